"""Document fingerprints (operator 9).

Method: improbable-feature digest. Every window of 64 bytes is ranked by how improbable the entropy of its
bytes is. Entropies of running text have one peak and fall off alike on both sides of it, so the rank is the
distance from the peak (``TYPICAL``); nearly constant windows (below ``LEAST`` bits) come last, since they are
padding and say nothing. Windows that are rarest in their neighbourhood are chosen as features. They go into a chain of Bloom filters of 2048 bits, a new one for every 128 features, and two
digests are compared by the bits that their filters share beyond chance, from 0 to 1.

A short text has few such windows or none, so it has chains of shorter windows besides (``SIZES``); only
chains of one window size are compared.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import cut_lineage, hash_sample, id_bitmap, in_bitmap, mix, powers, prefix_hash, U64, with_package
from tallyframe.llm.sharding import numbered

#: Bytes of a window, and windows on each side among which a feature is the rarest.
WINDOW, REACH = 64, 16
#: Bits of a filter, bits set per feature, and features per filter.
BITS, HASHES, FEATURES = 2048, 5, 128
#: Entropy of a window of running text in bits, about; the farther from it, the rarer. Windows below
#: LEAST bits say nothing and are chosen only where there are no others.
TYPICAL, LEAST = 4.0, 1.0
#: Window, reach, typical entropy, and bytes below which a text has features of this size. An edited text has
#: 0.5 to 2.5 times the bytes for a kept half of one-byte characters; the bounds overlap by more than that,
#: so that the two have a size in common which is short beside what they share.
SIZES = ((WINDOW, REACH, TYPICAL, 1 << 62), (16, 4, 3.3, 1024), (4, 1, 1.8, 256), (2, 0, 1.0, 64), (1, 0, 0.0, 8))
#: Bytes of texts that are worked on at once.
SLICE = 1 << 18

_LOG = np.zeros(WINDOW + 2)
_LOG[1:] = np.arange(1, WINDOW + 2) * np.log2(np.arange(1, WINDOW + 2))
#: Steps of entropy * window when a byte's count in the window rises to k, in units of 1 / 4096 bit.
_STEP = np.diff(np.round(_LOG * 4096)).astype(np.int32)


def entropies(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Entropy of each window's bytes, in bits. Counts of a window's first and last byte in it say by how
    much the sum changes from one window to the next."""
    n = len(data) - window + 1
    ahead = np.zeros(len(data), np.uint8)  # equal bytes among the window - 1 after each
    behind = np.zeros(len(data), np.uint8)
    for d in range(1, window):
        same = (data[:-d] == data[d:]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    first = np.bincount(data[:window], minlength=256)
    total = np.empty(n, np.int64)
    total[0] = int(np.round(_LOG[first] * 4096).sum())
    total[1:] = _STEP[behind[window:]] - _STEP[ahead[: n - 1]]
    # behind counts within window - 1 bytes, so the byte that has just left isn't among them
    return np.log2(window) - np.cumsum(total) / (4096 * window)


def least_within(x: np.ndarray, reach: int) -> np.ndarray:
    """The least value among each and the ``reach`` on both sides."""
    size = 2 * reach + 1
    padded = np.full(len(x) + 2 * reach, np.iinfo(x.dtype).max, x.dtype)
    padded[reach : reach + len(x)] = x
    width = 1
    while width * 2 <= size:
        padded = np.minimum(padded[:-width], padded[width:])
        width *= 2
    rest = size - width
    return (np.minimum(padded[: len(padded) - rest], padded[rest:]) if rest else padded)[: len(x)]


def features(texts: list[bytes]) -> list[dict[int, np.ndarray]]:
    """Hashes of the features of each text, in order, by their size. The empty text has none."""
    out: list[dict[int, np.ndarray]] = [{} for _ in texts]
    for window, reach, typical, below in SIZES:
        own = [i for i, t in enumerate(texts) if window <= len(t) < below]
        for i, found in zip(own, features_of([texts[i] for i in own], window, reach, typical), strict=True):
            out[i][window] = found
    return out


def features_of(texts: list[bytes], window: int, reach: int, typical: float) -> list[np.ndarray]:
    """Hashes of the features of one size of each text; none is shorter than a window."""
    if not texts:
        return []
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    sums = prefix_hash(data)
    n = len(data) - window + 1
    hashes = mix((sums[window:] - sums[:n]) * powers(n)[1])
    entropy = entropies(data, window)
    rarity = np.abs(entropy - typical) * 4096
    # the rarest first; equals in an order that their bytes decide
    rank = np.where(entropy < LEAST, 1 << 20, (1 << 19) - np.minimum(rarity, (1 << 19) - 1).astype(np.int64))
    key = rank << 32 | (hashes >> U64(32)).astype(np.int64)
    valid = np.ones(n, bool)
    for end in ends[:-1]:
        valid[end - window + 1 : end] = False
    key[~valid] = np.iinfo(np.int64).max
    # texts are apart by window - 1 >= reach invalid windows, so neighbourhoods don't mix
    chosen = np.flatnonzero(valid & (key == least_within(key, reach)))
    cuts = chosen.searchsorted(np.concatenate([[0], ends]))
    out = []
    for at, to in zip(cuts, cuts[1:], strict=False):
        found = hashes[chosen[at:to]]
        _, first = np.unique(found, return_index=True)
        out.append(found[np.sort(first)])
    return out


def filters(found: np.ndarray) -> np.ndarray:
    """The filters of features of one size: one row of bits each."""
    n = -(-len(found) // FEATURES)
    bits = np.zeros((n, BITS), np.uint8)
    if n:
        at = np.arange(len(found)) // FEATURES
        for k in range(HASHES):
            bits[at, (found >> U64(11 * k)).astype(np.int64) & (BITS - 1)] = 1
    return bits


def digest(found: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The chain of filters of a text's features of each size."""
    return {window: filters(x) for window, x in found.items()}


def shared(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """How alike two chains are, and the bits that this rests on: each filter of the shorter chain is held
    against all of the longer one, and the best shares of common bits beyond chance are averaged, weighted by
    the filter's bits."""
    if len(a) > len(b):
        a, b = b, a
    own, other = a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64)
    common = a.astype(np.float32) @ b.astype(np.float32).T
    chance = own[:, None] * other[None, :] / BITS
    most = np.minimum(own[:, None], other[None, :])
    share = np.clip((common - chance) / np.maximum(1e-9, most - chance), 0, 1)
    return float((share.max(axis=1) * own).sum() / own.sum()), int(own.sum())


def likeness(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> float:
    """How alike two digests are: the mean over the window sizes that both have, weighted by bits. Digests
    without a common size are unlike."""
    if not a or not b:
        return float(len(a) == len(b))
    parts = [shared(a[window], b[window]) for window in sorted(a.keys() & b.keys())]
    return sum(x * n for x, n in parts) / max(1, sum(n for _, n in parts))


def as_text(bits: dict[int, np.ndarray]) -> str:
    """A digest as text: its filters in base64, joined by points; chains of windows other than the longest
    begin with their size and a colon, and follow it after a comma."""
    chain = lambda x: ".".join(base64.b64encode(row.tobytes()).decode() for row in np.packbits(x, axis=1))
    return ",".join((f"{window}:" if window != WINDOW else "") + chain(x) for window, x in bits.items())


def ranges(rows: DataFrame, parts: int) -> list[tuple[int, int, int]]:
    """At most ``parts`` - 1 keys (known, id, hash) that cut all rows into about equal ranges, from a sample of 8 a range."""
    values = sorted(tuple(r) for r in hash_sample(rows, 8 * parts, *KEY).collect())
    return sorted({values[i * len(values) // parts] for i in range(1, parts)}) if values else []


#: Order of rows: those without an id first, then by id and by the text's hash.
KEY = ("known", "id", "hash")


def counted_rows(documents: DataFrame) -> DataFrame:
    """known, id, hash, text and n: equal rows (by id and hash of the text) are one with their number.

    The keys of repeated rows are found from keys alone; only rows that a bitmap of those lets through are grouped with
    their texts, which tasks combine before they send them. Nothing here depends on the order in which rows come."""
    rows = documents.select(F.col("doc_id").isNotNull().cast("int").alias("known"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("known", "id", F.xxhash64("text").alias("hash"), "text")
    again = cut_lineage(rows.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64(*KEY).alias("mark")))
    one = F.lit(1).cast("long").alias("n")
    if again.isEmpty():
        return rows.select(*KEY, "text", one)
    bits = documents.sparkSession.sparkContext.broadcast(id_bitmap(again, "mark"))

    @F.pandas_udf("boolean")
    def maybe(marks):
        import pandas as pd

        return pd.Series(in_bitmap(bits.value, marks.to_numpy()))

    flagged = rows.withColumn("maybe", maybe(F.xxhash64(*KEY)))
    several = flagged.where("maybe").groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("n"))
    return flagged.where("not maybe").select(*KEY, "text", one).union(several)


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document's, by ascending doc_id and, of equal ids, by a hash of the text; after the
    last comes the first. near_edited and near_next: likeness to the edited text and to the next document.

    A null or empty text has an empty digest, which is like another empty one (1) and unlike others (0). A
    null doc_id comes before all others. Repeated rows follow each other, so that all but the last of them are their own
    next. A single row is its own next. Other columns are not read, whatever their names; no rows give no rows.

    Whole texts are dealt out once, by ranges of (doc_id, hash of the text), so that an id of very many rows is cut into
    several ranges; only the first document of each range goes to two tasks, since the range before needs it as its
    next. Keys are made of a row's own cells, so a task that runs again deals the same rows to the same ranges."""
    spark = documents.sparkSession
    with_package(spark)
    rows = counted_rows(documents)
    edges = ranges(rows.select(*KEY), 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))

    @F.pandas_udf("int")
    def range_of(known, ids, hashes):
        import pandas as pd

        return pd.Series([bisect_right(edges, x) for x in zip(known, ids, hashes, strict=True)], dtype="int32")

    rows = rows.withColumn("part", range_of(*KEY))
    # the least key of each range that has rows: at most as many as there are ranges
    heads = sorted((r.part, *r.least) for r in rows.select("part", *KEY).groupBy("part").agg(F.min(F.struct(*KEY)).alias("least")).collect())
    # one row per range: as many as tasks, so that it may be broadcast
    neighbours = spark.createDataFrame([(*key, heads[i - 1][0]) for i, (_, *key) in enumerate(heads)], "known int, id long, hash long, before int")
    rows = rows.join(F.broadcast(neighbours), list(KEY), "left")
    extra = F.col("before")
    twice = F.array_compact(F.array(F.struct("part", F.lit(0).alias("late")), F.when(extra.isNotNull(), F.struct(extra.alias("part"), F.lit(1).alias("late")))))
    dealt = rows.withColumn("to", F.explode(twice)).select("to.part", "to.late", *KEY, "text", "n")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "late", *KEY)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows of one range whose last one still needs its next
        size = 0
        for batch in batches:
            for part, known, id_, text, n in zip(*(batch.column(c).to_pylist() for c in ("part", "known", "id", "text", "n")), strict=True):
                if waiting and waiting[-1][0] != part:
                    yield from compared(waiting)
                    waiting, size = [], 0
                waiting.append((part, id_ if known else None, text, n))
                size += len(text)
                if size > SLICE:
                    yield from compared(waiting)
                    waiting, size = waiting[-1:], len(text)
        yield from compared(waiting)

    def compared(waiting: list) -> Iterator[pa.RecordBatch]:
        if len(waiting) < 2:
            return
        texts = [w[2] for w in waiting]
        # a row, its next and how often: of repeated rows all but the last are followed by themselves
        pairs = [pair for i, w in enumerate(waiting[:-1]) for pair in (*([(i, i, w[3] - 1)] if w[3] > 1 else []), (i, i + 1, 1))]
        edited = []
        for i, j, _ in pairs:
            half = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - half] + texts[j][:half])
        raw = [t.encode() for t in edited]
        digests = [digest(f) for f in features([t.encode() for t in texts] + raw)]
        plain, changed = digests[: len(texts)], digests[len(texts) :]
        own = [as_text(d) for d in plain]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([waiting[i][1] for i, _, _ in pairs], pa.int64()),
                pa.array([len(texts[i]) for i, _, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                pa.array([own[i] for i, _, _ in pairs], pa.string()),
                pa.array([as_text(d) for d in changed], pa.string()),
                pa.array([likeness(plain[i], d) for (i, _, _), d in zip(pairs, changed, strict=True)], pa.float64()),
                pa.array([likeness(plain[i], plain[j]) for i, j, _ in pairs], pa.float64()),
                pa.array([n for _, _, n in pairs], pa.int64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n"],
        )

    out = dealt.mapInArrow(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n long")
    return numbered(out, "copy").drop("copy")
