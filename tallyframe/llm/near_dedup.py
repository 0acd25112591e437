"""Near-duplicate documents (operator 5).

Method: MinHash by one-permutation hashing with optimal densification, banded buckets, and star-shaped
candidate edges. A document's word-shingle set is hashed once; the hash's top bits choose a bin and each
bin keeps its least hash; an empty bin borrows from a bin that its own random sequence of bins reaches.
Documents that agree in all bins of a band share a bucket, and a bucket of n documents gives n - 1 edges
to its smallest member, not n * n / 2. Edges are confirmed on the full sets.

Two documents of a bucket may be linked though neither is with the bucket's centre. Buckets that hold more
than one component after the stars are settled by ``rare_links`` and ``long_band_links``, which never form all pairs
of a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import U64, Scratch, cut_lineage, id_bitmap, in_bitmap, matched_rows, mix, row_hash, text_slices, tidy, with_package, word_hashes

#: Bins of a signature, and its bands: 40 of 5 bins. A pair of similarity 0.85 misses all of them with
#: probability 7e-11, one of 0.8 with 1e-7.
BINS, BANDS, ROWS = 256, 40, 5
#: Partners of one centre that are compared in a task.
BESIDE = 64
#: A shingle is rare if at most so many of the sets at hand have it.
RARE = 8
#: Rounds of stars with the most central members in the buckets that the first ones leave open, at most.
ROUNDS = 2
#: Bins of a long band.
LONG = 10
#: So many times the centres are chosen in a long band's bucket with each round, up to so many in one list.
FURTHER, CENTRES = 32, 1 << 15
#: Classes of sizes in a long band's bucket, for each doubling of the size.
CLASSES = 4
#: Cells in which a set's members are counted (a power of 2), before long bands' pairs are made.
CELLS = 32
#: Edges of a task, about, when components are found.
EDGES = 1 << 20
#: Shingles of more than one part in 16 * HOT of all are joined by broadcast: there are fewer than so many.
HOT = 4096

Keep = Callable[[DataFrame], DataFrame]

_MULTIPLIERS = mix(np.arange(1, 65, dtype=np.uint64) * U64(0xA0761D6478BD642F)) | U64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted hashes of each row's distinct shingles, end to end, and the n + 1 offsets of the rows.

    Shingles are ``words`` lower-cased words; a row with fewer has its whole sequence as one."""
    hashes, _, _, of = word_hashes(data, offsets, lower=True)
    n = np.diff(of)
    full = np.zeros(max(0, len(hashes) - words + 1), U64)
    for k in range(words):
        full += hashes[k : k + len(full)] * _MULTIPLIERS[k]
    full = mix(full)
    out, sizes = [], np.zeros(len(n), np.int64)
    for i in range(len(n)):
        if n[i] >= words:
            found = np.unique(full[of[i] : of[i + 1] - words + 1])
        elif n[i]:
            own = hashes[of[i] : of[i + 1]]
            found = mix(np.array([(own * _MULTIPLIERS[: len(own)]).sum(dtype=U64) + U64(len(own))], U64))
        else:
            continue
        out.append(found)
        sizes[i] = len(found)
    return (np.concatenate(out) if out else np.empty(0, U64)), np.concatenate([[0], np.cumsum(sizes)])


def set_ids(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit number per set, from the sum of its members' hashes."""
    sums = np.zeros(len(sets) + 1, U64)
    np.cumsum(mix(sets ^ U64(0x5851F42D4C957F2D)), out=sums[1:])
    return mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(U64)).view(np.int64)


def signatures(sets: np.ndarray, offsets: np.ndarray, bins_of: int = BINS) -> np.ndarray:
    """One row of ``bins_of`` values (a power of 2) per set; rows of empty sets are zero."""
    n = len(offsets) - 1
    out = np.zeros((n, bins_of), U64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    cell = row * bins_of + (sets >> U64(64 - bins_of.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sets are sorted, so each bin's least comes first
    out.ravel()[cell[first]] = sets[first]
    filled = np.zeros((n, bins_of), bool)
    filled.ravel()[cell[first]] = True
    rows, bins = np.nonzero(~filled & (np.diff(offsets) > 0)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        if attempt < 4096:
            lender = (mix(bins.astype(U64) * U64(0x9FB21C651E98DF25) + U64(attempt)) & U64(bins_of - 1)).astype(np.int64)
        else:
            lender = (bins + attempt) % bins_of
        hit = filled[rows, lender]
        out[rows[hit], bins[hit]] = out[rows[hit], lender[hit]]
        rows, bins = rows[~hit], bins[~hit]
    return out


def sketch(members: np.ndarray) -> bytes:
    """One byte per bin, not densified: 0 for an empty bin, else 1 to 255 from its least member. There are as
    many bins as members, or up to twice as many."""
    width = max(6, int(len(members) - 1).bit_length())
    cell = (members >> U64(64 - width)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    out = np.zeros(1 << width, np.uint8)
    out[cell[first]] = (members[first] % U64(255)).astype(np.uint8) + 1
    return out.tobytes()


def bins_apart(a: np.ndarray, b: np.ndarray) -> int:
    """Bins in which two sketches differ. Each has a member that just one of the sets has."""
    while len(a) > len(b):
        a = np.where(a[::2] > 0, a[::2], a[1::2])  # the least of two neighbouring bins is that of the first, if it has one
    while len(b) > len(a):
        b = np.where(b[::2] > 0, b[::2], b[1::2])
    return int((a != b).sum())


def sketches(documents: DataFrame, words: int, row: Column | None = None) -> DataFrame:
    """Per document: doc_id, row (as given), n_shingles, the id of its set, band keys and a sketch."""
    with_package(documents.sparkSession)
    schema = "doc_id long, row long, n_shingles long, id long, bands array<long>, sketch binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                sets, at = shingle_sets(data, offsets, words)
                size = np.diff(at)
                table = signatures(sets, at)
                keys = (table[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS) * _MULTIPLIERS[:ROWS]).sum(axis=2, dtype=U64)
                keys = mix(keys + np.arange(BANDS, dtype=U64)).view(np.int64)
                starts = (np.cumsum(size > 0) - (size > 0)) * BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.append(starts, (size > 0).sum() * BANDS).astype(np.int32)), pa.array(keys[size > 0].ravel()))
                small = pa.array([sketch(sets[i:j]) if i < j else None for i, j in zip(at, at[1:], strict=False)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(size), pa.array(set_ids(sets, at)), bands, small], names=["doc_id", "row", "n_shingles", "id", "bands", "sketch"])

    named = [F.col("doc_id").cast("long").alias("doc_id"), (F.lit(None).cast("long") if row is None else row).alias("row"), "text"]
    return documents.select(*named).mapInArrow(tidy(work), schema)


def full_sets(documents: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """id, n, members (the sorted hashes of all shingles) of each set named in ``needed``, once."""
    bits = documents.sparkSession.sparkContext.broadcast(id_bitmap(needed, "id"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch):
                sets, at = shingle_sets(data, offsets, words)
                ids = set_ids(sets, at)
                some = np.flatnonzero((np.diff(at) > 0) & in_bitmap(bits.value, ids))
                some = some[np.unique(ids[some], return_index=True)[1]]  # copies once
                members = pa.array([sets[at[i] : at[i + 1]].view(np.int64) for i in some], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), members], names=["id", "members"])

    every = documents.select("text").mapInArrow(tidy(sets_of), "id long, members array<long>")
    one = every.groupBy("id").agg(F.first("members").alias("members"))
    return one.join(needed.select("id").distinct(), "id", "left_semi").select("id", F.array_size("members").cast("long").alias("n"), "members")


def joined(rows: DataFrame, values: DataFrame, key: str, keep: Keep) -> DataFrame:
    """Inner join of rows with ``values`` (one row per key). The values are written first, so that both sides of the join are
    shuffles, and Spark splits what a hot key has on the side of the rows."""
    return rows.join(keep(values), key)


def possible(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (u, v) but for those that can't be linked: by their sizes, or because their sketches show more
    members that just one of them has than a link allows. No linked pair is left out."""
    left = nodes.select(F.col("id").alias("u"), F.col("sketch").alias("su"), F.col("n_shingles").alias("nu"))
    right = nodes.select(F.col("id").alias("v"), F.col("sketch").alias("sv"), F.col("n_shingles").alias("nv"))
    both = pairs.join(left, "u").join(right, "v").where(100 * F.least("nu", "nv") >= similarity * F.greatest("nu", "nv"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = [bins_apart(np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)) for a, b in zip(batch.column("su"), batch.column("sv"), strict=True)]
            total = batch.column("nu").to_numpy() + batch.column("nv").to_numpy()
            keep = (100 + similarity) * (total - np.array(apart, np.int64)) >= 2 * similarity * total
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    return both.select("u", "v", "su", "sv", "nu", "nv").mapInArrow(tidy(work), "u long, v long")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int, keep: Keep) -> DataFrame:
    """The pairs (u, v) whose sets (id, n, members) have (100 + similarity) * both >= similarity * (n of u + n of v),
    with ``both``, the members in common. With n members each this says that intersection over union reaches it.

    A centre's set goes to each task with up to BESIDE of its partners, so a centre with very many of them is
    spread over tasks; a task holds one centre at a time."""
    counts = pairs.groupBy("u").agg((F.count("*") / BESIDE).cast("int").alias("more"))
    placed = joined(pairs, counts, "u", keep).select("u", "v", F.pmod(F.xxhash64("v"), F.col("more") + 1).alias("part"))
    ends = placed.select(F.col("v").alias("id"), "u", "part", F.lit(1).alias("side")).union(placed.select(F.col("u").alias("id"), "u", "part", F.lit(0).alias("side")).distinct())
    beside = sets.join(ends, "id").repartition("u", "part").sortWithinPartitions("u", "part", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre, n_centre = None, None, 0
        for batch in batches:
            us, parts, sides, ids, ns = (batch.column(c).to_pylist() for c in ("u", "part", "side", "id", "n"))
            members = batch.column("members")
            found = []
            for i, (u, part, side, own_id, n) in enumerate(zip(us, parts, sides, ids, ns, strict=True)):
                own = members[i].values.to_numpy().view(U64)
                if side == 0:
                    key, centre, n_centre = (u, part), own.copy(), n
                    continue
                assert key == (u, part)
                few, many = (own, centre) if len(own) < len(centre) else (centre, own)
                at = np.minimum(many.searchsorted(few), len(many) - 1)
                both = int((many[at] == few).sum())
                if (100 + similarity) * both >= similarity * (n + n_centre):
                    found.append((u, own_id, both))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], names=["u", "v", "both"])

    return beside.select("u", "part", "side", "id", "n", "members").mapInArrow(tidy(compare), "u long, v long, both long")


def rare_links(sets: DataFrame, similarity: int, keep: Keep) -> DataFrame:
    """Links (u, v) of sets (id, n, members, component) that, with the links within components, join whatever all
    links join, without all pairs.

    Only links between components matter, so a shingle that one component's sets have alone counts for nothing.
    The others are ordered by how many sets have them. A link needs a share of the larger set in common, so two
    linked sets have a shingle in common among the first few of both (a prefix filter). If it is rare, few sets
    have it, and their pairs are compared. If not, they have no rare shingle in common, and only their other
    shingles count: sets with the same ones are one from there on, and what links those is left to ``long_band_links``.
    Its pairs stand for all sets behind them: of each, the smallest is linked first, and any other one to the partner that
    takes the largest sets. A page template, however many pages have it, is one set after this."""
    room = lambda both: F.floor((100 + similarity) * both / similarity)  # noqa: E731  # most members of two linked sets
    elements = sets.select("id", "component", F.explode("members").alias("x"))
    alone = (F.min("component") == F.max("component")).alias("alone")
    counts = keep(elements.groupBy("x").agg(F.count("*").alias("df"), F.min("id").alias("one"), alone))
    total = counts.agg(F.sum("df")).first()[0] or 0
    # the most frequent shingles, fewer than 16 * HOT; without them no shingle's rows are many
    often = (F.col("df") > 1) & (F.col("df") * 16 * HOT > total)
    hot = F.broadcast(counts.where(often).select("x", "alone"))
    several = counts.where((F.col("df") > 1) & (F.col("alone") | (F.col("df") <= RARE)))
    rank = F.when(F.col("alone"), 0).otherwise(F.col("df")).alias("df")
    listed = elements.join(hot.select("x"), "x", "left_anti").join(several.where(~often), "x").select("id", "x", rank)
    listed = listed.union(elements.join(hot.where("alone"), "x").select("id", "x", F.lit(0).cast("long")))
    listed = listed.union(elements.join(hot.select("x"), "x", "left_semi").join(F.broadcast(several.where(often & ~F.col("alone"))), "x").select("id", "x", "df"))
    listed = listed.union(counts.where("df = 1").select(F.col("one").alias("id"), "x", F.lit(0).cast("long")))
    listed = listed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("rare"))
    source = sets.join(listed, "id", "left").select("id", "n", "component", "members", "rare")
    split = keep(source.mapInArrow(tidy(lambda batches: _split(batches, similarity)), "id long, n long, m long, component long, keys array<long>, rest_id long, rest array<long>"))

    # a rare shingle's sets are RARE at most; shingles of the same sets give their pairs once
    keyed = split.select(F.struct("id", "n", "m", "component").alias("set"), F.explode("keys").alias("key"))
    lists = keyed.groupBy("key").agg(F.array_sort(F.collect_list("set")).alias("sets")).where(F.size("sets") > 1).select("sets").distinct()
    pairs = keep(lists.mapInArrow(tidy(lambda batches: _pairs(batches, similarity)), "u long, v long").distinct())
    links = confirmed(pairs, sets, similarity, keep).select("u", "v")

    left = split.where("rest is not null")
    groups = left.groupBy("rest_id").agg(F.min(F.struct("n", "id")).alias("least"), F.first("rest").alias("members"), F.min("component").alias("a"), F.max("component").alias("b"))
    # a group of several components is compared with all others: each of its sets may be linked elsewhere
    level = keep(groups.select("rest_id", F.col("least.id").alias("id"), F.col("least.n").alias("n"), "members", F.when(F.col("a") == F.col("b"), F.col("a")).alias("component")))
    into = level.select("rest_id", F.col("id").alias("to"), F.col("n").alias("n_to"), F.array_size("members").alias("size"))
    behind = keep(left.select(F.col("id").alias("node"), F.col("n").alias("n_node"), "rest_id").join(into, "rest_id").where("node != to"))
    found = long_band_links(level.drop("rest_id"), similarity, keep)
    links = links.union(found.select("u", "v")).union(behind.where(F.col("n_node") + F.col("n_to") <= room(F.col("size"))).select(F.col("node").alias("u"), F.col("to").alias("v")))
    ends = [(F.col(a).alias("to"), F.struct((room(F.col("both")) - F.col(f"n_{b}")).alias("most"), F.col(b).alias("v")).alias("best")) for a, b in ("uv", "vu")]
    best = found.select(*ends[0]).union(found.select(*ends[1])).groupBy("to").agg(F.max("best").alias("best"))
    links = links.union(behind.join(best, "to").where("n_node <= best.most and node != best.v").select(F.col("node").alias("u"), F.col("best.v").alias("v")))
    return keep(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())


def long_bands(similarity: int) -> int:
    """So many bands of LONG bins that a pair of the similarity shares none with probability 1e-10."""
    return math.ceil(math.log(1e-10) / math.log1p(-((similarity / 100) ** LONG)))


def own_bands(n: np.ndarray, m: np.ndarray, similarity: int) -> np.ndarray:
    """The long bands that a set of n shingles needs, of which m are ``members``: so many that it shares none with a set that it is
    linked with, by those, with probability 1e-10.

    By the link's terms (see ``long_band_links``) the other set has n * similarity / 100 to reach / similarity shingles, with
    reach = (100 + similarity) * m - similarity * n. The members of the two are least alike if the other one is the largest of these and has
    all m among its members: m * similarity / reach, which is 1 for a set that has the fewest members of any linked one, below which it has no
    band. Both sets of a pair are in the bands that the pair's own likeness asks for."""
    reach = (100 + similarity) * m - similarity * n
    some = 100 * m >= similarity * n
    alike = np.minimum(1, similarity * m / np.where(some, reach, 1))
    with np.errstate(divide="ignore"):
        needed = np.ceil(math.log(1e-10) / np.log1p(-(alike**LONG)))
    return np.where(some, np.clip(needed, 1, long_bands(similarity)), 0).astype(np.int64)


def long_band_links(level: DataFrame, similarity: int, keep: Keep) -> DataFrame:
    """Links (u, v, both, n_u, n_v) of sets (id, n, members, component) that join whatever their links join; a null component is
    always compared.

    Buckets of long bands hold hardly any sets but linked ones: of two sets with 17 % in common one pair in 10 million shares
    one. In a bucket the member with most company is the centre of a star and is compared with all others of other components; then
    it is done with, and so is a bucket whose ``low`` members have all been centres. Rounds go on, with FURTHER times the centres,
    CENTRES at most, until no bucket has two components left.

    ``members`` may be fewer than n: the others are in no two sets. A link needs (100 + similarity) * both >= similarity * (n of u +
    n of v), so the smaller set of a linked pair has (100 + similarity) * members >= 2 * similarity * n. Only such ``low`` sets
    are centres, and a bucket without one is settled: edits of one text that each have too many shingles of their own are never
    compared with each other. For the same reason members go before each round that by size fit no low set of another
    component in their bucket (none of a class of sizes, by what its sets are at least and at most), and a set is only in the
    bands that its members need (``own_bands``): the fewer of its shingles are members, the more alike are those of linked sets.
    A pair is only made, bucket by bucket, if its members by CELLS ranges of their hashes allow a link, which edits of one text in
    different places mostly don't."""
    spark = level.sparkSession
    bands = long_bands(similarity)
    width = 1 << (bands * LONG - 1).bit_length()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                lists = part.column("members")
                sets, ends = lists.flatten().to_numpy().view(U64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                table = signatures(sets, ends, width)[:, : bands * LONG].reshape(-1, bands, LONG)
                keys = mix((table * _MULTIPLIERS[:LONG]).sum(axis=2, dtype=U64) + np.arange(bands, dtype=U64)).view(np.int64)
                own = own_bands(part.column("n").to_numpy(), np.diff(ends), similarity)
                ids = np.repeat(part.column("id").to_numpy(), own)
                yield pa.RecordBatch.from_arrays([pa.array(keys[np.arange(bands) < own[:, None]]), pa.array(ids)], names=["bucket", "id"])

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            sets, m = lists.flatten().to_numpy().view(U64), lists.value_lengths().to_numpy().astype(np.int64)
            cell = np.repeat(np.arange(len(m)) * CELLS, m) + (sets >> U64(64 - CELLS.bit_length() + 1)).astype(np.int64)
            counts = pa.array(np.bincount(cell, minlength=len(m) * CELLS).astype(np.int32))
            cells = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * CELLS), counts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "component", "n")), pa.array(m), batch.column("low"), cells], names=["id", "component", "n", "m", "low", "cells"])

    # no createDataFrame: its rows come from a Python RDD, whose workers stay beside those of the Arrow steps
    none = spark.range(0).select(*[F.lit(0).cast("long").alias(c) for c in ("u", "v", "both", "n_u", "n_v")])
    size = F.array_size("members").cast("long")
    low = (100 + similarity) * size >= 2 * similarity * F.col("n")
    if level.limit(2).count() < 2 or level.where(low).isEmpty():
        return none
    rest = keep(level.select("id", "n", "members").mapInArrow(tidy(work), "bucket long, id long"))
    labels = level.select("id", "component", "n", "members", low.alias("low")).mapInArrow(tidy(in_cells), "id long, component long, n long, m long, low boolean, cells array<int>")
    labels = keep(labels)
    # two sets have no more in common in a cell than the one with fewer members there
    most = lambda c: F.aggregate(F.zip_with("cells", c["cells"], lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda a, x: a + x)
    enough = lambda both, c: (100 + similarity) * both >= similarity * (F.col("n") + c["n"])
    fits = lambda c: (
        (c["id"] != F.col("id")) & (F.col("component").isNull() | ~c["component"].eqNullSafe(F.col("component"))) & enough(F.least("m", c["m"]), c) & enough(most(c), c)
    )
    # a null component is none of the others; by their sizes two sets fit if the reach of each is the other's share of n
    lone = F.coalesce("component", F.xxhash64("id"))
    reach = (100 + similarity) * F.col("m") - similarity * F.col("n")
    partner = lambda c: ((c["first"] < c["last"]) | (c["first"] != lone)) & (reach >= similarity * c["least"]) & (c["reach"] >= similarity * F.col("n"))
    found, centres = none, 1
    while True:
        inside = rest.join(labels, "id")
        by_size = inside.groupBy("bucket", F.floor(CLASSES * F.log2("n")).alias("class")).agg(
            *[f(lone).alias(a) for f, a in ((F.min, "a"), (F.max, "b"))],
            *[f(F.when(F.col("low"), value)).alias(a) for f, value, a in ((F.min, lone, "first"), (F.max, lone, "last"), (F.min, F.col("n"), "least"), (F.max, reach, "reach"))],
            F.count_if("low").alias("lows"),
            F.count("*").alias("members"),
        )
        sizes = F.collect_list(F.when(F.col("lows") > 0, F.struct("first", "last", "least", "reach"))).alias("sizes")
        counted = by_size.groupBy("bucket").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("lows").alias("lows"), F.sum("members").alias("members"), sizes)
        open_ = counted.where("a < b and lows > 0").select("bucket", "lows", "members", "sizes")
        rest = keep(joined(inside, open_, "bucket", keep).where(F.exists("sizes", partner)).drop("sizes"))
        if rest.isEmpty():
            return found
        slot = F.when(F.col("lows") <= centres, F.col("id")).otherwise(F.pmod(F.xxhash64("id", "bucket"), F.lit(centres)))
        best = with_company(rest.where("low"), keep).groupBy("bucket", slot.alias("slot")).agg(F.max(F.struct("company", "id", "component", "n", "m", "cells")).alias("centre"))
        chosen = keep(best.groupBy("bucket").agg(F.collect_list(F.struct("centre.id", "centre.component", "centre.n", "centre.m", "centre.cells")).alias("centres")))
        other = rest.join(chosen, "bucket").select("id", "n", F.explode(F.filter("centres", fits)).alias("c"))
        ends = F.when(F.col("id") < F.col("c.id"), F.struct(F.col("id").alias("u"), F.col("c.id").alias("v"), F.col("n").alias("n_u"), F.col("c.n").alias("n_v")))
        ends = ends.otherwise(F.struct(F.col("c.id").alias("u"), F.col("id").alias("v"), F.col("c.n").alias("n_u"), F.col("n").alias("n_v")))
        pairs = keep(other.select(ends.alias("pair")).select("pair.*").distinct())
        new = keep(confirmed(pairs.select("u", "v"), level, similarity, keep).join(pairs, ["u", "v"]).select("u", "v", "both", "n_u", "n_v"))
        found = found.union(new)
        # where all low members have been centres nothing is left to compare
        done = chosen.select("bucket", F.explode("centres.id").alias("id"))
        rest = keep(rest.where(F.col("lows") > centres).select("bucket", "id").join(done, ["bucket", "id"], "left_anti"))
        if rest.isEmpty():
            return found
        centres = min(centres * FURTHER, CENTRES)
        if not new.isEmpty():
            of = labels.where("component is not null").select("id", "component")
            met = new.join(of.withColumnsRenamed({"id": "u", "component": "a"}), "u").join(of.withColumnsRenamed({"id": "v", "component": "b"}), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
            merged = components(met, keep).select(F.col("id").alias("component"), F.col("component").alias("to"))
            labels = keep(labels.join(merged, "component", "left").select("id", F.coalesce("to", "component").alias("component"), "n", "m", "low", "cells"))


def _split(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Of each set: the rare shingles among its first ones, and its other shingles where a link could rest on those."""
    for batch in batches:
        out: list[tuple] = []
        for own_id, n, component, members, rare in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "component")), batch.column("members"), batch.column("rare"), strict=True):
            own = members.values.to_numpy()
            few, df = (rare.values.field("x").to_numpy(), rare.values.field("df").to_numpy()) if rare.is_valid else (np.empty(0, np.int64),) * 2
            need = -(-similarity * n // 100)  # members that any partner has in common with it, at least
            if len(own) < need:
                continue
            prefix = len(own) - need + 1
            keys = few[:prefix][df[:prefix] > 0]
            rest = None
            if len(own) - len(few) >= need:
                rest = own[~np.isin(own, few)]
            if len(keys) or rest is not None:
                rest_id = None if rest is None else int(set_ids(rest.view(U64), np.array([0, len(rest)]))[0])
                out.append((own_id, n, len(own), component, keys, rest_id, rest))
        types = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], t) for k, t in enumerate(types)], names=["id", "n", "m", "component", "keys", "rest_id", "rest"])


def _pairs(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Pairs of each list's sets, of different components, that may be linked if the smaller one's members are all in
    the other."""
    for batch in batches:
        for sets in batch.column("sets"):
            ids, n, m, component = (sets.values.field(c).to_numpy() for c in ("id", "n", "m", "component"))
            for i in range(len(ids) - 1):
                fits = (component[i + 1 :] != component[i]) & ((100 + similarity) * np.minimum(m[i + 1 :], m[i]) >= similarity * (n[i + 1 :] + n[i]))
                other = ids[i + 1 :][fits]
                if len(other):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(other), ids[i])), pa.array(other)], names=["u", "v"])


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (u, v) as stars: each of their ids with the smallest one it is joined to."""
    parts = [np.stack([b.column(c).to_numpy() for c in ("u", "v")]) for b in batches if b.num_rows]
    if not parts:
        return
    ids, ends = np.unique(np.concatenate(parts, axis=1), return_inverse=True)
    u, v = ends.reshape(2, -1)
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    others = np.flatnonzero(root != np.arange(len(ids)))
    for at in range(0, len(others), 1 << 16):
        some = others[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[root[some]]), pa.array(ids[some])], names=["u", "v"])


def components(edges: DataFrame, keep: Keep) -> DataFrame:
    """id, component (its smallest id) of every id in an edge (u, v).

    Each task makes stars of the edges it has; then edges meet by their larger end, where several smaller ends of
    one id join, and an end that has a smaller one itself is replaced by it (pointer jumping), until nothing changes. A
    task has about EDGES edges at most; hubs have many edges as smaller ends only, by which no task gathers them (the join
    is one whose large partitions Spark splits)."""
    ends = edges.select(F.least("u", "v").cast("long").alias("u"), F.greatest("u", "v").cast("long").alias("v")).where("u < v")
    pairs = keep(ends.mapInArrow(tidy(contracted), "u long, v long"))
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        # at first ids are still spread over many stars
        parents = keep(pairs.groupBy("v").agg(F.min("u").alias("to"))).select(F.col("v").alias("u"), "to")
        jumped = pairs.join(parents, "u", "left").select(F.coalesce("to", "u").alias("u"), "v")
        tasks = state[0] // EDGES
        met = jumped.repartition(tasks, "v") if tasks > int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) else jumped.repartition("v")
        pairs = keep(met.mapInArrow(tidy(contracted), "u long, v long"))
    own = pairs.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return pairs.select(F.col("v").alias("id"), F.col("u").alias("component")).union(own)


def classes(documents: DataFrame, words: int, similarity: int, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, n_shingles, id) and set ids with their component (id, component): see ``near_duplicates``."""
    keep = Scratch(documents.sparkSession)
    base = keep(sketches(documents, words, row))
    of_sets = base.where("n_shingles > 0").groupBy("id")
    nodes = keep(of_sets.agg(F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))

    band = nodes.select("id", F.explode("bands").alias("bucket"))
    centres = band.groupBy("bucket").agg(F.min("id").alias("u"), F.count("*").alias("members")).where("members > 1").drop("members")
    stars = keep(joined(band, centres, "bucket", keep))
    edges = stars.where("u != id").select("u", F.col("id").alias("v")).distinct()
    tried = keep(possible(edges, nodes, similarity))
    wanted = tried.select(F.col("u").alias("id")).union(tried.select(F.col("v").alias("id")))
    links = keep(confirmed(tried, full_sets(documents, wanted, words), similarity, keep).select("u", "v"))
    labels = components(links, keep)

    rest = unsettled(stars.select("bucket", "id"), labels, keep)
    if not rest.isEmpty():
        sets = keep(full_sets(documents, rest, words))
        for _ in range(ROUNDS):
            weighed = with_company(rest, keep)
            centres = weighed.groupBy("bucket").agg(F.max(F.struct("company", "id", "component")).alias("centre"))
            edges = joined(weighed, centres, "bucket", keep).where("component != centre.component").select(F.col("centre.id").alias("u"), F.col("id").alias("v")).distinct()
            found = keep(confirmed(keep(possible(edges, nodes, similarity)), sets, similarity, keep).select("u", "v"))
            if found.isEmpty():
                break
            links = links.union(found)
            labels = components(links, keep)
            rest = unsettled(rest.select("bucket", "id"), labels, keep)
        left = rest.select("id", "component").distinct()
        labels = components(links.union(rare_links(keep(sets.join(left, "id")), similarity, keep)), keep)
    named = nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    out = cut_lineage(base.select("doc_id", "row", "n_shingles", "id")), cut_lineage(named)
    keep.drop()
    return out


def unsettled(members: DataFrame, labels: DataFrame, keep: Keep) -> DataFrame:
    """bucket, id, component and members (how many the bucket has) of the members (bucket, id) of buckets with several
    components. A bucket of two is settled: one is its centre."""
    inside = members.join(labels, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    open_ = inside.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("members")).where("members > 2 and a < b").select("bucket", "members")
    return keep(joined(inside, open_, "bucket", keep))


def with_company(rest: DataFrame, keep: Keep) -> DataFrame:
    """``rest`` (bucket, id, members) with each id's company: the members of all its buckets. The text that many others
    are edited from has most, and is the one that they are linked with, though they needn't be with each other."""
    return joined(rest, rest.groupBy("id").agg(F.sum("members").alias("company")), "id", keep)


def spread(rows: DataFrame, named: DataFrame, least: Column) -> DataFrame:
    """``rows`` of ``classes`` that have shingles, with ``first``: the least value of ``least`` in each one's component."""
    own = rows.where("n_shingles > 0").groupBy("id").agg(F.min(least).alias("first")).join(named, "id")
    counted = own.groupBy("component").agg(F.min("first").alias("first"))
    return joined(rows.where("n_shingles > 0"), joined(own.select("id", "component"), counted, "component", cut_lineage).select("id", "first"), "id", cut_lineage)


def near_duplicates(documents: DataFrame, words: int = 5, similarity: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Two documents are linked where 100 * intersection >= similarity * union of their distinct shingles of
    ``words`` lower-cased words (A-Z), confirmed on the full sets; component_id is the smallest doc_id
    reached over links and kept says that this is the row's own. Equal sets are one from the start, so a
    group of copies counts once in everything after.

    An empty or null text has no shingles and links with nothing. Rows with a null doc_id link like others and
    get the smallest doc_id of their group; where a group has null ids only, component_id is null and all its
    rows are kept. Rows that repeat a doc_id are linked each by its own text. Repeated rows give repeated rows
    with the same values. Other columns are not read, whatever their names; no rows give no rows. Sets
    count as equal where a 64-bit hash of them is."""
    rows, named = classes(documents, words, similarity)
    linked = spread(rows, named, F.col("doc_id")).select("doc_id", "n_shingles", F.col("first").alias("component_id"))
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def without_near_duplicates(documents: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """One row, whole, of each group of near copies: the one of the smallest doc_id (nulls last) and, of those, of
    the least hash of all its columns (of types that can be hashed, so no maps).

    Null and repeated doc_ids make no difference to what is a copy: of several equal rows one stays. Rows with an
    empty or null text, or without words, link with nothing and all stay. No rows give no rows; columns may have any names."""
    rows, named = classes(documents, words, similarity, row_hash(documents))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    chosen = spread(rows, named, order)
    stays = chosen.groupBy("row", order.eqNullSafe(F.col("first")).alias("stays")).agg(F.count("*").alias("n"))
    stays = cut_lineage(stays)
    gone = stays.where("not stays").select("row")
    out = matched_rows(documents, gone, "left_anti")
    again = stays.where("stays and n > 1")
    if again.isEmpty():
        return out
    return matched_rows(out, again, "left_anti").unionByName(matched_rows(out, again, "left_semi").distinct())
