"""Quality classifier (operator 10).

Method: Naive Bayes support vectors. A text's n-grams count as present or absent; each is scaled by the
logarithm of its share among good over its share among bad labelled texts, rows get length 1, and a
linear model of hinge loss is fitted to them by dual coordinate descent.

N-grams are hashed to a fixed number of buckets: byte trigrams, and one and two words' shapes (case,
digits, marks at both ends, repetition of the word before). Shares of a few shapes, in steps, count as
n-grams of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import U64, cut_lineage, mix, text_slices, tidy, with_package, word_hashes

#: Buckets of hashed n-grams (2 ** BITS). Weights of so many are all that goes to the driver and back.
BITS = 16
#: The model is fitted on at most about so many labelled rows, chosen by a hash of doc_id, in parts of
#: about PART rows whose models are averaged.
MAX_ROWS, PART = 16_384, 2_048
#: N-grams of a part, about, where parts of PART rows would have more, and the finest cut of such a part.
GRAMS, CUTS = 1 << 24, 64
#: Weight of a row's hinge loss, passes over the rows, and the share of the fitted weights beside their
#: mean size.
COST, PASSES, OWN = 1.0, 12, 0.75
#: Bytes of text that n-grams are found in at once: marks of (row, bucket) take up to 2 ** BITS bytes a row.
SLICE = 1 << 18

# Classes of bytes: 0 other marks, 1 lower case, 2 upper case, 3 digits, 4 beyond ASCII, 5 closing marks.
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[[ord(c) for c in ".,;:!?"]] = 5


def word_shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A number per word for its shape, and marks of words that count as shares."""
    kind = _CLASS[data]
    sums = {k: np.concatenate([[0], np.cumsum(kind == k)]) for k in (0, 2, 3, 5)}
    n = {k: s[end] - s[start] for k, s in sums.items()}
    size = end - start
    again = np.zeros(len(start), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    shouted = (n[2] > 1) & (n[2] * 2 >= size)
    marked = (n[0] > 0) & (n[0] < size)
    bare = n[0] + n[5] == size
    double = (n[5] > 1) & ~bare
    length = np.minimum(3, size // 5)
    shape = ((((kind[start] * 6 + kind[end - 1]) * 2 + shouted) * 2 + again) * 2 + (n[3] > 0)) * 4 + length
    return shape * 2 + marked, {"again": again, "shouted": shouted, "marked": marked, "bare": bare, "double": double, "digits": n[3] > 0}


def ngrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """row * 2 ** BITS + bucket for each row's distinct n-grams, ascending."""
    rows = len(offsets) - 1
    seen = np.zeros(rows << BITS, bool)
    shift = U64(64 - BITS)

    def put(row: np.ndarray, code: np.ndarray, view: int) -> None:
        bucket = mix(code.astype(U64) * U64(8) + U64(view)) >> shift
        seen[(row << BITS) + bucket.astype(np.int64)] = True

    if len(data) >= 3:
        code = data[:-2].astype(np.int64) << 16 | data[1:-1].astype(np.int64) << 8 | data[2:]
        row = np.repeat(np.arange(rows), np.diff(offsets))
        inside = row[:-2] == row[2:]
        put(row[:-2][inside], code[inside], 0)
    hashes, start, end, of = word_hashes(data, offsets, lower=False)
    if len(start):
        row = np.repeat(np.arange(rows), np.diff(of))
        shape, marks = word_shapes(data, start, end, hashes)
        put(row, shape, 1)
        pair = row[:-1] == row[1:]
        put(row[:-1][pair], (shape[:-1] * 4096 + shape[1:])[pair], 2)
        total = np.diff(of)
        some = np.flatnonzero(total)
        for k, mark in enumerate(marks.values()):
            share = np.bincount(row, weights=mark, minlength=rows)[some] / total[some]
            put(some, np.ceil(share * 16) * 16 + k, 3)
    return np.flatnonzero(seen)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels the model never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def solved(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, seed: int = 0, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Weights (and a bias, last) of a hinge-loss model by dual coordinate descent, and the rows' dual variables.
    Rows are bucket numbers; values are log-count ratios, scaled to rows of length 1, and 1 for the bias."""
    weights = np.zeros(len(ratio) + 1)
    scaled = [ratio[r] / max(1e-9, np.sqrt((ratio[r] ** 2).sum())) for r in rows]
    square = np.array([(v**2).sum() + 1 for v in scaled])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            gradient = labels[i] * (weights[rows[i]] @ scaled[i] + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), COST)
            if new != alpha[i]:
                step = (new - alpha[i]) * labels[i]
                weights[rows[i]] += step * scaled[i]
                weights[-1] += step
                alpha[i] = new
    return weights, alpha


def descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The weights of ``solved``, drawn towards their mean size."""
    weights, _ = solved(rows, labels, ratio)
    size = np.abs(weights[:-1]).mean()
    weights[:-1] = OWN * weights[:-1] + (1 - OWN) * size
    return weights


def learnt_rows(documents: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """cell, label, text of at most about ``max_rows`` labelled documents: see ``fitted``. A part has CUTS cells."""
    labels = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("id"), "quality")
    labels = labels.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most").drop("most")
    total = max(1, labels.count())
    share = min(1.0, max_rows / total)
    parts = -(-min(total, max_rows) // PART)
    place = F.shiftrightunsigned(F.xxhash64(F.lit(29), "id"), 11) / F.lit(float(1 << 53))
    chosen = labels.where(place < share).withColumn("cell", F.floor(place / share * parts * CUTS).cast("int"))
    # at most about max_rows ids: bounded whatever the input
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(chosen), "id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return texts.groupBy("id", "cell", "label").agg(least).select("cell", "label", F.col("least.text").alias("text"))


def fitted(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratios per bucket, and weights with the bias last, learnt from labels (doc_id, quality).

    Labels other than 0 and 1, contradicting labels of one id, ids without a text and held-out ids are left
    out; of rows that repeat a labelled id, the text of the least hash is learnt from. With no label left all weights are 0; with one class, the bias decides."""
    with_package(documents.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, limit=SLICE):
                found = ngrams(data, offsets)
                cuts = found.searchsorted(np.arange(part.num_rows + 1) << BITS)
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((found & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("cell"), part.column("label"), lists], names=["cell", "label", "grams"])

    rows = cut_lineage(learnt_rows(documents, labels, max_rows).mapInArrow(tidy(work), "cell int, label int, grams array<int>"))
    # long texts make parts of fewer rows, so that a task holds about GRAMS n-grams
    grams, parts = rows.agg(F.sum(F.array_size("grams")), F.count_distinct(F.floor(F.col("cell") / CUTS))).first()
    more = min(CUTS, -(-(grams or 0) // (GRAMS * max(1, parts))) or 1)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for label, grams in zip(batch.column("label").to_pylist(), batch.column("grams"), strict=True):
                counts[label, grams.values.to_numpy()] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[0, some]), pa.array(counts[1, some])], names=["gram", "bad", "good"])

    counts = np.ones((2, 1 << BITS))
    for row in rows.select("label", "grams").mapInArrow(tidy(tally), "gram int, bad long, good long").groupBy("gram").agg(F.sum("bad"), F.sum("good")).collect():
        counts[:, row[0]] += row[1:]
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    shared = documents.sparkSession.sparkContext.broadcast(ratio)

    def fit(table: pa.Table) -> pa.Table:
        grams = [g.values.to_numpy() for g in table.column("grams")]
        weights = descent(grams, np.where(table.column("label").to_numpy() == 1, 1.0, -1.0), shared.value)
        return pa.table({"rows": pa.array([len(grams)], pa.int64()), "weights": pa.array([weights.tobytes()])})

    total, weights = 0, np.zeros((1 << BITS) + 1)
    # one row of weights per part, of which there are CUTS * max_rows / PART at most
    for row in rows.groupBy(F.floor(F.col("cell") * more / CUTS).alias("part")).applyInArrow(fit, "rows long, weights binary").collect():
        total += row["rows"]
        weights += row["rows"] * np.frombuffer(row["weights"])
    return ratio, weights / max(1, total)


def margins(data: np.ndarray, offsets: np.ndarray, model: tuple) -> np.ndarray:
    """Distance of each row from the boundary; good texts are above 0."""
    squares, products, bias = model
    found = ngrams(data, offsets)
    row, gram = found >> BITS, found & ((1 << BITS) - 1)
    dot, norm = (np.bincount(row, weights=v[gram], minlength=len(offsets) - 1) for v in (products, squares))
    return dot / np.sqrt(np.maximum(norm, 1e-18)) + bias


def shared_model(documents: DataFrame, labels: DataFrame, max_rows: int):
    ratio, weights = fitted(documents, labels, max_rows)
    return documents.sparkSession.sparkContext.broadcast((ratio**2, ratio * weights[:-1], float(weights[-1])))


def quality_scores(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each whole text.

    score: 0 to 1, higher for good texts; predicted: 1 where it is 0.5 or more. Only texts enter it; see
    ``fitted`` for what is learnt. A null or empty text has no n-grams and gets the score of the bias; a
    null doc_id is not held out; repeated rows give repeated rows; other columns are not read, whatever
    their names; no rows give no rows. Scoring has no shuffle."""
    shared = shared_model(documents, labels, max_rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, limit=SLICE):
                score = 1 / (1 + np.exp(-2 * np.clip(margins(data, offsets, shared.value), -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(work), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents, whole, that the classifier doesn't reject. Texts are scored where they stand.

    A null or empty text has the score of the bias; null ids are no reason to go; repeated rows stay or go
    together; columns may have any names; no rows give no rows."""
    shared = shared_model(documents, labels, max_rows)

    def judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for own in texts:
            batch = pa.RecordBatch.from_arrays([own], names=["text"])
            kept = [margins(data, offsets, shared.value) >= 0 for _, data, offsets in text_slices(batch, limit=SLICE)]
            yield pa.array(np.concatenate(kept) if kept else np.empty(0, bool))

    @F.arrow_udf("boolean")
    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from tidy(judged)(texts)

    # only texts go to Python; rows wait for the answer in Spark's own queue
    return documents.where(good("text"))
