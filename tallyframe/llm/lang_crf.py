"""Language identification, also of code-switched text (operator 11).

Method: a linear-chain conditional random field over words. A word's features are its affixes, its byte n-grams
and what a lexicon says of it; a learnt matrix scores transitions between languages. Forward-backward gives each
word's probabilities of the languages; a document's language is the one that holds most of its words.

Labelled documents have one language each, so the chain learns switches from sequences spliced from segments of
several documents. Long texts are cut into chunks whose transfer matrices are multiplied first, so all chunks
are worked through side by side and the result is that of one pass over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SLICE_BYTES, U64, cut_lineage, powers, prefix_hash, text_slices, with_package

#: Buckets of hashed features and of the lexicon (2 ** bits), and degrees of a lexicon's certainty.
BITS, LEXICON_BITS, DEGREES = 16, 17, 3
#: The model is fitted on at most about so many rows, chosen by a hash, with up to SEGMENTS segments of SEGMENT words of
#: each, in parts of about PART rows whose weights are averaged.
MAX_ROWS, SEGMENTS, SEGMENT, PART = 4_096, 8, 24, 512
#: Segments of a spliced sequence, passes over a part, its batches, and the rates of learning and of decay.
SPLICE, PASSES, BATCHES, RATE, DECAY = 6, 10, 8, 0.3, 1e-5
#: Words of a chunk, and bytes of a text beyond which it is worked through in pieces.
CHUNK, PIECE = 64, 4 * SLICE_BYTES
AFFIXES, GRAMS = (1, 2, 3, 4), (2, 3)

_ODD = np.arange(3, 33, 2, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) | U64(1)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


@dataclass
class Words:
    """Words of several texts: bytes (lower-cased), each word's start and end, and the n + 1 word offsets of the texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    of: np.ndarray
    sums: np.ndarray | None = field(default=None)

    def __post_init__(self) -> None:
        if self.sums is None:
            self.sums = prefix_hash(self.data)
        self.down = powers(len(self.data) + 1)[1]

    def code(self, start: np.ndarray, end: np.ndarray, view: int, bits: int = BITS) -> np.ndarray:
        """Buckets of the windows from start to end."""
        windows = (self.sums[end] - self.sums[start]) * self.down[start]
        return (((windows ^ (windows >> U64(29))) * _ODD[view]) >> U64(64 - bits)).astype(np.int64)

    def affixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words that are as long, and buckets of their first and last bytes."""
        for k in AFFIXES:
            some = np.flatnonzero(self.end - self.start >= k)
            yield some, self.code(self.start[some], self.start[some] + k, 2 * k)
            yield some, self.code(self.end[some] - k, self.end[some], 2 * k + 1)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each size: words that have such n-grams, where each one's begin, and their buckets, word by word."""
        for k in GRAMS:
            n = np.maximum(0, self.end - self.start - k + 1)
            some = np.flatnonzero(n)
            firsts = np.cumsum(n[some]) - n[some]
            at = np.arange(n.sum()) + np.repeat(self.start[some] - firsts, n[some])
            yield some, firsts, self.code(at, at + k, 10 + k)

    def lexicon(self) -> np.ndarray:
        return self.code(self.start, self.end, 0, LEXICON_BITS)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words are runs of ASCII letters and of bytes beyond ASCII; capitals of ASCII and Latin-1 count as small."""
    small = _SMALL[data]
    # Latin-1 capitals are the two bytes C3 80 to C3 9E (fixed values of UTF-8)
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3) if len(data) else np.empty(0, bool)
    small[1:][capital] += 0x20
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~letter[:-1]
    after[:-1] |= ~letter[1:]
    start = np.flatnonzero(before & letter)
    return Words(small, start, np.flatnonzero(after & letter) + 1, np.searchsorted(start, offsets))


@dataclass
class Model:
    """Languages; per language the weights of feature buckets; the lexicon's entry per bucket (0: none, else 1 + language *
    DEGREES + degree) and the weights of entries; and the scores of transitions."""

    langs: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    entries: np.ndarray
    moves: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Scores (words, languages). Each distinct word is scored once."""
        _, one, of = np.unique(words.code(words.start, words.end, 1, 64), return_index=True, return_inverse=True)
        return self._scores(replace(words, start=words.start[one], end=words.end[one]))[of]

    def _scores(self, words: Words) -> np.ndarray:
        out = np.zeros((len(self.langs), len(words.start)))
        for some, bucket in words.affixes():
            for own, weights in zip(out, self.weights, strict=True):
                own[some] += weights[bucket]
        for some, firsts, bucket in words.grams():
            if len(some):
                for own, weights in zip(out, self.weights, strict=True):
                    own[some] += np.add.reduceat(weights[bucket], firsts)
        return out.T + self.entries[self.lexicon[words.lexicon()]]


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.max(axis=tuple(range(1, x.ndim)), keepdims=True), 1e-300)


class Chain:
    """Forward-backward over several sequences at once. ``scores``: (words, labels), ``at``: the n + 1 word offsets of
    the sequences, ``moves``: (labels, labels). ``joined``: the sequences go on from words before them."""

    def __init__(self, scores: np.ndarray, at: np.ndarray, moves: np.ndarray, joined: bool = False):
        self.e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
        self.a = np.exp(moves - moves.max())
        n = np.diff(at)
        per = -(-n // CHUNK)
        owner = np.repeat(np.arange(len(n)), per)
        number = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        length = np.minimum(CHUNK, n[owner] - number * CHUNK)
        # longest first, so that the chunks that go on after so many words stand in front
        self.order = np.argsort(-length, kind="stable")
        self.length = length[self.order]
        self.begin = (at[owner] + number * CHUNK)[self.order]
        self.first = (number[self.order] == 0) & (not joined)
        self.sequences, self.per, self.owner = len(n), per, owner[self.order]
        self.chunk = np.argsort(self.order)  # place of each chunk, by sequence and number
        self.labels = scores.shape[1]

    def _on(self, t: int) -> int:
        return int(np.searchsorted(-self.length, -t, "left"))  # chunks of more than t words

    def transfers(self, alone: bool) -> np.ndarray:
        """A matrix per chunk: states after it from states before it, scaled. Sequences of one chunk need none
        unless ``alone``."""
        n = self.labels
        some = np.flatnonzero(alone | (self.per[self.owner] > 1))  # still the longest first
        m = np.broadcast_to(np.eye(n), (len(some), n, n)).copy()
        for t in range(CHUNK if len(some) else 0):
            on = int(np.searchsorted(-self.length[some], -t, "left"))
            if not on:
                break
            moved = (m[:on].reshape(-1, n) @ self.a).reshape(-1, n, n)
            if t == 0:
                moved[self.first[some]] = m[self.first[some]]
            moved *= self.e[self.begin[some[:on]] + t][:, None, :]
            m[:on] = _scaled(moved) if t % 4 == 3 else moved
        out = np.zeros((len(self.length), n, n))
        out[some] = _scaled(m)
        return out

    def sequence_transfers(self) -> np.ndarray:
        """A matrix per sequence."""
        m = self.transfers(True)
        out = np.broadcast_to(np.eye(self.labels), (self.sequences, self.labels, self.labels)).copy()
        for k in range(int(self.per.max(initial=0))):
            some = np.flatnonzero(self.per > k)
            out[some] = _scaled(out[some] @ m[self.chunk[(np.cumsum(self.per) - self.per)[some] + k]])
        return out

    def run(self, before: np.ndarray | None = None, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States forward and backward (words, labels), each scaled. before, after: states at the sequences' ends."""
        shape = (len(self.length), self.labels)
        enter, leave = np.ones(shape), np.ones(shape)
        base = np.cumsum(self.per) - self.per
        if self.per.max(initial=0) > 1 or before is not None or after is not None:
            m = self.transfers(before is not None or after is not None)
            state = np.ones((self.sequences, self.labels)) if before is None else before.copy()
            for k in range(int(self.per.max(initial=0))):
                some = np.flatnonzero(self.per > k)
                own = self.chunk[base[some] + k]
                enter[own] = state[some]
                state[some] = _scaled((state[some][:, None, :] @ m[own])[:, 0])
            state = np.ones((self.sequences, self.labels)) if after is None else after.copy()
            for k in range(int(self.per.max(initial=0)) - 1, -1, -1):
                some = np.flatnonzero(self.per > k)
                own = self.chunk[base[some] + k]
                leave[own] = state[some]
                state[some] = _scaled((m[own] @ state[some][:, :, None])[:, :, 0])
        forward, backward = np.empty_like(self.e), np.empty_like(self.e)
        for t in range(CHUNK if len(self.length) else 0):
            on = self._on(t)
            if not on:
                break
            moved = enter[:on] @ self.a
            if t == 0:
                moved[self.first] = enter[self.first]
            at = self.begin[:on] + t
            moved *= self.e[at]
            enter[:on] = forward[at] = _scaled(moved) if t % 4 == 3 else moved
        for t in range(CHUNK - 1, -1, -1):
            on = self._on(t)
            at = self.begin[:on] + t
            backward[at] = leave[:on]
            moved = (leave[:on] * self.e[at]) @ self.a.T
            leave[:on] = _scaled(moved) if t % 4 == 0 else moved
        return forward, backward


def posteriors(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


def fit(words: Words, labels: np.ndarray, n: int, lexicon: np.ndarray, passes: int = PASSES, seed: int = 0) -> Model:
    """A field fitted to segments (the texts of ``words``, each of one label): segments in random order are spliced to
    sequences, and the weights follow the gradient of the sequences' log-likelihood, scaled by its past squares."""
    order = np.random.default_rng(seed).permutation(len(labels))
    sizes = np.diff(words.of)
    pick = np.concatenate([np.arange(words.of[i], words.of[i + 1]) for i in order]) if len(order) else np.empty(0, np.int64)
    place = np.empty(len(pick), np.int64)
    place[pick] = np.arange(len(pick))
    truth = np.repeat(labels[order], sizes[order])
    ends = np.cumsum(sizes[order])[SPLICE - 1 :: SPLICE]
    at = np.unique(np.concatenate([[0], ends, [len(pick)]]))

    word, bucket = [], []
    for some, codes in words.affixes():
        word.append(place[some])
        bucket.append(codes)
    for some, firsts, codes in words.grams():
        word.append(np.repeat(place[some], np.diff(np.append(firsts, len(codes)))))
        bucket.append(codes)
    word, bucket = np.concatenate(word), np.concatenate(bucket)
    by = np.argsort(word, kind="stable")
    word, bucket = word[by], bucket[by]
    entry = lexicon[words.lexicon()][pick]

    shapes = ((n, 1 << BITS), (1 + n * DEGREES, n), (n, n))
    values, squares = [np.zeros(s) for s in shapes], [np.full(s, 1e-2) for s in shapes]
    cuts = np.unique(np.linspace(0, len(at) - 1, BATCHES + 1).astype(np.int64))
    for _ in range(passes):
        for i, j in zip(cuts, cuts[1:], strict=False):
            first, last = at[i], at[j]
            a, b = np.searchsorted(word, [first, last])
            own, codes = word[a:b] - first, bucket[a:b]
            scores = np.stack([np.bincount(own, weights=w[codes], minlength=last - first) for w in values[0]], axis=1) + values[1][entry[first:last]]
            chain = Chain(scores, at[i : j + 1] - first, values[2])
            forward, backward = chain.run()
            rest = posteriors(forward, backward)
            rest[np.arange(last - first), truth[first:last]] -= 1
            entries = np.zeros(shapes[1])
            np.add.at(entries, entry[first:last], rest)
            # pairs of neighbours inside sequences: expected less seen
            inner = np.ones(last - first, bool)
            inner[at[i:j] - first] = False
            right = np.flatnonzero(inner)
            x, y = forward[right - 1], chain.e[right] * backward[right]
            moves = chain.a * ((x / np.maximum(((x @ chain.a) * y).sum(axis=1, keepdims=True), 1e-300)).T @ y)
            np.subtract.at(moves, (truth[first:last][right - 1], truth[first:last][right]), 1)
            steps = (np.stack([np.bincount(codes, weights=r[own], minlength=1 << BITS) for r in rest.T]), entries, moves)
            for value, square, step in zip(values, squares, steps, strict=True):
                step = step + DECAY * (last - first) * value
                square += step**2
                value -= RATE * step / np.sqrt(square)
    return Model([], values[0], lexicon, values[1], values[2])


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit("\\p{L}")), F.lit(False))


def learnt_rows(documents: DataFrame, max_rows: int) -> DataFrame:
    """part, lang, text of at most about ``max_rows`` rows of different doc_id, lang or text: see ``fitted``."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where("lang is not null and text is not null")
    rows = rows.where(~held_out(F.col("doc_id")))
    total = max(1, rows.count())
    share, parts = min(1.0, max_rows / total), -(-min(total, max_rows) // PART)
    key = F.xxhash64(F.lit(31), "doc_id", "lang", "text")
    place = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    chosen = rows.withColumn("key", key).where((place < share) & has_letter(F.col("text")))
    one = chosen.groupBy("key").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    return one.select(F.floor(place / share * parts).cast("int").alias("part"), "lang", "text")


def fitted(documents: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model learnt from text and lang of rows that aren't held out and have both and a letter. A text in several
    languages counts in each. Without such rows it knows no language."""
    with_package(documents.sparkSession)
    rows = cut_lineage(learnt_rows(documents, max_rows))
    langs = sorted(row["lang"] for row in rows.select("lang").distinct().collect())  # at most as many as rows
    number = {lang: i for i, lang in enumerate(langs)}
    if not langs:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros(1 << LEXICON_BITS, np.int32), np.zeros((1, 0)), np.zeros((0, 0)))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                words = words_of(data, offsets)
                row = np.repeat(np.arange(part.num_rows), np.diff(words.of))
                seen = np.unique(row << LEXICON_BITS | words.lexicon())
                lang = np.array([number[x] for x in part.column("lang").to_pylist()])[seen >> LEXICON_BITS]
                pairs, n = np.unique((seen & ((1 << LEXICON_BITS) - 1)) * len(langs) + lang, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs // len(langs)), pa.array(pairs % len(langs)), pa.array(n)], names=["bucket", "lang", "n"])

    counts = rows.select("lang", "text").mapInArrow(buckets, "bucket long, lang long, n long").groupBy("bucket", "lang").agg(F.sum("n").alias("n"))
    best = counts.groupBy("bucket").agg(F.max_by("lang", F.struct("n", -F.col("lang"))).alias("lang"), (F.max("n") / F.sum("n")).alias("share"), F.sum("n").alias("n")).where("n > 1")
    lexicon = np.zeros(1 << LEXICON_BITS, np.int32)
    for bucket, lang, share, _ in best.collect():  # a row per bucket at most
        lexicon[bucket] = 1 + lang * DEGREES + (share > 0.8) + (share > 0.98)
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lang", "ascending"), ("text", "ascending")])
        texts, labels = [], []
        for lang, text in zip(table.column("lang").to_pylist(), table.column("text").to_pylist(), strict=True):
            raw = np.frombuffer(text.encode(), np.uint8)
            words = words_of(raw, np.array([0, len(raw)]))
            n = -(-len(words.start) // SEGMENT)
            for k in range(n) if n <= SEGMENTS else np.random.default_rng(len(raw)).choice(n, SEGMENTS, replace=False):
                of = words.start[k * SEGMENT], words.end[min(len(words.end), (k + 1) * SEGMENT) - 1]
                texts.append(raw[of[0] : of[1]])
                labels.append(number[lang])
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        model = fit(words_of(np.concatenate(texts), at), np.array(labels), len(langs), shared.value)
        flat = np.concatenate([model.weights.ravel(), model.entries.ravel(), model.moves.ravel()])
        return pa.table({"rows": pa.array([len(table)], pa.int64()), "weights": pa.array([flat.tobytes()])})

    total, flat = 0, 0.0
    # one row of weights per part, of which there are max_rows / PART at most
    for row in rows.groupBy("part").applyInArrow(learn, "rows long, weights binary").collect():
        total += row["rows"]
        flat = flat + row["rows"] * np.frombuffer(row["weights"])
    flat, n = flat / total, len(langs)
    a, b = n << BITS, (n << BITS) + (1 + n * DEGREES) * n
    return Model(langs, flat[:a].reshape(n, -1), lexicon, flat[a:b].reshape(-1, n), flat[b:].reshape(n, n))


def pieces(data: np.ndarray) -> list[np.ndarray]:
    """A long text cut behind bytes that aren't letters, about every PIECE bytes (inside a longer run of letters, where the
    run reaches that)."""
    out, at = [], 0
    while len(data) - at > PIECE:
        gaps = np.flatnonzero(~_LETTER[data[at : at + PIECE]])
        to = at + (int(gaps[-1]) + 1 if len(gaps) else PIECE)
        out.append(data[at:to])
        at = to
    return [*out, data[at:]]


def long_posteriors(data: np.ndarray, model: Model) -> Iterator[tuple[Words, np.ndarray]]:
    """Words and probabilities of a text piece by piece: two passes, between which only a matrix per piece is held."""
    parts = pieces(data)
    n = len(model.langs)
    chain = lambda k, words: Chain(model.emissions(words), words.of, model.moves, joined=k > 0)
    started, matrices = False, []
    for part in parts:
        words = words_of(part, np.array([0, len(part)]))
        matrices.append(chain(int(started), words).sequence_transfers()[0])
        started |= len(words.start) > 0
    after = [np.ones((1, n))]
    for m in reversed(matrices[1:]):
        after.append(_scaled((m @ after[-1][0])[None]))
    after.reverse()
    before, started = np.ones((1, n)), False
    for part, m, end in zip(parts, matrices, after, strict=True):
        words = words_of(part, np.array([0, len(part)]))
        yield words, posteriors(*chain(int(started), words).run(before, end))
        started |= len(words.start) > 0
        before = _scaled(before @ m)


def slice_posteriors(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[Words, np.ndarray]:
    words = words_of(data, offsets)
    return words, posteriors(*Chain(model.emissions(words), words.of, model.moves).run())


def shares(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """(rows, languages): each language's part of a row's words; 0 for rows without words."""
    if len(offsets) == 2 and len(data) > PIECE:
        total = sum((np.append(p.sum(axis=0), len(p)) for _, p in long_posteriors(data, model)), np.zeros(len(model.langs) + 1))
        return total[None, :-1] / max(1, total[-1])
    words, p = slice_posteriors(data, offsets, model)
    n = np.diff(words.of)
    row = np.repeat(np.arange(len(n)), n)
    return np.stack([np.bincount(row, weights=own, minlength=len(n)) for own in p.T], axis=1) / np.maximum(1, n)[:, None]


def languages(documents: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each whole text.

    lang_pred: the learnt language that most of the words are in, the smaller one if two have as many; score: its part of
    the words, by their probabilities. A text that is null, empty or has no letter, and any text where no language could be
    learnt, is ``und`` with score 0. Only texts enter a prediction; see ``fitted`` for what is learnt. A null doc_id is
    not held out; repeated rows give repeated rows; other columns aren't read, whatever their names; no rows give no
    rows. Predicting has no shuffle."""
    model = documents.sparkSession.sparkContext.broadcast(fitted(documents, max_rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = model.value.langs
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                known = part.column("letter").to_numpy(zero_copy_only=False) & bool(langs)
                share = shares(data, offsets, model.value) if known.any() else np.zeros((part.num_rows, 1))
                best = share.argmax(axis=1)
                names = [langs[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
                score = np.where(known, np.clip(share[np.arange(len(best)), best], 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", has_letter(F.col("text")).alias("letter"))
    scored = source.mapInArrow(work, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def language_spans(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, start, end (bytes of the UTF-8 text), lang and probability (mean) of each run of words of one language, the
    likeliest for each word: code-switched texts have several. Texts without words have no rows; nulls, ties, repeats and
    other columns as in ``languages``."""
    with_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def runs(base: int, doc: int | None, words: Words, p: np.ndarray, row: int) -> Iterator[tuple]:
        a, b = words.of[row], words.of[row + 1]
        best = p[a:b].argmax(axis=1)
        cuts = np.append(np.flatnonzero(np.diff(best, prepend=-1)), b - a)
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield doc, base + int(words.start[a + i]), base + int(words.end[a + j - 1]), shared.value.langs[best[i]], float(p[a + i : a + j, best[i]].mean())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
        for batch in batches:
            for part, data, offsets in text_slices(batch) if shared.value.langs else ():
                out, ids = [], part.column("doc_id").to_pylist()
                if part.num_rows == 1 and len(data) > PIECE:
                    base = 0
                    for words, p in long_posteriors(data, shared.value):
                        out.extend(runs(base, ids[0], words, p, 0))
                        base += len(words.data)
                else:
                    words, p = slice_posteriors(data, offsets, shared.value)
                    for row, doc in enumerate(ids):
                        out.extend(runs(-int(offsets[row]), doc, words, p, row))
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], names=["doc_id", "start", "end", "lang", "probability"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(work, "doc_id long, start long, end long, lang string, probability double")
