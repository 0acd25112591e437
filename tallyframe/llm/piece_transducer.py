"""SentencePiece encoding and decoding (operator 3).

Method: a weighted finite-state transducer. Normaliser, pieces and byte fallback are compiled from the
model file into arcs; composed with an input they give a lattice of states, each a place in the input and
what the path's last piece matters for, and the encoding is the lattice's shortest path in the tropical
semiring (weights add along a path, the least total wins).

Weights: of a unigram model, an arc's weight is minus its piece's score. Of a model that merges pairs, sums
of scores don't give the library's result; there a state has the last piece too, and an arc weighs 0 where
its piece stays as it is beside that one under the merges' order, and infinity otherwise (``prefix_bpe``
says why pairs suffice). One path of finite weight is left for each input, and it is the library's encoding.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import quoted, text_slices, texts_of, tidy, with_package
from tallyframe.llm.prefix_bpe import PrefixTable

SPACE = "▁"
# Marks that often end a word.
CLOSING = (",", ".", ";", ":", "!", "?")
#: Words whose paths a worker remembers in each of its two dictionaries, and the longest of them in characters. They stay in the
#: worker, in which later stages run too.
REMEMBERED, LONG = 1 << 17, 48
#: Marks (bytes) that tell words that come again.
SEEN = 1 << 22


def message_fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, raw[at : at + size]
        at += size


class Arcs:
    """Arcs over symbols, as a tree from state 0; a state at the end of a piece has its output and weight."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.out: list[tuple | None] = [None]

    def add(self, symbols: str, output: str, weight: float) -> None:
        at = 0
        for c in symbols:
            to = self.next[at].get(c)
            if to is None:
                to = self.next[at][c] = len(self.next)
                self.next.append({})
                self.out.append(None)
            at = to
        self.out[at] = (output, weight)


class SpacedWords(dict):
    """Maps a word without its space mark to the id bytes of it with the mark."""

    def __init__(self, words: PieceTransducer):
        super().__init__()
        self.of = words

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in self.of.loose and word[-2:-1].isalpha():
            return self[word[:-1]] + self.of[word[-1]]
        cut = self.of.barrier.split(word) if self.of.barrier else [word]
        if len(cut) > 1:
            return self[cut[0]] + b"".join(map(self.of.rest, cut[1:]))
        out = self.of.path(SPACE + word)
        self.of.remember(self, word, out)
        return out


class PieceTransducer(dict):
    """Maps a word (from one space mark to the next) to the bytes of its piece ids, four to an id."""

    def __init__(self, path: str):
        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        fields = list(message_fields(model.serialized_model_proto()))
        trainer, rules = (dict(message_fields(dict(fields).get(k, b""))) for k in (2, 3))
        pieces = [{3: 1} | dict(message_fields(raw)) for k, raw in fields if k == 1]
        # Fixed values of the model format: field 3 of the trainer is the kind (1 unigram, 2 merged pairs); of the
        # normaliser 2 is its character map, 3 adds a space in front, 4 removes spaces, 5 marks spaces; of a
        # piece 1 is its name, 2 its score, 3 its kind (1 normal, 2 unknown, 3 control, 4 given by users, 5
        # unused, 6 byte).
        self.merges = trainer.get(3, 1) == 2
        if trainer.get(3, 1) not in (1, 2) or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError(f"{path}: only unigram and merged-pair models with the identity normaliser are supported")
        if any(x[3] in (4, 5) for x in pieces) or sum(x[3] == 6 for x in pieces) != 256:
            raise ValueError(f"{path}: a model with byte fallback and without unused or given pieces is needed")
        names = [x[1].decode() for x in pieces]
        self.bytes = {int(names[i][3:5], 16): i for i, x in enumerate(pieces) if x[3] == 6}
        self.ids = {names[i]: i for i, x in enumerate(pieces) if x[3] == 1}
        score = {p: struct.unpack("<f", pieces[i].get(2, bytes(4)))[0] for p, i in self.ids.items()}

        # the normaliser: an arc from nothing to a space mark in front, and arcs from symbol to symbol
        self.front = SPACE if rules.get(3, 1) else ""
        self.symbols = {" ": SPACE}
        # the pieces: for merged pairs those that merging gives, at no weight
        self.arcs = Arcs()
        if self.merges:
            self.table = PrefixTable(self.ids, max(map(len, self.ids)), lambda a, b: -score[a + b] if a + b in score else None, list)
            for p in self.ids:
                if self.table.stable(p):
                    self.arcs.add(p, p, 0.0)
        else:
            for p in self.ids:
                self.arcs.add(p, p, -score[p])
        # byte fallback: an arc for a symbol that no piece is. Fixed value: what it weighs beyond the rarest piece.
        self.unknown = 0.0 if self.merges else np.float32(-min(score.values())) + np.float32(10)

        self.by_word = self.merges and not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        #: Marks that no piece has right after a letter, so that words can be cut before them.
        self.loose = {c for c in CLOSING if not any(x == c and y.isalpha() for p in self.ids for y, x in zip(p, p[1:], strict=False))}
        #: Control characters that no piece has: nothing is merged over them. A split keeps them, each between
        #: the parts beside it.
        alone = [c for c in map(chr, range(32)) if not any(c in p for p in self.ids)]
        self.barrier = re.compile("([" + "".join(map(re.escape, alone)) + "])") if alone else None
        self.spaced = SpacedWords(self)
        #: A mark for words seen before, by their hash, and how many there are.
        self.seen, self.marks = bytearray(SEEN), 0
        #: What each id decodes to: bytes, with nothing for control pieces.
        self.outputs = [b""] * len(pieces)
        for p, i in self.ids.items():
            self.outputs[i] = p.replace(SPACE, " ").encode()
        for b, i in self.bytes.items():
            self.outputs[i] = bytes([b])
        self.outputs[model.unk_id()] = " ⁇ ".encode()
        self.output_array = np.array(self.outputs, object)
        self.fallback = set(self.bytes.values())

    def normalised(self, text: str) -> str:
        for symbol, other in self.symbols.items():
            text = text.replace(symbol, other)
        return self.front + text if text else ""

    def arcs_from(self, word: str, at: int) -> list[tuple[int, str, float]]:
        """Arcs of the composition with a word that start at a place: where they end, piece, weight; the
        shortest first."""
        found = []
        after, out = self.arcs.next, self.arcs.out
        state, end, n = 0, at, len(word)
        while end < n:
            state = after[state].get(word[end])
            if state is None:
                break
            end += 1
            arc = out[state]
            if arc is not None:
                found.append((end, *arc))
        if not found or found[0][0] > at + 1:
            found.insert(0, (at + 1, word[at], self.unknown))
        return found

    def shortest(self, word: str) -> list[str]:
        """The pieces of the shortest path.

        Finite weights of merged pairs are all 0, so states are taken in any order: the last one found first. Whether
        an arc's weight is finite is asked when its end is taken, which most arcs' ends never are.
        Merging gives each prefix one encoding, so a place has one state of finite weight."""
        if not self.merges:
            return self.shortest_by_places(word)
        n, known, beside = len(word), self.table.known, self.table.beside
        after, out = self.arcs.next, self.arcs.out
        first = after[0]
        pieces: list[str] = []
        waiting: list[list[str]] = []  # for each place of the path the arcs from it that are left, by their pieces
        taken = set()
        at = 0
        while at < n:
            # the arcs from here as in ``arcs_from``, the shortest first
            end, c = at + 1, word[at]
            node = first.get(c)
            left = [c] if node is None or out[node] is None else []
            while node is not None:
                arc = out[node]
                if arc is not None:
                    left.append(arc[0])
                if end == n:
                    break
                node = after[node].get(word[end])
                end += 1
            waiting.append(left)
            last = pieces[-1] if pieces else None
            while True:
                while not left:  # all infinite: a place back
                    waiting.pop()
                    at -= len(pieces.pop())
                    left = waiting[-1]
                    last = pieces[-1] if pieces else None
                piece = left.pop()
                if at + len(piece) in taken:
                    continue
                if last is None:
                    break
                zero = known.get((last, piece))
                if beside(last, piece) if zero is None else zero:
                    break
            pieces.append(piece)
            at += len(piece)
            taken.add(at)
        return pieces

    def shortest_by_places(self, word: str) -> list[str]:
        """The shortest path where weights are sums of scores: states are places, relaxed from left to right. Sums are
        in single precision and over whole texts, as the library adds them up."""
        sums, by = [np.float32(0)] + [None] * len(word), [None] * (len(word) + 1)
        for at in range(len(word)):
            for end, piece, weight in self.arcs_from(word, at):
                total = np.float32(sums[at] + np.float32(weight))
                if by[end] is None or total < sums[end]:
                    sums[end], by[end] = total, (at, piece)
        path: list[str] = []
        at = len(word)
        while at:
            at, piece = by[at]
            path.append(piece)
        return path[::-1]

    def ids_of(self, piece: str) -> list[int]:
        """The output of an arc: the piece's id, or those of its bytes."""
        i = self.ids.get(piece)
        return [i] if i is not None else [self.bytes[b] for b in piece.encode()]

    def path(self, word: str) -> bytes:
        """The ids of a word's shortest path, as int32 bytes."""
        pieces = self.shortest(word)
        ids = list(map(self.ids.get, pieces))
        if None in ids:
            ids = [i for piece in pieces for i in self.ids_of(piece)]
        return array("i", ids).tobytes()

    def rest(self, word: str) -> bytes:
        return self[word] if word else b""

    def __missing__(self, word: str) -> bytes:
        cut = self.barrier.split(word) if self.by_word and self.barrier and len(word) > 1 else [word]
        if len(cut) > 1:
            return b"".join(map(self.rest, cut))
        if self.by_word and word[-1:] in self.loose and word[-2:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        out = self.path(word)
        self.remember(self, word, out)
        return out

    def remember(self, words: dict, word: str, path: bytes) -> None:
        """Keep a word's path in ``words`` if the word comes again: most come once."""
        at = hash(word) % SEEN
        if len(word) > LONG:
            return
        if not self.seen[at]:
            self.marks += 1
            if self.marks > SEEN // 2:
                self.seen, self.marks = bytearray(SEEN), 1
            self.seen[at] = 1
            return
        if len(words) >= REMEMBERED:
            words.clear()
        words[word] = path

    def encode(self, text: str) -> bytes:
        """The ids of a text, as int32 bytes."""
        text = self.normalised(text)
        if not self.by_word or SPACE * 2 in text or text.endswith(SPACE):
            return b"".join(map(self.__getitem__, self.words(text)))
        first, *rest = text.split(SPACE)
        return self.rest(first) + b"".join(map(self.spaced.__getitem__, rest))

    def words(self, text: str) -> Iterator[str]:
        """Parts that no piece crosses: space marks and what follows them up to the next one."""
        if not self.by_word:
            if text:
                yield text
            return
        at = 0
        while at < len(text):
            to = at
            while to < len(text) and text[to] == SPACE:
                to += 1
            end = text.find(SPACE, to)
            end = len(text) if end < 0 else end
            yield text[at:end]
            at = end

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 give one U+FFFD each."""
        raw = b"".join(self.output_array[ids].tolist())
        if self.front and raw[:1] == b" " and len(ids) and int(ids[0]) not in self.fallback:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="bytewise")


def _bytewise(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("bytewise", _bytewise)

_transducers: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """One per worker; its memory of words lasts over tasks."""
    if path not in _transducers:
        _transducers[path] = PieceTransducer(path)
    return _transducers[path]


def encode_pieces(documents: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), check: bool = False) -> DataFrame:
    """The columns ``keep`` and ids array<int>, n_ids of each row's whole text.

    ``model``: path of the model file, on every executor. ``check`` adds round_trip: whether the ids
    decode to the text again.

    A null or empty text has no ids; nulls in kept columns stay; repeated rows give repeated rows; other
    columns are not read, whatever their names; no rows give no rows. There is no shuffle."""
    with_package(documents.sparkSession)
    # the kept columns as one struct, so that their names can't clash with those here
    kept = F.struct(*[F.col(quoted(c)) for c in keep])
    source = documents.select(kept.alias("kept"), "text")
    schema = T.StructType([source.schema["kept"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_ids", T.LongType())])
    if check:
        schema = schema.add("round_trip", "boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                texts = texts_of(data, offsets)
                paths = [machine.encode(t) for t in texts]
                sizes = np.array([len(p) // 4 for p in paths], np.int64)
                values = np.frombuffer(b"".join(paths), np.int32)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                columns = [part.column("kept"), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values)), pa.array(sizes)]
                if check:
                    columns.append(pa.array([machine.decode(values[ends[i] : ends[i + 1]]) == t for i, t in enumerate(texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = source.mapInArrow(tidy(work), schema)
    return out.select("kept.*", *schema.names[1:])


def decode_pieces(encoded: DataFrame, model: str, column: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the text of the ids in ``column``: the transducer read backwards.

    Null and empty ids give the empty text, null elements are skipped; ids outside the model are an error.
    Nulls in kept columns stay; repeated rows give repeated rows; other columns are not read, whatever their
    names; no rows give no rows. There is no shuffle."""
    with_package(encoded.sparkSession)
    kept = F.struct(*[F.col(quoted(c)) for c in keep])
    source = encoded.select(kept.alias("kept"), F.coalesce(F.array_compact(F.col(quoted(column))), F.array().cast("array<int>")).alias("ids"))
    schema = T.StructType([source.schema["kept"], T.StructField("text", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in batches:
            texts = []
            for x in batch.column("ids"):
                ids = x.values.to_numpy()
                if len(ids) and not 0 <= ids.min() <= ids.max() < len(machine.outputs):
                    raise ValueError(f"ids outside the model's {len(machine.outputs)} pieces")
                texts.append(machine.decode(ids))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(tidy(work), schema).select("kept.*", "text")
