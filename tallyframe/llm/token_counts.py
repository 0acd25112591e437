"""Exact token counts of texts, and of every prefix of them (operator 2).

Method: prefix dynamic programming. A table per pretoken (see ``prefix_bpe``) and running sums over
the pretokens give the count of any prefix; a text is never encoded again to cut it to a budget.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import text_slices, texts_of, with_package
from tallyframe.llm.prefix_bpe import PrefixTable

# The pattern by which byte-level BPE cuts text before merging, and its parts.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# The white space of Unicode, which the pattern's \s stands for.
SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# Marks that are a pretoken of their own after a word and before a space.
CLOSING = (",", ".", ";", ":", "!", "?")

#: Pretokens whose counts a worker remembers, and the longest of them in characters.
REMEMBERED, LONG = 600_000, 48


def byte_codes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 bytes for
    themselves, the others, in order, for 256 and on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ChunkCounts(dict):
    """Maps text without spaces to its number of tokens after a space."""

    def __init__(self, words: PrefixCounter):
        super().__init__()
        self.of = words

    def __missing__(self, chunk: str) -> int:
        if chunk[-1:] in CLOSING and chunk[:-1].isalpha():
            return self[chunk[:-1]] + self.of[chunk[-1]]
        if chunk.isalpha():
            n = self.of.table.solve(b" " + chunk.encode())[0][-1]
        else:
            n = sum(map(self.of.__getitem__, self.of.words.findall(" " + chunk)))
        if len(chunk) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = n
        return n


class PrefixCounter(dict):
    """Maps a pretoken to its number of tokens, and counts the tokens of prefixes of whole texts."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path}: only byte-level BPE without normaliser or added prefix space is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must match plainly")
        code = byte_codes()
        raw = lambda s: bytes(code[c] for c in s)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        tokens = {raw(t) for t in model["vocab"] if t not in special}
        parts, formed = {a + b: (a, b) for a, b in ranks}, {a + b: i for (a, b), i in ranks.items()}
        in_order = len(parts) == len(ranks) and all(formed.get(x, -1) < i for pair, i in ranks.items() for x in pair)
        self.table = PrefixTable(tokens, max(map(len, tokens)), lambda a, b: ranks.get((a, b)), lambda t: [t[i : i + 1] for i in range(len(t))], parts if in_order else None)
        self.words = regex.compile(WORDS.replace(r"[^\s", "[^" + SPACES).replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]"))
        self.blank = regex.compile(f"[{SPACES}]+")
        self.wide = re.compile(f"[{SPACES}] | [{SPACES}]|^ | $")
        self.chunks = ChunkCounts(self)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def __missing__(self, word: str) -> int:
        n = self.table.solve(word.encode())[0][-1]
        if len(word) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special tokens, and those (True)."""
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if part:
                yield part, bool(i % 2)

    def count(self, text: str) -> int:
        return self.measure(text)[0]

    def measure(self, text: str, budget: int | None = None) -> tuple[int, int]:
        """The number of tokens, and the characters of the longest prefix of at most ``budget`` of them."""
        if self.special is not None and self.special.search(text):
            n = sum(1 if special else self.measure(part)[0] for part, special in self.pieces(text))
            return n, len(text) if budget is None or n <= budget else self.fitting(text, budget)
        if not text or self.wide.search(text):
            words = self.words.findall(text)
            each = list(map(self.__getitem__, words))
        else:
            # pretokens begin at every single space, so the parts between spaces can be counted apart
            words = text.split(" ")
            each = list(map(self.chunks.__getitem__, words))
            each[0] = sum(map(self.__getitem__, self.words.findall(words[0])))
            words = [words[0], *(" " + w for w in words[1:])] if budget is not None else words
        n = sum(each)
        if budget is None or n <= budget:
            return n, len(text)
        return n, self.cut(words, each, budget)

    def cut(self, words: list[str], each: list[int], budget: int) -> int:
        """``measure``'s prefix for a text over the budget, from the counts of its parts: it ends in the part
        that goes over, and only the stretch around that is looked into."""
        sums = np.cumsum(each)
        over = int(sums.searchsorted(budget, "right"))
        start = over
        while start and self.blank.match(words[start - 1][-1:]):  # white space belongs to what follows it
            start -= 1
        end = over + 1
        while end < len(words) and self.blank.match(words[end - 1][-1:]):
            end += 1
        inner = self.prefixes_of_plain("".join(words[start:end])) + (int(sums[start - 1]) if start else 0)
        return sum(map(len, words[:start])) + int(np.flatnonzero(inner <= budget)[-1])

    def word_prefixes(self, text: str) -> list[int]:
        """Counts of all prefixes, by characters, of a text that is one pretoken."""
        counts = self.table.solve(text.encode())[0]
        out, at = [0], 0
        for c in text:
            at += len(c.encode())
            out.append(counts[at])
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """The number of tokens of every prefix of the text, by characters: n + 1 numbers.

        A prefix may cut a pretoken otherwise than the whole text does: white space at its end is one
        pretoken, a cut contraction is an apostrophe and letters, a cut special token is plain text."""
        out = np.zeros(len(text) + 1, np.int64)
        at = done = 0
        for part, special in self.pieces(text):
            if special:
                cut = np.concatenate([self.prefixes_of_plain(part)[:-1], [1]])
                # the text before it and the cut special token may form pretokens together
                back = self.tail(text[:at])
                if back and not (self.special and self.special.fullmatch(back)):
                    joined = self.prefixes_of_plain(back + part)
                    cut = joined[len(back) :] - self.count(back)
                    cut[-1] = 1
                out[at + 1 : at + 1 + len(part)] = done + cut[1:]
                done += 1
            else:
                inner = self.prefixes_of_plain(part)
                out[at + 1 : at + 1 + len(part)] = done + inner[1:]
                done += int(inner[-1])
            at += len(part)
        return out

    def tail(self, text: str) -> str:
        """The last plain stretch before a special token that pretokens of what follows can reach into."""
        plain = list(self.pieces(text))
        if not plain or plain[-1][1]:
            return ""
        words = self.words.findall(plain[-1][0])
        out = ""
        for w in reversed(words):
            out = w + out
            if not self.blank.fullmatch(w) and len(out) > len(w) or not self.blank.match(w):
                break
        return out

    def prefixes_of_plain(self, text: str) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.int64)
        at = done = 0
        blank_from = base = -1  # where the white space before the present pretoken began, and the count there
        for w in self.words.findall(text):
            lead = self.blank.match(w)
            k = lead.end() if lead else 0
            if k:
                if blank_from < 0:
                    blank_from, base = at, done
                # within white space, a prefix ends in one pretoken of all the white space so far
                out[at + 1 : at + 1 + k] = base + np.array(self.word_prefixes(text[blank_from : at + k])[at + 1 - blank_from :])
            if k < len(w):
                if w in CONTRACTIONS:
                    inner = [0, self["'"], *(self["'"] + self[w[1:j]] for j in range(2, len(w))), self[w]]
                else:
                    inner = self.word_prefixes(w)
                out[at + k + 1 : at + 1 + len(w)] = done + np.array(inner[k + 1 :])
                blank_from = -1
            done += self[w]
            at += len(w)
        return out

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One per worker; its memory of pretokens lasts over tasks."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 1024, prefixes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars of each row, over whole texts.

    ``tokenizer``: path of a byte-level BPE file, on every executor. ``fit_chars``: characters of the
    longest prefix that has at most ``limit`` tokens (all of them, if none are over).
    ``prefixes``: adds ``prefix_tokens``, the count at every prefix by characters, from the empty one.

    A null text is an empty one (0 tokens); a null doc_id stays null; repeated rows give repeated rows;
    other columns are not read, whatever their names; no rows give no rows. There is no shuffle."""
    with_package(documents.sparkSession)
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + (", prefix_tokens array<int>" if prefixes else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                texts = texts_of(data, offsets)
                tokens, fits = np.array([count.measure(t, limit) for t in texts], np.int64).reshape(-1, 2).T
                columns = [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit), pa.array(fits)]
                if prefixes:
                    columns.append(pa.array([count.prefixes(t).astype(np.int32) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split(" ")[0] for f in schema.split(", ")])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, schema)
