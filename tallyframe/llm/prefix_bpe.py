"""Byte-pair encoding as a dynamic program over prefixes.

Merging leaves a boundary between two neighbouring tokens alone exactly if merging the two on their
own leaves it alone: what happens inside a token depends on that token only, and a merge over the
boundary depends on the two tokens beside it. So the encoding of a prefix is that of a shorter prefix
plus one token that is stable by itself and stable beside the shorter prefix's last token, and just one
such token exists at each position. Following it back gives the encoding, counting it gives the number
of tokens of every prefix, in one pass and without re-encoding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

#: Remembered pairs and tokens; at the limit the memory starts anew.
REMEMBERED = 400_000
#: The end of a symbol that no merge ends.
FOREVER = float("inf")


class PrefixTable:
    """``rank(left, right)``: the merge's rank, lower first, or None. Texts are str or bytes.

    ``parts``: the one merge that forms each token, given only where every merge ranks after those that
    form its two sides. Then ranks are times, and ``beside`` compares the times at which the symbols at
    the two edges exist instead of merging."""

    def __init__(self, tokens: Iterable, longest: int, rank: Callable, units: Callable[[Sequence], list], parts: dict | None = None):
        self.tokens, self.longest, self.rank, self.units, self.parts = tokens, longest, rank, units, parts
        self._stable: dict = {}
        #: Pairs of neighbours that ``beside`` has judged.
        self.known: dict = {}
        self._edges: dict = {}
        #: True for tokens that merging gives; False for what else tokens end in. A search backwards
        #: stops where there is neither.
        self.kinds = {t[i:]: False for t in tokens for i in range(1, len(t))} | {t: True for t in tokens if self.stable(t)}

    def edge(self, token, side: int) -> list:
        """The symbols at a token's left (0) or right (1) edge while it is merged, each with the rank
        of the merge that ends it."""
        key = (token, side)
        out = self._edges.get(key)
        if out is None:
            out = [(token, FOREVER)]
            while token in self.parts:
                pair = self.parts[token]
                token = pair[side]
                out.append((token, self.rank(*pair)))
            self._edges[key] = out
        return out

    def merged(self, symbols: list) -> list:
        """Plain merging: the best pair first, the leftmost of equals."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = self.rank(symbols[i], symbols[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def stable(self, token) -> bool:
        out = self._stable.get(token)
        if out is None:
            if len(self._stable) > REMEMBERED:
                self._stable.clear()
            if self.parts is None or len(token) == 1:
                out = len(token) == 1 or token in self.tokens and self.merged(self.units(token)) == [token]
            else:
                pair = self.parts.get(token)
                out = token in self.tokens and pair is not None and all(map(self.stable, pair)) and self.apart(*pair)
            self._stable[token] = out
        return out

    def apart(self, left, right) -> bool:
        """No merge over the boundary comes before the two are complete (``parts`` is given)."""
        there = self.edge(right, 0)
        for x, x_ends in self.edge(left, 1):
            for y, y_ends in there:
                r = self.rank(x, y)
                # at equal ranks the left one goes first; the two themselves may merge
                if r is not None and r < x_ends and r <= y_ends and (x_ends < FOREVER or y_ends < FOREVER):
                    return False
        return True

    def beside(self, left, right) -> bool:
        key = (left, right)
        out = self.known.get(key)
        if out is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            if self.parts is None:
                out = self.merged(self.units(left) + self.units(right)) == [left, right]
            else:
                out = self.rank(left, right) is None and self.apart(left, right)
            self.known[key] = out
        return out

    def solve(self, text) -> tuple[list[int], list]:
        """For each prefix of the text: its number of tokens, and its last token (None for the empty one)."""
        n = len(text)
        counts, last = [0] * (n + 1), [None] * (n + 1)
        kinds, known, beside, longest = self.kinds, self.known, self.beside, self.longest
        for end in range(1, n + 1):
            # tokens that end here, shorter ones first; the single symbol always is one
            starts = [end - 1]
            for start in range(end - 2, max(-1, end - longest - 1), -1):
                kind = kinds.get(text[start:end])
                if kind is None:
                    break
                if kind:
                    starts.append(start)
            for start in reversed(starts):
                token = text[start:end]
                if start:
                    fits = known.get((last[start], token))
                    if fits is None:
                        fits = beside(last[start], token)
                    if not fits:
                        continue
                counts[end] = counts[start] + 1
                last[end] = token
                break
        return counts, last
