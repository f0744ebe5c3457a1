"""Operator 2, substring dedup by recompression.

Words are the first symbols. Rounds of recompression shorten a text in step with every other: equal neighbours that make a short
run become one symbol, then neighbours x y become one where x is a left and y a right symbol, by a bit of their names in that round.
A symbol longer than the round's limit takes no part (restricted recompression), so whether a boundary between words survives a
round depends on a few words to either side (CONTEXTS) and no more. The name of a symbol is made of the names of its parts (pair(x, y),
pair(x, length of the run)): a global name that needs no dictionary. Equal substrings get the same symbols but for a few at their ends.

So a range of words has one decomposition wherever it stands: words at both ends up to where symbols of the first round are
certain, those up to where symbols of the second are, and so on to the symbols of the last round in the middle. Ranges are named and
compared by these symbols (class Symbols), 64 bits to reveal and 128 to verify.

A window of 35 words is anchored at one of the boundaries that survive longest among those at least CONTEXT words inside it (of several, the
one whose neighbouring words have the least name). The Spark rounds of waymark.llm.repeats group the symbols that all windows of an
anchor hold: shared ones reveal repeats. What is shared is verified by the symbols of whole windows, all of an anchor at once, then one by one.

Result: every word inside a window that starts anywhere else too, the same document included, judged on the input.

Cases: null, empty and short texts lose nothing; texts of any length are taken whole; copies lose all words if they have a whole
window, and rows that repeat an id are documents of their own; runs of one word are found as windows that overlap; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from waymark.llm.common import Names, Words, mix, pair
from waymark.llm.repeats import Layout, Scheme, covered, finish, keyed, repeated_blocks

#: Longest run that becomes a symbol, in words, and the limits on symbols by round.
RUN, LIMITS = 3, (1, 2, 3)
#: Words to either side that decide about a boundary, by round.
CONTEXTS = (0, RUN, *(RUN + sum(LIMITS[: k + 1]) for k in range(len(LIMITS))))
CONTEXT = CONTEXTS[-1]


class Level:
    """Symbols after a round: a boundary begins each, and two names each."""

    def __init__(self, bound: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        self.start = np.flatnonzero(bound)
        self.begin = np.append(self.start, len(bound))
        #: How many boundaries are before each place: the number of the first one from there on.
        self.number = np.concatenate([[0], np.cumsum(bound), [len(self.start) + 1]])
        self.symbols = one, two
        self.names = Names(one), Names(two, base=0xA0761D6478BD642F)

    def between(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Names of the sequences of symbols from boundaries a to boundaries b."""
        i, j = self.number[a], self.number[b]
        return [n.of(i, j) for n in self.names]


class Symbols:
    """The words of texts, recompressed. edge: the word starts a text, so no symbol goes across."""

    def __init__(self, one: np.ndarray, two: np.ndarray, edge: np.ndarray) -> None:
        n = len(one)
        self.levels = [Level(np.ones(n, bool), one, two)]
        same = np.zeros(n, bool)
        same[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & ~edge[1:]
        begin = np.flatnonzero(~same)
        length = np.diff(np.append(begin, n))
        bound = ~(same & np.repeat(length <= RUN, length))
        start = np.flatnonzero(bound)
        size = np.diff(np.append(start, n)).astype(np.uint64)
        run = size > 1
        self.levels.append(Level(bound, *[np.where(run, pair(x[start], size), x[start]) for x in (one, two)]))
        for k, limit in enumerate(LIMITS):
            last = self.levels[-1]
            start, (x, y) = last.start, last.symbols
            side = mix(x + np.uint64(2 * k + 1)) & np.uint64(1)
            takes = np.diff(last.begin) <= limit
            joins = np.append(takes[:-1] & takes[1:] & (side[:-1] == 0) & (side[1:] == 1) & ~edge[start[1:]], np.zeros(min(1, len(start)), bool))
            stays = np.concatenate([np.ones(min(1, len(start)), bool), ~joins[:-1]])
            bound = bound.copy()
            bound[start[~stays]] = False
            self.levels.append(Level(bound, *[np.where(joins, pair(v, np.append(v[1:], v[:1])), v)[stays] for v in (x, y)]))

    def survival(self) -> np.ndarray:
        """How many rounds the boundary before each word survives."""
        out = np.zeros(len(self.levels[0].start), np.uint8)
        for k, level in enumerate(self.levels[1:]):
            out[level.start] = k + 1
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two names of the ranges of words from a to b, made of the symbols of their decomposition. Round by round, symbols at both ends are taken up to where the next round's are certain."""
        out = [np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)]

        def take(level: Level, rows: np.ndarray, left: np.ndarray, right: np.ndarray, k: int) -> None:
            for x, name in zip(out, level.between(left, right), strict=True):
                x[rows] = pair(x[rows] + np.uint64(k), name)

        left, right, rows = a, b, np.arange(len(a))
        for k, level in enumerate(self.levels[:-1]):
            upper = self.levels[k + 1]
            lo, hi = a[rows] + CONTEXTS[k + 1], b[rows] - CONTEXTS[k + 1]
            wide = lo <= hi
            l = upper.begin[upper.number[np.where(wide, lo, 0)]]
            r = upper.begin[np.maximum(0, upper.number[np.where(wide, hi, 0) + 1] - 1)]
            goes_on = wide & (l <= r)
            stops = ~goes_on
            take(level, rows[stops], left[stops], right[stops], 2 * k + 1)
            left, right, l, r, rows = left[goes_on], right[goes_on], l[goes_on], r[goes_on], rows[goes_on]
            take(level, rows, left, l, 2 * k + 2)
            take(level, rows, r, right, 2 * k + 2)
            left, right = l, r
        take(self.levels[-1], rows, left, right, 0)
        return out[0], out[1]


def lay_out(batch: list) -> Layout:
    return _layout(Words(batch))


def _layout(words: Words) -> Layout:
    one, two = words.names()
    lo, hi = words.first[:-1], words.first[1:]
    edge = np.zeros(len(one) + 1, bool)
    edge[lo] = True
    symbols = Symbols(one, two, edge[: len(one)])
    tie = pair(np.concatenate([one[:1], one[:-1]]), one)
    priority = (np.uint64(15) - symbols.survival().astype(np.uint64)) << np.uint64(60) | tie >> np.uint64(4)
    return Layout(lo, hi, symbols.of, priority)


def scheme(window: int = 35) -> Scheme:
    if window < 2 * CONTEXT + 1:
        raise ValueError(f"windows have at least {2 * CONTEXT + 1} words")
    return Scheme("recompression", window, CONTEXT, window - 2 * CONTEXT + 1, (1,), lay_out)


def remove_repeats(docs: DataFrame, window: int = 35, outputs: tuple[str, ...] = ("n_words", "n_removed", "kept"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the outputs asked for: n_words, n_removed, kept (the words left, joined by one space) or kept_sha256, the digest of that."""
    s, base = scheme(window), keyed(docs, id_col, text_col)
    kinds = {"n_words": "n_words long", "n_removed": "n_removed long", "kept": "kept string", "kept_sha256": "kept_sha256 string"}

    def make():
        def run(batch: list, blocks: list) -> list:
            words = Words(batch)
            gone = covered(s, _layout(words), blocks) if any(blocks) else np.zeros(len(words.start), bool)
            out = {k: [] for k in outputs}
            for d in range(len(batch)):
                a, b = words.first[d], words.first[d + 1]
                left = ~gone[a:b]
                kept = b" ".join([words.data[x:y] for x, y in zip(words.start[a:b][left].tolist(), words.stop[a:b][left].tolist(), strict=True)]) if {"kept", "kept_sha256"} & out.keys() else b""
                made = {"n_words": lambda: int(b - a), "n_removed": lambda: int((~left).sum()), "kept": kept.decode, "kept_sha256": lambda: hashlib.sha256(kept).hexdigest()}
                for k, v in out.items():
                    v.append(made[k]())
            return [out[k] for k in outputs]

        return run

    return finish(base, [repeated_blocks(base, s)], make, ", ".join(kinds[k] for k in outputs))
