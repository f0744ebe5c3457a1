"""Operator 6, suffix-array dedup by bucket-pointer refinement of sampled suffixes.

Texts are bytes. The suffixes sampled are those that start at a minimiser: of the 128-byte q-grams inside a 400-byte window,
the one of least name, the first among equals; every window has one, found from the window alone. Their initial buckets are the
q-grams. A suffix alone in its bucket is done: no window at it can occur twice. A bucket with more suffixes is refined, in the Spark
rounds of waymark.llm.repeats: its members, with the bytes before them, are sorted on (bucket, identifiers of the strings at earlier
and later offsets), first for blocks of 17 offsets, then for single ones; each refined bucket keeps the identifier of the one it comes
from, and only members that are still undecided go to the next round.

Identifiers of the longer strings are those of shorter ones used again: an identifier of 2^k q bytes is that of the pair of
identifiers of 2^(k-1) q bytes at offset 0 and at offset 2^(k-1) q (class Buckets), down to the q-grams, whose bucket is a function of their
bytes. So identifiers need no global table, and a string gets the same one wherever it stands.

Result: every byte inside a 400-byte string that starts anywhere else too, the same document included, judged on the input;
matches don't cross documents.

Cases: null, empty and short texts lose nothing; texts of any length are taken whole; copies of at least 400 bytes lose everything, and rows
that repeat an id are documents of their own; a byte or phrase repeated over and over is found as overlapping windows; an
empty table gives an empty result; other columns are not read. Removed runs may cut a multi-byte character, so what is
left is bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from waymark.llm.common import BYTE_VALUES, Names, PrimeNames, forget, pair, stored
from waymark.llm.repeats import Layout, Scheme, covered, finish, keyed, repeated_blocks


class Buckets:
    """Identifiers of strings of at least q bytes, two of 62 bits or more each, made of the buckets of their q-grams by doubling."""

    def __init__(self, buf: np.ndarray, q: int) -> None:
        self.grams, self.q = PrimeNames(buf), q

    def doubled(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of the 2^k q bytes at `at`, from those of half as many at two offsets."""
        if k == 0:
            return self.grams.of(at, at + self.q)
        here, later = self.doubled(at, k - 1), self.doubled(at + (self.q << (k - 1)), k - 1)
        return pair(here[0], later[0]), pair(here[1], later[1])

    def of(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Any other length is covered by the largest doubled strings at its two ends, which overlap."""
        length = stop - start
        out = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
        for k in range(int(length.max(initial=0) // self.q).bit_length()):
            m = self.q << k
            own = np.flatnonzero((length >= m) & (length < 2 * m))
            first, last = self.doubled(start[own], k), self.doubled(stop[own] - m, k)
            size = length[own].astype(np.uint64)
            for x, a, b in zip(out, first, last, strict=True):
                x[own] = pair(pair(a, b), size)
        return out


def scheme(window: int = 400, q: int = 128, block: int = 17) -> Scheme:
    """q: bytes of an initial bucket; block: offsets that are refined together before single ones are."""
    if not 0 < q < window:
        raise ValueError("q is less than the window")
    block = min(block, window - q + 1)

    def lay_out(batch: list) -> Layout:
        raw = [t.encode() if t else b"" for t in batch]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        hi = np.cumsum([len(r) for r in raw]).astype(np.int64)
        lo = hi - np.array([len(r) for r in raw], np.int64)
        priority = np.zeros(len(buf), np.uint64)  # the last places begin no q-gram and are no anchors
        grams = Names(BYTE_VALUES[buf]).of_length(q)
        priority[: len(grams)] = grams
        made: list[Buckets] = []

        def names(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not made:  # only rounds need identifiers, the last pass over the texts doesn't
                made.append(Buckets(buf, q))
            return made[0].of(start, stop)

        return Layout(lo, hi, names, priority)

    return Scheme(f"buckets{window}", window, 0, window - q + 1, (block, 1), lay_out)


def remove_repeats(docs: DataFrame, window: int = 400, outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "spans", "kept"), id_col: str = "doc_id", text_col: str = "text", report: int | None = None, **sizes: int) -> DataFrame:
    """doc_id and the outputs asked for: n_bytes, n_removed, n_spans, spans (start and stop of the maximal removed runs), kept (the bytes left) or kept_sha256, the digest of that. With report, a length below the window, n_reported: the bytes inside strings of that length that start anywhere else too. They are told, not removed.

    What repeats over a window repeats over the shorter length too, so with report only texts that have a shorter repeat are searched for windows."""
    s, base = scheme(window, **sizes), keyed(docs, id_col, text_col)
    if report is None:
        short, blocks = None, [repeated_blocks(base, s)]
    else:
        short = scheme(report, q=min(64, report - 1))
        reported = repeated_blocks(base, short)
        some = stored(base.join(reported.select("k1", "k2"), ["k1", "k2"], "left_semi"), "buckets-some")
        blocks = [repeated_blocks(some, s), reported]
        forget(some)
    kinds = {"n_bytes": "n_bytes long", "n_removed": "n_removed long", "n_spans": "n_spans long", "spans": "spans array<struct<start:long,stop:long>>", "kept": "kept binary", "kept_sha256": "kept_sha256 string", "n_reported": "n_reported long"}

    def make():
        def run(batch: list, *blocks: list) -> list:
            raw = [t.encode() if t else b"" for t in batch]
            cut = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
            inside = [covered(x, x.lay_out(batch), own) if any(own) else np.zeros(cut[-1], bool) for x, own in zip((s, short), blocks, strict=False)]
            out = {k: [] for k in outputs}
            for d, text in enumerate(raw):
                gone = inside[0][cut[d] : cut[d + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))
                kept = text if not spans else b"".join(text[a:b] for a, b in zip([0, *[y for _, y in spans]], [*[x for x, _ in spans], len(text)], strict=True))
                made = {
                    "n_bytes": lambda: len(text), "n_removed": lambda: len(text) - len(kept), "n_spans": lambda: len(spans), "n_reported": lambda: int(inside[1][cut[d] : cut[d + 1]].sum()),
                    "spans": lambda: [{"start": a, "stop": b} for a, b in spans], "kept": lambda: kept, "kept_sha256": lambda: hashlib.sha256(kept).hexdigest(),
                }
                for k, v in out.items():
                    v.append(made[k]())
            return [out[k] for k in outputs]

        return run

    return finish(base, blocks, make, ", ".join(kinds[k] for k in outputs))
