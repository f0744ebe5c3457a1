"""Operator 4, token counts by heap-and-linked-list byte-pair merging, without making any identifier.

The symbols of a stretch of text stand in a linked list. A heap holds the adjacent pairs whose join is a piece of the
vocabulary; the pair of lowest rank (highest score), leftmost among equals, is joined again and again. The number of
tokens is the number of initial symbols less the number of joins; a symbol that the vocabulary lacks starts as the bytes
it falls back to.

Stretches: no piece holds a character followed by U+2581 (the mark of a space), so no join crosses the start of a run of
spaces, and counts add over stretches "spaces, then other characters". The same holds between any two characters that
stand side by side in no piece. Both facts are read from the vocabulary when it is loaded; if the first fails, a text is
one stretch. Counts of short stretches are remembered in the worker, up to a fixed number.

Cases: null and empty texts count 0 tokens and 0 bytes; text of any length is counted whole (heap: n log n); rows with
equal ids or texts are counted each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from waymark.llm.common import map_text, texts

MARK = "▁"
REMEMBERED, REMEMBERED_CHARS = 600_000, 48


class PieceVocabulary:
    """Ranks of the joinable pieces of a sentencepiece BPE model with byte fallback, identity normalisation and dummy prefix."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError(f"{path}: only BPE models with byte fallback, identity normalisation and dummy prefix are counted")
        if any(p.type == 4 for p in model.pieces):
            raise ValueError(f"{path}: user-defined pieces are not supported")
        order = {s: i for i, s in enumerate(sorted({-p.score for p in model.pieces if p.type == 1}))}
        self.rank = {p.piece: order[-p.score] for p in model.pieces if p.type == 1}
        self.beside = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.spaces_lead = all(MARK not in p.lstrip(MARK) for p in self.rank)

    def merge_count(self, s: str) -> int:
        """Tokens of one stretch: initial symbols minus merges."""
        get, n = self.rank.get, len(s)
        count = n
        for c in s:
            if c not in self.rank:
                count += len(c.encode()) - 1
        if n < 2:
            return count
        symbol = list(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [get(s[i : i + 2], -1) for i in range(n - 1)]  # the rank of the pair that starts here now
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            key = heappop(heap)
            i = key & 0xFFFFFFFF
            if pair[i] != key >> 32:
                continue  # a neighbour has been joined since
            j = after[i]
            joined = symbol[i] = symbol[i] + symbol[j]
            count -= 1
            pair[j] = r = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get(joined + symbol[k], -1)) >= 0:
                    heappush(heap, r << 32 | i)
            pair[i] = r
            if (h := before[i]) >= 0:
                if (r := get(symbol[h] + joined, -1)) >= 0:
                    heappush(heap, r << 32 | h)
                pair[h] = r
        return count

    def stretches(self, s: str) -> list[str]:
        """s cut wherever two characters stand side by side that no piece holds side by side."""
        beside, at, out = self.beside, 0, []
        for i in range(1, len(s)):
            if s[i - 1 : i + 1] not in beside:
                out.append(s[at:i])
                at = i
        out.append(s[at:])
        return out


class _Counts(dict):
    """Tokens by word, a word standing for itself after one space mark; filled as asked for."""

    def __init__(self, vocabulary: PieceVocabulary) -> None:
        self.vocabulary, self.parts = vocabulary, {}

    def stretch(self, s: str) -> int:
        parts, n = self.vocabulary.stretches(s), 0
        if len(parts) == 1:
            return self.vocabulary.merge_count(s)
        for part in parts:
            k = self.parts.get(part)
            if k is None:
                k = self.vocabulary.merge_count(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(self.parts) >= REMEMBERED:
                        self.parts.clear()
                    self.parts[part] = k
            n += k
        return n

    def __missing__(self, word: str) -> int:
        n = self.stretch(MARK + word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


_STRETCH = re.compile(r" +[^ ]*")


class PieceCounter:
    def __init__(self, path: str) -> None:
        self.vocabulary = PieceVocabulary(path)
        self.counts = _Counts(self.vocabulary)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        if not self.vocabulary.spaces_lead:
            return self.counts.stretch((" " + text).replace(" ", MARK))
        if text[0] == " " or text[-1] == " " or "  " in text:
            return sum(self.counts.stretch(x.replace(" ", MARK)) for x in _STRETCH.findall(" " + text))
        return sum(map(self.counts.__getitem__, text.split(" ")))


@lru_cache(maxsize=2)
def piece_counter(path: str) -> PieceCounter:
    """One per worker process and model, so that what is remembered serves later tasks too."""
    return PieceCounter(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of docs. One narrow pass: nothing is shuffled."""

    def make():
        count = piece_counter(model_path).count

        def run(batch: list) -> dict:
            tokens = [count(x) for x in batch]
            return {"n_bytes": [len(x.encode()) if x else 0 for x in batch], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

        return run

    return map_text(texts(docs, id_col, text_col), make, "n_bytes long, n_tokens long, over_limit boolean")
