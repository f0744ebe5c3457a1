"""Operator 8, byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text (a match of the splitting pattern) is halved down to leaves of a few bytes. A leaf is merged by ranks; a
node joins the token lists of its halves. Two facts make the join exact. (1) A token list is the encoding of its bytes if
and only if the encoding of the bytes of every two adjacent tokens is just these two tokens. (2) Any adjacent tokens of an
encoding have that property. So a join takes a window of tokens at the seam, encodes its bytes anew, and looks at the
two seams of the window: if the token before it and its first token, and its last token and the one after it, are
compatible, all adjacent pairs are, and tokens outside the window are final. Otherwise the window grows by doubling on
the side that failed. At worst the window is the whole node, which is then encoded as such. Joining is associative with
the empty list as identity, hence a monoid; decoding concatenates byte strings up the same tree.

As in the public library, a whole piece that is itself in the vocabulary is that one token.

Cases: null and empty texts give no ids, and decode to the empty string; special strings are ordinary text; very long
pieces take n log n joins; equal ids or texts are encoded row by row; empty tables give empty results; other columns are
not read. Ids that the vocabulary lacks raise KeyError on decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain, islice

import regex
from pyspark.sql import DataFrame

from waymark.llm.common import map_text, texts

#: Bytes of a leaf: so few that most leaves have been met before.
LEAF = 12
#: What a worker remembers: units, leaves or seams, and the length of a unit. Some 150 MB at most.
UNITS, PARTS, REMEMBERED_CHARS = 300_000, 100_000, 48


SINGLE = [bytes([i]) for i in range(256)]
#: More than any rank.
NONE = 1 << 60


class MonoidBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.text_of = {i: str(i) for i in ranks.values()}
        #: Rank of each two bytes.
        self.first = [ranks.get(SINGLE[i >> 8] + SINGLE[i & 255], NONE) for i in range(1 << 16)]
        self.pattern = regex.compile(pattern)
        self.pairs: dict[int, list[int]] = {}
        self.leaves: dict[bytes, list[int]] = {}
        self.units = _Units(self)

    def merge(self, b: bytes) -> list[int]:
        """Merges by lowest rank, leftmost first; for leaves and windows."""
        ranks = self.ranks
        if len(b) > 96:
            return self._merge_long(b)
        get, parts, first = ranks.get, [SINGLE[x] for x in b], self.first
        cost = [first[x << 8 | y] for x, y in zip(b, b[1:])]
        while cost and (low := min(cost)) != NONE:
            i = cost.index(low)
            joined = parts[i] = parts[i] + parts[i + 1]
            del parts[i + 1], cost[i]
            if i < len(cost):
                cost[i] = get(joined + parts[i + 1], NONE)
            if i:
                cost[i - 1] = get(parts[i - 1] + joined, NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, b: bytes) -> list[int]:
        ranks, n = self.ranks, len(b)
        part: list = [b[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, b[i : i + 2]) for i in range(n - 1) if (r := ranks.get(b[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            if part[i] is None or (j := after[i]) >= n or part[i] + part[j] != joined:
                continue
            part[i], part[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(p := joined + part[k])) is not None:
                    heapq.heappush(heap, (r, i, p))
            if (h := before[i]) >= 0 and (r := ranks.get(p := part[h] + joined)) is not None:
                heapq.heappush(heap, (r, h, p))
        return [ranks[p] for p in part if p is not None]

    def seam(self, a: int, b: int) -> list[int]:
        """The encoding of the bytes of two tokens; [a, b] itself if they are compatible."""
        found = self.pairs.get(a << 32 | b)
        if found is None:
            if len(self.pairs) >= PARTS:
                self.pairs.clear()
            found = self.pairs[a << 32 | b] = self.merge(self.bytes_of[a] + self.bytes_of[b])
        return found

    def compatible(self, a: int, b: int) -> bool:
        return self.seam(a, b) == [a, b]

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of the bytes of a and b, each an encoding."""
        if not a or not b:
            return a + b
        window = self.seam(a[-1], b[0])
        i, j, left, right = len(a) - 1, 1, 1, 1
        if len(window) == 2 and window[0] == a[-1] and window[1] == b[0]:
            return a + b
        while True:
            ok_left = i == 0 or self.compatible(a[i - 1], window[0])
            ok_right = j == len(b) or self.compatible(window[-1], b[j])
            if ok_left and ok_right:
                return a[:i] + window + b[j:]
            if not ok_left:
                i, left = max(0, i - left), left * 2
            if not ok_right:
                j, right = min(len(b), j + right), right * 2
            window = self.merge(b"".join([self.bytes_of[t] for t in chain(a[i:], b[:j])]))

    def tree(self, b: bytes) -> list[int]:
        n = len(b)
        if n <= LEAF:
            found = self.leaves.get(b)
            if found is None:
                if len(self.leaves) >= PARTS:
                    self.leaves.clear()
                found = self.leaves[b] = self.merge(b)
            return found
        return self.join(self.tree(b[: n // 2]), self.tree(b[n // 2 :]))

    def piece(self, b: bytes) -> list[int]:
        whole = self.ranks.get(b)
        return [whole] if whole is not None else self.tree(b)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.units.__getitem__, split_units(text)))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        """Byte strings joined pairwise up a tree; leaves are runs of ids."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class _Units(dict):
    """Ids of a unit (see split_units) or of a piece, filled as asked for."""

    def __init__(self, bpe: MonoidBpe) -> None:
        self.bpe = bpe

    def put(self, key: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(key) <= REMEMBERED_CHARS:
            if len(self) >= UNITS:  # the older half goes
                for old in list(islice(self, UNITS // 2)):
                    del self[old]
            self[key] = ids
        return ids

    def __missing__(self, unit: str) -> tuple[int, ...]:
        pieces = self.bpe.pattern.findall(unit)
        if len(pieces) == 1:
            return self.put(unit, tuple(self.bpe.piece(unit.encode())))
        out: list[int] = []
        for m in pieces:
            ids = self.get(m)
            out += self.put(m, tuple(self.bpe.piece(m.encode()))) if ids is None else ids
        return self.put(unit, tuple(out))


#: A single space between two characters that are neither white space nor controls starts a match of the pattern whatever stands
#: around it: no class of the pattern takes a space but as the first character of a match or within white space.
_SEAM = regex.compile(r"(?<=[^\s\x00-\x1F\x7F-\xA0])(?= [^\s\x00-\x1F\x7F-\xA0])", regex.V1)


def split_units(text: str) -> list[str]:
    """text in units that the pattern can be matched on separately."""
    if text[0] == " " or text[-1] == " " or "  " in text or "\n " in text or " \n" in text or not text.replace("\n", "").isprintable():
        return _SEAM.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


@lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str) -> MonoidBpe:
    """One per worker process and vocabulary."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return MonoidBpe(ranks, pattern)


#: What encode_documents can return beside doc_id. Digests are of the real ids and decoded bytes, made where these are, so that only the digests travel.
OUTPUTS = {"ids": "ids array<int>", "decoded": "decoded binary", "n_tokens": "n_tokens long", "ids_sha256": "ids_sha256 string", "decoded_sha256": "decoded_sha256 string", "text": "text string"}


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, outputs: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and the outputs asked for (names of OUTPUTS; text is the decoded bytes as UTF-8). One narrow pass."""

    def make():
        bpe = load(ranks_path, pattern)

        def run(batch: list) -> dict:
            cols: dict[str, list] = {k: [] for k in outputs}
            for text in batch:
                ids = bpe.encode(text)
                decoded = bpe.decode(ids)
                made = {
                    "ids": lambda: ids,
                    "decoded": lambda: decoded,
                    "n_tokens": lambda: len(ids),
                    "ids_sha256": lambda: hashlib.sha256(",".join(map(bpe.text_of.__getitem__, ids)).encode()).hexdigest(),
                    "decoded_sha256": lambda: hashlib.sha256(decoded).hexdigest(),
                    "text": lambda: None if text is None else decoded.decode(),
                }
                for k, v in cols.items():
                    v.append(made[k]())
            return cols

        return run

    return map_text(texts(docs, id_col, text_col), make, ", ".join(OUTPUTS[k] for k in outputs))


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, decoded for a table of ids; null ids decode to the empty string."""
    import pyarrow as pa

    def run(batches):
        bpe = load(ranks_path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids")).mapInArrow(run, f"doc_id {kind}, decoded binary")
