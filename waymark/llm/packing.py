"""Operator 13, best-fit packing planned over a histogram of lengths.

Texts become ids where they are read; a document is its ids and a terminator, and only one longer than a sequence is cut, into full
pieces after a first one that takes what is over. Pieces of one length are interchangeable, so the plan needs their counts alone:
lengths in falling order, each into the fullest sequences that still hold it, where sequences filled alike are one range of numbers. That
is best-fit decreasing, document by document the same, on at most `capacity` counts. A rule of the plan says: the pieces of this length
from this rank on go to these sequences, so many in each, from this offset on. Pieces are numbered within their length (the task
that made them counts them, and a running sum over tasks gives each task its first number) and take the planned slot of their rank.

Bounds: the driver sees one count for each length. A step of the plan splits at most one range in three, so there are at most five ranges
a length, and a range takes a new length no more often than distinct lengths fit into a sequence: the rules, which are all that is
broadcast, depend on the capacity only. The test measures some 3 rules a length.

Cases: null and empty texts are the terminator alone; texts of any length are packed whole; rows that repeat are packed each; ties (equal
lengths) take slots in the order of tasks; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.llm.common import slices, stored, texts
from waymark.llm.monoid_bpe import split_units

#: Units of text whose ids a worker remembers, and the longest of them.
UNITS, UNIT_CHARS = 500_000, 48

#: Fixed value: the splitting pattern of byte-level vocabularies.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes in: printable characters of Latin-1 for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def merge_ranks(rules: dict) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if merging by the lowest id of the result is what the vocabulary says: its merges make its tokens in the order of their ids. None otherwise."""
    model, special = rules["model"], {t["content"] for t in rules["added_tokens"]}
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    vocab, letters = {t: i for t, i in model["vocab"].items() if t not in special}, byte_letters()
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in made or made != sorted(set(made)) or len(made) + 256 != len(vocab) or not all(t in vocab for t in letters):
        return None
    return {bytes([letters[c] for c in t]): i for t, i in vocab.items()}


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, as the public library gives them. Where the vocabulary's own rules let a text be cut before single spaces (byte-level pieces by the usual pattern, nothing normalised), units of text are encoded once and remembered; where its merges go by ids, the faster of the two public libraries does it, but for units with a special string."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            rules = json.load(f)
        before = rules["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not rules["normalizer"]
        self.split = plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in rules["added_tokens"])
        self.special = [t["content"] for t in rules["added_tokens"]]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ordinary = None
        if self.split and (ranks := merge_ranks(rules)):
            import tiktoken

            self.ordinary = tiktoken.Encoding("units", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def unit(self, text: str) -> bytes:
        if self.ordinary and not any(s in text for s in self.special):
            ids = self.ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, batch: list) -> list[bytes]:
        """For each text (None: empty) the bytes of its ids."""
        known = self.known
        if len(known) >= UNITS:  # the older half goes
            for old in list(islice(known, UNITS // 2)):
                del known[old]
        out = []
        for text in batch:
            parts = []
            for u in (split_units(text) if self.split else [text]) if text else ():
                ids = known.get(u)
                if ids is None:
                    ids = self.unit(u)
                    if len(u) <= UNIT_CHARS:
                        known[u] = ids
                parts.append(ids)
            out.append(b"".join(parts))
        return out


@lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = 2048, terminator: int = 0, outputs: tuple[str, ...] = ("ids",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, the outputs asked for (ids, ids_crc32), and the piece's number in its task: task, nth among the pieces of its length there."""
    kinds = {"ids": ("ids array<int>", pa.list_(pa.int32())), "ids_crc32": ("ids_crc32 long", pa.int64())}
    end = struct.pack("<I", terminator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, met = None, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            encoder = encoder or load(path)
            for lo, k in slices(batch.column(1)):
                row, piece, start, length, nth = [], [], [], [], []
                out: dict[str, list] = {o: [] for o in outputs}
                for i, ids in enumerate(encoder.ids(batch.column(1).slice(lo, k).to_pylist())):
                    ids += end
                    for j, (at, n) in enumerate(cuts(len(ids) // 4, capacity)):
                        row.append(i), piece.append(j), start.append(at), length.append(n), nth.append(met[n])
                        met[n] += 1
                        if "ids" in out:
                            out["ids"].append(np.frombuffer(ids, "<i4", n, 4 * at))
                        if "ids_crc32" in out:
                            out["ids_crc32"].append(zlib.crc32(memoryview(ids)[4 * at : 4 * (at + n)]))
                arrays = [batch.column(0).slice(lo, k).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
                arrays += [pa.array(out[o], kinds[o][1]) for o in outputs] + [pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", *outputs, "task", "nth"])

    rows = texts(docs, id_col, text_col)
    made = StructType.fromDDL(", ".join(["piece int, start long, length long", *[kinds[o][0] for o in outputs], "task int, nth long"]))
    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], *made.fields]))


def plan(counts: Mapping[int, int], capacity: int) -> dict[int, np.ndarray]:
    """For each length the rules (rank, sequence, each, offset), by rising rank: pieces from this rank on, `each` to a sequence, the first of them at this offset, go to the sequences from this number on."""
    room: dict[int, list[tuple[int, int]]] = {}  # ranges (first sequence, how many) by the room they have left
    sizes: list[int] = []  # the keys of room, sorted
    rules: dict[int, list[tuple[int, int, int, int]]] = {}
    opened = 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(sizes, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        todo, rank, own = counts[length], 0, rules.setdefault(length, [])
        while todo:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                left = sizes[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], sizes[at]
            else:
                left, first, n = capacity, opened, -(-todo // (capacity // length))
                opened += n
            each = left // length
            full = min(n, todo // each)
            over = min(n - full, 1) * (todo - full * each)  # what a last sequence takes, fewer than each
            if full:
                own.append((rank, first, each, capacity - left))
            if over:
                own.append((rank + full * each, first + full, over, capacity - left))
            put(left - each * length, first, full)
            put(left - over * length, first + full, min(over, 1))
            used = full + min(over, 1)
            put(left, first + used, n - used)
            rank, todo = rank + full * each + over, todo - full * each - over
    return {length: np.array(own, np.int64) for length, own in rules.items()}


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """The rows of pieces(), a table that is read several times (so store it), with sequence_id and offset in place of task and nth."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    shared = spark.sparkContext.broadcast(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))  # a row for each task
    bases = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    kept = [c for c in cut.columns if c not in ("task", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = shared.value
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                n, r = int(length[rows[0]]), rank[rows]
                rule = rules[n][np.searchsorted(rules[n][:, 0], r, "right") - 1]
                past = r - rule[:, 0]
                sequence[rows] = rule[:, 1] + past // rule[:, 2]
                offset[rows] = rule[:, 3] + past % rule[:, 2] * n
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "rank").mapInArrow(run, StructType([*cut.select(*kept).schema.fields, *StructType.fromDDL("sequence_id long, offset long").fields]))


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, terminator: int = 0, outputs: tuple[str, ...] = ("ids",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each piece doc_id, piece, start, length, the outputs, sequence_id, offset."""
    return pack(stored(pieces(docs, path, capacity, terminator, outputs, id_col, text_col), "packing-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids (of the pieces, in order), lengths: the rows that a trainer reads, from packed pieces with ids. A sequence holds at most `capacity` tokens, so a group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
