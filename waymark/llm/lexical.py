"""Operator 12, ranked lexical search by scanning documents with one Aho-Corasick automaton, without an index of documents.

The terms of all items, each between two boundary marks, make one automaton. A document is normalised (A-Z in lower case, every run
of other characters than digits, ASCII letters and non-ASCII ones is a boundary), scanned once, and the matches are counted: the term
frequencies. Rows of (doc_id, n terms, matched terms, their frequencies) are written; the corpus statistics (documents with a term, terms
in all, documents that hold a term) are aggregates over them, with partial sums. A second pass over these rows adds up, by the map from
terms to items, each document's score for each item in 64-bit integers and keeps the best of each task; those of all tasks are
ranked in two steps, so no task has more than `top` rows of each task's share.

Bounds: items go to the executors in blocks of at most `block_chars` characters of terms (or one item, if that alone has more), some
200 MB of a worker's memory at the default, built once a worker; a larger set of items is searched block by block. The driver holds
one block and one count for each of its terms.

Cases: null and empty texts and those without terms are no documents (they aren't counted); texts of any length are scanned whole; rows
that repeat a doc_id are documents of their own; equal scores rank by doc_id, a null one first; items without terms have no rows; rows of
equal item_id are one item with the terms of all; a null item_id is an id like others; an item that nothing scores for has no
rows; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from waymark.llm.common import slices, stored, texts

#: A space for every ASCII character that no term holds; A-Z in lower case.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Scores of a task held at a time, and candidates before the worst of them go.
CELLS, PENDING = 2_000_000, 100_000


def normal(text: str | None) -> str:
    """Terms with spaces between and around them."""
    return f" {text.encode().translate(NORMAL).decode()} " if text else " "


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, term: each item's terms, once each."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    low = F.translate(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.explode(F.array_distinct(F.filter(F.split(low, " "), lambda t: t != ""))).alias("term")
    return items.select(F.col(f"`{item_col}`").alias("item"), terms).distinct()


class Block:
    """Items with their terms: the terms' list, and for each term, as one flat array with offsets, the items that hold it."""

    def __init__(self, items: list, held: list[list[str]]) -> None:
        self.key, self.items = uuid.uuid4().hex, items
        number: dict[str, int] = {}
        owner = [(number.setdefault(t, len(number)), i) for i, own in enumerate(held) for t in own]
        self.terms = list(number)
        pairs = np.array(sorted(owner), np.int64).reshape(-1, 2)
        self.owners, self.at = pairs[:, 1].copy(), np.searchsorted(pairs[:, 0], np.arange(len(number) + 1))


def blocks(terms: DataFrame, block_chars: int) -> Iterator[Block]:
    """Whole items in blocks, one partition of the sorted table fetched at a time."""
    items: list = []
    held: list[list[str]] = []
    size, distinct = 0, set()
    for r in stored(terms.orderBy("item"), "lexical-items").orderBy("item").toLocalIterator():
        if not items or r["item"] != items[-1]:
            if size >= block_chars:
                yield Block(items, held)
                items, held, size, distinct = [], [], 0, set()
            items.append(r["item"])
            held.append([])
        held[-1].append(r["term"])
        if r["term"] not in distinct:
            distinct.add(r["term"])
            size += len(r["term"]) + 2
    if items:
        yield Block(items, held)


_BUILT: dict[str, object] = {}


def _automaton(block: Block):
    """The block's automaton; a worker keeps the last one."""
    if block.key not in _BUILT:
        import ahocorasick

        _BUILT.clear()
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(block.terms):
            made.add_word(f" {t} ", i)
        made.make_automaton()
        _BUILT[block.key] = made
    return _BUILT[block.key]


def term_hits(docs: DataFrame, shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For documents with at least one term: doc_id, n, terms (numbers of the block's terms that occur), tfs. shared: a broadcast Block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scan = _automaton(shared.value).iter
            for lo, k in slices(batch.column(1)):
                row, n, terms, tfs = [], [], [], []
                for i, text in enumerate(batch.column(1).slice(lo, k).to_pylist()):
                    words = normal(text)
                    if size := len(words.split()):
                        found = Counter([v for _, v in scan(words)])
                        row.append(i), n.append(size), terms.append(list(found)), tfs.append(list(found.values()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, k).take(pa.array(row, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tfs"])

    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], *StructType.fromDDL("n long, terms array<int>, tfs array<long>").fields]))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _best(found: pa.Table, top: int) -> pa.Table:
    """The first rows of each item by score and doc_id."""
    found = found.take(pc.sort_indices(found, sort_keys=[("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")], null_placement="at_start"))
    item = found["item"].to_numpy()
    start = np.searchsorted(item, item)
    return found.filter(pa.array(np.arange(len(item)) - start < top))


def _scorer(shared, weights, documents: int, total: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = shared.value, weights.value
        many = len(block.items)
        pending: list[pa.Table] = []
        waiting, floor = 0, np.ones(many, np.int64)  # a score below the floor can't be among the best
        for batch in batches:
            rows = max(1, CELLS // many)
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                n, terms, tfs = part.column(1).to_pylist(), part.column(2), part.column(3)
                m = np.array([10 + 90 * x * documents // total for x in n], np.int64)
                term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
                doc = np.repeat(np.arange(len(n)), pc.list_value_length(terms).to_numpy())
                gain = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                lengths = block.at[term + 1] - block.at[term]
                each = np.repeat(np.arange(len(term)), lengths)
                owner = block.owners[np.arange(len(each)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + block.at[term][each]]
                scores = np.zeros(len(n) * many, np.int64)
                np.add.at(scores, doc[each] * many + owner, gain[each])
                scores = scores.reshape(len(n), many)
                i, item = np.nonzero(scores >= floor)
                if len(i):
                    pending.append(pa.table([pa.array(item), part.column(0).take(pa.array(i)), pa.array(scores[i, item])], names=["item", "doc_id", "score"]))
                    waiting += len(i)
                if waiting > PENDING + top * many:
                    kept = _best(pa.concat_tables(pending), top)
                    pending, waiting = [kept], len(kept)
                    owners = kept["item"].to_numpy()
                    full = np.flatnonzero(np.bincount(owners, minlength=many) == top)
                    floor[full] = kept["score"].to_numpy()[np.searchsorted(owners, full, "right") - 1]
        if pending:
            yield from _best(pa.concat_tables(pending), top).combine_chunks().to_batches()

    return run


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_chars: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each item its `top` documents of highest score above 0: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    item_kind, doc_kind = items.schema[item_col].dataType, docs.schema[id_col].dataType
    parts: list[DataFrame] = []
    statistics = None
    for block in blocks(item_terms(items, item_col, item_text_col), block_chars):
        shared = spark.sparkContext.broadcast(block)
        hits = stored(term_hits(docs, shared, id_col, text_col), "lexical-hits")
        statistics = statistics or tuple(hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())
        documents, total = statistics
        holding = np.zeros(len(block.terms), np.int64)
        for t, df in hits.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toLocalIterator():
            holding[t] = df
        weights = spark.sparkContext.broadcast(np.array([weight(documents, int(h)) for h in holding], np.int64))
        fields = StructType.fromDDL("item long, score long").fields
        best = hits.mapInArrow(_scorer(shared, weights, documents, total, top), StructType([fields[0], hits.schema["doc_id"], fields[1]]))
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(block.items)], StructType([fields[0]]).add("item_id", item_kind))
        order = (F.desc("score"), "doc_id")
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(64))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", bucket).orderBy(*order))).where(F.col("rank") <= top)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        parts.append(best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    out = parts[0] if parts else spark.createDataFrame([], StructType([StructField("item_id", item_kind), StructField("rank", IntegerType()), StructField("doc_id", doc_kind), StructField("score", LongType())]))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
