"""Windows of a fixed length that occur more than once in a corpus, found from sampled positions in Spark rounds.

Operators 2 and 6 share this part; they differ in how positions are chosen (by recompression of words; by q-grams of bytes)
and in how strings around them are named.

Every window of `window` items is given to one position inside it, its anchor, by a rule that looks at nothing but the
window, so equal windows have their anchors at equal distances d. The windows of an anchor are a block of distances. For a
block, the intersection of its windows is a string that all of them hold, the union one that holds them all:

* an intersection that occurs once: none of the block's windows occurs twice;
* a union that occurs twice: all of them do;
* otherwise the block is cut into smaller ones (block_sizes), and a Spark round names their intersections and unions anew.

A round sorts by bucket, counts the unions within, and hands on, for buckets with an open member, one representative of each
union together with its bucket. The next round refines that bucket: its blocks are named by it and by their intersections. The
last round has blocks of one window, where intersection and union are one. Names are functions of content alone, so tasks
agree on them without a dictionary: 64 bits for buckets, which only prune, and 124 or more for unions, which decide.

Every group is an aggregate with partial sums, or a join that Spark can split, so one string may occur any number of times;
no pairs are made. Texts are joined to their open blocks by a 96-bit key of id and text, which copies don't share.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import forget, let_go, mix, pair, slices, small_batches, stored

_KEY = "k1 long, k2 int"
_ROW = f"bucket long, u1 long, u2 long, {_KEY}, at long"


@dataclass
class Layout:
    """A batch of texts as one array of items: lo and hi of each text, two names of the ranges from starts to stops, and each position's priority (least first)."""

    lo: np.ndarray
    hi: np.ndarray
    names: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    priority: np.ndarray


@dataclass(frozen=True)
class Scheme:
    """window: items of a window. near, width: an anchor lies near to near + width - 1 items after the start of its window. block_sizes: distances in a block, by round after the first; the last is 1. lay_out: from texts to a Layout."""

    name: str
    window: int
    near: int
    width: int
    block_sizes: tuple[int, ...]
    lay_out: Callable[[list], Layout]

    def __post_init__(self) -> None:
        if self.near + self.width > _NEAR:
            raise ValueError(f"windows of over {_NEAR} items are not supported")


def anchors(scheme: Scheme, lay: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors and the first and last start of the windows given to each."""
    n = len(lay.priority) - scheme.window + 1  # starts, those of windows across texts included
    if n < 1:
        return (np.zeros(0, np.int64),) * 3
    # 32 bits of priority and the place: of equal priorities the first wins. Arrow's strings are below 2^31 bytes, so places fit
    mask = np.uint64(0xFFFFFFFF)
    least = (lay.priority & ~mask) | np.arange(len(lay.priority), dtype=np.uint64)
    span = 1
    while span * 2 <= scheme.width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if rest := scheme.width - span:
        least = np.minimum(least[:-rest], least[rest:])
    at = least[scheme.near : scheme.near + n] & mask
    within = np.zeros(n, bool)
    for lo, hi in zip(lay.lo.tolist(), lay.hi.tolist(), strict=True):
        within[lo : max(lo, hi - scheme.window + 1)] = True
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (within[1:] != within[:-1])]))
    last = np.append(first[1:], n) - 1
    own = within[first]
    return at[first[own]].astype(np.int64), first[own], last[own]


def named(scheme: Scheme, lay: Layout, text: np.ndarray, at: np.ndarray, near: np.ndarray, far: np.ndarray, parent: np.ndarray) -> list[np.ndarray]:
    """Buckets, which are refined from the parents' by the intersection, and names of the union of the windows of anchors at distances near to far."""
    lo, hi = lay.lo[text], lay.hi[text]
    inner, _ = lay.names(at - near, at - far + scheme.window)
    a, b = np.maximum(lo, at - far), np.minimum(hi, at - near + scheme.window)
    one, two = lay.names(a, b)
    place = mix((at - a).astype(np.uint64) << np.uint64(32) | (b - a).astype(np.uint64) << np.uint64(16) ^ near.astype(np.uint64))
    return [x.view(np.int64) for x in (pair(parent.view(np.uint64), inner + near.astype(np.uint64)), one ^ place, two + place)]


#: Bits of a distance in a packed block; the place in the text, below 2^31, stands above them.
_NEAR_BITS = 28
_NEAR = (1 << _NEAR_BITS) - 1


def _pack(at: np.ndarray, near: np.ndarray, level: int, target) -> np.ndarray:
    return at << _NEAR_BITS + 4 | near << 4 | level << 1 | target


def _rows(cols: list, k1: np.ndarray, k2: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], pa.array(k1), pa.array(k2), pa.array(packed)], names=["bucket", "u1", "u2", "k1", "k2", "at"])


def _first_round(scheme: Scheme) -> Callable:
    def run(batches):
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, n in slices(batch.column(2)):
                lay = scheme.lay_out(batch.column(2).slice(lo, n).to_pylist())
                at, _, _ = anchors(scheme, lay)
                text = np.searchsorted(lay.lo, at, "right") - 1
                near = np.full(len(at), scheme.near)
                cols = named(scheme, lay, text, at, near, near + scheme.width - 1, np.zeros(len(at), np.int64))
                yield _rows(cols, k1[lo + text], k2[lo + text], _pack(at - lay.lo[text], near, 0, 1))

    return run


def _next_round(scheme: Scheme, level: int) -> Callable:
    """Cuts the open blocks of each text (column 3: packed, and their buckets) into those of this level."""
    wide = scheme.width if level == 1 else scheme.block_sizes[level - 2]
    size = scheme.block_sizes[level - 1]

    def run(batches):
        for batch in batches:
            k1, k2, opened = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for lo, n in slices(batch.column(2)):
                lay = scheme.lay_out(batch.column(2).slice(lo, n).to_pylist())
                at, s_first, s_last = anchors(scheme, lay)
                part = opened.slice(lo, n)
                packed, parent = (part.values.field(c).to_numpy()[part.offsets[0].as_py() : part.offsets[-1].as_py()] for c in ("at", "bucket"))
                text = np.repeat(np.arange(n), np.diff(part.offsets.to_numpy()))
                where = (packed >> _NEAR_BITS + 4) + lay.lo[text]
                own = np.searchsorted(at, where)
                d_min, d_max = where - s_last[own], where - s_first[own]
                start, target = packed >> 4 & _NEAR, packed & 1
                pieces = -(-wide // size)
                near = start[:, None] + size * np.arange(pieces)[None, :]
                far = np.minimum(near + size, np.minimum(start + wide, scheme.near + scheme.width)[:, None]) - 1
                use = (near <= d_max[:, None]) & (far >= d_min[:, None]) & (near <= far)
                row, _ = np.nonzero(use)
                cols = named(scheme, lay, text[row], where[row], near[use], far[use], parent[row])
                yield _rows(cols, k1[lo + text[row]], k2[lo + text[row]], _pack(where[row] - lay.lo[text[row]], near[use], level, target[row]))

    return run


def _settle(rows: DataFrame, scheme: Scheme, level: int) -> tuple[DataFrame, DataFrame]:
    """One round over stored rows: keys and blocks found to be repeated, and blocks still open with the representatives they are to be compared with."""
    spark = rows.sparkSession
    # tables that a join reads twice are stored, so that it has an exchange of its own on both sides and Spark can split a bucket of very many rows
    shared = stored(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"), f"{scheme.name}-shared{level}")
    let_go(spark)
    members = stored(rows.join(shared, "bucket", "left_semi"), f"{scheme.name}-members{level}")
    forget(rows, shared)
    let_go(spark)
    classes = members.groupBy("bucket", "u1", "u2").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("one"))
    classes = stored(classes, f"{scheme.name}-classes{level}")
    let_go(spark)
    twice = classes.where("n > 1").select("bucket", "u1", "u2")
    done = members.where("at & 1 = 1").join(twice, ["bucket", "u1", "u2"], "left_semi").select("k1", "k2", "at")
    done = stored(done, f"{scheme.name}-done{level}")
    forget(members)
    alone = (F.col("n") == 1) & (F.col("one.at").bitwiseAND(F.lit(1)) == 1)
    open_buckets = stored(classes.groupBy("bucket").agg(F.count("*").alias("classes"), F.max(alone).alias("open")).where("classes > 1 and open").select("bucket"), f"{scheme.name}-open{level}")
    still = classes.join(open_buckets, "bucket", "left_semi").select("one.k1", "one.k2", F.struct(F.when(alone, F.col("one.at")).otherwise(F.col("one.at").bitwiseAND(F.lit(-2))).alias("at"), "bucket").alias("at"))
    return done, still


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """k1, k2, doc_id, text and more columns. Rows that agree in id and text share a key, and that is harmless: both stand for the same places."""
    small_batches(docs.sparkSession)
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    return docs.select(F.xxhash64(i, t).alias("k1"), F.hash(t, i).alias("k2"), i.alias("doc_id"), t.alias("text"), *more)


def by_text(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks of each text as one array; a text has no more of them than items."""
    out = stored(blocks.groupBy("k1", "k2").agg(F.collect_set("at").alias("blocks")), name)
    let_go(out.sparkSession)
    return out


def repeated_blocks(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """k1, k2, blocks: the blocks of each text whose windows occur elsewhere. docs: as from keyed()."""
    base = docs.where("text is not null").select("k1", "k2", "text")
    rows = stored(base.mapInArrow(_first_round(scheme), _ROW), f"{scheme.name}-rows0")
    done, still = _settle(rows, scheme, 0)
    found = [done]
    for level in range(1, len(scheme.block_sizes) + 1):
        opened = by_text(still, f"{scheme.name}-opened{level}")
        rows = stored(base.join(opened, ["k1", "k2"]).select("k1", "k2", "text", "blocks").mapInArrow(_next_round(scheme, level), _ROW), f"{scheme.name}-rows{level}")
        let_go(rows.sparkSession)
        forget(opened)
        done, still = _settle(rows, scheme, level)
        found.append(done)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    out = by_text(every, f"{scheme.name}-repeated")
    forget(*found)
    return out


def covered(scheme: Scheme, lay: Layout, blocks: list) -> np.ndarray:
    """Which items lie in a repeated window; blocks: packed blocks of each text, or None."""
    n = len(lay.priority)
    edge = np.zeros(n + 1, np.int64)
    per = np.array([0 if b is None else len(b) for b in blocks])
    if per.sum():
        at, s_first, s_last = anchors(scheme, lay)
        packed = np.concatenate([np.asarray(b, np.int64) for b in blocks if b is not None])
        text = np.repeat(np.arange(len(blocks)), per)
        where = (packed >> _NEAR_BITS + 4) + lay.lo[text]
        own = np.searchsorted(at, where)
        near, level = packed >> 4 & _NEAR, packed >> 1 & 7
        sizes = np.array([scheme.width, *scheme.block_sizes])
        far = near + sizes[level] - 1
        first, last = np.maximum(s_first[own], where - far), np.minimum(s_last[own], where - near)
        np.add.at(edge, first, 1)
        np.add.at(edge, last + scheme.window, -1)
    return np.cumsum(edge[:-1]) > 0


def finish(docs: DataFrame, blocks: list[DataFrame], make: Callable[[], Callable], schema: str) -> DataFrame:
    """doc_id and what make()'s function makes of (texts, their blocks in each table of blocks), for every row of docs, null texts included. The tables of blocks meet before the texts do, so texts travel once."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    made_schema = StructType.fromDDL(schema)
    types = [to_arrow_type(f.dataType) for f in made_schema]
    names = ["doc_id", *made_schema.names]
    numbered = [b.withColumnRenamed("blocks", f"blocks{i}") for i, b in enumerate(blocks)]
    every = numbered[0]
    for more in numbered[1:]:
        every = every.join(more, ["k1", "k2"], "full")
    joined = docs.join(every, ["k1", "k2"], "left").select("doc_id", "text", *[f"blocks{i}" for i in range(len(blocks))])

    def run(batches):
        made = make()
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                out = made(*[c.slice(lo, n).to_pylist() for c in batch.columns[1:]])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), *[pa.array(v, t) for v, t in zip(out, types, strict=True)]], names=names)

    return joined.mapInArrow(run, StructType([joined.schema["doc_id"], *made_schema.fields]))
