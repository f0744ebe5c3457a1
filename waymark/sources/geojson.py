"""Feature collections read in splits, however large and however written (in one line or many).

Files are cut at every opening brace, which Spark's text source does in any split. Whether a brace counts depends on whether it stands in a string,
and a feature is an object that begins at depth one of braces and of brackets; both are sums over all that comes before. A first pass adds up
each split (quotes; braces and brackets, for a split that begins outside a string or inside one), the driver adds up the splits, one
row each, and a second pass knows where it stands when it enters a split. Features that lie in one split are put together in its task; of those that
don't, a fragment a split is shuffled."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_MARKS = re.compile(r'\\.|"|\}', re.DOTALL)


def _scan(piece: str) -> tuple[int, tuple[int, int], tuple[int, int]]:
    """Quotes of a text between braces, and closing braces and the balance of brackets outside strings, if it begins outside one and if inside."""
    parts = (_ESCAPED.sub("", piece) if "\\" in piece else piece).split('"')
    sides = [parts[k::2] for k in (0, 1)]
    return len(parts) - 1, *[(sum(p.count("}") for p in own), sum(p.count("[") - p.count("]") for p in own)) for own in sides]


def _closing(piece: str, inside: int, n: int) -> int:
    """The place after the n-th closing brace outside strings."""
    for m in _MARKS.finditer(piece):
        if m[0] == '"':
            inside ^= 1
        elif m[0] == "}" and not inside:
            n -= 1
            if not n:
                return m.end()
    raise ValueError("braces don't pair")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, str]]:
    """file, start of the split, whether a brace stands before the piece, the piece."""
    last = None
    for batch in batches:
        for piece, file, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            first = (file, start) != last
            last = (file, start)
            yield file, start, not (first and start == 0), piece


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, int], list[int]] = {}
    for file, start, brace, piece in _pieces(batches):
        own = found.setdefault((file, start), [0, 0, 0, 0, 0])  # quotes odd, then braces and brackets if outside, if inside
        quotes, *sides = _scan(piece)
        for h in (0, 1):  # hypothesis: the split begins inside a string
            state = h ^ own[0]
            closed, brackets = sides[state]
            own[1 + 2 * h] += (brace and not state) - closed
            own[2 + 2 * h] += brackets
        own[0] ^= quotes & 1
    if found:
        keys, values = zip(*found.items(), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=["file", "start", "sums"])


def _entries(sums: DataFrame) -> dict[tuple[str, int], tuple[int, int, int]]:
    """For each split: inside a string, depth of braces, depth of brackets, where it begins."""
    entries, last, at = {}, None, (0, 0, 0)
    for file, start, own in sorted(tuple(r) for r in sums.collect()):  # one row a split
        if file != last:
            last, at = file, (0, 0, 0)
        entries[file, start] = at
        inside, braces, brackets = at
        at = (inside ^ own[0], braces + own[1 + 2 * inside], brackets + own[2 + 2 * inside])
    return entries


def _collector(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, braces, brackets = None, 0, 0, 0
        text, begun = None, False  # what is read of an object, and whether its beginning is

        def row(ended: bool) -> tuple:
            return (*split, begun, ended, "".join(text))

        def told(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()), strict=True)], names=["file", "start", "begun", "ended", "text"])

        rows: list[tuple] = []
        for file, start, brace, piece in _pieces(batches):
            if (file, start) != split:
                if text is not None:
                    rows.append(row(False))
                split = (file, start)
                inside, braces, brackets = shared.value[split]
                text, begun = ([], False) if braces > 1 else (None, False)
            if brace:
                if not inside:
                    if braces == 1 and brackets == 1:
                        text, begun = [], True
                    braces += 1
                if text is not None:
                    text.append("{")
            quotes, *sides = _scan(piece)
            closed, opened = sides[inside]
            if text is not None and closed >= braces - 1 > 0:
                text.append(piece[: _closing(piece, inside, braces - 1)])
                rows.append(row(True))
                text = None
            elif text is not None:
                text.append(piece)
            braces, brackets, inside = braces - closed, brackets + opened, inside ^ (quotes & 1)
            if len(rows) >= 1000:
                yield told(rows)
                rows = []
        if text is not None:
            rows.append(row(False))
        if rows:
            yield told(rows)

    return run


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """text: each object directly in an array of a file's outermost object, as it is written; of feature collections, the features."""
    pieces = spark.read.option("lineSep", "{").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    entries = _entries(pieces.mapInArrow(_sums, "file string, start long, sums array<long>"))
    shared = spark.sparkContext.broadcast(entries)
    parts = pieces.mapInArrow(_collector(shared), "file string, start long, begun boolean, ended boolean, text string")
    whole = parts.where("begun and ended").select("text")
    # fragments: of each file's some, in order, the beginning and what follows up to an end; those of other objects have no beginning
    before = Window.partitionBy("file").orderBy("start", "begun").rowsBetween(Window.unboundedPreceding, 0)
    cut = parts.where("not (begun and ended)").withColumn("object", F.sum(F.col("begun").cast("long")).over(before))
    own = Window.partitionBy("file", "object").orderBy("start", F.desc("begun")).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.where("object > 0").withColumn("over", F.coalesce(F.max("ended").over(own), F.lit(False))).where("not over")
    joined = cut.groupBy("file", "object").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda p: p["text"]), "").alias("text"))
    return whole.unionByName(joined.select("text"))
