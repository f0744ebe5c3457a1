"""Scans and sinks. Every reader gives _ord, the order of rows in the source, where order has a meaning."""

from __future__ import annotations

import csv
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.sources.geojson import read_features


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def with_order(df: DataFrame) -> DataFrame:
    """_ord: the place in the file, taken at the scan before any shuffle."""
    return df.withColumn("_ord", F.monotonically_increasing_id())


def read_geojson(spark: SparkSession, path: str, id_prop: str = "ref", lines: bool = False) -> DataFrame:
    """One row a feature that has an id: properties, kind and coordinates (JSON text). Feature collections, or, with lines, newline-delimited features; both are read in splits."""
    kinds = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
    texts = spark.read.text(path).withColumnRenamed("value", "text") if lines else read_features(spark, path)
    rows = texts.select(F.from_json("text", kinds).alias("f")).select("f.*")
    ident = F.trim(F.try_element_at("properties", F.lit(id_prop)))
    found = rows.where(F.coalesce("type", F.lit("Feature")) == "Feature")
    return found.select(ident.alias("ref"), "properties", F.col("geometry.type").alias("kind"), F.col("geometry.coordinates").alias("coordinates")).where(F.coalesce(F.col("ref") != "", F.lit(False)))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files by split: file, start (of the split), pos (of the line in it), quotes (of the line), inside (an odd number of quotes stands before it in the split), and how many lines before it in the split begin a record, if the split begins outside a quoted cell (outer) or inside one (inner). A task reads its splits in order, so nothing is shuffled."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pos, seen, outer = None, 0, 0, 0
        for batch in batches:
            value, file, start = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            own = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
            edges = [0, *[i for i in range(1, len(own)) if (file[i], start[i]) != (file[i - 1], start[i - 1])], len(own)]
            for a, b in zip(edges, edges[1:], strict=False):
                if (file[a], start[a]) != split:
                    split, pos, seen, outer = (file[a], start[a]), 0, 0, 0
                n = own[a:b]
                odd = (seen + np.cumsum(n) - n) % 2
                at = pos + np.arange(b - a)
                begun = outer + np.cumsum(1 - odd) - (1 - odd)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(at), pa.array(n.astype(np.int64)), pa.array(odd == 1), pa.array(begun), pa.array(at - begun), value.slice(a, b - a)], names=["file", "start", "pos", "quotes", "inside", "outer", "inner", "value"])
                pos, seen, outer = pos + b - a, int(seen + n.sum()), int(outer + (1 - odd).sum())

    return lines.mapInArrow(run, "file string, start long, pos long, quotes long, inside boolean, outer long, inner long, value string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, _ord, record: the records of CSV files with their numbers, from 0 in each file; blank lines are records, a line break in a quoted cell isn't an end. Files are read split by split. Quotes in a record are paired (a quote in a cell is doubled), so a line begins a record if the quotes before it are even in number: counts of each split, added up over splits, tell where records begin and their numbers. Only records of several lines are put together by a shuffle. Raises for a file whose quotes don't pair."""
    lines = _numbered_lines(spark, path)
    splits = silver(lines.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"), F.count_if(~F.col("inside")).alias("outer"), F.count_if("inside").alias("inner")), "splits")
    if odd := splits.groupBy("file").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").first():
        raise ValueError(f"{odd['file']} has a quote without its pair")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    entered = splits.withColumn("within", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    own = F.when(F.col("within"), F.col("inner")).otherwise(F.col("outer"))
    entered = entered.select("file", "start", "within", F.coalesce(F.sum(own).over(before), F.lit(0)).alias("base"))
    begins = F.col("inside") == F.col("within")
    earlier = F.when(F.col("within"), F.col("inner")).otherwise(F.col("outer"))
    number = F.col("base") + earlier - F.when(begins, 0).otherwise(1)
    placed = lines.join(entered, ["file", "start"]).select("file", "start", "pos", number.alias("_ord"), (begins & (F.col("quotes") % 2 == 0)).alias("alone"), "value")
    several = placed.where("not alone").groupBy("file", "_ord").agg(F.sort_array(F.collect_list(F.struct("start", "pos", "value"))).alias("parts"))
    return placed.where("alone").select("file", "_ord", F.col("value").alias("record")).unionByName(several.select("file", "_ord", F.array_join(F.col("parts.value"), "\n").alias("record")))


def header_names(cells: Sequence[str | None]) -> list[str]:
    """Names of columns: blank ones by place, repeated ones with .1, .2 and so on."""
    seen: dict[str, int] = {}
    names = []
    for i, name in enumerate(cells):
        name = (name or "").strip() or f"_c{i}"
        seen[name] = seen.get(name, -1) + 1
        names.append(name if not seen[name] else f"{name}.{seen[name]}")
    return names


def _cells(record: str) -> list[str]:
    """The cells of one record, without blank ones at its end."""
    cells = next(csv.reader([record.removeprefix("\ufeff")]), [])
    while cells and not cells[-1].strip():
        cells.pop()
    return cells


def read_offset_table(spark: SparkSession, path: str, header_row: int) -> DataFrame:
    """CSV exports of sheets with title rows above the header: columns named by the record of that number (from 0; blank rows and titles of any width count, quoted cells may hold line breaks), the records below it, blank cells null, and _ord, the record's number in its file. Of several files each has its own titles and the same header. Files are read in splits. Rows that are shorter than the header end in nulls; rows with more cells raise."""
    records = read_records(spark, path)
    heads = records.where(F.col("_ord") == header_row).select("record").distinct().take(2)
    if len(heads) != 1:
        raise ValueError(f"{path} has no row {header_row}" if not heads else f"the files of {path} differ in row {header_row}")
    names = header_names(_cells(heads[0][0]))
    if "_ord" in names:
        raise ValueError(f"{path} has a column _ord")
    width = len(names)
    found = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField("_ord", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_cells(r) for r in batch.column(1).to_pylist()]
            for row, at in zip(rows, batch.column(0).to_pylist(), strict=True):
                if len(row) > width:
                    raise ValueError(f"{path}: row {at} has {len(row)} cells, the header {width}")
                row.extend([None] * (width - len(row)))
            columns = [pa.array([r[i] if r[i] and r[i].strip() else None for r in rows], pa.string()) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(0)], names=[*names, "_ord"])

    return records.where(F.col("_ord") > header_row).select("_ord", "record").mapInArrow(run, found)


def stack_by_position(dfs: Sequence[DataFrame], names: Mapping[int, str]) -> DataFrame:
    """Tables of one layout under each other; columns by position."""
    parts = [df.select(*[df[df.columns[i]].cast("string").alias(n) for i, n in names.items()], F.lit(k).alias("_sheet")) for k, df in enumerate(dfs)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def resolve_column(df: DataFrame, fits: Callable[[str], bool], name: str) -> DataFrame:
    """The first column whose header fits, under the name; a null column if none does."""
    found = next((c for c in df.columns if fits(c)), None)
    return df.withColumn(name, F.lit(None).cast("string")) if found is None else df.withColumnRenamed(found, name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a declared schema in order and type; missing ones are null, others go."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _listed(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """Numbers of the versions under a path in order, and whether each is complete: Spark's writer leaves its mark last."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at)]
    return sorted((int(n[1:]), files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))) for n in names if re.fullmatch(r"v\d{9}", n))


def publish(df: DataFrame, path: str, keep: int = 2, **options: str) -> None:
    """df as a new version of the table at path. Nothing that is there is touched while it is written: readers see the version before until the new one is complete, and after a crash too. Then all but the last `keep` complete versions, and what crashes have left, are deleted; a reader that began with the version before can end."""
    spark = df.sparkSession
    there = _listed(spark, path)
    n = there[-1][0] + 1 if there else 0
    df.write.options(**options).parquet(f"{path}/v{n:09d}")
    stay = [k for k, whole in _listed(spark, path) if whole][-keep:]
    for k, _ in there:
        if k not in stay:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v{k:09d}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a table, or a plain Parquet table that others have put there; raises FileNotFoundError if there is neither."""
    there = _listed(spark, path)
    whole = [k for k, complete in there if complete]
    if there and not whole:
        raise FileNotFoundError(f"{path} has no complete version")
    try:
        return spark.read.parquet(f"{path}/v{whole[-1]:09d}" if whole else path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from None
        raise


def write_silver(df: DataFrame, root: str, name: str) -> None:
    publish(df, f"{root}/{name}.parquet")


def read_silver(spark: SparkSession, root: str, name: str, sector: str | None = None) -> DataFrame:
    """A table written before; raises FileNotFoundError if there is none."""
    try:
        df = read_published(spark, f"{root}/{name}.parquet")
    except FileNotFoundError as e:
        raise FileNotFoundError(f"{e}: write the silver stage first") from None
    return df if sector is None else df.where(F.lower("sector") == sector.lower())


def read_optional(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return read_silver(spark, root, name)
    except FileNotFoundError:
        return None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):  # a folder of one machine is no use to others
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        at = spark.sparkContext.getCheckpointDir()
    return f"{at.rstrip('/')}/waymark-{name}-{uuid.uuid4().hex}"


def silver(df: DataFrame, name: str) -> DataFrame:
    """df written once under shared_path and read again: for tables that several later steps read. The plan of what follows starts at a scan, and lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """A polygon layer (adm1..adm4, rings) without the country's prefix on its codes."""
    df = spark.read.parquet(path)
    return df.withColumns({c: F.regexp_replace(c, "^PH", "") for c in ("adm1", "adm2", "adm3", "adm4") if c in df.columns})


def write_gold(df: DataFrame, path: str, columns: Sequence[str], key: Sequence[str], files: int | None = None, find: Sequence[str] = (), **options: str) -> None:
    """A version of a Parquet table of fixed columns, sorted by key over all files: ranges to files, sorted within each, so no task has all rows. Columns that single rows are looked up by (find), beside the key, get Bloom filters."""
    out = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    out = out.repartitionByRange(files, *key) if files else out.repartitionByRange(*key)
    publish(out.sortWithinPartitions(*key), path, **{f"parquet.bloom.filter.enabled#{c}": "true" for c in find}, **options)


def write_gold_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; a quote in a cell is doubled, as read_csv_strings takes it."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A long metric table (metric, key, value) as JSON lines."""
    metrics.orderBy("metric", "key").coalesce(1).write.mode("overwrite").json(path)  # a few hundred rows of counts


def metrics_document(metrics: DataFrame) -> str:
    """The nested document of a metric table, keys sorted. For tables of counts, not of rows."""
    out: dict = {}
    for r in metrics.collect():
        out.setdefault(r["metric"], {})[r["key"]] = r["value"]
    return json.dumps(out, indent=2, sort_keys=True)


def describe_output(df: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """field, value: each column's description and how many rows have it, after the number of rows. One aggregate."""
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(F.struct(F.lit("rows").alias("field"), F.col("__rows").cast("string").alias("value")), *[F.struct(F.lit(c).alias("field"), F.concat(F.lit(descriptions.get(c, "")), F.lit(" ("), F.col(f"`{c}`").cast("string"), F.lit(" rows)")).alias("value")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def clean_stats(df: DataFrame, status: str = "coord_status", reason: str = "coord_rejection_reason") -> DataFrame:
    """Counts of a cleaned table by status and reason, one row."""
    return df.agg(
        F.count("*").alias("submissions"),
        *[F.count_if(F.col(status) == s).alias(s) for s in ("valid", "fixed_swap", "suspect", "no_coords")],
        *[F.count_if(F.col(reason) == r).alias(f"reason_{r}") for r in ("invalid", "out_of_bounds", "placeholder_default", "coordinate_cluster", "round_coordinates")],
    )
