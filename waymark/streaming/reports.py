"""Reports that keep arriving: the first of each key counts, as in the batch operator keep_first."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

#: Keyed state needs a state store that keeps keys and timers on disk.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
ARRIVED, BUCKET, HEARD, ROW = "arrived", "__bucket", "__heard", "__row"
#: Bytes of rows that are packed at once.
PACKED = 8_000_000


def few_partitions(spark: SparkSession, most: int = 24) -> dict[str, str]:
    """A setting for the session in which a stream with state begins: as many partitions as the session has, but no more than `most`. A partition of state costs about a CPU second in every batch, empty ones too, and their number stays that of the first batch."""
    name = "spark.sql.shuffle.partitions"
    return {name: str(min(most, int(spark.conf.get(name))))}


def report_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def first_report_stream(reports: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """The first report of each key in the order of arrival; a key is forgotten when the watermark passes it, so state is bounded by the keys of one delay."""
    return reports.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _by_key(table: pa.Table, by: Sequence[str], key: str) -> tuple[pa.Table, np.ndarray]:
    """table sorted by the columns by, of equal rows the earlier one first, and where another key begins."""
    table = table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in by])).combine_chunks()
    values = table.column(key)
    other = pc.not_equal(values.slice(1), values.slice(0, max(0, len(values) - 1)))
    return table, np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), other.to_numpy()]))


def _packed(key: str, order: Sequence[str], columns: Sequence[str]):
    """Of rows with their bucket, those of a bucket in one value, a table in Arrow's format: of some megabytes of rows at a time, of each key the first."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table, first = _by_key(pa.Table.from_batches(held), list(dict.fromkeys([BUCKET, key, *order])), key)
        table = table.take(first)
        bucket = table.column(BUCKET).to_numpy()
        edge = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        rows = table.select(columns)
        parts = [_to_bytes(rows.slice(lo, hi - lo)) for lo, hi in zip(edge, edge[1:], strict=False)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]], pa.int32()), pa.array(parts, pa.binary())], names=[BUCKET, "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held, size = [*held, batch], size + batch.nbytes
            if size > PACKED:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            yield from _from_bytes(raw).to_batches()


class Earliest(StatefulProcessor):
    """For each key of a bucket the order (columns that rank its reports) of the earliest report seen, and when the key was last heard of: one value a bucket. Reports that come before it are passed on, one a key. A timer forgets keys that are idle: a later report of one may then be passed on in vain, which the reader of the log makes good."""

    def __init__(self, key: str, order: Sequence[str], idle_ms: int) -> None:
        self.key, self.ranked, self.idle_ms = key, list(dict.fromkeys([key, *order])), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.best = handle, handle.getValueState("best", "keys binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came, now = None, None
        for part in rows:
            now = int(part["ms"].iloc[0])
            came, first = _by_key(pa.concat_tables([*([] if came is None else [came]), *map(_from_bytes, part["rows"])]), self.ranked, self.key)
            came = came.take(first)
        fresh = self._ranked(came, np.full(len(came), now), np.arange(len(came)))
        kept = self.best.get()
        kept = fresh.slice(0, 0) if kept is None else self._ranked(old := _from_bytes(kept[0]), old.column(HEARD).to_numpy(), np.full(len(old), -1))
        both, first = _by_key(pa.concat_tables([kept, fresh]), self.ranked, self.key)
        row, best = both.column(ROW).to_numpy(), both.take(first)
        again = np.maximum.reduceat(row, first) >= 0  # keys that were heard of
        heard, earlier = best.column(HEARD).to_numpy(), best.column(ROW).to_numpy()
        earlier = earlier[earlier >= 0]
        if len(earlier) or (again & (now - heard > self.idle_ms // 2)).any():
            self._keep(best.select(self.ranked).append_column(HEARD, pa.array(np.where(again, now, heard))))
        if not len(kept):
            self.handle.registerTimer(now + self.idle_ms)
        if len(earlier):
            yield pd.DataFrame({"rows": [_to_bytes(came.take(pa.array(earlier)))]})

    def _ranked(self, table: pa.Table, heard: np.ndarray, row: np.ndarray) -> pa.Table:
        return table.select(self.ranked).append_column(HEARD, pa.array(heard, pa.int64())).append_column(ROW, pa.array(row, pa.int64()))

    def _keep(self, table: pa.Table) -> None:
        self.best.update((_to_bytes(table),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        kept = _from_bytes(self.best.get()[0])
        heard = kept.column(HEARD).to_numpy()
        stay = heard + self.idle_ms > expiredTimerInfo.getExpiryTimeInMs()
        if not stay.any():
            self.best.clear()
        else:
            if not stay.all():
                self._keep(kept.filter(pa.array(stay)))
            self.handle.registerTimer(int(heard[stay].min()) + self.idle_ms)
        return iter([])

    def close(self) -> None:
        pass


def earlier_reports(reports: DataFrame, key: str, order: Sequence[str], idle: int = 7 * 24 * 3600, buckets: int = 1024) -> DataFrame:
    """From a stream of reports, those that come before all that their key has sent until then, by the columns of order. The watermark is on the time of arrival, which never falls back, so no report is too late, however old it is. State is a few values a key, forgotten after `idle` seconds without a report; keys are kept in buckets, and their rows travel packed, as calls of Python and of the state store for every key and row take far longer than the comparison. A checkpoint goes on with as many buckets as it began with. Reports without key or order are left out. Set STATE_STORE in the session."""
    whole = reports.where(" and ".join(f"`{c}` is not null" for c in (key, *order))).withColumn(BUCKET, F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets)))
    packed = whole.mapInArrow(_packed(key, order, reports.columns), f"{BUCKET} int, rows binary")
    arriving = packed.withColumns({"ms": F.unix_millis(F.current_timestamp()), ARRIVED: F.current_timestamp()}).withWatermark(ARRIVED, "0 seconds")
    found = arriving.groupBy(BUCKET).transformWithStateInPandas(Earliest(key, order, idle * 1000), "rows binary", "Append", "EventTime")
    return found.mapInArrow(_unpacked, reports.schema)


def earliest_report_log(reports: DataFrame, key: str, order: Sequence[str], log: str, checkpoint: str, idle: int = 7 * 24 * 3600, buckets: int = 1024) -> StreamingQuery:
    """Runs earlier_reports over what has arrived and appends to a log of Parquet files. Nothing written is ever rewritten: state and offsets are in the checkpoint, and a batch that is repeated after a failure at any point either finds its files committed or writes them anew."""
    return earlier_reports(reports, key, order, idle, buckets).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", log).trigger(availableNow=True).start()


def read_earliest(spark: SparkSession, log: str, key: str, order: Sequence[str]) -> DataFrame:
    """The earliest report of each key: the last of the log's few rows a key, one aggregate with partial sums."""
    rows = spark.read.parquet(log)
    return rows.groupBy(F.col(key).alias("__k")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*order)).alias("r")).select("r.*")
