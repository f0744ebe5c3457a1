"""The stream of reports against the batch result, after failures at any point."""

import os

import pytest
from pyspark.sql import functions as F

from waymark.streaming import reports

ORDER = ["at", "n"]


@pytest.fixture
def state_store(spark):
    before = {k: spark.conf.get(k) for k in reports.STATE_STORE}
    for k, v in reports.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sent(spark, k):
    """Delivery k: later ones bring earlier reports, ties, new sites, reports without site or time."""
    rows = [(f"s{i}", f"2024-01-{28 - 7 * k + i % 3:02d} 10:00:00", 100 - k if i % 2 else 5, f"{k}") for i in range(k, 12 + 2 * k)]
    rows += [(f"s{i}", "2024-06-01 00:00:00", k, "late") for i in range(4)] + [(None, "2020-01-01 00:00:00", 1, "no site"), ("s1", None, 1, "no time"), ("s2", "2024-06-01 00:00:00", k, "late")]
    return spark.createDataFrame(rows, "site string, at string, n long, note string").withColumn("at", F.to_timestamp("at"))


def run(spark, d, idle=3600):
    schema = sent(spark, 0).schema
    q = reports.earliest_report_log(reports.report_stream(spark, f"{d}/in", schema), "site", ORDER, f"{d}/log", f"{d}/state", idle)
    q.awaitTermination()
    assert q.exception() is None


def check(spark, d):
    rows = spark.read.parquet(f"{d}/in").where("site is not null and at is not null")
    want = rows.groupBy("site").agg(F.min_by(F.struct(*rows.columns), F.struct(*ORDER)).alias("r")).select("r.*")
    got = reports.read_earliest(spark, f"{d}/log", "site", ORDER)
    key = lambda df: sorted(tuple(r)[:3] for r in df.collect())
    assert key(got) == key(want)
    return spark.read.parquet(f"{d}/log").count()


def undo(d, sink):
    """The state of a crash in the last batch: before its commit, and, with sink, before the sink's commit."""
    for at in [f"{d}/state/commits"] + [f"{d}/log/_spark_metadata"] * sink:
        last = max((x for x in os.listdir(at) if x.isdigit()), key=int)
        for x in (last, f".{last}.crc"):
            if os.path.exists(f"{at}/{x}"):
                os.remove(f"{at}/{x}")


def test_deliveries_and_crashes(spark, tmp_path, state_store):
    d = str(tmp_path)
    for k, sink in ((0, None), (1, False), (2, True)):
        sent(spark, k).coalesce(1).write.mode("append").parquet(f"{d}/in")
        run(spark, d)
        n = check(spark, d)
        if sink is not None:
            undo(d, sink)
            run(spark, d)
            assert check(spark, d) == n  # the repeated batch is there once


def test_forgotten_keys(spark, tmp_path, state_store):
    """With keys forgotten at once, reports are passed on in vain, and the table is the same."""
    d = str(tmp_path)
    for k in (2, 1, 0):
        sent(spark, k).coalesce(1).write.mode("append").parquet(f"{d}/in")
        run(spark, d, idle=0)
    check(spark, d)


def test_first_of_each_key_in_order_of_arrival(spark, tmp_path):
    d = str(tmp_path)
    sent(spark, 1).where("site is not null and at is not null").coalesce(1).write.parquet(f"{d}/in")
    out = reports.first_report_stream(reports.report_stream(spark, f"{d}/in", sent(spark, 0).schema), "site", "at")
    out.writeStream.format("parquet").option("checkpointLocation", f"{d}/c").option("path", f"{d}/out").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{d}/out")
    assert got.count() == got.select("site").distinct().count() == sent(spark, 1).where("site is not null and at is not null").select("site").distinct().count()
