"""The stream's state in buckets of keys: of many keys few values, whose timers forget single keys."""

from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tests.test_streams import state_store  # noqa: F401
from waymark.streaming import reports


def test_many_keys_are_few_values(spark, tmp_path, state_store):  # noqa: F811
    d, n = str(tmp_path), 5000
    rows = spark.range(3 * n).select(F.concat(F.lit("s"), F.col("id") % n).alias("site"), F.when(F.col("id") % 7 != 0, F.col("id") + (1 << 60)).alias("note"), F.expr("timestamp'2024-01-01 00:00:00' - make_interval(0, 0, 0, 0, 0, 0, id)").alias("at"))
    for k in range(2):
        rows.where(F.col("id") % 2 == k).write.mode("append").parquet(f"{d}/in")
        q = reports.earliest_report_log(reports.report_stream(spark, f"{d}/in", rows.schema), "site", ["at"], f"{d}/log", f"{d}/state")
        q.awaitTermination()
        state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
        assert 0 < max(s["numRowsTotal"] for s in state) < n  # a call for each key is what took the time
    got = {r["site"]: (r["note"], r["at"]) for r in reports.read_earliest(spark, f"{d}/log", "site", ["at"]).collect()}
    want = {r["site"]: (r["note"], r["at"]) for r in rows.where(F.col("id") >= 2 * n).collect()}
    assert got == want and spark.read.parquet(f"{d}/log").count() <= 2 * n


def test_timer_forgets_idle_keys_alone():
    kept, timers = {}, []
    value = SimpleNamespace(get=lambda: kept.get("v"), update=lambda v: kept.update(v=v), clear=lambda: kept.pop("v"))
    p = reports.Earliest("k", ["at", "k"], 100)
    p.init(SimpleNamespace(getValueState=lambda *_: value, registerTimer=timers.append))

    def send(now, *rows):
        table = pa.table({"k": [r[0] for r in rows], "at": [r[1] for r in rows], "note": [r[2] for r in rows]})
        out = p.handleInputRows((0,), iter([pd.DataFrame({"rows": [reports._to_bytes(table)], "ms": [now]})]), None)
        return [tuple(r.values()) for x in out for raw in x["rows"] for r in reports._from_bytes(raw).to_pylist()]

    state = lambda: {r["k"]: (r["at"], r["__heard"]) for r in reports._from_bytes(kept["v"][0]).to_pylist()}
    assert send(1000, ("a", 5, "x"), ("b", 7, None), ("a", 4, "y"), ("a", 4, "z")) == [("a", 4, "y"), ("b", 7, None)]
    assert send(1060, ("b", 9, "later"), ("c", 1, "n")) == [("c", 1, "n")]
    assert state() == {"a": (4, 1000), "b": (7, 1060), "c": (1, 1060)} and timers == [1100]
    list(p.handleExpiredTimer((0,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1100)))
    assert set(state()) == {"b", "c"} and timers == [1100, 1160]
    assert send(1070, ("b", 9, "later")) == [] and state()["b"] == (7, 1060)  # heard of not long ago: nothing is written
    assert send(1070, ("a", 6, "again")) == [("a", 6, "again")]  # in vain
    list(p.handleExpiredTimer((0,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1160)))
    list(p.handleExpiredTimer((0,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1170)))
    assert timers == [1100, 1160, 1170] and "v" not in kept
