"""Exact order statistics where sketches narrow the values down."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.operators import search


def table(spark):
    rng = random.Random(9)
    rows = [("dense", 10 + rng.random() / 100) for _ in range(4000)]  # all within a hundredth of a degree
    rows += [("ties", float(rng.choice([-1, 0, 0, 0, 5]))) for _ in range(500)] + [("wide", rng.uniform(-90, 90)) for _ in range(700)] + [("one", 3.0), ("two", 2.0), ("two", 1.0)]
    rows += [("hot", 7.0)] * 3000 + [("hot", 7 + rng.random() / 1e6) for _ in range(900)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, x double").withColumn("n", F.count("*").over(search.Window.partitionBy("g")))


@pytest.mark.parametrize(("most", "ranges"), [(100_000, 200), (50, 20), (3, 4)])
def test_equal_to_sorted_values(spark, most, ranges):
    rows, df = table(spark)
    shares = (0.0, 0.25, 0.5, 0.75, 0.999)
    got = {r["g"]: tuple(r)[1:] for r in search._order_statistic(df, ["g"], "x", "n", shares, most, ranges).collect()}
    for g in {g for g, _ in rows}:
        own = sorted(x for k, x in rows if k == g)
        assert got[g] == tuple(own[int(len(own) * s)] for s in shares)
    assert len(got) == 6


def test_a_step_leaves_one_range(spark):
    """Of 4,000 different values in a hundredth of a degree a step with 20 ranges leaves some two hundred."""
    _, df = table(spark)
    values = df.where("g = 'dense'").groupBy("g", F.col("x").alias("v")).agg(F.count("*").alias("c")).withColumns({"i": F.lit(0), "at": F.lit(1000).cast("long")})
    left = search._narrowed(values, ["g"], 20)
    assert 150 < left.count() < 300 and left.agg(F.min("at")).first()[0] >= 0


def test_no_values(spark):
    _, df = table(spark)
    assert search._order_statistic(df.limit(0), ["g"], "x", "n", (0.5,)).collect() == []
