"""Tables as versions: readers and crashes beside a rewrite."""

import os

import pytest
from pyspark.sql import functions as F

from waymark.sources import io


def values(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        if k:
            before = io.read_published(spark, path)  # begun with the version before
        io.publish(spark.range(k, k + 3), path)
        assert values(io.read_published(spark, path)) == [k, k + 1, k + 2]
        if k:
            assert values(before) == [k - 1, k, k + 1]
    assert sorted(x for x in os.listdir(path) if x[0] == "v") == ["v000000002", "v000000003"]


def test_a_table_is_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    io.publish(spark.range(3), path)
    io.publish(io.read_published(spark, path).select((F.col("id") * 2).alias("id")), path)
    assert values(io.read_published(spark, path)) == [0, 2, 4]


def test_a_crash_leaves_the_table_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    io.publish(spark.range(3), path)
    failing = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        io.publish(failing, path)
    assert values(io.read_published(spark, path)) == [0, 1, 2]
    os.makedirs(f"{path}/v000000007/_temporary/0")  # as a driver leaves it that is killed while it writes
    assert values(io.read_published(spark, path)) == [0, 1, 2]
    io.publish(spark.range(5), path)
    assert values(io.read_published(spark, path)) == [0, 1, 2, 3, 4] and not os.path.exists(f"{path}/v000000007")


def test_tables_of_others_and_none(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "plain"))
    assert values(io.read_published(spark, str(tmp_path / "plain"))) == [0, 1]
    with pytest.raises(FileNotFoundError):
        io.read_published(spark, str(tmp_path / "none"))
    os.makedirs(tmp_path / "begun" / "v000000000")
    with pytest.raises(FileNotFoundError):
        io.read_published(spark, str(tmp_path / "begun"))
