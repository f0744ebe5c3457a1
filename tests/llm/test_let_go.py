"""Shuffle files of finished steps."""

import time

from pyspark.sql import functions as F

from waymark.llm import common, jaccard


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_the_last_query_keeps_no_shuffle_files(spark):
    """Nothing runs between the query and the collection."""
    before = shuffled(spark)
    df = spark.range(100_000).withColumn("k", F.col("id") % 977).groupBy("k").count()
    common.stored(df, "let-go")
    assert shuffled(spark) - before
    common.let_go(spark)
    for _ in range(50):
        if not shuffled(spark) - before:
            return
        time.sleep(0.1)
    raise AssertionError("shuffle files stay")


def test_cells_go_before_sketches_travel(spark, monkeypatch):
    """The landmarks of all sets are deleted once those that sets share are written."""
    done, stored, forget = [], jaccard.stored, jaccard.forget
    monkeypatch.setattr(jaccard, "stored", lambda df, name: (done.append(name), stored(df, name))[1])
    monkeypatch.setattr(jaccard, "forget", lambda *t: (done.extend("-" + x.stored_at.rsplit("waymark-", 1)[1].rsplit("-", 1)[0] for x in t), forget(*t))[1])
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i // 2}") for i in range(8)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert found == {i: i // 2 * 2 for i in range(8)}
    assert done.index("-jaccard-cells") < done.index("jaccard-near")
