"""Pages by marks and lookups over a sorted table: what the scans read."""

from pyspark.sql import functions as F

from waymark.operators import search
from waymark.sources import io


def read(df):
    """Rows that the scans of a plan, once run, have read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, rows = [plan], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            rows += p.metrics().apply("numOutputRows").value()
        if name.endswith("QueryStage"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return rows


def test_pages_and_sites_read_few_row_groups(spark, tmp_path):
    n, path = 60_000, str(tmp_path / "gold")
    ids = spark.range(n).select(F.format_string("s%07d", (F.col("id") * 7919) % n).alias("site_id"), F.sha2(F.col("id").cast("string"), 256).alias("code"))
    io.write_gold(ids, path, ["site_id", "code"], ["site_id"], files=3, find=["code"], **{"parquet.block.size": "200000", "parquet.page.size": "20000", "parquet.block.size.row.check.min": "100"})
    table = io.read_published(spark, path)
    marks = search.page_marks(table, 50)
    assert marks.count() == n // 50
    page = search.seek_page(table, marks, 1000)
    assert [r["site_id"] for r in page.collect()] == [f"s{i:07d}" for i in range(50_000, 50_050)]
    assert read(page) < n / 10
    assert read(search.get_site(table, "s0031234")) < n / 10
    code = ids.where("site_id = 's0031234'").first()["code"]
    found = search.get_site(table, code, "code")
    assert found.first()["site_id"] == "s0031234" and read(found) < n / 3  # its values are in no order: Bloom filters rule row groups out


def test_last_page_and_none(spark):
    df = spark.range(7).select(F.col("id").cast("string").alias("site_id"))
    marks = search.page_marks(df, 3)
    pages = [[r[0] for r in search.seek_page(df, marks, k).collect()] for k in range(4)]
    assert pages == [["0", "1", "2"], ["3", "4", "5"], ["6"], []]
    assert search.page_marks(df.limit(0), 3).collect() == []


def test_search_by_grams_equals_the_scan(spark, tmp_path):
    names = [None, "", "ab", "Abc", "abcabc", "xabc", "ABCd", "a bc", "Été é", "😀😀x😀", "cab", "İstanbul", "abc  abc", "bca"]
    df = spark.createDataFrame([(f"s{i}", n, i) for i, n in enumerate(names)] + [("abc", "bcd", 50), ("abc", "abc again", 51)], "site_id string, site_name string, _ord int")
    io.write_gold(search.name_grams(df), str(tmp_path / "g"), ["gram", "site_id"], ["gram", "site_id"])
    grams = io.read_published(spark, str(tmp_path / "g"))
    for q in ("abc", "ABC", "abcabc", "cab", "ab", "", "s3", "été", "😀x😀", "bcab", "c  a", "nothing", "stan"):
        assert search.search_by_grams(df, grams, q).collect() == search.search(df, q).collect(), q


def test_grams_of_the_query_alone_are_read(spark, tmp_path):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("site_id"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12).alias("site_name"), "id")
    grams = search.name_grams(df)
    io.write_gold(grams, str(tmp_path / "g"), ["gram", "site_id"], ["gram", "site_id"], **{"parquet.block.size": "200000", "parquet.page.size": "20000", "parquet.block.size.row.check.min": "100"})
    table = io.read_published(spark, str(tmp_path / "g"))
    assert read(table.where(F.col("gram").isin("abc", "bcd"))) < grams.count() / 10
    assert search.search_by_grams(df, table, "abcd", order="id").count() == search.search(df, "abcd", order="id").count() > 0
