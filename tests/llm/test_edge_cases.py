"""Legal input that is easy to trip over: header names that differ in case, odd column names, ties, repeated rows, very long texts."""

import re

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from tests.llm.test_text_operators import ODD, frame
from waymark.llm import bucket_refine, cascade, decontaminate, jaccard, monoid_bpe, pii, recompression, revisit, toxicity

RECORD = "record_id long, url string, ts long, is_revisit boolean, etag string, last_modified string, headers map<string,string>, payload_digest string, chunk string, found string"


def test_headers_that_differ_in_case(spark):
    url = "http://a.org/x"
    rows = [
        (1, url, 10, False, '"e"', None, {"Date": "one", "date": "two", "Server": "s"}, "p", "clash", "clash"),
        (2, url, 20, True, '"e"', None, {"ETag": "x", "etag": "y", "DATE": None}, None, "clash", "clash"),
    ]
    out = {r["record_id"]: r for r in revisit.resolve(spark.createDataFrame(rows, RECORD)).collect()}
    assert out[1]["headers"] == {"date": "one", "server": "s"}
    assert out[2]["headers"] == {"etag": "x", "date": None, "server": "s"} and out[2]["refers_to"] == 1


def test_revisit_ties_and_repeated_rows(spark):
    url = "http://a.org/x"
    full = [(i, url, 10, False, f'"{i}"', None, {}, f"p{i}", "c", "f") for i in (3, 7, 5, 7)]
    again = [(9, url, 11, True, '"7"', None, {}, None, "c", "f")] * 2 + [(10, url, 10, True, '"7"', None, {}, None, "c", "f")]
    out = [(r["record_id"], r["outcome"], r["refers_to"]) for r in revisit.resolve(spark.createDataFrame(full + again, RECORD)).where("outcome <> 'full'").collect()]
    assert sorted(out, key=str) == [(10, "no_earlier_response", None), (9, "resolved", 7), (9, "resolved", 7)]


def test_decontamination_keeps_odd_columns(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, "a"), (1, item, "a"), (2, "clean words", None), (2, "clean words", None), (None, None, "b")], "doc_id long, text string, `source-url` string")
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("runs", F.lit("clash")).withColumn("items", F.array(F.lit("x")))
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns and left.schema == docs.schema
    assert sorted((r["doc_id"] or 0, r["source-url"]) for r in left.collect()) == [(0, "b"), (2, None), (2, None)]


def test_decontamination_cuts_long_items(spark):
    words = [f"q{i}" for i in range(100)]
    docs = frame(spark, [" ".join(words), " ".join(words[30:50]), " ".join(words[40:52]), " ".join(words[::-1])])
    bench = spark.createDataFrame([("long", " ".join(words)), ("short", "q3 q4")], "item_id string, text string")
    want = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert want == {0: (100, ["long", "short"]), 1: (20, ["long"]), 2: (0, []), 3: (0, [])}
    for block in (1, 13, 20, 50):
        assert want == {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_contamination(docs, bench, block_words=block).collect()}


def test_redaction_of_repeated_rows_and_empty_tables(spark):
    docs = frame(spark, ["mail a@b.co"] * 3 + ODD)
    assert pii.redact(docs).where("text = 'mail [EMAIL]'").count() == 3
    assert pii.redact(docs.where("false")).count() == 0
    long = "x " * 600_000 + "a@b.co"
    assert pii.redact(frame(spark, [long])).first()["text"] == "x " * 600_000 + "[EMAIL]"


def test_quality_of_repeated_rows_and_long_texts(spark):
    text = "\n".join(f"word{i} is here" for i in range(40_000))
    out = cascade.quality(frame(spark, [text, text, "short"], ids=[1, 1, None])).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in out) == [(0, 1, False), (1, 120_000, False), (1, 120_000, False)]


def test_toxicity_trains_on_one_row_of_an_id(spark):
    rows = [(i, ("vile scum " if i % 2 else "fine day ") + f"w{i}") for i in range(40)] + [(1, "fine day today")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, labels, 100).count() == 40
    assert toxicity.training_rows(docs, labels, 7).count() == 7
    out = toxicity.toxicity(docs, labels)
    assert out.count() == 70 and out.where("toxic").count() == 20
    long = spark.createDataFrame([(0, "fine day " * 300_000), (1, "fine day " * 300_000 + "vile scum")], "doc_id long, text string")
    assert {r["doc_id"]: r["toxic"] for r in toxicity.score(long, toxicity.fit(docs.limit(40), labels)).collect()}[0] is False


def test_very_long_texts(spark):
    """Texts of over a million bytes: a passage at the end of one that another holds, and near copies."""
    words = [f"word{i}" for i in range(120_000)]
    passage = " ".join(f"p{i}" for i in range(110))
    long = " ".join(words) + " " + passage
    docs = frame(spark, [long, f"short start {passage} and end", long.replace("word7919 ", "other ", 1)])
    got = {r["doc_id"]: r["n_removed"] for r in recompression.remove_repeats(docs.where("doc_id < 2"), outputs=("n_removed",)).collect()}
    assert got == {0: 110, 1: 110}
    shared = len(f" {passage}")
    got = {r["doc_id"]: r["n_removed"] for r in bucket_refine.remove_repeats(docs.where("doc_id < 2"), outputs=("n_removed",)).collect()}
    assert got == {0: shared, 1: shared}
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 0}
    bpe = monoid_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    one = monoid_bpe.encode_documents(docs.where("doc_id = 0"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, outputs=("ids", "text")).first()
    assert one["ids"] == library.encode_ordinary(long) and one["text"] == long


def test_every_planted_form_is_found(spark):
    """Documents of the smallest table that hold a plain address, number or secret, by patterns of the test's own, have a span."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null")
    forms = re.compile(r"[\w.]+@mail\d+\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b(?:token|password|secret|api_key) = \"[^\"]+\"|(?<![\d.])\d{2,3}\.\d{2,3}\.\d{2,3}\.\d{2,3}(?![\d.])")
    held = {r["doc_id"] for r in docs.collect() if forms.search(r["text"])}
    found = {r["doc_id"] for r in pii.find_pii(docs).where(F.size("spans") > 0).select("doc_id").collect()}
    assert len(held) > 20 and len(held & found) >= 0.95 * len(held)
