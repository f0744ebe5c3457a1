"""The stages of the pipeline one by one against brute-force versions, each on its own input."""

import tiktoken
import public_tokenizers as P

import corpus_pipeline
from tests.llm.test_text_operators import jaccard_brute
from waymark.llm import decontaminate, monoid_bpe, pii, toxicity
from waymark.llm.common import stored


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "encoding"]
    steps = dict(corpus_pipeline.STAGES)

    one = stored(steps["toxicity"](spark, docs, sf), "t1")
    bad = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("toxic").collect()}
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()} - bad and bad

    two = stored(steps["near_duplicates"](spark, one, sf), "t2")
    rows = sorted((r["doc_id"], r["text"]) for r in one.collect())
    size, comp = jaccard_brute([t for _, t in rows], 5, 80)
    assert {r["doc_id"] for r in two.collect()} == {rows[c][0] for c in set(comp)}

    three = stored(steps["decontamination"](spark, two, sf), "t3")
    auto = decontaminate.Automaton([(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()], 13)
    clean = set()
    for r in two.collect():
        words = decontaminate.normal_words(r["text"])
        hit = sum(b - a for a, b in auto.scan(words)[0])
        if not (hit and 20 * hit >= len(words)):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in three.collect()} == clean != {r["doc_id"] for r in two.collect()}

    four = stored(steps["pii"](spark, three, sf), "t4")
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    before = {r["doc_id"]: r["text"] for r in three.collect()}
    for r in four.collect():
        assert r["text"] == pii.redacted(before[r["doc_id"]], pii.find_spans(before[r["doc_id"]])) and r["n_chars"] == len(r["text"])

    five = steps["encoding"](spark, four, sf)
    tk = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=monoid_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).ranks, special_tokens={})
    text = {r["doc_id"]: r["text"] for r in four.collect()}
    got = five.collect()
    assert all(r["ids"] == tk.encode_ordinary(text[r["doc_id"]]) and r["text"] == text[r["doc_id"]] for r in got)
    whole = corpus_pipeline.run(spark, sf)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in got)


def test_stages_take_empty_and_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "x", "y", 0), (2, "a", "x", "y", 1), (2, "a", "x", "y", 1)], docs.schema)
    for rows, n in ((docs, 0), (odd, 3)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stored(stage(spark, rows, sf), "odd")
        assert rows.count() == n
