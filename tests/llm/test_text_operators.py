"""The text operators on small inputs against brute force, the public libraries and planned cases."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.llm import bucket_refine, cascade, components, decontaminate, jaccard, monoid_bpe, pii, piece_count, queries, recompression, revisit, toxicity
from tests.test_queries import compare

ODD = [None, "", " ", "a", "é" * 500, "\x00 \x1c", "▁ ▁x", "日本語 テキスト 😀", "a\n\n b\t", "x" * 5000, "ab " * 2000, "<s> <|endoftext|>", "don't  WE'LL", "1.2.3.4 a@b.co"]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "clash", "k", 1) for i, t in zip(ids, texts)], "doc_id long, text string, node string, k1 string, n long")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# --- tokenizers ---


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def bpe():
    b = monoid_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    return b, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})


TEXT = st.text(alphabet=st.sampled_from(list(" \n\tabthe'sé日.1!▁\x1c 😀")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_tokens_equal_the_libraries(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")) if not hasattr(test_tokens_equal_the_libraries, "sp") else test_tokens_equal_the_libraries.sp
    test_tokens_equal_the_libraries.sp = sp
    assert piece_count.piece_counter(P.path("piece_bpe_32k.model")).count(text) == len(sp.encode(text))
    b = monoid_bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    if not hasattr(test_tokens_equal_the_libraries, "tk"):
        test_tokens_equal_the_libraries.tk = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    ids = b.encode(text)
    assert ids == test_tokens_equal_the_libraries.tk.encode_ordinary(text)
    assert b.decode(ids) == text.encode()


def test_tree_equals_whole_merge(bpe):
    b, _ = bpe
    random.seed(2)
    for _ in range(200):
        raw = bytes(random.choice(b"aab etnh\n") for _ in range(random.randint(1, 300)))
        assert b.tree(raw) == b.merge(raw)


def test_token_counts(spark, pieces):
    docs = frame(spark, ODD)
    out = {r["doc_id"]: r for r in piece_count.token_counts(docs, P.path("piece_bpe_32k.model"), limit=100).collect()}
    for i, t in enumerate(ODD):
        n = len(pieces.encode(t or ""))
        assert (out[i]["n_tokens"], out[i]["n_bytes"], out[i]["over_limit"]) == (n, len((t or "").encode()), n > 100)
    assert piece_count.token_counts(empty(spark), P.path("piece_bpe_32k.model")).count() == 0


def test_encode_and_decode(spark, bpe):
    b, tk = bpe
    enc = monoid_bpe.encode_documents(frame(spark, ODD), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, outputs=("ids", "n_tokens", "ids_sha256", "decoded_sha256"))
    out = {r["doc_id"]: r for r in enc.collect()}
    for i, t in enumerate(ODD):
        ids = tk.encode_ordinary(t or "")
        assert out[i]["ids"] == ids and out[i]["ids_sha256"] == sha(",".join(map(str, ids)).encode()) and out[i]["decoded_sha256"] == sha((t or "").encode())
    back = monoid_bpe.decode_ids(enc, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert {r["doc_id"]: bytes(r["decoded"]) for r in back.collect()} == {i: (t or "").encode() for i, t in enumerate(ODD)}


# --- repeats ---


def repeated(seqs, w):
    count = collections.Counter(tuple(s[i : i + w]) for s in seqs for i in range(len(s) - w + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - w + 1):
            if count[tuple(s[i : i + w])] > 1:
                gone[i : i + w] = [True] * w
        out.append(gone)
    return out


def passages(seed, n):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(40)]
    shared = [[random.choice(vocab) for _ in range(random.choice((34, 35, 36, 60, 120)))] for _ in range(6)]
    docs = []
    for _ in range(n):
        words = []
        for _ in range(random.randint(0, 4)):
            r = random.random()
            if r < 0.4:
                p = random.choice(shared)
                words += p[random.randint(0, 4) : len(p) - random.randint(0, 4)]
            elif r < 0.55:
                words += ["a"] * random.choice((3, 36, 80))
            elif r < 0.65:
                words += ["x", "y"] * 25
            else:
                words += [random.choice(vocab) for _ in range(random.randint(1, 80))]
        docs.append(" ".join(words))
    return [*docs, docs[1], docs[1], *ODD]


def test_recompression_equals_brute_force(spark):
    docs = passages(3, 60)
    out = {r["doc_id"]: r for r in recompression.remove_repeats(frame(spark, docs), outputs=("n_words", "n_removed", "kept_sha256", "kept")).collect()}
    words = [(t or "").encode().split() for t in docs]
    for i, (s, gone) in enumerate(zip(words, repeated(words, 35))):
        kept = b" ".join(w for w, g in zip(s, gone) if not g)
        assert (out[i]["n_words"], out[i]["n_removed"], out[i]["kept_sha256"], out[i]["kept"].encode()) == (len(s), sum(gone), sha(kept), kept)
    assert sum(r["n_removed"] for r in out.values()) > 1000
    assert recompression.remove_repeats(empty(spark)).count() == 0


def test_repeats_in_rows_of_one_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = recompression.remove_repeats(frame(spark, [text, text, None], ids=[7, 7, None]), outputs=("n_removed",)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (7, 40), (7, 40)]


def test_bucket_refinement_equals_brute_force(spark):
    docs = passages(4, 40)
    raw = [(t or "").encode() for t in docs]
    got = bucket_refine.remove_repeats(frame(spark, docs), window=90, q=30, block=9, outputs=("n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"))
    out = {r["doc_id"]: r for r in got.collect()}
    for i, (s, gone) in enumerate(zip(raw, repeated(raw, 90))):
        spans = [m.span() for m in re.finditer(b"1+", bytes(48 + g for g in gone))]
        assert (out[i]["n_bytes"], out[i]["n_removed"], out[i]["n_spans"]) == (len(s), sum(gone), len(spans))
        assert [(x["start"], x["stop"]) for x in out[i]["spans"]] == spans
        assert out[i]["kept_sha256"] == sha(bytes(c for c, g in zip(s, gone) if not g))


def symbols(words):
    from waymark.llm.common import Words

    one, two = Words([" ".join(words)]).names()
    edge = np.zeros(len(one), bool)
    edge[0] = True
    return recompression.Symbols(one, two, edge)


def test_survivors_depend_on_their_context_only():
    random.seed(5)
    for _ in range(200):
        core = [random.choice("abc") for _ in range(60)]
        head = random.randint(1, 30)
        one = symbols(core).survival()
        two = symbols([random.choice("abc") for _ in range(head)] + core + ["a"] * random.randint(0, 9)).survival()[head : head + 60]
        for k, c in enumerate(recompression.CONTEXTS):
            assert ((one >= k) == (two >= k))[c : 60 - c + 1].all()


def test_symbols_name_equal_ranges_equally_and_others_not():
    random.seed(6)
    for _ in range(60):
        words = [random.choice("ab") for _ in range(400)]
        core = words[100:160]
        words[300:360] = core
        s = symbols(words)
        a = np.array([random.randint(0, 59) for _ in range(300)])
        b = np.array([random.randint(x + 1, 60) for x in a])
        one, far = s.of(100 + a, 100 + b), s.of(300 + a, 300 + b)
        assert (one[0] == far[0]).all() and (one[1] == far[1]).all()
        start = np.array([random.randint(0, 340) for _ in range(500)])
        stop = start + np.array([random.randint(1, 60) for _ in start])
        named = {}
        for i, j, x, y in zip(start, stop, *s.of(start, stop)):
            key = tuple(words[i:j])
            assert named.setdefault((x, y), key) == key
        assert len(set(named.values())) == len(named)


# --- near duplicates ---


def jaccard_brute(docs, k, least):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
    sets = [frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if (w := low(t)) else frozenset() for t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= least * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(docs))]


def near_copies(seed, n):
    random.seed(seed)
    vocab = [f"w{i}" for i in range(200)]
    base = [[random.choice(vocab) for _ in range(random.choice((11, 12, 40, 120)))] for _ in range(12)]
    docs = list(ODD) + ["a b", "A b", "a b c", "A B C"]
    for _ in range(n):
        b = list(random.choice(base[:2] if random.random() < 0.5 else base))
        for _ in range(random.choice((0, 0, 1, 1, 2, 3, 6))):
            b[random.randrange(len(b))] = random.choice(vocab)
        docs.append(" ".join(b))
    return docs


@pytest.mark.parametrize(("k", "least", "work"), [(3, 90, 2_000_000_000), (5, 80, 4000)])
def test_jaccard_equals_brute_force(spark, k, least, work):
    """The small work makes regions be cut by pivots and into blocks."""
    docs = near_copies(6, 220)
    out = {r["doc_id"]: r for r in jaccard.jaccard_components(frame(spark, docs), shingle=k, least=least, work=work).collect()}
    sizes, comp = jaccard_brute(docs, k, least)
    assert [out[i]["n_shingles"] for i in range(len(docs))] == sizes
    assert [out[i]["component_id"] for i in range(len(docs))] == comp


def test_join_region_equals_brute_force():
    random.seed(7)
    for _ in range(30):
        base = random.sample(range(1000), 60)
        sets = [np.array(sorted(set(random.sample(base, 52)) | set(random.sample(range(2000, 2100), random.randint(0, 4)))), np.int64) for _ in range(40)]
        root, _ = jaccard.join_region(np.arange(40), sets, 80)
        want = list(range(40))
        for i in range(40):
            for j in range(i):
                a, b = set(sets[i]), set(sets[j])
                if 100 * len(a & b) >= 80 * len(a | b):
                    x, y = want[i], want[j]
                    want = [min(x, y) if w in (x, y) else w for w in want]
        assert len(set(zip(root.tolist(), want))) == len(set(want)) == len(set(root.tolist()))


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = frame(spark, [text, text + " more", text, None, "", "other words entirely"], ids=[5, 3, 5, 1, 2, None])
    kept = jaccard.keep_one(docs, shingle=5, least=80)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3]


def test_components(spark):
    chain = [(i, i + 1) for i in range(20)] + [(100, 101), (7, 7)]
    out = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}


# --- contamination, personal data, quality, toxicity, revisits ---


def test_decontamination(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [f"Start. {item.upper()}! End", f"{' '.join(f'q{i}' for i in range(12))} x", "short One!", *ODD]
    bench = spark.createDataFrame([(10, item), (9, "Short, one"), (8, None), (7, "?!"), (9, "short one"), (None, "end of")], "item_id long, text string")
    for block in (2_000_000, 5):
        out = {r["doc_id"]: r for r in decontaminate.find_contamination(frame(spark, docs), bench, block_words=block).collect()}
        assert (out[0]["n_words"], out[0]["n_hit"], out[0]["items"], [tuple(s) for s in out[0]["spans"]]) == (22, 20, ["10"], [(7, 7 + len(item))])
        assert (out[1]["n_hit"], out[2]["n_hit"], out[2]["items"]) == (0, 2, ["9"])
        assert all(out[i]["n_hit"] == 0 for i in range(3, len(docs)))
    left = decontaminate.drop_contaminated(frame(spark, docs), bench)
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(1, 2)) + list(range(3, len(docs))) and left.columns[2] == "node"
    assert decontaminate.find_contamination(frame(spark, docs), bench.where("false")).where("n_hit > 0").count() == 0


def base_spans(text):
    out = []
    for kind, pattern in pii.BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a1.@+- ()_%4é\n2")), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == base_spans(text)


def test_pii(spark):
    docs = ["mail a.b+c@d-e.co.uk. ip 1.2.3.4.5 300.1.1.1", "card 4111 1111 1111 1111 or 4111111111111112", "call +1 (017) 555-7713 now +12", 'token = "04dbebab91ab85687d33" iban: DE89 3704 0044 0532 0130 00 x', "see https://u:p@h.org/x, http://10.0.0.1/a and https://h.org", *ODD]
    out = {r["doc_id"]: [(s["kind"], docs[r["doc_id"]][s["start"] : s["stop"]]) for s in r["spans"]] for r in pii.find_pii(frame(spark, docs)).collect()}
    assert out[0] == [("email", "a.b+c@d-e.co.uk"), ("ip", "1.2.3.4")]
    assert out[1] == [("card", "4111 1111 1111 1111")] and out[2] == [("phone", "+1 (017) 555-7713")]
    assert out[3] == [("account", "04dbebab91ab85687d33"), ("account", "DE89 3704 0044 0532 0130 00")]
    assert [k for k, _ in out[4]] == ["email", "ip", "url", "url"] or [k for k, _ in out[4]] == ["ip", "url", "url"]
    red = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, docs)).collect()}
    assert red[0] == "mail [EMAIL]. ip [IP].5 300.1.1.1" and red[5] is None and red[6] == ""


def test_quality(spark):
    good = " ".join(f"word{i} the" for i in range(40))
    docs = [good, good.upper(), "a b c " * 30, good + " # # # # # # # # # # # #", "x\nx\nx\n" + good.replace(" ", "\n", 3), *ODD]
    out = {r["doc_id"]: r for r in cascade.quality(frame(spark, docs)).collect()}
    assert out[0]["kept"] and not out[1]["kept"] and out[2]["base_failed"] and not out[3]["kept"]
    assert out[2]["n_repeat_words"] == 90 and out[4]["n_dup_lines"] == 2
    assert all(not out[i]["kept"] for i in range(5, len(docs)))
    est = [cascade.Estimate(r, s, n, 10) for r, s, n in zip(cascade.rules(), (1, 2, 1, 1, 1, 1, 1), (0, 8, 9, 1, 0, 0, 0))]
    assert [r.name for r in cascade.ordered(est)][:3] == ["symbols", "word_length", "duplicate_lines"]
    assert cascade.quality(empty(spark)).count() == 0


def test_fit_cumulative_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 5, 600)
    grade = np.clip(x - 1 + (rng.random(600) < 0.1), 0, 3)
    w, t = toxicity.fit_cumulative(np.arange(600), np.zeros(600, int), x.astype(float), grade, 1)
    assert w[0] > 0 and (np.diff(t) > 0).all()


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    out = toxicity.toxicity(docs, labels.where(~held))
    m = out.join(labels.where(held & F.col("toxic").isNotNull()).withColumnRenamed("toxic", "label"), "doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == (F.col("label") == 1)).alias("right"), F.count_if((F.col("label") == 0) & F.col("toxic")).alias("wrong"), F.count_if(F.col("label") == 1).alias("bad"), F.count_if((F.col("label") == 1) & F.col("toxic")).alias("caught")).first()
    assert m["right"] >= 0.98 * m["n"] and m["wrong"] <= 0.01 * m["n"] and m["caught"] >= 0.95 * m["bad"], m


def test_toxicity_edge_cases(spark):
    labels = spark.createDataFrame([(0, 1), (0, None), (99, 1), (None, 1)], "doc_id long, toxic int")
    docs = frame(spark, ["bad words here", *ODD])
    assert toxicity.toxicity(docs, labels).where("toxic or severity <> 0").count() == 0
    assert toxicity.keep_clean(docs, labels).count() == docs.count()
    both = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    train = frame(spark, [("vile scum " if i % 2 else "fine day ") + f"w{i}" for i in range(40)] + [None, ""])
    out = {r["doc_id"]: r["toxic"] for r in toxicity.toxicity(train, both).collect()}
    assert all(out[i] == bool(i % 2) for i in range(40)) and len(out) == 42
    assert sorted(r["doc_id"] for r in toxicity.keep_clean(train, both).where("doc_id < 40").collect()) == list(range(0, 40, 2))


def test_revisits(spark):
    h = {"Content-Type": "text/html", "Date": "d1"}
    rows = [
        (1, "http://www.A.org:80/x/?utm_source=q&b=2&a=1#f", 10, False, '"e1"', None, h, "p1"),
        (2, "https://a.org/x?a=1&b=2", 20, False, '"e2"', None, h, "p2"),
        (3, "http://a.org/x/?b=2&a=1", 15, True, 'W/"e1"', None, {"Date": "d2", "Content-Length": "0"}, None),
        (4, "http://a.org/x?a=1&b=2", 20, True, '"e2"', None, {}, None),
        (5, "http://a.org/x?a=1&b=2", 5_000_000, True, '"e2"', None, None, None),
        (6, "http://a.org/x?a=1&b=2", 5, True, None, None, {}, None),
        (7, "http://a.org/x?a=1&b=2", 30, True, None, None, {}, None),
        (8, None, 30, True, None, None, {}, None),
        (9, "http://a.org/x?a=1&b=2", None, True, None, None, {}, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, is_revisit boolean, etag string, last_modified string, headers map<string,string>, payload_digest string")
    out = {r["record_id"]: r for r in revisit.resolve(df).collect()}
    assert {k: r["outcome"] for k, r in out.items()} == {1: "full", 2: "full", 3: "resolved", 4: "validator_mismatch", 5: "resolved", 6: "no_earlier_response", 7: "unverified", 8: "no_earlier_response", 9: "no_earlier_response"}
    assert out[3]["headers"] == {"content-type": "text/html", "date": "d2"} and out[3]["payload_digest"] == "p1" and out[5]["refers_to"] == 2
    assert revisit.resolve(df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_sql(spark, sf, name):
    compare(spark, sf, name, queries.QUERIES, queries.ORACLES)
