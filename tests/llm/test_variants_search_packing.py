"""Operators 11 to 13 against brute force, SQL and the public library."""

import random
import struct
import zlib
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_text_operators import ODD, empty, frame
from waymark.llm import lexical, packing, queries, variants


@pytest.mark.parametrize("name", ["op11_variants", "op12_lexical_search"])
def test_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and want


# --- 11 ---


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_near_words_forms_and_roots_equal_brute_force(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): rng.randint(1, 40) for _ in range(250)} | {"aaaaaa": 9, "aaaaa": 9, "aaaa": 9, "zzz": 1, "Ûaaaa": 50}
    got = {r["word"]: r for r in variants.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got) == set(words)
    form = {}
    for w, n in words.items():
        others = [(-words[v], v) for v in words if near(w, v)]
        best = min(others)[1] if others and -min(others)[0] >= 2 * n else None
        form[w] = best
        assert (got[w]["n"], got[w]["n_near"], got[w]["form"], got[w]["form_n"]) == (n, len(others), best, words.get(best))
    for w in words:
        at = w
        while form[at]:
            at = form[at]
        assert got[w]["root"] == at
    assert any(form[form[w]] for w in words if form[w])  # chains were followed


def test_a_long_chain_ends_at_its_root(spark):
    """Steps double, so 40 forms in a row take a few rounds."""
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}" if i < 40 else None) for i in range(41)], "word string, form string")
    assert {r["word"]: r["root"] for r in variants.roots(chain).collect()} == {f"w{i}": "w40" for i in range(40)}


def test_word_counts(spark):
    texts = [None, "", "Écoute écoute ÉCOUTE", "abcde" * 20_000 + " x", "Hello hello", "hello, heLLo!", "hello"]
    got = {r["word"]: r["n"] for r in variants.word_counts(frame(spark, texts), least_count=1, drop_one_in=0).collect()}
    assert got == {"Écoute": 2, "écoute": 1, "abcde" * 20_000: 1, "hello": 5}
    dropped = {}
    for i, t in enumerate(["hello world again"] * 300):
        for run in t.split():
            h = zlib.crc32(f"{i}:{run}".encode())
            w = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
            dropped[w] = dropped.get(w, 0) + 1
    got = {r["word"]: r["n"] for r in variants.word_counts(frame(spark, ["hello world again"] * 300), least_length=1, least_count=1).collect()}
    assert got == dropped and len(got) > 3
    assert variants.word_counts(frame(spark, texts, [7] * len(texts)), least_count=5, drop_one_in=0).collect() == [("hello", 5)]


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(empty(spark)).collect() == []
    assert variants.spelling_variants(frame(spark, [None, "", "a b"])).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    counts = {}
    variants._tally([1, 2], ["ab ab c", None], 0, counts)
    variants._tally([3], ["ab"], 0, counts)
    assert counts == {"ab": 3, "c": 1}


# --- 12 ---

ITEMS = [(1, "The cat"), (2, "dog, DOG; cat-dog"), (3, None), (4, "..."), (5, "nowhere"), (6, "the"), (1, "bird 42")]


def brute(docs, items, top):
    terms = lambda t: [x for x in "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in (t or "")).translate({i: i + 32 for i in range(65, 91)}).split(" ") if x]
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    total = sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    held = {}
    for i, t in items:
        held.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in held.items():
        scored = []
        for d, c in tf:
            m = 10 + 90 * sum(c.values()) * len(tf) // total
            scored.append((sum(lexical.weight(len(tf), df[t]) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t]), d))
        scored = sorted([x for x in scored if x[0] > 0], key=lambda x: (-x[0], -1 if x[1] is None else x[1]))[:top]
        out += [(i, k + 1, d, s) for k, (s, d) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [4_000_000, 1])
def test_search_equals_brute_force(spark, block):
    rng = random.Random(5)
    texts = [*ODD, *[" ".join(rng.choice(["the", "cat", "Dog", "dogs", "bird", "42", "x", "été", "hé\x00the"]) for _ in range(rng.randint(1, 12))) for _ in range(80)], "the cat", "the cat", "cat " * 20_000]
    ids = [*range(len(texts) - 1), 3]
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumn("doc_id", F.lit("clash"))
    got = sorted(tuple(r) for r in lexical.search(frame(spark, texts, ids), items, top=4, block_chars=block).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute(list(zip(ids, texts, strict=True)), ITEMS, 4) and {g[0] for g in got} >= {1, 2, 6}


def test_search_keeps_the_best_of_many(spark, monkeypatch):
    """Candidates go in several rounds, ties stay in order of doc_id, null ids come first."""
    texts = ["cat dog"] * 60 + ["cat"] * 60 + ["dog bird"] * 60 + ["none here"] * 100
    ids = [None, *range(len(texts), 1, -1)]
    items = spark.createDataFrame([(None, "cat"), (2, "dog")], "item_id int, text string")
    got = [tuple(r) for r in lexical.search(frame(spark, texts, ids).coalesce(1), items, top=10).where("item_id = 2").orderBy("rank").collect()]
    assert got == [x for x in brute(list(zip(ids, texts, strict=True)), [(2, "dog"), (7, "cat")], 10) if x[0] == 2] and got[0][2] is None
    found = lexical.search(frame(spark, texts, ids), items, top=10).where("item_id is null")
    assert found.count() == 10


def test_only_the_best_rows_stay():
    import pyarrow as pa

    t = pa.table({"item": [1, 0, 1, 1, 0], "doc_id": [5, 4, None, 2, 1], "score": [3, 7, 3, 9, 7]})
    assert lexical._best(t, 2).to_pylist() == [{"item": 0, "doc_id": 1, "score": 7}, {"item": 0, "doc_id": 4, "score": 7}, {"item": 1, "doc_id": 2, "score": 9}, {"item": 1, "doc_id": None, "score": 3}]


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    nothing = items.limit(0)
    for docs, asked in ((empty(spark), items), (frame(spark, ["cat"]), nothing), (frame(spark, [None, "."]), items)):
        out = lexical.search(docs, asked)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


# --- 13 ---

JSON = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)
TEXT = st.text(alphabet=st.sampled_from(list(" \n\tabthe'sé日.1!\x1c\x85\xa0 😀|<>")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TEXT, st.sampled_from(["<|endoftext|>", " <|endoftext|> x", "a <|endoftext|>b c"])), max_size=4))
def test_units_give_the_librarys_ids(parts):
    text = "".join(parts)
    assert packing.load(JSON).ids([text, None]) == [struct.pack(f"<{len(x)}I", *x) for x in (LIBRARY.encode(text, add_special_tokens=False).ids, [])]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100])
    counts = {n: rng.randint(1, 40) for n in rng.sample(range(1, capacity + 1), rng.randint(1, capacity // 2))}
    rules = packing.plan(counts, capacity)
    filled: dict[int, list] = {}
    for n, own in rules.items():
        for i, (rank, sequence, each, offset) in enumerate(own):
            upto = own[i + 1][0] if i + 1 < len(own) else counts[n]
            for r in range(upto - rank):
                filled.setdefault(sequence + r // each, []).append((offset + r % each * n, n))
    for own in filled.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and sum(own[-1]) <= capacity
    left: list[int] = []  # document by document
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [i for i, x in enumerate(left) if x >= n]
            if fits:
                left[min(fits, key=lambda i: left[i])] -= n
            else:
                left.append(capacity - n)
    assert sorted(left) == sorted(capacity - sum(own[-1]) for own in filled.values())


def test_rules_depend_on_lengths_only():
    rng = random.Random(1)
    sizes = [sum(map(len, packing.plan({n: rng.randint(1, 10) * many for n in range(1, 2049)}, 2048).values())) for many in (1, 1000, 10**9)]
    assert max(sizes) < 4 * 2048


def test_packing(spark):
    rng = random.Random(2)
    texts = [*ODD, *[" ".join(rng.choice(["the", "cat", "naïve", "x1", "<|endoftext|>"]) for _ in range(rng.randint(0, 400))) for _ in range(60)], "word " * 3000, "word " * 3000]
    capacity = 256
    out = packing.pack_documents(frame(spark, texts, [*range(len(texts) - 1), 5]), JSON, capacity, outputs=("ids", "ids_crc32"))
    rows = out.collect()
    want = Counter()
    for i, t in zip([*range(len(texts) - 1), 5], texts, strict=True):
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        k = -(-len(ids) // capacity)
        first = len(ids) - (k - 1) * capacity
        ends = [first + j * capacity for j in range(k)]
        for j, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
            want[i, j, a, b - a, tuple(ids[a:b])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], tuple(r["ids"])) for r in rows) == want
    assert all(r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"])) for r in rows)
    held: dict[int, list] = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append(r)
    for own in held.values():
        own.sort(key=lambda r: r["offset"])
        assert own[0]["offset"] == 0 and all(a["offset"] + a["length"] == b["offset"] for a, b in zip(own, own[1:], strict=False)) and sum(r["length"] for r in own) <= capacity
    left: list[int] = []
    for n in sorted((r["length"] for r in rows), reverse=True):
        i = min((i for i, x in enumerate(left) if x >= n), key=lambda i: left[i], default=None)
        if i is None:
            left.append(capacity - n)
        else:
            left[i] -= n
    assert len(held) == len(left)
    for s in packing.sequences(out).collect():
        own = held[s["sequence_id"]]
        assert len(s["ids"]) == sum(s["lengths"]) and Counter(s["doc_ids"]) == Counter(r["doc_id"] for r in own) and list(s["ids"]) == [x for r in own for x in r["ids"]]


def test_packing_an_empty_table(spark):
    out = packing.pack_documents(empty(spark), JSON, outputs=("ids_crc32",))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.collect() == []
    assert packing.sequences(packing.pack_documents(empty(spark), JSON)).collect() == []


def test_other_vocabularies_are_encoded_whole():
    path = P.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    text = "Hello  World, it's <|startoftext|> fine"
    assert packing.Encoder(path).ids([text]) == [struct.pack(f"<{len(x)}I", *x) for x in [whole.encode(text, add_special_tokens=False).ids]]
