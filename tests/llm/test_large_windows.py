"""Repeats over windows of thousands of items, and the automaton that a worker keeps."""

import random

import pytest

from tests.llm.test_text_operators import frame, sha
from waymark.llm import bucket_refine, decontaminate, recompression, repeats


def brute(texts, window):
    """Kept items of each text: those in no window that starts twice."""
    seen = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - window + 1):
            seen.setdefault(t[i : i + window], []).append((d, i))
    gone = [bytearray(len(t)) for t in texts]
    for at in seen.values():
        for d, i in at if len(at) > 1 else ():
            gone[d][i : i + window] = b"\1" * window
    return [[x for x, g in zip(t, own, strict=True) if not g] for t, own in zip(texts, gone, strict=True)]


def test_windows_of_thousands_of_bytes(spark):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, other = noise(7000), noise(6100)
    texts = [noise(900) + shared + noise(300), shared[400:] + noise(50) + other, noise(1700) + other + shared[: 6200], noise(6500), "", None]
    got = {r["doc_id"]: r for r in bucket_refine.remove_repeats(frame(spark, texts), window=6000, outputs=("n_removed", "kept_sha256")).collect()}
    for d, kept in enumerate(brute([(t or "").encode() for t in texts], 6000)):
        assert (got[d]["n_removed"], got[d]["kept_sha256"]) == (len((texts[d] or "").encode()) - len(kept), sha(bytes(kept)))
    assert got[0]["n_removed"] == 7000


def test_windows_of_thousands_of_words(spark):
    rng = random.Random(7)
    noise = lambda n: [rng.choice(["a", "b", "cd", "é"]) for _ in range(n)]
    shared = noise(6000)
    texts = [noise(300) + shared + noise(20), noise(10) + shared[100:] + noise(80), noise(5200)]
    got = {r["doc_id"]: r for r in recompression.remove_repeats(frame(spark, [" ".join(t) for t in texts]), window=5000, outputs=("n_removed", "kept_sha256")).collect()}
    for d, kept in enumerate(brute([tuple(t) for t in texts], 5000)):
        assert (got[d]["n_removed"], got[d]["kept_sha256"]) == (len(texts[d]) - len(kept), sha(" ".join(kept).encode()))
    assert got[0]["n_removed"] == 6000 or got[0]["n_removed"] == 5900


def test_windows_beyond_the_packing_raise():
    with pytest.raises(ValueError):
        repeats.Scheme("x", 1 << 29, 0, 1 << 29, (1,), lambda batch: None)


def test_one_automaton_a_worker_and_a_block():
    one = decontaminate._automaton("k", [("i", "a b c")], 2)
    assert decontaminate._automaton("k", [("i", "never read")], 2) is one
    assert decontaminate._automaton("l", [("i", "d e")], 2) is not one and list(decontaminate._BUILT) == ["l"]


def test_blocks_of_any_size_find_the_same(spark):
    docs = frame(spark, ["one two three four five six", "x one two three y", "four five", None])
    bench = spark.createDataFrame([("p", "one two three"), ("q", "three four five six seven"), ("r", "four five")], "item_id string, text string")
    rows = lambda n: sorted(map(repr, decontaminate.find_contamination(docs, bench, window=3, block_words=n).collect()))
    assert rows(1) == rows(4) == rows(250_000)
