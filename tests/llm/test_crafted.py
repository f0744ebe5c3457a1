"""Strings made so that polynomial names modulo 2^64 collide: the Thue-Morse word of 1,024 letters and its complement, as letters of a word, as words, as bytes."""

import numpy as np
import pytest

from tests.llm.test_text_operators import frame, repeated, sha
from waymark.llm import bucket_refine, jaccard, recompression
from waymark.llm.common import BYTE_VALUES, Names, PrimeNames, Words

BITS = [bin(i).count("1") % 2 for i in range(2048)]
ONE, TWO = ("".join("ab"[b ^ flip] for b in BITS[:1024]) for flip in (0, 1))


def test_names_tell_crafted_strings_apart():
    for first, second in ((ONE, TWO), (ONE * 2, TWO * 2)):
        raw = np.frombuffer((first + second).encode(), np.uint8)
        start, stop = np.array([0, len(first)]), np.array([len(first), 2 * len(first)])
        assert len(set(Names(BYTE_VALUES[raw]).of(start, stop).tolist())) == 1
        for x in PrimeNames(raw).of(start, stop):
            assert len(set(x.tolist())) == 2
    for x in Words([f"{ONE} {TWO}"]).names():
        assert len(set(x.tolist())) == 2
    words = [f"{'x' if c == 'a' else 'y'}" for c in ONE + TWO]
    one, two = Words([" ".join(words)]).names()
    edge = np.zeros(2048, bool)
    edge[0] = True
    for x in recompression.Symbols(one, two, edge).of(np.array([0, 1024]), np.array([1024, 2048])):
        assert len(set(x.tolist())) == 2


def test_jaccard_tells_crafted_words_apart(spark):
    docs = [ONE, TWO, f"some {ONE} more words here", f"some {TWO} more words here", ONE]
    out = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.jaccard_components(frame(spark, docs)).collect()}
    assert out == {0: (0, 1), 1: (1, 0), 2: (2, 0), 3: (3, 0), 4: (0, 1)}


def test_repeats_tell_crafted_words_apart(spark):
    around = [f"w{i}" for i in range(17)]
    docs = [" ".join([*around, x, *around]) for x in (ONE, TWO)]
    assert [r["n_removed"] for r in recompression.remove_repeats(frame(spark, docs), outputs=("n_removed",)).collect()] == [0, 0]
    runs = [" ".join("xy"[b ^ flip] for b in BITS) for flip in (0, 1)]
    words = [r.encode().split() for r in runs]
    got = {r["doc_id"]: r["n_removed"] for r in recompression.remove_repeats(frame(spark, runs), outputs=("n_removed",)).collect()}
    assert got == {i: sum(g) for i, g in enumerate(repeated(words, 35))}


@pytest.mark.parametrize("docs", [[ONE, TWO, "z" + ONE[:700] + "q"], [ONE * 2, TWO * 2], ["a" * 399, "a" * 400, "b" * 401, "".join(f"{i} " for i in range(900)), "".join(f"{i} " for i in range(300, 420)) + "end", ("é" * 250 + "ab" * 90) * 2]])
def test_bucket_refinement_at_production_sizes(spark, docs):
    raw = [d.encode() for d in docs]
    for report in (None, 256):
        rows = bucket_refine.remove_repeats(frame(spark, docs), report=report, outputs=("n_removed", "kept_sha256", *["n_reported"] * bool(report)))
        got = {r["doc_id"]: r for r in rows.collect()}
        for i, (s, gone, told) in enumerate(zip(raw, repeated(raw, 400), repeated(raw, 256))):
            assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (sum(gone), sha(bytes(c for c, g in zip(s, gone) if not g)))
            assert report is None or got[i]["n_reported"] == sum(told)


def test_first_names_that_clash_are_replaced():
    node, second = np.array([5, 5, 6]), np.array([1, 2, 3])
    assert jaccard.told_apart(node, second, np.array([5])).tolist() == [1, 2, 6]
