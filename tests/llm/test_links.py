"""Links of the Jaccard join, not only what they connect, against brute force."""

import random

import numpy as np
import pytest

from tests.llm.test_text_operators import ODD, frame, jaccard_brute, near_copies
from waymark.llm import jaccard


def links_brute(docs, k, least):
    import re

    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
    sets = [frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if (w := low(t)) else frozenset() for t in docs]
    return [sum(i != j and bool(a) and 100 * len(a & b) >= least * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]


@pytest.mark.parametrize(("k", "least", "work"), [(3, 90, 2_000_000_000), (5, 80, 4000), (1, 60, 2000)])
def test_links_equal_brute_force(spark, k, least, work):
    """The small work makes pairs meet in several regions and blocks; texts occur several times, one also as rows of one id."""
    docs = near_copies(8, 150)
    docs += docs[40:44] + [docs[60]] * 3
    ids = [*range(len(docs) - 2), len(docs) - 3, len(docs) - 3]
    want = links_brute(docs, k, least)
    _, comp = jaccard_brute(docs, k, least)
    rows = jaccard.jaccard_components(frame(spark, docs, ids), shingle=k, least=least, work=work).select("doc_id", "n_links", "component_id").collect()
    assert sorted((r["doc_id"], r["n_links"]) for r in rows) == sorted(zip(ids, want))
    assert all(r["component_id"] == comp[r["doc_id"]] for r in rows)
    assert max(want) > 3 and len(ODD) < len(docs)


def test_join_region_counts_every_link():
    random.seed(3)
    base = random.sample(range(1000), 60)
    sets = [np.array(sorted(random.sample(base, 54)), np.int64) for _ in range(40)]
    copies = np.array([random.choice((1, 1, 3)) for _ in sets])
    _, links = jaccard.join_region(np.arange(40), sets, 85, copies=copies)
    near = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    assert links.tolist() == [sum(copies[j] for j in range(40) if j != i and near(set(sets[i]), set(sets[j]))) for i in range(40)]
    assert links.sum() > 2 * 39


def test_pivots_cut_a_region_and_lose_no_link():
    """Four clusters and what lies between two of them: cells are smaller than the region, and each link has one home."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    base = [rng.integers(-(1 << 62), 1 << 62, 400) for _ in range(4)]
    for i in range(1, 4):
        base[i][: 100 * i] = base[0][: 100 * i]

    def near(b, change):
        s = b.copy()
        i = rng.random(len(s)) < change
        s[i] = rng.integers(-(1 << 62), 1 << 62, i.sum())
        return s

    sets = [near(base[i % 4], 0.02) for i in range(240)] + [np.where(np.arange(400) < k, base[0], base[1]) for k in range(200, 400, 10)]
    sets = [np.array(sorted(s, key=lambda x: int(np.int64(x).view(np.uint64)))) for s in sets]  # as sets come: in the order of unsigned names
    m = len(sets)
    table = pa.table({"region": pa.array(np.ones(m, np.int64)), "node": pa.array(np.arange(m)), "n": pa.array([len(s) for s in sets]), "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())), "copies": pa.array(np.ones(m, np.int64)), "home": pa.array([True] * m), "side": pa.array(np.full(m, -1)), "pile": pa.array(np.zeros(m, np.int64))})
    leads = table.slice(0, 32).append_column("leads", pa.array([True] * 32))
    rows = pa.concat_tables([leads, table.append_column("leads", pa.array([False] * m))]).combine_chunks()
    out = pa.Table.from_batches(jaccard._to_pivots(90)(iter(rows.to_batches(max_chunksize=50)))).to_pandas()
    assert set(out["side"]) == {-1} and out["region"].nunique() > 2 and out.groupby("region").size().max() < 0.6 * m
    where = {n: set(g) for n, g in out.groupby("node")["region"]}
    home = {n: r for n, r, h in zip(out["node"], out["region"], out["home"], strict=True) if h}
    assert len(home) == m and out["home"].sum() == m
    as_sets = [set(s.tolist()) for s in sets]
    linked = [(i, j) for i in range(m) for j in range(i) if 100 * len(as_sets[i] & as_sets[j]) >= 90 * len(as_sets[i] | as_sets[j])]
    assert len(linked) > 1000 and all(home[i] in where[j] and home[j] in where[i] for i, j in linked)
