"""The bound on the similarity of names, and the SQL of the measure, against difflib."""

import random
from difflib import SequenceMatcher

import duckdb

from waymark.functions.cleaning import name_similarity, name_similarity_bound
from waymark.operators import crosswalk
from waymark.plans import catalogue


def names(seed, n=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé 😀Ss") for _ in range(rng.randint(0, 14)))
    return [(word(), word()) for _ in range(n)] + [("Barrio 3 Elementary School", "barrio 3 ES"), (None, "a"), ("", " "), ("aaaa", "aa"), ("ß", "SS"), ("a", "a")]


def ratio(a, b):
    a, b = ((x or "").strip(" ").lower() for x in (a, b))
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def test_the_bound_is_never_below_the_measure(spark):
    df = spark.createDataFrame(names(1), "a string, b string")
    rows = df.select("a", "b", name_similarity_bound("a", "b").alias("most"), name_similarity("a", "b").alias("s")).collect()
    assert all(r["most"] >= r["s"] and abs(r["s"] - ratio(r["a"], r["b"])) < 1e-12 for r in rows)
    assert sum(r["most"] < 0.6 for r in rows) > 50 and any(r["most"] > r["s"] for r in rows)


def test_matches_are_those_without_the_bound(spark):
    rng = random.Random(2)
    row = lambda k, i, n: (f"{k}{i}", n, 10 + rng.random() / 1000, 120 + rng.random() / 1000, i)
    pairs = [(a or "x", b or "y") for a, b in names(3, 60)]
    schema = "site_id string, site_name string, latitude double, longitude double, _ord long"
    left, right = (spark.createDataFrame([row(k, i, p[j]) for i, p in enumerate(pairs)], schema) for j, k in enumerate("ab"))
    found = crosswalk.spatial_name_match(left, right)
    plain = crosswalk.spatial_name_match(left, right, similarity=lambda a, b: name_similarity(a, b))
    key = lambda df: sorted(tuple(r) for r in df.select("l_site_id", "r_site_id", "similarity").collect())
    assert key(found) == key(plain) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("array_distinct")  # the bound is below, on what Python gets


def test_sql_of_the_measure():
    con = duckdb.connect()
    con.execute("CREATE TABLE pairs (l INT, r INT, o INT, x VARCHAR, y VARCHAR)")
    plain = [(i, i, i, (a or "").strip(" ").lower(), (b or "").strip(" ").lower()) for i, (a, b) in enumerate(names(4))]
    con.executemany("INSERT INTO pairs VALUES (?, ?, ?, ?, ?)", plain)
    got = {i: s for i, s in con.execute("WITH RECURSIVE one AS (SELECT 1)" + catalogue._RATCLIFF + "SELECT l, s FROM scored").fetchall()}
    assert all(abs(got[i] - ratio(x, y)) < 1e-12 for i, _, _, x, y in plain)
