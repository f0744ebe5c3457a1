"""Operator 7, quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a Boolean expression that rejects a document. On a bounded sample each rule is timed, with the features it needs, and its
rejections are counted; rules are then ordered by rejections per second, the most first, and stand in one CASE WHEN in that order, which
stops at the first rule that rejects. The order decides how much work a document takes, never the verdict, which is the
conjunction of all rules. first_failed names the rule that was met first, and so depends on the order.

Features that several rules and the contract use are computed once, below the cascade. Nothing is shuffled.

Cases: a null text has no words; zero words fail the base; texts of any length are judged whole; equal rows are judged each; rules of
equal rejections and cost keep the given order; a null verdict of a rule rejects nothing; an empty table (or sample) keeps the given order of rules; other columns are not read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import texts

_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows found at least twice in the array w."""

    def covered(h: Column) -> Column:
        s = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            twice = F.filter(F.sequence(F.lit(1), F.size(s)), lambda k: F.coalesce(F.get(s, k - 1)["h"] == F.get(s, k - 2)["h"], F.lit(False)) | F.coalesce(F.get(s, k - 1)["h"] == F.get(s, k)["h"], F.lit(False)))
            starts = F.transform(twice, lambda k: F.get(s, k - 1)["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

        return let(s, marked)

    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, words and the counts of the contract."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        texts(docs, id_col, text_col)
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
        .withColumn("lines", lines)
        .select(
            "doc_id", "text", "words",
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _count(pattern: str) -> Column:
    """Characters of the class that pattern negates."""
    return F.length(F.regexp_replace("text", pattern, ""))


def rules() -> list[Rule]:
    """Production rules; integer comparisons only, so that every engine agrees."""
    n = F.col("n_words")
    return [
        Rule("too_long", n > 100_000),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("duplicate_lines", 5 * F.col("n_dup_lines") > 2 * F.col("n_lines")),
        Rule("shouting", 2 * _count(r"[^A-Z]+") > _count(r"[^A-Za-z]+")),
        Rule("exclamations", 10 * _count(r"[^!]+") > n),
        Rule("letterless", 5 * F.size(F.filter("words", lambda w: ~w.rlike(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"))) > n),
    ]


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: int
    rows: int


def sample_of(docs: DataFrame, rows: int = 500, most_chars: int = 100_000, one_in: int = 8) -> DataFrame:
    """At most `rows` rows of at most most_chars characters (so the driver, through which they go, holds a bounded amount), one in `one_in` by the hash of the text, from as few of the first partitions as give so many: nothing else is read, and nothing is shuffled."""
    chosen = docs.where((F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0) & (F.length("text") <= most_chars))
    return docs.sparkSession.createDataFrame(chosen.take(rows), docs.schema)


def estimate(docs: DataFrame, of: list[Rule], sample_rows: int = 500, repeats: int = 4) -> list[Estimate]:
    """Cost and rejections of each rule on a sample of docs (doc_id, text). Every rule is evaluated `repeats` times on every row of the sample, together with the features it needs; the time of a query that evaluates no rule is taken off, so that the cost is not that of starting a job."""
    sample = sample_of(docs, sample_rows)
    often = features(sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats)))))

    def timed(condition: Column) -> tuple[float, int, int]:
        times = []
        for _ in range(2):  # the first also compiles
            began = time.perf_counter()
            found = often.agg(F.count("*").alias("n"), F.count_if(condition).alias("rejected")).first()
            times.append(time.perf_counter() - began)
        return min(times), found["rejected"] // repeats, found["n"] // repeats

    idle, _, rows = timed(F.lit(False))
    if not rows:
        return [Estimate(r, 0.0, 0, 0) for r in of]
    return [Estimate(r, max(seconds - idle, 1e-3), rejected, rows) for r in of for seconds, rejected, _ in [timed(r.rejects)]]


def ordered(estimates: list[Estimate]) -> list[Rule]:
    """Most rejections per second first; those that reject nothing by cost."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rejected / max(e.seconds, 1e-9), e.seconds))]


def first_failed(of: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does; later rules aren't evaluated."""
    chain = None
    for rule in of:
        hit = F.coalesce(rule.rejects, F.lit(False))
        chain = F.when(hit, F.lit(rule.name)) if chain is None else chain.when(hit, F.lit(rule.name))
    return F.lit(None).cast("string") if chain is None else chain


def quality(docs: DataFrame, of: list[Rule] | None = None, sample_rows: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, first_failed and kept for every row of docs. Rows that fail the base don't enter the cascade."""
    featured = features(docs, id_col, text_col)
    order = ordered(estimate(texts(docs, id_col, text_col), rules() if of is None else of, sample_rows))
    return (
        featured.withColumn("base_failed", base_failed())
        .withColumn("first_failed", F.when(F.col("base_failed"), F.lit("base")).otherwise(first_failed(order)))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "first_failed", F.col("first_failed").isNull().alias("kept"))
    )
