"""Operator 11, spelling variants grouped by permuterm rotations.

Every word is marked with a terminator and rotated. Take the rotation that brings the character at place p to the end: what stands
before it, "rest, terminator, beginning", is the same for every word that has another character there, and it is a whole rotation of
the word that lacks the character. So the sorted rotations that extend one such string by at most one character, the prefix range that
skips the edited character, are the words that differ by one replacement, insertion or deletion at this place, and any two of them are
near. A range holds one word a letter at most, and the word without it: its size is bounded by the alphabet, whatever the corpus. Rotations
are dealt by that prefix and sorted, one scan of each range tells every member how many others it has and which of them is the most
frequent, and what a word hears from its ranges is summed. No pair is listed: a replacement is met in one range; a deletion from a
run of equal letters is met in several and counted in that of the run's last letter.

A word's form is its most frequent near word, if that is at least `ratio` times as frequent; roots are found by doubling the steps
along forms, in some five rounds, as frequencies grow by the ratio with each step.

Memory: a task counts words in a dictionary that it hands on whenever it holds PENDING of them.

Cases: null and empty texts have no words; texts of any length are counted whole; rows that repeat are counted each; words of equal
frequency are ordered by code points; a null doc_id counts as an empty one where letters are dropped; empty tables, and words without
near words, give no form and themselves as root; other columns are not read. Words hold no U+0000.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import LOWER, forget, slices, stored, texts

#: Distinct words that a task holds before it hands its counts on.
PENDING = 200_000
#: Marks the end of a word.
END = "\0"
_RUN = re.compile("[a-zÀ-ÿ]+")


def _tally(ids: list, batch: list, drop_one_in: int, counts: dict[str, int]) -> None:
    """Adds the words of texts to counts."""
    get, crc = counts.get, zlib.crc32
    for ident, text in zip(ids, batch, strict=True):
        if not text:
            continue
        head = crc(f"{'' if ident is None else ident}:".encode())
        for run, n in Counter(_RUN.findall(text.encode().translate(LOWER).decode())).items():
            if drop_one_in and not (h := crc(run.encode(), head)) % drop_one_in:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] = get(run, 0) + n


def word_counts(docs: DataFrame, least_length: int = 5, least_count: int = 3, drop_one_in: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the runs of letters, A-Z in lower case, of at least so many code points and occurrences. drop_one_in: of every so many (document, run), by checksum, one loses a letter, which plants misspellings; 0 for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            long = {w: n for w, n in counts.items() if len(w) >= least_length}
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(long), pa.string()), pa.array(list(long.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0)
            for lo, k in slices(batch.column(1)):
                _tally(ids.slice(lo, k).to_pylist(), batch.column(1).slice(lo, k).to_pylist(), drop_one_in, counts)
                if len(counts) >= PENDING:
                    yield told()
        yield told()

    rows = texts(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """From (word, n): prefix, edited, n. A row for each rotation as the head of its own range (edited is empty), and one for each that ends with a character of the word, under the prefix that skips it."""
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("p"))
    head, tail, size = F.expr("substring(word, 1, p)"), F.expr("substring(word, p + 1)"), F.length("word")
    skipped = F.concat(F.expr("substring(word, p + 2)"), F.lit(END), head)
    whole = F.struct(F.concat(tail, F.lit(END), head).alias("prefix"), F.lit("").alias("edited"))
    without = F.struct(skipped.alias("prefix"), F.expr("substring(word, p + 1, 1)").alias("edited"))
    both = F.when(F.col("p") < size, F.array(whole, without)).otherwise(F.array(whole))
    return at.select("n", F.explode(both).alias("r")).select("r.prefix", "r.edited", "n")


def _word() -> Column:
    return F.concat(F.substring_index("prefix", END, -1), F.col("edited"), F.substring_index("prefix", END, 1))


def near_words(words: DataFrame) -> DataFrame:
    """From (word, n), words distinct: word, n, n_near, and first, the most frequent near word with its n (null if there is none)."""
    whole = F.col("edited") == ""
    last = ~whole & ~F.startswith(F.col("prefix"), F.col("edited"))  # the last letter of its run
    ranges = Window.partitionBy("prefix").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct("word", "n")
    met = rotations(words).withColumns({"word": _word(), "whole": whole, "last": last})
    met = met.withColumns(
        {
            "size": F.count("*").over(ranges),
            "n_whole": F.count_if("whole").over(ranges),
            "n_last": F.count_if("last").over(ranges),
            "top": F.first(member).over(ranges),
            "next": F.nth_value(member, 2).over(ranges),
        }
    ).where("size > 1")
    other = F.when(F.col("top.word") == F.col("word"), F.col("next")).otherwise(F.col("top"))
    here = F.when(F.col("whole"), F.col("n_last")).otherwise(F.col("size") - F.col("n_whole") - 1 + F.when(F.col("last"), F.col("n_whole")).otherwise(0))
    heard = met.select("word", here.alias("here"), F.struct((-other["n"]).alias("less"), other["word"].alias("word")).alias("other"))
    found = heard.groupBy("word").agg(F.sum("here").alias("n_near"), F.min("other").alias("best"))
    first = F.when(F.col("best").isNotNull(), F.struct(F.col("best.word").alias("word"), (-F.col("best.less")).alias("n")))
    return words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), first.alias("first"))


def roots(forms: DataFrame, name: str = "variants-roots") -> DataFrame:
    """From (word, form), where following forms ends: word, root for every word that has a form. Steps double each round; a row that has reached its root isn't joined again. The driver sees one count a round."""
    steps, k = stored(forms.where("form is not null").select("word", F.col("form").alias("at"), F.lit(False).alias("done")), f"{name}-0"), 0
    while steps.where("not done").head(1):
        k += 1
        onward = steps.select(F.col("word").alias("at"), F.col("at").alias("after"))
        moved = steps.where("not done").join(onward, "at", "left").select("word", F.coalesce("after", "at").alias("at"), F.col("after").isNull().alias("done"))
        before, steps = steps, stored(steps.where("done").unionByName(moved), f"{name}-{k}")
        forget(before)
    return steps.select("word", F.col("at").alias("root"))


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """From (word, n), words distinct: word, form, root, n, n_near, form_n."""
    fits = F.col("first.n") >= ratio * F.col("n")
    near = near_words(words).select("word", "n", "n_near", F.when(fits, F.col("first.word")).alias("form"), F.when(fits, F.col("first.n")).alias("form_n"))
    near = stored(near, "variants-forms")
    return near.join(roots(near), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, drop_one_in: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of documents with their forms and roots."""
    words = word_counts(docs, least_length, least_count, drop_one_in, id_col, text_col)
    return variants(stored(words, "variants-words"), ratio)
