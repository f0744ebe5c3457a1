"""Operator 1, toxicity by cumulative-link ordinal regression.

P(grade >= k | x) = sigmoid(w.x - t_k), t_1 < t_2 < t_3: one weight vector for all thresholds. The result is the expected
severity, the sum of the three probabilities, and the verdict toxic if P(grade >= 1) reaches a half.

Features are sparse: lower-case words and their beginnings of 4 to 8 bytes, named by 64 bits, with value log(1 + count). The
labels say toxic or not; the grade of a toxic training text is 1 to 3 by the thirds of the number of its telling features
(log-odds over 2), so grades are ordered by how much abuse a text holds. Only toxic or not can be held against the labels: no
table grades severity, so grades 2 and 3 are not validated.

The model is fitted on at most `max_train` labelled documents, those of the least hash of doc_id (a documented bound; the
counting and selection of features run in Spark over that sample, and only the `max_features` selected columns reach the
driver). Scoring is one narrow pass over every whole text with the weights (bounded by max_features) broadcast.

Cases: null and empty texts and texts without known features score the intercept; labels that are null, of unknown documents
or repeated are ignored, ignored and merged by maximum; without both classes among the labels severity is 0 and nothing is
toxic; rows of equal ids are scored each, and one of them is trained on; ties at the cuts between grades take the lower grade;
texts of any length are read whole, in slices of a batch; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import LOWER, BYTE_VALUES, Names, Words, map_text, slices, stored, texts

GRADES = 3
PREFIXES = (4, 5, 6, 7, 8)
#: ASCII lower case; punctuation parts words.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in LOWER[:128]) + bytes(range(128, 256))


def features(batch: list) -> tuple[np.ndarray, np.ndarray]:
    """Text number and name of each occurrence of a feature."""
    words = Words(batch, _TABLE)
    names = Names(BYTE_VALUES[words.buf])
    length = words.stop - words.start
    docs, out = [words.doc], [names.of(words.start, words.stop)]
    for k in PREFIXES:
        at = length > k
        docs.append(words.doc[at])
        out.append(names.of(words.start[at], words.start[at] + k) ^ np.uint64(k))
    return np.concatenate(docs), np.concatenate(out)


class Known:
    """Columns of known features: a bit table first, then a search among the sorted names."""

    def __init__(self, names: np.ndarray) -> None:
        self.names = np.sort(names)
        self.mask = np.uint64((1 << 22) - 1)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.names & self.mask).astype(np.int64)] = True

    def columns(self, batch: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, column) of known features and their counts."""
        doc, name = features(batch)
        at = self.bits[(name & self.mask).astype(np.int64)]
        doc, name = doc[at], name[at]
        col = np.minimum(np.searchsorted(self.names, name), max(0, len(self.names) - 1))
        at = self.names[col] == name if len(self.names) else np.zeros(0, bool)
        key, count = np.unique(doc[at].astype(np.int64) * max(1, len(self.names)) + col[at], return_counts=True)
        return key // max(1, len(self.names)), key % max(1, len(self.names)), count


@dataclass
class Model:
    names: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.."""
        return 1 / (1 + np.exp(-np.clip(eta[:, None] - self.thresholds[None, :], -40, 40)))


def _counts(train: DataFrame, toxic: bool, known: np.ndarray | None = None) -> DataFrame:
    """Documents of a class that have a feature, by feature."""

    def run(batches):
        have = None if known is None else Known(known)
        for col in (b.column(1) for b in batches):
            for lo, size in slices(col):
                part = col.slice(lo, size).to_pylist()
                if have is None:
                    doc, name = features(part)
                    pairs = name[_first_of_pair(doc, name)]
                else:
                    pairs = have.names[have.columns(part)[1]]
                found, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["feature", "n"])

    return train.where(F.col("toxic") == int(toxic)).select("doc_id", "text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _first_of_pair(doc: np.ndarray, name: np.ndarray) -> np.ndarray:
    order = np.lexsort((name, doc))
    d, n = doc[order], name[order]
    return order[np.concatenate([[True], (d[1:] != d[:-1]) | (n[1:] != n[:-1])])[: len(order)]]


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int) -> DataFrame:
    """doc_id, text, toxic of at most max_train labelled documents."""
    chosen = labels.select(F.col("doc_id"), F.col("toxic")).where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = texts(docs).where("text is not null").join(F.broadcast(chosen), "doc_id")  # at most max_train rows of two numbers
    # of rows that share an id, the one whose text has the least hash, so that the bound is one of rows
    return rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("one"), F.max("toxic").alias("toxic")).select("doc_id", "one.text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, max_features: int = 4096, least: int = 4) -> Model | None:
    """The model, or None without both classes. least: toxic documents that must have a feature."""
    train = stored(training_rows(docs, labels, max_train), "toxicity-train")
    size = {r["toxic"]: r["n"] for r in train.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect()}
    if size.get(1, 0) < 1 or size.get(0, 0) < 1:
        return None
    often = _counts(train, True).where(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(32 * max_features).toPandas()
    names, n_pos = often["feature"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(float)
    order = np.argsort(names)
    names, n_pos = names[order], n_pos[order]
    neg = _counts(train, False, names).toPandas()
    n_neg = np.zeros(len(names))
    n_neg[np.searchsorted(names, neg["feature"].to_numpy(np.int64).view(np.uint64))] = neg["n"]
    odds = np.log((n_pos + 0.5) / (size[1] + 1)) - np.log((n_neg + 0.5) / (size[0] + 1))
    best = np.sort(np.argsort(-n_pos * odds, kind="stable")[:max_features])
    best = best[odds[best] > 0]
    names, odds = names[best], odds[best]

    def rows(batches):
        have = Known(names)
        for batch in batches:
            for lo, n in slices(batch.column(1)):
                doc, col, count = have.columns(batch.column(1).slice(lo, n).to_pylist())
                cut = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(x.astype(np.int32))) for x in (col, count)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(2).slice(lo, n), *lists], names=["doc_id", "toxic", "col", "count"])

    found = train.select(F.col("doc_id").cast("string"), "text", F.col("toxic").cast("int")).mapInArrow(rows, "doc_id string, toxic int, col array<int>, count array<int>").toArrow().sort_by("doc_id").combine_chunks()
    per, col, count = (f(found.column(c).chunk(0)).to_numpy() for f, c in ((pc.list_value_length, "col"), (pc.list_flatten, "col"), (pc.list_flatten, "count")))
    row, toxic = np.repeat(np.arange(len(found)), per), found.column("toxic").to_numpy() > 0
    grade = _grades(toxic, row, count * (odds[col] > 2))
    weights, thresholds = fit_cumulative(row, col, np.log1p(count), grade, len(names))
    return Model(names, weights, thresholds)


def _grades(toxic: np.ndarray, row: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """0 for texts that aren't toxic, else 1 to 3 by how often telling features occur in them."""
    total = np.bincount(row, weights=telling, minlength=len(toxic))
    cuts = np.quantile(total[toxic], [k / GRADES for k in range(1, GRADES)])
    return np.where(toxic, 1 + np.searchsorted(cuts, total, side="left"), 0)


def fit_cumulative(row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 400, ridge: float = 2e-5, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the proportional-odds model by Adam; thresholds as the first and logs of the gaps, so they stay ordered."""
    n = len(grade)
    p = np.zeros(n_features + GRADES)
    p[n_features] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1 :])
        t = p[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        eta = np.bincount(row, weights=value * w[col], minlength=n)
        upper = np.concatenate([np.ones((n, 1)), 1 / (1 + np.exp(-np.clip(eta[:, None] - t, -40, 40))), np.zeros((n, 1))], 1)
        here = np.arange(n)
        a, b = upper[here, grade], upper[here, grade + 1]
        chance = np.maximum(a - b, 1e-12)
        da, db = a * (1 - a) / chance, b * (1 - b) / chance  # d log P / d eta is da - db, by threshold -da and db
        g_eta = -(da - db) / n
        g_t = np.zeros(GRADES + 2)
        np.add.at(g_t, grade, da / n)
        np.add.at(g_t, grade + 1, -db / n)
        g_t = g_t[1 : GRADES + 1]
        grad = np.concatenate([np.bincount(col, weights=value * g_eta[row], minlength=n_features) + ridge * w, [g_t.sum()], np.cumsum(g_t[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1 :]))])


def score(docs: DataFrame, model: Model | None, at_least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade, rounded to 6 places), grade (the nearest), toxic."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def make():
        model = shared.value
        have = None if model is None else Known(model.names)

        def run(batch: list) -> dict:
            if model is None:
                z = [0.0] * len(batch)
                return {"severity": z, "grade": [0] * len(batch), "toxic": [False] * len(batch)}
            doc, col, count = have.columns(batch)
            over = model.exceed(np.bincount(doc, weights=np.log1p(count) * model.weights[col], minlength=len(batch)))
            severity = over.sum(1)
            return {"severity": np.round(severity, 6).tolist(), "grade": np.rint(severity).astype(int).tolist(), "toxic": (over[:, 0] >= at_least).tolist()}

        return run

    return map_text(texts(docs, id_col, text_col), make, "severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> DataFrame:
    """Severity of every row of docs, by a model fitted on the labels."""
    return score(docs, fit(docs, labels, max_train))


def keep_clean(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, at_least: float = 0.5) -> DataFrame:
    """The rows of docs that aren't toxic, with all their columns, in one narrow pass: rows aren't joined to their scores but carry them."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_train))
    at = docs.columns.index("text")

    def run(batches):
        have = None if model.value is None else Known(model.value.names)
        for batch in batches:
            for lo, n in slices(batch.column(at)):
                part = batch.slice(lo, n)
                if have is not None:
                    doc, col, count = have.columns(part.column(at).to_pylist())
                    over = model.value.exceed(np.bincount(doc, weights=np.log1p(count) * model.value.weights[col], minlength=n))
                    part = part.filter(pa.array(over[:, 0] < at_least))
                yield part

    return docs.mapInArrow(run, docs.schema)
