"""Toxicity by classifier chains.

Features: a document has a feature if one of its words (runs of letters, lower
case) equals it, or starts with its 4 or 5 letters (``stem:``). Spark counts for
every feature how many toxic and clean documents of the sample have it; the features
with the strongest surplus of toxic documents are kept (at most ``max_features``).

Chain: the categories are predicted one after another by logistic models. The
model of a category sees the features and the probabilities of all earlier
categories; in training these are out-of-fold predictions (``folds`` parts by a
hash of doc_id), so that a later model learns from probabilities as uncertain as
those it will meet. The last category is the verdict.

The classifier is fitted on a bounded sample of the labelled documents: about
``max_train`` (and a tenth more), chosen by a hash of doc_id, each class by its
share of the labels, but at least a tenth of the bound as far as it has so many,
with weights that give it its share back. So a rare class is learned from its
rows, however few they are among all. Scoring reads every whole text.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from pricelens.llm.common import fresh, written

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5)
#: The categories of the query, in chain order: a toxic document that holds a
#: toxic word, one that holds a word of a toxic stem, any toxic document.
CATEGORIES = ("toxic_word", "toxic_stem", "toxic")


def features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return words | {f"stem:{w[:n]}" for w in words for n in STEMS if len(w) >= n}


class Known:
    """The kept features, and which of them a text has."""

    def __init__(self, names: list[str]):
        self.at = {n: i for i, n in enumerate(names)}
        self.stems = {n: {k[5:]: i for k, i in self.at.items() if k.startswith("stem:") and len(k) == 5 + n} for n in STEMS}

    def present(self, text: str | None) -> list[int]:
        words = set(WORD.findall((text or "").lower()))
        out = {self.at[w] for w in words & self.at.keys()}
        for n, stems in self.stems.items():
            if stems:
                out.update(stems[s] for s in {w[:n] for w in words} & stems.keys())
        return sorted(out)


class Logistic:
    """Logistic model over present features and a few dense columns."""

    def __init__(self, n_features: int, n_dense: int):
        self.w, self.v, self.b = np.zeros(n_features), np.zeros(n_dense), 0.0

    def fit(self, rows: np.ndarray, cols: np.ndarray, dense: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 800, ridge: float = 1e-6) -> Logistic:
        n = max(weight.sum(), 1)
        speed_w, speed_v, speed_b = np.full(len(self.w), 1e-8), np.full(len(self.v), 1e-8), 1e-8
        for _ in range(rounds):
            g = (self.scores(rows, cols, dense) - y) * weight / n
            gw = np.bincount(cols, weights=g[rows], minlength=len(self.w)) + ridge * self.w
            gv, gb = dense.T @ g + ridge * self.v, g.sum()
            speed_w, speed_v, speed_b = speed_w + gw**2, speed_v + gv**2, speed_b + gb**2
            self.w -= 0.5 * gw / np.sqrt(speed_w)
            self.v -= 0.5 * gv / np.sqrt(speed_v)
            self.b -= 0.5 * gb / np.sqrt(speed_b)
        return self

    def scores(self, rows, cols, dense) -> np.ndarray:
        z = np.bincount(rows, weights=self.w[cols], minlength=len(dense)) + dense @ self.v + self.b
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Chain:
    """Models of the categories in order; ``labels`` has a column for each."""

    def __init__(self, names: list[str], categories: tuple[str, ...]):
        self.known, self.n, self.categories, self.models = Known(names), len(names), categories, []

    def fit(self, present: list[list[int]], labels: np.ndarray, fold: np.ndarray, weights: np.ndarray | None = None) -> Chain:
        # rows with the same features, labels and fold are one row with a weight
        seen: dict[tuple, float] = {}
        for key, w in zip(zip(map(tuple, present), map(tuple, labels.tolist()), fold.tolist()), [1.0] * len(present) if weights is None else weights.tolist()):
            seen[key] = seen.get(key, 0.0) + w
        present, weight = [list(k[0]) for k in seen], np.array(list(seen.values()), dtype=float)
        labels, fold = np.array([k[1] for k in seen]).reshape(len(seen), len(self.categories)), np.array([k[2] for k in seen])
        rows = np.repeat(np.arange(len(present)), [len(p) for p in present]).astype(np.int64)
        cols = np.array([c for p in present for c in p], dtype=np.int64)
        dense = np.zeros((len(present), 0))
        for k in range(len(self.categories)):
            y = labels[:, k].astype(float)
            out = np.zeros(len(y))
            # no later model reads the last category's out-of-fold predictions
            for f in np.unique(fold) if k + 1 < len(self.categories) else ():
                # rows of the other folds train, those of this one are predicted
                use = fold[rows] != f
                place = np.cumsum(fold != f) - 1
                model = Logistic(self.n, k).fit(place[rows[use]], cols[use], dense[fold != f], y[fold != f], weight[fold != f])
                out[fold == f] = model.scores(rows, cols, dense)[fold == f]
            self.models.append(Logistic(self.n, k).fit(rows, cols, dense, y, weight))
            dense = np.column_stack([dense, out])
        return self

    def predict(self, texts: list[str | None]) -> np.ndarray:
        present = [self.known.present(t) for t in texts]
        rows = np.repeat(np.arange(len(present)), [len(p) for p in present]).astype(np.int64)
        cols = np.array([c for p in present for c in p], dtype=np.int64)
        dense = np.zeros((len(present), 0))
        for m in self.models:
            dense = np.column_stack([dense, m.scores(rows, cols, dense)])
        return dense


def select_features(train: DataFrame, max_features: int, min_docs: int, min_z: float) -> list[str]:
    """Features of (text, toxic) rows by their surplus of toxic documents."""

    def run(batches):
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[y].update(features(t.as_py()))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([counts[y][n] for n in names], pa.int64()) for y in (0, 1)]], names=["feature", "clean", "toxic"]
            )

    totals = train.agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    n0, n1 = totals["clean"] or 0, totals["toxic"] or 0
    if not n0 or not n1:
        return []
    found = train.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, "feature string, clean long, toxic long")
    sums = found.groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    p = (F.col("c") + F.col("t") + 1) / (n0 + n1 + 2)
    z = (F.col("t") / n1 - F.col("c") / n0) / F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    kept = sums.where(F.col("t") >= min_docs).select("feature", z.alias("z")).where(F.col("z") >= min_z)
    return sorted(r["feature"] for r in kept.orderBy(F.desc("z"), "feature").limit(max_features).collect())


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    max_train: int = 20_000,
    max_features: int = 4096,
    min_docs: int = 3,
    min_z: float = 4.0,
    folds: int = 5,
) -> Chain | None:
    """The chain for CATEGORIES; None if there is no toxic or no clean label;
    also None, with a warning, if no feature tells them apart.

    ``labels``: (doc_id, toxic); null labels and ids are ignored, of several
    labels of a document the largest counts.
    """
    given = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
    given = given.groupBy(F.col(doc_id).cast("long").alias("label_id")).agg((F.max(toxic) > 0).cast("int").alias("toxic"))
    size = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None
    n = sum(size.values())
    share = [min(1.0, max(max_train / n, max_train / 10 / size[y])) for y in (0, 1)]
    place = F.pmod(F.xxhash64("label_id"), F.lit(1_000_000))
    chosen = given.where(place < F.when(F.col("toxic") == 1, F.lit(int(share[1] * 1_000_000))).otherwise(F.lit(int(share[0] * 1_000_000))))
    rows = docs.select(F.col(doc_id).cast("long").alias("label_id"), F.col(text).cast("string").alias("text"))
    # the chosen labels are about max_train rows of two numbers: a bounded broadcast
    # equal rows are one row with a weight, so a repeated row does not break the bound
    train = rows.join(F.broadcast(chosen), "label_id").groupBy("label_id", "toxic", F.xxhash64("text").alias("h"))
    train = written(train.agg(F.first("text").alias("text"), F.count("*").alias("n")), "toxic-train")
    names = select_features(train, max_features, min_docs, min_z)
    if not names:
        warnings.warn(f"{size[1]} toxic and {size[0]} clean labels, but no word or stem tells them apart: nothing will be called toxic (min_docs {min_docs}, min_z {min_z})", stacklevel=2)
        return None
    known = Known(names)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            found = [shared.value.present(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())), batch.column(3)], names=["label_id", "toxic", "present", "n"])

    got = train.select("label_id", "toxic", "text", "n").mapInArrow(run, "label_id long, toxic int, present array<int>, n long").collect()
    got.sort(key=lambda r: (r["label_id"], r["toxic"], r["present"]))
    stem = np.array([x.startswith("stem:") for x in names])
    y = np.array([r["toxic"] for r in got], dtype=np.int64)
    word = np.array([any(not stem[i] for i in r["present"]) for r in got], dtype=np.int64)
    root = np.array([any(stem[i] for i in r["present"]) for r in got], dtype=np.int64)
    fold = np.array([(r["label_id"] * 0x9E3779B97F4A7C15 >> 32) % folds for r in got])
    if share[0] != share[1]:  # a rare class: its few documents are dealt over the folds in turn
        rare = int(size[1] < size[0])
        ids = sorted({r["label_id"] for r in got if r["toxic"] == rare}, key=lambda i: (i * 0x9E3779B97F4A7C15 % 2**64, i))
        turn = {i: k % folds for k, i in enumerate(ids)}
        fold = np.array([turn[r["label_id"]] if r["toxic"] == rare else f for r, f in zip(got, fold.tolist())])
    weight = np.array([r["n"] / share[r["toxic"]] * min(share) for r in got])
    return Chain(names, CATEGORIES).fit([r["present"] for r in got], np.stack([y & word, y & root, y], 1), fold, weight)


def score_toxicity(docs: DataFrame, chain: Chain | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` plus a probability per category (``p_...``) and ``is_toxic``
    (under other names if ``docs`` has these).

    Null and empty texts have no feature; without a chain all probabilities are
    0 and nothing is toxic. Rows, repeated ones too, and other columns stay.
    """
    new = fresh(docs, *[f"p_{c}" for c in CATEGORIES], "is_toxic")
    names, at = [*docs.columns, *new], docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        c = shared.value
        for batch in batches:
            n = batch.num_rows
            p = c.predict([t.as_py() for t in batch.column(at)]) if c is not None else np.zeros((n, len(new) - 1))
            found = [pa.array(p[:, i]) for i in range(p.shape[1])] + [pa.array(p[:, -1] >= threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=names)

    fields = [*[StructField(c, DoubleType()) for c in new[:-1]], StructField(new[-1], BooleanType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that the chain calls toxic."""
    scored = score_toxicity(docs, train_chain(docs, labels, **options))
    return scored.where(~F.col(scored.columns[-1])).select(*docs.columns)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    from pricelens.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, train_chain(docs, table(spark, sf_dir, "labels"))).drop("text")
