"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are whole words and their first four and five letters, so that compounds of a root share weight.
They are selected by how much more often they occur in toxic documents. Grades are ordered: 0 clean,
then 1 to 3 by how much toxic wording a toxic document has (thirds of the toxic training rows). One
weight vector serves all thresholds: P(grade > k) = s(w.x - t_k) with t_0 < t_1 < t_2. The expected
severity is the sum of these probabilities, from 0 to 3.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import row_key

#: Labelled rows the model is fitted on: all, or about so many, chosen by a hash of the id. Features at most.
TRAIN_ROWS, MAX_FEATURES, SEED = 40_000, 8192, 41
#: Toxic documents that must have a feature, shared weight of the penalty, steps of the fit, distinct features held by a task.
SUPPORT, RIDGE, STEPS, HELD = 4, 0.01, 400, 200_000
#: Characters of a text that are split at a time.
PIECE = 1 << 20
GRADES = 3

_WORD = re.compile(r"[^\W\d_]+")


def word_counts(text: str | None) -> Counter:
    """Lower-case letter words of a whole text."""
    text, counts, start = text or "", Counter(), 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and text[end - 1].isalpha() and end - start < 2 * PIECE:
            end += 1
        counts.update(_WORD.findall(text[start:end].lower()))
        start = end
    return counts


def features(text: str | None) -> Counter:
    """Counts of words ('w') and of the first letters of longer words ('4', '5')."""
    found = Counter()
    for w, n in word_counts(text).items():
        found["w" + w] += n
        if len(w) > 4:
            found["4" + w[:4]] += n
        if len(w) > 5:
            found["5" + w[:5]] += n
    return found


def _selected(sample: DataFrame, support: int, most: int) -> list[tuple[str, float]]:
    """The features (name, log odds ratio) that tell toxic rows of the sample best, ``most`` at most."""

    def count(batches):
        seen: dict[str, list[int]] = {}

        def flush():
            names = list(seen)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[x][1] for x in names], pa.int64()),
                                               pa.array([seen[x][0] for x in names], pa.int64())], ["name", "toxic", "clean"])

        for b in batches:
            for label, text in zip(b["label"].to_pylist(), b["text"]):
                for name in features(text.as_py()):
                    seen.setdefault(name, [0, 0])[label] += 1
                if len(seen) > HELD:
                    yield flush()
                    seen.clear()
        if seen:
            yield flush()

    sizes = sample.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).first()
    toxic, clean = int(sizes["toxic"] or 0), int((sizes["all"] or 0) - (sizes["toxic"] or 0))
    counts = sample.mapInArrow(count, "name string, toxic long, clean long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    kept = counts.filter(F.col("toxic") >= support).withColumn("odds", odds).filter(F.col("odds") > math.log(4))
    rows = kept.orderBy((F.col("odds") * F.col("toxic")).desc(), "name").limit(most).select("name", "odds").collect()
    return [(r["name"], r["odds"]) for r in rows]


def fit(x: list[tuple[list[int], list[float]]], grade: np.ndarray, n_features: int, grades: int = GRADES,
        ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the proportional-odds model, by Adam steps on the penalised likelihood."""
    row = np.repeat(np.arange(len(x)), [len(i) for i, _ in x])
    col = np.array([j for i, _ in x for j in i], np.int64)
    val = np.array([v for _, vs in x for v in vs], float)
    n = len(x)
    # thresholds: the first one, then logarithms of the gaps, which keeps them in order
    above = np.clip([(grade > k).mean() for k in range(grades)], 1e-4, 1 - 1e-4)
    start = np.log(1 / above - 1)
    theta = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    for step in range(1, steps + 1):
        w, gaps = theta[:n_features], np.exp(theta[n_features + 1:])
        t = theta[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(row, val * w[col], n)
        edges = np.concatenate([[np.inf], -t, [-np.inf]])  # P(grade >= k) = s(z + edges[k])
        with np.errstate(invalid="ignore"):
            up, down = sig(z + edges[grade]), sig(z + edges[grade + 1])
        up, down = np.where(grade == 0, 1.0, up), np.where(grade == grades, 0.0, down)
        p = np.maximum(up - down, 1e-12)
        du, dd = up * (1 - up) / p, down * (1 - down) / p
        dz = -(du - dd) / n
        gt = np.array([(dd[grade == k].sum() * -1 + du[grade == k + 1].sum()) / n for k in range(grades)])
        g = np.concatenate([np.bincount(col, val * dz[row], n_features) + ridge * w / max(n, 1), [gt.sum()], [gaps[i] * gt[i + 1:].sum() for i in range(grades - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    t = theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1:]))])
    return theta[:n_features], t


def _vector(text: str | None, at: dict[str, int]) -> tuple[list[int], list[float]]:
    found = {}
    for w, n in word_counts(text).items():
        for name in ("w" + w, *(("4" + w[:4],) if len(w) > 4 else ()), *(("5" + w[:5],) if len(w) > 5 else ())):
            if (i := at.get(name)) is not None:
                found[i] = found.get(i, 0) + n
    return list(found), [math.log1p(n) for n in found.values()]


def grades_of(strength: np.ndarray, toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """0 for clean rows; toxic rows by equal parts of their toxic wording, least first."""
    out = np.zeros(len(toxic), np.int64)
    if toxic.any():
        edges = np.quantile(strength[toxic], np.arange(1, grades) / grades)
        out[toxic] = 1 + np.searchsorted(edges, strength[toxic], side="left")
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS,
          most: int = MAX_FEATURES, support: int = SUPPORT):
    """(features, weights, thresholds), or None where the labels are all of one kind."""
    truth = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    truth = stage(truth, "toxic-labels")
    share = train_rows / max(truth.count(), 1)
    chosen = truth.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about train_rows ids: a parameter bounds what is broadcast, so the texts need no shuffle
    sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = stage(sample.select("label", "text"), "toxic-sample")
    chosen_features = _selected(sample, support, most)
    if not chosen_features:
        return None
    names, odds = [n for n, _ in chosen_features], np.array([o for _, o in chosen_features])
    at = {n: i for i, n in enumerate(names)}

    def vectors(batches):
        for b in batches:
            xs = [_vector(t.as_py(), at) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["label"], pa.array([i for i, _ in xs], pa.list_(pa.int32())), pa.array([v for _, v in xs], pa.list_(pa.float64()))], ["label", "i", "v"])

    rows = sample.mapInArrow(vectors, "label int, i array<int>, v array<double>").collect()  # about train_rows sparse rows
    rows.sort(key=lambda r: (r["label"], r["i"], r["v"]))  # the same fit whatever order tasks end in
    x, toxic = [(r["i"], r["v"]) for r in rows], np.array([r["label"] for r in rows]) > 0
    if toxic.all() or not toxic.any():
        return None
    strength = np.array([sum(v * odds[i] for i, v in zip(*row)) for row in x])
    weights, thresholds = fit(x, grades_of(strength, toxic), len(names))
    return names, weights, thresholds


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, severity (0 to 3), grade (most likely), p_toxic, toxic.

    Null and empty texts have no features: they score as a document without toxic wording. Labels without
    an id or outside 0 and 1 are not used; of several, toxic counts. Where labels show only one kind there
    is no model: severity, grade and p_toxic are null and toxic is false.
    """
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(docs, labels, id_col, text_col, **options)
    if model is None:
        return rows.select("_row", "doc_id", F.lit(None).cast("double").alias("severity"), F.lit(None).cast("int").alias("grade"),
                           F.lit(None).cast("double").alias("p_toxic"), F.lit(False).alias("toxic"))
    names, weights, thresholds = model
    at, kind = {n: i for i, n in enumerate(names)}, rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            z = np.array([sum(weights[i] * v for i, v in zip(*_vector(t.as_py(), at))) for t in b["text"]], float)
            over = 1 / (1 + np.exp(-np.clip(z[:, None] - thresholds[None, :], -35, 35)))
            each = -np.diff(np.concatenate([np.ones((len(z), 1)), over, np.zeros((len(z), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b["_row"], b["doc_id"], pa.array(over.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(over[:, 0]), pa.array(over[:, 0] >= threshold)],
                ["_row", "doc_id", "severity", "grade", "p_toxic", "toxic"])

    return rows.mapInArrow(run, f"_row long, doc_id {kind}, severity double, grade int, p_toxic double, toxic boolean")
