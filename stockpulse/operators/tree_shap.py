"""Exact attribution of boosted trees: path-dependent Shapley values.

A tree's expectation with only some features known follows a row where the split's feature is known and both
branches, by their share of the training rows, where it is not. On the way to one leaf at most ``maxDepth``
different features decide, and each either sends a row towards the leaf or away from it: the Shapley values of a
leaf are a table with one row per pattern of these bits. Tables are computed once from the fitted trees; scoring
a batch is a look-up per leaf, vectorised over its rows, and runs where the rows are.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Executors need not have this package installed: the tables and their look-up travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Leaf:
    """Features on the way to a leaf, for each the half-open range (low, high] that leads to it, and its table."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    table: np.ndarray  # patterns x features


def pattern_table(shares: list[float], value: float) -> np.ndarray:
    """Shapley values of one leaf by pattern: bit j is set where feature j sends the row towards the leaf.

    ``shares`` are the shares of rows that take the way at the splits of a feature, multiplied.
    """
    m = len(shares)
    bits = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
    weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
    out = np.zeros((1 << m, m))
    for i in range(m):
        sums = np.zeros((1 << m, m))  # sums over the sets of known others, by their number
        sums[:, 0] = 1.0
        for j in range(m):
            if j != i:
                known = np.zeros_like(sums)
                known[:, 1:] = sums[:, :-1] * bits[:, j:j + 1]
                sums = sums * shares[j] + known
        out[:, i] = value * (bits[:, i] - shares[i]) * (sums @ np.array(weight))
    return out


def leaves_of(nodes: dict[int, tuple], scale: float) -> tuple[list[Leaf], float]:
    """(leaves, expectation) of one tree; ``nodes`` has id: (prediction, left, right, feature, threshold, rows)."""
    found, mean = [], 0.0
    todo = [(0, {}, 1.0)]
    while todo:
        at, way, reach = todo.pop()
        prediction, left, right, feature, threshold, rows = nodes[at]
        if left < 0:
            mean += reach * prediction * scale
            if way:
                names = tuple(sorted(way))
                found.append(Leaf(names, tuple(way[f][0] for f in names), tuple(way[f][1] for f in names), pattern_table([way[f][2] for f in names], prediction * scale)))
            continue
        low, high, share = way.get(feature, (-math.inf, math.inf, 1.0))
        for child, bounds in ((left, (low, min(high, threshold))), (right, (max(low, threshold), high))):
            part = nodes[child][5] / rows
            todo.append((child, {**way, feature: (*bounds, share * part)}, reach * part))
    return found, mean


def ensemble_leaves(model: GBTRegressionModel) -> tuple[list[Leaf], float]:
    """Leaves of all trees and the expected prediction. The model is read from its saved form: one row a node."""
    session = SparkSession.getActiveSession()
    path = scratch_path(session, "trees")
    model.write().save(path)
    rows = session.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # trees x nodes: bounded by the model
    trees: dict[int, dict[int, tuple]] = {}
    for r in rows:
        cut = list(r.split.leftCategoriesOrThreshold)
        if r.leftChild >= 0 and r.split.numCategories != -1:
            raise ValueError("categorical splits are not attributed")
        trees.setdefault(r.treeID, {})[r.id] = (r.prediction, r.leftChild, r.rightChild, r.split.featureIndex, cut[0] if cut else math.nan, r.rawCount)
    leaves, base = [], 0.0
    for tree, scale in enumerate(model.treeWeights):
        own, mean = leaves_of(trees[tree], scale)
        leaves += own
        base += mean
    return leaves, base


def shap_values(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """rows x features: what each feature adds to the prediction."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        pattern = np.zeros(len(x), np.int64)
        for j, f in enumerate(leaf.features):
            pattern |= ((x[:, f] > leaf.low[j]) & (x[:, f] <= leaf.high[j])).astype(np.int64) << j
        out[:, list(leaf.features)] += leaf.table[pattern]
    return out


def attribute(df: DataFrame, model: GBTRegressionModel, inputs: list[str], suffix: str = "_effect") -> DataFrame:
    """``df`` with one column per input, its effect on the prediction, and ``base``: they sum to the prediction.

    Inputs must not be null. The trees' tables are broadcast once; their size is that of the model (trees x leaves).
    """
    leaves, base = ensemble_leaves(model)
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    names = [f"{c}{suffix}" for c in inputs]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = shap_values(shared.value, b[inputs].to_numpy(np.float64))
            yield pd.concat([b, pd.DataFrame(found, columns=names, index=b.index)], axis=1)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), *(f"`{n}` double" for n in names)])
    return df.mapInPandas(run, schema).withColumn("base", F.lit(base))
