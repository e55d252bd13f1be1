"""Ensemble weights that minimise the squared error over the simplex, from sums of products."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package installed: the small solver travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def best_weights(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The w >= 0 with sum 1 that minimises w'Gw - 2 b'w.

    Every set of active members is tried: on it the optimum solves one linear system with the sum as constraint
    (least squares where members coincide), and the best feasible one is the optimum of the whole. Ties go to the
    smaller set, then to the earlier members.
    """
    n, best, found = len(target), np.inf, np.zeros(len(target))
    for size in range(1, n + 1):
        for active in map(list, combinations(range(n), size)):
            system = np.ones((size + 1, size + 1))
            system[:size, :size], system[size, size] = 2 * gram[np.ix_(active, active)], 0.0
            w = np.linalg.lstsq(system, np.append(2 * target[active], 1.0), rcond=None)[0][:size]
            if (w < -1e-9).any() or abs(w.sum() - 1) > 1e-6:
                continue
            w = np.clip(w, 0, None) / np.clip(w, 0, None).sum()
            value = w @ gram[np.ix_(active, active)] @ w - 2 * target[active] @ w
            if value < best - 1e-9 * max(1.0, abs(best) if np.isfinite(best) else 1.0):
                best, found = value, np.zeros(n)
                found[active] = w
    return found


def fit_weights(scored: DataFrame, members=("seasonal", "naive", "lookback"), by: str = "category") -> DataFrame:
    """by, rows, rmse, w_<member>: the weights with the lowest RMSE of each group, to the accuracy of doubles.

    One aggregation gives the sums of products of each group, a row of k (k + 3) / 2 + 2 numbers whatever its size;
    the programme is solved on that row. Rows without some member are left out; ``by`` must not be null.
    """
    k = len(members)
    rows = scored.na.drop(subset=["actual", by, *members]).select(by, F.col("actual").cast("double").alias("a"), *[F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(members)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.groupBy(by).agg(F.count("*").alias("rows"), F.sum(F.col("a") * F.col("a")).alias("aa"), *[F.sum(F.col("a") * F.col(f"m{i}")).alias(f"b{i}") for i in range(k)],
                                *[F.sum(F.col(f"m{i}") * F.col(f"m{j}")).alias(f"g{i}_{j}") for i, j in pairs])
    names = [f"w_{m}" for m in members]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                gram, target = np.empty((k, k)), np.array([r[f"b{i}"] for i in range(k)]) / r["rows"]
                for i, j in pairs:
                    gram[i, j] = gram[j, i] = r[f"g{i}_{j}"] / r["rows"]
                w = best_weights(gram, target)
                out.append((r[by], r["rows"], float(np.sqrt(max(r["aa"] / r["rows"] + w @ gram @ w - 2 * target @ w, 0.0))), *w))
            yield pd.DataFrame(out, columns=[by, "rows", "rmse", *names])

    kind = sums.schema[by].dataType.simpleString()
    return sums.mapInPandas(solve, f"`{by}` {kind}, rows long, rmse double, " + ", ".join(f"{n} double" for n in names))
