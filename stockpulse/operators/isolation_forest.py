"""Isolation forest (Liu, Ting, Zhou 2008): trees grown per group of a sample, scored batch-wise.

Sampling, grouping and scoring are Spark jobs. A tree sees at most 256 rows and the whole forest at most
200 x 511 nodes, so both the grouped tasks and the broadcast forest have a fixed size whatever the data.
Scaling the inputs first would change nothing: a split point is drawn within the range of its feature.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Forest settings.
N_TREES, SUBSAMPLE, MAX_FEATURES, SEED = 200, 256, 0.8, 42
NODE_SCHEMA = "tree_id int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of n keys."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def tree_sample(df: DataFrame, keys, columns, n_trees: int = N_TREES, subsample: int = SUBSAMPLE, seed: int = SEED):
    """Rows tagged with tree_id: ``subsample`` rows without replacement for each tree.

    The order is a hash of the key, so the sample does not depend on the partitioning. The pool holds
    at most ``n_trees * subsample`` rows; a hash threshold thins the input before the top-k so that the
    final merge stays small on any number of partitions. A small pool is reshuffled several times.
    """
    total = df.count()
    pool_size = n_trees * subsample
    order = F.xxhash64(*keys, F.lit(seed))
    cut = int((1 << 40) * min(1.0, 4 * pool_size / max(total, 1)))
    thin = df.filter(F.pmod(F.xxhash64(*keys, F.lit(seed + 1)), F.lit(1 << 40)) < cut)
    pool = stage(thin.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).orderBy(order, *keys).limit(pool_size),
                 "forest_pool")
    size = pool.count()
    per_tree = min(subsample, size)
    trees_per_round = max(1, size // max(1, per_tree))
    rounds = math.ceil(n_trees / trees_per_round)
    shuffled = Window.partitionBy("round").orderBy(F.xxhash64(*keys, "round"), *keys)
    tagged = (
        pool.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
        .withColumn("slot", F.floor((F.row_number().over(shuffled) - 1) / max(1, per_tree)))
        .filter(F.col("slot") < trees_per_round)
        .withColumn("tree_id", (F.col("round") * trees_per_round + F.col("slot")).cast("int"))
        .filter(F.col("tree_id") < n_trees)
    )
    return tagged.select("tree_id", *keys, *columns), per_tree


def grow(x: np.ndarray, rng: np.random.Generator, max_depth: int, features: np.ndarray) -> list[tuple]:
    """Nodes of one tree as (node, feature, threshold, left, right, path); feature -1 marks a leaf."""
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    next_id = 1
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        lows, highs = part.min(axis=0), part.max(axis=0)
        open_features = features[highs[features] > lows[features]]
        if depth >= max_depth or len(rows) <= 1 or len(open_features) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + average_path(len(rows))))
            continue
        f = int(rng.choice(open_features))
        threshold = float(rng.uniform(lows[f], highs[f]))
        goes_left = part[:, f] < threshold
        if not goes_left.any():
            goes_left = part[:, f] <= lows[f]
            threshold = float(np.nextafter(lows[f], highs[f]))
        nodes.append((node, f, threshold, next_id, next_id + 1, 0.0))
        todo.append((next_id, rows[goes_left], depth + 1))
        todo.append((next_id + 1, rows[~goes_left], depth + 1))
        next_id += 2
    return nodes


@dataclass
class Forest:
    """Node arrays of every tree (bounded by trees x nodes per tree)."""

    columns: list[str]
    per_tree: int
    trees: list[tuple[np.ndarray, ...]]

    def normality(self, x: np.ndarray) -> np.ndarray:
        """Minus the anomaly score 2^(-E[h]/c): higher is more normal."""
        depth = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, threshold, left, right, path in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                goes_left = x[every, np.maximum(f, 0)] < threshold[at]
                at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
            depth += path[at]
        mean = depth / max(1, len(self.trees))
        return -np.power(2.0, -mean / max(average_path(self.per_tree), 1e-12))


def fit_forest(df: DataFrame, keys, columns, n_trees: int = N_TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    """Grow the trees in parallel, one group of at most ``subsample`` rows per tree."""
    columns = list(columns)
    sample, per_tree = tree_sample(df, keys, columns, n_trees, subsample, seed)
    depth = max(1, math.ceil(math.log2(max(2, per_tree))))
    used = max(1, int(MAX_FEATURES * len(columns)))
    order = list(keys)

    def one_tree(key, rows):
        rng = np.random.default_rng([seed, int(key[0])])
        chosen = np.sort(rng.choice(len(columns), size=used, replace=False))
        x = rows.sort_values(order)[columns].to_numpy(dtype=float)
        nodes = pd.DataFrame(grow(x, rng, depth, chosen), columns=["node", "feature", "threshold", "left", "right", "path"])
        nodes.insert(0, "tree_id", int(key[0]))
        return nodes

    nodes = sample.groupBy("tree_id").applyInPandas(one_tree, NODE_SCHEMA).toPandas()
    trees = []
    for _, tree in nodes.sort_values(["tree_id", "node"]).groupby("tree_id"):
        trees.append(tuple(tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path")))
    return Forest(columns, per_tree, trees)


def score_forest(df: DataFrame, forest: Forest, output: str = "raw_score") -> DataFrame:
    """Raw score per row, batch-wise; higher is more normal."""
    shared = df.sparkSession.sparkContext.broadcast(forest)
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]

    def score(batches):
        model = shared.value
        for batch in batches:
            x = batch[model.columns].astype(float).to_numpy()
            yield batch.assign(**{output: model.normality(x) if len(batch) else np.zeros(0)})

    return df.mapInPandas(score, ", ".join(types) + f", `{output}` double")
