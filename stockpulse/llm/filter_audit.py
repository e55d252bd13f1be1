"""Audit of how filters interact when they run in any order.

A document's failures are a bit mask. Which step of an order removes it is a min-plus product: over the
filters, mask (0 where it fails, infinite where it passes) plus the filter's place in the order, combined by
minimum. That gives one table of 32 masks x 120 orders, whatever the input. The corpus is reduced to counts
per part and mask (map-side combining, so a hot part reaches the shuffle as at most 32 rows a task), and the
removal steps scatter these counts to their orders and steps.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: The audited filters, and limits of the failure conditions.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, "[#$%&*|]"
FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def removal_steps(filters: str = FILTERS) -> tuple[list[str], np.ndarray]:
    """(orders, steps): ``steps[mask, order]`` is the 1-based step that removes the mask, or one past the last."""
    n = len(filters)
    orders = list(permutations(range(n)))
    place = np.argsort(np.array(orders), axis=1).T + 1  # filters x orders: the inverse permutations
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1  # masks x filters
    cost = np.where(fails == 1, 0, n + 1)
    steps = np.minimum((cost[:, :, None] + place[None, :, :]).min(axis=1), n + 1)
    return ["".join(filters[i] for i in o) for o in orders], steps


def failure_mask(text: Column, copy: Column) -> Column:
    """Bit i is set where the document fails filter i; ``copy`` tells whether it fails E."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.char_length(text),
             text.rlike(SYMBOLS), copy]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, part, mask, good, toxic.

    A null text is empty and a null part is the empty string. A row fails E if a row with a smaller id has the
    same text; rows with one id, and rows without id, are no copies of each other. A document is good or toxic if
    any of its label rows says so; label rows without id, and flags that are null, say nothing.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    scanned = rows.select("doc_id", "part", failure_mask(F.col("text"), F.lit(False)).alias("mask"), F.sha2("text", 256).alias("digest"))
    scanned = stage(scanned, "filter-masks")
    # written first: a join of two plain shuffles is one whose hot partitions Spark can split
    firsts = stage(scanned.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1").select("digest", "first"), "first-copies")
    flags = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"), F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    found = scanned.join(firsts, "digest", "left").join(flags, "doc_id", "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    return found.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"),
                        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def _scatter(batches):
    """Counts of one part a row, by mask -> a row for each order and step."""
    orders, steps = removal_steps()
    n = len(FILTERS)
    at = np.arange(1, n + 1)
    here = steps[:, :, None] == at  # masks x orders x steps
    chosen = np.array([[FILTERS.index(c) for c in o] for o in orders])  # orders x steps
    fails = ((np.arange(1 << n)[:, None, None] >> chosen) & 1).astype(bool)
    earlier = fails & (steps[:, :, None] < at)
    only = np.arange(1 << n)[:, None, None] == (1 << chosen)
    later = steps[:, :, None] > at
    by = {"kept": later, "removed": here, "redundant": earlier, "unique_fails": only}
    by = {k: v.reshape(1 << n, -1).astype(np.int64) for k, v in by.items()}
    size = len(orders) * n
    for b in batches:
        counts = {c: np.array(b[c].to_pylist(), np.int64).reshape(-1, 1 << n) for c in ("all", "good", "toxic")}
        found = {k: counts["all"] @ v for k, v in by.items()}
        found["good_lost"], found["toxic_lost"] = counts["good"] @ by["removed"], counts["toxic"] @ by["removed"]
        share = np.zeros((len(counts["all"]), n), np.int64)
        np.add.at(share, (slice(None), chosen.ravel()), found["removed"])
        found["shapley"] = share[:, chosen.ravel()]
        for i, part in enumerate(b["part"].to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * size), pa.array([o for o in orders for _ in at]), pa.array(np.tile(at, len(orders)).astype(np.int32)), *(pa.array(found[f][i]) for f in FIGURES)],
                ["part", "filter_order", "step", *FIGURES])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, zeros included: the counts of ``FIGURES``.

    Parts are those of ``docs``; an empty table has none and returns no row. Nulls as in :func:`masks`.
    """
    counted = masks(docs, labels, id_col, text_col, part_col).groupBy("part", "mask").agg(
        F.count("*").alias("all"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    of_mask = F.map_from_entries(F.collect_list(F.struct("mask", F.struct("all", "good", "toxic"))))  # at most 32 masks a part
    every = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    in_order = lambda c: F.transform(every, lambda i: F.coalesce(F.col("m")[i][c], F.lit(0).cast("long"))).alias(c)
    lists = counted.groupBy("part").agg(of_mask.alias("m")).select("part", *map(in_order, ("all", "good", "toxic")))
    figures = ", ".join(f"{f} long" for f in FIGURES)
    return lists.mapInArrow(_scatter, f"part string, filter_order string, step int, {figures}")
