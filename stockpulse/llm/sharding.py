"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Law ``rows``: shard sizes are at most one row apart. The number of rows that each input partition sends to
each shard is drawn exactly (multivariate hypergeometric, one row of the matrix after the other). A
partition permutes its rows and cuts them by its row of the matrix; after the exchange each shard is
permuted again. The matrix has one row a partition, so the driver sees no data.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from .common import byte_length, row_key

SHARDS, SEED = 8, 53
#: Rows of a shard that one task permutes, on average.
LOCAL_ROWS = 500_000


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws from good + bad are good: inversion that starts at the mode and goes outward."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    lg = math.lgamma
    log_p = (lg(good + 1) - lg(mode + 1) - lg(good - mode + 1) + lg(bad + 1) - lg(n - mode + 1) - lg(bad - n + mode + 1)
             - lg(good + bad + 1) + lg(n + 1) + lg(good + bad - n + 1))
    u, up, down, a, b = rng.random() - math.exp(log_p), math.exp(log_p), math.exp(log_p), mode, mode
    while u > 0 and (a > low or b < high):
        if b < high:
            up *= (good - b) * (n - b) / ((b + 1) * (bad - n + b + 1))
            b += 1
            u -= up
            if u <= 0:
                return b
        if a > low:
            down *= a * (bad - n + a) / ((good - a + 1) * (n - a + 1))
            a -= 1
            u -= down
            if u <= 0:
                return a
        if up < 1e-18 and down < 1e-18:
            break
    return mode


def matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard; rows sum to ``counts``, columns differ by one at most."""
    rng, total = random.Random(seed), sum(counts)
    free = [total // shards + (i < total % shards) for i in range(shards)]
    out = []
    for n in counts:
        left, others, row = n, sum(free), []
        for room in free:
            others -= room
            row.append(hypergeometric(rng, room, others, left))
            left -= row[-1]
        free = [f - x for f, x in zip(free, row)]
        out.append(row)
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED,
          local_rows: int = LOCAL_ROWS) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot.

    Slots are 0, 1, ... in every shard. A null text has size 1 and the checksum of an empty one. Rows that
    are alike are placed one by one; an empty table gives no rows. The same files, settings and seed give
    the same shuffle.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), (byte_length(text) + 1).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    slim = stage(rows.withColumn("part", F.shiftright("_row", 33)), "shard-rows")
    counts = {r["part"]: r["n"] for r in slim.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row a partition
    parts = sorted(counts)
    drawn = matrix([counts[p] for p in parts], shards, seed)
    ends = [(p, [sum(row[:i + 1]) for i in range(shards)]) for p, row in zip(parts, drawn)]
    sent = docs.sparkSession.createDataFrame(ends, "part long, ends array<long>")

    first = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "_row"), "_row")) - 1
    dealt = slim.withColumn("at", first).join(sent, "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("at")))).drop("ends", "at", "part")

    # the second permutation: a random order cut into parts small enough for a task, then numbered inside them
    cuts = max(1, -(-sum(counts.values()) // (shards * local_rows)))
    dealt = dealt.withColumn("order", F.xxhash64(F.lit(seed + 1), "_row"))
    dealt = dealt.withColumn("cut", F.pmod(F.shiftright("order", 20), F.lit(cuts)))
    dealt = stage(dealt, "shard-dealt")
    before = Window.partitionBy("shard").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "cut").agg(F.count("*").alias("n")).select("shard", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "cut").orderBy("order", "_row")) - 1
    placed = dealt.withColumn("inside", inside).join(starts, ["shard", "cut"])
    return placed.select("_row", "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("start") + F.col("inside")).cast("long").alias("slot"))
