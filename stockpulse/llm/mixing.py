"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree; DataFrame operations only.

Each source is cut into blocks by a hash of its rows, and a seeded permutation orders the blocks. A mix
takes a source's blocks in that order, all of them once or twice and then a part, cut inside one block;
the row whose size comes nearest to what is missing then completes it. The exact block quotas of all sources are then split among output shards of
exact sizes: a binary tree over the sources, in which each node draws how the blocks of its left half fall
on the shards' free places (multivariate hypergeometric), so a level is one parallel step. Shards take
disjoint runs of a source's permuted blocks, and rows are permuted inside their shard by ``order_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import release, stage
from .common import ROW_KEY, numbered, row_key, word_count

#: Blocks of a source at most; a block has some rows of its source, however many there are.
BLOCKS = 1024
WEIGHTS, SHARE, CAP, SHARDS, SEED = (3, 1, 2), 1.5, 2.0, 8, 17


def drawn(u: str, good: str, bad: str, n: str) -> str:
    """The u-quantile of how many of ``n`` draws from good + bad are good, as one SQL expression of SQL expressions.

    Inverts the hypergeometric distribution over its support, or 12 deviations around the mode (the rest
    weighs under 1e-30). Ratios of neighbouring probabilities suffice, so no factorials are needed. A
    ``transform`` over an array of one value names what is used several times.
    """
    g, b, k = (f"cast(d.{c} AS double)" for c in ("good", "bad", "n"))
    total = f"({g} + {b})"
    ratio = f"({g} - x) * ({k} - x) / ((x + 1) * ({b} - {k} + x + 1))"
    mode = f"floor(({k} + 1) * ({g} + 1) / ({total} + 2))"
    wide = f"ceil(12 * sqrt(greatest({k} * {g} * {b} * ({total} - {k}), 0) / greatest({total} * {total} * ({total} - 1), 1))) + 12"
    mass = f"aggregate(steps, struct(1D AS p, 1D AS s), (a, x) -> struct(a.p * {ratio} AS p, a.s + a.p * {ratio} AS s), a -> a.s)"
    found = (f"aggregate(steps, struct(1D AS p, 1D AS s, r.low AS at), (a, x) -> struct(a.p * {ratio} AS p, a.s + a.p * {ratio} AS s, "
             "if(a.s < d.u * mass, x + 1, a.at) AS at), a -> a.at)")
    for name, value in (("mass", mass), ("steps", "if(r.high > r.low, sequence(r.low, r.high - 1), cast(array() AS array<bigint>))"),
                        ("r", "struct(greatest(d.n - d.bad, 0, m.mode - m.wide) AS low, least(d.n, d.good, m.mode + m.wide) AS high)"),
                        ("m", f"struct({mode} AS mode, {wide} AS wide)"), ("d", f"struct({u} AS u, {good} AS good, {bad} AS bad, {n} AS n)")):
        found = f"transform(array({value}), {name} -> {found})[0]"
    return found


def draw(df: DataFrame, name: str, u: str, good: str, bad: str, n: str) -> DataFrame:
    """Adds ``name``, the draw of each row."""
    return df.selectExpr("*", f"{drawn(u, good, bad, n)} AS {name}")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(index, quota), index from 0 without gaps -> (index, taken): array with the source's blocks for each shard.

    Shards hold equal numbers of blocks in all, at most one apart.
    """
    total, n = (int(x or 0) for x in quotas.agg(F.sum("quota"), F.count("*")).first())
    free = [total // shards + (i < total % shards) for i in range(shards)]
    nodes = quotas.sparkSession.range(1).select(F.col("id").alias("node"), F.lit(free).cast("array<long>").alias("free"))
    height = max(n - 1, 0).bit_length()
    for level in range(height):
        below = quotas.groupBy(F.shiftright("index", height - level - 1).alias("child")).agg(F.sum("quota").alias("quota"))
        left = below.filter("child % 2 = 0").select(F.shiftright("child", 1).alias("node"), F.col("quota").alias("left"))
        u = f"pmod(xxhash64({seed}, {level}, node, i), {1 << 52}) / {float(1 << 52)}D"
        taken = drawn(u, "free[i]", f"aggregate(slice(free, i + 2, {shards}), 0L, (a, x) -> a + x)", "s.left")
        # one expression for all shards, in turn, from the places that are still free: a copy for each makes plans the driver is slow to compile
        went = (f"aggregate(sequence(0, {shards - 1}), struct(left, cast(array() AS array<bigint>) AS went), (s, i) -> "
                f"transform(array({taken}), t -> struct(s.left - t AS left, concat(s.went, array(t)) AS went))[0], s -> s.went)")
        nodes = nodes.join(left, "node").selectExpr("node", "free", f"{went} AS went")
        other = F.zip_with("free", "went", lambda x, y: x - y)
        halves = F.explode(F.array(F.struct((2 * F.col("node")).alias("node"), F.col("went").alias("free")),
                                   F.struct((2 * F.col("node") + 1).alias("node"), other.alias("free"))))
        nodes = stage(nodes.select(halves.alias("half")).select("half.*"), "quota-tree")
    return nodes.select(F.col("node").alias("index"), F.col("free").alias("taken")).filter(F.col("index") < n)


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> adds index, weight and target.

    Sources in code-point order, null last, have the weights in turn. ``share`` of all sizes is dealt out
    by weight; no target is above ``cap`` times its source's size, and what is above is dealt again by
    weight among the others. With sources in the order of cap * size / weight, the capped ones are a
    prefix: the level of the others is the greatest of the levels after each prefix. One row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    s = sizes.withColumn("index", F.row_number().over(order).cast("long") - 1)
    s = s.withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("index") % len(weights) + 1).cast("int")).cast("double"))
    s = s.withColumn("most", cap * F.col("source_size"))
    w = Window.orderBy(F.col("most") / F.col("weight"), "index")
    before, everything = w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    parts = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / parts).withColumn("level", F.max("level").over(everything))
    return s.select("source", "source_size", "index", "weight", F.least("most", F.col("weight") * F.col("level")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", share: float = SHARE,
        cap: float = CAP, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, source, size, source_size, target, copies, shards, order_key.

    Size is the number of words; a null text has none. ``shards`` names the output shard of each copy. The
    choice depends on id, text and seed, not on the order of rows; repeated rows are told apart by place.
    Rows of size 0 are taken with their block. An empty table gives no rows.
    """
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"))
    slim = stage(rows.select("_row", "doc_id", "source", word_count(F.col("text")).alias("size"),
                             F.xxhash64(F.lit(seed), "doc_id", "text").alias("order_key")), "mix-rows")
    slim = slim.withColumn("block", F.pmod(F.xxhash64("order_key"), F.lit(blocks)).cast("int"))
    in_block = slim.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    sources = stage(targets(in_block.groupBy("source").agg(F.sum("block_size").alias("source_size")), share, cap, weights), "mix-targets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sources = sources.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))

    permuted = Window.partitionBy("index").orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block")
    b = in_block.join(sources, in_block["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    b = b.withColumn("place", F.row_number().over(permuted).cast("long") - 1)
    b = b.withColumn("room", F.col("rest") - F.coalesce(F.sum("block_size").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    b = b.withColumn("in_rest", (F.col("room") > 0).cast("int"))
    b = b.withColumn("n_blocks", F.count("*").over(Window.partitionBy("index")))
    b = stage(b, "mix-blocks")
    quotas = b.groupBy("index").agg((F.max(F.col("passes") * F.col("n_blocks")) + F.sum("in_rest")).alias("quota"))
    dealt = split_quotas(quotas, shards, seed)
    release(docs.sparkSession)
    runs = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda i: F.aggregate(F.slice(F.col("taken"), F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x))
    b = b.join(dealt.select("index", runs.alias("ends")), "index")
    uses = F.transform(F.sequence(F.lit(0), F.col("passes") + F.col("in_rest") - 1), lambda p: p * F.col("n_blocks") + F.col("place"))
    uses = F.when(F.col("passes") + F.col("in_rest") > 0, uses).otherwise(F.array().cast("array<long>"))
    b = b.withColumn("shards", F.transform(uses, lambda u: F.size(F.filter("ends", lambda e: e <= u))))
    b = stage(b.select("source", "block", "source_size", "target", "passes", "block_size", "room", "shards"), "mix-shards")

    within = Window.partitionBy("source", "block").orderBy("order_key", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(b.withColumnRenamed("source", "of"), placed["source"].eqNullSafe(F.col("of")) & (placed["block"] == b["block"])).drop(b["block"])
    fits = (F.col("block_size") <= F.col("room")) | (F.col("ahead") + F.col("size") <= F.col("room"))
    placed = placed.withColumn("in_part", (F.col("room") > 0) & fits)
    placed = stage(placed.select("_row", "doc_id", "source", "size", "source_size", "target", "passes", "shards", "order_key", "in_part"), "mix-placed")

    # the row not in the part whose size comes nearest to what its source still lacks, if that is an improvement
    part = F.coalesce(F.sum(F.when(F.col("in_part"), F.col("size"))), F.lit(0))
    lack = placed.groupBy("source").agg((F.first("target") - F.first("passes") * F.first("source_size") - part).alias("lack"))
    last = b.filter("room > 0 AND block_size > room").select(F.col("source").alias("of"), F.element_at("shards", -1).alias("cut_shard"))
    lack = lack.join(last, lack["source"].eqNullSafe(F.col("of"))).select("of", "lack", "cut_shard")
    near = F.abs(F.col("lack") - F.col("size"))
    extra = placed.filter("NOT in_part AND size > 0").join(lack, placed["source"].eqNullSafe(F.col("of"))).filter(near < F.col("lack"))
    extra = extra.groupBy("source").agg(F.min(F.struct(near.alias("near"), "order_key", "_row")).alias("best"), F.first("cut_shard").alias("cut_shard"))
    extra = extra.select(F.col("best._row").alias("chosen"), "cut_shard")
    out = placed.join(extra, placed["_row"] == F.col("chosen"), "left")
    copies = F.col("passes") + (F.col("in_part") | F.col("chosen").isNotNull()).cast("int")
    own = F.slice("shards", F.lit(1), F.col("passes") + F.col("in_part").cast("int"))
    return out.select("_row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      F.when(F.col("chosen").isNull(), own).otherwise(F.concat(own, F.array("cut_shard"))).alias("shards"), "order_key")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: a row taken twice is there twice."""
    docs = numbered(docs)
    uses = mix(docs, **options).filter("copies > 0").select(F.col("_row").alias(ROW_KEY), F.explode("shards").alias("_shard"))
    return docs.join(uses.select(ROW_KEY), ROW_KEY).drop(ROW_KEY)
