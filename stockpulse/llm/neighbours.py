"""Approximate nearest neighbours by inner product, over a forest of sorted hash strings.

Entries are set on a sphere (one more component makes their lengths equal, and is 0 in queries), so the
nearest by angle has the largest inner product. Every tree gives a vector a long string of hyperplane bits and keeps the strings
sorted, cut into cells by their first bits. A query descends to the longest prefix it shares in each tree
and looks at what is below; then it ascends in all trees at once. How far is set by the target recall: a
neighbour at the angle of the best candidates found so far shares a prefix of d bits in at least one of
T trees with probability 1 - (1 - p^d)^T, and the ascent ends at the deepest d that reaches the target.
Where that would be less than the least depth, or so little that all trees together are asked for the whole
table, or where too few candidates were found, it ends at depth 0 of one tree, whose cells hold every vector.
On clustered vectors that is deep; on vectors without structure every forest has to look at much of the
table, and this one does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage

#: Trees, bits of a hash string, the depth of the first look, the least depth, neighbours, target recall.
TREES, BITS, FIRST_DEPTH, LEAST_DEPTH, NEIGHBOURS, RECALL, SEED = 32, 24, 12, 3, 20, 0.97, 61
#: Vectors of a cell that meet in one task.
CELL = 8192


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors that are set, not zero, and finite in every component, in double precision."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))


def _hash(x: np.ndarray, longest: float | None, planes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, trees) hash strings as integers; of entries, set on a sphere of radius ``longest``, or of queries, with None."""
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(axis=1), 0)) if longest else np.zeros(len(x))
    side = np.concatenate([x, rest[:, None]], axis=1) @ planes > 0
    return side.reshape(len(x), -1, bits) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))


def _looked(k: int, bits: int):
    """Scores of a partition whose rows come sorted by cell, with queries after the vectors of their cell."""

    def run(batches):
        cell, data, asked = None, [], []

        def flush():
            if not data or not asked:
                return None
            data.sort(key=lambda r: r[0])
            strings = np.array([r[0] for r in data], np.int64)
            ids = np.array([r[1] for r in data], np.int64)
            x = np.stack([r[2] for r in data])
            out = []
            for string, query, q, depth in asked:
                low = string >> (bits - depth) << (bits - depth)
                a, b = np.searchsorted(strings, [low, low + (1 << (bits - depth))])
                if a == b:
                    continue
                s = (x[a:b] * q).sum(axis=1)  # row by row in one order: equal pairs have equal scores
                best = np.argpartition(-s, k - 1)[:k] if b - a > k else np.arange(b - a)
                best = np.flatnonzero(s >= s[best].min()) if b - a > k else best
                out += [(query, int(ids[a + i]), float(s[i])) for i in best]
            if out:
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query", "group", "score"])

        for batch in batches:
            values = np.asarray(batch["v"].flatten().to_numpy(zero_copy_only=False), float)
            width = len(values) // max(batch.num_rows, 1)
            x = values.reshape(batch.num_rows, width)
            tree, cells, salt, string, group, depth = (batch[c].to_pylist() for c in ("tree", "cell", "salt", "string", "group", "depth"))
            for i in range(batch.num_rows):
                key = (tree[i], cells[i], salt[i])
                if key != cell:
                    if (found := flush()) is not None:
                        yield found
                    cell, data, asked = key, [], []
                if depth[i] < 0:
                    data.append((string[i], group[i], x[i]))
                else:
                    asked.append((string[i], group[i], x[i], depth[i]))
        if (found := flush()) is not None:
            yield found

    return run


def _look(forest: DataFrame, sizes: DataFrame, queries: DataFrame, cell_bits: int, k: int, bits: int) -> DataFrame:
    """(query, group, score): per query, tree and cell the best ``k`` of the vectors below its node at ``depth``."""
    data = forest.select("tree", "cell", "string", "group", "v", F.lit(-1).alias("depth")).join(sizes, ["tree", "cell"])
    data = data.withColumn("salt", F.pmod(F.xxhash64("group"), F.col("salts")).cast("int")).drop("salts")
    span = F.expr(f"shiftleft(1L, greatest({cell_bits} - depth, 0))")  # cells below the node
    base = F.shiftright("string", bits - cell_bits)
    first = base - F.pmod(base, span)
    asked = queries.withColumn("cell", F.explode(F.sequence(first, first + span - 1))).join(sizes, ["tree", "cell"])
    asked = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("tree", "cell", "string", "group", "v", "depth", "salt")
    together = data.unionByName(asked.withColumn("depth", F.col("depth").cast("int"))).repartition("tree", "cell", "salt")
    return together.sortWithinPartitions("tree", "cell", "salt", "depth").mapInArrow(_looked(k, bits), "query long, group long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different groups of each query."""
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "group")
    return found.distinct().withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = NEIGHBOURS,
           trees: int = TREES, bits: int = BITS, first_depth: int = FIRST_DEPTH, least_depth: int = LEAST_DEPTH,
           recall: float = RECALL, cell: int = CELL, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by ``every``; a query's own row is no candidate, its copies
    are. Vectors that are null, zero or not finite take no part, nor do rows without an id. Equal vectors
    are one entry with its ``k`` + 1 smallest ids, which is all that ``k`` neighbours can need. Tables
    with vectors of different lengths raise an error; an empty table gives no rows.
    """
    good = usable(vectors, id_col, vector_col)
    keyed = good.withColumn("code", F.xxhash64("v"))
    nth = F.row_number().over(Window.partitionBy("code", "v").orderBy("vec_id"))
    ids = stage(keyed.withColumn("nth", nth).filter(F.col("nth") <= k + 1), "vector-ids")
    asked_ids = stage(keyed.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "code", "v"), "query-ids")
    entries = ids.filter("nth = 1").select(F.col("vec_id").alias("group"), "code", "v")
    bounds = entries.agg(F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b"), F.count("*").alias("n"),
                         F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("longest")).first()
    if bounds["n"] and bounds["a"] != bounds["b"]:
        raise ValueError("vectors of different lengths")
    width, longest = (bounds["a"] or 1), float(bounds["longest"] or 1.0)
    cell_bits = max(least_depth, min(bits - 1, int(np.ceil(np.log2(max(bounds["n"] / cell, 1))))))
    planes = np.random.default_rng(seed).standard_normal((width + 1, trees * bits))

    def strings(batches):
        for b in batches:
            x = np.asarray(b["v"].flatten().to_numpy(zero_copy_only=False), float).reshape(b.num_rows, width)
            found = [pa.array(list(_hash(x, r, planes, bits)), pa.list_(pa.int64())) for r in (longest, None)]
            yield pa.RecordBatch.from_arrays([b["group"], b["asked"], b["v"], *found], ["group", "asked", "v", "strings", "own"])

    # entries asked for: those with a query among all of their ids, not only the smallest ones
    wanted = asked_ids.select("code", "v").distinct().withColumn("asked", F.lit(True))
    marked = entries.join(wanted, ["code", "v"], "left").select("group", F.coalesce("asked", F.lit(False)).alias("asked"), "v")
    hashed = stage(marked.mapInArrow(strings, "group long, asked boolean, v array<double>, strings array<long>, own array<long>"), "hash-strings")
    forest = hashed.select("group", "v", F.posexplode("strings").alias("tree", "string")).withColumn("cell", F.shiftright("string", bits - cell_bits))
    sizes = forest.groupBy("tree", "cell").agg(F.ceil(F.count("*") / cell).cast("int").alias("salts"))
    sizes = stage(sizes, "forest-cells")
    queries = hashed.filter("asked").select("group", "v", F.posexplode("own").alias("tree", "string"))

    first = stage(_best(_look(forest, sizes, queries.withColumn("depth", F.lit(first_depth)), cell_bits, k + 1, bits), k + 1), "first-look")
    # the angle of the k-th candidate on the sphere; with fewer candidates the query ascends to depth 0
    kth = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    norms = hashed.filter("asked").select(F.col("group").alias("query"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm"))
    kth = kth.join(norms, "query")
    p = 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth") / (F.col("norm") * longest)))) / np.pi
    miss = 1 - (1 - recall) ** (1 / trees)  # one tree must find a neighbour with this probability
    depth = F.floor(F.log(F.lit(miss)) / F.log(F.least(p, F.lit(1 - 1e-9))))
    whole = max(least_depth, int(np.log2(trees)))  # below it, all trees together look at more than the table
    depth = F.when((F.col("n") > k) & (depth >= whole), F.least(F.lit(first_depth), depth)).otherwise(0)
    ascent = kth.select(F.col("query").alias("group"), depth.cast("int").alias("depth"))
    further = queries.join(ascent, "group", "left").withColumn("depth", F.coalesce("depth", F.lit(0))).filter(F.col("depth") < first_depth)
    further = further.filter((F.col("depth") > 0) | (F.col("tree") == F.pmod(F.xxhash64("group"), F.lit(trees))))  # at depth 0 one tree has all
    second = _look(forest, sizes, further, cell_bits, k + 1, bits)
    best = stage(_best(first.select("query", "group", "score").unionByName(second), k + 1), "nearest-groups")

    # from entries to rows: each candidate entry stands for its ids, each asked entry for its queries
    members = ids.join(entries.select("group", "code", "v"), ["code", "v"]).select("group", "vec_id")
    lists = best.select("query", "group", "score").join(members, "group").withColumn("place", F.row_number().over(
        Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("place") <= k + 1)
    lists = stage(lists.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list")), "nearest-lists")
    heads = asked_ids.join(entries, ["code", "v"]).select(F.col("vec_id").alias("query_id"), F.col("group").alias("query"))
    own = F.filter("list", lambda x: x["vec_id"] != F.col("query_id"))
    out = heads.join(lists, "query").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "near"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"), F.col("near.score").alias("score"))
