"""Merkle manifest of a dataset as content-addressed records.

Rows are leaves. Per language the leaves stand in order of id; every eight consecutive nodes become one, until
one is left, and the subroots of the languages are joined likewise into the root. What is stored are records
*digest -> digests of the children*; nothing refers to a place.

A proof is found by descent: from the root, by the digits of a leaf's rank in base eight, collecting the
children not chosen at each step; reversed, these segments lead from the leaf to the root. Requests that share
a way share its rows, so a step joins one row per visited node with its record and no digest is hot. Ranks come
from a range-partitioned write and one count per partition, never from a window over a language.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage

FANOUT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Every third document, by the CRC of its id, is checked against a text in lower case.
TAMPERED_ONE_IN = 3


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*inputs), 256)


def leaf_digest(**fields: Column) -> Column:
    """SHA-256 of the fields, each as byte count, colon and value, or a dash if null."""
    texts = [fields[f].cast("string") for f in FIELDS]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, tampered): ``tampered`` is the leaf of the altered row where that row is altered."""
    own = {f: F.col(f) for f in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(F.col("lang").cast("string").alias("lang"), "doc_id", leaf_digest(**own).alias("leaf"),
                       F.when(chosen, leaf_digest(**{**own, "text": lowered})).alias("tampered"))


def ranked(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``rank`` from 0 within its group by ``order`` (nulls first) and ``n``, the group's rows.

    Rows are dealt by ranges of (group, order) and written with their place; a count for each range and
    group gives where it starts. The only unpartitioned window is over one row a range.
    """
    dealt = nodes.withColumn("_spread", F.monotonically_increasing_id())  # equal rows need not share a range
    keys = [group, *order, "_spread"]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("_range", F.shiftright("_place", 33)).drop("_spread"), "dealt-by-range")
    runs = dealt.groupBy("_range", group).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy(group).orderBy("_range")
    runs = runs.withColumn("_start", F.sum("_n").over(before) - F.col("_n")).withColumn("n", F.sum("_n").over(Window.partitionBy(group)))
    runs = stage(runs.withColumnRenamed(group, "_group").withColumnRenamed("_range", "_of"), "ranges")
    joined = dealt.join(runs, (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("rank", F.col("_start") + F.col("_place") - F.col("_first")).select(*nodes.columns, "rank", "n")


def build(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, rank, n, digest) -> (records, roots).

    Records: tree, level (1 above the leaves), rank, digest, children. Roots: tree, digest, n, depth. A tree of one
    node is its own root, of depth 0. ``tree`` is not null.
    """
    roots, records, level = nodes.filter("n = 1").select("tree", "digest", "n", F.lit(0).alias("depth")), [], 0
    left = nodes.filter("n > 1")
    while not left.isEmpty():
        level += 1
        run = F.array_sort(F.collect_list(F.struct((F.col("rank") % FANOUT).cast("int").alias("at"), "digest")))
        above = left.groupBy("tree", F.floor(F.col("rank") / FANOUT).alias("rank"), F.ceil(F.col("n") / FANOUT).alias("n")).agg(F.transform(run, lambda c: c["digest"]).alias("children"))
        above = stage(above.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "records")
        records.append(above.select("tree", F.lit(level).alias("level"), "rank", "digest", "children"))
        roots = roots.unionByName(above.filter("n = 1").select("tree", "digest", "n", F.lit(level).alias("depth")))
        left = above.filter("n > 1").select("tree", "rank", "n", "digest")
    empty = nodes.limit(0).select("tree", F.lit(0).alias("level"), "rank", "digest", F.array("digest").alias("children"))
    for r in records:
        empty = empty.unionByName(r)
    return empty, roots


def descend(starts: DataFrame, records: DataFrame, wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """From (tree, depth, digest, proof) follow the records down -> (parents, single).

    ``parents`` are the nodes just above the leaves: tree, rank, children, proof; ``single`` the trees of one leaf.
    ``proof`` has one segment (place, siblings) a step, root first. With ``wanted`` (tree, rank of leaves), only
    the ways to these leaves are followed.
    """
    front, parents = starts.withColumn("rank", F.lit(0).cast("long")), None
    single = front.filter("depth = 0")
    deepest = starts.agg(F.max("depth")).first()[0] or 0
    for depth in range(deepest, 0, -1):
        # equal digests have equal children: one record each
        store = records.filter(F.col("level") == depth).groupBy("digest").agg(F.first("children").alias("children"))
        here = front.filter(F.col("depth") == depth).join(store, "digest")
        if depth == 1:
            parents = here.select("tree", "rank", "children", "proof")
            break
        child = here.select("tree", (F.col("depth") - 1).alias("depth"), "rank", "children", "proof", F.posexplode("children").alias("at", "chosen"))
        segment = F.struct("at", F.filter("children", lambda c, i: i != F.col("at")).alias("siblings"))
        child = child.select("tree", "depth", F.col("chosen").alias("digest"), F.concat("proof", F.array(segment)).alias("proof"), (F.col("rank") * FANOUT + F.col("at")).alias("rank"))
        if wanted is not None:
            ways = wanted.select("tree", F.floor(F.col("rank") / FANOUT ** (depth - 1)).alias("rank")).distinct()
            child = child.join(ways, ["tree", "rank"], "left_semi")
        front = stage(front.filter(F.col("depth") < depth).select(*child.columns).unionByName(child), "descent")
    if parents is None:
        parents = front.filter("false").select("tree", "rank", F.array("digest").alias("children"), "proof")
    return parents, single


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its proof (leaf first) lead to."""
    step = lambda acc, s: F.sha2(F.concat(F.array_join(F.slice(s["siblings"], F.lit(1), s["at"]), ""), acc,
                                          F.array_join(F.slice(s["siblings"], s["at"] + 1, F.lit(FANOUT)), "")), 256)
    return F.aggregate(proof, leaf, step)


def _below(parents: DataFrame, single: DataFrame, leaves: DataFrame) -> DataFrame:
    """Leaves (tree, rank, ...) met with their parents' rows: their columns and ``proof``, root first."""
    rest = [c for c in leaves.columns if c not in ("tree", "rank")]
    # eight leaves at most travel as one row to their parent, whose proof they share
    runs = leaves.groupBy("tree", F.floor(F.col("rank") / FANOUT).alias("rank")).agg(F.collect_list(F.struct((F.col("rank") % FANOUT).cast("int").alias("at"), *rest)).alias("run"))
    met = parents.join(runs, ["tree", "rank"]).select("tree", "rank", "children", "proof", F.explode("run").alias("leaf_"))
    segment = F.struct(F.col("leaf_.at").alias("at"), F.filter("children", lambda c, i: i != F.col("leaf_.at")).alias("siblings"))
    met = met.select("tree", (F.col("rank") * FANOUT + F.col("leaf_.at")).alias("rank"), *(F.col(f"leaf_.{c}").alias(c) for c in rest),
                     F.concat("proof", F.array(segment)).alias("proof"))
    return met.unionByName(leaves.join(single.select("tree", "proof"), "tree").select(*met.columns))


class Manifest:
    """Records, trees and placed leaves of ``docs`` (doc_id, source, lang, n_chars, text; more columns are ignored).

    Languages are trees, null first, then by bytes; leaves stand by id (null first), of one id by digest.
    Repeated rows are leaves of their own. An empty table has no root and no rows.
    """

    def __init__(self, docs: DataFrame):
        placed = ranked(stage(leaves_of(docs), "leaves"), "lang", ["doc_id", "leaf"])
        placed = stage(placed, "placed-leaves")
        sizes = placed.groupBy("lang").agg(F.first("n").alias("n"))
        langs = ranked(sizes.select(F.lit(0).alias("all"), "lang"), "all", ["lang"])
        langs = stage(langs.select(F.col("lang").alias("tree_lang"), F.col("rank").alias("tree"), F.col("n").alias("langs")), "languages")
        self.leaves = stage(placed.join(langs, F.col("lang").eqNullSafe(F.col("tree_lang"))).drop("tree_lang", "langs"), "leaves-by-tree")
        self.records, subroots = build(self.leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")))
        self.subroots = stage(subroots, "subroots")
        top = self.subroots.join(langs, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("langs").alias("n"), "digest")
        self.top_records, root = build(stage(top, "top-leaves"))
        self.root = root.select("tree", "depth", "digest")

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """Columns of ``leaves`` and subroot, root, proof (leaf first) of all leaves, or of ``wanted`` (tree, rank)."""
        none = F.expr("cast(array() as array<struct<at: int, siblings: array<string>>>)")
        root = self.root.first()
        starts = self.root.select("tree", "depth", "digest", none.alias("proof"))
        trees = None if wanted is None else wanted.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
        subroots = stage(self.subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "depth", "digest"), "subroot-leaves")
        tops = _below(*descend(starts, self.top_records, trees), subroots)
        starts = stage(tops.select(F.col("rank").alias("tree"), "depth", "digest", "proof"), "subroot-proofs")
        leaves = self.leaves if wanted is None else self.leaves.join(wanted.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
        found = _below(*descend(starts, self.records, wanted), leaves)
        names = starts.select("tree", F.col("digest").alias("subroot"))
        return found.join(names, "tree").select(*self.leaves.columns, "subroot", F.lit(root.digest if root else None).cast("string").alias("root"), F.reverse("proof").alias("proof"))


def verified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is recomputed from the altered leaf, where the row is altered, and the siblings of the proof;
    rows without id are never altered.
    """
    found = Manifest(docs).proofs()
    siblings = F.flatten(F.transform("proof", lambda s: s["siblings"]))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
