"""Exact Jaccard self-join of word n-gram sets by vertical partitioning.

The global n-gram order is that of the unsigned 64-bit shingle hashes, cut into ``FRAGMENTS`` equal ranges;
a document's set is one column a fragment, so that each step stores and reads the fragments it needs.

1. Equal sets become one node (128-bit code of the whole set).
2. Fragment by fragment, each node's shingles that no other node left in the race has are counted and
   summed. A node of size s can spare s - ceil(0.8 s) of them; with more it can have no partner and leaves.
   Different documents drop out after two or three of the fragments, near copies see all.
3. Of the nodes left, shingles are put in order of document frequency. Two similar sets share one of their
   rarest s - ceil(0.8 s) + 1, at places that leave room for the overlap they need (prefix and position).
4. Nodes with a common prefix shingle form a list. First the most central node of each list is compared
   with the others; then whatever is not yet connected within a list is compared pair by pair. Pairs
   already connected are never formed, so a group of near copies costs one pair a member.
5. A pair is compared fragment by fragment: partial overlaps are counted separately and summed per pair.

No sketch decides anything: candidates lose no pair of the given similarity, links rest on exact counts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, stage
from .common import ROW_KEY, numbered, row_key, shuffles_freed
from .components import components
from .simhash_dedup import SEED, _hashes

#: Words of a shingle, fragments of the order, rounds of central nodes; least similarity is FOUR_FIFTHS.
SHINGLE, FRAGMENTS, ROUNDS = 5, 8, 1
#: Fragments that one step looks at: first two, one by one, in which most texts drop out; the others of what is left.
FIRST, LATER = ((0,), (1,)), ((2, 3, 4), (5, 6, 7))
#: Similarity of 4/5: overlap >= 4/9 of both sizes together, size of the smaller >= 4/5 of the larger.
FOUR_FIFTHS = (4, 5)
#: Shingles of a record batch, about.
BATCH = 1 << 20
COLUMNS = [f"f{k}" for k in range(FRAGMENTS)]


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted different shingle hashes; a text of under ``k`` words is one shingle, one without words none."""
    found = [np.unique(h) for h in _hashes((text or "").encode(), k, SEED)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def least_of(size: Column) -> Column:
    """Overlap that a set needs with any partner: ceil(0.8 size)."""
    return F.ceil(size * FOUR_FIFTHS[0] / FOUR_FIFTHS[1]).cast("long")


def needed(one: Column, other: Column) -> Column:
    """Least overlap of two similar sets of these sizes, in whole numbers."""
    both = (one + other) * FOUR_FIFTHS[0]
    return F.floor((both + sum(FOUR_FIFTHS) - 1) / sum(FOUR_FIFTHS)).cast("long")


def fragment_sets(docs: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, sketch: Callable[[np.ndarray], int] | None = None,
                  fragments=range(FRAGMENTS)) -> DataFrame:
    """(_row, doc_id, code, size, f0, f1, ...): each row's different shingle hashes, a list for each of ``fragments``.

    Code and size are those of the whole set; with ``sketch``, so is fp, its value.
    """
    texts = docs.select(row_key(docs), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cuts = np.array([(i << 64) // FRAGMENTS for i in range(1, FRAGMENTS)], np.uint64)
    names = ["_row", "doc_id", "code", "size", *(COLUMNS[f] for f in fragments), *(["fp"] if sketch else [])]

    def packed(rows, ids, codes, sets):
        edges = np.array([[0, *np.searchsorted(s, cuts), len(s)] for s in sets], np.int64)
        lists = []
        for f in fragments:
            offsets = np.concatenate([[0], np.cumsum(edges[:, f + 1] - edges[:, f])]).astype(np.int32)
            values = np.concatenate([s[a:b] for s, a, b in zip(sets, edges[:, f], edges[:, f + 1])])
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))))
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(codes, pa.binary()),
                                           pa.array([len(s) for s in sets], pa.int64()), *lists,
                                           *([pa.array([sketch(s) for s in sets], pa.int64())] if sketch else [])], names)

    def run(batches):
        for b in batches:
            held, n = [], 0
            for row, doc, text in zip(b["_row"].to_pylist(), b["doc_id"].to_pylist(), b["text"]):
                s = shingle_set(text.as_py(), k)
                held.append((row, doc, xxhash.xxh3_128_digest(s.tobytes()), s))
                n += len(s)
                if n >= BATCH:
                    yield packed(*zip(*held))
                    held, n = [], 0
            if held:
                yield packed(*zip(*held))

    lists = ", ".join(f"{COLUMNS[f]} array<long>" for f in fragments)
    return texts.mapInArrow(run, f"_row long, doc_id long, code binary, size long, {lists}" + (", fp long" if sketch else ""))


def of_nodes(sets: DataFrame, alive: DataFrame, *columns: Column) -> DataFrame:
    """(node, ``columns``) of the nodes in ``alive``. Always a sort-merge join: the plan is the same at every size."""
    return sets.select(F.col("_row").alias("node"), *columns).join(alive.select("node").hint("merge"), "node", "left_semi")


def open_sets(sets: DataFrame, alive: DataFrame) -> DataFrame:
    """(node, fragment, shingles) of the nodes in ``alive``, written four fragments at a time: a step shuffles half of the sets."""
    steps = []
    for k in range(0, FRAGMENTS, 4):
        lists = F.array(*(F.struct(F.lit(i).alias("fragment"), F.col(COLUMNS[i]).alias("shingles")) for i in range(k, k + 4)))
        steps.append(stage(of_nodes(sets, alive, F.explode(lists).alias("f")).select("node", "f.*"), "open-sets"))
    return steps[0].sparkSession.read.schema(steps[0].schema).parquet(*(s.staged_at for s in steps))


def still_open(sets: DataFrame, alive: DataFrame, steps) -> DataFrame:
    """The nodes of ``alive`` (node, size, alone), a written table, that ``steps`` leave: at most a fifth of their shingles is theirs alone."""
    for step in steps:
        part = of_nodes(sets, alive, F.concat(*(F.col(COLUMNS[k]) for k in step)).alias("part"))
        held = part.select("node", F.explode("part").alias("shingle"))
        # one row a shingle after map-side combining, however many nodes hold it
        owners = held.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
        alone = owners.filter("n = 1").groupBy("node").agg(F.count("*").alias("more"))
        counted = alive.join(alone, "node", "left").select("node", "size", (F.col("alone") + F.coalesce("more", F.lit(0))).alias("alone"))
        alive = stage(counted.filter(F.col("alone") <= F.col("size") - least_of(F.col("size"))), "open-nodes")
    return alive


def open_nodes(docs: DataFrame, sets: DataFrame, heads: DataFrame, id_col: str, text_col: str, k: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(alive, parts): the nodes that may have a partner, and (node, fragment, shingles) of them.

    ``sets`` has the first fragments of all rows of the numbered table ``docs``; the sets of what these leave are made
    from the texts again, so that no copy of all shingles is ever stored.
    """
    start = stage(heads.select("node", "size", F.lit(0).cast("long").alias("alone")), "open-nodes")
    alive = still_open(sets, start, FIRST)
    again = docs.join(alive.select(F.col("node").alias(ROW_KEY)).hint("merge"), ROW_KEY, "left_semi")
    full = stage(fragment_sets(again, id_col, text_col, k), "open-fragment-sets")
    alive = still_open(full, alive, LATER).select("node", "size")
    parts = open_sets(full, alive)
    discard(full)
    return alive, parts


def prefix_lists(parts: DataFrame, alive: DataFrame) -> DataFrame:
    """(shingle, node, size, room, central): prefix places of each node in order of document frequency.

    ``room`` is the overlap still possible from this place on; ``central`` the mean frequency of the
    node's shingles, which is highest for the text that its near copies were made from.
    """
    held = parts.select("node", F.explode("shingles").alias("shingle"))
    often = stage(held.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "shingle-frequencies")
    ranked = held.join(often, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ranked"), F.sum("df").alias("total"))
    ranked = ranked.join(alive, "node").withColumn("alone", F.col("size") - F.size("ranked"))
    ranked = ranked.withColumn("length", F.col("size") - least_of(F.col("size")) + 1 - F.col("alone")).filter("length > 0")
    places = ranked.select("node", "size", "alone", (F.col("total") / F.col("size")).alias("central"),
                           F.posexplode(F.slice("ranked", F.lit(1), F.col("length").cast("int"))).alias("at", "place"))
    return places.select("place.shingle", "node", "size", (F.col("size") - F.col("alone") - F.col("at")).alias("room"), "central")


def _could_match(a: str, b: str) -> Column:
    least = needed(F.col(f"{a}.size"), F.col(f"{b}.size"))
    return (F.least(f"{a}.room", f"{b}.room") >= least) & (F.least(f"{a}.size", f"{b}.size") >= least_of(F.greatest(f"{a}.size", f"{b}.size")))


def similar_pairs(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b) of ``pairs`` (a, b, size_a, size_b) that are similar: partial overlaps a fragment, summed per pair."""
    one = parts.select(F.col("node").alias("a"), "fragment", F.col("shingles").alias("left")).hint("merge")
    other = parts.select(F.col("node").alias("b"), "fragment", F.col("shingles").alias("right")).hint("merge")
    met = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)))).join(one, ["a", "fragment"]).join(other, ["b", "fragment"])
    partial = met.select("a", "b", "size_a", "size_b", F.size(F.array_intersect("left", "right")).cast("long").alias("common"))
    whole = partial.groupBy("a", "b", "size_a", "size_b").agg(F.sum("common").alias("common"))
    return whole.filter(F.col("common") >= needed(F.col("size_a"), F.col("size_b"))).select("a", "b")


def _pairs(found: DataFrame) -> DataFrame:
    """Joined list entries x, y -> different pairs, written: their joins can then be split at hot nodes."""
    low = F.col("x.node") < F.col("y.node")
    pick = lambda c, first: F.when(low == first, F.col(f"x.{c}")).otherwise(F.col(f"y.{c}"))
    return stage(found.select(pick("node", F.lit(True)).alias("a"), pick("node", F.lit(False)).alias("b"), pick("size", F.lit(True)).alias("size_a"),
                              pick("size", F.lit(False)).alias("size_b")).distinct(), "candidate-pairs")


def _in_groups(lists: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, largest): list entries with the root of their group, and each list's largest group, where it has several."""
    roots = components(links)
    entries = stage(lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "list-entries")
    groups = entries.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    largest = groups.groupBy("shingle").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("groups")).filter("groups > 1")
    return entries, stage(largest.select("shingle", F.col("most.root").alias("most")), "open-lists")


def links_of(alive: DataFrame, parts: DataFrame, rounds: int = ROUNDS, proposed: DataFrame | None = None) -> DataFrame:
    """(a, b): similar nodes, enough of them to connect every two that any links connect.

    ``proposed`` are pairs (a, b, size_a, size_b) from elsewhere to compare first; they only save comparisons.
    """
    lists = stage(prefix_lists(parts, alive), "prefix-lists")

    head = F.max(F.struct("central", "node", "size", "room")).alias("head")
    first = stage(lists.groupBy("shingle").agg(head, F.count("*").alias("n")).filter("n > 1").select("shingle", "head.*"), "list-heads")
    met = lists.alias("x").join(first.alias("y"), "shingle").filter("x.node <> y.node").filter(_could_match("x", "y"))
    met = _pairs(met)
    if proposed is not None:
        known = stage(proposed.join(alive.select(F.col("node").alias("a")), "a", "left_semi").join(alive.select(F.col("node").alias("b")), "b", "left_semi")
                      .select("a", "b", "size_a", "size_b"), "proposed-pairs")
        met = stage(met.unionByName(known).distinct(), "candidate-pairs")
    links = stage(similar_pairs(met, parts), "links")
    for _ in range(rounds - 1):
        entries, largest = _in_groups(lists, links)
        rest = entries.join(largest, "shingle").filter("root <> most")
        heads_now = stage(rest.groupBy("shingle").agg(F.max(F.struct("central", "node", "size", "room", "root")).alias("head")).select("shingle", "head.*"), "list-heads")
        met = entries.alias("x").join(heads_now.alias("y"), "shingle").filter("x.root <> y.root").filter(_could_match("x", "y"))
        links = stage(links.unionByName(similar_pairs(_pairs(met), parts)), "links")
    entries, largest = _in_groups(lists, links)
    rest = stage(entries.join(largest, "shingle").filter("root <> most").drop("most"), "rest")
    met = entries.alias("x").join(rest.alias("y"), "shingle").filter("x.root <> y.root").filter(_could_match("x", "y"))
    links = stage(links.unionByName(similar_pairs(_pairs(met), parts)), "links")
    discard(lists, entries, rest)
    return links


def numbered_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` if it is numbered, else a numbered copy of its ids and texts; with the names of these columns."""
    if ROW_KEY in docs.columns:
        return docs, id_col, text_col
    return numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text"


def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, n_shingles, component_id.

    Two texts are linked if their sets of ``k``-word shingles (ASCII letters in lower case, words cut at ASCII
    white space) have a Jaccard similarity of 0.8 or more; a text of fewer words is one shingle. Texts without
    words (null, empty, spaces) have no shingle and no link: their component is their own id. ``component_id``
    is the smallest id reached over any number of links, null only where no id in reach is set. Repeated rows
    and equal sets are linked. Ids must be integers. Columns beyond id and text are not looked at.
    """
    with shuffles_freed(docs.sparkSession):
        docs, id_col, text_col = numbered_texts(docs, id_col, text_col)
        sets = stage(fragment_sets(docs, id_col, text_col, k, fragments=(0, 1)), "fragment-sets")
        rows = stage(sets.select("_row", "doc_id", "code", "size"), "set-rows")
        found = rows.filter("size > 0")
        heads = stage(found.groupBy("code").agg(F.min("_row").alias("node"), F.first("size").alias("size"), F.min("doc_id").alias("least")), "different-sets")
        alive, parts = open_nodes(docs, sets, heads, id_col, text_col, k)
        discard(sets)
        links = links_of(alive, parts, rounds)
        placed = heads.join(components(links), "node", "left").select("code", "least", F.coalesce("root", "node").alias("root"))
        least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        groups = stage(placed.join(least, "root").select("code", "component_id"), "set-groups")
    alone = rows.filter("size = 0").select("_row", "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.join(groups, "code").select("_row", "doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(alone)
