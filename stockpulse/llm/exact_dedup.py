"""Exact duplicates through an extendible-hash index on shared files, in DataFrame operations only.

1. Every text, less its white space, gets a 64-bit hash. Rows with the same hash *and the same bytes* are
   grouped: the grouping compares whole texts, and combines on the map side, so that a group of any
   size reaches the shuffle as one row a task.
2. Different texts with one hash are chained: the chain place tells them apart.
3. The entries (one a text) go to an extendible-hash index. Its directory is doubled until each slot
   points to a bucket of at most ``capacity`` entries; a bucket that fits earlier keeps its smaller
   local depth and is shared by several slots. Owner tasks write whole buckets, a hash range each.
4. A row finds its entry by the index: the first bits of its hash name a slot, the slot a bucket, and in the
   bucket it meets the entries of its hash; the best row of each entry stays.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from .common import keep_rows, numbered, row_key, without_spaces

#: Entries of a bucket, which one task writes.
CAPACITY = 100_000
#: Doublings beyond the even split: hashes are spread evenly, so a bucket that is over its capacity fits long before.
SPARE_DEPTH = 6


def depth_for(entries: int, capacity: int) -> int:
    """Bits of the hash that the directory may use: they grow with the entries."""
    return min(40, max(0, math.ceil(math.log2(max(entries, 1) / capacity))) + SPARE_DEPTH)


def directory(entries: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """One row for each slot in use: slot, depth (local depth of its bucket), bucket.

    Depth d reads the first d bits of the hash. A slot's bucket is the shallowest one with at most
    ``capacity`` entries, or at ``max_depth`` whatever is left.
    """
    slot = F.shiftrightunsigned("key", 64 - max_depth)
    slots = entries.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    doubled = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth))))
    doubled = doubled.withColumn("bucket", F.expr(f"shiftright(slot, {max_depth} - depth)"))
    filled = doubled.groupBy("depth", "bucket").agg(F.sum("n").alias("n"), F.collect_list("slot").alias("slots"))
    fits = filled.filter((F.col("n") <= capacity) | (F.col("depth") == max_depth))
    return (fits.select(F.explode("slots").alias("slot"), "depth", "bucket")
            .groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("b"))
            .select("slot", "b.depth", "b.bucket"))


def build_index(hashed: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame, int]:
    """(index, slots, depth): entries (depth, bucket, key, chain, text_sha256, group_size, longest), written by bucket
    to the shared folder, and the directory that leads to them.

    ``hashed`` has row, key, norm and n_points. ``chain`` numbers the texts of one hash from 0.
    """
    texts = hashed.groupBy("key", "norm").agg(F.count("*").alias("group_size"), F.max("n_points").alias("longest"),
                                              F.min("_row").alias("head"))
    entries = stage(texts.select("key", "group_size", "longest", "head", F.sha2("norm", 256).alias("text_sha256")), "entries")
    chained = entries.withColumn("chain", F.row_number().over(Window.partitionBy("key").orderBy("head")) - 1)
    depth = depth_for(entries.count(), capacity)
    slots = stage(directory(entries, capacity, depth), "directory")
    owned = with_bucket(chained, slots, depth)
    return stage(owned.repartition("depth", "bucket").sortWithinPartitions("depth", "bucket", "key"), "hash-index"), slots, depth


def with_bucket(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Rows with the bucket (depth, bucket) that the slot of their key points to."""
    return rows.withColumn("slot", F.shiftrightunsigned("key", 64 - depth)).join(slots, "slot").drop("slot")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: row key, doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty; empty and all-space texts are one group. Of a group, the row with the most
    code points stays, then the smallest id (null last), then the first of repeated rows. ``hash_bits``
    under 64 forces collisions, for tests.
    """
    raw = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), raw.alias("text"))
    norm = without_spaces(F.col("text"))
    full = F.xxhash64("norm")
    key = full if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(full, 64 - hash_bits), 64 - hash_bits)
    hashed = rows.select("_row", "doc_id", norm.alias("norm"), F.char_length("text").alias("n_points")).withColumn("key", key)
    slim = stage(hashed.select("_row", "doc_id", "n_points", "key", F.sha2("norm", 256).alias("text_sha256")), "rows")
    index, slots, depth = build_index(hashed, capacity)
    found = with_bucket(slim, slots, depth).join(index.drop("head"), ["depth", "bucket", "key", "text_sha256"])
    # written first: a join of two plain shuffles is one whose hot partitions Spark can split
    best = stage(found.filter(F.col("n_points") == F.col("longest")).groupBy("key", "chain")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("best"))
            .select("key", "chain", F.col("best.doc_id").alias("keep_id"), F.col("best._row").alias("keep_row")), "best-rows")
    return found.join(best, ["key", "chain"]).select(
        "_row", "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` less all but the best row of each group of equal texts; its columns are unchanged."""
    docs = numbered(docs)
    return keep_rows(docs, exact_groups(docs, id_col, text_col).filter("kept"))
