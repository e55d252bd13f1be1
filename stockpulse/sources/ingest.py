"""File feeds, each file taken exactly once.

New files arrive as micro-batches whose numbers the stream's checkpoint fixes. A batch writes its accepted and its
refused rows to folders that carry its number, then a commit file of that number; readers see committed batches
only. A job that dies before the commit is given the same files under the same number again and overwrites what it
had written, so no row is lost and none is there twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, stage
from .sinks import dedupe_latest

BROKEN = "_broken"


@dataclass(frozen=True)
class Feed:
    """What a feed delivers: columns, the key of a row, and rules that a good row meets (null counts as not met)."""

    name: str
    schema: str
    keys: tuple[str, ...]
    rules: dict[str, Callable[[], Column]] = field(default_factory=dict)
    date_column: str = "date"


POS = Feed("pos", "line_id string, sku_id string, region string, date date, sales_qty long, revenue_inr decimal(14,2), returns_qty long",
           ("line_id",), {"sku_id": lambda: F.length("sku_id").between(1, 20), "region": lambda: F.col("region").isNotNull(), "date": lambda: F.col("date").isNotNull(),
                          "sales_qty": lambda: F.col("sales_qty") >= 0, "revenue_inr": lambda: F.col("revenue_inr") >= 0})
COMPETITOR = Feed("competitor", "sku_id string, competitor string, date date, price_inr decimal(10,2)", ("sku_id", "competitor", "date"),
                  {"sku_id": lambda: F.length("sku_id").between(1, 20), "date": lambda: F.col("date").isNotNull(), "price_inr": lambda: F.col("price_inr") > 0})


def _split(rows: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused): refused rows keep all their columns as text, with the first rule they break."""
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("unreadable"))
    for name, rule in feed.rules.items():
        reason = reason.when(~F.coalesce(rule(), F.lit(False)), F.lit(name))
    marked = rows.withColumn("reason", reason)
    good = marked.filter("reason IS NULL").drop("reason", BROKEN)
    kept = [c for c in rows.columns if c not in (BROKEN, "file")]
    return good, marked.filter("reason IS NOT NULL").select("file", "reason", F.to_json(F.struct(*kept)).alias("row"), F.col(BROKEN).alias("line"))


def _one_a_key(good: DataFrame, feed: Feed) -> DataFrame:
    """One row a key: a file may repeat rows.

    Hashes of the keys are counted first. Only rows whose hash is there more than once are compared as a whole.
    """
    keyed = good.withColumn("_key", F.xxhash64(*feed.keys))
    often = stage(keyed.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key"), "repeated-keys")
    if often.isEmpty():
        return good
    several = keyed.join(often, "_key", "left_semi").drop("_key")
    once = keyed.join(often, "_key", "left_anti").drop("_key")
    return once.unionByName(dedupe_latest(several, list(feed.keys), [c for c in good.columns if c not in feed.keys]))


def ingest(spark: SparkSession, feed: Feed, source: str, target: str, kind: str = "csv", max_files: int | None = None,
           before_commit: Callable[[int], None] | None = None) -> dict:
    """Take all files of ``source`` that were not taken before; returns the batches, rows and refused rows of this run.

    ``before_commit`` is called between the writes of a batch and its commit (a hook for checks).
    """
    done = {"batches": 0, "rows": 0, "refused": 0}

    def take(batch: DataFrame, number: int) -> None:
        good, bad = _split(batch, feed)
        _one_a_key(good, feed).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/data/batch={number}")
        bad.write.mode("overwrite").parquet(f"{target}/refused/batch={number}")
        counts = {"rows": spark.read.parquet(f"{target}/data/batch={number}").count(), "refused": spark.read.parquet(f"{target}/refused/batch={number}").count()}
        if before_commit:
            before_commit(number)
        fs, where = file_system(spark, f"{target}/commits/{number}.json")
        out = fs.create(where, True)
        out.write(bytearray(json.dumps(counts).encode()))
        out.close()
        done["batches"] += 1
        done["rows"] += counts["rows"]
        done["refused"] += counts["refused"]

    reader = spark.readStream.format(kind).schema(f"{feed.schema}, {BROKEN} string").option("columnNameOfCorruptRecord", BROKEN).option("mode", "PERMISSIVE")
    if kind == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(source).withColumn("file", F.input_file_name())
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return done


def committed(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the committed batches, ascending."""
    fs, where = file_system(spark, f"{target}/commits")
    if not fs.exists(where):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(where) if s.getPath().getName().endswith(".json"))


def read_batches(spark: SparkSession, feed: Feed, target: str, after: int = -1) -> DataFrame:
    """Accepted rows of the committed batches after number ``after``, with their ``batch``."""
    paths = [f"{target}/data/batch={n}" for n in committed(spark, target) if n > after]
    schema = f"{feed.schema}, file string, batch int"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*paths)


def read_feed(spark: SparkSession, feed: Feed, target: str) -> DataFrame:
    """One row per key over all committed batches: a row that was delivered again counts as last delivered.

    A batch has one row a key, so its number decides alone, and columns that a caller does not use are not shuffled.
    """
    rows = read_batches(spark, feed, target).drop("file")
    others = [c for c in rows.columns if c not in ("batch", *feed.keys)]
    return rows.groupBy(*feed.keys).agg(*[F.max_by(c, "batch").alias(c) for c in others]).select(*[c for c in rows.columns if c != "batch"])


def read_refused(spark: SparkSession, target: str) -> DataFrame:
    """Refused rows of the committed batches: batch, file, reason, row, line."""
    paths = [f"{target}/refused/batch={n}" for n in committed(spark, target)]
    schema = "file string, reason string, row string, line string, batch int"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{target}/refused").parquet(*paths)


def touched_days(spark: SparkSession, feed: Feed, target: str, after: int = -1) -> DataFrame:
    """(date) of the days that batches after ``after`` delivered rows for, or took rows from by delivering them anew."""
    fresh = read_batches(spark, feed, target, after)
    days = fresh.select(F.col(feed.date_column).alias("date"))
    if after >= 0:
        moved = read_batches(spark, feed, target).filter(F.col("batch") <= after).join(fresh.select(*feed.keys), list(feed.keys), "left_semi")
        days = days.unionByName(moved.select(F.col(feed.date_column).alias("date")))
    return days.distinct()
