"""Column expressions and small helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import release, stage

#: ASCII white space, \x20 and \x09-\x0D; nothing else counts as space in these operators.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
WORD = r"[^\x20\x09-\x0D]+"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Column that carries the row key of a numbered table.
ROW_KEY = "_stockpulse_row"


def _plain_scan(docs: DataFrame) -> bool:
    """True for Parquet files as read, with nothing in between that could repeat or mix rows."""
    plan = docs._jdf.queryExecution().analyzed()
    return plan.getClass().getSimpleName() == "LogicalRelation" and "parquet" in plan.relation().toString().lower()


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` (or ``columns`` of it) with a row key beside each row that is the same in every evaluation.

    Rows that are alike in every column stay apart. A row of Parquet files is known by its file, whose number is
    taken from a written list, and its place in it. Any other table is numbered once into a copy in the shared folder:
    places in a scan depend on the cores at hand, so a second numbering could give other keys. ``ROW_KEY`` is not a
    name for columns of one's own; a table that has it is taken as numbered already.
    """
    if ROW_KEY in docs.columns:
        return docs
    chosen = list(columns) or [F.col(f"`{c}`") for c in docs.columns]
    if not _plain_scan(docs):
        return stage(docs.select(*chosen).withColumn(ROW_KEY, F.monotonically_increasing_id()), "numbered")
    path, place = F.col("_metadata.file_path").alias(f"{ROW_KEY}_file"), F.col("_metadata.row_index").alias(f"{ROW_KEY}_place")
    files = docs.select(path).distinct().withColumn(ROW_KEY, F.row_number().over(Window.orderBy(f"{ROW_KEY}_file")).cast("long"))
    # one row a file: Spark's own list of these files, with their sizes, is on the driver too
    keyed = docs.select(*chosen, path, place).join(F.broadcast(stage(files, "files")), f"{ROW_KEY}_file")
    return keyed.withColumn(ROW_KEY, F.shiftleft(ROW_KEY, 40) + F.col(f"{ROW_KEY}_place")).drop(f"{ROW_KEY}_file", f"{ROW_KEY}_place")


def row_key(docs: DataFrame) -> Column:
    """The stored key of a numbered table as ``_row``; of any other, a key that holds for one written pass only."""
    return (F.col(ROW_KEY) if ROW_KEY in docs.columns else F.monotonically_increasing_id()).alias("_row")


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of a numbered table whose key is in ``kept`` (_row), without the key."""
    return docs.join(kept.select(F.col("_row").alias(ROW_KEY)), ROW_KEY, "left_semi").drop(ROW_KEY)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files go as soon as the table they were made for is written; every step here ends in one."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)
        release(spark)


def without_spaces(text: Column) -> Column:
    """``text`` less every ASCII white-space character."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def process_cache() -> dict:
    """A dict that lives as long as the Python worker: what is loaded once serves all its tasks."""
    return sys.modules.setdefault("_stockpulse_process_cache", types.ModuleType("_stockpulse_process_cache")).__dict__
