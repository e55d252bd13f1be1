"""Checks for keys, nulls, references and domains, and a report that can fail a job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COLUMN_DEFAULTS


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def null_counts(df: DataFrame, columns) -> DataFrame:
    """One row per column with its null count, in one pass over the data."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    return counted.select(F.explode(pairs).alias("p")).select("p.*")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key is not in the parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def domain_violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows breaking a CHECK rule; like SQL, a null outcome passes."""
    return df.filter(~F.coalesce(rule, F.lit(True)))


def max_length(column: str, n: int) -> Column:
    return F.length(column) <= n


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Declared defaults for missing values."""
    return df.na.fill({c: v for c, v in COLUMN_DEFAULTS.get(table, {}).items() if c in df.columns})


def check_row(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check with its number of failing rows."""
    return reduce(DataFrame.unionByName, [check_row(n, d) for n, d in checks.items()])


def enforce(result: DataFrame) -> None:
    """Raise when any check failed. The report has one row per check."""
    failed = [f"{r.check_name}: {r.failures}" for r in result.filter("failures > 0").collect()]
    if failed:
        raise ValueError("data checks failed: " + ", ".join(failed))
