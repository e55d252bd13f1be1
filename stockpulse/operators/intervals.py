"""Joins of days with intervals of days, by dyadic blocks.

A block (level, block) is the run of 2^level days whose day numbers share ``day >> level``. Every interval is the
disjoint union of at most two blocks a level, and a day lies in one block of each level: a day inside an interval
meets exactly one of its blocks. The range condition becomes an equi-join on (level, block), and an interval costs
rows by the logarithm of its length, not by its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The last day that Spark's dates print with four digits, 9999-12-31, has a number under 2^22.
LEVELS = 23


def cover(first, last) -> Column:
    """Blocks (level, block) that together hold each day from ``first`` to ``last`` once; none if the interval is empty or a bound is null.

    At each level what is left runs from ceil(first / 2^level) to floor((last + 1) / 2^level), the end left out.
    An odd start or an odd end does not fit a block twice as long and is given out here.
    """
    def day(c) -> Column:
        return F.unix_date(F.col(c) if isinstance(c, str) else c).cast("long")

    def at(level: Column) -> Column:
        round_up = F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1
        low = F.call_function("shiftright", day(first) + round_up, level)
        high = F.call_function("shiftright", day(last) + 1, level)

        def block(number: Column, odd: Column) -> Column:
            return F.when((low < high) & (odd.bitwiseAND(F.lit(1)) == 1), F.struct(level.alias("level"), number.alias("block")))

        return F.array(block(low, low), block(high - 1, high))

    # one lambda over the levels keeps the plan short
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), at)))


def with_blocks(intervals: DataFrame, first, last) -> DataFrame:
    """``intervals`` once per block of their cover, with ``level`` and ``block``."""
    return intervals.withColumn("_block", F.explode(cover(first, last))).select("*", "_block.level", "_block.block").drop("_block")


def days_in(facts: DataFrame, blocks: DataFrame, *keys: str, day: str = "date") -> DataFrame:
    """Rows of ``facts`` joined with each interval that their day lies in, equal ``keys`` given.

    ``blocks`` comes from :func:`with_blocks`. A fact is repeated for the levels that occur there, 23 at most, and
    joined by equality; a null day lies in no interval.
    """
    levels = blocks.agg(F.array_sort(F.collect_set("level")).alias("levels")).scalar()
    placed = facts.withColumn("level", F.explode(levels)).withColumn("block", F.expr(f"shiftright(cast(unix_date({day}) AS bigint), level)"))
    return placed.join(blocks, ["level", "block", *keys]).drop("level", "block")
