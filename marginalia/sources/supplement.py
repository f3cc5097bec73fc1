"""Seeds that stand in for the time before a feed began (F-01, F-02, F-04, F-08)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_days(feed: DataFrame, day: str, by: list[str]) -> DataFrame:
    """The feed's first day in each group: a partial aggregate, one row a group."""
    return feed.groupBy(*by).agg(F.min(day).alias("_first"))


def _beside(seed: DataFrame, feed: DataFrame, day: str, by: list[str]) -> DataFrame:
    first = _first_days(feed, day, by)
    if not by:
        return seed.crossJoin(F.broadcast(first))  # a single row
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by])
    return seed.alias("s").join(first.alias("f"), same, "left").select("s.*", "f._first")


def before_feed(seed: DataFrame, feed: DataFrame, day: str, by: list[str] | None = None) -> DataFrame:
    """The seed's rows of days before the feed's first day (in each group of ``by``); all of them where the feed has none.

    Rows without a day are kept by neither side's calendar and stay out.
    """
    j = _beside(seed, feed, day, by or [])
    return j.where(F.col("_first").isNull() & F.col(day).isNotNull() | (F.col(day) < F.col("_first"))).drop("_first")


def overlaps(seed: DataFrame, feed: DataFrame, day: str, by: list[str] | None = None) -> DataFrame:
    """(group, first_day, last_day, rows): what of the seed lies in the feed's own time and is left out."""
    by = by or []
    j = _beside(seed, feed, day, by).where(F.col(day) >= F.col("_first"))
    return j.groupBy(*by).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 0)


def cut_over(seed: DataFrame, feed: DataFrame, day: str, by: list[str] | None = None) -> DataFrame:
    """The feed, and before it the seed: every row of the feed, no day from both."""
    return feed.unionByName(before_feed(seed, feed, day, by))
