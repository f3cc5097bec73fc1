"""Data-quality checks (Q-01..Q-05), each returning a violations DataFrame.

All checks are single aggregations (or a filter) over the checked frame, so
they run as one scan each: ``not_null`` counts every listed column in the same
pass, ``unique`` is a ``groupBy`` with partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
#   freshness defaults: warn after 36 h, error after 48 h (video feeds 36 / 72 h, search interest 8 / 14 days)
FRESHNESS = {"default": (36, 48), "video": (36, 72), "interest": (8 * 24, 14 * 24)}


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q-01: (column, null_rows) for every listed column that has NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], columns, "column", "null_rows")
    return long.where(F.col("null_rows") > 0)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q-02: non-NULL values that occur more than once, with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Q-03: rows whose value is outside the accepted set (NULLs are not checked)."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def freshness(df: DataFrame, loaded_at: str, as_of: str, *, warn_hours: int = 36, error_hours: int = 48) -> DataFrame:
    """Q-04: age of the newest row in hours and its status (pass / warn / error)."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("max_loaded_at")) / 3600.0
    status = (F.when(F.col("max_loaded_at").isNull() | (age > error_hours), "error")
              .when(age > warn_hours, "warn").otherwise("pass"))
    return newest.select("max_loaded_at", age.alias("age_hours"), status.alias("status"))


def expect_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Q-05: rows whose metric falls outside a documented band."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).between(low, high))


def violations_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per named check with its violation count (one job per check)."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
             for name, df in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
