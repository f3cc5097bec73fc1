"""Window patterns that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


#: Partitions a core that ``spread`` deals rows to at least.
PER_CORE = 8
#: Rows that a partition gets on average at most, where the number of rows is known.
PER_TASK = 500_000


def many(spark: SparkSession, rows: int) -> bool:
    """Whether ``rows`` are more than ``PER_TASK`` for each of the session's shuffle partitions."""
    return rows > PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *keys: str, rows: int = 0, least: int = 0) -> DataFrame:
    """``df`` dealt by ``keys`` to all of the session's shuffle partitions, which adaptive execution does not merge.

    Merging looks at compressed bytes and leaves a task a core while they are few, or 64 MB a task; where the
    stage behind sorts the rows and builds hash maps of them, a task holds many times that.  The join, window or
    grouping on ``keys`` needs this exchange anyway.  A session that sets as few partitions as it has cores would
    leave a task a core too, so there are ``PER_CORE`` partitions a core at least.  With the number of ``rows``, or
    a bound of it, there are so many that a task's share does not grow with the input.  ``least`` asks for so many partitions at least.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              PER_CORE * spark.sparkContext.defaultParallelism, ceil(rows / PER_TASK), least), *keys)


#: Numbers of the second ordering column that share a bucket inside a day.
BUCKET = 1 << 16


def _buckets(df: DataFrame, order: list[str]) -> list:
    """Order-preserving buckets of a group's rows: the first column, and ranges of the second where it is a whole number."""
    out = [F.col(order[0]).alias("_b0")]
    if len(order) > 1 and isinstance(df.schema[order[1]].dataType, IntegralType):
        out.append(F.floor(F.col(order[1]) / BUCKET).alias("_b1"))
    return out


def running_sums(df: DataFrame, by: list[str], order: list[str], values: dict[str, str],
                 first_bucket_as: str | None = None) -> DataFrame:
    """Running totals per ``by`` group in ``order`` (rows unbounded preceding .. current).

    Equal to ``sum(v) over (partition by by order by order rows ...)`` when
    ``order`` is unique within a group, without putting a whole group in one
    window partition.  The first ordering column (a date) is a bucket, and where the
    second is a whole number (an order id), so is each range of ``BUCKET`` of its values:

    * bucket totals per (group, bucket) come from a partial aggregation, and a
      window over the group sees one row per bucket to give the total of all earlier buckets;
    * inside a bucket, an ordinary running window: ``BUCKET`` rows at most where the
      second column is unique in the group, whatever share of the rows a group's day has;
    * result = earlier-bucket total + running value inside the bucket.

    Deterministic (no sampling), so it recomputes identically after an
    executor loss.  ``first_bucket_as`` also returns each group's first bucket
    (computed from the per-bucket table, no extra pass over ``df``).
    """
    rest, buckets = order[1:], _buckets(df, order)
    names = ["_b0", "_b1"][: len(buckets)]
    df0, df = df, df.select("*", *buckets)
    totals = df.groupBy(*by, *names).agg(*[F.sum(src).alias(f"_tot_{out}") for out, src in values.items()])
    prev_w = Window.partitionBy(*by).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    extra = []
    if first_bucket_as:
        # the group's first bucket (e.g. first order day) from the same small per-bucket table
        extra.append(F.min("_b0").over(Window.partitionBy(*by)).alias(first_bucket_as))
    offsets = totals.select(*by, *names, *[F.sum(f"_tot_{out}").over(prev_w).alias(f"_off_{out}")
                                           for out in values], *extra)
    local_w = Window.partitionBy(*by, *names).orderBy(*(rest or names)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select("*", *[F.sum(src).over(local_w).alias(f"_run_{out}") for out, src in values.items()])
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*by, *names]]
    joined = local.alias("l").join(offsets.alias("o"), reduce(lambda a, b: a & b, same), "left").drop(*[F.col(f"o.{c}") for c in [*by, *names]])
    outs = []
    for out in values:
        run, off = F.col(f"_run_{out}"), F.col(f"_off_{out}")
        outs.append(F.when(run.isNull() & off.isNull(), F.lit(None))
                    .otherwise(F.coalesce(run, F.lit(0)) + F.coalesce(off, F.lit(0))).alias(out))
    return joined.select(*df0.columns, *outs, *([first_bucket_as] if first_bucket_as else []))
