"""Serving patterns behind the dashboard queries (D-01..D-64, X-01..X-15).

The page queries of the source project are a handful of shapes applied to
the marts; each shape is one function here, taking explicit ``start``/``end``
dates (no text substitution, no wall clock):

* ``in_range``        range filter (pages that list a mart for a period)
* ``period_compare``  current period vs the period before it, as conditional
                      sums / averages / distinct counts in one aggregation
* ``weekly``          Monday-week x key roll-up with sums and ratios
* ``rollup``          group-by with sums and ratios of sums
* ``share_of_total``  each group's share of the grand total
* ``lines_long``      wide -> long (one row per line item of a cost stack)
* ``biweekly_start``  the two-week bucket of the source page
* ``top_n``           top rows by a measure with a total tie-break order
* ``semi_top_n``      rows whose key is among the top-n keys of another frame
* ``extract``         projection + ordering used by the extract queries

Scale notes: all shapes are single aggregations (partial aggregation before
the shuffle); ``top_n`` plans as TakeOrderedAndProject (per-partition top-n,
then a merge of n x partitions rows); ``share_of_total`` aggregates first and
takes the total from the aggregated rows, so its window sees one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import c, monday_week, round_half_away, safe_div


def _d(x) -> Column:
    return F.lit(x).cast("date")


def in_range(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Rows whose ``col`` lies in [start, end] (pushed down to the scan as a range predicate)."""
    return df.where(F.col(col).between(_d(start), _d(end)))


def current_period(col: str, start: str, end: str) -> Column:
    return F.col(col).between(_d(start), _d(end))


def prior_months(col: str, start: str, months: int = 12) -> Column:
    """[start - months, start): the comparison window of most pages."""
    return (F.col(col) >= F.add_months(_d(start), -months)) & (F.col(col) < _d(start))


def prior_same_length(col: str, start: str, end: str) -> Column:
    """The equally long window just before ``start``."""
    length = F.datediff(_d(end), _d(start)) + 1
    return (F.col(col) >= F.date_sub(_d(start), length)) & (F.col(col) < _d(start))


def period_compare(df: DataFrame, measures: list[tuple[str, str, Column | str, Column | None]],
                   where: Column | None = None) -> DataFrame:
    """One-row KPI table in one aggregation.

    ``measures`` = (name, kind, value, condition); kind is ``sum`` (0 outside the
    condition), ``avg`` (NULL outside) or ``count_distinct`` (of the value where
    the condition holds).
    """
    base = df.where(where) if where is not None else df
    aggs = []
    for name, kind, value, cond in measures:
        v = c(value)
        if kind == "sum":
            aggs.append(F.sum(F.when(cond, v).otherwise(F.lit(0)) if cond is not None else v).alias(name))
        elif kind == "avg":
            aggs.append(F.avg(F.when(cond, v) if cond is not None else v).alias(name))
        elif kind == "count_distinct":
            aggs.append(F.count_distinct(F.when(cond, v) if cond is not None else v).alias(name))
        else:
            raise ValueError(kind)
    return base.agg(*aggs)


def weekly(df: DataFrame, date_col: str, keys: list[str], sums: dict[str, str],
           ratios: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    g = df.groupBy(monday_week(date_col).alias("week"), *keys).agg(
        *[F.sum(src).alias(out) for out, src in sums.items()],
        *[safe_div(F.sum(n), F.sum(d)).alias(out) for out, (n, d) in (ratios or {}).items()])
    return g


def rollup(df: DataFrame, keys: list, sums: dict[str, str] | None = None,
           ratios: dict[str, tuple[str, str]] | None = None, extra: list[Column] | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(src).alias(out) for out, src in (sums or {}).items()],
        *[safe_div(F.sum(n), F.sum(d)).alias(out) for out, (n, d) in (ratios or {}).items()],
        *(extra or []))


def share_of_total(grouped: DataFrame, value: str, out: str, *, scale: float = 100.0, digits: int = 1) -> DataFrame:
    """Add ``out`` = round(value * scale / total, digits) to an already aggregated frame.

    The input has one row per group (a few categories), so the total window
    is tiny; the source page does the same with a cross join to a one-row total.
    """
    total = F.sum(value).over(Window.partitionBy())
    return grouped.withColumn(out, round_half_away(F.col(value) * scale / total, digits))


def lines_long(df: DataFrame, id_cols: list[str], lines: dict[str, str], *, name: str = "line",
               value: str = "value") -> DataFrame:
    """Wide -> long: one row per (id, line) with the line's value."""
    return df.unpivot(id_cols, list(lines.values()), name, value).select(
        *id_cols, F.coalesce(*[F.when(F.col(name) == src, F.lit(label)) for label, src in lines.items()]).alias(name),
        value)


def sunday_week_number(d) -> Column:
    """Week of the year with weeks starting on Sunday; days before the first Sunday are week 0."""
    d = c(d)
    return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")


def biweekly_start(d) -> Column:
    """Two-week bucket of the source page: Monday week + 7 days x (Sunday week number mod 2).

    Kept as written there: Sundays and New Year can move a day to the
    neighbouring bucket.
    """
    d = c(d)
    return F.date_add(monday_week(d), (sunday_week_number(d) % 2) * 7)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Top ``n`` rows by ``order`` (give a total order so ties are deterministic)."""
    return df.orderBy(*order).limit(n)


def semi_top_n(df: DataFrame, ranked: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the first ``n`` keys of ``ranked`` (n rows broadcast)."""
    top = ranked.orderBy(*order).limit(n).select(key)
    return df.join(F.broadcast(top), key, "left_semi")


def extract(df: DataFrame, columns: list, order: list[Column] | None = None) -> DataFrame:
    """X-01..X-15: extract queries: a mart's columns, optionally ordered for the consumer."""
    out = df.select(*columns)
    return out.orderBy(*order) if order else out


def write_ordered(df: DataFrame, path: str, order: list[Column], fmt: str = "parquet", **options) -> None:
    """X-01..X-15: write an extract whose files, in the order of their names, are the asked order.

    Rows are dealt to ranges of the order and sorted inside each, so no task holds the whole extract; every
    task writes one file, named by its range.  Give a total order.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").options(**options).format(fmt).save(path)
