"""All rules of a table in one pass, and counts taken while it is written (O-01, Q-01..Q-05).

A rule is ``(kind, column, ...)``: ``not_null``; ``unique``; ``accepted`` with the values; ``between`` with the
bounds; ``fresh`` with the moment it is asked and the hours after which the newest value is stale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marginalia.operators.runlog import append_runs, run_record

RULE = "rule string, column string, violations bigint"


def _name(rule: tuple) -> str:
    return f"{rule[0]}:{rule[1]}"


def _bad(rule: tuple) -> Column:
    """Whether a row breaks the rule; never null."""
    kind, column, *args = rule
    c = F.col(column)
    broken = {"not_null": lambda: c.isNull(), "accepted": lambda: c.isNotNull() & ~c.isin(*args[0]), "between": lambda: c.isNotNull() & ~c.between(*args)}
    return F.coalesce(broken[kind](), F.lit(False))


def _stale(rule: tuple, newest: Column) -> Column:
    """1 if the newest value is too old, or there is none."""
    _, _, as_of, hours = rule
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(newest.cast("timestamp"))
    return F.when(newest.isNull() | (age > hours * 3600), 1).otherwise(0)


def _metrics(rules: list[tuple]) -> list[Column]:
    """One aggregate for each rule but ``unique``."""
    return [(F.max(r[1]) if r[0] == "fresh" else F.count_if(_bad(r))).alias(_name(r)) for r in rules if r[0] != "unique"]


def violations(df: DataFrame, rules: list[tuple]) -> DataFrame:
    """(rule, column, violations) of every rule, 0 where it holds; one scan of ``df`` for all of them.

    ``unique`` counts the values that stand more than once.  Each row sends a value for each unique
    column, and the flags of the other rules with the first; grouped by value, with partial counts on the
    mappers, so a value that many rows share is a row a task.
    """
    unique = [r for r in rules if r[0] == "unique"]
    fresh = [r for r in rules if r[0] == "fresh"]
    flags = [r for r in rules if r[0] in ("not_null", "accepted", "between")]
    flag_cols = [F.when(_bad(r), 1).otherwise(0).alias(_name(r)) for r in flags] + [F.col(r[1]).cast("timestamp").alias(_name(r)) for r in fresh]
    sums = [F.sum(f"`{_name(r)}`").alias(_name(r)) for r in flags] + [F.max(f"`{_name(r)}`").alias(_name(r)) for r in fresh]
    rows = df.select(*flag_cols, F.array(*[F.struct(F.lit(_name(r)).alias("rule"), F.col(r[1]).cast("string").alias("value")) for r in unique], F.struct(
        F.lit("").alias("rule"), F.lit(None).cast("string").alias("value"))).alias("vs"))
    # the last entry, without a value, carries the row's flags; the others carry none
    long = rows.select(F.explode("vs").alias("v"), *[F.col(f"`{_name(r)}`") for r in [*flags, *fresh]])
    last = F.col("v.rule") == ""
    long = long.select("v.rule", "v.value", *[F.when(last, F.col(f"`{_name(r)}`")).alias(_name(r)) for r in [*flags, *fresh]])
    grouped = long.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"), *sums)
    total = grouped.agg(*[F.count_if((F.col("rule") == _name(r)) & F.col("value").isNotNull() & (F.col("n") > 1)).alias(_name(r)) for r in unique], *sums)
    parts = [F.struct(F.lit(r[0]).alias("rule"), F.lit(r[1]).alias("column"),
                      (_stale(r, F.col(f"`{_name(r)}`")) if r[0] == "fresh" else F.coalesce(F.col(f"`{_name(r)}`"), F.lit(0))).cast("bigint").alias("violations")) for r in rules]
    return total.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def write_checked(df: DataFrame, path: str, rules: list[tuple] = (), mode: str = "overwrite") -> tuple[int, dict[str, int]]:
    """Write a table and count its rows and broken rules on the way: (rows written, violations by rule).

    The counts are taken by the write itself (an ``Observation``), so the table is not read again.
    ``unique`` needs all rows of a value together and is left to :func:`violations`.
    """
    rules = [r for r in rules if r[0] != "unique"]
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("_rows"), *_metrics(rules)).write.mode(mode).parquet(path)
    got = seen.get
    out = {}
    for r in rules:
        v = got[_name(r)]
        if r[0] == "fresh":
            as_of = dt.datetime.fromisoformat(str(r[2]))
            v = None if v is None else v if isinstance(v, dt.datetime) else dt.datetime.combine(v, dt.time())
            v = int(v is None or (as_of - v).total_seconds() > r[3] * 3600)
        out[_name(r)] = v
    return got["_rows"], out


def run_load(spark: SparkSession, df: DataFrame, path: str, log: str, run_id: str, pipeline: str, *, rules: list[tuple] = (), git_sha: str = "") -> dict[str, int]:
    """O-01: write a table and append its run record, with the rows that the write has counted.

    A load that fails is logged as an error with the message's first line, and the failure goes on to the caller.
    """
    began = dt.datetime.now()
    try:
        rows, broken = write_checked(df, path, rules)
    except Exception as e:
        append_runs(run_record(spark, run_id, pipeline, began, dt.datetime.now(), "error", None, (str(e).splitlines() or [""])[0][:500], git_sha), log)
        raise
    append_runs(run_record(spark, run_id, pipeline, began, dt.datetime.now(), "success", rows, "", git_sha), log)
    return broken
