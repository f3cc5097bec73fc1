"""Run-log operators (O-01..O-05): append a run record, latest run per
pipeline, 30-day success rates and the digest warning flags.

The run log has the columns of ``RUN_LOG_DDL``.  ``as_of`` (a timestamp) plays
the role of the current time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import round_half_away

# Fixed values that must equal the reference's for equal results:
#   run-log columns: run_id, pipeline_name, started_at, finished_at, status, rows_loaded,
#                    duration_seconds, error_message, git_sha
#   transform pipeline name: "dbt";  statuses "success" / "error";  warning below 80 %
RUN_LOG_DDL = ("run_id string, pipeline_name string, started_at timestamp, finished_at timestamp, status string, "
               "rows_loaded bigint, duration_seconds double, error_message string, git_sha string")
TRANSFORM = "dbt"
WARN_BELOW = 80


def run_record(spark: SparkSession, run_id: str, pipeline: str, started_at, finished_at, status: str,
               rows_loaded: int | None, error_message: str = "", git_sha: str = "") -> DataFrame:
    """O-01: one run record (duration derived from the two timestamps)."""
    dur = (finished_at - started_at).total_seconds()
    return spark.createDataFrame(
        [(run_id, pipeline, started_at, finished_at, status, rows_loaded, dur, error_message, git_sha)], RUN_LOG_DDL)


def append_runs(records: DataFrame, path: str) -> None:
    """O-01: append to the run log (a Parquet table in the shared folder)."""
    records.write.mode("append").parquet(path)


def _hours_before(as_of: str, hours: int):
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")


def latest_runs(runs: DataFrame, as_of: str, *, hours: int = 24) -> DataFrame:
    """O-02: latest run per pipeline in the last ``hours`` (transform runs excluded).

    ``max(struct(started_at, ...))`` per pipeline: a partial aggregation, no
    ranked window over a possibly huge pipeline history.
    """
    r = runs.where((F.col("started_at") >= _hours_before(as_of, hours)) & (F.col("pipeline_name") != TRANSFORM))
    fields = ["started_at", "status", "rows_loaded", "duration_seconds", "error_message", "run_id"]
    g = r.groupBy("pipeline_name").agg(F.max(F.struct(*fields)).alias("x"))
    return g.select("pipeline_name", "x.status", "x.rows_loaded",
                    round_half_away(F.col("x.duration_seconds"), 1).alias("duration_seconds"),
                    "x.error_message", "x.started_at")


def success_trend(runs: DataFrame, as_of: str, *, days: int = 30, transform: bool = False) -> DataFrame:
    """O-03 (per pipeline) / O-04 (transform only, one row): runs, successes, failures, rate."""
    since = _hours_before(as_of, 24 * days)
    is_t = F.col("pipeline_name") == TRANSFORM
    r = runs.where((F.col("started_at") >= since) & (is_t if transform else ~is_t))
    ok = F.count_if(F.col("status") == "success")
    aggs = [F.count(F.lit(1)).alias("total_runs"), ok.alias("successes")]
    if not transform:
        aggs.append(F.count_if(F.col("status") == "error").alias("failures"))
    aggs.append(round_half_away(safe_rate(ok, F.count(F.lit(1))), 0).alias("success_rate"))
    return r.agg(*aggs) if transform else r.groupBy("pipeline_name").agg(*aggs)


def safe_rate(ok, total):
    return F.try_divide(ok * 100.0, total)


def digest_flags(trend: DataFrame, *, warn_below: int = WARN_BELOW) -> DataFrame:
    """O-05: mark pipelines whose success rate is under the warning threshold."""
    return trend.withColumn("warning", F.coalesce(F.col("success_rate"), F.lit(0.0)) < warn_below)
