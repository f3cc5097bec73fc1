"""Write modes and batching of the loaders (I-05..I-09, I-25, I-53).

``merge_upsert`` is the merge-by-key the source loaders perform: an incoming
row replaces the stored row with the same key, other stored rows are kept.
It is one ``unionByName`` + one aggregation per key (``max_by`` over a
(batch, load stamp, row fingerprint) order), so it is deterministic on ties
and its work is partially aggregated on the mappers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], *,
                 order_cols: list[str] | None = None) -> DataFrame:
    """I-05: newest row per key across the stored table and an incoming batch.

    Rows of ``batch`` win over ``target``; inside one side, the larger
    ``order_cols`` (e.g. ``_loaded_at``) wins, and the columns themselves
    break exact ties, so the result does not depend on file order.  The result
    has the columns of both sides; a side that lacks one has NULL there.
    Merging the same batch twice gives the same table (idempotent).
    """
    cols = target.columns + [c for c in batch.columns if c not in target.columns]
    order_cols = order_cols or []
    t = target.withColumn("_side", F.lit(0))
    b = batch.withColumn("_side", F.lit(1))
    u = t.unionByName(b, allowMissingColumns=True)
    payload = F.struct(*[F.col(c) for c in cols])
    rank = F.struct(F.col("_side"), *[F.col(c) for c in order_cols], payload.alias("_all"))
    g = u.groupBy(*keys).agg(F.max_by(payload, rank).alias("_row"))
    return g.select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def replace_table(df: DataFrame, path: str) -> None:
    """I-06: full refresh of a table."""
    df.write.mode("overwrite").parquet(path)


def lookback(df: DataFrame, date_col: str, as_of: str, days: int, *, lag: int = 1) -> DataFrame:
    """I-07: rows of the rolling window that ends ``lag`` days before ``as_of`` and spans ``days`` days."""
    end = F.date_sub(F.lit(as_of).cast("date"), lag)
    start = F.date_sub(end, days - 1)
    return df.where(F.col(date_col).between(start, end))


def date_chunks(spark, start: str, end: str, n: int) -> DataFrame:
    """I-09: cover [start, end] with closed n-day chunks (chunk_start, chunk_end)."""
    s = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr(f"INTERVAL {n} DAYS"))).alias("chunk_start"))
    return s.select("chunk_start", F.least(F.date_add("chunk_start", n - 1), F.lit(end).cast("date")).alias("chunk_end"))


def require_keys(df: DataFrame, keys: list[str], *, blank_is_missing: bool = True) -> tuple[DataFrame, DataFrame]:
    """I-25: (rows with every key present, rows skipped).  Count the second lazily when needed."""
    ok = None
    for k in keys:
        cond = F.col(k).isNotNull()
        if blank_is_missing:
            cond = cond & (F.trim(F.col(k).cast("string")) != "")
        ok = cond if ok is None else ok & cond
    return df.where(ok), df.where(~ok | ok.isNull())


def batch_ids(df: DataFrame, order_cols: list[str], size: int = 10_000) -> DataFrame:
    """I-53: fixed-size export batches numbered in ``order_cols`` order (give a total order).

    The sorted frame is checkpointed to the shared checkpoint folder, so its
    partitioning is fixed (and survives executor loss); each row's global
    position is then its partition's offset (a table with one row per
    partition) plus its position inside the partition, which the checkpoint's
    files keep.  The rows are sorted once; nothing is collected to the driver.
    """
    ordered = df.orderBy(*order_cols).checkpoint(eager=True)
    row_id = F.monotonically_increasing_id()  # partition number above 33 bits of position
    tagged = ordered.withColumn("_id", row_id).withColumns({
        "_pid": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    j = tagged.join(F.broadcast(offsets), "_pid")
    return j.select(*df.columns, F.floor((F.col("_off") + F.col("_pos")) / size).cast("bigint").alias("batch_id"))
