"""Merged, streamed and refreshed tables (I-05, I-08, T-06) over the bench tables.

Each query writes a table of its own to the shared folder, in several commits, and returns what it then reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marginalia.plans.catalog import register
from marginalia.session import checkpoint_dir
from marginalia.sources import roles as R
from marginalia.sources import tables as tb
from marginalia.streaming.ingest import ingest_stream, read_latest


def _new(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _drops(spark, d):
    """The orders as two deliveries: all up to 1996, then all from 1996 on with their later state; 1996 comes twice."""
    o = R.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"))
    year = F.year("order_date")
    return (o.where((year <= 1996) | year.isNull()).withColumn("load", F.lit(1)),
            o.where(year >= 1996).withColumns({"total": F.col("total") + 1, "load": F.lit(2)}))


MERGED_SPEC = "order_id:i customer_id:i order_date:d total:m status:s load:i"
MERGED_SQL = """
select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date, o_totalprice + if(coalesce(year(o_orderdate), 0) >= 1996, 1, 0) as total,
       o_orderstatus as status, if(coalesce(year(o_orderdate), 0) >= 1996, 2, 1) as load
from orders"""


@register("orders_merged_by_month", MERGED_SPEC, MERGED_SQL, "I-05")
def q_merged(spark, d):
    path = _new(spark, "orders-merged")
    for version, batch in enumerate(_drops(spark, d), 1):
        tb.merge_partitions(batch, path, ["order_id"], F.date_format("order_date", "yyyy-MM"), version, order_cols=["load"])
    return tb.read_table(spark, path)


@register("orders_streamed", MERGED_SPEC, MERGED_SQL, "I-08")
def q_streamed(spark, d):
    landed, path, seen = (_new(spark, f"orders-{x}") for x in ("landed", "streamed", "seen"))
    for drop in _drops(spark, d):
        drop.write.mode("append").json(landed)
        ingest_stream(spark, landed, "order_id long, customer_id long, order_date date, total double, status string, load int", path,
                      ["order_id"], seen, order_cols=["load"], part=F.date_format("order_date", "yyyy-MM"))
    return read_latest(spark, path)


def monthly_sales(orders, lines):
    """Orders, units and net value by day."""
    o = orders.select("order_id", "order_date")
    return o.join(lines.select("order_id", "quantity", "net"), "order_id").groupBy("order_date").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("quantity").alias("units"), F.sum("net").alias("net"))


@register("daily_sales_refreshed", "order_date:d orders:i units:i net:m", """
select cast(o_orderdate as date) as order_date, count(distinct o_orderkey) as orders, sum(cast(l_quantity as bigint)) as units,
       sum(cast(round(l_extendedprice * 100) as bigint)) / 100.0 as net
from orders join lineitem on l_orderkey = o_orderkey group by 1""", "T-06")
def q_refreshed(spark, d):
    """A mart after two refreshes: before the second, the orders of 1995 have changed and those of 1998 have come."""
    orders = R.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"))
    lines = R.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
                                                 (R.cents("l_extendedprice") / 100.0).alias("net"))
    lines = lines.join(orders, "order_id")
    early = lines.where(F.year("order_date") != 1998).withColumn("quantity", F.when(F.year("order_date") == 1995, 0).otherwise(F.col("quantity")))
    path, month = _new(spark, "daily-sales"), F.date_format("order_date", "yyyy-MM")
    for version, now in ((1, early), (2, lines)):
        tb.refresh(path, {"orders": (orders, month), "lines": (now, month)}, lambda orders, lines: monthly_sales(orders, lines.drop("order_date")), month, version, spark)
    return tb.read_table(spark, path)
