"""The page queries' periods reach the scans, and whole months stay."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marginalia.functions import in_months
from marginalia.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, column", [("pnl_listing", "o_orderdate"), ("d2c_kpi", "l_shipdate"), ("current_month", "ts"),
                                          ("affiliate_data", "ts"), ("revenue_yoy", "ts")])
def test_period_reaches_the_scan(spark, name, column):
    plan = QUERIES[name].run(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"Filter \(.*{column}#\d+ >= .*{column}#\d+ < ", plan)


def test_in_months_keeps_whole_months(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 1), None]
    df = spark.createDataFrame([(x,) for x in days], "d date").withColumn("t", F.col("d").cast("timestamp"))
    for col in ("d", "t"):
        kept = {r.d for r in df.where(in_months(col, "2024-01-15", "2024-02-03")).collect()}
        assert kept == {dt.date(2024, 1, 1), dt.date(2024, 2, 29)}
