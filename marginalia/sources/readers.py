"""Readers for landed files and sinks (I-01..I-04, I-50, I-55).

Landed payloads are read with an explicit schema (never inferred at scale):
JSON records (nested objects optional), delimited reports (tab, header,
gzip transparent), typed seed CSVs, and date-partitioned event folders.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_feed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """I-01: JSON lines with a fixed schema; missing nested objects read as NULL structs."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def header_name(name: str) -> str:
    """Report header -> column name: BOM dropped, '-' becomes '_'."""
    return name.lstrip("﻿").strip().replace("-", "_")


def read_flat_report(spark: SparkSession, path: str, *, sep: str = "\t", loaded_at: str | None = None) -> DataFrame:
    """I-02: delimited report (tab by default, header row, gzip read transparently).

    Empty fields become NULL; every column stays text (coerce with ``coerce_numeric``);
    a ``_loaded_at`` stamp is added, one value for the whole batch.
    """
    df = (spark.read.option("header", True).option("sep", sep).option("nullValue", "")
          .option("emptyValue", None).option("inferSchema", False).csv(path))
    df = df.toDF(*[header_name(c) for c in df.columns])
    stamp = F.lit(loaded_at).cast("timestamp") if loaded_at else F.current_timestamp()
    return df.withColumn("_loaded_at", stamp)


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """I-03: typed CSV seed (reference data)."""
    return spark.read.option("header", True).schema(ddl).csv(path)


def scan_shards(df: DataFrame, as_of: str, days: int, *, date_col: str = "event_date") -> DataFrame:
    """I-04: keep the last ``days`` days of a date-partitioned feed.

    With ``date_col`` a partition column the predicate becomes a
    PartitionFilter, so the other folders are never listed or read.
    """
    return df.where(F.col(date_col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def optional_table(spark: SparkSession, name: str, ddl: str) -> DataFrame:
    """I-50: a catalog table if it exists, else an empty frame with its schema."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], ddl)


_CAMEL = re.compile(r"([A-Z])")


def snake_name(name: str) -> str:
    """I-11 name rule: every capital gets a leading '_' and is lower-cased (B2B -> b2_b)."""
    return _CAMEL.sub(lambda m: "_" + m.group(1).lower(), name)


def snake_columns(df: DataFrame) -> DataFrame:
    """I-11: camelCase -> snake_case column names (a schema-only rename)."""
    return df.toDF(*[snake_name(c) for c in df.columns])


# --- sinks (I-55) --------------------------------------------------------------

def write_table(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """I-55: table sink (Parquet; overwrite for marts, append for logs)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    """I-55: view sink."""
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    """I-55: CSV sink (change sets for review)."""
    df.write.mode("overwrite").option("header", True).csv(path)
