"""Tables rewritten by partition: cost of a batch, failure, replay, refresh."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from marginalia.sources import tables as tb

ROWS = "k int, day date, v int"


def month():
    return F.date_format("day", "yyyy-MM")


def day(m, d=1):
    return dt.date(2024, m, d)


def files(path):
    return {p: p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("data/**/*.parquet")}


def test_a_batch_writes_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(k, day(1 + k % 4), k) for k in range(40)], ROWS)
    assert tb.merge_partitions(first, path, ["k"], month(), 1) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    before = files(path)
    batch = spark.createDataFrame([(2, day(3), 200), (2, day(3), 100), (99, day(3), 9), (98, None, 1)], ROWS)
    assert tb.merge_partitions(batch, path, ["k"], month(), 2) == ["2024-03", "null"]
    after = files(path)
    assert all(after[p] == t for p, t in before.items())
    assert {p.parent.name for p in set(after) - set(before)} == {"_p=2024-03", "_p=null"}
    got = {r.k: r.v for r in tb.read_table(spark, path).collect()}
    assert got == {**{k: k for k in range(40)}, 2: 200, 99: 9, 98: 1}
    assert {r.k: r.v for r in tb.read_table(spark, path, version=1).collect()} == {k: k for k in range(40)}
    assert tb.read_table(spark, path, parts=["2024-01"]).count() == 10
    assert [r.folder.split("/")[-2:] for r in tb.obsolete(spark, path).collect()] == [["_v=1", "_p=2024-03"]]
    assert tb.obsolete(spark, path, keep=2).count() == 0


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.merge_partitions(spark.createDataFrame([(1, day(1), 1), (2, day(2), 2)], ROWS), path, ["k"], month(), 1)
    bad = spark.createDataFrame([(1, day(1), 5)], ROWS).withColumn("v", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(Exception, match="stop"):
        tb.merge_partitions(bad, path, ["k"], month(), 2)
    assert tb.versions(spark, path) == [1] and {r.k: r.v for r in tb.read_table(spark, path).collect()} == {1: 1, 2: 2}
    assert tb.merge_partitions(spark.createDataFrame([(1, day(1), 6)], ROWS), path, ["k"], month(), 2) == ["2024-01"]
    assert tb.merge_partitions(spark.createDataFrame([(1, day(1), 7)], ROWS), path, ["k"], month(), 2) == []  # a replay
    assert {r.k: r.v for r in tb.read_table(spark, path).collect()} == {1: 6, 2: 2}


def test_new_columns_and_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tb.read_table(spark, path) is None and tb.merge_partitions(spark.createDataFrame([], ROWS), path, ["k"], month(), 1) == []
    tb.merge_partitions(spark.createDataFrame([(1, day(1), 1), (2, day(2), 2)], ROWS), path, ["k"], month(), 1)
    tb.merge_partitions(spark.createDataFrame([(3, day(2), 3, "x")], ROWS + ", w string"), path, ["k"], month(), 2)
    assert {(r.k, r.w) for r in tb.read_table(spark, path).collect()} == {(1, None), (2, None), (3, "x")}


def test_refresh_rewrites_changed_months_only(spark, tmp_path):
    path, built = str(tmp_path / "mart"), []

    def build(facts):
        built.append(sorted({r.m for r in facts.select(month().alias("m")).distinct().collect()}))
        return facts.groupBy("day").agg(F.sum("v").alias("v"))

    def run(rows, version):
        df = spark.createDataFrame(rows, ROWS)
        return tb.refresh(path, {"facts": (df, month())}, build, month(), version, spark)

    rows = [(k, day(1 + k % 3, 1 + k % 5), k) for k in range(30)]
    assert run(rows, 1) == ["2024-01", "2024-02", "2024-03"]
    before = files(path)
    assert run(rows[::-1], 2) == []  # the order of rows is no change
    changed = [(k, d, v + 100 if d.month == 2 and k < 5 else v) for k, d, v in rows if d.month != 3] + [(50, day(7), 1)]
    assert run(changed, 3) == ["2024-02", "2024-03", "2024-07"]
    assert built == [["2024-01", "2024-02", "2024-03"], ["2024-02", "2024-07"]]
    assert all(files(path)[p] == t for p, t in before.items())
    want = {}
    for _, d, v in changed:
        want[d] = want.get(d, 0) + v
    assert {r.day: r.v for r in tb.read_table(spark, path).collect()} == want
