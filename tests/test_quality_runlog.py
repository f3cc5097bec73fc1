import datetime as dt
import tempfile

from marginalia.operators import published as pub
from marginalia.operators import quality as q
from marginalia.operators import runlog as rl


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (2, None, 2.0), (None, "x", 3.0)],
                               "id int, status string, v double")
    nn = {r.column: r.null_rows for r in q.not_null(df, ["id", "status", "v"]).collect()}
    assert nn == {"id": 1, "status": 1, "v": 1}
    assert [(r.id, r.occurrences) for r in q.unique(df, "id").collect()] == [(2, 2)]
    assert [r.status for r in q.accepted_values(df, "status", ["a", "b"]).collect()] == ["x"]
    assert q.expect_between(df, "v", 1.5, 5.0).count() == 1
    stamps = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),)], "loaded_at timestamp")
    f = q.freshness(stamps, "loaded_at", "2024-01-02 14:00:00").first()
    assert f.age_hours == 38.0 and f.status == "warn"
    assert q.freshness(stamps, "loaded_at", "2024-01-03 01:00:00").first().status == "error"
    s = {r.check: r.violations for r in q.violations_summary({"uniq": q.unique(df, "id")}).collect()}
    assert s == {"uniq": 1}


def test_run_log_append_and_digest(spark):
    path = tempfile.mkdtemp(prefix="runlog-") + "/runs"
    t0 = dt.datetime(2024, 1, 30, 6, 0)
    rl.append_runs(rl.run_record(spark, "r1", "shopify", t0, t0 + dt.timedelta(seconds=90), "success", 10), path)
    rl.append_runs(rl.run_record(spark, "r2", "shopify", t0 + dt.timedelta(hours=1),
                                 t0 + dt.timedelta(hours=1, seconds=30), "error", None, "HTTP 500"), path)
    rl.append_runs(rl.run_record(spark, "r3", "dbt", t0, t0 + dt.timedelta(seconds=10), "success", None), path)
    runs = spark.read.parquet(path)
    latest = rl.latest_runs(runs, "2024-01-30 12:00:00").collect()
    assert [(r.pipeline_name, r.status, r.duration_seconds) for r in latest] == [("shopify", "error", 30.0)]
    trend = {r.pipeline_name: r for r in rl.digest_flags(rl.success_trend(runs, "2024-01-30 12:00:00")).collect()}
    assert trend["shopify"].success_rate == 50.0 and trend["shopify"].warning
    t = rl.success_trend(runs, "2024-01-30 12:00:00", transform=True).first()
    assert (t.total_runs, t.successes, t.success_rate) == (1, 1, 100.0)


def test_publish_and_materialize(spark):
    df = spark.createDataFrame([(1,)], "x int")
    names = pub.publish({"trends": df, "true_roas": df})
    assert set(names) == {"vw_trends", "vw_true_roas"} and spark.table("vw_trends").count() == 1
    root = tempfile.mkdtemp(prefix="marts-")
    done = pub.materialize({"trends": df}, root)
    assert done == ["fct_marketing__trends"] and spark.read.parquet(f"{root}/fct_marketing__trends").count() == 1
