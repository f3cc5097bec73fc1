"""Checked writes, contracts, seeds before a feed, ordered extracts, ranked rows per period."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators import checked as ck
from marginalia.operators import serving as sv
from marginalia.operators import staging as st
from marginalia.sources import contracts as ct
from marginalia.sources import flatten as fl
from marginalia.sources import supplement as sp

RULES = [("not_null", "v"), ("unique", "k"), ("unique", "v"), ("accepted", "s", ["a", "b"]), ("between", "v", 0, 5), ("fresh", "t", "2024-01-10 00:00:00", 48)]


def rows(spark, *rs):
    return spark.createDataFrame(rs, "k int, s string, v int, t timestamp")


def day(d, m=1):
    return dt.datetime(2024, m, d)


# ---- checks

def test_violations_of_all_rules(spark):
    df = rows(spark, (1, "a", 1, day(9)), (1, "z", None, day(1)), (2, None, 9, None), (None, "b", -1, None), (None, "c", 1, None), (3, "a", 1, None))
    got = {(r.rule, r.column): r.violations for r in ck.violations(df, RULES).collect()}
    assert got == {("not_null", "v"): 1, ("unique", "k"): 1, ("unique", "v"): 1, ("accepted", "s"): 2, ("between", "v"): 2, ("fresh", "t"): 0}
    late = {r.rule: r.violations for r in ck.violations(df, [("fresh", "t", "2024-01-12 00:00:00", 48)]).collect()}
    assert late == {"fresh": 1}
    none = {r.rule + r.column: r.violations for r in ck.violations(df.limit(0), RULES).collect()}
    assert none.pop("fresht") == 1 and set(none.values()) == {0} and len(none) == 5


def test_violations_take_one_scan(spark, tmp_path):
    rows(spark, (1, "a", 1, day(9))).write.parquet(str(tmp_path / "t"))
    out = ck.violations(spark.read.parquet(str(tmp_path / "t")), RULES)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_a_write_counts_its_rows(spark, tmp_path):
    df = rows(spark, (1, "a", 1, day(9)), (2, "z", None, day(1)))
    n, broken = ck.write_checked(df, str(tmp_path / "t"), RULES)
    assert (n, broken) == (2, {"not_null:v": 1, "accepted:s": 1, "between:v": 0, "fresh:t": 0})
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_loads_are_logged_also_when_they_fail(spark, tmp_path):
    log, df = str(tmp_path / "log"), rows(spark, (1, "a", 1, day(9)))
    ck.run_load(spark, df, str(tmp_path / "t"), log, "r1", "feed", rules=RULES)
    with pytest.raises(Exception, match="broken feed"):
        ck.run_load(spark, df.withColumn("s", F.raise_error(F.lit("broken feed"))), str(tmp_path / "u"), log, "r2", "feed")
    got = {r.run_id: r for r in spark.read.parquet(log).collect()}
    assert (got["r1"].status, got["r1"].rows_loaded, got["r1"].error_message) == ("success", 1, "")
    assert (got["r2"].status, got["r2"].rows_loaded) == ("error", None) and got["r2"].error_message


# ---- contracts

CONTRACT = "k:int s:string v:bigint"


def test_differences_name_each_fault(spark):
    good = rows(spark, (1, "a", 1, day(9))).select("k", "s", F.col("v").cast("long").alias("v"))
    assert ct.differences(good, CONTRACT, ("k",)) == []
    for c in good.columns:  # any column that goes is noticed
        assert ct.differences(good.drop(c), CONTRACT) == [f"missing: {c}"]
    assert ct.differences(good.select("s", "k", "v"), CONTRACT) == ["order: s k v"]
    assert ct.differences(good.withColumn("v", F.lit("x")).withColumn("w", F.lit(1)), CONTRACT, ("id",)) == ["unknown: w", "type: v is string, not bigint", "key: id"]


def test_align_needs_a_reason_for_what_differs(spark):
    df = rows(spark, (1, "a", 1, day(9)))
    with pytest.raises(ValueError, match="unknown: t"):
        ct.align(df, CONTRACT)
    with pytest.raises(ValueError, match="missing: v"):
        ct.align(df.drop("v"), CONTRACT, dropped={"t": "not asked"})
    with pytest.raises(ValueError, match="padded, but there: s"):
        ct.align(df, CONTRACT, {"s": "none"}, {"t": "not asked"})
    out = ct.union_aligned([(df, {}, {"t": ""}), (df.drop("v").select("t", "s", "k"), {"v": "no counts"}, {"t": ""})], CONTRACT)
    assert ct.differences(out, CONTRACT) == [] and sorted(map(tuple, out.collect()), key=str) == [(1, "a", 1), (1, "a", None)]


STAGED = {  # the contracts that lacked columns: name -> (columns, raw columns that differ from them)
    "amazon__fba_fees": "sku asin product_name product_group brand fulfilled_by product_size_tier your_price sales_price estimated_fee_total estimated_referral_fee_per_unit "
                        "estimated_variable_closing_fee estimated_order_handling_fee estimated_pick_pack_fee_per_unit estimated_weight_handling_fee "
                        "expected_fulfillment_fee_per_unit currency _loaded_at",
    "amazon__fba_shipments": "amazon_order_id sku shipment_id shipment_item_id buyer_email carrier tracking_number fulfillment_center_id quantity_shipped item_price ship_city "
                             "ship_state ship_postal_code ship_country shipment_date estimated_arrival_date _loaded_at",
    "google_ads__auction_insights": "date campaign_id campaign_name competitor_domain impression_share overlap_rate position_above_rate top_of_page_rate outranking_share ingested_at",
    "google_trends__interest_over_time": "week keyword interest_score is_partial ingested_at",
    "klaviyo__campaign_metrics": "campaign_id campaign_name send_date recipients delivered opens clicks unsubscribes conversions revenue ingested_at",
    "klaviyo__campaigns": "campaign_id campaign_name status send_time created_at updated_at ingested_at",
    "paypal__transactions": "transaction_id transaction_at transaction_date transaction_updated_at transaction_amount fee_amount currency_code transaction_status "
                            "transaction_event_code transaction_subject transaction_note paypal_reference_id paypal_reference_id_type invoice_id custom_field payer_email "
                            "payer_account_id payer_given_name payer_surname payer_full_name payer_alternate_name first_item_name item_count ingested_at",
    "quickbooks__accounts": "account_id name fully_qualified_name account_type account_sub_type classification current_balance currency active created_at updated_at",
    "youtube__videos": "video_id title description published_at published_date channel_id tags category_id duration thumbnail_url privacy_status made_for_kids ingested_at",
}
RAW = {"google_ads__auction_insights": ["date_start", "domain"], "klaviyo__campaigns": ["id", "name"], "paypal__transactions": ["transaction_updated_date"],
       "amazon__fba_fees": ["estimated_order_handling_fee_per_order", "estimated_weight_handling_fee_per_unit"]}


@pytest.mark.parametrize("name", STAGED)
def test_staging_contracts_have_all_columns(spark, name):
    raw = {*STAGED[name].split(), *RAW.get(name, [])}
    df = spark.createDataFrame([tuple("2024-01-02" for _ in raw)], ", ".join(f"`{c}` string" for c in raw))
    for c, bad in (("made_for_kids", "true"), ("is_partial", "true"), ("active", "true")):
        df = df.withColumn(c, F.lit(bad)) if c in df.columns else df
    numbers = [o for o, e, t in st.SPECS[name]["cols"] if t in ("bigint", "double", st.MONEY)] + [e for o, e, t in st.SPECS[name]["cols"] if t == st.MONEY and isinstance(e, str)]
    df = df.withColumns({c: F.lit("1") for c in numbers if c in df.columns})
    out = st.stage(df, name)
    assert out.columns == STAGED[name].split()
    row = out.first()
    assert None not in row


# ---- seeds

def test_seed_stands_in_before_the_feed_only(spark):
    at = lambda *xs: spark.createDataFrame([(g, None if d is None else dt.date(2024, 1, d), v) for g, d, v in xs], "g string, d date, v int")
    feed = at(("a", 10, 1), ("a", 12, 2), ("b", 5, 3), (None, 7, 4))
    seed = at(("a", 9, 10), ("a", 10, 11), ("a", 11, 12), ("b", 4, 13), ("b", 30, 14), ("c", 20, 15), (None, 6, 16), (None, 8, 17), ("a", None, 18))
    assert sorted(r.v for r in sp.before_feed(seed, feed, "d", ["g"]).collect()) == [10, 13, 15, 16]
    assert sorted(r.v for r in sp.before_feed(seed, feed, "d").collect()) == [13]
    assert sorted(r.v for r in sp.cut_over(seed, feed, "d", ["g"]).collect()) == [1, 2, 3, 4, 10, 13, 15, 16]
    got = {r.g: (r.first_day.day, r.last_day.day, r.rows) for r in sp.overlaps(seed, feed, "d", ["g"]).collect()}
    assert got == {"a": (10, 11, 2), "b": (30, 30, 1), None: (8, 8, 1)}
    assert sp.overlaps(seed, feed, "d").first().rows == 7
    empty = feed.limit(0)
    assert sp.before_feed(seed, empty, "d").count() == 8 and sp.overlaps(seed, empty, "d").count() == 0 and sp.cut_over(empty, feed, "d").count() == 4


# ---- extracts and ranked rows

def test_files_of_an_extract_are_in_order(spark, tmp_path):
    rng = random.Random(1)
    data = [(rng.randint(0, 40), rng.choice("xyz"), k) for k in range(2000)]
    df = spark.createDataFrame(data, "a int, b string, k int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sv.write_ordered(df, str(tmp_path / "x"), [F.desc("a"), F.asc("b"), F.asc("k")], "csv", header="false")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(pathlib.Path(tmp_path / "x").glob("part-*"))
    lines = [x for f in files for x in f.read_text().splitlines()]
    assert len(files) > 1 and lines == [f"{a},{b},{k}" for a, b, k in sorted(data, key=lambda r: (-r[0], r[1], r[2]))]


def test_top_rows_of_each_period_without_a_window(spark):
    rng = random.Random(2)
    data = [(rng.choice(["p", "q", None]), rng.choice([None, *range(6)]), k) for k in range(300)] + [("hot", k % 50, k) for k in range(3000)]
    df = spark.createDataFrame(data, "p string, v int, k int").repartition(5)
    out = fl.top_n_per_period(df, "p", "v", 4)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    want = []
    for p in {d[0] for d in data}:
        own = [d for d in data if d[0] == p]
        own.sort(key=lambda r: (r[1] is None, -(r[1] or 0), f'{{"p":"{r[0]}","k":{r[2]}}}' if r[0] is not None else f'{{"k":{r[2]}}}'))
        want += own[:4]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert fl.top_n_per_period(df.limit(0), "p", "v", 4).count() == 0
