import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginalia.operators import marketing as mk

EV = ("event_date date, event_ts timestamp, event_name string, user_pseudo_id string, transaction_id string, "
      "purchase_revenue double, manual_source string, manual_medium string, manual_campaign string, "
      "traffic_source string, traffic_medium string, traffic_name string, "
      "items array<struct<item_name:string,item_id:string,price:double,quantity:long>>")


def ev(d, h, name, user, tx=None, rev=None, ms=None, mm=None, ts_=None, tm=None, items=None):
    return (d, dt.datetime(d.year, d.month, d.day, h), name, user, tx, rev, ms, mm, None, ts_, tm, None, items or [])


D1, D2 = dt.date(2024, 1, 10), dt.date(2024, 1, 11)


def events(spark):
    return spark.createDataFrame([
        ev(D1, 1, "session_start", "u1", ms="google", mm="cpc"),
        ev(D1, 2, "view_item", "u1", ms="google", mm="cpc", items=[("Hat", "H1", 10.0, 2)]),
        ev(D1, 3, "view_item", "u1", ms="google", mm="cpc", items=[("Hat", "H1", 10.0, 1)]),
        ev(D1, 4, "add_to_cart", "u1", ms="google", mm="cpc", items=[("Hat", "H1", 10.0, 1)]),
        ev(D1, 5, "purchase", "u1", "100", 20.0, ms="google", mm="cpc", items=[("Hat", "H1", 10.0, 2)]),
        ev(D1, 6, "purchase", "u2", "100", 25.0, tm="organic"),       # later event of the same transaction
        ev(D1, 7, "session_start", None, ms="google", mm="cpc"),
        ev(D2, 1, "purchase", "u3", "200", 5.0, ts_="(direct)", tm="(none)"),
        ev(dt.date(2023, 1, 1), 1, "purchase", "u4", "300", 5.0),     # outside the 90-day window
    ], EV)


def orders(spark):
    return spark.createDataFrame([(100, 110.0, 10.0, "paid", None, None), (200, 50.0, None, "paid", None, None)],
                                 "order_id long, total_price double, total_tax double, financial_status string, "
                                 "utm_source string, utm_medium string")


def test_attribution_latest_event(spark):
    a = {r.transaction_id: r for r in mk.attribution(events(spark), orders(spark), "2024-01-31").collect()}
    assert set(a) == {"100", "200"}
    assert a["100"].ga4_source is None and a["100"].ga4_medium == "organic" and a["100"].ga4_revenue == 25.0
    assert a["100"].shopify_revenue == 100.0 and a["200"].shopify_revenue == 50.0


def test_funnel_two_phase_equals_distinct(spark):
    e = events(spark)
    got = {(r.report_date, r.source, r.medium): r for r in mk.funnel(e, "2024-01-31").collect()}
    g = got[(D1, "google", "cpc")]
    assert (g.sessions, g.product_views, g.add_to_carts, g.purchases) == (1, 1, 1, 1)
    assert g.view_to_cart_rate == 1.0 and g.checkouts == 0
    # the NULL-user session still creates no count
    want = (e.where(F.col("event_name") == "session_start")
            .groupBy("event_date").agg(F.count_distinct("user_pseudo_id").alias("n")).collect())
    assert sum(r.n for r in want) == sum(r.sessions for r in got.values())


def test_channel_summary_double_counts_null_source_organic(spark):
    a = mk.attribution(events(spark), orders(spark), "2024-01-31")
    social = spark.createDataFrame([], "date_start date, spend double, impressions long, clicks long, "
                                       "purchases long, purchase_value double")
    search = spark.createDataFrame([(D1, 10.0, 100, 5, 2.5, 30.0)], "date_start date, spend double, "
                                   "impressions long, clicks long, conversions double, conversion_value double")
    rows = {(r.report_date, r.channel): r for r in mk.channel_summary(social, search, a).collect()}
    assert rows[(D1, "organic")].conversions == 1.0
    assert rows[(D1, "direct")].conversions == 1.0            # NULL source counted as direct as well
    assert rows[(D1, "google_ads")].orders == 3               # 2.5 rounds half away from zero
    roas = {r.channel: r for r in mk.enhanced_roas(a, social, search).collect()}
    assert roas["organic"].ad_spend is None


def test_product_insights(spark):
    r = mk.product_insights(events(spark), "2024-01-31").first()
    assert (r.product_views, r.add_to_carts, r.purchases, r.revenue) == (2, 1, 1, 20.0)
    assert r.cart_to_purchase_rate == 1.0


def test_trends_rows_not_days(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, d), float(d), 1.0, 1, 1.0) for d in (1, 2, 5)],
                                  "report_date date, meta_spend double, shopify_meta_revenue double, "
                                  "shopify_meta_orders long, true_roas double")
    rows = mk.trends(daily).orderBy("report_date").collect()
    assert rows[2].spend_7d_avg == pytest.approx(8 / 3)
    assert rows[2].spend_dod_change == 3.0 and rows[2].spend_wow_change is None
