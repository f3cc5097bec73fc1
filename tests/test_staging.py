import datetime as dt
from decimal import Decimal

from marginalia.operators import staging as st


def test_keep_all_ties_dedup(spark):
    raw = spark.createDataFrame([
        (dt.date(2024, 1, 1), "A", "1.5", "10", "1", "3.0", 1), (dt.date(2024, 1, 1), "A", "2.5", "10", "1", "3.0", 1),
        (dt.date(2024, 1, 1), "A", "9.0", "10", "1", "3.0", 0), (dt.date(2024, 1, 1), "B", None, "1", "0", "0", 0)],
        "date date, advertised_asin string, cost string, impressions string, clicks string, sales14d string, "
        "_loaded_at int")
    rows = sorted((r.asin, r.cost) for r in st.stage(raw, "amazon__ad_spend").collect())
    assert rows == [("A", 1.5), ("A", 2.5), ("B", 0.0)]


def test_latest_row_dedup(spark):
    raw = spark.createDataFrame([("c", "p", "2024-01-01", "5", 1), ("c", "p", "2024-01-01", "7", 2),
                                 ("d", "p", "2024-01-01", "1", 1)],
                                "child_asin string, parent_asin string, report_date string, units_ordered string, "
                                "_loaded_at int")
    for c in ["units_ordered_b2b", "total_order_items", "ordered_product_sales_amount", "ordered_product_sales_currency",
              "sessions", "page_views", "buy_box_percentage", "unit_session_percentage"]:
        raw = raw.withColumn(c, raw["units_ordered"])
    got = {r.child_asin: r.units_ordered for r in st.stage(raw, "amazon__traffic").collect()}
    assert got == {"c": 7, "d": 1}


def test_orders_clean_fx_and_filters(spark):
    cols = ("sku string, asin string, currency string, quantity string, item_price string, item_status string, "
            "order_status string, ship_country string, sales_channel string, purchase_date string, "
            "amazon_order_id string, ship_service_level string, item_promotion_discount string")
    raw = spark.createDataFrame([
        ("s", "a", "CAD", "1", "100", "Shipped", "Shipped", "CA", "x", "2024-01-01T08:00:00Z", "o1", "std", "10"),
        ("s", "a", "CAD", "1", "100", "Shipped", "Shipped", "CA", "x", "2024-01-01T08:00:00Z", "o1", "std", "10"),
        ("s", "a", "USD", None, "5", "Cancelled", "Shipped", "US", "x", "2024-01-01T08:00:00Z", "o2", "std", None),
        ("s", "a", "USD", "1", "5", None, "Shipped", "US", "x", "2024-01-01T08:00:00Z", "o3", "std", None)], cols)
    rows = st.orders_clean(raw).collect()
    assert len(rows) == 1
    assert rows[0].sales == Decimal("64.8")
    assert rows[0].purchase_date_pac == dt.datetime(2024, 1, 1, 0, 0)


def test_partner_mapping_filter_and_video_rounding(spark):
    raw = spark.createDataFrame([("", "e", "b", "1", "2"), ("Ann", "e", "b", "3", "4.5")],
                                "sender_name string, sender_email string, partner_brand string, payments string, "
                                "total_amount string")
    for c in ["currencies", "first_payment", "last_payment", "sample_subjects"]:
        raw = raw.withColumn(c, raw["sender_email"])
    r = st.stage(raw, "quickbooks__partner_mapping").collect()
    assert len(r) == 1 and r[0].payment_count == 3
    v = spark.createDataFrame([("v", "2024-01-01", "2024-01-31", 10, 5.0, 95.0, 0.123456, 1, 2, 3, 5, 2, "2024-02-01")],
                              "video_id string, period_start string, period_end string, views long, "
                              "estimated_minutes_watched double, avg_view_duration_seconds double, "
                              "avg_view_percentage double, likes long, comments long, shares long, "
                              "subscribers_gained long, subscribers_lost long, ingested_at string")
    r = st.stage(v, "youtube__video_analytics").first()
    assert (r.avg_view_duration_minutes, r.avg_view_percentage, r.net_subscribers) == (1.58, 0.1235, 3)


def test_ad_report_contract_and_optional_source(spark):
    raw = spark.createDataFrame([("2024-01-01", 5, "c", "ENABLED", 9, "100", "0", "2.5", "1", "10.0", "1", 1)],
                                "date string, campaign_id int, campaign_name string, campaign_status string, "
                                "profile_id int, impressions string, clicks string, cost string, "
                                "purchases14d string, sales14d string, units_sold_clicks14d string, _loaded_at int")
    r = st.stage(raw, "amazon_ads__sp_campaigns").first()
    assert (r.campaign_id, r.profile_id, r.ad_product, r.purchases, r.sales) == ("5", "9", "SPONSORED_PRODUCTS", 1, 10.0)
    assert r.cpc is None and r.ctr == 0.0 and r.acos == 0.25 and r.roas == 4.0
    empty = st.stage_optional(spark, "no_such_bidding_strategy", "google_ads__bidding_strategy")
    assert empty.count() == 0 and "target_cpa" in empty.columns
    assert len(st.SPECS) >= 63
