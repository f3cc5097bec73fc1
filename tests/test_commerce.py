import datetime as dt

import pytest

from marginalia.operators import commerce as cm

D = dt.date(2024, 1, 31)
LINES = "order_id long, sku string, title string, quantity long, price double, total_discount double"
ORDERS = "order_id long, order_date date, customer_id long"
COSTS = "sku string, cogs double"


def frames(spark):
    lines = spark.createDataFrame([
        (1, "A-1", "Widget", 2, 10.0, 0.0),          # shop cost (also in market table: shop wins)
        (1, "B-1", "Gadget", 1, 30.0, 5.0),          # market cost
        (1, "", "Blank Sku", 1, 10.0, 0.0),          # NO_SKU_Blank_Sku -> fallback 40%
        (2, "P-1", "Partner Product", 1, 100.0, 0.0),  # partnership: 40% revenue kept, cost 0
        (2, "G-1", "Store Gift Card", 1, 50.0, 0.0),  # gift card: cost = net
        (3, "Z-1", "Freebie", 1, 0.0, 0.0),          # order with net revenue 0
    ], LINES)
    orders = spark.createDataFrame([(1, D, 10), (2, D, 10), (3, D, 11)], ORDERS)
    shop = spark.createDataFrame([(" a-1 ", 3.0), ("A-1", 5.0)], COSTS)  # avg per normalised key = 4
    market = spark.createDataFrame([("a-1", 100.0), ("b-1", 7.0), (None, 1.0)], COSTS)
    return lines, orders, shop, market


def test_cost_precedence_and_shipping(spark):
    lines, orders, shop, market = frames(spark)
    out = {r.sku: r for r in cm.product_profitability(lines, orders, shop, market).collect()}
    assert out["A-1"].cogs_source == "shop_seed" and out["A-1"].total_cogs == pytest.approx(8.0)
    assert out["B-1"].cogs_source == "amazon_map" and out["B-1"].total_cogs == pytest.approx(7.0)
    assert out["NO_SKU_Blank_Sku"].cogs_source == "fallback_40pct"
    assert out["NO_SKU_Blank_Sku"].total_cogs == pytest.approx(4.0)
    assert out["P-1"].net_revenue == pytest.approx(40.0) and out["P-1"].total_cogs == 0.0
    assert out["G-1"].total_cogs == pytest.approx(50.0) and out["G-1"].gross_profit == pytest.approx(0.0)
    # shipping of order 1 (net 20 + 25 + 10 = 55) is split by net share and sums to 5.35
    s = out["A-1"].estimated_shipping_cost + out["B-1"].estimated_shipping_cost + \
        out["NO_SKU_Blank_Sku"].estimated_shipping_cost
    assert s == pytest.approx(5.35)
    # order with zero net revenue: share undefined -> NULL shipping, NULL margin
    assert out["Z-1"].estimated_shipping_cost is None and out["Z-1"].gross_margin is None


def test_daily_spine_and_monthly(spark):
    lines, orders, shop, market = frames(spark)
    prof = cm.product_profitability(lines, orders, shop, market)
    g = spark.createDataFrame([(dt.date(2024, 2, 1), 10.0), (None, 99.0)], "date_start date, spend double")
    m = spark.createDataFrame([(D, 4.0)], "date_start date, spend double")
    daily = {r.order_date: r for r in cm.d2c_daily_pnl(orders, prof, g, m).collect()}
    assert set(daily) == {D, dt.date(2024, 2, 1)}          # date only present in one feed kept
    assert daily[dt.date(2024, 2, 1)].orders == 0 and daily[dt.date(2024, 2, 1)].google_ads_spend == 10.0
    assert daily[D].orders == 3 and daily[D].meta_ads_spend == 4.0
    fees = daily[D].net_revenue * 0.029 + 3 * 0.30
    assert daily[D].shopify_fees_est == pytest.approx(fees)
    monthly = {r.month: r for r in cm.d2c_monthly_pnl(cm.d2c_daily_pnl(orders, prof, g, m)).collect()}
    assert monthly[dt.date(2024, 1, 1)].orders == 3
    assert monthly[dt.date(2024, 2, 1)].blended_roas == 0.0


def test_cohorts_running_sum_and_ltv(spark):
    lines = spark.createDataFrame([
        (1, "A", "x", 1, 10.0, 0.0), (2, "A", "x", 1, 20.0, 0.0), (3, "A", "x", 1, 30.0, 0.0),
        (4, "", "x", 1, 99.0, 0.0)], LINES)
    orders = spark.createDataFrame([
        (1, dt.date(2024, 1, 31), 7), (2, dt.date(2024, 3, 1), 7), (3, dt.date(2024, 3, 1), 7),
        (4, dt.date(2024, 3, 1), None)], ORDERS)
    market = spark.createDataFrame([("a", 1.0)], COSTS)
    rows = {r.order_id: r for r in cm.customer_cohorts(orders, lines, market).collect()}
    assert set(rows) == {1, 2, 3}                    # NULL customer and blank-sku-only order dropped
    assert rows[2].months_since_first_order == 2     # Jan 31 -> Mar 1 crosses two month boundaries
    assert rows[1].cumulative_gross_profit == pytest.approx(9.0)
    assert rows[2].cumulative_gross_profit == pytest.approx(28.0)   # same-day ties ordered by order id
    assert rows[3].cumulative_gross_profit == pytest.approx(57.0)
    ltv = cm.customer_ltv(cm.customer_cohorts(orders, lines, market), "2024-09-01").collect()
    assert len(ltv) == 1 and ltv[0].cohort_size == 1 and ltv[0].avg_orders_6mo == 3.0
    assert cm.customer_ltv(cm.customer_cohorts(orders, lines, market), "2024-06-01").count() == 0


def test_product_dimension_and_empty_input(spark):
    products = spark.createDataFrame([(1, "t", "h", "ty", "v", "active", "", None, None)],
                                     "product_id long, title string, handle string, product_type string, "
                                     "vendor string, status string, tags string, created_at timestamp, "
                                     "updated_at timestamp")
    variants = spark.createDataFrame([(1, 2.0, 3, "b"), (1, 1.0, 4, "a"), (1, 9.0, 1, ""), (1, 5.0, 1, "a")],
                                     "product_id long, price double, inventory_quantity long, sku string")
    r = cm.product_dimension(products, variants).first()
    assert (r.variant_count, r.min_price, r.max_price, r.total_inventory, r.skus) == (3, 1.0, 5.0, 8, "a, b")
    empty = cm.product_dimension(products.limit(0), variants)
    assert empty.count() == 0 and "skus" in empty.columns
