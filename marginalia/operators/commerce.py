"""Store (D2C) and marketplace commerce operators.

Inputs are role-shaped DataFrames (see ``marginalia.sources.roles`` for the
columns each role carries).  All operators are lazy; nothing is collected.

Scale notes
* Aggregations are plain ``groupBy`` so Spark does map-side partial
  aggregation before the shuffle: a hot sku/date/customer is pre-reduced on
  every mapper and never lands whole in one task.
* Lookups derived from data (cost tables) are aggregated to one row per key
  before the join; AQE turns the join into a broadcast only after measuring
  that side at runtime (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
  otherwise it stays a sort-merge join.
* Daily spines are built as ``unionByName`` + one ``groupBy`` instead of a
  distinct date list followed by four left joins (one shuffle instead of five).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import month_diff, month_start, norm_key, nz, round_half_away, safe_div
from marginalia.functions.windows import many, running_sums, spread

# Fixed values that must equal the reference's for equal results:
#   partnership revenue share kept: 0.40 (the partnership product's title is a
#   per-deployment setting, PARTNER_TITLE, not a value of the source project)
#   gift-card rule: lower(title) like "%gift card%"
#   flat shipping per order: 5.35
#   fallback cost of goods: 0.40 of net revenue
#   payment fees: 0.029 of net revenue + 0.30 per order
#   marketplace fee rates of sales: selling 0.15, refunds 0.03, shipping 0.01
PARTNER_TITLE = "Partner Product"
PARTNER_SHARE = 0.40
GIFT_CARD_LIKE = "%gift card%"
SHIPPING_PER_ORDER = 5.35
FALLBACK_COGS_RATE = 0.40
FEE_RATE = 0.029
FEE_PER_ORDER = 0.30
MARKETPLACE_FEES = {"selling_fees": 0.15, "refunds": 0.03, "shipping_fees": 0.01}
EXCLUDED_STATUSES = ("refunded", "voided")


def _line_net(partner_title: str, partner_share: float):
    gross = F.col("price").cast("double") * F.col("quantity")
    net = gross - F.col("total_discount")
    return gross, F.when(F.col("title") == partner_title, net * partner_share).otherwise(net)


def cost_lookup(costs: DataFrame, sku_col: str = "sku", cost_col: str = "cogs") -> DataFrame:
    """One average unit cost per normalised sku key (NULL skus/costs ignored)."""
    return (costs.where(F.col(sku_col).isNotNull() & F.col(cost_col).isNotNull())
            .groupBy(norm_key(sku_col).alias("sku_key"))
            .agg(F.avg(cost_col).alias("unit_cost")))


def product_profitability(lines: DataFrame, orders: DataFrame, shop_costs: DataFrame,
                          market_costs: DataFrame, *, shipping_per_order: float = SHIPPING_PER_ORDER,
                          partner_title: str = PARTNER_TITLE, partner_share: float = PARTNER_SHARE,
                          gift_card_like: str = GIFT_CARD_LIKE,
                          fallback_cogs_rate: float = FALLBACK_COGS_RATE, rows: int = 0) -> DataFrame:
    """K-14: sku x title x order day P&L with cost-of-goods resolution.

    Cost precedence: partnership -> 0; gift card -> net revenue; shop cost
    table; marketplace cost table; flat fallback share of net revenue.  The
    ``cogs_source`` label uses the same precedence (one list, see R-10).
    Shipping is allocated to lines by their share of the order's net revenue.
    ``rows``: how many lines there are, if known; no task's share grows with it.
    """
    gross, net = _line_net(partner_title, partner_share)
    title = F.col("title")
    # Lines meet their order in one task, spread over all shuffle partitions.  The order's net total is a window over
    # them there (rows of a long order spill), so a line needs no row of its own in a hash map before it is added to
    # its day; a line's share of the flat shipping is its share of the order's net revenue.  What the title says is
    # added to the finished days.
    order_net = F.sum("net_revenue").over(Window.partitionBy("order_id"))
    detail = (spread(lines, "order_id", rows=rows).join(orders.select("order_id", "order_date"), "order_id")
              .select(
                  F.coalesce(F.when(F.col("sku") != "", F.col("sku")),
                             F.concat(F.lit("NO_SKU_"), F.replace(title, F.lit(" "), F.lit("_")))).alias("sku"),
                  "title", "order_id", "order_date", "quantity", gross.alias("gross_revenue"), "total_discount",
                  net.alias("net_revenue"))
              .withColumn("item_shipping_cost",
                          F.lit(shipping_per_order) * safe_div(F.col("net_revenue"), order_net)))
    # Few lines of real products share their day, so a task holds a group a line; where that is too many for the
    # session's shuffle partitions, which nothing splits, lines are dealt to as many as they need.
    if many(lines.sparkSession, rows):
        detail = spread(detail.drop("order_id"), "sku", "title", "order_date", rows=rows)
    daily = (detail.groupBy("sku", "title", "order_date").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("total_discount").alias("total_discounts"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("item_shipping_cost").alias("estimated_shipping_cost"))
        .withColumns({"is_partnership": title == partner_title,
                      "is_gift_card": F.lower(title).like(gift_card_like)}))
    shop = cost_lookup(shop_costs).withColumnRenamed("unit_cost", "shop_cost")
    market = cost_lookup(market_costs).withColumnRenamed("unit_cost", "market_cost")
    keyed = daily.withColumn("sku_key", norm_key("sku"))
    withc = keyed.join(shop, "sku_key", "left").join(market, "sku_key", "left")
    resolved = F.coalesce("shop_cost", "market_cost")
    source = (F.when(F.col("is_partnership"), "partnership")
              .when(F.col("is_gift_card"), "gift_card")
              .when(F.col("shop_cost").isNotNull(), "shop_seed")
              .when(F.col("market_cost").isNotNull(), "amazon_map")
              .otherwise("fallback_40pct"))
    cogs = (F.when(F.col("is_partnership"), F.lit(0.0))
            .when(F.col("is_gift_card"), F.col("net_revenue"))
            .when(resolved.isNotNull(), resolved * F.col("units_sold"))
            .otherwise(F.col("net_revenue") * fallback_cogs_rate))
    out = withc.select("sku", "title", "order_date", "units_sold", "gross_revenue", "total_discounts",
                       "net_revenue", "is_partnership", "is_gift_card",
                       source.alias("cogs_source"), cogs.alias("total_cogs"),
                       "estimated_shipping_cost")
    gp = F.col("net_revenue") - F.col("total_cogs")
    contrib = gp - F.col("estimated_shipping_cost")
    return out.select(
        "sku", "title", "order_date", "units_sold", "gross_revenue", "total_discounts", "net_revenue",
        "is_partnership", "is_gift_card", "cogs_source", "total_cogs",
        gp.alias("gross_profit"), safe_div(gp, F.col("net_revenue")).alias("gross_margin"),
        F.col("cogs_source").isin("shop_seed", "amazon_map", "partnership", "gift_card").alias("has_actual_cogs"),
        "estimated_shipping_cost", contrib.alias("contribution_profit"),
        safe_div(contrib, F.col("net_revenue")).alias("contribution_margin"))


def d2c_daily_pnl(orders: DataFrame, profitability: DataFrame, search_spend: DataFrame,
                  social_spend: DataFrame, *, fee_rate: float = FEE_RATE,
                  fee_per_order: float = FEE_PER_ORDER, rows: int = 0) -> DataFrame:
    """K-16: daily contribution stack over a date spine of four feeds.

    ``search_spend`` / ``social_spend`` carry (date_start, spend) rows.
    The spine is a union of the four pre-aggregated feeds summed by date.
    ``rows``: how many order lines there are, if known, which bounds the orders a task counts.
    """
    zero = F.lit(None).cast("double")
    if many(orders.sparkSession, rows):
        orders = spread(orders.select("order_id", "order_date"), "order_id", rows=rows)
    o = orders.groupBy("order_date").agg(F.count_distinct("order_id").alias("orders"))
    p = profitability.groupBy("order_date").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("net_revenue").alias("net_revenue"), F.sum("total_cogs").alias("total_cogs"),
        F.sum("estimated_shipping_cost").alias("estimated_shipping"))
    g = (search_spend.where(F.col("date_start").isNotNull())
         .groupBy(F.col("date_start").cast("date").alias("order_date"))
         .agg(F.sum("spend").alias("google_ads_spend")))
    m = (social_spend.where(F.col("date_start").isNotNull())
         .groupBy(F.col("date_start").cast("date").alias("order_date"))
         .agg(F.sum("spend").alias("meta_ads_spend")))
    cols = ["orders", "units_sold", "gross_revenue", "net_revenue", "total_cogs",
            "estimated_shipping", "google_ads_spend", "meta_ads_spend"]
    stacked = None
    for part in (o, p, g, m):
        have = set(part.columns)
        part = part.select("order_date", *[
            (F.col(k) if k in have else (F.lit(None).cast("bigint") if k in ("orders", "units_sold") else zero)).alias(k)
            for k in cols])
        stacked = part if stacked is None else stacked.unionByName(part)
    j = (stacked.where(F.col("order_date").isNotNull())
         .groupBy("order_date").agg(*[nz(F.sum(k), 0).alias(k) for k in cols]))
    fees = F.col("net_revenue") * fee_rate + F.col("orders") * fee_per_order
    j = j.withColumn("shopify_fees_est", fees)
    contrib = (F.col("net_revenue") - F.col("total_cogs") - F.col("estimated_shipping")
               - F.col("shopify_fees_est") - F.col("google_ads_spend") - F.col("meta_ads_spend"))
    return j.select(
        "order_date", "orders", "units_sold", "gross_revenue", "net_revenue", "total_cogs",
        "estimated_shipping", "shopify_fees_est", "google_ads_spend", "meta_ads_spend",
        (F.col("google_ads_spend") + F.col("meta_ads_spend")).alias("total_ad_spend"),
        contrib.alias("d2c_contribution"),
        safe_div(contrib, F.col("net_revenue")).alias("d2c_contribution_margin"))


def d2c_monthly_pnl(daily: DataFrame) -> DataFrame:
    """T-04: month roll-up; money rounded to cents, ratios on unrounded sums."""
    sums = ["orders", "units_sold", "gross_revenue", "net_revenue", "total_cogs", "estimated_shipping",
            "shopify_fees_est", "google_ads_spend", "meta_ads_spend", "total_ad_spend", "d2c_contribution"]
    m = daily.groupBy(month_start("order_date").alias("month")).agg(*[F.sum(k).alias(k) for k in sums])
    money = sums[2:]
    return m.select(
        "month", "orders", "units_sold", *[round_half_away(k, 2).alias(k) for k in money],
        safe_div(F.col("d2c_contribution"), F.col("net_revenue")).alias("d2c_contribution_margin"),
        safe_div(F.col("total_ad_spend"), F.col("net_revenue")).alias("ad_spend_pct_of_revenue"),
        safe_div(F.col("net_revenue"), F.col("total_ad_spend")).alias("blended_roas"))


def customer_cohorts(orders: DataFrame, lines: DataFrame, market_costs: DataFrame, *,
                     partner_title: str = PARTNER_TITLE, partner_share: float = PARTNER_SHARE,
                     fallback_cogs_rate: float = FALLBACK_COGS_RATE,
                     shipping_per_order: float = SHIPPING_PER_ORDER) -> DataFrame:
    """K-15: one row per customer order with cohort month and running profit.

    Running sums are ordered by (order_date, order_id) so same-day orders get
    a deterministic order (R-05).  They are computed with ``running_sums``,
    which slices a customer with very many orders across tasks.
    """
    _, net = _line_net(partner_title, partner_share)
    li = (lines.where(F.col("sku").isNotNull() & (F.col("sku") != ""))
          .select("order_id", "sku", "quantity", net.alias("net_revenue"),
                  (F.col("title") == partner_title).alias("is_partnership")))
    costs = cost_lookup(market_costs)
    li = li.join(costs, norm_key(li["sku"]) == costs["sku_key"], "left")
    line_cogs = (F.when(F.col("is_partnership"), F.lit(0.0))
                 .when(F.col("unit_cost").isNotNull(), F.col("unit_cost") * F.col("quantity"))
                 .otherwise(F.col("net_revenue") * fallback_cogs_rate))
    o = orders.where(F.col("customer_id").isNotNull()).select("order_id", "customer_id", "order_date")
    op = (o.join(li.select("order_id", "net_revenue", line_cogs.alias("cogs")), "order_id")
          .groupBy("order_id", "customer_id", "order_date")
          .agg(F.sum("net_revenue").alias("net_revenue"), F.sum("cogs").alias("total_cogs")))
    op = (op.withColumn("gross_profit", F.col("net_revenue") - F.col("total_cogs"))
          .withColumn("estimated_shipping_cost", F.lit(shipping_per_order))
          .withColumn("contribution_profit", F.col("gross_profit") - F.lit(shipping_per_order)))
    j = running_sums(op, ["customer_id"], ["order_date", "order_id"],
                     {"cumulative_gross_profit": "gross_profit",
                      "cumulative_contribution_profit": "contribution_profit"},
                     first_bucket_as="first_order_date")
    return j.select(
        "order_id", "customer_id", "order_date", "first_order_date",
        month_start("first_order_date").alias("cohort_month"),
        month_diff("order_date", "first_order_date").alias("months_since_first_order"),
        "net_revenue", "total_cogs", "gross_profit", "cumulative_gross_profit",
        "estimated_shipping_cost", "contribution_profit", "cumulative_contribution_profit")


def customer_ltv(cohorts: DataFrame, as_of: str, *, horizon_months: int = 6) -> DataFrame:
    """T-03: six-month value per cohort, mature customers only (explicit as_of)."""
    per = (cohorts.where(F.col("months_since_first_order") < horizon_months)
           .groupBy("customer_id", "cohort_month", "first_order_date")
           .agg(F.count_distinct("order_id").alias("orders_in_6mo"),
                F.sum("gross_profit").alias("gross_profit_6mo"),
                F.sum("net_revenue").alias("revenue_6mo"),
                F.sum("contribution_profit").alias("contribution_profit_6mo"),
                F.sum("estimated_shipping_cost").alias("shipping_cost_6mo")))
    mature = per.where(month_diff(F.lit(as_of).cast("date"), "first_order_date") >= horizon_months)
    return mature.groupBy("cohort_month").agg(
        F.count_distinct("customer_id").alias("cohort_size"),
        F.avg("gross_profit_6mo").alias("avg_ltv_6mo"),
        F.avg("revenue_6mo").alias("avg_revenue_6mo"),
        F.avg("orders_in_6mo").alias("avg_orders_6mo"),
        F.sum("gross_profit_6mo").alias("total_gross_profit_6mo"),
        F.sum("revenue_6mo").alias("total_revenue_6mo"),
        safe_div(F.sum("gross_profit_6mo"), F.sum("revenue_6mo")).alias("cohort_gross_margin"),
        F.avg("contribution_profit_6mo").alias("avg_contribution_ltv_6mo"),
        F.sum("contribution_profit_6mo").alias("total_contribution_profit_6mo"),
        F.sum("shipping_cost_6mo").alias("total_shipping_cost_6mo"),
        safe_div(F.sum("contribution_profit_6mo"), F.sum("revenue_6mo")).alias("cohort_contribution_margin"))


def product_performance(lines: DataFrame, orders: DataFrame, products: DataFrame, *,
                        excluded_statuses=EXCLUDED_STATUSES) -> DataFrame:
    """K-13: product x title x type x source x medium x campaign sales.

    ``not in`` drops NULL statuses as the SQL three-valued logic does.
    """
    o = (orders.where(~F.col("financial_status").isin(*excluded_statuses))
         .select("order_id", "utm_source", "utm_medium", "utm_campaign"))
    p = products.select("product_id", F.col("title").alias("p_title"), "product_type")
    # the distinct orders of a group cost a task two hash maps of its lines and one of its groups, so lines are spread
    j = spread(lines, "order_id").join(o, "order_id").join(p, "product_id", "left")
    return j.groupBy(
        "product_id", F.coalesce("p_title", "title").alias("product_title"), "product_type",
        F.coalesce("utm_source", F.lit("direct")).alias("source"),
        F.coalesce("utm_medium", F.lit("none")).alias("medium"),
        F.col("utm_campaign").alias("campaign"),
    ).agg(
        F.count_distinct("order_id").alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("price") * F.col("quantity")).alias("gross_revenue"),
        F.sum("total_discount").alias("total_discounts"),
        F.sum(F.col("price") * F.col("quantity") - F.col("total_discount")).alias("net_revenue"),
        F.avg("price").alias("avg_price"))


def product_dimension(products: DataFrame, variants: DataFrame) -> DataFrame:
    """T-01: products with a rollup of their non-blank-sku variants."""
    v = (variants.where(F.col("sku").isNotNull() & (F.col("sku") != ""))
         .groupBy("product_id").agg(
             F.count(F.lit(1)).alias("variant_count"), F.min("price").alias("min_price"),
             F.max("price").alias("max_price"), F.sum("inventory_quantity").alias("total_inventory"),
             F.array_join(F.array_sort(F.collect_set("sku")), ", ").alias("skus")))
    return products.join(v, "product_id", "left").select(
        "product_id", "title", "handle", "product_type", "vendor", "status", "tags",
        "created_at", "updated_at", "variant_count", "min_price", "max_price",
        "total_inventory", "skus")


# --- marketplace ---------------------------------------------------------------

def marketplace_daily_ad_spend(ad_spend: DataFrame) -> DataFrame:
    """A-01: ad spend by (date, asin); grouped as staging deals the rows, so they are not shuffled again."""
    return ad_spend.groupBy("asin", "date").agg(
        F.sum("cost").alias("cost"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"), F.sum("ad_sales").alias("ad_sales")).select(
        "date", "asin", "cost", "impressions", "clicks", "ad_sales")


def marketplace_ad_spend_union(*feeds: DataFrame, columns=None) -> DataFrame:
    """A-02 / A-03: align product-level (or campaign-level) ad feeds and stack them."""
    out = None
    for f in feeds:
        f = f.select(*columns) if columns else f
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def marketplace_daily_orders(orders_clean: DataFrame) -> DataFrame:
    """A-04: marketplace order lines summed by purchase day and asin."""
    return orders_clean.groupBy("asin", F.col("purchase_date").cast("date").alias("purchase_date_utc")).agg(
        F.sum("quantity").alias("quantity"), F.sum("item_price").alias("item_price"),
        F.sum("item_promotion_discount").alias("item_promotion_discount"), F.sum("sales").alias("sales")).select(
        "purchase_date_utc", "asin", "quantity", "item_price", "item_promotion_discount", "sales")


def marketplace_daily_profitability(daily_orders: DataFrame, daily_ad_spend: DataFrame,
                                    product_map: DataFrame, *, fees=None) -> DataFrame:
    """T-02: orders + ad spend + product costs -> costs and contribution per day x asin.

    A missing product cost leaves ``total_costs``/``contribution`` NULL, as in
    the source model.  The product comes before the day in the join's keys: a
    sort compares the first key's prefix, and a day has very many rows.
    """
    fees = fees or MARKETPLACE_FEES
    ads = daily_ad_spend.select(F.col("date").cast("date").alias("purchase_date_utc"), "asin",
                                "impressions", "clicks", "ad_sales", "cost")
    pm = product_map.select("asin", "cogs", "fba_cost", "title", "category", "subcategory", "sku")
    j = daily_orders.join(ads, ["asin", "purchase_date_utc"], "left").join(pm, "asin", "left")
    j = j.select(
        "purchase_date_utc", "asin", "quantity", "item_price", "item_promotion_discount",
        "impressions", "clicks", "ad_sales", "sales", nz("cost", 0.0).alias("ad_cost"),
        (F.col("cogs") * F.col("quantity")).alias("total_cogs"), "cogs", "fba_cost",
        (F.col("fba_cost") * F.col("quantity")).alias("total_fba_cost"),
        *[(F.col("sales") * rate).alias(name) for name, rate in fees.items()],
        "title", "category", "subcategory", "sku")
    total = (F.col("total_cogs") + F.col("total_fba_cost") + F.col("ad_cost")
             + sum((F.col(n) for n in fees), F.lit(0.0)))
    return j.withColumn("total_costs", total).withColumn("contribution", F.col("sales") - F.col("total_costs"))
