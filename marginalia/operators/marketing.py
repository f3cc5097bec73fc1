"""Marketing operators: web-analytics funnels and attribution, ad-platform
roll-ups, return on ad spend and rolling trends (K-01..K-08, K-17).

Inputs are role-shaped frames: ``events`` (web analytics events with
manual/traffic source fields and an ``items`` array), ``social``/``search``
(daily ad-platform rows), ``orders`` (store orders).

Scale notes
* "latest event per transaction" is a ``max(struct(ts, ...))`` aggregation,
  not a ``row_number`` window: partial aggregation reduces a hot transaction
  id on the mappers, and the struct ordering breaks timestamp ties
  deterministically.
* the six distinct-user counts of the funnel are computed in two phases
  (flags per user, then sums), which avoids the Expand that several
  ``count(distinct case ...)`` would plan (rows x 6 before the shuffle).
* the channel summary reads the attribution once and fans each row out to
  the channels it belongs to, instead of scanning it once per channel.
* trend windows run over one row per day (bounded by the calendar), so an
  unpartitioned window there is a single small task by design.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import round_to_long, safe_div

# Fixed values that must equal the reference's for equal results:
#   social sources: facebook, fb, ig, instagram, meta;  social mediums: paid_social, paidsocial
#   paid search: source google with medium cpc, ppc or paid
#   excluded order statuses: refunded, voided
#   funnel events: session_start, page_view, view_item, add_to_cart, begin_checkout, purchase
#   look-back of the web-analytics models: 90 days
SOCIAL_SOURCES = ("facebook", "fb", "ig", "instagram", "meta")
SOCIAL_MEDIUMS = ("paid_social", "paidsocial")
PAID_MEDIUMS = ("cpc", "ppc", "paid")
EXCLUDED_STATUSES = ("refunded", "voided")
FUNNEL_EVENTS = ("session_start", "page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")
FUNNEL_COLUMNS = ("sessions", "page_views", "product_views", "add_to_carts", "checkouts", "purchases")
LOOKBACK_DAYS = 90


def recent(events: DataFrame, as_of: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Keep the last ``days`` days of a date-sharded event feed (partition pruning
    when ``event_date`` is a partition column)."""
    return events.where(F.col("event_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def attribution(events: DataFrame, orders: DataFrame, as_of: str, *, days: int = LOOKBACK_DAYS) -> DataFrame:
    """K-05: one row per purchase transaction with its latest event's source."""
    p = recent(events, as_of, days).where((F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull())
    p = p.select(
        "transaction_id", "event_ts",
        F.col("event_date").alias("order_date"),
        F.coalesce("manual_source", "traffic_source").alias("ga4_source"),
        F.coalesce("manual_medium", "traffic_medium").alias("ga4_medium"),
        F.coalesce("manual_campaign", "traffic_name").alias("ga4_campaign"),
        F.col("purchase_revenue").alias("ga4_revenue"), "user_pseudo_id")
    fields = ["event_ts", "order_date", "ga4_revenue", "user_pseudo_id", "ga4_source", "ga4_medium", "ga4_campaign"]
    latest = (p.groupBy("transaction_id").agg(F.max(F.struct(*fields)).alias("e"))
              .select("transaction_id", *[F.col(f"e.{f}").alias(f) for f in fields[1:]]))
    o = orders.select(F.col("order_id").cast("string").alias("transaction_id"),
                      F.col("order_id"),
                      (F.col("total_price") - F.coalesce("total_tax", F.lit(0.0))).alias("shopify_revenue"))
    return latest.join(o, "transaction_id", "left").select(
        "order_date", "transaction_id", "order_id", "ga4_source", "ga4_medium", "ga4_campaign",
        F.lit(None).cast("string").alias("google_ads_campaign_id"), "shopify_revenue", "ga4_revenue",
        "user_pseudo_id")


def funnel(events: DataFrame, as_of: str, *, days: int = LOOKBACK_DAYS) -> DataFrame:
    """K-06: distinct users per funnel step by day, source and medium."""
    e = recent(events, as_of, days).where(F.col("event_name").isin(*FUNNEL_EVENTS)).select(
        F.col("event_date").alias("report_date"),
        F.coalesce("manual_source", "traffic_source", F.lit("(direct)")).alias("source"),
        F.coalesce("manual_medium", "traffic_medium", F.lit("(none)")).alias("medium"),
        "user_pseudo_id", "event_name")
    keys = ["report_date", "source", "medium"]
    # phase 1: one row per (group, user) with a 0/1 flag per step; a NULL user
    # forms its own row with all flags 0, so its group still appears
    known = F.col("user_pseudo_id").isNotNull()
    per_user = e.groupBy(*keys, "user_pseudo_id").agg(*[
        F.max(F.when(known & (F.col("event_name") == ev), 1).otherwise(0)).alias(col)
        for ev, col in zip(FUNNEL_EVENTS, FUNNEL_COLUMNS)])
    # phase 2: distinct users per step = sum of flags
    out = per_user.groupBy(*keys).agg(*[F.sum(col).cast("bigint").alias(col) for col in FUNNEL_COLUMNS])
    return out.select(
        *keys, *FUNNEL_COLUMNS,
        safe_div(F.col("add_to_carts"), F.col("product_views")).alias("view_to_cart_rate"),
        safe_div(F.col("purchases"), F.col("add_to_carts")).alias("cart_to_purchase_rate"),
        safe_div(F.col("purchases"), F.col("sessions")).alias("overall_conversion_rate"))


def product_insights(events: DataFrame, as_of: str, *, days: int = LOOKBACK_DAYS) -> DataFrame:
    """K-07: per item views, carts, purchases and purchase revenue."""
    e = recent(events, as_of, days).where(F.col("event_name").isin("view_item", "add_to_cart", "purchase"))
    it = e.select("event_name", F.explode("items").alias("i")).select(
        "event_name", "i.item_name", "i.item_id", "i.price", "i.quantity").where(F.col("item_name").isNotNull())
    ev = F.col("event_name")
    views = F.count_if(ev == "view_item")
    carts = F.count_if(ev == "add_to_cart")
    buys = F.count_if(ev == "purchase")
    return it.groupBy("item_name", "item_id").agg(
        views.alias("product_views"), carts.alias("add_to_carts"), buys.alias("purchases"),
        F.sum(F.when(ev == "purchase", F.col("price") * F.col("quantity")).otherwise(0)).alias("revenue"),
        safe_div(carts, views).alias("view_to_cart_rate"),
        safe_div(buys, carts).alias("cart_to_purchase_rate"),
        F.avg("price").alias("avg_price"))


def classify_channel(source, medium):
    """Ordered source/medium rules -> meta, google_ads, organic, referral, direct, other."""
    s = F.lower(F.coalesce(source, F.lit("")))
    m = F.lower(F.coalesce(medium, F.lit("")))
    return (F.when(s.isin(*SOCIAL_SOURCES) | m.isin(*SOCIAL_MEDIUMS), "meta")
            .when((s == "google") & m.isin(*PAID_MEDIUMS), "google_ads")
            .when(m.isin("organic", "referral"), F.lower(medium))
            .when((s == "(direct)") | source.isNull(), "direct")
            .otherwise("other"))


def _platform_daily(social: DataFrame, search: DataFrame):
    meta = social.groupBy(F.col("date_start").alias("report_date")).agg(
        F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"), F.sum(F.col("purchases").cast("double")).alias("conversions"),
        F.sum("purchase_value").alias("conversion_value")).withColumn("channel", F.lit("meta"))
    google = search.groupBy(F.col("date_start").alias("report_date")).agg(
        F.sum("spend").alias("spend"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"), F.sum("conversions").alias("conversions"),
        F.sum("conversion_value").alias("conversion_value")).withColumn("channel", F.lit("google_ads"))
    return meta, google


def channel_summary(social: DataFrame, search: DataFrame, attributed: DataFrame) -> DataFrame:
    """K-02: daily spend, conversions and revenue for five channels.

    Organic, referral and direct come from attributed orders; as in the
    source model an order with NULL source and organic/referral medium is
    counted both in its medium's channel and in direct (R-04).
    """
    meta, google = _platform_daily(social, search)
    a = attributed.where(F.col("shopify_revenue").isNotNull())
    m = F.lower(F.coalesce("ga4_medium", F.lit("")))
    s = F.lower(F.coalesce("ga4_source", F.lit("")))
    labels = F.array_compact(F.array(
        F.when(m == "organic", F.lit("organic")),
        F.when((s == "(direct)") | F.col("ga4_source").isNull(), F.lit("direct")),
        F.when(m == "referral", F.lit("referral"))))
    web = (a.select(F.col("order_date").alias("report_date"), "order_id", "shopify_revenue",
                    F.explode(labels).alias("channel"))
           .groupBy("report_date", "channel").agg(
               F.count_distinct("order_id").cast("double").alias("conversions"),
               F.sum("shopify_revenue").alias("conversion_value"))
           .select("report_date", "channel", F.lit(None).cast("double").alias("spend"),
                   F.lit(None).cast("bigint").alias("impressions"), F.lit(None).cast("bigint").alias("clicks"),
                   "conversions", "conversion_value"))
    allc = meta.unionByName(google).unionByName(web)
    return allc.select(
        "report_date", "channel", "spend", "impressions", "clicks", "conversions",
        F.col("conversion_value").alias("revenue"),
        safe_div(F.col("conversion_value"), F.col("spend")).alias("roas"),
        safe_div(F.col("spend"), F.col("conversions")).alias("cpa"),
        round_to_long("conversions").alias("orders"))


def enhanced_roas(attributed: DataFrame, social: DataFrame, search: DataFrame) -> DataFrame:
    """K-03: attributed revenue per day and channel with that channel's spend."""
    a = attributed.where(F.col("shopify_revenue").isNotNull()).select(
        F.col("order_date").alias("report_date"),
        classify_channel(F.col("ga4_source"), F.col("ga4_medium")).alias("channel"),
        "shopify_revenue", "order_id")
    daily = a.groupBy("report_date", "channel").agg(
        F.sum("shopify_revenue").alias("ga4_attributed_revenue"),
        F.count_distinct("order_id").alias("ga4_attributed_orders"))
    spend = (social.groupBy(F.col("date_start").alias("report_date")).agg(F.sum("spend").alias("ad_spend"))
             .withColumn("channel", F.lit("meta"))
             .unionByName(search.groupBy(F.col("date_start").alias("report_date"))
                          .agg(F.sum("spend").alias("ad_spend")).withColumn("channel", F.lit("google_ads"))))
    j = daily.join(spend, ["report_date", "channel"], "left")
    return j.select("report_date", "channel", "ga4_attributed_revenue", "ga4_attributed_orders", "ad_spend",
                    safe_div(F.col("ga4_attributed_revenue"), F.col("ad_spend")).alias("enhanced_roas"))


def true_roas(social: DataFrame, search: DataFrame, orders: DataFrame, *,
              excluded_statuses=EXCLUDED_STATUSES) -> DataFrame:
    """K-04: platform-reported vs store-recorded revenue per day.

    One row per date over the union of the four daily feeds (the source
    model's chained outer joins can split a store-only date in two, R-03).
    ``not in`` on the status drops NULL statuses, as SQL does.
    """
    meta = social.groupBy(F.col("date_start").alias("report_date")).agg(
        F.sum("spend").alias("meta_spend"), F.sum("impressions").alias("meta_impressions"),
        F.sum("clicks").alias("meta_clicks"), F.sum("purchases").alias("meta_reported_purchases"),
        F.sum("purchase_value").alias("meta_reported_revenue"))
    google = search.groupBy(F.col("date_start").alias("report_date")).agg(
        F.sum("spend").alias("google_spend"), F.sum("impressions").alias("google_impressions"),
        F.sum("clicks").alias("google_clicks"), F.sum("conversions").alias("google_conversions"),
        F.sum("conversion_value").alias("google_conversion_value"))
    src = F.lower(F.coalesce("utm_source", F.lit("")))
    med = F.lower(F.coalesce("utm_medium", F.lit("")))
    o = orders.where(~F.col("financial_status").isin(*excluded_statuses))
    is_meta = src.isin(*SOCIAL_SOURCES)
    is_google = (src == "google") & med.isin(*PAID_MEDIUMS)
    shop = (o.where(is_meta | is_google)
            .groupBy(F.col("order_date").alias("report_date")).agg(
                F.count_if(is_meta).alias("shopify_meta_orders"),
                F.sum(F.when(is_meta, F.col("total_price"))).alias("shopify_meta_revenue"),
                F.count_if(is_google).alias("shopify_google_orders"),
                F.sum(F.when(is_google, F.col("total_price"))).alias("shopify_google_revenue")))
    # a store-only date with only one kind of order keeps NULL (not 0) for the other kind
    shop = shop.select(
        "report_date",
        F.when(F.col("shopify_meta_orders") > 0, F.col("shopify_meta_orders")).alias("shopify_meta_orders"),
        "shopify_meta_revenue",
        F.when(F.col("shopify_google_orders") > 0, F.col("shopify_google_orders")).alias("shopify_google_orders"),
        "shopify_google_revenue")
    j = meta.join(google, "report_date", "full").join(shop, "report_date", "full")
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    blended = safe_div(z("shopify_meta_revenue") + z("shopify_google_revenue"), z("meta_spend") + z("google_spend"))
    return j.select(
        "report_date", "meta_spend", "meta_impressions", "meta_clicks", "meta_reported_purchases",
        "meta_reported_revenue", "shopify_meta_orders", "shopify_meta_revenue",
        safe_div(F.col("shopify_meta_revenue"), F.col("meta_spend")).alias("meta_true_roas"),
        safe_div(F.col("meta_reported_revenue"), F.col("meta_spend")).alias("meta_reported_roas"),
        (z("meta_reported_revenue") - z("shopify_meta_revenue")).alias("revenue_gap"),
        "google_spend", "google_impressions", "google_clicks", "google_conversions", "google_conversion_value",
        "shopify_google_orders", "shopify_google_revenue",
        safe_div(F.col("shopify_google_revenue"), F.col("google_spend")).alias("google_true_roas"),
        blended.alias("blended_true_roas"), blended.alias("true_roas"))


def trends(daily: DataFrame) -> DataFrame:
    """K-17: 7/30-row moving averages and day/week changes over a daily series.

    Frames count rows, not calendar days, as in the source model.  The input
    has one row per day, so the single window partition is small.
    """
    w = Window.orderBy("report_date")
    w7 = w.rowsBetween(-6, 0)
    w30 = w.rowsBetween(-29, 0)
    return daily.select(
        "report_date", "meta_spend", "shopify_meta_revenue", "shopify_meta_orders", "true_roas",
        F.avg("meta_spend").over(w7).alias("spend_7d_avg"),
        F.avg("shopify_meta_revenue").over(w7).alias("revenue_7d_avg"),
        F.avg("true_roas").over(w7).alias("roas_7d_avg"),
        F.avg("shopify_meta_orders").over(w7).alias("orders_7d_avg"),
        F.avg("meta_spend").over(w30).alias("spend_30d_avg"),
        F.avg("shopify_meta_revenue").over(w30).alias("revenue_30d_avg"),
        F.avg("true_roas").over(w30).alias("roas_30d_avg"),
        (F.col("meta_spend") - F.lag("meta_spend").over(w)).alias("spend_dod_change"),
        (F.col("shopify_meta_revenue") - F.lag("shopify_meta_revenue").over(w)).alias("revenue_dod_change"),
        (F.col("meta_spend") - F.lag("meta_spend", 7).over(w)).alias("spend_wow_change"),
        (F.col("shopify_meta_revenue") - F.lag("shopify_meta_revenue", 7).over(w)).alias("revenue_wow_change"))


DAILY_PERFORMANCE_COLUMNS = (
    "report_date platform campaign_id campaign_name campaign_type adset_id adset_name ad_id ad_name "
    "impressions clicks link_clicks spend cpc cpm ctr reach frequency conversions conversion_value "
    "add_to_cart add_to_cart_value initiate_checkout initiate_checkout_value landing_page_views").split()


def daily_performance(social: DataFrame, search: DataFrame) -> DataFrame:
    """K-01: social and search daily rows aligned to one 25-column layout."""
    null = lambda t: F.lit(None).cast(t)
    meta = social.select(
        F.col("date_start").alias("report_date"), F.lit("meta").alias("platform"), "campaign_id",
        "campaign_name", null("string").alias("campaign_type"), "adset_id", "adset_name", "ad_id", "ad_name",
        "impressions", "clicks", "link_clicks", "spend", "cpc", "cpm", "ctr", "reach", "frequency",
        F.col("purchases").cast("double").alias("conversions"), F.col("purchase_value").alias("conversion_value"),
        "add_to_cart", "add_to_cart_value", "initiate_checkout", "initiate_checkout_value", "landing_page_views")
    google = search.select(
        F.col("date_start").alias("report_date"), F.lit("google_ads").alias("platform"),
        F.col("campaign_id").cast("string").alias("campaign_id"), "campaign_name", "campaign_type",
        F.col("ad_group_id").cast("string").alias("adset_id"), F.col("ad_group_name").alias("adset_name"),
        null("string").alias("ad_id"), null("string").alias("ad_name"), "impressions", "clicks",
        null("bigint").alias("link_clicks"), "spend", "cpc", null("double").alias("cpm"), "ctr",
        null("bigint").alias("reach"), null("double").alias("frequency"), "conversions", "conversion_value",
        null("bigint").alias("add_to_cart"), null("double").alias("add_to_cart_value"),
        null("bigint").alias("initiate_checkout"), null("double").alias("initiate_checkout_value"),
        null("bigint").alias("landing_page_views"))
    return meta.unionByName(google)


# --- creatives ------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results:
#   creative tiers by lifetime roas: >= 3 top_performer, >= 2 good, >= 1 marginal, else underperformer
#   health: >= 14 active days and ctr% < 1 possible_fatigue; roas < 0.5 and spend > 50 cut_candidate
#   components: only creatives active >= 7 days


def creative_performance(creatives: DataFrame, social: DataFrame) -> DataFrame:
    """K-08: lifetime metrics per ad attached to each creative, with tier and health."""
    cd = social.where(F.col("spend") > 0).groupBy("ad_id", "ad_name").agg(
        F.sum("spend").alias("lifetime_spend"), F.sum("impressions").alias("lifetime_impressions"),
        F.sum("clicks").alias("lifetime_clicks"), F.sum("purchases").alias("lifetime_purchases"),
        F.sum("purchase_value").alias("lifetime_revenue"),
        safe_div(F.sum("purchase_value"), F.sum("spend")).alias("lifetime_roas"),
        (safe_div(F.sum("clicks"), F.sum("impressions")) * 100).alias("lifetime_ctr"),
        safe_div(F.sum("spend"), F.sum("purchases")).alias("lifetime_cpa"),
        F.min("date_start").alias("first_date"), F.max("date_start").alias("last_date"),
        F.count_distinct("date_start").alias("days_active"))
    j = creatives.join(cd, "ad_id", "left")
    roas = F.col("lifetime_roas")
    tier = (F.when(roas >= 3.0, "top_performer").when(roas >= 2.0, "good").when(roas >= 1.0, "marginal")
            .otherwise("underperformer"))
    health = (F.when((F.col("days_active") >= 14) & (F.col("lifetime_ctr") < 1.0), "possible_fatigue")
              .when((roas < 0.5) & (F.col("lifetime_spend") > 50), "cut_candidate").otherwise("healthy"))
    return j.select(
        "creative_id", "ad_id", "ad_name", F.col("title").alias("headline"), F.col("body").alias("primary_text"),
        "cta_type", "object_type", "video_id", "lifetime_spend", "lifetime_impressions", "lifetime_clicks",
        "lifetime_purchases", "lifetime_revenue", "lifetime_roas", "lifetime_ctr", "lifetime_cpa", "first_date",
        "last_date", "days_active", tier.alias("performance_tier"), health.alias("health_status"))


def component_scores(library: DataFrame, creative_perf: DataFrame, *, min_days: int = 7,
                     literal_weighting: bool = True) -> DataFrame:
    """K-09: performance of copy components (hooks match headlines, bodies match primary text).

    The source model's OR join becomes: unpivot creatives to (type, text),
    aggregate per normalised text, then one equi-join with the library, so no
    component x creative pair is ever formed.  ``weighted_roas`` keeps the
    source formula sum(purchases * roas * spend) / sum(spend) by default
    (R-06); ``literal_weighting=False`` gives sum(roas * spend) / sum(spend).
    """
    cp = creative_perf.where(F.col("days_active") >= min_days)
    sides = F.array(
        F.struct(F.lit("hook").alias("t"), F.col("headline").alias("x")),
        F.struct(F.lit("body").alias("t"), F.col("primary_text").alias("x")))
    u = (cp.select("*", F.explode(sides).alias("s"))
         .where(F.col("s.x").isNotNull())
         .select(F.col("s.t").alias("component_type"), F.lower(F.trim(F.col("s.x"))).alias("key"), "ad_id",
                 "lifetime_spend", "lifetime_purchases", "lifetime_roas", "lifetime_ctr", "lifetime_cpa",
                 "days_active"))
    w = F.col("lifetime_roas") * F.col("lifetime_spend")
    if literal_weighting:
        w = F.col("lifetime_purchases") * w
    per_text = u.groupBy("component_type", "key").agg(
        F.count_distinct("ad_id").alias("ads_using"), F.sum("lifetime_spend").alias("total_spend"),
        F.sum("lifetime_purchases").alias("total_purchases"), F.sum(w).alias("_w"),
        F.sum("lifetime_ctr").alias("_ctr_sum"), F.count("lifetime_ctr").alias("_ctr_n"),
        F.sum("lifetime_cpa").alias("_cpa_sum"), F.count("lifetime_cpa").alias("_cpa_n"),
        F.max("days_active").alias("max_days_active"))
    lib = library.select("component_id", "component_type", "text", F.lower(F.trim("text")).alias("key"))
    # a library row that repeats (same id, type, text) would be grouped into one row by the source model
    lib = lib.groupBy("component_id", "component_type", "text", "key").agg(F.count(F.lit(1)).alias("_n"))
    j = lib.join(per_text, ["component_type", "key"])
    n = F.col("_n")
    return j.select(
        "component_id", "component_type", "text", "ads_using", (F.col("total_spend") * n).alias("total_spend"),
        (F.col("total_purchases") * n).alias("total_purchases"),
        safe_div(F.col("_w"), F.col("total_spend")).alias("weighted_roas"),
        safe_div(F.col("_ctr_sum"), F.col("_ctr_n")).alias("avg_ctr"),
        safe_div(F.col("_cpa_sum"), F.col("_cpa_n")).alias("avg_cpa"), "max_days_active")


# --- tracking coverage and content posts (disabled in the source, built here) -------------------------
#   content tiers: 7-day clicks >= 50 and position <= 5 top_performer; >= 20 and <= 10 good;
#   7-day impressions >= 100 and clicks < 5 underperforming; published < 14 days ago too_early; else monitor


def session_comparison(store_sessions: DataFrame, funnel_daily: DataFrame) -> DataFrame:
    """K-21: store-side session counts against web-analytics funnel counts per day, with coverage rates.

    Both sides are first summed per day (one row per day each), then full-outer joined.
    """
    s = store_sessions.groupBy("report_date").agg(
        F.sum("sessions").alias("shopify_sessions"), F.sum("product_views").alias("shopify_product_views"),
        F.sum("add_to_carts").alias("shopify_add_to_carts"), F.sum("checkouts").alias("shopify_checkouts"),
        F.sum("orders").alias("shopify_orders"))
    g = funnel_daily.groupBy("report_date").agg(
        F.sum("sessions").alias("ga4_sessions"), F.sum("product_views").alias("ga4_product_views"),
        F.sum("add_to_carts").alias("ga4_add_to_carts"), F.sum("checkouts").alias("ga4_checkouts"),
        F.sum("purchases").alias("ga4_purchases"))
    j = s.join(g, "report_date", "full")
    col = F.col
    return j.select(
        "report_date", "shopify_sessions", "ga4_sessions",
        (col("shopify_sessions") - col("ga4_sessions")).alias("session_gap"),
        safe_div(col("shopify_sessions") - col("ga4_sessions"), col("shopify_sessions")).alias("session_discrepancy_pct"),
        safe_div(col("ga4_sessions"), col("shopify_sessions")).alias("ga4_coverage_rate"),
        "shopify_product_views", "ga4_product_views",
        safe_div(col("ga4_product_views"), col("shopify_product_views")).alias("product_view_coverage_rate"),
        "shopify_add_to_carts", "ga4_add_to_carts",
        safe_div(col("ga4_add_to_carts"), col("shopify_add_to_carts")).alias("add_to_cart_coverage_rate"),
        "shopify_checkouts", "ga4_checkouts",
        safe_div(col("ga4_checkouts"), col("shopify_checkouts")).alias("checkout_coverage_rate"),
        "shopify_orders", "ga4_purchases",
        safe_div(col("ga4_purchases"), col("shopify_orders")).alias("order_coverage_rate"),
        safe_div(col("shopify_orders"), col("shopify_sessions")).alias("shopify_conversion_rate"),
        safe_div(col("ga4_purchases"), col("ga4_sessions")).alias("ga4_conversion_rate"))


def content_performance(posts: DataFrame, perf: DataFrame, events: DataFrame, as_of: str, *, days: int = 30,
                        recent_days: int = 7) -> DataFrame:
    """K-22: each content post with its organic-search and web-analytics results and a tier.

    The page of an event is its ``page_location`` as recorded (the source model
    prefixes a second scheme onto full URLs, which never matches, R-11).
    Distinct users per page are counted in two phases (per page and user, then sums).
    """
    day = F.lit(as_of).cast("date")
    p = perf.where(F.col("query_date") >= F.date_sub(day, days))
    recent = F.col("query_date") >= F.date_sub(day, recent_days)
    sc = p.groupBy("page").agg(
        F.avg("position").alias("current_position"),
        F.sum(F.when(recent, F.col("impressions")).otherwise(0)).alias("impressions_7d"),
        F.sum(F.when(recent, F.col("clicks")).otherwise(0)).alias("clicks_7d"))
    sc = sc.withColumn("ctr", safe_div(F.col("clicks_7d"), F.col("impressions_7d")))
    e = events.where((F.col("event_date") >= F.date_sub(day, days))
                     & F.col("event_name").isin("session_start", "purchase"))
    per_user = e.groupBy(F.col("page_location").alias("page_url"), "user_pseudo_id").agg(
        F.max(F.when((F.col("event_name") == "session_start") & F.col("user_pseudo_id").isNotNull(), 1).otherwise(0))
        .alias("s"),
        F.max(F.when((F.col("event_name") == "purchase") & F.col("user_pseudo_id").isNotNull(), 1).otherwise(0))
        .alias("p"),
        F.sum(F.when(F.col("event_name") == "purchase", F.col("purchase_revenue")).otherwise(0.0)).alias("r"))
    g = per_user.groupBy("page_url").agg(F.sum("s").cast("bigint").alias("ga4_sessions"),
                                         F.sum("p").cast("bigint").alias("ga4_conversions"),
                                         F.sum("r").alias("ga4_revenue"))
    j = posts.join(sc, posts["url"] == sc["page"], "left").join(g, posts["url"] == g["page_url"], "left")
    age = F.datediff(day, F.col("publish_date"))
    clicks, pos, impr = F.col("clicks_7d"), F.col("current_position"), F.col("impressions_7d")
    tier = (F.when((clicks >= 50) & (pos <= 5), "top_performer").when((clicks >= 20) & (pos <= 10), "good")
            .when((impr >= 100) & (clicks < 5), "underperforming").when(age < 14, "too_early").otherwise("monitor"))
    return j.select("post_id", "title", "target_keyword", "content_type", "platform", "status", "url", "word_count",
                    "publish_date", age.alias("days_since_publish"), "current_position", "impressions_7d",
                    "clicks_7d", "ctr", "ga4_sessions", "ga4_conversions", "ga4_revenue", tier.alias("performance_tier"))
