"""Role mapping: the bench tables seen as the feeds the operators consume.

The bench ships TPC-H-style tables plus an event stream and text tables; the
operators expect store orders, order lines, ad-platform rows, web events and
so on.  Each role below is defined twice, once as a Spark DataFrame and once as
the equivalent DuckDB SQL (a CTE body) used by the oracle, and the two must be
kept in step.  A role reads a whole table or a partition of it into two
complementary roles.

Only exact arithmetic on the source values is used here (no rounding), so the
two engines produce bit-identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import in_months
from marginalia.functions.windows import many

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# as-of dates that play the role of current_date() for each family of inputs
AS_OF_ORDERS = "2001-09-01"
AS_OF_EVENTS = "2024-01-31"
AS_OF_SEARCH = "2024-02-26"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cents(x):
    """Money column (2 decimals) -> exact integer cents."""
    return F.round(F.col(x) * 100).cast("bigint")


def idiv(a, b):
    """Integer division, same result in Spark (div) and DuckDB (//)."""
    return F.expr(f"({a}) div ({b})")


# Money derived from the bench values is computed in integer cents and only
# then turned into a 2-decimal double, so every money input is an exact
# 2-decimal amount in both engines (no float noise, no rounding ties).


# ---------------------------------------------------------------------------
# store orders  <- orders
# ---------------------------------------------------------------------------

def _within(df, col, period):
    """The rows of the months that ``period`` (start, end) touches, filtered on the stored column."""
    return df if period is None else df.where(in_months(col, *period))


def shop_orders(spark, d, period=None):
    o = _within(table(spark, d, "orders"), "o_orderdate", period)
    pr = F.col("o_orderpriority")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_orderkey") + 100000).alias("order_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("total_price"),
        (idiv("cast(round(o_totalprice * 100) as bigint) * 8", 100) / 100.0).alias("total_tax"),
        F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "pending")
         .when(F.col("o_orderstatus") == "P", "refunded").alias("financial_status"),
        F.when(pr == "1-URGENT", "google").when(pr == "2-HIGH", "facebook")
         .when(pr == "3-MEDIUM", "google").when(pr == "5-LOW", "klaviyo").alias("utm_source"),
        F.when(pr == "1-URGENT", "cpc").when(pr == "2-HIGH", "paid")
         .when(pr == "3-MEDIUM", "organic").when(pr == "5-LOW", "email").alias("utm_medium"),
        F.when(pr == "1-URGENT", "brand").when(pr == "2-HIGH", "prospecting")
         .when(pr == "5-LOW", "newsletter").alias("utm_campaign"),
    )


SQL_SHOP_ORDERS = """
select o_orderkey as order_id, o_orderkey + 100000 as order_number, o_custkey as customer_id,
       cast(o_orderdate as date) as order_date, o_orderdate as created_at,
       o_totalprice as total_price, (cast(round(o_totalprice * 100) as bigint) * 8 // 100) / 100.0 as total_tax,
       case o_orderstatus when 'F' then 'paid' when 'O' then 'pending' when 'P' then 'refunded' end as financial_status,
       case o_orderpriority when '1-URGENT' then 'google' when '2-HIGH' then 'facebook'
            when '3-MEDIUM' then 'google' when '5-LOW' then 'klaviyo' end as utm_source,
       case o_orderpriority when '1-URGENT' then 'cpc' when '2-HIGH' then 'paid'
            when '3-MEDIUM' then 'organic' when '5-LOW' then 'email' end as utm_medium,
       case o_orderpriority when '1-URGENT' then 'brand' when '2-HIGH' then 'prospecting'
            when '5-LOW' then 'newsletter' end as utm_campaign
from orders"""


# ---------------------------------------------------------------------------
# order lines  <- lineitem join part
# ---------------------------------------------------------------------------

def _sku(size_col="p_size"):
    return F.when(F.col(size_col) % 10 == 0, F.lit("")).otherwise(
        F.concat_ws("-", "p_brand", "p_type", (F.col(size_col) % 4).cast("string")))


def line_rows(spark, d):
    """How many order lines there are; the files' footers say so."""
    return table(spark, d, "lineitem").count()


def shop_lines(spark, d, rows=None):
    """``rows``: ``line_rows``, if known.  Where the lines are many for the session's shuffle partitions, they pass by
    a hash map of the parts and are not sorted: a task's memory is that of its parts."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    if many(spark, line_rows(spark, d) if rows is None else rows):
        p = p.hint("shuffle_hash")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("variant_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (idiv("cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)") / 100.0).alias("price"),
        (idiv("(cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as bigint)) * cast(l_quantity as bigint)"
              " * cast(round(l_discount * 100) as bigint)", 100) / 100.0).alias("total_discount"),
        F.when(F.col("p_size") == 1, "Partner Product").when(F.col("p_size") == 2, "Digital Gift Card")
         .otherwise(F.col("p_name")).alias("title"),
        F.col("p_type").alias("variant_title"),
        _sku().alias("sku"),
    )


SQL_SHOP_LINES = """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_item_id,
       l_orderkey as order_id, l_partkey as product_id, l_partkey * 1000 + l_suppkey as variant_id,
       cast(l_quantity as bigint) as quantity,
       (cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) / 100.0 as price,
       ((cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) * cast(l_quantity as bigint)
         * cast(round(l_discount * 100) as bigint) // 100) / 100.0 as total_discount,
       case when p_size = 1 then 'Partner Product' when p_size = 2 then 'Digital Gift Card' else p_name end as title,
       p_type as variant_title,
       case when p_size % 10 = 0 then '' else concat_ws('-', p_brand, p_type, cast(p_size % 4 as varchar)) end as sku
from lineitem join part on l_partkey = p_partkey"""


# cost tables <- part (two overlapping slices by size class, to exercise precedence)

def shop_costs(spark, d):
    p = table(spark, d, "part")
    cost = idiv("cast(round(p_retailprice * 100) as bigint) * 35", 100) / 100.0
    return p.select(
        F.upper(F.concat_ws("-", "p_brand", "p_type", (F.col("p_size") % 4).cast("string"))).alias("sku"),
        F.col("p_name").alias("title"), F.when(F.col("p_size") % 4 != 1, cost).alias("cogs"))  # some skus have no cost yet


SQL_SHOP_COSTS = """
select upper(concat_ws('-', p_brand, p_type, cast(p_size % 4 as varchar))) as sku, p_name as title,
       if(p_size % 4 = 1, null, (cast(round(p_retailprice * 100) as bigint) * 35 // 100) / 100.0) as cogs
from part"""


def market_costs(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("asin"),
        F.concat(F.lit(" "), F.concat_ws("-", "p_brand", "p_type", (F.col("p_size") % 4).cast("string"))).alias("sku"),
        (idiv("cast(round(p_retailprice * 100) as bigint) * 45", 100) / 100.0).alias("cogs"),
        (idiv("cast(round(p_retailprice * 100) as bigint) * 5", 100) / 100.0).alias("fba_cost"),
        F.col("p_name").alias("title"), F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"))


SQL_MARKET_COSTS = """
select 'B' || cast(p_partkey as varchar) as asin,
       ' ' || concat_ws('-', p_brand, p_type, cast(p_size % 4 as varchar)) as sku,
       (cast(round(p_retailprice * 100) as bigint) * 45 // 100) / 100.0 as cogs,
       (cast(round(p_retailprice * 100) as bigint) * 5 // 100) / 100.0 as fba_cost,
       p_name as title, p_type as category, p_brand as subcategory
from part"""


def shop_products(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("handle"),
        F.col("p_type").alias("product_type"), F.col("p_brand").alias("vendor"),
        F.when(F.col("p_size") > 45, "archived").otherwise("active").alias("status"),
        F.concat_ws(", ", "p_type", "p_brand").alias("tags"),
        F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))


SQL_SHOP_PRODUCTS = """
select p_partkey as product_id, p_name as title, replace(p_name, ' ', '-') as handle,
       p_type as product_type, p_brand as vendor,
       case when p_size > 45 then 'archived' else 'active' end as status,
       concat_ws(', ', p_type, p_brand) as tags,
       cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
from part"""


def shop_variants(spark, d):
    """One variant per (part, supplier) pair seen in lineitem."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    v = li.groupBy("l_partkey", "l_suppkey").agg(
        F.max(idiv("cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)") / 100.0).alias("price"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("inventory_quantity"))
    j = v.join(p, v["l_partkey"] == p["p_partkey"])
    return j.select(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("variant_id"),
        F.col("l_partkey").alias("product_id"), "price", "inventory_quantity",
        F.col("p_type").alias("title"),
        F.when(F.col("l_suppkey") % 7 == 0, F.lit(""))
         .otherwise(F.concat_ws("-", "p_brand", F.col("l_suppkey").cast("string"))).alias("sku"))


SQL_SHOP_VARIANTS = """
select l_partkey * 1000 + l_suppkey as variant_id, l_partkey as product_id, price, inventory_quantity,
       p_type as title,
       case when l_suppkey % 7 = 0 then '' else concat_ws('-', p_brand, cast(l_suppkey as varchar)) end as sku
from (select l_partkey, l_suppkey,
             max((cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) / 100.0) as price,
             cast(sum(cast(l_quantity as bigint)) as bigint) as inventory_quantity
      from lineitem group by l_partkey, l_suppkey) v
join part on l_partkey = p_partkey"""


# ---------------------------------------------------------------------------
# ad platforms <- lineitem, split by line status into two complementary feeds
#   'F' lines: search-ads daily rows;  'O' lines: social-ads daily rows
# ---------------------------------------------------------------------------

def search_daily(spark, d, period=None):
    li = _within(table(spark, d, "lineitem"), "l_shipdate", period).where(F.col("l_linestatus") == "F")
    base = li.select(
        F.col("l_shipdate").cast("date").alias("date_start"),
        F.col("l_suppkey").alias("campaign_id"),
        F.concat(F.lit("search-"), F.col("l_suppkey").cast("string")).alias("campaign_name"),
        F.when(F.col("l_returnflag") == "R", "PERFORMANCE_MAX").otherwise("SEARCH").alias("campaign_type"),
        F.col("l_partkey").alias("ad_group_id"),
        F.concat(F.lit("group-"), F.col("l_partkey").cast("string")).alias("ad_group_name"),
        (F.col("l_quantity") * 40).cast("bigint").alias("impressions"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        (idiv("cast(round(l_extendedprice * 100) as bigint)", 1000) / 100.0).alias("spend"),
        F.round(F.col("l_discount") * 100).alias("conversions"),
        (idiv("cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint)", 100) / 100.0).alias("conversion_value"),
    )
    return base.select("*", F.try_divide(F.col("spend"), F.col("clicks")).alias("cpc"),
                       F.try_divide(F.col("clicks").cast("double"), F.col("impressions")).alias("ctr"))


SQL_SEARCH_DAILY = """
select cast(l_shipdate as date) as date_start, l_suppkey as campaign_id,
       'search-' || cast(l_suppkey as varchar) as campaign_name,
       case when l_returnflag = 'R' then 'PERFORMANCE_MAX' else 'SEARCH' end as campaign_type,
       l_partkey as ad_group_id, 'group-' || cast(l_partkey as varchar) as ad_group_name,
       cast(l_quantity * 40 as bigint) as impressions, cast(l_quantity as bigint) as clicks,
       (cast(round(l_extendedprice * 100) as bigint) // 1000) / 100.0 as spend,
       round(l_discount * 100) as conversions,
       (cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint) // 100) / 100.0
           as conversion_value
from lineitem where l_linestatus = 'F'"""
SQL_SEARCH_DAILY = f"""
select *, spend / nullif(clicks, 0) as cpc, cast(clicks as double) / nullif(impressions, 0) as ctr
from ({SQL_SEARCH_DAILY}) s"""


def social_daily(spark, d, period=None):
    li = _within(table(spark, d, "lineitem"), "l_shipdate", period).where(F.col("l_linestatus") == "O")
    base = li.select(
        F.col("l_shipdate").cast("date").alias("date_start"),
        F.col("l_suppkey").cast("string").alias("campaign_id"),
        F.concat(F.lit("social-"), F.col("l_suppkey").cast("string")).alias("campaign_name"),
        F.col("l_returnflag").alias("adset_id"),
        F.concat(F.lit("adset-"), F.col("l_returnflag")).alias("adset_name"),
        F.col("l_partkey").cast("string").alias("ad_id"),
        F.concat(F.lit("ad-"), F.col("l_partkey").cast("string")).alias("ad_name"),
        (F.col("l_quantity") * 40).cast("bigint").alias("impressions"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        (idiv("cast(round(l_extendedprice * 100) as bigint)", 1000) / 100.0).alias("spend"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("purchases"),
        (idiv("cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint)", 100) / 100.0).alias("purchase_value"),
    )
    return base.select(
        "*", F.col("clicks").alias("link_clicks"),
        F.try_divide(F.col("spend"), F.col("clicks")).alias("cpc"),
        F.try_divide(F.col("spend") * 1000, F.col("impressions")).alias("cpm"),
        F.try_divide(F.col("clicks").cast("double"), F.col("impressions")).alias("ctr"),
        F.expr("impressions div 2").alias("reach"),
        F.try_divide(F.col("impressions").cast("double"), F.expr("impressions div 2")).alias("frequency"),
        (F.col("purchases") * 3).alias("add_to_cart"), (F.col("purchase_value") * 2).alias("add_to_cart_value"),
        (F.col("purchases") * 2).alias("initiate_checkout"),
        (F.col("purchase_value") * 1.5).alias("initiate_checkout_value"),
        F.col("clicks").alias("landing_page_views"))


SQL_SOCIAL_DAILY = """
select cast(l_shipdate as date) as date_start, cast(l_suppkey as varchar) as campaign_id,
       'social-' || cast(l_suppkey as varchar) as campaign_name,
       l_returnflag as adset_id, 'adset-' || l_returnflag as adset_name,
       cast(l_partkey as varchar) as ad_id, 'ad-' || cast(l_partkey as varchar) as ad_name,
       cast(l_quantity * 40 as bigint) as impressions, cast(l_quantity as bigint) as clicks,
       (cast(round(l_extendedprice * 100) as bigint) // 1000) / 100.0 as spend,
       cast(round(l_discount * 100) as bigint) as purchases,
       (cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint) // 100) / 100.0
           as purchase_value
from lineitem where l_linestatus = 'O'"""
SQL_SOCIAL_DAILY = f"""
select *, clicks as link_clicks, spend / nullif(clicks, 0) as cpc, spend * 1000 / nullif(impressions, 0) as cpm,
       cast(clicks as double) / nullif(impressions, 0) as ctr, impressions // 2 as reach,
       cast(impressions as double) / nullif(impressions // 2, 0) as frequency,
       purchases * 3 as add_to_cart, purchase_value * 2 as add_to_cart_value,
       purchases * 2 as initiate_checkout, purchase_value * 1.5 as initiate_checkout_value,
       clicks as landing_page_views
from ({SQL_SOCIAL_DAILY}) s"""


# ---------------------------------------------------------------------------
# web analytics events <- events
#   event names: view->view_item, click->add_to_cart, purchase, signup->session_start, error->page_view
#   traffic attribution from the props key k (six buckets, incl. NULL source)
# ---------------------------------------------------------------------------

def web_events(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    b = k % 6
    et = F.col("event_type")
    name = (F.when(et == "view", "view_item").when(et == "click", "add_to_cart")
            .when(et == "purchase", "purchase").when(et == "signup", "session_start")
            .when(et == "error", "page_view"))
    return e.select(
        F.col("ts").cast("date").alias("event_date"),
        F.col("ts").alias("event_ts"),
        name.alias("event_name"),
        F.col("user_id").cast("string").alias("user_pseudo_id"),
        F.when(et == "purchase", F.expr("event_id div 2").cast("string")).alias("transaction_id"),
        F.when(et == "purchase", F.col("value")).alias("purchase_revenue"),
        F.when(b == 0, "google").when(b == 1, "facebook").when(b == 5, "newsletter").alias("manual_source"),
        F.when(b == 0, "cpc").when(b == 1, "paid_social").when(b == 5, "referral").alias("manual_medium"),
        F.when(b == 0, "brand").when(b == 1, "prospecting").alias("manual_campaign"),
        F.when(b == 2, "google").when(b == 4, "(direct)").alias("traffic_source"),
        F.when(b == 2, "organic").when(b == 3, "organic").when(b == 4, "(none)").alias("traffic_medium"),
        F.when(b == 2, "seo").alias("traffic_name"),
        F.array(F.struct(
            F.concat(F.lit("Item "), (k % 20).cast("string")).alias("item_name"),
            F.concat(F.lit("SKU-"), (k % 20).cast("string")).alias("item_id"),
            F.col("value").alias("price"),
            (F.col("user_id") % 3 + 1).alias("quantity"))).alias("items"),
        F.concat(F.lit("https://example.com/p/"), (k % 25).cast("string")).alias("page_location"),
    )


SQL_WEB_EVENTS = """
select cast(ts as date) as event_date, ts as event_ts,
       case event_type when 'view' then 'view_item' when 'click' then 'add_to_cart'
            when 'purchase' then 'purchase' when 'signup' then 'session_start'
            when 'error' then 'page_view' end as event_name,
       cast(user_id as varchar) as user_pseudo_id,
       case when event_type = 'purchase' then cast(event_id // 2 as varchar) end as transaction_id,
       case when event_type = 'purchase' then value end as purchase_revenue,
       case k % 6 when 0 then 'google' when 1 then 'facebook' when 5 then 'newsletter' end as manual_source,
       case k % 6 when 0 then 'cpc' when 1 then 'paid_social' when 5 then 'referral' end as manual_medium,
       case k % 6 when 0 then 'brand' when 1 then 'prospecting' end as manual_campaign,
       case k % 6 when 2 then 'google' when 4 then '(direct)' end as traffic_source,
       case k % 6 when 2 then 'organic' when 3 then 'organic' when 4 then '(none)' end as traffic_medium,
       case k % 6 when 2 then 'seo' end as traffic_name,
       [{'item_name': 'Item ' || cast(k % 20 as varchar), 'item_id': 'SKU-' || cast(k % 20 as varchar),
         'price': value, 'quantity': user_id % 3 + 1}] as items,
       'https://example.com/p/' || cast(k % 25 as varchar) as page_location
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e"""


# ---------------------------------------------------------------------------
# search terms <- documents (whole text is the term) left join labels
# ---------------------------------------------------------------------------

def search_terms(spark, d):
    doc = table(spark, d, "documents")
    lab = table(spark, d, "labels")
    j = doc.join(lab, "doc_id", "left")
    conv = F.coalesce(F.col("quality"), F.lit(0)).cast("double")
    return j.select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 56).cast("int")).alias("date_start"),
        F.substring("source", 4, 10).cast("bigint").alias("campaign_id"),
        F.col("source").alias("campaign_name"),
        F.col("lang").alias("ad_group_id"),
        F.concat(F.lit("group-"), F.col("lang")).alias("ad_group_name"),
        F.col("text").alias("search_term"),
        F.col("lang").alias("keyword_text"),
        F.when(F.col("doc_id") % 2 == 0, "BROAD").otherwise("EXACT").alias("match_type"),
        F.col("n_chars").alias("impressions"),
        F.expr("n_chars div 100").alias("clicks"),
        (F.col("n_chars") / 100.0).alias("spend"),
        conv.alias("conversions"),
        (conv * 25.0).alias("conversion_value"),
    )


SQL_SEARCH_TERMS = """
select date '2024-01-01' + cast(doc_id % 56 as integer) as date_start,
       cast(substr(source, 4, 10) as bigint) as campaign_id, source as campaign_name,
       lang as ad_group_id, 'group-' || lang as ad_group_name, text as search_term,
       lang as keyword_text, case when doc_id % 2 = 0 then 'BROAD' else 'EXACT' end as match_type,
       n_chars as impressions, n_chars // 100 as clicks, n_chars / 100.0 as spend,
       cast(coalesce(quality, 0) as double) as conversions,
       cast(coalesce(quality, 0) as double) * 25.0 as conversion_value
from documents left join labels using (doc_id)"""


# ---------------------------------------------------------------------------
# organic search performance <- events
# ---------------------------------------------------------------------------

def search_performance(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("ts").cast("date").alias("query_date"),
        F.when(F.col("user_id") % 2 == 0, "example.com").otherwise("shop.example.com").alias("site"),
        F.concat(F.lit("query "), (k % 40).cast("string")).alias("query"),
        F.concat(F.lit("https://example.com/p/"), (k % 25).cast("string")).alias("page"),
        F.lit("usa").alias("country"),
        F.when(F.col("event_type") == "view", "MOBILE").otherwise("DESKTOP").alias("device"),
        F.round(F.col("value") * 3).cast("bigint").alias("impressions"),
        F.round(F.col("value") / 10).cast("bigint").alias("clicks"),
        (1 + (k % 30) + (F.col("user_id") % 10) / 10.0).alias("position"),
        F.col("ts").alias("ingested_at"),
    ).withColumn("ctr", F.try_divide(F.col("clicks"), F.col("impressions")))


SQL_SEARCH_PERFORMANCE = """
select *, clicks / nullif(impressions, 0) as ctr from (
select cast(ts as date) as query_date,
       case when user_id % 2 = 0 then 'example.com' else 'shop.example.com' end as site,
       'query ' || cast(k % 40 as varchar) as query,
       'https://example.com/p/' || cast(k % 25 as varchar) as page,
       'usa' as country, case when event_type = 'view' then 'MOBILE' else 'DESKTOP' end as device,
       cast(round(value * 3) as bigint) as impressions, cast(round(value / 10) as bigint) as clicks,
       1 + (k % 30) + (user_id % 10) / 10.0 as position, ts as ingested_at
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e) s"""


ROLE_SQL = {
    "r_shop_orders": SQL_SHOP_ORDERS,
    "r_shop_lines": SQL_SHOP_LINES,
    "r_shop_costs": SQL_SHOP_COSTS,
    "r_market_costs": SQL_MARKET_COSTS,
    "r_shop_products": SQL_SHOP_PRODUCTS,
    "r_shop_variants": SQL_SHOP_VARIANTS,
    "r_search_daily": SQL_SEARCH_DAILY,
    "r_social_daily": SQL_SOCIAL_DAILY,
    "r_web_events": SQL_WEB_EVENTS,
    "r_search_terms": SQL_SEARCH_TERMS,
    "r_search_perf": SQL_SEARCH_PERFORMANCE,
}

ROLE_SPARK = {
    "r_shop_orders": shop_orders,
    "r_shop_lines": shop_lines,
    "r_shop_costs": shop_costs,
    "r_market_costs": market_costs,
    "r_shop_products": shop_products,
    "r_shop_variants": shop_variants,
    "r_search_daily": search_daily,
    "r_social_daily": social_daily,
    "r_web_events": web_events,
    "r_search_terms": search_terms,
    "r_search_perf": search_performance,
}


# ---------------------------------------------------------------------------
# accounting: purchases, accounts, invoices, customers, deposits, wallet txns
# ---------------------------------------------------------------------------

def purchase_lines(spark, d, period=None):
    """Expense lines <- lineitem x supplier x nation.

    Vendor = the supplier's nation (a few dozen vendors with many lines a
    month); vendors in regions 0-1 bill a flat amount per line, which makes
    them look like subscriptions; account = return flag + line status.
    """
    li = _within(table(spark, d, "lineitem"), "l_shipdate", period)
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    flat = F.col("n_regionkey") <= 1
    amount = F.when(flat, (F.col("n_nationkey") * 100 + 4999) / 100.0).otherwise(
        idiv("cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint)", 100) / 100.0)
    acct = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_item_id"),
        F.col("l_orderkey").cast("string").alias("purchase_id"),
        F.col("l_shipdate").cast("date").alias("txn_date"),
        F.col("n_nationkey").cast("string").alias("vendor_id"),
        F.concat(F.lit("Vendor "), F.col("n_name")).alias("vendor_name"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("description"),
        amount.alias("amount"), acct.alias("account_id"),
        F.concat(F.lit("Account "), acct).alias("account_name"),
        F.col("s_suppkey").cast("string").alias("customer_id"), F.col("s_name").alias("customer_name"),
        F.lit("NotBillable").alias("billable_status"))


SQL_PURCHASE_LINES = """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_item_id,
       cast(l_orderkey as varchar) as purchase_id, cast(l_shipdate as date) as txn_date,
       cast(n_nationkey as varchar) as vendor_id, 'Vendor ' || n_name as vendor_name,
       'part ' || cast(l_partkey as varchar) as description,
       case when n_regionkey <= 1 then (n_nationkey * 100 + 4999) / 100.0
            else (cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint) // 100) / 100.0
       end as amount,
       l_returnflag || l_linestatus as account_id, 'Account ' || l_returnflag || l_linestatus as account_name,
       cast(s_suppkey as varchar) as customer_id, s_name as customer_name, 'NotBillable' as billable_status
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"""

# chart of accounts (reference data, like a seed): one row per account id
ACCOUNTS = [
    ("AF", "Software", "Software", "Expense", "OfficeGeneralAdministrativeExpenses", "Expense", True),
    ("AO", "Owner Payroll", "Owner Payroll", "Expense", "PayrollWageExpenses", "Expense", True),
    ("NF", "Advertising", "Advertising", "Expense", "AdvertisingPromotional", "Expense", True),
    ("NO", "Freight", "Freight", "Cost of Goods Sold", "ShippingFreightDeliveryCos", "Expense", True),
    ("RF", "Insurance", "Insurance", "Expense", None, "Expense", True),
    ("RO", "Sales", "Sales", "Income", "SalesOfProductIncome", "Revenue", True),
]
ACCOUNT_DDL = ("account_id string, name string, fully_qualified_name string, account_type string, "
               "account_sub_type string, classification string, active boolean")


def accounts(spark, d=None):
    return spark.createDataFrame(ACCOUNTS, ACCOUNT_DDL)


def _sql_values(rows):
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


SQL_ACCOUNTS = (f"select * from (values {_sql_values(ACCOUNTS)}) as t(account_id, name, fully_qualified_name, "
                "account_type, account_sub_type, classification, active)")


def invoices(spark, d, period=None):
    """Wholesale invoices <- orders x customer; balance by order status."""
    o = _within(table(spark, d, "orders"), "o_orderdate", period)
    c = table(spark, d, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    tot = F.col("o_totalprice")
    bal = (F.when(F.col("o_orderstatus") == "F", F.lit(0.0))
           .when(F.col("o_orderstatus") == "O", tot)
           .otherwise(idiv("cast(round(o_totalprice * 100) as bigint)", 2) / 100.0))
    from marginalia.sources.flatten import invoice_status
    return j.select(
        F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_id"),
        F.col("o_orderkey").cast("string").alias("doc_number"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due_date"),
        F.col("o_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        tot.alias("total_amount"), bal.alias("balance"),
        invoice_status(bal, tot).alias("txn_status"))


SQL_INVOICES = """
select *, case when balance = 0 and total_amount > 0 then 'Paid' when balance < total_amount then 'Partial'
               when balance = total_amount then 'Open' else 'Unknown' end as txn_status
from (select 'INV-' || cast(o_orderkey as varchar) as invoice_id, cast(o_orderkey as varchar) as doc_number,
             cast(o_orderdate as date) as txn_date, cast(o_orderdate as date) + 30 as due_date,
             cast(o_custkey as varchar) as customer_id, c_name as customer_name, o_totalprice as total_amount,
             case o_orderstatus when 'F' then 0.0 when 'O' then o_totalprice
                  else (cast(round(o_totalprice * 100) as bigint) // 2) / 100.0 end as balance
      from orders join customer on o_custkey = c_custkey) i"""


def invoice_lines(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_item_id"),
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string")).alias("invoice_id"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("item_name"),
        F.col("l_quantity").alias("quantity"),
        (idiv("cast(round(l_extendedprice * 100) as bigint)", "cast(l_quantity as bigint)") / 100.0).alias("unit_price"),
        F.col("l_extendedprice").alias("amount"))


SQL_INVOICE_LINES = """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_item_id,
       'INV-' || cast(l_orderkey as varchar) as invoice_id, 'part ' || cast(l_partkey as varchar) as item_name,
       l_quantity as quantity,
       (cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) / 100.0 as unit_price,
       l_extendedprice as amount
from lineitem"""


def qb_customers(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("display_name"),
                    F.concat_ws(" ", "c_name", "c_mktsegment").alias("company_name"),
                    F.col("n_name").alias("state"), F.col("c_acctbal").alias("balance"))


SQL_QB_CUSTOMERS = """
select cast(c_custkey as varchar) as customer_id, c_name as display_name,
       concat_ws(' ', c_name, c_mktsegment) as company_name, n_name as state, c_acctbal as balance
from customer join nation on c_nationkey = n_nationkey"""

# deposit memo templates (bench shaping only): (k div 3) % 10 picks one
_MEMOS = [
    "AMAZON PAYMENTS PAYOUT {id}",
    "PAYOUT DESK, PAYOUT",
    "North Opco, Purpose Bu",
    "Description: Alpha Pro affiliate commission Transaction ID: 7X{id}",
    "Shopify transfer {id}",
    "South Squad payout {id}",
    "Podcast sponsorship {id}",
    "Description: Beta Gear monthly Transaction ID: 7X{id}",
    "mobile deposit",
    "Transaction ID: 9K{id}",
]
_ACCOUNT_OF_K4 = ["Operating Checking", "Operating Checking",
                  "PayPal balance account", "Operating Savings"]
_SUMMARY_OF_TYPE = {"purchase": "Shopify Payments", "view": "Affiliate Revenue", "click": "",
                    "signup": "Sponsorship income"}


def deposits(spark, d, period=None):
    """Bank and wallet deposits <- events (one deposit per event)."""
    e = _within(table(spark, d, "events"), "ts", period)
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id").cast("string")
    mi = F.expr("(cast(get_json_object(props, '$.k') as int) div 3) % 10")
    memo = None
    for i, t in enumerate(_MEMOS):
        parts = t.split("{id}")
        v = F.lit(parts[0]) if len(parts) == 1 else F.concat(F.lit(parts[0]), eid, F.lit(parts[1]))
        memo = F.when(mi == i, v) if memo is None else memo.when(mi == i, v)
    acct = None
    for i, a in enumerate(_ACCOUNT_OF_K4):
        acct = F.when(k % 4 == i, a) if acct is None else acct.when(k % 4 == i, a)
    summ = None
    for t, v in _SUMMARY_OF_TYPE.items():
        summ = F.when(F.col("event_type") == t, v) if summ is None else summ.when(F.col("event_type") == t, v)
    return e.select(eid.alias("deposit_id"), F.col("ts").cast("date").alias("txn_date"),
                    F.col("value").alias("total_amount"), acct.alias("deposit_to_account_name"),
                    summ.alias("source_summary"), memo.alias("memo"), F.lit(1).cast("bigint").alias("line_count"),
                    F.lit("USD").alias("currency"))


def _sql_case(expr, mapping):
    whens = " ".join(f"when {expr} = {k!r} then '{v}'" if isinstance(k, str) else f"when {expr} = {k} then {v}"
                     for k, v in mapping)
    return f"case {whens} end"


def _sql_memo():
    parts = []
    for i, t in enumerate(_MEMOS):
        pieces = t.split("{id}")
        if len(pieces) == 1:
            v = "'" + t.replace("'", "''") + "'"
        else:
            v = f"'{pieces[0]}' || cast(event_id as varchar) || '{pieces[1]}'"
        parts.append(f"when (k // 3) % 10 = {i} then {v}")
    return "case " + " ".join(parts) + " end"


SQL_DEPOSITS = f"""
select cast(event_id as varchar) as deposit_id, cast(ts as date) as txn_date, value as total_amount,
       case {' '.join(f"when k % 4 = {i} then '{a}'" for i, a in enumerate(_ACCOUNT_OF_K4))} end
           as deposit_to_account_name,
       case {' '.join(f"when event_type = '{t}' then '{v}'" for t, v in _SUMMARY_OF_TYPE.items())} end
           as source_summary,
       {_sql_memo()} as memo, cast(1 as bigint) as line_count, 'USD' as currency
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e"""


def wallet_transactions(spark, d):
    """Wallet (payment API) transactions <- events whose deposit memo carries a wallet id."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    mi = F.expr("(cast(get_json_object(props, '$.k') as int) div 3) % 10")
    e = e.where(mi.isin(3, 7, 9))
    pre = F.when(mi == 9, "9K").otherwise("7X")
    subj = F.when(F.col("user_id") % 3 == 0, "Club commission payout").when(
        F.col("user_id") % 3 == 1, "Delta partner payment").otherwise("Payment received")
    return e.select(F.concat(pre, F.col("event_id").cast("string")).alias("transaction_id"),
                    F.col("ts").alias("transaction_initiation_date"),
                    F.col("ts").cast("date").alias("transaction_date"),
                    F.col("value").alias("transaction_amount"),
                    F.when(F.col("user_id") % 5 == 0, "Pending").otherwise("Success").alias("transaction_status"),
                    subj.alias("transaction_subject"))


SQL_WALLET_TRANSACTIONS = """
select case when (k // 3) % 10 = 9 then '9K' else '7X' end || cast(event_id as varchar) as transaction_id,
       ts as transaction_initiation_date, cast(ts as date) as transaction_date, value as transaction_amount,
       case when user_id % 5 = 0 then 'Pending' else 'Success' end as transaction_status,
       case when user_id % 3 = 0 then 'Club commission payout' when user_id % 3 = 1 then 'Delta partner payment'
            else 'Payment received' end as transaction_subject
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e
where (k // 3) % 10 in (3, 7, 9)"""


ROLE_SQL.update({
    "r_purchase_lines": SQL_PURCHASE_LINES,
    "r_accounts": SQL_ACCOUNTS,
    "r_invoices": SQL_INVOICES,
    "r_invoice_lines": SQL_INVOICE_LINES,
    "r_qb_customers": SQL_QB_CUSTOMERS,
    "r_deposits": SQL_DEPOSITS,
    "r_wallet_txns": SQL_WALLET_TRANSACTIONS,
})
ROLE_SPARK.update({
    "r_purchase_lines": purchase_lines,
    "r_accounts": accounts,
    "r_invoices": invoices,
    "r_invoice_lines": invoice_lines,
    "r_qb_customers": qb_customers,
    "r_deposits": deposits,
    "r_wallet_txns": wallet_transactions,
})


# ---------------------------------------------------------------------------
# creatives, content library, ad copy, keywords
# ---------------------------------------------------------------------------

AS_OF_ADS = "2001-11-05"


def creatives(spark, d):
    """Social ad creatives <- part (one creative per ad, ad = part)."""
    p = table(spark, d, "part")
    sz = F.col("p_size")
    return p.select(
        F.concat(F.lit("cr"), F.col("p_partkey").cast("string")).alias("creative_id"),
        F.col("p_partkey").cast("string").alias("ad_id"),
        F.when(sz % 5 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("title"),
        F.concat_ws(" ", F.lit("Shop"), "p_type", "p_name").alias("body"),
        F.when(sz % 3 == 0, "SHOP_NOW").when(sz % 3 == 1, "LEARN_MORE").otherwise("BUY_NOW").alias("cta_type"),
        F.when(sz % 2 == 0, "VIDEO").otherwise("SHARE").alias("object_type"),
        F.when(sz % 2 == 0, F.concat(F.lit("v"), F.col("p_partkey").cast("string"))).alias("video_id"))


SQL_CREATIVES = """
select 'cr' || cast(p_partkey as varchar) as creative_id, cast(p_partkey as varchar) as ad_id,
       case when p_size % 5 = 0 then null else p_name end as title,
       concat_ws(' ', 'Shop', p_type, p_name) as body,
       case when p_size % 3 = 0 then 'SHOP_NOW' when p_size % 3 = 1 then 'LEARN_MORE' else 'BUY_NOW' end as cta_type,
       case when p_size % 2 = 0 then 'VIDEO' else 'SHARE' end as object_type,
       case when p_size % 2 = 0 then 'v' || cast(p_partkey as varchar) end as video_id
from part"""


def content_library(spark, d):
    """Copy components <- part: a hook and a body per part, written with case/space noise."""
    p = table(spark, d, "part")
    hook = p.select(F.concat(F.lit("h"), F.col("p_partkey").cast("string")).alias("component_id"),
                    F.lit("hook").alias("component_type"),
                    F.when(F.col("p_size") % 2 == 0, F.upper("p_name"))
                     .otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("text"))
    body = p.select(F.concat(F.lit("b"), F.col("p_partkey").cast("string")).alias("component_id"),
                    F.lit("body").alias("component_type"),
                    F.concat_ws(" ", F.lit("SHOP"), "p_type", "p_name").alias("text"))
    return hook.unionByName(body)


SQL_CONTENT_LIBRARY = """
select 'h' || cast(p_partkey as varchar) as component_id, 'hook' as component_type,
       case when p_size % 2 = 0 then upper(p_name) else ' ' || p_name || ' ' end as text
from part
union all
select 'b' || cast(p_partkey as varchar), 'body', concat_ws(' ', 'SHOP', p_type, p_name) from part"""


def ad_copy(spark, d):
    """Search ad copy assets <- part (one responsive ad per ad group = part)."""
    p = table(spark, d, "part")
    return p.select(
        (F.col("p_partkey") * 10 + 1).alias("ad_id"), (F.col("p_size") % 7).alias("campaign_id"),
        F.concat(F.lit("search-"), (F.col("p_size") % 7).cast("string")).alias("campaign_name"),
        F.col("p_partkey").alias("ad_group_id"),
        F.concat(F.lit("group-"), F.col("p_partkey").cast("string")).alias("ad_group_name"),
        F.lit("RESPONSIVE_SEARCH_AD").alias("ad_type"),
        F.when(F.col("p_size") % 2 == 0, "HEADLINE").otherwise("DESCRIPTION").alias("asset_type"),
        F.col("p_name").alias("asset_text"),
        F.when(F.col("p_size") > 40, "BEST").when(F.col("p_size") > 20, "GOOD").otherwise("LOW")
         .alias("performance_label"))


SQL_AD_COPY = """
select p_partkey * 10 + 1 as ad_id, p_size % 7 as campaign_id, 'search-' || cast(p_size % 7 as varchar) as campaign_name,
       p_partkey as ad_group_id, 'group-' || cast(p_partkey as varchar) as ad_group_name,
       'RESPONSIVE_SEARCH_AD' as ad_type, case when p_size % 2 = 0 then 'HEADLINE' else 'DESCRIPTION' end as asset_type,
       p_name as asset_text,
       case when p_size > 40 then 'BEST' when p_size > 20 then 'GOOD' else 'LOW' end as performance_label
from part"""


def keywords(spark, d):
    """Search keywords <- documents grouped by language (keyword text = ad group = language)."""
    doc = table(spark, d, "documents")
    g = doc.groupBy("lang").agg(F.min("doc_id").alias("keyword_id"), F.count(F.lit(1)).alias("n"))
    return g.select(
        "keyword_id", F.col("lang").alias("ad_group_id"), F.lit(1).cast("bigint").alias("campaign_id"),
        F.col("lang").alias("keyword_text"), F.lit("BROAD").alias("match_type"), F.lit("ENABLED").alias("status"),
        (F.col("n") % 10 + 1).alias("quality_score"),
        F.when(F.col("n") % 3 == 0, "ABOVE_AVERAGE").when(F.col("n") % 3 == 1, "AVERAGE")
         .otherwise("BELOW_AVERAGE").alias("expected_ctr"),
        F.lit("AVERAGE").alias("ad_relevance"), F.lit("ABOVE_AVERAGE").alias("landing_page_experience"))


SQL_KEYWORDS = """
select keyword_id, lang as ad_group_id, cast(1 as bigint) as campaign_id, lang as keyword_text,
       'BROAD' as match_type, 'ENABLED' as status, n % 10 + 1 as quality_score,
       case when n % 3 = 0 then 'ABOVE_AVERAGE' when n % 3 = 1 then 'AVERAGE' else 'BELOW_AVERAGE' end as expected_ctr,
       'AVERAGE' as ad_relevance, 'ABOVE_AVERAGE' as landing_page_experience
from (select lang, min(doc_id) as keyword_id, count(*) as n from documents group by lang) g"""


ROLE_SQL.update({"r_creatives": SQL_CREATIVES, "r_content_library": SQL_CONTENT_LIBRARY,
                 "r_ad_copy": SQL_AD_COPY, "r_keywords": SQL_KEYWORDS})
ROLE_SPARK.update({"r_creatives": creatives, "r_content_library": content_library,
                   "r_ad_copy": ad_copy, "r_keywords": keywords})


# ---------------------------------------------------------------------------
# paid queries, interest series, ad schedule, email, product feed
# ---------------------------------------------------------------------------

def paid_queries(spark, d):
    """Paid search-term rows on the organic query vocabulary <- click events."""
    e = table(spark, d, "events").where(F.col("event_type") == "click")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("ts").cast("date").alias("date_start"), (F.col("user_id") % 4).alias("campaign_id"),
        F.concat(F.lit("search-"), (F.col("user_id") % 4).cast("string")).alias("campaign_name"),
        F.concat(F.lit("query "), (k % 40).cast("string")).alias("search_term"),
        F.lit(10).cast("bigint").alias("impressions"), F.lit(1).cast("bigint").alias("clicks"),
        (idiv("cast(round(value * 100) as bigint)", 10) / 100.0).alias("spend"),
        F.when(F.col("user_id") % 7 == 0, 1.0).otherwise(0.0).alias("conversions"),
        F.when(F.col("user_id") % 7 == 0, F.col("value")).otherwise(0.0).alias("conversion_value"))


SQL_PAID_QUERIES = """
select cast(ts as date) as date_start, user_id % 4 as campaign_id,
       'search-' || cast(user_id % 4 as varchar) as campaign_name,
       'query ' || cast(k % 40 as varchar) as search_term, cast(10 as bigint) as impressions,
       cast(1 as bigint) as clicks, (cast(round(value * 100) as bigint) // 10) / 100.0 as spend,
       case when user_id % 7 = 0 then 1.0 else 0.0 end as conversions,
       case when user_id % 7 = 0 then value else 0.0 end as conversion_value
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e
where event_type = 'click'"""


def interest(spark, d):
    """Weekly (Sunday) search interest per keyword <- lineitem shipments by return flag."""
    li = table(spark, d, "lineitem")
    day = F.col("l_shipdate").cast("date")
    wk = F.date_sub(day, F.dayofweek(day) - 1)
    g = li.groupBy(wk.alias("week"), F.concat(F.lit("kw "), F.col("l_returnflag")).alias("keyword")).agg(
        F.count(F.lit(1)).alias("n"))
    return g.select("week", "keyword", (F.col("n") % 101).alias("interest_score"),
                    (F.col("week") >= F.lit("2001-10-28").cast("date")).alias("is_partial"))


SQL_INTEREST = """
select week, keyword, n % 101 as interest_score, week >= date '2001-10-28' as is_partial
from (select cast(l_shipdate as date) - cast(dayofweek(cast(l_shipdate as date)) as integer) as week,
             'kw ' || l_returnflag as keyword, count(*) as n
      from lineitem group by 1, 2) g"""


def ad_schedule(spark, d):
    """Ad-schedule (dayparting) rows <- all lineitems."""
    li = table(spark, d, "lineitem")
    day = F.col("l_shipdate").cast("date")
    start = (F.col("l_linenumber") * 3) % 24
    return li.select(
        day.alias("date_start"), F.col("l_suppkey").alias("campaign_id"),
        F.concat(F.lit("search-"), F.col("l_suppkey").cast("string")).alias("campaign_name"),
        F.col("l_linenumber").cast("bigint").alias("criterion_id"),
        F.upper(F.date_format(day, "EEEE")).alias("day_of_week"),
        start.cast("bigint").alias("start_hour"), (start + 3).cast("bigint").alias("end_hour"),
        F.lit(0).cast("bigint").alias("start_minute"), F.lit(0).cast("bigint").alias("end_minute"),
        (F.col("l_quantity") * 40).cast("bigint").alias("impressions"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        (idiv("cast(round(l_extendedprice * 100) as bigint)", 1000) / 100.0).alias("cost"),
        F.round(F.col("l_discount") * 100).alias("conversions"),
        (idiv("cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint)", 100)
         / 100.0).alias("conversions_value"),
        F.col("l_shipdate").alias("ingested_at"))


SQL_AD_SCHEDULE = """
select cast(l_shipdate as date) as date_start, l_suppkey as campaign_id,
       'search-' || cast(l_suppkey as varchar) as campaign_name, cast(l_linenumber as bigint) as criterion_id,
       upper(dayname(cast(l_shipdate as date))) as day_of_week, cast((l_linenumber * 3) % 24 as bigint) as start_hour,
       cast((l_linenumber * 3) % 24 + 3 as bigint) as end_hour, cast(0 as bigint) as start_minute,
       cast(0 as bigint) as end_minute, cast(l_quantity * 40 as bigint) as impressions,
       cast(l_quantity as bigint) as clicks, (cast(round(l_extendedprice * 100) as bigint) // 1000) / 100.0 as cost,
       round(l_discount * 100) as conversions,
       (cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint) // 100) / 100.0
           as conversions_value,
       l_shipdate as ingested_at
from lineitem"""


def email_campaigns(spark, d):
    """Email campaigns <- one per conversation."""
    c = table(spark, d, "conversations")
    g = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    return g.select(F.col("conv_id").cast("string").alias("campaign_id"),
                    F.concat(F.lit("campaign "), F.col("conv_id").cast("string")).alias("campaign_name"),
                    F.when(F.col("conv_id") % 4 == 0, "Draft").otherwise("Sent").alias("status"),
                    F.timestamp_add("HOUR", F.col("conv_id").cast("int"),
                                    F.lit("2024-01-01 09:00:00").cast("timestamp")).alias("send_time"))


SQL_EMAIL_CAMPAIGNS = """
select cast(conv_id as varchar) as campaign_id, 'campaign ' || cast(conv_id as varchar) as campaign_name,
       case when conv_id % 4 = 0 then 'Draft' else 'Sent' end as status,
       timestamp '2024-01-01 09:00:00' + to_hours(cast(conv_id as integer)) as send_time
from (select conv_id, count(*) as turns from conversations group by conv_id) g"""


def email_metrics(spark, d):
    """Email campaign metrics <- conversation turns."""
    c = table(spark, d, "conversations")
    g = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    rec = F.col("turns") * 100
    return g.select(F.col("conv_id").cast("string").alias("campaign_id"), rec.alias("recipients"),
                    (rec - F.col("conv_id") % 7).alias("delivered"), (F.col("turns") * 30).alias("opens"),
                    (F.col("turns") * 4).alias("clicks"), (F.col("conv_id") % 3).alias("unsubscribes"),
                    F.col("turns").cast("double").alias("conversions"),
                    (F.col("chars") / 100.0).alias("revenue"),
                    F.lit("2024-02-01 00:00:00").cast("timestamp").alias("ingested_at"))


SQL_EMAIL_METRICS = """
select cast(conv_id as varchar) as campaign_id, turns * 100 as recipients, turns * 100 - conv_id % 7 as delivered,
       turns * 30 as opens, turns * 4 as clicks, conv_id % 3 as unsubscribes, cast(turns as double) as conversions,
       chars / 100.0 as revenue, timestamp '2024-02-01 00:00:00' as ingested_at
from (select conv_id, count(*) as turns, sum(length(text)) as chars from conversations group by conv_id) g"""


def email_timeline(spark, d):
    """Daily email metric counts <- events per day and type."""
    e = table(spark, d, "events")
    g = e.groupBy(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("metric_name")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    return g.withColumn("ingested_at", F.lit("2024-02-01 00:00:00").cast("timestamp"))


SQL_EMAIL_TIMELINE = """
select cast(ts as date) as date, event_type as metric_name, cast(count(*) as double) as value,
       timestamp '2024-02-01 00:00:00' as ingested_at
from events group by 1, 2"""


def feed_products(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("title"),
                    F.when(F.col("p_size") % 9 == 0, "out of stock").otherwise("in stock").alias("availability"),
                    F.col("p_retailprice").alias("price_value"), F.col("p_brand").alias("brand"),
                    F.lit("2001-11-05 00:00:00").cast("timestamp").alias("ingested_at"))


SQL_FEED_PRODUCTS = """
select cast(p_partkey as varchar) as product_id, p_name as title,
       case when p_size % 9 = 0 then 'out of stock' else 'in stock' end as availability,
       p_retailprice as price_value, p_brand as brand, timestamp '2001-11-05 00:00:00' as ingested_at
from part"""


def feed_statuses(spark, d):
    """Product status snapshots <- lineitem (one snapshot per shipment of the part)."""
    li = table(spark, d, "lineitem")
    bad = F.col("l_returnflag") == "R"
    return li.select(F.col("l_partkey").cast("string").alias("product_id"),
                     F.when(bad, "disapproved").otherwise("approved").alias("approval_status"),
                     F.when(bad, F.concat(F.lit("Returned items: "), F.col("l_linestatus"))).alias("disapproval_reasons"),
                     F.col("l_shipdate").alias("ingested_at"))


SQL_FEED_STATUSES = """
select cast(l_partkey as varchar) as product_id,
       case when l_returnflag = 'R' then 'disapproved' else 'approved' end as approval_status,
       case when l_returnflag = 'R' then 'Returned items: ' || l_linestatus end as disapproval_reasons,
       l_shipdate as ingested_at
from lineitem"""


ROLE_SQL.update({"r_paid_queries": SQL_PAID_QUERIES, "r_interest": SQL_INTEREST, "r_ad_schedule": SQL_AD_SCHEDULE,
                 "r_email_campaigns": SQL_EMAIL_CAMPAIGNS, "r_email_metrics": SQL_EMAIL_METRICS,
                 "r_email_timeline": SQL_EMAIL_TIMELINE, "r_feed_products": SQL_FEED_PRODUCTS,
                 "r_feed_statuses": SQL_FEED_STATUSES})
ROLE_SPARK.update({"r_paid_queries": paid_queries, "r_interest": interest, "r_ad_schedule": ad_schedule,
                   "r_email_campaigns": email_campaigns, "r_email_metrics": email_metrics,
                   "r_email_timeline": email_timeline, "r_feed_products": feed_products,
                   "r_feed_statuses": feed_statuses})


# ---------------------------------------------------------------------------
# run log, survey responses
# ---------------------------------------------------------------------------

AS_OF_RUNS = "2024-01-30 12:00:00"
_PIPELINE_OF_TYPE = {"view": "shopify", "click": "meta_ads", "purchase": "google_ads", "signup": "dbt",
                     "error": "klaviyo"}


def run_log(spark, d):
    """Pipeline run records <- events (one run per event)."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    name = None
    for t, p in _PIPELINE_OF_TYPE.items():
        name = F.when(F.col("event_type") == t, p) if name is None else name.when(F.col("event_type") == t, p)
    err = F.col("user_id") % 9 == 0
    return e.select(
        F.col("event_id").cast("string").alias("run_id"), name.alias("pipeline_name"),
        F.col("ts").cast("timestamp").alias("started_at"),
        F.timestamp_add("SECOND", F.round(F.col("value")).cast("int"), F.col("ts").cast("timestamp")).alias("finished_at"),
        F.when(err, "error").otherwise("success").alias("status"),
        F.round(F.col("value") * 10).cast("bigint").alias("rows_loaded"),
        F.col("value").alias("duration_seconds"),
        F.when(err, F.concat(F.lit("HTTP 500 from "), name)).otherwise(F.lit("")).alias("error_message"),
        F.concat(F.lit("sha"), (k % 10).cast("string")).alias("git_sha"))


SQL_RUN_LOG = f"""
select cast(event_id as varchar) as run_id,
       case {' '.join(f"when event_type = '{t}' then '{p}'" for t, p in _PIPELINE_OF_TYPE.items())} end
           as pipeline_name,
       cast(ts as timestamp) as started_at,
       cast(ts as timestamp) + to_seconds(cast(round(value) as integer)) as finished_at,
       case when user_id % 9 = 0 then 'error' else 'success' end as status,
       cast(round(value * 10) as bigint) as rows_loaded, value as duration_seconds,
       case when user_id % 9 = 0 then 'HTTP 500 from ' ||
            case {' '.join(f"when event_type = '{t}' then '{p}'" for t, p in _PIPELINE_OF_TYPE.items())} end
            else '' end as error_message,
       'sha' || cast(k % 10 as varchar) as git_sha
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e"""

# survey answers (bench shaping only): conv_id % 7 picks one
_ANSWERS = ["Search Engine (Google, Bing)", "Social Media (Instagram)", "House Brand Podcast",
            "From an Influencer", "Friend or Family", "Some other community", "Magazine"]


def survey_responses(spark, d):
    """Post-purchase survey answers <- user turns of conversations."""
    c = table(spark, d, "conversations").where(F.col("role") == "user")
    ans = None
    for i, a in enumerate(_ANSWERS):
        ans = F.when(F.col("conv_id") % 7 == i, a) if ans is None else ans.when(F.col("conv_id") % 7 == i, a)
    return c.select(
        F.concat_ws("-", "conv_id", "turn").alias("response_id"),
        F.timestamp_add("HOUR", (F.col("conv_id") * 3 + F.col("turn")).cast("int"),
                        F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("responded_at"),
        ans.alias("how_did_you_hear"), (F.length("text") / 10.0).alias("order_total"))


SQL_SURVEY = f"""
select concat_ws('-', conv_id, turn) as response_id,
       timestamp '2024-01-01 00:00:00' + to_hours(cast(conv_id * 3 + turn as integer)) as responded_at,
       case {' '.join(f"when conv_id % 7 = {i} then '{a}'" for i, a in enumerate(_ANSWERS))} end as how_did_you_hear,
       length(text) / 10.0 as order_total
from conversations where role = 'user'"""

ROLE_SQL.update({"r_run_log": SQL_RUN_LOG, "r_survey": SQL_SURVEY})
ROLE_SPARK.update({"r_run_log": run_log, "r_survey": survey_responses})


# ---------------------------------------------------------------------------
# marketplace: order report lines and advertised-product rows <- lineitem
# ---------------------------------------------------------------------------

def market_orders(spark, d):
    """Marketplace order report (all text, as landed) <- lineitem."""
    li = table(spark, d, "lineitem")
    cur = F.when(F.col("l_suppkey") % 3 == 1, "CAD").when(F.col("l_suppkey") % 3 == 2, "MXN").otherwise("USD")
    return li.select(
        F.concat(F.lit("S-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("asin"), cur.alias("currency"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        F.format_string("%.2f", F.col("l_extendedprice")).alias("item_price"),
        F.when(F.col("l_returnflag") == "R", "Cancelled").otherwise("Shipped").alias("item_status"),
        F.when(F.col("l_linestatus") == "O", "Pending").otherwise("Shipped").alias("order_status"),
        F.lit("US").alias("ship_country"), F.lit("Amazon.com").alias("sales_channel"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("purchase_date"),
        F.concat(F.lit("AMZ-"), F.col("l_orderkey").cast("string")).alias("amazon_order_id"),
        F.lit("Standard").alias("ship_service_level"),
        F.when(F.col("l_discount") > 0.05, (F.round(F.col("l_discount") * 100)).cast("bigint").cast("string"))
         .alias("item_promotion_discount"))


SQL_MARKET_ORDERS = """
select 'S-' || cast(l_partkey as varchar) as sku, 'B' || cast(l_partkey as varchar) as asin,
       case when l_suppkey % 3 = 1 then 'CAD' when l_suppkey % 3 = 2 then 'MXN' else 'USD' end as currency,
       cast(cast(l_quantity as bigint) as varchar) as quantity, printf('%.2f', l_extendedprice) as item_price,
       case when l_returnflag = 'R' then 'Cancelled' else 'Shipped' end as item_status,
       case when l_linestatus = 'O' then 'Pending' else 'Shipped' end as order_status,
       'US' as ship_country, 'Amazon.com' as sales_channel,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as purchase_date,
       'AMZ-' || cast(l_orderkey as varchar) as amazon_order_id, 'Standard' as ship_service_level,
       case when l_discount > 0.05 then cast(cast(round(l_discount * 100) as bigint) as varchar) end
           as item_promotion_discount
from lineitem"""


def market_ads(spark, d):
    """Advertised-product report rows (two loads per day: odd/even line numbers) <- all lineitems."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("advertised_asin"),
        F.format_string("%.2f", idiv("cast(round(l_extendedprice * 100) as bigint)", 1000) / 100.0).alias("cost"),
        (F.col("l_quantity") * 40).cast("bigint").cast("string").alias("impressions"),
        F.col("l_quantity").cast("bigint").cast("string").alias("clicks"),
        F.format_string("%.2f", idiv("cast(round(l_extendedprice * 100) as bigint)", 10) / 100.0).alias("sales14d"),
        (F.col("l_linenumber") % 2 + 1).alias("_loaded_at"))


SQL_MARKET_ADS = """
select cast(l_shipdate as date) as date, 'B' || cast(l_partkey as varchar) as advertised_asin,
       printf('%.2f', (cast(round(l_extendedprice * 100) as bigint) // 1000) / 100.0) as cost,
       cast(cast(l_quantity * 40 as bigint) as varchar) as impressions,
       cast(cast(l_quantity as bigint) as varchar) as clicks,
       printf('%.2f', (cast(round(l_extendedprice * 100) as bigint) // 10) / 100.0) as sales14d,
       l_linenumber % 2 + 1 as _loaded_at
from lineitem"""

ROLE_SQL.update({"r_market_orders": SQL_MARKET_ORDERS, "r_market_ads": SQL_MARKET_ADS})
ROLE_SPARK.update({"r_market_orders": market_orders, "r_market_ads": market_ads})


# ---------------------------------------------------------------------------
# store-side sessions, content posts
# ---------------------------------------------------------------------------

def store_sessions(spark, d):
    """Store-side daily traffic counts <- events per day (event counts, not distinct users)."""
    e = table(spark, d, "events")
    t = F.col("event_type")
    return e.groupBy(F.col("ts").cast("date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(t == "view").alias("product_views"),
        F.count_if(t == "click").alias("add_to_carts"), F.count_if(t == "signup").alias("checkouts"),
        F.count_if(t == "purchase").alias("orders"))


SQL_STORE_SESSIONS = """
select cast(ts as date) as report_date, count(*) as sessions, count_if(event_type = 'view') as product_views,
       count_if(event_type = 'click') as add_to_carts, count_if(event_type = 'signup') as checkouts,
       count_if(event_type = 'purchase') as orders
from events group by 1"""


def content_posts(spark, d):
    """Content posts <- pages (title from the html <title>, words of the html text)."""
    p = table(spark, d, "pages")
    return p.select(
        F.col("page_id").alias("post_id"), F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.concat(F.lit("query "), (F.col("page_id") % 40).cast("string")).alias("target_keyword"),
        F.when(F.col("page_id") % 2 == 0, "blog").otherwise("guide").alias("content_type"),
        F.lit("web").alias("platform"), F.lit("published").alias("status"),
        F.concat(F.lit("https://example.com/p/"), (F.col("page_id") % 25).cast("string")).alias("url"),
        F.size(F.split(F.trim(F.regexp_replace("html", r"<[^>]*>", " ")), r"\s+")).cast("bigint").alias("word_count"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int")).alias("publish_date"))


SQL_CONTENT_POSTS = r"""
select page_id as post_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
       'query ' || cast(page_id % 40 as varchar) as target_keyword,
       case when page_id % 2 = 0 then 'blog' else 'guide' end as content_type, 'web' as platform,
       'published' as status, 'https://example.com/p/' || cast(page_id % 25 as varchar) as url,
       cast(len(regexp_split_to_array(trim(regexp_replace(html, '<[^>]*>', ' ', 'g')), '\s+')) as bigint) as word_count,
       date '2024-01-01' + cast(page_id % 30 as integer) as publish_date
from pages"""

ROLE_SQL.update({"r_store_sessions": SQL_STORE_SESSIONS, "r_content_posts": SQL_CONTENT_POSTS})
ROLE_SPARK.update({"r_store_sessions": store_sessions, "r_content_posts": content_posts})
