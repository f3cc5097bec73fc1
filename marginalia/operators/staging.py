"""Staging contracts (S-01..S-66): raw feed -> typed, renamed, deduplicated table.

Each contract is data, not code: a list of ``(output name, source expression,
type)`` entries plus optional row filter, ``distinct`` and dedup rule.
``stage(df, name)`` turns the spec into one ``select`` (so Catalyst prunes
the raw columns a contract does not use).  Dedup rules:

* ``latest``    one row per key, the newest ``_loaded_at`` (ties broken by the
                row's content), as a ``max_by`` aggregation: partially
                aggregated on the mappers, so a hot key is not one task;
* ``latest_all`` every row of the newest load per key (keep-all-ties), by a
                window over a key's rows (which spill where they are many);
                keys that hold a NULL are left out, as a join would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import round_half_away, safe_div
from marginalia.functions.windows import spread

# Fixed values that must equal the reference's for equal results:
#   marketplace FX to USD: MXN x 0.054, CAD x 0.72;  order-time zone: US/Pacific
#   cancelled marketplace orders/items dropped (status 'Cancelled')
FX = {"MXN": 0.054, "CAD": 0.72}
ORDER_TZ = "US/Pacific"
MONEY = "decimal(38,9)"

# name -> dict(cols=[(out, expr, type)], where=, distinct=, dedup=(kind, keys, order))
# an expr of None means "the column of the same name"; computed entries are callables
SPECS: dict[str, dict] = {
    "amazon__ad_spend": dict(
        cols=[("date", None, "date"), ("asin", "advertised_asin", "string"), ("cost", None, "double"),
              ("impressions", None, "bigint"), ("clicks", None, "bigint"), ("ad_sales", "sales14d", "double"),
              ("_loaded_at", None, None)],
        dedup=("latest_all", ["asin", "date"], "_loaded_at"),
        post=lambda df: df.select("date", "asin", F.coalesce("cost", F.lit(0.0)).alias("cost"), "impressions",
                                  "clicks", "ad_sales")),
    "amazon__traffic": dict(
        cols=[("child_asin", None, "string"), ("parent_asin", None, "string"), ("report_date", None, "date"),
              ("units_ordered", None, "bigint"), ("units_ordered_b2b", None, "bigint"),
              ("total_order_items", None, "bigint"), ("ordered_product_sales_amount", None, MONEY),
              ("ordered_product_sales_currency", None, "string"), ("sessions", None, "bigint"),
              ("page_views", None, "bigint"), ("buy_box_percentage", None, MONEY),
              ("unit_session_percentage", None, MONEY), ("_loaded_at", None, None)],
        dedup=("latest", ["child_asin", "report_date"], "_loaded_at")),
    "amazon__fba_fees": dict(
        cols=[*[(c, None, "string") for c in ("sku", "asin", "product_name", "product_group", "brand", "fulfilled_by", "product_size_tier")],
              ("your_price", None, MONEY), ("sales_price", None, MONEY), ("estimated_fee_total", None, MONEY),
              ("estimated_referral_fee_per_unit", None, MONEY), ("estimated_variable_closing_fee", None, MONEY),
              ("estimated_order_handling_fee", "estimated_order_handling_fee_per_order", MONEY),
              ("estimated_pick_pack_fee_per_unit", None, MONEY),
              ("estimated_weight_handling_fee", "estimated_weight_handling_fee_per_unit", MONEY),
              ("expected_fulfillment_fee_per_unit", None, MONEY), ("currency", None, "string"), ("_loaded_at", None, None)],
        dedup=("latest", ["sku", "asin"], "_loaded_at")),
    "amazon__fba_shipments": dict(
        cols=[*[(c, None, "string") for c in ("amazon_order_id", "sku", "shipment_id", "shipment_item_id", "buyer_email", "carrier",
                                              "tracking_number", "fulfillment_center_id")],
              ("quantity_shipped", None, "bigint"), ("item_price", None, MONEY), ("ship_city", None, "string"), ("ship_state", None, "string"),
              ("ship_postal_code", None, "string"), ("ship_country", None, "string"), ("shipment_date", None, "timestamp"), ("estimated_arrival_date", None, "timestamp"),
              ("_loaded_at", None, None)],
        dedup=("latest", ["amazon_order_id", "sku", "shipment_id", "shipment_item_id"], "_loaded_at")),
    "google_ads__pmax_insights": dict(
        cols=[("date_start", None, None), ("campaign_id", None, "bigint"), ("campaign_name", None, None),
              ("impressions", None, None), ("clicks", None, None), ("spend", None, None),
              ("conversions", None, None), ("conversion_value", None, None)],
        post=lambda df: df.select("*", safe_div(F.col("conversion_value"), F.col("spend")).alias("roas"),
                                  safe_div(F.col("spend"), F.col("conversions")).alias("cpa"))),
    "quickbooks__partner_mapping": dict(
        cols=[("sender_name", None, "string"), ("sender_email", None, "string"), ("partner_brand", None, "string"),
              ("payment_count", "payments", "bigint"), ("total_amount", None, "double"),
              ("currencies", None, None), ("first_payment", None, None), ("last_payment", None, None),
              ("sample_subjects", None, None)],
        where=lambda df: F.col("sender_name").isNotNull() & (F.col("sender_name") != "")),
    "youtube__video_analytics": dict(
        cols=[("video_id", None, None), ("period_start", None, "date"), ("period_end", None, "date"),
              ("views", None, None), ("estimated_minutes_watched", None, None),
              ("avg_view_duration_minutes", lambda: round_half_away(F.col("avg_view_duration_seconds") / 60.0, 2), None),
              ("avg_view_duration_seconds", None, None),
              ("avg_view_percentage", lambda: round_half_away(F.col("avg_view_percentage"), 4), None),
              ("likes", None, None), ("comments", None, None), ("shares", None, None),
              ("subscribers_gained", None, None), ("subscribers_lost", None, None),
              ("net_subscribers", lambda: F.col("subscribers_gained") - F.col("subscribers_lost"), None),
              ("ingested_at", None, "timestamp")]),
    "shopify__orders": dict(
        cols=[("order_id", None, "bigint"), ("order_number", None, "bigint"), ("order_date", None, "date"),
              ("created_at", None, "timestamp"), ("updated_at", None, "timestamp"),
              ("total_price", None, "double"), ("subtotal_price", None, "double"), ("total_tax", None, "double"),
              ("total_shipping", None, "double"), ("total_discounts", None, "double"),
              ("customer_id", None, "bigint"), ("customer_email", None, "string"),
              ("financial_status", None, "string"), ("fulfillment_status", None, "string"),
              ("currency", None, "string"), ("source_name", None, "string"), ("referring_site", None, "string"),
              ("landing_site", None, "string"), ("utm_source", None, "string"), ("utm_medium", None, "string"),
              ("utm_campaign", None, "string"), ("utm_content", None, "string"), ("utm_term", None, "string"),
              ("cancelled_at", None, "string"), ("cancel_reason", None, "string"), ("note", None, "string"),
              ("tags", None, "string")]),
    "shopify__order_line_items": dict(
        cols=[("line_item_id", None, "bigint"), ("order_id", None, "bigint"), ("product_id", None, "bigint"),
              ("variant_id", None, "bigint"), ("title", None, "string"), ("variant_title", None, "string"),
              ("sku", None, "string"), ("quantity", None, "bigint"), ("price", None, "double"),
              ("total_discount", None, "double"), ("order_date", None, "date")]),
    "meta__daily_insights": dict(
        cols=[("date_start", None, "date"), ("campaign_id", None, "string"), ("campaign_name", None, "string"),
              ("adset_id", None, "string"), ("adset_name", None, "string"), ("ad_id", None, "string"),
              ("ad_name", None, "string"), ("impressions", None, "bigint"), ("clicks", None, "bigint"),
              ("spend", None, "double"), ("cpc", None, "double"), ("cpm", None, "double"), ("ctr", None, "double"),
              ("reach", None, "bigint"), ("frequency", None, "double"), ("purchases", None, "bigint"),
              ("purchase_value", None, "double"), ("add_to_cart", None, "bigint"),
              ("add_to_cart_value", None, "double"), ("initiate_checkout", None, "bigint"),
              ("initiate_checkout_value", None, "double"), ("landing_page_views", None, "bigint"),
              ("link_clicks", None, "bigint")]),
    "google_ads__daily_insights": dict(
        cols=[("date_start", None, "date"), ("campaign_id", None, "bigint"), ("campaign_name", None, "string"),
              ("campaign_type", None, "string"), ("ad_group_id", None, "bigint"), ("ad_group_name", None, "string"),
              ("impressions", None, "bigint"), ("clicks", None, "bigint"), ("spend", None, "double"),
              ("cpc", None, "double"), ("ctr", None, "double"), ("conversions", None, "double"),
              ("conversion_value", None, "double"), ("cost_per_conversion", None, "double"),
              ("search_impression_share", None, "double")]),
    "google_ads__search_terms": dict(
        cols=[("date_start", None, "date"), ("campaign_id", None, "bigint"), ("campaign_name", None, "string"),
              ("ad_group_id", None, "bigint"), ("ad_group_name", None, "string"), ("search_term", None, "string"),
              ("keyword_text", None, "string"), ("match_type", None, "string"), ("impressions", None, "bigint"),
              ("clicks", None, "bigint"), ("spend", None, "double"), ("conversions", None, "double"),
              ("conversion_value", None, "double")]),
    "google_ads__auction_insights": dict(
        # the loader writes date_start / domain (R-07): map them, not the names the model reads
        cols=[("date", "date_start", "date"), ("campaign_id", None, "bigint"), ("campaign_name", None, "string"),
              ("competitor_domain", "domain", "string"), ("impression_share", None, "double"),
              ("overlap_rate", None, "double"), ("position_above_rate", None, "double"),
              ("top_of_page_rate", None, "double"), ("outranking_share", None, "double"), ("ingested_at", None, "timestamp")]),
    "search_console__performance": dict(
        cols=[("query_date", None, "date"), ("site", None, "string"), ("query", None, "string"),
              ("page", None, "string"), ("country", None, "string"), ("device", None, "string"),
              ("impressions", None, "bigint"), ("clicks", None, "bigint"), ("ctr", None, "double"),
              ("position", None, "double"), ("ingested_at", None, "timestamp")]),
    "quickbooks__deposits": dict(
        cols=[("deposit_id", None, "string"), ("txn_date", None, "date"), ("total_amount", None, "double"),
              ("deposit_to_account_name", None, "string"), ("source_summary", None, "string"),
              ("memo", None, "string"), ("line_count", None, "bigint"), ("currency", None, "string"),
              ("created_at", None, "timestamp"), ("updated_at", None, "timestamp")]),
    "quickbooks__purchase_line_items": dict(
        cols=[("line_item_id", None, "string"), ("purchase_id", None, "string"), ("txn_date", None, "date"),
              ("vendor_id", None, "string"), ("vendor_name", None, "string"), ("description", None, "string"),
              ("amount", None, "double"), ("account_id", None, "string"), ("account_name", None, "string"),
              ("customer_id", None, "string"), ("customer_name", None, "string"),
              ("billable_status", None, "string")]),
    "quickbooks__accounts": dict(
        cols=[("account_id", None, "string"), ("name", None, "string"), ("fully_qualified_name", None, "string"),
              ("account_type", None, "string"), ("account_sub_type", None, "string"),
              ("classification", None, "string"), ("current_balance", None, "double"), ("currency", None, "string"),
              ("active", None, "boolean"), ("created_at", None, "string"), ("updated_at", None, "string")]),
    "paypal__transactions": dict(
        cols=[("transaction_id", None, "string"), ("transaction_at", "transaction_date", "timestamp"), ("transaction_date", None, "date"),
              ("transaction_updated_at", "transaction_updated_date", "timestamp"), ("transaction_amount", None, MONEY), ("fee_amount", None, MONEY),
              *[(c, None, "string") for c in (
                  "currency_code", "transaction_status", "transaction_event_code", "transaction_subject", "transaction_note", "paypal_reference_id",
                  "paypal_reference_id_type", "invoice_id", "custom_field", "payer_email", "payer_account_id", "payer_given_name", "payer_surname",
                  "payer_full_name", "payer_alternate_name", "first_item_name")],
              ("item_count", None, "bigint"), ("ingested_at", None, "timestamp")]),
    "klaviyo__campaigns": dict(
        cols=[("campaign_id", "id", "string"), ("campaign_name", "name", "string"), ("status", None, "string"),
              ("send_time", None, "timestamp"), ("created_at", None, "timestamp"), ("updated_at", None, "timestamp"),
              ("ingested_at", None, "timestamp")]),
    "klaviyo__campaign_metrics": dict(
        cols=[("campaign_id", None, "string"), ("campaign_name", None, "string"), ("send_date", None, "date"), ("recipients", None, "double"), ("delivered", None, "double"),
              ("opens", None, "double"), ("clicks", None, "double"), ("unsubscribes", None, "double"),
              ("conversions", None, "double"), ("revenue", None, "double"), ("ingested_at", None, "timestamp")]),
    "youtube__videos": dict(
        cols=[("video_id", None, "string"), ("title", None, "string"), ("description", None, "string"),
              ("published_at", lambda: F.to_timestamp("published_at"), None),
              ("published_date", lambda: F.to_date(F.to_timestamp("published_at")), None),
              *[(c, None, "string") for c in ("channel_id", "tags", "category_id", "duration", "thumbnail_url", "privacy_status")],
              ("made_for_kids", None, "boolean"), ("ingested_at", None, "timestamp")]),
    "google_trends__interest_over_time": dict(
        cols=[("week", None, "date"), ("keyword", None, "string"), ("interest_score", None, "bigint"),
              ("is_partial", None, "boolean"), ("ingested_at", None, "timestamp")]),
}


def _col(out, expr, typ):
    if callable(expr):
        expr = expr()
    e = F.col(out) if expr is None else (F.col(expr) if isinstance(expr, str) else expr)
    return (e.cast(typ) if typ else e).alias(out)


def dedup(df: DataFrame, kind: str, keys: list[str], order: str) -> DataFrame:
    if kind == "latest":
        cols = df.columns
        rank = F.struct(F.col(order), F.xxhash64(*[F.col(c) for c in cols]))
        g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_r"))
        return g.select(*[F.col(f"_r.{c}").alias(c) for c in cols])
    if kind == "latest_all":
        # one scan and one shuffle: the newest stamp is a window over a key's loads; rows without a key are no rows of it
        keyed = df
        for k in keys:
            keyed = keyed.where(F.col(k).isNotNull())
        keyed = spread(keyed, *keys)
        newest = F.max(order).over(Window.partitionBy(*keys))
        return keyed.withColumn("_newest", newest).where(F.col(order) == F.col("_newest")).drop("_newest")
    raise ValueError(kind)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Apply the staging contract ``name`` to a raw frame."""
    spec = SPECS[name]
    if spec.get("where") is not None:
        df = df.where(spec["where"](df))
    out = df.select(*[_col(o, e, t) for o, e, t in spec["cols"]])
    if spec.get("distinct"):
        out = out.distinct()
    if spec.get("dedup"):
        out = dedup(out, *spec["dedup"])
    if spec.get("post"):
        out = spec["post"](out)
    return out


def orders_clean(raw: DataFrame, *, fx: dict | None = None, tz: str = ORDER_TZ) -> DataFrame:
    """S-04: marketplace order lines: distinct rows, cancelled (and NULL-status) rows dropped,
    money in USD, purchase time also as Pacific wall clock, sales = price - promotion."""
    fx = fx or FX
    money = lambda c: F.coalesce(F.col(c), F.lit("0")).cast(MONEY)
    p = raw.where((F.col("order_status") != "Cancelled") & (F.col("item_status") != "Cancelled")).select(
        "sku", "asin", "currency", money("quantity").alias("quantity"), money("item_price").alias("item_price"),
        "item_status", "order_status", "ship_country", "sales_channel",
        F.col("purchase_date").cast("timestamp").alias("purchase_date"), "amazon_order_id", "ship_service_level",
        money("item_promotion_discount").alias("item_promotion_discount")).distinct()
    # the purchase time makes the Pacific one, so rows are as distinct without it
    p = p.select(*p.columns[:9], F.from_utc_timestamp("purchase_date", tz).alias("purchase_date_pac"), *p.columns[9:])
    rate = F.lit(1.0)
    for cur, r in fx.items():
        rate = F.when(F.col("currency") == cur, F.lit(r)).otherwise(rate)
    rate = rate.cast("decimal(10,4)")
    p = p.select("*", (F.col("item_price") * rate).alias("corrected_item_price"),
                 (F.col("item_promotion_discount") * rate).alias("corrected_item_promotion_discount"))
    return p.withColumn("sales", F.col("corrected_item_price") - F.col("corrected_item_promotion_discount"))


def projection(spec: str) -> list[tuple]:
    """'out[=src][:type] ...' -> contract columns (plain rename/cast projections)."""
    cols = []
    for tok in spec.split():
        typ = None
        if ":" in tok:
            tok, typ = tok.split(":", 1)
        out, src = (tok.split("=", 1) if "=" in tok else (tok, None))
        cols.append((out, src, typ))
    return cols


# plain rename/cast contracts (one select each)
PROJECTIONS = {
    "google_ads__campaigns": "campaign_id:bigint campaign_name campaign_type bidding_strategy_type status "
                             "budget_amount:double",
    "google_ads__ad_groups": "ad_group_id:bigint campaign_id:bigint ad_group_name ad_group_type status "
                             "cpc_bid=cpc_bid_micros:double",
    "google_ads__keywords": "keyword_id:bigint ad_group_id:bigint campaign_id:bigint keyword_text match_type status "
                            "quality_score:bigint expected_ctr ad_relevance landing_page_experience",
    "google_ads__shopping_performance": "date_start:date product_title product_item_id product_type_l1 product_brand "
                                        "campaign_id:bigint campaign_name impressions:bigint clicks:bigint "
                                        "spend:double conversions:double conversion_value:double",
    "google_ads__geographic_view": "date_start:date location_type country_criterion_id:bigint campaign_id:bigint "
                                   "campaign_name impressions:bigint clicks:bigint spend:double conversions:double "
                                   "conversion_value:double",
    "google_ads__ad_schedule_view": "date_start:date campaign_id:bigint campaign_name criterion_id:bigint day_of_week "
                                    "start_hour:bigint end_hour:bigint start_minute end_minute impressions:bigint "
                                    "clicks:bigint cost:double conversions:double conversions_value:double "
                                    "ingested_at:timestamp",
    "google_ads__asset_group": "asset_group_id:bigint asset_group_name status campaign_id:bigint campaign_name",
    "google_ads__asset_group_asset": "asset_resource_name field_type status asset_group_id:bigint asset_group_name "
                                     "campaign_id:bigint campaign_name",
    "google_ads__conversion_action": "conversion_action_id:bigint conversion_action_name status conversion_type "
                                     "default_value:double always_use_default_value:boolean counting_type "
                                     "include_in_conversions_metric:boolean",
    "google_ads__campaign_negative_keywords": "criterion_id:bigint campaign_id:bigint campaign_name keyword_text "
                                             "match_type status",
    "google_ads__ad_group_negative_keywords": "criterion_id:bigint ad_group_id:bigint ad_group_name "
                                             "campaign_id:bigint campaign_name keyword_text match_type status",
    "meta__ads": "ad_id:string adset_id:string campaign_id:string creative_id:string ad_name status",
    "meta__adsets": "adset_id:string campaign_id:string adset_name status targeting_summary optimization_goal "
                    "billing_event",
    "meta__campaigns": "campaign_id:string campaign_name objective status daily_budget:double created_time "
                       "updated_time",
    "meta__creatives": "creative_id:string ad_id:string ad_name title body cta_type image_url video_id thumbnail_url "
                       "object_type",
    "shopify__products": "product_id:bigint title handle product_type vendor status tags created_at updated_at",
    "shopify__product_variants": "variant_id:bigint product_id:bigint price:double compare_at_price:double "
                                 "inventory_quantity:bigint title sku",
    "shopify__customers": "customer_id:bigint orders_count:bigint total_spent:double email first_name last_name "
                          "state accepts_marketing city province country tags",
    "quickbooks__customers": "customer_id:string display_name company_name given_name family_name email phone city "
                             "state postal_code country balance:double active:boolean is_project:boolean "
                             "created_at updated_at",
    "quickbooks__invoice_line_items": "line_item_id:string invoice_id:string txn_date:date customer_id:string "
                                      "line_num:bigint description item_id:string item_name quantity:double "
                                      "unit_price:double amount:double discount_rate:double tax_code",
    "quickbooks__invoices": "invoice_id:string doc_number txn_date:date due_date:date customer_id:string "
                            "customer_name total_amount:double balance:double currency email_status billing_email "
                            "ship_date:date tracking_num txn_status created_at updated_at",
    "quickbooks__items": "item_id:string name fully_qualified_name type description unit_price:double "
                         "purchase_cost:double sku income_account_id income_account_name active:boolean "
                         "taxable:boolean created_at updated_at",
    "quickbooks__payments": "payment_id:string txn_date:date customer_id:string customer_name total_amount:double "
                            "unapplied_amount:double payment_method_id:string deposit_to_account_id:string currency "
                            "created_at updated_at",
    "quickbooks__purchases": "purchase_id:string txn_date:date payment_type total_amount:double account_id:string "
                             "account_name vendor_id:string vendor_name memo currency credit:boolean "
                             "line_count:bigint line_summary created_at updated_at",
    "quickbooks__sales_receipts": "sales_receipt_id:string txn_date:date customer_id:string customer_name "
                                  "total_amount:double subtotal_amount:double payment_method_name "
                                  "deposit_to_account_name currency memo created_at updated_at",
    "quickbooks__vendors": "vendor_id:string display_name company_name given_name family_name email balance:double "
                           "active:boolean vendor_1099:boolean created_at updated_at",
    "klaviyo__flows": "flow_id=id flow_name=name status trigger_type created_at=created:timestamp "
                      "updated_at=updated:timestamp ingested_at:timestamp",
    "klaviyo__metrics_timeline": "date:date metric_id metric_name value:double ingested_at:timestamp",
    "merchant_center__product_statuses": "product_id title approval_status disapproval_reasons issue_code "
                                         "issue_servability issue_resolution issue_attribute issue_destination "
                                         "issue_description ingested_at:timestamp",
    "merchant_center__products": "product_id title description link image_link availability price_value "
                                 "price_currency brand condition custom_label_0 custom_label_1 custom_label_2 "
                                 "custom_label_3 custom_label_4 product_types google_product_category "
                                 "ingested_at:timestamp",
    "merchant_center__shopping_ads_program": "state region_code eligibility_status review_issues ingested_at:timestamp",
    "youtube__channel_stats": "channel_id channel_title=title snapshot_date:date subscriber_count view_count "
                              "video_count hidden_subscriber_count ingested_at:timestamp",
    "youtube__video_stats": "video_id snapshot_date:date view_count like_count comment_count favorite_count "
                            "ingested_at:timestamp",
    "google_trends__related_queries": "keyword query_type related_query value:bigint ingested_at:timestamp",
}
for _name, _spec in PROJECTIONS.items():
    SPECS.setdefault(_name, dict(cols=projection(_spec)))


# marketplace ad reports: (source column of purchases, sales, units) per report family
_AD_METRICS = {"SPONSORED_PRODUCTS": ("purchases14d", "sales14d", "units_sold_clicks14d", "bigint"),
               "SPONSORED_BRANDS": ("purchases", "sales", "units_sold", "bigint"),
               "SPONSORED_DISPLAY": ("purchases_clicks", "sales_clicks", "units_sold_clicks", "double")}


def _ad_ratios(df: DataFrame) -> DataFrame:
    clicks, impr = F.col("clicks").cast("double"), F.col("impressions").cast("double")
    return df.select("*", safe_div(clicks, impr).alias("ctr"), safe_div(F.col("cost"), clicks).alias("cpc"),
                     safe_div(F.col("cost"), F.col("sales")).alias("acos"),
                     safe_div(F.col("sales"), F.col("cost")).alias("roas"))


def _ad_spec(product: str, level: str) -> dict:
    purchases, sales, units, units_type = _AD_METRICS[product]
    head = [("report_date", "date", "date"), ("campaign_id", None, "string"), ("campaign_name", None, None)]
    if level == "campaign":
        head += [("campaign_status", None, None)]
    else:
        asin, sku = ("promoted_asin", "promoted_sku") if product == "SPONSORED_DISPLAY" else \
            ("advertised_asin", "advertised_sku")
        head += [("ad_group_id", None, "string"), ("ad_group_name", None, None), ("asin", asin, None),
                 ("sku", sku, None)]
    cols = head + [("profile_id", None, "string"), ("ad_product", lambda: F.lit(product), None),
                   ("impressions", None, "bigint"), ("clicks", None, "bigint"), ("cost", None, "double"),
                   ("purchases", purchases, "bigint"), ("sales", sales, "double")]
    if level == "campaign" or product == "SPONSORED_DISPLAY":
        cols.append(("units_sold", units, units_type))
    cols.append(("_loaded_at", None, None))
    return dict(cols=cols, post=_ad_ratios)


SPECS.update({
    "amazon_ads__sp_campaigns": _ad_spec("SPONSORED_PRODUCTS", "campaign"),
    "amazon_ads__sb_campaigns": _ad_spec("SPONSORED_BRANDS", "campaign"),
    "amazon_ads__sd_campaigns": _ad_spec("SPONSORED_DISPLAY", "campaign"),
    "amazon_ads__sp_asin": _ad_spec("SPONSORED_PRODUCTS", "asin"),
    "amazon_ads__sd_asin": _ad_spec("SPONSORED_DISPLAY", "asin"),
    "shopify__sessions": dict(cols=projection("report_date:date referrer_source:string sessions:bigint "
                                              "product_views:bigint add_to_carts:bigint checkouts:bigint "
                                              "orders:bigint")),
})

# optional sources: absent table -> empty frame with the contract's schema (I-50)
OPTIONAL_DDL = {
    "google_ads__bidding_strategy": ("bidding_strategy_id bigint, bidding_strategy_name string, "
                                     "bidding_strategy_type string, target_cpa double, target_roas double, "
                                     "maximize_conversions_target_cpa double"),
}
SPECS["google_ads__bidding_strategy"] = dict(cols=[
    ("bidding_strategy_id", None, "bigint"), ("bidding_strategy_name", None, None), ("bidding_strategy_type", None, None),
    ("target_cpa", lambda: safe_div(F.col("target_cpa_micros").cast("double"), F.lit(1_000_000.0)), None),
    ("target_roas", None, "double"),
    ("maximize_conversions_target_cpa",
     lambda: safe_div(F.col("maximize_conversions_target_cpa_micros").cast("double"), F.lit(1_000_000.0)), None)])


def stage_optional(spark, table_name: str, name: str) -> DataFrame:
    """Stage a source that may not exist yet; an absent table gives an empty typed frame."""
    if spark.catalog.tableExists(table_name):
        return stage(spark.table(table_name), name)
    return spark.createDataFrame([], OPTIONAL_DDL[name])


SPECS["google_ads__campaign_asset_set"] = dict(cols=projection(
    "campaign_resource_name asset_set_resource_name status asset_set_id:bigint asset_set_name asset_set_type "
    "campaign_id:bigint campaign_name"))
SPECS["google_ads__campaign_audience_view"] = dict(cols=projection(
    "resource_name campaign_id:bigint campaign_name impressions:bigint clicks:bigint spend:double conversions:double "
    "conversion_value:double"))
OPTIONAL_DDL.update({
    "google_ads__campaign_asset_set": ("campaign_resource_name string, asset_set_resource_name string, status string, "
                                       "asset_set_id bigint, asset_set_name string, asset_set_type string, "
                                       "campaign_id bigint, campaign_name string"),
    "google_ads__campaign_audience_view": ("resource_name string, campaign_id bigint, campaign_name string, "
                                           "impressions bigint, clicks bigint, spend double, conversions double, "
                                           "conversion_value double"),
})
