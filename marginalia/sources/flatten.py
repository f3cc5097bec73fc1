"""Record shaping for landed API payloads (I-10..I-59).

Each flattener is a ``select`` over a DataFrame read with a fixed schema
(nested structs and arrays), so Spark parses once and projects only the
fields it needs.  Python truthiness of the source loaders (``""`` and 0 count
as missing) is reproduced with ``nullif`` / ``when`` where it matters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import blank_as_null, c, gid_to_long, micros, try_double, try_long, utm_param, \
    zero_as_null

# Fixed values that must equal the reference's for equal results:
#   wallet status codes: S Success, P Pending, V Reversed, D Denied, F Failed
#   invoice status: balance 0 and total > 0 -> Paid; balance < total -> Partial; balance = total -> Open;
#                   otherwise Unknown
WALLET_STATUS = {"S": "Success", "P": "Pending", "V": "Reversed", "D": "Denied", "F": "Failed"}


def invoice_status(balance, total) -> Column:
    """I-40: invoice status from balance and total."""
    b, t = c(balance), c(total)
    return (F.when((b == 0) & (t > 0), "Paid").when(b < t, "Partial").when(b == t, "Open")
            .otherwise("Unknown"))

# Fixed values that must equal the reference's for equal results:
#   social action aliases, first present alias wins (per output column):
ACTION_ALIASES = {
    "purchases": ["omni_purchase", "purchase", "offsite_conversion.fb_pixel_purchase"],
    "purchase_value": ["omni_purchase", "purchase", "offsite_conversion.fb_pixel_purchase"],
    "add_to_cart": ["omni_add_to_cart", "add_to_cart", "offsite_conversion.fb_pixel_add_to_cart"],
    "add_to_cart_value": ["omni_add_to_cart", "add_to_cart", "offsite_conversion.fb_pixel_add_to_cart"],
    "initiate_checkout": ["omni_initiated_checkout", "initiated_checkout",
                          "offsite_conversion.fb_pixel_initiate_checkout"],
    "initiate_checkout_value": ["omni_initiated_checkout", "initiated_checkout",
                                "offsite_conversion.fb_pixel_initiate_checkout"],
    "landing_page_views": ["landing_page_view"],
    "link_clicks": ["link_click"],
}
UTM_NAMES = ["source", "medium", "campaign", "content", "term"]


def coerce_numeric(df: DataFrame, float_cols, int_cols) -> DataFrame:
    """I-10: tolerant numbers: floats by try_cast, ints through double ('3.0' -> 3); bad text -> NULL."""
    exprs = []
    for col in df.columns:
        if col in float_cols:
            exprs.append(try_double(F.col(col).cast("string")).alias(col))
        elif col in int_cols:
            exprs.append(try_long(F.col(col).cast("string")).alias(col))
        else:
            exprs.append(F.col(col))
    return df.select(*exprs)


def _money(x) -> Column:
    return F.coalesce(try_double(x), F.lit(0.0))


def flatten_orders(raw: DataFrame) -> DataFrame:
    """I-12 (+ I-18): order header rows; order day = first 10 chars of created_at; shipping defaults to 0."""
    land = F.col("landing_site")
    return raw.select(
        F.col("id").alias("order_id"), "order_number", "created_at", "updated_at", "financial_status",
        "fulfillment_status", _money(F.col("total_price")).alias("total_price"),
        _money(F.col("subtotal_price")).alias("subtotal_price"), _money(F.col("total_tax")).alias("total_tax"),
        _money(F.col("total_shipping_price_set.shop_money.amount")).alias("total_shipping"),
        _money(F.col("total_discounts")).alias("total_discounts"), "currency",
        F.col("customer.id").alias("customer_id"), F.col("customer.email").alias("customer_email"),
        "landing_site", "referring_site", "source_name",
        *[utm_param(land, n).alias(f"utm_{n}") for n in UTM_NAMES],
        "cancelled_at", "cancel_reason", "tags", "note",
        F.substring("created_at", 1, 10).alias("order_date"))


def flatten_order_lines(raw: DataFrame) -> DataFrame:
    """I-13: one row per line item with its order key and day (orders without lines yield no rows)."""
    li = raw.select(F.col("id").alias("order_id"), F.substring("created_at", 1, 10).alias("order_date"),
                    F.explode("line_items").alias("li"))
    return li.select(F.col("li.id").alias("line_item_id"), "order_id", F.col("li.product_id").alias("product_id"),
                     F.col("li.variant_id").alias("variant_id"), F.col("li.title").alias("title"),
                     F.col("li.variant_title").alias("variant_title"), F.col("li.sku").alias("sku"),
                     F.col("li.quantity").alias("quantity"), _money(F.col("li.price")).alias("price"),
                     _money(F.col("li.total_discount")).alias("total_discount"), "order_date")


def flatten_products(raw: DataFrame) -> DataFrame:
    """I-14 (+ I-17): products from graph-API nodes; ids from GIDs; tags joined with ', '."""
    return raw.select(gid_to_long(F.col("id")).alias("product_id"), "title", "handle",
                      F.col("productType").alias("product_type"), "vendor", "status",
                      F.array_join("tags", ", ").alias("tags"), F.col("createdAt").alias("created_at"),
                      F.col("updatedAt").alias("updated_at"))


def flatten_variants(raw: DataFrame) -> DataFrame:
    """I-15: one row per variant with a tolerant price."""
    v = raw.select(gid_to_long(F.col("id")).alias("product_id"), F.explode("variants").alias("v"))
    return v.select(gid_to_long(F.col("v.id")).alias("variant_id"), "product_id",
                    try_double(F.col("v.price")).alias("price"),
                    try_double(F.col("v.compareAtPrice")).alias("compare_at_price"),
                    F.col("v.inventoryQuantity").alias("inventory_quantity"), F.col("v.title").alias("title"),
                    F.col("v.sku").alias("sku"))


def flatten_customers(raw: DataFrame) -> DataFrame:
    """I-16: customers with their default address fields."""
    a = "defaultAddress"
    return raw.select(gid_to_long(F.col("id")).alias("customer_id"), "email", F.col("firstName").alias("first_name"),
                      F.col("lastName").alias("last_name"), F.col("numberOfOrders").cast("bigint").alias("orders_count"),
                      try_double(F.col("amountSpent.amount")).alias("total_spent"),
                      F.col(f"{a}.city").alias("city"), F.col(f"{a}.province").alias("province"),
                      F.col(f"{a}.country").alias("country"), F.col("createdAt").alias("created_at"))


def _is_action(name: str):
    return lambda a: a["action_type"] == F.lit(name)


def pivot_actions(df: DataFrame, actions: str = "actions", values: str = "action_values",
                  aliases: dict | None = None) -> DataFrame:
    """I-19: action arrays -> one column per action; first present alias wins, last duplicate wins.

    Counts become bigint (through double), values double.  No map is built, so
    duplicated action types do not raise.
    """
    aliases = aliases or ACTION_ALIASES
    out = []
    for col, names in aliases.items():
        arr = F.col(values if col.endswith("_value") else actions)
        picks = [F.try_element_at(F.filter(arr, _is_action(n)), F.lit(-1))["value"] for n in names]
        v = F.coalesce(*picks)
        out.append((try_double(v) if col.endswith("_value") else try_long(v)).alias(col))
    return df.select("*", *out).drop(actions, values)


def creative_text(df: DataFrame) -> DataFrame:
    """I-20: creative title/body/CTA from top level, then video, link (only while body is empty), photo data.

    Blank strings count as missing, as Python truthiness does in the source loader.
    """
    b = blank_as_null
    oss = "object_story_spec"
    body0 = b(F.col("body"))
    body1 = F.coalesce(body0, b(F.col(f"{oss}.video_data.message")))
    use_link = body1.isNull()
    body2 = F.when(use_link, b(F.col(f"{oss}.link_data.message"))).otherwise(body1)
    body3 = F.when(body2.isNull(), b(F.col(f"{oss}.photo_data.message"))).otherwise(body2)
    title1 = F.coalesce(b(F.col("title")), b(F.col(f"{oss}.video_data.title")))
    title = F.when(use_link, F.coalesce(title1, b(F.col(f"{oss}.link_data.name")))).otherwise(title1)
    cta1 = b(F.col(f"{oss}.video_data.call_to_action.type"))
    cta2 = F.when(use_link, F.coalesce(cta1, b(F.col(f"{oss}.link_data.call_to_action.type")))).otherwise(cta1)
    img1 = F.coalesce(b(F.col("image_url")), b(F.col(f"{oss}.video_data.image_url")))
    img2 = F.when(use_link, F.coalesce(img1, b(F.col(f"{oss}.link_data.image_url")),
                                       b(F.col(f"{oss}.link_data.picture")))).otherwise(img1)
    img3 = F.when(body2.isNull(), F.coalesce(img2, b(F.col(f"{oss}.photo_data.image_url")))).otherwise(img2)
    return df.select(F.col("id").alias("creative_id"), title.alias("title"), body3.alias("body"),
                     F.coalesce(cta2, b(F.col("call_to_action_type"))).alias("cta_type"),
                     F.col(f"{oss}.video_data.video_id").alias("video_id"), img3.alias("image_url"),
                     F.col(f"{oss}.page_id").alias("page_id"))


def to_utc(col) -> Column:
    """I-21: ISO timestamp with offset ('2025-06-23T09:19:47-0600') -> UTC timestamp; bad -> NULL.

    Fractions of a second and plain dates (midnight) are read too.
    """
    x = c(col)
    colon = F.regexp_replace(x, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ])"), F.try_to_timestamp(colon))


def attach_ad(creatives: DataFrame, ads: DataFrame) -> DataFrame:
    """I-22: the ad of each creative; when several ads use it, the last one listed wins."""
    last = ads.groupBy(F.col("creative_id")).agg(F.max_by(F.struct("ad_id", "ad_name"), F.col("list_pos")).alias("a"))
    return creatives.join(last, "creative_id", "left").select(creatives["*"], F.col("a.ad_id").alias("ad_id"),
                                                              F.col("a.ad_name").alias("ad_name"))


def search_rows(df: DataFrame, prop: str) -> DataFrame:
    """I-28: positional key arrays -> columns; site label from the property; ctr 6 / position 2 places."""
    from marginalia.functions import domain_label
    from marginalia.functions.columns import round_half_away
    return df.select(F.col("keys")[0].cast("date").alias("query_date"), domain_label(F.lit(prop)).alias("site"),
                     F.col("keys")[1].alias("query"), F.col("keys")[2].alias("page"),
                     F.col("keys")[3].alias("country"), F.col("keys")[4].alias("device"),
                     F.col("clicks").cast("bigint").alias("clicks"),
                     F.col("impressions").cast("bigint").alias("impressions"),
                     round_half_away(F.col("ctr"), 6).alias("ctr"), round_half_away(F.col("position"), 2).alias("position"))


def zip_series(df: DataFrame, dates: str = "dates", counts: str = "counts") -> DataFrame:
    """I-29: parallel arrays -> rows; a short counts array pads with NULL."""
    z = df.select("*", F.explode(F.arrays_zip(F.col(dates).alias("d"), F.col(counts).alias("v"))).alias("z"))
    return z.select(*[c_ for c_ in df.columns if c_ not in (dates, counts)],
                    F.col("z.d").alias("date"), F.col("z.v").alias("value"))


def records_from_table(df: DataFrame, headers: str = "headers", rows: str = "rows") -> DataFrame:
    """I-30: (header list, rows of values) -> one map per row (a header without value -> NULL)."""
    r = df.select(F.col(headers).alias("h"), F.explode(rows).alias("r"))
    return r.select(F.map_from_arrays("h", F.transform("h", lambda _, i: F.try_element_at(F.col("r"), i + 1)))
                    .alias("record"))


def product_statuses(df: DataFrame) -> DataFrame:
    """I-35: per product: any disapproved issue -> 'disapproved'; reasons = descriptions of the
    disapproved issues joined with ', '; one row per issue and at least one row per product
    (missing fields become '')."""
    issues = F.coalesce(F.col("itemLevelIssues"), F.array())
    dis = F.filter(issues, lambda i: i["servability"] == "disapproved")
    s = df.select(F.coalesce(F.col("productId"), F.lit("")).alias("product_id"),
                  F.coalesce(F.col("title"), F.lit("")).alias("title"),
                  F.when(F.size(dis) > 0, "disapproved").otherwise("approved").alias("approval_status"),
                  F.array_join(F.transform(dis, lambda i: F.coalesce(i["description"], F.lit(""))), ", ")
                  .alias("disapproval_reasons"),
                  F.explode_outer(issues).alias("i"))
    fields = ["code", "servability", "resolution", "attribute", "destination", "description"]
    present = set(df.schema["itemLevelIssues"].dataType.elementType.fieldNames())
    return s.select("product_id", "title", "approval_status", "disapproval_reasons",
                    *[(F.coalesce(F.col(f"i.{f}"), F.lit("")) if f in present else F.lit("")).alias(f"issue_{f}")
                      for f in fields])


def feed_products(df: DataFrame) -> DataFrame:
    """I-34: product feed rows; missing text fields become '', product types joined with ', '."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    cols = [("product_id", "id"), ("title", "title"), ("description", "description"), ("link", "link"),
            ("image_link", "imageLink"), ("availability", "availability"), ("price_value", "price.value"),
            ("price_currency", "price.currency"), ("brand", "brand"), ("condition", "condition")]
    labels = [(f"custom_label_{i}", f"customLabel{i}") for i in range(5)]
    return df.select(*[e(src).alias(out) for out, src in cols + labels],
                     F.array_join(F.coalesce(F.col("productTypes"), F.array()), ", ").alias("product_types"),
                     e("googleProductCategory").alias("google_product_category"))


def program_status(df: DataFrame) -> DataFrame:
    """I-36: one row per region status of the shopping-ads programme, or one empty row when none."""
    r = df.select(F.coalesce(F.col("state"), F.lit("")).alias("state"), F.explode_outer("regionStatuses").alias("r"))
    return r.select("state", F.coalesce(F.col("r.regionCode"), F.lit("")).alias("region_code"),
                    F.coalesce(F.col("r.eligibilityStatus"), F.lit("")).alias("eligibility_status"),
                    F.array_join(F.coalesce(F.col("r.reviewIssues"), F.array()), ", ").alias("review_issues"))


def flatten_traffic(df: DataFrame, report_date: str) -> DataFrame:
    """I-27: sales-and-traffic by child asin: nested sales money flattened (counts default 0), every
    traffic field kept with a snake_case name."""
    from marginalia.sources.readers import snake_name
    sales = "salesByAsin"
    traffic_fields = df.schema["trafficByAsin"].dataType.fieldNames() if "trafficByAsin" in df.columns else []
    return df.select(
        F.col("childAsin").alias("child_asin"), F.col("parentAsin").alias("parent_asin"),
        F.lit(report_date).cast("date").alias("report_date"),
        F.coalesce(F.col(f"{sales}.unitsOrdered"), F.lit(0)).alias("units_ordered"),
        F.coalesce(F.col(f"{sales}.unitsOrderedB2B"), F.lit(0)).alias("units_ordered_b2b"),
        F.coalesce(F.col(f"{sales}.totalOrderItems"), F.lit(0)).alias("total_order_items"),
        F.coalesce(F.col(f"{sales}.orderedProductSales.amount"), F.lit(0)).alias("ordered_product_sales_amount"),
        F.col(f"{sales}.orderedProductSales.currencyCode").alias("ordered_product_sales_currency"),
        *[F.col(f"trafficByAsin.{f}").alias(snake_name(f)) for f in traffic_fields])


def unpivot_interest(df: DataFrame, keywords: list[str]) -> DataFrame:
    """I-37: wide interest table (one column per keyword) -> (week, keyword, interest_score, is_partial)."""
    long = df.unpivot(["date", "isPartial"], keywords, "keyword", "interest_score")
    return long.select(F.col("date").cast("date").alias("week"), "keyword",
                       F.col("interest_score").cast("bigint").alias("interest_score"),
                       F.coalesce(F.col("isPartial").cast("boolean"), F.lit(False)).alias("is_partial"))


def stack_related(top: DataFrame, rising: DataFrame) -> DataFrame:
    """I-38: related queries, top and rising stacked with a type label."""
    return (top.withColumn("query_type", F.lit("top"))
            .unionByName(rising.withColumn("query_type", F.lit("rising")), allowMissingColumns=True))


def flatten_payments(df: DataFrame) -> DataFrame:
    """I-39: wallet transaction rows: status code decoded, payer full name, first cart item, item count."""
    info, payer, cart = "transaction_info", "payer_info", "cart_info"
    code = F.col(f"{info}.transaction_status")
    decoded = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in WALLET_STATUS.items() for x in kv]), code),
                         code)
    items = F.coalesce(F.col(f"{cart}.item_details"), F.array())
    first = F.try_element_at(items, F.lit(1))
    name = F.nullif(F.trim(F.concat_ws(" ", F.col(f"{payer}.payer_name.given_name"),
                                       F.col(f"{payer}.payer_name.surname"))), F.lit(""))
    return df.select(F.col(f"{info}.transaction_id").alias("transaction_id"),
                     F.col(f"{info}.transaction_initiation_date").alias("transaction_initiation_date"),
                     F.coalesce(try_double(F.col(f"{info}.transaction_amount.value")), F.lit(0.0)).alias("transaction_amount"),
                     F.coalesce(try_double(F.col(f"{info}.fee_amount.value")), F.lit(0.0)).alias("fee_amount"),
                     decoded.alias("transaction_status"), F.col(f"{info}.transaction_subject").alias("transaction_subject"),
                     F.col(f"{payer}.email_address").alias("payer_email"), name.alias("payer_name"),
                     first["item_name"].alias("item_name"), F.size(items).alias("item_count"))


def deposit_summary(df: DataFrame) -> DataFrame:
    """I-44: deposit source summary: positive lines; entity name, else memo, else account, else 'unknown'."""
    every = F.coalesce(F.col("Line"), F.array())
    lines = F.filter(every, lambda l: l["Amount"] > 0)
    b = blank_as_null
    label = F.transform(lines, lambda l: F.coalesce(
        b(l["DepositLineDetail"]["Entity"]["name"]), b(l["Description"]),
        b(l["DepositLineDetail"]["AccountRef"]["name"]), F.lit("unknown")))
    return df.select(F.col("Id").alias("deposit_id"), F.col("TxnDate").cast("date").alias("txn_date"),
                     F.col("TotalAmt").alias("total_amount"),
                     F.col("DepositToAccountRef.name").alias("deposit_to_account_name"),
                     F.array_join(label, ", ").alias("source_summary"), F.col("PrivateNote").alias("memo"),
                     F.size(every).alias("line_count"))


def purchase_summary(df: DataFrame, n: int | None = None) -> DataFrame:
    """I-45: non-empty line descriptions (else the line's account), '; ' joined; the first ``n`` of them if given."""
    b = blank_as_null
    texts = F.transform(F.coalesce(F.col("Line"), F.array()), lambda l: F.coalesce(
        b(l["Description"]), b(l["AccountBasedExpenseLineDetail"]["AccountRef"]["name"])))
    kept = F.filter(texts, lambda t: t.isNotNull())
    return df.select(F.col("Id").alias("purchase_id"), F.col("TxnDate").cast("date").alias("txn_date"),
                     F.col("TotalAmt").alias("total_amount"), F.col("EntityRef.name").alias("vendor_name"),
                     F.size(F.coalesce(F.col("Line"), F.array())).alias("line_count"),
                     F.array_join(kept if n is None else F.slice(kept, 1, n), "; ").alias("line_summary"))


def sales_receipt_subtotal(df: DataFrame) -> DataFrame:
    """I-43: receipt subtotal = sum of its item lines' amounts."""
    items = F.filter(F.coalesce(F.col("Line"), F.array()), lambda l: l["DetailType"] == "SalesItemLineDetail")
    return df.select(F.col("Id").alias("receipt_id"), F.col("TotalAmt").alias("total_amount"),
                     F.aggregate(items, F.lit(0.0), lambda acc, l: acc + F.coalesce(l["Amount"], F.lit(0.0)))
                     .alias("subtotal"))


def flatten_invoice_lines(df: DataFrame) -> DataFrame:
    """I-41: invoice lines without subtotal lines; id = '<invoice>_<line>'."""
    li = df.select(F.col("Id").alias("invoice_id"), F.explode("Line").alias("l")).where(
        F.col("l.DetailType") != "SubTotalLineDetail")
    d = "l.SalesItemLineDetail"
    return li.select(F.concat_ws("_", "invoice_id", F.col("l.Id")).alias("line_item_id"), "invoice_id",
                     F.col(f"{d}.ItemRef.name").alias("item_name"), F.col(f"{d}.Qty").alias("quantity"),
                     F.col(f"{d}.UnitPrice").alias("unit_price"), F.col("l.Amount").alias("amount"),
                     F.col("l.Description").alias("description"))


def top_n_per_period(df: DataFrame, period: str, order_col: str, n: int) -> DataFrame:
    """I-49: the source API returns at most ``n`` ranked rows per window; the same cap as a filter, never by default.

    (This is the feature itself, a ranking cap, not a sampling shortcut.)  Ties go to the row whose other columns, taken
    as one JSON text, come first.  Every task keeps the best ``n`` rows of each period it meets, and after the
    shuffle, which moves no more than those, the same is done once more: no window, and a period's rows are never sorted together.
    """
    key = [F.col(period).cast("string").alias("_period"), F.to_json(F.struct(*[F.col(c) for c in df.columns if c != order_col])).alias("_tie")]
    keyed = df.select("*", *key)

    def best(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            order = pc.sort_indices(t, sort_keys=[("_period", "ascending"), (order_col, "descending"), ("_tie", "ascending")], null_placement="at_end")
            period_of = t.column("_period").take(order).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            new = np.concatenate(([True], period_of[1:] != period_of[:-1])) if len(period_of) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            rank = np.arange(len(period_of)) - np.repeat(first, np.diff(np.append(first, len(period_of))))
            held = t.take(order.filter(pa.array(rank < n))).combine_chunks()
        yield from held.to_batches() if held is not None else ()

    return keyed.mapInArrow(best, keyed.schema).repartition("_period").mapInArrow(best, keyed.schema).select(*df.columns)


def audience_export(customers: DataFrame) -> DataFrame:
    """I-52: hashed audience rows: non-blank email; sha256(lower(trim)); names hashed only when both present."""
    e = F.lower(F.trim(F.col("email")))
    fn, ln = F.lower(F.trim(F.col("first_name"))), F.lower(F.trim(F.col("last_name")))
    both = (F.coalesce(fn, F.lit("")) != "") & (F.coalesce(ln, F.lit("")) != "")
    return customers.where(F.coalesce(e, F.lit("")) != "").select(
        F.sha2(e, 256).alias("hashed_email"), F.when(both, F.sha2(fn, 256)).alias("hashed_first_name"),
        F.when(both, F.sha2(ln, 256)).alias("hashed_last_name"))


def tag_links(df: DataFrame, text: str, domains: list[str], params: str) -> DataFrame:
    """I-51: append tracking parameters to links of tracked domains inside a text.

    Links that already carry utm_source are kept; the number of links changed
    is returned.  Done with regexp functions: the domain test strips a leading
    'www.' and accepts sub-domains.
    """
    part = r"[^\s)\]>\"']"
    dom = "|".join(d.replace(".", r"\.") for d in domains)
    host = rf"(?:www\.)?(?:[^/?#:\s)\]>\"']+\.)?(?:{dom})(?=[/?#:\s)\]>\"']|$)"
    link = rf"https?://(?!{part}*utm_source=)%s{host}{part}*"
    put = params.replace("\\", "\\\\").replace("$", "\\$")
    # each link is matched whole and once: with a query first, then without
    new = F.regexp_replace(F.col(text), "(" + link % rf"(?={part}*\?)" + ")", "$1&" + put)
    new = F.regexp_replace(new, "(" + link % rf"(?!{part}*\?)" + ")", "$1?" + put)
    todo = F.regexp_extract_all(F.col(text), F.lit(link % ""), 0)
    return df.select("*", new.alias(f"{text}_tagged"), F.size(F.array_distinct(todo)).alias("links_tagged"))


def flatten_purchase_lines(df: DataFrame) -> DataFrame:
    """I-46: one row per purchase line; id = '<purchase>_<line id or 0>'."""
    li = df.select(F.col("Id").alias("purchase_id"), F.col("TxnDate").alias("txn_date"),
                   F.col("EntityRef.value").alias("vendor_id"), F.col("EntityRef.name").alias("vendor_name"),
                   F.explode("Line").alias("l"))
    d = "l.AccountBasedExpenseLineDetail"
    return li.select(F.concat_ws("_", "purchase_id", F.coalesce(F.col("l.Id"), F.lit("0"))).alias("line_item_id"),
                     "purchase_id", "txn_date", "vendor_id", "vendor_name", F.col("l.LineNum").alias("line_num"),
                     F.col("l.Description").alias("description"),
                     F.coalesce(F.col("l.Amount").cast("double"), F.lit(0.0)).alias("amount"),
                     F.col(f"{d}.AccountRef.value").alias("account_id"), F.col(f"{d}.AccountRef.name").alias("account_name"),
                     F.col(f"{d}.CustomerRef.value").alias("customer_id"),
                     F.col(f"{d}.CustomerRef.name").alias("customer_name"),
                     F.col(f"{d}.BillableStatus").alias("billable_status"))


def flatten_bill_payments(df: DataFrame) -> DataFrame:
    """I-47: bill payments; the paying account is the cheque's bank account, else the card account."""
    acct = F.coalesce(F.col("CheckPayment.BankAccountRef"), F.col("CreditCardPayment.CCAccountRef"))
    return df.select(F.col("Id").alias("bill_payment_id"), F.col("TxnDate").alias("txn_date"),
                     F.col("VendorRef.value").alias("vendor_id"), F.col("VendorRef.name").alias("vendor_name"),
                     F.coalesce(F.col("TotalAmt").cast("double"), F.lit(0.0)).alias("total_amount"),
                     F.col("PayType").alias("pay_type"), acct["value"].alias("account_id"),
                     acct["name"].alias("account_name"))


# reference entities: output column -> (source path, default when missing)
VENDOR_FIELDS = {
    "vendor_id": ("Id", None), "display_name": ("DisplayName", None), "company_name": ("CompanyName", None),
    "given_name": ("GivenName", None), "family_name": ("FamilyName", None),
    "email": ("PrimaryEmailAddr.Address", None), "phone": ("PrimaryPhone.FreeFormNumber", None),
    "balance": ("Balance", 0.0), "active": ("Active", True), "vendor_1099": ("Vendor1099", False),
    "created_at": ("MetaData.CreateTime", None), "updated_at": ("MetaData.LastUpdatedTime", None),
}


def flatten_entity(df: DataFrame, fields: dict) -> DataFrame:
    """I-48: declarative flatten of a reference entity (vendors, customers, accounts, items)."""
    out = []
    for name, (path, default) in fields.items():
        col = F.col(path)
        if default is not None:
            col = F.coalesce(col.cast(_dtype(default)), F.lit(default))
        out.append(col.alias(name))
    return df.select(*out)


def _dtype(v):
    return "boolean" if isinstance(v, bool) else "double" if isinstance(v, float) else "bigint" \
        if isinstance(v, int) else "string"


def attach_campaign(metrics: DataFrame, campaigns: DataFrame) -> DataFrame:
    """I-31: campaign report rows with the campaign's name and send day (first 10 chars of send time).

    ``metrics``: (groupings struct<campaign_id>, statistics struct<...>); ``campaigns``: (id, attributes
    struct<name, send_time>).  The lookup side has one row per campaign.
    """
    c = campaigns.select(F.col("id").alias("campaign_id"), F.col("attributes.name").alias("campaign_name"),
                         F.col("attributes.send_time").alias("send_time"))
    m = metrics.select(F.col("groupings.campaign_id").alias("campaign_id"), F.col("statistics").alias("s"))
    j = m.join(c, "campaign_id", "left")
    return j.select("campaign_id", "campaign_name",
                    F.when(blank_as_null(F.col("send_time")).isNotNull(), F.substring("send_time", 1, 10))
                    .alias("send_date"),
                    *[F.col(f"s.{k}").alias(k) for k in ("recipients", "delivered", "opens", "clicks",
                                                         "unsubscribes", "conversions")],
                    F.col("s.conversion_value").alias("revenue"))


def flatten_flow_messages(flows: DataFrame) -> DataFrame:
    """I-32: flows -> actions -> messages, one row per message with its flow and action ids."""
    a = flows.select(F.col("id").alias("flow_id"), F.explode("actions").alias("a"))
    m = a.select("flow_id", F.col("a.id").alias("action_id"), F.explode("a.messages").alias("m"))
    return m.select(F.col("m.id").alias("id"), "flow_id", "action_id",
                    *[F.col(f"m.attributes.{k}").alias(k) for k in ("name", "status", "channel", "created_at",
                                                                     "updated_at")])


def flatten_profiles(df: DataFrame) -> DataFrame:
    """I-33: email profiles: consent flags and location flattened; free-form properties kept as JSON text
    (an empty object -> NULL)."""
    a = "attributes"
    em = f"{a}.subscriptions.email.marketing"
    sm = f"{a}.subscriptions.sms.marketing"
    props = F.to_json(F.col(f"{a}.properties"))
    return df.select(
        "id", *[F.col(f"{a}.{k}").alias(k) for k in ("email", "phone_number", "first_name", "last_name", "created",
                                                     "updated")],
        F.col(f"{em}.consent").alias("email_consent"),
        F.col(f"{em}.can_receive_email_marketing").alias("email_subscribed"),
        F.col(f"{em}.consent_timestamp").alias("email_consent_timestamp"),
        F.col(f"{sm}.consent").alias("sms_consent"), F.col(f"{sm}.can_receive_sms_marketing").alias("sms_subscribed"),
        *[F.col(f"{a}.location.{k}").alias(k) for k in ("city", "region", "country")],
        F.when(props.isNotNull() & (props != "{}"), props).alias("properties"))


def flatten_received_payments(df: DataFrame) -> DataFrame:
    """I-42: customer payments with their references; amounts default to 0, currency to USD."""
    return df.select(
        F.col("Id").alias("payment_id"), F.col("TxnDate").alias("txn_date"),
        F.col("CustomerRef.value").alias("customer_id"), F.col("CustomerRef.name").alias("customer_name"),
        F.coalesce(F.col("TotalAmt").cast("double"), F.lit(0.0)).alias("total_amount"),
        F.coalesce(F.col("UnappliedAmt").cast("double"), F.lit(0.0)).alias("unapplied_amount"),
        F.col("PaymentMethodRef.value").alias("payment_method_id"),
        F.col("PaymentMethodRef.name").alias("payment_method_name"),
        F.col("DepositToAccountRef.value").alias("deposit_to_account_id"),
        F.col("DepositToAccountRef.name").alias("deposit_to_account_name"),
        F.col("PaymentRefNum").alias("payment_ref_num"),
        F.coalesce(F.col("CurrencyRef.value"), F.lit("USD")).alias("currency"),
        F.col("MetaData.CreateTime").alias("created_at"), F.col("MetaData.LastUpdatedTime").alias("updated_at"))


def flatten_social(resource: str, df: DataFrame) -> DataFrame:
    """I-57: social-ads entities (campaigns, adsets, ads) with tolerant budgets and UTC times.

    The adset geo targeting is kept as whole JSON text (the source loader keeps
    a Python repr of the same object, cut to 1,000 characters).  Daily insights are a feed of
    :mod:`marginalia.sources.landing`.
    """
    t = lambda c: to_utc(F.col(c))
    if resource == "campaigns":
        return df.select(F.col("id").alias("campaign_id"), F.col("name").alias("campaign_name"), "objective", "status",
                         try_double(F.col("daily_budget")).alias("daily_budget"),
                         try_double(F.col("lifetime_budget")).alias("lifetime_budget"),
                         t("created_time").alias("created_time"), t("updated_time").alias("updated_time"))
    if resource == "adsets":
        geo = F.col("targeting.geo_locations")
        return df.select(F.col("id").alias("adset_id"), F.col("name").alias("adset_name"), "campaign_id", "status",
                         try_double(F.col("daily_budget")).alias("daily_budget"),
                         try_double(F.col("lifetime_budget")).alias("lifetime_budget"),
                         F.when(F.col("targeting").isNotNull(), F.coalesce(F.to_json(geo), F.lit("")))
                         .alias("targeting_summary"), "optimization_goal", "billing_event",
                         t("created_time").alias("created_time"), t("updated_time").alias("updated_time"))
    if resource == "ads":
        return df.select(F.col("id").alias("ad_id"), F.col("name").alias("ad_name"), "adset_id", "campaign_id", "status",
                         F.col("creative.id").alias("creative_id"), t("created_time").alias("created_time"),
                         t("updated_time").alias("updated_time"))
    raise ValueError(resource)


def flatten_email(resource: str, df: DataFrame) -> DataFrame:
    """I-58: email campaigns and flows from (id, attributes struct)."""
    keys = {"campaigns": ["name", "status", "send_time", "created_at", "updated_at"],
            "flows": ["name", "status", "trigger_type", "created", "updated"]}[resource]
    return df.select("id", *[F.col(f"attributes.{k}").alias(k) for k in keys])


def flatten_channel_stats(df: DataFrame, snapshot_date: str) -> DataFrame:
    """I-59: channel statistics snapshot; counters to bigint (0 when missing), hidden flag false by default."""
    st = "statistics"
    return df.select(F.col("id").alias("channel_id"), F.col("snippet.title").alias("title"),
                     F.lit(snapshot_date).cast("date").alias("snapshot_date"),
                     *[F.coalesce(try_long(F.col(f"{st}.{src}")), F.lit(0)).alias(out)
                       for out, src in (("subscriber_count", "subscriberCount"), ("view_count", "viewCount"),
                                        ("video_count", "videoCount"))],
                     F.coalesce(F.col(f"{st}.hiddenSubscriberCount").cast("boolean"), F.lit(False))
                     .alias("hidden_subscriber_count"))


def flatten_video_stats(df: DataFrame, snapshot_date: str) -> DataFrame:
    """I-59: per-video statistics snapshot keyed by (video_id, snapshot_date)."""
    st = "statistics"
    return df.select(F.col("id").alias("video_id"), F.lit(snapshot_date).cast("date").alias("snapshot_date"),
                     *[F.coalesce(try_long(F.col(f"{st}.{src}")), F.lit(0)).alias(out)
                       for out, src in (("view_count", "viewCount"), ("like_count", "likeCount"),
                                        ("comment_count", "commentCount"), ("favorite_count", "favoriteCount"))])


# I-56: search-ads resources landed in API shape (segments / campaign / ad_group / metrics structs).
# output column -> (source path, transform); transforms: micros (/1e6), micros0 (0 -> NULL, /1e6),
# zero (0 -> NULL); enum values are landed as their names already.
ADS_SPECS = {
    "daily_insights": {
        "date_start": ("segments.date", None), "campaign_id": ("campaign.id", None),
        "campaign_name": ("campaign.name", None), "campaign_type": ("campaign.advertising_channel_type", None),
        "ad_group_id": ("ad_group.id", None), "ad_group_name": ("ad_group.name", None),
        "impressions": ("metrics.impressions", None), "clicks": ("metrics.clicks", None),
        "spend": ("metrics.cost_micros", "micros"), "cpc": ("metrics.average_cpc", "micros"),
        "ctr": ("metrics.ctr", None), "conversions": ("metrics.conversions", None),
        "conversion_value": ("metrics.conversions_value", None),
        "cost_per_conversion": ("metrics.cost_per_conversion", "micros0"),
        "search_impression_share": ("metrics.search_impression_share", "zero")},
    "search_terms": {
        "date_start": ("segments.date", None), "campaign_id": ("campaign.id", None),
        "campaign_name": ("campaign.name", None), "ad_group_id": ("ad_group.id", None),
        "ad_group_name": ("ad_group.name", None), "search_term": ("search_term_view.search_term", None),
        "keyword_text": ("segments.keyword.info.text", None), "match_type": ("segments.search_term_match_type", None),
        "impressions": ("metrics.impressions", None), "clicks": ("metrics.clicks", None),
        "spend": ("metrics.cost_micros", "micros"), "conversions": ("metrics.conversions", None),
        "conversion_value": ("metrics.conversions_value", None)},
    "keywords": {
        "keyword_id": ("ad_group_criterion.criterion_id", None), "ad_group_id": ("ad_group.id", None),
        "campaign_id": ("campaign.id", None), "keyword_text": ("ad_group_criterion.keyword.text", None),
        "match_type": ("ad_group_criterion.keyword.match_type", None), "status": ("ad_group_criterion.status", None),
        "quality_score": ("ad_group_criterion.quality_info.quality_score", "zero"),
        "expected_ctr": ("ad_group_criterion.quality_info.search_predicted_ctr", None),
        "ad_relevance": ("ad_group_criterion.quality_info.creative_quality_score", None),
        "landing_page_experience": ("ad_group_criterion.quality_info.post_click_quality_score", None)},
    "shopping_performance": {
        "date_start": ("segments.date", None), "product_title": ("segments.product_title", None),
        "product_item_id": ("segments.product_item_id", None), "product_type_l1": ("segments.product_type_l1", None),
        "product_brand": ("segments.product_brand", None), "campaign_id": ("campaign.id", None),
        "campaign_name": ("campaign.name", None), "impressions": ("metrics.impressions", None),
        "clicks": ("metrics.clicks", None), "spend": ("metrics.cost_micros", "micros"),
        "conversions": ("metrics.conversions", None), "conversion_value": ("metrics.conversions_value", None)},
    "campaigns": {
        "campaign_id": ("campaign.id", None), "campaign_name": ("campaign.name", None),
        "campaign_type": ("campaign.advertising_channel_type", None),
        "bidding_strategy_type": ("campaign.bidding_strategy_type", None), "status": ("campaign.status", None),
        "campaign_budget": ("campaign.campaign_budget", None)},
}


def _ads_col(path: str, transform: str | None) -> Column:
    x = F.col(path)
    if transform == "micros":
        return micros(x)
    if transform == "micros0":
        return micros(x, zero_null=True)
    if transform == "zero":
        return zero_as_null(x)
    return x


def flatten_ads(resource: str, df: DataFrame) -> DataFrame:
    """I-56: one declarative select per search-ads resource (see ``ADS_SPECS``)."""
    return df.select(*[_ads_col(p, t).alias(out) for out, (p, t) in ADS_SPECS[resource].items()])


def attach_budget(campaigns: DataFrame, budgets: DataFrame) -> DataFrame:
    """I-26: campaign budget amount (micros -> units) by budget resource name; NULL when missing."""
    b = (budgets.select(F.col("resource_name").alias("campaign_budget"),
                        micros(F.col("amount_micros")).alias("budget_amount"))
         .dropDuplicates(["campaign_budget"]))
    return campaigns.join(b, "campaign_budget", "left").drop("campaign_budget")


def alt_text_changes(products: DataFrame, patterns: DataFrame, aliases: DataFrame | None = None, *,
                     brand: str = "House Brand", handle_filter: str | None = None,
                     overwrite: bool = False) -> DataFrame:
    """I-54: proposed alt text for product images (one row per image to change).

    ``products``: (id, title, handle, images array<struct<id, alt, src, variant_ids>>,
    variants array<struct<id, title>>); ``patterns``: curated (handle, position, alt),
    position 0-based; ``aliases``: (alias, handle) mapping handles to a curated one.
    Images with an alt are kept unless ``overwrite``.  The curated text at the
    image's position wins, then the first curated text + ' — additional view n',
    else a generic text from the brand, the title (brand prefix removed) and the
    first non-default variant label of the image.
    """
    p = products
    if handle_filter:
        needle = handle_filter.lower()
        p = p.where(F.lower("handle").contains(needle) | F.lower("title").contains(needle))
    img = p.select("id", "title", "handle", "variants", F.posexplode("images").alias("idx", "img"))
    existing = F.trim(F.coalesce(F.col("img.alt"), F.lit("")))
    if not overwrite:
        img = img.where(existing == "")
    labels = F.transform(F.coalesce(F.col("img.variant_ids"), F.array().cast("array<bigint>")),
                         lambda vid: F.try_element_at(F.filter(F.col("variants"), lambda v: v["id"] == vid),
                                                      F.lit(-1))["title"])
    label = F.coalesce(F.try_element_at(F.filter(labels, lambda l: l.isNotNull() & (l != "")
                                                 & (F.lower(l) != "default title")), F.lit(1)), F.lit(""))
    rows = img.select(F.col("id").alias("product_id"), F.col("handle").alias("product_handle"),
                      F.col("title").alias("product_title"), F.col("img.id").alias("image_id"),
                      (F.col("idx") + 1).alias("image_position"),
                      F.coalesce(F.col("img.src"), F.lit("")).alias("image_src"), existing.alias("current_alt"),
                      "idx", label.alias("variant_label"))
    key = F.col("product_handle")
    if aliases is not None:
        rows = rows.join(aliases.select(F.col("alias").alias("product_handle"), F.col("handle").alias("_canon")),
                         "product_handle", "left")
        key = F.coalesce(F.col("_canon"), F.col("product_handle"))
    rows = rows.withColumn("_key", key)
    pats = patterns.groupBy(F.col("handle").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("position", "alt"))).alias("_pats"))
    j = rows.join(pats, "_key", "left")
    n = F.coalesce(F.size("_pats"), F.lit(0))
    base = F.trim(F.replace(F.col("product_title"), F.lit("|"), F.lit("—")))
    for prefix in (f"{brand} Shop ", f"{brand} "):
        base = F.when(base.startswith(prefix), F.trim(F.substring(base, len(prefix) + 1, 1 << 20))).otherwise(base)
    pos = (F.col("idx") + 1).cast("string")
    generic = F.when(F.col("variant_label") != "",
                     F.concat(F.lit(f"{brand} "), base, F.lit(" — "), F.col("variant_label"), F.lit(" — image "), pos)) \
        .otherwise(F.concat(F.lit(f"{brand} "), base, F.lit(" — image "), pos))
    alt = (F.when(n > F.col("idx"), F.element_at("_pats", F.col("idx") + 1)["alt"])
           .when(n > 0, F.concat(F.element_at("_pats", 1)["alt"], F.lit(" — additional view "), pos))
           .otherwise(generic))
    return j.select("product_id", "product_handle", "product_title", "image_id", "image_position", "image_src",
                    "current_alt", alt.alias("proposed_alt"))


def _ads_spec(spec: str) -> dict:
    """'out=path[:transform] ...' -> ADS_SPECS entry."""
    out = {}
    for tok in spec.split():
        name, rest = tok.split("=", 1)
        path, _, tr = rest.partition(":")
        out[name] = (path, tr or None)
    return out


_CAMPAIGN = "campaign_id=campaign.id campaign_name=campaign.name"
_METRICS = ("impressions=metrics.impressions clicks=metrics.clicks spend=metrics.cost_micros:micros "
            "conversions=metrics.conversions conversion_value=metrics.conversions_value")
ADS_SPECS.update({k: _ads_spec(v) for k, v in {
    # the bid is landed in micros and staged in units (the source column keeps a 'micros' name, R-12)
    "ad_groups": "ad_group_id=ad_group.id ad_group_name=ad_group.name " + _CAMPAIGN +
                 " ad_group_type=ad_group.type status=ad_group.status cpc_bid=ad_group.cpc_bid_micros:micros",
    "bidding_strategy": "bidding_strategy_id=bidding_strategy.id bidding_strategy_name=bidding_strategy.name "
                        "bidding_strategy_type=bidding_strategy.type "
                        "target_cpa_micros=bidding_strategy.target_cpa.target_cpa_micros:zero "
                        "target_roas=bidding_strategy.target_roas.target_roas:zero "
                        "maximize_conversions_target_cpa_micros="
                        "bidding_strategy.maximize_conversions.target_cpa_micros:zero",
    "conversion_action": "conversion_action_id=conversion_action.id conversion_action_name=conversion_action.name "
                         "status=conversion_action.status conversion_type=conversion_action.type "
                         "default_value=conversion_action.value_settings.default_value:zero "
                         "always_use_default_value=conversion_action.value_settings.always_use_default_value "
                         "counting_type=conversion_action.counting_type "
                         "include_in_conversions_metric=conversion_action.include_in_conversions_metric",
    "asset_group": "asset_group_id=asset_group.id asset_group_name=asset_group.name status=asset_group.status "
                   "final_urls=asset_group.final_urls " + _CAMPAIGN,
    "asset_group_asset": "asset_resource_name=asset_group_asset.asset field_type=asset_group_asset.field_type "
                         "status=asset_group_asset.status asset_group_id=asset_group.id "
                         "asset_group_name=asset_group.name " + _CAMPAIGN,
    "campaign_asset_set": "campaign_resource_name=campaign_asset_set.campaign "
                          "asset_set_resource_name=campaign_asset_set.asset_set status=campaign_asset_set.status "
                          "asset_set_id=asset_set.id asset_set_name=asset_set.name asset_set_type=asset_set.type "
                          + _CAMPAIGN,
    "geographic_view": "date_start=segments.date location_type=geographic_view.location_type "
                       "country_criterion_id=geographic_view.country_criterion_id " + _CAMPAIGN + " " + _METRICS,
    "campaign_audience_view": "resource_name=campaign_audience_view.resource_name " + _CAMPAIGN + " " + _METRICS,
    "auction_insights": "date_start=segments.date " + _CAMPAIGN + " domain=segments.auction_insight_domain "
                        "impression_share=metrics.auction_insight_search_impression_share:zero "
                        "overlap_rate=metrics.auction_insight_search_overlap_rate:zero "
                        "position_above_rate=metrics.auction_insight_search_position_above_rate:zero "
                        "top_of_page_rate=metrics.auction_insight_search_top_impression_percentage:zero "
                        "outranking_share=metrics.auction_insight_search_outranking_share:zero",
    "ad_schedule_view": "date_start=segments.date " + _CAMPAIGN + " criterion_id=campaign_criterion.criterion_id "
                        "day_of_week=campaign_criterion.ad_schedule.day_of_week "
                        "start_hour=campaign_criterion.ad_schedule.start_hour "
                        "end_hour=campaign_criterion.ad_schedule.end_hour "
                        "start_minute=campaign_criterion.ad_schedule.start_minute "
                        "end_minute=campaign_criterion.ad_schedule.end_minute impressions=metrics.impressions "
                        "clicks=metrics.clicks cost=metrics.cost_micros:micros conversions=metrics.conversions "
                        "conversions_value=metrics.conversions_value",
    "campaign_negative_keywords": "criterion_id=campaign_criterion.criterion_id "
                                  "keyword_text=campaign_criterion.keyword.text "
                                  "match_type=campaign_criterion.keyword.match_type "
                                  "status=campaign_criterion.status " + _CAMPAIGN,
    "ad_group_negative_keywords": "criterion_id=ad_group_criterion.criterion_id "
                                  "keyword_text=ad_group_criterion.keyword.text "
                                  "match_type=ad_group_criterion.keyword.match_type status=ad_group_criterion.status "
                                  "ad_group_id=ad_group.id ad_group_name=ad_group.name " + _CAMPAIGN,
    "pmax_insights": "date_start=segments.date " + _CAMPAIGN + " " + _METRICS,
}.items()})


def flatten_auction_insights(df: DataFrame) -> DataFrame:
    """I-56 + I-25: auction insight rows; rows without a competitor domain are dropped (merge key)."""
    out = flatten_ads("auction_insights", df)
    return out.where(F.col("domain").isNotNull() & (F.trim(F.col("domain")) != ""))
