"""Feeds shaped from nested records (I-12..I-15, I-18, I-20, I-22..I-38, I-42, I-46, I-47, I-52, I-56..I-58).

Each query nests the rows of a bench table as its feed would deliver them, with gaps where the
feed leaves fields out, and shapes them back; the SQL states the flat result directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.plans.catalog import register
from marginalia.sources import flatten as fl
from marginalia.sources import landing as ld
from marginalia.sources import roles as R
from marginalia.sources.merge import require_keys


def _c(x):
    return F.col(x)


def _struct(**parts):
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def _text(x):
    return _c(x).cast("string")


def _none():
    """A missing text."""
    return F.lit(None).cast("string")


@register("landed_creatives", "creative_id:s title:s body:s link_description:s cta_type:s image_url:s video_id:s object_type:s page_id:s instagram_actor_id:s "
          "thumbnail_url:s ad_id:s ad_name:s", """
select cast(p_partkey as varchar) as creative_id,
       case p_partkey % 4 when 0 then 'own' when 1 then 'video' when 2 then 'link' end as title,
       case p_partkey % 4 when 0 then p_name when 1 then 'video text' when 2 then 'link text' else 'photo text' end as body,
       case p_partkey % 4 when 1 then 'below the video' when 2 then 'below the link' end as link_description,
       case p_partkey % 4 when 1 then 'WATCH' when 2 then 'BUY' else 'LEARN' end as cta_type,
       case p_partkey % 4 when 2 then 'picture' when 3 then 'photo' end as image_url,
       if(p_partkey % 4 = 1, 'v' || p_partkey, null) as video_id, p_type as object_type, 'page' as page_id, if(p_size % 2 = 0, 'actor', null) as instagram_actor_id,
       if(p_size % 3 = 0, 'thumb', null) as thumbnail_url, cast(ad as varchar) as ad_id, 'ad ' || ad as ad_name
from part left join (select l_partkey, arg_max(l_suppkey, l_orderkey * 10 + l_linenumber) as ad from lineitem group by 1) on l_partkey = p_partkey""", "I-20")
def q_creatives(spark, d):
    """Creatives with their text in one of four places, and a blank one in a place that is tried before; the ad that used one last."""
    kind = _c("p_partkey") % 4
    at = lambda k, x: F.when(kind == k, x)
    video = _struct(message=F.lit("video text"), title=F.lit("video"), link_description=F.lit("below the video"), video_id=F.concat(F.lit("v"), _c("p_partkey")),
                    call_to_action=_struct(type=F.lit("WATCH")))
    link = _struct(message=F.when(kind == 2, "link text").otherwise(""), name=F.when(kind == 2, F.lit("link")), description=F.when(kind == 2, F.lit("below the link")),
                   picture=F.when(kind == 2, F.lit("picture")), call_to_action=F.when(kind == 2, _struct(type=F.lit("BUY"))))
    story = _struct(page_id=F.lit("page"), instagram_actor_id=F.when(_c("p_size") % 2 == 0, "actor"), video_data=at(1, video), link_data=F.when(kind != 1, link),
                    photo_data=F.when(kind != 1, _struct(message=F.lit("photo text"), image_url=F.lit("photo"))))
    body = _struct(id=_text("p_partkey"), title=F.when(kind == 0, "own").otherwise(""), body=F.when(kind == 0, _c("p_name")).otherwise(""), call_to_action_type=F.lit("LEARN"),
                   object_type=_c("p_type"), thumbnail_url=F.when(_c("p_size") % 3 == 0, "thumb"), object_story_spec=story)
    creatives = ld.read_feed(R.table(spark, d, "part").select(F.to_json(body).alias("payload")), "creatives")
    ads = R.table(spark, d, "lineitem").select(_text("l_partkey").alias("creative_id"), _text("l_suppkey").alias("ad_id"), F.concat(F.lit("ad "), _c("l_suppkey")).alias("ad_name"),
                                               (_c("l_orderkey") * 10 + _c("l_linenumber")).alias("list_pos"))
    return fl.attach_ad(creatives, ads)


@register("shaped_orders", "order_id:i order_date:d total_price:m subtotal_price:m total_shipping:m total_discounts:m customer_id:i customer_email:s utm_source:s utm_medium:s "
          "utm_campaign:s utm_term:s utm_content:s", """
select o_orderkey as order_id, cast(o_orderdate as date) as order_date, o_totalprice as total_price, 0 as subtotal_price, if(o_orderkey % 5 = 0, 0, 4.5) as total_shipping,
       0 as total_discounts, if(o_custkey % 4 = 0, null, o_custkey) as customer_id, if(o_custkey % 4 = 0, null, 'c' || o_custkey || '@shop.example') as customer_email,
       case when o_orderkey % 3 = 0 then null else 'mail & more' end as utm_source, case when o_orderkey % 3 = 0 then null else 'e mail' end as utm_medium,
       case when o_orderkey % 3 = 0 then null else o_orderpriority end as utm_campaign, null as utm_term, if(o_orderkey % 3 = 1, 'first', null) as utm_content
from orders""", "I-12")
def q_orders(spark, d):
    """Prices as text, one of them unreadable; landing pages with encoded, repeated and blank parameters."""
    key = _c("o_orderkey")
    mail = F.concat(F.lit("/p?utm_source=mail%20%26+more&utm_medium=e+mail&utm_campaign="), _c("o_orderpriority"), F.lit("&utm_term="),
                    F.when(key % 3 == 1, "&utm_content=first&utm_content=second#x").otherwise(""))
    null = _none()
    raw = R.table(spark, d, "orders").select(
        key.alias("id"), key.alias("order_number"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-05:00'").alias("created_at"), null.alias("updated_at"),
        F.lit("paid").alias("financial_status"), null.alias("fulfillment_status"), _text("o_totalprice").alias("total_price"), F.lit("n/a").alias("subtotal_price"),
        null.alias("total_tax"), F.when(key % 5 != 0, _struct(shop_money=_struct(amount=F.lit("4.5")))).alias("total_shipping_price_set"), F.lit("").alias("total_discounts"),
        F.lit("USD").alias("currency"), F.when(_c("o_custkey") % 4 != 0, _struct(id=_c("o_custkey"), email=F.concat(F.lit("c"), _c("o_custkey"), F.lit("@shop.example")))).alias("customer"),
        F.when(key % 3 == 0, "/p?ref=1").otherwise(mail).alias("landing_site"), null.alias("referring_site"), null.alias("source_name"), null.alias("cancelled_at"),
        null.alias("cancel_reason"), null.alias("tags"), null.alias("note"))
    return fl.flatten_orders(raw)


@register("shaped_order_lines", "line_item_id:i order_id:i product_id:i sku:s quantity:i price:m total_discount:m order_date:d", """
select l_orderkey * 10 + l_linenumber as line_item_id, l_orderkey as order_id, l_partkey as product_id, if(l_partkey % 5 = 0, null, 'S' || l_partkey) as sku,
       cast(l_quantity as bigint) as quantity, l_extendedprice as price, 0 as total_discount, cast(o_orderdate as date) as order_date
from lineitem join orders on o_orderkey = l_orderkey""", "I-13")
def q_order_lines(spark, d):
    """Orders with their lines nested; an order without lines gives no row."""
    line = _struct(id=_c("l_orderkey") * 10 + _c("l_linenumber"), product_id=_c("l_partkey"), variant_id=_c("l_partkey"), title=F.lit("t"), variant_title=F.lit("v"),
                   sku=F.when(_c("l_partkey") % 5 != 0, F.concat(F.lit("S"), _c("l_partkey"))), quantity=_c("l_quantity").cast("bigint"), price=_text("l_extendedprice"),
                   total_discount=_none())
    lines = R.table(spark, d, "lineitem").groupBy(_c("l_orderkey").alias("id")).agg(F.collect_list(line).alias("line_items"))  # an order's lines
    orders = R.table(spark, d, "orders").select(_c("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"))
    return fl.flatten_order_lines(orders.join(lines, "id", "left"))


@register("shaped_variants", "variant_id:i product_id:i price:m compare_at_price:m inventory_quantity:i title:s sku:s product_tags:s product_type:s", """
select p_partkey * 10 + k as variant_id, p_partkey as product_id, if(k = 2, null, p_retailprice) as price, if(k = 1, p_retailprice, null) as compare_at_price, p_size as inventory_quantity,
       'v' || k as title, if(k = 1, 'S' || p_partkey, null) as sku, p_brand || ', ' || p_type as product_tags, p_type as product_type
from part, (values (1), (2)) t(k)""", "I-14")
def q_variants(spark, d):
    """I-14, I-15: products by global ids with their variants, one with an unreadable price."""
    gid = lambda kind, x: F.concat(F.lit(f"gid://store/{kind}/"), x.cast("string"))
    variant = lambda k: _struct(id=gid("Variant", _c("p_partkey") * 10 + k), price=_text("p_retailprice") if k == 1 else F.lit("free"), compareAtPrice=_text("p_retailprice") if k == 1 else _none(),  # noqa: E731,E501
                                inventoryQuantity=_c("p_size"), title=F.lit(f"v{k}"), sku=F.concat(F.lit("S"), _c("p_partkey")) if k == 1 else _none())
    raw = R.table(spark, d, "part").select(gid("Product", _c("p_partkey")).alias("id"), _c("p_name").alias("title"), F.lit("h").alias("handle"), _c("p_type").alias("productType"),
                                           F.lit("v").alias("vendor"), F.lit("ACTIVE").alias("status"), F.array("p_brand", "p_type").alias("tags"), F.lit("c").alias("createdAt"),
                                           F.lit("u").alias("updatedAt"), F.array(variant(1), variant(2)).alias("variants"))
    products = fl.flatten_products(raw).select("product_id", _c("tags").alias("product_tags"), "product_type")
    return fl.flatten_variants(raw).join(products, "product_id")


@register("shaped_search_rows", "query_date:d site:s query:s page:s country:s device:s clicks:i impressions:i ctr:r position:m", """
select cast(ts as date) as query_date, 'shop.example' as site, event_type as query, '/p/' || user_id as page, 'usa' as country, if(user_id % 2 = 0, 'MOBILE', 'DESKTOP') as device,
       event_id % 7 as clicks, event_id % 7 + 20 as impressions, (event_id % 7) / (event_id % 7 + 20.0) as ctr, 1.25 as position
from events where event_id % 10 <> 9""", "I-28")
def q_search_rows(spark, d):
    """I-25, I-28: rows by position; those with too few keys, a tenth, have no merge key and go."""
    n = _c("event_id") % 7
    keys = F.array(_c("ts").cast("date").cast("string"), _c("event_type"), F.concat(F.lit("/p/"), _c("user_id")), F.lit("usa"), F.when(_c("user_id") % 2 == 0, "MOBILE").otherwise("DESKTOP"))
    raw = R.table(spark, d, "events").select(F.when(_c("event_id") % 10 == 9, F.slice(keys, 1, 3)).otherwise(keys).alias("keys"), _text("event_id").alias("id"), n.alias("clicks"),
                                             (n + 20).alias("impressions"), (n / (n + 20.0)).alias("ctr"), F.lit(1.25).alias("position"))
    whole, _ = require_keys(raw.withColumn("last_key", F.try_element_at("keys", F.lit(5))), ["last_key"])
    return fl.search_rows(whole, "sc-domain:shop.example")


@register("shaped_metric_series", "metric:s date:s value:i", """
select event_type as metric, strftime(ts, '%Y-%m-%d') as date, case when row_number() over (partition by event_type order by cast(ts as date)) % 3 = 0 then null else count(*) end as value
from events group by event_type, strftime(ts, '%Y-%m-%d'), cast(ts as date)""", "I-29")
def q_series(spark, d):
    """A metric's days and counts as two parallel arrays; every third count is missing."""
    day = R.table(spark, d, "events").groupBy(_c("event_type").alias("metric"), _c("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    one = day.groupBy("metric").agg(F.array_sort(F.collect_list(F.struct("day", "n"))).alias("x"))  # a metric's days
    n = F.transform("x", lambda v, i: F.when((i + 1) % 3 != 0, v["n"]))
    return fl.zip_series(one.select("metric", F.transform("x", lambda v: v["day"].cast("string")).alias("dates"), n.alias("counts")))


@register("shaped_campaign_metrics", "campaign_id:s campaign_name:s send_date:s recipients:i opens:i revenue:m", """
select cast(o_custkey as varchar) as campaign_id, c_name as campaign_name, if(c_nationkey % 2 = 0, '2024-03-01', null) as send_date, count(*) as recipients,
       count(*) filter (o_orderstatus = 'F') as opens, sum(cast(round(o_totalprice * 100) as bigint)) / 100.0 as revenue
from orders left join customer on c_custkey = o_custkey and c_custkey % 10 <> 3 group by o_custkey, c_name, c_nationkey""", "I-31")
def q_campaigns(spark, d):
    """A tenth of the campaigns is not in the lookup; half have no send time."""
    m = R.table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(_c("o_orderstatus") == "F").alias("f"), (F.sum(R.cents("o_totalprice")) / 100.0).alias("r"))
    zero = F.lit(0)
    metrics = m.select(_struct(campaign_id=_text("o_custkey")).alias("groupings"), _struct(recipients=_c("n"), delivered=_c("n"), opens=_c("f"), clicks=zero, unsubscribes=zero,
                                                                                          conversions=zero, conversion_value=_c("r")).alias("statistics"))
    names = R.table(spark, d, "customer").where(_c("c_custkey") % 10 != 3).select(_text("c_custkey").alias("id"), _struct(
        name=_c("c_name"), send_time=F.when(_c("c_nationkey") % 2 == 0, "2024-03-01T10:00:00Z").otherwise("")).alias("attributes"))
    return fl.attach_campaign(metrics, names)


@register("shaped_flow_messages", "id:s flow_id:s action_id:s name:s status:s", """
select l_orderkey || '-' || l_linenumber || '-' || k as id, cast(l_orderkey as varchar) as flow_id, cast(l_linenumber as varchar) as action_id, l_returnflag as name,
       if(k = 1, 'live', null) as status
from lineitem, (values (1), (2)) t(k) where l_linestatus = 'F' or k = 1""", "I-32")
def q_flow_messages(spark, d):
    """Flows of actions of one or two messages."""
    msg = lambda k: _struct(id=F.concat_ws("-", "l_orderkey", "l_linenumber", F.lit(str(k))), attributes=_struct(
        name=_c("l_returnflag"), status=F.lit("live") if k == 1 else _none(), channel=F.lit("email"), created_at=_none(), updated_at=_none()))
    action = _struct(id=_text("l_linenumber"), messages=F.when(_c("l_linestatus") == "F", F.array(msg(1), msg(2))).otherwise(F.array(msg(1))))
    return fl.flatten_flow_messages(R.table(spark, d, "lineitem").groupBy(_text("l_orderkey").alias("id")).agg(F.collect_list(action).alias("actions")))


@register("shaped_profiles", "id:s email:s email_consent:s sms_subscribed:b city:s properties:s", """
select cast(c_custkey as varchar) as id, 'c' || c_custkey || '@shop.example' as email, if(c_custkey % 2 = 0, 'SUBSCRIBED', null) as email_consent,
       if(c_custkey % 3 = 0, true, null) as sms_subscribed, n_name as city, if(c_custkey % 4 = 0, '{"segment":"' || c_mktsegment || '"}', null) as properties
from customer join nation on n_nationkey = c_nationkey""", "I-33")
def q_profiles(spark, d):
    c = R.table(spark, d, "customer").join(R.table(spark, d, "nation"), _c("n_nationkey") == _c("c_nationkey"))
    key = _c("c_custkey")
    mail = F.when(key % 2 == 0, _struct(marketing=_struct(consent=F.lit("SUBSCRIBED"), can_receive_email_marketing=F.lit(True), consent_timestamp=F.lit("t"))))
    sms = F.when(key % 3 == 0, _struct(marketing=_struct(consent=F.lit("SUBSCRIBED"), can_receive_sms_marketing=F.lit(True))))
    attributes = _struct(email=F.concat(F.lit("c"), key, F.lit("@shop.example")), phone_number=_none(), first_name=_none(), last_name=_none(), created=_none(), updated=_none(),
                         subscriptions=_struct(email=mail, sms=sms), location=_struct(city=_c("n_name"), region=_none(), country=_none()),
                         properties=_struct(segment=F.when(key % 4 == 0, _c("c_mktsegment"))))
    return fl.flatten_profiles(c.select(_text("c_custkey").alias("id"), attributes.alias("attributes")))


@register("shaped_product_feed", "product_id:s title:s description:s price_value:s price_currency:s brand:s custom_label_0:s custom_label_4:s product_types:s", """
select cast(p_partkey as varchar) as product_id, p_name as title, '' as description, if(p_size % 3 = 0, '', cast(p_size as varchar)) as price_value, if(p_size % 3 = 0, '', 'USD') as price_currency,
       p_brand as brand, p_type as custom_label_0, '' as custom_label_4, if(p_size % 2 = 0, p_brand || ', ' || p_type, '') as product_types
from part""", "I-34")
def q_product_feed(spark, d):
    null, odd = _none(), _c("p_size") % 2 == 0
    return fl.feed_products(R.table(spark, d, "part").select(
        _text("p_partkey").alias("id"), _c("p_name").alias("title"), null.alias("description"), null.alias("link"), null.alias("imageLink"), null.alias("availability"),
        F.when(_c("p_size") % 3 != 0, _struct(value=_text("p_size"), currency=F.lit("USD"))).alias("price"), _c("p_brand").alias("brand"), null.alias("condition"),
        _c("p_type").alias("customLabel0"), *[null.alias(f"customLabel{i}") for i in range(1, 5)], F.when(odd, F.array("p_brand", "p_type")).alias("productTypes"),
        null.alias("googleProductCategory")))


@register("shaped_product_statuses", "product_id:s title:s approval_status:s disapproval_reasons:s issue_code:s issue_servability:s issue_attribute:s", """
with i as (select p_partkey, k, case k when 1 then 'price' else 'image' end as code, if(k = 1 and p_size % 4 = 1, 'disapproved', 'demoted') as servability
           from part, (values (1), (2)) t(k) where p_size % 3 <> 0)
select cast(p_partkey as varchar) as product_id, coalesce(p_name, '') as title, if(p_size % 3 <> 0 and p_size % 4 = 1, 'disapproved', 'approved') as approval_status,
       if(p_size % 3 <> 0 and p_size % 4 = 1, 'bad ' || p_type, '') as disapproval_reasons, coalesce(code, '') as issue_code, coalesce(servability, '') as issue_servability, '' as issue_attribute
from part left join i using (p_partkey)""", "I-35")
def q_statuses(spark, d):
    """Two issues a product, or none (a third); one of them may disapprove it."""
    issue = lambda code, s: _struct(code=F.lit(code), servability=s, description=F.concat(F.lit("bad "), _c("p_type")))
    issues = F.array(issue("price", F.when(_c("p_size") % 4 == 1, "disapproved").otherwise("demoted")), issue("image", F.lit("demoted")))
    return fl.product_statuses(R.table(spark, d, "part").select(_text("p_partkey").alias("productId"), _c("p_name").alias("title"), F.when(_c("p_size") % 3 != 0, issues).alias("itemLevelIssues")))


@register("shaped_traffic", "child_asin:s report_date:d units_ordered:i ordered_product_sales_amount:m ordered_product_sales_currency:s page_views:i sessions_b2_b:i", """
select cast(l_partkey as varchar) as child_asin, date '2024-05-01' as report_date, if(l_partkey % 6 = 0, 0, sum(cast(l_quantity as bigint))) as units_ordered,
       if(l_partkey % 6 = 0, 0, sum(cast(round(l_extendedprice * 100) as bigint)) / 100.0) as ordered_product_sales_amount,
       if(l_partkey % 6 = 0, null, 'USD') as ordered_product_sales_currency, count(*) as page_views, count(distinct l_suppkey) as sessions_b2_b
from lineitem group by l_partkey""", "I-27")
def q_traffic(spark, d):
    t = R.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum(_c("l_quantity").cast("bigint")).alias("q"), (F.sum(R.cents("l_extendedprice")) / 100.0).alias("m"),
                                                              F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("s"))
    sales = _struct(unitsOrdered=_c("q"), unitsOrderedB2B=F.lit(0), totalOrderItems=_c("n"), orderedProductSales=_struct(amount=_c("m"), currencyCode=F.lit("USD")))
    return fl.flatten_traffic(t.select(_text("l_partkey").alias("childAsin"), _text("l_partkey").alias("parentAsin"), F.when(_c("l_partkey") % 6 != 0, sales).alias("salesByAsin"),
                                       _struct(pageViews=_c("n"), sessionsB2B=_c("s")).alias("trafficByAsin")), "2024-05-01")


@register("shaped_interest", "week:d keyword:s interest_score:i is_partial:b", """
select cast(date_trunc('week', ts) as date) as week, event_type as keyword, count(*) as interest_score, false as is_partial from events where event_type in ('view', 'click', 'purchase')
group by 1, 2
union all select w.week, k.keyword, 0, false from (select distinct cast(date_trunc('week', ts) as date) as week from events) w, (values ('view'), ('click'), ('purchase')) k(keyword)
where not exists (select 1 from events where cast(date_trunc('week', ts) as date) = w.week and event_type = k.keyword)""", "I-37")
def q_interest(spark, d):
    """Weeks with a column per keyword, turned into rows."""
    words = ["view", "click", "purchase"]
    wide = R.table(spark, d, "events").groupBy(F.date_trunc("week", "ts").alias("date")).agg(*[F.count_if(_c("event_type") == w).alias(w) for w in words])
    return fl.unpivot_interest(wide.withColumn("isPartial", F.lit(None).cast("boolean")), words)


@register("shaped_received_payments", "payment_id:s txn_date:d customer_id:s total_amount:m unapplied_amount:m payment_method_name:s currency:s", """
select cast(o_orderkey as varchar) as payment_id, cast(o_orderdate as date) as txn_date, if(o_custkey % 3 = 0, null, cast(o_custkey as varchar)) as customer_id, o_totalprice as total_amount,
       0 as unapplied_amount, if(o_orderkey % 2 = 0, 'Card', null) as payment_method_name, if(o_orderkey % 5 = 0, 'EUR', 'USD') as currency
from orders""", "I-42")
def q_received(spark, d):
    ref = lambda v, n: _struct(value=v, name=n)
    key, null = _c("o_orderkey"), _none()
    return fl.flatten_received_payments(R.table(spark, d, "orders").select(
        key.cast("string").alias("Id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("TxnDate"), F.when(_c("o_custkey") % 3 != 0, ref(_text("o_custkey"), null)).alias("CustomerRef"),
        _c("o_totalprice").alias("TotalAmt"), null.alias("UnappliedAmt"), F.when(key % 2 == 0, ref(F.lit("1"), F.lit("Card"))).alias("PaymentMethodRef"),
        ref(null, null).alias("DepositToAccountRef"), null.alias("PaymentRefNum"), F.when(key % 5 == 0, ref(F.lit("EUR"), null)).alias("CurrencyRef"),
        _struct(CreateTime=null, LastUpdatedTime=null).alias("MetaData")))


@register("shaped_purchase_lines", "line_item_id:s purchase_id:s vendor_id:s line_num:i amount:m account_name:s billable_status:s", """
select l_orderkey || '_' || if(l_linenumber = 1, '0', cast(l_linenumber as varchar)) as line_item_id, cast(l_orderkey as varchar) as purchase_id, 'v' as vendor_id, l_linenumber as line_num,
       if(l_linenumber = 2, 0, l_extendedprice) as amount, if(l_returnflag = 'A', null, l_returnflag) as account_name, if(l_returnflag = 'A', null, 'Billable') as billable_status
from lineitem""", "I-46")
def q_purchase_lines(spark, d):
    """Purchases of nested lines; the first line has no id, the second no amount."""
    ref = lambda v, n: _struct(value=v, name=n)
    detail = F.when(_c("l_returnflag") != "A", _struct(AccountRef=ref(_c("l_returnflag"), _c("l_returnflag")), CustomerRef=ref(_none(), _none()), BillableStatus=F.lit("Billable")))
    line = _struct(Id=F.when(_c("l_linenumber") != 1, _text("l_linenumber")), LineNum=_c("l_linenumber"), Description=_none(),
                   Amount=F.when(_c("l_linenumber") != 2, _c("l_extendedprice")), AccountBasedExpenseLineDetail=detail)
    return fl.flatten_purchase_lines(R.table(spark, d, "lineitem").groupBy(_text("l_orderkey").alias("Id")).agg(F.collect_list(line).alias("Line")).select(
        "Id", F.lit("2024-01-01").alias("TxnDate"), ref(F.lit("v"), F.lit("V")).alias("EntityRef"), "Line"))


@register("landed_bill_payments", "bill_payment_id:s txn_date:d total_amount:m pay_type:s account_id:s account_name:s currency:s", """
select cast(o_orderkey as varchar) as bill_payment_id, cast(o_orderdate as date) as txn_date, o_totalprice as total_amount, if(o_orderkey % 3 = 0, 'Check', 'CreditCard') as pay_type,
       case o_orderkey % 3 when 0 then '1' when 1 then '2' end as account_id, case o_orderkey % 3 when 0 then 'Bank' when 1 then 'Card' end as account_name, 'USD' as currency
from orders""", "I-47")
def q_bill_payments(spark, d):
    """Paid by cheque, by card, or by a card without an account."""
    k = _c("o_orderkey") % 3
    ref = lambda v, n: _struct(value=F.lit(v), name=F.lit(n))
    body = _struct(Id=_text("o_orderkey"), TxnDate=F.date_format("o_orderdate", "yyyy-MM-dd"), TotalAmt=_c("o_totalprice"), PayType=F.when(k == 0, "Check").otherwise("CreditCard"),
                   CheckPayment=F.when(k == 0, _struct(BankAccountRef=ref("1", "Bank"))), CreditCardPayment=F.when(k == 1, _struct(CCAccountRef=ref("2", "Card"))))
    return ld.read_feed(R.table(spark, d, "orders").select(F.to_json(body).alias("payload")), "bill_payments")


@register("shaped_search_ads", "date_start:d campaign_id:i campaign_type:s clicks:i spend:m cpc:r cost_per_conversion:r search_impression_share:r", """
select cast(l_shipdate as date) as date_start, l_suppkey as campaign_id, l_returnflag as campaign_type, cast(l_quantity as bigint) as clicks, l_extendedprice as spend,
       l_partkey / 1000000.0 as cpc, if(l_linenumber = 1, null, l_linenumber / 2.0) as cost_per_conversion, if(l_discount = 0, null, l_discount) as search_impression_share
from lineitem""", "I-56")
def q_search_ads(spark, d):
    """I-23, I-24, I-56: amounts in micros; a cost of 0 a conversion and a share of 0 mean none."""
    whole = F.when(_c("l_linenumber") == 1, F.lit(0)).otherwise(_c("l_linenumber") * 500000)
    metrics = _struct(impressions=F.lit(1), clicks=_c("l_quantity").cast("bigint"), cost_micros=R.cents("l_extendedprice") * 10000, average_cpc=_c("l_partkey"), ctr=F.lit(0.0),
                      conversions=F.lit(0.0), conversions_value=F.lit(0.0), cost_per_conversion=whole, search_impression_share=_c("l_discount"))
    return fl.flatten_ads("daily_insights", R.table(spark, d, "lineitem").select(
        _struct(date=F.date_format("l_shipdate", "yyyy-MM-dd")).alias("segments"), _struct(id=_c("l_suppkey"), name=F.lit("c"), advertising_channel_type=_c("l_returnflag")).alias("campaign"),
        _struct(id=_c("l_partkey"), name=F.lit("g")).alias("ad_group"), metrics.alias("metrics")))


@register("shaped_campaign_budgets", "campaign_id:i campaign_name:s status:s budget_amount:m", """
select p_partkey as campaign_id, p_name as campaign_name, p_brand as status, s_acctbal as budget_amount from part left join supplier on s_suppkey = p_partkey % 50 and s_suppkey % 5 <> 1""", "I-26")
def q_budgets(spark, d):
    """Campaigns share budgets, which are listed twice; a fifth of the budgets is not listed."""
    s = R.table(spark, d, "supplier").where(_c("s_suppkey") % 5 != 1).select(F.concat(F.lit("budgets/"), _c("s_suppkey")).alias("resource_name"), (R.cents("s_acctbal") * 10000).alias("amount_micros"))
    campaign = _struct(id=_c("p_partkey"), name=_c("p_name"), advertising_channel_type=_c("p_type"), bidding_strategy_type=_c("p_type"), status=_c("p_brand"),
                       campaign_budget=F.concat(F.lit("budgets/"), _c("p_partkey") % 50))
    return fl.attach_budget(fl.flatten_ads("campaigns", R.table(spark, d, "part").select(campaign.alias("campaign"))), s.unionAll(s))


@register("shaped_auction_insights", "date_start:d campaign_id:i domain:s impression_share:r overlap_rate:r", """
select cast(l_shipdate as date) as date_start, l_suppkey as campaign_id, l_returnflag || '.example' as domain, if(l_discount = 0, null, l_discount) as impression_share,
       if(l_tax = 0, null, l_tax) as overlap_rate
from lineitem where l_linenumber > 2""", "I-25")
def q_auction(spark, d):
    """Rows without a competitor's domain, null or blank, have no merge key."""
    domain = F.when(_c("l_linenumber") == 1, _none()).when(_c("l_linenumber") == 2, " ").otherwise(F.concat(_c("l_returnflag"), F.lit(".example")))
    share = {f"auction_insight_search_{x}": F.lit(0.0) for x in ("position_above_rate", "top_impression_percentage", "outranking_share")}
    metrics = _struct(auction_insight_search_impression_share=_c("l_discount"), auction_insight_search_overlap_rate=_c("l_tax"), **share)
    return fl.flatten_auction_insights(R.table(spark, d, "lineitem").select(
        _struct(date=F.date_format("l_shipdate", "yyyy-MM-dd"), auction_insight_domain=domain).alias("segments"), _struct(id=_c("l_suppkey"), name=F.lit("c")).alias("campaign"),
        metrics.alias("metrics")))


@register("shaped_social_campaigns", "campaign_id:s campaign_name:s daily_budget:m lifetime_budget:m created_time:t updated_time:t", """
select cast(o_orderkey as varchar) as campaign_id, o_orderpriority as campaign_name, o_totalprice as daily_budget, null as lifetime_budget,
       if(o_orderkey % 7 = 0, null, o_orderdate + interval 6 hour) as created_time, o_orderdate - interval 90 minute as updated_time
from orders""", "I-57")
def q_social(spark, d):
    """I-21, I-57: budgets as text, one unreadable; times with offsets, some no times."""
    at = lambda offset: F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))
    return fl.flatten_social("campaigns", R.table(spark, d, "orders").select(
        _text("o_orderkey").alias("id"), _c("o_orderpriority").alias("name"), F.lit("SALES").alias("objective"), F.lit("ACTIVE").alias("status"), _text("o_totalprice").alias("daily_budget"),
        F.lit("none").alias("lifetime_budget"), F.when(_c("o_orderkey") % 7 == 0, "soon").otherwise(at("-0600")).alias("created_time"), at("+01:30").alias("updated_time")))


@register("shaped_audience", "hashed_email:s hashed_first_name:s hashed_last_name:s", """
select sha256('c' || c_custkey || '@shop.example') as hashed_email, if(c_custkey % 3 = 0, null, sha256('ann')) as hashed_first_name, if(c_custkey % 3 = 0, null, sha256(lower(c_mktsegment))) as hashed_last_name
from customer where c_custkey % 4 <> 0""", "I-52")
def q_audience(spark, d):
    """Addresses in capitals and blanks; a quarter is blank; a third lacks one of both names."""
    key = _c("c_custkey")
    return fl.audience_export(R.table(spark, d, "customer").select(
        F.when(key % 4 == 0, "  ").otherwise(F.concat(F.lit(" C"), key, F.lit("@Shop.example "))).alias("email"), F.lit("Ann ").alias("first_name"),
        F.when(key % 3 != 0, _c("c_mktsegment")).alias("last_name")))
