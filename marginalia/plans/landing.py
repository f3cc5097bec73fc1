"""Feeds read from payloads of two shapes (I-16, I-39..I-48, I-57, I-59).

The payloads are written from the bench tables, every row with every field.  Rows of odd id come in a second
shape: numbers as text, and some objects missing or turned into plain text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.plans.catalog import register
from marginalia.sources import landing as ld
from marginalia.sources import roles as R


def _text(col, odd):
    """A number, as text in odd rows."""
    return F.when(odd, F.to_json(F.struct(col.cast("string").alias("x")))).otherwise(F.to_json(F.struct(col.alias("x"))))


def _payload(odd, **parts):
    """A JSON object from columns without NULL ones; a value in a (column,) tuple is a number that odd rows write as text."""
    def body(text):
        return F.to_json(F.struct(*[(col if not isinstance(col, tuple) else col[0].cast("string") if text else col[0]).alias(name) for name, col in parts.items()]))

    return F.when(odd, body(True)).otherwise(body(False))


def _c(x):
    return F.col(x)


INSIGHT_SPEC = ("date_start:d campaign_id:s campaign_name:s adset_id:s ad_id:s ad_name:s impressions:i clicks:i spend:m reach:i frequency:f "
                "purchases:i purchase_value:m add_to_cart:i initiate_checkout:i landing_page_views:i link_clicks:i n_rejected:i")


@register("social_daily_insights", INSIGHT_SPEC, """
select cast(l_shipdate as date) as date_start, cast(l_suppkey as varchar) as campaign_id, 'c-' || l_suppkey as campaign_name, cast(l_orderkey as varchar) as adset_id,
       cast(l_partkey as varchar) as ad_id, if(l_orderkey % 2 = 1, null, 'ad ' || l_partkey) as ad_name, cast(l_quantity as bigint) * 40 as impressions,
       cast(l_quantity as bigint) as clicks, if(l_orderkey % 14 = 1, null, l_extendedprice) as spend, cast(l_quantity as bigint) * 30 as reach, 1.5 as frequency,
       l_linenumber as purchases, l_extendedprice as purchase_value, null as add_to_cart, if(l_orderkey % 2 = 1, 3, null) as initiate_checkout,
       9 as landing_page_views, null as link_clicks, if(l_orderkey % 14 = 1, 1, 0) as n_rejected
from lineitem""", "I-57")
def q_insights(spark, d):
    """Odd rows: counts as text, no ad name, the purchase under its second alias; every seventh of them an amount that is no number."""
    li = R.table(spark, d, "lineitem")
    odd = _c("l_orderkey") % 2 == 1
    n = _c("l_quantity").cast("bigint")
    action = lambda kind, v: F.struct(F.lit(kind).alias("action_type"), v.cast("string").alias("value"))
    line, price = _c("l_linenumber"), _c("l_extendedprice")
    actions = F.when(odd, F.array(action("purchase", line), action("initiated_checkout", F.lit("3.0")), action("landing_page_view", F.lit(4)), action("landing_page_view", F.lit(9)))).otherwise(
        F.array(action("purchase", F.lit(0)), action("omni_purchase", line), action("landing_page_view", F.lit(9)), action("other", line)))
    spend = F.when(_c("l_orderkey") % 14 == 1, F.to_json(F.struct(F.lit("n/a").alias("x")))).otherwise(_text(price, odd))
    body = _payload(odd, date_start=_c("l_shipdate").cast("date"), campaign_id=_c("l_suppkey").cast("string"), campaign_name=F.concat(F.lit("c-"), _c("l_suppkey")),
                    adset_id=(_c("l_orderkey"),), ad_id=(_c("l_partkey"),), ad_name=F.when(~odd, F.concat(F.lit("ad "), _c("l_partkey"))), impressions=(n * 40,), clicks=(n,),
                    reach=(n * 30,), frequency=(F.lit(1.5),), actions=actions, action_values=F.array(action("omni_purchase", price)))
    parts = li.select(body.alias("body"), spend.alias("spend"))  # built once, as the next step names it twice
    body = F.concat(F.substring_index("body", "}", -1), F.regexp_replace("body", r"\}$", ""), F.lit(',"spend":'), F.regexp_extract("spend", r'^\{"x":(.*)\}$', 1), F.lit("}"))
    return ld.read_feed(parts.select(body.alias("payload")), "social_daily_insights").withColumn("n_rejected", F.size("rejected"))


INVOICE_SPEC = ("invoice_id:s txn_date:d due_date:d customer_id:s customer_name:s total_amount:m balance:m currency:s billing_email:s txn_status:s created_at:s n_rejected:i")


@register("landed_invoices", INVOICE_SPEC, """
select cast(o_orderkey as varchar) as invoice_id, cast(o_orderdate as date) as txn_date, cast(o_orderdate as date) + 30 as due_date,
       if(o_orderkey % 2 = 1, null, cast(o_custkey as varchar)) as customer_id, if(o_orderkey % 2 = 1, null, c_name) as customer_name, o_totalprice as total_amount,
       b as balance, if(o_orderkey % 2 = 1, 'USD', 'EUR') as currency, if(o_orderkey % 2 = 1, null, 'a@b.example') as billing_email,
       if(b = 0, 'Paid', if(b < o_totalprice, 'Partial', 'Open')) as txn_status, if(o_orderkey % 2 = 1, null, '2024-01-01') as created_at, 0 as n_rejected
from (select *, case o_orderstatus when 'F' then 0 when 'O' then o_totalprice else 1 end as b from orders) left join customer on c_custkey = o_custkey""", "I-40")
def q_invoices(spark, d):
    """Odd rows: amounts as text, the customer a plain text in place of an object, no currency, mail or stamps."""
    o = R.table(spark, d, "orders").join(R.table(spark, d, "customer").select("c_custkey", "c_name"), _c("o_custkey") == _c("c_custkey"), "left")
    odd = _c("o_orderkey") % 2 == 1
    balance = F.when(_c("o_orderstatus") == "F", 0.0).when(_c("o_orderstatus") == "O", _c("o_totalprice")).otherwise(1.0)
    day = _c("o_orderdate").cast("date")
    ref = F.struct(_c("o_custkey").cast("string").alias("value"), _c("c_name").alias("name"))
    body = _payload(odd, Id=(_c("o_orderkey"),), TxnDate=day, DueDate=F.date_add(day, 30), TotalAmt=(_c("o_totalprice"),), Balance=(balance,),
                    CustomerRef=F.when(~odd, ref), CurrencyRef=F.when(~odd, F.struct(F.lit("EUR").alias("value"))), BillEmail=F.when(~odd, F.struct(F.lit("a@b.example").alias("Address"))),
                    MetaData=F.when(~odd, F.struct(F.lit("2024-01-01").alias("CreateTime"))), Customer=F.when(odd, _c("c_name")))
    return ld.read_feed(o.select(body.alias("payload")), "invoices").withColumn("n_rejected", F.size("rejected"))


def _orders_with_lines(spark, d, line):
    """A row per order with its lines, in order, as one array (an order has seven at most)."""
    li = R.table(spark, d, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(_c("l_linenumber").alias("n"), line.alias("x")))).alias("ls"))
    return lines.select("l_orderkey", F.transform("ls", lambda x: x["x"]).alias("lines")).join(R.table(spark, d, "orders"), _c("o_orderkey") == _c("l_orderkey"))


BILL_SPEC = "bill_id:s txn_date:d vendor_id:s total_amount:m balance:m currency:s line_summary:s"


@register("landed_bills", BILL_SPEC, """
select cast(o_orderkey as varchar) as bill_id, cast(o_orderdate as date) as txn_date, cast(o_custkey as varchar) as vendor_id, o_totalprice as total_amount, 0 as balance,
       'USD' as currency, coalesce(list_aggregate(list(t order by l_linenumber, if(l_linenumber % 3 = 1, t, ''), l_extendedprice, t) filter (t <> '')[1:5], 'string_agg', '; '), '') as line_summary
from (select *, if(l_linenumber % 3 = 0, '', if(l_linenumber % 3 = 1, 'part ' || l_partkey, 'acct ' || l_suppkey)) as t from lineitem) join orders on o_orderkey = l_orderkey
group by o_orderkey, o_orderdate, o_custkey, o_totalprice""", "I-45")
def q_bills(spark, d):
    """Lines with a description, with an account only, or with neither; the summary names the first five that say something."""
    k = _c("l_linenumber") % 3
    line = F.struct(F.when(k == 1, F.concat(F.lit("part "), _c("l_partkey"))).alias("Description"), _c("l_extendedprice").alias("Amount"),
                    F.when(k == 2, F.struct(F.struct(F.concat(F.lit("acct "), _c("l_suppkey")).alias("name")).alias("AccountRef"))).alias("AccountBasedExpenseLineDetail"))
    o = _orders_with_lines(spark, d, line)
    body = _payload(_c("o_orderkey") % 2 == 1, Id=(_c("o_orderkey"),), TxnDate=_c("o_orderdate").cast("date"), TotalAmt=(_c("o_totalprice"),),
                    VendorRef=F.struct(_c("o_custkey").alias("value")), Line=_c("lines"))
    return ld.read_feed(o.select(body.alias("payload")), "bills")


@register("landed_invoice_lines", "line_item_id:s invoice_id:s txn_date:d customer_id:s line_num:i item_id:s quantity:f unit_price:m amount:m discount_rate:f", """
select o_orderkey || '_' || l_linenumber as line_item_id, cast(o_orderkey as varchar) as invoice_id, cast(o_orderdate as date) as txn_date, cast(o_custkey as varchar) as customer_id,
       l_linenumber as line_num, cast(l_partkey as varchar) as item_id, l_quantity as quantity, 0 as unit_price, l_extendedprice as amount, l_discount as discount_rate
from lineitem join orders on o_orderkey = l_orderkey where l_linenumber % 4 <> 0""", "I-41")
def q_invoice_lines(spark, d):
    """Every fourth line is a subtotal, which is left out by its type."""
    sub = _c("l_linenumber") % 4 == 0
    detail = F.struct(F.struct(_c("l_partkey").alias("value")).alias("ItemRef"), _c("l_quantity").alias("Qty"), _c("l_discount").alias("DiscountRate"))
    line = F.struct(_c("l_linenumber").alias("Id"), _c("l_linenumber").alias("LineNum"), _c("l_extendedprice").alias("Amount"),
                    F.when(sub, "SubTotalLineDetail").otherwise("SalesItemLineDetail").alias("DetailType"), F.when(~sub, detail).alias("SalesItemLineDetail"))
    o = _orders_with_lines(spark, d, line)
    body = _payload(F.lit(False), Id=(_c("o_orderkey"),), TxnDate=_c("o_orderdate").cast("date"), CustomerRef=F.struct(_c("o_custkey").alias("value")), Line=_c("lines"))
    return ld.read_lines(o.select(body.alias("payload")), "invoice_lines")


@register("landed_sales_receipts", "sales_receipt_id:s txn_date:d total_amount:m subtotal_amount:m currency:s", """
select cast(o_orderkey as varchar) as sales_receipt_id, cast(o_orderdate as date) as txn_date, o_totalprice as total_amount,
       coalesce(sum(cast(round(l_extendedprice * 100) as bigint)) filter (l_linenumber % 4 <> 0), 0) / 100.0 as subtotal_amount, 'USD' as currency
from lineitem join orders on o_orderkey = l_orderkey group by o_orderkey, o_orderdate, o_totalprice""", "I-43")
def q_receipts(spark, d):
    line = F.struct(_c("l_extendedprice").cast("string").alias("Amount"),
                    F.when(_c("l_linenumber") % 4 == 0, "SubTotalLineDetail").otherwise("SalesItemLineDetail").alias("DetailType"))
    o = _orders_with_lines(spark, d, line)
    body = _payload(_c("o_orderkey") % 2 == 1, Id=(_c("o_orderkey"),), TxnDate=_c("o_orderdate").cast("date"), TotalAmt=(_c("o_totalprice"),), Line=_c("lines"))
    return ld.read_feed(o.select(body.alias("payload")), "sales_receipts")


ENTITY_SPEC = "kind:s id:s name:s amount:m active:b detail:s"


@register("landed_entities", ENTITY_SPEC, """
select 'customer' as kind, cast(c_custkey as varchar) as id, c_name as name, c_acctbal as amount, c_custkey % 2 = 0 as active, if(c_custkey % 2 = 1, null, n_name) as detail
from customer join nation on n_nationkey = c_nationkey
union all select 'item', cast(p_partkey as varchar), p_name, p_retailprice, true, if(p_partkey % 2 = 1, null, p_type) from part
union all select 'account', cast(s_suppkey as varchar), s_name, s_acctbal, true, 'USD' from supplier""", "I-48")
def q_entities(spark, d):
    """Customers, items and accounts by their contracts; odd customers are marked inactive and have no address."""
    c = R.table(spark, d, "customer").join(R.table(spark, d, "nation"), _c("n_nationkey") == _c("c_nationkey"))
    odd = _c("c_custkey") % 2 == 1
    c = c.select(_payload(odd, Id=(_c("c_custkey"),), DisplayName=_c("c_name"), Balance=(_c("c_acctbal"),), Active=F.when(odd, F.lit(False)),
                          BillAddr=F.when(~odd, F.struct(_c("n_name").alias("Country")))).alias("payload"))
    odd = _c("p_partkey") % 2 == 1
    i = R.table(spark, d, "part").select(_payload(odd, Id=(_c("p_partkey"),), Name=_c("p_name"), UnitPrice=(_c("p_retailprice"),), Type=F.when(~odd, _c("p_type"))).alias("payload"))
    a = R.table(spark, d, "supplier").select(_payload(_c("s_suppkey") % 2 == 1, Id=(_c("s_suppkey"),), Name=_c("s_name"), CurrentBalance=(_c("s_acctbal"),)).alias("payload"))
    pick = lambda df, kind, *cols: df.select(F.lit(kind).alias("kind"), *[_c(x).alias(y) for x, y in zip(cols, ("id", "name", "amount", "active", "detail"), strict=True)])
    return pick(ld.read_feed(c, "customers"), "customer", "customer_id", "display_name", "balance", "active", "country").unionByName(
        pick(ld.read_feed(i, "items"), "item", "item_id", "name", "unit_price", "active", "type")).unionByName(
        pick(ld.read_feed(a, "accounts"), "account", "account_id", "name", "current_balance", "active", "currency"))


WALLET_SPEC = ("transaction_id:s transaction_date:t transaction_amount:m fee_amount:m currency_code:s transaction_status:s payer_full_name:s first_item_name:s item_count:i")


@register("landed_wallet_transactions", WALLET_SPEC, """
select cast(event_id as varchar) as transaction_id, date_trunc('second', ts) as transaction_date, value as transaction_amount, 0 as fee_amount, 'USD' as currency_code,
       case event_type when 'purchase' then 'Success' when 'view' then 'Pending' when 'click' then 'Denied' else 'X' end as transaction_status,
       if(user_id % 2 = 1, 'Pay Er', 'Alt Name') as payer_full_name, if(user_id % 3 = 0, null, 'first') as first_item_name, if(user_id % 3 = 0, 0, 2) as item_count
from events""", "I-39")
def q_wallet(spark, d):
    e = R.table(spark, d, "events")
    odd = _c("user_id") % 2 == 1
    code = F.when(_c("event_type") == "purchase", "S").when(_c("event_type") == "view", "P").when(_c("event_type") == "click", "D").otherwise("X")
    info = F.struct(_c("event_id").cast("string").alias("transaction_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+0000").alias("transaction_initiation_date"),
                    F.struct(_c("value").cast("string").alias("value"), F.lit("USD").alias("currency_code")).alias("transaction_amount"), code.alias("transaction_status"))
    name = F.struct(F.when(odd, F.lit("Pay")).alias("given_name"), F.when(odd, F.lit("Er")).alias("surname"), F.lit("Alt Name").alias("alternate_full_name"))
    items = F.when(_c("user_id") % 3 != 0, F.array(F.struct(F.lit("first").alias("item_name")), F.struct(F.lit("second").alias("item_name"))))
    body = _payload(odd, transaction_info=info, payer_info=F.struct(name.alias("payer_name")), cart_info=F.struct(items.alias("item_details")))
    return ld.read_feed(e.select(body.alias("payload")), "wallet_transactions")


@register("landed_videos", "video_id:s title:s published_at:t tags:s category_id:s made_for_kids:b thumbnail_url:s", """
select cast(p_partkey as varchar) as video_id, p_name as title, cast('2024-01-02 03:04:05' as timestamp) as published_at, p_brand || ',' || p_type as tags,
       cast(p_size as varchar) as category_id, p_partkey % 2 = 1 as made_for_kids, if(p_partkey % 2 = 1, null, 'http://t.example/' || p_partkey) as thumbnail_url
from part""", "I-59")
def q_videos(spark, d):
    odd = _c("p_partkey") % 2 == 1
    thumb = F.struct(F.struct(F.concat(F.lit("http://t.example/"), _c("p_partkey")).alias("url")).alias("high"))
    snippet = F.struct(_c("p_name").alias("title"), F.lit("2024-01-02T03:04:05Z").alias("publishedAt"), F.array("p_brand", "p_type").alias("tags"),
                       _c("p_size").alias("categoryId"), F.when(~odd, thumb).alias("thumbnails"))
    body = _payload(odd, id=(_c("p_partkey"),), snippet=snippet, status=F.when(odd, F.struct(F.lit(True).alias("madeForKids"))))
    return ld.read_feed(R.table(spark, d, "part").select(body.alias("payload")), "videos")


@register("landed_channel_days", "report_date:d views:i estimated_minutes_watched:m subscribers_gained:i subscribers_lost:i", """
select cast(ts as date) as report_date, count(*) as views, sum(cast(round(value * 100) as bigint)) / 100.0 as estimated_minutes_watched,
       count(*) filter (event_type = 'signup') as subscribers_gained, 0 as subscribers_lost
from events group by 1""", "I-59")
def q_channel_days(spark, d):
    """A report answer a day: column names and rows of values, which are zipped into objects first."""
    day = R.table(spark, d, "events").groupBy(_c("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(R.cents("value")) / 100.0).alias("m"), F.count_if(_c("event_type") == "signup").alias("s"))
    heads = F.array(*[F.struct(F.lit(x).alias("name")) for x in ("day", "views", "estimatedMinutesWatched", "subscribersGained")])
    rows = F.array(F.array(_c("day").cast("string"), _c("n").cast("string"), _c("m").cast("string"), _c("s").cast("string")))
    return ld.read_feed(ld.zip_report(day.select(F.to_json(F.struct(heads.alias("columnHeaders"), rows.alias("rows"))).alias("payload"))), "channel_days")


@register("landed_store_customers", "customer_id:i email:s orders_count:i total_spent:m accepts_marketing:b country:s", """
select c_custkey as customer_id, if(c_custkey % 2 = 1, null, 'c' || c_custkey || '@shop.example') as email, c_custkey % 9 as orders_count, c_acctbal as total_spent,
       c_custkey % 2 = 0 as accepts_marketing, n_name as country
from customer join nation on n_nationkey = c_nationkey""", "I-16")
def q_store_customers(spark, d):
    c = R.table(spark, d, "customer").join(R.table(spark, d, "nation"), _c("n_nationkey") == _c("c_nationkey"))
    odd = _c("c_custkey") % 2 == 1
    body = _payload(odd, id=(_c("c_custkey"),), email=F.when(~odd, F.concat(F.lit("c"), _c("c_custkey"), F.lit("@shop.example"))), orders_count=(_c("c_custkey") % 9,),
                    total_spent=(_c("c_acctbal"),), accepts_marketing=F.when(~odd, F.lit(True)), default_address=F.struct(_c("n_name").alias("country")))
    return ld.read_feed(c.select(body.alias("payload")), "store_customers")


@register("landed_deposits", "deposit_id:s txn_date:d total_amount:m deposit_to_account_name:s source_summary:s line_count:i currency:s", """
select cast(event_id as varchar) as deposit_id, cast(ts as date) as txn_date, value as total_amount, if(user_id % 2 = 1, null, 'Bank') as deposit_to_account_name,
       if(value > 0, case user_id % 3 when 0 then 'Entity' when 1 then 'memo' else 'unknown' end || ', ', '') || 'unknown' as source_summary, 3 as line_count, 'USD' as currency
from events""", "I-44")
def q_deposits(spark, d):
    """Three lines a deposit: the event's amount, one without any name, and one that takes money off."""
    e, u = R.table(spark, d, "events"), _c("user_id") % 3
    detail = F.struct(F.when(u == 0, F.struct(F.lit("Entity").alias("name"))).alias("Entity"))
    line = lambda amount, memo, x: F.struct(amount.cast("string").alias("Amount"), memo.alias("Description"), x.alias("DepositLineDetail"))
    none, blank = F.lit(None).cast(detail_type := "struct<Entity:struct<name:string>>"), F.lit("")
    lines = F.array(line(_c("value"), F.when(u == 1, "memo").otherwise(blank), detail.cast(detail_type)), line(F.lit("1"), blank, none), line(F.lit("-1"), F.lit("back"), none))
    body = _payload(_c("user_id") % 2 == 1, Id=(_c("event_id"),), TxnDate=_c("ts").cast("date"), TotalAmt=(_c("value"),), Line=lines,
                    DepositToAccountRef=F.when(_c("user_id") % 2 == 0, F.struct(F.lit("Bank").alias("name"))))
    return ld.read_feed(e.select(body.alias("payload")), "deposits")
