"""Checked, aligned, supplemented and extracted tables (O-01, Q-01..Q-05, A-02, A-03, F-01..F-08, I-49, X-01..X-15)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marginalia.operators import checked as ck
from marginalia.operators import finance as fin
from marginalia.operators import serving as sv
from marginalia.operators import staging as st
from marginalia.plans.catalog import QUERIES, register
from marginalia.plans.finance import affiliates_df
from marginalia.session import checkpoint_dir
from marginalia.sources import contracts as ct
from marginalia.sources import flatten as fl
from marginalia.sources import roles as R
from marginalia.sources import supplement as sp


def _new(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _c(x):
    return F.col(x)


# ---- checks ---------------------------------------------------------------------------------------

LINE_RULES = [("not_null", "l_partkey"), ("unique", "l_orderkey"), ("unique", "l_comment_id"), ("accepted", "l_returnflag", ["A", "R"]),
              ("between", "l_discount", 0.0, 0.05), ("not_null", "late"), ("fresh", "l_shipdate", "2001-01-01 00:00:00", 48)]


@register("line_violations", "rule:s column:s violations:i", """
with l as (select *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as l_comment_id, if(l_quantity > 45, null, 1) as late from lineitem)
select 'not_null' as rule, 'l_partkey' as column, count(*) - count(l_partkey) as violations from l
union all select 'not_null', 'late', count(*) - count(late) from l
union all select 'unique', 'l_orderkey', (select count(*) from (select 1 from l group by l_orderkey having count(*) > 1))
union all select 'unique', 'l_comment_id', (select count(*) from (select 1 from l group by l_comment_id having count(*) > 1))
union all select 'accepted', 'l_returnflag', count(*) filter (l_returnflag not in ('A', 'R')) from l
union all select 'between', 'l_discount', count(*) filter (l_discount < 0 or l_discount > 0.05) from l
union all select 'fresh', 'l_shipdate', if(max(cast(l_shipdate as timestamp)) < timestamp '2001-01-01' - interval 48 hour, 1, 0) from l""", "Q-01")
def q_violations(spark, d):
    li = R.table(spark, d, "lineitem")
    li = li.withColumns({"l_comment_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "late": F.when(_c("l_quantity") <= 45, 1)})
    return ck.violations(li, LINE_RULES)


@register("run_log_of_loads", "pipeline_name:s status:s rows_loaded:i", """
select 'orders' as pipeline_name, 'success' as status, count(*) as rows_loaded from orders
union all select 'lines', 'success', count(*) from lineitem""", "O-01")
def q_run_log(spark, d):
    """Two tables are written with their rows counted by the write; the run log is read back."""
    log = _new(spark, "run-log")
    for k, (name, table) in enumerate((("orders", "orders"), ("lines", "lineitem"))):
        ck.run_load(spark, R.table(spark, d, table), _new(spark, f"load-{name}"), log, f"run-{k}", name)
    return spark.read.parquet(log)


# ---- aligned unions -------------------------------------------------------------------------------

BY_ASIN = ("report_date:date campaign_id:string campaign_name:string ad_group_id:string ad_group_name:string asin:string sku:string profile_id:string ad_product:string "
           "impressions:bigint clicks:bigint cost:double sales:double ctr:double cpc:double acos:double roas:double")
BY_CAMPAIGN = ("report_date:date campaign_id:string campaign_name:string campaign_status:string profile_id:string ad_product:string impressions:bigint clicks:bigint cost:double "
               "purchases:bigint sales:double units_sold:double ctr:double cpc:double acos:double roas:double")


def _ad_rows(spark, d, flag, purchases, sales, units):
    """Ad report rows, all as text, of the lines with a return flag; the three flags make three products."""
    li = R.table(spark, d, "lineitem").where(_c("l_returnflag") == flag)
    asin, sku = F.concat(F.lit("B"), _c("l_partkey")), F.concat(F.lit("sku-"), _c("l_partkey"))
    cost = F.format_string("%.2f", R.idiv("cast(round(l_extendedprice * 100) as bigint)", 1000) / 100.0)
    return li.select(_c("l_shipdate").cast("date").cast("string").alias("date"), _c("l_suppkey").cast("string").alias("campaign_id"), F.concat(F.lit("c "), _c("l_suppkey")).alias("campaign_name"),
                     F.lit("ENABLED").alias("campaign_status"), _c("l_linenumber").cast("string").alias("ad_group_id"), F.concat(F.lit("g "), _c("l_linenumber")).alias("ad_group_name"),
                     asin.alias("advertised_asin"), asin.alias("promoted_asin"), sku.alias("advertised_sku"), sku.alias("promoted_sku"), F.lit("p1").alias("profile_id"),
                     (_c("l_quantity") * 40).cast("bigint").cast("string").alias("impressions"), _c("l_quantity").cast("bigint").cast("string").alias("clicks"), cost.alias("cost"),
                     _c("l_linenumber").cast("string").alias(purchases), F.format_string("%.2f", _c("l_extendedprice")).alias(sales), _c("l_linenumber").cast("string").alias(units),
                     F.lit(1).alias("_loaded_at"))


def _sp(spark, d):
    return _ad_rows(spark, d, "A", "purchases14d", "sales14d", "units_sold_clicks14d")


def _sd(spark, d):
    return _ad_rows(spark, d, "R", "purchases_clicks", "sales_clicks", "units_sold_clicks")


def _sb(spark, d):
    return _ad_rows(spark, d, "N", "purchases", "sales", "units_sold")


_AD_SQL = """
select cast(l_shipdate as date) as report_date, cast(l_suppkey as varchar) as campaign_id, 'c ' || l_suppkey as campaign_name, cast(l_linenumber as varchar) as ad_group_id,
       'g ' || l_linenumber as ad_group_name, 'B' || l_partkey as asin, 'sku-' || l_partkey as sku, 'p1' as profile_id, 'ENABLED' as campaign_status,
       case l_returnflag when 'A' then 'SPONSORED_PRODUCTS' when 'R' then 'SPONSORED_DISPLAY' else 'SPONSORED_BRANDS' end as ad_product, l_linenumber as purchases,
       cast(l_linenumber as double) as units_sold, cast(l_quantity as bigint) * 40 as impressions, cast(l_quantity as bigint) as clicks, c as cost, l_extendedprice as sales,
       if(l_quantity >= 1, 1 / 40.0, null) as ctr, c / nullif(cast(l_quantity as bigint), 0) as cpc, c / nullif(l_extendedprice, 0) as acos, l_extendedprice / nullif(c, 0) as roas
from (select *, (cast(round(l_extendedprice * 100) as bigint) // 1000) / 100.0 as c from lineitem)"""
_ASIN_SPEC = ("report_date:d campaign_id:s campaign_name:s ad_group_id:s ad_group_name:s asin:s sku:s profile_id:s ad_product:s impressions:i clicks:i cost:m sales:m "
              "ctr:r cpc:r acos:r roas:r")
_CAMPAIGN_SPEC = ("report_date:d campaign_id:s campaign_name:s campaign_status:s profile_id:s ad_product:s impressions:i clicks:i cost:m purchases:i sales:m units_sold:f "
                  "ctr:r cpc:r acos:r roas:r")
_NOT_ASKED = {c: "no column of the union" for c in ("purchases", "units_sold", "_loaded_at")}


@register("ad_spend_by_asin", _ASIN_SPEC, f"select * from ({_AD_SQL}) where ad_product <> 'SPONSORED_BRANDS'", "A-02")
def q_by_asin(spark, d):
    """Product and display ads in one layout; brand ads have no product (A-03 has them)."""
    feeds = [(st.stage(_sp(spark, d), "amazon_ads__sp_asin"), {}, {c: r for c, r in _NOT_ASKED.items() if c != "units_sold"}),
             (st.stage(_sd(spark, d), "amazon_ads__sd_asin"), {}, _NOT_ASKED)]
    return ct.union_aligned(feeds, BY_ASIN)


@register("ad_spend_by_campaign", _CAMPAIGN_SPEC, _AD_SQL, "A-03")
def q_by_campaign(spark, d):
    raw = {"sp": _sp(spark, d), "sb": _sb(spark, d), "sd": _sd(spark, d)}
    return ct.union_aligned([(st.stage(df, f"amazon_ads__{k}_campaigns"), {}, {"_loaded_at": "load stamp"}) for k, df in raw.items()], BY_CAMPAIGN)


# ---- supplements ----------------------------------------------------------------------------------

CUT, SEED_END = "1996-07-10", "1996-07-20"  # the feed begins; the seed goes on for ten days more
EVENTS_CUT, EVENTS_SEED_END = "2024-01-11", "2024-01-15"


def _before_cut(df, day="txn_date", cut=CUT, end=SEED_END):
    """(feed, seed rows of the time before it): both sides come with ten days in common, which the seed gives up."""
    feed = df.where(_c(day) >= F.lit(cut).cast("date"))
    return feed, sp.before_feed(df.where(_c(day) <= F.lit(end).cast("date")), feed, day)


@register("monthly_revenue_supplemented", QUERIES["monthly_revenue"].spec, f"""
select * from m_monthly_revenue where revenue_stream <> 'Wholesale'
union all
select date_trunc('month', txn_date)::date, 'Wholesale', sum(total_amount), count(*) from r_invoices
where txn_status in ('Paid', 'Partial', 'Open') and txn_date is not null group by date_trunc('month', txn_date), txn_date >= date '{CUT}'""", "F-01")
def q_revenue_supplemented(spark, d):
    feed, seed = _before_cut(R.invoices(spark, d))
    none = R.deposits(spark, d).limit(0)
    return fin.monthly_revenue(feed, R.deposits(spark, d), supplement=fin.monthly_revenue(seed, none))


@register("monthly_expenses_supplemented", QUERIES["monthly_expenses"].spec, f"""
select date_trunc('month', txn_date)::date as month, coalesce(a.name, l.account_name) as expense_category, a.account_type as account_type, a.account_sub_type as account_sub_type,
       list_contains(['PayrollWageExpenses', 'PayrollExpenses', 'PayrollTaxExpenses'], a.account_sub_type) as is_owner_compensation, sum(amount) as total_amount,
       count(*) as transaction_count
from r_purchase_lines l join r_accounts a using (account_id)
where a.classification = 'Expense' and txn_date is not null and coalesce(a.name, l.account_name) is not null
group by 1, 2, 3, 4, 5, txn_date >= date '{CUT}'""", "F-02")
def q_expenses_supplemented(spark, d):
    feed, seed = _before_cut(R.purchase_lines(spark, d))
    return fin.monthly_expenses(feed, R.accounts(spark, d), supplement=fin.monthly_expenses(seed, R.accounts(spark, d)))


_AFF = QUERIES["affiliate_by_partner"].sql
_AFF_HALF = "(select * from r_deposits where txn_date {} date '" + EVENTS_CUT + "')"


@register("affiliates_supplemented", QUERIES["affiliate_by_partner"].spec, f"""
select * from ({_AFF.replace('from r_deposits', 'from ' + _AFF_HALF.format('>='))}) union all
select * from ({_AFF.replace('from r_deposits', 'from ' + _AFF_HALF.format('<'))})""", "F-04")
def q_affiliates_supplemented(spark, d):
    feed, seed = _before_cut(R.deposits(spark, d), cut=EVENTS_CUT, end=EVENTS_SEED_END)
    wallet = R.wallet_transactions(spark, d)
    return fin.affiliate_by_partner(feed, wallet, supplement=fin.affiliate_by_partner(seed, wallet))


@register("wholesale_detail_supplemented", QUERIES["wholesale_detail"].spec, f"""
select * from ({QUERIES["wholesale_detail"].sql}) where txn_date >= date '{CUT}'
union all
select 'bank-' || strftime(m, '%Y-%m'), 'BANK-' || strftime(m, '%Y-%m'), m, 'Pre-QBO (Bank Statement)', 'Pre-QBO (Bank Statement)', null, null, null, null, v, v, 0, 'Paid'
from (select date_trunc('month', txn_date)::date as m, sum(total_amount) as v from r_invoices
      where txn_date < date '{CUT}' and txn_status in ('Paid', 'Partial', 'Open') group by 1)""", "F-08")
def q_wholesale_supplemented(spark, d):
    feed, seed = _before_cut(R.invoices(spark, d))
    none = R.deposits(spark, d).limit(0)
    return fin.wholesale_detail(feed, R.invoice_lines(spark, d), R.qb_customers(spark, d), supplement=fin.monthly_revenue(seed, none))


# ---- ranked rows per period -----------------------------------------------------------------------

@register("top_events_by_day", "event_id:i day:d value:m", """
select event_id, cast(ts as date) as day, value from events
qualify row_number() over (partition by cast(ts as date) order by value desc, lpad(cast(event_id as varchar), 20, '0')) <= 5""", "I-49")
def q_top_events(spark, d):
    e = R.table(spark, d, "events").select(F.lpad(_c("event_id").cast("string"), 20, "0").alias("event_id"), _c("ts").cast("date").alias("day"), "value")
    return fl.top_n_per_period(e, "day", "value", 5)


# ---- extracts -------------------------------------------------------------------------------------

# extract -> (query, columns or all, order): the consumer's column lists and orders (fixed values)
EXTRACTS = {
    "X-01": ("affiliate_by_partner", None, "month partner_name"),
    "X-02": ("customer_ltv", "cohort_month cohort_size avg_ltv_6mo avg_revenue_6mo avg_orders_6mo avg_contribution_ltv_6mo total_revenue_6mo total_gross_profit_6mo "
                             "total_contribution_profit_6mo cohort_gross_margin cohort_contribution_margin total_shipping_cost_6mo", "-cohort_month"),
    "X-03": ("customer_cohorts", "order_id customer_id order_date first_order_date cohort_month months_since_first_order net_revenue gross_profit cumulative_gross_profit "
                                 "contribution_profit cumulative_contribution_profit estimated_shipping_cost", "customer_id order_date"),
    "X-04": ("d2c_monthly_pnl", None, "month"),
    "X-05": ("expense_by_vendor", None, "month vendor_name"),
    "X-06": ("monthly_expenses", None, "month expense_category"),
    "X-07": ("expense_enriched", None, "month expense_bucket expense_category"),
    "X-09": ("monthly_pnl", None, "month"),
    "X-10": ("monthly_revenue", None, "month revenue_stream"),
    "X-12": ("channel_summary", "report_date channel spend impressions clicks conversions revenue roas cpa orders", "-report_date channel"),
    "X-14": ("subscription_analysis", None, "-annual_projection"),
    "X-15": ("wholesale_detail", None, "-txn_date"),
}


def extract_order(order: str, names: list[str]) -> list:
    """The asked order, made total by all other columns."""
    asked = [(x.lstrip("-"), x.startswith("-")) for x in order.split()]
    return [F.desc(n) if down else F.asc(n) for n, down in asked] + [F.asc(n) for n in names if n not in dict(asked)]


def _extract(survey_id: str, source: str, names: str | None, order: str) -> None:
    q = QUERIES[source]
    kinds = dict(q.columns)
    names_ = names.split() if names else list(kinds)

    @register(f"extract_{survey_id.lower().replace('-', '')}_{source}", " ".join(f"{n}:{kinds[n]}" for n in names_), q.sql, survey_id)
    def build(spark, d):
        path = _new(spark, f"extract-{source}")
        sv.write_ordered(q.build(spark, d).select(*names_), path, extract_order(order, names_))
        return spark.read.parquet(path)


for _id, _how in EXTRACTS.items():
    _extract(_id, *_how)


@register("extract_x08_survey", "response_id:s responded_at:t how_did_you_hear:s order_total:m", "select * from r_survey", "X-08")
def q_survey_extract(spark, d):
    path = _new(spark, "extract-survey")
    s = R.survey_responses(spark, d)
    sv.write_ordered(s, path, extract_order("-responded_at", s.columns))
    return spark.read.parquet(path)
