"""Dashboard page queries (D-xx), extracts (X-xx) and run-log digests (O-xx).

Each page query is a serving pattern applied to a mart with explicit dates
(the page's date-range inputs become ``START``/``END`` constants here).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marginalia.functions import month_start, monday_week, round_half_away, safe_div
from marginalia.functions import sql_round_half_away as R2
from marginalia.operators import runlog as rl
from marginalia.operators import serving as sv
from marginalia.plans import commerce as pc
from marginalia.plans import finance as pf
from marginalia.plans import marketing as pm
from marginalia.plans.catalog import QUERIES, SQL_MODELS, register, sql_model
from marginalia.sources import roles as R

# page date-range inputs used by the registered queries
START, END = "2000-01-01", "2000-12-31"          # order-era marts
EV_START, EV_END = "2024-01-08", "2024-01-21"    # event-era inputs
PAGE = (START, END)                              # the months a page shows
PAGE_AND_PRIOR = ("1999-01-01", END)             # and the twelve before them
RUNS_AS_OF = R.AS_OF_RUNS

for _name in ("channel_summary", "daily_performance", "expense_enriched", "subscription_analysis",
              "monthly_pnl", "affiliate_by_partner", "wholesale_detail", "customer_ltv"):
    if f"m_{_name}" not in SQL_MODELS:
        sql_model(f"m_{_name}", QUERIES[_name].sql)


def _q(name):
    return lambda spark, d: QUERIES[name].build(spark, d)


channel_summary = _q("channel_summary")
daily_performance = _q("daily_performance")
expense_enriched = _q("expense_enriched")
subscriptions = _q("subscription_analysis")
monthly_pnl = pf.pnl_df
affiliates = pf.affiliates_df
wholesale = _q("wholesale_detail")
cohort_ltv = _q("customer_ltv")


def _in(col, a=START, b=END):
    return f"{col} >= date '{a}' and {col} <= date '{b}'"


def _prior12(col, a=START):
    return f"{col} >= date '{a}' - interval 12 month and {col} < date '{a}'"


# --- acquisition ------------------------------------------------------------------

PAID = ("google_ads", "meta")


def _acq_measures(cond):
    paid = F.col("channel").isin(*PAID)
    return [("total_spend", "sum", F.when(paid, F.col("spend")), cond),
            ("_paid_rev", "sum", F.when(paid, F.col("revenue")), cond),
            ("_g_rev", "sum", F.when(F.col("channel") == "google_ads", F.col("revenue")), cond),
            ("_g_sp", "sum", F.when(F.col("channel") == "google_ads", F.col("spend")), cond),
            ("_m_rev", "sum", F.when(F.col("channel") == "meta", F.col("revenue")), cond),
            ("_m_sp", "sum", F.when(F.col("channel") == "meta", F.col("spend")), cond)]


def _acq_kpi(df, cond, prefix=""):
    k = sv.period_compare(df, [(n, kind, F.coalesce(v, F.lit(0.0)), c) for n, kind, v, c in _acq_measures(cond)])
    return k.select(F.col("total_spend").alias(f"{prefix}total_spend"),
                    safe_div(F.col("_paid_rev"), F.col("total_spend")).alias(f"{prefix}blended_roas"),
                    safe_div(F.col("_g_rev"), F.col("_g_sp")).alias(f"{prefix}google_roas"),
                    safe_div(F.col("_m_rev"), F.col("_m_sp")).alias(f"{prefix}meta_roas"))


def _acq_sql(where, prefix=""):
    return f"""
select sum(case when channel in ('google_ads', 'meta') then spend else 0 end) as {prefix}total_spend,
       sum(case when channel in ('google_ads', 'meta') then revenue else 0 end)
         / nullif(sum(case when channel in ('google_ads', 'meta') then spend else 0 end), 0) as {prefix}blended_roas,
       sum(case when channel = 'google_ads' then revenue else 0 end)
         / nullif(sum(case when channel = 'google_ads' then spend else 0 end), 0) as {prefix}google_roas,
       sum(case when channel = 'meta' then revenue else 0 end)
         / nullif(sum(case when channel = 'meta' then spend else 0 end), 0) as {prefix}meta_roas
from m_channel_summary where {where}"""


@register("acquisition_kpi_current", "total_spend:m blended_roas:r google_roas:r meta_roas:r",
          _acq_sql(_in("report_date")), "D-01")
def q_acq_current(spark, d):
    cs = channel_summary(spark, d)
    return _acq_kpi(cs.where(sv.current_period("report_date", START, END)), None)


_prior_len = (f"report_date >= date '{START}' - cast(date '{END}' - date '{START}' + 1 as integer) "
              f"and report_date < date '{START}'")


@register("acquisition_kpi_prior", "prior_total_spend:m prior_blended_roas:r prior_google_roas:r prior_meta_roas:r",
          _acq_sql(_prior_len, "prior_"), "D-02")
def q_acq_prior(spark, d):
    cs = channel_summary(spark, d)
    return _acq_kpi(cs.where(sv.prior_same_length("report_date", START, END)), None, "prior_")


@register("weekly_spend", "week:d channel:s spend:m", f"""
select cast(date_trunc('week', report_date) as date) as week, channel, sum(spend) as spend
from m_channel_summary where {_in('report_date')} and channel in ('google_ads', 'meta') group by 1, 2""", "D-03")
def q_weekly_spend(spark, d):
    cs = sv.in_range(channel_summary(spark, d), "report_date", START, END).where(F.col("channel").isin(*PAID))
    return sv.weekly(cs, "report_date", ["channel"], {"spend": "spend"})


@register("weekly_roas", "week:d channel:s roas:r", f"""
select cast(date_trunc('week', report_date) as date) as week, channel, sum(revenue) / nullif(sum(spend), 0) as roas
from m_channel_summary where {_in('report_date')} and channel in ('google_ads', 'meta') group by 1, 2""", "D-04")
def q_weekly_roas(spark, d):
    cs = sv.in_range(channel_summary(spark, d), "report_date", START, END).where(F.col("channel").isin(*PAID))
    return sv.weekly(cs, "report_date", ["channel"], {}, {"roas": ("revenue", "spend")})


CAMPAIGN_SPEC = "campaign_name:s spend:m clicks:i conversions:f revenue:m roas:r cpc:r conversion_rate:r"


def _campaigns(platform):
    def build(spark, d):
        dp = sv.in_range(daily_performance(spark, d), "report_date", START, END) \
            .where(F.col("platform") == platform)
        return sv.rollup(dp, ["campaign_name"], {"spend": "spend", "clicks": "clicks", "conversions": "conversions",
                                                 "revenue": "conversion_value"},
                         {"roas": ("conversion_value", "spend"), "cpc": ("spend", "clicks"),
                          "conversion_rate": ("conversions", "clicks")})
    sql = f"""
select campaign_name, sum(spend) as spend, sum(clicks) as clicks, sum(conversions) as conversions,
       sum(conversion_value) as revenue, sum(conversion_value) / nullif(sum(spend), 0) as roas,
       sum(spend) / nullif(sum(clicks), 0) as cpc, sum(conversions) / nullif(sum(clicks), 0) as conversion_rate
from m_daily_performance where {_in('report_date')} and platform = '{platform}' group by campaign_name"""
    return build, sql


_g_build, _g_sql = _campaigns("google_ads")
register("google_campaigns", CAMPAIGN_SPEC, _g_sql, "D-05")(_g_build)
_m_build, _m_sql = _campaigns("meta")
register("meta_campaigns", CAMPAIGN_SPEC, _m_sql, "D-06")(_m_build)


# --- D2C -----------------------------------------------------------------------------

def _cur_prior_sql(table, col, items, where_extra=""):
    parts = []
    for name, expr, which in items:
        cond = _in(col) if which == "cur" else _prior12(col)
        parts.append(f"sum(case when {cond} then {expr} else 0 end) as {name}")
    return (f"select {', '.join(parts)} from {table} where {col} >= date '{START}' - interval 12 month "
            f"and {col} <= date '{END}' {where_extra}")


def _cur_prior(df, col, items):
    cur = sv.current_period(col, START, END)
    pri = sv.prior_months(col, START, 12)
    win = (F.col(col) >= F.add_months(F.lit(START).cast("date"), -12)) & (F.col(col) <= F.lit(END).cast("date"))
    return sv.period_compare(df, [(n, "sum", F.col(e) if isinstance(e, str) else e, cur if w == "cur" else pri)
                                  for n, e, w in items], where=win)


D2C_KPI = [("period_revenue", "net_revenue", "cur"), ("prior_revenue", "net_revenue", "prior"),
           ("period_contribution", "d2c_contribution", "cur"), ("prior_contribution", "d2c_contribution", "prior"),
           ("period_ad_spend", "total_ad_spend", "cur"), ("prior_ad_spend", "total_ad_spend", "prior"),
           ("period_orders", "orders", "cur")]


@register("d2c_kpi", " ".join(f"{n}:{'i' if n == 'period_orders' else 'm'}" for n, _, _ in D2C_KPI),
          _cur_prior_sql("m_d2c_monthly_pnl", "month", D2C_KPI), "D-21")
def q_d2c_kpi(spark, d):
    return _cur_prior(pc.monthly_pnl_df(spark, d, PAGE_AND_PRIOR), "month", D2C_KPI)


@register("contribution_breakdown", "month:d net_revenue:m cogs:m shipping:m shopify_fees:m google:m meta:m "
          "d2c_contribution:m", f"""
select month, net_revenue, total_cogs * -1 as cogs, estimated_shipping * -1 as shipping,
       shopify_fees_est * -1 as shopify_fees, google_ads_spend * -1 as google, meta_ads_spend * -1 as meta,
       d2c_contribution
from m_d2c_monthly_pnl where {_in('month')}""", "D-22")
def q_contribution(spark, d):
    m = sv.in_range(pc.monthly_pnl_df(spark, d, PAGE), "month", START, END)
    return m.select("month", "net_revenue", (-F.col("total_cogs")).alias("cogs"),
                    (-F.col("estimated_shipping")).alias("shipping"), (-F.col("shopify_fees_est")).alias("shopify_fees"),
                    (-F.col("google_ads_spend")).alias("google"), (-F.col("meta_ads_spend")).alias("meta"),
                    "d2c_contribution")


COST_LINES = {"COGS": "total_cogs", "Shipping": "estimated_shipping", "Shopify Fees": "shopify_fees_est",
              "Google Ads": "google_ads_spend", "Meta Ads": "meta_ads_spend"}


@register("cost_stack_long", "month:d line:s value:m", " union all ".join(
    f"select month, '{label}' as line, {col} as value from m_d2c_monthly_pnl where {_in('month')}"
    for label, col in COST_LINES.items()), "D-23")
def q_cost_stack(spark, d):
    m = sv.in_range(pc.monthly_pnl_df(spark, d, PAGE), "month", START, END)
    return sv.lines_long(m, ["month"], COST_LINES)


BIWEEK_SUMS = ["orders", "net_revenue", "total_cogs", "estimated_shipping", "shopify_fees_est", "google_ads_spend",
               "meta_ads_spend", "d2c_contribution"]


@register("d2c_biweekly", "period_start:d orders:i " + " ".join(f"{c}:m" for c in BIWEEK_SUMS[1:]) + " margin:r", f"""
select cast(date_trunc('week', order_date) as date)
         + 7 * cast(((dayofyear(order_date) + 6 - dayofweek(order_date)) // 7) % 2 as integer) as period_start,
       {', '.join(f'sum({c}) as {c}' for c in BIWEEK_SUMS)},
       sum(d2c_contribution) / nullif(sum(net_revenue), 0) as margin
from m_d2c_daily_pnl where {_in('order_date')} group by 1""", "D-24")
def q_biweekly(spark, d):
    daily = sv.in_range(pc.daily_pnl_df(spark, d, PAGE), "order_date", START, END)
    return sv.rollup(daily, [sv.biweekly_start("order_date").alias("period_start")],
                     {c: c for c in BIWEEK_SUMS}, {"margin": ("d2c_contribution", "net_revenue")})


# --- expenses ------------------------------------------------------------------------

EXP_KPI_SQL = f"""
select sum(case when {_in('month')} and expense_bucket != 'Payroll & Benefits' then total_amount else 0 end)
           as total_expenses,
       sum(case when {_prior12('month')} and expense_bucket != 'Payroll & Benefits' then total_amount else 0 end)
           as prior_total_expenses,
       sum(case when {_in('month')} and expense_bucket = 'Payroll & Benefits' then total_amount else 0 end)
           as owner_comp
from m_expense_enriched where month >= date '{START}' - interval 12 month and month <= date '{END}'"""


@register("expense_kpi_comparison", "total_expenses:m prior_total_expenses:m owner_comp:m", EXP_KPI_SQL, "D-28")
def q_exp_kpi(spark, d):
    e = expense_enriched(spark, d)
    pay = F.col("expense_bucket") == "Payroll & Benefits"
    cur = sv.current_period("month", START, END)
    pri = sv.prior_months("month", START, 12)
    win = (F.col("month") >= F.add_months(F.lit(START).cast("date"), -12)) & (F.col("month") <= F.lit(END).cast("date"))
    return sv.period_compare(e, [("total_expenses", "sum", "total_amount", cur & ~pay),
                                 ("prior_total_expenses", "sum", "total_amount", pri & ~pay),
                                 ("owner_comp", "sum", "total_amount", cur & pay)], where=win)


@register("sub_kpis", "active_subscriptions:i monthly_burn:m annual_projection:m", """
select count(*) as active_subscriptions, sum(avg_monthly_cost) as monthly_burn, sum(annual_projection) as annual_projection
from m_subscription_analysis""", "D-29")
def q_sub_kpis(spark, d):
    return subscriptions(spark, d).agg(F.count(F.lit(1)).alias("active_subscriptions"),
                                       F.sum("avg_monthly_cost").alias("monthly_burn"),
                                       F.sum("annual_projection").alias("annual_projection"))


@register("bucket_monthly", "month:d expense_bucket:s total_amount:m", f"""
select month, expense_bucket, sum(total_amount) as total_amount from m_expense_enriched
where {_in('month')} group by 1, 2""", "D-30")
def q_bucket_monthly(spark, d):
    return sv.rollup(sv.in_range(expense_enriched(spark, d), "month", START, END), ["month", "expense_bucket"],
                     {"total_amount": "total_amount"})


@register("top_categories", "expense_category:s expense_bucket:s total_amount:m mom_change:m avg_mom_change_pct:r", f"""
select expense_category, expense_bucket, sum(total_amount) as total_amount, sum(mom_change) as mom_change,
       avg(mom_change_pct) as avg_mom_change_pct
from m_expense_enriched where {_in('month')} group by 1, 2
order by total_amount desc, expense_category, expense_bucket limit 20""", "D-31")
def q_top_categories(spark, d):
    g = sv.rollup(sv.in_range(expense_enriched(spark, d), "month", START, END), ["expense_category", "expense_bucket"],
                  {"total_amount": "total_amount", "mom_change": "mom_change"},
                  extra=[F.avg("mom_change_pct").alias("avg_mom_change_pct")])
    return sv.top_n(g, [F.col("total_amount").desc(), "expense_category", "expense_bucket"], 20)


@register("cost_cutting", pf.SUB_SPEC, "select * from m_subscription_analysis where cost_cutting_signal is not null",
          "D-32")
def q_cost_cutting(spark, d):
    return subscriptions(spark, d).where(F.col("cost_cutting_signal").isNotNull())


@register("top_sub_trend", "month:d vendor_name:s total_spend:m", f"""
select v.month, v.vendor_name, v.total_spend from m_expense_by_vendor v
join (select vendor_name from m_subscription_analysis order by annual_projection desc, vendor_name limit 10) t
  on v.vendor_name = t.vendor_name
where {_in('v.month')}""", "D-33")
def q_top_sub_trend(spark, d):
    v = sv.in_range(QUERIES["expense_by_vendor"].build(spark, d), "month", START, END)
    top = sv.semi_top_n(v, subscriptions(spark, d), "vendor_name",
                        [F.col("annual_projection").desc(), "vendor_name"], 10)
    return top.select("month", "vendor_name", "total_spend")


@register("top_vendors", "vendor_name:s total_spend:m total_transactions:i avg_monthly_spend:m is_subscription:b", f"""
select vendor_name, sum(total_spend) as total_spend, sum(transaction_count) as total_transactions,
       avg(total_spend) as avg_monthly_spend, bool_or(is_likely_subscription) as is_subscription
from m_expense_by_vendor where {_in('month')} group by vendor_name
order by total_spend desc, vendor_name limit 20""", "D-34")
def q_top_vendors(spark, d):
    v = sv.in_range(QUERIES["expense_by_vendor"].build(spark, d), "month", START, END)
    g = sv.rollup(v, ["vendor_name"], {"total_spend": "total_spend", "total_transactions": "transaction_count"},
                  extra=[F.avg("total_spend").alias("avg_monthly_spend"),
                         F.max("is_likely_subscription").alias("is_subscription")])
    return sv.top_n(g, [F.col("total_spend").desc(), "vendor_name"], 20)


# --- index / revenue ---------------------------------------------------------------------

IDX_KPI = [("ytd_revenue", "total_revenue", "cur"), ("prior_revenue", "total_revenue", "prior"),
           ("ytd_expenses", "operating_expenses", "cur"), ("prior_expenses", "operating_expenses", "prior"),
           ("ytd_net_income", "operating_income", "cur"), ("prior_net_income", "operating_income", "prior"),
           ("ytd_owner_comp", "owner_compensation", "cur")]


@register("kpi_with_comparison", " ".join(f"{n}:m" for n, _, _ in IDX_KPI),
          _cur_prior_sql("m_monthly_pnl", "month", IDX_KPI), "D-37")
def q_index_kpi(spark, d):
    return _cur_prior(monthly_pnl(spark, d, PAGE_AND_PRIOR), "month", IDX_KPI)


@register("ytd_revenue_mix", "revenue_stream:s total_revenue:m", f"""
select revenue_stream, sum(revenue) as total_revenue from m_monthly_revenue where {_in('month')} group by 1""", "D-39")
def q_revenue_mix(spark, d):
    return sv.rollup(sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END), ["revenue_stream"],
                     {"total_revenue": "revenue"})


@register("stream_totals", "revenue_stream:s total_revenue:m total_transactions:i avg_monthly_revenue:m", f"""
select revenue_stream, sum(revenue) as total_revenue, sum(transaction_count) as total_transactions,
       avg(revenue) as avg_monthly_revenue
from m_monthly_revenue where {_in('month')} group by revenue_stream""", "D-53")
def q_stream_totals(spark, d):
    return sv.rollup(sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END), ["revenue_stream"],
                     {"total_revenue": "revenue", "total_transactions": "transaction_count"},
                     extra=[F.avg("revenue").alias("avg_monthly_revenue")])


@register("revenue_yoy", "month_num:i month_name:s year:i revenue:m", f"""
select month(month) as month_num, strftime(month, '%b') as month_name, year(month) as year, sum(revenue) as revenue
from m_monthly_revenue where {_in('month')} group by 1, 2, 3""", "D-54")
def q_yoy(spark, d):
    r = sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END)
    return sv.rollup(r, [F.month("month").alias("month_num"), F.date_format("month", "MMM").alias("month_name"),
                         F.year("month").alias("year")], {"revenue": "revenue"})


@register("revenue_kpi_comparison", "total_revenue:m prior_total_revenue:m avg_monthly_revenue:m "
          "prior_avg_monthly_revenue:m", f"""
select sum(case when {_in('month')} then revenue else 0 end) as total_revenue,
       sum(case when {_prior12('month')} then revenue else 0 end) as prior_total_revenue,
       avg(case when {_in('month')} then revenue end) as avg_monthly_revenue,
       avg(case when {_prior12('month')} then revenue end) as prior_avg_monthly_revenue
from m_monthly_revenue where month >= date '{START}' - interval 12 month and month <= date '{END}'""", "D-55")
def q_revenue_kpi(spark, d):
    r = pf.revenue_df(spark, d, PAGE_AND_PRIOR)
    cur = sv.current_period("month", START, END)
    pri = sv.prior_months("month", START, 12)
    win = (F.col("month") >= F.add_months(F.lit(START).cast("date"), -12)) & (F.col("month") <= F.lit(END).cast("date"))
    return sv.period_compare(r, [("total_revenue", "sum", "revenue", cur), ("prior_total_revenue", "sum", "revenue", pri),
                                 ("avg_monthly_revenue", "avg", "revenue", cur),
                                 ("prior_avg_monthly_revenue", "avg", "revenue", pri)], where=win)


@register("top_stream", "revenue_stream:s total_revenue:m", f"""
select revenue_stream, sum(revenue) as total_revenue from m_monthly_revenue where {_in('month')}
group by revenue_stream order by total_revenue desc, revenue_stream limit 1""", "D-56")
def q_top_stream(spark, d):
    g = sv.rollup(sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END), ["revenue_stream"],
                  {"total_revenue": "revenue"})
    return sv.top_n(g, [F.col("total_revenue").desc(), "revenue_stream"], 1)


@register("peak_month", "month:d total_revenue:m", f"""
select month, sum(revenue) as total_revenue from m_monthly_revenue where {_in('month')}
group by month order by total_revenue desc, month limit 1""", "D-57")
def q_peak_month(spark, d):
    g = sv.rollup(sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END), ["month"], {"total_revenue": "revenue"})
    return sv.top_n(g, [F.col("total_revenue").desc(), "month"], 1)


# --- LTV -------------------------------------------------------------------------------

@register("ltv_kpi", "total_customers:i avg_ltv_6mo:m avg_contribution_ltv:m avg_gross_margin:r "
          "avg_contribution_margin:r", f"""
select sum(cohort_size) as total_customers,
       sum(avg_ltv_6mo * cohort_size) / nullif(sum(cohort_size), 0) as avg_ltv_6mo,
       sum(avg_contribution_ltv_6mo * cohort_size) / nullif(sum(cohort_size), 0) as avg_contribution_ltv,
       avg(cohort_gross_margin) as avg_gross_margin, avg(cohort_contribution_margin) as avg_contribution_margin
from m_customer_ltv where {_in('cohort_month', '1995-01-01', END)}""", "D-40")
def q_ltv_kpi(spark, d):
    c = sv.in_range(cohort_ltv(spark, d), "cohort_month", "1995-01-01", END)
    return c.agg(F.sum("cohort_size").alias("total_customers"),
                 safe_div(F.sum(F.col("avg_ltv_6mo") * F.col("cohort_size")), F.sum("cohort_size")).alias("avg_ltv_6mo"),
                 safe_div(F.sum(F.col("avg_contribution_ltv_6mo") * F.col("cohort_size")), F.sum("cohort_size"))
                 .alias("avg_contribution_ltv"),
                 F.avg("cohort_gross_margin").alias("avg_gross_margin"),
                 F.avg("cohort_contribution_margin").alias("avg_contribution_margin"))


@register("repeat_kpi", "total_customers:i repeat_rate:r has_repeat:f", f"""
with c as (select customer_id, max(months_since_first_order) > 0 as is_repeat from m_customer_cohorts
           where {_in('cohort_month', '1995-01-01', END)} group by 1)
select count(*) as total_customers, sum(case when is_repeat then 1 else 0 end) * 1.0 / count(*) as repeat_rate,
       avg(case when is_repeat then 1 else null end) as has_repeat from c""", "D-41")
def q_repeat_kpi(spark, d):
    co = sv.in_range(pc.cohorts_df(spark, d), "cohort_month", "1995-01-01", END)
    c = co.groupBy("customer_id").agg((F.max("months_since_first_order") > 0).alias("is_repeat"))
    return c.agg(F.count(F.lit(1)).alias("total_customers"),
                 (F.sum(F.when(F.col("is_repeat"), 1).otherwise(0)) * 1.0 / F.count(F.lit(1))).alias("repeat_rate"),
                 F.avg(F.when(F.col("is_repeat"), F.lit(1))).alias("has_repeat"))


@register("new_vs_repeat_monthly", "month:d buyer_type:s customer_count:i", f"""
select cast(date_trunc('month', order_date) as date) as month,
       case when months_since_first_order = 0 then 'New Customer' else 'Repeat Buyer' end as buyer_type,
       count(distinct customer_id) as customer_count
from m_customer_cohorts where {_in('order_date')} group by 1, 2""", "D-42")
def q_new_vs_repeat(spark, d):
    co = sv.in_range(pc.cohorts_df(spark, d), "order_date", START, END)
    return co.groupBy(month_start("order_date").alias("month"),
                      F.when(F.col("months_since_first_order") == 0, "New Customer").otherwise("Repeat Buyer")
                      .alias("buyer_type")).agg(F.count_distinct("customer_id").alias("customer_count"))


@register("cohort_repeat_rate", "cohort_month:d total_customers:i repeat_customers:i repeat_rate_pct:r "
          "months_to_second:f", f"""
select cohort_month, count(distinct customer_id) as total_customers,
       count(distinct case when months_since_first_order > 0 then customer_id end) as repeat_customers,
       count(distinct case when months_since_first_order > 0 then customer_id end) * 100.0
         / nullif(count(distinct customer_id), 0) as repeat_rate_pct,
       avg(case when months_since_first_order = 1 then months_since_first_order end) as months_to_second
from m_customer_cohorts where {_in('cohort_month', '1995-01-01', END)} group by 1""", "D-44")
def q_cohort_repeat(spark, d):
    co = sv.in_range(pc.cohorts_df(spark, d), "cohort_month", "1995-01-01", END)
    # two distinct counts over the same column: first reduce to one row per (cohort, customer)
    per = co.groupBy("cohort_month", "customer_id").agg(
        F.max(F.col("months_since_first_order") > 0).alias("rep"),
        F.sum(F.when(F.col("months_since_first_order") == 1, 1)).alias("n1"),
        F.count(F.when(F.col("months_since_first_order") == 1, 1)).alias("c1"))
    g = per.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(F.col("rep")).alias("repeat_customers"),
        F.sum("n1").alias("_n1"), F.sum("c1").alias("_c1"))
    return g.select("cohort_month", "total_customers", "repeat_customers",
                    safe_div(F.col("repeat_customers") * 100.0, F.col("total_customers")).alias("repeat_rate_pct"),
                    safe_div(F.col("_n1"), F.col("_c1")).alias("months_to_second"))


@register("profitability_by_cohort", "cohort_month:d total_gross_profit:m total_contribution_profit:m "
          "total_revenue:m gross_margin:r contribution_margin:r", f"""
select cohort_month, sum(gross_profit) as total_gross_profit, sum(contribution_profit) as total_contribution_profit,
       sum(net_revenue) as total_revenue, sum(gross_profit) / nullif(sum(net_revenue), 0) as gross_margin,
       sum(contribution_profit) / nullif(sum(net_revenue), 0) as contribution_margin
from m_customer_cohorts where {_in('cohort_month', '1995-01-01', END)} group by 1""", "D-45")
def q_profit_by_cohort(spark, d):
    co = sv.in_range(pc.cohorts_df(spark, d), "cohort_month", "1995-01-01", END)
    return sv.rollup(co, ["cohort_month"], {"total_gross_profit": "gross_profit",
                                            "total_contribution_profit": "contribution_profit",
                                            "total_revenue": "net_revenue"},
                     {"gross_margin": ("gross_profit", "net_revenue"),
                      "contribution_margin": ("contribution_profit", "net_revenue")})


# --- wholesale -----------------------------------------------------------------------------

@register("revenue_by_customer", "customer_name:s company:s state:s total_revenue:m invoice_count:i total_units:f", f"""
select customer_name, coalesce(company_name, customer_name) as company, state, sum(amount) as total_revenue,
       count(distinct invoice_id) as invoice_count, sum(quantity) as total_units
from m_wholesale_detail where {_in('txn_date')} group by 1, 2, 3""", "D-59")
def q_rev_by_customer(spark, d):
    w = sv.in_range(wholesale(spark, d), "txn_date", START, END)
    return w.groupBy("customer_name", F.coalesce("company_name", "customer_name").alias("company"), "state").agg(
        F.sum("amount").alias("total_revenue"), F.count_distinct("invoice_id").alias("invoice_count"),
        F.sum("quantity").alias("total_units"))


@register("wholesale_top_products", "item_name:s total_quantity:f total_revenue:m avg_price:m", f"""
select item_name, sum(quantity) as total_quantity, sum(amount) as total_revenue, avg(unit_price) as avg_price
from m_wholesale_detail where item_name is not null and {_in('txn_date')} group by item_name
order by total_revenue desc, item_name limit 20""", "D-60")
def q_top_products(spark, d):
    w = sv.in_range(wholesale(spark, d), "txn_date", START, END).where(F.col("item_name").isNotNull())
    g = sv.rollup(w, ["item_name"], {"total_quantity": "quantity", "total_revenue": "amount"},
                  extra=[F.avg("unit_price").alias("avg_price")])
    return sv.top_n(g, [F.col("total_revenue").desc(), "item_name"], 20)


@register("wholesale_monthly_trend", "month:d revenue:m invoice_count:i customer_count:i", f"""
select cast(date_trunc('month', txn_date) as date) as month, sum(amount) as revenue,
       count(distinct invoice_id) as invoice_count, count(distinct customer_name) as customer_count
from m_wholesale_detail where {_in('txn_date')} group by 1""", "D-61")
def q_wholesale_trend(spark, d):
    w = sv.in_range(wholesale(spark, d), "txn_date", START, END)
    return w.groupBy(month_start("txn_date").alias("month")).agg(
        F.sum("amount").alias("revenue"), F.count_distinct("invoice_id").alias("invoice_count"),
        F.count_distinct("customer_name").alias("customer_count"))


@register("outstanding_invoices", "invoice_id:s txn_date:d customer_name:s company_name:s invoice_total:m "
          "invoice_balance:m txn_status:s", f"""
select invoice_id, txn_date, customer_name, company_name, invoice_total, invoice_balance, txn_status
from m_wholesale_detail where invoice_balance > 0 and {_in('txn_date')} group by 1, 2, 3, 4, 5, 6, 7""", "D-62")
def q_outstanding(spark, d):
    w = sv.in_range(wholesale(spark, d), "txn_date", START, END).where(F.col("invoice_balance") > 0)
    return w.select("invoice_id", "txn_date", "customer_name", "company_name", "invoice_total", "invoice_balance",
                    "txn_status").dropDuplicates()


@register("outstanding_total", "outstanding_balance:m", f"""
select sum(invoice_balance) as outstanding_balance from m_wholesale_detail
where invoice_balance > 0 and {_in('txn_date')}""", "D-64")
def q_outstanding_total(spark, d):
    """Summed per line, as the source page does (an invoice with n lines counts n times, R-13)."""
    w = sv.in_range(wholesale(spark, d), "txn_date", START, END).where(F.col("invoice_balance") > 0)
    return w.agg(F.sum("invoice_balance").alias("outstanding_balance"))


# --- affiliates ---------------------------------------------------------------------------------

AFF_START, AFF_END = EV_START[:8] + "01", "2024-12-31"


@register("partner_totals", "partner_name:s total_revenue:m total_transactions:i months_active:i "
          "avg_monthly_revenue:m first_month:d last_month:d", f"""
select partner_name, sum(revenue) as total_revenue, sum(transaction_count) as total_transactions,
       count(distinct month) as months_active, sum(revenue) / count(distinct month) as avg_monthly_revenue,
       min(month) as first_month, max(month) as last_month
from m_affiliate_by_partner where {_in('month', AFF_START, AFF_END)} group by partner_name""", "D-08")
def q_partner_totals(spark, d):
    a = sv.in_range(affiliates(spark, d, (AFF_START, AFF_END)), "month", AFF_START, AFF_END)
    g = a.groupBy("partner_name").agg(F.sum("revenue").alias("total_revenue"),
                                      F.sum("transaction_count").alias("total_transactions"),
                                      F.count_distinct("month").alias("months_active"),
                                      F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    return g.select("partner_name", "total_revenue", "total_transactions", "months_active",
                    (F.col("total_revenue") / F.col("months_active")).alias("avg_monthly_revenue"),
                    "first_month", "last_month")


@register("affiliate_channel_split", "payment_channel:s total_revenue:m total_transactions:i", f"""
select payment_channel, sum(revenue) as total_revenue, sum(transaction_count) as total_transactions
from m_affiliate_by_partner where {_in('month', AFF_START, AFF_END)} group by 1""", "D-12")
def q_channel_split(spark, d):
    a = sv.in_range(affiliates(spark, d, (AFF_START, AFF_END)), "month", AFF_START, AFF_END)
    return sv.rollup(a, ["payment_channel"], {"total_revenue": "revenue", "total_transactions": "transaction_count"})


# --- attribution survey -------------------------------------------------------------------------------

# Survey answer classes, first match wins (fixed values; the store's own podcast answer uses the
# per-deployment brand name, here the neutral "House Brand")
SURVEY_CLASSES = [("Search Engine", "like", "Search Engine%"), ("Social Media", "like", "Social Media%"),
                  ("Brand Podcast", "like", "House Brand Podcast%"), ("Influencer", "like", "From an Influencer%"),
                  ("Word of Mouth", "eq", "Friend or Family"), ("Other Community", "like", "%other%")]


def survey_class(col):
    expr = None
    for label, op, pat in SURVEY_CLASSES:
        cond = col.like(pat) if op == "like" else (col == pat)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("Other")


def _survey_class_sql(col="how_did_you_hear"):
    parts = [f"when {col} like '{p}' then '{lab}'" if op == "like" else f"when {col} = '{p}' then '{lab}'"
             for lab, op, p in SURVEY_CLASSES]
    return "case " + " ".join(parts) + " else 'Other' end"


def survey_in_range(spark, d):
    s = R.survey_responses(spark, d)
    return s.where(F.col("responded_at").cast("date").between(F.lit(EV_START).cast("date"), F.lit(EV_END).cast("date")))


_SURVEY_WHERE = f"cast(responded_at as date) >= date '{EV_START}' and cast(responded_at as date) <= date '{EV_END}'"


@register("survey_mix", "channel_category:s responses:i", f"""
select {_survey_class_sql()} as channel_category, count(*) as responses from r_survey
where {_SURVEY_WHERE} group by 1""", "D-15")
def q_survey_mix(spark, d):
    s = survey_in_range(spark, d)
    return s.groupBy(survey_class(F.col("how_did_you_hear")).alias("channel_category")).agg(
        F.count(F.lit(1)).alias("responses"))


@register("survey_over_time", "week:d channel_category:s response_count:i", f"""
select cast(date_trunc('week', cast(responded_at as date)) as date) as week, {_survey_class_sql()} as channel_category,
       count(*) as response_count
from r_survey where {_SURVEY_WHERE} group by 1, 2""", "D-16")
def q_survey_time(spark, d):
    s = survey_in_range(spark, d)
    return s.groupBy(monday_week(F.col("responded_at").cast("date")).alias("week"),
                     survey_class(F.col("how_did_you_hear")).alias("channel_category")).agg(
        F.count(F.lit(1)).alias("response_count"))


@register("survey_kpi", "total_responses:i pct_search:r pct_podcast_influencer:r pct_wom_other:r", f"""
select count(*) as total_responses,
       sum(case when how_did_you_hear like 'Search Engine%' then 1 else 0 end) * 1.0 / count(*) as pct_search,
       sum(case when how_did_you_hear like 'House Brand Podcast%' or how_did_you_hear like 'From an Influencer%'
                then 1 else 0 end) * 1.0 / count(*) as pct_podcast_influencer,
       sum(case when how_did_you_hear = 'Friend or Family' or how_did_you_hear like '%other%' then 1 else 0 end)
         * 1.0 / count(*) as pct_wom_other
from r_survey where {_SURVEY_WHERE}""", "D-14")
def q_survey_kpi(spark, d):
    s = survey_in_range(spark, d)
    h = F.col("how_did_you_hear")
    n = F.count(F.lit(1))
    share = lambda cond: F.try_divide(F.sum(F.when(cond, 1).otherwise(0)) * 1.0, n)
    return s.agg(n.alias("total_responses"), share(h.like("Search Engine%")).alias("pct_search"),
                 share(h.like("House Brand Podcast%") | h.like("From an Influencer%")).alias("pct_podcast_influencer"),
                 share((h == "Friend or Family") | h.like("%other%")).alias("pct_wom_other"))


@register("channel_comparison", "channel:s survey_responses:i survey_pct:f avg_order_value:m", f"""
with s as (select {_survey_class_sql()} as channel, count(*) as survey_count, avg(order_total) as avg_order_value
           from r_survey where {_SURVEY_WHERE} group by 1),
t as (select sum(survey_count) as t from s)
select s.channel, s.survey_count as survey_responses, {R2('s.survey_count * 100.0 / t.t', 1)} as survey_pct,
       s.avg_order_value
from s cross join t""", "D-19")
def q_channel_comparison(spark, d):
    s = survey_in_range(spark, d)
    g = s.groupBy(survey_class(F.col("how_did_you_hear")).alias("channel")).agg(
        F.count(F.lit(1)).alias("survey_responses"), F.avg("order_total").alias("avg_order_value"))
    return sv.share_of_total(g, "survey_responses", "survey_pct")


# --- pipeline health and digest ------------------------------------------------------------------------------

def _runs(spark, d):
    r = R.run_log(spark, d)
    return r.withColumn("run_date", F.col("started_at").cast("date"))


_RUNS_SQL = "(select *, cast(started_at as date) as run_date from r_run_log)"
_RUNS_TODAY = RUNS_AS_OF[:10]


@register("pipeline_daily_failures", "run_date:d failures:i successes:i", f"""
select run_date, count(*) filter (where status = 'error' and pipeline_name != 'dbt') as failures,
       count(*) filter (where status = 'success' and pipeline_name != 'dbt') as successes
from {_RUNS_SQL} r where run_date >= date '{_RUNS_TODAY}' - interval 30 day group by run_date""", "D-46")
def q_daily_failures(spark, d):
    r = _runs(spark, d).where(F.col("run_date") >= F.date_sub(F.lit(_RUNS_TODAY).cast("date"), 30))
    nd = F.col("pipeline_name") != "dbt"
    return r.groupBy("run_date").agg(F.count_if((F.col("status") == "error") & nd).alias("failures"),
                                     F.count_if((F.col("status") == "success") & nd).alias("successes"))


@register("pipeline_rates", "pipeline_name:s total_runs:i successes:i failures:i success_rate:f", f"""
select pipeline_name, count(*) as total_runs, count(*) filter (where status = 'success') as successes,
       count(*) filter (where status = 'error') as failures,
       {R2("100.0 * count(*) filter (where status = 'success') / count(*)", 1)} as success_rate
from {_RUNS_SQL} r where run_date >= date '{_RUNS_TODAY}' - interval 30 day and pipeline_name != 'dbt'
group by pipeline_name""", "D-47")
def q_pipeline_rates(spark, d):
    r = _runs(spark, d).where((F.col("run_date") >= F.date_sub(F.lit(_RUNS_TODAY).cast("date"), 30))
                              & (F.col("pipeline_name") != "dbt"))
    ok = F.count_if(F.col("status") == "success")
    return r.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("total_runs"), ok.alias("successes"),
        F.count_if(F.col("status") == "error").alias("failures"),
        round_half_away(ok * 100.0 / F.count(F.lit(1)), 1).alias("success_rate"))


@register("recent_failures", "started_at:t pipeline_name:s duration_seconds:f error_message:s", f"""
select started_at, pipeline_name, {R2('duration_seconds', 0)} as duration_seconds, error_message
from r_run_log where status = 'error' order by started_at desc, run_id desc limit 25""", "D-48")
def q_recent_failures(spark, d):
    r = R.run_log(spark, d).where(F.col("status") == "error")
    top = sv.top_n(r, [F.col("started_at").desc(), F.col("run_id").desc()], 25)
    return top.select("started_at", "pipeline_name", round_half_away("duration_seconds", 0).alias("duration_seconds"),
                      "error_message")


@register("transform_health", "run_date:d status:s duration_seconds:f error_message:s", f"""
select run_date, status, {R2('duration_seconds', 0)} as duration_seconds, error_message
from {_RUNS_SQL} r where pipeline_name = 'dbt' order by run_date desc, started_at desc, run_id desc limit 30""", "D-49")
def q_dbt_health(spark, d):
    r = _runs(spark, d).where(F.col("pipeline_name") == "dbt")
    top = sv.top_n(r, [F.col("run_date").desc(), F.col("started_at").desc(), F.col("run_id").desc()], 30)
    return top.select("run_date", "status", round_half_away("duration_seconds", 0).alias("duration_seconds"),
                      "error_message")


@register("digest_latest_runs", "pipeline_name:s status:s rows_loaded:i duration_seconds:f error_message:s "
          "started_at:t", f"""
select pipeline_name, status, rows_loaded, {R2('duration_seconds', 1)} as duration_seconds, error_message, started_at
from (select *, row_number() over (partition by pipeline_name
                                   order by started_at desc, status desc, rows_loaded desc, duration_seconds desc,
                                            error_message desc, run_id desc) as rn
      from r_run_log where started_at >= timestamp '{RUNS_AS_OF}' - interval 24 hour and pipeline_name != 'dbt') x
where rn = 1""", "O-02")
def q_latest_runs(spark, d):
    return rl.latest_runs(R.run_log(spark, d), RUNS_AS_OF)


@register("digest_success_trend", "pipeline_name:s total_runs:i successes:i failures:i success_rate:f warning:b", f"""
select *, coalesce(success_rate, 0) < 80 as warning from (
select pipeline_name, count(*) as total_runs, count_if(status = 'success') as successes,
       count_if(status = 'error') as failures,
       {R2("100.0 * count_if(status = 'success') / count(*)", 0)} as success_rate
from r_run_log where started_at >= timestamp '{RUNS_AS_OF}' - interval 30 day and pipeline_name != 'dbt'
group by pipeline_name) t""", "O-03")
def q_success_trend(spark, d):
    return rl.digest_flags(rl.success_trend(R.run_log(spark, d), RUNS_AS_OF))


@register("digest_transform_rate", "total_runs:i successes:i success_rate:f", f"""
select count(*) as total_runs, count_if(status = 'success') as successes,
       {R2("100.0 * count_if(status = 'success') / nullif(count(*), 0)", 0)} as success_rate
from r_run_log where started_at >= timestamp '{RUNS_AS_OF}' - interval 30 day and pipeline_name = 'dbt'""", "O-04")
def q_transform_rate(spark, d):
    return rl.success_trend(R.run_log(spark, d), RUNS_AS_OF, transform=True)


@register("pipeline_runs_extract", "run_date:d pipeline_name:s status:s rows_loaded:i duration_seconds:f "
          "error_message:s started_at:t", f"""
select cast(started_at as date) as run_date, pipeline_name, status, rows_loaded,
       {R2('duration_seconds', 1)} as duration_seconds, nullif(error_message, '') as error_message, started_at
from r_run_log where started_at >= timestamp '{RUNS_AS_OF}' - interval 90 day""", "X-13")
def q_runs_extract(spark, d):
    r = R.run_log(spark, d).where(F.col("started_at") >= F.lit(RUNS_AS_OF).cast("timestamp") - F.expr("INTERVAL 90 DAYS"))
    return sv.extract(r, [F.col("started_at").cast("date").alias("run_date"), "pipeline_name", "status", "rows_loaded",
                          round_half_away("duration_seconds", 1).alias("duration_seconds"),
                          F.nullif(F.col("error_message"), F.lit("")).alias("error_message"), "started_at"])


@register("paid_campaign_daily", "report_date:d platform:s campaign_id:s campaign_name:s adset_name:s impressions:i "
          "clicks:i spend:m cpc:r ctr:r conversions:f conversion_value:m", """
select report_date, platform, campaign_id, campaign_name, adset_name, impressions, clicks, spend, cpc, ctr,
       conversions, conversion_value from m_daily_performance""", "X-11")
def q_paid_campaign_daily(spark, d):
    return sv.extract(daily_performance(spark, d), ["report_date", "platform", "campaign_id", "campaign_name",
                                                    "adset_name", "impressions", "clicks", "spend", "cpc", "ctr",
                                                    "conversions", "conversion_value"])


# --- range listings and the remaining page shapes --------------------------------------------------

_LISTINGS = [  # (query name, id, mart, date column, start, end)
    ("affiliate_data", "D-07", "affiliate_by_partner", "month", AFF_START, AFF_END),
    ("d2c_pnl_listing", "D-20", "d2c_monthly_pnl", "month", START, END),
    ("expenses_enriched_listing", "D-25", "expense_enriched", "month", START, END),
    ("vendors_listing", "D-27", "expense_by_vendor", "month", START, END),
    ("pnl_listing", "D-35", "monthly_pnl", "month", START, END),
    ("revenue_listing", "D-36", "monthly_revenue", "month", START, END),
    ("cohort_ltv_trend", "D-43", "customer_ltv", "cohort_month", "1995-01-01", END),
    ("wholesale_listing", "D-58", "wholesale_detail", "txn_date", START, END),
    ("revenue_page_revenue", "D-50", "monthly_revenue", "month", START, END),
    ("revenue_page_pnl", "D-51", "monthly_pnl", "month", START, END),
]


_MONTHLY = {"affiliate_by_partner": affiliates, "d2c_monthly_pnl": pc.monthly_pnl_df, "monthly_pnl": monthly_pnl,
            "monthly_revenue": pf.revenue_df}  # marts whose months stand alone: their feeds are cut to the page's months


def _listing(mart, col, a, b):
    if mart in _MONTHLY:
        return lambda spark, d: sv.in_range(_MONTHLY[mart](spark, d, (a, b)), col, a, b)
    return lambda spark, d: sv.in_range(QUERIES[mart].build(spark, d), col, a, b)


for _n, _id, _mart, _col, _a, _b in _LISTINGS:
    register(_n, QUERIES[_mart].spec, f"select * from m_{_mart} where {_in(_col, _a, _b)}", _id)(
        _listing(_mart, _col, _a, _b))

register("subscriptions_listing", pf.SUB_SPEC, "select * from m_subscription_analysis", "D-26")(subscriptions)


@register("current_month", "total_revenue:m operating_expenses:m operating_income:m operating_margin:r "
          "owner_compensation:m", f"""
select total_revenue, operating_expenses, operating_income, operating_margin, owner_compensation
from m_monthly_pnl where month = cast(date_trunc('month', date '{END}') as date)""", "D-38")
def q_current_month(spark, d):
    p = monthly_pnl(spark, d, (END, END)).where(F.col("month") == F.trunc(F.lit(END).cast("date"), "MM"))
    return p.select("total_revenue", "operating_expenses", "operating_income", "operating_margin",
                    "owner_compensation")


@register("retail_breakdown", "month:d revenue_stream:s revenue:m", f"""
select month, revenue_stream, revenue from m_monthly_revenue
where revenue_stream in ('Wholesale', 'Shopify', 'Amazon') and {_in('month')}""", "D-52")
def q_retail_breakdown(spark, d):
    r = sv.in_range(pf.revenue_df(spark, d, PAGE), "month", START, END)
    return r.where(F.col("revenue_stream").isin("Wholesale", "Shopify", "Amazon")).select(
        "month", "revenue_stream", "revenue")


@register("monthly_by_partner", "month:d partner_name:s revenue:m", f"""
select month, partner_name, sum(revenue) as revenue from m_affiliate_by_partner
where {_in('month', AFF_START, AFF_END)} group by 1, 2""", "D-09")
def q_monthly_by_partner(spark, d):
    return sv.rollup(sv.in_range(affiliates(spark, d, (AFF_START, AFF_END)), "month", AFF_START, AFF_END), ["month", "partner_name"],
                     {"revenue": "revenue"})


UNIDENTIFIED = ("Unidentified", "Unknown (Mobile Deposit)")


@register("top_partners_monthly", "month:d partner_name:s revenue:m", f"""
select month, partner_name, sum(revenue) as revenue from m_affiliate_by_partner
where partner_name not in ('Unidentified', 'Unknown (Mobile Deposit)') and {_in('month', AFF_START, AFF_END)}
group by 1, 2""", "D-10")
def q_top_partners_monthly(spark, d):
    a = sv.in_range(affiliates(spark, d, (AFF_START, AFF_END)), "month", AFF_START, AFF_END).where(~F.col("partner_name").isin(*UNIDENTIFIED))
    return sv.rollup(a, ["month", "partner_name"], {"revenue": "revenue"})


@register("affiliate_monthly_totals", "month:d total_revenue:m total_transactions:i active_partners:i", f"""
select month, sum(revenue) as total_revenue, sum(transaction_count) as total_transactions,
       count(distinct partner_name) as active_partners
from m_affiliate_by_partner where {_in('month', AFF_START, AFF_END)} group by 1""", "D-11")
def q_affiliate_totals(spark, d):
    a = sv.in_range(affiliates(spark, d, (AFF_START, AFF_END)), "month", AFF_START, AFF_END)
    return a.groupBy("month").agg(F.sum("revenue").alias("total_revenue"),
                                  F.sum("transaction_count").alias("total_transactions"),
                                  F.count_distinct("partner_name").alias("active_partners"))


_AFF_KPI_SQL = f"""
select sum(case when {_in('month', '2024-01-01', '2024-12-31')} then revenue else 0 end) as ytd_revenue,
       sum(case when {_prior12('month', '2024-01-01')} then revenue else 0 end) as prior_revenue,
       sum(case when {_in('month', '2024-01-01', '2024-12-31')}
                 and partner_name not in ('Unidentified', 'Unknown (Mobile Deposit)') then revenue else 0 end)
           as identified_revenue,
       sum(case when {_prior12('month', '2024-01-01')}
                 and partner_name not in ('Unidentified', 'Unknown (Mobile Deposit)') then revenue else 0 end)
           as prior_identified_revenue,
       sum(case when {_in('month', '2024-01-01', '2024-12-31')}
                 and partner_name in ('Unidentified', 'Unknown (Mobile Deposit)') then revenue else 0 end)
           as unidentified_revenue,
       count(distinct case when {_in('month', '2024-01-01', '2024-12-31')}
                 and partner_name not in ('Unidentified', 'Unknown (Mobile Deposit)') then partner_name end)
           as identified_partners
from m_affiliate_by_partner where month >= date '2024-01-01' - interval 12 month and month <= date '2024-12-31'"""


@register("affiliate_kpi_comparison", "ytd_revenue:m prior_revenue:m identified_revenue:m "
          "prior_identified_revenue:m unidentified_revenue:m identified_partners:i", _AFF_KPI_SQL, "D-13")
def q_affiliate_kpi(spark, d):
    a = affiliates(spark, d, ("2023-01-01", "2024-12-31"))
    cur = sv.current_period("month", "2024-01-01", "2024-12-31")
    pri = sv.prior_months("month", "2024-01-01", 12)
    ident = ~F.col("partner_name").isin(*UNIDENTIFIED)
    win = (F.col("month") >= F.lit("2023-01-01").cast("date")) & (F.col("month") <= F.lit("2024-12-31").cast("date"))
    return sv.period_compare(a, [("ytd_revenue", "sum", "revenue", cur), ("prior_revenue", "sum", "revenue", pri),
                                 ("identified_revenue", "sum", "revenue", cur & ident),
                                 ("prior_identified_revenue", "sum", "revenue", pri & ident),
                                 ("unidentified_revenue", "sum", "revenue", cur & ~ident),
                                 ("identified_partners", "count_distinct", "partner_name", cur & ident)], where=win)


@register("survey_aov", "channel_category:s responses:i avg_order_value:m total_revenue:m", f"""
select {_survey_class_sql()} as channel_category, count(*) as responses, avg(order_total) as avg_order_value,
       sum(order_total) as total_revenue
from r_survey where {_SURVEY_WHERE} group by 1""", "D-17")
def q_survey_aov(spark, d):
    s = survey_in_range(spark, d)
    return s.groupBy(survey_class(F.col("how_did_you_hear")).alias("channel_category")).agg(
        F.count(F.lit(1)).alias("responses"), F.avg("order_total").alias("avg_order_value"),
        F.sum("order_total").alias("total_revenue"))


@register("ga4_channel_orders", "channel:s attributed_orders:i attributed_revenue:m", f"""
select channel, sum(orders) as attributed_orders, sum(revenue) as attributed_revenue
from m_channel_summary where {_in('report_date', EV_START, EV_END)} group by 1""", "D-18")
def q_ga4_channel_orders(spark, d):
    cs = sv.in_range(channel_summary(spark, d), "report_date", EV_START, EV_END)
    return sv.rollup(cs, ["channel"], {"attributed_orders": "orders", "attributed_revenue": "revenue"})


@register("wholesale_kpi_comparison", "total_revenue:m prior_total_revenue:m invoice_count:i prior_invoice_count:i "
          "active_customers:i", f"""
select sum(case when {_in('txn_date')} then amount else 0 end) as total_revenue,
       sum(case when {_prior12('txn_date')} then amount else 0 end) as prior_total_revenue,
       count(distinct case when {_in('txn_date')} then invoice_id end) as invoice_count,
       count(distinct case when {_prior12('txn_date')} then invoice_id end) as prior_invoice_count,
       count(distinct case when {_in('txn_date')} then customer_name end) as active_customers
from m_wholesale_detail where txn_date >= date '{START}' - interval 12 month and txn_date <= date '{END}'""", "D-63")
def q_wholesale_kpi(spark, d):
    w = wholesale(spark, d)
    cur = sv.current_period("txn_date", START, END)
    pri = sv.prior_months("txn_date", START, 12)
    win = (F.col("txn_date") >= F.add_months(F.lit(START).cast("date"), -12)) & \
        (F.col("txn_date") <= F.lit(END).cast("date"))
    return sv.period_compare(w, [("total_revenue", "sum", "amount", cur), ("prior_total_revenue", "sum", "amount", pri),
                                 ("invoice_count", "count_distinct", "invoice_id", cur),
                                 ("prior_invoice_count", "count_distinct", "invoice_id", pri),
                                 ("active_customers", "count_distinct", "customer_name", cur)], where=win)
