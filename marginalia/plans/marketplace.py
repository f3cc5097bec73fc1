"""Marketplace queries (S-01, S-04, A-01, A-04, T-02) over the bench roles."""

from __future__ import annotations

from marginalia.operators import commerce as cm
from marginalia.operators import staging as st
from marginalia.plans.catalog import register, sql_model
from marginalia.sources import roles as R


def ad_spend_df(spark, d):
    return st.stage(R.market_ads(spark, d), "amazon__ad_spend")


def daily_orders_df(spark, d):
    return cm.marketplace_daily_orders(st.orders_clean(R.market_orders(spark, d)))


sql_model("m_market_ad_spend", """
with s as (select date, advertised_asin as asin, cast(cost as double) as cost, cast(impressions as bigint) as impressions,
                  cast(clicks as bigint) as clicks, cast(sales14d as double) as sales14d, _loaded_at,
                  dense_rank() over (partition by date, advertised_asin order by _loaded_at desc) as dr
           from r_market_ads)
select date, asin, coalesce(cost, 0) as cost, impressions, clicks, sales14d as ad_sales from s where dr = 1""")

sql_model("m_market_daily_ad_spend", """
select date, asin, sum(cost) as cost, sum(impressions) as impressions, sum(clicks) as clicks, sum(ad_sales) as ad_sales
from m_market_ad_spend group by 1, 2""")

sql_model("m_market_orders_clean", """
with p as (select distinct sku, asin, currency, cast(coalesce(quantity, '0') as decimal(38,9)) as quantity,
                  cast(coalesce(item_price, '0') as decimal(38,9)) as item_price, item_status, order_status,
                  cast(purchase_date as timestamp) as purchase_date, amazon_order_id,
                  cast(coalesce(item_promotion_discount, '0') as decimal(38,9)) as item_promotion_discount
           from r_market_orders where order_status != 'Cancelled' and item_status != 'Cancelled'),
c as (select *, item_price * case currency when 'MXN' then cast(0.054 as decimal(10,4))
                                           when 'CAD' then cast(0.72 as decimal(10,4)) else cast(1 as decimal(10,4)) end
                   as corrected_item_price,
             item_promotion_discount * case currency when 'MXN' then cast(0.054 as decimal(10,4))
                                           when 'CAD' then cast(0.72 as decimal(10,4)) else cast(1 as decimal(10,4)) end
                   as corrected_item_promotion_discount
      from p)
select *, corrected_item_price - corrected_item_promotion_discount as sales from c""")

sql_model("m_market_daily_orders", """
select cast(purchase_date as date) as purchase_date_utc, asin, sum(quantity) as quantity, sum(item_price) as item_price,
       sum(item_promotion_discount) as item_promotion_discount, sum(sales) as sales
from m_market_orders_clean group by 1, 2""")

AD_SPEC = "date:d asin:s cost:m impressions:i clicks:i ad_sales:m"


@register("marketplace_daily_ad_spend", AD_SPEC, "select * from m_market_daily_ad_spend", "A-01")
def q_ad_spend(spark, d):
    return cm.marketplace_daily_ad_spend(ad_spend_df(spark, d))


ORD_SPEC = "purchase_date_utc:d asin:s quantity:f item_price:m item_promotion_discount:m sales:m"


@register("marketplace_daily_orders", ORD_SPEC, "select * from m_market_daily_orders", "A-04")
def q_daily_orders(spark, d):
    return daily_orders_df(spark, d)


PROFIT_SPEC = ("purchase_date_utc:d asin:s quantity:f item_price:m item_promotion_discount:m impressions:i clicks:i "
               "ad_sales:m sales:m ad_cost:m total_cogs:m cogs:m fba_cost:m total_fba_cost:m selling_fees:m "
               "refunds:m shipping_fees:m title:s category:s subcategory:s sku:s total_costs:m contribution:m")


@register("marketplace_daily_profitability", PROFIT_SPEC, """
with j as (
    select o.purchase_date_utc, o.asin, o.quantity, o.item_price, o.item_promotion_discount, a.impressions, a.clicks,
           a.ad_sales, o.sales, coalesce(a.cost, 0) as ad_cost, pm.cogs * o.quantity as total_cogs, pm.cogs,
           pm.fba_cost, pm.fba_cost * o.quantity as total_fba_cost, o.sales * 0.15 as selling_fees,
           o.sales * 0.03 as refunds, o.sales * 0.01 as shipping_fees, pm.title, pm.category, pm.subcategory, pm.sku
    from m_market_daily_orders o
    left join m_market_daily_ad_spend a on o.purchase_date_utc = a.date and o.asin = a.asin
    left join r_market_costs pm on o.asin = pm.asin)
select *, total_cogs + total_fba_cost + ad_cost + selling_fees + refunds + shipping_fees as total_costs,
       sales - (total_cogs + total_fba_cost + ad_cost + selling_fees + refunds + shipping_fees) as contribution
from j""", "T-02")
def q_profitability(spark, d):
    ads = cm.marketplace_daily_ad_spend(ad_spend_df(spark, d))
    return cm.marketplace_daily_profitability(daily_orders_df(spark, d), ads, R.market_costs(spark, d))
