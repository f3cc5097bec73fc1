"""Finance queries (F-01..F-08) over the bench roles."""

from __future__ import annotations

from marginalia.operators import finance as fin
from marginalia.plans.catalog import register, sql_model
from marginalia.sources import roles as R


# A ``period`` (start, end) keeps whole months, and its range reaches the scans of the feeds.

def revenue_df(spark, d, period=None):
    return fin.monthly_revenue(R.invoices(spark, d, period), R.deposits(spark, d, period))


def expenses_df(spark, d, period=None):
    return fin.monthly_expenses(R.purchase_lines(spark, d, period), R.accounts(spark, d))


def pnl_df(spark, d, period=None):
    return fin.monthly_pnl(revenue_df(spark, d, period), expenses_df(spark, d, period))


def affiliates_df(spark, d, period=None):
    """Wallet transactions are matched by id, whatever their date, so only the deposits are cut to the period."""
    return fin.affiliate_by_partner(R.deposits(spark, d, period), R.wallet_transactions(spark, d))


def by_vendor_df(spark, d):
    return fin.expense_by_vendor(R.purchase_lines(spark, d))


# A table of rules over three texts of a deposit (the summary as it is, summary and memo in lower case); the lowest number wins.
sql_model("m_monthly_revenue", """
with rules as (
    select * from (values
        (1, 'Operating Checking', 'memo', '%amazon%', 'Amazon'),
        (2, null, 'as written', '%Shopify%', 'Shopify'),
        (3, 'Operating Checking', 'memo', '%shopify%', 'Shopify'),
        (4, null, 'as written', 'Affiliate Revenue', 'Affiliate'),
        (5, 'PayPal balance account', 'memo', '%', 'Affiliate'),
        (6, null, 'summary', '%sponsor%', 'Sponsorship'), (7, null, 'memo', '%sponsor%', 'Sponsorship'),
        (8, null, 'summary', '%partnership%', 'Sponsorship'), (9, null, 'memo', '%partnership%', 'Sponsorship')
    ) t(no, account, field, pattern, stream)),
said as (
    select n, txn_date, total_amount, account, unnest(texts) as t
    from (select row_number() over () as n, txn_date, total_amount, deposit_to_account_name as account,
                 [{'field': 'as written', 'text': coalesce(source_summary, '')},
                  {'field': 'summary', 'text': lower(coalesce(source_summary, ''))},
                  {'field': 'memo', 'text': lower(coalesce(memo, ''))}] as texts from r_deposits)),
income as (
    select any_value(txn_date) as txn_date, any_value(total_amount) as amount, arg_min(r.stream, r.no) as revenue_stream
    from said join rules r on r.field = t.field and t.text like r.pattern and coalesce(r.account, said.account, '') = coalesce(said.account, '')
    group by n
    union all
    select txn_date, total_amount, 'Wholesale' from r_invoices where list_contains(['Paid', 'Partial', 'Open'], txn_status))
select cast(date_trunc('month', txn_date) as date) as month, revenue_stream, sum(amount) as revenue, count(*) as transaction_count
from income where txn_date is not null group by 1, 2""")

REV_SPEC = "month:d revenue_stream:s revenue:m transaction_count:i"


@register("monthly_revenue", REV_SPEC, "select * from m_monthly_revenue", "F-01")
def q_monthly_revenue(spark, d):
    return revenue_df(spark, d)


sql_model("m_monthly_expenses", """
with chart as (
    select account_id, {'name': name, 'kind': account_type, 'sub': account_sub_type} as account from r_accounts where classification = 'Expense')
select date_trunc('month', txn_date)::date as month, coalesce(account.name, account_name) as expense_category, account.kind as account_type,
       account.sub as account_sub_type, list_contains(['PayrollWageExpenses', 'PayrollExpenses', 'PayrollTaxExpenses'], account.sub) as is_owner_compensation,
       sum(amount) as total_amount, count(*) as transaction_count
from r_purchase_lines join chart using (account_id)
where txn_date is not null and coalesce(account.name, account_name) is not null group by all""")

EXP_SPEC = ("month:d expense_category:s account_type:s account_sub_type:s is_owner_compensation:b "
            "total_amount:m transaction_count:i")


@register("monthly_expenses", EXP_SPEC, "select * from m_monthly_expenses", "F-02")
def q_monthly_expenses(spark, d):
    return expenses_df(spark, d)


PNL_SPEC = ("month:d total_revenue:m retail_revenue:m wholesale_revenue:m shopify_revenue:m amazon_revenue:m "
            "affiliate_revenue:m sponsorship_revenue:m total_expenses:m operating_expenses:m owner_compensation:m "
            "net_income:m operating_income:m operating_margin:r")


@register("monthly_pnl", PNL_SPEC, """
with book as (  -- income by stream and expenses by kind in one table, expenses negative
    select month, revenue_stream as entry, revenue as amount from m_monthly_revenue
    union all
    select month, case is_owner_compensation when true then 'owner' when false then 'operating' else 'unflagged' end, -total_amount from m_monthly_expenses),
m as (
    select month, coalesce(sum(amount) filter (entry not in ('owner', 'operating', 'unflagged')), 0) as income,
           coalesce(-sum(amount) filter (entry in ('owner', 'operating', 'unflagged')), 0) as spent,
           map(list(entry), list(amount)) as by_entry
    from (select month, entry, sum(amount) as amount from book group by all) group by month),
named as (
    select month, income, spent, coalesce(by_entry['Wholesale'], 0) as wholesale, coalesce(by_entry['Shopify'], 0) as shopify, coalesce(by_entry['Amazon'], 0) as amazon,
           coalesce(by_entry['Affiliate'], 0) as affiliate, coalesce(by_entry['Sponsorship'], 0) as sponsorship, -coalesce(by_entry['operating'], 0) as running,
           -coalesce(by_entry['owner'], 0) as owner from m)
select month, income as total_revenue, wholesale + shopify + amazon as retail_revenue, wholesale as wholesale_revenue, shopify as shopify_revenue,
       amazon as amazon_revenue, affiliate as affiliate_revenue, sponsorship as sponsorship_revenue, spent as total_expenses, running as operating_expenses,
       owner as owner_compensation, income - spent as net_income, income - running as operating_income,
       if(income <> 0, (income - running) / income, null) as operating_margin
from named""", "F-03")
def q_monthly_pnl(spark, d):
    return pnl_df(spark, d)


AFF_SPEC = "month:d partner_name:s payment_channel:s revenue:m transaction_count:i"


# A payment's text is the first one there is; the lowest matching rule row names the partner.
@register("affiliate_by_partner", AFF_SPEC, """
with rules(no, channel, pattern, partner) as (
    values (1, 'Bank', 'payout desk%', 'Payout Desk'), (2, 'Bank', 'north opco%', 'North Sports'), (3, 'Bank', 'north topco%', 'North Sports'),
           (4, 'Bank', 'south squad%', 'South Squad'), (5, 'Bank', 'mobile deposit%', 'Unknown (Mobile Deposit)'), (6, null, '%alpha pro%', 'Alpha Pro'),
           (7, null, '%club commission%', 'Club'), (8, null, 'club,%', 'Club'), (9, null, '%beta gear%', 'Beta Gear'), (10, null, '%betagear%', 'Beta Gear'),
           (11, null, '%north%media part%', 'North Media'), (12, null, '%payout desk%', 'Payout Desk'), (13, null, '%delta%', 'Delta')),
paid as (
    select txn_date, total_amount, coalesce(memo, '') as note,
           if(deposit_to_account_name = 'Operating Checking', 'Bank', 'PayPal') as payment_channel
    from r_deposits where deposit_to_account_name = 'PayPal balance account'
       or (deposit_to_account_name = 'Operating Checking' and source_summary = 'Affiliate Revenue')),
texts as (
    select row_number() over () as n, p.*,
           lower(if(payment_channel = 'Bank', regexp_extract(lower(note), '^[a-z0-9 ]+'),
                    coalesce(nullif(trim(regexp_extract(note, '(?s)Description:(.*)', 1)), ''), w.transaction_subject, note))) as said
    from paid p left join r_wallet_txns w on payment_channel = 'PayPal' and w.transaction_status = 'Success'
      and w.transaction_id != '' and w.transaction_id = regexp_extract(note, 'Transaction ID:\\s*([A-Z0-9]+)', 1)),
named as (
    select any_value(txn_date) as txn_date, any_value(total_amount) as amount, payment_channel,
           coalesce(arg_min(r.partner, r.no), 'Unidentified') as partner_name
    from texts left join rules r on said like r.pattern and coalesce(r.channel, payment_channel) = payment_channel
    group by n, payment_channel)
select cast(date_trunc('month', txn_date) as date) as month, partner_name, payment_channel, sum(amount) as revenue,
       count(*) as transaction_count
from named group by 1, 2, 3""", "F-04")
def q_affiliate_by_partner(spark, d):
    return affiliates_df(spark, d)


sql_model("m_expense_by_vendor", """
with months as (
    select vendor_name, date_trunc('month', txn_date)::date as month, list(amount) as paid from r_purchase_lines
    where vendor_name is not null and txn_date is not null group by all),
vendors as (select vendor_name, list(list_sum(paid)) as costs, list({'month': month, 'paid': paid}) as ms from months group by vendor_name),
judged as (
    select vendor_name, ms, len(costs) >= 3 and coalesce(list_stddev_samp(costs) / nullif(list_avg(costs), 0) < 0.3, list_stddev_samp(costs) is null) as steady
    from vendors)
select vendor_name, m.month as month, list_sum(m.paid) as total_spend, len(m.paid) as transaction_count, list_avg(m.paid) as avg_amount,
       coalesce(steady, false) as is_likely_subscription
from (select vendor_name, steady, unnest(ms) as m from judged)""")

VENDOR_SPEC = ("vendor_name:s month:d total_spend:m transaction_count:i avg_amount:m is_likely_subscription:b")


@register("expense_by_vendor", VENDOR_SPEC, "select * from m_expense_by_vendor", "F-05")
def q_expense_by_vendor(spark, d):
    return by_vendor_df(spark, d)


ENRICH_SPEC = ("month:d expense_category:s expense_bucket:s account_type:s account_sub_type:s total_amount:m "
               "transaction_count:i prior_month_amount:m mom_change:m mom_change_pct:r")


# The first bucket whose list holds the sub-type; each category's rows as one ordered list, beside itself moved by one.
@register("expense_enriched", ENRICH_SPEC, """
with buckets(no, bucket, subs) as (
    values (1, 'COGS & Fulfillment', ['SuppliesMaterialsCogs', 'CostOfLaborCos', 'OtherCostsOfServiceCos', 'ShippingFreightDeliveryCos']),
           (2, 'Marketing & Advertising', ['AdvertisingPromotional']), (3, 'SaaS & Tools', ['DuesSubscriptions']),
           (4, 'Professional Services', ['CostOfLabor', 'LegalProfessionalFees']), (5, 'Payroll & Benefits', ['PayrollWageExpenses']),
           (6, 'Facilities & Insurance', ['Insurance']), (7, 'Travel & Events', ['Travel', 'TravelMeals']),
           (8, 'Supplies & Shipping', ['ShippingFreightDelivery', 'SuppliesMaterials'])),
lists as (
    select expense_category, list(e order by month, account_type asc nulls first, account_sub_type asc nulls first, is_owner_compensation asc nulls first,
                                  total_amount, transaction_count) as es
    from m_monthly_expenses e group by expense_category),
pairs as (select unnest(list_zip(es, list_prepend(null, es[:-2]))) as x from lists),
rows_ as (select x[1] as e, x[2].total_amount as before from pairs)
select e.month as month, e.expense_category as expense_category,
       coalesce((select arg_min(bucket, no) from buckets where list_contains(subs, e.account_sub_type) or (no = 3
                 and e.account_sub_type = 'OfficeGeneralAdministrativeExpenses' and contains(lower(e.expense_category), 'software'))), 'Other Operating') as expense_bucket,
       e.account_type as account_type, e.account_sub_type as account_sub_type, e.total_amount as total_amount, e.transaction_count as transaction_count,
       before as prior_month_amount, e.total_amount - before as mom_change, if(before <> 0, e.total_amount / before - 1, null) as mom_change_pct
from rows_""", "F-06")
def q_expense_enriched(spark, d):
    return fin.expense_enriched(expenses_df(spark, d))


SUB_SPEC = ("vendor_name:s avg_monthly_cost:m annual_projection:m months_active:i first_seen:d last_seen:d "
            "total_spend:m cost_cutting_signal:s")


# A vendor's monthly costs as one ordered list: its first and last three months are slices of it.
@register("subscription_analysis", SUB_SPEC, f"""
with vendors as (
    select vendor_name, list(total_spend order by month) as costs, list(distinct month) as months, min(month) as first_seen,
           max(month) as last_seen, sum(total_spend) as total_spend, avg(total_spend) as avg_monthly_cost
    from m_expense_by_vendor where is_likely_subscription group by vendor_name)
select vendor_name, avg_monthly_cost, 12 * avg_monthly_cost as annual_projection, len(months) as months_active, first_seen, last_seen,
       total_spend,
       case when list_avg(costs[-3:]) > list_avg(costs[:3]) * 1.10 and 12 * avg_monthly_cost > 1000 then 'Price creeping up'
            when last_seen < date_trunc('month', date '{R.AS_OF_ORDERS}') - interval 1 month and 12 * avg_monthly_cost > 500 then 'May be unused'
            when 12 * avg_monthly_cost > 2000 then 'High-cost — review' end as cost_cutting_signal
from vendors""", "F-07")
def q_subscription_analysis(spark, d):
    return fin.subscription_analysis(by_vendor_df(spark, d), R.AS_OF_ORDERS)


WHOLESALE_SPEC = ("line_item_id:s invoice_id:s txn_date:d customer_name:s company_name:s state:s item_name:s "
                  "quantity:f unit_price:m amount:m invoice_total:m invoice_balance:m txn_status:s")


@register("wholesale_detail", WHOLESALE_SPEC, """
select li.line_item_id, i.invoice_id, i.txn_date, i.customer_name, c.company_name, c.state, li.item_name,
       li.quantity, li.unit_price, li.amount, i.total_amount as invoice_total, i.balance as invoice_balance,
       i.txn_status
from r_invoice_lines li join r_invoices i on li.invoice_id = i.invoice_id
left join r_qb_customers c on i.customer_id = c.customer_id""", "F-08")
def q_wholesale_detail(spark, d):
    return fin.wholesale_detail(R.invoices(spark, d), R.invoice_lines(spark, d), R.qb_customers(spark, d))
