"""Finance operators: revenue streams, expenses, P&L, affiliate partners,
vendor subscriptions and wholesale detail (F-01..F-08).

Inputs are role-shaped frames (see ``marginalia.sources.roles``): deposits,
invoices and their lines, purchase (expense) lines, chart of accounts,
accounting customers, wallet transactions.  Optional ``*_supplement`` frames
play the part of the bank-statement seeds; they are appended unchanged.

Scale notes
* classification rules are ordered ``when`` chains evaluated inside codegen;
  one pass over deposits feeds every revenue stream (the source model scans
  the deposits once per stream).
* windows (lag per category, first/last three months per vendor) run over
  monthly aggregates: one row per month per key, bounded by the calendar.
* the chart of accounts is reference data a few rows long (broadcast).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import month_start, safe_div

# Fixed values that must equal the reference's for equal results:
#   owner-compensation account sub-types: PayrollWageExpenses, PayrollExpenses, PayrollTaxExpenses
#   expense classification kept: Expense
#   wholesale invoice statuses: Paid, Partial, Open
#   wallet account: "PayPal balance account"
#   (the operating bank account's name, BANK_ACCOUNT, is a per-deployment setting)
#   affiliate bank tag: "Affiliate Revenue"
#   retail streams: Wholesale, Shopify, Amazon
#   subscription: >= 3 active months and spend stddev/mean < 0.3
#   cost signals: recent > early x 1.10 and projection > 1000 -> "Price creeping up";
#                 last seen before last month and projection > 500 -> "May be unused";
#                 projection > 2000 -> "High-cost — review"
OWNER_SUBTYPES = ("PayrollWageExpenses", "PayrollExpenses", "PayrollTaxExpenses")
WHOLESALE_STATUSES = ("Paid", "Partial", "Open")
BANK_ACCOUNT = "Operating Checking"
WALLET_ACCOUNT = "PayPal balance account"
RETAIL_STREAMS = ("Wholesale", "Shopify", "Amazon")
DEPOSIT_STREAMS = ("Amazon", "Shopify", "Affiliate", "Sponsorship")

# Expense buckets by account sub-type, first match wins (fixed values).
EXPENSE_BUCKETS = [
    ("COGS & Fulfillment", ("SuppliesMaterialsCogs", "CostOfLaborCos", "OtherCostsOfServiceCos",
                            "ShippingFreightDeliveryCos")),
    ("Marketing & Advertising", ("AdvertisingPromotional",)),
    ("SaaS & Tools", ("DuesSubscriptions",)),  # plus general-admin accounts named like software
    ("Professional Services", ("CostOfLabor", "LegalProfessionalFees")),
    ("Payroll & Benefits", ("PayrollWageExpenses",)),
    ("Facilities & Insurance", ("Insurance",)),
    ("Travel & Events", ("Travel", "TravelMeals")),
    ("Supplies & Shipping", ("ShippingFreightDelivery", "SuppliesMaterials")),
]
OTHER_BUCKET = "Other Operating"

# Affiliate partner rules, first match wins: (channel or None for any, LIKE pattern on the match text, partner).
# A sample; a deployment's own rules come as a seed (:func:`partner_rules`).
PARTNER_RULES = [
    ("Bank", "payout desk%", "Payout Desk"),
    ("Bank", "north opco%", "North Sports"),
    ("Bank", "north topco%", "North Sports"),
    ("Bank", "south squad%", "South Squad"),
    ("Bank", "mobile deposit%", "Unknown (Mobile Deposit)"),
    (None, "%alpha pro%", "Alpha Pro"),
    (None, "%club commission%", "Club"),
    (None, "club,%", "Club"),
    (None, "%beta gear%", "Beta Gear"),
    (None, "%betagear%", "Beta Gear"),
    (None, "%north%media part%", "North Media"),
    (None, "%payout desk%", "Payout Desk"),
    (None, "%delta%", "Delta"),
]
UNIDENTIFIED = "Unidentified"


def _union_all(frames):
    frames = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b), frames)


def classify_deposit(account, summary, memo, *, bank_account: str = BANK_ACCOUNT):
    """Ordered revenue-stream rules for a deposit (Amazon, Shopify, Affiliate, Sponsorship, Other)."""
    s = F.coalesce(summary, F.lit(""))
    m = F.lower(F.coalesce(memo, F.lit("")))
    ls = F.lower(s)
    bank = account == bank_account
    return (F.when(bank & m.like("%amazon%"), "Amazon")
            .when(s.like("%Shopify%") | (bank & m.like("%shopify%")), "Shopify")
            .when(s == "Affiliate Revenue", "Affiliate")
            .when(account == WALLET_ACCOUNT, "Affiliate")
            .when(ls.like("%sponsor%") | m.like("%sponsor%") | ls.like("%partnership%") | m.like("%partnership%"),
                  "Sponsorship")
            .otherwise("Other"))


def monthly_revenue(invoices: DataFrame, deposits: DataFrame, supplement: DataFrame | None = None, *,
                    bank_account: str = BANK_ACCOUNT) -> DataFrame:
    """F-01: revenue and transaction count per month and stream.

    'Other' deposits are dropped; sales receipts are deliberately not an input.
    """
    inv = (invoices.where(F.col("txn_status").isin(*WHOLESALE_STATUSES))
           .groupBy(month_start("txn_date").alias("month"))
           .agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count"))
           .withColumn("revenue_stream", F.lit("Wholesale")))
    stream = classify_deposit(F.col("deposit_to_account_name"), F.col("source_summary"), F.col("memo"),
                              bank_account=bank_account)
    dep = (deposits.select(month_start("txn_date").alias("month"), stream.alias("revenue_stream"), "total_amount")
           .where(F.col("revenue_stream").isin(*DEPOSIT_STREAMS))
           .groupBy("month", "revenue_stream")
           .agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count")))
    cols = ["month", "revenue_stream", "revenue", "transaction_count"]
    sup = supplement.select(*cols) if supplement is not None else None
    return _union_all([inv.select(*cols), dep.select(*cols), sup]).where(F.col("month").isNotNull())


def monthly_expenses(lines: DataFrame, accounts: DataFrame, supplement: DataFrame | None = None, *,
                     owner_subtypes=OWNER_SUBTYPES) -> DataFrame:
    """F-02: expense totals per month x category x account type x sub-type x owner flag.

    A NULL sub-type gives a NULL owner flag, as ``in (...)`` does in SQL.
    """
    a = accounts.select("account_id", "name", "account_type", "account_sub_type", "classification")
    j = lines.join(a, "account_id", "left")
    cat = F.coalesce(F.col("name"), F.col("account_name"))
    sub = F.col("account_sub_type")
    owner = F.when(sub.isNotNull(), sub.isin(*owner_subtypes))
    m = (j.where(F.col("txn_date").isNotNull() & cat.isNotNull() & (F.col("classification") == "Expense"))
         .groupBy(month_start("txn_date").alias("month"), cat.alias("expense_category"), "account_type",
                  "account_sub_type", owner.alias("is_owner_compensation"))
         .agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("transaction_count")))
    cols = ["month", "expense_category", "account_type", "account_sub_type", "is_owner_compensation",
            "total_amount", "transaction_count"]
    sup = supplement.select(*cols) if supplement is not None else None
    return _union_all([m.select(*cols), sup])


def monthly_pnl(revenue: DataFrame, expenses: DataFrame, *, retail_streams=RETAIL_STREAMS) -> DataFrame:
    """F-03: one P&L row per month over the union of revenue and expense months.

    A NULL owner flag counts in total expenses but in neither split, as in
    the source model (R-18).
    """
    st = F.col("revenue_stream")
    rv = lambda cond: F.sum(F.when(cond, F.col("revenue")).otherwise(0.0))
    r = revenue.groupBy("month").agg(
        F.sum("revenue").alias("total_revenue"), rv(st.isin(*retail_streams)).alias("retail_revenue"),
        rv(st == "Wholesale").alias("wholesale_revenue"), rv(st == "Shopify").alias("shopify_revenue"),
        rv(st == "Amazon").alias("amazon_revenue"), rv(st == "Affiliate").alias("affiliate_revenue"),
        rv(st == "Sponsorship").alias("sponsorship_revenue"))
    own = F.col("is_owner_compensation")
    ex = lambda cond: F.sum(F.when(cond, F.col("total_amount")).otherwise(0.0))
    e = expenses.groupBy("month").agg(
        F.sum("total_amount").alias("total_expenses"), ex(~own).alias("operating_expenses"),
        ex(own).alias("owner_compensation"))
    rcols = ["total_revenue", "retail_revenue", "wholesale_revenue", "shopify_revenue", "amazon_revenue",
             "affiliate_revenue", "sponsorship_revenue"]
    ecols = ["total_expenses", "operating_expenses", "owner_compensation"]
    nul = F.lit(None).cast("double")
    stacked = (r.select("month", *rcols, *[nul.alias(c) for c in ecols])
               .unionByName(e.select("month", *[nul.alias(c) for c in rcols], *ecols)))
    j = stacked.groupBy("month").agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in rcols + ecols])
    return j.select(
        "month", *rcols, *ecols,
        (F.col("total_revenue") - F.col("total_expenses")).alias("net_income"),
        (F.col("total_revenue") - F.col("operating_expenses")).alias("operating_income"),
        safe_div(F.col("total_revenue") - F.col("operating_expenses"), F.col("total_revenue"))
        .alias("operating_margin"))


def partner_rules(seed: DataFrame, *, most: int = 5_000) -> list[tuple]:
    """The rules of a seed table (rule_order, channel, pattern, partner), in order; a blank channel is any.

    A rule list becomes an expression, so more than ``most`` rules are refused.
    """
    rows = seed.orderBy("rule_order", "pattern").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} partner rules")
    return [(r["channel"] or None, r["pattern"], r["partner"]) for r in rows if r["pattern"] and r["partner"]]


def partner_of(channel, text, rules=PARTNER_RULES):
    """First matching affiliate rule for (channel, match text), else 'Unidentified'."""
    named = [F.when(text.like(pattern) if ch is None else (channel == ch) & text.like(pattern), partner)
             for ch, pattern, partner in rules]
    return F.coalesce(*named, F.lit(UNIDENTIFIED))


def affiliate_by_partner(deposits: DataFrame, wallet_txns: DataFrame,
                         supplement: DataFrame | None = None, *, bank_account: str = BANK_ACCOUNT,
                         rules=PARTNER_RULES) -> DataFrame:
    """F-04: affiliate revenue per month x partner x payment channel.

    Wallet deposits are matched on the description after 'Description:' in
    the memo, else the wallet transaction's subject (successful ones only,
    joined on the id after 'Transaction ID:'), else the memo; bank deposits
    tagged as affiliate revenue on the leading words of the memo.  The two
    seed-lookup tiers of the source model are unreachable there (their
    inputs are NULL constants) and are left out.  Deposits without a
    transaction id go around the join, so they are no hot key in it.
    """
    d = deposits.where(F.col("deposit_to_account_name").isin(WALLET_ACCOUNT, bank_account)).select(
        "deposit_id", "txn_date", "total_amount", "deposit_to_account_name",
        F.coalesce("source_summary", F.lit("")).alias("source_summary"),
        F.coalesce("memo", F.lit("")).alias("memo"))
    memo = F.col("memo")
    desc_pos = F.instr(memo, "Description:")
    wallet = d.where(F.col("deposit_to_account_name") == WALLET_ACCOUNT).select(
        "deposit_id", "txn_date", "total_amount", F.lit("PayPal").alias("payment_channel"), "memo",
        F.when(memo.like("%Description:%"), F.trim(F.substr(memo, desc_pos + 12))).otherwise("")
        .alias("paypal_description"),
        F.regexp_extract(memo, r"Transaction ID:\s*([A-Z0-9]+)", 1).alias("paypal_txn_id"))
    bank = d.where((F.col("deposit_to_account_name") == bank_account)
                   & (F.col("source_summary") == "Affiliate Revenue")).select(
        "deposit_id", "txn_date", "total_amount", F.lit("Bank").alias("payment_channel"), "memo",
        F.lit("").alias("paypal_description"), F.lit(None).cast("string").alias("paypal_txn_id"))
    aff = wallet.unionByName(bank)
    tx = (wallet_txns.where(F.col("transaction_status") == "Success")
          .select(F.col("transaction_id").alias("paypal_txn_id"), F.col("transaction_subject").alias("subj")))
    # the source dialect's regexp_extract yields NULL on no match; ours '' never joins either
    # a comparison with '' is NULL for bank deposits; both sorts have no id to look up
    has_id = F.coalesce(F.col("paypal_txn_id") != "", F.lit(False))
    aff = (aff.where(has_id).join(tx, "paypal_txn_id", "left")
           .unionByName(aff.where(~has_id).withColumn("subj", F.lit(None).cast("string"))))
    ch = F.col("payment_channel")
    text = F.lower(F.when(ch == "Bank", F.regexp_extract(F.lower(memo), r"^([a-z0-9 ]+)", 1))
                   .when(F.col("paypal_description") != "", F.col("paypal_description"))
                   .when(F.col("subj").isNotNull(), F.col("subj"))
                   .otherwise(memo))
    # a generated column is not inlined, so neither the rules nor a filter on the partner evaluate the text once for each rule
    m = aff.select("txn_date", "total_amount", "payment_channel", F.explode(F.array(text)).alias("said")).select(
        "txn_date", "total_amount", "payment_channel", partner_of(ch, F.col("said"), rules).alias("partner_name"))
    q = m.groupBy(month_start("txn_date").alias("month"), "partner_name", "payment_channel").agg(
        F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("transaction_count"))
    cols = ["month", "partner_name", "payment_channel", "revenue", "transaction_count"]
    sup = supplement.select(*cols) if supplement is not None else None
    return _union_all([q.select(*cols), sup])


def expense_by_vendor(lines: DataFrame, *, min_months: int = 3, max_cv: float = 0.3) -> DataFrame:
    """F-05: vendor x month spend with a likely-subscription flag.

    Vendor statistics come from a window over the vendor's monthly rows (one
    row per month), so no self-join back to the aggregate is needed.
    """
    vm = (lines.where(F.col("vendor_name").isNotNull() & F.col("txn_date").isNotNull())
          .groupBy("vendor_name", month_start("txn_date").alias("month"))
          .agg(F.sum("amount").alias("total_spend"), F.count(F.lit(1)).alias("transaction_count"),
               F.avg("amount").alias("avg_amount")))
    w = Window.partitionBy("vendor_name")
    months = F.count("month").over(w)
    sd = F.stddev_samp("total_spend").over(w)
    mean = F.avg("total_spend").over(w)
    sub = (months >= min_months) & (sd.isNull() | (F.coalesce(safe_div(sd, mean) < max_cv, F.lit(False))))
    return vm.select("vendor_name", "month", "total_spend", "transaction_count", "avg_amount",
                     F.coalesce(sub, F.lit(False)).alias("is_likely_subscription"))


def expense_bucket(sub_type, category):
    expr = None
    for bucket, subs in EXPENSE_BUCKETS:
        cond = sub_type.isin(*subs)
        if bucket == "SaaS & Tools":
            cond = cond | ((sub_type == "OfficeGeneralAdministrativeExpenses")
                           & F.lower(category).like("%software%"))
        expr = F.when(cond, bucket) if expr is None else expr.when(cond, bucket)
    return expr.otherwise(OTHER_BUCKET)


def expense_enriched(expenses: DataFrame) -> DataFrame:
    """F-06: bucket + previous row of the same category (previous row, not calendar month).

    Rows sharing a month within a category are ordered by account type and
    sub-type to make ``lag`` deterministic (R-05).
    """
    w = Window.partitionBy("expense_category").orderBy(
        "month", F.col("account_type").asc_nulls_first(), F.col("account_sub_type").asc_nulls_first(),
        F.col("is_owner_compensation").asc_nulls_first(), "total_amount", "transaction_count")
    prior = F.lag("total_amount").over(w)
    e = expenses.select("*", expense_bucket(F.col("account_sub_type"), F.col("expense_category"))
                        .alias("expense_bucket"), prior.alias("prior_month_amount"))
    return e.select("month", "expense_category", "expense_bucket", "account_type", "account_sub_type",
                    "total_amount", "transaction_count", "prior_month_amount",
                    (F.col("total_amount") - F.col("prior_month_amount")).alias("mom_change"),
                    safe_div(F.col("total_amount") - F.col("prior_month_amount"), F.col("prior_month_amount"))
                    .alias("mom_change_pct"))


def subscription_analysis(by_vendor: DataFrame, as_of: str, *, n: int = 3, creep: float = 1.10,
                          creep_floor: float = 1000.0, unused_floor: float = 500.0,
                          high_floor: float = 2000.0) -> DataFrame:
    """F-07: one row per subscription vendor with a cost-cutting signal."""
    vm = by_vendor.where(F.col("is_likely_subscription"))
    asc = Window.partitionBy("vendor_name").orderBy("month")
    desc = Window.partitionBy("vendor_name").orderBy(F.col("month").desc())
    r = vm.select("*", F.row_number().over(asc).alias("rn_a"), F.row_number().over(desc).alias("rn_d"))
    s = r.groupBy("vendor_name").agg(
        F.avg("total_spend").alias("avg_monthly_cost"), (F.avg("total_spend") * 12).alias("annual_projection"),
        F.count_distinct("month").alias("months_active"), F.min("month").alias("first_seen"),
        F.max("month").alias("last_seen"), F.sum("total_spend").alias("total_spend"),
        F.avg(F.when(F.col("rn_a") <= n, F.col("total_spend"))).alias("early_cost"),
        F.avg(F.when(F.col("rn_d") <= n, F.col("total_spend"))).alias("recent_cost"))
    cutoff = F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), -1)
    sig = (F.when((F.col("recent_cost") > F.col("early_cost") * creep) & (F.col("annual_projection") > creep_floor),
                  "Price creeping up")
           .when((F.col("last_seen") < cutoff) & (F.col("annual_projection") > unused_floor), "May be unused")
           .when(F.col("annual_projection") > high_floor, "High-cost — review"))
    return s.select("vendor_name", "avg_monthly_cost", "annual_projection", "months_active", "first_seen",
                    "last_seen", "total_spend", sig.alias("cost_cutting_signal"))


def wholesale_detail(invoices: DataFrame, lines: DataFrame, customers: DataFrame,
                     supplement: DataFrame | None = None) -> DataFrame:
    """F-08: invoice line detail with invoice and customer attributes.

    ``supplement`` (month, revenue_stream, revenue, ...) adds one synthetic
    'Paid' line per month of wholesale bank-statement revenue.
    """
    i = invoices.select("invoice_id", "txn_date", "customer_id", "customer_name",
                        F.col("total_amount").alias("invoice_total"), F.col("balance").alias("invoice_balance"),
                        "txn_status")
    c = customers.select("customer_id", "company_name", "state")
    # customers meet the invoices, not their lines: the lines are shuffled once
    i = i.join(c, "customer_id", "left")
    d = lines.select("line_item_id", "invoice_id", "item_name", "quantity", "unit_price", "amount").join(i, "invoice_id")
    cols = ["line_item_id", "invoice_id", "txn_date", "customer_name", "company_name", "state", "item_name",
            "quantity", "unit_price", "amount", "invoice_total", "invoice_balance", "txn_status"]
    out = d.select(*cols)
    if supplement is not None:
        ym = F.date_format("month", "yyyy-MM")
        label = F.lit("Pre-QBO (Bank Statement)")
        s = supplement.where(F.col("revenue_stream") == "Wholesale").select(
            F.concat(F.lit("bank-"), ym).alias("line_item_id"), F.concat(F.lit("BANK-"), ym).alias("invoice_id"),
            F.col("month").alias("txn_date"), label.alias("customer_name"), label.alias("company_name"),
            F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("item_name"),
            F.lit(None).cast("double").alias("quantity"), F.lit(None).cast("double").alias("unit_price"),
            F.col("revenue").alias("amount"), F.col("revenue").alias("invoice_total"),
            F.lit(0.0).alias("invoice_balance"), F.lit("Paid").alias("txn_status"))
        out = out.unionByName(s)
    return out
