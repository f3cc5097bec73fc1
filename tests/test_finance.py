import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginalia.operators import finance as fin
from marginalia.sources.flatten import invoice_status

LINE = "vendor_name string, txn_date date, amount double"


def test_subscription_flags(spark):
    rows = []
    for m in (1, 2, 3):
        rows.append(("steady", dt.date(2024, m, 5), 10.0))          # 3 months, stddev 0 -> subscription
        rows.append(("jumpy", dt.date(2024, m, 5), 10.0 * m ** 3))  # high variation -> not
    rows += [("two", dt.date(2024, 1, 5), 5.0), ("two", dt.date(2024, 2, 5), 5.0),   # only 2 months
             ("zero", dt.date(2024, 1, 5), 0.0), ("zero", dt.date(2024, 2, 5), 0.0),
             ("zero", dt.date(2024, 3, 5), 0.0)]                    # mean 0 -> NULL ratio -> false
    bv = fin.expense_by_vendor(spark.createDataFrame(rows, LINE))
    flags = {r.vendor_name: r.is_likely_subscription for r in bv.select("vendor_name", "is_likely_subscription")
             .distinct().collect()}
    assert flags == {"steady": True, "jumpy": False, "two": False, "zero": False}
    sub = {r.vendor_name: r for r in fin.subscription_analysis(bv, "2024-09-01").collect()}
    assert set(sub) == {"steady"}
    assert sub["steady"].annual_projection == pytest.approx(120.0) and sub["steady"].cost_cutting_signal is None


def test_subscription_signal_order(spark):
    rows = [("v", dt.date(2024, m, 1), s, 1, 1.0, True) for m, s in ((1, 100.0), (2, 100.0), (3, 100.0),
                                                                      (4, 200.0), (5, 200.0), (6, 200.0))]
    bv = spark.createDataFrame(rows, "vendor_name string, month date, total_spend double, transaction_count long, "
                                     "avg_amount double, is_likely_subscription boolean")
    assert fin.subscription_analysis(bv, "2024-07-15").first().cost_cutting_signal == "Price creeping up"


def test_partner_rules_first_match(spark):
    df = spark.createDataFrame([("Bank", "payout desk may"), ("PayPal", "a payout desk"),
                                ("PayPal", "alpha pro and delta"), ("PayPal", "nothing")], "c string, t string")
    got = [r.p for r in df.select(fin.partner_of(F.col("c"), F.col("t")).alias("p")).collect()]
    assert got == ["Payout Desk", "Payout Desk", "Alpha Pro", "Unidentified"]


def test_partner_rules_expected_names(spark):
    cases = [("Bank", "north opco llc", "North Sports"), ("Bank", "mobile deposit 12", "Unknown (Mobile Deposit)"),
             ("PayPal", "mobile deposit 12", "Unidentified"), ("Bank", "south squad inc", "South Squad"), ("PayPal", "club, june", "Club"),
             ("PayPal", "a club commission 4", "Club"), ("PayPal", "betagear", "Beta Gear"), ("PayPal", "north tech media partner", "North Media"),
             ("Bank", "north topco", "North Sports"), ("PayPal", None, "Unidentified"), (None, "delta", "Delta"), ("PayPal", "clubs,", "Unidentified")]
    df = spark.createDataFrame([(i, c, t) for i, (c, t, _) in enumerate(cases)], "i int, c string, t string")
    got = df.select("i", fin.partner_of(F.col("c"), F.col("t")).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == [p for _, _, p in cases]


def test_affiliate_settings_and_missing_ids(spark):
    """A third and more of the deposits have no transaction id: none is lost or looked up."""
    day = dt.date(2024, 3, 5)
    wallet, bank = fin.WALLET_ACCOUNT, "Main Account"
    rows = [(i, day, 10.0, wallet, None, "beta gear") for i in range(6)]
    rows += [(6, day, 1.0, wallet, None, "Transaction ID: AB1"), (7, day, 2.0, wallet, None, "Transaction ID: ZZ9"),
             (8, day, 3.0, bank, "Affiliate Revenue", "acme pays"), (9, day, 4.0, fin.BANK_ACCOUNT, "Affiliate Revenue", "acme pays"),
             (10, day, 5.0, wallet, None, None)]
    dep = spark.createDataFrame(rows, "deposit_id long, txn_date date, total_amount double, deposit_to_account_name string, "
                                      "source_summary string, memo string")
    tx = spark.createDataFrame([("AB1", "Alpha Pro May", "Success"), ("ZZ9", "Alpha Pro May", "Failed"), ("", "Delta", "Success")],
                               "transaction_id string, transaction_subject string, transaction_status string")
    rules = [("Bank", "acme%", "Acme"), *fin.PARTNER_RULES]
    got = {(r.partner_name, r.payment_channel): (r.revenue, r.transaction_count)
           for r in fin.affiliate_by_partner(dep, tx, bank_account=bank, rules=rules).collect()}
    assert got == {("Beta Gear", "PayPal"): (60.0, 6), ("Alpha Pro", "PayPal"): (1.0, 1), ("Acme", "Bank"): (3.0, 1),
                   ("Unidentified", "PayPal"): (7.0, 2)}


def test_bank_account_setting(spark):
    dep = spark.createDataFrame([(dt.date(2024, 3, 5), 9.0, "Main Account", "", "AMAZON PAYOUT")],
                                "txn_date date, total_amount double, deposit_to_account_name string, source_summary string, memo string")
    inv = spark.createDataFrame([], "txn_date date, total_amount double, txn_status string")
    assert fin.monthly_revenue(inv, dep).count() == 0
    assert fin.monthly_revenue(inv, dep, bank_account="Main Account").first().revenue_stream == "Amazon"


def test_invoice_status(spark):
    df = spark.createDataFrame([(0.0, 10.0), (5.0, 10.0), (10.0, 10.0), (0.0, 0.0), (None, 1.0)], "b double, t double")
    got = [r.s for r in df.select(invoice_status("b", "t").alias("s")).collect()]
    assert got == ["Paid", "Partial", "Open", "Open", "Unknown"]


def test_monthly_pnl_null_owner_flag(spark):
    rev = spark.createDataFrame([(dt.date(2024, 1, 1), "Wholesale", 100.0, 1), (dt.date(2024, 1, 1), "Affiliate", 50.0, 1)],
                                "month date, revenue_stream string, revenue double, transaction_count long")
    exp = spark.createDataFrame([(dt.date(2024, 1, 1), 30.0, True), (dt.date(2024, 1, 1), 20.0, False),
                                 (dt.date(2024, 1, 1), 5.0, None), (dt.date(2024, 2, 1), 1.0, False)],
                                "month date, total_amount double, is_owner_compensation boolean")
    rows = {r.month: r for r in fin.monthly_pnl(rev, exp).collect()}
    j = rows[dt.date(2024, 1, 1)]
    assert (j.total_revenue, j.retail_revenue, j.affiliate_revenue) == (150.0, 100.0, 50.0)
    assert (j.total_expenses, j.operating_expenses, j.owner_compensation) == (55.0, 20.0, 30.0)
    assert rows[dt.date(2024, 2, 1)].operating_margin is None     # no revenue -> safe ratio NULL


def test_deposit_classifier(spark):
    df = spark.createDataFrame([
        (fin.BANK_ACCOUNT, None, "AMAZON PAYOUT"), ("x", "Shopify Payments", ""), (fin.BANK_ACCOUNT, "", "shopify"),
        ("x", "Affiliate Revenue", ""), (fin.WALLET_ACCOUNT, "", ""), ("x", "", "Podcast sponsorship"),
        ("x", None, None)], "a string, s string, m string")
    got = [r.c for r in df.select(fin.classify_deposit(F.col("a"), F.col("s"), F.col("m")).alias("c")).collect()]
    assert got == ["Amazon", "Shopify", "Shopify", "Affiliate", "Affiliate", "Sponsorship", "Other"]


def test_partner_rules_from_a_seed(spark):
    """I-03: the rules of a deployment come as rows, in their order; a blank channel is any."""
    seed = spark.createDataFrame([(2, "", "%acme%", "Acme"), (1, "Bank", "acme gift%", "Gifts"), (3, None, None, "No pattern"), (4, "", "%x%", None)],
                                 "rule_order int, channel string, pattern string, partner string")
    rules = fin.partner_rules(seed)
    assert rules == [("Bank", "acme gift%", "Gifts"), (None, "%acme%", "Acme")]
    df = spark.createDataFrame([("Bank", "acme gift 1"), ("PayPal", "acme gift 1"), ("Bank", "my acme"), ("Bank", "delta")], "c string, t string")
    assert [r.p for r in df.select(fin.partner_of(F.col("c"), F.col("t"), rules).alias("p")).collect()] == ["Gifts", "Acme", "Acme", "Unidentified"]
    with pytest.raises(ValueError):
        fin.partner_rules(seed, most=2)
