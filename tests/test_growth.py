"""Work that must not grow beside the input: what is built once is built once, what is read once is read once."""

import datetime as dt
import re

from pyspark.sql import functions as F

from marginalia.functions import windows
from marginalia.functions.windows import spread
from marginalia.operators import commerce as cm
from marginalia.operators import finance as fin
from marginalia.operators import search as se
from marginalia.operators import staging as st
from marginalia.plans import QUERIES
from marginalia.plans.landing import _payload
from marginalia.sources import landing as ld
from marginalia.sources import tables as tb


def test_refresh_builds_the_mart_once(spark, tmp_path):
    """The mart's rows are counted as they are built: a refresh asks for each of them once, also where no row is left."""
    rows = spark.createDataFrame([(i, f"m{i % 3}") for i in range(30)], "x int, p string")
    count = spark.sparkContext.accumulator(0)

    def build(src):
        def seen(batches):
            for b in batches:
                count.add(b.num_rows)
                yield b

        return src.repartition(2).mapInArrow(seen, "x int, p string").where("p != 'm2'")

    assert tb.refresh(str(tmp_path / "t"), {"src": (rows, F.col("p"))}, build, F.col("p"), 1, spark) == ["m0", "m1", "m2"]
    assert count.value == 30
    assert tb.read_table(spark, str(tmp_path / "t")).count() == 20
    assert tb.refresh(str(tmp_path / "n"), {"src": (rows.where("p = 'm2'"), F.col("p"))}, build, F.col("p"), 1, spark) == ["m2"]
    assert tb.read_table(spark, str(tmp_path / "n")) is None


def test_ngrams_are_sorted_as_plain_texts(spark):
    """Stop words are looked up in a set and the sorted n-grams are texts, not pairs of a text and a length."""
    df = spark.createDataFrame([(dt.date(2024, 2, 20), "red the red shoe", "c", 10, 2, 6.0, 0.0), (dt.date(2024, 2, 20), None, "c", 1, 0, 9.0, 0.0)],
                               "date_start date, search_term string, campaign_name string, impressions long, clicks long, spend double, conversions double")
    out = se.search_term_ngrams(df, "2024-02-26")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and "INSET" in plan
    assert dict(out.select(se.gram_texts(F.array(F.lit("a"), F.lit("b"))).alias("g")).schema["g"].dataType.jsonValue())["elementType"] == "string"
    assert {(r.ngram, r.ngram_length, r.unique_search_terms, r.total_impressions) for r in out.collect()} == {
        ("red", 1, 1, 20), ("shoe", 1, 1, 10), ("red red", 2, 1, 10), ("red shoe", 2, 1, 10)}


def _terms(spark):
    """400 rows of two weeks and four campaigns (one of them NULL), terms repeated and NULL; one week of a campaign has most rows."""
    return spark.range(400).selectExpr("date_add(date '2024-02-12', cast(if(id % 4 < 2, 0, id % 14) as int)) as date_start",
                                       "if(id % 17 = 0, null, concat('red ', substr('the shoes hat red boots', cast(id % 9 as int) + 1), ' w', id % 23)) as search_term",
                                       "nullif(concat('c', if(id % 4 < 2, 0, id % 5)), 'c3') as campaign_name", "id % 50 as impressions", "id % 7 as clicks",
                                       "double(id % 11) as spend", "double(id % 3) as conversions")


def test_ngrams_are_summed_where_their_terms_are(spark, monkeypatch):
    """Terms are exchanged, their n-grams are not, but for those of a large week of a campaign; rows stay."""
    def grams_sent(df):
        return len(re.findall(r"hashpartitioning\([^)]*\b(?:ngram|g)#", _executed(df)))

    few = se.search_term_ngrams(_terms(spark), "2024-02-26")
    assert grams_sent(few) == 0 and len(re.findall(r"hashpartitioning", _executed(few))) == 1
    monkeypatch.setattr(se, "LARGE_ROWS", 50)
    monkeypatch.setattr(se, "LARGE_SHARE", 4)
    large = se.search_term_ngrams(_terms(spark), "2024-02-26")
    assert grams_sent(large) == 1
    assert _figures(large) == _figures(few) and few.count() > 100
    monkeypatch.setattr(se, "LARGE_SHARE", 1)  # none holds more than all
    assert grams_sent(se.search_term_ngrams(_terms(spark), "2024-02-26")) == 0
    rows = _terms(spark).where("spend > 0 and search_term is not null").collect()
    want = {}
    for r in rows:
        words = [w for w in re.sub("[^a-z0-9 ]+", " ", r.search_term.strip()).split() if w not in se.STOP_WORDS]
        week = r.date_start - dt.timedelta(days=r.date_start.weekday())
        for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            x = want.setdefault((week, g, r.campaign_name), [set(), 0, 0.0])
            x[0].add(r.search_term)
            x[1] += r.impressions
            x[2] += r.spend
    want = {k: (len(t), i, s) for k, (t, i, s) in want.items() if len(t) >= 2 or s >= 5}
    assert {(r.week_start, r.ngram, r.campaign_name): (r.unique_search_terms, r.total_impressions, r.total_spend) for r in large.collect()} == want


def test_an_action_list_is_read_once(spark):
    """Eight computed fields ask two lists: each list's entries are typed in one place of the plan."""
    text = ('{"ad_id":1,"actions":[{"action_type":"purchase","value":"2"},7,{"action_type":"link_click","value":1},{"action_type":"link_click","value":"4.0"},'
            '{"action_type":"omni_purchase"}],"action_values":[{"action_type":"purchase","value":"n/a"}]}')
    out = ld.read_feed(spark.createDataFrame([(text,), ("{}",), ("no json",)], "payload string"), "social_daily_insights")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("$.actions") == 1
    got = [(r.link_clicks, r.purchases, r.purchase_value, r.landing_page_views) for r in out.collect()]
    assert got == [(4, None, None, None), (None,) * 4, (None,) * 4]


def test_a_payload_is_one_object(spark):
    """Numbers as text in odd rows, NULL fields left out, one JSON object written a row."""
    df = spark.createDataFrame([(True, 1.5, 2, "x"), (False, 1.5, 2, None), (None, None, None, None)], "odd boolean, a double, b int, c string")
    out = df.select(_payload(F.col("odd"), a=(F.col("a"),), b=(F.col("b"),), c=F.col("c")).alias("p"))
    assert [r.p for r in out.collect()] == ['{"a":"1.5","b":"2","c":"x"}', '{"a":1.5,"b":2}', "{}"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("to_json") <= 2


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _aggregates_under_the_lines_exchange(plan):
    """Hash aggregations keyed by an order, each of which holds a row for every line of a task."""
    return [x for x in plan.split("\n") if "HashAggregate(keys=[order_id" in x]


def test_profitability_keeps_no_row_of_a_line_in_a_hash_map(spark):
    """Lines are spread over all shuffle partitions and go through one window to their day."""
    lines = spark.createDataFrame([(1, "a", "A", 2, 10.0, 1.0), (1, "a", "A", 1, 10.0, None), (1, "", "B C", 1, 20.0, 0.0), (2, None, None, 1, 5.0, 0.0),
                                   (3, "p", "Partner Product", 1, 10.0, 0.0), (4, "x", "X", 1, 1.0, 0.0), (None, "a", "A", 1, 1.0, 0.0)],
                                  "order_id long, sku string, title string, quantity long, price double, total_discount double")
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame([(1, day), (2, day), (3, day), (3, dt.date(2024, 1, 2)), (None, day)], "order_id long, order_date date")
    none = spark.createDataFrame([], "sku string, cogs double")
    out = cm.product_profitability(lines, orders, none, none)
    assert not _aggregates_under_the_lines_exchange(_executed(out)) and "REPARTITION_BY_NUM" in _executed(out)
    got = {(r.sku, r.order_date.day): (r.units_sold, r.net_revenue, round(r.estimated_shipping_cost, 6), r.cogs_source, r.is_gift_card) for r in out.collect()}
    share = 5.35 / 39
    assert got == {("a", 1): (3, 19.0, round(19 * share, 6), "fallback_40pct", False), ("NO_SKU_B_C", 1): (1, 20.0, round(20 * share, 6), "fallback_40pct", False),
                   (None, 1): (1, 5.0, 5.35, "fallback_40pct", None), ("p", 1): (1, 4.0, 2.675, "partnership", False), ("p", 2): (1, 4.0, 2.675, "partnership", False)}


def test_the_pnl_keeps_no_row_of_a_line_in_a_hash_map(spark, tmp_path):
    """The daily and monthly P&L and its extract read the same step."""
    d = "/root/testdata/sf0.001"
    for name in ("d2c_daily_pnl", "d2c_monthly_pnl"):
        plan = _executed(QUERIES[name].run(spark, d))
        assert not _aggregates_under_the_lines_exchange(plan) and "REPARTITION_BY_NUM" in plan
    assert QUERIES["extract_x04_d2c_monthly_pnl"].build(spark, d).count() == QUERIES["d2c_monthly_pnl"].build(spark, d).count()


def _dealt(plan):
    """Partitions that lines are dealt to by their order."""
    return {int(n) for n in re.findall(r"hashpartitioning\(order_id#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)}


def test_the_daily_pnl_deals_its_lines_to_several_partitions_a_core(spark):
    """A session with as few shuffle partitions as cores would leave a core's share of the lines in one task."""
    cores = spark.sparkContext.defaultParallelism
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < 8 * cores
    assert _dealt(_executed(QUERIES["d2c_daily_pnl"].run(spark, "/root/testdata/sf0.001"))) == {8 * cores}
    rows = spark.createDataFrame([(i % 50,) for i in range(100)] + [(None,)] * 3, "k long")
    assert spread(rows, "k").rdd.getNumPartitions() == 8 * cores and spread(rows, "k").groupBy("k").count().count() == 51
    few = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 9 * cores)
        assert spread(rows, "k").rdd.getNumPartitions() == 9 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)


def test_the_monthly_pnl_deals_its_lines_to_several_partitions_a_core(spark):
    """A month's sums are made of days whose lines were dealt as the daily P&L deals them."""
    assert _dealt(_executed(QUERIES["d2c_monthly_pnl"].run(spark, "/root/testdata/sf0.001"))) == {8 * spark.sparkContext.defaultParallelism}


def test_the_pnl_extract_deals_its_lines_to_several_partitions_a_core(spark, monkeypatch):
    """What the extract writes is the monthly P&L, dealt as that is."""
    from marginalia.operators import serving as sv
    written = []
    write = sv.write_ordered
    monkeypatch.setattr(sv, "write_ordered", lambda df, path, order: (written.append(_dealt(_executed(df))), write(df, path, order)))
    assert QUERIES["extract_x04_d2c_monthly_pnl"].build(spark, "/root/testdata/sf0.001").count() > 0
    assert written == [{8 * spark.sparkContext.defaultParallelism}]


def _shop(spark, d):
    """600 lines of 150 orders and 20 products, some keys NULL, some that no table knows, a product and an order twice."""
    n = spark.range(600)
    n.selectExpr("nullif(id div 4, 7) as l_orderkey", "nullif(id % 22, 3) as l_partkey", "id % 5 as l_suppkey", "cast(id % 4 as int) as l_linenumber",
                 "cast(id % 6 + 1 as double) as l_quantity", "10.0D * (id % 6 + 1) as l_extendedprice", "(id % 3) / 100D as l_discount", "0.0D as l_tax",
                 "if(id % 2 = 0, 'R', 'N') as l_returnflag", "if(id % 3 = 0, 'F', 'O') as l_linestatus",
                 "timestamp '2024-01-01' + make_dt_interval(cast(id % 90 as int)) as l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    n.where("id < 140").selectExpr("nullif(if(id = 139, 5, id), 9) as o_orderkey", "id % 11 as o_custkey", "'F' as o_orderstatus", "9.5D as o_totalprice",
                                   "if(id = 12, null, timestamp '2024-01-01' + make_dt_interval(cast(id % 80 as int))) as o_orderdate",
                                   "'2-HIGH' as o_orderpriority").write.parquet(f"{d}/orders.parquet")
    n.where("id < 21").selectExpr("if(id = 20, 4, id) as p_partkey", "nullif(concat('part ', id), 'part 6') as p_name", "concat('B', id) as p_brand", "'T' as p_type",
                                  "cast(id as int) as p_size", "900D + id as p_retailprice").write.parquet(f"{d}/part.parquet")
    return d


def _share_bounded(plan):
    """Lines meet their order, then their product's day, in 600 / 10 partitions, and their part without being sorted."""
    days = {int(n) for n in re.findall(r"hashpartitioning\(sku#\d+, title#\d+, order_date#\d+, (\d+)\), REPARTITION_BY_NUM", plan)}
    parts = re.findall(r"(\w+Join) \[l_partkey#", plan)
    return _dealt(plan) == {60} == days and set(parts) == {"ShuffledHashJoin"}


def _figures(df):
    """Rows as texts in order; sums of doubles depend on the order of their rows in the last digits."""
    return sorted(str([f"{v:.6f}" if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_a_task_of_the_monthly_pnl_holds_a_bounded_share_of_the_lines(spark, tmp_path, monkeypatch):
    """With many lines for the session's shuffle partitions, there are as many partitions as the lines need; rows stay."""
    d = _shop(spark, str(tmp_path))
    names = ("d2c_monthly_pnl", "d2c_daily_pnl", "product_profitability")
    few = {n: QUERIES[n].run(spark, d) for n in names}
    assert not any(_share_bounded(_executed(df)) for df in few.values())
    monkeypatch.setattr(windows, "PER_TASK", 10)
    assert 600 > 10 * int(spark.conf.get("spark.sql.shuffle.partitions")) and 60 > 8 * spark.sparkContext.defaultParallelism
    for n in names:
        df = QUERIES[n].run(spark, d)
        assert _share_bounded(_executed(df))
        assert _figures(df) == _figures(few[n])


def test_the_pnl_extract_holds_a_bounded_share_of_the_lines(spark, tmp_path, monkeypatch):
    """What the extract writes is the monthly P&L, dealt as that is."""
    from marginalia.operators import serving as sv
    d = _shop(spark, str(tmp_path))
    few = _figures(QUERIES["d2c_monthly_pnl"].run(spark, d))
    monkeypatch.setattr(windows, "PER_TASK", 10)
    written = []
    write = sv.write_ordered
    monkeypatch.setattr(sv, "write_ordered", lambda df, path, order: (written.append(_share_bounded(_executed(df))), write(df, path, order)))
    assert _figures(QUERIES["extract_x04_d2c_monthly_pnl"].build(spark, d)) == few and len(few) == 3
    assert written == [True]


def test_performance_spreads_its_lines(spark):
    """The hash maps of the distinct orders hold the lines of one shuffle partition, not of a core."""
    lines = spark.createDataFrame([(1, 7, "T", 2, 3.0, 1.0), (1, 7, "T", 1, 5.0, 0.0), (2, 7, "T", 1, 4.0, None), (3, 7, "T", 1, 4.0, 0.0)],
                                  "order_id long, product_id long, title string, quantity long, price double, total_discount double")
    orders = spark.createDataFrame([(1, "paid", "a"), (2, "paid", "a"), (3, "voided", "a"), (2, None, "a")],
                                   "order_id long, financial_status string, utm_source string").selectExpr("*", "cast(null as string) utm_medium", "cast(null as string) utm_campaign")
    out = cm.product_performance(lines, orders, spark.createDataFrame([], "product_id long, title string, product_type string"))
    assert "REPARTITION_BY_NUM" in _executed(out)
    assert [(r.product_title, r.source, r.medium, r.orders, r.units_sold, r.gross_revenue, r.avg_price) for r in out.collect()] == [("T", "a", "none", 2, 4, 15.0, 4.0)]


def test_the_newest_load_is_found_in_one_scan(spark):
    """Ads are scanned and shuffled once: the newest load, its sums and their join need no other exchange; keys with a NULL stay out."""
    d = dt.date(2024, 1, 1)
    raw = spark.createDataFrame([(d, "A", "1.0", "1", "1", "1.0", 1), (d, "A", "2.0", "1", "1", "1.0", 2), (d, "A", None, "1", "1", "1.0", 2), (d, "B", "4.0", "1", "1", "1.0", 1),
                                 (None, "A", "8.0", "1", "1", "1.0", 1), (d, None, "8.0", "1", "1", "1.0", 1), (d, "C", "8.0", "1", "1", "1.0", None)],
                                "date date, advertised_asin string, cost string, impressions string, clicks string, sales14d string, _loaded_at int")
    out = cm.marketplace_daily_ad_spend(st.stage(raw, "amazon__ad_spend"))
    plan = _executed(out)
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert sorted((r.asin, r.cost, r.impressions) for r in out.collect()) == [("A", 2.0, 2), ("B", 4.0, 1)]


def test_distinct_orders_are_told_apart_without_the_derived_time(spark):
    """The Pacific time follows from the purchase time: it is added to the distinct rows."""
    row = ("s", "A", "CAD", "2", "10.00", "Shipped", "Shipped", "US", "web", "2024-01-01T00:30:00Z", "o", "std", None)
    raw = spark.createDataFrame([row, row], "sku string, asin string, currency string, quantity string, item_price string, item_status string, order_status string, ship_country string, "
                                            "sales_channel string, purchase_date string, amazon_order_id string, ship_service_level string, item_promotion_discount string")
    out = st.orders_clean(raw)
    assert [(str(r.purchase_date_pac), str(r.purchase_date), float(r.sales)) for r in out.collect()] == [("2023-12-31 16:30:00", "2024-01-01 00:30:00", 7.2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "from_utc_timestamp" not in plan[plan.index("Aggregate ["):].split("\n", 1)[1]  # below the distinct rows' own line


def test_wide_results_round_in_small_methods(spark):
    """More than eight roundings leave no generated method that the JVM refuses to compile; the values are the same."""
    from marginalia.plans import catalog as ct
    values = [None, 0.125, -2.675, 1234567.891, 1e-9, 2.5, -0.0, 7e11, 0.1 + 0.2, 3.0]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} double" for i in range(10)))
    wide = ct.normalize(df, [(f"c{i}", "mfr"[i % 3]) for i in range(10)])
    narrow = [ct.normalize(df, [(f"c{i}", "mfr"[i % 3])]).first()[0] for i in range(10)]
    assert list(wide.first()) == narrow and wide.columns == df.columns
    assert _executed(wide).count("FLOOR") <= 9 * 10  # a class's steps, not a column's


def test_lines_meet_their_invoices_after_the_customers_did(spark):
    """Invoice lines are in one join: customers are looked up for the invoices."""
    lines = spark.createDataFrame([("l1", "i1", "x", 1.0, 2.0, 2.0), ("l2", "i1", "y", 1.0, 3.0, 3.0), ("l3", "i9", "z", 1.0, 3.0, 3.0)],
                                  "line_item_id string, invoice_id string, item_name string, quantity double, unit_price double, amount double")
    invoices = spark.createDataFrame([("i1", dt.date(2024, 1, 1), "c1", "C", 5.0, 0.0, "Paid"), ("i1", dt.date(2024, 1, 2), None, "D", 5.0, 0.0, "Paid")],
                                     "invoice_id string, txn_date date, customer_id string, customer_name string, total_amount double, balance double, txn_status string")
    customers = spark.createDataFrame([("c1", "Co", "NY"), ("c1", "Co2", None)], "customer_id string, company_name string, state string")
    out = fin.wholesale_detail(invoices, lines, customers)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftOuter")
    got = [(r.line_item_id, r.txn_date.day, r.company_name) for r in out.collect()]
    assert len(got) == 6 and set(got) == {(x, 1, c) for x in ("l1", "l2") for c in ("Co", "Co2")} | {(x, 2, None) for x in ("l1", "l2")}
