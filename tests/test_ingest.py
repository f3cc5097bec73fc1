import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marginalia.sources import flatten as fl
from marginalia.sources import merge as mg
from marginalia.sources import readers as rd
from marginalia.streaming.ingest import ingest_stream, read_latest


def test_coerce_numeric_like_the_report_loader(spark):
    rows = [("2024-01-01", "1", "1000", "50", "12.34", "100.00"), ("2024-01-01", "2", None, None, None, None),
            ("2024-01-01", "3", "not_a_number", "3.0", "bad", "7")]
    df = spark.createDataFrame(rows, "date string, campaignId string, impressions string, clicks string, "
                                     "cost string, sales14d string")
    out = fl.coerce_numeric(df, {"cost", "sales14d"}, {"impressions", "clicks"}).collect()
    assert (out[0].impressions, out[0].clicks, out[0].cost, out[0].sales14d) == (1000, 50, 12.34, 100.0)
    assert (out[1].impressions, out[1].cost) == (None, None)
    assert (out[2].impressions, out[2].clicks, out[2].cost, out[2].sales14d) == (None, 3, None, 7.0)


def test_merge_upsert_newest_wins_and_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, _loaded_at int")
    b = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "c2", 3)], "k int, v string, _loaded_at int")
    m = mg.merge_upsert(t, b, ["k"], order_cols=["_loaded_at"])
    got = {r.k: r.v for r in m.collect()}
    assert got == {1: "a", 2: "B", 3: "c2"}
    again = {r.k: r.v for r in mg.merge_upsert(m, b, ["k"], order_cols=["_loaded_at"]).collect()}
    assert again == got
    # equal stamps: the winner does not depend on input order
    tie1 = spark.createDataFrame([(5, "x", 1), (5, "y", 1)], "k int, v string, _loaded_at int")
    tie2 = spark.createDataFrame([(5, "y", 1), (5, "x", 1)], "k int, v string, _loaded_at int")
    empty = t.limit(0)
    a1 = mg.merge_upsert(empty, tie1, ["k"], order_cols=["_loaded_at"]).first().v
    a2 = mg.merge_upsert(empty, tie2, ["k"], order_cols=["_loaded_at"]).first().v
    assert a1 == a2


def test_lookback_chunks_keys_and_batches(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 32)], "d date")
    assert mg.lookback(df, "d", "2024-01-31", 7).count() == 7          # Jan 24..30
    ch = mg.date_chunks(spark, "2024-01-01", "2024-03-15", 31).orderBy("chunk_start").collect()
    assert [(r.chunk_start, r.chunk_end) for r in ch] == [(dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2024, 2, 1), dt.date(2024, 3, 2)), (dt.date(2024, 3, 3), dt.date(2024, 3, 15))]
    ok, skipped = mg.require_keys(spark.createDataFrame([("a",), ("",), (None,)], "k string"), ["k"])
    assert ok.count() == 1 and skipped.count() == 2
    b = mg.batch_ids(spark.range(25).withColumnRenamed("id", "x"), ["x"], size=10)
    sizes = sorted((r.batch_id, r.n) for r in b.groupBy("batch_id").agg(F.count("*").alias("n")).collect())
    assert sizes == [(0, 10), (1, 10), (2, 5)]


def test_pivot_actions_alias_order_and_duplicates(spark):
    schema = "id string, actions array<struct<action_type:string,value:string>>, " \
             "action_values array<struct<action_type:string,value:string>>"
    df = spark.createDataFrame([("1", [("purchase", "2"), ("omni_purchase", "3.0"), ("link_click", "9"),
                                       ("link_click", "11")], [("purchase", "10.5")]),
                                ("2", None, None)], schema)
    rows = {r.id: r for r in fl.pivot_actions(df).collect()}
    assert rows["1"].purchases == 3 and rows["1"].purchase_value == 10.5 and rows["1"].link_clicks == 11
    assert rows["2"].purchases is None and rows["2"].add_to_cart is None


def test_creative_text_blank_is_missing(spark):
    schema = ("id string, title string, body string, image_url string, call_to_action_type string, "
              "object_story_spec struct<page_id:string, video_data:struct<message:string,title:string,"
              "video_id:string,image_url:string,call_to_action:struct<type:string>>, "
              "link_data:struct<message:string,name:string,image_url:string,picture:string,"
              "call_to_action:struct<type:string>>, photo_data:struct<message:string,image_url:string>>")
    df = spark.createDataFrame([("c1", "", "", None, "SHOP", ("p", None, ("link body", "Link", None, "pic", ("BUY",)),
                                                               None)),
                                ("c2", "T", "B", None, None, None)], schema)
    rows = {r.creative_id: r for r in fl.creative_text(df).collect()}
    assert (rows["c1"].title, rows["c1"].body, rows["c1"].cta_type, rows["c1"].image_url) == \
        ("Link", "link body", "BUY", "pic")
    assert (rows["c2"].title, rows["c2"].body, rows["c2"].cta_type) == ("T", "B", None)


def test_product_statuses_one_row_at_least(spark):
    schema = "productId string, title string, itemLevelIssues array<struct<code:string,description:string,servability:string>>"
    df = spark.createDataFrame([("p1", "a", None), ("p2", "b", [("x", "bad image", "disapproved"),
                                                                 ("y", "warn", "demoted")])], schema)
    rows = fl.product_statuses(df).collect()
    assert len([r for r in rows if r.product_id == "p1"]) == 1
    p2 = [r for r in rows if r.product_id == "p2"]
    assert len(p2) == 2 and p2[0].approval_status == "disapproved" and p2[0].disapproval_reasons == "bad image"


def test_misc_shapes(spark):
    z = spark.createDataFrame([("m", ["2024-01-01", "2024-01-02"], [5])], "metric string, dates array<string>, "
                                                                            "counts array<int>")
    assert [(r.date, r.value) for r in fl.zip_series(z).collect()] == [("2024-01-01", 5), ("2024-01-02", None)]
    assert rd.snake_name("unitsOrderedB2B") == "units_ordered_b2_b"
    t = spark.createDataFrame([("Visit https://www.shop.com/p?a=1 and https://other.com/x and "
                                "https://shop.com/q?utm_source=y",)], "d string")
    r = fl.tag_links(t, "d", ["shop.com"], "utm_source=yt").first()
    assert r.links_tagged == 1 and "https://www.shop.com/p?a=1&utm_source=yt" in r.d_tagged
    cust = spark.createDataFrame([(" A@x.com ", "Ann", ""), ("", "B", "C")], "email string, first_name string, "
                                                                            "last_name string")
    a = fl.audience_export(cust).collect()
    assert len(a) == 1 and a[0].hashed_first_name is None and len(a[0].hashed_email) == 64


def test_flatten_orders_from_json(spark):
    d = tempfile.mkdtemp(prefix="orders-json-")
    recs = [{"id": 1, "order_number": 1001, "created_at": "2024-01-31T23:00:00-05:00", "total_price": "20.00",
             "landing_site": "/?utm_source=fb+ads&utm_medium=paid", "customer": {"id": 7, "email": "a@b.c"},
             "total_shipping_price_set": {"shop_money": {"amount": "5.00"}},
             "line_items": [{"id": 11, "sku": "A", "quantity": 2, "price": "10.00", "total_discount": "0"}]},
            {"id": 2, "created_at": "2024-02-01T01:00:00Z", "total_price": "bad", "line_items": []}]
    with open(os.path.join(d, "part.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    schema = ("id long, order_number long, created_at string, updated_at string, financial_status string, "
              "fulfillment_status string, total_price string, subtotal_price string, total_tax string, "
              "total_discounts string, currency string, landing_site string, referring_site string, "
              "source_name string, cancelled_at string, cancel_reason string, tags string, note string, "
              "customer struct<id:long,email:string>, "
              "total_shipping_price_set struct<shop_money:struct<amount:string>>, "
              "line_items array<struct<id:long,product_id:long,variant_id:long,title:string,variant_title:string,"
              "sku:string,quantity:long,price:string,total_discount:string>>")
    raw = rd.read_feed(spark, d, schema)
    o = {r.order_id: r for r in fl.flatten_orders(raw).collect()}
    assert o[1].utm_source == "fb ads" and o[1].total_shipping == 5.0 and o[1].order_date == "2024-01-31"
    assert o[2].total_price == 0.0 and o[2].customer_id is None and o[2].total_shipping == 0.0
    lines = fl.flatten_order_lines(raw).collect()
    assert len(lines) == 1 and lines[0].price == 10.0


def test_streaming_merge_is_incremental(spark):
    src = tempfile.mkdtemp(prefix="landed-")
    tgt = tempfile.mkdtemp(prefix="merged-")
    ck = tempfile.mkdtemp(prefix="ck-")
    schema = "k long, v string, _loaded_at string"

    def land(name, rows):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(json.dumps(dict(zip(["k", "v", "_loaded_at"], r))) for r in rows))

    land("a.json", [(1, "a", "1"), (2, "b", "1")])
    ingest_stream(spark, src, schema, tgt, ["k"], ck, order_cols=["_loaded_at"])
    land("b.json", [(2, "B", "2"), (3, "c", "2")])
    ingest_stream(spark, src, schema, tgt, ["k"], ck, order_cols=["_loaded_at"])
    got = {r.k: r.v for r in read_latest(spark, tgt).collect()}
    assert got == {1: "a", 2: "B", 3: "c"}


def test_feed_program_and_traffic(spark):
    prog = spark.createDataFrame([("ENABLED", None), ("ENABLED", [("US", "ELIGIBLE", ["a", "b"])])],
                                 "state string, regionStatuses array<struct<regionCode:string,"
                                 "eligibilityStatus:string,reviewIssues:array<string>>>")
    rows = sorted((r.region_code, r.review_issues) for r in fl.program_status(prog).collect())
    assert rows == [("", ""), ("US", "a, b")]
    tr = spark.createDataFrame([("c1", "p1", (3, None, 4, (12.5, "USD")), (10, 20.5))],
                               "childAsin string, parentAsin string, salesByAsin struct<unitsOrdered:int,"
                               "unitsOrderedB2B:int,totalOrderItems:int,orderedProductSales:struct<amount:double,"
                               "currencyCode:string>>, trafficByAsin struct<browserSessions:int,buyBoxPercentage:double>")
    r = fl.flatten_traffic(tr, "2024-01-02").first()
    assert (r.units_ordered, r.units_ordered_b2b, r.browser_sessions, r.buy_box_percentage) == (3, 0, 10, 20.5)


def test_accounting_lines_and_entities(spark):
    schema = ("Id string, TxnDate string, TotalAmt double, EntityRef struct<value:string,name:string>, "
              "Line array<struct<Id:string,LineNum:int,Description:string,Amount:double,"
              "AccountBasedExpenseLineDetail:struct<AccountRef:struct<value:string,name:string>,"
              "CustomerRef:struct<value:string,name:string>,BillableStatus:string>>>")
    df = spark.createDataFrame([("9", "2024-01-02", 30.0, ("v1", "Acme"),
                                 [("1", 1, "", 10.0, (("a", "Software"), None, "NotBillable")),
                                  (None, 2, "paper", 20.0, (("b", "Office"), None, None))])], schema)
    lines = {r.line_item_id: r for r in fl.flatten_purchase_lines(df).collect()}
    assert set(lines) == {"9_1", "9_0"} and lines["9_1"].account_name == "Software"
    s = fl.purchase_summary(df).first()
    assert s.line_summary == "Software; paper" and s.line_count == 2
    v = spark.createDataFrame([("1", "Acme", None, None)], "Id string, DisplayName string, Balance double, "
                                                           "Active boolean")
    fields = {k: fl.VENDOR_FIELDS[k] for k in ("vendor_id", "display_name", "balance", "active")}
    r = fl.flatten_entity(v, fields).first()
    assert (r.vendor_id, r.balance, r.active) == ("1", 0.0, True)


def test_email_flatteners(spark):
    metrics = spark.createDataFrame([(("c1",), (100, 90, 40, 5, 1, 2.0, 55.5)), (("c9",), (1, 1, 0, 0, 0, 0.0, 0.0))],
                                    "groupings struct<campaign_id:string>, statistics struct<recipients:int,"
                                    "delivered:int,opens:int,clicks:int,unsubscribes:int,conversions:double,"
                                    "conversion_value:double>")
    camps = spark.createDataFrame([("c1", ("Launch", "2024-03-05T10:00:00+00:00"))],
                                  "id string, attributes struct<name:string,send_time:string>")
    rows = {r.campaign_id: r for r in fl.attach_campaign(metrics, camps).collect()}
    assert rows["c1"].send_date == "2024-03-05" and rows["c1"].revenue == 55.5 and rows["c9"].campaign_name is None
    flows = spark.createDataFrame([("f1", [("a1", [("m1", ("Welcome", "live", "email", None, None))]),
                                           ("a2", [])])],
                                  "id string, actions array<struct<id:string,messages:array<struct<id:string,"
                                  "attributes:struct<name:string,status:string,channel:string,created_at:string,"
                                  "updated_at:string>>>>>")
    m = fl.flatten_flow_messages(flows).collect()
    assert [(r.id, r.flow_id, r.action_id, r.name) for r in m] == [("m1", "f1", "a1", "Welcome")]


def test_entity_flatteners(spark):
    ads = spark.createDataFrame([("1", "ad", "s", "c", "ACTIVE", ("cr1",), "2025-06-23T09:19:47-0600", "bad")],
                                "id string, name string, adset_id string, campaign_id string, status string, "
                                "creative struct<id:string>, created_time string, updated_time string")
    r = fl.flatten_social("ads", ads).first()
    assert r.creative_id == "cr1" and r.created_time == dt.datetime(2025, 6, 23, 15, 19, 47) and r.updated_time is None
    ch = spark.createDataFrame([("UC1", ("My channel",), ("1200", None, "7", None))],
                               "id string, snippet struct<title:string>, statistics struct<subscriberCount:string,"
                               "viewCount:string,videoCount:string,hiddenSubscriberCount:boolean>")
    c = fl.flatten_channel_stats(ch, "2024-02-01").first()
    assert (c.subscriber_count, c.view_count, c.video_count, c.hidden_subscriber_count) == (1200, 0, 7, False)


def test_ads_resources(spark):
    schema = ("segments struct<date:string>, campaign struct<id:long,name:string,advertising_channel_type:string>, "
              "ad_group struct<id:long,name:string>, metrics struct<impressions:long,clicks:long,cost_micros:long,"
              "average_cpc:long,ctr:double,conversions:double,conversions_value:double,cost_per_conversion:long,"
              "search_impression_share:double>")
    df = spark.createDataFrame([(("2024-01-01",), (1, "c", "SEARCH"), (2, "g"),
                                 (100, 5, 12_340_000, 2_468_000, 0.05, 0.0, 0.0, 0, 0.0))], schema)
    r = fl.flatten_ads("daily_insights", df).first()
    assert (r.spend, r.cpc, r.cost_per_conversion, r.search_impression_share) == (12.34, 2.468, None, None)
    camps = spark.createDataFrame([(1, "b/1"), (2, None)], "campaign_id long, campaign_budget string")
    budgets = spark.createDataFrame([("b/1", 5_000_000)], "resource_name string, amount_micros long")
    got = {r.campaign_id: r.budget_amount for r in fl.attach_budget(camps, budgets).collect()}
    assert got == {1: 5.0, 2: None}


def test_alt_text_changes(spark):
    schema = ("id long, title string, handle string, images array<struct<id:long,alt:string,src:string,"
              "variant_ids:array<bigint>>>, variants array<struct<id:long,title:string>>")
    prods = spark.createDataFrame([
        (1, "House Brand Paddle | Pro", "paddle", [(10, "", "a.jpg", [7, 8]), (11, "kept", "b.jpg", None)],
         [(7, "Default Title"), (8, "Blue")]),
        (2, "Ball", "ball-old", [(20, None, "c.jpg", None), (21, " ", "d.jpg", None), (22, None, "e.jpg", None)], [])],
        schema)
    pats = spark.createDataFrame([("ball", 0, "Ball front"), ("ball", 1, "Ball side")], "handle string, position int, alt string")
    al = spark.createDataFrame([("ball-old", "ball")], "alias string, handle string")
    got = {r.image_id: r.proposed_alt for r in fl.alt_text_changes(prods, pats, al).collect()}
    assert got == {10: "House Brand Paddle — Pro — Blue — image 1", 20: "Ball front", 21: "Ball side",
                   22: "Ball front — additional view 3"}
    assert fl.alt_text_changes(prods, pats, al, overwrite=True).count() == 5


def test_all_ads_resources_have_specs(spark):
    assert len(fl.ADS_SPECS) == 18
    schema = ("segments struct<date:string,auction_insight_domain:string>, campaign struct<id:long,name:string>, "
              "metrics struct<auction_insight_search_impression_share:double,auction_insight_search_overlap_rate:double,"
              "auction_insight_search_position_above_rate:double,"
              "auction_insight_search_top_impression_percentage:double,auction_insight_search_outranking_share:double>")
    df = spark.createDataFrame([(("2024-01-01", "rival.com"), (1, "c"), (0.5, 0.0, 0.1, 0.2, 0.3)),
                                (("2024-01-01", ""), (1, "c"), (0.5, 0.0, 0.1, 0.2, 0.3))], schema)
    rows = fl.flatten_auction_insights(df).collect()
    assert len(rows) == 1 and rows[0].impression_share == 0.5 and rows[0].overlap_rate is None


def test_tag_links_repeated_and_nested(spark):
    text = "https://ex.com https://ex.com/page and https://ex.com (https://www.ex.com/a?b=1#c) https://other.com https://ex.com?utm_source=z"
    r = fl.tag_links(spark.createDataFrame([(text,), (None,)], "d string"), "d", ["ex.com"], "utm_source=yt").collect()
    assert r[0].d_tagged == ("https://ex.com?utm_source=yt https://ex.com/page?utm_source=yt and https://ex.com?utm_source=yt "
                             "(https://www.ex.com/a?b=1#c&utm_source=yt) https://other.com https://ex.com?utm_source=z")
    assert r[0].links_tagged == 3 and r[1].d_tagged is None


def test_merge_upsert_takes_new_columns_and_lacks_old_ones(spark):
    from marginalia.sources.merge import merge_upsert
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, x string, y int")
    new = spark.createDataFrame([(2, "c", True), (3, "d", False)], "id long, x string, z boolean")
    got = sorted(tuple(r) for r in merge_upsert(old, new, ["id"]).collect())
    assert got == [(1, "a", 5, None), (2, "c", None, True), (3, "d", None, False)]


def test_to_utc_fractions_dates_and_rubbish(spark):
    vals = ["2025-06-23T09:19:47-0600", "2025-06-23T09:19:47.250-06:00", "2025-06-23", "2025-06-23T09:19:47Z", "2025", "x", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string").select("i", fl.to_utc("v").cast("string").alias("t"))
    got = [r.t for r in df.orderBy("i").collect()]
    assert got == ["2025-06-23 15:19:47", "2025-06-23 15:19:47.25", "2025-06-23 00:00:00", "2025-06-23 09:19:47", None, None, None]


def test_utm_param_skips_blank_and_fragment(spark):
    from marginalia.functions.columns import utm_param
    vals = ["http://a/?utm_source=&utm_source=x", "http://a/?b=1#utm_source=y", "http://a/?b=1&utm_source=q+r%21#z"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string").select("i", utm_param("v", "source").alias("t"))
    assert [r.t for r in df.orderBy("i").collect()] == ["x", None, "q r!"]
