"""Landed payloads that drift: types, missing objects, unreadable text, rejects."""

import datetime as dt
import json

from marginalia.plans import QUERIES
from marginalia.sources import landing as ld


def payloads(spark, *rows):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in rows], "payload string")


def test_numbers_in_any_dress(spark):
    """I-10: numbers as text, whole numbers with a fraction, bad values and nulls."""
    spec = "a a bigint\nb b double 0\nc c.d date\nf f boolean true"
    rows = [{"a": "1000", "b": "12.34", "c": {"d": "2024-01-02"}, "f": False}, {"a": 3.0, "b": 5}, {"a": "3.0", "b": None, "c": "2024"}, {"a": "not_a_number", "b": "bad"},
            {"a": 9007199254740993}, {"a": [1], "f": "false"}, {}, "no json", None, [1, 2]]
    got = ld.read_fields(ld.land(payloads(spark, *rows)), spec, keep=("unreadable",)).collect()
    assert [(r.a, r.b, r.c, r.f, r.rejected, r.unreadable) for r in got] == [
        (1000, 12.34, dt.date(2024, 1, 2), False, [], False), (3, 5.0, None, True, [], False), (3, 0.0, None, True, [], False), (None, 0.0, None, True, ["a", "b"], False),
        (9007199254740993, 0.0, None, True, [], False), (None, 0.0, None, False, ["a"], False), (None, 0.0, None, True, [], False), (None, 0.0, None, True, [], True),
        (None, 0.0, None, True, [], False), (None, 0.0, None, True, [], False)]
    read = ld.read_fields(ld.land(payloads(spark, *rows)), spec)
    assert {r.field: r.rows for r in ld.reject_counts(read).collect()} == {"a": 2, "b": 1}


def test_shape_shows_the_drift(spark):
    shape = ld.shape(ld.land(payloads(spark, {"a": 1, "b": "x"}, {"a": "1", "b": "y"}, "bad"))).first()[0]
    assert "a: VARIANT" in shape and "b: STRING" in shape


def test_every_feed_reads_an_empty_payload(spark):
    for feed, (spec, computed) in ld.FEEDS.items():
        row = ld.read_feed(payloads(spark, {}), feed).first()
        assert row.__fields__ == [f[0] for f in ld.fields(spec)] + [*computed, "rejected"], feed
        assert row.rejected == []


def test_actions_take_the_first_alias_and_its_last_entry(spark):
    acts = [{"action_type": "purchase", "value": "9"}, {"action_type": "omni_purchase", "value": "1"}, {"action_type": "omni_purchase", "value": "2.0"}, {"action_type": "link_click", "value": "x"}]
    row = ld.read_feed(payloads(spark, {"ad_id": 5, "actions": acts, "action_values": "drifted"}), "social_daily_insights").first()
    assert (row.ad_id, row.purchases, row.link_clicks, row.add_to_cart, row.purchase_value) == ("5", 2, None, None, None)


def test_lines_and_accounts(spark):
    doc = {"Id": 7, "TxnDate": "2024-01-02", "Line": [{"Id": "1", "Amount": "2.5", "DetailType": "SalesItemLineDetail", "SalesItemLineDetail": {"Qty": "2"}},
                                                     {"DetailType": "SubTotalLineDetail"}, {"Amount": 1}]}
    got = ld.read_lines(payloads(spark, doc, {"Id": 8}, {"Id": 9, "Line": "none"}), "invoice_lines").collect()
    assert [(r.line_item_id, r.quantity, r.amount) for r in got] == [("7_1", 2.0, 2.5), ("7_0", 0.0, 1.0)]
    pay = ld.read_feed(payloads(spark, {"CreditCardPayment": {"CCAccountRef": {"value": 3, "name": "Card"}}}, {"CheckPayment": {"BankAccountRef": {"value": "4"}}}), "bill_payments").collect()
    assert [(r.account_id, r.account_name) for r in pay] == [("3", "Card"), ("4", None)]


def test_the_landed_feeds_are_read_in_one_scan(spark):
    plan = QUERIES["landed_wallet_transactions"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_creative_text_from_the_first_place_that_has_one(spark):
    """I-20: blank texts count as missing; the link counts only without a text above it, the photo only without a link's."""
    story = {"page_id": "p", "instagram_actor_id": "a",
             "video_data": {"message": "", "title": "V", "video_id": "v", "call_to_action": None, "link_description": "vd"},
             "link_data": {"message": "L", "name": "LN", "description": "LD", "picture": "pic", "call_to_action": {"type": "BUY"}},
             "photo_data": {"message": "P", "image_url": "photo"}}
    rows = [{"id": "1", "title": "", "body": "", "image_url": None, "call_to_action_type": "SHOP", "object_story_spec": story, "thumbnail_url": "t", "object_type": "VIDEO"},
            {"id": "2", "body": "own", "call_to_action_type": "SHOP", "object_story_spec": story},
            {"id": "3", "object_story_spec": {"link_data": {"name": "only a name"}, "photo_data": {"message": "P", "image_url": "photo"}}},
            {"id": "4", "title": "T", "object_story_spec": "gone"}]
    got = {r.creative_id: r for r in ld.read_feed(payloads(spark, *rows), "creatives").collect()}
    pick = lambda k: tuple(got[k][x] for x in ("title", "body", "link_description", "cta_type", "image_url"))
    assert pick("1") == ("V", "L", "vd", "BUY", "pic")
    assert (got["1"].video_id, got["1"].thumbnail_url, got["1"].object_type, got["1"].page_id, got["1"].instagram_actor_id) == ("v", "t", "VIDEO", "p", "a")
    assert pick("2") == ("V", "own", "vd", "SHOP", None)
    assert pick("3") == ("only a name", "P", None, None, "photo")
    assert pick("4") == ("T", None, None, None, None)
