"""Landed payloads of drifting shape (I-01, I-10) and the feeds read from them.

A payload is parsed once into a ``VARIANT``, so a field that changes its type, moves into an object or vanishes is
no analysis error: it is NULL, and where it is there but cannot be read as the contract's type its name stands in
``rejected``.  A feed is data: lines of ``output path type [default]``; computed fields are columns over the variant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.columns import blank_as_null
from marginalia.sources.flatten import ACTION_ALIASES, WALLET_STATUS, invoice_status, to_utc

_V = "_payload"


def land(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The payload as a variant beside the other columns; ``unreadable`` marks text that is no JSON."""
    v = F.try_parse_json(F.col(payload))
    return df.withColumn(_V, v).withColumn("unreadable", F.col(payload).isNotNull() & F.col(_V).isNull()).drop(payload)


def shape(landed: DataFrame) -> DataFrame:
    """(shape): the schema that all payloads share, with VARIANT where they differ: what has drifted shows at a glance."""
    return landed.where(F.col(_V).isNotNull()).agg(F.schema_of_variant_agg(_V).alias("shape"))


def get(path: str, kind: str, v: Column | str = _V) -> Column:
    """A field as ``kind``, tolerantly (I-10): numbers may be text, whole numbers may have a fraction ('3.0' is 3), bad values are NULL."""
    v = F.col(v) if isinstance(v, str) else v
    at = path if path == "$" else f"$.{path}"
    text = F.try_variant_get(v, at, "string")
    if kind == "bigint":
        return F.coalesce(F.try_variant_get(v, at, "bigint"), text.try_cast("double").try_cast("bigint"))
    if kind == "utc":
        return to_utc(text)
    return F.try_variant_get(v, at, kind)


def _there(path: str) -> Column:
    x = F.try_variant_get(F.col(_V), f"$.{path}", "variant")
    return x.isNotNull() & ~F.is_variant_null(x)


def fields(spec: str) -> list[tuple]:
    """(output, path, type, default or None) of each line."""
    out = []
    for line in spec.strip().splitlines():
        name, path, kind, *rest = line.split()
        out.append((name, path, kind, rest[0] if rest else None))
    return out


def read_fields(landed: DataFrame, spec: str, computed: dict[str, Callable[[], Column]] | None = None, keep: tuple = ()) -> DataFrame:
    """The feed's columns, then the computed ones, then ``rejected``: the names of fields that are there and not readable.

    A value is read once, in a projection of its own; whether a field is there is only asked where its value is NULL.
    """
    rows, made = fields(spec), computed or {}
    lists = {k: b for f in made.values() for k, b in getattr(f, "needs", {}).items()}
    read = landed.select(*keep, _V, *[get(path, kind).alias(f"_val_{name}") for name, path, kind, _ in rows], *[b().alias(k) for k, b in lists.items()])
    cols, bad = [], []
    for name, path, kind, default in rows:
        value = F.col(f"_val_{name}")
        bad.append(F.when(value.isNull() & _there(path), F.lit(name)))
        cast = "timestamp" if kind == "utc" else kind
        cols.append((value if default is None else F.coalesce(value, F.lit(default).cast(cast))).alias(name))
    rejected = F.array_compact(F.array(*bad))
    return read.select(*keep, *cols, *[f().alias(name) for name, f in made.items()], rejected.alias("rejected"))


def reject_counts(read: DataFrame) -> DataFrame:
    """(field, rows): how often each field was there and not readable; one pass over the feed."""
    return read.select(F.explode("rejected").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("rows"))


# ---- computed fields ------------------------------------------------------------------------------

def _list(path: str) -> Column:
    """An array of variants; empty if it is missing or no array."""
    return F.coalesce(get(path, "array<variant>"), F.array().cast("array<variant>"))


def _latest(source: str) -> Callable[[], Column]:
    """(kind, value) of the entries of an action list, last first; each is read once, whatever asks for it."""
    entry = lambda a: F.struct(get("action_type", "string", a).alias("kind"), get("value", "variant", a).alias("value"))
    return lambda: F.reverse(F.transform(_list(source), entry))


def _action(column: str) -> Callable[[], Column]:
    """I-19 over a variant: the first alias that is there, its last entry."""
    source = "action_values" if column.endswith("_value") else "actions"
    kind = "double" if column.endswith("_value") else "bigint"
    entries = f"_latest_{source}"

    def build():
        places = [F.nullif(F.array_position(F.col(entries)["kind"], alias), F.lit(0)) for alias in ACTION_ALIASES[column]]
        return get("$", kind, F.get(F.col(entries)["value"], (F.coalesce(*places) - 1).cast("int")))

    build.needs = {entries: _latest(source)}
    return build


def _described_lines() -> Column:
    """Line descriptions, else the line's account, without empty ones."""
    texts = F.transform(_list("Line"), lambda l: F.coalesce(
        blank_as_null(get("Description", "string", l)), blank_as_null(get("AccountBasedExpenseLineDetail.AccountRef.name", "string", l))))
    return F.array_compact(texts)


def _item_lines() -> Column:
    """I-43: the sum of the item lines."""
    items = F.filter(_list("Line"), lambda l: get("DetailType", "string", l) == "SalesItemLineDetail")
    return F.aggregate(items, F.lit(0.0), lambda s, l: s + F.coalesce(get("Amount", "double", l), F.lit(0.0)))


def _deposit_sources() -> Column:
    """I-44: of lines with a positive amount the entity, else the memo, else the account, else 'unknown'."""
    lines = F.filter(_list("Line"), lambda l: F.coalesce(get("Amount", "double", l), F.lit(0.0)) > 0)
    return F.array_join(F.transform(lines, lambda l: F.coalesce(*[blank_as_null(get(p, "string", l)) for p in (
        "DepositLineDetail.Entity.name", "Description", "DepositLineDetail.AccountRef.name")], F.lit("unknown"))), ", ")


def _paying_account(part: str) -> Column:
    """I-47: the cheque's bank account, else the card's."""
    return F.coalesce(*[get(f"{x}.{part}", "string") for x in ("CheckPayment.BankAccountRef", "CreditCardPayment.CCAccountRef")])


def _wallet_status() -> Column:
    code = get("transaction_info.transaction_status", "string")
    known = F.create_map(*[F.lit(x) for kv in WALLET_STATUS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, code), code)


def _payer_name() -> Column:
    """The payer's full name: given and family name, else the alternate one."""
    n = [get(f"payer_info.payer_name.{x}", "string") for x in ("given_name", "surname", "alternate_full_name")]
    return F.coalesce(F.nullif(F.trim(F.concat_ws(" ", n[0], n[1])), F.lit("")), blank_as_null(n[2]))


#: Texts of a creative: paths tried always, paths while there is no text yet, paths while the link has none either, last resort (fixed values).
_VIDEO, _LINK, _PHOTO = (f"object_story_spec.{x}_data" for x in ("video", "link", "photo"))
CREATIVE_SOURCES = {
    "title": (("title", f"{_VIDEO}.title"), (f"{_LINK}.name",), (), ()),
    "body": (("body", f"{_VIDEO}.message"), (f"{_LINK}.message",), (f"{_PHOTO}.message",), ()),
    "link_description": ((f"{_VIDEO}.link_description",), (f"{_LINK}.description",), (), ()),
    "cta_type": ((f"{_VIDEO}.call_to_action.type",), (f"{_LINK}.call_to_action.type",), (), ("call_to_action_type",)),
    "image_url": (("image_url", f"{_VIDEO}.image_url"), (f"{_LINK}.image_url", f"{_LINK}.picture"), (f"{_PHOTO}.image_url",), ()),
}


def _creative(column: str) -> Callable[[], Column]:
    """I-20: a creative's text from the first place that has one; blank ones count as missing."""
    def first(paths):
        return F.coalesce(F.lit(None).cast("string"), *[blank_as_null(get(p, "string")) for p in paths])

    def build():
        always, link, photo, last = CREATIVE_SOURCES[column]
        text, linked = first(CREATIVE_SOURCES["body"][0]), first(CREATIVE_SOURCES["body"][1])
        return F.coalesce(first(always), F.when(text.isNull(), first(link)), F.when(text.isNull() & linked.isNull(), first(photo)), first(last))

    return build


_STAMPS = """
created_at MetaData.CreateTime string
updated_at MetaData.LastUpdatedTime string"""

#: feed -> (fields, computed fields).  Names, paths and defaults are the feeds' own contracts (fixed values).
FEEDS: dict[str, tuple[str, dict[str, Callable[[], Column]]]] = {
    "social_daily_insights": ("""
date_start date_start date
campaign_id campaign_id string
campaign_name campaign_name string
adset_id adset_id string
adset_name adset_name string
ad_id ad_id string
ad_name ad_name string
impressions impressions bigint
clicks clicks bigint
spend spend double
cpc cpc double
cpm cpm double
ctr ctr double
reach reach bigint
frequency frequency double""", {c: _action(c) for c in ACTION_ALIASES}),
    "creatives": ("""
creative_id id string
video_id object_story_spec.video_data.video_id string
thumbnail_url thumbnail_url string
object_type object_type string
page_id object_story_spec.page_id string
instagram_actor_id object_story_spec.instagram_actor_id string""", {c: _creative(c) for c in CREATIVE_SOURCES}),
    "invoices": ("""
invoice_id Id string
doc_number DocNumber string
txn_date TxnDate date
due_date DueDate date
customer_id CustomerRef.value string
customer_name CustomerRef.name string
total_amount TotalAmt double 0
balance Balance double 0
currency CurrencyRef.value string USD
email_status EmailStatus string
billing_email BillEmail.Address string
ship_date ShipDate date
tracking_num TrackingNum string
apply_tax_after_discount ApplyTaxAfterDiscount boolean""" + _STAMPS, {
        "txn_status": lambda: invoice_status(*[F.coalesce(get(p, "double"), F.lit(0.0)) for p in ("Balance", "TotalAmt")])}),
    "bills": ("""
bill_id Id string
txn_date TxnDate date
due_date DueDate date
vendor_id VendorRef.value string
vendor_name VendorRef.name string
total_amount TotalAmt double 0
balance Balance double 0
doc_number DocNumber string
memo PrivateNote string
currency CurrencyRef.value string USD""" + _STAMPS, {"line_summary": lambda: F.array_join(F.slice(_described_lines(), 1, 5), "; ")}),
    "purchases": ("""
purchase_id Id string
txn_date TxnDate date
payment_type PaymentType string
total_amount TotalAmt double 0
account_id AccountRef.value string
account_name AccountRef.name string
vendor_id EntityRef.value string
vendor_name EntityRef.name string
entity_type EntityRef.type string
doc_number DocNumber string
memo PrivateNote string
currency CurrencyRef.value string USD
credit Credit boolean false""" + _STAMPS, {"line_count": lambda: F.size(_list("Line")).cast("bigint"),
                                           "line_summary": lambda: F.array_join(F.slice(_described_lines(), 1, 5), "; ")}),
    "sales_receipts": ("""
sales_receipt_id Id string
doc_number DocNumber string
txn_date TxnDate date
customer_id CustomerRef.value string
customer_name CustomerRef.name string
total_amount TotalAmt double 0
payment_method_id PaymentMethodRef.value string
payment_method_name PaymentMethodRef.name string
deposit_to_account_id DepositToAccountRef.value string
deposit_to_account_name DepositToAccountRef.name string
currency CurrencyRef.value string USD
memo PrivateNote string""" + _STAMPS, {"subtotal_amount": _item_lines}),
    "deposits": ("""
deposit_id Id string
txn_date TxnDate date
total_amount TotalAmt double 0
deposit_to_account_id DepositToAccountRef.value string
deposit_to_account_name DepositToAccountRef.name string
currency CurrencyRef.value string USD
memo PrivateNote string""" + _STAMPS, {"source_summary": _deposit_sources, "line_count": lambda: F.size(_list("Line")).cast("bigint")}),
    "bill_payments": ("""
bill_payment_id Id string
txn_date TxnDate date
vendor_id VendorRef.value string
vendor_name VendorRef.name string
total_amount TotalAmt double 0
pay_type PayType string
doc_number DocNumber string
currency CurrencyRef.value string USD""" + _STAMPS, {
        "account_id": lambda: _paying_account("value"), "account_name": lambda: _paying_account("name")}),
    "customers": ("""
customer_id Id string
display_name DisplayName string
company_name CompanyName string
given_name GivenName string
family_name FamilyName string
email PrimaryEmailAddr.Address string
phone PrimaryPhone.FreeFormNumber string
city BillAddr.City string
state BillAddr.CountrySubDivisionCode string
postal_code BillAddr.PostalCode string
country BillAddr.Country string
balance Balance double 0
active Active boolean true
is_project IsProject boolean false""" + _STAMPS, {}),
    "accounts": ("""
account_id Id string
name Name string
fully_qualified_name FullyQualifiedName string
account_type AccountType string
account_sub_type AccountSubType string
classification Classification string
current_balance CurrentBalance double 0
currency CurrencyRef.value string USD
active Active boolean true""" + _STAMPS, {}),
    "items": ("""
item_id Id string
name Name string
fully_qualified_name FullyQualifiedName string
type Type string
description Description string
unit_price UnitPrice double 0
purchase_cost PurchaseCost double 0
sku Sku string
quantity_on_hand QtyOnHand double
income_account_id IncomeAccountRef.value string
income_account_name IncomeAccountRef.name string
expense_account_id ExpenseAccountRef.value string
expense_account_name ExpenseAccountRef.name string
active Active boolean true
taxable Taxable boolean false""" + _STAMPS, {}),
    "store_customers": ("""
customer_id id bigint
email email string
first_name first_name string
last_name last_name string
orders_count orders_count bigint
total_spent total_spent double 0
created_at created_at string
updated_at updated_at string
state state string
accepts_marketing accepts_marketing boolean false
city default_address.city string
province default_address.province string
country default_address.country string
tags tags string""", {}),
    "wallet_transactions": ("""
transaction_id transaction_info.transaction_id string
transaction_date transaction_info.transaction_initiation_date utc
transaction_updated_date transaction_info.transaction_updated_date utc
transaction_amount transaction_info.transaction_amount.value double 0
fee_amount transaction_info.fee_amount.value double 0
currency_code transaction_info.transaction_amount.currency_code string
transaction_event_code transaction_info.transaction_event_code string
transaction_subject transaction_info.transaction_subject string
transaction_note transaction_info.transaction_note string
paypal_reference_id transaction_info.paypal_reference_id string
paypal_reference_id_type transaction_info.paypal_reference_id_type string
invoice_id transaction_info.invoice_id string
custom_field transaction_info.custom_field string
payer_email payer_info.email_address string
payer_account_id payer_info.account_id string
payer_given_name payer_info.payer_name.given_name string
payer_surname payer_info.payer_name.surname string
payer_alternate_name payer_info.payer_name.alternate_full_name string""", {
        "transaction_status": _wallet_status, "payer_full_name": _payer_name,
        "first_item_name": lambda: get("item_name", "string", F.try_element_at(_list("cart_info.item_details"), F.lit(1))),
        "item_count": lambda: F.size(_list("cart_info.item_details")).cast("bigint")}),
    "videos": ("""
video_id id string
title snippet.title string
description snippet.description string
published_at snippet.publishedAt utc
channel_id snippet.channelId string
category_id snippet.categoryId string
duration contentDetails.duration string
thumbnail_url snippet.thumbnails.high.url string
privacy_status status.privacyStatus string
made_for_kids status.madeForKids boolean false""", {"tags": lambda: F.array_join(F.transform(_list("snippet.tags"), lambda t: t.try_cast("string")), ",")}),
    "video_analytics": ("""
video_id video string
views views bigint 0
estimated_minutes_watched estimatedMinutesWatched double 0
avg_view_duration_seconds averageViewDuration double 0
avg_view_percentage averageViewPercentage double 0
likes likes bigint 0
comments comments bigint 0
shares shares bigint 0
subscribers_gained subscribersGained bigint 0
subscribers_lost subscribersLost bigint 0""", {}),
    "channel_days": ("""
report_date day date
views views bigint 0
estimated_minutes_watched estimatedMinutesWatched double 0
avg_view_duration_seconds averageViewDuration double 0
subscribers_gained subscribersGained bigint 0
subscribers_lost subscribersLost bigint 0""", {}),
}

#: Lines of a document, one row each: (array, fields of the document, fields of a line, line types left out).
LINES = {
    "invoice_lines": ("invoice_id", "SubTotalLineDetail", """
line_num LineNum bigint
description Description string
item_id SalesItemLineDetail.ItemRef.value string
item_name SalesItemLineDetail.ItemRef.name string
quantity SalesItemLineDetail.Qty double 0
unit_price SalesItemLineDetail.UnitPrice double 0
amount Amount double 0
discount_rate SalesItemLineDetail.DiscountRate double 0
tax_code SalesItemLineDetail.TaxCodeRef.value string"""),
}


def read_feed(df: DataFrame, feed: str, payload: str = "payload") -> DataFrame:
    """A landed feed by its contract (I-16, I-20, I-39, I-40, I-43..I-45, I-47, I-48, I-57, I-59)."""
    spec, computed = FEEDS[feed]
    return read_fields(land(df, payload), spec, computed)


def read_lines(df: DataFrame, feed: str, payload: str = "payload") -> DataFrame:
    """I-41: a document's lines with its id, day and customer; a line's id is '<document>_<line id or 0>'."""
    document, left_out, spec = LINES[feed]
    head = land(df, payload).select(get("Id", "string").alias(document), get("TxnDate", "date").alias("txn_date"),
                                    get("CustomerRef.value", "string").alias("customer_id"), F.explode(_list("Line")).alias(_V))
    head = head.where(F.coalesce(get("DetailType", "string") != left_out, F.lit(True)))
    line_id = F.concat_ws("_", F.col(document), F.coalesce(get("Id", "string"), F.lit("0"))).alias("line_item_id")
    return read_fields(head, spec, keep=(line_id, document, "txn_date", "customer_id"))


def zip_report(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A report answer (``columnHeaders`` and ``rows``) as one payload per row, each an object by header."""
    v = land(df, payload)
    names = F.transform(_list("columnHeaders"), lambda h: get("name", "string", h))
    rows = v.select(names.alias("names"), F.explode(_list("rows")).alias("r"))
    values = F.transform(F.try_variant_get("r", "$", "array<variant>"), lambda x: x.try_cast("string"))
    return rows.select(F.to_json(F.map_from_arrays("names", F.transform("names", lambda _, i: F.try_element_at(values, i + 1)))).alias("payload"))
