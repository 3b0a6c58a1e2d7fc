import json
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import flatten
from orderlake.plans import registry


def as_of():
    return F.lit("2025-09-18 12:00:00").cast("timestamp")


ROWS = [
    {"rowNumber": 1, "sku": "A", "vatRate": 0.25, "offers": [{"campaignId": "C1", "discount": 2.5}]},
    {"rowNumber": 2, "sku": "B", "offers": []},
]
DOC = {
    "orderNumber": "7",
    "orderDate": "2025-09-18T06:05:10Z",
    "salesBrand": "shop",
    "unknownField": 1,
    "status": {"value": "sent", "title": "Sent"},
    "source": {"name": "web", "isExternal": True},
    "invoiceAddress": {"firstName": "Ann", "address": {"city": "Oslo"}},
    "total": {"totalAmount": 12.5},
    "payments": [{"title": "Card", "psp": "p", "method": "card", "amount": 12.5}, None],
    "offers": [{"campaignId": "K", "discount": 1.0}],
    "buckets": [
        {"bucketNumber": 1, "deliveredFrom": {"name": "W"}, "shipping": {"fee": 4.0}, "rows": ROWS},
        {"bucketNumber": 2, "rows": []},
        {"bucketNumber": 3},
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    """One raw history-grain row."""
    text = {c: json.dumps(DOC[c]) if c in DOC else None for c in schemas.RAW_JSON_H}
    values = {**{k: DOC.get(k) for k in ("orderNumber", "orderDate", "salesBrand")}, **text}
    schema = schemas.struct(schemas.RAW_H)
    return spark.createDataFrame([tuple(values.get(n) for n in schema.names)], schema)


@pytest.fixture(scope="module")
def keyed(raw):
    return flatten.preprocess_bronze(raw, as_of())


@pytest.fixture(scope="module")
def events(spark):
    bodies = [DOC, {"orderNumber": "8", "buckets": [], "payments": None}]
    enqueued = datetime(2025, 9, 18, 6, 6)
    df = spark.createDataFrame(
        [(json.dumps(b), enqueued, Decimal(1), "1", "k") for b in bodies], schemas.ENVELOPE
    )
    return flatten.parse_events(df)


def test_preprocess(keyed):
    row = keyed.first()
    assert (row.status_value, row.status_title) == ("sent", "Sent")
    assert row.orderDate == datetime(2025, 9, 18, 8, 5, 10)
    assert row.updated_datetime == datetime(2025, 9, 18, 12)


@pytest.mark.parametrize(
    "name, count, columns",
    [("order", 1, 33), ("payment", 2, 11), ("offerhead", 1, 9), ("bucket", 3, 31), ("row", 2, 34), ("offerline", 1, 9)],
)
def test_history_tables(keyed, name, count, columns):
    out = registry.apply(keyed, name)
    assert out.count() == count
    assert len(out.columns) == columns
    assert out.columns[:4] == [f"{name}_bk", f"{name}_hashkey", "orderNumber", "status_value"]


@pytest.mark.parametrize("name", list(registry.transforms()))
def test_parsed_batch_gives_the_same_as_text(keyed, name):
    assert rows(registry.apply(flatten.parse_raw(keyed), name)) == rows(registry.apply(keyed, name))


def test_null_fill_of_payments(keyed):
    out = flatten.flatten_payment_h(keyed)
    got = rows(out, "payment_bk", "title", "pspReference", "alternative")
    # a NULL array element stays a row of NULLs: a field set on a NULL struct is NULL
    assert got == [("7_sent", None, None, None), ("7_sent_Card_p_card_", "Card", "", "")]


def test_offer_key_skips_the_missing_activation_code(keyed):
    assert rows(flatten.flatten_offerhead_h(keyed), "offerhead_bk") == [("7_sent_K",)]


def test_names_of_row_and_bucket_columns(keyed):
    row = flatten.flatten_row_h(keyed).columns
    assert {"SKU", "URL", "VATRate", "ImageName", "source_isExternal", "BucketNumber"} <= set(row)
    bucket = flatten.flatten_bucket_h(keyed).columns
    assert {"DeliveredFrom_name", "deliveryAddress_address_PostalCode", "shipping_carrier_Code"} <= set(bucket)


def test_offer_lines(keyed):
    got = rows(flatten.flatten_offerline_h(keyed), "offerline_bk", "CampaignId", "Discount")
    assert got == [("7_sent_1_1_C1", "C1", 2.5)]


def test_snapshot_tables(events):
    order = flatten.flatten_order_s(events, as_of())
    assert len(order.columns) == 33
    assert rows(order, "order_bk", "invoiceAddress_address_city", "total_totalAmount") == [
        ("7", "Oslo", 12.5),
        ("8", None, None),
    ]
    payment = flatten.flatten_payment_s(events, as_of())
    assert len(payment.columns) == 12
    assert rows(payment, "payment_bk") == [("7_Card_p_card_",), ("7____",)]
    row = flatten.flatten_row_s(events, as_of())
    assert len(row.columns) == 35
    assert rows(row, "bucket_bk", "row_bk", "SKU") == [("7_1", "7_1_1", "A"), ("7_1", "7_1_2", "B")]


def test_inner_expansion_drops_and_outer_keeps(events):
    outer = flatten.flatten_row_s(events, as_of(), outer=True)
    assert rows(outer, "row_bk") == [("7_1_1",), ("7_1_2",), ("7_2_",), ("7_3_",), ("8__",)]


def test_current_time_is_the_default_clock(events):
    stamped = flatten.flatten_order_s(events).first().updated_datetime
    assert abs((datetime.now() - stamped).total_seconds()) < 600


def test_malformed_text(spark, keyed):
    broken = keyed.withColumns(
        {
            "source": F.lit("{oops"),
            "payments": F.lit('[{"title":'),
            "offers": F.lit('{"campaignId":"single"}'),
            "buckets": F.lit('[{"bucketNumber":1.5,"rows":[{"rowNumber":2,"orderedQuantity":2.5}]}]'),
        }
    )
    order = flatten.flatten_order_h(broken).first()
    assert order.source_name is None and order.orderNumber == "7"
    assert flatten.flatten_payment_h(broken).count() == 0
    assert rows(flatten.flatten_offerhead_h(broken), "campaignId") == [("single",)]
    assert rows(flatten.flatten_row_h(broken), "BucketNumber", "RowNumber", "OrderedQuantity") == [
        (None, 2, None)
    ]


def test_prune_looks_through_arrays(spark):
    kind = schemas.prune(
        schemas.struct("a STRING, b STRING, c ARRAY<STRUCT<x INT, y STRUCT<z INT, w INT>>>"),
        ["b", "c.y.z"],
    )
    assert kind.simpleString() == "struct<b:string,c:array<struct<y:struct<z:int>>>>"


def test_text_is_parsed_once_and_without_a_shuffle(keyed):
    out = flatten.flatten_row_h(keyed)
    text = plan(out)
    assert "Exchange" not in text
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert not any("from_json" in line for line in filters)
    assert "deliveryAddress" not in text  # fields nobody reads are not parsed


def test_register_own_transform(events):
    registry.register("brand", lambda df: df.select("orderNumber", "salesBrand"), "brands", ["orderNumber"])
    try:
        assert rows(registry.apply(events, "brand")) == [("7", "shop"), ("8", None)]
    finally:
        registry._REGISTRY.pop("brand")
