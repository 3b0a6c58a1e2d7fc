"""Flatten nested order updates into relational tables.

Every transform is `DataFrame -> DataFrame`, narrow (no shuffle), and built from
path lists: a column's source path decides its output name, and the paths a transform
reads decide how much of a JSON text is parsed. A column that is already a struct or array is
used as it is, so a job can parse everything once, persist, and fan out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas
from orderlake.functions import business_key_h, business_key_s, hash_key, local_time, stamp

# --- fixed values: source paths, in output order ----------------------------------------
ORDER_PATHS = """
    orderNumber status.value orderDate salesBrand country currency
    source.name source.title source.isExternal clientIP status.title
    fraudStatus.value fraudStatus.title deliveryStatus.value deliveryStatus.title customerNumber
    invoiceAddress.firstName invoiceAddress.lastName invoiceAddress.email invoiceAddress.mobilePhone
    invoiceAddress.address.street invoiceAddress.address.postalCode
    invoiceAddress.address.city invoiceAddress.address.countryCode
    total.handlingFee total.shippingFee total.salesAmount
    total.discount total.totalAmount total.creditedAmount
""".split()
PAYMENT_PATHS = "title psp method alternative amount pspReference".split()
LINE_OFFER_PATHS = "campaignId discount".split()
OFFER_HEAD_PATHS = "campaignId title activationCode discount".split()
BUCKET_PATHS = """
    bucketNumber returnCode deliveredFrom.name
    deliveryAddress.firstName deliveryAddress.lastName
    deliveryAddress.address.street deliveryAddress.address.postalCode
    deliveryAddress.address.city deliveryAddress.address.countryCode
    deliveryAddress.email deliveryAddress.mobilePhone
    pickupPoint.id pickupPoint.name pickupPoint.address.street pickupPoint.address.postalCode
    pickupPoint.address.city pickupPoint.address.countryCode
    deliveryEstimate.date deliveryEstimate.text
    shipping.carrier.code shipping.carrier.name shipping.method shipping.title
    shipping.fee shipping.returnFee shipping.unclaimedFee
""".split()
ROW_PATHS = """
    sku name color size brand url imageName
    orderedQuantity deliveredQuantity cancelledQuantity notifiedReturnQuantity returnedQuantity
    singleBasePrice singleSalesPrice manualDiscount totalDiscount totalAmount vatRate
""".split()
ROW_ORDER_PATHS = """
    orderDate salesBrand customerNumber country currency
    source.isExternal deliveryStatus.value fraudStatus.value source.name
""".split()
# Names that do not follow the "capitalise the last part" rule of bucket and row columns.
IRREGULAR_NAMES = {
    "deliveredFrom.name": "DeliveredFrom_name",
    "sku": "SKU",
    "url": "URL",
    "vatRate": "VATRate",
}


def _plain(path: str) -> str:
    return path.replace(".", "_")


def _capital(path: str) -> str:
    if path in IRREGULAR_NAMES:
        return IRREGULAR_NAMES[path]
    head, _, leaf = path.rpartition(".")
    leaf = leaf[0].upper() + leaf[1:]
    return f"{_plain(head)}_{leaf}" if head else leaf


def project(paths: list[str], base: str = "", rename=_plain) -> list[Column]:
    """One aliased column per path, read below `base`."""
    prefix = f"{base}." if base else ""
    return [F.col(prefix + p).alias(rename(p)) for p in paths]


def below(base: str, paths: list[str]) -> list[str]:
    return [f"{base}.{p}" for p in paths]


def _parse(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Parse the JSON text columns that `paths` read into, and no more of them than that.

    Without paths every JSON column is parsed completely. Parsed columns are left alone.
    """
    raw = schemas.struct(", ".join(f"{n} {kind}" for n, kind in schemas.RAW_JSON_H.items()))
    raw = raw if paths is None else schemas.prune(raw, paths)
    text = {
        f.name: F.from_json(F.col(f.name), f.dataType)
        for f in raw
        if f.name in df.columns and isinstance(df.schema[f.name].dataType, T.StringType)
    }
    return df.withColumns(text) if text else df


def _expand(df: DataFrame, array: str, item: str, outer: bool = False) -> DataFrame:
    """One row per array element. Inner by default: NULL and empty arrays yield no row."""
    return df.withColumn(item, (F.explode_outer if outer else F.explode)(F.col(array)))


# --- history grain (H) --------------------------------------------------------------
ORDER_KEY_H = ("orderNumber", "status_value")


def preprocess_bronze(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Raw table to keyed raw: local order time, status fields, processing stamp."""
    status = _parse(df, ["status"]).withColumn("orderDate", local_time("orderDate"))
    return status.withColumns(
        {
            "status_parsed": F.col("status"),
            "status_value": F.col("status.value"),
            "status_title": F.col("status.title"),
            "updated_datetime": stamp(as_of),
        }
    )


def parse_raw(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Parse the JSON columns of a raw batch at once (then persist it before a fan-out): all of
    them, or what the transforms called `names` read."""
    if names is None or any(n not in READS_H for n in names):
        return _parse(df)
    return _parse(df, sorted({path for n in names for path in READS_H[n]}))


def _clock(df: DataFrame, as_of: Column | None) -> Column:
    """The stamp set by the preprocess step, unless another clock is given."""
    has_stamp = as_of is None and "updated_datetime" in df.columns
    return (F.col("updated_datetime") if has_stamp else stamp(as_of)).alias("updated_datetime")


def _keyed_h(name: str, *parts: str) -> list[Column]:
    return [
        business_key_h(*parts).alias(f"{name}_bk"),
        hash_key(*parts).alias(f"{name}_hashkey"),
    ]


def flatten_order_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    parsed = _parse(df, ORDER_PATHS)
    # status was already taken apart by the preprocess step
    paths = [_plain(p) if p.startswith("status.") else p for p in ORDER_PATHS]
    return parsed.select(*_keyed_h("order", *ORDER_KEY_H), *project(paths), _clock(df, as_of))


def flatten_payment_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    items = _expand(_parse(df, below("payments", PAYMENT_PATHS)), "payments", "payment")
    for field in ("pspReference", "alternative"):
        filled = F.coalesce(F.col(f"payment.{field}"), F.lit(""))
        items = items.withColumn("payment", F.col("payment").withField(field, filled))
    key = (*ORDER_KEY_H, *(f"payment.{p}" for p in ("title", "psp", "method", "pspReference")))
    return items.select(
        *_keyed_h("payment", *key),
        *project(list(ORDER_KEY_H)),
        *project(PAYMENT_PATHS, "payment"),
        _clock(df, as_of),
    )


def flatten_offerhead_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    items = _expand(_parse(df, below("offers", OFFER_HEAD_PATHS)), "offers", "offer")
    return items.select(
        *_keyed_h("offerhead", *ORDER_KEY_H, "offer.campaignId", "offer.activationCode"),
        *project(list(ORDER_KEY_H)),
        *project(OFFER_HEAD_PATHS, "offer"),
        _clock(df, as_of),
    )


def flatten_bucket_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    items = _expand(_parse(df, below("buckets", BUCKET_PATHS)), "buckets", "bucket")
    return items.select(
        *_keyed_h("bucket", *ORDER_KEY_H, "bucket.bucketNumber"),
        *project(list(ORDER_KEY_H)),
        *project(BUCKET_PATHS, "bucket", _capital),
        _clock(df, as_of),
    )


ROW_POSITION = ["buckets.bucketNumber", "buckets.rows.rowNumber"]
ROW_ITEM_PATHS = [*ROW_POSITION, *below("buckets.rows", ROW_PATHS)]


def _bucket_rows(df: DataFrame) -> DataFrame:
    return _expand(_expand(df, "buckets", "bucket"), "bucket.rows", "row")


ROW_KEY_H = (*ORDER_KEY_H, "bucket.bucketNumber", "row.rowNumber")


def flatten_row_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    parsed = _parse(df, [*ROW_ORDER_PATHS, *ROW_ITEM_PATHS])
    return _bucket_rows(parsed).select(
        *_keyed_h("row", *ROW_KEY_H),
        *project(list(ORDER_KEY_H)),
        *project(["bucketNumber"], "bucket", _capital),
        *project(["rowNumber", *ROW_PATHS], "row", _capital),
        _clock(df, as_of),
        *project(ROW_ORDER_PATHS),
    )


def flatten_offerline_h(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    parsed = _parse(df, [*ROW_POSITION, *below("buckets.rows.offers", LINE_OFFER_PATHS)])
    items = _expand(_bucket_rows(parsed), "row.offers", "offer")
    return items.select(
        *_keyed_h("offerline", *ROW_KEY_H, "offer.campaignId"),
        *project(list(ORDER_KEY_H)),
        *project(["bucketNumber"], "bucket", _capital),
        *project(["rowNumber"], "row", _capital),
        *project(LINE_OFFER_PATHS, "offer", _capital),
        _clock(df, as_of),
    )


# What each transform reads of the JSON columns; `status` is parsed before.
READS_H = {
    "order": [p for p in ORDER_PATHS if not p.startswith("status.")],
    "payment": below("payments", PAYMENT_PATHS),
    "offerhead": below("offers", OFFER_HEAD_PATHS),
    "bucket": below("buckets", BUCKET_PATHS),
    "row": [*ROW_ORDER_PATHS, *ROW_ITEM_PATHS],
    "offerline": [*ROW_POSITION, *below("buckets.rows.offers", LINE_OFFER_PATHS)],
}


# --- snapshot grain (S) ----------------------------------------------------------------
READS_S = {
    "order": ORDER_PATHS,
    "payment": ["orderNumber", "status.value", *below("payments", PAYMENT_PATHS)],
    "row": ["orderNumber", "status.value", *ROW_ORDER_PATHS, *ROW_ITEM_PATHS],
}


def parse_events(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Envelope rows (`body` text plus metadata) to typed events; bad bodies become NULL fields.

    With paths (see READS_S) only those fields are parsed.
    """
    meta = [c for c in df.columns if c != "body"]
    body = schemas.struct(schemas.BODY_S)
    kind = body if paths is None else schemas.prune(body, paths)
    return df.select(F.from_json("body", kind).alias("e"), *meta).select("e.*", *meta)


def flatten_order_s(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    return df.select(
        F.col("orderNumber").alias("order_bk"),
        *project(ORDER_PATHS),
        F.col("EventEnqueuedUtcTime"),
        stamp(as_of).alias("updated_datetime"),
    )


def flatten_payment_s(df: DataFrame, as_of: Column | None = None, outer: bool = False) -> DataFrame:
    items = _expand(df, "payments", "payment", outer)
    key = ("orderNumber", *(f"payment.{p}" for p in ("title", "psp", "method", "pspReference")))
    return items.select(
        F.col("orderNumber").alias("order_bk"),
        business_key_s(*key).alias("payment_bk"),
        *project(["orderNumber", "status.value"]),
        *project(PAYMENT_PATHS, "payment"),
        F.col("EventEnqueuedUtcTime"),
        stamp(as_of).alias("updated_datetime"),
    )


def flatten_row_s(df: DataFrame, as_of: Column | None = None, outer: bool = False) -> DataFrame:
    """`outer=True` keeps events without buckets and buckets without rows."""
    items = _expand(_expand(df, "buckets", "bucket", outer), "bucket.rows", "row", outer)
    bucket_key = ("orderNumber", "bucket.bucketNumber")
    return items.select(
        business_key_s(*bucket_key).alias("bucket_bk"),
        business_key_s(*bucket_key, "row.rowNumber").alias("row_bk"),
        *project(["orderNumber"]),
        *project(["bucketNumber"], "bucket", _capital),
        *project(["rowNumber", *ROW_PATHS], "row", _capital),
        *project([*ROW_ORDER_PATHS, "status.value"]),
        F.col("EventEnqueuedUtcTime").alias("source_updated_datetime"),
        stamp(as_of).alias("updated_datetime"),
    )
