"""Declared schemas. Nothing is inferred from data.

Two grains share most of the nested types:
  * snapshot grain (S): one JSON document per event, parsed in one go;
  * history grain (H): a raw table with scalar columns and JSON text columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# --- fixed values: field names and types of the order-update document -----------------
SOURCE = "STRUCT<name STRING, title STRING, isExternal BOOLEAN>"
STATUS = "STRUCT<value STRING, title STRING>"
ADDRESS = "STRUCT<street STRING, postalCode STRING, city STRING, countryCode STRING>"
PERSON = (
    f"STRUCT<firstName STRING, lastName STRING, address {ADDRESS}, "
    "email STRING, mobilePhone STRING>"
)
PICKUP = f"STRUCT<id STRING, name STRING, address {ADDRESS}>"
CARRIER = "STRUCT<code STRING, name STRING>"
TOTAL = (
    "STRUCT<handlingFee DOUBLE, shippingFee DOUBLE, salesAmount DOUBLE, "
    "discount DOUBLE, totalAmount DOUBLE, creditedAmount DOUBLE>"
)
SHIPPING = (
    f"STRUCT<carrier {CARRIER}, method STRING, title STRING, fee DOUBLE, "
    "returnFee DOUBLE, unclaimedFee DOUBLE, options ARRAY<STRING>>"
)
ROW = (
    "STRUCT<rowNumber INT, sku STRING, name STRING, color STRING, size STRING, brand STRING, "
    "url STRING, imageName STRING, orderedQuantity INT, deliveredQuantity INT, "
    "cancelledQuantity INT, notifiedReturnQuantity INT, returnedQuantity INT, "
    "singleBasePrice DOUBLE, singleSalesPrice DOUBLE, "
    "offers ARRAY<STRUCT<campaignId STRING, discount DOUBLE>>, "
    "manualDiscount DOUBLE, totalDiscount DOUBLE, totalAmount DOUBLE, vatRate DOUBLE>"
)
OFFERS = "ARRAY<STRUCT<campaignId STRING, title STRING, activationCode STRING, discount DOUBLE>>"
DELIVERIES = (
    f"ARRAY<STRUCT<deliveryNumber STRING, deliveryDate DATE, carrier {CARRIER}, "
    "parcels ARRAY<STRUCT<parcelNumber STRING, returnParcelNumber STRING, trackingLink STRING, "
    "parcelLink STRING, returnParcelLink STRING, weight DOUBLE, volume DOUBLE, "
    "rows ARRAY<STRUCT<rowNumber INT, quantity DOUBLE>>>>>>"
)


def _buckets(date_type: str) -> str:
    return (
        "ARRAY<STRUCT<bucketNumber INT, returnCode STRING, deliveredFrom STRUCT<name STRING>, "
        f"deliveryAddress {PERSON}, pickupPoint {PICKUP}, "
        f"deliveryEstimate STRUCT<date {date_type}, text STRING>, "
        f"shipping {SHIPPING}, rows ARRAY<{ROW}>>>"
    )


BUCKETS_S = _buckets("DATE")
BUCKETS_H = _buckets("STRING")
PAYMENTS_S = (
    "ARRAY<STRUCT<title STRING, psp STRING, method STRING, type STRING, isTokenized BOOLEAN, "
    "alternative STRING, amount DOUBLE, pspReference STRING>>"
)
PAYMENTS_H = (
    "ARRAY<STRUCT<title STRING, psp STRING, method STRING, alternative STRING, "
    "amount DOUBLE, pspReference STRING>>"
)

# The S document, without the transport envelope.
BODY_S = (
    "orderNumber STRING, orderDate TIMESTAMP, salesBrand STRING, country STRING, currency STRING, "
    f"source {SOURCE}, clientIP STRING, status {STATUS}, fraudStatus {STATUS}, "
    f"deliveryStatus {STATUS}, customerNumber STRING, civicNumber STRING, "
    f"invoiceAddress {PERSON}, buckets {BUCKETS_S}, offers {OFFERS}, payments {PAYMENTS_S}, "
    f"logs ARRAY<STRING>, total {TOTAL}, deliveries {DELIVERIES}"
)

# Transport metadata that travels beside the document, as columns.
META = (
    "EventEnqueuedUtcTime TIMESTAMP, SequenceNumber DECIMAL(20,0), "
    "Offset STRING, PartitionKey STRING"
)

# One event as it arrives: text body plus metadata.
ENVELOPE = f"body STRING, {META}"

# One event as one JSON line holding document and metadata fields side by side.
EVENT_S = f"{BODY_S}, {META}"

# JSON text columns of the H raw table and the type each one holds.
RAW_JSON_H = {
    "status": STATUS,
    "source": SOURCE,
    "fraudStatus": STATUS,
    "deliveryStatus": STATUS,
    "invoiceAddress": PERSON,
    "total": TOTAL,
    "payments": PAYMENTS_H,
    "offers": OFFERS,
    "buckets": BUCKETS_H,
}
RAW_SCALARS_H = (
    "orderNumber STRING, orderDate STRING, salesBrand STRING, country STRING, "
    "currency STRING, clientIP STRING, customerNumber STRING"
)
RAW_H = (
    RAW_SCALARS_H + ", " + ", ".join(f"{c} STRING" for c in RAW_JSON_H) + ", " + META
)


def struct(ddl: str) -> T.StructType:
    """DDL text to StructType."""
    return T.StructType.fromDDL(ddl)


def prune(kind: T.DataType, paths: list[str]) -> T.DataType:
    """Only the fields named by dotted paths; arrays on the way are looked through.

    Parsing text with a pruned type skips what nobody reads.
    """
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(prune(kind.elementType, paths))
    if not isinstance(kind, T.StructType):
        return kind
    below: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        below.setdefault(head, []).append(rest)
    return T.StructType(
        [
            f if "" in below[f.name] else T.StructField(f.name, prune(f.dataType, below[f.name]))
            for f in kind
            if f.name in below
        ]
    )


# --- output contracts ----------------------------------------------------------------
# Columns of the three warehouse tables, in the order of their declarations.
WAREHOUSE = {
    "order": """
        order_bk STRING, orderNumber STRING, status_value STRING, orderDate TIMESTAMP,
        salesBrand STRING, country STRING, total_creditedAmount DOUBLE,
        EventEnqueuedUtcTime TIMESTAMP, updated_datetime TIMESTAMP,
        invoiceAddress_address_countryCode STRING, total_handlingFee DOUBLE,
        total_shippingFee DOUBLE, total_salesAmount DOUBLE, total_discount DOUBLE,
        total_totalAmount DOUBLE, invoiceAddress_lastName STRING, invoiceAddress_email STRING,
        invoiceAddress_mobilePhone STRING, invoiceAddress_address_street STRING,
        invoiceAddress_address_postalCode STRING, invoiceAddress_address_city STRING,
        fraudStatus_value STRING, fraudStatus_title STRING, deliveryStatus_value STRING,
        deliveryStatus_title STRING, customerNumber STRING, invoiceAddress_firstName STRING,
        currency STRING, source_name STRING, source_title STRING, source_isExternal BOOLEAN,
        clientIP STRING, status_title STRING, rn BIGINT
    """,
    "payment": """
        pspReference STRING, EventEnqueuedUtcTime TIMESTAMP, updated_datetime TIMESTAMP,
        status_value STRING, title STRING, psp STRING, method STRING, alternative STRING,
        amount DOUBLE, order_bk STRING, payment_bk STRING, orderNumber STRING, rn BIGINT
    """,
    "row": """
        bucket_bk STRING, row_bk STRING, orderNumber STRING, BucketNumber BIGINT,
        RowNumber BIGINT, SKU STRING, Name STRING, Color STRING, Size STRING, Brand STRING,
        URL STRING, ImageName STRING, OrderedQuantity BIGINT, DeliveredQuantity BIGINT,
        CancelledQuantity BIGINT, NotifiedReturnQuantity BIGINT, ReturnedQuantity BIGINT,
        SingleBasePrice DOUBLE, SingleSalesPrice DOUBLE, ManualDiscount DOUBLE,
        TotalDiscount DOUBLE, TotalAmount DOUBLE, VATRate DOUBLE, orderDate TIMESTAMP,
        salesBrand STRING, customerNumber STRING, country STRING, currency STRING,
        status_value STRING, source_isExternal BOOLEAN, source_name STRING,
        deliveryStatus_value STRING, fraudStatus_value STRING,
        source_updated_datetime TIMESTAMP, updated_datetime TIMESTAMP,
        orderDateLocal TIMESTAMP, rn BIGINT
    """,
}
