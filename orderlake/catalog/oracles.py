"""SQL that computes each registered query's answer straight from the star-schema tables.

The SQL never touches JSON or the nested documents: it states the flat result that nesting,
parsing and flattening must give back. It runs in an ordinary SQL engine on the same files.
"""

from __future__ import annotations

ORDER_CUT = "TIMESTAMP '1998-07-01 00:00:00'"
EVENT_CUT = "TIMESTAMP '2024-01-20 00:00:00'"
FIRST_CUT = "TIMESTAMP '2024-01-10 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
NO_TEXT = "CAST(NULL AS VARCHAR)"
NO_DOUBLE = "CAST(NULL AS DOUBLE)"
NO_INT = "CAST(NULL AS INTEGER)"

# One row per event, with every order-level field.
DOC = f"""
versioned AS (
  SELECT *, 1 AS v FROM orders
  UNION ALL SELECT *, 2 AS v FROM orders WHERE o_orderkey % 4 = 0
),
base AS (
  SELECT o.o_orderkey AS k, o.v, o.o_orderpriority AS priority,
    CAST(o.o_orderkey AS VARCHAR) AS "orderNumber",
    CASE WHEN o.v = 1 THEN 'new' ELSE o.o_orderstatus END AS status_value,
    o.o_orderdate AS "orderDate", c.c_mktsegment AS "salesBrand", n.n_name AS country,
    CASE n.n_regionkey WHEN 0 THEN 'ZAR' WHEN 1 THEN 'USD' WHEN 2 THEN 'JPY' WHEN 3 THEN 'EUR'
      ELSE 'AED' END AS currency,
    'src' || CAST(o.o_orderkey % 3 AS VARCHAR) AS source_name,
    CASE WHEN o.o_orderkey % 7 <> 0 THEN 'Web shop' END AS source_title,
    o.o_orderkey % 2 = 0 AS "source_isExternal",
    '10.0.0.' || CAST(o.o_orderkey % 256 AS VARCHAR) AS "clientIP",
    CASE WHEN o.o_orderkey % 50 = 0 THEN 'review' ELSE 'ok' END AS "fraudStatus_value",
    CASE WHEN o.v = 2 THEN CASE WHEN o.o_orderkey % 50 = 0 THEN 'review' ELSE 'ok' END END
      AS "deliveryStatus_value",
    CAST(c.c_custkey AS VARCHAR) AS "customerNumber", c.c_name,
    substr(n.n_name, 1, 2) AS country_code,
    CASE WHEN o.o_totalprice < 50000 THEN CAST(49 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS fee,
    o.o_totalprice,
    o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS INTEGER)) + to_days(o.v - 1) AS enqueued,
    CAST(o.o_orderkey * 2 + o.v AS BIGINT) AS seq, CAST(o.o_custkey AS VARCHAR) AS custkey
  FROM versioned o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
doc AS MATERIALIZED (
  SELECT *, upper(status_value) AS status_title, upper("fraudStatus_value") AS "fraudStatus_title",
    upper("deliveryStatus_value") AS "deliveryStatus_title",
    c_name AS "invoiceAddress_firstName", {NO_TEXT} AS "invoiceAddress_lastName",
    {NO_TEXT} AS "invoiceAddress_email", {NO_TEXT} AS "invoiceAddress_mobilePhone",
    {NO_TEXT} AS "invoiceAddress_address_street", {NO_TEXT} AS "invoiceAddress_address_postalCode",
    {NO_TEXT} AS "invoiceAddress_address_city",
    country_code AS "invoiceAddress_address_countryCode",
    {NO_DOUBLE} AS "total_handlingFee", fee AS "total_shippingFee",
    o_totalprice AS "total_salesAmount", {NO_DOUBLE} AS total_discount,
    o_totalprice + fee AS "total_totalAmount", {NO_DOUBLE} AS "total_creditedAmount",
    enqueued AS "EventEnqueuedUtcTime", enqueued + INTERVAL 2 MINUTES AS updated_datetime,
    ("orderDate" AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm' AS local_date
  FROM base
)"""

ORDER_FIELDS = """
    "orderNumber", status_value, "salesBrand", country, currency, source_name, source_title,
    "source_isExternal", "clientIP", status_title, "fraudStatus_value", "fraudStatus_title",
    "deliveryStatus_value", "deliveryStatus_title", "customerNumber", "invoiceAddress_firstName",
    "invoiceAddress_lastName", "invoiceAddress_email", "invoiceAddress_mobilePhone",
    "invoiceAddress_address_street", "invoiceAddress_address_postalCode",
    "invoiceAddress_address_city", "invoiceAddress_address_countryCode", "total_handlingFee",
    "total_shippingFee", "total_salesAmount", total_discount, "total_totalAmount",
    "total_creditedAmount", updated_datetime"""

# One row per event and line item. Names of row fields carry a prefix to keep them apart.
ITEM = f"""
item AS MATERIALIZED (
  SELECT d.*, CAST(l.l_suppkey % 3 + 1 AS INTEGER) AS bucket_no, l.l_linenumber AS row_no,
    CAST(l.l_partkey AS VARCHAR) AS sku, p.p_name, CAST(p.p_size AS VARCHAR) AS p_size_text,
    p.p_brand, CAST(l.l_quantity AS INTEGER) AS quantity,
    CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END AS returned,
    p.p_retailprice, l.l_extendedprice, l.l_discount, l.l_tax,
    l.l_extendedprice * l.l_discount AS discount_amount
  FROM doc d
  JOIN lineitem l ON l.l_orderkey = d.k
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""


def _row_fields(integer: str) -> str:
    return f"""
    "orderNumber", status_value, CAST(bucket_no AS {integer}) AS "BucketNumber",
    CAST(row_no AS {integer}) AS "RowNumber", sku AS "SKU", p_name AS "Name", {NO_TEXT} AS "Color",
    p_size_text AS "Size", p_brand AS "Brand", {NO_TEXT} AS "URL", {NO_TEXT} AS "ImageName",
    CAST(quantity AS {integer}) AS "OrderedQuantity", CAST(NULL AS {integer}) AS "DeliveredQuantity",
    CAST(NULL AS {integer}) AS "CancelledQuantity",
    CAST(NULL AS {integer}) AS "NotifiedReturnQuantity",
    CAST(returned AS {integer}) AS "ReturnedQuantity", p_retailprice AS "SingleBasePrice",
    {NO_DOUBLE} AS "SingleSalesPrice", {NO_DOUBLE} AS "ManualDiscount",
    discount_amount AS "TotalDiscount", l_extendedprice AS "TotalAmount", l_tax AS "VATRate",
    updated_datetime, "salesBrand", "customerNumber", country, currency, "source_isExternal",
    "deliveryStatus_value", "fraudStatus_value", source_name"""


ROW_H = f"""
row_h AS (
  SELECT concat_ws('_', "orderNumber", status_value, bucket_no, row_no) AS row_bk,
    md5(concat_ws('_', "orderNumber", status_value, bucket_no, row_no)) AS row_hashkey,
    {_row_fields("INTEGER")}, local_date AS "orderDate"
  FROM item
)"""


def _row_s(integer: str) -> str:
    return f"""
row_s AS (
  SELECT concat("orderNumber", '_', bucket_no) AS bucket_bk,
    concat("orderNumber", '_', bucket_no, '_', row_no) AS row_bk,
    {_row_fields(integer)}, "orderDate", "EventEnqueuedUtcTime" AS source_updated_datetime
  FROM item
)"""


ORDER_H = f"""
order_h AS (
  SELECT concat_ws('_', "orderNumber", status_value) AS order_bk,
    md5(concat_ws('_', "orderNumber", status_value)) AS order_hashkey,
    {ORDER_FIELDS}, local_date AS "orderDate"
  FROM doc
)"""
ORDER_S = f"""
order_s AS (
  SELECT "orderNumber" AS order_bk, {ORDER_FIELDS}, "orderDate", "EventEnqueuedUtcTime" FROM doc
)"""

# Card payments, and a gift card with every third order. No payment at keys ending in nine.
PAY = f"""
pay AS (
  SELECT d.*, 'Card' AS title, 'acquirer' AS psp, 'card' AS method, {NO_TEXT} AS alternative,
    CASE WHEN k % 3 = 0 THEN "total_totalAmount" * CAST(0.6 AS DOUBLE)
      ELSE "total_totalAmount" END AS amount,
    CASE WHEN k % 5 <> 0 THEN 'acquirer-' || CAST(k AS VARCHAR) END AS reference
  FROM doc d WHERE k % 10 <> 9
  UNION ALL
  SELECT d.*, 'Giftcard', 'house', 'giftcard', 'voucher',
    "total_totalAmount" * CAST(0.4 AS DOUBLE),
    CASE WHEN k % 5 <> 0 THEN 'house-' || CAST(k AS VARCHAR) END
  FROM doc d WHERE k % 10 <> 9 AND k % 3 = 0
)"""
PAYMENT_S = """
payment_s AS (
  SELECT "orderNumber" AS order_bk,
    concat("orderNumber", '_', title, '_', psp, '_', method, '_', reference) AS payment_bk,
    "orderNumber", status_value, title, psp, method, alternative, amount,
    reference AS "pspReference", "EventEnqueuedUtcTime", updated_datetime
  FROM pay
)"""
PAYMENT_H = """
payment_h AS (
  SELECT concat_ws('_', "orderNumber", status_value, title, psp, method, coalesce(reference, ''))
      AS payment_bk,
    md5(concat_ws('_', "orderNumber", status_value, title, psp, method, coalesce(reference, '')))
      AS payment_hashkey,
    "orderNumber", status_value, title, psp, method, coalesce(alternative, '') AS alternative,
    amount, coalesce(reference, '') AS "pspReference", updated_datetime
  FROM pay
)"""

# Latest event per user and type, at the cut and at the end.
LAST_EVENTS = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events
),
ranked_before AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events WHERE ts < {EVENT_CUT}
),
after_cut AS (SELECT * EXCLUDE (n) FROM ranked WHERE n = 1),
before_cut AS (SELECT * EXCLUDE (n) FROM ranked_before WHERE n = 1)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _newer_wins(target: str, source: str, keys: list[str], guard: str) -> str:
    on = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    return f"""
    SELECT t.* FROM {target} t LEFT JOIN {source} s ON {on}
    WHERE s."{keys[0]}" IS NULL OR NOT coalesce({guard}, false)
    UNION ALL BY NAME
    SELECT s.* FROM {source} s LEFT JOIN {target} t ON {on}
    WHERE t."{keys[0]}" IS NULL OR coalesce({guard}, false)"""


def _warehouse() -> dict[str, str]:
    """Latest rows, newer-wins merges and refreshes of the three warehouse tables."""
    specs = {
        "row": (
            "row_bk",
            "source_updated_datetime",
            '"SKU", "OrderedQuantity", "TotalAmount", "VATRate", "ReturnedQuantity"',
            [DOC, ITEM, _row_s("BIGINT")],
            """, date_trunc('millisecond', (("orderDate" AT TIME ZONE 'UTC')
                 AT TIME ZONE 'Europe/Stockholm') + INTERVAL 500 MICROSECONDS) AS "orderDateLocal\"""",
        ),
        "payment": ("payment_bk", "EventEnqueuedUtcTime", "amount", [DOC, PAY, PAYMENT_S], ""),
        "order": ("order_bk", "EventEnqueuedUtcTime", "status_value", [DOC, ORDER_S], ""),
    }
    found = {}
    for name, (key, time, ties, ctes, extra) in specs.items():
        order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in [f'"{time}"', *ties.split(",")])

        def latest(cte: str, where: str) -> str:
            return f"""
            {cte}_ranked AS (
              SELECT *{extra}, row_number() OVER (PARTITION BY "{key}" ORDER BY {order}) AS rn
              FROM {name}_s WHERE {where}
            ),
            {cte} AS (SELECT * FROM {cte}_ranked WHERE rn = 1)"""

        before = latest("target", f"status_value = 'new' AND \"{time}\" < {ORDER_CUT}")
        everything = latest("source", "true")
        since = latest(
            "source",
            "updated_datetime > (SELECT max(updated_datetime) FROM target) - INTERVAL 15 MINUTES",
        )
        guard = f't."{time}" < s."{time}"'
        upsert = _newer_wins("target", "source", [key], guard)
        number = f"CAST(split_part(\"{key}\", '_', 1) AS BIGINT)"
        some_before = latest("target", f"status_value = 'new' AND \"{time}\" < {ORDER_CUT} AND {number} % 7 <> 0")
        some = latest("known", f"{number} % 5 <> 0")
        again = f"""
            source AS (SELECT * REPLACE ('again' AS status_value, CASE WHEN {number} % 3 = 0
              THEN "{time}" - INTERVAL 10 DAYS ELSE "{time}" END AS "{time}") FROM known)"""
        found[f"dedup_latest_{name}_s"] = f"{_with(*ctes, everything)} SELECT * FROM source"
        found[f"merge_newer_{name}"] = f"{_with(*ctes, some_before, some, again)} {upsert}"
        found[f"warehouse_refresh_{name}"] = f"{_with(*ctes, before, since)} {upsert}"
    return found


def _flatten() -> dict[str, str]:
    bucket_key = "concat_ws('_', \"orderNumber\", status_value, bucket_no)"
    line_key = "concat_ws('_', \"orderNumber\", status_value, bucket_no, row_no, campaign)"
    offer_key = "concat_ws('_', \"orderNumber\", status_value, 'URGENT')"
    return {
        "preprocess_bronze": f"""{_with(DOC)} SELECT "orderNumber", local_date AS "orderDate",
            status_value, status_title, updated_datetime FROM doc""",
        "flatten_order": f"""{_with(DOC)} SELECT "orderNumber", status_value, "source_isExternal",
            "invoiceAddress_firstName", "invoiceAddress_address_countryCode", "total_totalAmount"
            FROM doc""",
        "flatten_order_s": f"{_with(DOC, ORDER_S)} SELECT * FROM order_s",
        "flatten_payment_s": f"{_with(DOC, PAY, PAYMENT_S)} SELECT * FROM payment_s",
        "flatten_row_s": f"{_with(DOC, ITEM, _row_s('INTEGER'))} SELECT * FROM row_s",
        "flatten_order_h": f"{_with(DOC, ORDER_H)} SELECT * FROM order_h",
        "flatten_payment_h": f"{_with(DOC, PAY, PAYMENT_H)} SELECT * FROM payment_h",
        "flatten_row_h": f"{_with(DOC, ITEM, ROW_H)} SELECT * FROM row_h",
        "flatten_offerhead_h": f"""{_with(DOC)} SELECT {offer_key} AS offerhead_bk,
            md5({offer_key}) AS offerhead_hashkey, "orderNumber", status_value,
            'URGENT' AS "campaignId", 'Urgent handling' AS title, {NO_TEXT} AS "activationCode",
            CAST(5 AS DOUBLE) AS discount, updated_datetime
            FROM doc WHERE priority = '1-URGENT'""",
        "flatten_bucket_h": f"""{_with(DOC, ITEM)},
            buckets AS (SELECT DISTINCT "orderNumber", status_value, bucket_no, c_name,
              country_code, "orderDate", updated_datetime FROM item)
            SELECT {bucket_key} AS bucket_bk, md5({bucket_key}) AS bucket_hashkey,
              "orderNumber", status_value, bucket_no AS "BucketNumber", {NO_TEXT} AS "ReturnCode",
              'Warehouse ' || bucket_no AS "DeliveredFrom_name",
              c_name AS "deliveryAddress_FirstName", {NO_TEXT} AS "deliveryAddress_LastName",
              {NO_TEXT} AS "deliveryAddress_address_Street",
              {NO_TEXT} AS "deliveryAddress_address_PostalCode",
              {NO_TEXT} AS "deliveryAddress_address_City",
              country_code AS "deliveryAddress_address_CountryCode",
              {NO_TEXT} AS "deliveryAddress_Email", {NO_TEXT} AS "deliveryAddress_MobilePhone",
              {NO_TEXT} AS "pickupPoint_Id", {NO_TEXT} AS "pickupPoint_Name",
              {NO_TEXT} AS "pickupPoint_address_Street",
              {NO_TEXT} AS "pickupPoint_address_PostalCode",
              {NO_TEXT} AS "pickupPoint_address_City",
              {NO_TEXT} AS "pickupPoint_address_CountryCode",
              strftime("orderDate", '%Y-%m-%d') AS "deliveryEstimate_Date",
              {NO_TEXT} AS "deliveryEstimate_Text", 'CR' || bucket_no AS "shipping_carrier_Code",
              {NO_TEXT} AS "shipping_carrier_Name", 'home' AS "shipping_Method",
              {NO_TEXT} AS "shipping_Title",
              CASE WHEN bucket_no = 1 THEN CAST(49 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                AS "shipping_Fee",
              {NO_DOUBLE} AS "shipping_ReturnFee", {NO_DOUBLE} AS "shipping_UnclaimedFee",
              updated_datetime
            FROM buckets""",
        "flatten_offerline_h": f"""{_with(DOC, ITEM)},
            offers AS (
              SELECT *, 'C' || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) AS campaign,
                l_discount AS discount FROM item WHERE l_discount <> 0
              UNION ALL
              SELECT *, 'BULK', CAST(0.01 AS DOUBLE) FROM item
              WHERE l_discount > CAST(0.05 AS DOUBLE)
            )
            SELECT {line_key} AS offerline_bk, md5({line_key}) AS offerline_hashkey,
              "orderNumber", status_value, bucket_no AS "BucketNumber", row_no AS "RowNumber",
              campaign AS "CampaignId", discount AS "Discount", updated_datetime
            FROM offers""",
        "flatten_outer": f"""{_with(DOC, ITEM)}
            SELECT concat("orderNumber", '_', bucket_no) AS bucket_bk,
              concat("orderNumber", '_', bucket_no, '_', row_no) AS row_bk, "orderNumber",
              status_value, bucket_no AS "BucketNumber", row_no AS "RowNumber", sku AS "SKU"
            FROM item
            UNION ALL
            SELECT "orderNumber" || '_', "orderNumber" || '__', "orderNumber", status_value,
              {NO_INT}, {NO_INT}, {NO_TEXT}
            FROM doc d WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = d.k)""",
        "sql_flatten_row": f"""{_with(DOC, ITEM, _row_s('INTEGER'))}
            SELECT bucket_bk, row_bk, "orderNumber", status_value, "BucketNumber", "RowNumber",
              "SKU", "Name", "OrderedQuantity", "TotalAmount", source_updated_datetime
            FROM row_s""",
    }


def _files() -> dict[str, str]:
    """Sources, sinks and table care."""
    kept_body = """k % 97 NOT IN (0, 1, 3, 4, 6, 7, 8)"""
    changed = """CASE WHEN CAST("orderNumber" AS BIGINT) % 3 = 0 THEN 'XXX' ELSE currency END AS currency"""
    latest_row = f"""{_with(DOC, ITEM, ROW_H)},
        r AS (SELECT *, row_number() OVER (PARTITION BY row_hashkey ORDER BY "SKU" DESC,
          "OrderedQuantity" DESC, "ReturnedQuantity" DESC, "TotalDiscount" DESC,
          "TotalAmount" DESC, "VATRate" DESC) AS n FROM row_h)
        SELECT * EXCLUDE (n) FROM r WHERE n = 1"""
    return {
        "raw_scan": "SELECT * FROM events",
        "ndjson_scan": f"""{_with(DOC)},
            lines AS (
              SELECT l_orderkey,
                count(DISTINCT l_suppkey % 3) AS n
              FROM lineitem GROUP BY ALL
            )
            SELECT d."orderNumber", d."orderDate", d.status_value,
              CAST(coalesce(l.n, CASE WHEN d.k % 2 = 1 THEN 0 END) AS INTEGER) AS n_buckets,
              d."EventEnqueuedUtcTime", d.seq AS sequence_number,
              CAST(d.seq AS VARCHAR) AS "Offset", d.custkey AS "PartitionKey"
            FROM doc d LEFT JOIN lines l ON l.l_orderkey = d.k""",
        "append_schema_merge": f"""
            SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
            WHERE o_orderdate < {ORDER_CUT}
            UNION ALL BY NAME SELECT * FROM orders WHERE o_orderdate >= {ORDER_CUT}""",
        "first_load": f"{_with(DOC, ITEM, ROW_H)} SELECT * FROM row_h",
        "fanout_counts": f"""{_with(DOC, ITEM, PAY)}
            SELECT 'order' AS table_name, count(*) AS n FROM doc
            UNION ALL SELECT 'payment', count(*) FROM pay
            UNION ALL SELECT 'offerhead', count(*) FROM doc WHERE priority = '1-URGENT'
            UNION ALL SELECT 'bucket', count(*)
              FROM (SELECT DISTINCT "orderNumber", status_value, bucket_no FROM item)
            UNION ALL SELECT 'row', count(*) FROM item
            UNION ALL SELECT 'offerline', CAST(sum((l_discount <> 0)::INT
              + (l_discount > CAST(0.05 AS DOUBLE))::INT) AS BIGINT) FROM item""",
        "dead_letter_rows": f"""{_with(DOC)}
            SELECT CASE k % 97 WHEN 0 THEN '{{"orderNumber":' WHEN 1 THEN '[1]'
                WHEN 3 THEN '{{"orderNumber":"3"}}{{"orderNumber":"4"}}'
                WHEN 6 THEN '{{"orderNumber":"3"}},"y":{{"orderNumber":"4"}}'
                WHEN 7 THEN '{{"orderNumber":"3"}},"x":{{"orderNumber":"4"}}'
                WHEN 8 THEN '{{"orderNumber":"3"}}}} junk'
                ELSE '{{"orderNumber":"3"}} junk' END AS body,
              "EventEnqueuedUtcTime", CAST(seq AS VARCHAR) AS "Offset", custkey AS "PartitionKey"
            FROM doc WHERE k % 97 IN (0, 1, 3, 4, 6, 7, 8)""",
        "valid_rows": f"""{_with(DOC)}
            SELECT CASE WHEN k % 97 <> 2 THEN "orderNumber" END AS "orderNumber",
              CASE WHEN k % 97 <> 2 THEN status_value END AS status_value,
              CASE WHEN k % 97 <> 2 THEN "orderDate" END AS "orderDate",
              "EventEnqueuedUtcTime", CAST(seq AS VARCHAR) AS "Offset"
            FROM doc WHERE {kept_body}""",
        "dead_letter_raw": f"""{_with(DOC)}
            SELECT "orderNumber", CAST(seq AS VARCHAR) AS "Offset", CASE k % 89 WHEN 0 THEN 'status'
              WHEN 1 THEN 'buckets' WHEN 2 THEN 'payments' WHEN 3 THEN 'offers,total'
              WHEN 4 THEN 'offers' WHEN 5 THEN 'payments' ELSE 'buckets' END AS broken
            FROM doc WHERE k % 89 < 7
            UNION ALL SELECT "orderNumber", NULL, '' FROM doc WHERE k % 89 >= 7""",
        "retype_rewrite": "SELECT * FROM orders",
        "compact_matching_tables": """SELECT t AS table_name, o_orderkey, o_orderstatus, true AS moved,
              'ok' AS status
            FROM orders, (VALUES ('orders_flat'), ('orders_by_status')) x(t)""",
        "contract_check": f"""{_with(DOC, PAY, PAYMENT_S)},
            r AS (SELECT *, row_number() OVER (PARTITION BY payment_bk ORDER BY
              "EventEnqueuedUtcTime" DESC NULLS LAST, amount DESC NULLS LAST) AS n FROM payment_s),
            p AS (SELECT * FROM r WHERE n = 1)
            SELECT CAST(position AS INTEGER) AS position, name, kind, filled FROM (
              SELECT 0 AS position, 'pspReference' AS name, 'string' AS kind, count("pspReference") AS filled FROM p
              UNION ALL SELECT 1, 'EventEnqueuedUtcTime', 'timestamp', count("EventEnqueuedUtcTime") FROM p
              UNION ALL SELECT 2, 'updated_datetime', 'timestamp', count(updated_datetime) FROM p
              UNION ALL SELECT 3, 'status_value', 'string', count(status_value) FROM p
              UNION ALL SELECT 4, 'title', 'string', count(title) FROM p
              UNION ALL SELECT 5, 'psp', 'string', count(psp) FROM p
              UNION ALL SELECT 6, 'method', 'string', count(method) FROM p
              UNION ALL SELECT 7, 'alternative', 'string', count(alternative) FROM p
              UNION ALL SELECT 8, 'amount', 'double', count(amount) FROM p
              UNION ALL SELECT 9, 'order_bk', 'string', count(order_bk) FROM p
              UNION ALL SELECT 10, 'payment_bk', 'string', count(payment_bk) FROM p
              UNION ALL SELECT 11, 'orderNumber', 'string', count("orderNumber") FROM p
              UNION ALL SELECT 12, 'rn', 'bigint', count(*) FROM p)""",
        "empty_batch": "SELECT *, 'False,True,False' AS steps FROM events",
        "stream_ingest_rows": "SELECT * FROM events",
        "stream_ingest_tables": f"""{_with(DOC, ITEM, _row_s('INTEGER'))} SELECT * FROM row_s
            WHERE "orderNumber" NOT IN (SELECT "orderNumber" FROM doc WHERE k % 97 IN (0, 1, 2, 3, 4, 6, 7, 8))""",
        "stream_upsert_order": f"""{_with(DOC, ORDER_H)} SELECT * REPLACE ({changed}) FROM order_h""",
        "stream_upsert_row": f"SELECT * REPLACE ({changed}) FROM ({latest_row})",
        "stream_restart": f"{_with(DOC, PAY, PAYMENT_H)} SELECT * FROM payment_h",
        "add_columns": f"""SELECT *, {NO_TEXT} AS source_name,
            CAST(NULL AS BOOLEAN) AS "source_isExternal", {NO_DOUBLE} AS discount FROM orders""",
        "compact_preserves": "SELECT * FROM lineitem",
        "table_detail": "SELECT count(DISTINCT l_returnflag) AS num_files, count(*) AS num_rows FROM lineitem",
        "compact_small_files": """SELECT l_returnflag, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files,
            CAST(l_returnflag = 'R' AS INTEGER) AS kept FROM lineitem GROUP BY l_returnflag""",
        "evolve_stored_table": f"""SELECT o_orderkey, o_orderstatus, o_orderdate,
            CASE WHEN o_orderdate >= {ORDER_CUT} THEN o_orderpriority END AS o_orderpriority,
            CASE WHEN o_orderdate >= {ORDER_CUT} THEN o_orderkey % 2 = 0 END AS "isExternal" FROM orders""",
        "catalog_listing": """SELECT t AS table_name, k AS key,
            CASE k WHEN 'load.rows' THEN CAST((SELECT count(*) FROM orders) AS VARCHAR) ELSE t END AS value
            FROM (VALUES ('orders'), ('orders_old')) x(t), (VALUES ('load.rows'), ('load.source')) y(k)""",
        "delete_stored": """SELECT * FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F'
            AND o_orderkey <= (SELECT max(o_orderkey) // 4 FROM orders), false)""",
        "stored_upsert_recent": """WITH s AS (SELECT (1 + max(o_orderkey) + 7) // 8 AS size FROM orders),
            o AS (SELECT o_orderkey // size AS block, o_orderkey >= size * 8 * 9 // 10 AS late FROM orders, s)
            SELECT block, count(*) AS n, count(*) FILTER (late) AS n_late, NOT bool_or(late) AS kept FROM o GROUP BY block""",
        "stream_replayed_events": f"""{_with(DOC, ITEM, _row_s('INTEGER'))} SELECT * FROM row_s
            WHERE "orderNumber" NOT IN (SELECT "orderNumber" FROM doc WHERE k % 97 IN (0, 1, 2, 3, 4, 6, 7, 8))""",
        "stream_batch_counts": f"""{_with(DOC)} SELECT count(*) AS n_events,
            count(*) FILTER ({kept_body}) AS n_valid, count(*) FILTER (NOT ({kept_body})) AS n_rejected FROM doc""",
        "stream_admission": """SELECT event_id % 6 // 2 AS batch_id, event_id % 6 AS file, count(*) AS n
            FROM events GROUP BY ALL""",
        "stream_repeating": "SELECT * FROM events",
        "processing_stamp": """SELECT event_type, count(*) AS n, CAST(1 AS BIGINT) AS n_stamps, true AS is_now
            FROM events GROUP BY event_type""",
    }


def _simple() -> dict[str, str]:
    """Filters, keys, aggregates, scalar functions, incremental reads."""
    parts = "o_orderkey, nullif(o_orderstatus, 'F'), o_orderpriority"
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    minute = "o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER))"
    in_sweden = "AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Stockholm'"
    since = f"{AS_OF} - INTERVAL 36 HOURS"
    fresh = f"""fresh AS (
        SELECT 'events_click' AS table_name, count(*) AS n FROM events
          WHERE event_type = 'click' AND ts >= {since}
        UNION ALL SELECT 'events_error', count(*) FROM events
          WHERE event_type = 'error' AND ts >= {since}
        UNION ALL SELECT 'events_view', count(*) FROM events
          WHERE event_type = 'view' AND ts >= {since}
        UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderdate >= {since}
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate >= {since})"""
    known = f"(SELECT max(ts) FROM events WHERE ts < {EVENT_CUT})"
    return {
        "like_filter": "SELECT * FROM part WHERE p_type LIKE 'PROMO%'",
        "prefix_filter": "SELECT * FROM part WHERE starts_with(p_name, 'red ')",
        "business_key_h": f"SELECT o_orderkey, concat_ws('_', {parts}) AS bk FROM orders",
        "business_key_s": """SELECT o_orderkey, concat(o_orderkey, '_', nullif(o_orderstatus, 'F'),
            '_', o_orderpriority) AS bk FROM orders""",
        "hash_key": f"SELECT o_orderkey, md5(concat_ws('_', {parts})) AS hashkey FROM orders",
        "table_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in tables
        ),
        "high_watermark": "SELECT max(ts) AS high_watermark FROM events",
        "status_summary": """SELECT count(*) AS total,
            count(*) FILTER (o_orderstatus = 'O') AS n_open,
            count(*) FILTER (o_orderstatus = 'F') AS n_finished,
            count(*) FILTER (o_orderstatus = 'P') AS n_partial FROM orders""",
        "top_recent": "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000",
        "incremental_lookback": f"SELECT * FROM events WHERE ts > {known} - INTERVAL 15 MINUTES",
        "incremental_strict": f"SELECT * FROM events WHERE ts > {known}",
        "incremental_empty_target": """SELECT 'none' AS on_empty, CAST(0 AS BIGINT) AS n
            UNION ALL SELECT 'all', count(*) FROM events""",
        "delete_where": "SELECT * FROM orders WHERE o_orderstatus <> 'F'",
        "json_struct": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
            FROM events""",
        "local_time": f'SELECT o_orderkey, (({minute}) {in_sweden} AS "local" FROM orders',
        "local_time_roundtrip": f'SELECT o_orderkey, (({minute}) {in_sweden} AS "local" FROM orders',
        "local_time_ms": f"""SELECT event_id, date_trunc('millisecond',
            ((ts {in_sweden}) + INTERVAL 500 MICROSECONDS) AS "local" FROM events""",
        "parse_timestamp": f"""SELECT o_orderkey,
            CASE WHEN o_orderstatus <> 'P' THEN {minute} END AS parsed FROM orders""",
        "utc_text_timestamp": 'SELECT event_id, ts AS "at" FROM events',
        "cast_matrix": """SELECT event_id, CAST(event_id AS VARCHAR) AS id_text, ts AS ts_zoned,
            CAST(ts AS DATE) AS day, value AS value_again, CAST(user_id AS INTEGER) AS user_int
            FROM events""",
        "raised_error": f"""WITH {fresh} SELECT event_type, count(*) AS count,
              (SELECT string_agg(table_name, ', ' ORDER BY table_name) FROM fresh WHERE n = 0) AS message
            FROM events GROUP BY event_type""",
        "freshness_script": f"""WITH {fresh} SELECT event_type, count(*) AS count,
            (SELECT string_agg(table_name, ', ' ORDER BY table_name) FROM fresh WHERE n = 0) AS stale,
            'all tables are fresh' AS others FROM events GROUP BY event_type""",
        "freshness_counts": f"WITH {fresh} SELECT * FROM fresh",
        "freshness_failures": f"""WITH {fresh} SELECT
            string_agg(table_name, ', ' ORDER BY table_name) AS failed_tables
            FROM fresh WHERE n = 0""",
    }


def _upserts() -> dict[str, str]:
    keys = ["user_id", "event_type"]
    last = _with(LAST_EVENTS)
    newer = _newer_wins("before_cut", "after_cut", keys, "t.ts < s.ts")
    change_keys = "b.user_id = a.user_id AND b.event_type = a.event_type"

    def feed(after: str) -> str:
        """Changes between the cut and `after`; event_id tells versions of a key apart."""
        return f"""
        SELECT 'insert' AS _change_type, a.*, CAST(2 AS BIGINT) AS _commit_version
          FROM {after} a LEFT JOIN before_cut b ON {change_keys} WHERE b.user_id IS NULL
        UNION ALL SELECT 'delete', b.*, 2
          FROM before_cut b LEFT JOIN {after} a ON {change_keys} WHERE a.user_id IS NULL
        UNION ALL SELECT 'update_preimage', b.*, 2
          FROM before_cut b JOIN {after} a ON {change_keys} WHERE a.event_id <> b.event_id
        UNION ALL SELECT 'update_postimage', a.*, 2
          FROM before_cut b JOIN {after} a ON {change_keys} WHERE a.event_id <> b.event_id"""

    kept = "kept AS (SELECT * FROM after_cut WHERE event_type <> 'signup')"

    def late(shift: str) -> str:
        order = '"EventEnqueuedUtcTime" DESC, status_value DESC'
        return f"""{_with(DOC, ORDER_S)},
        n AS (SELECT *, row_number() OVER (PARTITION BY order_bk ORDER BY {order}) AS rn FROM order_s),
        target AS (SELECT order_bk, status_value, "EventEnqueuedUtcTime", "total_totalAmount"
          FROM n WHERE rn = 1),
        source AS (SELECT order_bk, 'late' AS status_value, "total_totalAmount",
          "EventEnqueuedUtcTime" {shift} AS "EventEnqueuedUtcTime"
          FROM order_s WHERE status_value = 'new')
        SELECT t.order_bk, t."total_totalAmount",
          CASE WHEN t."EventEnqueuedUtcTime" < s."EventEnqueuedUtcTime" THEN s.status_value
            ELSE t.status_value END AS status_value,
          greatest(t."EventEnqueuedUtcTime", s."EventEnqueuedUtcTime") AS "EventEnqueuedUtcTime"
        FROM target t JOIN source s USING (order_bk)"""

    return {
        "dedup_latest_h": f"""{_with(DOC)} SELECT "orderNumber", status_value,
            local_date AS "orderDate",
            CASE WHEN v = 1 AND k % 2 = 1 THEN "EventEnqueuedUtcTime" + INTERVAL 1 HOUR
              ELSE "EventEnqueuedUtcTime" END AS "EventEnqueuedUtcTime",
            CASE WHEN v = 1 AND k % 2 = 1 THEN 'again-' ELSE '' END || CAST(seq AS VARCHAR) AS "Offset"
            FROM doc""",
        "dedup_latest_events": f"{last} SELECT * FROM after_cut",
        "merge_update_all": f"""{_with(DOC, ORDER_H)}
            SELECT * FROM order_h WHERE CAST("orderNumber" AS BIGINT) % 5 <> 0
            UNION ALL BY NAME
            SELECT * REPLACE ('pending' AS "fraudStatus_value") FROM order_h
            WHERE CAST("orderNumber" AS BIGINT) % 5 = 0 AND status_value = 'new'
              AND "orderDate" < {ORDER_CUT}""",
        "merge_condition": f"""{last}
            {_newer_wins("before_cut", "after_cut", keys, "t.value <= s.value")}""",
        "merge_broadcast_source": f"""{last}, late AS (SELECT * REPLACE (CASE WHEN user_id % 3 = 0
              THEN ts - INTERVAL 60 DAYS ELSE ts END AS ts) FROM after_cut WHERE user_id % 5 <> 0)
            {_newer_wins("before_cut", "late", keys, "t.ts < s.ts")}""",
        "merge_null_keys": f"""{last},
            old AS (SELECT * FROM before_cut WHERE event_type <> 'click'),
            new AS (SELECT * FROM after_cut WHERE event_type <> 'click'),
            loose AS (SELECT * REPLACE (NULL AS event_type) FROM before_cut WHERE event_type = 'click'
              UNION ALL
              SELECT * REPLACE (NULL AS event_type) FROM after_cut WHERE event_type = 'click')
            {_newer_wins("old", "new", keys, "t.ts < s.ts")}
            UNION ALL BY NAME SELECT * FROM loose""",
        "change_feed": f"{last}, {kept} {feed('kept')}",
        "state_changes": f"{last}, {kept} {feed('kept')}",
        "late_event_ignored": late("- INTERVAL 1 HOUR"),
        "late_event_applied": late("+ INTERVAL 1 HOUR"),
        "replay_idempotent": f"{last} {newer}",
        "change_feed_recorded": f"""WITH k AS (SELECT user_id, event_type, min(ts) AS first,
              coalesce(bool_or(ts >= {FIRST_CUT} AND ts < {EVENT_CUT}), false) AS second, coalesce(bool_or(ts >= {EVENT_CUT}), false) AS third
              FROM events GROUP BY user_id, event_type),
            c AS (SELECT 2 AS v, 'insert' AS t, event_type FROM k WHERE first >= {FIRST_CUT} AND first < {EVENT_CUT}
              UNION ALL SELECT 2, unnest(['update_preimage', 'update_postimage']), event_type FROM k WHERE first < {FIRST_CUT} AND second
              UNION ALL SELECT 3, 'insert', event_type FROM k WHERE first >= {EVENT_CUT}
              UNION ALL SELECT 3, unnest(['update_preimage', 'update_postimage']), event_type FROM k WHERE first < {EVENT_CUT} AND third
              UNION ALL SELECT 4, 'delete', event_type FROM k WHERE event_type = 'signup')
            SELECT CAST(v AS BIGINT) AS _commit_version, t AS _change_type, event_type, count(*) AS n FROM c GROUP BY ALL""",
        "change_feed_replayed": """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS r FROM events) WHERE r = 1 AND event_type <> 'signup'""",
    }


def oracles() -> dict[str, str]:
    return {**_files(), **_flatten(), **_simple(), **_warehouse(), **_upserts()}
