"""Order-update documents derived from the star-schema tables.

One event per order and version; an order whose status is looked at twice has a second
version. Line items are nested as buckets, rows and offers: an order is one document, however
many line items it has.

Orders with their line items nested are written once per application and input folder to the
shared work folder, as numbers and names. From these rows each reader makes the texts that it
reads, in the layout of a landing table: text body and metadata, and the same document as raw
scalar and JSON text columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.tables import listed_bytes
from orderlake.session import setting, work_path

# Currency by region key; any other region pays in AED.
CURRENCIES = {0: "ZAR", 1: "USD", 2: "JPY", 3: "EUR"}

LINES_PER_TASK = 4 << 20  # bytes of the line items' files that a task sorts and nests

_staged: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _empty(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _person(name: Column, country_code: Column) -> Column:
    address = F.struct(country_code.alias("countryCode"))
    return F.struct(name.alias("firstName"), address.alias("address"))


LINE = "l_linenumber l_partkey l_suppkey l_quantity l_returnflag l_discount l_extendedprice l_tax".split()
PART = "p_name p_size p_brand p_retailprice".split()


def _lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Line items per order with what is known of their parts: (o_orderkey, items)."""
    lines = lineitem.select("l_orderkey", *LINE)
    parts = part.select("p_partkey", *PART)
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select(F.col("l_orderkey").alias("o_orderkey"), F.struct(*LINE, *PART).alias("item"))
        .groupBy("o_orderkey")
        .agg(F.collect_list("item").alias("items"))
    )


def _row(item: Column) -> Column:
    """A line item as a row of a document."""
    bulk = F.struct(F.lit("BULK").alias("campaignId"), F.lit(0.01).alias("discount"))
    percent = F.round(item["l_discount"] * 100).cast("int").cast("string")
    own = F.struct(
        F.concat(F.lit("C"), percent).alias("campaignId"), item["l_discount"].alias("discount")
    )
    offers = (
        F.when(item["l_discount"] == 0, F.array())
        .when(item["l_discount"] > 0.05, F.array(own, bulk))
        .otherwise(F.array(own))
    )
    quantity = item["l_quantity"].cast("int")
    return F.struct(
        item["l_linenumber"].alias("rowNumber"),
        item["l_partkey"].cast("string").alias("sku"),
        item["p_name"].alias("name"),
        item["p_size"].cast("string").alias("size"),
        item["p_brand"].alias("brand"),
        quantity.alias("orderedQuantity"),
        F.when(item["l_returnflag"] == "R", quantity).otherwise(0).alias("returnedQuantity"),
        item["p_retailprice"].alias("singleBasePrice"),
        offers.alias("offers"),
        (item["l_extendedprice"] * item["l_discount"]).alias("totalDiscount"),
        item["l_extendedprice"].alias("totalAmount"),
        item["l_tax"].alias("vatRate"),
    )


def _buckets(customer: Column, country_code: Column, day: Column) -> Column:
    number = lambda i: (i["l_suppkey"] % 3 + 1).cast("int")
    numbers = F.array_sort(F.array_distinct(F.transform("items", number)))

    def bucket(n: Column) -> Column:
        rows = F.transform(F.filter("items", lambda i: number(i) == n), _row)
        name = n.cast("string")
        return F.struct(
            n.alias("bucketNumber"),
            F.struct(F.concat(F.lit("Warehouse "), name).alias("name")).alias("deliveredFrom"),
            _person(customer, country_code).alias("deliveryAddress"),
            F.struct(day.alias("date")).alias("deliveryEstimate"),
            F.struct(
                F.struct(F.concat(F.lit("CR"), name).alias("code")).alias("carrier"),
                F.lit("home").alias("method"),
                F.when(n == 1, F.lit(49.0)).otherwise(F.lit(0.0)).alias("fee"),
                F.array(F.concat(F.lit("slot "), name)).alias("options"),
            ).alias("shipping"),
            rows.alias("rows"),
        )

    return F.transform(numbers, bucket)


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per order: what its documents are made of."""
    orders, lineitem, customer, nation, part = (
        table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer", "nation", "part")
    )
    key = F.col("o_orderkey")
    heads = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(_lines(lineitem, part), "o_orderkey", "left")
        # without line items: buckets are NULL for even keys, empty for odd ones
        .withColumn("items", F.coalesce("items", F.when(key % 2 == 1, F.array())))
    )
    names = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
    names += "c_custkey c_name c_mktsegment n_name n_regionkey items".split()
    return heads.select(*names)


def build_updates(heads: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The documents of nested orders as a lazy DataFrame: all columns of the landing table, or
    some. Texts are made only for these."""
    key = F.col("o_orderkey")
    versions = F.when(key % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    first = F.col("v") == 1
    order_number = key.cast("string")
    country_code = F.substring("n_name", 1, 2)
    status = F.when(first, F.lit("new")).otherwise(F.col("o_orderstatus"))
    checked = F.when(key % 50 == 0, F.lit("review")).otherwise(F.lit("ok"))
    fee = F.when(F.col("o_totalprice") < 50000, F.lit(49.0)).otherwise(F.lit(0.0))
    total = F.col("o_totalprice") + fee
    ordered = F.col("o_orderdate").cast("timestamp")
    enqueued = ordered + F.make_dt_interval(F.col("v") - 1, F.lit(0), (key % 1440).cast("int"))
    sequence = key * 2 + F.col("v")

    def payment(kind: str, psp: str, alternative: str | None, share: float | None) -> Column:
        reference = F.when(key % 5 != 0, F.concat(F.lit(f"{psp}-"), key.cast("string")))
        return F.struct(
            F.lit(kind.capitalize()).alias("title"),
            F.lit(psp).alias("psp"),
            F.lit(kind).alias("method"),
            F.lit("debit").alias("type"),
            (key % 2 == 1).alias("isTokenized"),
            F.lit(alternative).cast("string").alias("alternative"),
            (total if share is None else total * F.lit(share)).alias("amount"),
            reference.alias("pspReference"),
        )

    payments = (
        F.when(key % 10 == 9, F.array())
        .when(
            key % 3 == 0,
            F.array(
                payment("card", "acquirer", None, 0.6), payment("giftcard", "house", "voucher", 0.4)
            ),
        )
        .otherwise(F.array(payment("card", "acquirer", None, None)))
    )
    offers = F.when(
        F.col("o_orderpriority") == "1-URGENT",
        F.array(
            F.struct(
                F.lit("URGENT").alias("campaignId"),
                F.lit("Urgent handling").alias("title"),
                _empty("string").alias("activationCode"),
                F.lit(5.0).alias("discount"),
            )
        ),
    )
    day = F.date_format(ordered, "yyyy-MM-dd")
    nested = _buckets(F.col("c_name"), country_code, day)
    document = {
        "orderNumber": order_number,
        "orderDate": F.date_format(ordered, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "salesBrand": F.col("c_mktsegment"),
        "country": F.col("n_name"),
        "currency": F.coalesce(
            F.element_at(
                F.create_map(*[F.lit(x) for p in CURRENCIES.items() for x in p]), F.col("n_regionkey")
            ),
            F.lit("AED"),
        ),
        "source": F.struct(
            F.concat(F.lit("src"), (key % 3).cast("string")).alias("name"),
            F.when(key % 7 != 0, F.lit("Web shop")).alias("title"),
            (key % 2 == 0).alias("isExternal"),
        ),
        "clientIP": F.concat(F.lit("10.0.0."), (key % 256).cast("string")),
        "status": F.struct(status.alias("value"), F.upper(status).alias("title")),
        "fraudStatus": F.struct(checked.alias("value"), F.upper(checked).alias("title")),
        "deliveryStatus": F.when(
            ~first, F.struct(checked.alias("value"), F.upper(checked).alias("title"))
        ),
        "customerNumber": F.col("c_custkey").cast("string"),
        "invoiceAddress": _person(F.col("c_name"), country_code),
        "total": F.struct(
            fee.alias("shippingFee"),
            F.col("o_totalprice").alias("salesAmount"),
            total.alias("totalAmount"),
        ),
        "buckets": nested,
        "offers": offers,
        "payments": payments,
    }
    scalars = ("orderNumber", "orderDate", "salesBrand", "country", "currency", "clientIP", "customerNumber")
    landed = {
        "body": F.to_json(F.struct(*[c.alias(n) for n, c in document.items()])),
        **{n: c if n in scalars else F.to_json(c) for n, c in document.items()},
        "EventEnqueuedUtcTime": enqueued,
        "SequenceNumber": sequence.cast("decimal(20,0)"),
        "Offset": sequence.cast("string"),
        "PartitionKey": F.col("o_custkey").cast("string"),
        "o_orderkey": key,
        "v": F.col("v"),
    }
    made = F.struct(*[landed[n].alias(n) for n in columns or landed])
    # Exploded, so that readers parse texts: nothing of theirs is moved to where these are made.
    versioned = heads.withColumn("v", F.explode(versions))
    return versioned.select(F.explode(F.array(made)).alias("u")).select("u.*")


def nested_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder in which the nested orders lie as files, written on first use."""
    place = (spark.conf.get("spark.app.id", ""), sf_dir)
    if place not in _staged:
        path = work_path(spark, "updates")
        # Line items take some forty times their files' size where they are sorted and nested.
        parts = -(-listed_bytes(table(spark, sf_dir, "lineitem")) // LINES_PER_TASK)
        name = "spark.sql.shuffle.partitions"
        with setting(spark, name, str(max(parts, int(spark.conf.get(name))))):
            nested_orders(spark, sf_dir).write.option("compression", "zstd").parquet(path)
        _staged[place] = path
    return _staged[place]


def order_updates(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The documents, or some of their columns, made of the nested orders that are staged once per
    application and input folder."""
    return build_updates(spark.read.parquet(nested_folder(spark, sf_dir)), columns)
