"""Event sources: batch and streaming reads with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake import schemas

# Micro-batch settings of the event host.
MIN_BATCH_EVENTS = 100
MAX_BATCH_WAIT = "2m"
# Fixed value: the host tries a failed batch again after up to this time.
REPLAY_WINDOW = "1 hour"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_events_json(
    spark: SparkSession, path: str, schema: str | T.StructType = schemas.EVENT_S
) -> DataFrame:
    """Newline-delimited JSON with a declared schema: unknown fields are ignored, lines that
    do not fit are kept whole in the corrupt-record column."""
    declared = schemas.struct(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*declared.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    reader = spark.read.schema(with_corrupt).option("columnNameOfCorruptRecord", schemas.CORRUPT)
    return reader.json(path)


def read_events(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType = schemas.ENVELOPE,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Stream of the files that arrive in a folder (one event per row).

    A batch takes all new files unless it is limited by number or by bytes. With `archive_dir`,
    files of finished batches are moved there, so that the folder stays short.
    """
    reader = spark.readStream.format(format).schema(schema)
    options = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
    if archive_dir:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    return reader.options(**{k: v for k, v in options.items() if v}).load(path)


def once(events: DataFrame, window: str) -> DataFrame:
    """A stream without events that a source delivers again within `window`, in the same batch or
    a later one, also after a restart.

    Events are known by partition key and sequence number. The window runs on the time of arrival,
    so an event is never late, however old it is; it bounds what is remembered. Events that lack
    one of the two numbers are not told apart, and all of them stay.
    """
    number = F.concat_ws(":", F.col("SequenceNumber").cast("string"), "PartitionKey")
    complete = F.col("SequenceNumber").isNotNull() & F.col("PartitionKey").isNotNull()
    known = events.withColumns(
        {"_arrived": F.current_timestamp(), "_event": F.when(complete, number).otherwise(F.expr("uuid()"))}
    )
    fresh = known.withWatermark("_arrived", window).dropDuplicatesWithinWatermark(["_event"])
    return fresh.drop("_arrived", "_event")


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options of a Kafka-compatible event hub source. A batch takes all there is; give
    `maxOffsetsPerTrigger` where batches must be smaller."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "minOffsetsPerTrigger": str(MIN_BATCH_EVENTS),
        "maxTriggerDelay": MAX_BATCH_WAIT,
        **extra,
    }


def kafka_envelope(records: DataFrame) -> DataFrame:
    """Kafka records to envelope columns."""
    return records.select(
        F.col("value").cast("string").alias("body"),
        F.col("timestamp").alias("EventEnqueuedUtcTime"),
        F.col("offset").cast("decimal(20,0)").alias("SequenceNumber"),
        F.col("offset").cast("string").alias("Offset"),
        F.col("key").cast("string").alias("PartitionKey"),
    )


def read_kafka_events(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Stream of a Kafka-compatible event hub (needs Spark's Kafka package on the class path)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **extra))
    return kafka_envelope(reader.load())
