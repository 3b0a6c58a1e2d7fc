"""Structured Streaming jobs: event ingest (S) and silver upsert (H).

Progress lives in the checkpoint. A batch that is replayed after a failure rewrites the same
batch folders, and merges into stored tables what they already hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderlake import schemas
from orderlake.operators.flatten import flatten_order_s, flatten_payment_s, flatten_row_s
from orderlake.operators.quality import parse_checked, split_valid
from orderlake.operators.stored import ORDERS_PER_BLOCK
from orderlake.plans.silver import silver_tables, upsert_silver
from orderlake.session import configure
from orderlake.sources.events import REPLAY_WINDOW, once, read_events
from orderlake.sources.sinks import append_table, fan_out, write_dead_letters

# Fixed value: pause between micro-batches of the continuous job.
INTERVAL = "5 minutes"

STREAM_TABLES = {
    "order": (flatten_order_s, "orderupdates_orderstream"),
    "payment": (flatten_payment_s, "orderupdates_paymentstream"),
    "row": (flatten_row_s, "orderupdates_rowstream"),
}


def trigger(interval: str | None = None) -> dict:
    """Trigger options: run to completion, or repeat every `interval`."""
    return {"processingTime": interval} if interval else {"availableNow": True}


def query_id(batch: DataFrame, checkpoint: str) -> str:
    """Name of the running stream: kept in its checkpoint, new after the checkpoint is reset."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return found or checkpoint


def drop_shuffle_files(batch: DataFrame) -> None:
    """Remove what a finished micro-batch has shuffled into the stream's state. Spark itself does so
    only when the driver's heap is collected, so that many batches would lie on disk."""
    plan, cleaner = batch._jdf.logicalPlan(), batch.sparkSession.sparkContext._jsc.sc().cleaner()
    if cleaner.isEmpty() or plan.getClass().getSimpleName() != "LogicalRDD":
        return
    found = [plan.rdd()]
    while found:
        needs = found.pop().dependencies()
        for i in range(needs.size()):
            if needs.apply(i).getClass().getSimpleName() == "ShuffleDependency":
                cleaner.get().doCleanupShuffle(needs.apply(i).shuffleId(), False)
            found.append(needs.apply(i).rdd())


def start_batches(
    events: DataFrame,
    upsert_batch: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Run `upsert_batch(batch, batch_id, query_id)` on every micro-batch.

    A stream plans its batches with adaptive execution off. The upserts inside a batch are
    ordinary queries, so the engine's settings are put back for them.
    """

    def configured(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        upsert_batch(batch, batch_id, query_id(batch, checkpoint))
        drop_shuffle_files(batch)

    writer = events.writeStream.foreachBatch(configured).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(interval)).start()


def upsert_stream(
    raw: DataFrame,
    target_dir: str,
    checkpoint: str,
    interval: str | None = None,
    as_of: Column | None = None,
    names: list[str] | None = None,
    orders_per_block: int = ORDERS_PER_BLOCK,
    on_source_duplicates: str = "latest",
) -> StreamingQuery:
    """Raw order updates from any streaming DataFrame, upserted into the silver tables.

    Documents whose JSON texts do not convert, and child rows that lose against another one of
    the same key in their document, are kept below `<target_dir>/deadletters`.
    """
    tables = silver_tables(raw.sparkSession, target_dir, orders_per_block)
    if names:
        tables = {n: tables[n] for n in names}

    def upsert_batch(batch: DataFrame, batch_id: int, query: str) -> None:
        upsert_silver(
            batch,
            tables,
            batch_id,
            as_of,
            on_source_duplicates,
            writer=query,
            dead_letters=f"{target_dir}/deadletters",
        )

    return start_batches(raw, upsert_batch, checkpoint, interval)


def start_upsert_stream(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint: str,
    interval: str | None = None,
    max_files_per_trigger: int | None = None,
    **options,
) -> StreamingQuery:
    """`upsert_stream` over the files that arrive in `source_dir`."""
    raw = read_events(
        spark, source_dir, schemas.RAW_H, max_files_per_trigger=max_files_per_trigger
    )
    return upsert_stream(raw, target_dir, checkpoint, interval, **options)


def ingest_stream(
    events: DataFrame,
    target_dir: str,
    checkpoint: str,
    consumer: str = "orderlake",
    interval: str | None = None,
    as_of: Column | None = None,
    replay_window: str | None = REPLAY_WINDOW,
) -> StreamingQuery:
    """Event bodies from any streaming DataFrame in the envelope's layout (for example
    `read_kafka_events`), appended to the three stream tables; bodies that do not parse go to
    the dead letters. Events that arrive again within `replay_window` are dropped (None: kept).
    Each batch reports its events, valid and rejected ones under the name `ingest`; see
    `batch_counts`."""
    fresh = once(events, replay_window) if replay_window else events
    checked = parse_checked(fresh).observe(
        "ingest",
        F.count(F.lit(1)).alias("n_events"),
        F.count_if("is_valid").alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_rejected"),
    )

    def ingest(batch: DataFrame, batch_id: int, query: str) -> None:
        def good(fn):
            return lambda rows: fn(split_valid(rows)[0], as_of)

        outputs = {name: good(fn) for name, (fn, _) in STREAM_TABLES.items()}
        outputs["dead"] = lambda rows: split_valid(rows)[1]
        # Of an accepted event only its values are read again, not its text.
        rejected = batch.withColumn("body", F.when(~F.col("is_valid"), F.col("body")))

        def write(name: str, rows: DataFrame) -> None:
            if name == "dead":
                path = f"{target_dir}/deadletters"
                write_dead_letters(rows, path, consumer, "parse", batch_id, query)
            else:
                append_table(rows, f"{target_dir}/{STREAM_TABLES[name][1]}", batch_id, writer=query)

        fan_out(rejected, outputs, write)

    return start_batches(checked, ingest, checkpoint, interval)


def start_ingest_stream(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    checkpoint: str,
    consumer: str = "orderlake",
    interval: str | None = None,
    max_files_per_trigger: int | None = None,
    as_of: Column | None = None,
    replay_window: str | None = REPLAY_WINDOW,
) -> StreamingQuery:
    """`ingest_stream` over the files that arrive in `source_dir`."""
    events = read_events(
        spark, source_dir, schemas.ENVELOPE, max_files_per_trigger=max_files_per_trigger
    )
    return ingest_stream(events, target_dir, checkpoint, consumer, interval, as_of, replay_window)


class BatchCounts(StreamingQueryListener):
    """Counts of the micro-batches of all streams of a session, as Spark reports them: no job is
    run for them. Register with `spark.streams.addListener`; `rows` holds (query id, batch id,
    counts by name)."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, dict[str, dict]]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = {name: row.asDict() for name, row in event.progress.observedMetrics.items()}
        if found:
            self.rows.append((str(event.progress.id), event.progress.batchId, found))

    def onQueryTerminated(self, event) -> None:
        pass


def batch_counts(query: StreamingQuery, name: str = "ingest") -> list[dict]:
    """Counts of the latest batches of one stream that had rows, oldest first."""
    found = [(p.batchId, p.observedMetrics.get(name)) for p in query.recentProgress]
    return [{"batch_id": n, **row.asDict()} for n, row in found if row is not None and row["n_events"]]
