"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Every query is run completely (into a sink that discards its rows), twice; the faster run
counts. Nesting the star schema into documents is timed apart, as `stage_updates`: it makes
the input and is not part of the total.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from orderlake.catalog.queries import QUERIES
from orderlake.catalog.updates import order_updates
from orderlake.session import build_session

HEADLINE = (
    "flatten_row_s flatten_order_s flatten_payment_s "
    "flatten_order_h flatten_bucket_h flatten_row_h flatten_offerline_h "
    "dedup_latest_h dedup_latest_row_s merge_newer_row merge_update_all "
    "warehouse_refresh_row warehouse_refresh_payment warehouse_refresh_order "
    "fanout_counts stream_upsert_order incremental_lookback change_feed "
    "dead_letter_rows compact_preserves"
).split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "orderlake-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="orderlake-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    staged = timed(lambda: order_updates(spark, sf_dir).count())
    seconds = {name: min(timed(lambda: run(name)) for _ in range(2)) for name in HEADLINE}
    n_events = order_updates(spark, sf_dir).count()
    n_rows = QUERIES["flatten_row_s"](spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "stage_updates": staged,
                "events": n_events,
                "flatten_row_s_rows_per_sec": round(n_rows / seconds["flatten_row_s"]),
                "flatten_row_s_events_per_sec": round(n_events / seconds["flatten_row_s"]),
                "warehouse_refresh_sec": round(
                    sum(s for n, s in seconds.items() if n.startswith("warehouse_refresh")), 3
                ),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
