"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line.

Events are built once and stored, so the timed queries start from files of raw events as a feed
delivers them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import changes, decode, lookup, project
from tidemark.plans import fixtures as X
from tidemark.plans import queries as Q
from tidemark.session import prepare, shared_dir
from tidemark.sources import events, landing
from tidemark.streaming.sink import start_landing

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    return prepare(spark)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    home = shared_dir(spark)
    parts = int(CPUS)
    X.order_events(spark, SF_DIR).repartitionByRange(parts, "pos").write.parquet(f"{home}/orders")
    X.user_events(spark, SF_DIR).repartitionByRange(parts, "pos").write.parquet(f"{home}/users")
    orders, users = (events.read_events(spark, f"{home}/{n}") for n in ("orders", "users"))
    both = orders.unionByName(users)
    n_orders, n_users = orders.count(), users.count()

    def projected() -> DataFrame:
        return project.project_rows(decode.decodable(decode.decode_events(orders, X.PREFIX)), X.ORDERS)

    def filled() -> DataFrame:
        return lookup.fill_from_snapshot(projected(), X.order_snapshot(spark, SF_DIR), X.ORDERS)

    def restart() -> None:
        sink = Q.new_sink(spark)
        steps: list = []

        def stop(step: str, folder: str) -> None:
            if step == "staged" and not steps:
                steps.append(step)
                raise Q.Interrupted(step)

        sink.on_step = stop
        for attempt in range(2):
            stream = start_landing(events.stream_events(spark, f"{home}/orders"), sink, available_now=True)
            try:
                stream.awaitTermination()
            except Exception:
                if attempt:
                    raise

    zone = Q.landed(spark, users)
    doubled = project.convertible(projected()).select("pos", "row.*")
    timed = {
        "scan_events": lambda: run(orders),
        "row_image": lambda: run(project.convertible(projected()).select("pos", "row.*")),
        "update_fallback": lambda: run(filled().select("pos", "row.*")),
        "change_profile": lambda: run(changes.change_profile(decode.decodable(decode.decode_events(both, X.PREFIX)))),
        "dedupe_changes": lambda: run(changes.dedupe_changes(doubled.unionByName(doubled))),
        "landing_write_1": lambda: Q.landed(spark, orders),
        "landing_write_8": lambda: Q.landed(spark, orders, max_records_per_file=max(1000, n_orders // 7)),
        "multi_table_landing": lambda: Q.landed(spark, both),
        "apply_changes": lambda: run(
            changes.apply_changes(landing.read_landing(spark, zone, X.USERS_FOLDER, X.USERS), X.USERS.keys)
        ),
        "restart_replay": restart,
    }
    only = set(sys.argv[1:])
    seconds = {}
    for name, action in timed.items():
        if only and name not in only:
            continue
        best = float("inf")
        for _ in range(REPEATS):
            start = time.perf_counter()
            action()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    rates = {
        f"{name}_per_sec": round(rows / seconds[key])
        for name, key, rows in (
            ("events_decoded", "row_image", n_orders),
            ("rows_landed_1_file", "landing_write_1", n_orders),
            ("rows_landed_8_files", "landing_write_8", n_orders),
            ("changes_applied", "apply_changes", n_users),
        )
        if key in seconds
    }
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, best of repeats",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
