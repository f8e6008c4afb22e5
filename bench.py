"""Times the headline queries on whole tables and prints one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spinledger.plans import given_tables as given  # noqa: E402
from spinledger.plans.catalog import QUERIES, _enriched_orders  # noqa: E402
from spinledger.session import build_session, scratch_path  # noqa: E402
from spinledger.sources.tables import read_enriched, write_enriched  # noqa: E402

HEADLINE = [
    "enrich",
    "orders_enrich",
    "daily_genre_kpis",
    "top_songs_per_genre",
    "top_genres_daily",
    "orders_daily_genre_kpis",
    "orders_top_songs_per_genre",
    "orders_top_genres_daily",
    "validate_rows",
    "validate_files",
    "validate_csv_scan",
    "enriched_scan",
    "pruned_scan",
    "upsert_daily_genre",
    "day_union_recompute",
    "rerun_idempotent",
    "quarantine",
    "batch_kpis",
    "stream_kpis",
    "lookup_top_songs_day",
    "lookup_genre_history",
]


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def pruning(spark, sf_dir: str) -> dict[str, dict[str, int]]:
    """Files and bytes a one-day read opens with 1, 7 and 30 days of history."""
    enriched = _enriched_orders(spark, sf_dir)
    days = [row[0] for row in enriched.select("listen_date").distinct().orderBy("listen_date").limit(30).collect()]
    result = {}
    for history in (1, 7, 30):
        path = scratch_path(spark, f"bench-history-{history}")
        kept = enriched.where(enriched.listen_date.isin(days[:history]))
        write_enriched(kept, path, "bench", rebalance=True)
        day = read_enriched(spark, path, [str(days[0])])
        size = day.select("_metadata.file_path", "_metadata.file_size").distinct().collect()
        result[str(history)] = {"files": len(size), "bytes": sum(row["file_size"] for row in size)}
    return result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "spinledger-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    plays = given.event_streams(spark, sf_dir).count()
    order_plays = given.order_streams(spark, sf_dir).count()
    # The first query of a session pays for class loading and code generation.
    warm_up = timed(lambda: run(QUERIES["daily_genre_kpis"](spark, sf_dir)))

    seconds = {name: timed(lambda name=name: run(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
    order_kpis = sum(seconds[name] for name in seconds if name.startswith("orders_"))
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "warm_up_sec": warm_up,
        "event_plays": plays,
        "order_plays": order_plays,
        "order_plays_per_sec_enrich_and_three_kpis": round(order_plays / order_kpis),
        "one_day_read_by_history_days": pruning(spark, sf_dir),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
