"""Plans that must hold at scale: hot keys, early aggregation, bounded scans."""

import contextlib

import pytest
from pyspark.sql import functions as F

from spinledger.operators import kpis
from spinledger.operators.enrich import enrich_streams
from spinledger.plans.catalog import QUERIES
from spinledger.sources import tables

from test_kpis import enriched_of

SF = "/root/testdata/sf0.001"

# Queries that write and read back run inside their builder; the rest are one plan.
STORAGE = {
    "enriched_scan", "pruned_scan", "manifest_round_trip", "csv_streams_scan", "csv_songs_scan", "csv_users_scan",
    "day_union_recompute", "rerun_idempotent", "rejected_items", "validate_csv_scan", "quarantine",
    "quarantine_rows", "run_metrics", "batch_kpis", "stream_kpis", "archive_inputs",
    "archive_two_nights", "stream_outcomes", "stream_new_versions", "listening_sums", "top_songs_from_sums",
}
LAZY = [name for name in QUERIES if name not in STORAGE]


@contextlib.contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for forbidden in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        if forbidden == "SinglePartition" and name in ("dates_manifest", "dates_touched"):
            # One list of distinct days is the result; only distinct days meet there.
            continue
        assert forbidden not in plan, forbidden


@pytest.mark.parametrize("group, partitions", [("track_id", 8), ("user_id", 8), ("track_id", 2001)])
def test_hot_keys_are_split_when_tables_are_too_large_to_broadcast(spark, group, partitions):
    """Whether or not the aggregation that follows could reuse the join's partitioning, and
    also where the number of partitions makes Spark report sizes only roughly."""
    plays = spark.range(0, 300000, 1, 16).select(
        (F.col("id") % 1000).alias("user_id"),
        # A third of all plays is of track 0.
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("track_id"),
        F.timestamp_seconds(1719300000 + F.col("id") % 86400).alias("listen_time"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    songs = spark.range(5000).select(F.col("id").alias("track_id"), F.lit("pop").alias("track_genre"))
    users = spark.range(1000).select(F.col("id").alias("user_id"), F.lit("x").alias("user_name"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__shuffle__partitions=str(partitions),
    ):
        counted = enrich_streams(plays, songs, users).groupBy(group).agg(F.count("note").alias("n"))
        rows = {row[group]: row["n"] for row in counted.collect()}
        final = plan_of(counted)
    assert "skew=true" in final
    assert sum(rows.values()) == 300000
    assert rows[0] == (100000 + 40 if group == "track_id" else 300)


def test_listener_counts_are_reduced_before_the_first_shuffle(spark):
    plan = plan_of(kpis.compute_daily_genre_kpis(enriched_of(spark, [("u1", "s10", None)])))
    below_last_exchange = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in below_last_exchange and "partial_count" in below_last_exchange
    assert "SortAggregate" not in plan


def test_ranking_is_pruned_before_its_shuffle(spark):
    plan = plan_of(kpis.compute_top_songs_per_genre(enriched_of(spark, [("u1", "s10", None)])))
    assert plan.count("WindowGroupLimit") == 2
    window_exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[window_exchange:]


def test_kpi_scans_read_their_own_columns(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "e")
    tables.write_enriched(enriched_of(spark, [("u1", "s10", dt.date(2024, 6, 25))]), path, "a")
    enriched = tables.read_enriched(spark, path)
    daily = plan_of(kpis.compute_daily_genre_kpis(enriched))
    assert "ReadSchema: struct<user_id:string,track_genre:string,duration_ms:bigint>" in daily
    songs = plan_of(kpis.compute_top_songs_per_genre(enriched))
    assert "ReadSchema: struct<track_id:string,track_name:string,track_genre:string>" in songs


def test_one_day_costs_the_same_whatever_the_history(spark, tmp_path):
    import datetime as dt

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    seen = set()
    for history in (1, 7, 30):
        path = str(tmp_path / str(history))
        plays = [("u1", "s10", day) for day in days[:history]]
        tables.write_enriched(enriched_of(spark, plays).coalesce(1), path, "a")
        seen.add(len(tables.read_enriched(spark, path, ["2024-01-01"]).inputFiles()))
    assert seen == {1}


def test_rebalanced_write_splits_a_hot_day(spark, tmp_path):
    plays = spark.range(0, 60000, 1, 8).select(
        F.col("id").cast("string").alias("user_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("track_id"),
        # Half of all plays fall on one day.
        F.when(F.col("id") % 2 == 0, F.lit("2024-06-25"))
        .otherwise(F.concat(F.lit("2024-06-0"), (F.col("id") % 9 + 1).cast("string")))
        .cast("date")
        .alias("listen_date"),
    )
    path = str(tmp_path / "e")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="300KB"):
        rows, days = tables.write_enriched(plays, path, "a", rebalance=True)
    assert (rows, len(days)) == (60000, 10)
    files = [file.split("listen_date=")[1][:10] for file in tables.read_enriched(spark, path).inputFiles()]
    assert files.count("2024-06-25") > 1


def test_verdicts_are_semi_joined_by_their_size(spark, tmp_path):
    from spinledger.operators.validation import file_verdicts, good_plays, judge_lines
    from spinledger.schemas import VERDICT
    from spinledger.sources.lines import read_lines

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("user_id,track_id,listen_time\n1,t,2024-06-25\n")
    lines = read_lines(spark, str(tmp_path / "in"))
    file_verdicts(lines).write.parquet(str(tmp_path / "verdicts"))
    accepted = spark.read.schema(VERDICT).parquet(str(tmp_path / "verdicts")).where("ok").select("file")
    plays = good_plays(judge_lines(lines.join(accepted, "file", "left_semi")))
    assert "BroadcastHashJoin" in plan_of(plays)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        shuffled = good_plays(judge_lines(lines.join(accepted, "file", "left_semi")))
        assert "SortMergeJoin" in plan_of(shuffled) and shuffled.count() == 1
