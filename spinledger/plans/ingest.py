"""One run from raw lines to KPI tables, shared by batch and stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.enrich import enrich_streams
from ..operators.records import join_records, spanning_files, with_records
from ..operators.validation import (
    BAD_HEADER,
    EMPTY_FILE,
    bad_lines,
    empty_file_verdicts,
    good_plays,
    judge_lines,
    split_summary,
    verdicts_of,
)
from ..schemas import VERDICT, Layout
from ..sources.lease import holding
from ..sources.lines import read_lines
from ..sources.listing import zero_length_files
from ..sources.manifest import read_dates_manifest, write_dates_manifest
from ..sources.paths import days_of, exists, is_folder
from ..sources.tables import changed_slices, clear_partitions, drop_files, slice_path, write_enriched, write_slice
from .load import refresh_kpis

FILE_MODE = "files"
ROW_MODE = "rows"

QUARANTINED_COLUMNS = ["file", "line_no", "reason", "message"]


def source_id_of(object_key: str) -> str:
    """A short, path-safe id of an input key; the same key always gives the same id."""
    return "key-" + hashlib.md5(object_key.encode("utf-8")).hexdigest()


def run_batch(
    spark: SparkSession,
    path: str,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    *,
    source_id: str | None = None,
    mode: str = FILE_MODE,
    rebalance: bool = True,
) -> dict[str, int]:
    """Validate, transform and load the files at ``path`` as one arrival.

    Running the same path again replaces what it wrote before.
    """
    return ingest(
        spark,
        read_lines(spark, path),
        zero_length_files(spark, path),
        songs,
        users,
        layout,
        source_id or source_id_of(path),
        mode=mode,
        rebalance=rebalance,
    )


def run_and_archive(
    spark: SparkSession,
    raw_root: str,
    archive_root: str,
    object_key: str,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    **options,
) -> dict[str, int]:
    """``run_batch`` on one key, a file or a folder, whose accepted files move to the archive.

    Rejected files stay where they are, next to their entry in the quarantine, and so do files that
    arrive while the run goes on. A file delivered again under its key replaces its plays, also
    in the archive. Each delivery of a folder adds to what earlier ones stored. A run
    that was interrupted anywhere can be repeated.
    """
    from .arrivals import deliver

    mode = options.get("mode", FILE_MODE)
    for field, value in {"raw_root": raw_root, "archive_root": archive_root, "object_key": object_key}.items():
        if not value:
            raise ValueError(f"Required field missing: {field}")
    path = f"{raw_root.rstrip('/')}/{object_key}"

    def run(source_id: str) -> dict[str, int]:
        return run_batch(spark, path, songs, users, layout, source_id=source_id, **options)

    with holding(spark, layout.lease):
        return deliver(spark, raw_root, archive_root, layout, object_key, source_id_of(object_key), is_folder(spark, path), run, mode)


def ingest(
    spark: SparkSession,
    lines: DataFrame,
    empty_files: DataFrame,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    source_id: str,
    *,
    mode: str = FILE_MODE,
    rebalance: bool = True,
) -> dict[str, int]:
    """One arrival: validate, transform, load, and a row of run metrics.

    In ``files`` mode one bad record rejects its file and the other files go on. In
    ``rows`` mode only the bad records are set aside. Every step replaces what an
    earlier attempt at the same ``source_id`` wrote, so a failed run can be repeated.
    Only one arrival at a time is taken on a root; another one waits for it.
    """
    if not source_id or "/" in source_id:
        raise ValueError(f"source_id names a folder and must not be empty or hold a slash: {source_id!r}")
    with holding(spark, layout.lease) as lease:
        metrics = validate(spark, lines, empty_files, layout, source_id, mode=mode)
        lease.check()
        metrics |= transform(spark, lines, songs, users, layout, source_id, mode=mode, rebalance=rebalance)
        lease.check()
        metrics |= load(spark, layout, source_id)
        row = spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{name} bigint" for name in metrics))
        write_slice(row, layout.run_metrics, source_id)
    return metrics


def validate(
    spark: SparkSession,
    lines: DataFrame,
    empty_files: DataFrame,
    layout: Layout,
    source_id: str,
    *,
    mode: str = FILE_MODE,
) -> dict[str, int]:
    """Store a verdict per file and what is set aside, with the reasons."""
    good = usable(mode)
    # An empty file is reported by the arrival that met it first.
    if exists(spark, layout.verdicts):
        others = spark.read.schema(f"{_ddl(VERDICT)}, source_id string").parquet(layout.verdicts)
        known = others.where((F.col("source_id") != source_id) & (F.col("reason") == EMPTY_FILE)).select("file")
        empty_files = empty_files.join(known, "file", "left_anti")
    # The summary of the splits is stored: verdicts and line numbers come from it, not from
    # further scans of the text.
    write_slice(split_summary(lines).withColumn("joined", F.lit(False)), layout.splits, source_id)
    spanning = spanning_files(read_splits(spark, layout, source_id))
    if not spanning.isEmpty():
        # Files with a line that leaves quotes open are judged by their records.
        joined = split_summary(join_records(lines.join(spanning, "file", "left_semi"))).withColumn("joined", F.lit(True))
        joined.write.mode("append").parquet(slice_path(layout.splits, source_id))
        lines = with_records(lines, spanning)
    splits = read_splits(spark, layout, source_id)
    # Of a file that was read both ways its records count.
    splits = splits.withColumn("records", F.bool_or("joined").over(Window.partitionBy("file"))).where("joined = records")
    judged = verdicts_of(splits).unionByName(empty_file_verdicts(empty_files))
    write_slice(judged, layout.verdicts, source_id)
    verdicts = read_verdicts(spark, layout, source_id)
    rejects = verdicts.where(~good).select(*QUARANTINED_COLUMNS)
    if mode == ROW_MODE:
        accepted = verdicts.where(good).select("file")
        bad_records = bad_lines(lines, splits).join(accepted, "file", "left_semi")
        rejects = rejects.unionByName(bad_records.select(*QUARANTINED_COLUMNS))
    quarantined = write_slice(rejects, layout.quarantine, source_id)
    checked = verdicts.agg(
        F.count(F.lit(1)).alias("files_checked"),
        F.count_if(~good).alias("files_rejected"),
        F.coalesce(F.sum("data_rows"), F.lit(0)).alias("rows_checked"),
    ).first()
    return {**checked.asDict(), "quarantined": quarantined}


def transform(
    spark: SparkSession,
    lines: DataFrame,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    source_id: str,
    *,
    mode: str = FILE_MODE,
    rebalance: bool = True,
) -> dict[str, int]:
    """Store the enriched plays of the usable files and the manifest of days touched.

    A file counts once, whatever arrival brings it: what other arrivals stored of a file is
    taken back before its new version is stored, so the latest delivery stands.
    """
    # Files set aside are few in a sound delivery: where there are none, the lines are not
    # joined at all, and else Catalyst broadcasts their names while they are small.
    spanning = spanning_files(read_splits(spark, layout, source_id))
    if not spanning.isEmpty():
        lines = with_records(lines, spanning)
    rejected = read_verdicts(spark, layout, source_id).where(~usable(mode)).select("file")
    taken = lines if rejected.isEmpty() else lines.join(rejected, "file", "left_anti")
    plays = good_plays(judge_lines(taken))
    _take_back(spark, layout, source_id, mode)
    rows, dates = write_enriched(
        enrich_streams(plays, songs, users), layout.enriched, source_id, rebalance=rebalance
    )
    touched = _touched(spark, layout, source_id, dates)
    return {"rows_written": rows, "dates_touched": len(touched)}


def load(spark: SparkSession, layout: Layout, source_id: str) -> dict[str, int]:
    """Refresh the KPI tables for the days in the arrival's manifest."""
    return refresh_kpis(spark, layout, read_dates_manifest(spark, layout.manifest(source_id)))


def read_verdicts(spark: SparkSession, layout: Layout, source_id: str) -> DataFrame:
    return spark.read.schema(VERDICT).parquet(slice_path(layout.verdicts, source_id))


def read_splits(spark: SparkSession, layout: Layout, source_id: str) -> DataFrame:
    return spark.read.parquet(slice_path(layout.splits, source_id))


def _take_back(spark: SparkSession, layout: Layout, source_id: str, mode: str) -> None:
    """Remove what other arrivals stored of the usable files of this one.

    The days concerned go into the manifest first. If the run stops in between, its
    repetition refreshes them even where nothing is left to take back.
    """
    taken = read_verdicts(spark, layout, source_id).where(usable(mode)).select("file")
    every = spark.read.schema(f"{_ddl(VERDICT)}, source_id string").parquet(layout.verdicts)
    shared = every.where(F.col("source_id") != source_id).join(taken, "file", "left_semi")
    slices = [
        (day, row["source_id"]) for row in shared.select("source_id").distinct().collect() for day in days_of(spark, layout.enriched, row["source_id"])
    ]
    if not slices:
        return
    changed = changed_slices(spark, layout.enriched, slices, taken)
    if changed:
        manifest = layout.manifest(source_id)
        before = read_dates_manifest(spark, manifest) if exists(spark, manifest) else []
        write_dates_manifest(spark, manifest, [*before, *(day for day, _ in changed)])
        drop_files(spark, layout.enriched, changed, taken, layout.staged(source_id))


def _ddl(schema) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)


def usable(mode: str) -> Column:
    """Whether plays are taken from a file with a given verdict."""
    if mode == FILE_MODE:
        return F.col("ok")
    if mode == ROW_MODE:
        # Without the right header the fields of a file mean nothing, so it fails whole.
        bad_record = (F.col("reason") != BAD_HEADER) & F.col("line_no").isNotNull()
        return F.col("ok") | bad_record
    raise ValueError(f"mode must be {FILE_MODE!r} or {ROW_MODE!r}, got {mode!r}")


def _touched(spark: SparkSession, layout: Layout, source_id: str, dates: list[str]) -> list[str]:
    """Days to refresh: those just written and those an earlier run of this arrival wrote.

    Days the arrival no longer has lose its old partition, which is looked for in the
    store itself. The manifest is stored before the refresh, so a run that stops anywhere
    in between can be repeated.
    """
    manifest = layout.manifest(source_id)
    before = read_dates_manifest(spark, manifest) if exists(spark, manifest) else []
    # Also what a run left that stopped before its manifest was stored.
    before = sorted({*before, *days_of(spark, layout.enriched, source_id)})
    gone = sorted(set(before) - set(dates))
    clear_partitions(spark, layout.enriched, [f"listen_date={day}/source_id={source_id}" for day in gone])
    return write_dates_manifest(spark, manifest, [*before, *dates])
