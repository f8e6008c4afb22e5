"""Arrivals of files: noticed once per version, loaded, retried one by one, moved by verdict."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import VERDICT, Layout
from ..sources.lines import read_lines
from ..sources.listing import VERSION, file_versions
from ..sources.moves import carry_out, planned_moves, store_moves
from ..sources.paths import days_of, exists, read_note, write_note
from ..sources.tables import clear_partitions, slice_path, write_slice
from .ingest import FILE_MODE, QUARANTINED_COLUMNS, ingest, read_verdicts, usable
from .load import refresh_kpis

# Files of an arrival at most; their paths pass through the driver.
FILES_PER_ARRIVAL = 10_000
# Times a file is tried by itself before it is set aside.
MAX_ATTEMPTS = 3
# Fixed value: the reason a file that cannot be loaded is set aside with.
FAILED = "could not be loaded"

_NOTICE = f"{VERSION}, day string"
# A version is noticed after it was written; the clocks of both may differ by less than this.
_CLOCKS = timedelta(days=1)


def notice(spark: SparkSession, streams_path: str, layout: Layout, max_files: int | None = None) -> int:
    """Write down the versions of files that wait unnoticed; returns the number of files.

    A version is (file, modified, length), so a file that is delivered again under its old
    name is an arrival like any other. Notices are JSON files of up to ``max_files`` rows in
    order of modification, which a stream reads as its source. Only notices as young as the
    oldest waiting file can be about one of them, and no others are read.
    """
    waiting = file_versions(spark, streams_path)
    oldest = waiting.agg(F.min("modified")).first()[0]
    if oldest is None:
        return 0
    if exists(spark, layout.arrivals):
        since = str((oldest - _CLOCKS).date())
        known = spark.read.schema(_NOTICE).option("basePath", layout.arrivals).json(layout.arrivals).where(F.col("day").cast("string") >= since)
        waiting = waiting.join(known.select("file", "modified", "length"), ["file", "modified", "length"], "left_anti")
    # One small row for each file that waits.
    place = F.row_number().over(Window.orderBy("modified", "file")) - 1
    numbered = waiting.withColumn("arrival", F.floor(place / F.lit(max_files or FILES_PER_ARRIVAL)))
    rows = numbered.persist()
    try:
        count = rows.count()
        if count:
            day = time.strftime("%Y-%m-%d", time.gmtime())
            parts = rows.agg(F.max("arrival")).first()[0] + 1
            target = f"{layout.arrivals}/day={day}/noticed={time.time_ns()}"
            rows.repartitionByRange(int(min(parts, 1000)), "arrival").sortWithinPartitions("arrival", "modified", "file").write.partitionBy("arrival").json(target)
    finally:
        rows.unpersist()
    return count


def consume(
    spark: SparkSession,
    noticed: DataFrame,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    source_id: str,
    *,
    streams_path: str,
    archive_path: str | None = None,
    mode: str = FILE_MODE,
    rebalance: bool = True,
    max_attempts: int = MAX_ATTEMPTS,
) -> None:
    """Load the noticed files as one arrival and move the sound ones to the archive.

    If the arrival fails it is halved, down to the files that fail by themselves. Such a
    file is tried ``max_attempts`` times, counted in a stored table so that a try that ends
    the driver counts as well, and then set aside. The last error is raised if not one of
    several files can be loaded: then the files are not at fault.

    The end of an arrival is written down. When it comes back after a failure it is not
    loaded again, and only its moves are carried out to the end.
    """
    note = layout.finished(source_id)
    parts = read_note(spark, note)
    if parts is None:
        files = [row.asDict() for row in noticed.select("file", "modified", "length").orderBy("modified", "file").collect()]
        options = {"mode": mode, "rebalance": rebalance}
        loaded, error = _load(spark, files, songs, users, layout, source_id, max_attempts, options)
        if error is not None and not loaded and len(files) > 1:
            raise error
        if archive_path:
            sound = _sound_files(spark, layout, loaded, mode)
            versions = spark.createDataFrame([tuple(file.values()) for file in files], VERSION)
            store_moves(planned_moves(versions.join(sound, "file", "left_semi"), streams_path, archive_path), f"{layout.moves}/{source_id}")
        write_note(spark, note, json.dumps(loaded))
    if archive_path and exists(spark, f"{layout.moves}/{source_id}/list"):
        carry_out(spark, f"{layout.moves}/{source_id}")


def _sound_files(spark: SparkSession, layout: Layout, parts: Sequence[str], mode: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], "file string")
    verdicts = spark.read.schema(VERDICT).parquet(*[slice_path(layout.verdicts, part) for part in parts])
    return verdicts.where(usable(mode)).select("file").distinct()


def _load(spark, files: list[dict], songs, users, layout: Layout, source_id: str, max_attempts: int, options: dict) -> tuple[list[str], Exception | None]:
    """(arrivals that went through, the last error): the files whole or, if that fails, by halves."""
    if len(files) == 1:
        return _load_one(spark, files[0], songs, users, layout, source_id, max_attempts, options)
    try:
        _ingest_files(spark, files, songs, users, layout, source_id, options)
        return [source_id], None
    except Exception as error:
        failure = error
        _discard(spark, layout, source_id)
    loaded, middle = [], len(files) // 2
    for number, half in enumerate((files[:middle], files[middle:])):
        done, error = _load(spark, half, songs, users, layout, f"{source_id}-{number}", max_attempts, options)
        loaded += done
        failure = error or failure
    return loaded, failure


def _load_one(spark, file: dict, songs, users, layout: Layout, source_id: str, max_attempts: int, options: dict) -> tuple[list[str], Exception | None]:
    path = slice_path(layout.attempts, source_id)
    failure: Exception | None = None
    begun = spark.read.parquet(path).count() if exists(spark, path) else 0
    while begun < max_attempts:
        begun += 1
        attempt = spark.createDataFrame([(*file.values(), begun)], f"{VERSION}, attempt int")
        attempt.coalesce(1).write.mode("append").parquet(path)
        try:
            _ingest_files(spark, [file], songs, users, layout, source_id, options)
            return [source_id], None
        except Exception as error:
            failure = error
            _discard(spark, layout, source_id)
    message = f"{FAILED} in {begun} attempts" + (f": {str(failure).strip().splitlines()[0][:500]}" if failure else "")
    verdict = spark.createDataFrame([(file["file"], False, FAILED, None, message, 0, 0)], VERDICT)
    write_slice(verdict, layout.verdicts, source_id)
    write_slice(verdict.select(*QUARANTINED_COLUMNS), layout.quarantine, source_id)
    return [], failure or RuntimeError(message)


def _ingest_files(spark, files: list[dict], songs, users, layout: Layout, source_id: str, options: dict) -> None:
    full = [file["file"] for file in files if file["length"] > 0]
    empty = spark.createDataFrame([(file["file"],) for file in files if file["length"] == 0], "file string")
    lines = read_lines(spark, [_unescaped(name) for name in full]) if full else _no_lines(spark)
    ingest(spark, lines, empty, songs, users, layout, source_id, **options)


def _unescaped(uri: str) -> str:
    """A path as a reader takes it, from the URI that a scan reports."""
    from urllib.parse import unquote, urlsplit

    parts = urlsplit(uri)
    host = f"//{parts.netloc}" if parts.netloc or parts.scheme == "file" else ""
    # What a reader would take for a pattern is escaped.
    path = "".join(f"\\{char}" if char in "{}[]*?\\" else char for char in unquote(parts.path))
    return f"{parts.scheme}:{host}{path}"


def _no_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file string, block bigint, pos bigint, value string")


def _discard(spark: SparkSession, layout: Layout, source_id: str) -> None:
    """Take back what an arrival stored that did not go through, and refresh its days."""
    days = days_of(spark, layout.enriched, source_id)
    clear_partitions(spark, layout.enriched, [f"listen_date={day}/source_id={source_id}" for day in days])
    for path in (layout.splits, layout.verdicts, layout.quarantine, layout.run_metrics):
        clear_partitions(spark, path, [f"source_id={source_id}"])
    refresh_kpis(spark, layout, days)


def deliver(spark: SparkSession, raw_root: str, archive_root: str, layout: Layout, key: str, key_id: str, is_tree: bool, run, mode: str) -> dict[str, int]:
    """One delivery of a key: ``run(source_id)`` loads it, its accepted files move to the archive.

    Deliveries of a folder are numbered, each an arrival of its own, so that what an earlier
    one stored stands. One that was interrupted goes on under its number: up to the
    stored list of moves by loading what lies there again, after it by the moves alone.
    """
    path = f"{raw_root.rstrip('/')}/{key}"
    last, metrics = _last_delivery(spark, layout, key_id), None
    number = last + 1
    if last >= 0 and read_note(spark, layout.finished(f"{key_id}/{last:06d}")) is None:
        moves = f"{layout.moves}/{key_id}/{last:06d}"
        if exists(spark, f"{moves}/list/_SUCCESS"):
            carry_out(spark, moves)
            metrics = _metrics(spark, layout, _delivery_id(key_id, last, is_tree))
            write_note(spark, layout.finished(f"{key_id}/{last:06d}"), "[]")
            if not exists(spark, path) or file_versions(spark, path).join(_sound_files(spark, layout, [_delivery_id(key_id, last, is_tree)], mode), "file", "left_anti").isEmpty():
                return metrics
        else:
            number = last
    moves, source_id = f"{layout.moves}/{key_id}/{number:06d}", _delivery_id(key_id, number, is_tree)
    # Files that come later than this list are not moved, even if the run still reads them.
    file_versions(spark, path).write.mode("overwrite").parquet(f"{moves}/seen")
    metrics = run(source_id)
    sound = read_verdicts(spark, layout, source_id).where(usable(mode)).select("file")
    seen = spark.read.schema(VERSION).parquet(f"{moves}/seen")
    store_moves(planned_moves(seen.join(sound, "file", "left_semi"), raw_root, archive_root), moves)
    carry_out(spark, moves)
    write_note(spark, layout.finished(f"{key_id}/{number:06d}"), "[]")
    return metrics


def _delivery_id(key_id: str, number: int, is_tree: bool) -> str:
    return f"{key_id}-{number:06d}" if is_tree else key_id


def _last_delivery(spark: SparkSession, layout: Layout, key_id: str) -> int:
    from ..sources.paths import names_below

    return max((int(name) for name in names_below(spark, f"{layout.moves}/{key_id}")), default=-1)


def _metrics(spark: SparkSession, layout: Layout, source_id: str) -> dict[str, int]:
    return spark.read.parquet(slice_path(layout.run_metrics, source_id)).first().asDict()
