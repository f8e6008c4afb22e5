"""Arrivals as a stream: every new version of a file under a folder flows into the KPI tables."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.arrivals import MAX_ATTEMPTS, consume, notice
from ..plans.ingest import FILE_MODE
from ..schemas import Layout
from ..sources.lease import holding
from ..sources.listing import VERSION
from ..sources.paths import make_folder


def start_stream(
    streams_path: str,
    songs: DataFrame,
    users: DataFrame,
    layout: Layout,
    checkpoint: str,
    *,
    name: str = "stream",
    max_files_per_trigger: int | None = None,
    archive_path: str | None = None,
    mode: str = FILE_MODE,
    rebalance: bool = True,
    available_now: bool = True,
    poll_seconds: float = 10.0,
    max_attempts: int = MAX_ATTEMPTS,
) -> StreamingQuery:
    """Ingest files in order of arrival; a version of a file is taken once however often it is seen.

    The source of the stream are notices: versions of files that a listing of the folder
    found, written down before they are loaded. A file that is delivered again under its name is a
    new version and replaces its plays. Empty files are noticed like others.

    Each micro-batch is one arrival named by the stream and its batch number. After
    a failure the same files come back under the same number and replace what the
    failed attempt left, so the checkpoint and the tables belong together: start
    both afresh or neither.

    A micro-batch takes all waiting files up to a bound, so a day is recomputed once for them.
    Days are recomputed whole: one file per trigger keeps strict order and gives the same tables
    with more refreshes. A file that keeps failing is set aside after ``max_attempts``.
    ``archive_path`` is where accepted files move as soon as their arrival is loaded; rejected
    ones stay. ``available_now`` drains the backlog and stops; else the folder is
    listed every ``poll_seconds``.
    """
    spark = songs.sparkSession
    make_folder(spark, layout.arrivals)
    notice(spark, streams_path, layout, max_files_per_trigger)
    source = spark.readStream.schema(VERSION).options(maxFilesPerTrigger="1", recursiveFileLookup="true").json(layout.arrivals)

    def run(batch: DataFrame, batch_id: int) -> None:
        with holding(batch.sparkSession, layout.lease):
            consume(
                batch.sparkSession,
                batch,
                songs,
                users,
                layout,
                f"{name}-{batch_id:010d}",
                streams_path=streams_path,
                archive_path=archive_path,
                mode=mode,
                rebalance=rebalance,
                max_attempts=max_attempts,
            )

    writer = source.writeStream.queryName(name).foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    query = writer.start()

    def poll() -> None:
        while query.isActive and not query.awaitTermination(poll_seconds):
            notice(spark, streams_path, layout, max_files_per_trigger)

    threading.Thread(target=poll, name=f"{name}-notices", daemon=True).start()
    return query
