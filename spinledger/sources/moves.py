"""Moves of files as a stored list that can be carried out again.

The list is written before the first file moves. Each move looks at what it finds, so that a
list which was carried out in part, or twice at once, ends the same way; a file that was
delivered anew in the meantime is left for the run that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .listing import VERSION
from .paths import exists, move_file, qualified

# States of a move.
MOVED, DONE_BEFORE, NEWER, MISSING = "moved", "moved before", "newer version", "missing"
# Stores that tasks reach by themselves; files of others are renamed by the driver, one call each.
_BY_TASKS = ("file", "hdfs")


def planned_moves(files: DataFrame, raw_root: str, archive_root: str) -> DataFrame:
    """(file, modified, length, target): files below ``raw_root`` under the same key elsewhere."""
    spark = files.sparkSession
    raw, target = (qualified(spark, root) for root in (raw_root, archive_root))
    key = F.substring(_plain(F.col("file")), len(_path(raw)) + 2, 1 << 30)
    below = F.startswith(_plain(F.col("file")), F.lit(f"{_path(raw)}/"))
    return files.select("file", "modified", "length", F.when(below, F.concat(F.lit(f"{target}/"), key)).alias("target"))


def _plain(uri: Column) -> Column:
    """The path of a file URI, without scheme and host and with its escapes resolved."""
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _path(uri: str) -> str:
    return urlsplit(uri).path.rstrip("/")


def store_moves(moves: DataFrame, path: str) -> None:
    """Write the list; a list that lies there already is the same one and stands."""
    spark = moves.sparkSession
    if not exists(spark, f"{path}/list/_SUCCESS"):
        moves.write.mode("overwrite").parquet(f"{path}/list")


def carry_out(spark: SparkSession, path: str) -> dict[str, int]:
    """Carry out a stored list unless that is done, and count its files by state."""
    if not exists(spark, f"{path}/done/_SUCCESS"):
        moves = spark.read.schema(f"{VERSION}, target string").parquet(f"{path}/list").where("target is not null")
        by_tasks = F.regexp_extract("target", "^([a-z0-9]+):", 1).isin(*_BY_TASKS)
        done = moves.where(by_tasks).mapInArrow(_move_rows, "file string, target string, state string")
        others = moves.where(~by_tasks).select("file", "modified", "length", "target")
        rows = [(row["file"], row["target"], move_file(spark, row["file"], row["target"], _millis(row["modified"]), row["length"])) for row in others.toLocalIterator()]
        if rows:
            done = done.unionByName(spark.createDataFrame(rows, done.schema))
        done.write.mode("overwrite").parquet(f"{path}/done")
    states = spark.read.parquet(f"{path}/done").groupBy("state").count().collect()
    return {row["state"]: row["count"] for row in states}


def pending(spark: SparkSession, folder: str, names: list[str]) -> list[str]:
    """Lists below ``folder`` that were written and not carried out to the end."""
    return [f"{folder}/{name}" for name in names if exists(spark, f"{folder}/{name}/list/_SUCCESS") and not exists(spark, f"{folder}/{name}/done/_SUCCESS")]


def _millis(moment) -> int:
    return int(moment.timestamp() * 1000)


def _move_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        states = [_move(*row) for row in zip(*(batch.column(name).to_pylist() for name in ("file", "target", "modified", "length")), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("target"), pa.array(states, pa.string())], ["file", "target", "state"])


def _move(file: str, target: str, modified, length: int) -> str:
    from pyarrow import fs

    parts = urlsplit(file)
    store = fs.LocalFileSystem() if parts.scheme in ("", "file") else fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/")[0]
    # A scan's file names are URIs; the target is a plain path behind its scheme.
    source, aim = unquote(parts.path), "/" + target.split(":", 1)[1].lstrip("/").removeprefix(f"{parts.netloc}/" if parts.netloc else "")
    info, there = store.get_file_info([source, aim])
    if info.type == fs.FileType.NotFound:
        return DONE_BEFORE if there.type == fs.FileType.File else MISSING
    if info.size != length or abs(info.mtime.timestamp() - modified.timestamp()) >= 1:
        return NEWER
    store.create_dir(aim.rsplit("/", 1)[0], recursive=True)
    try:
        store.move(source, aim)
    except OSError:
        # Another attempt of this task was faster.
        if store.get_file_info(source).type != fs.FileType.NotFound:
            raise
        return DONE_BEFORE
    return MOVED
