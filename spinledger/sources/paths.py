"""The few file-system calls that are not DataFrame reads or writes."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Calls to a store that the driver makes side by side.
FILE_THREADS = 16


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def side_by_side(call: Callable, items: Iterable) -> list:
    """The results of a call for each item, in order. Calls to a store mostly wait for it."""
    items = list(items)
    if len(items) < 2:
        return [call(item) for item in items]
    with ThreadPoolExecutor(min(FILE_THREADS, len(items))) as threads:
        return list(threads.map(call, items))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def existing(spark: SparkSession, parent: str, names: Iterable[str]) -> list[str]:
    """The full paths of those names that exist below ``parent``."""
    fs, parent_path = _resolve(spark, parent)
    if not fs.exists(parent_path):
        return []
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    names = list(names)
    found = side_by_side(lambda name: fs.exists(new_path(parent_path, name)), names)
    return [f"{parent}/{name}" for name, there in zip(names, found, strict=True) if there]


def empty_version(spark: SparkSession, file: str) -> tuple[str, datetime, int] | None:
    """(file, modified, 0) of a file given by its URI, if it exists and is still empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    status = fs.getFileStatus(path)
    return (file, datetime.fromtimestamp(status.getModificationTime() / 1000, UTC), 0) if status.getLen() == 0 else None


def names_below(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def rename_file(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another name; a file of that name is replaced."""
    fs, source_path = _resolve(spark, source)
    _, target_path = _resolve(spark, target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path):
        fs.delete(target_path, False)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.mkdirs(hadoop_path)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is either whole or not there: written aside, then renamed."""
    fs, hadoop_path = _resolve(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(hadoop_path):
        fs.delete(hadoop_path, False)
    if not fs.rename(aside, hadoop_path):
        raise OSError(f"could not write {path}")


def read_note(spark: SparkSession, path: str):
    """The JSON value of a note, or None if there is none."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def archive_input(spark: SparkSession, raw_root: str, archive_root: str, object_key: str) -> dict[str, str]:
    """Move one processed file to the archive under the same relative key.

    A rename, so no bytes pass through this process. Call it only after the load
    of the input has succeeded. A missing input raises, a folder too: ``run_and_archive`` moves
    its files one by one. A file that an earlier delivery of the same key left is replaced.
    """
    for name, value in {"raw_root": raw_root, "archive_root": archive_root, "object_key": object_key}.items():
        if not value:
            raise ValueError(f"Required field missing: {name}")
    source = f"{raw_root.rstrip('/')}/{object_key}"
    target = f"{archive_root.rstrip('/')}/{object_key}"
    fs, source_path = _resolve(spark, source)
    if not fs.exists(source_path):
        raise FileNotFoundError(source)
    status = fs.getFileStatus(source_path)
    if status.isDirectory():
        raise IsADirectoryError(source)
    move_file(spark, status.getPath().toUri().toString(), target, status.getModificationTime(), status.getLen())
    return {"status": "archived", "from": source, "to": target}


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path, with scheme and without a slash at its end."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def move_file(spark: SparkSession, file: str, target: str, modified: int, length: int) -> str:
    """Rename one file of a move list, by the driver; returns the state (see ``moves``)."""
    uri = spark._jvm.java.net.URI(file)
    source_path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = source_path.getFileSystem(spark._jsc.hadoopConfiguration())
    _, target_path = _resolve(spark, target)
    if not fs.exists(source_path):
        return "moved before" if fs.exists(target_path) else "missing"
    status = fs.getFileStatus(source_path)
    if status.getLen() != length or abs(status.getModificationTime() - modified) >= 1000:
        return "newer version"
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path) and fs.getFileStatus(target_path).isFile():
        fs.delete(target_path, False)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {file} to {target}")
    return "moved"


def first_folder(spark: SparkSession, parent: str, prefix: str) -> str | None:
    """Any one folder below ``parent`` whose name starts so; lists no further than that."""
    fs, parent_path = _resolve(spark, parent)
    if not fs.exists(parent_path):
        return None
    found = fs.listStatusIterator(parent_path)
    while found.hasNext():
        name = found.next().getPath().getName()
        if name.startswith(prefix):
            return f"{parent}/{name}"
    return None


def days_of(spark: SparkSession, parent: str, source_id: str) -> list[str]:
    """The days for which a table partitioned by day and source holds rows of a source."""
    fs, _ = _resolve(spark, parent)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{parent}/listen_date=*/source_id={source_id}"))
    return sorted(status.getPath().getParent().getName().removeprefix("listen_date=") for status in found or [])


def files_below(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(name of the folder, name, length) of the files at any depth below ``path``."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found, files = [], fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().getParent().getName(), status.getPath().getName(), status.getLen()))
    return found


def replace_files(spark: SparkSession, source: str, folders: Iterable[str]) -> None:
    """Put copies of the data files of ``source``, which are small, in place of the files of other folders.

    The copies come first: a folder is never without a file.
    """
    fs, source_path = _resolve(spark, source)
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    given = [status.getPath() for status in fs.listStatus(source_path) if not status.getPath().getName().startswith(("_", "."))]

    def replace(folder: str) -> None:
        folder_path = jvm.org.apache.hadoop.fs.Path(folder)
        before = [status.getPath() for status in fs.listStatus(folder_path)]
        for path in given:
            target = jvm.org.apache.hadoop.fs.Path(folder_path, path.getName())
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path, fs, target, False, conf)
        for path in before:
            fs.delete(path, True)

    side_by_side(replace, folders)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of rows that are derived from others."""
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; of several callers one gets True.

    The store has to create exclusively, as HDFS does. For local files the operating system does.
    """
    fs, hadoop_path = _resolve(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    if fs.getScheme() == "file":
        try:
            os.close(os.open(fs.makeQualified(hadoop_path).toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        fs.create(hadoop_path, False).close()
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            return False
        raise error
    return True


def file_age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was last touched; None if it does not exist."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return None
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.setTimes(hadoop_path, int(time.time() * 1000), -1)


def delete_file(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, False)
