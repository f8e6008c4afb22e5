"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Rows per Arrow batch: texts are long, and a batch is what a Python worker holds at once.
BATCH_ROWS = "1000"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, and let workers find this package.

    Where the package is installed or sent with ``--py-files`` the path changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    environment = spark.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), _ROOT]))


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    This cuts the lineage, keeps what is computed once from being computed again and
    survives the loss of any executor.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lower_ascii(text):
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text) whatever other columns there are; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def quoted(names: list[str]) -> list[str]:
    """Column names as they have to be written where they may hold dots or blanks."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def carried(docs: DataFrame, added: tuple[str, ...]) -> tuple[list[str], DataFrame]:
    """(names, frame) with the columns of ``docs`` called c0, c1... so that none can clash.

    Columns of the names in ``added`` are left out: an operator sets them anew.
    """
    names = [name for name in docs.columns if name not in added]
    return names, docs.select([F.col(own).alias(f"c{k}") for k, own in enumerate(quoted(names))])


def extended(frame: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``frame`` with further fields; every field may be null."""
    fields = [T.StructField(field.name, field.dataType) for field in frame.schema]
    return T.StructType([*fields, *T.StructType.fromDDL(ddl)])


def restored(names: list[str]) -> list[Column]:
    """The carried columns under their own names."""
    return [F.col(f"c{k}").alias(name) for k, name in enumerate(names)]


def hashed_sample(frame: DataFrame, count: int, rows: int, *columns: str) -> DataFrame:
    """``count`` of about ``rows`` rows, those of the smallest hashes; all if there are fewer.

    Rows far above the expected limit are left out before the sort, so that no more than a
    few times ``count`` rows travel, however many partitions there are.
    """
    key = F.xxhash64(*columns)
    share = min(1.0, 4.0 * (count + 25) / max(rows, 1))
    low = F.lit(int(-(2**63) + share * (2**64 - 1025)))
    return frame.where(key <= low).orderBy(key, *columns).limit(count)
