"""The given tables in the roles of plays, songs and users.

Whole tables throughout. Event users without a supplier row have no account, so the
inner join drops a share of the event plays by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import STREAM_COLUMNS

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_plays(table(spark, sf_dir, "events"))


def _event_plays(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
        F.col("ts").alias("listen_time"),
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays that arrive first in the two-arrival queries."""
    return _event_plays(table(spark, sf_dir, "events").where(F.col("event_type") == "view"))


def other_than_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays that arrive second."""
    return _event_plays(table(spark, sf_dir, "events").where(F.col("event_type") != "view"))


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.col("p_type").alias("track_genre"),
        F.col("p_brand").alias("artists"),
        (F.col("p_size").cast("bigint") * 10000).alias("duration_ms"),
    )


def suppliers_as_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("user_name"),
        F.col("s_nationkey").alias("user_country"),
    )


def order_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, larger stream: every line item is a play on its ship date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("track_id"),
        F.col("l_shipdate").alias("listen_time"),
    )


def customers_as_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("c_nationkey").alias("user_country"),
    )


def text_ids(rows: DataFrame) -> DataFrame:
    """Ids as text, the type they have in CSV files."""
    ids = {name: F.col(name).cast("string") for name in ("user_id", "track_id") if name in rows.columns}
    return rows.withColumns(ids)


def event_csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event plays as the text columns of a stream file."""
    plays = event_streams(spark, sf_dir)
    return text_ids(plays).withColumn("listen_time", F.date_format("listen_time", TIME_FORMAT))


def sound_lines(spark: SparkSession, sf_dir: str, views: bool) -> DataFrame:
    """Lines of one file per day, without bad records: the views, or all other events."""
    chosen = F.col("event_type") == "view" if views else F.col("event_type") != "view"
    return _with_headers(_lines_of(table(spark, sf_dir, "events").where(chosen), _line()))


def day_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines of one file per day, without bad records."""
    return _with_headers(_lines_of(table(spark, sf_dir, "events"), _line()))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines of one file per day, split by the hour.

    Events of the smallest values turn into bad records, five kinds in all, so that
    the rules have something to find; every event remains a line. Event ids count up
    by one in time order, which makes them positions.
    """
    return _with_headers(_lines_of(table(spark, sf_dir, "events"), _damaged_line()))


WRONG_HEADER = "user,track,time"
WIDE_LINE = "," * 30_000


def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_lines`` with whole files damaged too: those of every 7th have a wrong header,
    those of every 8th nothing but the header, those of every 9th a line of 30,001 fields."""
    lines = event_lines(spark, sf_dir)
    day = F.substring("file", 15, 2)
    first = F.min(F.when(F.col("block") >= 0, F.col("pos"))).over(Window.partitionBy("file"))
    header = F.col("block") < 0
    value = (
        F.when(header & (day == "07"), WRONG_HEADER)
        .when(~header & (day == "09") & (F.col("pos") == F.col("first")), WIDE_LINE)
        .otherwise(F.col("value"))
    )
    return lines.withColumn("first", first).where(header | (day != "08")).withColumn("value", value).drop("first")


RECORDS_PER_FILE = 200


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, place, value): every document as a record whose track is its whole text, line breaks
    included, in files of consecutive documents. Some times are no times."""
    docs = table(spark, sf_dir, "documents")
    track = F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""'))
    time = F.when(F.length("text") % 50 == 0, "someday").otherwise("2024-06-25")
    number = F.floor(F.col("doc_id") / RECORDS_PER_FILE).cast("string")
    value = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), track, F.lit('",'), time)
    rows = docs.select(F.concat(F.lit("docs-"), number, F.lit(".csv")).alias("file"), F.col("doc_id").alias("place"), value.alias("value"))
    headers = rows.select("file").distinct().withColumns({"place": F.lit(-1).cast("bigint"), "value": F.lit(",".join(STREAM_COLUMNS))})
    return rows.unionByName(headers)


def _lines_of(events: DataFrame, value: Column) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    file = F.concat(F.lit("plays-"), day, F.lit(".csv"))
    return events.select(
        file.alias("file"),
        F.hour("ts").cast("bigint").alias("block"),
        F.col("event_id").alias("pos"),
        value.alias("value"),
    )


def _line() -> Column:
    track = F.get_json_object("props", "$.k")
    return F.concat_ws(",", F.col("user_id").cast("string"), track, F.date_format("ts", TIME_FORMAT))


def _with_headers(lines: DataFrame) -> DataFrame:
    headers = lines.select("file").distinct()
    return lines.unionByName(
        headers.select(
            "file",
            F.lit(-1).cast("bigint").alias("block"),
            F.lit(0).cast("bigint").alias("pos"),
            F.lit(",".join(STREAM_COLUMNS)).alias("value"),
        )
    )


def _damaged_line() -> Column:
    user = F.col("user_id").cast("string")
    track = F.get_json_object("props", "$.k")
    time = F.date_format("ts", TIME_FORMAT)
    empty, value = F.lit(""), F.col("value")
    return (
        F.when(value <= 0.02, F.concat_ws(",", empty, track, time))
        .when(value <= 0.04, F.concat_ws(",", user, empty, time))
        .when(value <= 0.06, F.concat_ws(",", user, track, empty))
        .when(value <= 0.08, F.concat_ws(",", user, track, F.replace(time, F.lit("-"), F.lit("/"))))
        .when(value <= 0.10, F.concat_ws(",", user, track, time, F.lit("x")))
        .otherwise(F.concat_ws(",", user, track, time))
    )
