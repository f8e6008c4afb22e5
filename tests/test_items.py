"""Items, upsert, text functions and manifests."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spinledger.functions import text
from spinledger.operators.upsert import (
    items_json,
    to_items,
    upsert,
    with_complete_key,
    with_incomplete_key,
)
from spinledger.schemas import DAILY_GENRE_ITEM, DAILY_GENRE_KEYS, TOP_GENRES_ITEM
from spinledger.sources.manifest import dates_manifest, read_dates_manifest, write_dates_manifest


def test_upsert_replaces_by_key(spark):
    schema = "genre string, date string, listen_count bigint"
    old = spark.createDataFrame([("pop", "2024-06-25", 1), ("rock", "2024-06-25", 2)], schema)
    new = spark.createDataFrame([("pop", "2024-06-25", 9), ("pop", "2024-06-26", 3)], schema)
    once = upsert(old, new, DAILY_GENRE_KEYS)
    expected = [("pop", "2024-06-25", 9), ("pop", "2024-06-26", 3), ("rock", "2024-06-25", 2)]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, upsert(once, new, DAILY_GENRE_KEYS).collect())) == expected


def test_items_cast_and_drop_other_columns(spark):
    rows = spark.createDataFrame(
        [("dub", "2021-03-14", 17, 6, 4321987, 0.1, "extra"), ("fado", "2021-03-15", 2, 2, None, None, "extra")],
        "genre string, date string, listen_count bigint, unique_listeners bigint, "
        "total_listening_time_ms bigint, avg_listening_time_per_user_ms double, other string",
    )
    items = to_items(rows, DAILY_GENRE_ITEM)
    assert items.columns == list(DAILY_GENRE_ITEM)
    dub = items.where("genre = 'dub'").first()
    assert dub["listen_count"] == Decimal(17)
    assert dub["avg_listening_time_per_user_ms"] == Decimal("0.1")
    fado = json.loads(items_json(items.where("genre = 'fado'")).first()["item"])
    assert "total_listening_time_ms" not in fado and "avg_listening_time_per_user_ms" not in fado
    assert fado["genre"] == "fado"


def test_item_text_attributes(spark):
    rows = spark.createDataFrame([("2024-06-25", "01", None, 5)], "date string, rank string, genre string, listen_count int")
    item = to_items(rows, TOP_GENRES_ITEM).first()
    assert (item["rank"], item["genre"], item["listen_count"]) == ("01", None, Decimal(5))


def test_rows_without_a_key_are_set_apart(spark):
    rows = spark.createDataFrame([("pop", "d"), (None, "d"), (None, None)], "genre string, date string")
    assert with_complete_key(rows, DAILY_GENRE_KEYS).count() == 1
    reasons = sorted(row["reason"] for row in with_incomplete_key(rows, DAILY_GENRE_KEYS).collect())
    assert reasons == ["null key: genre", "null key: genre,date"]


def test_text_functions(spark):
    row = (
        spark.sql("select date'2024-06-25' as day, 1 as rank, 12 as high, 305000L as ms, 'streams/a.csv' as key")
        .select(
            text.date_text(F.col("day")),
            text.padded_rank(F.col("rank")),
            text.date_rank(F.col("day"), F.col("high")),
            text.rank_label(F.col("rank")),
            text.minutes(F.col("ms")),
            text.manifest_key(F.col("key")),
            text.exact_decimal(F.lit(0.3)),
        )
        .first()
    )
    assert tuple(row) == (
        "2024-06-25", "01", "2024-06-25#12", "#01", 5.1, "manifests/streams/a.csv.json", Decimal("0.3000000000"),
    )


def test_manifest_round_trip_sorts_and_dedupes(spark, tmp_path):
    path = str(tmp_path / "m.json")
    written = write_dates_manifest(spark, path, ["2024-06-26", None, "2024-06-25", "2024-06-26"])
    assert written == ["2024-06-25", "2024-06-26"] == read_dates_manifest(spark, path)


def test_manifest_rewrite_and_empty(spark, tmp_path):
    path = str(tmp_path / "m.json")
    write_dates_manifest(spark, path, ["2024-06-26"])
    assert write_dates_manifest(spark, path, []) == [] == read_dates_manifest(spark, path)


@pytest.mark.parametrize("content", ['{"days": ["2023-11-02"]}', '{"dates": null}', '{"dates": {"day": 2}}', "[2023"])
def test_malformed_manifest_raises(spark, tmp_path, content):
    path = tmp_path / "m.json"
    path.write_text(content)
    with pytest.raises(Exception, match="(?i)dates|malformed"):
        read_dates_manifest(spark, str(path))


def test_missing_manifest_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_dates_manifest(spark, str(tmp_path / "absent.json"))


def test_manifest_numbers_become_text(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"dates": [20231105, "2023-11-02"]}')
    assert read_dates_manifest(spark, str(path)) == ["20231105", "2023-11-02"]


def test_dates_manifest_of_a_frame(spark):
    frame = spark.sql(
        "select explode(array(date'2024-06-26', null, date'2024-06-25', date'2024-06-26')) as listen_date"
    )
    assert dates_manifest(frame).first()["dates"] == ["2024-06-25", "2024-06-26"]
