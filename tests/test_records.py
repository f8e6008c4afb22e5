"""Records that span lines: against a plain reader, over many splits, through whole runs."""

import contextlib
import csv
import io
import random

import pytest

from spinledger.operators import records as r
from spinledger.operators import validation as v
from spinledger.plans.ingest import ROW_MODE, run_batch
from spinledger.schemas import Layout
from spinledger.sources.lines import read_lines
from spinledger.sources.tables import slice_path

HEADER = "user_id,track_id,listen_time"


@contextlib.contextmanager
def splits_of(spark, size):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def records_of(spark, path):
    found = {}
    for row in r.join_records(read_lines(spark, path)).collect():
        found.setdefault(row["file"].rsplit("/", 1)[1], []).append((row["block"], row["pos"], row["value"]))
    return {name: [value for _, _, value in sorted(rows)] for name, rows in found.items()}


def plain_records(content):
    """Texts of the records a plain reader sees, by the lines it takes for each."""
    lines = content.split("\n")
    if lines[-1] == "":
        lines.pop()
    reader = csv.reader(iter([line + "\n" for line in lines]))
    texts, at = [], 0
    for _ in reader:
        texts.append("\n".join(lines[at : reader.line_num]))
        at = reader.line_num
    return texts


def random_text(rng, size):
    return "".join(rng.choice(['"', '"', ",", "\n", "a", "b ", '""', '","', "é"]) for _ in range(size))


def test_records_of_random_text_match_a_plain_reader(spark, tmp_path):
    rng = random.Random(11)
    contents = {f"f{i}.csv": random_text(rng, rng.choice([1, 5, 40, 400])) for i in range(24)}
    for name, content in contents.items():
        (tmp_path / name).write_text(content, newline="")
    for size in (61, 100_000):
        with splits_of(spark, size):
            got = records_of(spark, str(tmp_path))
        assert got == {name: plain_records(content) for name, content in contents.items()}


def test_numbers_of_records_are_dense_in_a_block(spark, tmp_path):
    (tmp_path / "a.csv").write_text("".join(f'{i},"x\ny{i}\nz",t\n' for i in range(200)))
    with splits_of(spark, 300):
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        rows = r.join_records(lines).collect()
    assert len(rows) == 200
    blocks = {}
    for row in rows:
        blocks.setdefault(row["block"], []).append(row["pos"])
    assert all(sorted(places) == list(range(1, len(places) + 1)) for places in blocks.values())


def test_a_record_without_end_is_malformed_and_not_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(r, "RECORD_CHARS", 500)
    fitting = '1,"' + "x\n" * 100 + '",2024-06-25'
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{fitting}\n1,k,2024-06-25\n2,\"open,2024-06-25\n" + "3,k,2024-06-25\n" * 2000)
    for size in (400, 1_000_000):
        with splits_of(spark, size):
            got = records_of(spark, str(tmp_path))["a.csv"]
        assert got[:3] == [HEADER, fitting, "1,k,2024-06-25"]
        assert got[3:] == ["2,open,2024-06-25,,,"]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "file string, block bigint, pos bigint, value string")
    assert r.join_records(empty).collect() == []


@pytest.fixture
def references(spark):
    songs = spark.createDataFrame([("k", "n", "a", "pop", 1000), ("k\nl", "m", "a", "rock", 2000)], "track_id string, track_name string, artists string, track_genre string, duration_ms bigint")
    users = spark.createDataFrame([("1", "u", "c")], "user_id string, user_name string, user_country string")
    return songs, users


def plain_verdict(content):
    """(first bad record's number or none, data rows) by a plain reader."""
    rows = list(csv.reader(io.StringIO(content)))
    bad = (number for number, row in enumerate(rows[1:], start=2) if len(row) != 3 or "" in row or not row[2].startswith("2024-"))
    return next(bad, None), len(rows) - 1


def test_a_run_takes_records_that_span_lines(spark, tmp_path, references):
    streams = tmp_path / "streams"
    streams.mkdir()
    contents = {
        "spanning.csv": f'{HEADER}\n1,"k\nl",2024-06-25\n1,k,2024-06-25\n',
        "crlf.csv": f'{HEADER}\r\n1,"k\r\nl",2024-06-25\r\n',
        "plain.csv": f"{HEADER}\n1,k,2024-06-26\n",
        "bad.csv": f'{HEADER}\n1,"a\n\n""b""",2024-06-25\n1,"c\nd",someday\n,k,2024-06-25\n',
    }
    for name, content in contents.items():
        (streams / name).write_text(content, newline="")
    layout = Layout(str(tmp_path / "tables"))
    for _ in range(2):
        metrics = run_batch(spark, str(streams), *references, layout)
        assert (metrics["files_checked"], metrics["files_rejected"], metrics["rows_checked"], metrics["rows_written"]) == (4, 1, 7, 4)
    verdicts = spark.read.parquet(layout.verdicts).collect()
    for row in verdicts:
        name = row["file"].rsplit("/", 1)[1]
        assert (row["line_no"], row["data_rows"]) == plain_verdict(contents[name])
    assert {row["reason"] for row in verdicts} == {None, v.NOT_ISO}
    stored = spark.read.parquet(layout.enriched).groupBy("track_id").count().collect()
    assert {tuple(row) for row in stored} == {("k", 2), ("k\nl", 2)}


def test_single_bad_records_among_spanning_ones(spark, tmp_path, references):
    streams = tmp_path / "streams"
    streams.mkdir()
    (streams / "a.csv").write_text(f'{HEADER}\n1,"k\nl",2024-06-25\n1,"x\ny",\n1,k,2024-06-25\n1,k\n')
    layout = Layout(str(tmp_path / "tables"))
    with splits_of(spark, 60):
        metrics = run_batch(spark, str(streams), *references, layout, source_id="one", mode=ROW_MODE)
    assert (metrics["rows_written"], metrics["quarantined"]) == (2, 2)
    set_aside = spark.read.parquet(slice_path(layout.quarantine, "one")).where("message like 'line%'").collect()
    assert {(row["line_no"], row["reason"]) for row in set_aside} == {(3, v.EMPTY), (5, v.WIDTH)}


def test_files_without_open_quotes_are_read_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n"1","a,b","2024-06-25"\n1,"say ""hi""",2024-06-25\n1,a"b,2024-06-25\n')
    splits = v.split_summary(read_lines(spark, str(tmp_path)))
    assert r.spanning_files(splits).count() == 0
