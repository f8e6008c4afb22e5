"""Stream-file rules: the cases one by one, random files, and files of many splits."""

import csv
import random
import re
from datetime import datetime

import pytest

from spinledger.operators import validation as v
from spinledger.sources.lines import read_lines
from spinledger.sources.listing import zero_length_files

HEADER = "user_id,track_id,listen_time"
GOOD = "1,k7,2024-06-25 08:05:09"


def write(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    data = content if isinstance(content, bytes) else content.encode("utf-8")
    (folder / name).write_bytes(data)
    return str(folder)


def verdicts(spark, path):
    rows = v.file_verdicts(read_lines(spark, path)).collect()
    return {row["file"].rsplit("/", 1)[1]: row for row in rows}


CASES = {
    # name: (content, ok, reason, line_no, row_count)
    "two_good": (f"{HEADER}\n{GOOD}\n{GOOD}\n", True, None, None, 2),
    "no_last_newline": (f"{HEADER}\n{GOOD}", True, None, None, 1),
    "iso_t": (f"{HEADER}\n1,k7,2024-06-25T08:05:09\n", True, None, None, 1),
    "date_only": (f"{HEADER}\n1,k7,2024-06-25\n", True, None, None, 1),
    "hours_only": (f"{HEADER}\n1,k7,2024-06-25T08\n", True, None, None, 1),
    "hours_offset": (f"{HEADER}\n1,k7,2024-06-25T08+02:00\n", True, None, None, 1),
    "micros_offset": (f"{HEADER}\n1,k7,2024-06-25 08:05:09.123456-05:00\n", True, None, None, 1),
    "crlf": (f"{HEADER}\r\n{GOOD}\r\n", True, None, None, 1),
    "quoted": (f'{HEADER}\n"1","a,b","2024-06-25"\n', True, None, None, 1),
    "doubled_quote": (f'{HEADER}\n1,"say ""hi"", ok",2024-06-25\n', True, None, None, 1),
    "quoted_header": (f'"user_id",track_id,"listen_time"\n{GOOD}\n', True, None, None, 1),
    "blank_field": (f"{HEADER}\n ,k7,2024-06-25\n", True, None, None, 1),
    "bom": (b"\xef\xbb\xbf" + f"{HEADER}\n{GOOD}\n".encode(), True, None, None, 1),
    "header_only": (f"{HEADER}\n", False, v.HEADER_ONLY, None, 0),
    "wrong_header": (f"listener,song,moment\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "upper_header": (f"USER_ID,track_id,listen_time\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "swapped_header": (f"track_id,user_id,listen_time\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "long_header": (f"{HEADER},extra\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "no_header": (f"{GOOD}\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "blank_header": (f"\n{HEADER}\n{GOOD}\n", False, v.BAD_HEADER, 1, 0),
    "extra_field": (f"{HEADER}\n{GOOD},surplus\n", False, v.WIDTH, 2, 0),
    "short_row": (f"{HEADER}\n{GOOD}\n1,k7\n", False, v.WIDTH, 3, 1),
    "blank_line": (f"{HEADER}\n{GOOD}\n\n{GOOD}\n", False, v.WIDTH, 3, 1),
    "blank_end": (f"{HEADER}\n{GOOD}\n\n", False, v.WIDTH, 3, 1),
    "no_user": (f"{HEADER}\n,k7,2024-06-25\n", False, v.EMPTY, 2, 0),
    "no_track": (f"{HEADER}\n1,,2024-06-25\n", False, v.EMPTY, 2, 0),
    "no_time": (f"{HEADER}\n1,k7,\n", False, v.EMPTY, 2, 0),
    "quoted_empty": (f'{HEADER}\n"",k7,2024-06-25\n', False, v.EMPTY, 2, 0),
    "not_a_date": (f"{HEADER}\n1,k7,someday\n", False, v.NOT_ISO, 2, 0),
    "slashes": (f"{HEADER}\n1,k7,2024/06/25\n", False, v.NOT_ISO, 2, 0),
    "us_date": (f"{HEADER}\n1,k7,06-25-2024 08:05:09\n", False, v.NOT_ISO, 2, 0),
    "year_only": (f"{HEADER}\n1,k7,2024\n", False, v.NOT_ISO, 2, 0),
    "feb_30": (f"{HEADER}\n1,k7,2024-02-30\n", False, v.NOT_ISO, 2, 0),
    "hour_24": (f"{HEADER}\n1,k7,2024-06-25 24:00:00\n", False, v.NOT_ISO, 2, 0),
    "year_zero": (f"{HEADER}\n1,k7,0000-06-25\n", False, v.NOT_ISO, 2, 0),
    "time_only": (f"{HEADER}\n1,k7,T08:05\n", False, v.NOT_ISO, 2, 0),
    "third_bad": (f"{HEADER}\n{GOOD}\n{GOOD}\n1,k7,bad\n{GOOD}\n,,\n", False, v.NOT_ISO, 4, 2),
    "header_again": (f"{HEADER}\n{GOOD}\n{HEADER}\n{GOOD}\n{HEADER}\n", False, v.NOT_ISO, 3, 1),
    "header_twice": (f"{HEADER}\n{HEADER}\n{HEADER}\n", False, v.NOT_ISO, 2, 0),
    "header_after_bad": (f"{HEADER}\n1,,2024-06-25\n{HEADER}\n", False, v.EMPTY, 2, 0),
    "bad_utf8": (f"{HEADER}\n{GOOD}\n".encode() + b"1,\xff\xfe,2024-06-25\n", False, v.NOT_UTF8, 3, 1),
    "carriage_return": (f"{HEADER}\n1,a\rb,2024-06-25\n", False, v.WIDTH, 2, 0),
}


@pytest.fixture(scope="module")
def case_verdicts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cases")
    for name, case in CASES.items():
        write(folder, name, case[0])
    return verdicts(spark, str(folder))


@pytest.mark.parametrize("name", CASES)
def test_case(case_verdicts, name):
    _, ok, reason, line_no, row_count = CASES[name]
    got = case_verdicts[name]
    assert (got["ok"], got["reason"], got["line_no"], got["row_count"]) == (ok, reason, line_no, row_count)


def test_messages(case_verdicts):
    assert case_verdicts["two_good"]["message"] == "PASSED — 2 rows checked"
    assert case_verdicts["extra_field"]["message"] == f"line 2: column count mismatch — {GOOD},surplus"
    assert case_verdicts["no_user"]["message"] == "line 2: empty value in required field — ,k7,2024-06-25"
    assert case_verdicts["third_bad"]["message"] == "line 4: listen_time 'bad' is not ISO datetime"
    assert case_verdicts["wrong_header"]["message"] == f"header mismatch: expected {HEADER}, got listener,song,moment"


def test_zero_length_file(spark, tmp_path):
    write(tmp_path, "empty.csv", "")
    write(tmp_path / "nested", "empty2.csv", "")
    write(tmp_path, "full.csv", f"{HEADER}\n{GOOD}\n")
    write(tmp_path, "_SUCCESS", "")
    files = zero_length_files(spark, str(tmp_path))
    rows = v.empty_file_verdicts(files).collect()
    assert sorted(row["file"].rsplit("/", 1)[1] for row in rows) == ["empty.csv", "empty2.csv"]
    assert all(not row["ok"] and row["message"] == "file is empty" and row["row_count"] == 0 for row in rows)
    scanned = v.file_verdicts(read_lines(spark, str(tmp_path)))
    assert scanned.columns == v.empty_file_verdicts(files).columns
    # The same spelling of the path as the scan gives.
    parents = {row["file"].rsplit("/", 1)[0] for row in [*scanned.collect(), *files.collect()]}
    assert parents == {scanned.first()["file"].rsplit("/", 1)[0], f"file:{tmp_path}/nested"}


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lines(spark, str(tmp_path / "absent.csv")).collect()


def expected_bad_lines(content):
    """Plain Python over csv.reader: [(line number, reason)] below the header."""
    iso = re.compile(v.iso_timestamp.__globals__["ISO_PATTERN"])
    found = []
    for number, fields in list(enumerate(csv.reader(content.splitlines()), start=1))[1:]:
        if len(fields) != 3:
            found.append((number, v.WIDTH))
        elif "" in fields:
            found.append((number, v.EMPTY))
        else:
            try:
                valid = bool(iso.match(fields[2])) and bool(datetime.fromisoformat(fields[2]))
            except ValueError:
                valid = False
            if not valid:
                found.append((number, v.NOT_ISO))
    return found


def random_file(rng, lines):
    ids = ["1", "k7", " ", "", '"q,q"', '""', '"a ""b"" c"', "é", "-"]
    times = [
        "2024-06-25", "2024-06-25 01", "2024-06-25T01:02", "2024-06-25 01:02:03", "2024-06-25T01:02:03.123",
        "2024-06-25 01:02:03.123456", "2024-06-25T01:02:03+01:00", "2024-06-25 01:02:03.12", "2024-6-25",
        "2024-13-01", "2023-02-29", "2024-02-29", "2024-06-25 25:00", "2024-06-25T23:60", "2024-06-25x01:02",
        " 2024-06-25", "2024-06-25 ", "", '"2024-06-25"', "2024-06-25 01:02:03+1", "20240625",
    ]
    rows = [HEADER]
    for _ in range(lines):
        fields = [rng.choice(ids), rng.choice(ids), rng.choice(times)]
        if rng.random() < 0.1:
            fields = fields[: rng.randint(1, 2)]
        if rng.random() < 0.1:
            fields.append(rng.choice(ids))
        rows.append(",".join(fields))
        if rng.random() < 0.05:
            rows.append("")
    return "\n".join(rows) + "\n"


def test_random_files_match_plain_python(spark, tmp_path):
    rng = random.Random(7)
    contents = {f"f{i}.csv": random_file(rng, rng.randint(1, 60)) for i in range(25)}
    for name, content in contents.items():
        write(tmp_path, name, content)
    lines = read_lines(spark, str(tmp_path))
    got = {name: [] for name in contents}
    for row in v.bad_lines(lines).orderBy("file", "line_no").collect():
        got[row["file"].rsplit("/", 1)[1]].append((row["line_no"], row["reason"]))
    expected = {name: expected_bad_lines(content) for name, content in contents.items()}
    assert got == expected
    for name, verdict in verdicts(spark, str(tmp_path)).items():
        first = next(iter(expected[name]), None)
        assert verdict["ok"] == (first is None)
        assert (verdict["line_no"], verdict["reason"]) == (first or (None, None))


def test_line_numbers_over_many_splits(spark, tmp_path):
    bad_at = {1500, 1501, 2400}
    rows = [HEADER] + [
        f"{i},t{i},{'x' if i + 1 in bad_at else '2024-06-25'}" for i in range(1, 2537)
    ]
    write(tmp_path, "big.csv", "\n".join(rows) + "\n")
    write(tmp_path, "small.csv", f"{HEADER}\n{GOOD}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        got = {row["line_no"] for row in v.bad_lines(lines).collect()}
        verdict = verdicts(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == bad_at
    assert (verdict["big.csv"]["line_no"], verdict["big.csv"]["row_count"]) == (1500, 1498)
    assert verdict["big.csv"]["data_rows"] == 2536
    assert verdict["small.csv"]["ok"]


def test_good_plays_drop_headers_and_bad_lines(spark, tmp_path):
    write(tmp_path, "a.csv", f"{HEADER}\n{GOOD}\n1,,2024-06-25\n2,t,2024-06-25T23:30:00-05:00\n")
    plays = v.good_plays(v.judge_lines(read_lines(spark, str(tmp_path)))).drop("file").collect()
    got = sorted((row["user_id"], row["track_id"], row["listen_time"].isoformat()) for row in plays)
    assert [row[:2] for row in got] == [("1", "k7"), ("2", "t")]


def test_parse_is_evaluated_once(spark, tmp_path):
    write(tmp_path, "a.csv", f"{HEADER}\n{GOOD}\n")
    plan = v.good_plays(v.judge_lines(read_lines(spark, str(tmp_path))))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_csv") == 1


def test_one_scan_and_no_sort_of_lines_per_verdict(spark, tmp_path):
    write(tmp_path, "a.csv", f"{HEADER}\n{GOOD}\n")
    plan = v.file_verdicts(read_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    below = plan[plan.index("Exchange") :]
    assert "ObjectHashAggregate" in below and "Window" in plan
