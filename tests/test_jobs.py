"""The command line: the three steps apart, the whole run, and the stream."""

import pytest

from spinledger.__main__ import main
from spinledger.schemas import Layout
from spinledger.sources.tables import read_kpis


@pytest.fixture
def roots(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "streams").mkdir(parents=True)
    (raw / "reference").mkdir()
    (raw / "reference" / "songs.csv").write_text(
        "track_id,track_name,track_genre,artists,duration_ms\nt1,Harbour,folk,Ida,61000\n"
    )
    (raw / "reference" / "users.csv").write_text("user_id,user_name,user_age,user_country\n7,Alice,25,UK\n")
    (raw / "streams" / "a.csv").write_text("user_id,track_id,listen_time\n7,t1,2023-11-02 08:05:09\n")
    (raw / "streams" / "bad.csv").write_text("user_id,track_id,listen_time\n7,t1,nope\n")
    return raw, str(tmp_path / "tables"), str(tmp_path / "archive")


def arguments(job, raw, root, *more, tables=True):
    reference = ["--songs", f"{raw}/reference/songs.csv", "--users", f"{raw}/reference/users.csv"]
    return [job, "--raw-root", str(raw), "--root", root, *(reference if tables else []), *more]


def plays(spark, root):
    return [(row["genre"], row["date"], row["listen_count"]) for row in read_kpis(spark, Layout(root).daily_genre).collect()]


def test_steps_one_after_the_other(spark, roots):
    raw, root, _ = roots
    key = ["--object-key", "streams/a.csv"]
    assert main(arguments("validate", raw, root, *key, tables=False)) == 0
    assert main(arguments("transform", raw, root, *key)) == 0
    assert main(arguments("load", raw, root, *key, tables=False)) == 0
    assert plays(spark, root) == [("folk", "2023-11-02", 1)]


def test_validate_fails_on_a_bad_file(roots):
    raw, root, _ = roots
    assert main(arguments("validate", raw, root, "--object-key", "streams/bad.csv", tables=False)) == 1


def test_load_without_manifest_raises(roots):
    raw, root, _ = roots
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        main(arguments("load", raw, root, "--object-key", "streams/a.csv", tables=False))


def test_run_with_archive(spark, roots):
    raw, root, archive = roots
    more = ["--object-key", "streams/a.csv", "--archive-root", archive]
    assert main(arguments("run", raw, root, *more)) == 0
    assert plays(spark, root) == [("folk", "2023-11-02", 1)]
    assert not (raw / "streams" / "a.csv").exists()


def test_stream_job(spark, roots, tmp_path):
    raw, root, _ = roots
    assert main(arguments("stream", raw, root, "--checkpoint", str(tmp_path / "cp"))) == 0
    assert plays(spark, root) == [("folk", "2023-11-02", 1)]
    assert spark.read.parquet(Layout(root).quarantine).count() == 1
