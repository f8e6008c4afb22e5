"""One run at a time per root."""

import os
import threading
import time

import pytest

from spinledger.plans import ingest
from spinledger.schemas import Layout
from spinledger.sources.lease import LeaseLost, RootBusy, acquire, holding
from spinledger.sources.paths import create_exclusively
from spinledger.sources.tables import read_kpis

from test_runs import put, songs, users  # noqa: F401


def test_one_of_many_creates_a_file(spark, tmp_path):
    won = []
    start = threading.Barrier(8)

    def run():
        start.wait()
        won.append(create_exclusively(spark, str(tmp_path / "lease" / "1")))

    threads = [threading.Thread(target=run) for _ in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(won) == [False] * 7 + [True]


def test_a_second_run_waits_or_raises(spark, tmp_path):
    path = str(tmp_path / "lease")
    first = acquire(spark, path)
    with pytest.raises(RootBusy):
        acquire(spark, path, wait=0)
    threading.Timer(0.5, first.release).start()
    second = acquire(spark, path, wait=30)
    assert second.number == first.number + 1
    with pytest.raises(LeaseLost):
        first.check()


def test_a_lease_left_behind_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "lease")
    lost = acquire(spark, path)
    os.utime(tmp_path / "lease" / f"{lost.number:012d}", (time.time() - 100, time.time() - 100))
    with pytest.raises(RootBusy):
        acquire(spark, path, wait=0, expires=200)
    taken = acquire(spark, path, wait=0, expires=50)
    with pytest.raises(LeaseLost):
        lost.check()
    # The end of the lost run does not free the root of its follower.
    lost.release()
    with pytest.raises(RootBusy):
        acquire(spark, path, wait=0, expires=50)
    taken.check()


def test_a_held_lease_is_renewed_and_released_on_errors(spark, tmp_path):
    path = str(tmp_path / "lease")
    with pytest.raises(ZeroDivisionError), holding(spark, path, expires=3) as outer:
        with holding(spark, path) as inner:
            assert inner is outer
        time.sleep(4)
        with pytest.raises(RootBusy):
            acquire(spark, path, wait=0, expires=3)
        1 / 0
    assert acquire(spark, path, wait=0).number == outer.number + 1
    left = [name for name in os.listdir(path) if not name.startswith(".")]
    assert len(left) == 3


def test_two_runs_at_once_on_one_root(spark, songs, users, tmp_path):  # noqa: F811
    layout, errors = Layout(str(tmp_path / "t")), []
    paths = [put(tmp_path, f"{name}.csv", f"u1,t1,2024-06-25 1{k}:00:00") for k, name in enumerate("ab")]

    def run(path):
        try:
            ingest.run_batch(spark, path, songs, users, layout)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(path,)) for path in paths]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    assert [row["listen_count"] for row in read_kpis(spark, layout.daily_genre).collect()] == [2]


def test_a_run_that_lost_its_root_stops(spark, songs, users, tmp_path, monkeypatch):  # noqa: F811
    layout = Layout(str(tmp_path / "t"))
    path = put(tmp_path, "a.csv", "u1,t1,2024-06-25 10:00:00")
    judged = ingest.validate

    def slow(*args, **options):
        result = judged(*args, **options)
        assert create_exclusively(spark, f"{layout.lease}/{1:012d}")
        return result

    monkeypatch.setattr(ingest, "validate", slow)
    with pytest.raises(LeaseLost):
        ingest.run_batch(spark, path, songs, users, layout)
    assert not os.path.exists(layout.enriched)
