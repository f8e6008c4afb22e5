"""One run at a time per root: a numbered lease file that only one run can create.

The holder of a root is the file with the highest number below its lease folder. It may be
followed by the next number once it is released or no longer renewed. Files are created
exclusively, so of several runs that wait one wins, and a holder that slept through its time
finds a higher number and stops before it writes on.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .paths import create_exclusively, delete_file, file_age, names_below, touch, write_note

# Seconds after its last renewal from which a lease counts as left behind.
EXPIRES = 300.0
# Seconds that a run waits for another one to end.
WAIT = 3600.0
_POLL = 2.0
_RELEASED = ".released"
_held = threading.local()


class RootBusy(RuntimeError):
    """Another run holds the root."""


class LeaseLost(RuntimeError):
    """The lease expired and another run took the root over."""


class Lease:
    """A held lease. ``check`` raises once another run has taken over."""

    def __init__(self, spark: SparkSession, path: str, number: int) -> None:
        self._spark, self._path, self.number = spark, path, number

    def check(self) -> None:
        last, _ = _last(self._spark, self._path)
        if last != self.number:
            raise LeaseLost(f"lease {self.number} of {self._path} was taken over by {last}")
        touch(self._spark, f"{self._path}/{_name(self.number)}")

    def release(self) -> None:
        write_note(self._spark, f"{self._path}/{_name(self.number)}{_RELEASED}", "{}")


def _name(number: int) -> str:
    return f"{number:012d}"


def _last(spark: SparkSession, path: str) -> tuple[int, bool]:
    """(highest number, whether it was released); (-1, True) if there is none."""
    names = [name for name in names_below(spark, path) if not name.startswith(".")]
    numbers = [int(name) for name in names if not name.endswith(_RELEASED)]
    last = max(numbers, default=-1)
    return last, last < 0 or f"{_name(last)}{_RELEASED}" in names


def acquire(spark: SparkSession, path: str, wait: float = WAIT, expires: float = EXPIRES) -> Lease:
    """The lease of ``path``; waits for its holder at most ``wait`` seconds, then raises."""
    until = time.monotonic() + wait
    while True:
        last, released = _last(spark, path)
        free = released or (file_age(spark, f"{path}/{_name(last)}") or 0.0) > expires
        if free and create_exclusively(spark, f"{path}/{_name(last + 1)}"):
            for name in names_below(spark, path):
                # The holder before is kept: without it a late run could count from zero.
                if not name.startswith(".") and int(name.removesuffix(_RELEASED)) < last:
                    delete_file(spark, f"{path}/{name}")
            return Lease(spark, path, last + 1)
        if time.monotonic() >= until:
            raise RootBusy(f"another run holds {path}")
        time.sleep(min(_POLL, max(0.05, until - time.monotonic())))


@contextmanager
def holding(spark: SparkSession, path: str, wait: float = WAIT, expires: float = EXPIRES) -> Iterator[Lease]:
    """Hold the lease of ``path`` during a block and renew it in the background.

    A block inside a block of the same thread shares its lease.
    """
    own = _held.__dict__
    if path in own:
        own[path].check()
        yield own[path]
        return
    lease = own[path] = acquire(spark, path, wait, expires)
    over = threading.Event()

    def renew() -> None:
        while not over.wait(expires / 3):
            try:
                lease.check()
            except LeaseLost:
                return
            except Exception:
                # A store that does not answer is asked again; the lease may expire meanwhile.
                continue

    renewal = threading.Thread(target=renew, name="lease", daemon=True)
    renewal.start()
    try:
        yield lease
    finally:
        over.set()
        renewal.join()
        del own[path]
        lease.release()
