"""Merging many sorted runs with a tree of losers: one comparison per level and element."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


def merge_runs(runs: Sequence[Iterator]) -> Iterator:
    """All elements of sorted runs in order; equal ones by the number of their run.

    An inner node keeps the loser of the match below it. After the winner leaves, its run's
    next element is replayed against the losers on its path only.
    """
    count = len(runs)
    if not count:
        return
    # (exhausted, element, run): an exhausted run loses against everything.
    heads = [_head(run, number) for number, run in enumerate(runs)]
    losers: list = [None] * count
    winner = None
    for number in range(count):
        winner = _replay(losers, heads[number], (number + count) // 2, building=True)
    while winner is not None and not winner[0]:
        yield winner[1]
        number = winner[2]
        heads[number] = _head(runs[number], number)
        winner = _replay(losers, heads[number], (number + count) // 2)


def _head(run: Iterator, number: int) -> tuple:
    for element in run:
        return False, element, number
    return True, None, number


def _before(a: tuple, b: tuple) -> bool:
    if a[0] or b[0]:
        return b[0] and not a[0]
    return a[1] < b[1] or (not b[1] < a[1] and a[2] < b[2])


def _replay(losers: list, candidate: tuple, node: int, building: bool = False) -> tuple | None:
    while node:
        other = losers[node]
        if building and other is None:
            # The first to arrive waits for its opponent.
            losers[node] = candidate
            return None
        if other is not None and _before(other, candidate):
            losers[node], candidate = candidate, other
        node //= 2
    return candidate
