"""A generalised suffix automaton over the words of several short texts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Recognises every run of words that occurs in one of the items.

    Items of at least ``window`` words count by their windows of that many words, shorter
    ones as one window of all their words. After ``finish`` each state knows the items
    whose windows end there.
    """

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self._items: list[tuple[str, Sequence[int]]] = []
        self.window_items: dict[int, frozenset[str]] = {}
        self.whole_items: dict[int, list[tuple[int, str]]] = {}
        self.nearest_whole: list[int] = []

    def add(self, name: str, words: Sequence[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
        if len(words):
            self._items.append((name, words))

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            known = self.next[at][word]
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._clone(at, word, known)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, word: int, known: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[known])
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while at != -1 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def finish(self) -> SuffixAutomaton:
        found: dict[int, set[str]] = {}
        for name, words in self._items:
            state = 0
            for count, word in enumerate(words, 1):
                state = self.next[state][word]
                if count >= self.window:
                    found.setdefault(self._shortest_with(state, self.window), set()).add(name)
            if len(words) < self.window:
                whole = self._shortest_with(state, len(words))
                self.whole_items.setdefault(whole, []).append((len(words), name))
        self.window_items = {state: frozenset(names) for state, names in found.items()}
        self._items = []
        # The nearest state up the links, itself included, where a short item ends.
        self.nearest_whole = [0] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest_whole[state] = state if state in self.whole_items else self.nearest_whole[self.link[state]]
        return self

    def _shortest_with(self, state: int, length: int) -> int:
        """The state of the suffix of ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, words: Iterable[int]) -> Iterable[tuple[int, int, Iterable[str]]]:
        """(position of the last word, words matched, items) where windows end.

        The state holds the longest run of words ending here that occurs in any item.
        """
        state, length = 0, 0
        following, link, lengths = self.next, self.link, self.length
        for position, word in enumerate(words):
            while state and word not in following[state]:
                state = link[state]
                length = lengths[state]
            if word in following[state]:
                state = following[state][word]
                length += 1
            if length >= self.window:
                yield position, self.window, self.window_items[self._shortest_with(state, self.window)]
            whole = self.nearest_whole[state]
            while whole:
                for size, name in self.whole_items[whole]:
                    if size <= length:
                        yield position, size, (name,)
                whole = self.nearest_whole[link[whole]]
