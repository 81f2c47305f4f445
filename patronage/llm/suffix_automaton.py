"""Suffix automaton over word sequences that knows the smallest document of each state."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """Recognizes every run of words of the added sequences. ``first`` holds, per state, the
    smallest document in which the state's runs occur, once ``close`` was called."""

    def __init__(self) -> None:
        self.after: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.size = [0]
        self.first: list[int | None] = [None]

    def _state(self, size: int, link: int, after: dict[Hashable, int]) -> int:
        self.after.append(after)
        self.link.append(link)
        self.size.append(size)
        self.first.append(None)
        return len(self.size) - 1

    def _split(self, state: int, word: Hashable, target: int) -> int:
        """The state reached from ``state`` by ``word``, made exact in length."""
        if self.size[target] == self.size[state] + 1:
            return target
        copy = self._state(self.size[state] + 1, self.link[target], dict(self.after[target]))
        self.link[target] = copy
        while state >= 0 and self.after[state].get(word) == target:
            self.after[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: Iterable[Hashable], doc: int) -> None:
        last = 0
        for word in words:
            if word in self.after[last]:
                last = self._split(last, word, self.after[last][word])
            else:
                made = self._state(self.size[last] + 1, 0, {})
                state = last
                while state >= 0 and word not in self.after[state]:
                    self.after[state][word] = made
                    state = self.link[state]
                if state >= 0:
                    self.link[made] = self._split(state, word, self.after[state][word])
                last = made
            known = self.first[last]
            self.first[last] = doc if known is None else min(known, doc)

    def close(self) -> None:
        """Pass each state's smallest document on to its suffixes."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            link, doc = self.link[state], self.first[state]
            if link > 0 and doc is not None:
                known = self.first[link]
                self.first[link] = doc if known is None else min(known, doc)

    def earlier(self, words: Sequence[Hashable], doc: int, window: int) -> list[int]:
        """Places of ``words`` where a run of ``window`` words begins that occurs in a smaller
        document. Matching statistics are followed as far as ``window``, no longer."""
        state = size = 0
        found = []
        for place, word in enumerate(words):
            while state and word not in self.after[state]:
                state = self.link[state]
                size = self.size[state]
            if word not in self.after[state]:
                continue
            state, size = self.after[state][word], size + 1
            if size < window:
                continue
            while self.size[self.link[state]] >= window:
                state = self.link[state]
            size = window
            first = self.first[state]
            if first is not None and first < doc:
                found.append(place - window + 1)
        return found
