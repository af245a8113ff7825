"""Suffix automata over sequences of small numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    """All runs of the added sequences, as states with transitions, longest lengths and links to shorter suffixes."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:  # another sequence has this run
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def add(self, words: list[int]) -> None:
        state = 0
        for w in words:
            state = self._extend(state, w)

    def matches(self, words: Iterable[int]) -> Iterator[tuple[int, int, int]]:
        """At each word: its place, the state, and the length of the longest added run that ends there."""
        state = length = 0
        for at, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state, length = self.next[state][w], length + 1
            yield at, state, length
