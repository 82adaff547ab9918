"""A suffix automaton over words."""

from __future__ import annotations

from collections.abc import Hashable, Iterable


class SuffixAutomaton:
    """All word sequences of the added spans; each state knows where its sequences end first.

    Spans must be added in the order in which "first" is meant.
    """

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.end = [-1], [0], [-1]
        self._last = 0

    def add(self, words: Iterable[Hashable], at: int) -> None:
        """Append a span whose first word has position `at`."""
        self._last = 0
        for place, word in enumerate(words, at):
            self._extend(word, place)

    def _state(self, moves: dict, link: int, length: int, end: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.end.append(end)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: Hashable) -> int:
        """A copy of q for the sequences that also end where p was extended."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.end[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, word: Hashable, place: int) -> None:
        p = self._last
        if word in self.next[p]:  # the span so far lies in an earlier one
            q = self.next[p][word]
            self._last = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
            return
        new = self._state({}, 0, self.length[p] + 1, place)
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        self._last = new

    def first_ends(self, k: int) -> list[int]:
        """For each state of sequences of k words or more, where its last k words end first; -1 for shorter ones."""
        out = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[s] >= k:
                up = self.link[s]
                out[s] = out[up] if self.length[up] >= k else self.end[s]
        return out

    def matches(self, words: Iterable[Hashable], k: int, first_ends: list[int]) -> Iterable[tuple[int, int]]:
        """(index of the last word, where the same k words end first) wherever the longest match has k words or more."""
        state, have = 0, 0
        moves, link, length = self.next, self.link, self.length
        for i, word in enumerate(words):
            while state and word not in moves[state]:
                state = link[state]
                have = length[state]
            to = moves[state].get(word)
            if to is None:
                have = 0
                continue
            state, have = to, have + 1
            if have >= k:
                yield i, first_ends[state]
