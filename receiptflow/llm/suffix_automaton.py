"""A generalised suffix automaton over sequences of word ids."""

from __future__ import annotations


class SuffixAutomaton:
    """Accepts every run of words of every added item, and knows which items hold a run.

    ``window`` words of an item in a row make a window; an item of fewer words is one window as a whole.
    """

    def __init__(self, items: list[list[int]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.length)
        #: the state of the last ``window`` words of a state's runs, for states of runs of that length or more
        self.top = [0] * n
        by_length = sorted(range(1, n), key=self.length.__getitem__)
        for state in by_length:
            if self.length[state] >= window:
                above = self.link[state]
                self.top[state] = state if self.length[above] < window else self.top[above]
        #: items that hold a window, by its ``top``
        self.holders: dict[int, set[int]] = {}
        #: (words, item) of the short items that end wherever a state is reached
        self.shorts: list[tuple[tuple[int, int], ...]] = [()] * n
        own: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(items):
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= window:
                    self.holders.setdefault(self.top[state], set()).add(k)
            if 0 < len(words) < window:
                own.setdefault(state, []).append((len(words), k))
        if own:
            for state in by_length:
                above = self.shorts[self.link[state]]
                self.shorts[state] = above + tuple(own[state]) if state in own else above

    def _extend(self, last: int, w: int) -> int:
        """The state of the item so far and ``w``."""
        there = self.next[last].get(w)
        if there is not None and self.length[there] == self.length[last] + 1:
            return there
        if there is not None:
            return self._split(last, w, there)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.next[at][w]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._split(at, w, there)
        return new

    def _split(self, at: int, w: int, there: int) -> int:
        """A state for the shorter runs of ``there``, those that come by ``at``."""
        part = self._state(self.length[at] + 1, dict(self.next[there]))
        self.link[part], self.link[there] = self.link[there], part
        while at >= 0 and self.next[at].get(w) == there:
            self.next[at][w] = part
            at = self.link[at]
        return part

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(-1)
        self.length.append(length)
        return len(self.length) - 1

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of ``words`` inside windows, first and past-the-end, joined where they touch, and the items hit."""
        spans: list[tuple[int, int]] = []
        hit: set[int] = set()
        met: set[int] = set()
        state = matched = 0
        window, length, link, following, shorts = self.window, self.length, self.link, self.next, self.shorts
        for i, w in enumerate(words):
            while state and w not in following[state]:
                state = link[state]
                matched = length[state]
            state = following[state].get(w, 0)
            matched = matched + 1 if state else 0
            longest = 0
            if matched >= window:
                longest = matched
                met.add(self.top[state])
            for n, k in shorts[state]:
                if n <= matched:
                    hit.add(k)
                    longest = max(longest, n)
            if longest:
                first = i + 1 - longest
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i + 1))
        return spans, hit.union(*(self.holders[x] for x in met))
