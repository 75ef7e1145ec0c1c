"""A suffix automaton over words, and the windows of a fixed length that it shares with a text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property

Passage = tuple[int, list]
# Bytes of passages whose matches a reference keeps.
_KNOWN_BYTES = 1 << 18


class SuffixAutomaton:
    """All substrings of some passages; a separator of its own stands after each passage."""

    def __init__(self, passages: Iterable[list] = ()):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0
        for passage in passages:
            for word in passage:
                self._extend(word)
            self._extend(len(self.next))  # an int equals no word and no other separator

    def _extend(self, word) -> None:
        nxt, link, length = self.next, self.link, self.length
        new, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        link.append(0)
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(word) == q:
                    nxt[p][word] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new

    def windows(self, words: list, size: int) -> Iterator[tuple[int, int]]:
        """Start and state of each window of ``size`` words that occurs in the automaton.

        The matching statistic is the length of the longest suffix read so far that
        occurs. It is cut back to ``size`` words when it gets there, so the state is
        the one that stands for the window: equal windows have equal states.
        """
        nxt, link, length = self.next, self.link, self.length
        state, matched = 0, 0
        for i, word in enumerate(words):
            to = nxt[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(word)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= size:
                while length[link[state]] >= size:
                    state = link[state]
                matched = min(matched, length[state])
                yield i - size + 1, state


class Reference:
    """The passages of one reference document and which of their windows are found elsewhere."""

    def __init__(self, passages: list[Passage], size: int):
        self.passages, self.size = passages, size
        self.automaton = SuffixAutomaton(words for _, words in passages)
        self.hit: set[int] = set()
        self.known: dict[bytes, tuple] = {}
        self.known_bytes = 0

    @cached_property
    def states(self) -> list[tuple[int, int]]:
        """Start in the document and state of every window of the passages."""
        return [(at + i, s) for at, words in self.passages for i, s in self.automaton.windows(words, self.size)]

    def repeated(self) -> list[int]:
        """Starts of the windows that occur twice here or were found in another document."""
        count = Counter(s for _, s in self.states)
        return [at for at, s in self.states if count[s] > 1 or s in self.hit]

    def match(self, starts: list[int], texts: list[bytes]) -> tuple[list[int], tuple[list[int], list[bytes]]]:
        """Starts of the windows of another document's passages that occur here, and what is left of the passages.

        Left are the stretches of windows that do not occur here. Copies bring the same
        passages again and again; what was found for one is kept.
        """
        found: list[int] = []
        left: tuple[list[int], list[bytes]] = ([], [])
        for at, text in zip(starts, texts):
            result = self.known.get(text)
            if result is None:
                result = self._match(text.split())
                # What is kept is about ten times the text.
                if len(text) <= _KNOWN_BYTES // 8:
                    self.known_bytes += len(text)
                    if self.known_bytes > _KNOWN_BYTES:
                        self.known.clear()
                        self.known_bytes = len(text)
                    self.known[text] = result
            here, rest = result
            found += [at + i for i in here]
            left[0].extend([at + i for i, _ in rest])
            left[1].extend([t for _, t in rest])
        return found, left

    def _match(self, words: list[bytes]) -> tuple[list[int], list[tuple[int, bytes]]]:
        here = []
        for i, state in self.automaton.windows(words, self.size):
            here.append(i)
            self.hit.add(state)
        lacking = set(range(len(words) - self.size + 1)).difference(here)
        return here, [(a, b" ".join(words[a:b])) for a, b in spans(lacking, self.size)]


def spans(starts: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The stretches covered by windows of ``size`` words, from (first) word up to (before) word."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s + size))
        else:
            out.append((s, s + size))
    return out
