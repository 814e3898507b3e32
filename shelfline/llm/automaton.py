"""A generalised suffix automaton of word sequences, and the walk of a word stream through it.

Every sequence is an item or a piece of one, with the number of its words that must match in a row to count (its
window). A state stands for all strings of words that end at the same places of the sequences; walking a stream
through the states gives, at each word, the longest match that ends there. A mark (state, length) says which items a
window of that length belongs to; marks of a state and of its suffixes are chained, longest first.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np

# Bytes that are parts of words, A-Z counted as a-z. 0xFF never occurs in UTF-8; it ends a text.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or b >= 0x61 and b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
END = b"\xff"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a text."""
    return text.translate(FOLD).split()


@dataclass
class Hits:
    """What a stream of texts matched, per text."""

    n_words: np.ndarray
    hit: np.ndarray
    """Whether each word of the stream is inside a window; one more entry after each text."""
    longest: np.ndarray
    """The longest match that ends at each word, where words could match."""
    ends: np.ndarray
    """Place of the end of each text in the stream."""
    owners: dict[int, set]
    """Names of the items that each matching text holds a window of."""


class Builder:
    """Adds sequences one by one; ``pack`` gives the finished automaton as bytes."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.sequences: list[tuple[list[int], int, object]] = []

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: int, onto: int) -> int:
        """The state for the strings of ``onto`` that are one word longer than those of ``state``."""
        if self.length[onto] == self.length[state] + 1:
            return onto
        clone = self._state(self.length[state] + 1, self.link[onto], dict(self.next[onto]))
        self.link[onto] = clone
        while state >= 0 and self.next[state].get(word) == onto:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:  # an earlier sequence has this string
            return self._split(last, word, there)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.next[last][word])
        return new

    def add(self, words: list[bytes], window: int, owner: object) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
        last = 0
        for word in ids:
            last = self._extend(last, word)
        self.sequences.append((ids, window, owner))

    def _marks(self) -> dict[int, dict[int, set]]:
        """State -> window length -> owners of the windows that end there."""
        marks: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for ids, window, owner in self.sequences:
            state = 0
            for at, word in enumerate(ids):
                state = self.next[state][word]
                if at + 1 >= window:
                    while self.length[self.link[state]] >= window:  # the window slides: what is before it is dropped
                        state = self.link[state]
                    marks[state][window].add(owner)
        return marks

    def pack(self) -> bytes:
        n, size = len(self.link), max(1, len(self.vocabulary))
        marks = self._marks()
        mark_length, mark_before, mark_owners = [], [], []
        top = np.full(n, -1, dtype=np.int32)
        for state in np.argsort(self.length, kind="stable").tolist():  # a suffix is shorter, so it comes first
            above = int(top[self.link[state]]) if state else -1
            for length in sorted(marks.get(state, ())):
                mark_length.append(length)
                mark_before.append(above)
                mark_owners.append(marks[state][length])
                above = len(mark_length) - 1
            top[state] = above
        keys = np.array([s * size + w for s, follow in enumerate(self.next) for w in follow], dtype=np.int64)
        onto = np.array([t for follow in self.next for t in follow.values()], dtype=np.int32)
        pairs = np.unique(np.array([a * size + b for ids, _, _ in self.sequences for a, b in zip(ids, ids[1:], strict=False)], dtype=np.int64))
        shortest = min((window for ids, window, _ in self.sequences if ids), default=1)
        return pickle.dumps({
            "vocabulary": self.vocabulary, "keys": keys, "onto": onto, "pairs": pairs, "shortest": shortest, "top": top,
            "link": np.array(self.link, dtype=np.int32), "length": np.array(self.length, dtype=np.int32),
            "mark_length": np.array(mark_length, dtype=np.int32), "mark_before": np.array(mark_before, dtype=np.int32), "mark_owners": mark_owners,
        })


def _slot(pairs: np.ndarray, bits: int) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


class Automaton:
    """The finished automaton in a worker."""

    def __init__(self, packed: bytes):
        parts = pickle.loads(packed)
        self.vocabulary: dict[bytes, int] = parts["vocabulary"]
        self.size = max(1, len(self.vocabulary))
        self.vocabulary[END] = -2
        self.shortest = parts["shortest"]
        self.step = dict(zip(parts["keys"].tolist(), parts["onto"].tolist(), strict=True))
        self.links, self.lengths = parts["link"].tolist(), parts["length"].tolist()
        self.top, self.mark_length, self.mark_before, self.mark_owners = (parts[k] for k in ("top", "mark_length", "mark_before", "mark_owners"))
        # A match cannot run over two words that follow each other in no item; a table of bits finds most such places.
        self.bits = max(16, int(len(parts["pairs"])).bit_length() + 4)
        self.follow = np.zeros(1 << self.bits, dtype=bool)
        self.follow[_slot(parts["pairs"], self.bits)] = True

    def _stretches(self, ids: np.ndarray) -> np.ndarray:
        """(from, to) of the stretches of the stream that may hold a window."""
        known = ids >= 0
        if self.shortest > 1:
            pairs = ids[:-1].astype(np.int64) * self.size + ids[1:]
            joined = known[:-1] & known[1:]
            joined[joined] = self.follow[_slot(pairs[joined], self.bits)]
        else:
            joined = known
        edge = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
        start, stop = edge[::2], edge[1::2] + (self.shortest > 1)
        return np.stack([start, stop], axis=1)[stop - start >= self.shortest]

    def _walk(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """State and longest matching length at each word; all words are known ones."""
        step, links, lengths, size = self.step, self.links, self.lengths, self.size
        states, matched = [], []
        state = length = 0
        for word in ids:
            onto = step.get(state * size + word)
            while onto is None:
                state = links[state]
                length = lengths[state]
                onto = step.get(state * size + word)
            state = onto
            length += 1
            states.append(state)
            matched.append(length)
        return states, matched

    def match(self, texts: list[bytes]) -> Hits:
        """Windows in a batch of texts; a window never reaches over the end of a text."""
        stream = (b" " + END + b" ").join([*texts, b""]).translate(FOLD).split()
        ids = np.fromiter(map(self.vocabulary.get, stream, repeat(-1)), dtype=np.int64, count=len(stream))
        ends = np.flatnonzero(ids == -2)
        n_words = np.diff(ends, prepend=-1) - 1
        longest = np.zeros(len(ids), dtype=np.int64)
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        found_at, found_mark = [], []
        for start, stop in self._stretches(ids).tolist() if len(self.mark_length) else ():
            states, matched = self._walk(ids[start:stop].tolist())
            matched = np.array(matched)
            longest[start:stop] = matched
            states = np.array(states)
            mark = self.top[states]
            while (over := (mark >= 0) & (self.mark_length[mark] > matched)).any():  # windows of this state longer than the match
                mark[over] = self.mark_before[mark[over]]
            here = np.flatnonzero(mark >= 0)
            if len(here):
                found_at.append(here + start)
                found_mark.append(mark[here])
        owners: dict[int, set] = {}
        if found_at:
            at, mark = np.concatenate(found_at), np.concatenate(found_mark)
            np.add.at(change, at + 1 - self.mark_length[mark], 1)
            np.add.at(change, at + 1, -1)
            text = np.searchsorted(ends, at)
            for one, top in np.unique(np.stack([text, mark], axis=1), axis=0).tolist():
                names = owners.setdefault(one, set())
                while top >= 0:
                    names |= self.mark_owners[top]
                    top = int(self.mark_before[top])
        return Hits(n_words, np.cumsum(change[:-1]) > 0, longest, ends, owners)
