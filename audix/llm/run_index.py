"""Run-length text index: a run-compressed Burrows-Wheeler transform with
samples at the run ends, and the matching statistics it streams.

The texts of a collection are joined with terminators that differ from each
other, so no match crosses a text. Rows j-1 and j of the transform with equal
letters stay neighbours one text position to the left and match one letter
longer. The match with the neighbouring row is therefore needed at run ends
only: between two sampled positions it shrinks by one per letter. Streaming the
samples over the text gives, for every position, the longest match that starts
anywhere else in the collection.
"""

from __future__ import annotations

import numpy as np

_STEP = 7            # letters per packed word: 257**7 < 2**63
_BASE = 257
BLOCK = 1 << 17      # rows compared or sorted at once


class RunIndex:
    """Index of texts (byte strings), empty ones included. Places, ranks and
    match lengths take four bytes a letter as long as these can count them."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
        if texts:
            self.letters = np.frombuffer(b"\0".join((*texts, b"")), np.uint8).astype(np.int16)
            self.letters += 1
            self.letters[self.starts + sizes] = 0
        else:
            self.letters = np.zeros(0, np.int16)
        self.kind = np.int32 if len(self.letters) < 2**31 else np.int64
        self._pack()
        self._sample(self._suffix_order())

    def _pack(self) -> None:
        """words[i]: the next letters up to a terminator; room[i]: letters
        before it, at most the letters of a word."""
        n = len(self.letters)
        self.words, self.room = np.zeros(n, np.int64), np.zeros(n, np.int8)
        inside = np.ones(n, bool)
        for k in range(_STEP):
            ahead = self.letters[k:]
            inside[:len(ahead)] &= ahead != 0
            self.words *= _BASE
            self.words[:len(ahead)] += ahead * inside[:len(ahead)]
            self.room += inside

    def _suffix_order(self) -> np.ndarray:
        """Suffix array by prefix doubling of the groups still tied, block by
        block. A rank is the first row of a group, so blocks of whole groups may
        see the finer ranks of those before them."""
        n = len(self.letters)
        order = np.argsort(self.words, kind="stable").astype(self.kind)
        new = np.ones(n, bool)
        for i in range(1, n, BLOCK):
            here, before = order[i:i + BLOCK], order[i - 1:min(i + BLOCK, n) - 1]
            new[i:i + BLOCK] = (self.words[here] != self.words[before]) | (self.room[here] < _STEP)
        rank = np.empty(n, self.kind)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=self.kind), self.kind(0)))
        at, depth = self._tied(new, np.arange(n, dtype=self.kind)), _STEP
        while len(at):
            first = np.append(np.flatnonzero(rank[order[at]] == at), len(at))
            edges = np.unique(np.append(first[np.searchsorted(first, np.arange(0, len(at), BLOCK))], len(at)))
            left = []
            for a, b in zip(edges[:-1], edges[1:]):
                rows = at[a:b]
                items = order[rows]
                key = rank[items].astype(np.int64) * n + rank[items + depth]
                inner = np.argsort(key, kind="stable")
                items, key = items[inner], key[inner]
                order[rows] = items
                fresh = np.append(True, key[1:] != key[:-1])
                rank[items] = np.maximum.accumulate(np.where(fresh, rows, self.kind(0)))
                left.append(self._tied(fresh, rows))
            at = np.concatenate(left)
            depth *= 2
        return order

    @staticmethod
    def _tied(new: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Those of the rows whose group, begun where new, has several."""
        tied = ~new
        tied[:-1] |= ~new[1:]
        return rows[tied]

    def _sample(self, order: np.ndarray) -> None:
        """Letters and first rows of the runs; match lengths at both run ends."""
        n = len(order)
        letter = self.letters[order - 1]     # of the first letter: the last terminator
        head = np.ones(n, bool)
        head[1:] = (letter[1:] != letter[:-1]) | (letter[1:] == 0)
        first = np.flatnonzero(head).astype(self.kind)
        self.run_letter, self.run_first = letter[first], first
        self.n_rows = n
        last = np.append(first[1:], self.kind(n))[:len(first)] - 1
        self.head_position, self.tail_position = order[first], order[last]
        # a run's last row and the next run's first one are neighbours
        self.head_match, self.tail_match = np.zeros(len(first), self.kind), np.zeros(len(first), self.kind)
        self.head_match[1:] = self.extend(self.head_position[1:], self.tail_position[:-1])
        self.tail_match[:-1] = self.head_match[1:]

    def extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths of the suffixes at a and b, a block in step."""
        return np.concatenate([np.zeros(0, self.kind), *[self._extend(a[i:i + BLOCK], b[i:i + BLOCK])
                                                         for i in range(0, len(a), BLOCK)]])

    def _extend(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), self.kind)
        live = np.arange(len(a))
        while len(live):
            same = (self.words[a] == self.words[b]) & (self.room[a] >= _STEP) & (self.room[b] >= _STEP)
            stop = ~same
            if stop.any():
                x, y, more = a[stop], b[stop], np.zeros(int(stop.sum()), self.kind)
                on = np.ones(len(x), bool)
                for k in range(_STEP):
                    on &= (self.room[x] > k) & (self.room[y] > k)
                    on[on] = self.letters[x[on] + k] == self.letters[y[on] + k]
                    more += on
                out[live[stop]] += more
            live, a, b = live[same], a[same] + _STEP, b[same] + _STEP
            out[live] += _STEP
        return out

    def matching_statistics(self) -> np.ndarray:
        """For every position of the joined texts, the length of the longest
        match that starts at any other position."""
        best = np.zeros(self.n_rows, self.kind)
        for position, match in ((self.head_position, self.head_match), (self.tail_position, self.tail_match)):
            sampled = np.full(self.n_rows, -1, self.kind)
            sampled[position] = position
            ends = np.zeros(self.n_rows, self.kind)
            ends[position] = position + match
            value = ends[np.maximum.accumulate(sampled)]
            value -= np.arange(self.n_rows, dtype=self.kind)
            np.maximum(best, value, out=best)
        return best
