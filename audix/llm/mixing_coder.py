"""Adaptive context-mixing range coder for blocks of token ids.

Every id is coded by a mixture of four predictions. Orders 2, 1 and 0 each name
one id: the one that last followed the two ids before, that last followed the id
before, and that is ahead in the block so far. A prediction has a confidence
(how often it came true), and for every order and confidence the block learns
how often such predictions hold; that is the share of the range the order gets
of what the higher orders leave. The rest, never empty, goes to all ids by their
counts in the group of blocks, so no id of the header is ever without a range.

Blocks start from a fresh state and end with their own words, so each can be
decoded and checked alone, given the header. Many blocks are coded in step:
every array has one lane per block, and a step is a fixed number of operations
on flat arrays that stay in place, whatever the ids. Ids are named by their
place in the header. The coder's numbers are integers held in doubles, exact
below 2**53; chances are doubles that both sides get by the same operations.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK_IDS = 1024
LANES = 4096                # 65,536 at most
SLOTS = 1 << 10             # contexts a block tells apart, per order
STATES = 16                 # confidence: 0 is no prediction yet
COUNT_BITS = 20             # the header's counts, scaled
MIX_BITS = 12               # the mixture's range
RATE = 2.0 ** -5

_NONE = 0xFFFFFF00          # a slot is place * 256 + confidence
_HASH, _HASH_TWO = np.array(0x9E3779B1, np.uint32), np.array(0x85EBCA6B, np.uint32)
_SHIFT = np.array(32 - (SLOTS.bit_length() - 1), np.uint32)
_BEYOND = np.array(1 << COUNT_BITS, np.uint32)      # any place
_BYTE, _SURE, _ONE = np.array(8, np.uint32), np.array(STATES - 1, np.uint8), np.array(1, np.uint8)
_MIX, _SHARE, _FREE = (np.array(x) for x in (2.0 ** MIX_BITS, 2.0 ** -MIX_BITS, 2.0 ** MIX_BITS - 1))
_COUNT, _LAST = np.array(2.0 ** -COUNT_BITS), np.array(2.0 ** COUNT_BITS - 1)
_KEEP, _LEARN = np.array(1 - RATE, np.float32), np.array(RATE, np.float32)
# A range has at most 48 bits and is given a word of 16 where it is below 32.
_TOP, _BOTTOM, _HEAD, _WORD, _MORE = (np.array(x) for x in (2.0 ** 48, 2.0 ** 32, 2.0 ** -32, 2.0 ** 16, 2.0 ** 16 - 1))


def scaled_counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, counts) with counts that sum to 2**COUNT_BITS, each at
    least one; the header of a group of blocks."""
    found, n = np.unique(ids, return_counts=True)
    if len(found) == 0:
        return found.astype(np.uint32), n
    if len(found) > 1 << (COUNT_BITS - 1):
        raise ValueError("more distinct ids in a group than its counts can hold")
    room = (1 << COUNT_BITS) - len(found)
    scaled = 1 + (n * room) // n.sum()
    scaled[np.argmax(n)] += (1 << COUNT_BITS) - scaled.sum()
    return found.astype(np.uint32), scaled


class _Base:
    """Ranges of the header's ids, and the id at every point of the range. The
    place after the last stands for a whole range, where another order was met."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids.astype(np.uint32), counts.astype(np.int64)
        self.none = len(ids)
        bound = np.concatenate(([0], np.cumsum(self.counts))).astype(np.float64)
        self.first = np.concatenate((bound[:-1], [0.0]))
        self.size = np.concatenate((self.counts, [1 << COUNT_BITS])).astype(np.float64)

    def places(self, ids: np.ndarray) -> np.ndarray:
        index = np.zeros(int(self.ids.max(initial=0)) + 1, "<u4")
        index[self.ids] = np.arange(len(self.ids), dtype=np.uint32)
        return index.take(ids)

    def points(self) -> np.ndarray:
        kind = np.uint16 if self.none < 1 << 16 else np.uint32
        return np.append(np.repeat(np.arange(self.none, dtype=kind), self.counts), kind(self.none))


class _Mixture:
    """State of all lanes. Arrays hold order 2, order 1, order 0, each with all
    lanes; those of four rows have the counts before them."""

    def __init__(self, lanes: int):
        self.table = np.full(2 * lanes * SLOTS, _NONE, "<u4")
        self.base = np.arange(2 * lanes, dtype=np.uint32) * np.uint32(SLOTS)
        self.slot = np.full(3 * lanes, _NONE, "<u4")
        # chance that a prediction of an order and a confidence holds
        start = (np.arange(STATES) + 1) / (np.arange(STATES) + 6)
        start[0] = 0
        self.chance = np.tile(start.astype(np.float32), 3 * lanes)
        self.row = np.arange(3 * lanes, dtype=np.int64) * STATES
        self.last, self.context = np.zeros(lanes, "<u4"), np.zeros(lanes, "<u4")
        self._buffers(lanes)

    def _buffers(self, m: int) -> None:
        self.m = m
        self.hash, self.at = np.empty(2 * m, np.uint32), np.empty(2 * m, np.int64)
        self.places = np.zeros(4 * m, "<u4")
        self.place = self.places[m:]
        self.byte = self.slot.view(np.uint8)[::4]
        self.state, self.weaker, self.stronger = (np.empty(3 * m, np.uint8) for _ in range(3))
        self.cell = np.empty(3 * m, np.int64)
        self.p, self.held, self.weight = np.empty(3 * m, np.float32), np.empty(3 * m, np.float32), np.empty(3 * m)
        self.hit, self.apart = np.empty(3 * m, bool), np.empty(3 * m, bool)
        self.own = np.empty(2 * m)
        self.first, self.size = np.zeros((4, m)), np.zeros((4, m))
        self.fresh, self.change, self.gone = np.empty(m, "<u4"), np.empty(3 * m, "<u4"), np.empty(3 * m, "<u4")
        self.lane = np.arange(m)

    def keep(self, m: int) -> None:
        """Go on with the first ``m`` lanes only."""
        if m < self.m:
            self.base, self.slot, self.row = (a.reshape(-1, self.m)[:, :m].ravel()
                                              for a in (self.base, self.slot, self.row))
            self.last, self.context = self.last[:m].copy(), self.context[:m].copy()
            self._buffers(m)

    def predict(self) -> None:
        """places and confidences of the next id; where the ranges of the counts
        and of order 2, 1 and 0 begin, and their sizes."""
        m, p = self.m, self.weight
        two, one = self.hash[:m], self.hash[m:]
        np.multiply(self.last, _HASH, out=one)
        np.add(one, self.context, out=two)
        np.multiply(one, _HASH_TWO, out=self.context)
        np.right_shift(self.hash, _SHIFT, out=self.hash)
        np.add(self.hash, self.base, out=self.hash)
        self.at[:] = self.hash
        self.table.take(self.at, out=self.slot[:2 * m], mode="clip")
        np.right_shift(self.slot, _BYTE, out=self.place)
        self.state[:] = self.byte
        self.cell[:] = self.state
        np.add(self.cell, self.row, out=self.cell)
        self.chance.take(self.cell, out=self.p, mode="clip")
        p[:] = self.p
        # a repeated prediction has no share of its own
        two, one, top = self.place[:m], self.place[m:2 * m], self.place[2 * m:]
        np.not_equal(one, two, out=self.apart[:m])
        np.not_equal(top, one, out=self.apart[m:2 * m])
        np.not_equal(top, two, out=self.apart[2 * m:])
        np.logical_and(self.apart[m:2 * m], self.apart[2 * m:], out=self.apart[m:2 * m])
        self.own[:] = self.apart[:2 * m]
        np.multiply(p[m:], self.own, out=p[m:])
        left, *shares = self.size
        for k, share in enumerate(shares):
            np.multiply(p[k * m:(k + 1) * m], left if k else _FREE, out=share)
            np.floor(share, out=share)
            np.subtract(left if k else _FREE, share, out=left)
        np.add(left, 1.0, out=left)
        self.first[1] = left
        np.subtract(_MIX, shares[2], out=self.first[3])
        np.subtract(self.first[3], shares[1], out=self.first[2])

    def update(self, now: np.ndarray) -> None:
        """Learn the ids that came; ``hit`` tells whose predictions they are."""
        m, p, held, hit = self.m, self.p, self.held, self.hit
        held[:] = hit
        np.multiply(held, _LEARN, out=held)
        np.multiply(p, _KEEP, out=p)
        np.add(p, held, out=p)
        self.chance[self.cell] = p
        np.right_shift(self.state, _ONE, out=self.weaker)
        np.less(self.state, _SURE, out=self.apart)
        np.add(self.state, self.apart.view(np.uint8), out=self.stronger)
        np.subtract(self.stronger, self.weaker, out=self.stronger)
        np.multiply(self.stronger, hit.view(np.uint8), out=self.stronger)
        np.add(self.weaker, self.stronger, out=self.stronger)
        self.byte[:] = self.stronger
        np.equal(self.stronger, 0, out=self.apart)          # predictions that are given up
        np.left_shift(now, _BYTE, out=self.fresh)
        np.add(self.fresh, 1, out=self.fresh)
        self.gone[:] = self.apart
        np.subtract(self.fresh, self.slot.reshape(3, m), out=self.change.reshape(3, m))
        np.multiply(self.change, self.gone, out=self.change)
        np.add(self.slot, self.change, out=self.slot)
        self.table[self.at] = self.slot[:2 * m]
        self.last[:] = now


def _in_order(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes from the longest block to the shortest; active lanes per step."""
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    return order, np.searchsorted(-sizes[order], -np.arange(1, longest + 1), side="right")


def _spans(active: np.ndarray) -> list[tuple[int, int, int]]:
    """(from, to, lanes) of the steps with equally many active lanes."""
    cuts = [0, *(np.flatnonzero(np.diff(active)) + 1).tolist(), len(active)]
    return [(a, b, int(active[a])) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def encode_blocks(blocks: list[np.ndarray], header: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """Payload of every block; the header holds all their ids."""
    base, out = _Base(*header), []
    for a in range(0, len(blocks), LANES):
        out += _encode(blocks[a:a + LANES], base)
    return out


def _encode(blocks: list[np.ndarray], base: _Base) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks], np.int64)
    order, active = _in_order(sizes)
    lanes, longest = len(blocks), len(active)
    ids = np.zeros((lanes, longest), np.uint32)
    for lane, b in enumerate(order):
        ids[lane, :sizes[b]] = blocks[b]
    places = np.ascontiguousarray(base.places(ids.T))
    mixture = _Mixture(lanes)
    low, span = np.zeros(lanes), np.full(lanes, _TOP)
    words, whose = [], []           # in the order they are put out, and their lanes
    for a, z, m in _spans(active):
        mixture.keep(m)
        first, size, unit, word = (np.empty(m) for _ in range(4))
        hit, row, taken = np.empty((3, m), bool), np.empty(m, np.uint8), np.empty(m, np.int64)
        more, counts = np.empty(m, bool), np.empty(m, np.uint32)
        named, sp, lo = mixture.place.reshape(3, m), span[:m], low[:m]
        for t in range(a, z):
            now = places[t, :m]
            mixture.predict()
            np.equal(named, now, out=mixture.hit.reshape(3, m))
            np.greater(mixture.size[1:], 0, out=hit)
            np.logical_and(hit, mixture.hit.reshape(3, m), out=hit)
            two, one, top = hit.view(np.uint8)
            np.add(one, top, out=row)
            np.add(row, row, out=row)
            np.add(row, two, out=row)
            np.add(row, top, out=row)
            # the part of the range
            taken[:] = row
            np.multiply(taken, m, out=taken)
            np.add(taken, mixture.lane, out=taken)
            mixture.first.take(taken, out=first, mode="clip")
            mixture.size.take(taken, out=size, mode="clip")
            np.multiply(sp, _SHARE, out=unit)
            np.floor(unit, out=unit)
            np.multiply(first, unit, out=first)
            np.add(lo, first, out=lo)
            np.multiply(size, unit, out=sp)
            # and the id's range in the part of the counts; of other parts, all
            counts[:] = row
            np.multiply(counts, _BEYOND, out=counts)
            np.add(counts, now, out=counts)
            taken[:] = counts
            base.first.take(taken, out=first, mode="clip")
            base.size.take(taken, out=size, mode="clip")
            np.multiply(sp, _COUNT, out=unit)
            np.floor(unit, out=unit)
            np.multiply(first, unit, out=first)
            np.add(lo, first, out=lo)
            np.multiply(size, unit, out=sp)
            # a word is kept where the range is short, with a carry that is resolved below
            np.less(sp, _BOTTOM, out=more)
            np.multiply(lo, _HEAD, out=word)
            np.floor(word, out=word)
            some = np.flatnonzero(more)
            words.append(word.take(some).astype(np.uint32))
            whose.append(some.astype(np.uint16))
            unit[:] = more
            np.multiply(word, unit, out=word)
            np.multiply(word, _BOTTOM, out=word)
            np.subtract(lo, word, out=lo)
            np.multiply(unit, _MORE, out=unit)
            np.add(unit, 1.0, out=unit)
            np.multiply(lo, unit, out=lo)
            np.multiply(sp, unit, out=sp)
            if sp.min() < _BOTTOM:          # a range of a point is given a second word
                some = np.flatnonzero(sp < _BOTTOM)
                short = np.floor(lo[some] * _HEAD)
                words.append(short.astype(np.uint32))
                whose.append(some.astype(np.uint16))
                lo[some] = (lo[some] - short * _BOTTOM) * _WORD
                sp[some] *= _WORD
            mixture.update(now)
    # a last word names a point of the range that is left; what follows it is read as 0
    words.append(np.ceil(low * _HEAD).astype(np.uint32))
    whose = np.concatenate([*whose, np.arange(lanes, dtype=np.uint16)])
    words = np.concatenate(words)[np.argsort(whose, kind="stable")]
    end = np.cumsum(np.bincount(whose, minlength=lanes))
    while len(over := np.flatnonzero(words >> 16)):
        words &= 0xFFFF
        words[over - 1] += 1                # never of a block's first word
    words = words.astype(">u2")
    payloads = [b""] * lanes
    for lane, b in enumerate(order):
        if sizes[b]:
            payloads[b] = words[end[lane - 1] if lane else 0:end[lane]].tobytes()
    return payloads


def decode_blocks(payloads: list[bytes], sizes: list[int], header: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Ids of every block."""
    base, out = _Base(*header), []
    for a in range(0, len(payloads), LANES):
        out += _decode(payloads[a:a + LANES], np.array(sizes[a:a + LANES], np.int64), base)
    return out


def _decode(payloads: list[bytes], sizes: np.ndarray, base: _Base) -> list[np.ndarray]:
    order, active = _in_order(sizes)
    lanes, longest = len(payloads), len(active)
    width = max((len(p) for p in payloads), default=0) // 2 + 8
    words = np.zeros((lanes, width))
    for lane, b in enumerate(order):
        w = np.frombuffer(payloads[b][:len(payloads[b]) // 2 * 2], ">u2")
        words[lane, :len(w)] = w
    mixture, points = _Mixture(lanes), base.points()
    span, code = np.full(lanes, _TOP), (words[:, 0] * _WORD + words[:, 1]) * _WORD + words[:, 2]
    words, used = words.ravel(), np.arange(lanes) * width + 3
    places = np.zeros((longest, lanes), "<u4")
    with np.errstate(over="ignore"):        # of damaged blocks
        for a, z, m in _spans(active):
            mixture.keep(m)
            first, size, unit, word = (np.empty(m) for _ in range(4))
            reach, row, taken = np.empty((3, m), bool), np.empty(m, np.uint8), np.empty(m, np.int64)
            more, found = np.empty(m, bool), np.empty(m, points.dtype)
            named, sp, x, at = mixture.place.reshape(3, m), span[:m], code[:m], used[:m]
            for t in range(a, z):
                now = places[t, :m]
                mixture.predict()
                np.multiply(sp, _SHARE, out=unit)
                np.floor(unit, out=unit)
                np.divide(x, unit, out=word)
                np.minimum(word, _FREE, out=word)
                np.greater_equal(word, mixture.first[1:], out=reach)
                two, one, top = reach.view(np.uint8)
                np.add(two, one, out=row)
                np.add(row, top, out=row)
                taken[:] = row
                np.multiply(taken, m, out=taken)
                np.add(taken, mixture.lane, out=taken)
                mixture.first.take(taken, out=first, mode="clip")
                mixture.size.take(taken, out=size, mode="clip")
                np.multiply(first, unit, out=first)
                np.subtract(x, first, out=x)
                np.multiply(size, unit, out=sp)
                # the point in the part of the counts; beyond them for other parts
                np.multiply(sp, _COUNT, out=unit)
                np.floor(unit, out=unit)
                np.divide(x, unit, out=word)
                np.minimum(word, _LAST, out=word)
                first[:] = two
                np.multiply(first, _TOP, out=first)
                np.maximum(word, first, out=word)
                points.take(word.astype(np.int64), out=found, mode="clip")
                mixture.places[:m] = found
                mixture.places.take(taken, out=now, mode="clip")
                np.equal(named, now, out=mixture.hit.reshape(3, m))
                taken[:] = found
                base.first.take(taken, out=first, mode="clip")
                base.size.take(taken, out=size, mode="clip")
                np.multiply(first, unit, out=first)
                np.subtract(x, first, out=x)
                np.multiply(size, unit, out=sp)
                np.less(sp, _BOTTOM, out=more)
                words.take(at, out=word, mode="clip")
                unit[:] = more
                np.multiply(word, unit, out=word)
                np.multiply(unit, _MORE, out=unit)
                np.add(unit, 1.0, out=unit)
                np.multiply(x, unit, out=x)
                np.add(x, word, out=x)
                np.multiply(sp, unit, out=sp)
                np.add(at, more, out=at)
                while sp.min() < _BOTTOM:
                    some = np.flatnonzero(sp < _BOTTOM)
                    x[some] = x[some] * _WORD + words.take(at[some], mode="clip")
                    sp[some] *= _WORD
                    at[some] += 1
                mixture.update(now)
    ids = base.ids.take(places.T, mode="clip") if longest else places.T
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * lanes
    for lane, b in enumerate(order):
        out[b] = ids[lane, :sizes[b]].copy()
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
