"""Byte-level BPE as a monoid: encode halves, join neighbours.

The encodings of byte strings form a monoid: two neighbours are joined by
re-encoding a window around their border. A token sequence is the encoding of
its bytes exactly when every two neighbours are the encoding of their own bytes,
so the window grows, by doubling, until it meets the untouched tokens on either
side in such pairs; everything outside is then proved to stay. A piece (a match of the
split pattern) is halved down to parts that are tokens, which are joined up again;
pieces themselves never merge, so texts concatenate theirs. Decoding concatenates the
bytes of the ids.

Texts are cut before the first white space after other characters, a border no
piece crosses; the distinct cuts of a slice are found in compiled code and a
worker encodes each only once while it is remembered.

Defined cases: null and empty texts have no ids and decode to nothing; characters
of any length and texts without white space are cut nowhere and encoded by
halves; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.batches import ragged, spread, text_slices
from audix.llm.shared import ship

# Bytes from which merges are taken from a heap; their result is the same.
HEAP_BYTES = 96
CACHE_CUTS = 600_000
CACHE_PAIRS = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class MonoidBpe:
    """Encoder and decoder for a rank table (token bytes to id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs: dict[int, bool] = {}
        size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.lengths = np.fromiter((len(t) for t in tokens), np.int64, size)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.table = np.frombuffer(b"".join(tokens), np.uint8)

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain encoding: the neighbours of lowest rank merge, leftmost first."""
        if len(piece) > HEAP_BYTES:
            return self._merge_long(piece)
        ranks, parts = self.ranks, [piece[i:i + 1] for i in range(len(piece))]
        scores = [ranks.get(piece[i:i + 2]) for i in range(len(piece) - 1)]
        while True:
            best, at = None, -1
            for i, r in enumerate(scores):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at < len(scores):
                scores[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                scores[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merge_long(self, piece: bytes) -> list[bytes]:
        """The same merges from a heap of (rank, place)."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))          # end of the part that starts here
        left = list(range(-1, n - 1))        # start of the part before
        alive = bytearray(b"\1" * n)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i):
            if i >= 0 and end[i] < n:
                j = end[end[i]]
                r = ranks.get(piece[i:j])
                if r is not None:
                    heapq.heappush(heap, (r, i, j))

        while heap:
            _, i, j = heapq.heappop(heap)
            if not alive[i] or end[i] >= j or end[i] >= n or end[end[i]] != j:
                continue
            alive[end[i]] = 0
            end[i] = j
            if j < n:
                left[j] = i
            offer(i)
            offer(left[i])
        out, i = [], 0
        while i < n:
            out.append(piece[i:end[i]])
            i = end[i]
        return out

    def settled(self, a: bytes, b: bytes) -> bool:
        """Whether a, b is the encoding of its bytes."""
        key = self.ranks[a] << 32 | self.ranks[b]
        known = self.pairs.get(key)
        if known is None:
            known = self.merge(a + b) == [a, b]
            if len(self.pairs) < CACHE_PAIRS:
                self.pairs[key] = known
        return known

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Encoding of the bytes of two encodings."""
        if not left or not right:
            return left or right
        if self.settled(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self.merge(b"".join(left[len(left) - a:] + right[:b]))
            firm_left = a == len(left) or self.settled(left[-a - 1], window[0])
            firm_right = b == len(right) or self.settled(window[-1], right[b])
            if firm_left and firm_right:
                return left[:len(left) - a] + window + right[b:]
            if not firm_left:
                a = min(2 * a, len(left))
            if not firm_right:
                b = min(2 * b, len(right))

    def tokens(self, piece: bytes) -> list[bytes]:
        """Encoding of one piece, by halves down to tokens."""
        if piece in self.ranks:
            return [piece]
        half = len(piece) // 2
        return self.join(self.tokens(piece[:half]), self.tokens(piece[half:]))

    leaf = tokens       # the name of an earlier form

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, concatenated."""
        ids = ids.astype(np.int64)
        return self.table[spread(self.starts[ids], self.lengths[ids])]


class TextEncoder:
    """ids of whole texts; every match of the pattern is encoded separately."""

    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = MonoidBpe(ranks)
        self.split = regex.compile(pattern).findall
        self.seen: dict[bytes, bytes] = {}

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Borders no piece crosses: text starts, and ASCII white space after a
        character that is certainly none (one ASCII byte, or two bytes from C3)."""
        if len(data) == 0:
            return np.zeros(0, np.int64)
        space = _SPACE[data]
        solid = (data < 0x80) & ~space
        two = np.zeros(len(data), bool)
        two[1:] = (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
        border = np.zeros(len(data), bool)
        border[1:] = space[1:] & (solid | two)[:-1]
        border[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(border)

    def _ids(self, part: bytes) -> bytes:
        ranks = self.bpe.ranks
        if part in ranks and len(part) > 1 and part[1:].isalpha() and part[:1] == b" ":
            return ranks[part].to_bytes(4, "little")
        out = []
        for piece in self.split(part.decode("utf-8", "replace")):
            piece = piece.encode()
            if piece in ranks:
                out.append(ranks[piece])
            else:
                out += [ranks[t] for t in self.bpe.tokens(piece)]
        return np.array(out, np.uint32).tobytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(uint32 ids back to back, ids per text)."""
        start = self.cut(data, offsets)
        if len(start) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        bound = np.append(start, len(data)).astype(np.int64)
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(bound), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        known, seen = [], self.seen
        for part in coded.dictionary.to_pylist():
            ids = seen.get(part)
            if ids is None:
                ids = self._ids(part)
                if len(seen) < CACHE_CUTS and len(part) <= 64:
                    seen[part] = ids
            known.append(ids)
        table = np.frombuffer(b"".join(known), np.uint32)
        size = np.fromiter((len(k) >> 2 for k in known), np.int64, len(known))
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        index = coded.indices.to_numpy()
        n = size[index]
        ids = table[spread(begin[index], n)]
        total = np.concatenate(([0], np.cumsum(n)))
        at = np.searchsorted(start, offsets)
        return ids, total[at[1:]] - total[at[:-1]]


@lru_cache(maxsize=2)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder per Python worker and vocabulary."""
    return TextEncoder(path, pattern)


def _digests(path: str, pattern: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for s in text_slices(batches):
            ids, sizes = encoder.encode(s.data, s.offsets)
            decoded = encoder.bpe.decode(ids)
            wide = np.concatenate(([0], np.cumsum(encoder.bpe.lengths[ids.astype(np.int64)])))
            bound = np.concatenate(([0], np.cumsum(sizes)))
            one = [hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest() for a, b in zip(bound[:-1], bound[1:])]
            two = [hashlib.sha256(decoded[wide[a]:wide[b]].tobytes()).hexdigest() for a, b in zip(bound[:-1], bound[1:])]
            columns = [s.rows.column(0), pa.array(sizes), pa.array(one, pa.string()), pa.array(two, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [ragged(ids.astype(np.int64), sizes, pa.int64()),
                            pa.array([decoded[wide[a]:wide[b]].tobytes() for a, b in zip(bound[:-1], bound[1:])], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def encode_texts(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded bytes of every
    document; with ``keep_ids`` the ids and bytes themselves."""
    ship(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<long>, decoded binary" if keep_ids else ""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_digests(path, pattern, keep_ids), schema))
