"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths are partitioned into reciprocal-capacity classes: class j holds pieces
of capacity // j tokens, and its bins take exactly j of them. A document is cut
greedily into such pieces, the largest class first (whole sequences are class
1), and what is left below the smallest class is its tail; tails are laid end to
end and cut at sequence borders. Bins are filled independently in every task
(documents are dealt by a hash of their id, and a task numbers its own bins).
The pieces of unfinished bins, fewer than j per class and task, are merged class
by class, and what that leaves, fewer than j per class, in one last step whose
last sequence has the length of a power of two where it can, so that it needs
no padding.

Padding: full bins of class j miss capacity % j tokens (15 of 4096 at most for
the 16 classes), sequences of the last step none but the very last cut.

Defined cases: null and empty texts are one end id; repeated documents are
packed each (rows with the same doc_id and text are alike); an empty table packs
nothing; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.batches import text_slices
from audix.llm.shared import ship, stored
from audix.llm.token_ids import with_end, word_encoder

CAPACITY = 4096
CLASSES = 16
END_ID = 2

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut(length: int, capacity: int = CAPACITY, classes: int = CLASSES) -> list[tuple[int, int]]:
    """(class, size) of the pieces of a document; class 0 is the tail."""
    pieces = [(1, capacity)] * (length // capacity)
    left = length % capacity
    for j in range(2, classes + 1):
        size = capacity // j
        while left >= size:
            pieces.append((j, size))
            left -= size
    if left:
        pieces.append((0, left))
    return pieces


class _Bins:
    """Open bins of one task; finished pieces leave with a sequence number."""

    def __init__(self, first: int, capacity: int, classes: int, keep_ids: bool):
        self.next, self.capacity, self.classes, self.keep = first, capacity, classes, keep_ids
        self.open: dict[int, list[tuple]] = {j: [] for j in range(classes + 1)}
        self.tail = 0
        self.done: list[tuple] = []

    def close(self, j: int) -> None:
        offset = 0
        for doc, start, tokens, ids in self.open[j]:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.next, offset,
                              ids if self.keep else None))
            offset += len(ids)
        self.open[j] = []
        self.next += 1

    def add(self, j: int, piece: tuple) -> None:
        if j:
            self.open[j].append(piece)
            if len(self.open[j]) == j:
                self.close(j)
            return
        doc, start, tokens, ids = piece
        while len(ids):
            part = ids[:self.capacity - self.tail]
            self.open[0].append((doc, start, tokens, part))
            self.tail += len(part)
            start, ids = start + len(part), ids[len(part):]
            if self.tail == self.capacity:
                self.close(0)
                self.tail = 0

    def finish(self) -> None:
        """Close everything: unfinished classes join the tails, and the last
        sequence is cut into lengths that are powers of two."""
        for j in range(1, self.classes + 1):
            rest, self.open[j] = self.open[j], []
            for piece in rest:
                self.add(0, piece)
        rest, left = self.open[0], self.tail
        self.open[0], self.tail = [], 0
        whole = self.capacity
        while left:
            size = 1 << (left.bit_length() - 1)
            self.capacity = size
            while self.tail < size and rest:
                doc, start, tokens, ids = rest.pop(0)
                part, ids_left = ids[:size - self.tail], ids[size - self.tail:]
                self.open[0].append((doc, start, tokens, part))
                self.tail += len(part)
                if len(ids_left):
                    rest.insert(0, (doc, start + len(part), tokens, ids_left))
            self.close(0)
            left, self.tail = left - size, 0
        self.capacity = whole

    def flush(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        return _batch([r[:7] for r in rows], [r[7] for r in rows], None)

    def unfinished(self) -> pa.RecordBatch:
        rows, ids, kind = [], [], []
        for j, pieces in self.open.items():
            for doc, start, tokens, part in pieces:
                rows.append((doc, start, len(part), None, tokens, None, None))
                ids.append(part)
                kind.append(j)
        return _batch(rows, ids, kind)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_STORED = PIECES + ", ids array<long>, class int, task long"


def _batch(rows: list[tuple], ids: list, kind: list | None) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(_NAMES)
    task = _task()
    return pa.RecordBatch.from_arrays(
        columns + [pa.array([None if i is None else i.astype(np.int64) for i in ids], pa.list_(pa.int64())),
                   pa.array(kind or [None] * len(rows), pa.int32()), pa.array([task] * len(rows), pa.int64())],
        _NAMES + ["ids", "class", "task"])


def _task() -> int:
    from pyspark import TaskContext
    return TaskContext.get().partitionId()


def _from_texts(path: str, capacity: int, classes: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        bins = _Bins(_task() << 32, capacity, classes, keep_ids)
        for s in text_slices(batches):
            ids, sizes = with_end(*encoder.encode(s.data, s.offsets), END_ID)
            bound = np.concatenate(([0], np.cumsum(sizes)))
            for i, doc in enumerate(s.rows.column(0).to_pylist()):
                at = 0
                for j, size in cut(int(sizes[i]), capacity, classes):
                    bins.add(j, (doc, at, int(sizes[i]), ids[bound[i] + at:bound[i] + at + size]))
                    at += size
            yield bins.flush()
        yield bins.unfinished()
    return run


def _from_pieces(level: int, capacity: int, classes: int, keep_ids: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins((level << 56) + (_task() << 32), capacity, classes, keep_ids)
        for batch in batches:
            for r in batch.to_pylist():
                bins.add(r["class"], (r["doc_id"], r["start"], r["doc_tokens"], np.array(r["ids"], np.uint32)))
        if last:
            bins.finish()
        yield bins.flush()
        yield bins.unfinished()
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, classes: int = CLASSES,
         keep_ids: bool = False, fan_in: int = 64) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32, doc_tokens, sequence_id, offset, and ids if ``keep_ids``."""
    ship(docs.sparkSession)
    first = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .mapInArrow(_from_texts(tokenizer, capacity, classes, keep_ids), _STORED), "packed")
    levels, open_ = [first.where("sequence_id is not null")], first.where("sequence_id is null")
    tasks, level = (open_.agg(F.max("task")).first()[0] or 0) + 1, 1
    while True:
        groups = -(-tasks // fan_in)
        merged = stored(open_.withColumn("group", F.expr(f"task div {fan_in}")).repartition(groups, "group")
                        .sortWithinPartitions("class", "task", "doc_id", "start").drop("group")
                        .mapInArrow(_from_pieces(level, capacity, classes, keep_ids, groups == 1), _STORED), "merged")
        levels.append(merged.where("sequence_id is not null"))
        if groups == 1:
            break
        open_, tasks, level = merged.where("sequence_id is null"), groups, level + 1
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.select(*_NAMES, *(["ids"] if keep_ids else []))
