"""Token ids in files: documents in ascending doc_id, context-mixed blocks.

Documents are range-partitioned by doc_id and sorted, one file per range. A file
is Parquet, written and committed by Spark, so it works on any store the cluster
reads; each row is a group of whole documents: their doc_ids and sizes, a header
with the counts of its token ids, and the blocks of these ids. A block is
BLOCK_IDS ids coded by ``mixing_coder`` from a fresh state, with its number of
ids, the CRC-32 of the ids and its payload; it can be decoded without any other.
Reading decodes the blocks of a group in step, checks every CRC and fails on a
damaged block.

A document's start in the whole collection comes from the group sizes alone
(column-pruned): a running sum over groups inside a file and over files.

Defined cases: null and empty texts hold the end id only; rows that repeat a
doc_id are separate, next to each other; a null doc_id comes first; an empty
table makes no groups; a document longer than a group is a group of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import text_slices
from audix.llm.mixing_coder import BLOCK_IDS, LANES, checksum, decode_blocks, encode_blocks, scaled_counts
from audix.llm.shared import ship, stored, text_bytes
from audix.llm.token_ids import with_end, word_encoder

END_ID = 2
FILE_BYTES = 32 << 20           # of text
SLICE_BYTES = 4 << 20           # encoded at once
GROUP_IDS = BLOCK_IDS * LANES

GROUP = ("file int, part int, n_ids long, doc_ids array<long>, sizes array<long>, ids array<int>, counts array<int>, "
         "blocks array<struct<n:int,crc:long,payload:binary>>")
_BLOCK = pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("payload", pa.binary())])


def _group(file: int, part: int, docs: list, sizes: list[int], ids: np.ndarray) -> pa.RecordBatch:
    blocks = [ids[a:a + BLOCK_IDS] for a in range(0, len(ids), BLOCK_IDS)]
    header = scaled_counts(ids)
    coded = [{"n": len(b), "crc": checksum(b), "payload": p} for b, p in zip(blocks, encode_blocks(blocks, header))]
    return pa.RecordBatch.from_arrays(
        [pa.array([file], pa.int32()), pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()),
         pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
         *[pa.array([h.astype(np.int32)], pa.list_(pa.int32())) for h in header], pa.array([coded], pa.list_(_BLOCK))],
        ["file", "part", "n_ids", "doc_ids", "sizes", "ids", "counts", "blocks"])


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        file, part, encoder = TaskContext.get().partitionId(), 0, word_encoder(path)
        docs, sizes, held, n = [], [], [], 0
        for s in text_slices(batches, max_bytes=SLICE_BYTES):
            ids, counts = with_end(*encoder.encode(s.data, s.offsets), END_ID)
            bound = np.concatenate(([0], np.cumsum(counts)))
            done = 0
            for i, doc in enumerate(s.rows.column(0).to_pylist()):
                if n and n + int(bound[i + 1] - bound[done]) > GROUP_IDS:
                    held.append(ids[bound[done]:bound[i]])
                    yield _group(file, part, docs, sizes, np.concatenate(held))
                    docs, sizes, held, n, done, part = [], [], [], 0, i, part + 1
                docs.append(doc)
                sizes.append(int(counts[i]))
                if not n:
                    n = 1       # a group is never empty: a first document always fits
            held.append(ids[bound[done]:])
            n = max(1, sum(len(h) for h in held))
        if docs:
            yield _group(file, part, docs, sizes, np.concatenate(held))
    return run


def write_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents' ids (each with the end id) and return the files."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(text_bytes())).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    ordered = rows.repartitionByRange(int(files), "doc_id").sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(_write(tokenizer), GROUP), "ids")


def decode_group(row: dict) -> list[np.ndarray]:
    """Ids of each document of a group; raises on a wrong checksum."""
    header = np.array(row["ids"], np.uint32), np.array(row["counts"], np.int64)
    found = decode_blocks([b["payload"] for b in row["blocks"]], [b["n"] for b in row["blocks"]], header)
    for k, (block, b) in enumerate(zip(row["blocks"], found)):
        if checksum(b) != block["crc"]:
            raise ValueError(f"block {k} of group {row['part']} in file {row['file']} is damaged")
    ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
    return np.split(ids, np.cumsum(row["sizes"])[:-1])


def _read(keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = decode_group(row)
                sizes = np.array(row["sizes"], np.int64)
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["base"] + np.cumsum(sizes) - sizes),
                           pa.array(sizes), pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def read_ids(files: DataFrame, keep_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (and ids) of every document, from the files."""
    sizes = files.select("file", "part", "n_ids")
    per_file = sizes.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    first = per_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (sizes.join(first, "file")
            .select("file", "part", (F.col("first") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("base")))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    return files.join(base, ["file", "part"]).mapInArrow(_read(keep_ids), schema)
