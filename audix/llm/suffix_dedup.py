"""Removal of long byte strings that occur more than once in the corpus.

A byte goes when a WINDOW-byte string that covers it also starts anywhere else.
Every window is assigned to one anchor, the gram of GRAM bytes with the smallest
hash inside it (the leftmost of equal ones); the choice depends on the window's
bytes alone, so equal windows have equal anchors at equal places. Windows next
to each other share an anchor; together they form a fragment.

1. Fragments are listed per document (anchor hash, content hash, place).
2. Anchors that occur once leave: nothing in their windows repeats.
3. Fragments with equal content collapse to one representative and are marked.
4. Anchors with several contents go to index shards by anchor hash: each shard
   joins overlapping fragments of a document, builds a run-length index of them,
   streams its matching statistics, and marks windows whose match is at least
   WINDOW long. Shards have a bounded size; an anchor with more than HOT_CONTENTS
   contents is split by whole window, counted with partial aggregation.
5. Marked windows return to their documents, whose covered bytes are cut.

Matches never cross documents; hashes only choose and group (equal content is
taken from a 64-bit content hash within a 64-bit anchor hash). Defined cases:
null text is empty; rows with one doc_id are separate documents; documents below
WINDOW bytes keep everything; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.batches import flat, forget, mix64, spread, text_slices
from audix.llm.rolling import RollingHash
from audix.llm.run_index import RunIndex
from audix.llm.shared import discard, join_by_key, packed, stored

WINDOW, GRAM = 200, 64
SHARD_BYTES = 2 << 20
HOT_CONTENTS = 4096
CHUNK = 1 << 20              # window starts handled at once
LISTED_BYTES = 1 << 18       # texts whose fragments are listed at once, at least one


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by block prefix and suffix minima."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def fragments(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM,
              chunk: int = CHUNK) -> tuple[np.ndarray, ...]:
    """(text number, anchor hash, content hash, first window start, number of
    starts) of the fragments of the texts of a slice."""
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    sizes = np.diff(offsets)
    doc_of = np.repeat(np.arange(len(sizes)), sizes)
    for a in range(0, max(len(data) - window + 1, 0), chunk):
        part = data[a:a + chunk + window - 1]
        starts = len(part) - window + 1
        roll = RollingHash(part)
        grams = roll.all(gram)
        low = np.uint64((1 << 24) - 1)
        key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        chosen = (_sliding_min(key, window - gram + 1) & low).astype(np.int64)
        doc = doc_of[a:a + starts]
        valid = np.flatnonzero(offsets[doc + 1] - np.arange(a, a + starts) >= window)
        if len(valid) == 0:
            continue
        anchor = chosen[valid]
        head = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)))
        tail = np.append(head[1:], len(valid)) - 1
        lo, hi, at = valid[head], valid[tail], anchor[head]
        content = mix64(roll.of(lo, hi + window) ^ mix64(((at - lo) * 4096 + (hi - lo)).astype(np.uint64)))
        owner = doc[lo]
        for out, x in zip(found, (owner, grams[at], content, lo + a - offsets[owner], hi - lo + 1)):
            out.append(x)
    kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int64)
    return tuple(np.concatenate(f) if f else np.zeros(0, k) for f, k in zip(found, kinds))


def _list_fragments(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for s in text_slices(batches, max_bytes=LISTED_BYTES):
            owner, anchor, content, lo, n = fragments(s.data, s.offsets, window, gram)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0).take(at), s.rows.column(1).take(at), pa.array(anchor.view(np.int64)),
                 pa.array(content.view(np.int64)), pa.array(lo), pa.array(n.astype(np.int32))],
                ["did", "th", "anchor", "content", "lo", "n_starts"])
    return run


def _cut_fragments(window: int):
    """Bytes of the listed fragments of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            listed = s.rows.column(s.rows.schema.get_field_index("listed"))
            per_row = np.diff(listed.offsets.to_numpy())
            items = listed.flatten()
            lo = items.field("lo").to_numpy()
            size = items.field("n_starts").to_numpy().astype(np.int64) + window - 1
            owner = np.repeat(np.arange(len(s)), per_row)
            packed = s.data[spread(s.offsets[owner] + lo, size)]
            bound = np.zeros(len(size) + 1, np.int32)
            np.cumsum(size, out=bound[1:])
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0).take(at), s.rows.column(1).take(at), items.field("anchor"), items.field("lo"),
                 items.field("n_starts"), items.field("alone"),
                 pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bound), pa.py_buffer(packed)])],
                ["did", "th", "anchor", "lo", "n_starts", "alone", "bytes"])
    return run


MARKS = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def mark_shard(rows: pa.Table, window: int = WINDOW) -> pa.Table:
    """Windows of a shard's fragments that match at least ``window`` bytes
    elsewhere in the shard: (did, th, lo, hi) runs of marked starts."""
    did, th, lo = (rows.column(c).to_numpy() for c in ("did", "th", "lo"))
    order = np.lexsort((lo, th, did))
    did, th, lo = did[order], th[order], lo[order]
    texts, region, within, last, end = [], [], [], None, 0
    for d, t, at, data in zip(did.tolist(), th.tolist(), lo.tolist(), rows.column("bytes").take(order).to_pylist()):
        if (d, t) == last and at <= end:
            texts[-1].append(data[end - at:])
        else:
            texts.append([data])
            first, last = at, (d, t)
            end = at
        region.append(len(texts) - 1)
        within.append(at - first)
        end = max(end, at + len(data))
    index = RunIndex([b"".join(t) for t in texts])
    del texts
    hit = index.matching_statistics() >= window
    alone = rows.column("alone").to_numpy()[order]
    begin = (index.starts[np.array(region, np.int64)] + np.array(within, np.int64))[alone]
    del index
    did, th, lo, n = did[alone], th[alone], lo[alone], rows.column("n_starts").to_numpy()[order][alone].astype(np.int64)
    flags = hit[spread(begin, n)]
    owner, place = np.repeat(np.arange(len(n)), n), spread(np.zeros(len(n), np.int64), n)
    on = np.flatnonzero(flags)
    new = np.ones(len(on), bool)
    new[1:] = (on[1:] != on[:-1] + 1) | (owner[on[1:]] != owner[on[:-1]])
    ends = np.ones(len(on), bool)
    ends[:-1] = new[1:]
    head, tail = on[new], on[ends]
    who = owner[head]
    return pa.Table.from_arrays([pa.array(x) for x in (did[who], th[who], lo[who] + place[head], lo[who] + place[tail])],
                                schema=MARKS)


def _windows(window: int):
    """Content hash of every single window of the fragments of hot anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(batch.schema.get_field_index("bytes")))
            n = np.maximum(np.diff(offsets) - window + 1, 0)
            at, owner = spread(offsets[:-1], n), pa.array(np.repeat(np.arange(len(n)), n))
            hashes = RollingHash(data).of(at, at + window)
            lo = np.repeat(batch.column(batch.schema.get_field_index("lo")).to_numpy(), n)
            names = ["did", "th", "anchor", "alone"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).take(owner) for c in names]
                + [pa.array(lo + spread(np.zeros(len(n), np.int64), n)), pa.array(hashes.view(np.int64))],
                names + ["lo", "content"])
    return run


def _cut(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches):
            spans = s.rows.column(s.rows.schema.get_field_index("spans")).to_pylist()
            removed, n_spans, digests, texts = [], [], [], []
            for i, marked in enumerate(spans):
                text, kept, at, cuts = s.text(i), [], 0, 0
                end = -1
                for m in sorted((m["lo"], m["hi"]) for m in marked or ()):
                    if m[0] > end:
                        cuts += 1
                        if end >= 0:
                            at = end
                        kept.append(text[at:m[0]])
                    end = max(end, m[1] + window)
                kept.append(text[max(end, 0):])
                rest = b"".join(kept)
                removed.append(len(text) - len(rest))
                n_spans.append(cuts)
                digests.append(hashlib.sha256(rest).hexdigest())
                if keep_text:
                    texts.append(rest.decode("utf-8", "ignore"))
            keep = ["row"]
            columns = [s.rows.column(0), pa.array(np.diff(s.offsets)), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                       pa.array(digests, pa.string())]
            keep += ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(texts, pa.string()))
                keep.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, keep)
    return run


def marked_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(did, th, lo, hi): runs of window starts whose window occurs elsewhere."""
    listed = stored(docs.select("did", "th", "text")
                    .mapInArrow(_list_fragments(window, gram),
                                "did long, th long, anchor long, content long, lo long, n_starts int"), "fragments")
    total = listed.count()
    often = stored(listed.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > 1), "anchors")
    again = stored(join_by_key(listed, often, ["anchor"], "n", total).drop("n"), "again")

    discard(listed, often)

    # fragments of equal content: all marked, one stands for them
    groups = stored(again.groupBy("anchor", "content")
                    .agg(F.count("*").alias("n"), F.min(F.struct("did", "th", "lo", "n_starts")).alias("rep")), "groups")
    twins = groups.where(F.col("n") > 1).select("anchor", "content", "n")
    same = join_by_key(again, twins, ["anchor", "content"], "n", total) \
        .select("did", "th", "lo", (F.col("lo") + F.col("n_starts") - 1).alias("hi"))

    # anchors with several contents: bytes of one fragment of each
    several = groups.groupBy("anchor").agg(F.count("*").alias("contents")).where(F.col("contents") > 1)
    reps = stored(join_by_key(groups, several, ["anchor"], "contents", total)
                  .select("anchor", "contents", (F.col("n") == 1).alias("alone"), "rep.*"), "reps")
    per_doc = reps.groupBy("did", "th").agg(F.collect_list(F.struct("anchor", "lo", "n_starts", "alone")).alias("listed"))
    cut = stored(docs.select("did", "th", "text").join(per_doc, ["did", "th"])
                 .mapInArrow(_cut_fragments(window), "did long, th long, anchor long, lo long, n_starts int, "
                                                     "alone boolean, bytes binary"), "bytes")
    size = reps.agg(F.sum(F.col("n_starts") + window)).first()[0] or 0
    hot = reps.where(F.col("contents") > HOT_CONTENTS).select("anchor").distinct()
    shards = max(1, -(-size // SHARD_BYTES))
    indexed = (cut.join(hot, "anchor", "left_anti")
               .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
               .groupBy("shard").applyInArrow(lambda rows: mark_shard(rows, window), "did long, th long, lo long, hi long"))
    out = same.unionByName(indexed)

    if not hot.isEmpty():
        single = stored(cut.join(hot, "anchor", "left_semi")
                        .mapInArrow(_windows(window), "did long, th long, anchor long, alone boolean, lo long, content long"),
                        "windows")
        twice = stored(single.groupBy("anchor", "content").agg(F.count("*").alias("n")).where(F.col("n") > 1), "twice")
        out = out.unionByName(join_by_key(single.where("alone"), twice, ["anchor", "content"], "n", single.count())
                              .select("did", "th", "lo", F.col("lo").alias("hi")))
    return out


RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """Every row of docs(doc_id, text, ...) with its other columns and n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 (and kept_text: the
    remaining bytes, partial characters at the cuts left out)."""
    base = (packed(docs, RESULTS)
            .withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("did", F.coalesce(F.col("doc_id"), F.lit(-2**63)))
            .withColumn("th", F.xxhash64("text")))
    marks = marked_windows(base, window, gram)
    spans = stored(marks.groupBy("did", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    joined = base.join(spans, ["did", "th"], "left").select("row", "text", "spans")
    schema = f"row {base.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, " \
             "kept_sha256 string" + (", kept_text string" if keep_text else "")
    return joined.mapInArrow(_cut(window, keep_text), schema) \
        .select("row.*", *[c for c in RESULTS if keep_text or c != "kept_text"])
