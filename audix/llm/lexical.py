"""Ranked lexical search: MaxScore over blocks of documents, bounded by pairs of terms.

A term of an item adds weight times saturated frequency to a document's score, all in
integers. An index is made for a set of items: documents are cut into blocks, and a
block holds, for every term of the items, the documents with it and their impacts, and,
for every two terms that are neighbours when an item's terms are ranked by weight, their
largest joint impact and the list of documents with both, ranked by joint impact. (Where
the joint maximum is nearly the sum of both single ones, LIST_SHARE, the list is left
out; it could hardly tighten anything. The maximum always stays.)

A search takes the terms of an item in the order of their weights. Two neighbours add at
most the largest of their joint impact and their single ones, so what the terms from
position i on can add is the least sum over all ways to cover them by single terms and
neighbouring pairs, found right to left. The k-th joint impact of a pair's list is a
first threshold. Lists are added for all documents until the bound left can lift no new
document over the threshold; the rest is looked up for candidates alone, dropping those
that the bound left cannot lift. A block whose bounds together stay below
the threshold of the blocks before it in the task is not visited at all. Every task
returns at most k documents an item, so the last step meets no large group.

Items are the stated queries: they are read in blocks of bounded size, and every block of
them meets every block of documents once.

Defined cases: null and empty texts have no terms and are never found; null ids count as
documents and come last among equal scores; rows that repeat an id are documents of their
own; rows of an item that are equal count once, items of one id and different texts are
ranked apart; terms in every document may weigh nothing; no documents or items: no rows.
Columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import text_slices
from audix.llm.shared import ship, stored

ITEM_BYTES = 8 << 20        # text of the items that are searched together
BLOCK_POSTINGS = 1 << 18    # postings of a block, which is one row of the index
LIST_SHARE = 0.9            # of two terms' single maxima, above which no list is kept
SCALE, LENGTH_PERCENT, SATURATION = 1000, 25, 12

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

DOC_TERMS = "doc_id long, n long, terms binary, counts binary"
INDEX = ("docs binary, known binary, terms binary, starts binary, posted binary, impacts binary, "
         "first binary, second binary, peaks binary, pair_starts binary, together binary, joint binary")
FOUND = "item int, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes, ASCII letters lower-cased."""
    return text.translate(_FOLD).split()


@dataclass
class Items:
    """A block of items as flat arrays over their own vocabulary."""
    names: list[int | None]               # item_id
    vocabulary: dict[bytes, int]
    queries: list[tuple[np.ndarray, np.ndarray]]     # (terms, times they occur) of each item

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> "Items":
        vocabulary: dict[bytes, int] = {}
        queries = []
        for _, text in rows:
            found = Counter(terms(text.encode()))
            ids = [vocabulary.setdefault(t, len(vocabulary)) for t in found]
            queries.append((np.array(ids, np.int64), np.array(list(found.values()), np.int64)))
        return cls([name for name, _ in rows], vocabulary, queries)

    def weighted(self, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each item's terms that weigh something, heaviest first."""
        out = []
        for ids, times in self.queries:
            order = np.lexsort((ids, -weights[ids] * times))
            order = order[weights[ids[order]] > 0]
            out.append((ids[order], times[order]))
        return out


def item_blocks(items: DataFrame, size: int) -> Iterator[Items]:
    """Distinct (item_id, text) rows, streamed to the driver in blocks of ``size`` bytes."""
    rows, held = [], 0
    for r in items.where("text is not null").select("item_id", "text").distinct().toLocalIterator():
        rows.append((r.item_id, r.text))
        held += len(r.text)
        if held >= size:
            yield Items.of(rows)
            rows, held = [], 0
    if rows:
        yield Items.of(rows)


def count_terms(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Length of every document in terms, and how often it holds those of the vocabulary."""
    size, get = max(len(vocabulary), 1), vocabulary.get
    for part in text_slices(batches):
        lengths, codes = np.zeros(len(part), np.int64), []
        for i in range(len(part)):
            found = terms(part.text(i))
            lengths[i] = len(found)
            ids = np.array([get(t, -1) for t in found], np.int64)
            codes.append(ids[ids >= 0] + i * size)
        code, counts = np.unique(np.concatenate(codes), return_counts=True)
        cut = np.searchsorted(code, np.arange(len(part) + 1) * size)
        ids, counts = (code % size).astype(np.int32), counts.astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [part.rows.column(part.rows.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array(lengths),
             pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
             pa.array([counts[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
            ["doc_id", "n", "terms", "counts"])


def document_frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Documents of the task with each term."""
    held = np.zeros(size, np.int64)
    for batch in batches:
        for row in batch.column(0):
            held += np.bincount(np.frombuffer(row.as_buffer(), np.int32), minlength=size)
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["term", "df"])


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(SCALE * math.log((2 * documents + 2) / (2 * d + 1))) if d else 0
                     for d in df.tolist()], np.int64)


def impacts(counts: np.ndarray, lengths: np.ndarray, weights: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What terms add to the scores of documents, one value a posting."""
    scaled = [LENGTH_PERCENT * n * documents // total for n in lengths.tolist()]
    m = 100 - LENGTH_PERCENT + np.array(scaled, np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + SATURATION * m))


@dataclass
class Block:
    """Documents, postings sorted by term, and pairs of terms with the documents of both."""
    docs: np.ndarray          # doc_id
    known: np.ndarray         # whether it is not null
    terms: np.ndarray         # the terms that occur, ascending
    starts: np.ndarray        # of their postings
    posted: np.ndarray        # document numbers in the block
    impacts: np.ndarray
    first: np.ndarray         # the pairs that meet
    second: np.ndarray
    peaks: np.ndarray         # their largest joint impacts
    pair_starts: np.ndarray   # of their lists
    together: np.ndarray      # document numbers, the largest joint impact first
    joint: np.ndarray         # joint impacts of the lists

    KINDS = {"docs": np.int64, "known": np.bool_, "terms": np.int32, "starts": np.int64, "posted": np.int32,
             "impacts": np.int64, "first": np.int32, "second": np.int32, "peaks": np.int64,
             "pair_starts": np.int64, "together": np.int32, "joint": np.int64}

    def __post_init__(self):
        self.lists = {t: (self.posted[a:b], self.impacts[a:b]) for t, a, b in
                      zip(self.terms.tolist(), self.starts[:-1].tolist(), self.starts[1:].tolist())}
        self.most = {t: int(add.max()) for t, (_, add) in self.lists.items()}
        self.pairs = {pair: (peak, self.together[a:b], self.joint[a:b]) for *pair_, peak, a, b in
                      zip(self.first.tolist(), self.second.tolist(), self.peaks.tolist(),
                          self.pair_starts[:-1].tolist(), self.pair_starts[1:].tolist()) for pair in [tuple(pair_)]}

    @classmethod
    def build(cls, docs, known, row, term, impact, pairs: np.ndarray) -> "Block":
        order = np.lexsort((row, term))
        row, term, impact = row[order].astype(np.int32), term[order], impact[order]
        present, starts = np.unique(term, return_index=True)
        starts = np.append(starts, len(term)).astype(np.int64)
        none = np.zeros(0, np.int64)
        block = cls(docs, known, present.astype(np.int32), starts, row, impact,
                    none, none, none, np.zeros(1, np.int64), none, none)
        found = []
        for a, b in pairs.tolist():
            if a not in block.lists or b not in block.lists:
                continue
            short, long = sorted((block.lists[a], block.lists[b]), key=lambda x: len(x[0]))
            at = np.minimum(np.searchsorted(long[0], short[0]), len(long[0]) - 1)
            hit = long[0][at] == short[0]
            if hit.any():
                joint = short[1][hit] + long[1][at[hit]]
                peak = int(joint.max())
                order = np.argsort(-joint, kind="stable") if peak < LIST_SHARE * (block.most[a] + block.most[b]) else none
                found.append((a, b, peak, short[0][hit][order], joint[order]))
        if found:
            first, second, peaks, together, joint = zip(*found)
            block = cls(docs, known, block.terms, starts, row, impact, np.array(first), np.array(second),
                        np.array(peaks), np.cumsum([0] + [len(x) for x in together]),
                        np.concatenate(together), np.concatenate(joint))
        return block

    def packed(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([np.ascontiguousarray(getattr(self, n), k).tobytes()], pa.binary())
             for n, k in self.KINDS.items()], list(self.KINDS))

    @classmethod
    def unpacked(cls, batch: pa.RecordBatch, i: int) -> "Block":
        return cls(*[np.frombuffer(batch.column(batch.schema.get_field_index(n))[i].as_buffer(), k)
                     for n, k in cls.KINDS.items()])


def item_pairs(queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The pairs of terms that the items list: neighbours by weight, smaller id first."""
    found = {(min(a, b), max(a, b)) for ids, _ in queries for a, b in zip(ids[:-1].tolist(), ids[1:].tolist())}
    return np.array(sorted(found), np.int64).reshape(-1, 2)


def build_blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray, pairs: np.ndarray, documents: int,
                 total: int, size: int = BLOCK_POSTINGS) -> Iterator[pa.RecordBatch]:
    """The index of a task's documents, cut into blocks of about ``size`` postings."""
    held, n = [], 0

    def flush() -> pa.RecordBatch:
        ids = [d for d, *_ in held]
        known = np.array([d is not None for d in ids], bool)
        sizes = [len(t) for _, _, t, _ in held]
        row = np.repeat(np.arange(len(held)), sizes)
        term = np.concatenate([t for _, _, t, _ in held])
        counts = np.concatenate([c for *_, c in held]).astype(np.int64)
        lengths = np.repeat(np.array([n for _, n, _, _ in held], np.int64), sizes)
        return Block.build(np.array([d or 0 for d in ids], np.int64), known, row, term,
                           impacts(counts, lengths, weights[term], documents, total), pairs).packed()
    for batch in batches:
        names = batch.schema.get_field_index
        for doc, length, t, c in zip(batch.column(names("doc_id")).to_pylist(), batch.column(names("n")).to_pylist(),
                                     batch.column(names("terms")), batch.column(names("counts"))):
            t, c = np.frombuffer(t.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.int32)
            used = weights[t] > 0
            if used.any():
                held.append((doc, length, t[used], c[used]))
                n += int(used.sum())
            if n >= size:
                yield flush()
                held, n = [], 0
    if held:
        yield flush()


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Search:
    """Top k of one item over block after block; ``visited`` counts the postings read."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, k: int, paired: bool = True):
        self.query = list(zip(ids.tolist(), times.tolist()))
        self.k, self.paired, self.visited, self.threshold = k, paired, 0, 0
        self.best: tuple[np.ndarray, np.ndarray, np.ndarray] = (
            np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    def _bounds(self, block: Block, query: list[tuple[int, int]]) -> tuple[list[int], int]:
        """What the terms from each position on can add at most, and a score that k
        documents of the block reach."""
        single = [block.most[t] * q for t, q in query]
        left, low = [0] * (len(query) + 2), 0
        for i in range(len(query) - 1, -1, -1):
            left[i] = single[i] + left[i + 1]
            if self.paired and i + 1 < len(query):
                (a, p), (b, q) = query[i], query[i + 1]
                bound = max(single[i], single[i + 1])
                if (pair := block.pairs.get((a, b) if a < b else (b, a))) is not None:
                    peak, _, joint = pair
                    # Repeats of a term in the item count beside the joint impact.
                    bound = max(bound, peak + (p - 1) * block.most[a] + (q - 1) * block.most[b])
                    if len(joint) >= self.k:
                        low = max(low, int(joint[self.k - 1]))
                left[i] = min(left[i], bound + left[i + 2])
        return left, low

    def visit(self, block: Block) -> None:
        query = [(t, q) for t, q in self.query if t in block.lists]
        left, low = self._bounds(block, query)
        low = max(low, self.threshold)
        if not query or left[0] < low:
            return
        scores, i = np.zeros(len(block.docs), np.int64), 0
        while i < len(query) and left[i] >= max(low, 1):
            docs, add = block.lists[query[i][0]]
            scores[docs] += add * query[i][1]
            self.visited += len(docs)
            i += 1
            low = max(low, _kth(scores, self.k))
        found = np.flatnonzero(scores)
        scores = scores[found]
        for j in range(i, len(query) + 1):
            keep = scores + left[j] >= low
            found, scores = found[keep], scores[keep]
            if j < len(query):
                docs, add = block.lists[query[j][0]]
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[at] == found, add[at] * query[j][1], 0)
                self.visited += len(found)
                low = max(low, _kth(scores, self.k))
        docs, known, held = self.best
        self._keep(np.append(docs, block.docs[found]), np.append(known, block.known[found]), np.append(held, scores))

    def _keep(self, docs: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        order = np.lexsort((docs, ~known, -scores))[:self.k]
        self.best = (docs[order], known[order], scores[order])
        if len(order) == self.k:
            self.threshold = int(self.best[2][-1])


def search_blocks(batches: Iterator[pa.RecordBatch], queries: list[tuple[np.ndarray, np.ndarray]],
                  k: int) -> Iterator[pa.RecordBatch]:
    """The k best documents of the task's blocks for every item."""
    searches = [Search(ids, times, k) for ids, times in queries]
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block.unpacked(batch, i)
            for s in searches:
                s.visit(block)
    for item, s in enumerate(searches):
        docs, known, scores = s.best
        if len(docs):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), item, np.int32)), pa.array(docs, mask=~known), pa.array(scores)],
                ["item", "doc_id", "score"])


@dataclass
class Index:
    """A stored index for one block of items."""
    items: Items
    blocks: DataFrame
    weights: np.ndarray
    documents: int
    total: int


def build_index(docs: DataFrame, items: Items) -> Index:
    """Index of (doc_id, text) for the terms of ``items``; statistics are of all documents."""
    vocabulary, size = items.vocabulary, len(items.vocabulary)
    counted = stored(docs.select("doc_id", "text").mapInArrow(lambda b: count_terms(b, vocabulary), DOC_TERMS),
                     "lexical-terms")
    stats = counted.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    df = np.zeros(size, np.int64)
    for r in (counted.select("terms").mapInArrow(lambda b: document_frequencies(b, size), "term int, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):        # at most one row a term of the items
        df[r.term] = r.df
    documents, total = stats.documents, stats.total
    weights = term_weights(df, documents)
    pairs = item_pairs(items.weighted(weights))
    blocks = stored(counted.mapInArrow(lambda b: build_blocks(b, weights, pairs, documents, total), INDEX),
                    "lexical-index")
    return Index(items, blocks, weights, documents, total)


def search(index: Index, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of every item of the index."""
    queries = index.items.weighted(index.weights)
    found = index.blocks.mapInArrow(lambda b: search_blocks(b, queries, k), FOUND)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    spark = index.blocks.sparkSession
    names = spark.createDataFrame(list(enumerate(index.items.names)), "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank_all(docs: DataFrame, items: DataFrame, k: int = 20, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The k best documents of every item of (item_id, text)."""
    ship(docs.sparkSession)
    found = [search(build_index(docs, block), k) for block in item_blocks(items, item_bytes)]
    nothing = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found) if found else nothing
