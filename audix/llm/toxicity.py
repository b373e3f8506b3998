"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme values.

Labelled documents that hold a word are counted by class, for the word as a whole and for
its prefixes of 3 to 8 characters, in a fixed number of hashed slots. The log-odds of a
word come from a chain of Dirichlet (Beta) priors: the share of toxic documents is the
prior of the shortest prefix, whose posterior share is the prior of the next longer one,
and so on to the word itself. They are drawn towards 0 by CARE standard deviations, so that
only words that are surely of one class weigh anything, and every word costs DRIFT.

Along a text, the maximal scoring segments (every stretch that no shorter or longer one
beats) are found in one pass. The best score of a clean text of n words follows an
extreme-value law, P(best <= x) = exp(-K n exp(-lambda x)); lambda and K are fitted by
maximum likelihood to clean labelled texts. A segment is significant if less than one as
good is expected in a clean text of its length. The significant segments of a text,
best first, are judged together by the law of the sum of the r best ones, for every r;
the smallest probability, on a log scale, is the evidence of the text, which a logistic
regression turns into a score between 0 and 1.

The law and the regression are fitted to texts that did not teach the log-odds: the
labelled ones are halved by a hash of the text, each half is scored with the counts of
the other, at most CALIBRATION_ROWS of each class. Counts cover all labelled documents;
what they gather is bounded by the slots, whatever the size of the corpus.

Defined cases: null and empty texts and texts without a word have no segment, and the
score of no evidence; of several labels of a document the largest counts, null labels and
ids count as unlabelled; with no labelled documents every score is 0; with one class only
every score is its share; an empty table gives no rows. Other columns stay; of columns
named like a result the result stays.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import text_slices
from audix.llm.shared import packed, ship, small, stored

SLOTS = 1 << 20                     # hashed words and prefixes
PREFIXES = (3, 4, 5, 6, 7, 8)       # characters
# Chosen by the log loss of each half of the labelled training documents under the other.
PRIOR = 40.0                        # weight of a prior, in documents
CARE = 2.0
DRIFT = 0.3
CALIBRATION_ROWS = 10_000           # documents of each class that fit the law and the regression
MEMO_CHARS = 1 << 22                # of words remembered by a task
SALTS = 64
WORD = re.compile(r"[^\W_]+")
RESULTS = ["score", "n_passages", "passages"]
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def slots(word: str) -> list[int]:
    """Slots of a word's prefixes, shortest first, and of the word."""
    return [zlib.crc32(word[:k].encode("utf-8", "replace")) % SLOTS for k in PREFIXES if k < len(word)] \
        + [zlib.crc32(b"=" + word.encode("utf-8", "replace")) % SLOTS]


class Memo(dict):
    """Values of words, computed once until the remembered words grow too long."""

    def __init__(self, value):
        super().__init__()
        self.value, self.held = value, 0

    def __missing__(self, word):
        found = self.value(word)
        if len(word) <= 64:
            self.held += len(word) + 64
            if self.held > 16 * MEMO_CHARS:
                self.clear()
                self.held = len(word)
            self[word] = found
        return found


@dataclass(frozen=True)
class Model:
    """Counts of clean and toxic documents by slot; the law; the regression."""
    clean: np.ndarray
    toxic: np.ndarray
    documents: tuple[float, float]      # clean and toxic ones
    law: tuple[float, float] = (1.0, 1.0)          # lambda, K
    line: tuple[float, float] = (0.0, 1.0)         # intercept, slope

    def word_score(self, word: str) -> float:
        """What a word adds to a segment."""
        base = (self.documents[1] + 1) / (sum(self.documents) + 2)
        clean, toxic, share = PRIOR * (1 - base), PRIOR * base, base
        for s in slots(word):
            clean, toxic = float(self.clean[s]) + PRIOR * (1 - share), float(self.toxic[s]) + PRIOR * share
            share = toxic / (clean + toxic)
        odds = math.log(toxic / clean) - math.log(base / (1 - base))
        sure = max(abs(odds) - CARE * math.sqrt(1 / clean + 1 / toxic), 0)
        return math.copysign(sure, odds) - DRIFT

    def evidence(self, scores: list[float], n: int) -> float:
        """Minus the logarithm of the probability that a clean text of ``n`` words has
        segments as good as the best ones together, at least 0."""
        rate, k = self.law
        best, total, r = 0.0, 0.0, 0
        for s in sorted(scores, reverse=True):
            normal = rate * s - math.log(k * max(n, 1))
            if normal <= 0:
                break
            total, r = total + normal, r + 1
            # the sum of the r best (Karlin and Altschul), and a factor 2 for every r tried
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r) + r * math.log(2)
            best = max(best, -log_p)
        return best

    def score(self, evidence: float) -> float:
        at = self.line[0] + self.line[1] * math.log1p(evidence)
        return 1 / (1 + math.exp(-at)) if at > -700 else 0.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal scoring segments (Ruzzo and Tompa), in one pass."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    at = np.flatnonzero(scores > 0)
    found: list[tuple[float, float, int, int]] = []        # left sum, right sum, start, end
    links: list[int] = []                                   # the nearest earlier one with a smaller left sum
    for i, left, right in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist()):
        start = i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = links[j]
            if j < 0 or found[j][1] >= right:
                break
            left, start = found[j][0], found[j][2]
            del found[j:], links[j:]
        found.append((left, right, start, i + 1))
        links.append(j)
    return [(a, b, right - left) for left, right, a, b in found]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts of the task that hold a slot, by half and class; slot SLOTS counts all texts."""
    held = np.zeros((4, SLOTS + 1), np.int64)
    memo = Memo(slots)
    for part in text_slices(batches):
        group = 2 * part.rows.column(part.rows.schema.get_field_index("half")).to_numpy() \
            + part.rows.column(part.rows.schema.get_field_index("toxic")).to_numpy()
        for i in range(len(part)):
            words = set(WORD.findall(part.text(i).decode("utf-8", "replace").lower()))
            held[group[i], list({s for w in words for s in memo[w]} | {SLOTS})] += 1
    for g in range(4):
        at = np.flatnonzero(held[g])
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), g, np.int32)), pa.array(at.astype(np.int32)), pa.array(held[g][at])],
                ["part", "slot", "n"])


def _scored(text: str, memo: Memo) -> tuple[int, list[tuple[int, int, float]]]:
    words = WORD.findall(text.lower())
    return len(words), segments(np.array([memo[w] for w in words]))


def best_scores(batches: Iterator[pa.RecordBatch], models: list[Model]) -> Iterator[pa.RecordBatch]:
    """(toxic, words, scores of the segments) of texts, each by the model of the other half."""
    memos = [Memo(m.word_score) for m in models]
    for part in text_slices(batches):
        half = part.rows.column(part.rows.schema.get_field_index("half")).to_pylist()
        rows = [_scored(part.text(i).decode("utf-8", "replace"), memos[1 - half[i]]) for i in range(len(part))]
        yield pa.RecordBatch.from_arrays(
            [part.rows.column(part.rows.schema.get_field_index("toxic")), pa.array([n for n, _ in rows], pa.int64()),
             pa.array([[s for *_, s in found] for _, found in rows], pa.list_(pa.float64()))],
            ["toxic", "words", "scores"])


def fit_law(words: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """Maximum-likelihood lambda and K of the best scores of clean texts."""
    words, best = words[best > 0].astype(float), best[best > 0]
    if len(best) < 10 or best.max() == best.min():
        return 1.0, 1.0

    def slope(rate: float) -> float:
        w = words * np.exp(-rate * (best - best.min()))
        return 1 / rate - best.mean() + (best * w).sum() / w.sum()
    low, high = 1e-3, 1e3
    for _ in range(100):            # the slope falls with the rate
        mid = math.sqrt(low * high)
        low, high = (mid, high) if slope(mid) > 0 else (low, mid)
    return low, float(len(best) / (words * np.exp(-low * best)).sum())


def fit_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x with weights, by Newton steps with a small ridge."""
    design, beta = np.column_stack([np.ones_like(x), x]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        grad = design.T @ (weight * (y - p)) - 1e-3 * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(beta[0]), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame) -> Model | float:
    """The model of (doc_id, text) labelled by (doc_id, toxic); a number if there are
    not both classes, the score of every text."""
    spark = docs.sparkSession
    ship(spark)
    one = stored(labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
                 .agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "labels")
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")
    taught = stored(docs.select("doc_id", "text").join(small(one, 16), "doc_id")
                    .select("doc_id", "toxic", half.alias("half"), "text"), "taught")
    sizes = {r.toxic: r.n for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return float(max(sizes, default=0))
    counts = np.zeros((4, SLOTS + 1))
    summed = (taught.select("half", "toxic", "text").mapInArrow(count_words, "part int, slot int, n long")
              .groupBy("part", "slot").agg(F.sum("n").alias("n")))
    # At most 4 rows a slot, whatever the size of the corpus.
    for part, slot, n in zip(*[c.to_numpy() for c in summed.toArrow().columns]):
        counts[part, slot] = n

    def model(rows: np.ndarray) -> Model:
        clean, toxic = rows.reshape(-1, 2, SLOTS + 1).sum(axis=0)
        return Model(clean[:-1].astype(np.float32), toxic[:-1].astype(np.float32), (clean[-1], toxic[-1]))
    halves, whole = [model(counts[:2]), model(counts[2:])], model(counts)
    order = F.xxhash64("doc_id", "text")
    chosen = taught.withColumn("order", order).withColumn("salt", F.pmod("order", F.lit(SALTS)))
    for by in (["toxic", "salt"], ["toxic"]):
        chosen = (chosen.withColumn("at", F.row_number().over(Window.partitionBy(*by).orderBy("order", "doc_id")))
                  .where(F.col("at") <= CALIBRATION_ROWS))
        # texts are read again for those that stay, not moved
        chosen = chosen.select("doc_id", "toxic", "order", "salt")
    drawn = taught.join(F.broadcast(chosen.select("doc_id", F.col("order").alias("drawn")).distinct()), "doc_id") \
        .where(order == F.col("drawn"))
    found = stored(drawn.select("toxic", "half", "text").mapInArrow(
        lambda b: best_scores(b, halves), "toxic int, words long, scores array<double>"), "calibration")
    firsts = found.select("toxic", "words", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("best"))
    clean = firsts.where("toxic = 0").toArrow()
    law = fit_law(clean["words"].to_numpy(), clean["best"].to_numpy())
    judged = replace(whole, law=law)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([judged.evidence(s, n) for n, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())])],
                ["toxic", "evidence"])
    rows = found.mapInArrow(weigh, "toxic int, evidence double").toArrow()
    toxic = rows["toxic"].to_numpy()
    # A drawn document stands for all of its class.
    weight = np.where(toxic == 1, sizes[1] / max((toxic == 1).sum(), 1), sizes[0] / max((toxic == 0).sum(), 1))
    return replace(judged, line=fit_line(np.log1p(rows["evidence"].to_numpy()), toxic.astype(float), weight))


def _judge(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(model.word_score)
        rate, k = model.law
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                                   ("expected", pa.float64())]))
        for part in text_slices(batches):
            scores, passages = [], []
            for i in range(len(part)):
                text = part.text(i).decode("utf-8", "replace")
                n, found = _scored(text, memo)
                scores.append(model.score(model.evidence([s for *_, s in found], n)))
                good = [(a, b, s, k * n * math.exp(-rate * s)) for a, b, s in found]
                good = [g for g in good if g[3] < 1]
                if good:
                    spans = [m.span() for m in WORD.finditer(text.lower())]
                    passages.append([{"start": spans[a][0], "end": spans[b - 1][1], "score": s, "expected": e}
                                     for a, b, s, e in good])
                else:
                    passages.append([])
            yield pa.RecordBatch.from_arrays(
                [part.rows.column(0), pa.array(scores, pa.float64()), pa.array([len(p) for p in passages], pa.int32()),
                 pa.array(passages, kind)], ["row", *RESULTS])
    return run


def find_toxic(docs: DataFrame, model: Model | float) -> DataFrame:
    """All columns of ``docs`` but text, then score, n_passages and passages: characters
    [start, end) of the lower-cased text, score, and how many as good are expected."""
    rows = packed(docs, RESULTS).select("row", "text")
    if isinstance(model, float):
        return rows.select("row.*", F.lit(model).alias("score"), F.lit(0).alias("n_passages"),
                           F.array().cast(PASSAGES).alias("passages"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double, n_passages int, passages {PASSAGES}"
    return rows.mapInArrow(_judge(model), schema).select("row.*", *RESULTS)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
