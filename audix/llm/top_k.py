"""Exact top-k by columnar branch and bound.

Vectors of small integers are kept in vertical layout, one column per dimension.
A cell of the work is a block of queries against a block of candidates: inner
products are accumulated dimension block by dimension block; after each block a
pair's score can still grow by at most the product of the two remaining masses
(norms of the dimensions not read yet), and what cannot reach its query's k-th
best score is compacted away: candidates that no query can use, then single
pairs once few are left. The k-th best score is bounded from below by full scores
of the candidates ahead after the first block and half-way, and the pairs that
survive all dimensions are exact.

Queries are a stated set (a predicate on the ids) against all rows, so every
query block meets every candidate block once; blocks are dealt by id hash, cells
are the unit of work, and a cell returns at most k rows per query. Equal vectors
are one candidate; only its k + 1 smallest ids can be in an answer, and they are
chosen by a salted two-step window, so a common vector is no hot group.

Defined cases: vectors that are null or empty or hold null or non-finite
components take no part; only vectors of one length are compared; a null id takes
no part; of rows that repeat an id the smallest vector counts; ties go to the smaller id; fewer than k candidates: all of them;
an empty table gives an empty result. Scores are exact: products are summed in
doubles while every sum stays below 2**53, in 64-bit integers otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.shared import ship, stored

SCALE = 64
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
DIMENSION_BLOCK = 8
# Share of a cell's pairs below which survivors leave the dense layout.
DENSE_SHARE = 0.03
# Candidates ahead that are scored in full for a bound, as a multiple of k.
AHEAD = 8
SALTS = 64


def usable(vector: str) -> Column:
    """Not null, and every component a finite number."""
    c = F.col(vector)
    return F.coalesce((F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x)
                                                 & (F.abs(x) != float("inf"))), F.lit(False))


def one_per_id(rows: DataFrame, is_query: Column, vector: str) -> DataFrame:
    """vec_id, is_query and v (doubles), one row per id."""
    return (rows.where("vec_id is not null")
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
                    F.transform(F.col(vector), lambda x: x.cast("double")).alias("v"))
            .groupBy("vec_id").agg(F.max("is_query").alias("is_query"), F.min("v").alias("v")))


def smallest_ids(rows: DataFrame, key: list[str], keep: int) -> DataFrame:
    """The rows with the ``keep`` smallest vec_id of every key, in two steps."""
    def best(df, *by):
        w = Window.partitionBy(*by).orderBy("vec_id")
        return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= keep).drop("_n")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    return best(best(salted, *key, "_salt").drop("_salt"), *key)


def cell_top(queries: np.ndarray, candidates: np.ndarray, k: int,
             width: int = DIMENSION_BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of every pair of a cell that can be
    among its query's k best in the cell, ties with the k-th included."""
    n, dims = candidates.shape
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * dims
    kind = np.float64 if bound < 2**53 else np.int64
    q, columns = queries.astype(kind), np.ascontiguousarray(candidates.T.astype(kind))
    # dimensions in the order of the candidates' mass, largest first
    order = np.argsort(-np.square(columns.astype(np.float64)).sum(axis=1), kind="stable")
    q, columns = np.ascontiguousarray(q[:, order]), columns[order]
    mass_q = np.sqrt(np.square(q.astype(np.float64))[:, ::-1].cumsum(axis=1)[:, ::-1])
    mass_c = np.sqrt(np.square(columns.astype(np.float64))[::-1].cumsum(axis=0)[::-1])
    names = np.arange(n)                       # candidates still in vertical layout
    partial = np.zeros((len(q), n), kind)
    floor = np.full(len(q), -np.inf)
    pairs = None                               # (query, candidate, score) once few are left
    for d in range(0, dims, width):
        end = min(d + width, dims)
        if pairs is None:
            partial += q[:, d:end] @ columns[d:end]
            if n > k and (d == 0 or d < dims // 2 <= end or end == dims):
                floor = np.maximum(floor, _kth_score(q, columns, partial, k, end == dims))
            low = (floor - 1e-9 * (1 + np.abs(floor)))[:, None]
            reach = partial if end == dims else partial + np.outer(mass_q[:, end] * (1 + 1e-9), mass_c[end])
            alive = reach >= low
            if end == dims or np.count_nonzero(alive) <= DENSE_SHARE * alive.size:
                qi, ci = np.nonzero(alive)
                pairs = qi, ci, partial[qi, ci]
                continue
            some = alive.any(axis=0)
            if np.count_nonzero(some) < 0.8 * len(some):
                names, columns, mass_c, partial = names[some], columns[:, some], mass_c[:, some], partial[:, some]
        else:
            qi, ci, score = pairs
            for x in range(d, end):
                score = score + q[qi, x] * columns[x][ci]
            reach = score if end == dims else score + mass_q[qi, end] * mass_c[end][ci] * (1 + 1e-9)
            stay = reach >= (floor - 1e-9 * (1 + np.abs(floor)))[qi]
            pairs = qi[stay], ci[stay], score[stay]
    qi, ci, score = pairs
    return qi, names[ci], score.astype(np.int64)


def _kth_score(q: np.ndarray, columns: np.ndarray, partial: np.ndarray, k: int, final: bool) -> np.ndarray:
    """A score that k candidates of every query reach: the k-th best full score
    of those ahead so far, or of all when the partial scores are final."""
    n = partial.shape[1]
    if n < k:
        return np.full(len(q), -np.inf)
    if final:
        return np.partition(partial, n - k, axis=1)[:, n - k].astype(np.float64)
    ahead = min(n, AHEAD * k)
    some = np.argpartition(-partial, ahead - 1, axis=1)[:, :ahead]
    return np.array([np.partition(q[i] @ columns[:, some[i]], ahead - k)[ahead - k] for i in range(len(q))], np.float64)


def _cell(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "cand": [], "score": []}, dtype="int64")
        if len(left) == 0 or len(right) == 0:
            return empty
        right = right.sort_values("cand", kind="stable")
        candidates = np.array(right["v"].tolist(), np.int64)
        own = right["cand"].to_numpy()
        out = []
        queries = np.array(left["v"].tolist(), np.int64)
        for a in range(0, len(left), QUERY_BLOCK):
            # a query's own vector is one of the candidates, so one more is kept
            qi, ci, score = cell_top(queries[a:a + QUERY_BLOCK], candidates, k + 1)
            order = np.lexsort((own[ci], -score, qi))
            qi, ci, score = qi[order], ci[order], score[order]
            first = np.searchsorted(qi, qi)
            top = np.arange(len(qi)) - first <= k
            qi, ci, score = qi[top] + a, ci[top], score[top]
            out.append(pd.DataFrame({"query_id": left["query_id"].to_numpy()[qi], "cand": own[ci], "score": score}))
        return pd.concat(out)
    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding",
                scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest integer inner products of
    floor(scale * x) of every query row of vectors(vec_id, <vector>)."""
    ship(vectors.sparkSession)
    base = one_per_id(vectors.where(usable(vector)), is_query, vector).withColumn(
        "v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)))
    keyed = stored(base.withColumn("dims", F.size("v")).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.hash("v")), "vectors")
    key = ["dims", "h1", "h2"]
    # one candidate per distinct vector, named by its smallest id
    members = stored(smallest_ids(keyed.select("vec_id", *key), key, k + 1), "members")
    first = members.groupBy(*key).agg(F.min("vec_id").alias("cand"))
    distinct = stored(keyed.join(first.withColumnRenamed("cand", "vec_id"), [*key, "vec_id"], "left_semi").select(F.col("vec_id").alias("cand"), "dims", "v"), "candidates")
    asked = keyed.where("is_query").select(F.col("vec_id").alias("query_id"), "v", *key)
    n_candidates, n_queries = distinct.count(), asked.count()
    c_blocks = max(1, -(-n_candidates // CANDIDATE_BLOCK))
    q_blocks = max(1, -(-n_queries // (16 * QUERY_BLOCK)))
    left = (asked.select("query_id", "dims", "v",
                         F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).alias("qb"),
                         F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb")))
    right = (distinct.select("cand", "dims", "v", F.pmod(F.xxhash64("cand"), F.lit(c_blocks)).cast("int").alias("cb"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("qb")))
    found = (left.groupBy("dims", "qb", "cb").cogroup(right.groupBy("dims", "qb", "cb"))
             .applyInPandas(_cell(k), "query_id long, cand long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand")
    top = stored(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
                 .select("query_id", "cand", "score"), "top")
    named = members.join(first, key).select("vec_id", "cand")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (top.join(named, "cand").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
