"""Approximate nearest neighbours by largest inner product.

Vectors are dealt to shards of bounded size by a hash; each shard builds a
hierarchical navigable small-world graph and stores it as flat neighbour arrays
(one row per shard: level by level, a fixed number of neighbours per vertex).
Queries, a stated set, visit every shard in blocks, and shard results are merged.

Inside a shard the inner product becomes a distance by one more dimension: all
vectors are scaled by the largest norm and completed to length one, queries get
a zero there. Vertices are inserted in batches and queries searched in batches;
a batch walks the graph in step, every lane keeping its own beam, so the work is
matrix arithmetic. Neighbours are chosen with the diversity rule (a candidate
closer to a chosen neighbour than to the vertex is passed over). Equal vectors
are one vertex, so copies cannot fill a neighbourhood; the scores returned are
inner products of the original vectors in double precision.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as query or candidate; vectors of different lengths
never meet; of rows that repeat an id the smallest vector counts; ties go to the smaller vec_id; fewer than k candidates: all that are
found; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.batches import mix64
from audix.llm.shared import ship, stored
from audix.llm.top_k import one_per_id, smallest_ids, usable

SHARD_ROWS, LEAST_SHARDS = 16384, 4
QUERY_BLOCK = 1024
NEIGHBOURS = 16              # per level; twice as many on the lowest
EF_BUILD, EF_SEARCH = 64, 256
BATCH = 512


def _nearest(sims: np.ndarray, keep: int) -> np.ndarray:
    """Columns of the ``keep`` largest values of each row, largest first."""
    if sims.shape[1] > keep:
        part = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
        inner = np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable")
        return np.take_along_axis(part, inner, 1)
    return np.argsort(-sims, axis=1, kind="stable")


class Graph:
    """HNSW over unit vectors; nearness is the inner product."""

    def __init__(self, points: np.ndarray, neighbours: list[np.ndarray] | None = None, entry: int = 0):
        self.points = points.astype(np.float32)
        self.entry = entry
        if neighbours is not None:
            self.neighbours = neighbours
        else:
            self._build()

    # search ---------------------------------------------------------------

    def walk(self, queries: np.ndarray, start: np.ndarray, ef: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of one level from start (lanes x any, -1 for none):
        (ids, similarities), lanes x ef, best first, -1 where fewer."""
        table, n, lanes = self.neighbours[level], len(self.points), len(queries)
        start = start[:, :ef]
        ids = np.full((lanes, ef), -1, np.int64)
        sims = np.full((lanes, ef), -np.inf, np.float32)
        seen = np.zeros((lanes, n + 1), bool)
        seen[:, n] = True
        width = start.shape[1]
        ids[:, :width] = start
        found = np.einsum("lwd,ld->lw", self.points[start], queries)
        sims[:, :width] = np.where(start >= 0, found, -np.inf)
        seen[np.arange(lanes)[:, None], np.where(start >= 0, start, n)] = True
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        done = ids < 0
        live = np.arange(lanes)
        while len(live):
            open_ = ~done[live]
            has = open_.any(axis=1)
            live = live[has]
            if len(live) == 0:
                break
            at = open_[has].argmax(axis=1)
            done[live, at] = True
            near = table[ids[live, at]]
            near = np.where(near >= 0, near, n)
            fresh = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            new = np.einsum("lwd,ld->lw", self.points[np.where(fresh, near, 0)], queries[live])
            new = np.where(fresh, new, -np.inf)
            better = new > sims[live, -1][:, None]
            act = better.any(axis=1)
            rows = live[act]
            if len(rows) == 0:
                continue
            all_sims = np.concatenate((sims[rows], np.where(better, new, -np.inf)[act]), axis=1)
            all_ids = np.concatenate((ids[rows], near[act]), axis=1)
            all_done = np.concatenate((done[rows], ~better[act]), axis=1)
            best = _nearest(all_sims, ef)
            sims[rows] = np.take_along_axis(all_sims, best, 1)
            ids[rows] = np.where(np.isinf(sims[rows]), -1, np.take_along_axis(all_ids, best, 1))
            done[rows] = np.take_along_axis(all_done, best, 1) | (ids[rows] < 0)
        return ids, sims

    def search(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the ef nearest found on the lowest level."""
        at = np.full((len(queries), 1), self.entry)
        for level in range(len(self.neighbours) - 1, 0, -1):
            at, _ = self.walk(queries, at, 1, level)
        return self.walk(queries, at, min(ef, len(self.points)), 0)

    # building ---------------------------------------------------------------

    def _chosen(self, vertices: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Diverse neighbours (lanes x keep, -1 padded) from candidates given
        nearest first; what the rule passes over fills the places left."""
        lanes, c = ids.shape
        between = np.einsum("lad,lbd->lab", self.points[ids], self.points[ids])
        taken = np.zeros((lanes, c), bool)
        count = np.zeros(lanes, np.int64)
        valid = (ids >= 0) & (ids != vertices[:, None])
        for k in range(c):
            closest = np.where(taken, between[:, k, :], -np.inf).max(axis=1)
            good = valid[:, k] & (sims[:, k] > closest) & (count < keep)
            taken[:, k] = good
            count += good
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * c + np.arange(c)
        order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
        out = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
        if out.shape[1] < keep:
            out = np.concatenate((out, np.full((lanes, keep - out.shape[1]), -1)), axis=1)
        return out

    def _connect(self, level: int, vertices: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Neighbours of new vertices, and the way back from each of them."""
        table = self.neighbours[level]
        width = table.shape[1]
        chosen = self._chosen(vertices, ids, sims, NEIGHBOURS)
        table[vertices, :NEIGHBOURS] = chosen
        back, new = chosen.reshape(-1), np.repeat(vertices, NEIGHBOURS)
        back, new = back[back >= 0], new[back >= 0]
        order = np.argsort(back, kind="stable")
        back, new = back[order], new[order]
        hosts, first, n = np.unique(back, return_index=True, return_counts=True)
        for a in range(0, int(n.max(initial=0)), width):      # a host's new neighbours, some at a time
            here = np.flatnonzero(n > a)
            for part in np.array_split(here, -(-len(here) // 1024)):
                offered = np.full((len(part), int(np.minimum(n[part] - a, width).max())), -1)
                for k in range(offered.shape[1]):
                    some = n[part] - a > k
                    offered[some, k] = new[first[part][some] + a + k]
                self._offer(table, hosts[part], offered)

    def _offer(self, table: np.ndarray, host: np.ndarray, offered: np.ndarray) -> None:
        """Add neighbours to hosts, choosing anew where a host has too many."""
        width = table.shape[1]
        both = np.concatenate((table[host], offered), axis=1)
        place = np.arange(both.shape[1])
        known = (both[:, :, None] == both[:, None, :]) & (place[:, None] > place)
        both[known.any(axis=2)] = -1
        near = np.where(both >= 0, np.einsum("lwd,ld->lw", self.points[both], self.points[host]), -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        both, near = np.take_along_axis(both, order, 1), np.take_along_axis(near, order, 1)
        full = (both >= 0).sum(axis=1) > width
        table[host[~full]] = both[~full, :width]
        if full.any():
            table[host[full]] = self._chosen(host[full], both[full], near[full], width)

    def _build(self) -> None:
        n = len(self.points)
        draw = (mix64(np.arange(n, dtype=np.uint64) + np.uint64(97)) >> np.uint64(11)) * 2.0**-53
        levels = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(NEIGHBOURS)).astype(int), 12)
        order = np.lexsort((np.arange(n), mix64(np.arange(n, dtype=np.uint64) + np.uint64(31)), -levels))
        # the highest vertices go first, so levels are complete from the top down
        self.entry = int(order[0]) if n else 0
        top = int(levels.max(initial=0))
        self.neighbours = [np.full((n, NEIGHBOURS * (2 if level == 0 else 1)), -1, np.int64) for level in range(top + 1)]
        at = 1
        while at < n:
            batch = order[at:at + min(BATCH, max(16, at))]
            points = self.points[batch]
            inside = points @ points.T
            np.fill_diagonal(inside, -np.inf)
            start = np.full((len(batch), 1), self.entry)
            for level in range(top, -1, -1):
                member = levels[batch] >= level
                passing = np.flatnonzero(~member)
                ids = np.full((len(batch), EF_BUILD), -1)
                if len(passing):
                    ids[passing, :1] = self.walk(points[passing], start[passing], 1, level)[0]
                mine = np.flatnonzero(member)
                if len(mine):
                    ids[mine], sims = self.walk(points[mine], start[mine], EF_BUILD, level)
                    peers = inside[np.ix_(mine, mine)]
                    some = _nearest(peers, min(16, len(mine)))
                    both = np.concatenate((ids[mine], batch[mine][some]), axis=1)
                    near = np.concatenate((sims, np.take_along_axis(peers, some, 1)), axis=1)
                    both = np.where(np.isinf(near), -1, both)
                    best = _nearest(near, min(EF_BUILD, near.shape[1]))
                    self._connect(level, batch[mine], np.take_along_axis(both, best, 1), np.take_along_axis(near, best, 1))
                start = ids[:, :8]
            at += len(batch)


def unit_points(vectors: np.ndarray) -> np.ndarray:
    """Vectors over their largest norm, completed to length one."""
    scale = np.abs(vectors).max(initial=0) or 1.0
    x = vectors / scale
    norms = np.sqrt(np.square(x).sum(axis=1))
    x = x / (norms.max(initial=0) or 1.0)
    rest = np.sqrt(np.maximum(0, 1 - np.square(x).sum(axis=1)))
    return np.concatenate((x, rest[:, None]), axis=1)


_SHARD = "dims int, shard int, n int, entry long, levels int, ids binary, vectors binary, neighbours binary"


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the shard's ids, vectors and graph as flat arrays."""
    rows = rows.sort_values("cand", kind="stable")
    vectors = np.array(rows["v"].tolist(), np.float64)
    graph = Graph(unit_points(vectors))
    flat = np.concatenate([t.reshape(-1) for t in graph.neighbours]).astype(np.int32)
    return pd.DataFrame({"dims": [vectors.shape[1]], "shard": [rows["shard"].iloc[0]], "n": [len(rows)],
                         "entry": [graph.entry], "levels": [len(graph.neighbours)],
                         "ids": [rows["cand"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()],
                         "neighbours": [flat.tobytes()]})


def load_shard(row) -> tuple[Graph, np.ndarray, np.ndarray]:
    """(graph, ids, original vectors) of a stored shard."""
    n, dims = int(row["n"]), int(row["dims"])
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dims)
    flat, tables, at = np.frombuffer(row["neighbours"], np.int32), [], 0
    for level in range(int(row["levels"])):
        width = NEIGHBOURS * (2 if level == 0 else 1)
        tables.append(flat[at:at + n * width].reshape(n, width).astype(np.int64))
        at += n * width
    return Graph(unit_points(vectors), tables, int(row["entry"])), np.frombuffer(row["ids"], np.int64), vectors


def _visit(k: int, ef: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": np.zeros(0, np.int64), "cand": np.zeros(0, np.int64), "score": np.zeros(0)})
        if len(left) == 0 or len(right) == 0:
            return out
        graph, ids, vectors = load_shard(right.iloc[0])
        asked = np.array(left["v"].tolist(), np.float64)
        unit = asked / np.abs(asked).max(axis=1, keepdims=True)
        unit /= np.sqrt(np.square(unit).sum(axis=1, keepdims=True))
        unit = np.concatenate((unit, np.zeros((len(unit), 1))), axis=1).astype(np.float32)
        parts = [out]
        for a in range(0, len(unit), 256):
            found, _ = graph.search(unit[a:a + 256], ef)
            found = found[:, :2 * k + 2]
            score = np.einsum("lwd,ld->lw", vectors[found], asked[a:a + 256])
            lane, place = np.nonzero(found >= 0)
            part = pd.DataFrame({"query_id": left["query_id"].to_numpy()[a + lane], "cand": ids[found[lane, place]],
                                 "score": score[lane, place]})
            part = part.sort_values(["query_id", "score", "cand"], ascending=[True, False, True], kind="stable")
            parts.append(part.groupby("query_id", sort=False).head(k + 1))
        return pd.concat(parts)
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding",
            ef: int = EF_SEARCH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for every query
    row of vectors(vec_id, <vector>), its own row left out."""
    ship(vectors.sparkSession)
    nonzero = vectors.where(usable(vector)).where(F.exists(vector, lambda x: x != 0))
    base = one_per_id(nonzero, is_query, vector)
    key = ["dims", "h1", "h2"]
    keyed = stored(base.withColumn("dims", F.size("v")).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.hash("v")),
                   "vectors")
    members = stored(smallest_ids(keyed.select("vec_id", *key), key, k + 1), "members")
    first = members.groupBy(*key).agg(F.min("vec_id").alias("cand"))
    distinct = stored(keyed.join(first.withColumnRenamed("cand", "vec_id"), [*key, "vec_id"], "left_semi")
                      .select(F.col("vec_id").alias("cand"), "dims", "v"), "vertices")
    shards = max(LEAST_SHARDS, -(-distinct.count() // shard_rows))
    graphs = stored(distinct.withColumn("shard", F.pmod(F.xxhash64("cand"), F.lit(shards)).cast("int"))
                    .groupBy("dims", "shard").applyInPandas(build_shard, _SHARD), "graphs")
    asked = keyed.where("is_query").select(F.col("vec_id").alias("query_id"), "dims", "v")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    left = (asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    right = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    by = ["dims", "shard", "block"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)) \
        .applyInPandas(_visit(k, ef), "query_id long, cand long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand")
    top = stored(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
                 .select("query_id", "cand", "score"), "top")
    named = members.join(first, key).select("vec_id", "cand")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (top.join(named, "cand").where(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
