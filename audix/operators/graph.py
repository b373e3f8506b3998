"""Similarity graph of users.

Vertices are the distinct projected feature tuples with their user counts
(k); edges join tuples with Jaccard >= cutoff, weight k_i * k_j; every vertex
also carries a self-loop of weight k(k-1)/2. V is bounded by distinct tuples of
top-k features, not by users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.functions.features import NAMESPACES, namespaced_tokens, nonempty_projection, tuple_hash, tuple_key
from audix.functions.text import pair_count
from audix.operators.simjoin import DEFAULT_CUTOFF, similarity_join, similarity_self_join


def collapse_vertices(projected: DataFrame) -> DataFrame:
    """(vid, vkey, five arrays, k). ``projected`` has sid and the five
    projected arrays (already P14). Rows with all-empty sets are dropped (P15).
    vid = hash of the arrays with their lengths; vkey is the tuple as text."""
    p = nonempty_projection(projected).select(*NAMESPACES)
    g = p.groupBy(*NAMESPACES).agg(F.count("*").alias("k"))
    g = g.withColumn("vkey", tuple_key())
    return g.select(tuple_hash().alias("vid"), "vkey", *NAMESPACES, "k")


def collapse_candidates(projected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate tuples (tid, tkey, arrays, n_users) and the sid -> tid map;
    ids are not collected per tuple, the map is joined back instead."""
    p = nonempty_projection(projected).withColumn("tkey", tuple_key())
    p = p.withColumn("tid", tuple_hash())
    tuples = p.groupBy("tid", "tkey", *NAMESPACES).agg(F.count("*").alias("n_users"))
    members = p.select("sid", "tid")
    return tuples, members


def assert_unique_ids(df: DataFrame, id_col: str, key_col) -> None:
    """Fail loudly on a 64-bit hash collision between distinct keys."""
    dup = df.groupBy(id_col).agg(F.countDistinct(key_col).alias("n")).where(F.col("n") > 1)
    if dup.limit(1).count():
        raise RuntimeError(f"hash collision on {id_col}; use a dense id instead")


def build_edges(vertices: DataFrame, cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """G2 + G3: (src, dst, w) with src < dst for similarity edges (w = k_i*k_j)
    and src = dst for self-loops (w = k(k-1)/2, kept when 0)."""
    assert_unique_ids(vertices, "vid", F.struct(*NAMESPACES))
    sets = vertices.select(F.col("vid").alias("id"), namespaced_tokens().alias("tokens"))
    pairs = similarity_self_join(sets, cutoff=cutoff).select("id_a", "id_b")
    kk = vertices.select("vid", "k")
    e = (pairs.join(kk.withColumnRenamed("vid", "id_a").withColumnRenamed("k", "k_a"), "id_a")
         .join(kk.withColumnRenamed("vid", "id_b").withColumnRenamed("k", "k_b"), "id_b")
         .select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"),
                 (F.col("k_a") * F.col("k_b")).cast("long").alias("w")))
    loops = vertices.select(F.col("vid").alias("src"), F.col("vid").alias("dst"), pair_count("k").alias("w"))
    return e.unionByName(loops)


def graph_summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertex count, edge count incl. loops, user count (one row each as
    a (measure, value) table, no cross join)."""
    v = vertices.agg(F.count("*").alias("value"), F.sum("k").alias("users"))
    e = edges.agg(F.count("*").alias("value"))
    return (v.select(F.lit("vertices").alias("measure"), F.col("value").cast("long"))
            .unionByName(e.select(F.lit("edges").alias("measure"), F.col("value").cast("long")))
            .unionByName(v.select(F.lit("users").alias("measure"), F.coalesce(F.col("users"), F.lit(0)).cast("long").alias("value"))))


def _ends(edges: DataFrame) -> DataFrame:
    """Both ends of every edge; a self-loop contributes its vertex twice."""
    return edges.select(F.explode(F.array("src", "dst")).alias("vid"), "w")


def degree(edges: DataFrame) -> DataFrame:
    """Unweighted degree, a self-loop counts 2. (vid, degree)."""
    return _ends(edges).groupBy("vid").agg(F.count("*").alias("degree"))


def strength(edges: DataFrame) -> DataFrame:
    """Weighted degree, a self-loop counts twice. (vid, s)."""
    return _ends(edges).groupBy("vid").agg(F.sum("w").alias("s"))


def modularity(edges: DataFrame, membership: DataFrame) -> DataFrame:
    """Q = sum_c [ w_in(c)/W - (s_c / 2W)^2 ], W = total weight incl. loops.
    One row (modularity), null when W = 0 (K16). ``membership`` is (vid, cid)."""
    m = membership.select("vid", "cid")
    e = (edges.join(m.withColumnRenamed("vid", "src").withColumnRenamed("cid", "c_src"), "src")
         .join(m.withColumnRenamed("vid", "dst").withColumnRenamed("cid", "c_dst"), "dst"))
    per_c_in = (e.where(F.col("c_src") == F.col("c_dst")).groupBy(F.col("c_src").alias("cid"))
                .agg(F.sum("w").alias("w_in")))
    per_c_s = (e.select(F.explode(F.array("c_src", "c_dst")).alias("cid"), "w")
               .groupBy("cid").agg(F.sum("w").alias("s_c")))
    per_c = per_c_s.join(per_c_in, "cid", "left").fillna(0, ["w_in"])
    # sum_c s_c = 2W (loops count twice), so one aggregate gives every term.
    t = per_c.agg(F.sum("w_in").cast("double").alias("win"),
                  F.sum(F.col("s_c").cast("double") * F.col("s_c")).alias("ss"),
                  (F.sum("s_c").cast("double") / 2).alias("W"))
    return t.select(F.when(F.col("W") > 0, F.col("win") / F.col("W") - F.col("ss") / (4 * F.col("W") * F.col("W")))
                    .alias("modularity"))


def community_share(edges: DataFrame, membership: DataFrame, weighted: bool = False) -> DataFrame:
    """a_c = sum of member degrees / (2 * edge count incl. loops).
    Unweighted by default, as the gate is defined (K7); ``weighted`` uses
    strengths / 2W. (cid, a)."""
    per_v = strength(edges).withColumnRenamed("s", "d") if weighted else degree(edges).withColumnRenamed("degree", "d")
    per_c = per_v.join(membership.select("vid", "cid"), "vid").groupBy("cid").agg(F.sum("d").alias("d"))
    # The total (2 x edge count, or 2W) is one number: fetch it, do not join it.
    tot = float(per_v.agg(F.sum("d")).first()[0] or 0.0)
    return per_c.select("cid", (F.col("d") / F.lit(tot) if tot > 0 else F.lit(None).cast("double")).alias("a"))


def candidate_affinity(tuples: DataFrame, vertices: DataFrame, membership: DataFrame,
                       cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """G15 / J9 + A11: e(t, c) = sum of k over vertices of c similar to tuple t.
    Returns (tid, cid, e)."""
    left = tuples.select(F.col("tid").alias("id"), namespaced_tokens().alias("tokens"))
    right = vertices.select(F.col("vid").alias("id"), namespaced_tokens().alias("tokens"))
    pairs = similarity_join(left, right, cutoff=cutoff).select(F.col("id_a").alias("tid"), F.col("id_b").alias("vid"))
    return (pairs.join(vertices.select("vid", "k"), "vid")
            .join(membership.select("vid", "cid"), "vid")
            .groupBy("tid", "cid").agg(F.sum("k").alias("e")))
