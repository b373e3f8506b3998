"""Admission of expanded users into the originals' communities.

For each candidate tuple t: c* = arg-max_c e(t, c) (lowest cid on ties); admit
iff e(t, c*) > a(c*) * sum_c e(t, c); gain = the difference (K8: the arg-max
is over edge weight, not gain). Every user of the tuple gets its gain; the
final audience is the top N by gain, N = min(floor(candidates / divisor),
admitted). Only N and the candidate count reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.functions.joins import small_side

AUDIENCE_DIVISOR = 1000


def gate(affinity: DataFrame, shares: DataFrame) -> DataFrame:
    """(tid, cid, e_best, e_total, a, gain) for admitted tuples only.
    Tuples with no similar vertex have no affinity rows: not admitted."""
    per_t = affinity.groupBy("tid").agg(
        F.min_by(F.struct("cid", "e"), F.struct((-F.col("e")).alias("ne"), F.col("cid"))).alias("best"),
        F.sum("e").alias("e_total"))
    j = (per_t.select("tid", F.col("best.cid").alias("cid"), F.col("best.e").alias("e_best"), "e_total")
         .join(small_side(shares.select("cid", "a")), "cid"))
    j = j.withColumn("gain", F.col("e_best") - F.col("a") * F.col("e_total"))
    return j.where(F.col("e_best") > F.col("a") * F.col("e_total"))


def admitted_users(gated: DataFrame, members: DataFrame) -> DataFrame:
    """(sid, tid, cid, gain) for every user of an admitted tuple."""
    return members.join(gated.select("tid", "cid", "gain"), "tid")


def top_audience(users: DataFrame, n: int) -> DataFrame:
    """T4 (N given): top n users by gain, ties by sid (TakeOrderedAndProject)."""
    return users.orderBy(F.col("gain").desc(), F.col("sid")).limit(max(int(n), 0)).select("sid", "gain")


def audience_size_n(n_candidates: int, n_admitted: int, divisor: int = AUDIENCE_DIVISOR) -> int:
    """N = min(floor(candidates / divisor), admitted) (K15: fewer than divisor
    candidates give none). T5's alternative passes the originals' count."""
    return min(n_candidates // divisor, n_admitted)


def final_audience(users: DataFrame, n_candidates: int, divisor: int = AUDIENCE_DIVISOR,
                   n_override: int | None = None) -> DataFrame:
    """T4 with the reference's N, or ``n_override`` (T5: number of originals)."""
    # The limit itself stops at the admitted users, so they are not counted first.
    return top_audience(users, n_candidates // divisor if n_override is None else n_override)


def intake_counts(originals: DataFrame, candidates: DataFrame) -> DataFrame:
    """A10: rows read on each side, before empty projections are dropped
    (the candidate count is the N in T4). (measure, value)."""
    o = originals.agg(F.count("*").alias("value")).select(F.lit("originals_read").alias("measure"), "value")
    c = candidates.agg(F.count("*").alias("value")).select(F.lit("candidates_read").alias("measure"), "value")
    return o.unionByName(c)
