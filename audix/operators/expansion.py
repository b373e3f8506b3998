"""Two-step cluster expansion and its follow-up.

seeds --semi-join--> user's clusters --distinct--> reached clusters
      --semi-join--> cluster's users --explode--> (cluster, user) rows

One application, no file between the steps. Every join is keyed on a unique
key of the matrix side (one row per user / per cluster), so a popular cluster
is one wide row, not a hot shuffle key; explode output is de-duplicated on the
full (cluster, user) pair, which spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.functions.text import trim_ws


def _nonempty(arr: str):
    return F.size(F.coalesce(F.col(arr), F.array())) > 0


def clean_seeds(seeds: DataFrame, col: str = "sid") -> DataFrame:
    """Seed id list: trimmed (S3/K9), nulls and empties dropped. Duplicates are
    kept; the semi-joins below make them harmless."""
    s = seeds.select(trim_ws(col).alias("sid"))
    return s.where(F.col("sid").isNotNull() & (F.col("sid") != ""))


def user_cluster_rows(user_clusters: DataFrame) -> DataFrame:
    """SID rows with a non-empty cluster list, as (sid, cluster_ids)."""
    return (user_clusters.where((F.col("id_type") == "SID") & _nonempty("cluster_ids"))
            .select(F.col("raw_id").alias("sid"),
                    F.filter(F.col("cluster_ids.id"), lambda x: x.isNotNull()).alias("cids")))


def seed_clusters(seeds: DataFrame, user_clusters: DataFrame) -> DataFrame:
    """J5 + A6: the set of clusters of each seed user, as distinct (sid, cluster_id).

    Semi-join first (one matrix row per user, no duplication from repeated
    seeds), then unnest; the per-user set union is a distinct on the pair."""
    s = clean_seeds(seeds)
    inv = user_cluster_rows(user_clusters)
    return (inv.join(s, "sid", "left_semi")
            .select("sid", F.explode("cids").alias("cluster_id"))
            .distinct())


def reached_clusters(seed_cl: DataFrame) -> DataFrame:
    """Distinct clusters of all seeds (the reference re-emits one row per seed
    user only for the reducer to test existence)."""
    return seed_cl.select("cluster_id").distinct()


def cluster_sid_rows(cluster_users: DataFrame) -> DataFrame:
    """Clusters with a non-empty SID list, as (cluster_id, sids)."""
    m = cluster_users.where(_nonempty("user_raw_ids")).select(
        "cluster_id",
        F.transform(F.filter("user_raw_ids", lambda x: (x["id_type"] == "SID") & x["raw_id"].isNotNull()),
                    lambda x: x["raw_id"]).alias("sids"))
    return m.where(F.size("sids") > 0)


def expand_users(reached: DataFrame, cluster_users: DataFrame) -> DataFrame:
    """J6 + A7 + P13: one row per distinct (cluster_id, sid) over reached clusters.

    As in the reference, a user reached through several clusters appears once
    per cluster (K4); use ``expanded_ids(..., dedup=True)`` for a unique list."""
    m = cluster_sid_rows(cluster_users)
    return (m.join(reached, "cluster_id", "left_semi")
            .select("cluster_id", F.explode("sids").alias("sid"))
            .distinct())


def expanded_ids(expanded: DataFrame, dedup: bool = False) -> DataFrame:
    """The expansion as an id list (multiset by default, K4)."""
    ids = expanded.select("sid")
    return ids.distinct() if dedup else ids


def expand(seeds: DataFrame, user_clusters: DataFrame, cluster_users: DataFrame,
           num_partitions: int | None = None) -> DataFrame:
    """Both steps: seeds -> (cluster_id, sid) rows.

    A5: ``num_partitions`` pins the reducer count of each step (the
    reference's 32 / 64); by default AQE sizes the shuffles at runtime."""
    if num_partitions:
        user_clusters = user_clusters.repartition(num_partitions, "raw_id")
        cluster_users = cluster_users.repartition(num_partitions, "cluster_id")
    return expand_users(reached_clusters(seed_clusters(seeds, user_clusters)), cluster_users)


def expand_users_scored(seed_cl: DataFrame, cluster_users: DataFrame) -> DataFrame:
    """(cluster_id, sid, score) with score = number of seed users whose
    cluster set contains the cluster (partial aggregation before the join)."""
    score = seed_cl.groupBy("cluster_id").agg(F.count("*").alias("score"))
    m = cluster_sid_rows(cluster_users)
    return (m.join(score, "cluster_id")
            .select("cluster_id", F.explode("sids").alias("sid"), "score")
            .distinct())


def expand_by_segment(seeds_by_segment: DataFrame, user_clusters: DataFrame,
                      cluster_users: DataFrame) -> DataFrame:
    """All cohorts at once. ``seeds_by_segment`` is (segment_id, sid);
    the result is distinct (segment_id, cluster_id, sid)."""
    s = seeds_by_segment.select("segment_id", trim_ws("sid").alias("sid")).where(F.col("sid") != "")
    inv = user_cluster_rows(user_clusters)
    seg_cl = (inv.join(s, "sid")
              .select("segment_id", F.explode("cids").alias("cluster_id"))
              .distinct())
    m = cluster_sid_rows(cluster_users)
    return (m.join(seg_cl, "cluster_id")
            .select("segment_id", "cluster_id", F.explode("sids").alias("sid"))
            .distinct())


def expansion_minus_seed(expanded: DataFrame, originals: DataFrame, profiles: DataFrame,
                         dt: str) -> DataFrame:
    """A1 + J4 + J2: distinct expanded ids, minus the originals (anti-join),
    joined to the dated active SID profiles. Returns the profile rows."""
    new = expanded.select("sid").distinct()
    orig = clean_seeds(originals).select(F.col("sid").alias("osid"))
    fresh = new.join(orig, new.sid == orig.osid, "left_anti")
    prof = profiles.where(F.col("raw_id").isNotNull() & (F.col("dt") == dt)
                          & (F.col("id_type") == "SID") & (F.col("status") == "active"))
    return prof.join(fresh, prof.raw_id == fresh.sid).drop("sid")
