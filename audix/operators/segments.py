"""Segment ranking and member extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.functions.joins import bounded_broadcast
from audix.functions.text import safe_divide

PROFILE_FEATURE_COLS = ["demo", "device", "app_activities", "geo", "keywords"]


def segment_topk(segment_revenue: DataFrame, dt: str, k: int = 10,
                 usertype: str = "sid", source: str = "dsp") -> DataFrame:
    """Top-k segments by revenue per user.

    profitability = revenue / userscount as double, null when userscount is 0
    or null (sorts last). Ties are broken by id so the top-k is deterministic;
    the sort+limit plans as TakeOrderedAndProject (per-partition heaps).
    """
    return (segment_revenue
            .where((F.col("usertype") == usertype) & (F.col("dt") == dt) & (F.col("source") == source))
            .select("id", safe_divide("revenue", "userscount").alias("profitability"))
            .orderBy(F.col("profitability").desc_nulls_last(), F.col("id").asc())
            .limit(k))


def segment_members(profiles: DataFrame, top_segments: DataFrame, dt: str,
                    require_clicks: bool = True) -> DataFrame:
    """Users of the chosen segments with their nested profile.

    Filters: segments and (optionally, K18) clicks not null, the dated
    snapshot, SID ids, active status. The segments bag is flattened with an
    inner explode (empty/null drops the row) and joined map-side to the top
    list, which is bounded by its ``limit`` and so safe to broadcast.
    One output row per (profile row, matching segment entry).
    """
    cond = (F.col("segments").isNotNull() & (F.col("dt") == dt)
            & (F.col("id_type") == "SID") & (F.col("status") == "active"))
    if require_clicks:
        cond = cond & F.col("clicks").isNotNull()
    flat = (profiles.where(cond)
            .select("raw_id", *PROFILE_FEATURE_COLS, "clicks", "other_clicks",
                    F.explode("segments").alias("seg"))
            .select("*", F.col("seg.segment_id").alias("segment_id")).drop("seg"))
    top = top_segments.select(F.col("id").alias("top_id"))
    return (flat.join(bounded_broadcast(top), flat.segment_id == top.top_id, "inner")
            .drop("top_id"))
