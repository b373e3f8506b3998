"""Audience size and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.functions.joins import DEFAULT_BROADCAST_ROWS, has_at_most
from audix.functions.text import in_open_range

# Defaults of the reference's evaluation, kept as parameters.
DEFAULT_SOURCE = "regular"


def spend_in_window(spend: DataFrame, lo_hour: str, hi_hour: str,
                    source: str = DEFAULT_SOURCE) -> DataFrame:
    """Non-null id and cost, cost != 0, source match, lo < hour_id < hi
    (both bounds exclusive, lexical). Pushed into the scan by Catalyst."""
    return (spend.where(F.col("s_id").isNotNull() & F.col("advertiser_cost").isNotNull()
                        & (F.col("advertiser_cost") != 0.0)
                        & in_open_range("hour_id", lo_hour, hi_hour)
                        & (F.col("source") == source))
            .select("s_id", "advertiser_cost", "hour_id"))


def audience_size(ids: DataFrame, col: str = "sid") -> DataFrame:
    """Count of non-null ids (one row; 0 for an empty list, K12)."""
    return ids.agg(F.count(col).alias("n_users"))


def audience_revenue_hourly(spend_w: DataFrame, ids: DataFrame, col: str = "sid",
                            max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A3: revenue of the list's users per hour.

    Every list row joins its spend rows (list duplicates count again, as in
    the reference). When the list is checked small it is broadcast and the
    only shuffle is the hourly partial aggregate. Otherwise spend is first
    collapsed to (s_id, hour_id) sums, so a user holding a third of the rows
    contributes at most one row per hour to the shuffle join.
    """
    lst = ids.select(F.col(col).alias("_lid"))
    if has_at_most(lst, max_broadcast_rows):
        j = spend_w.join(F.broadcast(lst), spend_w.s_id == lst._lid)
    else:
        pre = spend_w.groupBy("s_id", "hour_id").agg(F.sum("advertiser_cost").alias("advertiser_cost"))
        j = pre.join(lst, pre.s_id == lst._lid)
    return j.groupBy("hour_id").agg(F.sum("advertiser_cost").alias("revenue"))


def audience_revenue(hourly: DataFrame) -> DataFrame:
    """Total over the hourly sums (one row; null for no spend, K12)."""
    return hourly.agg(F.sum("revenue").alias("revenue"))


def audience_compare(lists: dict[str, DataFrame], spend_w: DataFrame, col: str = "sid") -> DataFrame:
    """One row per list: n_users, revenue and revenue_per_user (ours; the
    reference stores the four numbers only). Lists are tagged and evaluated
    in one pass over the filtered spend."""
    tagged = None
    for name, df in lists.items():
        t = df.select(F.lit(name).alias("list"), F.col(col).alias("sid"))
        tagged = t if tagged is None else tagged.unionByName(t)
    sizes = tagged.groupBy("list").agg(F.count("sid").alias("n_users"))
    per_user = spend_w.groupBy("s_id").agg(F.sum("advertiser_cost").alias("cost"))
    rev = (tagged.join(per_user, tagged.sid == per_user.s_id)
           .groupBy("list").agg(F.sum("cost").alias("revenue")))
    # one row per list, also for a list without rows
    names = spend_w.sparkSession.createDataFrame([(n,) for n in lists], "list string")
    return (names.join(sizes, "list", "left").join(rev, "list", "left")
            .withColumn("n_users", F.coalesce("n_users", F.lit(0)))
            .select("list", "n_users", "revenue",
                    F.try_divide(F.col("revenue"), F.col("n_users")).alias("revenue_per_user")))
