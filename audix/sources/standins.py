"""Stand-ins for the reference's inputs, derived by Spark from the test tables.

The reference reads catalog tables that are not public (profiles, segment
revenue, cluster matrices, spend). FIXTURES.md part 2 gives the rules used here
to derive inputs of the same shape from the TPC-H-like tables, so every query's
work grows with the given data. Nested collections built here are bounded by
small vocabularies (statuses, priorities, part types, name words), not by data
size; the cluster matrices are bounded by users per (part, month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.functions.joins import small_side
from audix.sources.tables import read_table

# Fixed stand-in constants (FIXTURES.md part 2).
PROFILE_DT = "20240101"
SEGMENT_REVENUE_DT = "20240101"
NON_SID_EVERY = 50        # c_custkey % 50 = 0 gets id_type 'OTHER'
UNKNOWN_GENDER_EVERY = 11  # c_custkey % 11 = 0 gets gender 'UNKNOWN'
AGE_STEP = 2000           # c_acctbal buckets
KEYWORD_LISTS = ["page_view", "page_click", "ad_click", "ad_conv", "search_click", "search_query"]


def _t(spark, sf_dir, name, *cols):
    df = read_table(spark, sf_dir, name)
    return df.select(*cols) if cols else df


def segment_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment revenue table: id = mktsegment-nation, revenue = sum(totalprice),
    userscount = distinct customers. Orders are pre-aggregated per customer
    (map-side partial aggregation) before the customer join."""
    per_cust = (_t(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
                .groupBy("o_custkey").agg(F.sum("o_totalprice").alias("rev")))
    cust = _t(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    return (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey)
            .groupBy(F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("id"))
            .agg(F.sum("rev").alias("revenue"), F.count("*").alias("userscount"))
            .select("id", F.lit("sid").alias("usertype"), F.lit(SEGMENT_REVENUE_DT).alias("dt"),
                    F.lit("dsp").alias("source"), "revenue", "userscount"))


# Lines that one task groups: the sorts of a group-by hold a task's rows in memory.
LINES_A_TASK = 250_000


def _dealt(rows: DataFrame, key: str, lines: DataFrame) -> DataFrame:
    """``rows`` dealt by ``key`` to tasks, as many as ``lines`` has LINES_A_TASK, so that what
    follows a key is grouped where it is: no partial lists are sorted, spilled and sent."""
    return rows.repartition(max(1, -(-lines.count() // LINES_A_TASK)), key)


def _customer_ids(spark, sf_dir):
    c = _t(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment",
        F.col("c_custkey").cast("string").alias("raw_id"),
        F.when(F.col("c_custkey") % NON_SID_EVERY == 0, F.lit("OTHER")).otherwise(F.lit("SID")).alias("id_type"))


def user_cluster_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer, cluster) with cluster = part x order month."""
    li = _t(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    o = _t(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("custkey"),
                    (F.col("l_partkey") * 1000000 + F.year("o_orderdate") * 100
                     + F.month("o_orderdate")).cast("long").alias("cluster_id"))
            .distinct())


def user_clusters(spark: SparkSession, sf_dir: str, pairs: DataFrame | None = None) -> DataFrame:
    """User-to-clusters matrix: id_type, raw_id, cluster_ids array<struct<id>>."""
    c = _customer_ids(spark, sf_dir).select("c_custkey", "raw_id", "id_type")
    pairs = user_cluster_pairs(spark, sf_dir) if pairs is None else pairs
    per_user = _dealt(pairs, "custkey", pairs).groupBy("custkey").agg(
        F.sort_array(F.collect_list(F.struct(F.col("cluster_id").alias("id")))).alias("cluster_ids"))
    return (c.join(per_user, c.c_custkey == per_user.custkey)
            .select("id_type", "raw_id", "cluster_ids"))


def cluster_users(spark: SparkSession, sf_dir: str, pairs: DataFrame | None = None) -> DataFrame:
    """Cluster-to-users matrix: cluster_id, user_raw_ids array<struct<id_type, raw_id>>."""
    c = _customer_ids(spark, sf_dir).select("c_custkey", "raw_id", "id_type")
    pairs = user_cluster_pairs(spark, sf_dir) if pairs is None else pairs
    return (_dealt(pairs.join(c, pairs.custkey == c.c_custkey).select("cluster_id", "id_type", "raw_id"), "cluster_id", pairs)
            .groupBy("cluster_id")
            .agg(F.sort_array(F.collect_list(F.struct("id_type", "raw_id"))).alias("user_raw_ids")))


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend by user and hour from ``events``: s_id, advertiser_cost, hour_id, source."""
    ev = _t(spark, sf_dir, "events", "user_id", "value", "ts", "event_type")
    return ev.select(F.col("user_id").cast("string").alias("s_id"),
                     F.col("value").cast("double").alias("advertiser_cost"),
                     F.date_format("ts", "yyyyMMddHH").alias("hour_id"),
                     F.col("event_type").alias("source"))


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a ``dt`` day string, standing in for daily snapshots."""
    ev = _t(spark, sf_dir, "events")
    return ev.withColumn("dt", F.date_format("ts", "yyyyMMdd"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested user profiles (FIXTURES.md part 1/2)."""
    cust = _customer_ids(spark, sf_dir)
    nation = _t(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = _t(spark, sf_dir, "region", "r_regionkey", "r_name")
    orders = _t(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    li = _t(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber")
    part = _t(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    events = _t(spark, sf_dir, "events", "user_id", "event_type")

    # Orders: commonest priority (ties: smallest), set of priorities and statuses.
    by_prio = (orders.groupBy("o_custkey", "o_orderpriority")
               .agg(F.count("*").alias("n"), F.collect_set("o_orderstatus").alias("st")))
    ord_agg = by_prio.groupBy(F.col("o_custkey").alias("ok_cust")).agg(
        F.min_by("o_orderpriority", F.struct((-F.col("n")).alias("nn"), F.col("o_orderpriority"))).alias("model"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("st")))).alias("statuses"))

    # Line items: part types and name words split over six lists by line number.
    bought = (li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == orders.o_orderkey)
              .join(part, li.l_partkey == part.p_partkey).where(F.col("p_name").isNotNull())
              .select("o_custkey", "p_type", (F.col("l_linenumber") % 6).alias("slot"), "p_name").distinct())
    # A customer's distinct lines meet in one task and become distinct (slot, word) entries,
    # types under slot -1: at most (types + 6 x name words) a customer are ever listed.
    entry = lambda slot, word: F.struct(slot.cast("int").alias("slot"), word.alias("word"))
    entries = (_dealt(bought, "o_custkey", li)
               .select(F.col("o_custkey").alias("lk_cust"), F.inline(F.concat(
                   F.array(entry(F.lit(-1), F.col("p_type"))),
                   F.transform(F.split("p_name", " "), lambda w: entry(F.col("slot"), w)))))
               .distinct())

    def listed(i):
        return F.transform(F.filter("entries", lambda e: (e["slot"] == i) & e["word"].isNotNull()), lambda e: e["word"])
    li_agg = (entries.groupBy("lk_cust").agg(F.sort_array(F.collect_list(F.struct("slot", "word"))).alias("entries"))
              .select("lk_cust", listed(-1).alias("ptypes"), *[listed(i).alias(f"kw{i}") for i in range(6)]))

    clicks = (events.where(F.col("event_type") == "click").groupBy(F.col("user_id").alias("ck_user"))
              .agg(F.count("*").alias("clicks")))
    views = (events.where(F.col("event_type") == "view").groupBy(F.col("user_id").alias("vw_user"))
             .agg(F.count("*").alias("other_clicks")))

    geo_region = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")

    j = (cust.join(small_side(geo_region, 100_000), cust.c_nationkey == geo_region.n_nationkey, "left")
         .join(ord_agg, cust.c_custkey == ord_agg.ok_cust, "left")
         .join(li_agg, cust.c_custkey == li_agg.lk_cust, "left")
         .join(clicks, cust.c_custkey == clicks.ck_user, "left")
         .join(views, cust.c_custkey == views.vw_user, "left"))

    nul = F.lit(None).cast("string")
    demo = F.struct(
        F.when(F.col("c_custkey") % UNKNOWN_GENDER_EVERY == 0, F.lit("UNKNOWN"))
         .otherwise(F.col("c_mktsegment")).alias("gender"),
        nul.alias("f1"), nul.alias("f2"),
        (F.floor(F.col("c_acctbal") / AGE_STEP).cast("long") * AGE_STEP).cast("string").alias("age_bucket"))
    device = F.struct(
        F.struct(nul.alias("m0"), nul.alias("m1"), nul.alias("m2"), nul.alias("m3"),
                 F.col("model").alias("model")).alias("mobile"),
        F.transform("statuses", lambda s: F.struct(s.alias("os"), nul.alias("d1"),
                                                   F.col("r_name").alias("browser"))).alias("desktop"))
    apps = F.transform("ptypes", lambda t: F.struct(nul.alias("a0"), nul.alias("a1"), nul.alias("a2"),
                                                    nul.alias("a3"), t.alias("category")))
    geo = F.struct(F.array(F.struct(F.col("c_nationkey").cast("long").alias("woe_id"))).alias("city"))
    keywords = F.when(F.col("kw0").isNotNull(), F.struct(*[
        F.struct(F.transform(f"kw{i}", lambda w: F.struct(w.alias("word"))).alias("wiki")).alias(name)
        for i, name in enumerate(KEYWORD_LISTS)]))
    segments = F.concat(
        F.array(F.struct(F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("segment_id"))),
        F.coalesce(F.transform("priorities", lambda p: F.struct(p.alias("segment_id"))),
                   F.array().cast("array<struct<segment_id:string>>")))

    return j.select(
        "raw_id", "id_type", F.lit("active").alias("status"), F.lit(PROFILE_DT).alias("dt"),
        demo.alias("demo"), device.alias("device"), apps.alias("app_activities"), geo.alias("geo"),
        keywords.alias("keywords"), "clicks", "other_clicks", segments.alias("segments"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents joined to labels, as a profile-like row for training (F7):
    clicks = 1 + toxic when quality = 1 else 0, so label = +1 iff quality = 1."""
    docs = _t(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    labels = _t(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return (docs.join(labels, "doc_id")
            .select(F.col("doc_id").cast("string").alias("raw_id"), "lang", "source", "text",
                    F.when(F.col("quality") == 1, 1 + F.col("toxic")).otherwise(0).cast("long").alias("clicks")))


def support_weights(features_long_df: DataFrame) -> DataFrame:
    """Stand-in for the learner's weight file when a SQL twin is needed:
    weight(ns, token) = number of users holding the feature. T3 then keeps the
    k most supported features (ties by ns, token)."""
    return (features_long_df.groupBy("ns", "token")
            .agg(F.count("*").cast("double").alias("weight")))


def fixed_membership(vertices: DataFrame) -> DataFrame:
    """A membership SQL can recompute (length of the tuple text mod 4), so the
    SQL twins check the graph arithmetic independently of detection."""
    return vertices.select("vid", (F.length("vkey") % 4).cast("long").alias("cid"))
