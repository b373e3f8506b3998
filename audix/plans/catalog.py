"""Registered queries: (spark, sf_dir) -> DataFrame over the test tables.

Each query wires stand-in inputs (derived by Spark from the given tables) to
the library's operators, with the parameters of a realistic run. Money and
ratios are rounded in the final projection only, so the DuckDB twins in
``oracle.py`` can be compared value for value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.operators import evaluate, expansion, quality, segments
from audix.plans.memo import memoized
from audix.sources import standins, tables

# Run parameters of the registered queries (S21 defaults for the test data).
SEGMENT_DT = standins.SEGMENT_REVENUE_DT
PROFILE_DT = standins.PROFILE_DT
TOP_K_SEGMENTS = 10
SEED_SEGMENT_RANK = 1          # the audience is the best segment's members
SPEND_LO, SPEND_HI = "2024010700", "2024011400"
SPEND_SOURCE = "purchase"
RETENTION_RUN_DATE, RETENTION_DAYS = "20250205", 400


# ---- shared building blocks -------------------------------------------------

profiles = memoized(standins.profiles)
user_cluster_pairs = memoized(standins.user_cluster_pairs)
segment_revenue = memoized(standins.segment_revenue)


@memoized
def user_clusters(spark, sf_dir) -> DataFrame:
    return standins.user_clusters(spark, sf_dir, user_cluster_pairs(spark, sf_dir))


@memoized
def cluster_users(spark, sf_dir) -> DataFrame:
    return standins.cluster_users(spark, sf_dir, user_cluster_pairs(spark, sf_dir))


@memoized
def top_segments(spark, sf_dir) -> DataFrame:
    return segments.segment_topk(segment_revenue(spark, sf_dir), SEGMENT_DT, TOP_K_SEGMENTS)


@memoized
def seed_ids(spark, sf_dir) -> DataFrame:
    """The audience to expand: members (clicks or not) of the best segment."""
    best = (top_segments(spark, sf_dir)
            .orderBy(F.col("profitability").desc_nulls_last(), F.col("id")).limit(SEED_SEGMENT_RANK))
    m = segments.segment_members(profiles(spark, sf_dir), best, PROFILE_DT, require_clicks=False)
    return m.select(F.col("raw_id").alias("sid"))


@memoized
def expanded(spark, sf_dir) -> DataFrame:
    return expansion.expand(seed_ids(spark, sf_dir), user_clusters(spark, sf_dir),
                            cluster_users(spark, sf_dir))


@memoized
def fresh_profiles(spark, sf_dir) -> DataFrame:
    return expansion.expansion_minus_seed(expanded(spark, sf_dir), seed_ids(spark, sf_dir),
                                          profiles(spark, sf_dir), PROFILE_DT)


def spend_window(spark, sf_dir) -> DataFrame:
    return evaluate.spend_in_window(standins.spend(spark, sf_dir), SPEND_LO, SPEND_HI, SPEND_SOURCE)


def audience_lists(spark, sf_dir) -> dict[str, DataFrame]:
    """raw = expansion as written (multiset, K4); filtered = distinct, minus
    the originals, with an active profile."""
    return {"raw": expansion.expanded_ids(expanded(spark, sf_dir)),
            "filtered": fresh_profiles(spark, sf_dir).select(F.col("raw_id").alias("sid"))}


# ---- registered queries -----------------------------------------------------

def q_segment_topk(spark, sf_dir):
    return top_segments(spark, sf_dir).select("id", F.round("profitability", 4).alias("profitability"))


def q_segment_members(spark, sf_dir):
    m = segments.segment_members(profiles(spark, sf_dir), top_segments(spark, sf_dir), PROFILE_DT)
    return m.select("raw_id", "segment_id", "clicks")


def q_seed_clusters(spark, sf_dir):
    return expansion.seed_clusters(seed_ids(spark, sf_dir), user_clusters(spark, sf_dir))


def q_expand_users(spark, sf_dir):
    return expanded(spark, sf_dir)


def q_expand_users_scored(spark, sf_dir):
    sc = expansion.seed_clusters(seed_ids(spark, sf_dir), user_clusters(spark, sf_dir))
    return expansion.expand_users_scored(sc, cluster_users(spark, sf_dir))


def q_expand_by_segment(spark, sf_dir):
    m = segments.segment_members(profiles(spark, sf_dir), top_segments(spark, sf_dir),
                                 PROFILE_DT, require_clicks=False)
    seeds = m.select("segment_id", F.col("raw_id").alias("sid"))
    return expansion.expand_by_segment(seeds, user_clusters(spark, sf_dir),
                                       cluster_users(spark, sf_dir))


def q_expansion_minus_seed(spark, sf_dir):
    return fresh_profiles(spark, sf_dir).select("raw_id")


def q_expansion_counters(spark, sf_dir):
    return quality.expansion_counters(seed_ids(spark, sf_dir), user_clusters(spark, sf_dir),
                                      cluster_users(spark, sf_dir))


def q_audience_size(spark, sf_dir):
    out = None
    for name, ids in audience_lists(spark, sf_dir).items():
        t = evaluate.audience_size(ids).select(F.lit(name).alias("list"), "n_users")
        out = t if out is None else out.unionByName(t)
    return out


def q_audience_revenue_hourly(spark, sf_dir):
    h = evaluate.audience_revenue_hourly(spend_window(spark, sf_dir), audience_lists(spark, sf_dir)["raw"])
    return h.select("hour_id", F.round("revenue", 2).alias("revenue"))


def q_audience_revenue(spark, sf_dir):
    out = None
    sw = spend_window(spark, sf_dir)
    for name, ids in audience_lists(spark, sf_dir).items():
        t = (evaluate.audience_revenue(evaluate.audience_revenue_hourly(sw, ids))
             .select(F.lit(name).alias("list"), F.round("revenue", 2).alias("revenue")))
        out = t if out is None else out.unionByName(t)
    return out


def q_audience_compare(spark, sf_dir):
    c = evaluate.audience_compare(audience_lists(spark, sf_dir), spend_window(spark, sf_dir))
    return c.select("list", "n_users", F.round("revenue", 2).alias("revenue"),
                    F.round("revenue_per_user", 4).alias("revenue_per_user"))


def q_latest_snapshot(spark, sf_dir):
    ev = standins.dated_events(spark, sf_dir)
    return tables.latest_snapshot(ev).select("event_id", "dt", "user_id", "event_type")


def q_retention_window(spark, sf_dir):
    ev = standins.dated_events(spark, sf_dir)
    kept = tables.retention_window(ev, RETENTION_RUN_DATE, RETENTION_DAYS)
    return kept.groupBy("dt").agg(F.count("*").alias("n_rows"))


QUERIES = {
    "segment_topk": q_segment_topk,
    "segment_members": q_segment_members,
    "seed_clusters": q_seed_clusters,
    "expand_users": q_expand_users,
    "expand_users_scored": q_expand_users_scored,
    "expand_by_segment": q_expand_by_segment,
    "expansion_minus_seed": q_expansion_minus_seed,
    "expansion_counters": q_expansion_counters,
    "audience_size": q_audience_size,
    "audience_revenue_hourly": q_audience_revenue_hourly,
    "audience_revenue": q_audience_revenue,
    "audience_compare": q_audience_compare,
    "latest_snapshot": q_latest_snapshot,
    "retention_window": q_retention_window,
}


# ---- features, similarity graph, admission ----------------------------------

from audix.functions import features as feats  # noqa: E402
from audix.operators import assign, graph, simjoin  # noqa: E402

GRAPH_TOP_K = 100           # evaluation default of the reference
GRAPH_CUTOFF = simjoin.DEFAULT_CUTOFF
TEST_AUDIENCE_DIVISOR = 10     # reference uses 1000 (K15); sf0.01 has ~200 candidates


@memoized
def original_members(spark, sf_dir) -> DataFrame:
    best = (top_segments(spark, sf_dir)
            .orderBy(F.col("profitability").desc_nulls_last(), F.col("id")).limit(SEED_SEGMENT_RANK))
    return segments.segment_members(profiles(spark, sf_dir), best, PROFILE_DT, require_clicks=False)


@memoized
def original_features(spark, sf_dir) -> DataFrame:
    return feats.profile_features(original_members(spark, sf_dir))


@memoized
def selected_features(spark, sf_dir) -> DataFrame:
    w = standins.support_weights(feats.features_long(original_features(spark, sf_dir)))
    return feats.top_features(w, GRAPH_TOP_K)


@memoized
def graph_parts(spark, sf_dir):
    sel = selected_features(spark, sf_dir)
    proj = feats.project(original_features(spark, sf_dir), sel)
    vertices = graph.collapse_vertices(proj)
    edges = graph.build_edges(vertices, GRAPH_CUTOFF)
    return sel, vertices, edges


@memoized
def candidate_parts(spark, sf_dir):
    sel = selected_features(spark, sf_dir)
    cand = feats.profile_features(fresh_profiles(spark, sf_dir))
    tuples, members = graph.collapse_candidates(feats.project(cand, sel))
    return cand, tuples, members


def _keyed_edges(vertices, edges):
    kv = vertices.select("vid", "vkey")
    e = (edges.join(kv.withColumnRenamed("vid", "src").withColumnRenamed("vkey", "a"), "src")
         .join(kv.withColumnRenamed("vid", "dst").withColumnRenamed("vkey", "b"), "dst"))
    return e.select(F.least("a", "b").alias("src_key"), F.greatest("a", "b").alias("dst_key"), "w")


def q_features_long(spark, sf_dir):
    return feats.features_long(feats.profile_features(profiles(spark, sf_dir)))


def q_graph_lines(spark, sf_dir):
    m = segments.segment_members(profiles(spark, sf_dir), top_segments(spark, sf_dir), PROFILE_DT)
    f = feats.profile_features(m, keep=["segment_id"])
    return f.where(F.col("sid").isNotNull()).select("segment_id", feats.graph_line().alias("value"))


def q_feature_lines_roundtrip(spark, sf_dir):
    """The graph lines parsed back into (sid, ns, token)."""
    lines = q_graph_lines(spark, sf_dir).select("value")
    return feats.features_long(feats.parse_feature_lines(lines))


def training_features(spark, sf_dir) -> DataFrame:
    """Labelled documents as rows of training lines, with their source."""
    d = standins.labelled_documents(spark, sf_dir)
    toks = F.filter(F.transform(feats.split_ws(F.lower("text")), lambda t: feats.clean_keyword(t)),
                    lambda t: t != "")
    return d.select(F.col("raw_id").alias("doc_id"), "clicks", "source",
                    F.array("lang").alias("demo"), F.array("source").alias("device"),
                    F.lit(None).cast("array<string>").alias("app_activities"),
                    F.lit(None).cast("array<string>").alias("geo"),
                    F.array_sort(F.array_distinct(toks)).alias("keywords"))


def q_training_rows(spark, sf_dir):
    rows = training_features(spark, sf_dir).select("*", *feats.label_importance("clicks"))
    return rows.select("doc_id", "label", "importance", feats.training_line().alias("value"))


def q_feature_topk(spark, sf_dir):
    return selected_features(spark, sf_dir)


def q_vertex_collapse(spark, sf_dir):
    _, v, _ = graph_parts(spark, sf_dir)
    return v.select("vkey", "k")


def q_jaccard_pairs(spark, sf_dir):
    docs = tables.read_table(spark, sf_dir, "documents").select(
        "doc_id", feats.split_ws(F.lower("text")).alias("tokens"))
    p = simjoin.similarity_self_join(docs, "doc_id", "tokens", GRAPH_CUTOFF)
    return p.select(F.col("id_a").alias("doc_a"), F.col("id_b").alias("doc_b"),
                    F.round("jaccard", 6).alias("jaccard"))


def q_jaccard_cross(spark, sf_dir):
    _, v, _ = graph_parts(spark, sf_dir)
    _, tuples, _ = candidate_parts(spark, sf_dir)
    left = tuples.select(F.col("tid").alias("id"), feats.namespaced_tokens().alias("tokens"))
    right = v.select(F.col("vid").alias("id"), feats.namespaced_tokens().alias("tokens"))
    p = simjoin.similarity_join(left, right, cutoff=GRAPH_CUTOFF)
    return (p.join(tuples.select(F.col("tid").alias("id_a"), "tkey"), "id_a")
            .join(v.select(F.col("vid").alias("id_b"), "vkey"), "id_b")
            .select("tkey", "vkey", F.round("jaccard", 6).alias("jaccard")))


def q_graph_edges(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    return _keyed_edges(v, e)


def q_graph_summary(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    return graph.graph_summary(v, e)


def q_vertex_degree(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    return graph.degree(e).join(v.select("vid", "vkey"), "vid").select("vkey", "degree")


def q_community_share(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    s = graph.community_share(e, standins.fixed_membership(v))
    return s.select("cid", F.round("a", 9).alias("a"))


def q_modularity_of(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    return graph.modularity(e, standins.fixed_membership(v)).select(F.round("modularity", 9).alias("modularity"))


def q_community_affinity(spark, sf_dir):
    _, v, _ = graph_parts(spark, sf_dir)
    _, tuples, _ = candidate_parts(spark, sf_dir)
    aff = graph.candidate_affinity(tuples, v, standins.fixed_membership(v), GRAPH_CUTOFF)
    return aff.join(tuples.select("tid", "tkey"), "tid").select("tkey", "cid", "e")


def _admitted(spark, sf_dir):
    _, v, e = graph_parts(spark, sf_dir)
    cand, tuples, members = candidate_parts(spark, sf_dir)
    memb = standins.fixed_membership(v)
    aff = graph.candidate_affinity(tuples, v, memb, GRAPH_CUTOFF)
    gated = assign.gate(aff, graph.community_share(e, memb))
    return cand, assign.admitted_users(gated, members)


def q_intake_counts(spark, sf_dir):
    return assign.intake_counts(original_members(spark, sf_dir), fresh_profiles(spark, sf_dir))


def q_admit_users(spark, sf_dir):
    _, users = _admitted(spark, sf_dir)
    return users.select("sid", "cid", F.round("gain", 6).alias("gain"))


def q_final_audience(spark, sf_dir):
    cand, users = _admitted(spark, sf_dir)
    top = assign.final_audience(users, cand.count(), TEST_AUDIENCE_DIVISOR)
    return top.select("sid", F.round("gain", 6).alias("gain"))


QUERIES.update({
    "features_long": q_features_long,
    "graph_lines": q_graph_lines,
    "feature_lines_roundtrip": q_feature_lines_roundtrip,
    "training_rows": q_training_rows,
    "feature_topk": q_feature_topk,
    "vertex_collapse": q_vertex_collapse,
    "jaccard_pairs": q_jaccard_pairs,
    "jaccard_cross": q_jaccard_cross,
    "graph_edges": q_graph_edges,
    "vertex_degree": q_vertex_degree,
    "graph_summary": q_graph_summary,
    "community_share": q_community_share,
    "modularity_of": q_modularity_of,
    "community_affinity": q_community_affinity,
    "intake_counts": q_intake_counts,
    "admit_users": q_admit_users,
    "final_audience": q_final_audience,
})


# ---- learning and community detection (rows-only: no SQL twin) -------------

from audix.operators import communities, learn, linear  # noqa: E402

CV_FOLDS = 10
CV_PASSES = 10


@memoized
def doc_training(spark, sf_dir) -> DataFrame:
    """Labelled documents as training rows: label/importance by F7, features
    demo = lang, device = source, keywords = cleaned distinct tokens."""
    d = standins.labelled_documents(spark, sf_dir)
    toks = F.filter(F.transform(feats.split_ws(F.lower("text")), lambda t: feats.clean_keyword(t)),
                    lambda t: t != "")
    rows = d.select(F.col("raw_id").alias("sid"), *feats.label_importance("clicks"),
                    F.array("lang").alias("demo"), F.array("source").alias("device"),
                    F.array().cast("array<string>").alias("app_activities"),
                    F.array().cast("array<string>").alias("geo"),
                    F.array_distinct(toks).alias("keywords"))
    return learn.training_frame(rows)


def _learn(loss):
    def q(spark, sf_dir):
        _, w = learn.train(doc_training(spark, sf_dir), loss, CV_PASSES)
        return w
    q.__name__ = f"q_learn_weights_{loss}"
    return q


def one_hot_training(spark, sf_dir) -> DataFrame:
    """Labelled documents with their language as the only feature: the optimum
    of every loss is closed form, so SQL can state it."""
    rows = standins.labelled_documents(spark, sf_dir).where("lang is not null").select(
        F.col("raw_id").alias("sid"), *feats.label_importance("clicks"), F.array("lang").alias("demo"),
        *[F.array().cast("array<string>").alias(ns) for ns in feats.NAMESPACES[1:]])
    return learn.training_frame(rows)


def _learn_one_hot(loss):
    """Squared: weighted mean label. Logistic: log odds. Hinge and median: the
    sign of the weighted majority."""
    def q(spark, sf_dir):
        _, w = learn.train(one_hot_training(spark, sf_dir), loss, 50)
        value = F.round("weight", 2) if loss in ("squared", "logistic") else F.signum("weight")
        return w.select("ns", "token", value.alias("weight"))
    q.__name__ = f"q_learn_one_hot_{loss}"
    return q


LONG_TEXT = 1000


def two_feature_training(spark, sf_dir) -> DataFrame:
    """Labelled documents with two features that overlap, ``demo^en`` and
    ``keywords^long``: the optimum of squared loss solves two equations."""
    rows = standins.labelled_documents(spark, sf_dir)
    def feature(when, token):
        return F.when(when, F.array(F.lit(token))).otherwise(F.array().cast("array<string>"))
    arrays = {"demo": feature(F.col("lang") == "en", "en"), "keywords": feature(F.length("text") >= LONG_TEXT, "long")}
    return learn.training_frame(rows.select(
        F.col("raw_id").alias("sid"), *feats.label_importance("clicks"),
        *[arrays.get(ns, F.array().cast("array<string>")).alias(ns) for ns in feats.NAMESPACES]))


def q_learn_two_features(spark, sf_dir):
    """M1-M3: weights of two overlapping features, kept as a table of slots."""
    _, w = learn.train(two_feature_training(spark, sf_dir), "squared", CV_PASSES)
    return w.select("ns", "token", F.round("weight", 5).alias("weight"))


def q_predict_saved(spark, sf_dir):
    """M5: a model is trained, saved, loaded and used: score and class of every row."""
    rows = two_feature_training(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex[:12]}"
    learn.train_model(rows, "squared", CV_PASSES).save(path)
    scored = learn.binary_prediction(learn.predict(linear.load(spark, path), rows))
    return scored.select("row_id", F.round("score", 5).alias("score"), F.col("pred").cast("int").alias("pred"))


def q_learn_online(spark, sf_dir):
    """M2 + M4: one adaptive pass over the rows, as a feature dump is trained."""
    rows = doc_training(spark, sf_dir)
    return learn.named_weights(rows, learn.train_online(rows, "squared"))


def q_learn_online_one_hot(spark, sf_dir):
    """One pass over rows with one feature: the sign of every language's weight."""
    rows = one_hot_training(spark, sf_dir)
    w = learn.named_weights(rows, learn.train_online(rows, "logistic", passes=3))
    return w.select("ns", "token", F.signum("weight").alias("weight"))


def q_feature_topk_learned(spark, sf_dir):
    _, w = learn.train(doc_training(spark, sf_dir), "squared", CV_PASSES)
    return feats.top_features(w, GRAPH_TOP_K)


def q_kfold_sizes(spark, sf_dir):
    return learn.fold_sizes(doc_training(spark, sf_dir), CV_FOLDS)


def q_cv_accuracy(spark, sf_dir):
    return learn.cross_validate(doc_training(spark, sf_dir), "squared", CV_FOLDS, CV_PASSES)


def _communities(method):
    def q(spark, sf_dir):
        _, v, e = graph_parts(spark, sf_dir)
        memb = method(e)
        return memb.join(v.select("vid", "vkey"), "vid").select("vkey", "cid")
    q.__name__ = f"q_communities_{method.__name__}"
    return q


def q_community_compare(spark, sf_dir):
    _, _, e = graph_parts(spark, sf_dir)
    return communities.compare_methods(e)


def q_admit_users_detected(spark, sf_dir):
    """The full gate: communities found by G6 instead of a fixed membership."""
    _, v, e = graph_parts(spark, sf_dir)
    _, tuples, members = candidate_parts(spark, sf_dir)
    memb = communities.greedy_modularity(e)
    aff = graph.candidate_affinity(tuples, v, memb, GRAPH_CUTOFF)
    gated = assign.gate(aff, graph.community_share(e, memb))
    return assign.admitted_users(gated, members).select("sid", "gain")


QUERIES.update({
    "kfold_sizes": q_kfold_sizes,
    "learn_weights": _learn("squared"),
    "learn_weights_logistic": _learn("logistic"),
    "learn_weights_hinge": _learn("hinge"),
    "learn_weights_quantile": _learn("quantile"),
    "learn_one_hot_squared": _learn_one_hot("squared"),
    "learn_one_hot_logistic": _learn_one_hot("logistic"),
    "learn_one_hot_hinge": _learn_one_hot("hinge"),
    "learn_one_hot_quantile": _learn_one_hot("quantile"),
    "learn_two_features": q_learn_two_features,
    "predict_saved": q_predict_saved,
    "learn_online": q_learn_online,
    "learn_online_one_hot": q_learn_online_one_hot,
    "feature_topk_learned": q_feature_topk_learned,
    "cv_accuracy": q_cv_accuracy,
    "communities_greedy": _communities(communities.greedy_modularity),
    "communities_label_prop": _communities(communities.label_propagation),
    "communities_eigen": _communities(communities.leading_eigenvector),
    "communities_map": _communities(communities.infomap),
    "communities_walk": _communities(communities.walktrap),
    "community_compare": q_community_compare,
    "admit_users_detected": q_admit_users_detected,
})


# ---- sinks: written to the shared folder, read back --------------------------

import uuid  # noqa: E402

from audix.session import checkpoint_dir  # noqa: E402
from audix.sources import sinks  # noqa: E402


def _output(spark, name: str) -> str:
    """A dated output of its own in the cluster's shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/sink-{name}-{uuid.uuid4().hex[:12]}"


def q_sink_by_key(spark, sf_dir):
    """Gzip text by sanitised key; a first run with all
    customers, then one without the last segment, whose folder is gone."""
    key = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.substring("c_mktsegment", 1, 2), F.lit("/"),
                                                        F.substring("c_mktsegment", 3, 20)))
    rows = tables.read_table(spark, sf_dir, "customer").select(key.alias("segment"), "c_custkey", "c_nationkey")
    out = _output(spark, "by-key")
    sinks.write_partitioned_text(rows, out, ["segment"], compression="gz")
    sinks.write_partitioned_text(rows.where("segment is null or segment <> 'MA/CHINERY'"), out, ["segment"], compression="gz")
    return spark.read.schema("value string, segment string").text(out).select("segment", "value")


def q_sink_two_keys(spark, sf_dir):
    """Two key levels, the keys kept in the lines."""
    rows = tables.read_table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), (F.col("s_suppkey") % 3).alias("part"), "s_suppkey")
    out = _output(spark, "two-keys")
    sinks.write_partitioned_text(rows, out, ["nation", "part"], delimiter=",", remove_keys=False)
    return spark.read.schema("value string, nation string, part string").text(out).select("nation", "part", "value")


def q_sink_graph_lines(spark, sf_dir):
    """Graph lines by segment, bzip2; a first run under other segments is replaced."""
    members = segments.segment_members(profiles(spark, sf_dir), top_segments(spark, sf_dir), PROFILE_DT)
    f = feats.profile_features(members, keep=["segment_id"])
    out = _output(spark, "graph-lines")
    sinks.write_graph_lines(f.withColumn("segment_id", F.concat("segment_id", F.lit("/old"))), out, compression="bz2")
    sinks.write_graph_lines(f, out, compression="bz2")
    return spark.read.schema("value string, segment_id string").text(out).select("segment_id", "value")


def q_sink_graph_features(spark, sf_dir):
    """The written graph lines read again as (sid, ns, token)."""
    return feats.features_long(feats.parse_feature_lines(q_sink_graph_lines(spark, sf_dir).select("value")))


def q_sink_training_lines(spark, sf_dir):
    """Training lines by source, gzip, written twice and read back."""
    rows = training_features(spark, sf_dir).withColumnRenamed("source", "segment_id")
    out = _output(spark, "training-lines")
    for _ in range(2):
        sinks.write_training_lines(rows, out, compression="gz")
    return spark.read.schema("value string, segment_id string").text(out).select("segment_id", "value")


def q_sink_retention(spark, sf_dir):
    """Events by day, of which a run deletes one day, and another run all days up
    to RETENTION_DAYS before it: (dt, n) of what is left."""
    ev = tables.read_table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("dt"), "event_id")
    out = _output(spark, "dated")
    ev.write.partitionBy("dt").parquet(out)
    sinks.delete_dated(spark, out, RETENTION_RUN_DATE, RETENTION_DAYS - 3)
    sinks.delete_dated(spark, out, RETENTION_RUN_DATE, RETENTION_DAYS, exact_day_only=False)
    return spark.read.schema("event_id long, dt string").parquet(out).groupBy("dt").agg(F.count("*").alias("n"))


def q_sink_plain(spark, sf_dir):
    """Tab-separated text and gzip ids, read back as id lists."""
    ids = tables.read_table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("sid"))
    text, gz = _output(spark, "text"), _output(spark, "ids")
    sinks.write_text(ids.withColumn("n", F.lit(1)), text)
    sinks.write_ids_gzip(ids, gz)
    return (tables.read_id_list(spark, text).select(F.lit("text").alias("sink"), "sid")
            .unionByName(tables.read_id_lines(spark, gz).select(F.lit("gzip").alias("sink"), "sid")))


def q_sink_records(spark, sf_dir):
    """Record files; a shrinking rerun replaces them, an empty rerun
    leaves none. (run, rows read back)."""
    orders = tables.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    out, counts = _output(spark, "records"), []
    for run, rows in (("full", orders), ("urgent", orders.where("o_orderpriority = '1-URGENT'")), ("none", orders.where("false"))):
        sinks.write_records(rows, out)
        left = 0 if run == "none" and not sinks.output_exists(spark, out) else spark.read.schema(orders.schema).parquet(out).count()
        counts.append((run, left))
    return spark.createDataFrame(counts, "run string, n_rows long")


QUERIES.update({"sink_by_key": q_sink_by_key, "sink_two_keys": q_sink_two_keys, "sink_plain": q_sink_plain,
                "sink_records": q_sink_records, "sink_graph_lines": q_sink_graph_lines,
                "sink_graph_features": q_sink_graph_features, "sink_training_lines": q_sink_training_lines,
                "sink_retention": q_sink_retention})


# ---- detection and learned features, checked --------------------------------

def _communities_check(method):
    """One row: vertices, those with exactly one community, and whether the
    partition beats the one of single vertices (modularity)."""
    def q(spark, sf_dir):
        _, v, e = graph_parts(spark, sf_dir)
        memb = method(e)
        single = v.select("vid", F.col("vid").alias("cid"))
        better = (graph.modularity(e, memb).first()[0] or 0.0) >= (graph.modularity(e, single).first()[0] or 0.0)
        once = memb.groupBy("vid").agg(F.count("*").alias("n")).join(v.select("vid"), "vid").where("n = 1")
        return (v.agg(F.count("*").alias("n_vertices"))
                .withColumn("n_once", F.lit(once.count())).withColumn("better", F.lit(better)))
    q.__name__ = f"q_check_{method.__name__}"
    return q


@memoized
def learned_features(spark, sf_dir) -> DataFrame:
    """T3 on weights learned from the users' own profile lines and clicks."""
    rows = feats.profile_features(profiles(spark, sf_dir), keep=["clicks"]).select("*", *feats.label_importance("clicks"))
    _, w = learn.train(learn.training_frame(rows), "squared", CV_PASSES)
    return feats.top_features(w, GRAPH_TOP_K)


def q_vertices_learned(spark, sf_dir):
    """G1 on the learned selection: the originals' distinct feature tuples."""
    proj = feats.project(original_features(spark, sf_dir), learned_features(spark, sf_dir))
    return graph.collapse_vertices(proj).select("vkey", "k")


def q_admit_users_learned(spark, sf_dir):
    """The whole chain on learned features: graph, communities, gate."""
    sel = learned_features(spark, sf_dir)
    vertices = graph.collapse_vertices(feats.project(original_features(spark, sf_dir), sel))
    edges = graph.build_edges(vertices, GRAPH_CUTOFF)
    cand = feats.profile_features(fresh_profiles(spark, sf_dir))
    tuples, members = graph.collapse_candidates(feats.project(cand, sel))
    memb = communities.greedy_modularity(edges)
    gated = assign.gate(graph.candidate_affinity(tuples, vertices, memb, GRAPH_CUTOFF), graph.community_share(edges, memb))
    return assign.admitted_users(gated, members).select("sid", "gain")


CHECKED = {"greedy": communities.greedy_modularity, "label_prop": communities.label_propagation,
           "eigen": communities.leading_eigenvector, "map": communities.infomap, "walk": communities.walktrap}
QUERIES.update({f"communities_{name}_check": _communities_check(method) for name, method in CHECKED.items()})
QUERIES.update({"vertices_learned": q_vertices_learned, "admit_users_learned": q_admit_users_learned})
