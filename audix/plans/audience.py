"""End-to-end audience run: the reference's daily sequence as one Spark application.

1. rank segments, take the best segment's members (originals);
2. expand them through the user-cluster matrices, drop the originals;
3. learn feature weights from the day's clicks (or count support), project both sides
   on the top-k features, build the originals' graph;
4. find communities, admit candidates that raise modularity, keep the top N;
5. compare audience size and revenue of the raw and filtered lists.

Intermediate results that feed several later stages are checkpointed into
the cluster's checkpoint directory; the driver receives only counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.functions import features as feats
from audix.operators import assign, communities, evaluate, expansion, graph, learn, segments
from audix.session import cut_lineage
from audix.sources import tables


@dataclass
class RunParams:
    segment_dt: str
    profile_dt: str
    top_segments: int = 10
    segment_rank: int = 1
    require_clicks: bool = False
    top_features: int = 100
    cutoff: float = 0.8
    divisor: int = 1000
    spend_lo: str = ""
    spend_hi: str = ""
    spend_source: str = evaluate.DEFAULT_SOURCE
    method: str = "fastgreedy"
    learn_loss: str | None = "squared"      # None: features are ranked by how many members have them
    counters: dict = field(default_factory=dict)


METHODS = {"fastgreedy": communities.greedy_modularity, "infomap": communities.infomap,
           "leading_eigenvector": communities.leading_eigenvector,
           "label_propagation": communities.label_propagation, "walktrap": communities.walktrap}


def run(spark: SparkSession, segment_revenue: DataFrame, profiles: DataFrame, user_clusters: DataFrame,
        cluster_users: DataFrame, spend: DataFrame, weights: DataFrame | None, p: RunParams) -> dict:
    """Returns the stage outputs as DataFrames plus the driver-side counters."""
    top = segments.segment_topk(segment_revenue, p.segment_dt, p.top_segments)
    best = top.orderBy(F.col("profitability").desc_nulls_last(), F.col("id")).limit(p.segment_rank)
    members = cut_lineage(segments.segment_members(profiles, best, p.profile_dt, p.require_clicks))
    seeds = members.select(F.col("raw_id").alias("sid"))

    expanded = cut_lineage(expansion.expand(seeds, user_clusters, cluster_users))
    fresh = cut_lineage(expansion.expansion_minus_seed(expanded, seeds, profiles, p.profile_dt))

    orig_feat = feats.profile_features(members)
    if weights is None and p.learn_loss:
        # M1-M4: one pass of the learner over the day's profiles and clicks
        rows = learn.training_frame(feats.profile_features(tables.as_of(profiles, p.profile_dt), keep=["clicks"])
                                    .select("*", *feats.label_importance("clicks")))
        weights = learn.named_weights(rows, learn.train_online(rows, p.learn_loss))
    elif weights is None:
        weights = (feats.features_long(orig_feat).groupBy("ns", "token")
                   .agg(F.count("*").cast("double").alias("weight")))
    sel = feats.top_features(weights, p.top_features)
    vertices = cut_lineage(graph.collapse_vertices(feats.project(orig_feat, sel)))
    edges = cut_lineage(graph.build_edges(vertices, p.cutoff))
    # Reported before detection; a near-clique of similar tuples shows here.
    p.counters.update({"vertices": vertices.count(), "edges": edges.count()})
    memb = cut_lineage(METHODS[p.method](edges))

    cand_feat = feats.profile_features(fresh)
    tuples, tmembers = graph.collapse_candidates(feats.project(cand_feat, sel))
    tuples, tmembers = cut_lineage(tuples), cut_lineage(tmembers)
    aff = graph.candidate_affinity(tuples, vertices, memb, p.cutoff)
    gated = assign.gate(aff, graph.community_share(edges, memb))
    admitted = cut_lineage(assign.admitted_users(gated, tmembers))
    n_candidates = fresh.count()
    final = assign.final_audience(admitted, n_candidates, p.divisor)

    spend_w = evaluate.spend_in_window(spend, p.spend_lo, p.spend_hi, p.spend_source)
    compare = evaluate.audience_compare(
        {"raw": expansion.expanded_ids(expanded), "filtered": final.select("sid")}, spend_w)
    p.counters.update({"candidates": n_candidates})
    return {"top_segments": top, "members": members, "expanded": expanded, "fresh": fresh,
            "vertices": vertices, "edges": edges, "membership": memb, "admitted": admitted,
            "final": final, "compare": compare}
