"""Row-reason counters of the expansion (A14), as a (stage, counter, value) table.

The reference increments job counters while its two jobs run. Here they are observed
metrics of the expansion itself: every stage is tapped where its rows pass, the
expansion is written once, and the counters of that one run are read afterwards.
To see the records without a partner, the two joins keep both sides.
"""

from __future__ import annotations

from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from audix.operators.expansion import _nonempty, clean_seeds, cluster_sid_rows, user_cluster_rows
from audix.session import write_shared


def _counted(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def _seen(observation: Observation) -> dict:
    """The values of a tap. One that Spark left out, its input known to be empty, has none."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


@contextmanager
def _every_stage(spark):
    """Plans in which a side without rows does not make Spark leave out the others, whose
    taps would then see nothing."""
    rules = {"spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation",
             "spark.sql.adaptive.optimizer.excludedRules":
                 "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}
    before = {k: spark.conf.get(k, None) for k in rules}
    for k, rule in rules.items():
        spark.conf.set(k, ",".join(filter(None, [before[k], rule])))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Counters:
    """Counters by stage, tapped from frames, in the order of the taps."""

    def __init__(self):
        self.taps: list[tuple[str, list[str], Observation]] = []

    def tap(self, df: DataFrame, stage: str, **counters: Column) -> DataFrame:
        seen = Observation()
        self.taps.append((stage, list(counters), seen))
        return df.observe(seen, *[c.alias(name) for name, c in counters.items()])

    def table(self, spark) -> DataFrame:
        """(stage, counter, value) of the run."""
        rows = [(stage, name, seen.get(name) or 0) for stage, names, o in self.taps for seen in [_seen(o)] for name in names]
        return spark.createDataFrame(rows, "stage string, counter string, value long")


def expand_counted(seeds: DataFrame, user_clusters: DataFrame, cluster_users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The expansion, distinct (cluster_id, sid), written to the shared folder, and the
    counters of the run that wrote it."""
    c = Counters()
    is_sid = F.col("id_type") == "SID"
    matrix = c.tap(user_clusters, "user_to_cluster_map",
                   NonSidId=_counted(F.coalesce(F.col("id_type") != "SID", F.lit(True))),
                   EmptyClusterIdList=_counted(is_sid & ~_nonempty("cluster_ids")),
                   NumOfClusterIdList=_counted(is_sid & _nonempty("cluster_ids")))
    events = c.tap(clean_seeds(seeds), "seed_map", SeedRecord=F.count("*"))
    # one row per id: its clusters, if it has a list, and whether it is a seed
    listed = user_cluster_rows(matrix).select("sid", "cids", F.lit(False).alias("seed"))
    ids = (listed.unionByName(events.select("sid", F.lit(None).cast(listed.schema["cids"].dataType).alias("cids"),
                                            F.lit(True).alias("seed")))
           .groupBy("sid").agg(F.max("seed").alias("seed"), F.count("cids").alias("lists"),
                               F.array_distinct(F.flatten(F.collect_list("cids"))).alias("cids")))
    has_list = F.col("lists") > 0
    ids = c.tap(ids, "user_to_cluster_reduce", ValidRecord=_counted(has_list & F.col("seed")),
                EmptyUserId=_counted(has_list & ~F.col("seed")), EmptyClusterId=_counted(F.col("seed") & ~has_list))
    clusters = c.tap(cluster_users, "cluster_to_user_map",
                     EmptyRawIds=_counted(~_nonempty("user_raw_ids")),
                     EmptySidList=_counted(_nonempty("user_raw_ids") & (F.size(F.filter(
                         "user_raw_ids", lambda x: (x["id_type"] == "SID") & x["raw_id"].isNotNull())) == 0)))
    payload = c.tap(ids.where(has_list & F.col("seed")).select(F.explode("cids").alias("cluster_id")),
                    "cluster_payload_map", ClusterPayloadRecord=F.count("*"))
    reached = payload.distinct().withColumn("event", F.lit(True))
    met = c.tap(cluster_sid_rows(clusters).join(reached, "cluster_id", "full_outer"), "cluster_to_user_reduce",
                NoEventsInClusterId=_counted(F.col("sids").isNotNull() & F.col("event").isNull()),
                NoMatchClusterId=_counted(F.col("event") & F.col("sids").isNull()),
                MatchedClusterId=_counted(F.col("event") & F.col("sids").isNotNull()))
    found = c.tap(met.where(F.col("event") & F.col("sids").isNotNull())
                  .select("cluster_id", F.explode(F.array_distinct("sids")).alias("sid")),
                  "cluster_to_user_output", ValidRecord=F.count("*"))
    with _every_stage(seeds.sparkSession):
        expanded = write_shared(found.distinct(), "expanded")
    return expanded, c.table(seeds.sparkSession)


def expansion_counters(seeds: DataFrame, user_clusters: DataFrame, cluster_users: DataFrame) -> DataFrame:
    """(stage, counter, value) of an expansion."""
    return expand_counted(seeds, user_clusters, cluster_users)[1]
