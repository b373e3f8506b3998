"""Connected components of a link table by alternating star contractions.

Every round hangs each vertex's larger neighbours, then its smaller ones, on the
smallest vertex it sees; the rounds end when nothing changes. The rounds are
written to the shared checkpoint folder, no vertex's neighbours are gathered in
one row, and only the count of changed links reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.shared import discard, join_by_key, stored


def _stars(edges: DataFrame, total: int) -> DataFrame:
    """A large-star step, then a small-star step, on edges(u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
    large = stored(join_by_key(both.where(F.col("v") > F.col("u")), low, ["u"], "n", total)
                   .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
    low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return (join_by_key(large, low, ["u"], "n", total).where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(id, component): every vertex of links(a, b) with the smallest id it can
    reach. Self-links and repeated links are allowed; no links, no rows."""
    edges = stored(links.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def mark(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row.n, row.h

    before = mark(edges)
    while before[0]:
        last = edges
        edges = stored(_stars(edges, before[0]), "stars")
        discard(last)
        now = mark(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())
