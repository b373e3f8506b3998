"""Merkle manifest of a data set: subtrees by source, proofs by butterfly exchange.

Every row is a leaf, the SHA-256 (lower-case hex) of its fields. In each source the
leaves stand in ascending order, and every 16 neighbouring nodes become the SHA-256 of
their hex digests, level by level, until one is left: the subroot. The subroots in the
order of their sources make the root in the same way.

Aligned partitions of 4096 leaves hash their three lowest levels by themselves. Above
them there is no pass up and down: in round r, partitions whose numbers differ only in
digit r (base 16) swap the roots that they have, and each of them hashes the common
ancestor, again and again the same one. A partition so holds at the end every sibling
on its way to the top, its upper proof. Where the last run of partitions is incomplete,
its members also answer those that look for a partner beyond the end. A round is one
shuffle of at most 16 short rows a partition, whatever the size of a source.

Defined cases: null sources come first; null doc_ids come first in their source; rows of
equal id stand in the order of their digests, equal rows are leaves of their own; a null
field is ``-``, an empty text ``0:``; an empty table gives no rows. Columns other than
those hashed are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.functions.rank import row_index
from audix.llm.shared import join_by_key, stored

FANOUT = 16
RUNS = FANOUT * FANOUT           # runs of 16 leaves in a partition
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: every field as byte count, colon, value, or ``-`` if null."""
    shown = [c.cast("string") for c in fields]
    return _digest(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
                              for c in shown]))


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its way lead to."""
    return F.aggregate(proof, node, lambda at, s: _digest(F.concat(s["left"], at, s["right"])))


def siblings(proof: Column) -> Column:
    """All siblings of a way, level by level, left to right."""
    return _joined(F.transform(proof, lambda s: F.concat(s["left"], s["right"])))


def _others(nodes: Column, first: Column, at: Column) -> Column:
    """The nodes of the run from ``first`` (0-based) on but the one at ``at`` of it."""
    return F.struct(_joined(F.slice(nodes, first + 1, at)).alias("left"),
                    _joined(F.slice(nodes, first + at + 2, FANOUT - 1 - at)).alias("right"))


def butterfly(parts: DataFrame) -> DataFrame:
    """(tree, part, root, proof) of (tree, part, parts, node): partitions 0 .. parts - 1
    of every tree swap roots until each knows its tree's root and its own way to it."""
    alone = parts.where("parts = 1").select("tree", "part", F.col("node").alias("root"),
                                            F.array().cast(PROOF).alias("proof"))
    most = parts.agg(F.max("parts")).first()[0] or 1
    state = parts.where("parts > 1").withColumn("proof", F.array().cast(PROOF))
    width = 1
    while width < most:
        state = _swap(state, width)
        width *= FANOUT
    return alone.unionByName(state.select("tree", "part", F.col("node").alias("root"), "proof"))


def _swap(state: DataFrame, width: int) -> DataFrame:
    """One round: groups of ``width`` partitions, whose members all know the group's root,
    become groups of 16 times as many."""
    group, low = F.expr(f"part div {width}"), F.col("part") % width
    groups = F.ceil(F.col("parts") / width)
    first = F.expr(f"group div {FANOUT} * {FANOUT}")
    members = F.least(F.lit(width), F.col("parts") - F.col("group") * width)
    # The members of an incomplete group stand for its missing numbers.
    stands = F.when(F.col("to_group") == F.col("group"), F.array("low")).otherwise(
        F.sequence(F.col("low"), F.lit(width - 1).cast("long"), members))
    sent = (state.withColumn("group", group).withColumn("low", low)
            .withColumn("to_group", F.explode(F.sequence(first, F.least(first + FANOUT, groups) - 1)))
            .withColumn("to_low", F.explode(stands))
            .withColumn("to", F.col("to_group") * width + F.col("to_low"))
            .where("to < parts"))
    met = (sent.groupBy("tree", F.col("to").alias("part"), "parts")
           .agg(F.sort_array(F.collect_list(F.struct("group", "node"))).alias("run"),
                F.max(F.when(F.col("to") == F.col("part"), F.col("proof"))).alias("proof")))
    nodes, at = F.col("run.node"), (group % FANOUT).cast("int")
    higher = F.col("parts") > width
    return met.select(
        "tree", "part", "parts",
        F.when(higher, _digest(_joined(nodes))).otherwise(nodes[0]).alias("node"),
        F.when(higher, F.concat("proof", F.array(_others(nodes, F.lit(0), at)))).otherwise(F.col("proof")).alias("proof"))


def partitions(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Of (tree, index, n, node, item): the stored runs of 16 leaves, and the partitions
    (tree, part, parts, low: proofs of their runs, root, proof)."""
    runs = stored(rows.select("tree", "n", F.expr(f"index div {RUNS * FANOUT}").alias("part"),
                              (F.expr(f"index div {FANOUT}") % RUNS).cast("int").alias("run"),
                              (F.col("index") % FANOUT).cast("int").alias("at"), "node", "item")
                  .repartition("tree", "part").groupBy("tree", "n", "part", "run")
                  .agg(F.sort_array(F.collect_list(F.struct("at", "node", "item"))).alias("items"))
                  .withColumn("node", F.when(F.col("n") > 1, _digest(_joined(F.col("items.node"))))
                              .otherwise(F.col("items.node")[0])), f"{name}-runs")
    first = F.col("first")
    inner = (runs.groupBy("tree", "n", "part")
             .agg(F.sort_array(F.collect_list(F.struct("run", "node"))).alias("found"))
             .withColumn("first", F.col("found.node"))
             .withColumn("second", F.when(F.col("n") > FANOUT, F.transform(
                 F.sequence(F.lit(0), F.size(first) - 1, F.lit(FANOUT)),
                 lambda i: _digest(_joined(F.slice(first, i + 1, FANOUT))))).otherwise(first)))
    second = F.col("second")

    def way(j: Column) -> Column:
        own = (F.floor(j / FANOUT)).cast("int")
        return F.filter(F.array(F.when(F.col("n") > FANOUT, _others(first, own * FANOUT, j % FANOUT)),
                                F.when(F.col("n") > RUNS, _others(second, F.lit(0), own))), F.isnotnull)
    parts = stored(inner.select(
        "tree", "part", F.ceil(F.col("n") / (RUNS * FANOUT)).alias("parts"),
        F.when(F.col("n") > RUNS, _digest(_joined(second))).otherwise(second[0]).alias("node"),
        F.transform(F.sequence(F.lit(0), F.size(first) - 1), way).alias("low")), f"{name}-parts")
    upper = stored(butterfly(parts.select("tree", "part", "parts", "node")), f"{name}-upper")
    return runs, parts.drop("node").join(upper, ["tree", "part"])


def ways(runs: DataFrame, parts: DataFrame) -> DataFrame:
    """(item, node, proof and the other columns of ``parts``) of every leaf."""
    others = [c for c in parts.columns if c not in ("tree", "part", "parts", "low", "proof")]
    upper = parts.select("tree", "part", *others, "proof", F.posexplode("low").alias("run", "low"))
    found = runs.select("tree", "n", "part", "run", "items").join(
        upper.withColumn("proof", F.concat("low", "proof")).drop("low"), ["tree", "part", "run"])
    nodes = F.col("items.node")
    return (found.withColumn("nodes", nodes).select(*others, "n", "proof", "nodes", F.explode("items").alias("leaf"))
            .select(*others, "leaf.item", "leaf.node",
                    F.when(F.col("n") > 1, F.concat(F.array(_others(F.col("nodes"), F.lit(0), F.col("leaf.at"))),
                                                    "proof")).otherwise(F.col("proof")).alias("proof")))


def manifest(rows: DataFrame, source: str, order: str, digest: str, item: list[str]) -> DataFrame:
    """Every leaf of ``rows`` with its way to the root: the ``item`` columns, leaf,
    subroot, root and proof, an array of (left, right) siblings from the leaf up."""
    tree = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source)))
    leaves = stored(rows.select(tree.alias("tree"), F.col(order).alias("order"), F.col(digest).alias("node"),
                                F.struct(*item).alias("item")), "merkle-leaves")
    placed = row_index(leaves, ["tree", "order", "node"], "place")
    counts = stored(placed.groupBy("tree").agg(F.count("*").alias("n"), F.min("place").alias("start")), "merkle-counts")
    total = leaves.count()
    indexed = (join_by_key(placed, counts, ["tree"], "n", total)
               .select("tree", (F.col("place") - F.col("start")).alias("index"), "n", "node", "item"))
    runs, parts = partitions(indexed, "merkle")
    parts = parts.withColumnRenamed("root", "subroot").withColumnRenamed("proof", "sub_proof")

    subroots = parts.where("part = 0").select("tree", "parts", "subroot")
    top = row_index(subroots, ["tree"], "place").select(
        F.lit("").alias("tree"), (F.col("place") - 1).alias("index"), F.lit(counts.count()).cast("long").alias("n"),
        F.col("subroot").alias("node"), F.struct("tree", "parts").alias("item"))
    sources = stored(ways(*partitions(top, "merkle-top"))
                     .select("item.tree", F.col("item.parts").alias("sources_parts"), "root", "proof"), "merkle-sources")
    together = join_by_key(parts, sources, ["tree"], "sources_parts", parts.count())
    whole = together.withColumn("proof", F.concat("sub_proof", "proof")).drop("sub_proof", "sources_parts")
    return ways(runs, whole).select("item.*", F.col("node").alias("leaf"), "subroot", "root", "proof")
