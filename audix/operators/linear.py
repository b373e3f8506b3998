"""Linear models whose weights are a table (M1-M5, M7, M9).

Features are hashed to 2^bits slots. Rows hold the slots that they have; the weights are
rows (model, slot, weight), spread over the cluster like any table, so neither the driver
nor a task holds a vector over the slots. One row of numbers a model reaches the driver.

``fit`` minimises a loss over all rows with limited-memory quasi-Newton steps. The basis of
a step (the last changes of weights and gradients, and the gradient) are columns beside
the weights; the driver gets their inner products, decides on the coefficients of the
direction, and the columns are combined in place. The margin of a row is linear in the
step, so the step's length is found on the rows alone. Several models, as the folds of a
cross-validation, are fitted in one pass: a row has a margin for each of them, and its
gradients travel to the slots together.

``fit_online`` is the one-pass learner: every shard of rows takes an adaptive step after
each row, safe for any importance, and the weights of the shards are averaged by how much
each has seen of a slot.

``Model.save`` and ``load`` keep a model as files.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.functions.joins import split_join
from audix.session import cut_lineage, drop_shared, write_shared

TAU = 0.5
HISTORY = 5                     # changes that a step remembers
SHARD_ROWS = 1_000_000          # rows that the one-pass learner reads in a row
ROUND_ROWS = 100_000            # rows of a shard that a task sorts at a time
LIST_SLOTS = 1 << 14            # slots in a row of the lists between rounds
BROADCAST_BYTES = 32 << 20
MOST_BLOCKS = 32                # blocks of slots, each broadcast for itself
# Lengths tried, as multiples of the step that a quadratic bound of the loss suggests.
LENGTHS = tuple(2.0 ** i for i in range(-6, 7))


@dataclass(frozen=True)
class Loss:
    value: Callable[[Column, Column], Column]        # of margin and label
    slope: Callable[[Column, Column], Column]        # with respect to the margin
    curvature: float                                 # bound of its second derivative


def _sign(y: Column) -> Column:
    return F.when(y > 0, 1.0).otherwise(-1.0)


def _soft(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


LOSSES = {
    "squared": Loss(lambda m, y: (m - y) * (m - y) / 2, lambda m, y: m - y, 1.0),
    "logistic": Loss(lambda m, y: _soft(-_sign(y) * m), lambda m, y: -_sign(y) / (1 + F.exp(_sign(y) * m)), 0.25),
    "hinge": Loss(lambda m, y: F.greatest(1 - _sign(y) * m, F.lit(0.0)),
                  lambda m, y: F.when(_sign(y) * m < 1, -_sign(y)).otherwise(0.0), 1.0),
    "quantile": Loss(lambda m, y: F.when(y > m, TAU * (y - m)).otherwise((1 - TAU) * (m - y)),
                     lambda m, y: F.when(y > m, -TAU).otherwise(1 - TAU), 1.0),
}


@dataclass(frozen=True)
class Model:
    """Weights of one model: (slot, weight) rows."""
    loss: str
    bits: int
    weights: DataFrame

    def save(self, path: str) -> None:
        """The weights and what they belong to, as Parquet; the second is written last, so
        that a model with it is whole."""
        spark = self.weights.sparkSession
        self.weights.select("slot", "weight").write.mode("overwrite").parquet(f"{path}/weights")
        spark.createDataFrame([(self.loss, self.bits)], "loss string, bits int").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/model")

    def score(self, rows: DataFrame, slots: Column) -> DataFrame:
        """``rows`` with ``score``, the sum of the weights of their slots."""
        numbered = cut_lineage(rows.withColumn("_held", slots).withColumn("_at", F.monotonically_increasing_id()))
        slots_known = self.weights.count()
        if 1 < (blocks := _blocks(slots_known, 1)) <= MOST_BLOCKS:
            parts = _dealt(numbered.select(F.col("_at").alias("_row"), F.col("_held").alias("slots")), blocks)
            met = functools.reduce(DataFrame.unionByName, _meet_dealt(parts, self.weights.select("slot", "weight"))) \
                .withColumnRenamed("_row", "_at")
            for p in parts:
                drop_shared(p)
        else:
            met = _meet(numbered.select("_at", F.explode("_held").alias("slot")), self.weights, 1, slots_known)
        total = met.groupBy("_at").agg(F.sum("weight").alias("score"))
        return numbered.drop("_held").join(total, "_at", "left").fillna(0.0, ["score"]).drop("_at")


def load(spark: SparkSession, path: str) -> Model:
    """A saved model."""
    kind = spark.read.parquet(f"{path}/model").first()
    return Model(kind.loss, kind.bits, spark.read.parquet(f"{path}/weights"))


def _meet(pairs: DataFrame, table: DataFrame, numbers: int, slots: int | None = None) -> DataFrame:
    """(row, slot) pairs with the numbers of their slots: a small table (``slots`` rows) is
    broadcast, a larger one block by block, so that no pair is shuffled. Beyond MOST_BLOCKS
    the slots that many rows have are broadcast, and the others are shuffled to."""
    slots = table.count() if slots is None else slots
    blocks = _blocks(slots, numbers)
    if blocks == 1:
        return pairs.join(F.broadcast(table), "slot")
    if blocks > MOST_BLOCKS:
        return split_join(pairs, table, "slot")
    table = cut_lineage(table)
    block = F.pmod(F.xxhash64("slot"), F.lit(blocks))
    found = [pairs.where(block == b).join(F.broadcast(table.where(block == b)), "slot") for b in range(blocks)]
    return functools.reduce(DataFrame.unionByName, found)


def _blocks(slots: int, numbers: int) -> int:
    """Blocks, each small enough to broadcast, of a table of ``slots`` rows."""
    return max(1, math.ceil(slots * (16 + 8 * numbers) / max(1, BROADCAST_BYTES)))


def _dealt(rows: DataFrame, blocks: int) -> list[DataFrame]:
    """(_row, slots) rows written once for every block of slots, so that a pass that meets
    a table block by block reads every slot of a row once, however many blocks there are."""
    def own(b: int) -> Column:
        return F.filter("slots", lambda s: F.pmod(s, F.lit(blocks)) == b)
    return [write_shared(rows.select("_row", own(b).alias("slots")).where(F.size("slots") > 0), "learner-block")
            for b in range(blocks)]


def _meet_dealt(parts: list[DataFrame], table: DataFrame) -> list[DataFrame]:
    """Sums a row, of the slots that it has in a block, of the numbers of ``table``: a written
    table (_row, sums) a block of ``_dealt`` rows. A block is broadcast when the one before is
    done with, so the driver holds one of them, however many there are."""
    blocks, numbers = len(parts), [c for c in table.columns if c != "slot"]
    return [write_shared(p.select("_row", F.explode("slots").alias("slot"))
                         .join(F.broadcast(table.where(F.pmod("slot", F.lit(blocks)) == b)), "slot")
                         .groupBy("_row").agg(*[F.sum(c).alias(c) for c in numbers]), "learner-met")
            for b, p in enumerate(parts)]


def _direction(dots: np.ndarray, held: int) -> np.ndarray:
    """Coefficients of the quasi-Newton direction over the basis s_1.., y_1.., g, from the
    inner products of the basis (``held`` changes, oldest first): the two-loop recursion."""
    size = 2 * held + 1
    delta = np.zeros(size)
    delta[-1] = -1.0
    alpha = np.zeros(held)
    for i in range(held - 1, -1, -1):
        alpha[i] = delta @ dots[:, i] / dots[i, held + i]
        delta[held + i] -= alpha[i]
    if held:
        last = held - 1
        delta *= dots[last, held + last] / dots[held + last, held + last]
    for i in range(held):
        beta = delta @ dots[:, held + i] / dots[i, held + i]
        delta[i] += alpha[i] - beta
    return delta


def fit(rows: DataFrame, loss: str = "squared", steps: int = 10, folds: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(weights, rows) of the models fitted to ``rows`` (label, importance, slots, fold).

    Without ``folds`` one model (number 0) learns from all rows; with them model j learns
    from the rows whose fold is not folds[j]. weights is (model, slot, weight); rows come
    back with an array ``margins`` over the models, their own fold's among them. A slot
    of no training row has weight 0."""
    kind, k = LOSSES[loss], len(folds or [0])
    label, importance = F.col("label"), F.col("importance")

    def taught(j: int) -> Column:
        return F.col("fold") != folds[j] if folds else F.lit(True)
    margin = [F.get("margins", F.lit(j)) for j in range(k)]
    # The slots are written once; what a step changes of a row is kept without them.
    whole = write_shared(rows, "learner-rows")
    held_rows, held_state = whole.select("_row", "slots"), None
    state = whole.drop("slots").withColumn("margins", F.array_repeat(F.lit(0.0), k))
    n_rows, *total = state.agg(F.count("*"), *[F.sum(F.when(taught(j), importance)) for j in range(k)]).first()
    total = [x or 0.0 for x in total]
    few_rows = n_rows * (16 + 8 * k) <= BROADCAST_BYTES

    def gradients(state: DataFrame) -> DataFrame:
        slopes = [F.when(taught(j), importance * kind.slope(margin[j], label)).otherwise(0.0).alias(f"g{j}") for j in range(k)]
        sloped = state.select("_row", *slopes)
        summed = (held_rows.join(F.broadcast(sloped) if few_rows else sloped, "_row")
                  .select(*[f"g{j}" for j in range(k)], F.explode("slots").alias("slot"))
                  .groupBy("slot").agg(*[F.sum(f"g{j}").alias(f"g{j}") for j in range(k)]))
        models = F.explode(F.array(*[F.struct(F.lit(j).alias("model"), F.col(f"g{j}").alias("g")) for j in range(k)]))
        return summed.select("slot", models.alias("m")).select("slot", "m.model", "m.g")

    none = F.array().cast("array<double>")
    weights = write_shared(gradients(state).select("model", "slot", F.lit(0.0).alias("w"), "g", none.alias("s"), none.alias("y")),
                           "learner-weights")
    n_slots = weights.count() // k
    blocks = _blocks(n_slots, k)
    parts = _dealt(held_rows, blocks) if 1 < blocks <= MOST_BLOCKS and steps > 0 else []
    live = set(range(k))
    for step in range(steps):
        held = min(step, HISTORY) if loss != "quantile" else 0
        basis = [F.get("s", F.lit(i)) for i in range(held)] + [F.get("y", F.lit(i)) for i in range(held)] + [F.col("g")]
        size = len(basis)
        upper = [(a, b) for a in range(size) for b in range(a, size)]
        dots = {}
        for r in weights.groupBy("model").agg(*[F.sum(basis[a] * basis[b]).alias(f"d{a}_{b}") for a, b in upper]).collect():
            m = np.zeros((size, size))
            for (a, b), x in zip(upper, r[1:]):
                m[a, b] = m[b, a] = x
            dots[r.model] = m
        coefficients, down = {}, {}
        for j in sorted(live):
            m = dots.get(j)
            # at the optimum but for rounding: a mean gradient of 1e-9 a slot
            if m is None or m[-1, -1] <= 1e-18 * max(total[j], 1.0) ** 2:
                live.discard(j)
                continue
            delta = np.zeros(size)
            good = [i for i in range(held) if m[i, held + i] > 1e-12 * m[held + i, held + i]]
            use = good + [held + i for i in good] + [size - 1]
            delta[use] = _direction(m[np.ix_(use, use)], len(good))
            if delta @ m[:, -1] >= 0:       # no descent: the plain gradient
                delta = np.zeros(size)
                delta[-1] = -1.0
            coefficients[j], down[j] = delta, float(delta @ m[:, -1])
        if not live:
            break
        # Numbers that change from step to step come in arrays, so that the compiled code stays.
        of_model = [F.get(F.lit([float(coefficients[j][i]) if j in coefficients else 0.0 for j in range(k)]), F.col("model"))
                    for i in range(size)]
        moved = weights.withColumn("d", sum((c * b for c, b in zip(of_model, basis)), F.lit(0.0)))
        if k == 1:
            wide = moved.select("slot", F.col("d").alias("d0"))
        else:
            wide = moved.groupBy("slot").agg(*[F.sum(F.when(F.col("model") == j, F.col("d"))).alias(f"d{j}") for j in range(k)])
        written = []
        if parts:
            wide = write_shared(wide, "learner-step")
            written = [wide, *_meet_dealt(parts, wide)]
            met = functools.reduce(DataFrame.unionByName, written[1:])
        else:
            met = _meet(held_rows.select("_row", F.explode("slots").alias("slot")), wide, k, n_slots)
        change = (met.groupBy("_row").agg(F.array(*[F.sum(f"d{j}") for j in range(k)]).alias("change")))
        state = write_shared(state.drop("change").join(change, "_row", "left")
                             .withColumn("change", F.coalesce("change", F.array_repeat(F.lit(0.0), k))), "learner-rows")
        for w in written:
            drop_shared(w)
        if held_state is not None:
            drop_shared(held_state)
        held_state = state
        delta_m = [F.get("change", F.lit(j)) for j in range(k)]
        if loss == "quantile":
            length = {j: 0.5 / math.sqrt(step + 1) / (total[j] or 1.0) for j in live}
        else:
            length = _lengths(state, kind, margin, delta_m, taught, down, live)
        if not live:
            break
        lengths = F.lit([float(length.get(j, 0.0)) for j in range(k)])
        ahead = F.zip_with("change", lengths, lambda c, a: c * a)
        state = state.withColumn("margins", F.zip_with("margins", ahead, lambda m, c: m + c))
        new = gradients(state).select("model", "slot", F.col("g").alias("g_new"))
        went = F.col("d") * F.col("went")
        # the median's steps use no history, so none is kept, moved and written for them
        keep = lambda c, x: c if loss == "quantile" else \
            F.slice(F.concat(c, F.array(x)), F.greatest(F.size(c) + 2 - HISTORY, F.lit(1)), HISTORY)
        after = (moved.withColumn("went", F.get(lengths, F.col("model"))).join(new, ["model", "slot"])
                 .select("model", "slot", (F.col("w") + went).alias("w"), F.col("g_new").alias("g"),
                         keep(F.col("s"), went).alias("s"), keep(F.col("y"), F.col("g_new") - F.col("g")).alias("y")))
        held_weights, weights = weights, write_shared(after, "learner-weights")
        drop_shared(held_weights)
    for p in parts:
        drop_shared(p)
    return weights.select("model", "slot", F.col("w").alias("weight")), state.drop("change")


def _lengths(state: DataFrame, kind: Loss, margin: list[Column], change: list[Column], taught, down: dict[int, float],
             live: set[int]) -> dict[int, float]:
    """The step length of every model: the one that minimises a quadratic bound of the
    loss, or the best of some multiples of it where the bound is not the loss. Models that
    no length improves leave ``live``."""
    order = sorted(live)
    weight = F.col("importance")
    bend = state.agg(*[F.sum(F.when(taught(j), weight * change[j] * change[j])) for j in order]).first()
    base = {j: -down[j] / (kind.curvature * b) for j, b in zip(order, bend) if b}
    live.intersection_update(base)
    if kind is LOSSES["squared"] or not base:
        return base
    scaled = F.zip_with("change", F.lit([float(base.get(j, 0.0)) for j in range(len(change))]), lambda c, b: c * b)
    asked = [(j, t) for j in base for t in (0.0, *LENGTHS)]
    sums = state.withColumn("scaled", scaled).agg(*[
        F.sum(F.when(taught(j), weight * kind.value(margin[j] + t * F.get("scaled", F.lit(j)), F.col("label"))))
        for j, t in asked]).first()
    found: dict[int, list] = {}
    for (j, t), x in zip(asked, sums):
        found.setdefault(j, []).append((x, t * base[j]))
    out = {}
    for j, ((start, _), *others) in found.items():
        best, a = min(others)
        if best < start * (1 - 1e-10):
            out[j] = a
        else:
            live.discard(j)
    return out


def _moved(loss: str, p: float, y: float, a: float) -> float:
    """The margin after an implicit step of weight ``a``: p' = p - a * slope(p')."""
    if loss == "squared":
        return (p + a * y) / (1 + a)
    if loss == "quantile":
        return p + min(a * TAU, y - p) if y > p else p - min(a * (1 - TAU), p - y)
    s = 1.0 if y > 0 else -1.0
    if loss == "hinge":
        return p + s * min(a, 1 - s * p) if s * p < 1 else p
    low, high = 0.0, a                                  # logistic: how far p moves towards s
    for _ in range(40):
        mid = (low + high) / 2
        x = s * p + mid
        if mid < a / (1 + math.exp(min(x, 500))):
            low = mid
        else:
            high = mid
    return p + s * low


def _slope(loss: str, p: float, y: float) -> float:
    if loss == "squared":
        return p - y
    if loss == "quantile":
        return -TAU if y > p else 1 - TAU
    s = 1.0 if y > 0 else -1.0
    if loss == "hinge":
        return -s if s * p < 1 else 0.0
    return -s / (1 + math.exp(min(s * p, 500)))


def _shard(loss: str, rate: float):
    """Adaptive steps over the rows of a shard, in their order: lists of slots with their
    weight and seen, the sum of the squared gradients. A shard goes on from its own lists
    (kind 0), which come before its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, w, seen = 0, np.zeros(0, np.int32), np.zeros(0), np.zeros(0)

        def placed(slots: np.ndarray) -> np.ndarray:
            """Where the ascending, distinct ``slots`` are; new ones are put in with zeros."""
            nonlocal keys, w, seen
            at = np.searchsorted(keys, slots)
            new = np.append(keys, -1)[at] != slots
            if new.any():
                keys, w, seen = np.insert(keys, at[new], slots[new]), np.insert(w, at[new], 0.0), np.insert(seen, at[new], 0.0)
                at = np.searchsorted(keys, slots)
            return at

        def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
            return batch.column(name).flatten().to_numpy()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            given = batch.schema.names
            if "shard" in given:        # rounds follow each other
                shard = batch.column("shard")[0].as_py()
            lists = int((batch.column("kind").to_numpy() == 0).sum()) if "kind" in given else 0
            if lists:
                own, batch = batch.slice(0, lists), batch.slice(lists)
                slots = numbers(own, "slots")
                order = np.argsort(slots)
                at = placed(slots[order])
                w[at], seen[at] = numbers(own, "start")[order], numbers(own, "before")[order]
                if batch.num_rows == 0:
                    continue
            held = batch.column("slots")
            off, slots = held.offsets.to_numpy() - held.offsets[0].as_py(), held.flatten().to_numpy()
            distinct, first, back = np.unique(slots, return_index=True, return_inverse=True)
            known = placed(distinct)
            # not in the first pass: all weights start from 0
            if "start" in given and not batch.column("start").null_count:
                new = (seen[known] == 0) & (w[known] == 0)
                w[known[new]] = numbers(batch, "start")[first[new]]
                seen[known[new]] = numbers(batch, "before")[first[new]]
            index = known[back]
            y, importance = batch.column("label").to_numpy(), batch.column("importance").to_numpy()
            for i in range(batch.num_rows):
                own = index[off[i]:off[i + 1]]
                if not len(own):
                    continue
                p = float(w[own].sum())
                g = importance[i] * _slope(loss, p, y[i])
                if g == 0.0:
                    continue
                seen[own] += g * g
                pace = rate / np.sqrt(seen[own])
                total = float(pace.sum())
                w[own] += pace * ((_moved(loss, p, float(y[i]), importance[i] * total) - p) / total)
        for a in range(0, len(keys), LIST_SLOTS):
            some = slice(a, a + LIST_SLOTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([keys[some]], pa.list_(pa.int32())),
                 *[pa.array([x[some]], pa.list_(pa.float64())) for x in (w, seen)]], ["shard", "slots", "start", "before"])
    return run


def fit_online(rows: DataFrame, loss: str = "squared", passes: int = 1, rate: float = 0.5,
               shard_rows: int = SHARD_ROWS, round_rows: int = ROUND_ROWS) -> DataFrame:
    """(slot, weight) after ``passes`` over ``rows`` (row_id, label, importance, slots). Rows
    are dealt to shards, and ordered in them, by a hash of row_id, so the result does not
    depend on how they are stored. Before another pass every shard starts from the average
    of all: each slot's weights are averaged by the squared gradients that a shard saw.

    A shard is read in rounds, by ranges of that hash, so that a task sorts about
    ``round_rows`` rows at a time; its weights are handed on from round to round, and the
    steps are those of a single round."""
    ready = write_shared(rows.select(F.xxhash64("row_id").alias("order"), "row_id", "label", "importance", "slots"), "learner-online")
    n_rows = ready.count()
    shards = max(1, math.ceil(n_rows / shard_rows))
    rounds = max(1, math.ceil(n_rows / shards / round_rows))
    weights = None
    for _ in range(passes):
        if weights is None:
            given, columns = ready, ["label", "importance", "slots"]
        else:
            known = (_meet(ready.select("row_id", F.posexplode("slots").alias("at", "slot")), weights, 2)
                     .groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("at", "weight", "seen"))).alias("of")))
            given = (ready.join(known, "row_id", "left").withColumn("start", F.coalesce("of.weight", F.array().cast("array<double>")))
                     .withColumn("before", F.coalesce("of.seen", F.array().cast("array<double>"))).drop("of"))
            given, columns = write_shared(given, "learner-given") if rounds > 1 else given, ["label", "importance", "slots", "start", "before"]
        given = given.withColumn("shard", F.pmod(F.hash("order"), F.lit(shards)))
        columns, lists = columns + (["shard"] if rounds > 1 else []), None
        for r in range(rounds):
            low, high = (((i << 64) // rounds - (1 << 63)) for i in (r, r + 1))
            part, own = given.where((F.col("order") >= low) & (F.col("order") <= high - 1)), columns
            if lists is not None:
                part = part.withColumn("kind", F.lit(1)).unionByName(lists.withColumn("kind", F.lit(0)), allowMissingColumns=True)
                own = [*dict.fromkeys([*columns, "start", "before", "kind"])]
            first = ["kind"] if lists is not None else []
            dealt = part.repartitionById(shards, "shard").sortWithinPartitions(*first, "order", "row_id")
            held, lists = lists, write_shared(dealt.select(own).mapInArrow(
                _shard(loss, rate), "shard int, slots array<int>, start array<double>, before array<double>"), "learner-lists")
            if held is not None:
                drop_shared(held)
        found = lists.select(F.inline(F.arrays_zip("slots", "start", "before"))).toDF("slot", "weight", "seen")
        weights = cut_lineage(found.groupBy("slot").agg(
            F.when(F.sum("seen") > 0, F.sum(F.col("weight") * F.col("seen")) / F.sum("seen")).otherwise(0.0).alias("weight"),
            F.sum("seen").alias("seen")))
        drop_shared(lists)
    drop_shared(ready)
    return weights.select("slot", "weight")
