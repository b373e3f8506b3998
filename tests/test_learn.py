"""Fold sizes (K6) and a planted sparse model."""

import random

import pytest
from pyspark.sql import functions as F

from audix.functions.joins import split_join
from audix.functions.rank import row_index
from audix.operators import learn, linear


def frame(spark, n):
    return spark.createDataFrame([(str(i), 1.0, 1.0, ["keywords^a"]) for i in range(n)],
                                 "row_id string, label double, importance double, feats array<string>")


@pytest.mark.parametrize("n,k,folds", [(11, 10, 6), (7, 10, 7), (20, 10, 10)])
def test_fold_sizes(spark, n, k, folds):
    sizes = {r.fold: r.n for r in learn.fold_sizes(frame(spark, n), k).collect()}
    assert len(sizes) == folds and sum(sizes.values()) == n
    per = -(-n // k)
    assert all(v == per for f, v in sizes.items() if f != max(sizes))


def test_row_index(spark):
    df = spark.range(0, 1000).repartition(7).withColumn("key", (F.col("id") * 7919) % 1000)
    got = [r.rank for r in row_index(df, [F.col("key")]).orderBy("key").collect()]
    assert got == list(range(1, 1001))


def planted(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toks = {f"keywords^n{rng.randrange(40)}" for _ in range(4)}
        pos = rng.random() < 0.5
        toks.add("demo^good" if pos else "demo^bad")
        rows.append((str(i), 1.0 if pos else -1.0, 1.0, sorted(toks)))
    return spark.createDataFrame(rows, "row_id string, label double, importance double, feats array<string>")


@pytest.mark.parametrize("loss", ["squared", "logistic", "hinge", "quantile"])
def test_planted_model(spark, loss):
    tr = planted(spark)
    predict, w = learn.train(tr, loss, passes=10)
    top = [(r.ns, r.token) for r in w.orderBy(F.abs("weight").desc(), "ns", "token").limit(2).collect()]
    assert set(top) == {("demo", "good"), ("demo", "bad")}
    assert learn.accuracy(predict(tr)) > 0.95


def test_cross_validate(spark):
    cv = {r.fold: r for r in learn.cross_validate(planted(spark, 60), "logistic", k=4, passes=5).collect()}
    assert set(cv) == {-1, 0, 1, 2, 3} and cv[-1].n_test == 60 and cv[-1].accuracy > 0.9


def test_slots_keep_names(spark):
    tr = planted(spark)
    _, w = learn.train(tr, "logistic", passes=10, bits=18)
    names = {(r.ns, r.token) for r in w.collect()}
    assert names <= {tuple(f.split("^")) for r in tr.collect() for f in r.feats} and len(names) > 30
    # two features in one slot share its weight, and none is lost
    _, w = learn.train(tr, "logistic", passes=10, bits=3)
    assert w.count() == len({f for r in tr.collect() for f in r.feats})


def test_default_slots_tell_features_apart(spark):
    """Two features that meet in one of 2^18 slots have their own weights."""
    names = spark.range(4000).select(F.concat(F.lit("demo^f"), "id").alias("f"))
    at = names.select("f", learn.slot(F.col("f"), 18).alias("low"), learn.slot(F.col("f"), 24).alias("high"))
    a, b = at.alias("x").join(at.alias("y"), "low").where("x.high < y.high").select("x.f", "y.f").first()
    tr = spark.createDataFrame([(str(i), 1.0 if i % 3 else -1.0, 1.0, [a if i % 3 else b]) for i in range(30)],
                               "row_id string, label double, importance double, feats array<string>")
    predict, w = learn.train(tr, "squared", passes=10)
    got = {f"demo^{r.token}": r.weight for r in w.collect()}
    assert got == pytest.approx({a: 1.0, b: -1.0}, abs=1e-3) and learn.accuracy(predict(tr)) == 1.0


def test_slot_is_the_vector_index(spark):
    df = spark.createDataFrame([([f"demo^{x}"],) for x in ("a", "bc", "éö", "日本", "long token"[:4], "x" * 17)], "feats array<string>")
    transform, _ = learn.vectorize(df, 10)
    for r in transform(df).withColumn("slot", learn.slot(F.col("feats")[0], 10)).collect():
        assert list(r.features.indices) == [r.slot]


def test_one_hot_optimum(spark):
    """One feature a row: the optimum of every loss is closed form."""
    rows = [("a", 1.0, 3.0), ("a", -1.0, 1.0), ("b", 1.0, 1.0), ("b", -1.0, 4.0), ("b", -1.0, 1.0)]
    tr = spark.createDataFrame([(str(i), y, k, [f"demo^{f}"]) for i, (f, y, k) in enumerate(rows)],
                               "row_id string, label double, importance double, feats array<string>")
    def weights(loss):
        return {r.token: r.weight for r in learn.train(tr, loss, passes=50)[1].collect()}
    assert weights("squared") == pytest.approx({"a": 0.5, "b": -4 / 6}, abs=1e-4)
    import math
    assert weights("logistic") == pytest.approx({"a": math.log(3), "b": -math.log(5)}, abs=1e-3)
    for loss in ("hinge", "quantile"):
        w = weights(loss)
        assert w["a"] > 0 > w["b"]


def test_folds_together_like_refits(spark):
    """Every fold's accuracy is that of a model trained on the others alone."""
    rows = planted(spark, 120, seed=11).withColumn("importance", F.lit(1.0) + F.length("row_id"))
    for loss in ("squared", "logistic"):
        got = {r.fold: (r.n_test, r.accuracy) for r in learn.cross_validate(rows, loss, k=3, passes=4, bits=20).collect()}
        folded = learn.assign_folds(rows, 3)
        for f in (0, 1, 2):
            model = learn.train_model(folded.where(F.col("fold") != f), loss, 4, 20)
            test = learn.predict(model, folded.where(F.col("fold") == f))
            assert got[f] == (test.count(), pytest.approx(learn.accuracy(test)))


def test_margins_are_the_scores(spark):
    rows = learn._slotted(planted(spark, 80), 20)
    weights, scored = linear.fit(rows, "logistic", 4)
    model = linear.Model("logistic", 20, weights.select("slot", "weight"))
    want = {r._row: r.score for r in model.score(scored, F.col("slots")).collect()}
    assert {r._row: r.margins[0] for r in scored.collect()} == pytest.approx(want)


def dense(rows, loss, steps=4000):
    """Weights by plain gradient descent on a dense matrix."""
    import numpy as np
    names = sorted({f for r in rows for f in r[3]})
    x = np.array([[f in r[3] for f in names] for r in rows], float)
    y, k = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    w = np.zeros(len(names))
    for _ in range(steps):
        m = x @ w
        g = m - y if loss == "squared" else -y / (1 + np.exp(y * m))
        w -= 0.9 / (k[:, None] * x).sum(1).sum() * (x.T @ (k * g)) * (1 if loss == "squared" else 4)
    return dict(zip(names, w))


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_optimum_of_overlapping_features(spark, loss):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        feats = sorted({f"demo^{rng.choice('abc')}", f"geo^{rng.choice('xyz')}"})
        rows.append((str(i), 1.0 if rng.random() < 0.3 + 0.4 * ("demo^a" in feats) else -1.0, rng.choice([1.0, 3.0]), feats))
    df = spark.createDataFrame(rows, "row_id string, label double, importance double, feats array<string>")
    got = {f"{r.ns}^{r.token}": r.weight for r in learn.train(df, loss, passes=25)[1].collect()}
    want = dense(rows, loss, 20000)
    # the features of a namespace sum to one another, so only sums are determined
    assert {(a, b): got[a] + got[b] for a in "demo^a demo^b demo^c".split() for b in "geo^x geo^y geo^z".split()} == \
        pytest.approx({(a, b): want[a] + want[b] for a in "demo^a demo^b demo^c".split() for b in "geo^x geo^y geo^z".split()}, abs=2e-3)


def test_shuffled_weights_like_broadcast_ones(spark, monkeypatch):
    """Slots beyond the broadcast bound, and slots of very many rows, give the same model."""
    rows = planted(spark, 200)
    want = {(r.ns, r.token): r.weight for r in learn.train(rows, "squared", 5)[1].collect()}
    monkeypatch.setattr(linear, "BROADCAST_BYTES", 0)
    assert {(r.ns, r.token): r.weight for r in learn.train(rows, "squared", 5)[1].collect()} == pytest.approx(want)
    pairs = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).cast("int").alias("slot"), "id")
    table = spark.createDataFrame([(i, float(i)) for i in range(40)], "slot int, weight double")
    plain = sorted(map(tuple, pairs.join(table, "slot").collect()))
    assert sorted(map(tuple, split_join(pairs, table, "slot").collect())) == plain


@pytest.mark.parametrize("loss", ["squared", "logistic", "hinge", "quantile"])
def test_one_pass_ranks_planted_weights(spark, loss):
    tr = planted(spark, 600)
    model = learn.train_online(tr, loss, shard_rows=200)
    w = learn.named_weights(tr, model)
    assert {r.token for r in w.orderBy(F.abs("weight").desc()).limit(2).collect()} == {"good", "bad"}
    assert learn.accuracy(learn.predict(model, tr)) > 0.95
    # the result does not depend on how the rows are stored
    again = learn.train_online(tr.repartition(5, F.rand(2)), loss, shard_rows=200)
    assert {r.slot: r.weight for r in again.weights.collect()} == pytest.approx({r.slot: r.weight for r in model.weights.collect()})


def test_online_steps_like_a_loop(spark):
    """One shard, two passes: the weights of a plain loop over the rows in their order."""
    rows = planted(spark, 60).withColumn("importance", F.when(F.col("label") > 0, 5.0).otherwise(1.0))
    model = learn.train_online(rows, "squared", passes=2)
    order = rows.withColumn("o", F.xxhash64("row_id")).orderBy("o").withColumn("slots", learn.slots(F.col("feats"), 24)).collect()
    w, seen = {}, {}
    for _ in range(2):
        for r in order:
            p = sum(w.get(s, 0.0) for s in r.slots)
            g = r.importance * (p - r.label)
            for s in r.slots:
                seen[s] = seen.get(s, 0.0) + g * g
            pace = {s: 0.5 / seen[s] ** 0.5 for s in r.slots}
            total = sum(pace.values())
            a = r.importance * total
            for s in r.slots:
                w[s] = w.get(s, 0.0) + pace[s] * ((p + a * r.label) / (1 + a) - p) / total
    assert {r.slot: r.weight for r in model.weights.collect()} == pytest.approx(w)


def test_implicit_steps_solve_their_equation():
    for loss in linear.LOSSES:
        for p in (-2.0, -0.3, 0.0, 0.7, 3.0):
            for y in (-1.0, 1.0):
                for a in (0.01, 0.5, 40.0):
                    q = linear._moved(loss, p, y, a)
                    step = (p - q) / a
                    low, high = sorted((linear._slope(loss, q - 1e-7, y), linear._slope(loss, q + 1e-7, y)))
                    assert low - 1e-5 <= step <= high + 1e-5, (loss, p, y, a)


def test_saved_model(spark, tmp_out):
    tr = planted(spark, 100)
    model = learn.train_online(tr, "logistic", bits=20)
    model.save(f"{tmp_out}/m")
    again = linear.load(spark, f"{tmp_out}/m")
    assert (again.loss, again.bits) == ("logistic", 20)
    want = {r.row_id: r.score for r in learn.predict(model, tr).collect()}
    assert {r.row_id: r.score for r in learn.predict(again, tr).collect()} == pytest.approx(want)
    # rows without a known feature score 0, and are negative
    odd = spark.createDataFrame([("a", ["demo^never"]), ("b", []), ("c", None)], "row_id string, feats array<string>")
    assert [(r.score, r.pred) for r in learn.binary_prediction(learn.predict(again, odd)).collect()] == [(0.0, -1.0)] * 3


def test_no_rows(spark):
    none = planted(spark, 5).limit(0)
    assert learn.train(none, "logistic", 3)[1].count() == 0
    assert learn.train_online(none, "hinge").weights.count() == 0
    assert [(r.fold, r.n_test) for r in learn.cross_validate(none, k=3, passes=2).collect()] == [(-1, 0)]


def test_pairs_meet_a_large_table_in_blocks(spark, monkeypatch):
    """A table beyond one broadcast is met block by block: the same rows, no pair shuffled."""
    pairs = spark.range(600).select((F.col("id") % 30).alias("_row"), (F.col("id") % 97).cast("int").alias("slot"))
    table = spark.range(90).select(F.col("id").cast("int").alias("slot"), (F.col("id") * 0.5).alias("weight"))
    expected = sorted(map(tuple, pairs.join(table, "slot").select("_row", "slot", "weight").collect()))
    monkeypatch.setattr(linear, "BROADCAST_BYTES", 500)
    met = linear._meet(pairs, table, 1)
    assert sorted(map(tuple, met.select("_row", "slot", "weight").collect())) == expected
    assert "SortMergeJoin" not in met._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_fit_are_kept_without_their_slots(spark):
    rows = spark.createDataFrame([(i, 1.0 if i % 2 else -1.0, 1.0, [i % 2, 5]) for i in range(20)],
                                 "_row long, label double, importance double, slots array<int>")
    weights, state = linear.fit(rows, "squared", 2)
    assert "slots" not in state.columns and state.count() == 20
    assert {r.slot: round(r.weight, 3) for r in weights.collect()} == {0: -1.0, 1: 1.0, 5: 0.0}


def test_first_online_pass_carries_no_starting_weights(spark, monkeypatch):
    seen, shard = [], linear._shard
    rows = spark.createDataFrame([(i, 1.0 if i % 2 else -1.0, 1.0, [i % 2]) for i in range(20)],
                                 "row_id long, label double, importance double, slots array<int>")
    original = type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, *a, **b: seen.append(self.columns) or original(self, *a, **b))
    got = {r.slot: r.weight for r in linear.fit_online(rows, "squared", 2).collect()}
    assert seen[0] == ["label", "importance", "slots"] and "start" in seen[1]
    assert got[0] < 0 < got[1] and shard is linear._shard


def test_rounds_of_a_shard_are_one_pass(spark):
    """Shards read in rounds hand their weights on: those of one round, in every pass."""
    rng = random.Random(5)
    rows = spark.createDataFrame(
        [(i, 1.0 if rng.random() < 0.5 else -1.0, float(rng.randint(1, 3)), rng.sample(range(60), rng.randint(0, 9))) for i in range(200)],
        "row_id long, label double, importance double, slots array<int>")
    for loss, passes in (("squared", 1), ("logistic", 2)):
        want = {r.slot: r.weight for r in linear.fit_online(rows, loss, passes, shard_rows=70).collect()}
        got = {r.slot: r.weight for r in linear.fit_online(rows, loss, passes, shard_rows=70, round_rows=11).collect()}
        assert len(want) == 60 and got == pytest.approx(want)


def test_a_shard_of_many_slots_stays_small():
    """The lists of a shard take 20 bytes a slot, not a Python object for each."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    n, per = 400, 1000
    def batches():
        for a in range(0, n, 50):
            slots = [np.arange(i * per, (i + 1) * per, dtype=np.int32) for i in range(a, a + 50)]
            yield pa.RecordBatch.from_arrays([pa.array([1.0] * 50), pa.array([1.0] * 50), pa.array(slots, pa.list_(pa.int32()))],
                                             ["label", "importance", "slots"])
    tracemalloc.start()
    held = sum(len(x) for b in linear._shard("squared", 0.5)(batches()) for x in b.column("slots").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held == n * per and peak < 64 * n * per


@pytest.mark.parametrize("loss,size", [("quantile", 0), ("squared", 5)])
def test_history_only_where_steps_use_it(spark, monkeypatch, loss, size):
    kept, write = [], linear.write_shared
    def spy(df, name):
        out = write(df, name)
        if name == "learner-weights":
            kept.append(max(r.n for r in out.select(F.size("s").alias("n")).collect()))
        return out
    monkeypatch.setattr(linear, "write_shared", spy)
    linear.fit(learn._slotted(planted(spark, 60), 20), loss, 7)
    assert kept[-1] == size


def test_a_pass_in_blocks_reads_every_slot_once(spark, monkeypatch):
    """Weights beyond one broadcast: the model is the same, and a step meets each slot of a row once."""
    rows = learn._slotted(planted(spark, 100), 20)
    want = {r.slot: r.weight for r in linear.fit(rows, "squared", 4)[0].collect()}
    seen, meet = [], linear._meet_dealt
    monkeypatch.setattr(linear, "_meet_dealt", lambda parts, table: seen.append(
        [p.select(F.explode("slots")).count() for p in parts]) or meet(parts, table))
    monkeypatch.setattr(linear, "BROADCAST_BYTES", 200)
    got = {r.slot: r.weight for r in linear.fit(rows, "squared", 4)[0].collect()}
    assert got == pytest.approx(want)
    pairs = rows.select(F.explode("slots")).count()
    assert len(seen) >= 3 and all(len(x) == 6 and sum(x) == pairs for x in seen)


def test_blocks_are_broadcast_one_at_a_time(spark, monkeypatch):
    """No plan of a fit, or of a score, holds two blocks of weights."""
    rows = learn._slotted(planted(spark, 100), 20)
    weights = linear.fit(rows, "squared", 2)[0]
    model = linear.Model("squared", 20, weights.select("slot", "weight"))
    want = {r._row: r.score for r in model.score(rows, F.col("slots")).collect()}
    held, write = [], linear.write_shared

    def spy(df, name):
        if name in ("learner-met", "learner-rows", "learner-weights"):
            # what the optimiser broadcasts of itself is small; asked for are the hints
            held.append(df._jdf.queryExecution().analyzed().toString().count("strategy=broadcast"))
        return write(df, name)
    monkeypatch.setattr(linear, "write_shared", spy)
    monkeypatch.setattr(linear, "BROADCAST_BYTES", 200)
    got = {r.slot: r.weight for r in linear.fit(rows, "squared", 2)[0].collect()}
    assert got == pytest.approx({r.slot: r.weight for r in weights.collect()})
    scored = model.score(rows, F.col("slots"))
    assert {r._row: r.score for r in scored.collect()} == pytest.approx(want)
    held.append(scored._jdf.queryExecution().analyzed().toString().count("strategy=broadcast"))
    assert max(held) == 1
