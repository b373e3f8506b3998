"""The prefix-filter join equals brute force; C11 edge cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from audix.operators import simjoin
from audix.operators.simjoin import similarity_join, similarity_self_join


def brute(sets_a, sets_b, t, self_join):
    out = set()
    for (ia, a), (ib, b) in itertools.product(sets_a, sets_b):
        if self_join and not ia < ib:
            continue
        la, lb = len(a), len(b)
        if la + lb == 0:
            continue
        i = len(a & b)
        if 1.0 * i / (la + lb - i) >= t:
            out.add((ia, ib))
    return out


def random_sets(rng, n, vocab, max_len):
    sets = []
    for i in range(n):
        base = rng.sample(range(vocab), rng.randint(0, max_len))
        sets.append((i, {f"t{x}" for x in base}))
    # near and exact copies
    for j in range(n // 4):
        src = sets[rng.randrange(n)][1]
        s = set(src)
        if s and rng.random() < 0.5:
            s.discard(next(iter(s)))
        sets.append((n + j, s))
    return sets


@pytest.mark.parametrize("t", [0.5, 0.8, 0.9, 1.0])
def test_self_join_equals_brute_force(spark, t):
    rng = random.Random(int(t * 100))
    sets = random_sets(rng, 80, 30, 8)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets], "id long, tokens array<string>")
    got = {(r.id_a, r.id_b) for r in similarity_self_join(df, cutoff=t).collect()}
    assert got == brute(sets, sets, t, True)


@pytest.mark.parametrize("t", [0.6, 0.8])
def test_two_sided_join_equals_brute_force(spark, t):
    rng = random.Random(7)
    a = random_sets(rng, 40, 20, 6)
    b = random_sets(rng, 30, 20, 6)
    da = spark.createDataFrame([(i, sorted(s)) for i, s in a], "id long, tokens array<string>")
    db = spark.createDataFrame([(i, sorted(s)) for i, s in b], "id long, tokens array<string>")
    got = {(r.id_a, r.id_b) for r in similarity_join(da, db, cutoff=t).collect()}
    assert got == brute(a, b, t, False)


def test_edge_cases(spark):
    rows = [(1, []), (2, []), (3, ["a", "b", "c", "d", "e"]), (4, ["a", "b", "c", "d"]),
            (5, ["a", "b", "c", "d", "x"]), (6, ["a", "b", "c", "d", "e"]),
            (7, ["demo^a"]), (8, ["geo^a"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = {(r.id_a, r.id_b): r.jaccard for r in similarity_self_join(df, cutoff=0.8).collect()}
    assert (1, 2) not in got                     # both empty: 0
    assert got[(3, 6)] == 1.0                    # equal sets
    assert got[(3, 4)] == 0.8 and got[(4, 6)] == 0.8   # exactly 0.8 (4 of 5)
    assert (3, 5) not in got                     # 4 of 6, just below
    assert (7, 8) not in got                     # same token, two namespaces


def test_rejects_zero_cutoff(spark):
    df = spark.createDataFrame([(1, ["a"])], "id long, tokens array<string>")
    with pytest.raises(ValueError):
        similarity_self_join(df, cutoff=0.0)


def test_independent_of_partitioning(spark):
    rng = random.Random(11)
    sets = random_sets(rng, 60, 25, 7)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets], "id long, tokens array<string>")
    one = {tuple(r) for r in similarity_self_join(df.repartition(1), cutoff=0.7).collect()}
    many = {tuple(r) for r in similarity_self_join(df.repartition(13), cutoff=0.7).collect()}
    assert one == many


def test_texts_that_share_a_rare_word_are_no_candidates(spark):
    """Sets with one token in common, rare enough to be in every prefix, end in the join."""
    rows = [(i, ["shared"] + [f"w{i % 4}x{j}" for j in range(30)] + [f"own{i}"]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    freq = simjoin._token_freq(df).withColumn("df", F.when(F.col("token") == "shared", 0).otherwise(F.col("df")))
    pref = simjoin._prefix_rows(df.withColumn("h", F.xxhash64("tokens")), freq, 0.8)
    got = {(r.id_a, r.id_b) for r in simjoin._candidates(pref, pref, 0.8, True).collect()}
    assert got == {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 4 == b % 4}


@pytest.mark.parametrize("n", [1, 300, 900, 3000])
def test_bitmaps_lose_no_long_pair(spark, n):
    rng = random.Random(n)
    sets = []
    for i in range(6):
        base = {f"t{i}-{j}" for j in range(n)}
        sets += [(3 * i, base), (3 * i + 1, base - set(rng.sample(sorted(base), n // 5))),
                 (3 * i + 2, base | {f"u{i}-{j}" for j in range(n // 4)})]
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets], "id long, tokens array<string>")
    assert {(r.id_a, r.id_b) for r in similarity_self_join(df, cutoff=0.8).collect()} == brute(sets, sets, 0.8, True)


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_tokens_that_share_their_hash_lose_no_pair(spark, monkeypatch, most):
    """Tokens stand as 64 bits in the prefixes. With five values for all of them, and with
    frequencies broadcast or shuffled, the pairs are those of brute force."""
    few = lambda t: F.pmod(F.xxhash64(t), F.lit(5))
    monkeypatch.setattr(simjoin, "_bits_of", few)
    monkeypatch.setattr(simjoin, "VOCAB_BROADCAST_ROWS", most)
    sets = random_sets(random.Random(9), 60, 30, 8)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets], "id long, tokens array<string>")
    got = {(r.id_a, r.id_b) for r in similarity_self_join(df, cutoff=0.6).collect()}
    assert got == brute(sets, sets, 0.6, True)


def test_little_is_shuffled_for_a_token(spark):
    """A prefix row has no text and no word that a single set has; sets are dealt once,
    before their tokens are rows, and no bitmap is shuffled beside every token."""
    df = spark.createDataFrame([(i, [f"own{i}", f"group{i // 2}", "all"]) for i in range(8)], "id long, tokens array<string>")
    sets = df.withColumn("h", F.xxhash64("tokens"))
    pref = simjoin._prefix_rows(sets, simjoin._token_freq(sets), 0.5)
    assert dict(pref.dtypes)["token"] == "bigint"
    assert pref.count() == 8 and {r.pos for r in pref.collect()} == {2}      # own comes first, all last
    plan = pref._jdf.queryExecution().executedPlan().toString()
    ranked = plan[plan.index("Window ["):]
    assert "bit_xor" not in ranked.split("Exchange")[0]
