"""Ranked lexical search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from audix.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    held = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    held = [h for h in held if h[2]]
    n_docs, total = len(held), sum(h[2] for h in held)
    out = []
    for item, text in sorted(set((i, t) for i, t in items if t is not None), key=str):
        found = []
        for d, tf, n in held:
            m = 75 + 25 * n * n_docs // total
            score = 0
            for t in words(text):
                if tf[t]:
                    df = sum(1 for _, other, _ in held if other[t])
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, d is None, d))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:k])]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = ["w%d" % int(rng.paretovariate(0.6)) for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    docs += [(i, docs[i - 400][1]) for i in range(400, 480)]
    docs += [(5, "Ünïcode w1 w2!w3"), (None, "w1 w1 w7"), (None, None), (900, None), (901, ""), (902, "--- !!"),
             (903, "w9 " * 60000 + "w10"), (904, docs[7][1]), (904, docs[7][1])]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(30)]
    items += [(3, "w1 w2"), (3, "w1 w2"), (40, None), (41, ""), (42, "nowhere"), (43, "ünïcode W1 W1 w9"), (None, "w5 w6")]
    return docs, items


@pytest.mark.parametrize("postings", [1 << 18, 150])
def test_like_brute_force(spark, monkeypatch, corpus, postings):
    docs, items = corpus
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(lexical.build_blocks, "__defaults__", (postings,))
    rows = [(d, t, 1, 2.0) for d, t in docs]
    found = lexical.rank_all(spark.createDataFrame(rows, "doc_id long, text string, rank int, score double").repartition(3),
                             spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == sorted(brute(docs, items), key=str)


def test_items_in_several_blocks_and_smaller_k(spark, corpus):
    docs, items = corpus
    found = lexical.rank_all(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string"), k=3, item_bytes=3000)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute(docs, items, 3), key=str)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    no_docs = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert lexical.rank_all(no_docs, spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert lexical.rank_all(spark.createDataFrame(docs, "doc_id long, text string"), no_items).collect() == []


def blocks_of(texts, items, size):
    """Index blocks of texts, made without Spark by the tasks' own functions."""
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    counted = list(lexical.count_terms(iter([batch]), items.vocabulary))
    df = np.zeros(len(items.vocabulary), np.int64)
    for b in lexical.document_frequencies((x.select(["terms"]) for x in counted), len(df)):
        df[b.column(0).to_numpy()] = b.column(1).to_numpy()
    lengths = np.concatenate([b.column(1).to_numpy() for b in counted])
    weights = lexical.term_weights(df, int((lengths > 0).sum()))
    queries = items.weighted(weights)
    blocks = lexical.build_blocks(iter(counted), weights, lexical.item_pairs(queries), int((lengths > 0).sum()),
                                  int(lengths.sum()), size)
    return [lexical.Block.unpacked(b, 0) for b in blocks], queries


def test_pair_bounds_read_fewer_postings():
    """Same results with and without pairs, fewer postings read with them."""
    rng = random.Random(9)
    rare = ["r%d" % i for i in range(60)]
    common = ["c%d" % i for i in range(12)]
    texts = [" ".join([rng.choice(common) for _ in range(30)] + rng.sample(rare, 1)) for _ in range(3000)]
    items = lexical.Items.of([(i, " ".join(rng.sample(rare, 4) + rng.sample(common, 6))) for i in range(20)])
    blocks, queries = blocks_of(texts, items, 8000)
    assert len(blocks) > 3
    read = {}
    for paired in (True, False):
        results = []
        read[paired] = 0
        for ids, times in queries:
            s = lexical.Search(ids, times, 20, paired)
            for b in blocks:
                s.visit(b)
            read[paired] += s.visited
            results.append([x.tolist() for x in s.best])
        read[paired, "rows"] = results
    assert read[True, "rows"] == read[False, "rows"]
    assert read[True] < 0.98 * read[False]
    everything = sum(len(b.lists[t][0]) for ids, _ in queries for t in ids.tolist() for b in blocks if t in b.lists)
    assert read[True] < 0.9 * everything


def test_pair_lists_hold_the_joint_documents():
    items = lexical.Items.of([(0, "a b c d"), (1, "a d")])
    texts = ["a b", "b c", "a d", "c d", "a b c d", "", "e", "a a a", "b b b", "c c c", "d d d"]
    (block,), queries = blocks_of(texts, items, 1000)
    names = {v: k.decode() for k, v in items.vocabulary.items()}
    met = 0
    for ids, _ in queries:
        for a, b in zip(ids[:-1].tolist(), ids[1:].tolist()):
            peak, together, joint = block.pairs[min(a, b), max(a, b)]
            score = {d: sum(block.lists[t][1][block.lists[t][0] == d].sum() for t in (a, b)) for d in range(len(block.docs))
                     if names[a] in texts[block.docs[d]] and names[b] in texts[block.docs[d]]}
            assert peak == max(score.values())
            if len(together):
                assert sorted(together.tolist()) == sorted(score) and joint.tolist() == sorted(score.values(), reverse=True)
                assert all(score[d] == j for d, j in zip(together.tolist(), joint.tolist()))
                met += 1
    assert met
