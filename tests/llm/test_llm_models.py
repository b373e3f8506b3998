"""Language identification, vector search, licences, pipeline and registration."""

import collections
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from audix.llm import graph_search, language, licences, queries, top_k

SMALL = "/root/testdata/sf0.001"


def test_language_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, SMALL)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = got.collect()
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_no_language_is_left_out(spark):
    """130 labels, one document of each held out."""
    rng = random.Random(6)
    rows = []
    for k in range(130):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)]
        rows += [(10 * k + i, " ".join(rng.choice(words) for _ in range(30)), f"l{k:03d}") for i in range(5 + (k < 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in language.training_sample(docs)} == {f"l{k:03d}" for k in range(130)}
    got = language.identify(docs.where("doc_id % 10 = 0"), docs.where("doc_id % 10 > 0")).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 128


def test_language_cases(spark):
    rows = [(1, "der die das und nicht", "de", "q"), (2, "the and of with this", "en", None), (3, None, "en", "x"),
            (4, "", None, "x"), (5, "123 !? 456", "de", "x"), (6, "the and the of", None, "x"), (None, "und nicht das", "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language.identify(docs, docs)
    assert got.columns == ["doc_id", "lang", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert found[1][0] == found[None][0] == "de" and found[2][0] == found[6][0] == "en"
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert {r.lang_pred for r in language.identify(docs, docs.where("false")).collect()} == {"und"}
    assert language.identify(docs.where("false"), docs).collect() == []


def test_presence_never_crosses_texts():
    marks = language.presence(np.frombuffer(b"abab", np.uint8), np.array([0, 2, 4]))
    assert (marks[0] == marks[1]).all() and marks[0].sum() == 3
    assert language.presence(np.zeros(0, np.uint8), np.array([0, 0])).sum() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 12))
    x[100:300] = x[5]                                   # a very common vector
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [1.0, None] * 6, 1), (902, [float("nan")] * 12, 1), (903, [float("inf")] * 12, 1),
             (904, [0.0] * 12, 1), (905, [], 1), (None, [1.0] * 12, 1), (7, rows[7][1], 1), (920, [0.5] * 12, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").repartition(4)


def brute_top(vectors, score, usable, k=20):
    rows = {}
    for r in vectors.collect():
        v = r.embedding
        if r.vec_id is not None and v and all(c is not None and math.isfinite(c) for c in v) and usable(v):
            rows[r.vec_id] = np.array(v)
    out = {}
    for q in rows:
        if q % 20 == 0:
            scored = sorted((-score(rows[q], v), i) for i, v in rows.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def test_exact_top_k_equals_brute_force(vectors):
    expected = brute_top(vectors, lambda a, b: int(np.floor(64 * a).astype(int) @ np.floor(64 * b).astype(int)), lambda v: True)
    got = collections.defaultdict(list)
    for r in top_k.exact_top_k(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == expected


@pytest.mark.parametrize("n,dims,width", [(5, 3, 8), (500, 16, 4), (500, 16, 16)])
def test_cell_keeps_every_answer(n, dims, width):
    rng = np.random.default_rng(n)
    q, c = rng.integers(-60, 60, (30, dims)), rng.integers(-60, 60, (n, dims))
    c[: n // 3] = c[0]
    qi, ci, score = top_k.cell_top(q, c, 7, width)
    full = q @ c.T
    assert (full[qi, ci] == score).all()
    for i in range(len(q)):
        floor = np.sort(full[i])[-min(7, n)]
        assert set(np.flatnonzero(full[i] >= floor)) <= set(ci[qi == i])


def test_exact_top_k_beyond_doubles():
    q = np.array([[2**40, 3]])
    c = np.array([[2**20, 1], [2**20, 0]])
    _, ci, score = top_k.cell_top(q, c, 1)
    assert dict(zip(ci, score))[0] == 2**60 + 3


def test_graph_search_recall(vectors):
    usable = lambda v: any(v)
    expected = brute_top(vectors, lambda a, b: float(a @ b), usable)
    got = collections.defaultdict(list)
    for r in graph_search.nearest(vectors, F.col("vec_id") % 20 == 0, shard_rows=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(expected)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in e}) for q, e in expected.items())
    assert hits >= 0.95 * sum(map(len, expected.values()))
    for q in got:
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True) and q not in dict(got[q])


def test_graph_is_stored_flat():
    import pandas as pd
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    row = graph_search.build_shard(pd.DataFrame({"cand": np.arange(300) * 2, "v": list(x), "dims": 8, "shard": 4}))
    graph, ids, back = graph_search.load_shard(row.iloc[0])
    assert (back == x).all() and (ids == np.arange(300) * 2).all()
    query = np.concatenate((x[:40] / np.linalg.norm(x[:40], axis=1, keepdims=True), np.zeros((40, 1))), axis=1).astype(np.float32)
    found, _ = graph.search(query, 100)
    true = np.argsort(-(x[:40] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) for a, b in zip(found, true)]) >= 9


def test_search_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k.exact_top_k(none, F.lit(True)).collect() == []
    assert graph_search.nearest(none, F.lit(True)).collect() == []


def test_licences(spark):
    rows = [
        (1, "a/b/x.py", "code here foo\nLicensed under the Apache License, Version 2.0.\n" + "more code bar\n" * 9),
        (2, "a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
                         "software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
        (3, "a/b/c/y.py", "nothing to see"), (4, "z/y.py", "nothing to see"), (5, None, None), (6, "a/b/", ""),
        (7, "a/b/d/COPYING", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU "
                             "General Public License as published by\nthe Free Software Foundation, either version 3 of the License"),
        (8, "a/b/d/e/f.py", "x"), (8, "a/b/d/e/f.py", "x"), (9, "q/only.txt", "All rights reserved."), (10, "q/r/s.txt", "zzz")]
    files = spark.createDataFrame(rows, "file_id long, path string, text string").withColumn("licence", F.lit("clash"))
    got = {(r.file_id, r.path): (r.licence, r.origin, r.directory) for r in licences.scan(files).collect()}
    assert got[1, "a/b/x.py"] == ("Apache-2.0", "notice", None)
    assert got[2, "a/LICENSE"][:2] == ("MIT", "notice")
    assert got[3, "a/b/c/y.py"] == ("MIT", "inherited", "a")
    assert got[4, "z/y.py"] == got[5, ""] == (None, "none", None)
    assert got[6, "a/b/"] == ("MIT", "inherited", "a")
    assert got[7, "a/b/d/COPYING"][:2] == ("GPL-3.0", "notice")
    assert got[8, "a/b/d/e/f.py"] == ("GPL-3.0", "inherited", "a/b/d")
    assert got[10, "q/r/s.txt"] == ("Proprietary", "inherited", "q")
    assert len(licences.scan(files).collect()) == len(rows)
    assert licences.scan(files.where("false")).collect() == []


def test_licence_cosine_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(F.col("doc_id").alias("file_id"), F.lit("").alias("path"), "text")
    texts = {r.file_id: r.text or "" for r in docs.collect()}
    words = {d: re.findall("[a-z0-9]+", t.lower()) for d, t in texts.items()}
    rows = licences.template_words(licences.TEMPLATES)
    known = {r[2] for r in rows}
    n = len(texts)
    idf = {w: math.log((n + 1) / (sum(w in set(x) for x in words.values()) + 1)) + 1 for w in known}
    templates = collections.defaultdict(dict)
    for i, name, w, c in rows:
        templates[i, name][w] = c * idf[w]
    best = {}
    for d, t in texts.items():
        units, run = [], []
        for line in [*t.split("\n"), ""]:
            w = re.findall("[a-z0-9]+", line.lower())
            if w and sum(x in known for x in w) >= licences.LINE_SHARE * len(w):
                units.append(w)
                run = run + w
            else:
                units += [run] if run else []
                run = []
        for u in units:
            v = {w: c * idf.get(w, math.log(n + 1) + 1) for w, c in collections.Counter(u).items()}
            size = math.sqrt(sum(x * x for x in v.values()))
            for (_, name), y in templates.items():
                s = sum(v[w] * y.get(w, 0) for w in v) / size / math.sqrt(sum(x * x for x in y.values()))
                if round(s, 6) >= licences.LEAST_COSINE:
                    best[d] = min(best.get(d, (9, "")), (-round(s, 6), name))
    got = {r.file_id: (-r.cosine, r.licence) for r in licences.scan(docs).where("origin = 'notice'").collect()}
    assert got.keys() == best.keys()
    assert all(abs(got[d][0] - best[d][0]) < 1e-5 and got[d][1] == best[d][1] for d in best)


def test_pipeline(spark):
    import corpus_pipeline as p
    assert [name for name, _ in p.STAGES] == ["language_id", "line_dedup", "near_dedup", "suffix_dedup", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    from audix.llm.shared import stored
    kept = [n]
    for name, stage in p.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] < n and kept[1] >= n - 2
    assert docs.where("n_chars <> length(text)").count() == 0
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    last = p.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == ids


def test_pipeline_stages_on_odd_rows(spark, docs):
    import corpus_pipeline as p
    for _, stage in p.STAGES[1:-1]:
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        got.collect()
    none = docs.where("false")
    for _, stage in p.STAGES:
        assert stage(spark, none, SMALL).collect() == []


def test_registered():
    import __spark_entry__ as e
    names = e.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(e.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        if os.path.exists(f"{SMALL}/{t}.parquet"):
            con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    found = con.sql(queries.ORACLE[name])
    names = found.columns
    expected = sorted(map(str, found.fetchall()))
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r[c] for c in names)) for r in got.collect()) == expected
