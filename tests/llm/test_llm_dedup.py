"""Line, near-duplicate and suffix dedup against brute force."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from audix.llm import line_dedup, near_duplicates, run_index, suffix_dedup
from audix.llm.components import components
from audix.llm.run_index import RunIndex

SPACE = " \t\n\v\f\r"


def shingles(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", data)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(docs, percent):
    rows = [r for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    sets = collections.defaultdict(set)
    for r in rows:
        sets[r.doc_id].add(shingles(r.text))
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and any(x and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                label[q] = p
    found = near_duplicates.near_duplicates(docs, percent=percent).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == find(r.doc_id), r
            assert r.kept == (r.doc_id == r.component_id)
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate((a[:320], rng.integers(0, 2**63, 80).astype(np.uint64)))
    one = np.array([5], np.uint64)
    s = near_duplicates.sketches(np.concatenate((a, b, one)), np.array([400, 400, 1]))
    assert (s != near_duplicates._EMPTY).all()
    assert abs((s[0] == s[1]).mean() - 320 / 480) < 0.15
    empty = near_duplicates.sketches(np.zeros(0, np.uint64), np.array([0]))
    assert (empty == near_duplicates._EMPTY).all()


def test_repeated_id_links_all_its_texts(spark):
    """Id 50 is a copy of 3, and also has a text of which 60 is a near copy."""
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    rows = [(3, a), (50, a), (50, b), (60, b + " more"), (70, " ".join(f"c{i}" for i in range(100)))]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (50, 3), (50, 3), (60, 3), (70, 70)]


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (7, 7)] + [(500, 500 + k) for k in range(1, 40)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, **{500 + k: 500 for k in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_lines(rows, run):
    """Texts after deleting lines of later occurrences of ``run`` equal lines."""
    places = sorted({(r.doc_id if r.doc_id is not None else -2**63, r.text or "") for r in rows},
                    key=lambda x: x[0])
    seen, out = {}, {}
    order = collections.defaultdict(list)
    for d, t in places:
        lines = t.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        words = [lines[i].strip(SPACE) for i in solid]
        gone = set()
        for j in range(len(words) - run + 1):
            k = tuple(words[j:j + run])
            order[k].append((d, t, j))
        out[d, t] = (lines, solid, gone, words)
    for k, where in order.items():
        for d, t, j in where[1:]:
            out[d, t][2].update(out[d, t][1][j + i] for i in range(run))
    return {k: "\n".join(x for i, x in enumerate(v[0]) if i not in v[2]) for k, v in out.items()}


def test_line_dedup_equals_brute_force(docs):
    rows = docs.where("doc_id is null or doc_id <> 3").select("doc_id", "text").collect()
    expected = brute_lines(rows, 3)
    found = line_dedup.line_dedup(docs.where("doc_id is null or doc_id <> 3"))
    assert found.columns == ["doc_id", "lang", "source", "n", "rank", "text", "n_lines", "n_removed", "n_runs"]
    got = found.collect()
    assert len(got) == len(rows)
    left = collections.Counter((r.doc_id if r.doc_id is not None else -2**63, r.text or "") for r in got)
    assert left == collections.Counter((d, t) for (d, _), t in expected.items())
    assert sum(r.n_removed for r in got) > 0 and all(r.n_removed <= r.n_lines for r in got)


def test_short_runs_of_enough_bytes_go(spark, docs, texts):
    parts = [(900 + i, "\n".join([*t.split("\n")[i % 3:i % 3 + 1 + i % 2], f"own {i}"])) for i, t in enumerate(texts[:30])]
    docs = docs.where("doc_id is null or doc_id <> 3").select("doc_id", "text") \
        .unionByName(spark.createDataFrame(parts, "doc_id long, text string"))
    rows = docs.collect()
    places = sorted({(r.doc_id if r.doc_id is not None else -2**63, r.text or "") for r in rows}, key=lambda x: x[0])
    seen, expected, lone = set(), collections.Counter(), 0
    texts = [[x for x in t.split("\n") if x.strip(SPACE)] for _, t in places]
    for (d, t), solid in zip(places, texts):
        words, gone = [x.strip(SPACE) for x in solid], set()
        for run in (1, 2, 3):
            for j in range(len(words) - run + 1):
                k = tuple(words[j:j + run])
                if run == 3 or len("".join(k).encode()) >= 40:
                    gone |= set(range(j, j + run)) if k in seen else set()
                    seen.add(k)
        lone += len(gone) in (1, 2)
        at = [i for i, x in enumerate(t.split("\n")) if x.strip(SPACE)]
        cut = {at[i] for i in gone}
        expected[d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut)] += 1
    got = line_dedup.line_dedup(docs, least=40).collect()
    assert len(got) == len(rows) and lone > 0
    assert collections.Counter((r.doc_id if r.doc_id is not None else -2**63, r.text or "") for r in got) == expected


def test_pipeline_cuts_single_lines(spark):
    import corpus_pipeline
    line, short = "All rights to this page are with its owners.", "Read more."
    docs = spark.createDataFrame([(1, f"one\n{line}\n{short}"), (2, line), (3, f"two\n{line}"), (4, f"{short}\nthree")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    assert got == {1: f"one\n{line}\n{short}", 2: "", 3: "two", 4: f"{short}\nthree"}


def test_line_runs_extend(spark):
    shared = [f"line {i}" for i in range(10)]
    docs = spark.createDataFrame([(1, "\n".join(["a", *shared, "b"])), (2, "\n".join(["c", "", *shared[:6], " ", *shared[6:]])),
                                  (3, "\n".join(shared[:2]))], "did long, text string").selectExpr("did", "xxhash64(text) th", "text")
    runs = line_dedup.repeated_runs(docs).collect()
    assert [(r.did, r["first"], r["last"], r.from_did, r.from_line) for r in runs] == [(2, 1, 10, 1, 1)]


def brute_bytes(rows, window):
    seen = collections.Counter()
    data = [((r.doc_id, r.text), (r.text or "").encode()) for r in rows]
    for _, b in data:
        seen.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = collections.Counter()
    for key, b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                mark[i:i + window] = b"\1" * window
        kept = bytes(c for c, m in zip(b, mark) if not m)
        spans = sum(1 for i in range(len(mark)) if mark[i] and (i == 0 or not mark[i - 1]))
        out[key[0], len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("window,gram,hot,shard", [(200, 64, 4096, 2 << 20), (50, 16, 3, 2000)])
def test_suffix_dedup_equals_brute_force(docs, monkeypatch, window, gram, hot, shard):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTENTS", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    found = suffix_dedup.suffix_dedup(docs, window, gram, keep_text=True)
    assert found.columns[:5] == ["doc_id", "lang", "source", "n", "rank"]
    got = found.collect()
    rows = docs.select("doc_id", "text").collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == \
        brute_bytes(rows, window)
    assert all(r.n_bytes - r.n_removed >= len(r.kept_text.encode()) for r in got)


def test_fragments_cover_every_window_in_chunks():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 49, 50, 51, 400, 3000)]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    for chunk in (64, 1 << 20):
        owner, _, _, lo, n = suffix_dedup.fragments(data, offsets, 50, 16, chunk)
        starts = sorted((int(o), int(a) + k) for o, a, m in zip(owner, lo, n) for k in range(m))
        assert starts == [(i, j) for i, t in enumerate(texts) for j in range(len(t) - 49)]


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        texts = [rng.choice(base) + rng.choice(base) for _ in range(rng.randint(1, 6))]
        index = RunIndex(texts)
        ms = index.matching_statistics()
        places = [(i, j) for i, t in enumerate(texts) for j in range(len(t))]
        for i, j in places:
            best = 0
            for p, q in places:
                if (p, q) != (i, j):
                    a, b, k = texts[i][j:], texts[p][q:], 0
                    while k < min(len(a), len(b)) and a[k] == b[k]:
                        k += 1
                    best = max(best, k)
            assert ms[index.starts[i] + j] == best
    assert len(RunIndex([]).matching_statistics()) == 0


@pytest.mark.parametrize("block", [1, 3, 1 << 17])
def test_blocks_give_the_same_matches(monkeypatch, block):
    monkeypatch.setattr(run_index, "BLOCK", block)
    test_matching_statistics_equal_brute_force()


@pytest.mark.parametrize("kind", ["random", "copies", "passages"])
def test_index_memory_is_bounded_per_letter(kind):
    """The index of a shard took 110 to 170 bytes a letter, in each Python worker of an executor."""
    rng = random.Random(3)
    text = rng.randbytes(400_000)
    if kind == "copies":
        text = text[:330] * 1200
    elif kind == "passages":
        text = b"".join(text[i:i + 200] for i in (rng.randrange(100_000) for _ in range(2000)))
    texts = [text[i:i + 330] for i in range(0, len(text), 330)]
    RunIndex(texts[:2]).matching_statistics()
    tracemalloc.start()
    try:
        assert len(RunIndex(texts).matching_statistics()) == len(text) + len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 * len(text)


def test_listing_memory_is_bounded():
    """A megabyte of texts was listed at once, with 68 MB of arrays."""
    import pyarrow as pa
    rng = random.Random(4)
    texts = pa.array(["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(500)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(range(500)), texts], ["did", "th", "text"])
    listed = suffix_dedup._list_fragments(200, 64)
    rows = sum(b.num_rows for b in listed(iter([batch])))
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in listed(iter([batch]))) == rows > 0
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6


def test_empty_tables(nothing):
    assert near_duplicates.near_duplicates(nothing).collect() == []
    assert line_dedup.line_dedup(nothing).collect() == []
    assert suffix_dedup.suffix_dedup(nothing).collect() == []
