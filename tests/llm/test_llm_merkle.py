"""Merkle manifest against a plain loop over the leaves."""

import hashlib

import pytest
from pyspark.sql import functions as F

from audix.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def up(nodes):
    """Root of a list of digests, and for every node the siblings on its way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = i // 16 * 16
            ways[leaf].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 16])))
            at[leaf] = i // 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def brute(rows):
    """(item, leaf, subroot, root, way) of (source, order, leaf, item)."""
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = [], []
    for name in names:
        group = sorted(by[name], key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        sub, ways = up([r[2] for r in group])
        subs.append(sub)
        out.append((group, ways))
    root, tops = up(subs)
    return [(r[3], r[2], subs[i], root, way + tops[i])
            for i, (group, ways) in enumerate(out) for r, way in zip(group, ways)]


def got(spark, rows, schema="source string, order long, leaf string, item long"):
    df = spark.createDataFrame(rows, schema)
    found = merkle.manifest(df, "source", "order", "leaf", ["item"]).withColumn(
        "folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    for r in found:
        assert r.folded == r.root
    return sorted((r.item, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in found)


def test_manifest_like_a_loop(spark):
    """Sources of 1 to 4,700 rows, a null one, some with ids of one text or of several."""
    rows = []
    for s, n in (("b", 4700), ("a", 1), (None, 17), ("é", 16), ("Z", 257), ("", 5)):
        for i in range(n):
            order = None if i % 50 == 7 else i // 2
            rows.append((s, order, h(str(s), str(i // 3 * 3 if i % 5 == 0 else i)), len(rows)))
    # Equal rows may stand in either order: give them one item.
    item = {}
    rows = [(s, o, d, item.setdefault((s, o, d), i)) for s, o, d, i in rows]
    assert got(spark, rows) == sorted(brute(rows))


def test_many_sources(spark):
    rows = [(f"s{i:03}", i, h(str(i)), i) for i in range(300)]
    assert got(spark, rows) == sorted(brute(rows))


@pytest.mark.parametrize("parts", [1, 2, 15, 16, 17, 33, 255, 256, 257, 300, 530])
def test_butterfly_gives_every_partition_its_way(spark, parts):
    nodes = [h(str(i)) for i in range(parts)]
    df = spark.createDataFrame([("x", i, parts, d) for i, d in enumerate(nodes)],
                               "tree string, part long, parts long, node string")
    root, ways = up(nodes)
    found = {r.part: r for r in merkle.butterfly(df).collect()}
    assert len(found) == parts
    for i, r in found.items():
        assert r.root == root and [tuple(s) for s in r.proof] == ways[i]


def test_empty_table_and_fields(spark):
    assert got(spark, []) == []
    df = spark.createDataFrame([(None, ""), (7, "é")], "a int, b string")
    leaves = [r[0] for r in df.select(merkle.leaf([F.col("a"), F.col("b")])).collect()]
    assert leaves == [h("-0:"), h("1:72:é")]


def test_query_on_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and an extra column; a tampered text is found unless lower case leaves it."""
    import zlib
    from audix.llm.queries import op13_merkle_manifest
    rows = [(i, t, "en", s, 1, 5) for i in range(40) for t, s in (("ABC", "x"), ("abc", None))]
    rows += [(None, None, None, None, None, None), (3, "ABC", "en", "x", 1, 5), (50, "É" * 30000 + "A", "en", "y", 2, 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    text = {}
    for r in rows:
        fields = [r[0], r[3], r[2], r[4], r[1]]
        text[h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])] = r[1]
    for r in found:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.verified == (not (hit and text[r.leaf] != "abc")) == (r.folded_root == r.root)
