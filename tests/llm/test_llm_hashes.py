"""Lines and words that collide modulo every power of two are told apart."""

import pytest

from audix.llm import line_dedup, near_duplicates


def thue_morse(n, a="a", b="b"):
    """Two different words of 2**n letters, with equal polynomial hashes modulo 2**64."""
    bits = [bin(i).count("1") & 1 for i in range(1 << n)]
    return "".join(a if b_ else b for b_ in bits), "".join(b if b_ else a for b_ in bits)


@pytest.mark.parametrize("n", [7, 9, 10, 12])
def test_line_dedup(spark, n):
    x, y = thue_morse(n)
    rows = [(1, f"first line\n{x}\nlast line"), (2, f"first line\n{y}\nlast line"), (3, x), (4, y)]
    for least in (None, 40):
        found = {r.doc_id: r for r in line_dedup.line_dedup(
            spark.createDataFrame(rows, "doc_id long, text string"), least=least).collect()}
        assert [found[i].n_removed for i in (1, 2)] == [0, 0]
        assert [found[i].n_removed for i in (3, 4)] == ([0, 0] if least is None else [1, 1])


@pytest.mark.parametrize("n", [5, 6, 9, 12])
def test_near_duplicates(spark, n):
    x, y = thue_morse(n)
    rows = [(1, x), (2, y), (3, x.upper()), (4, f"a b c d {x}"), (5, f"a b c d {y}")]
    found = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_pipeline_stages(spark):
    import corpus_pipeline
    x, y = thue_morse(12)
    rows = [(1, f"first line\n{x}\nlast line", "en", "s", 9), (2, f"other line\n{y}\nend line", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("line_dedup", "near_dedup"):
        kept = dict(corpus_pipeline.STAGES)[name](spark, docs, "").collect()
        assert sorted((r.doc_id, r.text) for r in kept) == [(r[0], r[1]) for r in rows]
