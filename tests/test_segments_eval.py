"""P1-P7, T1, T2, J1, P2, A2-A4, E1-E3, S17, S18, S20."""

import pytest

from audix.operators import evaluate, segments
from audix.sources import tables


def test_segment_topk_division(spark):
    rev = spark.createDataFrame([
        ("a", "sid", "d", "dsp", 10.0, 2), ("b", "sid", "d", "dsp", 9.0, 0), ("c", "sid", "d", "dsp", 3.0, None),
        ("e", "sid", "d", "dsp", 20.0, 4), ("f", "sid", "x", "dsp", 99.0, 1), ("g", "sid", "d", "other", 99.0, 1),
    ], "id string, usertype string, dt string, source string, revenue double, userscount long")
    got = [(r.id, r.profitability) for r in segments.segment_topk(rev, "d", 10).collect()]
    assert got[:2] == [("a", 5.0), ("e", 5.0)]          # tie broken by id
    assert {i for i, p in got[2:]} == {"b", "c"} and all(p is None for _, p in got[2:])
    assert len(segments.segment_topk(rev, "d", 1).collect()) == 1


def test_members_flatten(spark):
    prof = spark.createDataFrame([
        ("u1", "SID", "active", "d", None, None, None, None, None, 3, None, [("A",), ("B",), ("A",)]),
        ("u2", "SID", "active", "d", None, None, None, None, None, None, None, [("A",)]),
        ("u3", "SID", "active", "d", None, None, None, None, None, 1, None, []),
        ("u4", "OTHER", "active", "d", None, None, None, None, None, 1, None, [("A",)]),
    ], "raw_id string, id_type string, status string, dt string, demo string, device string, "
       "app_activities string, geo string, keywords string, clicks long, other_clicks long, "
       "segments array<struct<segment_id:string>>")
    top = spark.createDataFrame([("A", 1.0)], "id string, profitability double")
    got = sorted((r.raw_id, r.segment_id) for r in segments.segment_members(prof, top, "d").collect())
    assert got == [("u1", "A"), ("u1", "A")]    # bag semantics; u2 has no clicks (K18)
    got2 = sorted(r.raw_id for r in segments.segment_members(prof, top, "d", require_clicks=False).collect())
    assert got2 == ["u1", "u1", "u2"]


def test_spend_window_and_sums(spark):
    spend = spark.createDataFrame([
        ("s1", 1.0, "2024010700", "regular"), ("s1", 2.0, "2024010701", "regular"),
        ("s1", 4.0, "2024011400", "regular"), ("s2", 8.0, "2024010702", "regular"),
        ("s2", 0.0, "2024010702", "regular"), ("s3", 16.0, "2024010702", "other"),
        (None, 32.0, "2024010702", "regular"), ("s2", None, "2024010702", "regular"),
    ], "s_id string, advertiser_cost double, hour_id string, source string")
    w = evaluate.spend_in_window(spend, "2024010700", "2024011400")
    assert w.count() == 2        # both bounds exclusive
    ids = spark.createDataFrame([("s1",), ("s2",), ("s2",), (None,)], "sid string")
    assert evaluate.audience_size(ids).first().n_users == 3
    hourly = {r.hour_id: r.revenue for r in evaluate.audience_revenue_hourly(w, ids).collect()}
    assert hourly == {"2024010701": 2.0, "2024010702": 16.0}     # duplicates count again
    # the shuffle path (list not broadcast) gives the same sums
    hourly2 = {r.hour_id: r.revenue for r in evaluate.audience_revenue_hourly(w, ids, max_broadcast_rows=0).collect()}
    assert hourly2 == hourly
    assert evaluate.audience_revenue(evaluate.audience_revenue_hourly(w, ids)).first().revenue == 18.0
    empty = ids.where("false")
    assert evaluate.audience_size(empty).first().n_users == 0     # K12: one row
    cmp = {r.list: r for r in evaluate.audience_compare({"a": ids, "b": empty}, w).collect()}
    assert cmp["a"].revenue == 18.0 and cmp["a"].revenue_per_user == pytest.approx(6.0)
    assert cmp["b"].n_users == 0 and cmp["b"].revenue is None and cmp["b"].revenue_per_user is None


def test_dated_partitions(spark):
    df = spark.createDataFrame([("20240101", 1), ("20240102", 2), ("20240102", 3)], "dt string, v int")
    assert sorted(r.v for r in tables.latest_snapshot(df).collect()) == [2, 3]
    assert [r.v for r in tables.latest_snapshot(df, committed=["20240101"]).collect()] == [1]
    assert tables.latest_snapshot(df, committed=[]).count() == 0
    assert tables.as_of(df, "20240101").count() == 1
    kept = tables.retention_window(df, "20250205", 400)      # cut = 2024-01-02
    assert kept.count() == 0
    dropped = tables.retention_window(df, "20250204", 400, exact_day_only=True)   # cut = 2024-01-01
    assert sorted(r.v for r in dropped.collect()) == [2, 3]
