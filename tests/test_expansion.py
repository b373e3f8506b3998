"""J4-J7, A6, A7, A14, D1, D2, P8-P13 on hand-made matrices with edge rows."""

from audix.operators import expansion, quality

UC = "id_type string, raw_id string, cluster_ids array<struct<id:long>>"
CU = "cluster_id long, user_raw_ids array<struct<id_type:string,raw_id:string>>"


def matrices(spark):
    uc = spark.createDataFrame([
        ("SID", "s1", [(10,), (11,)]), ("SID", "s1", [(11,), (12,)]),   # two rows: union
        ("SID", "s2", [(11,)]), ("OTHER", "s3", [(10,)]),               # non-SID ignored
        ("SID", "s4", None), ("SID", "s5", []),                         # null / empty lists
        ("SID", "s6", [(99,)]),                                         # cluster not in matrix
        ("SID", "s8", [(13,)]),                                         # not a seed
    ], UC)
    cu = spark.createDataFrame([
        (10, [("SID", "a"), ("SID", "b"), ("OTHER", "c")]),
        (11, [("SID", "b"), ("SID", "d")]),
        (12, [("OTHER", "x")]),                                         # no SID: dropped
        (13, [("SID", "z")]),                                           # no seed
        (14, None), (15, []),
    ], CU)
    seeds = spark.createDataFrame([("s1",), ("s1\t ",), (" s2",), ("s4",), ("s6",), ("s7",), (None,)], "sid string")
    return uc, cu, seeds


def test_two_steps(spark):
    uc, cu, seeds = matrices(spark)
    sc = {(r.sid, r.cluster_id) for r in expansion.seed_clusters(seeds, uc).collect()}
    assert sc == {("s1", 10), ("s1", 11), ("s1", 12), ("s2", 11), ("s6", 99)}
    ex = sorted((r.cluster_id, r.sid) for r in expansion.expand(seeds, uc, cu).collect())
    # one row per (cluster, user); b is reached via two clusters (K4)
    assert ex == [(10, "a"), (10, "b"), (11, "b"), (11, "d")]
    assert sorted(r.sid for r in expansion.expanded_ids(expansion.expand(seeds, uc, cu), dedup=True).collect()) \
        == ["a", "b", "d"]
    scored = {(r.cluster_id, r.sid): r.score for r in expansion.expand_users_scored(
        expansion.seed_clusters(seeds, uc), cu).collect()}
    assert scored[(11, "b")] == 2 and scored[(10, "a")] == 1


def test_by_segment_and_minus_seed(spark):
    uc, cu, _ = matrices(spark)
    seg = spark.createDataFrame([("A", "s1"), ("B", "s2"), ("B", "s2")], "segment_id string, sid string")
    got = {(r.segment_id, r.cluster_id, r.sid) for r in expansion.expand_by_segment(seg, uc, cu).collect()}
    assert ("B", 11, "b") in got and ("A", 10, "a") in got and all(s != "B" or c == 11 for s, c, _ in got)
    prof = spark.createDataFrame([("a", "SID", "active", "d"), ("b", "SID", "inactive", "d"),
                                  ("d", "SID", "active", "d"), ("d", "SID", "active", "d")],
                                 "raw_id string, id_type string, status string, dt string")
    ex = expansion.expand(spark.createDataFrame([("s1",), ("s2",)], "sid string"), uc, cu)
    orig = spark.createDataFrame([("a",)], "sid string")
    out = sorted(r.raw_id for r in expansion.expansion_minus_seed(ex, orig, prof, "d").collect())
    assert out == ["d", "d"]   # a is original, b inactive; profile duplicates kept (J2)


def test_counters(spark):
    uc, cu, seeds = matrices(spark)
    c = {(r.stage, r.counter): r.value for r in quality.expansion_counters(seeds, uc, cu).collect()}
    assert c[("user_to_cluster_map", "NonSidId")] == 1
    assert c[("user_to_cluster_map", "EmptyClusterIdList")] == 2
    assert c[("user_to_cluster_reduce", "ValidRecord")] == 3          # s1, s2, s6
    assert c[("user_to_cluster_reduce", "EmptyUserId")] == 1          # s8
    assert c[("user_to_cluster_reduce", "EmptyClusterId")] == 2       # s4, s7
    assert c[("cluster_to_user_map", "EmptyRawIds")] == 2
    assert c[("cluster_to_user_map", "EmptySidList")] == 1
    assert c[("cluster_to_user_reduce", "NoMatchClusterId")] == 2     # 12 (no SID), 99
    assert c[("cluster_to_user_reduce", "NoEventsInClusterId")] == 1  # 13
    assert c[("cluster_to_user_output", "ValidRecord")] == 4


def _counted_by_hand(seeds, users, clusters):
    """The counters by a loop over the records."""
    seeds = [s.strip() for s in seeds if s and s.strip()]
    sid = {}
    for kind, raw, cl in users:
        if kind == "SID" and cl:
            sid.setdefault(raw, set()).update(x for x in cl if x is not None)
    payload = [(u, x) for u in sid if u in set(seeds) for x in sid[u]]
    reached = {x for _, x in payload}
    rows = [(cid, [r for k, r in raw if k == "SID" and r is not None]) for cid, raw in clusters if raw]
    rows = [r for r in rows if r[1]]
    return {
        ("user_to_cluster_map", "NonSidId"): sum(k != "SID" for k, *_ in users),
        ("user_to_cluster_map", "EmptyClusterIdList"): sum(k == "SID" and not cl for k, _, cl in users),
        ("user_to_cluster_map", "NumOfClusterIdList"): sum(k == "SID" and bool(cl) for k, _, cl in users),
        ("seed_map", "SeedRecord"): len(seeds),
        ("user_to_cluster_reduce", "ValidRecord"): len(set(sid) & set(seeds)),
        ("user_to_cluster_reduce", "EmptyUserId"): len(set(sid) - set(seeds)),
        ("user_to_cluster_reduce", "EmptyClusterId"): len(set(seeds) - set(sid)),
        ("cluster_to_user_map", "EmptyRawIds"): sum(not raw for _, raw in clusters),
        ("cluster_to_user_map", "EmptySidList"): sum(bool(raw) and not [r for k, r in raw if k == "SID" and r is not None] for _, raw in clusters),
        ("cluster_payload_map", "ClusterPayloadRecord"): len(payload),
        ("cluster_to_user_reduce", "NoEventsInClusterId"): sum(c not in reached for c, _ in rows),
        ("cluster_to_user_reduce", "NoMatchClusterId"): len(reached - {c for c, _ in rows}),
        ("cluster_to_user_reduce", "MatchedClusterId"): sum(c in reached for c, _ in rows),
        ("cluster_to_user_output", "ValidRecord"): sum(len(set(s)) for c, s in rows if c in reached),
    }


def test_counters_of_one_run(spark):
    """Counters and expansion of one run, against a loop; and of no records at all."""
    from audix.operators import expansion, quality
    seeds = ["a", " b\t", "a", "", None, "zz"]
    users = [("SID", "a", ["1", "2", None]), ("SID", "b", []), ("SID", "b", ["2", "9"]), ("MID", "a", ["3"]),
             (None, "c", ["1"]), ("SID", "d", ["4"]), ("SID", "e", None)]
    clusters = [("1", [("SID", "a"), ("SID", "x"), ("SID", "x"), ("MID", "y")]), ("2", [("MID", "y"), ("SID", None)]),
                ("4", [("SID", "q")]), ("5", []), ("6", None), ("2", [("SID", "w")])]
    s = spark.createDataFrame([(x,) for x in seeds], "sid string")
    u = spark.createDataFrame([(k, r, None if c is None else [(x,) for x in c]) for k, r, c in users],
                              "id_type string, raw_id string, cluster_ids array<struct<id:string>>")
    c = spark.createDataFrame(clusters, "cluster_id string, user_raw_ids array<struct<id_type:string,raw_id:string>>")
    expanded, counters = quality.expand_counted(s, u, c)
    assert {(r.stage, r.counter): r.value for r in counters.collect()} == _counted_by_hand(seeds, users, clusters)
    want = expansion.expand(s, u, c)
    assert sorted(map(tuple, expanded.collect())) == sorted(map(tuple, want.collect()))
    # no seed, no user list or no cluster: the other counters stay
    for got, want in ((quality.expansion_counters(s.limit(0), u, c), _counted_by_hand([], users, clusters)),
                      (quality.expansion_counters(s.where("sid = '?'"), u, c), _counted_by_hand([], users, clusters)),
                      (quality.expansion_counters(s, u.where("raw_id = '?'"), c), _counted_by_hand(seeds, [], clusters)),
                      (quality.expansion_counters(s, u, c.where("cluster_id = '?'")), _counted_by_hand(seeds, users, []))):
        assert {(r.stage, r.counter): r.value for r in got.collect()} == want
    none = quality.expansion_counters(s.limit(0), u.limit(0), c.limit(0)).collect()
    assert len(none) == 14 and {r.value for r in none} == {0}
