"""Feature extraction on hand-made nested rows."""

from pyspark.sql import functions as F

from audix.functions import features as feats

SCHEMA = """raw_id string,
 demo struct<gender:string,f1:string,f2:string,age_bucket:string>,
 device struct<mobile:struct<m0:string,m1:string,m2:string,m3:string,model:string>,
               desktop:array<struct<os:string,d1:string,browser:string>>>,
 app_activities array<struct<a0:string,a1:string,a2:string,a3:string,category:string>>,
 geo struct<city:array<struct<woe_id:long>>>,
 keywords struct<page_view:struct<wiki:array<struct<word:string>>>,page_click:struct<wiki:array<struct<word:string>>>,
                 ad_click:struct<wiki:array<struct<word:string>>>,ad_conv:struct<wiki:array<struct<word:string>>>,
                 search_click:struct<wiki:array<struct<word:string>>>,search_query:struct<wiki:array<struct<word:string>>>>,
 clicks long"""


def _kw(*lists):
    padded = list(lists) + [None] * (6 - len(lists))
    return tuple((None if l is None else [(w,) for w in l],) for l in padded)


def rows():
    return [
        ("u1", ("F", None, None, "25-34"),
         ((None, None, None, None, "Galaxy  S\t9"), [("Windows 7", None, "Chrome"), ("Windows 7", None, None)]),
         [(None, None, None, None, "Social Media"), (None, None, None, None, None)],
         ([(123,), (None,), (123,)],),
         _kw(["Foo:Bar", "a|b"], ["line\nbreak"], [":|"], None, ["FOO:bar"]), 7),
        ("u2", ("UNKNOWN", None, None, "Unknown"), None, None, None, None, None),
        ("u3", ("unknown", None, None, "NULL"), ((None, None, None, None, None), None), [], (None,),
         _kw(None), 0),
        ("u4", None, None, None, None, None, 1),
    ]


def test_namespaces(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = {r.sid: r for r in feats.profile_features(df).collect()}
    u1 = out["u1"]
    assert u1.demo == ["25-34", "F"]
    # C2 on the model, K10 split on os/browser, distinct.
    assert u1.device == ["7", "Chrome", "Galaxy_S_9", "Windows"]
    assert u1.app_activities == ["Social_Media"]
    assert u1.geo == ["123"]
    # C3 + C4: ':' '|' newline removed, lower-cased, '' dropped, distinct across lists.
    assert u1.keywords == ["ab", "foobar", "linebreak"]
    u2 = out["u2"]
    assert u2.demo == [] and u2.device is None and u2.geo is None and u2.keywords is None
    u3 = out["u3"]
    assert u3.demo == ["unknown"]  # blacklist is case-sensitive (C6)
    assert u3.device == [] and u3.app_activities == [] and u3.geo == [] and u3.keywords == []
    u4 = out["u4"]
    assert all(getattr(u4, ns) is None for ns in feats.NAMESPACES)


def test_line_round_trip(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    f = feats.profile_features(df)
    lines = f.select(feats.graph_line().alias("value"))
    got = {r.value for r in lines.collect()}
    assert "u4" in got and "u2 |demo" in got
    back = {r.sid: r for r in feats.parse_feature_lines(lines).collect()}
    orig = {r.sid: r for r in f.collect()}
    for sid, r in orig.items():
        for ns in feats.NAMESPACES:
            assert back[sid][ns] == (getattr(r, ns) or [])


def test_parse_edge_lines(spark):
    lines = spark.createDataFrame([("9 |demo a b ||device x |bogus q r |keywords",),
                                   ("  7\t|geo 1 1 2",)], "value string")
    out = {r.sid: r for r in feats.parse_feature_lines(lines).collect()}
    assert out["9"].demo == ["a", "b"] and out["9"].device == ["x"] and out["9"].keywords == []
    assert out["7"].geo == ["1", "2"]


def test_labels(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (7,)], "clicks long")
    got = [tuple(r) for r in df.select(*feats.label_importance()).collect()]
    assert got == [(-1, 1), (-1, 1), (1, 1), (1, 7)]


def test_top_features_and_projection(spark):
    w = spark.createDataFrame([("demo", "F", 0.5), ("geo", "1", -0.9), ("weird", "x", 0.7),
                               ("device", "b", 0.5), ("device", "a", 0.5)], "ns string, token string, weight double")
    top = feats.top_features(w, 3).collect()
    # ties on |weight| are broken by (ns, token)
    assert [(r.ns, r.token) for r in top] == [("geo", "1"), ("weird", "x"), ("demo", "F")]
    sel = feats.group_selected(feats.top_features(w, 3))
    assert {(r.ns, r.token) for r in sel.collect()} == {("geo", "1"), ("keywords", "x"), ("demo", "F")}
    f = spark.createDataFrame([("s1", ["F"], ["a", "b"], [], ["1", "2"], ["x", "y"]),
                               ("s2", ["M"], [], None, [], [])],
                              "sid string, demo array<string>, device array<string>, app_activities array<string>, "
                              "geo array<string>, keywords array<string>")
    p = {r.sid: r for r in feats.project(f, feats.top_features(w, 3)).collect()}
    assert p["s1"].device == [] and p["s1"].geo == ["1"] and p["s1"].keywords == ["x"] and p["s1"].demo == ["F"]
    assert feats.nonempty_projection(feats.project(f, feats.top_features(w, 3))).count() == 1
    # The semi-join path (large selections) gives the same projection.
    q = {r.sid: r for r in feats.project(f, feats.top_features(w, 3), max_literal=1).collect()}
    assert all(q[s][ns] == p[s][ns] for s in p for ns in feats.NAMESPACES)


def test_text_functions(spark):
    from audix.functions import text as T
    df = spark.createDataFrame([(" a\t", "x/y", 0, 10.0)], "s string, k string, z long, n double")
    r = df.select(T.trim_ws("s").alias("t"), T.sanitize_key("k").alias("k"),
                  T.sanitize_key(F.lit(None)).alias("nk"), T.safe_divide("n", "z").alias("d"),
                  T.jaccard(F.lit(0), F.lit(0), F.lit(0)).alias("j0"), T.pair_count(F.lit(5)).alias("pc")).first()
    assert (r.t, r.k, r.nk, r.d, r.j0, r.pc) == ("a", "x-y", "null", None, 0.0, 10)


def test_weight_lines(spark):
    lines = spark.createDataFrame([("Version 8.0",), ("Id",), ("demo^F:123:0.5",), ("keywords^car:77:-1.25",),
                                   ("geo^1:5:oops",), ("Constant:116060:0",)], "value string")
    got = {(r.ns, r.token): r.weight for r in feats.parse_weight_lines(lines).collect()}
    assert got == {("demo", "F"): 0.5, ("keywords", "car"): -1.25, ("geo", "1"): None}
    top = feats.top_features(feats.parse_weight_lines(lines), 1).collect()
    assert (top[0].ns, top[0].token) == ("keywords", "car")


def test_dates_and_casts(spark):
    from audix.functions import text as T
    df = spark.createDataFrame([("-2.5",), ("x",)], "s string")
    got = [r.v for r in df.select(T.safe_abs_double(F.col("s")).alias("v")).collect()]
    assert got == [2.5, None]
    r = spark.range(1).select(T.day_offset("20250205", -400).alias("a"), T.day_offset("20240101", -1).alias("b"),
                              T.day_offset("20240101", 30).alias("c")).first()
    assert (r.a, r.b, r.c) == ("20240102", "20231231", "20240131")


def test_dirty_lines(spark):
    rows = spark.createDataFrame([("",), ("|demo F",), ("x |demo",), (None,), ("u1 |demo F M",)], "value string")
    parsed = {(r.sid, tuple(r.demo)) for r in feats.parse_feature_lines(rows).collect()}
    assert ("u1", ("F", "M")) in parsed and (None, ("F",)) in parsed and ("x", ()) in parsed
    labelled = feats.parse_feature_lines(spark.createDataFrame([("a b |demo F",), ("1 2 |demo F",), ("",)], "value string"),
                                         with_label=True)
    assert sorted((str(r.label), str(r.importance)) for r in labelled.collect()) == [("1", "2"), ("None", "None"), ("None", "None")]
    weights = feats.parse_weight_lines(spark.createDataFrame([("geo^7",), ("geo^7:12",), ("geo^7:12:x",), ("geo^7:12:0.5",)],
                                                             "value string"))
    assert sorted(str(r.weight) for r in weights.collect()) == ["0.5", "None", "None", "None"]


def test_projection_same_at_both_sizes(spark):
    empty = "cast(array() as array<string>)"
    f = spark.sql(f"""select sid, array(d) demo, array(k, 'z') device, {empty} app_activities, {empty} geo, {empty} keywords
                      from values ('u', 'F', 'a'), ('u', 'M', 'b'), (null, 'F', 'z'), (null, 'M', 'a') as t(sid, d, k)""")
    sel = spark.createDataFrame([("demo", "F", 1.0), ("device", "a", 1.0), ("device", "b", 1.0)], "ns string, token string, weight double")
    def rows(df):
        return sorted(str((r.sid, r.demo, r.device, r.geo)) for r in df.collect())
    assert rows(feats.project(f, sel)) == rows(feats.project(f, sel, max_literal=0))


def test_tuple_hash_tells_separators_apart(spark):
    empty = "cast(array() as array<string>)"
    df = spark.sql(f"""select array('a,b') demo, {empty} device, {empty} app_activities, {empty} geo, {empty} keywords
                       union all select array('a', 'b'), {empty}, {empty}, {empty}, {empty}
                       union all select {empty}, array('a', 'b'), {empty}, {empty}, {empty}""")
    assert df.select(feats.tuple_hash().alias("h")).distinct().count() == 3
