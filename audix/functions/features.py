"""Namespaced feature sets of a profile.

A user's features are five ``array<string>`` columns (demo, device,
app_activities, geo, keywords): distinct, sorted, null when the namespace
value itself is null (the namespace is then absent from the text line), empty
when it is present but yields nothing. All column expressions: no UDF, so the
extraction runs inside whole-stage codegen as a map-only projection.

Nested fields are resolved by position from the input schema at plan time,
as the reference reads them, so renamed filler fields do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audix.functions.text import (AGE_BLACKLIST, GENDER_BLACKLIST, clean_keyword, not_blacklisted,  # noqa: F401
                                  split_ws, trim_ws, ws_to_underscore)
from audix.session import cut_lineage

# Fixed namespace names and their order in text lines.
NAMESPACES = ["demo", "device", "app_activities", "geo", "keywords"]
# Positions inside the nested profile values (FIXTURES.md part 1).
DEMO_GENDER, DEMO_AGE = 0, 3
DEVICE_MOBILE, DEVICE_DESKTOP = 0, 1
MOBILE_MODEL = 4
DESKTOP_OS, DESKTOP_BROWSER = 0, 2
APP_CATEGORY = 4
GEO_CITY, CITY_ID = 0, 0
KEYWORD_LIST_COUNT = 6
WIKI, WORD = 0, 0



def _empty() -> Column:
    return F.array().cast("array<string>")

MAX_LITERAL_FEATURES = 100_000


def _fname(dtype: T.DataType, pos: int) -> str:
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype.fields[pos].name


def _dtype(schema: T.StructType, path: list) -> T.DataType:
    d: T.DataType = schema[path[0]].dataType
    for p in path[1:]:
        if isinstance(d, T.ArrayType):
            d = d.elementType
        d = d[p].dataType if isinstance(p, str) else d.fields[p].dataType
    return d


def _tokens(arr: Column) -> Column:
    """Distinct, sorted, no empty strings."""
    return F.array_sort(F.array_distinct(F.filter(arr, lambda t: t.isNotNull() & (t != ""))))


def _split_all(arr: Column) -> Column:
    """Values with inner white space become several tokens, as they do
    after the text round trip."""
    return F.flatten(F.transform(arr, lambda v: F.coalesce(split_ws(v), _empty())))


def demo_tokens(schema: T.StructType, col: str = "demo") -> Column:
    """gender and age bucket, minus the blacklists."""
    d = _dtype(schema, [col])
    g = F.col(col)[_fname(d, DEMO_GENDER)]
    a = F.col(col)[_fname(d, DEMO_AGE)]
    vals = F.array(not_blacklisted(g, GENDER_BLACKLIST), not_blacklisted(a, AGE_BLACKLIST))
    return F.when(F.col(col).isNotNull(), _tokens(_split_all(F.filter(vals, lambda v: v.isNotNull()))))


def device_tokens(schema: T.StructType, col: str = "device") -> Column:
    """mobile model (C2), distinct desktop os and browser values."""
    d = _dtype(schema, [col])
    mob_name = _fname(d, DEVICE_MOBILE)
    desk_name = _fname(d, DEVICE_DESKTOP)
    model_name = _fname(_dtype(schema, [col, mob_name]), MOBILE_MODEL)
    desk_t = _dtype(schema, [col, desk_name])
    os_name, br_name = _fname(desk_t, DESKTOP_OS), _fname(desk_t, DESKTOP_BROWSER)
    model = ws_to_underscore(F.col(col)[mob_name][model_name])
    desk = F.coalesce(F.col(col)[desk_name], F.array())
    oss = F.transform(F.filter(desk, lambda x: x.isNotNull()), lambda x: x[os_name])
    brs = F.transform(F.filter(desk, lambda x: x.isNotNull()), lambda x: x[br_name])
    vals = F.concat(F.filter(F.array(model), lambda v: v.isNotNull()),
                    _split_all(F.filter(oss, lambda v: v.isNotNull())),
                    _split_all(F.filter(brs, lambda v: v.isNotNull())))
    return F.when(F.col(col).isNotNull(), _tokens(vals))


def app_tokens(schema: T.StructType, col: str = "app_activities") -> Column:
    """distinct categories with white space runs as '_' (C2)."""
    cat = _fname(_dtype(schema, [col]), APP_CATEGORY)
    vals = F.transform(F.filter(F.col(col), lambda x: x.isNotNull() & x[cat].isNotNull()),
                       lambda x: ws_to_underscore(x[cat]))
    return F.when(F.col(col).isNotNull(), _tokens(vals))


def geo_tokens(schema: T.StructType, col: str = "geo") -> Column:
    """distinct city place ids as text."""
    city = _fname(_dtype(schema, [col]), GEO_CITY)
    cid = _fname(_dtype(schema, [col, city]), CITY_ID)
    arr = F.coalesce(F.col(col)[city], F.array())
    vals = F.transform(F.filter(arr, lambda x: x.isNotNull() & x[cid].isNotNull()),
                       lambda x: x[cid].cast("string"))
    return F.when(F.col(col).isNotNull(), _tokens(vals))


def keyword_tokens(schema: T.StructType, col: str = "keywords") -> Column:
    """distinct union of the six word lists, cleaned (C3) and lower-cased (C4)."""
    kt = _dtype(schema, [col])
    parts = []
    for i in range(min(KEYWORD_LIST_COUNT, len(kt.fields))):
        lst = kt.fields[i].name
        wiki = _fname(kt.fields[i].dataType, WIKI)
        word = _fname(_dtype(schema, [col, lst, wiki]), WORD)
        arr = F.coalesce(F.col(col)[lst][wiki], F.array())
        parts.append(F.transform(F.filter(arr, lambda x: x.isNotNull() & x[word].isNotNull()),
                                 lambda x: clean_keyword(x[word])))
    return F.when(F.col(col).isNotNull(), _tokens(F.flatten(F.array(*parts))))


def profile_features(profiles: DataFrame, id_col: str = "raw_id", keep: list[str] | None = None) -> DataFrame:
    """F1-F5 for every row: id, the five token arrays, plus ``keep`` columns."""
    s = profiles.schema
    return profiles.select(
        F.col(id_col).alias("sid"), *(keep or []),
        demo_tokens(s).alias("demo"), device_tokens(s).alias("device"),
        app_tokens(s).alias("app_activities"), geo_tokens(s).alias("geo"),
        keyword_tokens(s).alias("keywords"))


def features_long(feat: DataFrame) -> DataFrame:
    """(sid, ns, token) rows, one per feature."""
    st = F.array(*[F.struct(F.lit(ns).alias("ns"), F.coalesce(F.col(ns), _empty()).alias("toks"))
                   for ns in NAMESPACES])
    return (feat.select("sid", F.inline(st))
            .select("sid", "ns", F.explode("toks").alias("token")))


def label_importance(click_col: str = "clicks") -> list[Column]:
    """F7 (K1: clicks read by name): label -1 / importance 1 without clicks
    (null or 0), else label 1 / importance = clicks."""
    c = F.coalesce(F.col(click_col).cast("long"), F.lit(0))
    return [F.when(c != 0, F.lit(1)).otherwise(F.lit(-1)).alias("label"),
            F.when(c != 0, c).otherwise(F.lit(1)).cast("long").alias("importance")]


def _ns_parts() -> list[Column]:
    return [F.when(F.col(ns).isNotNull(), F.concat(F.array(F.lit("|" + ns)), F.col(ns))) for ns in NAMESPACES]


def graph_line(id_col: str = "sid") -> Column:
    """``id |demo t t |device t |app_activities t |geo t |keywords t``."""
    return F.concat_ws(" ", F.col(id_col), *_ns_parts())


def training_line() -> Column:
    """S13 body: ``label importance |demo t ... |keywords t``."""
    return F.concat_ws(" ", F.col("label").cast("string"), F.col("importance").cast("string"), *_ns_parts())


def parse_feature_lines(lines: DataFrame, value_col: str = "value", with_label: bool = False) -> DataFrame:
    """Text lines back to (sid, five arrays) [or (label, importance, ...)].

    The first bar-separated segment holds the id (K14) or ``label importance``;
    empty segments are skipped (K13); unknown namespaces are ignored; a missing
    namespace is an empty set, as in the reference's reader. A blank line or one
    without an id gives a null id; a label or importance that is no number is null."""
    segs = F.split(F.col(value_col), r"\|")
    head = split_ws(F.coalesce(segs[0], F.lit("")))
    body = F.transform(F.filter(F.slice(segs, 2, 1 << 30), lambda s: trim_ws(s) != ""),
                       lambda s: split_ws(s))
    cols = []
    for ns in NAMESPACES:
        toks = F.flatten(F.transform(F.filter(body, lambda t: t[0] == F.lit(ns)),
                                     lambda t: F.slice(t, 2, 1 << 30)))
        cols.append(_tokens(F.coalesce(toks, _empty())).alias(ns))
    if with_label:
        lead = [F.get(head, F.lit(0)).try_cast("int").alias("label"),
                F.get(head, F.lit(1)).try_cast("long").alias("importance")]
    else:
        lead = [F.get(head, F.lit(0)).alias("sid")]
    return lines.select(*lead, *cols)


def top_features(weights: DataFrame, k: int) -> DataFrame:
    """K features with the largest |weight|; ties by (ns, token) so the
    choice is deterministic (TakeOrderedAndProject)."""
    return (weights.where(F.col("weight").isNotNull())
            .orderBy(F.abs("weight").desc(), F.col("ns"), F.col("token"))
            .limit(k).select("ns", "token", "weight"))


def group_selected(selected: DataFrame) -> DataFrame:
    """normalise namespaces (unknown -> keywords) of the selected features."""
    return selected.select(
        F.when(F.col("ns").isin(*NAMESPACES[:4]), F.col("ns")).otherwise(F.lit("keywords")).alias("ns"),
        "token").distinct()


def project(feat: DataFrame, selected: DataFrame, max_literal: int = MAX_LITERAL_FEATURES) -> DataFrame:
    """Intersect each namespace with the selected features of that
    namespace (matched by name, K2). The selection is a top-k result, bounded
    by k; it is inlined as literal arrays (map-only projection). Larger
    selections are joined and regrouped row by row; the rows are the same."""
    sel = group_selected(selected)
    rows = sel.limit(max_literal + 1).collect()
    others = [c for c in feat.columns if c not in NAMESPACES]
    if len(rows) <= max_literal:
        by_ns: dict[str, list[str]] = {ns: [] for ns in NAMESPACES}
        for r in rows:
            by_ns[r["ns"]].append(r["token"])
        cols = []
        for ns in NAMESPACES:
            lit = F.array(*[F.lit(t) for t in sorted(by_ns[ns])]).cast("array<string>")
            cols.append(F.array_sort(F.array_intersect(F.coalesce(F.col(ns), _empty()), lit)).alias(ns))
        return feat.select(*others, *cols)
    # Rows are told apart by a number of their own (ids may repeat or be null),
    # fixed by the checkpoint before it is used twice.
    numbered = cut_lineage(feat.withColumn("_row", F.monotonically_increasing_id()))
    long = features_long(numbered.drop("sid").withColumnRenamed("_row", "sid")).join(sel, ["ns", "token"], "left_semi")
    regrouped = long.groupBy(F.col("sid").alias("_row")).agg(*[
        F.array_sort(F.collect_set(F.when(F.col("ns") == ns, F.col("token")))).alias(ns) for ns in NAMESPACES])
    out = numbered.select("_row", *others).join(regrouped, "_row", "left")
    return out.select(*others, *[F.coalesce(F.col(ns), _empty()).alias(ns) for ns in NAMESPACES])


def nonempty_projection(feat: DataFrame) -> DataFrame:
    """Drop rows whose five projected sets are all empty."""
    total = sum((F.coalesce(F.size(ns), F.lit(0)) for ns in NAMESPACES[1:]), F.coalesce(F.size("demo"), F.lit(0)))
    return feat.where(total > 0)


def namespaced_tokens() -> Column:
    """The five sets as one set of ``ns^token`` strings (for similarity)."""
    def prefixed(ns):
        return F.transform(F.coalesce(F.col(ns), _empty()), lambda t: F.concat(F.lit(ns + "^"), t))
    return F.flatten(F.array(*[prefixed(ns) for ns in NAMESPACES]))


def tuple_key() -> Column:
    """Canonical text of a projected feature tuple (namespace order, sorted tokens)."""
    return F.concat_ws(" ", *[F.concat(F.lit(ns + "["), F.array_join(F.coalesce(F.col(ns), _empty()), ","), F.lit("]"))
                              for ns in NAMESPACES])


def tuple_hash() -> Column:
    """64-bit hash of a projected feature tuple: every array with its length, so
    that tokens holding separators, or moved to another namespace, differ."""
    return F.xxhash64(*[c for ns in NAMESPACES
                        for c in (F.size(F.coalesce(F.col(ns), _empty())), F.coalesce(F.col(ns), _empty()))])


def parse_weight_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Weight file lines ``ns^token:hash:weight`` -> (ns, token, weight).
    Every line with a '^' is kept (K3: no header line is lost); the weight is
    ``try_cast`` so a malformed or missing value is null and never ranked."""
    parts = F.split(F.col(value_col), ":")
    feature = parts[0]
    return (lines.where(F.instr(F.col(value_col), "^") > 0)
            .select(F.substring_index(feature, "^", 1).alias("ns"),
                    F.expr(f"substr(split({value_col}, ':')[0], instr(split({value_col}, ':')[0], '^') + 1)").alias("token"),
                    F.get(parts, F.lit(2)).try_cast("double").alias("weight")))
