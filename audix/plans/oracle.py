"""DuckDB twins of the registered queries (ANSI-ish SQL over the test tables).

Each string computes the same result as ``catalog.QUERIES[name]`` straight
from the base tables, independently of the stand-in builders, so a match
checks both the stand-ins and the operators.
"""

from __future__ import annotations

# Shared CTE bodies.
SEGREV = """segrev AS (
  SELECT c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS id,
         SUM(o_totalprice) AS revenue, COUNT(DISTINCT c_custkey) AS userscount
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1)"""
TOPSEG = """topseg AS (
  SELECT id, revenue / userscount AS profitability FROM segrev
  ORDER BY profitability DESC NULLS LAST, id LIMIT 10)"""
BESTSEG = """bestseg AS (SELECT id FROM topseg ORDER BY profitability DESC NULLS LAST, id LIMIT 1)"""
SEEDS = """seeds AS (
  SELECT CAST(c_custkey AS VARCHAR) AS sid FROM customer
  WHERE c_custkey % 50 <> 0
    AND c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) IN (SELECT id FROM bestseg))"""
PAIRS = """pairs AS (
  SELECT DISTINCT o_custkey AS custkey,
         CAST(l_partkey * 1000000 + year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS cluster_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SEEDCL = """seedcl AS (
  SELECT DISTINCT CAST(custkey AS VARCHAR) AS sid, cluster_id FROM pairs
  WHERE custkey % 50 <> 0 AND CAST(custkey AS VARCHAR) IN (SELECT sid FROM seeds))"""
EXPANDED = """expanded AS (
  SELECT DISTINCT cluster_id, CAST(custkey AS VARCHAR) AS sid FROM pairs
  WHERE custkey % 50 <> 0 AND cluster_id IN (SELECT cluster_id FROM seedcl))"""
FRESH = """fresh AS (
  SELECT DISTINCT sid AS raw_id FROM expanded WHERE sid NOT IN (SELECT sid FROM seeds))"""
SPENDW = """sw AS (
  SELECT CAST(user_id AS VARCHAR) AS s_id, value AS advertiser_cost,
         strftime(ts, '%Y%m%d%H') AS hour_id
  FROM events
  WHERE event_type = 'purchase' AND value IS NOT NULL AND value <> 0
    AND strftime(ts, '%Y%m%d%H') > '2024010700' AND strftime(ts, '%Y%m%d%H') < '2024011400')"""
LISTS = """lists AS (
  SELECT 'raw' AS list, sid FROM expanded
  UNION ALL SELECT 'filtered' AS list, raw_id AS sid FROM fresh)"""

AUDIENCE = [SEGREV, TOPSEG, BESTSEG, SEEDS, PAIRS, SEEDCL, EXPANDED, FRESH]


def _with(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


ORACLE = {
    "segment_topk": _with([SEGREV, TOPSEG], "SELECT id, ROUND(profitability, 4) AS profitability FROM topseg"),
    "segment_members": _with([SEGREV, TOPSEG], """
SELECT CAST(c_custkey AS VARCHAR) AS raw_id,
       c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS segment_id, clk.clicks
FROM customer
JOIN (SELECT user_id, COUNT(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1) clk
  ON c_custkey = clk.user_id
WHERE c_custkey % 50 <> 0
  AND c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) IN (SELECT id FROM topseg)"""),
    "seed_clusters": _with(AUDIENCE[:6], "SELECT sid, cluster_id FROM seedcl"),
    "expand_users": _with(AUDIENCE[:7], "SELECT cluster_id, sid FROM expanded"),
    "expand_users_scored": _with(AUDIENCE[:6] + [
        "score AS (SELECT cluster_id, COUNT(*) AS score FROM seedcl GROUP BY 1)"], """
SELECT DISTINCT p.cluster_id, CAST(p.custkey AS VARCHAR) AS sid, s.score
FROM pairs p JOIN score s ON p.cluster_id = s.cluster_id WHERE p.custkey % 50 <> 0"""),
    "expand_by_segment": _with([SEGREV, TOPSEG, PAIRS, """segseeds AS (
  SELECT c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS segment_id, CAST(c_custkey AS VARCHAR) AS sid
  FROM customer WHERE c_custkey % 50 <> 0
    AND c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) IN (SELECT id FROM topseg))""",
        """segcl AS (SELECT DISTINCT s.segment_id, p.cluster_id FROM segseeds s
  JOIN pairs p ON CAST(p.custkey AS VARCHAR) = s.sid)"""], """
SELECT DISTINCT c.segment_id, p.cluster_id, CAST(p.custkey AS VARCHAR) AS sid
FROM pairs p JOIN segcl c ON p.cluster_id = c.cluster_id WHERE p.custkey % 50 <> 0"""),
    "expansion_minus_seed": _with(AUDIENCE, "SELECT raw_id FROM fresh"),
    "expansion_counters": _with(AUDIENCE[:7] + [
        "inv AS (SELECT DISTINCT CAST(custkey AS VARCHAR) AS sid FROM pairs WHERE custkey % 50 <> 0)",
        "sd AS (SELECT DISTINCT sid FROM seeds)",
        """mat AS (SELECT cluster_id FROM pairs GROUP BY cluster_id HAVING COUNT_IF(custkey % 50 <> 0) > 0)""",
        "reach AS (SELECT DISTINCT cluster_id FROM seedcl)"], """
SELECT 'user_to_cluster_map' AS stage, 'NonSidId' AS counter,
       CAST((SELECT COUNT(DISTINCT custkey) FROM pairs WHERE custkey % 50 = 0) AS BIGINT) AS value
UNION ALL SELECT 'user_to_cluster_map', 'EmptyClusterIdList', CAST(0 AS BIGINT)
UNION ALL SELECT 'user_to_cluster_map', 'NumOfClusterIdList', (SELECT COUNT(*) FROM inv)
UNION ALL SELECT 'seed_map', 'SeedRecord', (SELECT COUNT(*) FROM seeds)
UNION ALL SELECT 'user_to_cluster_reduce', 'ValidRecord', (SELECT COUNT(*) FROM inv WHERE sid IN (SELECT sid FROM sd))
UNION ALL SELECT 'user_to_cluster_reduce', 'EmptyUserId', (SELECT COUNT(*) FROM inv WHERE sid NOT IN (SELECT sid FROM sd))
UNION ALL SELECT 'user_to_cluster_reduce', 'EmptyClusterId', (SELECT COUNT(*) FROM sd WHERE sid NOT IN (SELECT sid FROM inv))
UNION ALL SELECT 'cluster_to_user_map', 'EmptyRawIds', CAST(0 AS BIGINT)
UNION ALL SELECT 'cluster_to_user_map', 'EmptySidList',
       (SELECT COUNT(*) FROM (SELECT cluster_id FROM pairs GROUP BY cluster_id HAVING COUNT_IF(custkey % 50 <> 0) = 0))
UNION ALL SELECT 'cluster_payload_map', 'ClusterPayloadRecord', (SELECT COUNT(*) FROM seedcl)
UNION ALL SELECT 'cluster_to_user_reduce', 'NoEventsInClusterId', (SELECT COUNT(*) FROM mat WHERE cluster_id NOT IN (SELECT cluster_id FROM reach))
UNION ALL SELECT 'cluster_to_user_reduce', 'NoMatchClusterId', (SELECT COUNT(*) FROM reach WHERE cluster_id NOT IN (SELECT cluster_id FROM mat))
UNION ALL SELECT 'cluster_to_user_reduce', 'MatchedClusterId', (SELECT COUNT(*) FROM reach WHERE cluster_id IN (SELECT cluster_id FROM mat))
UNION ALL SELECT 'cluster_to_user_output', 'ValidRecord', (SELECT COUNT(*) FROM expanded)"""),
    "audience_size": _with(AUDIENCE + [LISTS],
                           "SELECT list, COUNT(sid) AS n_users FROM lists GROUP BY list"),
    "audience_revenue_hourly": _with(AUDIENCE + [SPENDW], """
SELECT hour_id, ROUND(SUM(advertiser_cost), 2) AS revenue
FROM sw JOIN expanded e ON sw.s_id = e.sid GROUP BY hour_id"""),
    "audience_revenue": _with(AUDIENCE + [SPENDW, LISTS], """
SELECT l.list, ROUND(SUM(sw.advertiser_cost), 2) AS revenue
FROM (SELECT DISTINCT list FROM lists) l
LEFT JOIN lists x ON x.list = l.list
LEFT JOIN sw ON sw.s_id = x.sid
GROUP BY l.list"""),
    "audience_compare": _with(AUDIENCE + [SPENDW, LISTS], """
SELECT s.list, s.n_users, ROUND(r.revenue, 2) AS revenue, ROUND(r.revenue / s.n_users, 4) AS revenue_per_user
FROM (SELECT list, COUNT(sid) AS n_users FROM lists GROUP BY list) s
LEFT JOIN (SELECT x.list, SUM(sw.advertiser_cost) AS revenue FROM lists x JOIN sw ON sw.s_id = x.sid GROUP BY x.list) r
  ON s.list = r.list"""),
    "latest_snapshot": """
WITH ev AS (SELECT *, strftime(ts, '%Y%m%d') AS dt FROM events)
SELECT event_id, dt, user_id, event_type FROM ev WHERE dt = (SELECT MAX(dt) FROM ev)""",
    "retention_window": """
WITH ev AS (SELECT strftime(ts, '%Y%m%d') AS dt FROM events)
SELECT dt, COUNT(*) AS n_rows FROM ev
WHERE CAST(strptime(dt, '%Y%m%d') AS DATE) > CAST(DATE '2025-02-05' - INTERVAL 400 DAY AS DATE)
GROUP BY dt""",
}


# ---- features and graph (brute force on the SQL side) -----------------------

FEATL = [r"""ordprio AS (SELECT o_custkey AS ck, o_orderpriority AS prio, COUNT(*) AS n FROM orders GROUP BY 1, 2)""",
         r"""model AS (
  SELECT ck, regexp_replace(prio, '\s+', '_', 'g') AS token
  FROM (SELECT ck, prio, row_number() OVER (PARTITION BY ck ORDER BY n DESC, prio) AS rn FROM ordprio) WHERE rn = 1)""",
         r"""bought AS (
  SELECT o_custkey AS ck, p_type, p_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey)""",
         r"""featl AS (SELECT DISTINCT sid, ns, token FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS sid, 'demo' AS ns, unnest(string_split_regex(c_mktsegment, '\s+')) AS token
    FROM customer WHERE c_custkey % 11 <> 0 AND c_mktsegment NOT IN ('UNKNOWN', 'NULL')
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'demo', CAST(CAST(floor(c_acctbal / 2000) AS BIGINT) * 2000 AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(ck AS VARCHAR), 'device', token FROM model
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'device', unnest(string_split_regex(o_orderstatus, '\s+')) FROM orders
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'device', unnest(string_split_regex(r_name, '\s+'))
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT CAST(ck AS VARCHAR), 'app_activities', regexp_replace(p_type, '\s+', '_', 'g') FROM bought
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'geo', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT CAST(ck AS VARCHAR), 'keywords', lower(regexp_replace(w, ':|\||\n+|\s+', '', 'g'))
    FROM (SELECT ck, unnest(string_split(p_name, ' ')) AS w FROM bought)
) WHERE token IS NOT NULL AND token <> '')"""]


def _key_expr(alias: str) -> str:
    parts = [f"'{ns}[' || coalesce(string_agg(token, ',' ORDER BY token) FILTER (WHERE ns = '{ns}'), '') || ']'"
             for ns in ["demo", "device", "app_activities", "geo", "keywords"]]
    return " || ' ' || ".join(parts) + f" AS {alias}"


GRAPH = AUDIENCE + FEATL + [
    """topf AS (
  SELECT ns, token, CAST(COUNT(*) AS DOUBLE) AS weight FROM featl WHERE sid IN (SELECT sid FROM seeds)
  GROUP BY ns, token ORDER BY abs(weight) DESC, ns, token LIMIT 100)""",
    """proj AS (SELECT f.sid, f.ns, f.token FROM featl f JOIN topf t ON f.ns = t.ns AND f.token = t.token
  WHERE f.sid IN (SELECT sid FROM seeds))""",
    f"ukeys AS (SELECT sid, {_key_expr('vkey')} FROM proj GROUP BY sid)",
    "verts AS (SELECT vkey, CAST(COUNT(*) AS BIGINT) AS k FROM ukeys GROUP BY vkey)",
    "vtok AS (SELECT DISTINCT u.vkey, p.ns || '^' || p.token AS t FROM ukeys u JOIN proj p ON u.sid = p.sid)",
    "vsz AS (SELECT vkey, COUNT(*) AS n FROM vtok GROUP BY vkey)",
    """vpairs AS (SELECT a.vkey AS ka, b.vkey AS kb, COUNT(*) AS i FROM vtok a JOIN vtok b
  ON a.t = b.t AND a.vkey < b.vkey GROUP BY 1, 2)""",
    """vedges AS (SELECT p.ka, p.kb FROM vpairs p JOIN vsz sa ON sa.vkey = p.ka JOIN vsz sb ON sb.vkey = p.kb
  WHERE CAST(p.i AS DOUBLE) / (sa.n + sb.n - p.i) >= 0.8)""",
    """edges AS (
  SELECT e.ka AS src_key, e.kb AS dst_key, CAST(va.k * vb.k AS BIGINT) AS w
  FROM vedges e JOIN verts va ON va.vkey = e.ka JOIN verts vb ON vb.vkey = e.kb
  UNION ALL SELECT vkey, vkey, CAST(k * (k - 1) // 2 AS BIGINT) FROM verts)""",
    "memb AS (SELECT vkey, CAST(length(vkey) % 4 AS BIGINT) AS cid FROM verts)",
    """deg AS (SELECT vkey, CAST(COUNT(*) AS BIGINT) AS degree
  FROM (SELECT src_key AS vkey FROM edges UNION ALL SELECT dst_key FROM edges) GROUP BY vkey)""",
    """share AS (SELECT m.cid, CAST(SUM(d.degree) AS DOUBLE) / (SELECT SUM(degree) FROM deg) AS a
  FROM deg d JOIN memb m ON d.vkey = m.vkey GROUP BY m.cid)""",
]

CANDIDATES = GRAPH + [
    """cproj AS (SELECT f.sid, f.ns, f.token FROM featl f JOIN topf t ON f.ns = t.ns AND f.token = t.token
  WHERE f.sid IN (SELECT raw_id FROM fresh))""",
    f"ckeys AS (SELECT sid, {_key_expr('tkey')} FROM cproj GROUP BY sid)",
    "ctok AS (SELECT DISTINCT c.tkey, p.ns || '^' || p.token AS t FROM ckeys c JOIN cproj p ON c.sid = p.sid)",
    "csz AS (SELECT tkey, COUNT(*) AS n FROM ctok GROUP BY tkey)",
    "xpairs AS (SELECT a.tkey, b.vkey, COUNT(*) AS i FROM ctok a JOIN vtok b ON a.t = b.t GROUP BY 1, 2)",
    """xsim AS (SELECT x.tkey, x.vkey, CAST(x.i AS DOUBLE) / (sa.n + sb.n - x.i) AS jac
  FROM xpairs x JOIN csz sa ON sa.tkey = x.tkey JOIN vsz sb ON sb.vkey = x.vkey
  WHERE CAST(x.i AS DOUBLE) / (sa.n + sb.n - x.i) >= 0.8)""",
    """aff AS (SELECT x.tkey, m.cid, CAST(SUM(v.k) AS BIGINT) AS e
  FROM xsim x JOIN verts v ON v.vkey = x.vkey JOIN memb m ON m.vkey = x.vkey GROUP BY 1, 2)""",
    """best AS (SELECT tkey, cid, e, SUM(e) OVER (PARTITION BY tkey) AS etot,
  row_number() OVER (PARTITION BY tkey ORDER BY e DESC, cid) AS rn FROM aff)""",
    """gated AS (SELECT b.tkey, b.cid, b.e - s.a * b.etot AS gain FROM best b JOIN share s ON b.cid = s.cid
  WHERE b.rn = 1 AND b.e > s.a * b.etot)""",
    "adm AS (SELECT c.sid, g.cid, g.gain FROM ckeys c JOIN gated g ON c.tkey = g.tkey)",
]

DOC_TOKENS = r"""toks AS (SELECT DISTINCT doc_id, t FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS t FROM documents) WHERE t <> '')"""

ORACLE.update({
    "features_long": _with(FEATL, "SELECT sid, ns, token FROM featl"),
    "graph_lines": _with([SEGREV, TOPSEG] + FEATL + [
        """mem AS (SELECT CAST(c_custkey AS VARCHAR) AS sid,
  c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS segment_id FROM customer
  WHERE c_custkey % 50 <> 0 AND c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) IN (SELECT id FROM topseg)
    AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click'))""",
        """nsl AS (SELECT sid, ns, string_agg(token, ' ' ORDER BY token) AS toks FROM featl
  WHERE sid IN (SELECT sid FROM mem) GROUP BY sid, ns)"""], """
SELECT m.segment_id, concat_ws(' ', m.sid,
  '|demo', max(n.toks) FILTER (WHERE n.ns = 'demo'), '|device', max(n.toks) FILTER (WHERE n.ns = 'device'),
  '|app_activities', max(n.toks) FILTER (WHERE n.ns = 'app_activities'), '|geo', max(n.toks) FILTER (WHERE n.ns = 'geo'),
  '|keywords', max(n.toks) FILTER (WHERE n.ns = 'keywords')) AS value
FROM mem m LEFT JOIN nsl n ON m.sid = n.sid GROUP BY m.segment_id, m.sid"""),
    "feature_lines_roundtrip": _with([SEGREV, TOPSEG] + FEATL, """
SELECT f.sid, f.ns, f.token FROM featl f JOIN customer c ON f.sid = CAST(c.c_custkey AS VARCHAR)
WHERE c.c_custkey % 50 <> 0
  AND c.c_mktsegment || '-' || CAST(c.c_nationkey AS VARCHAR) IN (SELECT id FROM topseg)
  AND c.c_custkey IN (SELECT user_id FROM events WHERE event_type = 'click')"""),
    "training_rows": _with([r"""dt AS (SELECT doc_id, lower(regexp_replace(t, ':|\||\n+|\s+', '', 'g')) AS t FROM (
  SELECT doc_id, unnest(string_split_regex(lower(text), '\s+')) AS t FROM documents))""",
                            """dk AS (SELECT doc_id, string_agg(t, ' ' ORDER BY t) AS toks
  FROM (SELECT DISTINCT doc_id, t FROM dt WHERE t <> '') GROUP BY doc_id)"""], """
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
  CASE WHEN l.quality = 1 THEN 1 ELSE -1 END AS label,
  CAST(CASE WHEN l.quality = 1 THEN 1 + l.toxic ELSE 1 END AS BIGINT) AS importance,
  concat_ws(' ', CASE WHEN l.quality = 1 THEN '1' ELSE '-1' END,
            CAST(CASE WHEN l.quality = 1 THEN 1 + l.toxic ELSE 1 END AS VARCHAR),
            '|demo', d.lang, '|device', d.source, '|keywords', k.toks) AS value
FROM documents d JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN dk k ON k.doc_id = d.doc_id"""),
    "feature_topk": _with(GRAPH[:len(AUDIENCE) + len(FEATL) + 1], "SELECT ns, token, weight FROM topf"),
    "vertex_collapse": _with(GRAPH, "SELECT vkey, k FROM verts"),
    "jaccard_pairs": _with([DOC_TOKENS,
                            "sz AS (SELECT doc_id, COUNT(*) AS n FROM toks GROUP BY 1)",
                            """pr AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, COUNT(*) AS i
  FROM toks a JOIN toks b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2)"""], """
SELECT pr.doc_a, pr.doc_b, ROUND(CAST(i AS DOUBLE) / (sa.n + sb.n - i), 6) AS jaccard
FROM pr JOIN sz sa ON sa.doc_id = pr.doc_a JOIN sz sb ON sb.doc_id = pr.doc_b
WHERE CAST(i AS DOUBLE) / (sa.n + sb.n - i) >= 0.8"""),
    "jaccard_cross": _with(CANDIDATES, "SELECT tkey, vkey, ROUND(jac, 6) AS jaccard FROM xsim"),
    "graph_edges": _with(GRAPH, "SELECT src_key, dst_key, w FROM edges"),
    "vertex_degree": _with(GRAPH, "SELECT vkey, degree FROM deg"),
    "graph_summary": _with(GRAPH, """
SELECT 'vertices' AS measure, CAST(COUNT(*) AS BIGINT) AS value FROM verts
UNION ALL SELECT 'edges', CAST(COUNT(*) AS BIGINT) FROM edges
UNION ALL SELECT 'users', CAST(coalesce(SUM(k), 0) AS BIGINT) FROM verts"""),
    "community_share": _with(GRAPH, "SELECT cid, ROUND(a, 9) AS a FROM share"),
    "modularity_of": _with(GRAPH + [
        """ec AS (SELECT e.w, ma.cid AS ca, mb.cid AS cb FROM edges e
  JOIN memb ma ON ma.vkey = e.src_key JOIN memb mb ON mb.vkey = e.dst_key)""",
        "percs AS (SELECT cid, SUM(w) AS s_c FROM (SELECT ca AS cid, w FROM ec UNION ALL SELECT cb, w FROM ec) GROUP BY cid)",
        "perin AS (SELECT ca AS cid, SUM(w) AS w_in FROM ec WHERE ca = cb GROUP BY ca)",
        """t AS (SELECT CAST(SUM(coalesce(w_in, 0)) AS DOUBLE) AS win, SUM(CAST(s_c AS DOUBLE) * s_c) AS ss,
  CAST(SUM(s_c) AS DOUBLE) / 2 AS W FROM percs LEFT JOIN perin ON percs.cid = perin.cid)"""],
        "SELECT ROUND(CASE WHEN W > 0 THEN win / W - ss / (4 * W * W) END, 9) AS modularity FROM t"),
    "community_affinity": _with(CANDIDATES, "SELECT tkey, cid, e FROM aff"),
    "intake_counts": _with(AUDIENCE, """
SELECT 'originals_read' AS measure, CAST(COUNT(*) AS BIGINT) AS value FROM seeds
UNION ALL SELECT 'candidates_read', CAST(COUNT(*) AS BIGINT) FROM fresh"""),
    "admit_users": _with(CANDIDATES, "SELECT sid, cid, ROUND(gain, 6) AS gain FROM adm"),
    "final_audience": _with(CANDIDATES, """
SELECT sid, ROUND(gain, 6) AS gain FROM (
  SELECT sid, gain, row_number() OVER (ORDER BY gain DESC, sid) AS rn FROM adm)
WHERE rn <= LEAST((SELECT COUNT(*) FROM fresh) // 10, (SELECT COUNT(*) FROM adm))"""),
})

ORACLE["kfold_sizes"] = """
WITH lab AS (SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
n AS (SELECT CAST(ceil(COUNT(*) / 10.0) AS BIGINT) AS sz FROM lab),
r AS (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // (SELECT sz FROM n) AS fold FROM lab)
SELECT CAST(fold AS INTEGER) AS fold, COUNT(*) AS n FROM r GROUP BY fold"""

# Closed-form optima of the one-hot models: P and N are the weights of the
# positive and the negative rows of a language.
_ONE_HOT = """WITH r AS (SELECT d.lang AS token,
    sum(CASE WHEN l.quality = 1 THEN 1 + l.toxic ELSE 0 END) AS p, sum(CASE WHEN l.quality = 1 THEN 0 ELSE 1 END) AS n
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang IS NOT NULL GROUP BY d.lang)
SELECT 'demo' AS ns, token, CAST({value} AS DOUBLE) AS weight FROM r"""
ORACLE.update({
    "learn_one_hot_squared": _ONE_HOT.format(value="round((p - n) / (p + n), 2)"),
    "learn_one_hot_logistic": _ONE_HOT.format(value="round(ln(p / n), 2)"),
    "learn_one_hot_hinge": _ONE_HOT.format(value="sign(p - n)"),
    "learn_one_hot_quantile": _ONE_HOT.format(value="sign(p - n)"),
})

ORACLE["learn_online_one_hot"] = _ONE_HOT.format(value="sign(p - n)")

# Normal equations of two features: a = English, b = long text, k = importance, y = label.
_TWO = """WITH r AS (SELECT CAST(d.doc_id AS VARCHAR) AS row_id, CASE WHEN d.lang = 'en' THEN 1 ELSE 0 END AS a,
    CASE WHEN length(d.text) >= 1000 THEN 1 ELSE 0 END AS b, CASE WHEN l.quality = 1 THEN 1 + l.toxic ELSE 1 END AS k,
    CASE WHEN l.quality = 1 THEN 1 ELSE -1 END AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT sum(k * a) AS aa, sum(k * b) AS bb, sum(k * a * b) AS ab, sum(k * y * a) AS ya, sum(k * y * b) AS yb FROM r),
w AS (SELECT (ya * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS wb FROM s)
"""
ORACLE.update({
    "learn_two_features": _TWO + """SELECT 'demo' AS ns, 'en' AS token, round(wa, 5) AS weight FROM w
UNION ALL SELECT 'keywords', 'long', round(wb, 5) FROM w""",
    "predict_saved": _TWO + """SELECT row_id, round(a * wa + b * wb, 5) AS score,
  CASE WHEN a * wa + b * wb > 0 THEN 1 ELSE -1 END AS pred FROM r, w""",
})

# Sinks: what the last run left, read back.
ORACLE.update({
    "sink_by_key": """
SELECT coalesce(segment, 'null') AS segment, CAST(c_custkey AS VARCHAR) || chr(9) || CAST(c_nationkey AS VARCHAR) AS value
FROM (SELECT CASE WHEN c_custkey % 7 <> 0 THEN substr(c_mktsegment, 1, 2) || '-' || substr(c_mktsegment, 3) END AS segment,
             c_custkey, c_nationkey FROM customer)
WHERE segment IS NULL OR segment <> 'MA-CHINERY'""",
    "sink_two_keys": """
SELECT CAST(s_nationkey AS VARCHAR) AS nation, CAST(s_suppkey % 3 AS VARCHAR) AS part,
       concat_ws(',', s_nationkey, s_suppkey % 3, s_suppkey) AS value FROM supplier""",
    "sink_plain": """
SELECT sink, 'c' || CAST(c_custkey AS VARCHAR) AS sid FROM customer, (VALUES ('text'), ('gzip')) AS s(sink)""",
    "sink_records": """
SELECT 'full' AS run, count(*) AS n_rows FROM orders
UNION ALL SELECT 'urgent', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT 'none', 0""",
})

ORACLE.update({
    "sink_graph_lines": ORACLE["graph_lines"],
    "sink_graph_features": ORACLE["feature_lines_roundtrip"],
    "sink_training_lines": f"""SELECT coalesce(d.source, 'null') AS segment_id, t.value
FROM ({ORACLE["training_rows"]}) t JOIN documents d ON CAST(d.doc_id AS VARCHAR) = t.doc_id""",
    "sink_retention": """SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events
WHERE strftime(ts, '%Y%m%d') <> '20240105' AND strftime(ts, '%Y%m%d') > '20240102' GROUP BY 1""",
})

# Detection: every vertex of the graph in one community, and no worse than
# single vertices.
ORACLE.update({f"communities_{name}_check": _with(
    GRAPH, "SELECT count(*) AS n_vertices, count(*) AS n_once, TRUE AS better FROM verts")
    for name in ("greedy", "label_prop", "eigen", "map", "walk")})
