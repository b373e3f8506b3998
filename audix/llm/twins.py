"""DuckDB twins of the operators that SQL can express at the size of a
correctness check (they compare all pairs or sort whole tables)."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, i, t, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k
      FROM (SELECT doc_id, i, regexp_replace(line, '^[\t-\r ]+|[\t-\r ]+$', '', 'g') AS t FROM l) WHERE t <> ''),
w AS (SELECT doc_id, k, t || chr(10) || lead(t, 1) OVER o || chr(10) || lead(t, 2) OVER o AS run
      FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, k, first_value(doc_id) OVER o AS fd, first_value(k) OVER o AS fk
      FROM w WHERE run IS NOT NULL WINDOW o AS (PARTITION BY run ORDER BY doc_id, k)),
later AS (SELECT * FROM f WHERE doc_id <> fd OR k <> fk),
gone AS (SELECT DISTINCT doc_id, k + d AS k FROM later, (VALUES (0), (1), (2)) AS x(d)),
runs AS (SELECT doc_id, count(*) AS n_runs
         FROM (SELECT DISTINCT doc_id, fd, k - fk AS diagonal,
                      k - row_number() OVER (PARTITION BY doc_id, fd, k - fk ORDER BY k) AS island FROM later)
         GROUP BY doc_id),
cut AS (SELECT n.doc_id, n.i FROM n JOIN gone USING (doc_id, k)),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
         FROM l LEFT JOIN cut ON l.doc_id = cut.doc_id AND l.i = cut.i WHERE cut.i IS NULL GROUP BY l.doc_id),
size AS (SELECT doc_id, count(*) AS n_lines FROM n GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN size USING (doc_id) LEFT JOIN removed USING (doc_id)
     LEFT JOIN runs USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM p JOIN z zx ON zx.doc_id = x JOIN z zy ON zy.doc_id = y WHERE 100 * c >= 85 * (zx.n + zy.n - c)),
e AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reach = e.x),
m AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT documents.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       documents.doc_id = component_id AS kept
FROM documents JOIN m USING (doc_id) LEFT JOIN z USING (doc_id)
"""

EXACT_TOP_K = """
WITH e AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d, len(embedding) AS n
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
bad AS (SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR isnan(x) OR isinf(x)),
v AS (SELECT vec_id, d, n, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS y
      FROM e WHERE vec_id NOT IN (SELECT vec_id FROM bad)),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.y * c.y) AS BIGINT) AS score
      FROM v q JOIN v c ON q.d = c.d AND q.n = c.n AND q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id GROUP BY 1, 2),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def licence_scan(words: list[tuple[int, str, str, int]], line_share: float, least: float, licence_share: float) -> str:
    """Twin of the licence scan for template rows (template, licence, word, count)."""
    rows = ", ".join(f"({t}, '{name}', '{word}', {n})" for t, name, word, n in words)
    return rf"""
WITH tw(template, licence, word, n) AS (VALUES {rows}),
files AS (SELECT doc_id, coalesce(text, '') AS text,
                 concat_ws('/', source, CAST(doc_id // 512 AS VARCHAR), CAST(doc_id // 32 AS VARCHAR),
                           CAST(doc_id AS VARCHAR) || '.txt') AS path FROM documents),
total AS (SELECT count(*) AS files FROM files),
fw AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM files),
df AS (SELECT word, count(DISTINCT doc_id) AS df FROM fw WHERE word IN (SELECT word FROM tw) GROUP BY 1),
idf AS (SELECT w.word, ln((files + 1.0) / (coalesce(df, 0) + 1)) + 1 AS idf
        FROM (SELECT DISTINCT word FROM tw) w LEFT JOIN df USING (word), total),
tv AS (SELECT template, licence, word, n * idf AS w FROM tw JOIN idf USING (word)),
tn AS (SELECT template, sqrt(sum(w * w)) AS size FROM tv GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM files),
lw AS (SELECT doc_id, i, unnest(regexp_extract_all(line, '[a-z0-9]+')) AS word FROM l),
notice AS (SELECT doc_id, i, i - dense_rank() OVER (PARTITION BY doc_id ORDER BY i) AS run
           FROM (SELECT doc_id, i FROM lw LEFT JOIN (SELECT DISTINCT word, 1 AS known FROM tw) USING (word)
                 GROUP BY 1, 2 HAVING count(known) >= {line_share} * count(*))),
unit AS (SELECT doc_id, i, 'line ' || i AS unit FROM notice UNION ALL SELECT doc_id, i, 'run ' || run FROM notice),
uw AS (SELECT doc_id, unit, word, count(*) AS n FROM unit JOIN lw USING (doc_id, i) GROUP BY 1, 2, 3),
weighed AS (SELECT doc_id, unit, word, n, n * coalesce(idf, ln(files + 1.0) + 1) AS w
            FROM uw LEFT JOIN idf USING (word), total),
size AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS size, sum(n) AS n_words FROM weighed GROUP BY 1, 2),
scored AS (SELECT w.doc_id, w.unit, t.licence, s.n_words, round(sum(w.w * t.w) / (any_value(s.size) * any_value(tn.size)), 6) AS cosine
           FROM weighed w JOIN tv t USING (word) JOIN tn USING (template) JOIN size s ON s.doc_id = w.doc_id AND s.unit = w.unit
           GROUP BY w.doc_id, w.unit, t.template, t.licence, s.n_words),
own AS (SELECT doc_id, first(licence ORDER BY cosine DESC, licence) AS licence, max(cosine) AS cosine, max(n_words) AS n_words
        FROM scored WHERE cosine >= {least} GROUP BY 1),
words AS (SELECT doc_id, count(*) AS all_words FROM fw GROUP BY 1),
homes AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS home FROM files),
given AS (SELECT home AS directory, first(licence ORDER BY cosine DESC, licence, path) AS licence, max(cosine) AS cosine
          FROM own JOIN words USING (doc_id) JOIN homes USING (doc_id) WHERE n_words >= {licence_share} * all_words GROUP BY 1),
nearest AS (SELECT h.doc_id, first(g.directory ORDER BY length(g.directory) DESC) AS directory
            FROM homes h JOIN given g ON g.directory = '' OR h.home = g.directory OR starts_with(h.home, g.directory || '/')
            GROUP BY 1)
SELECT h.doc_id, h.path, coalesce(o.licence, g.licence) AS licence, coalesce(o.cosine, g.cosine) AS cosine,
       CASE WHEN o.licence IS NOT NULL THEN 'notice' WHEN g.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.licence IS NULL THEN g.directory END AS directory
FROM homes h LEFT JOIN own o USING (doc_id) LEFT JOIN nearest n USING (doc_id) LEFT JOIN given g ON g.directory = n.directory
"""

LEXICAL_SEARCH = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
i AS (SELECT item_id, text, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, text, t, count(*) AS q FROM i GROUP BY ALL),
p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM p, s GROUP BY t),
scored AS (SELECT item_id, text, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) //
             (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
           FROM q JOIN p USING (t) JOIN weight USING (t), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20
"""


def merkle_manifest(levels: int = 5, fanout: int = 16) -> str:
    """Merkle proofs of sources of at most ``fanout ** levels`` documents, as many sources at most."""
    leaf = " || ".join(f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
                       for c in ("doc_id", "source", "lang", "n_chars", "text"))
    lower = leaf.replace("CAST(text AS", "CAST(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                         "'abcdefghijklmnopqrstuvwxyz') AS")

    def forest(name: str, tree: str) -> str:
        """Levels 1, 2, ... of the nodes of level 0, and the siblings of every node."""
        out = []
        for k in range(levels):
            out.append(f"""{name}{k + 1} AS (SELECT {tree}, i // {fanout} AS i, (n + {fanout - 1}) // {fanout} AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h
  FROM {name}{k} GROUP BY {tree}, i // {fanout}, n)""")
            run = f"OVER (PARTITION BY {tree}, i // {fanout} ORDER BY i ROWS BETWEEN"
            out.append(f"""{name}w{k} AS (SELECT {tree}, i, n,
  coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {name}{k})""")
        return ",\n".join(out)

    def climb(start: str, name: str, tree: str, on: str) -> tuple[str, str]:
        """Steps from table ``start`` (columns p, x, i) up the levels of a forest."""
        out, last = [], start
        for k in range(levels):
            out.append(f"""{start}{name}{k} AS (SELECT r.* REPLACE (r.p || w.a || w.b AS p,
  CASE WHEN w.n > 1 THEN sha256(w.a || r.x || w.b) ELSE r.x END AS x)
  FROM {last} r JOIN {name}w{k} w ON {on} AND w.i = r.{tree}i // {fanout ** k})""")
            last = f"{start}{name}{k}"
        return ",\n".join(out), last

    low, last = climb("c", "s", "", "w.source IS NOT DISTINCT FROM r.source")
    high, top = climb(last, "t", "s", "true")
    return f"""
WITH RECURSIVE e(k, s, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT k, s + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM e WHERE s < 8),
crc AS (SELECT list(v ORDER BY k) AS t FROM e WHERE s = 8),
f AS (SELECT doc_id, source, sha256({leaf}) AS leaf,
  CASE WHEN xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % 5 = 0
    THEN sha256({lower}) ELSE sha256({leaf}) END AS shown
  FROM documents, crc),
s0 AS (SELECT doc_id, source, leaf, shown, leaf AS h, count(*) OVER (PARTITION BY source) AS n,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM f),
{forest("s", "source")},
t0 AS (SELECT 0 AS z, source, h, h AS subroot, count(*) OVER () AS n,
  row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM s{levels}),
{forest("t", "z")},
c AS (SELECT s0.doc_id, s0.source, s0.leaf, t0.subroot, s0.i, t0.i AS si, s0.shown AS x, '' AS p
  FROM s0 JOIN t0 ON s0.source IS NOT DISTINCT FROM t0.source),
{low},
{high}
SELECT doc_id, leaf, subroot, (SELECT h FROM t{levels}) AS root, sha256(p) AS proof_sha256, x AS folded_root,
       x = (SELECT h FROM t{levels}) AS verified
FROM {top}
"""
