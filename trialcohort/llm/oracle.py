"""DuckDB SQL with the same rows as the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

# texts with words, in order of place; chr() spells the white space
SOLID = "'[^\\x20\\x09-\\x0D]+'"
ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
LETTERS = "'[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(column: str, kind: str, lower: bool) -> str:
    text = f"coalesce({column}, '')"
    return f"regexp_extract_all({LOWER.format(text) if lower else text}, {kind})"


OP3 = f"""
WITH d AS (SELECT doc_id, {words('text', ALNUM, True)} AS w FROM documents),
i AS (SELECT item_id, {words('text', ALNUM, True)} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM iw) s)
),
hits AS (SELECT DISTINCT dw.doc_id, dw.k, dw.size, iw.item_id FROM dw JOIN iw USING (size, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP7 = r"""
WITH l AS (
  SELECT doc_id, line, place FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents WHERE text IS NOT NULL
  )
),
w AS (
  SELECT doc_id, place, line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS win
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY place)
),
f AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY win ORDER BY doc_id, place) AS nth
  FROM w WHERE win IS NOT NULL AND regexp_matches(win, '[^\x20\x09-\x0D]')
),
gone AS (SELECT DISTINCT doc_id, unnest([place, place + 1, place + 2]) AS place FROM f WHERE nth > 1),
k AS (SELECT l.doc_id, l.place, l.line, g.place IS NOT NULL AS out FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place)
SELECT d.doc_id, CAST(count(k.place) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE k.out) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE NOT k.out), '')) AS kept_sha256
FROM documents d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""

OP9 = f"""
WITH d AS (SELECT doc_id, {words('text', SOLID, False)} AS w FROM documents),
v AS (SELECT doc_id, k, md5(array_to_string(w[k:k + 34], ' ')) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d)),
r AS (SELECT win FROM v GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM v SEMI JOIN r USING (win)),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT t.doc_id, t.p, t.word, g.p IS NOT NULL AS out FROM t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.p = t.p)
SELECT d.doc_id, CAST(count(k.p) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE k.out) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(k.word, ' ' ORDER BY k.p) FILTER (WHERE NOT k.out), '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""

OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words('text', SOLID, True)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (sh) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


OP11 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words('text', SOLID, True)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 2], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (sh) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {words('text', LETTERS, True)} AS w
  FROM documents
),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
lt AS (SELECT lang, term, count(*) AS lc FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
lv AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM lt GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN lt USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN gc USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
    CAST(1 + (1000000000 * (CAST(coalesce(c, 0) AS HUGEINT) + 2)) // (n + 2 * v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (CAST(lc AS HUGEINT) + 2)) // (ln + 2 * v) AS BIGINT) AS q
  FROM gn JOIN lt USING (lang) JOIN lv USING (lang) LEFT JOIN gc USING (lang, source, term)
),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
rows AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM rows
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR k <= 10
"""

OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {words('text', SOLID, False)} AS w FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN l USING (doc_id)
),
m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails
),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
s AS (SELECT filter_order, step, filter_order[step] AS c FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, fails, n, good, toxic, list_min([instr(filter_order, y) FOR y IN string_split(fails, '') IF y <> '']) AS gone FROM m, o),
k AS (
  SELECT part, filter_order, step, c,
    sum(CASE WHEN gone IS NULL OR gone > step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone < step AND contains(fails, c) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = c THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM r JOIN s USING (filter_order) GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley
FROM k
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_prefix_decontamination": OP3,
        "op7_line_windows": OP7,
        "op9_recompression_dedup": OP9,
        "op10_circulant_minhash": OP10,
        "op11_partenum_join": OP11,
        "op12_source_divergence": OP12,
        "op13_filter_interaction": OP13,
    }
