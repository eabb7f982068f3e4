"""DuckDB SQL for the queries whose contract SQL can express, written from the contracts."""

from __future__ import annotations

from .licenses import CONTAINMENT, PHRASES, TEMPLATES
from .url_filter import ALPHA, MIN_CHILDREN, MIN_SHARE, RULES, Z

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def components_sql(nodes: str, links: str) -> str:
    """(node, component) with the smallest reachable node; ``links`` (a, b) holds both directions."""
    return f"""reach(node, seen) AS (SELECT node, node FROM {nodes} UNION SELECT reach.node, l.b FROM reach JOIN {links} l ON l.a = reach.seen),
comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""


OP1 = f"""WITH RECURSIVE v AS (SELECT vec_id AS node, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.node AS a, y.node AS b FROM v x JOIN v y ON x.label = y.label AND x.node <> y.node AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
{components_sql("v", "links")},
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON a = vec_id LEFT JOIN comp ON node = vec_id"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(f"substr('{_LETTERS}', CAST((CAST('0x' || substr(h, {k * 5 + 1}, 5) AS INTEGER) >> {s}) & 31 AS INTEGER) + 1, 1)"
                      for k in range(8) for s in (15, 10, 5, 0))
OP2 = f"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
u AS (SELECT page_id, strlen(body) AS n, {_BASE32} AS digest, first,
  regexp_replace(replace(replace(replace(coalesce(url, 'urn:x-page:' || page_id), ' ', '%20'), '<', '%3C'), '>', '%3E'), '^$', '') AS t
  FROM p JOIN f USING (h)),
k AS (SELECT *, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN
    array_to_string(list_reverse(string_split(lower(regexp_extract(t, '://([^/?#]*)', 1)), '.')), ',') || ')' ||
    lower(coalesce(nullif(regexp_extract(t, '://[^/?#]*(.*)$', 1), ''), '/')) ELSE lower(t) END AS url_key FROM u)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, url_key,
  row_number() OVER (ORDER BY url_key, page_id) - 1 AS capture_no FROM k"""


def _op4() -> str:
    phrases = ", ".join(f"({words_sql(chr(39) + p + chr(39))}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join("({}, '{}')".format(words_sql("'" + t.replace("'", "''") + "'"), label) for label, t in TEMPLATES)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {words_sql("text")} AS w FROM documents),
ph(p, label) AS (VALUES {phrases}),
places AS (SELECT r, k - 1 AS first, label FROM (SELECT r, w, p, label, unnest(generate_series(1, len(w) - len(p) + 1)) AS k FROM d, ph
  WHERE list_has_all(w, p)) WHERE list_slice(w, k, k + len(p) - 1) = p),
base AS (SELECT r, count(*) AS n, min(first) AS lo, max(first) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
te AS (SELECT row_number() OVER () AS i, list_distinct(col0) AS t, len(col0) AS n, col1 AS label FROM (VALUES {templates})),
near AS (SELECT a.i AS i, b.i AS k, len(b.t) > len(a.t) AS more FROM te a, te b WHERE a.i <> b.i AND len(list_intersect(a.t, b.t)) / len(a.t) >= {CONTAINMENT} - 1e-12),
reach AS (SELECT te.i, greatest(any_value(te.n), coalesce(max(o.n), 0)) AS n FROM te LEFT JOIN near ON near.i = te.i LEFT JOIN te o ON o.i = near.k GROUP BY te.i),
li AS (SELECT r, w, k, sum(n) OVER (PARTITION BY r ORDER BY k) AS e, n FROM (SELECT r, w, unnest(generate_series(1, len(x))) AS k,
  unnest(list_transform(x, lambda y: len({words_sql("y")}))) AS n FROM (SELECT r, w, string_split(coalesce(text, ''), chr(10)) AS x FROM d))),
runs AS (SELECT l.r, l.k, l.w, l.e, l.n, te.i, te.t, te.label, (SELECT min(m.e) FROM li m WHERE m.r = l.r AND m.k >= l.k AND m.e >= l.e + reach.n) AS until
  FROM li l, te JOIN reach USING (i) WHERE l.n > 0 AND len(list_intersect(te.t, l.w)) / len(te.t) >= {CONTAINMENT} - 1e-12),
shares AS (SELECT r, k, i, label, len(list_intersect(t, list_slice(w, e - n + 1, e))) / len(t) AS own,
  len(list_intersect(t, list_slice(w, e - n + 1, coalesce(until, len(w))))) / len(t) AS run FROM runs),
met AS (SELECT r, k, i, label, CASE WHEN own >= {CONTAINMENT} - 1e-12 THEN own ELSE run END AS c FROM shares WHERE run >= {CONTAINMENT} - 1e-12),
best AS (SELECT r, label, c FROM met m WHERE NOT EXISTS (SELECT 1 FROM met o JOIN near ON near.i = m.i AND near.k = o.i
  WHERE o.r = m.r AND o.k = m.k AND (o.c > m.c OR (o.c = m.c AND near.more)))),
found AS (SELECT r, max(c) AS c FROM best GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM best UNION ALL SELECT r, label FROM places) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
  CASE WHEN n IS NOT NULL THEN 1.0 ELSE coalesce(c, 0.0) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r) LEFT JOIN al USING (r)"""


OP5 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql("text")} AS w FROM documents),
b AS (SELECT item_id, {words_sql("text")} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, k, k + 9) AS p FROM
  (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(p) AS n FROM win),
dw AS (SELECT r, k, n, list_slice(w, k, k + n - 1) AS p FROM
  (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r, k, n, item_id FROM dw JOIN win USING (p)),
pos AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS x FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM
  (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)"""

OP7 = f"""WITH RECURSIVE d AS (SELECT doc_id AS node, {words_sql("text")} AS w FROM documents),
sh AS (SELECT DISTINCT node, list_slice(w, k, k + 4) AS s FROM
  (SELECT node, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT node, count(*) AS n FROM sh GROUP BY node),
common AS (SELECT x.node AS a, y.node AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.node <> y.node GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n p ON p.node = a JOIN n q ON q.node = b WHERE c >= 0.8 * (p.n + q.n - c)),
{components_sql("n", "links")},
m AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component, doc_id) AS class_id, coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN m ON a = doc_id LEFT JOIN comp ON node = doc_id"""


#: Levels that the SQL of op6 spells out: more than the paths of the tables have (the operator has no such limit).
LEVELS = 16


def _op6() -> str:
    fits = {text: f"(host = '{text[:text.index('/')]}' OR ends_with(host, '.{text[:text.index('/')]}')) AND starts_with(path, '{text[text.index('/'):]}')"
            for _, text in RULES}
    longest = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits[t]} THEN '{t}'" for _, t in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[t]} THEN '{what}'" for what, t in longest) + " END"
    levels = []
    for k in range(1, LEVELS + 1):
        levels.append(f"""h{k} AS MATERIALIZED (SELECT host, t, segs[{k}] AS seg, sum(n) AS own FROM c{k - 1} WHERE len(segs) >= {k} GROUP BY ALL),
a{k} AS MATERIALIZED (SELECT host, t, sum(own) AS total, count(*) AS children FROM h{k} GROUP BY ALL),
c{k} AS MATERIALIZED (SELECT c.host, masked, n, allowed, blocked, segs, CASE WHEN len(segs) >= {k} THEN list_append(c.t,
    CASE WHEN children >= {MIN_CHILDREN} AND own < {MIN_SHARE} * total THEN '*' ELSE segs[{k}] END) ELSE c.t END AS t
  FROM c{k - 1} c LEFT JOIN h{k} h ON h.host = c.host AND h.t = c.t AND h.seg = c.segs[{k}] LEFT JOIN a{k} a ON a.host = c.host AND a.t = c.t),""")
    all_levels = "\n".join(levels)
    return f"""WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
j AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS by_rule, regexp_replace(path, '[0-9]+', '#', 'g') AS masked FROM s),
c AS (SELECT host, masked, count(*) AS n, count(*) FILTER (by_rule = 'allow') AS allowed, count(*) FILTER (by_rule = 'block') AS blocked,
  list_filter(string_split(masked, '/'), lambda x: x <> '') AS f FROM j GROUP BY host, masked),
c0 AS MATERIALIZED (SELECT host, masked, n, allowed, blocked, CASE WHEN len(f) > {LEVELS}
  THEN list_append(f[1:{LEVELS - 1}], array_to_string(f[{LEVELS}:], '/')) ELSE f END AS segs, CAST([] AS VARCHAR[]) AS t FROM c),
{all_levels}
nodes AS MATERIALIZED (SELECT host, t, sum(allowed) AS al, sum(blocked) AS bl, CASE WHEN len(t) > 0 THEN t[1:len(t) - 1] END AS up
  FROM c{LEVELS} GROUP BY host, t),
pooled AS (SELECT host, up, sum(al) AS pa, sum(bl) AS pb FROM nodes GROUP BY host, up),
g AS MATERIALIZED (SELECT nodes.*, CASE WHEN al + bl = 0 OR abs(bl / (al + bl) - pb / (pa + pb))
    <= {Z} * sqrt((pb / (pa + pb)) * (1 - pb / (pa + pb)) / (al + bl)) + 1e-12
  THEN list_append(coalesce(nodes.up, ['/']), '**') ELSE t END AS grp
  FROM nodes JOIN pooled ON nodes.host = pooled.host AND nodes.up IS NOT DISTINCT FROM pooled.up),
gs AS (SELECT host, grp, sum(al) AS ga, sum(bl) AS gb FROM g GROUP BY host, grp),
ts AS (SELECT t, sum(al) AS ta, sum(bl) AS tb FROM g GROUP BY t),
o AS (SELECT CASE WHEN sum(al + bl) > 0 THEN sum(bl) / sum(al + bl) ELSE 0.0 END AS overall FROM nodes),
v AS (SELECT g.host, g.t, (gb + {ALPHA} * ((tb + {ALPHA} * overall) / (ta + tb + {ALPHA}))) / (ga + gb + {ALPHA}) AS purity
  FROM g JOIN gs ON gs.host = g.host AND gs.grp = g.grp JOIN ts ON ts.t = g.t, o)
SELECT page_id, j.host, path, rule, coalesce(by_rule, CASE WHEN purity > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  '/' || array_to_string(d.t, '/') AS template
FROM j JOIN c{LEVELS} d ON d.host = j.host AND d.masked = j.masked JOIN v ON v.host = d.host AND v.t = d.t"""


OP13 = f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
lv AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
gs AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
lt AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
ls AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(gs.total, 0) + 5 * lv.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (lt.n + 5)) // (ls.total + 5 * lv.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN lv ON lv.lang = g.lang JOIN ls ON ls.lang = g.lang JOIN lt ON lt.lang = g.lang AND lt.term = k.term
  LEFT JOIN gs ON gs.lang = g.lang AND gs.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term
  WHERE a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 50"""


ORACLES = {"op1_embedding_dedup": OP1, "op2_warc": OP2, "op4_license_scan": _op4(), "op5_decontaminate": OP5, "op6_url_filter": _op6(), "op7_jaccard_join": OP7,
           "op13_source_audit": OP13}
