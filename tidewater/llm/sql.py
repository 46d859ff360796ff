"""DuckDB SQL for the numbered queries that SQL can express; tables as the driver registers them."""

from __future__ import annotations

from tidewater.llm import licenses, mixing, secrets

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), pat AS (
  SELECT DISTINCT item_id, 10 AS n, array_to_string(w[k:k + 9], ' ') AS p FROM i, unnest(range(1, len(w) - 8)) AS t(k) WHERE len(w) >= 10
  UNION
  SELECT item_id, len(w), array_to_string(w, ' ') FROM i WHERE len(w) BETWEEN 1 AND 9
), lens AS (SELECT DISTINCT n FROM pat),
occ AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS p FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(k)
), hits AS (SELECT doc_id, k, n, item_id FROM occ JOIN pat USING (n, p)),
hw AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM hits, unnest(range(0, n)) AS t(j) GROUP BY doc_id),
hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.doc_id = hw.doc_id LEFT JOIN hi ON d.doc_id = hi.doc_id
"""

_names = ", ".join(f"({_quote(k)}, {_quote(v)})" for k, v in licenses.NAMES.items())
_rules = ", ".join(f"({_quote(a)}, {_quote(b)}, {_quote(c)})" for a, b, c in licenses.SEQUENCES)
_normal = "trim(regexp_replace(" + _LOWER.format("{}") + ", '[^a-z0-9]+', ' ', 'g'))"
for _pattern, _fill in licenses.FILLS:
    _normal = f"regexp_replace({_normal}, {_quote(_pattern)}, {_quote(_fill)}, 'g')"
_licences = ", ".join(f"({_quote(k)}, {_quote(v)})" for k, v in licenses.LICENCES.items())
LICENSES = rf"""
WITH known(sentence, name) AS (VALUES {_names}), rules(rule, licence, seq) AS (VALUES {_rules}), whole(stretch, licence) AS (VALUES {_licences}),
s AS (
  SELECT doc_id, k, part[k] AS sentence FROM (
    SELECT doc_id, string_split(regexp_replace(text, '{licenses.END}', chr(1) || '\1', 'g'), chr(1)) AS part
    FROM documents WHERE regexp_matches(text, '{licenses.KEYWORDS}')
  ), unnest(range(1, len(part) + 1)) AS t(k)
  WHERE trim(translate(part[k], chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')) <> ''
), n AS (
  SELECT doc_id, k, coalesce(a.name, b.name, '{licenses.UNKNOWN}') AS name
  FROM s LEFT JOIN known a ON a.sentence = {_normal.format('s.sentence')}
  LEFT JOIN known b ON b.sentence = {_normal.format("string_split(s.sentence, chr(10))[-1]")}
), q AS (
  SELECT doc_id, ',' || string_agg(name, ',' ORDER BY k) || ',' AS seq, '<' || string_agg(name, '><' ORDER BY k) || '>' AS marks,
    count(*) FILTER (WHERE name <> '{licenses.UNKNOWN}') AS n_known,
    string_agg(name, ',' ORDER BY k) FILTER (WHERE name <> '{licenses.UNKNOWN}') AS ids
  FROM n GROUP BY doc_id
), m AS (
  SELECT doc_id, list_sort(list_distinct(list(rule))) AS rules
  FROM q JOIN rules ON regexp_matches(q.seq, rules.seq) GROUP BY doc_id
), x AS (
  SELECT doc_id, list_sort(list_distinct(list(licence))) AS licences
  FROM (SELECT doc_id, replace(unnest(regexp_extract_all(marks, {_quote(licenses.STRETCH)})), '<{licenses.UNKNOWN}>', '') AS stretch FROM q) JOIN whole USING (stretch) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_known, 0) AS BIGINT) AS n_known, coalesce(ids, '') AS sentence_ids,
  coalesce(array_to_string(rules, ','), '') AS rules, coalesce(array_to_string(licences, ','), '') AS licences
FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id LEFT JOIN m ON d.doc_id = m.doc_id LEFT JOIN x ON d.doc_id = x.doc_id
"""

SUBSTRINGS = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS p FROM d, unnest(range(1, len(w) - 18)) AS t(k)
), late AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY p ORDER BY doc_id, k) AS nth FROM win) WHERE nth > 1
), gone AS (SELECT DISTINCT doc_id, k + j AS k FROM late, unnest(range(0, 20)) AS t(j)),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.k) AS words
  FROM (SELECT doc_id, k, w[k] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(k)) x
  LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.k = g.k WHERE g.k IS NULL GROUP BY x.doc_id
), n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

_weights = f"list_value({', '.join(map(str, mixing.WEIGHTS))})"
_tilts = "[" + ", ".join(f"CAST({t} AS DOUBLE)" for t in mixing.TILTS) + "]"

MIXING = rf"""
WITH z AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), t AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    {_weights}[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.WEIGHTS)}] AS weight,
    {_tilts}[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(mixing.TILTS)}] AS tilt
  FROM z GROUP BY source
), l AS (
  SELECT *, source_size * {mixing.REPEATS} AS lim,
    (CAST(sum(source_size) OVER () AS DOUBLE) * {mixing.BUDGET} - CAST(coalesce(sum(source_size * {mixing.REPEATS}) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
      / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM t WINDOW o AS (ORDER BY CAST(source_size * {mixing.REPEATS} AS DOUBLE) / weight, source IS NULL, source)
), g AS (
  SELECT source, source_size, tilt, least(CAST(lim AS DOUBLE), coalesce(weight * max(level) FILTER (WHERE level * weight <= lim) OVER (), CAST(lim AS DOUBLE))) AS target FROM l
), c AS (
  SELECT z.doc_id, z.size, z.source, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS beg FROM z
), u AS (
  SELECT c.doc_id, c.size, g.source_size, g.target, tilt, beg, CAST(round(target) AS BIGINT) AS goal,
    CASE WHEN g.source_size > 0 THEN CAST(round(target) AS BIGINT) // g.source_size ELSE 0 END AS epochs
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
), v AS (
  SELECT *, greatest(0, least(size, goal - epochs * source_size - beg)) AS rest FROM u
), x AS (
  SELECT *, list_transform(range(0, CASE WHEN size = 0 THEN 0 ELSE epochs + CAST(rest > 0 AS BIGINT) END), lambda k: (k * source_size + beg) / CAST(goal AS DOUBLE)) AS shares FROM v
)
SELECT doc_id, size, source_size, target, CAST(epochs * size + rest AS BIGINT) AS taken,
  list_transform(shares, lambda s: CASE WHEN tilt = 0 THEN s ELSE (1 + tilt - sqrt(greatest((1 + tilt) * (1 + tilt) - 4 * tilt * s, 0))) / (2 * tilt) + 0.0 END) AS positions
FROM x
"""

MINHASH = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS p FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS t(k) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.p = b.p AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), r AS (SELECT a AS doc_id, a AS other FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT doc_id, min(other) AS c FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.c, w.doc_id) AS component_id, coalesce(c.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""


def _matches(kind: str, pattern: str, group: int = 0) -> str:
    """Matches of ``pattern`` with their places, counted by what lies before them."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, m[k] AS match, g[k] AS grp,
    CAST(coalesce(list_sum(list_transform(b[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS beg
  FROM (SELECT doc_id, regexp_extract_all(text, {_quote(pattern)}) AS m, regexp_extract_all(text, {_quote(pattern)}, {group}) AS g,
    string_split_regex(text, {_quote(pattern)}) AS b FROM documents WHERE regexp_matches(text, {_quote(pattern)})), unnest(range(1, len(m) + 1)) AS t(k)"""


_base = " UNION ALL ".join(f"SELECT * FROM ({_matches(k, p, g)}) WHERE length(grp) >= {least}" for k, (p, g, least) in secrets.BASE_RULES.items())
_class = " ".join(f"WHEN regexp_matches(match, '{p}') THEN {limit}" for _, p, limit in secrets.CLASSES)
_w = secrets.WIDTH
_order = " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(secrets.KINDS))
SECRETS = rf"""
WITH base AS (SELECT doc_id, kind, beg, beg + length(match) AS fin FROM ({_base})),
tok AS (
  SELECT doc_id, beg, match, CASE {_class} END AS lim FROM ({_matches('entropy', secrets.CANDIDATE)})
  WHERE NOT regexp_matches(match, '{secrets.ALLOWED}')
), slide AS (
  SELECT doc_id, beg, lim, j, log2({_w}) - list_sum(list_transform(list_distinct(string_split(substr(match, j, {_w}), '')),
    lambda c: ({_w} - length(replace(substr(match, j, {_w}), c, ''))) * log2({_w} - length(replace(substr(match, j, {_w}), c, ''))))) / {_w} AS h
  FROM tok t, unnest(range(1, length(match) - {_w} + 2)) AS u(j)
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.beg <= t.beg AND t.beg + length(match) <= b.fin)
), ent AS (
  SELECT doc_id, 'entropy' AS kind, beg + min(j) - 1 AS beg, beg + max(j) - 1 + {_w} AS fin FROM slide WHERE h >= lim GROUP BY doc_id, slide.beg
), spans AS (
  SELECT doc_id, kind, beg, CASE kind {_order} END AS nth, kind || ':' || beg || ':' || fin AS word FROM (FROM base UNION ALL FROM ent)
), a AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS k, count(*) FILTER (WHERE kind = 'hex') AS x,
    count(*) FILTER (WHERE kind = 'entropy') AS e, string_agg(word, ',' ORDER BY beg, nth) FILTER (WHERE kind <> 'entropy') AS b,
    string_agg(word, ',' ORDER BY beg, nth) AS w FROM spans GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(k, 0) AS BIGINT) AS n_access, CAST(coalesce(x, 0) AS BIGINT) AS n_hex,
  CAST(coalesce(e, 0) AS BIGINT) AS n_entropy, sha256(coalesce(b, '')) AS base_sha256, coalesce(w, '') AS spans
FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id
"""

NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS alike, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""

NEAR_VECTORS = """
WITH RECURSIVE r AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM r AS a JOIN r AS b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT a AS vec_id, a AS seen FROM l UNION SELECT reach.vec_id, l.b FROM reach JOIN l ON l.a = reach.seen
), c AS (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id, coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
"""

ORACLE_SQL = {
    "op3_decontamination": DECONTAMINATION,
    "op4_licenses": LICENSES,
    "op5_substrings": SUBSTRINGS,
    "op6_mixing": MIXING,
    "op9_minhash": MINHASH,
    "op10_secrets": SECRETS,
    "op11_negatives": NEGATIVES,
    "op12_near_vectors": NEAR_VECTORS,
}
