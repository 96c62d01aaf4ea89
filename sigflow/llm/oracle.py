"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

from sigflow.llm import urls
from sigflow.llm.quality import BULLETS, ELLIPSES, STOP_WORDS

_WS = r"[\x20\x09-\x0D]"


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values))


def _any_of(column: str, function: str, marks) -> str:
    return " OR ".join(f"{function}({column}, '{m}')" for m in marks)


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '{_WS}+')) AS word,
               generate_subscripts(regexp_split_to_array(t, '{_WS}+'), 1) AS pos FROM d)
  WHERE word <> ''
),
tri AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s AS g
  FROM w WINDOW s AS (PARTITION BY doc_id ORDER BY i)
),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri WHERE g IS NOT NULL)
  WHERE c > 1
),
cov AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (
    SELECT doc_id, i FROM rep UNION ALL SELECT doc_id, i + 1 FROM rep UNION ALL SELECT doc_id, i + 2 FROM rep)
  GROUP BY doc_id
),
ws AS (
  SELECT doc_id, count(*) AS n, sum(length(word)) AS chars,
         count(*) FILTER (WHERE lower(word) IN ({_sql_list(STOP_WORDS)})) AS stops
  FROM w GROUP BY doc_id
),
ln AS (
  SELECT doc_id, count(*) AS n, count(DISTINCT line) AS nd,
         count(*) FILTER (WHERE {_any_of("tl", "starts_with", BULLETS)}) AS bullets,
         count(*) FILTER (WHERE {_any_of("tl", "ends_with", ELLIPSES)}) AS ellipses
  FROM (SELECT doc_id, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tl
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d))
  WHERE tl <> '' GROUP BY doc_id
),
m AS (
  SELECT d.doc_id, coalesce(ws.n, 0) AS n_words, CAST(coalesce(ws.chars, 0) AS BIGINT) AS word_chars,
         length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(ln.n - ln.nd, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         coalesce(ws.stops, 0) AS stops, coalesce(ln.n, 0) AS lines,
         coalesce(ln.bullets, 0) AS bullets, coalesce(ln.ellipses, 0) AS ellipses
  FROM d LEFT JOIN ws USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN ln USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND word_chars / n_words BETWEEN 2.0 AND 15.0
         AND n_symbols / n_words <= 0.1
         AND stops / n_words >= 0.02
         AND n_dup_lines / lines <= 0.5
         AND bullets / lines <= 0.9
         AND ellipses / lines <= 0.5 AS kept
FROM m
"""


def _rule_case(value) -> str:
    whens = []
    for r in sorted(urls.RULES, key=lambda r: (-len(r.pattern), r.pattern)):
        cut = r.pattern.index("/")
        h, p = r.pattern[:cut], r.pattern[cut:]
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        whens.append(f"WHEN {fits} THEN '{value(r)}'")
    return "CASE " + " ".join(whens) + " END"


def _url_level(k: int) -> str:
    g, before = f"g{k}", f"nodes{k - 1}"
    z = repr(urls.Z * urls.Z)
    return f"""
parent{k} AS (
  SELECT node, count(DISTINCT {g}) AS kids, sum(lab) AS p_lab, sum(bad) AS p_bad FROM {before} GROUP BY node
),
child{k} AS (
  SELECT c.*, CASE WHEN c.{g} <> '' AND ((kids >= {urls.MANY_CHILDREN} AND c_n <= {urls.RARE})
    OR CAST(c_bad * p_lab - p_bad * c_lab AS DOUBLE) * CAST(c_bad * p_lab - p_bad * c_lab AS DOUBLE)
       <= CAST('{z}' AS DOUBLE) * CAST(p_bad AS DOUBLE) * CAST(p_lab - p_bad AS DOUBLE) * CAST(c_lab AS DOUBLE))
    THEN '*' ELSE c.{g} END AS t
  FROM (SELECT node, {g}, sum(n) AS c_n, sum(lab) AS c_lab, sum(bad) AS c_bad, any_value(rate) AS p_rate
        FROM {before} GROUP BY node, {g}) c JOIN parent{k} USING (node)
),
merged{k} AS (
  SELECT node, t, (sum(c_bad) + {urls.STRENGTH!r}::DOUBLE * any_value(p_rate)) / (sum(c_lab) + {urls.STRENGTH!r}::DOUBLE) AS new_rate
  FROM child{k} GROUP BY node, t
),
nodes{k} AS (
  SELECT n.* REPLACE (n.node || '/' || c.t AS node, m.new_rate AS rate)
  FROM {before} n JOIN child{k} c ON n.node = c.node AND n.{g} = c.{g}
  JOIN merged{k} m ON m.node = c.node AND m.t = c.t
)"""


_SHAPES = ", ".join(
    f"regexp_replace(coalesce(list_filter(string_split(path, '/'), lambda x: x <> '')[{k + 1}], ''), '[0-9]+', '#', 'g') AS g{k + 1}"
    for k in range(urls.DEPTH)
)
_GS = ", ".join(f"g{k + 1}" for k in range(urls.DEPTH))

URLS = f"""
WITH rest AS (
  SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '') AS r
  FROM pages
),
split AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
known AS (
  SELECT doc_id AS id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL THEN 0 END) AS bad
  FROM labels GROUP BY doc_id
),
cut AS (
  SELECT page_id, host, path, {_rule_case(lambda r: r.pattern)} AS rule, {_rule_case(lambda r: r.verdict)} AS rule_verdict,
         {_SHAPES}, CASE WHEN bad IS NOT NULL THEN 1 ELSE 0 END AS lab, coalesce(bad, 0) AS bad
  FROM split LEFT JOIN known ON page_id = id
),
shapes AS (SELECT host, {_GS}, count(*) AS n, sum(lab) AS lab, sum(bad) AS bad FROM cut GROUP BY host, {_GS}),
total AS (
  SELECT (coalesce(sum(bad), 0) + {urls.STRENGTH * urls.PRIOR!r}::DOUBLE) / (coalesce(sum(lab), 0) + {urls.STRENGTH!r}::DOUBLE) AS rate
  FROM shapes
),
hosts AS (
  SELECT host, (sum(bad) + {urls.STRENGTH!r}::DOUBLE * (SELECT rate FROM total)) / (sum(lab) + {urls.STRENGTH!r}::DOUBLE) AS rate
  FROM shapes GROUP BY host
),
nodes0 AS (SELECT shapes.*, hosts.rate, shapes.host AS node FROM shapes JOIN hosts USING (host)),
{",".join(_url_level(k + 1) for k in range(urls.DEPTH))}
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN 1.0::DOUBLE - rate < {urls.PURITY!r}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
       node AS template
FROM cut JOIN nodes{urls.DEPTH} USING (host, {_GS})
"""

NEAREST = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         list_sum(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * d.x[i])) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.x) = len(d.x) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

# Every prefix of every rebuilt conversation as a string of digests; subtrees by the prefixes of that
# string. The checksum of the id is worked out bit by bit.
TRIE = """
WITH own AS (
  SELECT conv_id, list({d: sha256(length(r) || ':' || r || x), c: length(x)}
                       ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS steps
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
        FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
checksum AS (
  SELECT conv_id, steps, conv_id - conv_id % 100 AS base, xor(list_reduce(
    flatten(list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i:
      list_transform(range(0, 8), lambda b: (ascii(CAST(conv_id AS VARCHAR)[i])::BIGINT >> b) & 1))),
    lambda acc, bit: CASE WHEN (acc & 1) != bit THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END,
    4294967295::BIGINT), 4294967295) % 6 AS h
  FROM own),
paths AS (
  SELECT a.conv_id, list_concat(coalesce(b.steps[1:a.h], []), a.steps[a.h + 1:]) AS path
  FROM checksum a LEFT JOIN own b ON a.base = b.conv_id),
members AS (
  SELECT conv_id, d AS depth, len(path) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE path[d].c END AS chars,
         array_to_string(list_transform(path[1:d], lambda s: s.d), '') AS node
  FROM paths, unnest(range(0, len(path) + 1)) AS u(d)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256,
         CASE WHEN depth > 0 THEN substr(node, 1, 64 * (depth - 1)) END AS parent
  FROM members GROUP BY node, depth),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
subtrees AS (
  SELECT substr(u.node, 1, 64 * k) AS node, sum(u.saved) AS saved_tokens, count(*) FILTER (c.n IS NULL) AS n_leaves
  FROM nodes u LEFT JOIN children c ON u.node = c.parent, unnest(range(0, u.depth + 1)) AS a(k)
  GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v JOIN subtrees s ON v.node = s.node
LEFT JOIN children c ON v.node = c.parent
LEFT JOIN nodes p ON v.parent = p.node
"""

# Every window of 20 words by its words; a word goes if a window over it has an earlier start.
SUBSTRING = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS s FROM w, unnest(range(1, len(words) - 18)) AS u(i)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM later, range(0, 20) AS r(k)),
each AS (
  SELECT e.doc_id, e.j, e.word, g.j IS NOT NULL AS removed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w) e
  LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j),
runs AS (SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY j), false) AS starts FROM each),
told AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, count(*) FILTER (starts) AS n_spans,
         string_agg(word, ' ' ORDER BY j) FILTER (NOT removed) AS kept
  FROM runs GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, coalesce(t.n_removed, 0) AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256, coalesce(t.n_spans, 0) AS n_spans
FROM w LEFT JOIN told t ON w.doc_id = t.doc_id
"""

# All pairs that share a shingle, and the closure of their links.
JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
tokens AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS s
  FROM w, unnest(range(1, greatest(len(words) - 2, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS u(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM tokens a JOIN tokens b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM w
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT w.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.v) AS component_id
FROM w JOIN reach r ON w.doc_id = r.u LEFT JOIN sizes s ON s.doc_id = w.doc_id GROUP BY w.doc_id
"""
