"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

import math

from quotemill.llm.weak_quality import GOOD, ITERATIONS, LEAST_WORDS, MOST_REPEATED, ON_BAD, ON_GOOD, PSEUDO, RULES


_OP2 = """
WITH t AS (SELECT conv_id, turn, role, text FROM conversations),
last AS (SELECT conv_id, max(turn) AS turn FROM t WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY conv_id),
answer AS (SELECT t.conv_id, max(t.text) AS text FROM t JOIN last USING (conv_id, turn) WHERE role = 'assistant' GROUP BY 1),
rej AS (
  SELECT t.conv_id, t.turn, t.role,
         CASE WHEN t.role = 'assistant' AND t.turn = l.turn AND a.conv_id IS NOT NULL THEN a.text ELSE t.text END AS text
  FROM t LEFT JOIN last l ON t.conv_id = l.conv_id LEFT JOIN answer a ON a.conv_id = xor(t.conv_id, 1)),
c AS (SELECT conv_id, turn, role, text, count(*) AS n FROM t GROUP BY ALL),
r AS (SELECT conv_id, turn, role, text, count(*) AS n FROM rej GROUP BY ALL),
b AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, coalesce(c.role, r.role) AS role,
         coalesce(c.text, r.text) AS text, coalesce(c.n, 0) AS c, coalesce(r.n, 0) AS r
  FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.turn = r.turn AND c.role = r.role AND c.text = r.text),
f AS (SELECT conv_id, min(turn) FILTER (WHERE c <> r) AS first FROM b GROUP BY conv_id),
s AS (
  SELECT b.*, 'prompt' AS part, c AS copies FROM b JOIN f USING (conv_id) WHERE first IS NULL OR turn < first
  UNION ALL SELECT b.*, 'chosen', c FROM b JOIN f USING (conv_id) WHERE turn >= first AND c > 0
  UNION ALL SELECT b.*, 'rejected', r FROM b JOIN f USING (conv_id) WHERE turn >= first AND r > 0)
SELECT conv_id AS pair_id, part, turn, role, copies,
       CAST(part <> 'prompt' AND role = 'assistant' AS INTEGER) AS mask,
       '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered
FROM s
"""

_OP3 = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 'v' || source END AS s,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
src AS (
  SELECT s, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY s)) - 1) % 3 + 1] AS w
  FROM d GROUP BY s),
lvl AS (
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS lft,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS opn
  FROM src WINDOW o AS (ORDER BY 3 * source_size / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first AS (SELECT lft, opn FROM lvl WHERE lft * w <= cap * opn ORDER BY cap / w, s LIMIT 1),
tgt AS (
  SELECT s, source_size,
         least(CAST(cap AS DOUBLE), CAST(first.lft * w AS DOUBLE) / CAST(first.opn AS DOUBLE)) AS target
  FROM lvl, first),
run AS (
  SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.s ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN tgt ON d.s = tgt.s)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM run
"""

_OP9 = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS q
  FROM (SELECT page_id, url, html, coalesce(rest, '') AS rest FROM p)),
seen AS (SELECT * REPLACE (regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\b|\z)|<style\b.*?(?:</style\b|\z)', ' ', 'g') AS html) FROM u),
a AS (SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || q END AS node FROM seen),
tag AS (
  SELECT a.*, unnest(list_concat(
    list_filter(regexp_extract_all(html, '(?i)<link\s[^<>]*>'), lambda x: regexp_matches(x, '(?i)\srel\s*=\s*["'']?[^"''>]*\bcanonical\b')),
    list_filter(regexp_extract_all(html, '(?i)<meta\s[^<>]*>'), lambda x: regexp_matches(x, '(?i)http-equiv\s*=\s*["'']?refresh\b')))) AS tag
  FROM a),
raw AS (
  SELECT node, host, path, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme, replace(trim(
    CASE WHEN lower(tag) LIKE '<link%' THEN regexp_extract(tag, '(?i)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
      || regexp_extract(tag, '(?i)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2)
      || regexp_extract(tag, '(?i)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)
    ELSE regexp_extract(tag, '(?i)\scontent\s*=\s*["'']?\s*[\d.]+\s*[;,]\s*url\s*=\s*["'']?([^"''>\s]+)', 1) END), '&amp;', '&') AS link
  FROM tag),
absolute AS (
  SELECT node, CASE WHEN link = '' OR link LIKE '#%' THEN NULL
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN link LIKE '//%' THEN scheme || ':' || link
    WHEN link LIKE '/%' THEN scheme || '://' || host || link
    WHEN link LIKE '?%' THEN scheme || '://' || host || path || link
    ELSE scheme || '://' || host || regexp_replace(CASE WHEN path = '' THEN '/' ELSE path END, '[^/]*$', '') || link END AS to_url
  FROM raw),
parts AS (SELECT node, substr(to_url, instr(to_url, '://') + 3) AS rest FROM absolute WHERE to_url IS NOT NULL),
links AS (
  SELECT DISTINCT node AS a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END
    || regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS b
  FROM parts WHERE regexp_extract(rest, '^[^/?#]*') <> '' AND node IS NOT NULL),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (SELECT node FROM a WHERE node IS NOT NULL UNION SELECT b FROM reach),
rules(verdict, h, s) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
parsed AS (SELECT node, regexp_extract(node, '^[^/?#]*') AS host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) AS path FROM nodes),
ruled AS (
  SELECT node, arg_max(verdict, length(h || s)) AS verdict FROM parsed JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY node),
carried AS (
  SELECT a AS node, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
  FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY a),
own AS (
  SELECT page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(verdict, length(h || s)) AS verdict
  FROM a JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id)
SELECT a.page_id, a.host, a.path, own.rule, coalesce(own.verdict, carried.verdict, 'allow') AS verdict
FROM a LEFT JOIN own USING (page_id) LEFT JOIN carried USING (node)
"""

_OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]
                        for i in range(1, len(w) - 3)]) END AS g
  FROM d),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
  WHERE 100 * c >= 75 * (len(sa.g) + len(sb.g) - c)),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(m, s.doc_id) AS kept
FROM s LEFT JOIN low ON low.a = s.doc_id
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11 = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (SELECT doc_id, regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(LOWER_TEXT, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
words AS (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM d UNION ALL SELECT unnest(w) FROM b)),
hexed AS (SELECT w, hex(encode(w)) AS h FROM words),
bytes AS (
  SELECT w, list_transform(range(CAST(length(h) // 2 AS BIGINT)), lambda i: CAST(
    16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS BIGINT)) AS x
  FROM hexed),
slot AS (
  SELECT w, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], x),
    lambda c, y: xor(c >> 8, tab[CAST((xor(c, y) & 255) + 1 AS BIGINT)]))) % 10000 AS k
  FROM bytes, crc),
s AS (SELECT k, count(*) AS n FROM (SELECT unnest(w) AS w FROM d) JOIN slot USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) JOIN slot USING (w) GROUP BY k),
tot AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s_all, coalesce((SELECT sum(n) FROM t), 0) AS t_all),
gain AS (
  SELECT s.k, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (s_all + 10000) AS DOUBLE)
                                   / CAST((s.n + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (k), tot),
weighed AS (
  SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS g
  FROM (SELECT doc_id, unnest(w) AS w FROM d) JOIN slot USING (w) JOIN gain USING (k) GROUP BY doc_id),
sc AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features,
         CASE WHEN n IS NULL THEN 0 WHEN g < 0 AND g % n <> 0 THEN g // n - 1 ELSE g // n END AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT)
                                    + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
  FROM d LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place,
         count(*) OVER () * 10 // 100 AS many
  FROM sc WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= many THEN place END AS rank
FROM sc LEFT JOIN ranked USING (doc_id)
""".replace("LOWER_TEXT", _LOWER.format("coalesce(text, '')"))


def _op12() -> str:
    """Measures, votes and the iteration itself, over the counts of vote patterns."""
    def vote(rule):
        _, what, scale, worst_low, low, high, worst_high = rule
        x, of = f"100 * {what}", "1" if scale == "one" else scale
        bad = [f"{x} {op} {int(limit)} * {of}" for op, limit, used in (
            ("<", worst_low, worst_low > 0), (">", worst_high, worst_high < math.inf)) if used]
        good = f"{x} >= {int(low)} * {of}" + (f" AND {x} <= {int(high)} * {of}" if high < math.inf else "")
        return f"CASE WHEN {of} <= 0 THEN 0 WHEN {' OR '.join(bad) or 'false'} THEN -1 WHEN {good} THEN 1 ELSE 0 END"

    n = len(RULES)
    votes = ", ".join(f"{vote(r)} AS v{j}" for j, r in enumerate(RULES))
    v = ", ".join(f"v{j}" for j in range(n))
    odds = "ln(share / (1 - share))" + "".join(
        f" + CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END" for j in range(n))

    def bounded(bounds, right, every):
        begin, least, most = bounds
        return (f"least({most}, greatest({least}, (coalesce(sum({right}), 0) + {PSEUDO * begin})"
                f" / (coalesce(sum({every}), 0) + {PSEUDO})))")

    step = ", ".join([f"least({GOOD[2]}, greatest({GOOD[1]}, sum(c * q) / sum(c)))"] + [
        bounded(ON_GOOD, f"CASE WHEN v{j} > 0 THEN c * q END", f"CASE WHEN v{j} <> 0 THEN c * q END") for j in range(n)] + [
        bounded(ON_BAD, f"CASE WHEN v{j} < 0 THEN c * (1 - q) END", f"CASE WHEN v{j} <> 0 THEN c * (1 - q) END")
        for j in range(n)])
    names = ", ".join(["share"] + [f"g{j}" for j in range(n)] + [f"b{j}" for j in range(n)])
    start = ", ".join([f"CAST({x} AS DOUBLE)" for x in [GOOD[0]] + [ON_GOOD[0]] * n + [ON_BAD[0]] * n])
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, w[i:i + 4] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, x FROM win GROUP BY doc_id, x HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS pos FROM win JOIN twice USING (doc_id, x)) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
         len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters,
         len(regexp_extract_all(text, '[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) AS n_marks, len(list_distinct(w)) AS n_distinct,
         len(list_filter(w, lambda x: regexp_matches(x, '[.!?]$'))) AS n_ends,
         len(list_filter(w, lambda x: regexp_matches(x, '^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$'))) AS n_bare
  FROM d LEFT JOIN rep USING (doc_id)),
voted AS (SELECT *, {votes} FROM m),
pat AS (SELECT {v}, count(*) AS c FROM voted GROUP BY ALL),
em AS (
  SELECT 0 AS it, {', '.join(f'{x} AS {y}' for x, y in zip(start.split(', '), names.split(', ')))}
  UNION ALL
  SELECT it + 1, {step}
  FROM (SELECT em.it, pat.*, 1 / (1 + exp(-({odds}))) AS q FROM em, pat WHERE it < {ITERATIONS}) GROUP BY it),
final AS (SELECT {v}, 1 / (1 + exp(-({odds}))) AS q FROM em, pat WHERE it = {ITERATIONS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND q >= 0.5 AS kept
FROM voted JOIN final USING ({v})
"""


_OP13 = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(LOWER_TEXT, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS p FROM docs)),
occ AS (
  SELECT lang, 1 AS n, unnest(w) AS phrase FROM pieces
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM pieces),
f AS (SELECT lang, n, phrase, count(*) AS f FROM occ GROUP BY ALL),
tot AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE n = 1 GROUP BY lang),
cand AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND f >= 10),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, n)) AS k FROM cand)),
val AS (
  SELECT cut.lang, cut.phrase, a, k, fx.f AS l, fy.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(fx.f AS HUGEINT) * fy.f) AS BIGINT) AS score
  FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y),
best AS (SELECT lang, phrase, a, l, r, score FROM val QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ins AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM cand WHERE n = 3) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN ins USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT top.lang, rank, phrase, a, l, r, tot.n, score FROM top JOIN tot ON tot.lang = top.lang WHERE rank <= 2000
""".replace("LOWER_TEXT", _LOWER.format("coalesce(text, '')"))

ORACLE = {"op5_near_duplicates": _OP5, "op2_preference_format": _OP2, "op3_source_mix": _OP3, "op9_url_verdicts": _OP9,
          "op11_importance": _OP11, "op12_quality": _op12(), "op13_collocations": _OP13}
