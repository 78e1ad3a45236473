"""DuckDB oracle SQL, one statement per registered query, over the driver's views.

Each statement computes the expected result straight from the base tables
(for rendered pages: the values that were rendered), using the same key-based
variation formulas as ``fixtures.render``.
"""

from __future__ import annotations

HOST = "https://www.markets.example"


def clean(x: str = "html") -> str:
    """Script, style and comments removed."""
    return f"regexp_replace({x}, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g')"


def dec(x: str) -> str:
    """Entity decoding for the named entities found in the test pages (&amp; last)."""
    out = x
    for ent, ch in (("&quot;", "'\"'"), ("&copy;", "'\u00a9'"), ("&middot;", "'\u00b7'"),
                    ("&lt;", "'<'"), ("&gt;", "'>'"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
        out = f"replace({out}, '{ent}', {ch})"
    return out


WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: str) -> str:
    """Python str.strip() (all Unicode whitespace)."""
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def origin(x: str) -> str:
    return f"regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


def canon(x: str) -> str:
    """B6 key: fragment dropped, path escaped, query arguments sorted (their names and values are plain here)."""
    u = f"regexp_replace({x}, '#.*$', '')"
    base = f"regexp_replace({u}, '\\?.*$', '')"
    path = (f"array_to_string(list_transform(string_split({base}, ''), lambda ch: "
            "CASE WHEN regexp_matches(ch, '[ -~]') THEN ch ELSE url_encode(ch) END), '')")
    args = f"list_sort(list_filter(string_split(regexp_extract({u}, '\\?(.*)$', 1), '&'), lambda a: a <> ''))"
    return f"CASE WHEN len({args}) > 0 THEN {path} || '?' || array_to_string({args}, '&') ELSE {path} END"


NAV_LINKS = f"""
  nav_a AS (
    SELECT page_id,
      regexp_extract_all({clean()}, '<a href="([^"]*)">([^<]*)</a>', 1) AS hs,
      regexp_extract_all({clean()}, '<a href="([^"]*)">([^<]*)</a>', 2) AS ls
    FROM pages),
  nav_b AS (SELECT page_id, hs, ls, unnest(generate_series(1, len(hs))) AS i FROM nav_a),
  links AS (
    SELECT CAST(page_id AS BIGINT) AS page_id, CAST(i - 1 AS INTEGER) AS pos,
           NULLIF({dec('ls[i]')}, '') AS label, {dec('hs[i]')} AS href
    FROM nav_b)"""

HREF_VARIANTS = NAV_LINKS + """,
  lang AS (SELECT page_id, regexp_extract(html, '<html[^>]*\\slang="([^"]*)"', 1) AS lang FROM pages),
  v AS (
    SELECT page_id, pos, 0 AS variant, href FROM links
    UNION ALL SELECT page_id, pos, 1, '/' || lang || href FROM links JOIN lang USING (page_id)
    UNION ALL SELECT page_id, pos, 2, lang || href FROM links JOIN lang USING (page_id)
    UNION ALL SELECT page_id, pos, 3, '' FROM links WHERE pos % 4 = 0)"""

LINK_EXTRACT = f"WITH {NAV_LINKS} SELECT page_id, pos, label, href FROM links"

INDEX_URL_RULE = f"""WITH {HREF_VARIANTS}
SELECT page_id, pos, CAST(variant AS INTEGER) AS variant, href,
  CASE WHEN starts_with(href, '/en/') OR starts_with(href, '/fr/') THEN '{HOST}' || href
       ELSE '{HOST}/en/' || href END AS target_url
FROM v WHERE href IS NOT NULL"""

COMPANY_URL_RULE = f"""WITH {HREF_VARIANTS}
SELECT page_id, pos, CAST(variant AS INTEGER) AS variant, href,
  CASE WHEN contains(href, 'en/') THEN '{HOST}' || href || '/listed-companies'
       ELSE '{HOST}/fr' || href || '/listed-companies' END AS target_url
FROM v WHERE href IS NOT NULL AND href <> ''"""

OFFSITE_FILTER = """
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) AS host
           FROM pages)
SELECT page_id, host,
  (host = 'example.org' OR ends_with(host, '.example.org')
   OR host = 'www.ththin.example.com' OR ends_with(host, '.www.ththin.example.com')) AS allowed
FROM h"""

DEDUPE_LINKS = f"""WITH {NAV_LINKS},
  l AS (SELECT l.page_id, l.pos, l.label, l.href, {origin('p.url')} || l.href AS target_url
        FROM links l JOIN pages p USING (page_id)),
  c AS (SELECT *, {canon('target_url')} AS canonical_url FROM l),
  r AS (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY page_id, pos) AS rn FROM c)
SELECT canonical_url, page_id, pos, label, href FROM r WHERE rn = 1"""

TITLES = f"""
  titles AS (
    SELECT page_id,
      {strip(dec("NULLIF(regexp_extract(" + clean() + ", '(?s)<title[^>]*>([^<]*)', 1), '')"))} AS label
    FROM pages)"""

LINK_PAGE_JOIN = f"""WITH {TITLES}
SELECT p2.page_id, p2.url, t.label AS market, CAST(t.page_id AS BIGINT) AS from_page_id
FROM titles t JOIN pages p2 ON p2.page_id = t.page_id + 1"""

LINK_PAGE_CANONICAL = f"""WITH {TITLES}
SELECT p.page_id, p.url, t.label AS market, CAST(t.page_id AS BIGINT) AS from_page_id
FROM titles t JOIN pages p2 ON p2.page_id = t.page_id + 1
JOIN pages p ON {canon('p.url')} = {canon('p2.url')}"""

UNRESOLVED_LINKS = f"""WITH {NAV_LINKS},
  m AS (SELECT l.page_id, l.pos, {origin('p.url')} || l.href AS target_url
        FROM links l JOIN pages p USING (page_id)),
  n AS (SELECT t.page_id, -1 AS pos, p2.url AS target_url
        FROM pages t JOIN pages p2 ON p2.page_id = t.page_id + 1
        UNION ALL
        SELECT max(page_id), -1, '{HOST}/missing/' || CAST(max(page_id) AS VARCHAR) FROM pages),
  u AS (SELECT * FROM m UNION ALL SELECT * FROM n)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(pos AS INTEGER) AS pos, target_url
FROM u WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = u.target_url)"""

HEADING_OR_DEFAULT = f"""
SELECT page_id,
  CASE WHEN regexp_matches({clean()}, '(?i)<h1\\b')
       THEN {strip(dec("NULLIF(regexp_extract(" + clean() + ", '(?s)<h1[^>]*>([^<]*)', 1), '')"))}
       ELSE 'Index Name Not Found' END AS heading,
  CASE WHEN regexp_matches(html, 'subheading-category') THEN 'unexpected'
       ELSE 'Index Name Not Found' END AS indice_name
FROM pages"""

PAGE_TEXTS = f"""
WITH s AS (SELECT page_id, list_slice(string_split_regex({clean()}, '<p>'), 2, 100000000) AS segs FROM pages),
t AS (
  SELECT page_id, flatten(list_transform(segs, lambda g: list_filter(
      string_split_regex(regexp_extract(g, '(?s)^(.*?)(?:</p>|</article>|$)', 1), '<[^>]*>'),
      lambda x: len(x) > 0))) AS ps
  FROM s)
SELECT page_id,
  COALESCE({strip(dec('ps[1]'))}, 'Data not found') AS first_text,
  COALESCE({strip(dec('ps[2]'))}, 'Data not found') AS second_text,
  CAST(len(ps) AS INTEGER) AS n_texts
FROM t"""

def market_label(nk: str, name: str, blk: str) -> str:
    """Menu label of a (nation, block) market, as rendered by fixtures.render.market_label."""
    mid = f"(({blk}) * 100 + {nk})"
    head = f"{name} || ' Board ' || CAST({blk} AS VARCHAR)"
    abbr = f"'B' || CAST({nk} AS VARCHAR) || '-' || CAST({blk} AS VARCHAR)"
    return (f"CASE WHEN {mid} % 11 = 0 THEN {head} "
            f"WHEN {mid} % 11 = 1 THEN {head} || ' (' || {abbr} || ') (ALT)' "
            f"WHEN {mid} % 11 = 2 THEN {head} || ' ()' "
            f"WHEN {mid} % 23 = 7 THEN {head} || ' (B' || CAST({nk} AS VARCHAR) || chr(10) || '-' "
            f"|| CAST({blk} AS VARCHAR) || ')' "
            f"ELSE {head} || ' (' || {abbr} || ')' END")


COMPANY_ITEMS = """
SELECT
  CASE WHEN c_custkey % 2 = 1 THEN c_name || ' & Co' ELSE c_name END AS company_name,
  CASE WHEN c_custkey % 17 = 5 THEN 'N/A' ELSE c_mktsegment END AS sector,
  CASE WHEN c_custkey % 13 = 6 THEN NULL ELSE c_acctbal END AS price,
  CASE WHEN c_custkey % 7 = 0 THEN NULL
       ELSE CAST((c_custkey * 37) % 2001 - 1000 AS DOUBLE) / 100 END AS one_day,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       ELSE CAST((c_custkey * 53) % 40001 - 20000 AS DOUBLE) / 100 END AS ytd,
  CAST((c_custkey * 7919) % 100000000 + 1000 AS DOUBLE) AS market_cap,
  strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER), '%d-%b-%Y') AS date,
  {label} AS market_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
""".format(label=market_label("c_nationkey", "n_name", "c_custkey // 40"))

def fmt2(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


MARKETS = """
  per_cust AS (
    SELECT o_custkey, count(*) AS n_orders,
           sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS order_cents, max(o_orderdate) AS last_date
    FROM orders GROUP BY o_custkey),
  mj AS (
    SELECT c_nationkey AS nk, c_custkey // 40 AS block, CAST(round(c_acctbal * 100) AS BIGINT) AS acct_cents,
           COALESCE(n_orders, 0) AS n_orders, COALESCE(order_cents, 0) AS order_cents, last_date
    FROM customer LEFT JOIN per_cust ON c_custkey = o_custkey),
  mk AS (
    SELECT nk, block, block * 100 + nk AS mid, count(*) AS n_cust, sum(acct_cents) AS acct_cents,
           sum(n_orders) AS n_orders, sum(order_cents) AS order_cents, max(last_date) AS last_date
    FROM mj GROUP BY nk, block),
  mm AS (SELECT mk.*, n_name FROM mk JOIN nation ON nk = n_nationkey),
  ix0 AS (
    SELECT mid AS page_id, mid, nk, block, n_name, n_cust, acct_cents, n_orders, order_cents,
      CASE WHEN mid % 6 IN (2, 3) THEN 'Date not found'
           ELSE strftime(COALESCE(last_date, TIMESTAMP '2024-04-03'), '%d-%b-%Y') END AS current_date,
      CASE WHEN mid % 11 = 0 THEN 'Abbreviation not found'
           WHEN mid % 11 = 1 THEN 'B' || nk || '-' || block
           WHEN mid % 11 = 2 THEN ''
           WHEN mid % 23 = 7 THEN 'Abbreviation not found'
           ELSE 'B' || nk || '-' || block END AS index_abbreviation,
      CASE WHEN mid % 13 = 0 THEN 'Index Name Not Found'
           WHEN mid % 29 = 3 THEN NULL
           WHEN mid % 31 = 4 THEN repeat('Long ', 60) || n_name
           ELSE '🏛 ' || n_name || ' Exchange ' || block END AS indice_name,
      CASE WHEN mid % 5 IN (1, 3, 4) THEN CAST(order_cents AS DOUBLE) / 100 END AS index_value,
      CASE WHEN mid % 5 = 0 THEN CAST(order_cents AS DOUBLE) / 100
           WHEN mid % 5 IN (3, 4) THEN CAST((mid * 13) % 2001 - 1000 AS DOUBLE) / 100 END AS index_change,
      CASE WHEN mid % 4 = 1 THEN -(CAST((mid * 7) % 300000 AS DOUBLE) / 100) END AS index_percentage_change,
      CASE mid % 7 WHEN 0 THEN 4 WHEN 1 THEN 5 WHEN 2 THEN 3 WHEN 3 THEN 0 WHEN 4 THEN 3 ELSE 5 END AS n_periods,
      CASE WHEN mid % 9 = 0 THEN 0 WHEN mid % 9 = 2 THEN -1 WHEN mid % 9 IN (1, 3) THEN 3 ELSE 4 END AS n_summary,
      NULLIF(concat_ws(';',
        CASE WHEN mid % 13 <> 0 AND mid % 29 = 3 THEN 'index_name_without_text' END,
        CASE WHEN mid % 9 = 2 THEN 'summary_cell_without_span' END), '') AS extract_error
    FROM mm),
  ix AS (
    SELECT *, NULLIF(concat_ws(';',
        CASE WHEN mid % 4 = 3 THEN 'index_percentage_change:not_a_number' END,
        CASE WHEN length(indice_name) > 255 THEN 'indice_name:too_long' END,
        extract_error), '') AS reject_reason
    FROM ix0)"""

INDEX_ITEMS = f"""WITH {MARKETS}
SELECT page_id, current_date, index_abbreviation, indice_name, index_value, index_change,
  index_percentage_change, CAST(n_periods AS INTEGER) AS n_periods, CAST(n_summary AS INTEGER) AS n_summary,
  extract_error, reject_reason
FROM ix"""

SHAPES = """
  shapes(shape, period, j) AS (VALUES
    (0, '1M', 0), (0, '3M', 1), (0, 'YTD', 2), (0, '1Y', 3),
    (1, '1M', 0), (1, '3M', 1), (1, 'YTD', 2), (1, '1Y', 3), (1, '2Y', 4),
    (2, '1M', 2), (2, '3M', 1), (2, 'YTD', 3),
    (4, '1M', 0), (4, '3M', 1), (4, 'YTD', 2),
    (5, '1M', 0), (5, '3M', 1), (5, 'YTD', 2), (5, '1Y', 3), (5, '2Y', 4),
    (6, '1M', 0), (6, '3M', 1), (6, 'YTD', 2), (6, '1Y', 3), (6, '2Y', 4))"""

PERIOD_RETURNS = f"""WITH {MARKETS}, {SHAPES}
SELECT page_id, period, CAST((mid * (j + 3) * 17) % 4001 - 2000 AS DOUBLE) / 100 AS pct
FROM ix JOIN shapes ON shapes.shape = ix.mid % 7
WHERE reject_reason IS NULL"""

SUMMARY_ENTRIES = """
  sm AS (
    SELECT *, CASE WHEN mid % 3 = 0 THEN 'Mln' WHEN mid % 3 = 1 THEN 'Millions' ELSE 'Bln' END AS mag_word,
              CASE WHEN mid % 3 = 2 THEN 1e9 ELSE 1e6 END AS mag,
              'C' || nk AS cur
    FROM ix WHERE mid % 9 NOT IN (0, 2)),
  se AS (
    SELECT page_id, mid, 'Value Traded (' || mag_word || ' ' || cur || ')' AS key,
           format('{:,.2f}', CAST(acct_cents AS DOUBLE) / 100) AS value,
           'Value Traded' AS metric, mag, cur AS currency, CAST(acct_cents AS DOUBLE) / 100 * mag AS amount,
           reject_reason FROM sm
    UNION ALL
    SELECT page_id, mid, 'Volume',
           CASE WHEN mid % 9 = 1 THEN 'Volume' WHEN mid % 9 = 3 THEN 'dup-' || n_orders
                ELSE format('{:,.0f}', CAST(n_orders * 1000 + n_cust AS DOUBLE)) END,
           'Volume', 1.0, NULL,
           CASE WHEN mid % 9 IN (1, 3) THEN NULL ELSE CAST(n_orders * 1000 + n_cust AS DOUBLE) END,
           reject_reason FROM sm
    UNION ALL
    SELECT page_id, mid, 'Transactions', CASE WHEN n_orders = 0 THEN '-' ELSE CAST(n_orders AS VARCHAR) END,
           'Transactions', 1.0, NULL, CASE WHEN n_orders = 0 THEN NULL ELSE CAST(n_orders AS DOUBLE) END,
           reject_reason FROM sm WHERE mid % 9 <> 3
    UNION ALL
    SELECT page_id, mid, 'Market Cap. (' || mag_word || ' ' || cur || ')',
           format('{:,.2f}', CAST(order_cents + acct_cents AS DOUBLE) / 100),
           'Market Cap.', mag, cur, CAST(order_cents + acct_cents AS DOUBLE) / 100 * mag,
           reject_reason FROM sm WHERE mid % 9 <> 1)"""

SUMMARY_KV = f"""WITH {MARKETS}, {SUMMARY_ENTRIES}
SELECT page_id, key, value FROM se"""

METRIC_UNITS = f"""WITH {MARKETS}, {SUMMARY_ENTRIES}
SELECT page_id, metric, CAST(mag AS DOUBLE) AS magnitude, currency, amount
FROM se WHERE reject_reason IS NULL"""

LEVEL_REPAIR = f"""WITH {MARKETS}
SELECT page_id, index_value, index_change, COALESCE(index_value, index_change) AS level,
       (index_value IS NULL AND index_change IS NOT NULL) AS level_repaired
FROM ix WHERE reject_reason IS NULL"""

COMPANY_CTE = "companies AS (" + COMPANY_ITEMS.replace(
    "FROM customer JOIN nation", ", c_custkey, c_nationkey FROM customer JOIN nation") + ")"

COMPANY_INDEX_JOIN = f"""WITH {MARKETS}, {COMPANY_CTE}
SELECT c.company_name, c.price, ix.index_abbreviation, ix.indice_name
FROM companies c JOIN ix ON ix.mid = (c.c_custkey // 40) * 100 + c.c_nationkey
WHERE ix.reject_reason IS NULL AND ix.index_abbreviation NOT IN ('Abbreviation not found', '')"""

SECTOR_ROLLUP = f"""WITH {COMPANY_CTE}
SELECT sector, market_name, count(*) AS n_companies, sum(market_cap) AS total_market_cap,
       CAST(sum(CAST(round(ytd * 100) AS BIGINT)) AS DOUBLE) / count(ytd) / 100 AS mean_ytd
FROM companies GROUP BY ROLLUP (sector, market_name)"""


def signed(v: str) -> str:
    return f"(CASE WHEN {v} >= 0 THEN '+' ELSE '' END || format('{{:,.2f}}', {v}))"


OD = "CAST((c_custkey * 37) % 2001 - 1000 AS DOUBLE) / 100"
YTD = "CAST((c_custkey * 53) % 40001 - 20000 AS DOUBLE) / 100"

COMPANY_FALLBACK = f"""
SELECT CASE WHEN c_custkey % 2 = 1 THEN c_name || ' & Co' ELSE c_name END AS company_name,
  CASE WHEN c_custkey % 7 = 0 THEN 'N/A' ELSE {signed(OD)} || '%' END AS one_day,
  CASE WHEN c_custkey % 11 = 0 THEN 'N/A' ELSE {signed(YTD)} || '%' END AS ytd
FROM customer"""

PV = "CAST((mid * (j + 3) * 17) % 4001 - 2000 AS DOUBLE) / 100"

TIME_PERIODS_ZIP = f"""WITH {MARKETS}, {SHAPES}
SELECT page_id, period AS key, {signed(PV)} || '%' AS value
FROM ix JOIN shapes ON shapes.shape = ix.mid % 7"""

ABBREVIATION = """
WITH l AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 14 = 12 THEN NULL
         WHEN c_custkey % 7 = 5 THEN ''
         WHEN c_custkey % 7 = 0 THEN c_name
         WHEN c_custkey % 7 = 1 THEN c_name || ' (X' || c_custkey || ') (Y)'
         WHEN c_custkey % 7 = 2 THEN c_name || ' ()'
         WHEN c_custkey % 7 = 3 THEN c_name || ' (N' || chr(10) || c_custkey || ')'
         WHEN c_custkey % 7 = 4 THEN c_name || ' (R' || chr(13) || c_custkey || ')'
         ELSE c_name || ' (' || c_mktsegment || ')' END AS label
  FROM customer)
SELECT c_custkey,
  CASE WHEN label IS NULL OR label = '' THEN label
       WHEN regexp_matches(label, '\\((.*?)\\)') THEN regexp_extract(label, '\\((.*?)\\)', 1)
       ELSE 'Abbreviation not found' END AS abbreviation
FROM l"""

AFTER_LAST = f"""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%Y') AS d FROM orders),
x AS (SELECT o_orderkey,
        CASE WHEN o_orderkey % 3 = 0 THEN 'As of ' || d
             WHEN o_orderkey % 3 = 1 THEN 'x As of y As of ' || d || '  '
             ELSE '  ' || d END AS text
      FROM t)
SELECT o_orderkey, {strip("split_part(text, 'As of', -1)")} AS date_part FROM x"""

NUMBER_CLEAN = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 IN (0, 1, 2) THEN NULL ELSE o_totalprice END AS index_value,
  CASE WHEN o_orderkey % 10 IN (0, 1, 2) THEN NULL ELSE o_totalprice END AS one_day
FROM orders"""

REJECT_SPLIT = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 12 IN (0, 1, 2, 4, 5, 8) THEN 'rejected' ELSE 'valid' END AS status,
  CASE o_orderkey % 12 WHEN 0 THEN 'price:not_a_number' WHEN 1 THEN 'price:not_a_number'
       WHEN 2 THEN 'price:not_finite' WHEN 4 THEN 'price:not_a_number'
       WHEN 5 THEN 'company_name:too_long'
       WHEN 8 THEN 'price:not_finite;market_cap:not_a_number' END AS reject_reason,
  CASE WHEN o_orderkey % 12 IN (0, 1, 2, 4, 8) THEN NULL
       WHEN o_orderkey % 12 = 3 THEN CAST('nan' AS DOUBLE) ELSE o_totalprice END AS price,
  CAST(CASE WHEN o_orderkey % 12 = 5 THEN 300 WHEN o_orderkey % 12 = 6 THEN 255
            ELSE length('Order ' || o_orderkey) END AS INTEGER) AS name_length
FROM orders"""

JSON_ENTRIES = """
  je AS (SELECT event_id, unnest(json_keys(props)) AS key, props FROM events),
  jv AS (SELECT event_id, key, json_extract_string(props, '$."' || key || '"') AS value FROM je)"""

JSON_PROPS = f"""WITH {JSON_ENTRIES}
SELECT event_id, key, value, '{{"' || key || '":"' || value || '"}}' AS entry_json FROM jv"""

DICT_LITERAL = f"""WITH {JSON_ENTRIES}
SELECT event_id, key, value FROM jv"""

FEED_DOCUMENTS = r"""WITH d AS (
  SELECT doc_id, lang, nullif(regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), '') AS text FROM documents)
SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5,
       md5('"' || text || '",' || chr(10) || '"' || lang || '"') AS quoted_md5 FROM d"""

FEED_LITERALS = r"""WITH e AS (SELECT event_id, event_id % 8 AS kind, regexp_extract(props, '[0-9]+') AS k FROM events)
SELECT event_id,
  CASE kind WHEN 0 THEN '{"k":"' || k || '","ok":"true","note":null}' WHEN 1 THEN '{"k":"' || k || '"}'
            WHEN 2 THEN '{"k":"' || k || '.5","n":"it''s A' || chr(233) || '"}' WHEN 6 THEN '{"k":"1_' || k || '"}'
            WHEN 7 THEN '{}' END AS props,
  CASE kind WHEN 3 THEN 'props:not_a_dict@' || (length(k) + 7) WHEN 4 THEN 'props:empty' WHEN 5 THEN 'props:not_a_dict@0'
  END AS reject_reason
FROM e"""

STRICT_LOAD = """
SELECT CASE o_orderkey % 7 WHEN 1 THEN 'unknown_fields:note,vip' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'not_an_object' END
         AS refused,
       count(*) AS n_lines, CAST(sum(CASE WHEN o_orderkey % 7 <> 3 THEN o_orderkey END) AS BIGINT) AS sum_ids,
       count(*) FILTER (o_orderkey % 7 IN (0, 5, 6)) AS n_prices, count(*) FILTER (o_orderkey % 7 IN (1, 2, 3)) AS n_reported
FROM orders WHERE o_orderkey % 7 <> 4 GROUP BY 1"""

LANDED_SIZES = """WITH l AS (SELECT '{"id":' || c_custkey || ',"label":"Größe ' || c_name || '"}' AS line FROM customer)
SELECT 'customers' AS dataset, 'landed_bytes' AS "check", CAST(sum(strlen(line) + 1) AS BIGINT) AS value, false AS flag FROM l
UNION ALL SELECT 'customers', 'landed_chars', CAST(sum(length(line) + 1) AS BIGINT), false FROM l"""

ROUTE_ITEMS = """
SELECT CASE event_type WHEN 'view' THEN 'indices' ELSE 'companies' END AS table_name, event_id
FROM events WHERE event_type IN ('view', 'click')"""

RUN_STAMP = """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS ds FROM events"""

NESTED_LOAD = """
SELECT event_id AS id, CASE WHEN event_id % 3 = 2 THEN '' ELSE 'a "type"=' || event_type || ';user=' || user_id END AS entries
FROM events"""

NUMBER_PYTHON = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (3, 4) THEN NULL ELSE round(o_totalprice, 2) END AS price,
       CASE WHEN o_orderkey % 6 IN (3, 4) THEN 'not_a_number' END AS error
FROM orders"""

APPEND_HISTORY = """
SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id, count(*) AS n_ids,
       count(DISTINCT o_orderkey) AS n_orders
FROM orders"""

ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split())

FILE_AUDIT = """
SELECT 'orders' AS dataset, 'landed_empty' AS "check", CAST(0 AS BIGINT) AS value, false AS flag
UNION ALL SELECT 'orders', 'landed_rows', count(*), count(*) = 0 FROM orders
UNION ALL SELECT 'orders', 'landed_blank', 0, false"""


def _daily_rows(kind: str, records: str, valid: str, rejected: str) -> str:
    rows = [("records", records), ("valid", valid), ("rejected", rejected),
            ("links_refused", "n_menus"), ("links_unresolved", "n_menus"), ("history_rows", valid),
            ("landed_empty", "0"), ("landed_rows", valid), ("landed_blank", "0"),
            ("unexpected_fields", "0"), ("loaded_rows", valid)]
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS dataset, '{c}' AS \"check\", CAST({v} AS BIGINT) AS value, false AS flag FROM tot"
        for c, v in rows)


RUN_DAILY = f"""WITH {MARKETS},
  tot AS (
    SELECT (SELECT count(*) FROM ix) AS n_markets,
           (SELECT count(*) FROM ix WHERE reject_reason IS NULL) AS n_valid_ix,
           (SELECT count(*) FROM customer) AS n_customers,
           (SELECT count(*) FROM (SELECT DISTINCT nk, block // 25 FROM mk)) AS n_menus)
{_daily_rows('indices', 'n_markets', 'n_valid_ix', 'n_markets - n_valid_ix')}
UNION ALL
{_daily_rows('companies', 'n_customers', 'n_customers', '0')}"""

EXPORT_ROUNDING = """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / l_quantity, 10) AS ratio FROM lineitem"""

SCHEMA_DRIFT = """
SELECT 'note' AS field, count(*) AS rows FROM customer WHERE c_custkey % 2 = 1"""

RETENTION = """
WITH d AS (SELECT CAST(ts AS DATE) AS ds, count(*) AS n_events FROM events GROUP BY 1)
SELECT strftime(ds, '%Y-%m-%d') AS ds, n_events, ((SELECT max(ds) FROM d) - ds) < 13 AS kept FROM d"""

LATEST_ROW = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

QUOTE_DATE = """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS quote_date
FROM orders"""


URL_FINGERPRINT = """
WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS stem FROM pages)
SELECT stem || '/%C3%A9~x%20y?a=&b=1&c=p+q' AS canonical_url, min(page_id) AS page_id, 0 AS pos, 3 * count(*) AS n_spellings
FROM p GROUP BY stem"""

RERUN_APPEND = """
WITH o AS (SELECT o_orderkey, 'part' || (o_orderkey % 3) AS batch FROM orders),
b AS (SELECT batch, count(*) AS rows FROM o GROUP BY batch),
t AS (SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS s FROM o)
SELECT batch, CAST(1 + coalesce(sum(rows) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_id,
       rows, t.n AS n_rows, 1 AS min_id, t.n AS max_id, t.n AS n_ids, t.s AS sum_keys
FROM b, t"""

ATOMIC_LOAD = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"

RETENTION_RUN = """
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events)
SELECT strftime(d, '%Y%m%d') AS ds, count(*) AS n_events, CAST(sum(event_id) AS BIGINT) AS sum_ids
FROM e WHERE date_diff('day', d, (SELECT max(d) FROM e)) < 13 GROUP BY d"""

ORACLE = {
    "q_retention_run": RETENTION_RUN,
    "q_url_fingerprint": URL_FINGERPRINT,
    "q_rerun_append": RERUN_APPEND,
    "q_atomic_load": ATOMIC_LOAD,
    "q_company_items": COMPANY_ITEMS,
    "q_link_extract": LINK_EXTRACT,
    "q_index_url_rule": INDEX_URL_RULE,
    "q_company_url_rule": COMPANY_URL_RULE,
    "q_offsite_filter": OFFSITE_FILTER,
    "q_dedupe_links": DEDUPE_LINKS,
    "q_link_page_join": LINK_PAGE_JOIN,
    "q_link_page_canonical": LINK_PAGE_CANONICAL,
    "q_unresolved_links": UNRESOLVED_LINKS,
    "q_heading_or_default": HEADING_OR_DEFAULT,
    "q_page_texts": PAGE_TEXTS,
    "q_index_items": INDEX_ITEMS,
    "q_period_returns": PERIOD_RETURNS,
    "q_summary_kv": SUMMARY_KV,
    "q_metric_units": METRIC_UNITS,
    "q_level_repair": LEVEL_REPAIR,
    "q_company_index_join": COMPANY_INDEX_JOIN,
    "q_sector_rollup": SECTOR_ROLLUP,
    "q_company_fallback": COMPANY_FALLBACK,
    "q_time_periods_zip": TIME_PERIODS_ZIP,
    "q_abbreviation": ABBREVIATION,
    "q_after_last": AFTER_LAST,
    "q_number_clean": NUMBER_CLEAN,
    "q_reject_split": REJECT_SPLIT,
    "q_json_props": JSON_PROPS,
    "q_dict_literal": DICT_LITERAL,
    "q_feed_documents": FEED_DOCUMENTS,
    "q_feed_literals": FEED_LITERALS,
    "q_strict_load": STRICT_LOAD,
    "q_landed_sizes": LANDED_SIZES,
    "q_route_items": ROUTE_ITEMS,
    "q_run_stamp": RUN_STAMP,
    "q_nested_load": NESTED_LOAD,
    "q_number_python": NUMBER_PYTHON,
    "q_export_load": COMPANY_ITEMS,
    "q_append_history": APPEND_HISTORY,
    "q_row_counts": ROW_COUNTS,
    "q_file_audit": FILE_AUDIT,
    "q_run_daily": RUN_DAILY,
    "q_export_rounding": EXPORT_ROUNDING,
    "q_schema_drift": SCHEMA_DRIFT,
    "q_retention": RETENTION,
    "q_latest_row": LATEST_ROW,
    "q_quote_date": QUOTE_DATE,
}
