"""URL filter with redirect equivalence (operator 9), DataFrame functions only.

Pages that redirect to each other, or name each other as canonical, form one
class (distributed connected components over the link table).  A rule that fits
a page's own URL decides it.  A page that no rule fits takes the decision of its
class: allow if any address in the class is explicitly allowed, else block if any
is blocked, else allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import staged
from quotemill.llm.graph import components

#: (verdict, host, path); the query's fixed rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(rest: Column) -> Column:
    """Host, A-Z lower-cased, of the text after ``://``; ``''`` for null."""
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def url_path(rest: Column) -> Column:
    """Path of the text after ``://``, up to ``?`` or ``#``; ``''`` for null."""
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def with_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """Add ``host``, ``path`` and ``node`` (the address) of a URL column.

    The address is host, path (``/`` if empty) and query; scheme and fragment do
    not tell pages apart.  It is null when there is no host.  Host and path are
    empty for a null URL and for one without ``://``.
    """
    at = F.instr(F.col(url), "://")
    rest = F.col(prefix + "rest")
    host, path = F.col(prefix + "host"), F.col(prefix + "path")
    return (df.withColumn(prefix + "rest", F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))))
            .withColumns({prefix + "host": url_host(rest), prefix + "path": url_path(rest),
                          prefix + "query": F.coalesce(F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))})
            .withColumn(prefix + "node", F.when(host != "", F.concat(
                host, F.when(path == "", "/").otherwise(path), F.col(prefix + "query"))))
            .drop(prefix + "rest", prefix + "query"))


def _with_rule(df: DataFrame, rules) -> DataFrame:
    """Add ``rule`` and ``own``, name and verdict of the longest rule that fits ``host, path``, else null."""
    name, own = F, F
    for verdict, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, own = name.when(fits, F.lit(host + path)), own.when(fits, F.lit(verdict))
    null = F.lit(None).cast("string")
    return df.withColumns({"rule": name if rules else null, "own": own if rules else null})


#: What a browser takes no tags from: comments, scripts and styles, to the end of the page where one stays open.
_UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\b|\z)|<style\b.*?(?:</style\b|\z)"
_TAG = r"(?i)<(?:link|meta)\s[^<>]*>"
_CANONICAL = r"""(?i)\srel\s*=\s*["']?[^"'>]*\bcanonical\b"""
_REFRESH = r"""(?i)http-equiv\s*=\s*["']?refresh\b"""
_HREF = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TO = r"""(?i)\scontent\s*=\s*["']?\s*[\d.]+\s*[;,]\s*url\s*=\s*["']?([^"'>\s]+)"""


def _resolve(link: Column) -> Column:
    """Absolute form of a link; the page's parts are in ``scheme, host, path``."""
    root = F.concat(F.col("scheme"), F.lit("://"), F.col("host"))
    return (F.when(link.isNull() | (link == ""), F.lit(None).cast("string"))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | link.startswith("#"), F.lit(None).cast("string"))
            .when(link.startswith("//"), F.concat(F.col("scheme"), F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(link.startswith("?"), F.concat(root, F.col("path"), link))
            .otherwise(F.concat(root, F.col("folder"), link)))


def equivalence_links(pages: DataFrame) -> DataFrame:
    """``(url, html)`` -> distinct ``(a, b)``: a page's address and where it redirects or is canonical.

    Reads ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` outside comments, scripts and styles.  Rows
    with a null URL or null HTML give no link.
    """
    # Most pages name neither and are not searched for comments.
    told = F.col("html").rlike(r"""(?i)\bcanonical\b|http-equiv\s*=\s*["']?refresh\b""")
    found = F.regexp_extract_all(F.when(told, F.regexp_replace("html", _UNSEEN, " ")), F.lit(_TAG), 0)
    links = F.filter(found, lambda t: F.when(F.lower(t).startswith("<link"), t.rlike(_CANONICAL)).otherwise(t.rlike(_REFRESH)))
    tags = pages.select("url", F.explode(links).alias("tag"))
    href = F.concat(*[F.coalesce(F.regexp_extract("tag", _HREF, i), F.lit("")) for i in (1, 2, 3)])
    link = F.when(F.lower("tag").startswith("<link"), href).otherwise(F.regexp_extract("tag", _TO, 1))
    # Few rows, written between the steps: filters below would otherwise be pushed down as
    # copies of all these expressions.
    tags = staged(tags.select("url", F.replace(F.trim(link), F.lit("&amp;"), F.lit("&")).alias("link")), "url-tags")
    rows = with_parts(tags, "url").withColumns({
        "scheme": F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*):", 1),
        "folder": F.regexp_replace(F.when(F.col("path") == "", "/").otherwise(F.col("path")), r"[^/]*$", "")})
    rows = staged(rows.select(F.col("node").alias("a"), _resolve(F.col("link")).alias("to")), "url-links")
    links = staged(with_parts(rows, "to", "to_").select("a", F.col("to_node").alias("b")), "url-edges")
    return links.where("a <> b").distinct()


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """Verdict of every page: ``page_id, host, path, rule, verdict, class_size``.

    ``pages`` has ``page_id, url, html``; ``redirects`` may add ``(from_url, to_url)``
    links seen by the fetcher.  ``rules`` is a short list of (verdict, host, path)
    kept in the job's configuration.  One row out per row in, repeated rows and
    null ids included.  A null URL or one without ``://`` has empty host and path,
    no rule, and verdict allow.  An empty table gives an empty result.
    """
    rules = list(rules)
    links = equivalence_links(pages)
    if redirects is not None:
        more = with_parts(with_parts(redirects.select("from_url", "to_url"), "from_url"), "to_url", "to_")
        links = links.unionByName(more.select(F.col("node").alias("a"), F.col("to_node").alias("b")).where("a <> b"))
    member = staged(components(links), "url-classes")
    # An address is the text after "://" of its URL.
    seen = member.withColumns({"host": url_host(F.col("node")), "path": url_path(F.col("node"))})
    seen = _with_rule(seen, rules)
    classes = seen.groupBy("component").agg(
        F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"),
        F.count("*").alias("class_size"))
    known = member.join(classes, "component").select("node", "allowed", "blocked", "class_size")

    rows = with_parts(pages.select("page_id", "url"), "url")
    out = _with_rule(rows, rules).join(known, "node", "left")
    carried = F.when(F.coalesce("allowed", F.lit(False)), "allow").when(
        F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", carried).alias("verdict"),
                      F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"))
