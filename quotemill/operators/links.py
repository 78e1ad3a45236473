"""Link discovery, URL rules and the link -> page join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import html as H
from ..functions.core import let
from .select import Each, select_fields
from ..session import checkpoint_root
from .sizing import MAX_BROADCAST_BYTES, fence, possible_members, row_sizes

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_links(pages: DataFrame, scope_tag: str | None = None, scope_class: str | None = None,
                  anchor_class: str | None = None, carry: tuple[str, ...] = (),
                  inside: tuple[str, ...] = ()) -> DataFrame:
    """B1 + C13: one row per anchor, ``(page_id, pos, label, href, *carry)``, document order.

    ``label`` is the anchor's first direct text (``a::text`` ``.get()``), ``href``
    its attribute value (null when absent); both entity-decoded, neither
    stripped.  With a scope, only anchors inside the scope element(s) count, and
    with ``inside`` only those inside elements of these names, one in the other.
    ``carry`` names page columns (e.g. ``url``) to keep on every link, so that
    nothing has to be joined back to the page table later.
    Scopes nest to any depth.  Narrow: no shuffle; each page is handled in the task that read it.
    """
    def step(tag: str, cls: str | None) -> str:
        return tag + (f".{cls}" if cls else "")
    steps = [step(scope_tag, scope_class)] if scope_tag else []
    anchors = " ".join([*steps, *inside, step("a", anchor_class)])
    found = select_fields(pages, {"_links": Each(anchors, {"label": "a", "href": "a::attr(href)"})}, ("page_id", *carry))
    return fence(found.select("page_id", *carry, F.posexplode("_links").alias("pos", "link"))
                 .select(F.col("page_id").cast("bigint"), F.col("pos").cast("int"),
                         H.first_text("link.label").alias("label"), H.first_text("link.href").alias("href"), *carry))


def index_page_url(href: ColumnOrName, host: str = schemas.DEFAULT_HOST,
                   base_lang: str = "en") -> Column:
    """B2: ``/en/..`` or ``/fr/..`` -> host + href; otherwise host + '/<lang>/' + href.

    ``base_lang`` stands for the language of the seed URL (the source's constant
    branch); a double slash for hrefs such as ``/x`` is kept.  Null stays null.
    """
    return let(href, lambda h: F.when(h.startswith("/en/") | h.startswith("/fr/"), F.concat(F.lit(host), h))
               .otherwise(F.concat(F.lit(f"{host}/{base_lang}/"), h)))


def company_page_url(href: ColumnOrName, host: str = schemas.DEFAULT_HOST,
                     suffix: str = schemas.COMPANY_PAGE_SUFFIX) -> Column:
    """Href containing ``en/`` -> host + href + suffix, else host + '/fr' + href + suffix."""
    return let(href, lambda h: F.when(h.contains("en/"), F.concat(F.lit(host), h, F.lit(suffix)))
               .otherwise(F.concat(F.lit(host + "/fr"), h, F.lit(suffix))))


def drop_missing_href(links: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """Split links into (kept, rejects) before a URL rule.

    ``rule="company"`` skips null and empty hrefs; ``rule="index"`` keeps empty
    hrefs (the source resolves them) and routes null hrefs to rejects, where the
    source stopped the page's crawl instead.
    """
    href = F.col("href")
    missing = href.isNull() if rule == "index" else (href.isNull() | (href == ""))
    rejects = links.filter(missing).withColumn("reject_reason", F.lit("missing_href"))
    return links.filter(~missing), rejects


def url_host(url: ColumnOrName) -> Column:
    """Host of an absolute URL, lower-cased, without user info or port (null if none).

    Lenient like Python's ``urlparse``: characters that a strict URI parser
    refuses (spaces, non-ASCII) elsewhere in the URL do not lose the host.
    """
    host = F.regexp_extract(_c(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def within_domains(url: ColumnOrName, domains=schemas.DEFAULT_DOMAINS) -> Column:
    """Host equals an allowed domain or is one of its subdomains."""
    def test(host: Column) -> Column:
        t = F.lit(False)
        for d in domains:
            d = d.lower()
            t = t | (host == d) | host.endswith("." + d)
        return F.coalesce(t, F.lit(False))
    return let(url_host(url), test)


def _escaped(text: Column, plain: str, kept: str = "", blank: str = "%20") -> Column:
    """Percent-encoding in one form, character by character (UTF-8).

    Characters of the class ``plain`` stand for themselves and the rest is escaped in upper case.  Escapes named in
    ``kept`` are not undone.  ``blank`` is how a blank is written; ``+`` is read as one where it is written so.
    """
    def piece(t: Column) -> Column:
        code = F.when(t.rlike("^%[0-9A-Fa-f]{2}$"), F.conv(F.substring(t, 2, 2), 16, 10).cast("int"))
        undone = F.when(code < 128, F.chr(code))
        raw = F.concat(F.lit("%"), F.regexp_replace(F.hex(F.encode(t, "UTF-8")), "(..)(?=.)", "$1%"))
        known = F.upper(t)
        stays = known.isin(kept.split()) if kept else F.lit(False)
        blanks = (t == " ") | (code == 32) | ((t == "+") if blank == "+" else F.lit(False))
        return (F.when(blanks, F.lit(blank))
                .when(code.isNotNull(), F.when(undone.rlike(f"^[{plain}]$") & ~stays, undone).otherwise(known))
                .when(t.rlike(f"^[{plain}]$"), t).otherwise(raw))
    no_escape = plain.replace("%", "")
    whole = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)%[0-9A-Fa-f]{2}|."), 0), piece), "")
    return F.when(text.rlike(f"^[{no_escape}]*$"), text).otherwise(whole)


# Characters that stay as they are in a path and in a query argument.
_PATH_PLAIN = r"A-Za-z0-9._~:/?\[\]@!$&'()*+,;=|%-"
_ARGUMENT_PLAIN = r"A-Za-z0-9._~-"


def canonical_url(url: ColumnOrName) -> Column:
    """B6 key: URLs that ask for the same thing are written alike.

    Scheme and host are lower-cased (a port stays), the fragment goes, an empty path becomes ``/``, escapes take
    one form in path and arguments, arguments without a value get an empty one (``a`` is ``a=``), empty
    arguments go and the rest is sorted.  What has no ``scheme://`` keeps its path as written.
    """
    def argument(a: Column) -> Column:
        name = F.regexp_extract(a, r"(?s)^([^=]*)", 1)
        value = F.regexp_extract(a, r"(?s)^[^=]*=(.*)$", 1)
        return F.concat(_escaped(name, _ARGUMENT_PLAIN, blank="+"), F.lit("="), _escaped(value, _ARGUMENT_PLAIN, blank="+"))

    def canon(u: Column) -> Column:
        front = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)", 1)
        path = F.regexp_extract(u, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?]*)?([^?]*)", 1)
        path = F.when((front != "") & (path == ""), F.lit("/")).when(
            front != "", let(path, lambda p: _escaped(p, _PATH_PLAIN, "%2F %3F"))).otherwise(path)
        args = F.filter(F.split(F.regexp_extract(u, r"(?s)\?(.*)$", 1), "&"), lambda a: a != "")
        return let(F.array_sort(F.transform(args, argument)), lambda found: F.concat(
            F.regexp_replace(F.lower(front), ":$", ""), path,
            F.when(F.size(found) > 0, F.concat(F.lit("?"), F.array_join(found, "&"))).otherwise("")))
    return let(F.regexp_replace(_c(url), r"(?s)#.*$", ""), canon)


def dedupe_links(links: DataFrame, url_col: str = "target_url") -> DataFrame:
    """One row per canonical URL, the first by (page_id, pos) -- so the first label wins.

    A grouped ``min`` over a struct aggregates partially before the shuffle, so a
    URL linked from a third of all pages costs one row per map task, not one hot
    reducer; a ``row_number`` window would send every duplicate to one task.
    """
    cols = [c for c in links.columns]
    first = F.min(F.struct(*[F.col(c) for c in ["page_id", "pos"] + [c for c in cols if c not in ("page_id", "pos")]]))
    return (links.groupBy(canonical_url(url_col).alias("canonical_url"))
            .agg(first.alias("first"))
            .select("canonical_url", *[F.col("first")[c].alias(c) for c in ["page_id", "pos"] + [c for c in cols if c not in ("page_id", "pos")]]))


def resolve_links(links: DataFrame, pages: DataFrame, url_col: str = "target_url",
                  carry: tuple[str, ...] = ("label",), max_broadcast_rows: int = 200_000,
                  canonical: bool = True, extract: Callable[[DataFrame], DataFrame] | None = None,
                  market_col: str = "market") -> tuple[DataFrame, DataFrame]:
    """B7 + B8: (pages reached through a link, links whose page is missing).

    The joined frame holds the target page's ``page_id, url, html`` plus the
    carried link columns (the parent's ``market`` label, renamed ``market``
    when ``label`` is carried).  Both sides meet on the canonical URL, the
    key of ``dedupe_links``, or on the URL as it is without ``canonical``.

    Two phases.  First links and pages meet on their URLs alone; the links, each marked reached or not, are
    written once to the shared folder, so neither side is evaluated again.  Then the HTML is fetched by a
    second scan.  Up to ``max_broadcast_rows`` rows and 64 MB the reached links are broadcast to it.  Beyond,
    pages that no link can reach are dropped in the scan (``possible_members``) and the rest meets the links in
    a shuffle.  With ``extract`` that shuffle moves records instead of HTML: it is a narrow function from pages
    ``page_id, url, html, market`` to records that hand ``market`` on as ``market_col``, the joined frame is
    what it returns, and ``carry`` must be the label alone.
    """
    if extract is not None and tuple(carry) != ("label",):
        raise ValueError("with extract, only the label can be carried")
    checkpoint_root(links.sparkSession)
    key = canonical_url if canonical else _c
    known = pages.select(key("url").alias("_url")).where("_url is not null").distinct()
    marked = (links.withColumn("_target", key(url_col)).join(known, F.col("_target") == F.col("_url"), "left")
              .checkpoint())
    unresolved = marked.where("_url is null").select(*links.columns)
    side = marked.where("_url is not null").select("_target", *carry)
    if "label" in carry:
        side = side.withColumnRenamed("label", "market")
    rows, size = row_sizes(side, max_broadcast_rows)
    if rows <= max_broadcast_rows and size <= MAX_BROADCAST_BYTES:
        joined = pages.join(F.broadcast(side), key(pages["url"]) == side["_target"]).drop("_target")
        return (extract(joined) if extract else joined), unresolved
    near = possible_members(pages, key(pages["url"]), side, "_target", side.count())
    if extract is None:
        return near.join(side, key(near["url"]) == side["_target"]).drop("_target"), unresolved
    # Records carry their page's key where the label goes, and trade it for the label after the shuffle.
    records = extract(near.withColumn("market", key("url")))
    labels = side.select("_target", F.col("market").alias("_label"))
    joined = records.join(labels, records[market_col] == labels["_target"])
    return joined.select(*[F.col("_label").alias(c) if c == market_col else records[c] for c in records.columns]), unresolved


def absolute_url(base_url: ColumnOrName, href: ColumnOrName) -> Column:
    """Resolve an href against the page it was found on (``response.follow``).

    Absolute hrefs pass through; ``//host/..`` takes the page scheme; ``/path``
    takes the page origin; any other href is appended to the page's directory.
    Dot segments are not normalised.
    """
    def resolve(base: Column, h: Column) -> Column:
        origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
        scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        path_base = F.regexp_replace(base, r"[?#].*$", "")
        directory = F.when(path_base.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*$"),
                           F.concat(path_base, F.lit("/"))) \
                     .otherwise(F.regexp_extract(path_base, r"^(.*/)", 1))
        return (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
                .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
                .when(h.startswith("/"), F.concat(origin, h))
                .otherwise(F.concat(F.when(directory == "", F.concat(origin, F.lit("/")))
                                    .otherwise(directory), h)))
    return let(base_url, lambda b: let(href, lambda h: resolve(b, h)))
