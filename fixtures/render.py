"""Render the driver's base tables as market HTML pages (test scaffolding).

Nothing here is part of the library.  Pages are produced with Spark string
expressions so that ``extract(render(T)) == T`` can be checked against a plain
SQL query on ``T``.  Every page holds a bounded number of records (``ROWS_PER_PAGE``)
so that no single group grows with the data.

Variation is driven by the record key (``k % m``) and is mirrored, formula for
formula, by the oracle SQL in ``__spark_entry__.py``.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators.sizing import broadcast_if_small
from quotemill.session import scratch_path

HOST = S.DEFAULT_HOST
ROWS_PER_PAGE = 40
# Quote block markers for the index pages (C2 re-aimed as markers).
#: Where index pages have their quote block.
CONTENT = "/html/body/div[2]/section/div[2]"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Render a page set from the given tables, anew on every call, and read it back from scratch storage."""
    path = scratch_path(spark, f"fixture-{name}")
    build().write.parquet(path)
    return spark.read.parquet(path)


def signed(v: Column, decimals: int = 2, suffix: str = "") -> Column:
    """'+1,234.56%' style text of a double."""
    return F.concat(F.when(v >= 0, F.lit("+")).otherwise(F.lit("")),
                    F.format_number(v, decimals), F.lit(suffix))


def _spread(df: DataFrame) -> DataFrame:
    """Rendered pages are few and small; keep one partition per core so that
    extraction downstream is not squeezed into the single partition AQE would
    coalesce them into."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _page(rows: DataFrame, key_cols: list[str], order_col: str, html_col: str,
          extra: list[Column]) -> DataFrame:
    """Group rendered rows into pages, document order by ``order_col``."""
    return (rows.groupBy(*key_cols)
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(order_col), F.col(html_col)))),
                lambda x: x[html_col]), "").alias("body"), *extra))


# ---------------------------------------------------------------------------
# Company listing pages: customer x nation, one page per (nation, key block).

def market_id(nation_key: Column, block: Column) -> Column:
    return (block * 100 + nation_key).cast("bigint")


def market_label(nation_key: Column, nation_name: Column, block: Column) -> Column:
    """Menu label of one (nation, block) market; variation by market id exercises D6."""
    mid = market_id(nation_key, block)
    head = F.concat(nation_name, F.lit(" Board "), block.cast("string"))
    abbr = F.concat(F.lit("B"), nation_key.cast("string"), F.lit("-"), block.cast("string"))
    return (F.when(mid % 11 == 0, head)
            .when(mid % 11 == 1, F.concat(head, F.lit(" ("), abbr, F.lit(") (ALT)")))
            .when(mid % 11 == 2, F.concat(head, F.lit(" ()")))
            .when(mid % 23 == 7, F.concat(head, F.lit(" (B"), nation_key.cast("string"), F.lit("\n-"),
                                          block.cast("string"), F.lit(")")))
            .otherwise(F.concat(head, F.lit(" ("), abbr, F.lit(")"))))


def company_market(nation_key: Column, nation_name: Column, block: Column) -> tuple[Column, Column]:
    """Market label and menu href of one (nation, block) market."""
    label = market_label(nation_key, nation_name, block)
    slug = F.concat(F.lower(nation_name), F.lit("-"), block.cast("string"))
    href = F.when(nation_key % 5 == 2, F.concat(F.lit("/fr/bourse/"), slug)) \
            .otherwise(F.concat(F.lit("/en/stock-markets/"), slug))
    return label, href


def company_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rendered ``<tr>`` per customer, with its market keys."""
    c = _spread(_read(spark, sf_dir, "customer"))
    n = _read(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    name = F.when(k % 2 == 1, F.concat(F.col("c_name"), F.lit(" &amp; Co"))).otherwise(F.col("c_name"))
    name = F.when(k % 10 == 3, F.concat(F.lit("\n  "), name, F.lit("  "))).otherwise(name)
    sector = F.when(k % 17 == 5, F.lit("")) \
              .when(k % 9 == 4, F.concat(F.lit("&nbsp;"), F.col("c_mktsegment"), F.lit("&nbsp;"))) \
              .otherwise(F.col("c_mktsegment"))
    price = F.when(k % 13 == 6, F.lit("")).otherwise(F.format_number(F.col("c_acctbal"), 2))
    one_day_v = ((k * 37) % 2001 - 1000).cast("double") / 100
    one_day_t = signed(one_day_v, 2, "%")
    one_day = (F.when(k % 7 == 0, F.lit(""))
               .when(k % 3 == 0, F.concat(F.lit('<font color="green">'), one_day_t, F.lit("</font>")))
               .when(k % 3 == 1, F.concat(F.lit("<p>"), one_day_t, F.lit("</p>")))
               .otherwise(F.concat(F.lit("<font></font><p> "), one_day_t, F.lit(" </p>"))))
    ytd_v = ((k * 53) % 40001 - 20000).cast("double") / 100
    ytd_t = signed(ytd_v, 2, "%")
    ytd = (F.when(k % 11 == 0, F.lit("<p></p>"))
           .when(k % 2 == 0, F.concat(F.lit("<p>"), ytd_t, F.lit("</p>")))
           .otherwise(F.concat(F.lit('<font color="red">'), ytd_t, F.lit("</font>"))))
    cap = F.format_number(((k * 7919) % 100000000 + 1000).cast("double"), 2)
    date = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int")), "dd-MMM-yyyy")
    tr = F.concat(
        F.lit('<tr class="row">'),
        F.lit('<td class="col_width_1 left"><a href="/en/company/'), k.cast("string"), F.lit('">'), name, F.lit("</a></td>"),
        F.lit('<td class="col_width_2">'), sector, F.lit("</td>"),
        F.lit("<td class='col_width_3'>"), price, F.lit("<table><tfoot></tfoot></table></td>"),
        F.lit('<td class="col_width_4">'), one_day, F.lit("</td>"),
        F.lit('<td class="col_width_5">'), ytd, F.lit("</td>"),
        F.lit('<td class="col_width_6">'), cap, F.lit("</td>"),
        F.lit('<td class="col_width_7">'), date, F.lit("</td></tr>\n"))
    block = (k / ROWS_PER_PAGE).cast("bigint")
    label, href = company_market(F.col("c_nationkey"), F.col("n_name"), block)
    return (c.join(broadcast_if_small(n, 1_000), c.c_nationkey == n.n_nationkey)
            .select(k, "c_nationkey", "n_name", block.alias("block"),
                    label.alias("market"), href.alias("href"), tr.alias("tr")))


def company_page_url(href: Column) -> Column:
    """Where the site publishes a market's listing (mirrors the site, not the library)."""
    return F.when(href.contains("en/"), F.concat(F.lit(HOST), href, F.lit(S.COMPANY_PAGE_SUFFIX))) \
            .otherwise(F.concat(F.lit(HOST + "/fr"), href, F.lit(S.COMPANY_PAGE_SUFFIX)))


def company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html, market)``: listing pages as reached from the menu (materialised)."""
    return _materialized(spark, sf_dir, "company", lambda: _render_company_pages(spark, sf_dir))


def _render_company_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = company_rows(spark, sf_dir)
    pages = _page(rows, ["c_nationkey", "n_name", "block", "market", "href"], "c_custkey", "tr", [])
    decoy = ('<table class="tabtable-rs_01k0jris-old"><tbody><tr><td class="col_width_1">'
             '<a href="/x">Old Co</a></td><td class="col_width_3">1.00</td></tr></tbody></table>')
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Listed companies</title>'
              '<script>var s = "<table class=\\"tabtable-rs_01k0jris\\"><tbody><tr>";</script></head><body>'
              '<h1>Listed companies of '), F.col("n_name"), F.lit("</h1>"), F.lit(decoy),
        F.lit('<table class="tabtable-rs_01k0jris table"><thead><tr><th>Company</th><th>Sector</th>'
              '<th>Price</th><th>1D</th><th>YTD</th><th>M Cap</th><th>Date</th></tr></thead>\n<tbody>\n'),
        F.col("body"), F.lit("</tbody></table><!-- end of list --></body></html>"))
    return _spread(pages.select(
        (F.col("block") * 100 + F.col("c_nationkey")).cast("bigint").alias("page_id"),
        company_page_url(F.col("href")).alias("url"), html.alias("html"), "market"))


# ---------------------------------------------------------------------------
# Index pages: one per (nation, key block) market, values from its customers
# and their orders.  Money is summed in integer cents so totals are exact.

PERIOD_KEYS = ["1M", "3M", "YTD", "1Y", "2Y"]
MAGNITUDES = ["Mln", "Millions", "Bln"]


def market_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(mid, nk, n_name, block, n_cust, acct_cents, n_orders, order_cents, last_date)``."""
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    o = _read(spark, sf_dir, "orders")
    per_cust = o.groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("order_cents"),
        F.max("o_orderdate").alias("last_date"))
    block = (F.col("c_custkey") / ROWS_PER_PAGE).cast("bigint")
    joined = (c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
              .select(F.col("c_nationkey").alias("nk"), block.alias("block"),
                      F.round(F.col("c_acctbal") * 100).cast("bigint").alias("acct_cents"),
                      F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                      F.coalesce("order_cents", F.lit(0)).alias("order_cents"), "last_date"))
    stats = joined.groupBy("nk", "block").agg(
        F.count("*").alias("n_cust"), F.sum("acct_cents").alias("acct_cents"),
        F.sum("n_orders").alias("n_orders"), F.sum("order_cents").alias("order_cents"),
        F.max("last_date").alias("last_date"))
    return (stats.join(broadcast_if_small(n, 1_000), stats.nk == n.n_nationkey)
            .select(market_id(F.col("nk"), F.col("block")).alias("mid"), "nk", "n_name", "block",
                    "n_cust", "acct_cents", "n_orders", "order_cents", "last_date"))


def _cents(c: Column) -> Column:
    return F.format_number(c.cast("double") / 100, 2)


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html, market, href)``: one index page per market (materialised)."""
    return _materialized(spark, sf_dir, "index", lambda: _render_index_pages(spark, sf_dir))


def _render_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = market_stats(spark, sf_dir)
    mid, nk, blk = F.col("mid"), F.col("nk"), F.col("block")
    label = market_label(nk, F.col("n_name"), blk)
    slug = F.concat(F.lower(F.col("n_name")), F.lit("-"), blk.cast("string"))

    # Heading (C7, C11): present with text, absent, present without text, too long.
    name = F.concat(F.lit(" \U0001F3DB "), F.col("n_name"), F.lit(" Exchange "), blk.cast("string"), F.lit(" "))
    name = F.when(mid % 31 == 4, F.concat(F.repeat(F.lit("Long "), 60), F.col("n_name"))).otherwise(name)
    heading = (F.when(mid % 13 == 0, F.lit('<h1 class="page-subtitle">Market</h1>'))
               .when(mid % 29 == 3, F.lit('<h1 class="page-subtitle">Market <small class="subheading-category"></small></h1>'))
               .otherwise(F.concat(F.lit('<h1 class="page-subtitle">Market <small class="subheading-category">'),
                                   name, F.lit("</small></h1>"))))

    # Quote date.
    date = F.date_format(F.coalesce(F.col("last_date"), F.lit("2024-04-03").cast("timestamp")), "dd-MMM-yyyy")
    date_font = (F.when(mid % 6 == 0, F.concat(F.lit('<font size="1">x As of y As of '), date, F.lit("</font>")))
                 .when(mid % 6 == 1, F.concat(F.lit('<font size="1"> '), date, F.lit("</font>")))
                 .when(mid % 6 == 2, F.lit(""))
                 .when(mid % 6 == 3, F.lit('<font size="1"></font>'))
                 .otherwise(F.concat(F.lit('<font size="1">As of '), date, F.lit(" </font>"))))

    # Level and change spans (C9, D14, quirk Q1).
    span = '<span style="font-weight:bold;font-size: 22pt">'
    value = _cents(F.col("order_cents"))
    change = signed(((mid * 13) % 2001 - 1000).cast("double") / 100)
    levels = (F.when(mid % 5 == 0, F.concat(F.lit(span + " </span>"), F.lit(span), value, F.lit("</span>")))
              .when(mid % 5 == 1, F.concat(F.lit(span), value, F.lit("</span>")))
              .when(mid % 5 == 2, F.lit(""))
              .otherwise(F.concat(F.lit(span), value, F.lit("</span> "), F.lit(span), change, F.lit("</span>"))))

    # Falling change (C10): absent, red, green (ignored), red with a percent sign (rejected later).
    move = F.format_number(((mid * 7) % 300000).cast("double") / 100, 2)
    # A red span that is no child of the font is never the change.
    deeper = F.lit('<font><b><span style="color: #ff0000;">-9</span></b></font>')
    falling = (F.when(mid % 4 == 0, deeper)
               .when(mid % 4 == 1, F.concat(F.lit('<font><span style="color: #ff0000;">-'), move, F.lit("</span></font>")))
               .when(mid % 4 == 2, F.concat(F.lit('<font><span style="color: #00aa00;">+'), move, F.lit("</span></font>")))
               .otherwise(F.concat(F.lit('<font><span style="color: #ff0000;">-'), move, F.lit("%</span></font>"))))

    # Period table (E1): key / value list shapes by mid % 7.
    def pv(j: int) -> Column:
        return signed(((mid * (j + 3) * 17) % 4001 - 2000).cast("double") / 100, 2, "%")

    def keys_html(keys: list[str]) -> Column:
        return F.lit('<tr class="tr_ht1">' + "".join(f"<td>{k}</td>" for k in keys) + "</tr>")

    def values_html(n: int) -> Column:
        parts = [F.lit('<tr class="tabrow">')]
        for j in range(n):
            parts += [F.lit("<td><p>"), pv(j), F.lit("</p></td>")]
        parts.append(F.lit("</tr>"))
        return F.concat(*parts)

    def table(keys: list[str], n: int) -> Column:
        return F.concat(F.lit('<table class="tabtable-rs_c4try72e">'), keys_html(keys), values_html(n), F.lit("</table>"))

    periods = (F.when(mid % 7 == 0, table(PERIOD_KEYS[:4], 4))
               .when(mid % 7 == 1, table(PERIOD_KEYS, 6))
               .when(mid % 7 == 2, table(["1M", "3M", "1M", "YTD"], 4))
               .when(mid % 7 == 3, F.lit(""))
               .when(mid % 7 == 4, table(PERIOD_KEYS, 3))
               .otherwise(table(PERIOD_KEYS, 5)))

    # Summary table (C12, E2): normal, one-span cell, cell without span, duplicate key.
    cur = F.concat(F.lit("C"), nk.cast("string"))
    mag = F.when(mid % 3 == 0, F.lit("Mln")).when(mid % 3 == 1, F.lit("Millions")).otherwise(F.lit("Bln"))
    vt_key = F.concat(F.lit("Value Traded ("), mag, F.lit(" "), cur, F.lit(")"))
    cap_key = F.concat(F.lit("Market Cap. ("), mag, F.lit(" "), cur, F.lit(")"))
    volume = F.format_number((F.col("n_orders") * 1000 + F.col("n_cust")).cast("double"), 0)
    trans = F.when(F.col("n_orders") == 0, F.lit("-")).otherwise(F.col("n_orders").cast("string"))
    cap = _cents(F.col("order_cents") + F.col("acct_cents"))

    def cell(k: Column, v: Column) -> Column:
        # The value's second text and the empty element between the spans change nothing.
        return F.concat(F.lit("<td><span>"), k, F.lit("</span> <i></i><span class='v>0'>"), v,
                        F.lit("<br>(est.)</span></td>"))

    row1 = F.concat(F.lit('<tr class="tabrow">'), cell(vt_key, _cents(F.col("acct_cents"))),
                    cell(F.lit("Volume"), volume), F.lit("</tr>"))
    row2_normal = F.concat(F.lit('<tr class="tabrow">'), cell(F.lit("Transactions"), trans), cell(cap_key, cap), F.lit("</tr>"))
    row2 = (F.when(mid % 9 == 1, F.concat(F.lit('<tr class="tabrow">'), cell(F.lit("Transactions"), trans),
                                          F.lit("<td><span>Volume</span></td></tr>")))
            .when(mid % 9 == 2, F.concat(F.lit('<tr class="tabrow">'), cell(F.lit("Transactions"), trans),
                                         F.lit("<td>n/a</td></tr>")))
            .when(mid % 9 == 3, F.concat(F.lit('<tr class="tabrow">'),
                                         cell(F.lit("Volume"), F.concat(F.lit("dup-"), F.col("n_orders").cast("string"))),
                                         cell(cap_key, cap), F.lit("</tr>")))
            .otherwise(row2_normal))
    summary = F.when(mid % 9 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<table class="tabtable-gr_alterora_elemental_2_grey_1s2"><tbody>'), row1, row2,
                 F.lit("</tbody></table>")))

    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>Market</title><style>.x{}</style></head><body>"
              '<div class="menu"><a href="/en/">Home</a></div>'),
        heading,
        # The block is found by its place alone: others before it hold the same markup.
        F.lit('<div><section><div class="quote-content"><font size="1">As of 02-Feb-2001</font>'
              '<span style="font-weight:bold;font-size: 22pt">1.11</span><font><span style="color: #ff0000;">-1.1</span></font></div>'
              '<p>Quotes</p><div class="quote-content"><div class="quote">'), date_font,
        F.lit("<p>Index level</p>"), levels, F.lit(" "), falling,
        F.lit('</div><div class="quote-end"></div></div>'),
        periods, summary,
        F.lit('</section></div><footer><font size="1">As of 01-Jan-1999 (archive)</font>'
              '<span style="font-weight:bold;font-size: 22pt">0.00</span></footer></body></html>'))
    href = F.when(nk % 5 == 2, F.concat(F.lit("/fr/bourse/"), slug)).otherwise(F.concat(F.lit("/en/stock-markets/"), slug))
    url = F.when(href.startswith("/en/") | href.startswith("/fr/"), F.concat(F.lit(HOST), href)) \
           .otherwise(F.concat(F.lit(HOST + "/en/"), href))
    return _spread(m.select(mid.alias("page_id"), url.alias("url"), html.alias("html"), label.alias("market"),
                            href.alias("href")))


# ---------------------------------------------------------------------------
# Menu (seed) pages for the whole daily job: one per (nation, group of 25 blocks).

MENU_GROUP = 25
#: Elements of one name around the menu's list.
MENU_DEPTH = 200


def menu_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu pages (materialised); see ``_render_menu_pages``."""
    return _materialized(spark, sf_dir, "menu", lambda: _render_menu_pages(spark, sf_dir))


def _render_menu_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html)`` menu pages linking every market.

    Each menu page also holds one anchor without href (B4), its first link
    repeated with another label (B6), a link to a market that has no page (B8)
    and anchors outside the menu block or without the menu class (ignored).
    """
    m = market_stats(spark, sf_dir).select("mid", "nk", "n_name", "block")
    label = market_label(F.col("nk"), F.col("n_name"), F.col("block"))
    slug = F.concat(F.lower(F.col("n_name")), F.lit("-"), F.col("block").cast("string"))
    href = F.when(F.col("nk") % 5 == 2, F.concat(F.lit("/fr/bourse/"), slug)) \
            .otherwise(F.concat(F.lit("/en/stock-markets/"), slug))
    li = F.concat(F.lit('<li><a class="menu-market-link" href="'), href, F.lit('">'),
                  F.replace(label, F.lit("&"), F.lit("&amp;")), F.lit("</a></li>"))
    items = m.select("nk", (F.col("block") / MENU_GROUP).cast("bigint").alias("grp"), "mid",
                     li.alias("li"), href.alias("href"))
    pages = items.groupBy("nk", "grp").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("mid", "li"))), lambda x: x["li"]), "")
        .alias("body"),
        F.min_by("href", "mid").alias("first_href"))
    closed = F.concat(F.lit("/en/stock-markets/closed-"), F.col("nk").cast("string"), F.lit("-"),
                      F.col("grp").cast("string"))
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Markets</title></head><body>'
              '<nav><a class="menu-market-link" href="/en/about">About</a></nav>'
              "<div data-x='1>0' class='wide mega-inner'><div><div>All</div></div>"
              '<a class="menu-market-link" href="/en/stray">Not in a list</a>' + "<div>" * MENU_DEPTH + "<ul>"), F.col("body"),
        F.lit('<li><a class="menu-market-link">Coming soon</a></li>'),
        F.lit('<li><div><a title="a > b" class=menu-market-link href='), F.col("first_href"),
        F.lit('>Again</a></div></li>'),
        F.lit('<li><a class="menu-market-link" href="'), closed, F.lit('">Closed (CL)</a></li>'),
        F.lit('<li><a href="/en/news">News</a></li></ul>' + "</div>" * MENU_DEPTH + "</div></body></html>"))
    return pages.select(
        (F.col("grp") * 1000 + F.col("nk")).cast("bigint").alias("page_id"),
        F.concat(F.lit(HOST + "/en/menu/"), F.col("nk").cast("string"), F.lit("/"),
                 F.col("grp").cast("string")).alias("url"),
        html.alias("html"))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fetched page of the site: menus, index pages and listing pages."""
    menus = menu_pages(spark, sf_dir).select((F.col("page_id") * 10).alias("page_id"), "url", "html")
    index = index_pages(spark, sf_dir).select((F.col("page_id") * 10 + 1).alias("page_id"), "url", "html")
    listing = company_pages(spark, sf_dir).select((F.col("page_id") * 10 + 2).alias("page_id"), "url", "html")
    return menus.unionByName(index).unionByName(listing)
