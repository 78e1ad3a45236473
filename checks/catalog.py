"""Registered queries: each ``q_*`` takes ``(spark, sf_dir)`` and returns a DataFrame.

Names follow SURVEY §7.3; the operator IDs each one exercises are in its
docstring.  Every query reads the driver's tables (or pages Spark renders from
them) in full, so its work grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import render as R
from quotemill import schemas as S
from quotemill.functions import html as H
from quotemill.functions import text as X
from quotemill.operators import consumer as C
from quotemill.operators import extract as E
from quotemill.operators import links as L
from quotemill.operators import audit as A
from quotemill.operators import validate as V
from quotemill.operators.select import Each, select_fields
from quotemill.operators.sizing import dealt
from quotemill.functions import maps as M
from quotemill.plans import daily as D
from quotemill.session import scratch_path
from quotemill.sinks import writers as W
from quotemill.sources import readers as RD

# Domains for the off-site filter query.
OFFSITE_DOMAINS = ("example.org", "www.ththin.example.com")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nav_links(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    pages = _t(spark, sf_dir, "pages").withColumn(
        "lang", F.regexp_extract("html", r'<html[^>]*\slang="([^"]*)"', 1))
    return L.extract_links(pages, scope_tag="nav", carry=carry)


def _href_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nav link's href as found, prefixed with '/<page lang>', with '<lang>', and blank."""
    links = _nav_links(spark, sf_dir, carry=("lang",))
    variants = F.array(
        F.col("href"), F.concat(F.lit("/"), F.col("lang"), F.col("href")),
        F.concat(F.col("lang"), F.col("href")),
        F.when(F.col("pos") % 4 == 0, F.lit("")))
    return links.select("page_id", "pos", F.posexplode(variants).alias("variant", "href"))


def q_company_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers rendered as listing pages, re-extracted and typed."""
    pages = R.company_pages(spark, sf_dir)
    staged = V.stage(E.company_items(pages), "companies")
    return V.valid_rows(staged, "companies")



def q_link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every menu anchor of every page, document order."""
    return _nav_links(spark, sf_dir)


def q_index_url_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index-page URL rule over href variants; null hrefs are refused."""
    kept, _ = L.drop_missing_href(_href_variants(spark, sf_dir), "index")
    return kept.select("page_id", "pos", F.col("variant").cast("int"), "href",
                       L.index_page_url("href", R.HOST).alias("target_url"))


def q_company_url_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company-page URL rule; null and empty hrefs are skipped."""
    kept, _ = L.drop_missing_href(_href_variants(spark, sf_dir), "company")
    return kept.select("page_id", "pos", F.col("variant").cast("int"), "href",
                       L.company_page_url("href", R.HOST).alias("target_url"))


def q_offsite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fetched page URLs fall inside the allowed domains."""
    pages = _t(spark, sf_dir, "pages")
    return pages.select("page_id", L.url_host("url").alias("host"),
                        L.within_domains("url", OFFSITE_DOMAINS).alias("allowed"))


def q_dedupe_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links resolved against their page, one row per canonical URL, first label wins."""
    links = _nav_links(spark, sf_dir, carry=("url",)).select(
        "page_id", "pos", "label", "href", L.absolute_url("url", "href").alias("target_url"))
    return L.dedupe_links(links).select("canonical_url", "page_id", "pos", "label", "href")


def q_url_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spellings of each page URL (case, escapes, argument order, blank values) are one request."""
    url = _t(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("stem"))
    front = F.regexp_extract("stem", r"^([^/]*//[^/]*)", 1)
    path = F.regexp_extract("stem", r"^[^/]*//[^/]*(.*)$", 1)
    spellings = F.array(
        F.concat("stem", F.lit("/\u00e9~x y?b=1&a=&c=p+q")),
        F.concat(F.upper(front), path, F.lit("/%C3%A9%7ex%20y?c=p%20q&a&b=1#top")),
        F.concat("stem", F.lit("/%c3%a9~%78 y?&b=%31&a=&c=p+q&")))
    links = url.select("page_id", F.posexplode(spellings).alias("pos", "target_url"))
    kept = links.groupBy(L.canonical_url("target_url").alias("canonical_url")).agg(F.count("*").alias("n_spellings"))
    return L.dedupe_links(links).join(kept, "canonical_url").select("canonical_url", "page_id", "pos", "n_spellings")


def q_rerun_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended in three batches, every batch twice; each is there once, ids dense."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(APPEND_SCHEMA)
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "batches")
    for k in range(3):
        for _ in range(2):
            W.append_with_ids(spark, o.filter(F.col("o_orderkey") % 3 == k), path, schema, batch=f"part{k}")
    h = RD.read_history(spark, path, schema).agg(
        F.count("*").alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.countDistinct("id").alias("n_ids"), F.sum("o_orderkey").alias("sum_keys"))
    b = W.recorded_batches(spark, path)
    # One row of totals beside each of the three batches.
    return b.withColumn("one", F.lit(1)).join(F.broadcast(h.withColumn("one", F.lit(1))), "one").drop("one")


def q_atomic_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed and loaded by status, one load after the other; a load refused in between changes nothing."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string("o_orderkey bigint, o_totalprice double, o_orderstatus string")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    base = scratch_path(spark, "atomic")
    for ds, rows in (("2024-04-03", o.filter("o_orderstatus = 'O'")), ("2024-04-04", o.filter("o_orderstatus = 'F'")),
                     ("2024-04-05", o.withColumn("o_orderkey", F.lit("none")))):
        W.land(rows, base, "orders", ds)
    for ds in ("2024-04-03", "2024-04-04"):
        W.truncate_load(spark, base, "orders", ds, schema, f"{base}/warehouse")
    try:
        W.truncate_load(spark, base, "orders", "2024-04-05", schema, f"{base}/warehouse")
    except Exception:  # noqa: BLE001 - refused: keys that are no numbers
        pass
    return RD.read_table(spark, f"{base}/warehouse", schema)


def _next_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page links to page_id + 1, labelled with its own title (the last one dangles)."""
    pages = _t(spark, sf_dir, "pages")
    titles = select_fields(pages, {"title": "title"}, ("page_id",)).select(
        "page_id", X.strip(H.first_text("title")).alias("label"))
    nxt = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("target_url"))
    last = pages.groupBy().agg(F.max("page_id").alias("page_id"))
    dangling = last.select("page_id", F.concat(F.lit(R.HOST + "/missing/"), F.col("page_id").cast("string"))
                           .alias("target_url"))
    return titles.join(nxt.unionByName(dangling), "page_id").withColumn("pos", F.lit(0))


def q_link_page_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link -> page equi-join on the exact URL, carrying the parent's label as ``market``."""
    links = _next_page_links(spark, sf_dir).withColumnRenamed("page_id", "from_page_id")
    joined, _ = L.resolve_links(links, _t(spark, sf_dir, "pages"), carry=("label", "from_page_id"), canonical=False)
    return joined.select("page_id", "url", "market", "from_page_id")


def q_link_page_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link -> page join on the canonical URL (fragments and argument order do not count)."""
    links = _next_page_links(spark, sf_dir).withColumnRenamed("page_id", "from_page_id")
    joined, _ = L.resolve_links(links, _t(spark, sf_dir, "pages"), carry=("label", "from_page_id"))
    return joined.select("page_id", "url", "market", "from_page_id")


def q_unresolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose target page was not fetched (menu hrefs and the dangling next link)."""
    pages = _t(spark, sf_dir, "pages")
    menu = _nav_links(spark, sf_dir, carry=("url",)).select(
        "page_id", "pos", L.absolute_url("url", "href").alias("target_url"))
    nxt = _next_page_links(spark, sf_dir).select("page_id", F.lit(-1).alias("pos"), "target_url")
    _, unresolved = L.resolve_links(menu.unionByName(nxt), pages, carry=("page_id",))
    return unresolved.select("page_id", F.col("pos").cast("int"), "target_url")


def q_heading_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page heading text; the index-name selector falls back to its sentinel."""
    found = select_fields(_t(spark, sf_dir, "pages"), {
        "h1": Each("h1", {"text": "h1"}), "name": Each(f"small.{S.INDEX_NAME_CLASS}", {"text": "small"})}, ("page_id",))

    def text_or_default(field: str):
        return F.when(F.size(field) > 0, X.strip(H.first_text(F.flatten(f"{field}.text")))).otherwise(
            F.lit(S.SENTINEL_INDEX_NAME))
    return found.select("page_id", text_or_default("h1").alias("heading"), text_or_default("name").alias("indice_name"))


def q_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph texts of each page: first, second (sentinel when missing), count."""
    ps = select_fields(_t(spark, sf_dir, "pages"), {"p": "p"}, ("page_id",)).select("page_id", H.decoded("p").alias("ps"))
    return ps.select("page_id",
                     X.nth_or("ps", 0, S.SENTINEL_DATA).alias("first_text"),
                     X.nth_or("ps", 1, S.SENTINEL_DATA).alias("second_text"),
                     F.size("ps").cast("int").alias("n_texts"))


def _index_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = R.index_pages(spark, sf_dir)
    raw = E.index_items(pages, R.CONTENT)
    return V.stage(V.abbreviate(raw), "indices")


def _valid_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.valid_rows(_index_staged(spark, sf_dir), "indices", keep=("page_id",))


def _valid_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = V.stage(E.company_items(R.company_pages(spark, sf_dir)), "companies")
    return V.valid_rows(staged, "companies")


def q_index_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages re-extracted; maps summarised by size."""
    st = _index_staged(spark, sf_dir)

    def size_or_null(c: str):
        """Entry count; -1 when the record lost its map."""
        return F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.size(c)).cast("int")
    return st.select(
        "page_id", "current_date", "index_abbreviation", "indice_name",
        F.col("_t_index_value").alias("index_value"), F.col("_t_index_change").alias("index_change"),
        F.col("_t_index_percentage_change").alias("index_percentage_change"),
        size_or_null("time_periods").alias("n_periods"), size_or_null("market_summary").alias("n_summary"),
        "extract_error", "reject_reason")


def q_period_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-period returns of valid indices, unpivoted and typed."""
    return C.period_returns(_valid_indices(spark, sf_dir), keys=("page_id",))


def q_summary_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-summary cells, last duplicate key wins, long form."""
    st = _index_staged(spark, sf_dir).filter(F.col("market_summary").isNotNull())
    return C.summary_entries(st, keys=("page_id",))


def q_metric_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary metrics of valid indices normalised to (metric, magnitude, currency, amount)."""
    return C.metric_units(_valid_indices(spark, sf_dir), keys=("page_id",))


def q_level_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index level with the value/change shift repaired."""
    return C.level_repair(_valid_indices(spark, sf_dir)).select(
        "page_id", "index_value", "index_change", "level", "level_repaired")


def q_company_index_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies joined to their market's index through the label abbreviation."""
    joined = C.company_index_join(_valid_companies(spark, sf_dir), _valid_indices(spark, sf_dir))
    return joined.select("company_name", "price", "index_abbreviation", "indice_name")


def q_sector_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up of extracted companies by sector and market."""
    return C.sector_rollup(_valid_companies(spark, sf_dir))


def q_company_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1D / YTD cells read from font, else p, else the N/A default (raw text)."""
    raw = E.company_items(R.company_pages(spark, sf_dir))
    return raw.select("company_name", "one_day", "ytd")


def q_time_periods_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period tables of every index page zipped (longer values, duplicate keys, none), long form.

    The zip runs inside each page's row, so no key can concentrate work.
    """
    st = _index_staged(spark, sf_dir)
    return st.select("page_id", F.explode("time_periods").alias("key", "value"))


def q_abbreviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-parentheses rule over customer labels (none, two, empty, CR/LF inside, empty, null)."""
    c = _t(spark, sf_dir, "customer")
    k, name = F.col("c_custkey"), F.col("c_name")
    label = (F.when(k % 14 == 12, F.lit(None).cast("string"))
             .when(k % 7 == 5, F.lit(""))
             .when(k % 7 == 0, name)
             .when(k % 7 == 1, F.concat(name, F.lit(" (X"), k.cast("string"), F.lit(") (Y)")))
             .when(k % 7 == 2, F.concat(name, F.lit(" ()")))
             .when(k % 7 == 3, F.concat(name, F.lit(" (N\n"), k.cast("string"), F.lit(")")))
             .when(k % 7 == 4, F.concat(name, F.lit(" (R\r"), k.cast("string"), F.lit(")")))
             .otherwise(F.concat(name, F.lit(" ("), F.col("c_mktsegment"), F.lit(")"))))
    return c.select("c_custkey", X.paren_group(label).alias("abbreviation"))


def _date_text(c: str) -> "F.Column":
    return F.date_format(F.col(c), "dd-MMM-yyyy")


def q_after_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text after the last 'As of' marker (zero, one or two markers), stripped."""
    o = _t(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), _date_text("o_orderdate")
    text = (F.when(k % 3 == 0, F.concat(F.lit("As of "), d))
            .when(k % 3 == 1, F.concat(F.lit("x As of y As of "), d, F.lit("  ")))
            .otherwise(F.concat(F.lit("  "), d)))
    return o.select("o_orderkey", X.after_last(text, S.DATE_MARKER).alias("date_part"))


def q_number_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money text with separators, sentinels, blanks, exponents -> double or null."""
    o = _t(spark, sf_dir, "orders")
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    f = F.format_number(v, 2)
    e = F.concat(F.round(v * 100).cast("bigint").cast("string"), F.lit("e-2"))
    value_text = (F.when(k % 10 == 0, F.lit(S.SENTINEL_DATA)).when(k % 10 == 1, F.lit(""))
                  .when(k % 10 == 2, F.lit(",")).when(k % 10 == 3, F.concat(F.lit(" "), f, F.lit(" ")))
                  .when(k % 10 == 4, e).otherwise(f))
    pct_text = (F.when(k % 10 == 0, F.lit(S.SENTINEL_COMPANY)).when(k % 10 == 1, F.lit(""))
                .when(k % 10 == 2, F.lit("%")).when(k % 10 == 3, F.concat(F.lit(" "), f, F.lit("% ")))
                .when(k % 10 == 4, F.concat(e, F.lit("%"))).otherwise(F.concat(f, F.lit("%"))))
    return o.select("o_orderkey",
                    X.to_number(value_text, S.SENTINEL_DATA)["value"].alias("index_value"),
                    X.to_number(pct_text, S.SENTINEL_COMPANY, True)["value"].alias("one_day"))


def q_number_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices with underscores, digits of other scripts or a misplaced underscore."""
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    plain = F.replace(F.format_number(v, 2), F.lit(","), F.lit(""))
    text = (F.when(k % 6 == 0, F.replace(F.format_number(v, 2), F.lit(","), F.lit("_")))
            .when(k % 6 == 1, F.translate(plain, "0123456789", "٠١٢٣٤٥٦٧٨٩"))
            .when(k % 6 == 2, F.translate(plain, "0123456789", "𝟎𝟏𝟐𝟑𝟒𝟓𝟔𝟕𝟖𝟗"))
            .when(k % 6 == 3, F.concat(F.lit("_"), plain)).when(k % 6 == 4, F.replace(plain, F.lit("."), F.lit("_.")))
            .otherwise(F.concat(F.lit("\u00a0"), plain, F.lit("e1_0"))))
    number = X.to_number(text, S.SENTINEL_DATA)
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.round(number["value"] / F.when(k % 6 == 5, 1e10).otherwise(1.0), 2)
                                              .alias("price"), number["error"].alias("error"))


def q_reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company records built from orders with bad tokens -> status and reasons."""
    o = _t(spark, sf_dir, "orders")
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    f = F.format_number(v, 2)
    name = (F.when(k % 12 == 5, F.repeat(F.lit("N"), 300))
            .when(k % 12 == 6, F.concat(F.repeat(F.lit("N"), 250), F.repeat(F.lit(" "), 10)))
            .otherwise(F.concat(F.lit("Order "), k.cast("string"))))
    price = (F.when(k % 12 == 0, F.lit("-")).when(k % 12 == 1, F.lit("1.2%"))
             .when(k % 12 == 2, F.lit("inf")).when(k % 12 == 3, F.lit("nan"))
             .when(k % 12 == 4, F.lit("1.0d")).when(k % 12 == 8, F.lit("-inf")).otherwise(f))
    ytd = F.when(k % 12 == 7, F.lit("%")).otherwise(F.lit("+1.50%"))
    cap = F.when(k % 12 == 8, F.lit("-")).otherwise(f)
    raw = o.select("o_orderkey", name.alias("company_name"), F.col("o_orderpriority").alias("sector"),
                   price.alias("price"), F.lit(S.SENTINEL_COMPANY).alias("one_day"), ytd.alias("ytd"),
                   cap.alias("market_cap"), _date_text("o_orderdate").alias("date"),
                   F.concat(F.lit("M ("), F.col("o_orderstatus"), F.lit(")")).alias("market_name"))
    st = V.stage(raw, "companies")
    ok = F.col("reject_reason").isNull()
    return st.select("o_orderkey", F.when(ok, "valid").otherwise("rejected").alias("status"), "reject_reason",
                     F.col("_t_price").alias("price"),
                     F.length("_t_company_name").cast("int").alias("name_length"))


def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event props JSON -> map -> entries, and the map written back as JSON."""
    ev = _t(spark, sf_dir, "events").select("event_id", M.parse_dict_literal("props").alias("m"))
    e = ev.select("event_id", F.explode(M.or_empty("m")).alias("key", "value"))
    return e.select("event_id", "key", "value",
                    M.map_json(F.create_map("key", "value")).alias("entry_json"))


def q_dict_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Props as Python dict literals in a CSV feed, written, read back and parsed."""
    ev = _t(spark, sf_dir, "events").select(
        "event_id", "event_type", F.replace(F.col("props"), F.lit('"'), F.lit("'")).alias("props"))
    path = scratch_path(spark, "feed")
    W.write_feed_csv(ev, path)
    schema = "event_id string, event_type string, props string"
    back = RD.read_feed_csv(spark, path, schema)
    return back.select(F.col("event_id").cast("bigint").alias("event_id"),
                       F.explode(M.parse_dict_literal("props")).alias("key", "value"))


def q_feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line ends and quotes included, as cells of a CSV feed that is written and read in splits."""
    text = F.regexp_replace("text", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    quoted = F.concat(F.lit('"'), text, F.lit('",\n"'), F.col("lang"), F.lit('"'))
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("text"), quoted.alias("quoted"))
    path = scratch_path(spark, "documents-feed")
    W.write_feed_csv(docs, path)
    back = RD.read_feed_csv(spark, path, "doc_id string, lang string, quoted string, text string")
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.length("text").alias("n_chars"),
                       F.md5(F.encode("text", "UTF-8")).alias("text_md5"), F.md5(F.encode("quoted", "UTF-8")).alias("quoted_md5"))


def q_feed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed cells as Python or JSON literals, broken ones refused with the place."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    kind = F.col("event_id") % 8
    cell = (F.when(kind == 0, F.concat(F.lit("{'k': "), k, F.lit(", 'ok': True, 'note': None}")))
            .when(kind == 1, F.col("props"))
            .when(kind == 2, F.concat(F.lit("{'k': "), k, F.lit(r""".5, "n": 'it\'s \x41\u00e9',}""")))
            .when(kind == 3, F.concat(F.lit("{'k': "), k, F.lit(", 'ok': }")))
            .when(kind == 4, F.lit("  "))
            .when(kind == 5, F.concat(F.lit("{'k': {'n': "), k, F.lit("}}")))
            .when(kind == 6, F.concat(F.lit("{'k': 'a', 'k': '1_"), k, F.lit("'}"))))
    ev = _t(spark, sf_dir, "events").select("event_id", cell.alias("props"))
    staged = V.stage_literals(ev, ("props",))
    return staged.select("event_id", F.when(F.col("reject_reason").isNull(), M.map_json("_t_props")).alias("props"),
                         "reject_reason")


EXPORT_DS = "2024-04-04"


def q_strict_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 F8: landed orders of which some lines carry a stray field, a wrong type or no object, told in one scan."""
    k = F.col("o_orderkey")
    line = (F.when(k % 7 == 1, F.concat(F.lit('{"id":'), k, F.lit(',"note":"x","vip":1}')))
            .when(k % 7 == 2, F.concat(F.lit('{"id":'), k, F.lit(',"price":"cheap"}')))
            .when(k % 7 == 3, F.concat(F.lit('["id",'), k, F.lit("]")))
            .when(k % 7 == 4, F.lit(" "))
            .otherwise(F.concat(F.lit('{"price":'), F.col("o_totalprice").cast("string"), F.lit(',"id":'), k, F.lit("}"))))
    base = scratch_path(spark, "strict")
    _t(spark, sf_dir, "orders").select(line.alias("value")).write.text(base)
    read = RD.checked_landed(spark, base, S.COMPANIES)
    return read.groupBy("refused").agg(F.count("*").alias("n_lines"), F.sum("id").alias("sum_ids"),
                                       F.count("price").alias("n_prices"), F.count("line").alias("n_reported"))


def q_landed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and characters of landed customers, which differ by the letters beyond ASCII."""
    base = scratch_path(spark, "sizes")
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("Größe "), F.col("c_name")).alias("label"))
    landed = W.land(c, base, "customers", EXPORT_DS)
    audits = A.union_all([A.audit_files(spark, landed, "customers", sizes=True),
                          A.audit_text(spark, landed, "customers", sizes=True)])
    return audits.filter(F.col("check").isin("landed_bytes", "landed_chars"))


def q_route_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as items of two record types and unknown ones, each sent to its table or to none."""
    kind = F.when(F.col("event_type") == "view", F.lit("indices")).when(F.col("event_type") == "click", F.lit("companies"))
    items = _t(spark, sf_dir, "events").select("event_id", F.coalesce(kind, F.col("event_type")).alias("record_type"))
    return A.union_all([part.select(F.lit(name).alias("table_name"), "event_id") for name, part in V.route(items).items()])


def q_run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamp and date key of every event's time."""
    return _t(spark, sf_dir, "events").select(
        "event_id", X.run_stamp("ts").alias("stamp"), X.date_key("ts").alias("ds"))


def q_nested_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps exported as nested objects, loaded into a map column, compared free of order."""
    ev = _t(spark, sf_dir, "events")
    keys = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("user"), F.lit("a \"type\""))).when(
        F.col("event_id") % 3 == 1, F.array(F.lit("a \"type\""), F.lit("user"))).otherwise(F.array().cast("array<string>"))
    values = F.when(F.col("event_id") % 3 == 0, F.array(F.col("user_id").cast("string"), F.col("event_type"))).otherwise(
        F.array(F.col("event_type"), F.col("user_id").cast("string")))
    base = scratch_path(spark, "nested")
    schema = T.StructType().add("id", "long").add("market_summary", S.MAP_SS)
    W.land(ev.select(F.col("event_id").alias("id"), M.zip_map(keys, values).alias("market_summary")),
           f"{base}/landing", "maps", EXPORT_DS)
    loaded = W.truncate_load(spark, f"{base}/landing", "maps", EXPORT_DS, schema, f"{base}/warehouse")
    entries = F.transform(M.canonical_entries("market_summary"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return loaded.select("id", F.array_join(entries, ";").alias("entries"))


def q_export_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies appended, full history landed as NDJSON, strictly re-loaded."""
    base = scratch_path(spark, "export")
    W.append_with_ids(spark, _valid_companies(spark, sf_dir), f"{base}/history/companies", S.COMPANIES)
    history = RD.read_history(spark, f"{base}/history/companies", S.COMPANIES)
    W.land(history, f"{base}/landing", "companies", EXPORT_DS)
    W.land(history, f"{base}/landing", "companies", EXPORT_DS)  # re-run of the date: replaced, not doubled
    loaded = W.truncate_load(spark, f"{base}/landing", "companies", EXPORT_DS, S.COMPANIES,
                             f"{base}/warehouse/companies")
    return loaded.drop("id")


APPEND_SCHEMA = "id bigint, o_orderkey bigint, o_totalprice double"


def q_append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended in two batches; ids dense 1..n across both."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(APPEND_SCHEMA)
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    path = scratch_path(spark, "history")
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp")
    W.append_with_ids(spark, o.filter(early).drop("o_orderdate"), path, schema)
    W.append_with_ids(spark, o.filter(~early).drop("o_orderdate"), path, schema)
    h = spark.read.parquet(path)
    return h.agg(F.count("*").alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                 F.countDistinct("id").alias("n_ids"), F.countDistinct("o_orderkey").alias("n_orders"))


ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: row count of every table."""
    return A.row_counts(**{t: _t(spark, sf_dir, t) for t in ALL_TABLES}) \
            .select(F.col("table").alias("table_name"), F.col("rows").alias("n_rows"))


def q_file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders audited for bytes, lines and blank content (paths dropped)."""
    base = scratch_path(spark, "audit")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    landed = W.land(o, base, "orders", EXPORT_DS)
    audits = A.union_all([A.audit_files(spark, landed, "orders"), A.audit_text(spark, landed, "orders")])
    return audits.filter(F.col("check") != "landed_files")


def q_run_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily job on a rendered site."""
    pages = R.site_pages(spark, sf_dir)
    base = scratch_path(spark, "daily")
    # A fetched archive mixes kinds of pages; one kind a file would leave each crawl's parsing to few tasks.
    dealt(pages).write.parquet(f"{base}/pages")
    pages = RD.read_pages(spark, f"{base}/pages")
    seeds = R.menu_pages(spark, sf_dir).select("url")
    rules = D.SiteRules(host=R.HOST, content=R.CONTENT)
    audit = D.run_daily(spark, pages, seeds, base, EXPORT_DS, rules)
    return audit.filter(~F.col("check").isin("landed_files", "landed_bytes", "landed_chars"))


def q_export_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price per unit exported with 10-decimal rounding and read back."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / F.col("l_quantity")).alias("ratio"))
    base = scratch_path(spark, "rounding")
    W.land(li, base, "ratios", EXPORT_DS, compat_round=True)
    schema = "l_orderkey bigint, l_linenumber int, ratio double"
    return spark.read.schema(schema).json(RD.landing_path(base, "ratios", EXPORT_DS))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: NDJSON company records, odd keys carrying an extra field, checked against the load schema."""
    c = _t(spark, sf_dir, "customer")
    recs = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("company_name"),
                    F.col("c_mktsegment").alias("sector"), F.col("c_acctbal").alias("price"),
                    F.when(F.col("c_custkey") % 2 == 1, F.lit("vip")).alias("note"))
    base = scratch_path(spark, "drift")
    recs.write.json(base)
    return A.unexpected_fields(spark, base, S.COMPANIES)


def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day, kept or expired under the 13-day rule at the latest day."""
    ev = _t(spark, sf_dir, "events")
    daily = ev.groupBy(F.to_date("ts").alias("ds")).agg(F.count("*").alias("n_events"))
    run_date = ev.agg(F.max(F.to_date("ts"))).first()[0]
    kept = W.retained(daily, "ds", run_date, 13).withColumn("kept", F.lit(True))
    gone = W.expired(daily, "ds", run_date, 13).withColumn("kept", F.lit(False))
    return kept.unionByName(gone).select(F.date_format("ds", "yyyy-MM-dd").alias("ds"), "n_events", "kept")


def q_retention_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed by day, partitions of 13 days or more at the latest day removed; what is left, by day."""
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("ds"))
    base = scratch_path(spark, "retention")
    ev.write.partitionBy("ds").json(RD.landing_path(base, "events"))
    run_date = _t(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]
    W.remove_expired(spark, base, "events", run_date)
    left = spark.read.schema("event_id bigint, event_type string, ds string").json(RD.landing_path(base, "events"))
    return left.groupBy("ds").agg(F.count("*").alias("n_events"), F.sum("event_id").alias("sum_ids"))


def q_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (by time, then id), via a partial aggregate."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return C.latest_rows(ev, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value")


def q_quote_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote dates as text (with sentinel) typed back to dates."""
    o = _t(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit(S.SENTINEL_DATE)).otherwise(_date_text("o_orderdate"))
    return o.select("o_orderkey", F.date_format(C.quote_date(text), "yyyy-MM-dd").alias("quote_date"))


QUERIES = {
    "q_company_items": q_company_items,
    "q_link_extract": q_link_extract,
    "q_index_url_rule": q_index_url_rule,
    "q_company_url_rule": q_company_url_rule,
    "q_offsite_filter": q_offsite_filter,
    "q_dedupe_links": q_dedupe_links,
    "q_url_fingerprint": q_url_fingerprint,
    "q_rerun_append": q_rerun_append,
    "q_atomic_load": q_atomic_load,
    "q_link_page_join": q_link_page_join,
    "q_link_page_canonical": q_link_page_canonical,
    "q_unresolved_links": q_unresolved_links,
    "q_heading_or_default": q_heading_or_default,
    "q_page_texts": q_page_texts,
    "q_index_items": q_index_items,
    "q_period_returns": q_period_returns,
    "q_summary_kv": q_summary_kv,
    "q_metric_units": q_metric_units,
    "q_level_repair": q_level_repair,
    "q_company_index_join": q_company_index_join,
    "q_sector_rollup": q_sector_rollup,
    "q_company_fallback": q_company_fallback,
    "q_time_periods_zip": q_time_periods_zip,
    "q_abbreviation": q_abbreviation,
    "q_after_last": q_after_last,
    "q_number_clean": q_number_clean,
    "q_reject_split": q_reject_split,
    "q_json_props": q_json_props,
    "q_dict_literal": q_dict_literal,
    "q_feed_documents": q_feed_documents,
    "q_feed_literals": q_feed_literals,
    "q_strict_load": q_strict_load,
    "q_landed_sizes": q_landed_sizes,
    "q_route_items": q_route_items,
    "q_run_stamp": q_run_stamp,
    "q_nested_load": q_nested_load,
    "q_number_python": q_number_python,
    "q_export_load": q_export_load,
    "q_append_history": q_append_history,
    "q_row_counts": q_row_counts,
    "q_file_audit": q_file_audit,
    "q_run_daily": q_run_daily,
    "q_export_rounding": q_export_rounding,
    "q_schema_drift": q_schema_drift,
    "q_retention": q_retention,
    "q_retention_run": q_retention_run,
    "q_latest_row": q_latest_row,
    "q_quote_date": q_quote_date,
}
