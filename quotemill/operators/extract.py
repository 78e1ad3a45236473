"""Page -> record extraction with the C/D/E column functions.

Input is the B7 output: target pages ``(page_id, url, html)`` carrying the
parent's ``market`` label.  Both extractors are narrow transformations: each
page is parsed once, in the task that holds it, by selectors given as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import html as H
from ..functions import maps as M
from ..functions import text as X
from ..functions.core import let
from .select import Each, select_fields
from .sizing import fence


#: What is read from an index page; ``{content}`` is where the quote block is.
INDEX_FIELDS = {
    "_name": Each(f"h1.{S.INDEX_HEADING_CLASS} small.{S.INDEX_NAME_CLASS}", {"text": "small"}),
    "_period_keys": (f"table.{S.PERIOD_TABLE_CLASS}", f"tr.{S.PERIOD_KEY_ROW_CLASS} td"),
    "_period_values": (f"table.{S.PERIOD_TABLE_CLASS}", f"tr.{S.DATA_ROW_CLASS} p"),
    "_cells": Each((f"table.{S.SUMMARY_TABLE_CLASS}", f"tr.{S.DATA_ROW_CLASS}", "td"),
                   {"key": "span:first-child", "value": "span:last-child"}),
}
CONTENT_FIELDS = {
    "_dates": f'font[size="{S.DATE_FONT_SIZE}"]',
    "_levels": f'span[style*="{S.LEVEL_SPAN_STYLE}"]',
    "_falling": f'font > span[style*="{S.FALLING_SPAN_STYLE}"]',
}


def index_items(resolved: DataFrame, content: str | None = None) -> DataFrame:
    """one raw index record per page (strings and two string maps).

    ``content`` is a selector or absolute path (C2) of the quote block; without it the whole document is the
    block, and a page without the block has none of its fields.  ``extract_error`` carries the F9 reasons for
    records the source lost (heading without text, summary cell without span text).
    """
    inside = {k: (content, v) if content else v for k, v in CONTENT_FIELDS.items()}
    base = select_fields(resolved, {**INDEX_FIELDS, **inside}, ("page_id", "url", "market"))

    name_present = F.size("_name") > 0
    name_text = H.first_text(F.flatten("_name.text"))
    kvs = F.transform("_cells", lambda c: let(
        F.struct(X.strip(H.first_text(c["key"])).alias("key"), X.strip(H.first_text(c["value"])).alias("value")),
        lambda p: F.when(p["key"].isNotNull() & p["value"].isNotNull(), p)))

    staged = base.select(
        "page_id", "url", "market",
        name_present.alias("_name_present"), name_text.alias("_name_text"),
        H.first_text("_dates").alias("_date_text"), H.decoded("_levels").alias("_levels"),
        H.decoded("_falling").alias("_falling"),
        M.zip_map(H.decoded("_period_keys"), H.decoded("_period_values")).alias("time_periods"),
        kvs.alias("_kvs"))

    name_lost = F.col("_name_present") & F.col("_name_text").isNull()
    cell_lost = F.exists("_kvs", lambda kv: kv.isNull())
    errors = F.array_compact(F.array(
        F.when(name_lost, F.lit("index_name_without_text")),
        F.when(cell_lost, F.lit("summary_cell_without_span"))))
    date_text = F.col("_date_text")
    return fence(staged.select(
        "page_id", "url",
        F.when(date_text.isNull() | (date_text == ""), F.lit(S.SENTINEL_DATE))
         .otherwise(X.after_last(date_text, S.DATE_MARKER)).alias("current_date"),
        F.col("market").alias("index_abbreviation"),
        X.nth_or("_levels", 1, S.SENTINEL_DATA).alias("index_change"),
        F.coalesce(X.strip(F.get("_falling", 0)), F.lit(S.SENTINEL_CHANGE)).alias("index_percentage_change"),
        X.nth_or("_levels", 0, S.SENTINEL_DATA).alias("index_value"),
        F.when(F.col("_name_present"), X.strip("_name_text"))
         .otherwise(F.lit(S.SENTINEL_INDEX_NAME)).alias("indice_name"),
        F.when(cell_lost, F.lit(None).cast(S.MAP_SS))
         .otherwise(M.entries_to_map("_kvs")).alias("market_summary"),
        "time_periods",
        F.nullif(F.array_join(errors, ";"), F.lit("")).alias("extract_error")))


_C1, _C2, _C3, _C4, _C5, _C6, _C7 = S.COMPANY_CELL_CLASSES
COMPANY_ROW = f"table.{S.COMPANY_TABLE_CLASS} tbody tr"
#: What is read from one row of a listing page; the change cells hold a font or else a paragraph.
COMPANY_FIELDS = {
    "company_name": f"td.{_C1} a", "sector": f"td.{_C2}", "price": f"td.{_C3}",
    "one_day": f"td.{_C4} font", "one_day_p": f"td.{_C4} p", "ytd": f"td.{_C5} font", "ytd_p": f"td.{_C5} p",
    "market_cap": f"td.{_C6}", "date": f"td.{_C7}",
}


def company_items(resolved: DataFrame, rebalance_rows: bool = False) -> DataFrame:
    """zero or more raw company records per page, one per ``tbody tr``.

    Adds ``page_id`` and ``row_pos`` (document order) so that results can be
    traced to their page; the eight item fields are strings.

    A page is parsed by the task that holds it.  When a single page can hold a
    large share of all rows (SURVEY K8), ``rebalance_rows`` inserts a
    ``rebalance`` after the row split so AQE spreads what follows over many
    tasks; it costs one shuffle of the rows' texts, so it is off by default.
    """
    found = select_fields(resolved, {"_rows": Each(COMPANY_ROW, COMPANY_FIELDS)}, ("page_id", "market"))
    exploded = found.select("page_id", "market", F.posexplode("_rows").alias("row_pos", "row"))
    if rebalance_rows:
        exploded = exploded.hint("rebalance")

    def text(field: str) -> Column:
        return H.first_text(F.col("row")[field])

    return fence(exploded.select(
        "page_id", F.col("row_pos").cast("int").alias("row_pos"),
        X.strip_or_default(text("company_name")).alias("company_name"),
        X.strip_or_default(text("sector")).alias("sector"),
        X.strip_or_default(text("price")).alias("price"),
        X.strip_or_default(X.first_nonempty(text("one_day"), text("one_day_p"))).alias("one_day"),
        X.strip_or_default(X.first_nonempty(text("ytd"), text("ytd_p"))).alias("ytd"),
        X.strip_or_default(text("market_cap")).alias("market_cap"),
        X.strip_or_default(text("date")).alias("date"),
        F.col("market").alias("market_name")))
