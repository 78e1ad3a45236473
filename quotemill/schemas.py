"""Schemas, sentinels, selectors and field policies.

Every table has one hand-written ``StructType`` here; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source job's literals for equal results.
# Sentinel texts written when a field is absent.
SENTINEL_ABBREVIATION = "Abbreviation not found"
SENTINEL_INDEX_NAME = "Index Name Not Found"
SENTINEL_DATE = "Date not found"
SENTINEL_CHANGE = "Change not found"
SENTINEL_DATA = "Data not found"
SENTINEL_COMPANY = "N/A"

# Selector vocabulary of the two page kinds.
MENU_SCOPE_CLASS = "mega-inner"
MENU_LINK_CLASS = "menu-market-link"
INDEX_HEADING_CLASS = "page-subtitle"
INDEX_NAME_CLASS = "subheading-category"
PERIOD_TABLE_CLASS = "tabtable-rs_c4try72e"
PERIOD_KEY_ROW_CLASS = "tr_ht1"
DATA_ROW_CLASS = "tabrow"
SUMMARY_TABLE_CLASS = "tabtable-gr_alterora_elemental_2_grey_1s2"
COMPANY_TABLE_CLASS = "tabtable-rs_01k0jris"
COMPANY_CELL_CLASSES = ("col_width_1", "col_width_2", "col_width_3", "col_width_4",
                        "col_width_5", "col_width_6", "col_width_7")
LEVEL_SPAN_STYLE = "font-weight:bold;font-size: 22pt"
FALLING_SPAN_STYLE = "color: #ff0000;"
DATE_MARKER = "As of"
DATE_FONT_SIZE = "1"
COMPANY_PAGE_SUFFIX = "/listed-companies"
# ---------------------------------------------------------------------------

# Host of the market site.  The URL rules (B2, B3) only prepend it, so it is a
# parameter everywhere; this default is a neutral placeholder.
DEFAULT_HOST = "https://www.markets.example"
DEFAULT_DOMAINS = ("www.markets.example",)

# Numeric field policies (D10-D13): field -> (sentinel, strip percent sign).
INDEX_NUMBER_FIELDS = {
    "index_value": (SENTINEL_DATA, False),
    "index_change": (SENTINEL_DATA, False),
    "index_percentage_change": (SENTINEL_CHANGE, False),
}
COMPANY_NUMBER_FIELDS = {
    "price": (SENTINEL_COMPANY, False),
    "one_day": (SENTINEL_COMPANY, True),
    "ytd": (SENTINEL_COMPANY, True),
    "market_cap": (SENTINEL_COMPANY, False),
}
# VARCHAR(255) columns.
INDEX_TEXT_LIMITS = {"indice_name": 255}
COMPANY_TEXT_LIMITS = {"company_name": 255, "sector": 255, "market_name": 255}

S = T.StringType()
D = T.DoubleType()
L = T.LongType()
MAP_SS = T.MapType(S, S)

PAGES = T.StructType([
    T.StructField("page_id", L, False),
    T.StructField("url", S, False),
    T.StructField("html", S, True),
])

LINKS = T.StructType([
    T.StructField("page_id", L, False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("label", S, True),
    T.StructField("href", S, True),
])

RAW_INDEX_FIELDS = ["current_date", "index_abbreviation", "index_change",
                    "index_percentage_change", "index_value", "indice_name",
                    "market_summary", "time_periods"]
RAW_COMPANY_FIELDS = ["company_name", "sector", "price", "one_day", "ytd",
                      "market_cap", "date", "market_name"]

RAW_INDEX = T.StructType(
    [T.StructField(f, S, True) for f in RAW_INDEX_FIELDS[:6]]
    + [T.StructField("market_summary", MAP_SS, True),
       T.StructField("time_periods", MAP_SS, True)])

RAW_COMPANY = T.StructType([T.StructField(f, S, True) for f in RAW_COMPANY_FIELDS])

# Typed history / warehouse tables (jobs DDL and load schema; id is the surrogate key).
INDICES = T.StructType([
    T.StructField("id", L, True),
    T.StructField("current_date", S, True),
    T.StructField("index_abbreviation", S, True),
    T.StructField("index_change", D, True),
    T.StructField("index_percentage_change", D, True),
    T.StructField("index_value", D, True),
    T.StructField("indice_name", S, True),
    T.StructField("market_summary", MAP_SS, True),
    T.StructField("time_periods", MAP_SS, True),
])

COMPANIES = T.StructType([
    T.StructField("id", L, True),
    T.StructField("company_name", S, True),
    T.StructField("sector", S, True),
    T.StructField("price", D, True),
    T.StructField("one_day", D, True),
    T.StructField("ytd", D, True),
    T.StructField("market_cap", D, True),
    T.StructField("date", S, True),
    T.StructField("market_name", S, True),
])

AUDIT = T.StructType([
    T.StructField("dataset", S, False),
    T.StructField("check", S, False),
    T.StructField("value", L, True),
    T.StructField("flag", T.BooleanType(), True),
])

TABLES = {"indices": INDICES, "companies": COMPANIES}


def field_names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
