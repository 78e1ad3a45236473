"""Consumer-side queries over the typed tables.

The source ships none of these; they are what a reader of the two tables needs
and are listed apart from the inventory.  All are aggregations or narrow
projections; none collects a group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import text as X

# Magnitude words in summary keys.
MAGNITUDE_WORDS = {"Mln": 1e6, "Millions": 1e6, "Bln": 1e9, "Billions": 1e9}


def latest_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order`` (ties broken by later order columns).

    A grouped ``max`` over a struct whose leading fields are the order columns is
    aggregated partially on the map side, so a key holding a third of all rows
    is pre-reduced per task instead of landing on one reducer (a row_number
    window would sort every row of the hot key in one task).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_last")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col("_last")[c].alias(c) for c in order + rest])


def quote_date(c: str | Column) -> Column:
    """``dd-MMM-yyyy`` text -> date; sentinels and bad text -> null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, "dd-MMM-yyyy")


def period_returns(indices: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """``time_periods`` unpivoted to ``(keys.., period, pct)``, percent typed."""
    exploded = indices.select(*keys, F.explode("time_periods").alias("period", "_v"))
    return exploded.select(*keys, "period",
                           X.to_number("_v", S.SENTINEL_COMPANY, True)["value"].alias("pct"))


def summary_entries(indices: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """E2 long form: ``market_summary`` exploded to ``(keys.., key, value)``."""
    return indices.select(*keys, F.explode("market_summary").alias("key", "value"))


def metric_units(indices: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Summary metrics as ``(metric, magnitude, currency, amount)``.

    ``Market Cap. (Mln NGN)`` -> metric ``Market Cap.``, magnitude 1e6, currency
    ``NGN``; the amount is the number times the magnitude (null when the text is
    not a number, e.g. ``-``).
    """
    e = summary_entries(indices, keys)
    unit = F.regexp_extract("key", r"\(([^)]*)\)", 1)
    words = F.split(X.strip(unit), " ")
    mag = F.lit(1.0)
    for word, factor in MAGNITUDE_WORDS.items():
        mag = F.when(F.get(words, 0) == word, F.lit(factor)).otherwise(mag)
    currency = F.when(unit == "", F.lit(None)).otherwise(F.get(words, F.size(words) - 1))
    number = X.to_number("value", S.SENTINEL_COMPANY, False)["value"]
    return e.select(*keys, X.strip(F.regexp_extract("key", r"^([^(]*)", 1)).alias("metric"),
                    mag.alias("magnitude"), currency.alias("currency"),
                    (number * mag).alias("amount"))


def level_repair(indices: DataFrame) -> DataFrame:
    """Index level with the value/change shift (quirk Q1) repaired, flagged."""
    repaired = F.col("index_value").isNull() & F.col("index_change").isNotNull()
    return indices.withColumn("level", F.coalesce("index_value", "index_change")) \
                  .withColumn("level_repaired", repaired)


def company_index_join(companies: DataFrame, indices: DataFrame) -> DataFrame:
    """Companies joined to the latest row of their market's index through the label abbreviation.

    Index rows without a usable abbreviation (sentinel or empty) do not join.
    Of several days of an index the one of the latest quote date counts (ties:
    the greatest values), found by a partially aggregated maximum.  The sides are
    evaluated once; AQE broadcasts the index side when its real size is small,
    and splits a market that holds a large share of all companies otherwise.
    """
    c = companies.withColumn("_abbr", X.paren_group("market_name"))
    i = indices.filter((F.col("index_abbreviation") != S.SENTINEL_ABBREVIATION)
                       & (F.col("index_abbreviation") != "")).withColumnRenamed("id", "index_id")
    plain = sorted(f.name for f in i.schema.fields if f.dataType != S.MAP_SS)
    plain.sort(key=lambda name: name != "index_id")
    latest = F.max_by(F.struct(*i.columns), F.struct(quote_date("current_date").alias("_day"), *plain))
    i = i.groupBy(F.col("index_abbreviation").alias("_key")).agg(latest.alias("_row")).select("_row.*")
    return c.join(i, c["_abbr"] == i["index_abbreviation"], "inner").drop("_abbr")


def sector_rollup(companies: DataFrame, dims: tuple[str, ...] = ("sector", "market_name")) -> DataFrame:
    """Roll-up of count, market cap and mean YTD (mean from exact cents)."""
    ytd_cents = F.round(F.col("ytd") * 100).cast("bigint")
    return companies.rollup(*dims).agg(
        F.count("*").alias("n_companies"),
        F.sum("market_cap").alias("total_market_cap"),
        (F.sum(ytd_cents) / F.count(ytd_cents) / 100).alias("mean_ytd"))
