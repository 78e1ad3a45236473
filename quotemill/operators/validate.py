"""Item stages: abbreviation rule, typing, valid/reject split.

``stage`` computes, in one projection, the typed values of a raw record and the
reasons it would be refused.  ``valid_rows`` and ``reject_rows`` are plain
filters over the staged frame; a job that needs both writes the staged frame
once (partitioned by ``status``) and reads each side back, so extraction runs a
single time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import maps as M
from ..functions import text as X
from .sizing import fence, spread

KINDS = {
    "indices": (S.INDEX_NUMBER_FIELDS, S.INDEX_TEXT_LIMITS, S.INDICES),
    "companies": (S.COMPANY_NUMBER_FIELDS, S.COMPANY_TEXT_LIMITS, S.COMPANIES),
}


def abbreviate(raw_index: DataFrame) -> DataFrame:
    """F5 + D6 (stage 300): only index records carry the abbreviation field."""
    if "index_abbreviation" not in raw_index.columns:
        return raw_index
    return raw_index.withColumn("index_abbreviation", X.paren_group("index_abbreviation"))


def route(items: DataFrame, type_col: str = "record_type") -> dict[str, DataFrame]:
    """split a mixed item frame by record type; unknown types are not stored."""
    return {kind: items.filter(F.col(type_col) == kind) for kind in KINDS}


def _varchar(c: Column, limit: int) -> tuple[Column, Column]:
    """VARCHAR(n) -- overflow made only of trailing spaces is cut, else refused."""
    too_long = F.length(c) > limit
    only_spaces = F.length(F.regexp_replace(c, " +$", "")) <= limit
    value = F.when(too_long & only_spaces, F.substring(c, 1, limit)).otherwise(c)
    return value, F.coalesce(too_long & ~only_spaces, F.lit(False))


def stage(raw: DataFrame, kind: str) -> DataFrame:
    """Typed columns ``_t_<field>`` plus ``reject_reason`` (null when the row is valid).

    Reasons, joined by ``;``: ``<field>:not_a_number`` (D13/F4),
    ``<field>:not_finite`` (F7), ``<field>:too_long`` (F6) and any
    ``extract_error`` (F9).  One bad field refuses the whole row.
    """
    numbers, limits, _ = KINDS[kind]
    typed, reasons = [], []
    for field, (sentinel, pct) in numbers.items():
        n = X.to_number(field, sentinel, pct)
        typed.append(n["value"].alias(f"_t_{field}"))
        reasons.append(F.when(n["error"].isNotNull(), F.concat(F.lit(field + ":"), n["error"])))
    for field, limit in limits.items():
        value, bad = _varchar(F.col(field), limit)
        typed.append(value.alias(f"_t_{field}"))
        reasons.append(F.when(bad, F.lit(field + ":too_long")))
    if "extract_error" in raw.columns:
        reasons.append(F.col("extract_error"))
    reason = F.nullif(F.array_join(F.array_compact(F.array(*reasons)), ";"), F.lit(""))
    return fence(spread(raw).select("*", *typed, reason.alias("reject_reason")))


def stage_literals(raw: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Feed columns that hold dict literals, typed as maps ``_t_<field>`` plus ``reject_reason``.

    A null cell is an empty map (E4).  A cell that is no dict refuses its row as ``<field>:<error>``; the reasons
    of several cells are joined by ``;``.
    """
    read = fence(raw.select("*", *[M.dict_literal(f).alias(f"_d_{f}") for f in fields]))
    reasons = [F.concat(F.lit(f + ":"), F.col(f"_d_{f}.error")) for f in fields]
    typed = [F.when(F.col(f"_d_{f}.error").isNull(), M.or_empty(F.col(f"_d_{f}.value"))).alias(f"_t_{f}") for f in fields]
    reason = F.nullif(F.array_join(F.array_compact(F.array(*reasons)), ";"), F.lit(""))
    return read.select(*raw.columns, *typed, reason.alias("reject_reason"))


def valid_rows(staged: DataFrame, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid side in table column order (F10), without the surrogate ``id``.

    ``keep`` names extra columns (e.g. ``page_id``) to carry in front.
    """
    _, _, schema = KINDS[kind]
    cols = [F.col(c) for c in keep]
    for f in schema.fields:
        if f.name == "id":
            continue
        src = f"_t_{f.name}" if f"_t_{f.name}" in staged.columns else f.name
        c = F.col(src)
        if f.dataType == S.MAP_SS:
            c = M.or_empty(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return staged.filter(F.col("reject_reason").isNull()).select(*cols)


def reject_rows(staged: DataFrame, kind: str) -> DataFrame:
    """Refused side: the record as strings (maps as JSON text) + ``reject_reason``."""
    _, _, schema = KINDS[kind]
    keys = [c for c in ("page_id", "row_pos") if c in staged.columns]
    cols = []
    for f in schema.fields:
        if f.name == "id":
            continue
        c = F.col(f.name)
        cols.append((M.map_json(c) if f.dataType == S.MAP_SS else c.cast("string")).alias(f.name))
    return staged.filter(F.col("reject_reason").isNotNull()).select(*keys, *cols, "reject_reason")


def split_valid(raw: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)``; both sides are filters over one staged frame."""
    staged = stage(raw, kind)
    return valid_rows(staged, kind), reject_rows(staged, kind)


def conform(df: DataFrame, schema) -> DataFrame:
    """select and cast to a table's column order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
