"""Audits as small aggregate DataFrames.

Each audit returns rows of the ``AUDIT`` shape ``(dataset, check, value, flag)``
so that a job can union them into one report: ``value`` is always a number (a
yes/no check reports 1/0) and ``flag`` is always the warning bit.  Everything is an aggregation
over the data or over file listings; nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import readers as R


def audit_row(df: DataFrame, dataset: str, check: str, value, warn=None) -> DataFrame:
    """One audit row from a one-row aggregate frame.

    ``value`` is a column (or column name) of ``df``; ``warn`` a boolean column,
    false when omitted.
    """
    v = value if not isinstance(value, str) else F.col(value)
    w = F.lit(False) if warn is None else warn
    return df.select(F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
                     F.coalesce(v.cast("bigint"), F.lit(0)).alias("value"),
                     F.coalesce(w.cast("boolean"), F.lit(False)).alias("flag"))


def audit_rows(df: DataFrame, dataset: str, *checks) -> DataFrame:
    """Audit rows ``(check, value, warn or None)`` from one one-row aggregate frame, evaluated once for all of them."""
    rows = [F.struct(F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
                     F.coalesce((F.col(value) if isinstance(value, str) else value).cast("bigint"),
                                F.lit(0).cast("bigint")).alias("value"),
                     F.coalesce((F.lit(False) if warn is None else warn).cast("boolean"), F.lit(False)).alias("flag"))
            for check, value, warn in checks]
    return df.select(F.inline(F.array(*rows)))


def yes_no(c) -> "F.Column":
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(**tables: DataFrame) -> DataFrame:
    """H1: ``(table, rows)`` for each named table."""
    return union_all([t.agg(F.count("*").cast("bigint").alias("rows"))
                      .select(F.lit(name).alias("table"), "rows") for name, t in tables.items()])


def audit_files(spark: SparkSession, path: str, dataset: str, sizes: bool = False) -> DataFrame:
    """A6 + F11: number of files, with ``sizes`` total bytes, and an empty-file warning flag.

    Spark's JSON writer adds ``_SUCCESS`` markers; only data files count.
    """
    files = R.file_sizes(spark, path).filter(~F.col("path").rlike(r"/_[^/]*$|/\.[^/]*$"))
    agg = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    empty = F.col("bytes") == 0
    checks = [("landed_files", "files", None), ("landed_empty", yes_no(empty), empty)]
    if sizes:
        checks.append(("landed_bytes", "bytes", empty))
    return audit_rows(agg, dataset, *checks)


def audit_text(spark: SparkSession, path: str, dataset: str, sizes: bool = False) -> DataFrame:
    """A5 + D17: landed lines, with ``sizes`` their characters (not bytes), and whether all content is blank."""
    st = R.file_text_stats(spark, path).filter(~F.col("path").rlike(r"/_[^/]*$"))
    agg = st.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
                 F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
                 F.coalesce(F.bool_and("is_blank"), F.lit(True)).alias("blank"))
    checks = [("landed_rows", "lines", F.col("lines") == 0), ("landed_blank", yes_no(F.col("blank")), F.col("blank"))]
    if sizes:
        checks.append(("landed_chars", "chars", F.col("chars") == 0))
    return audit_rows(agg, dataset, *checks)


def unexpected_fields(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """F8: top-level JSON keys present in the files but absent from the load schema.

    ``(field, rows)``; an empty result means the strict load contract holds.
    The distinct key set is aggregated partially, so it stays small however
    many rows carry a stray key.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    keys = (lines.filter(F.trim("value") != "")
            .select(F.explode(F.json_object_keys("value")).alias("field")))
    known = spark.createDataFrame([(f.name,) for f in schema.fields], "field string")
    return (keys.join(F.broadcast(known), "field", "left_anti")
            .groupBy("field").agg(F.count("*").cast("bigint").alias("rows")))
