"""Readers.  Every read takes an explicit schema; nothing is inferred."""

from __future__ import annotations

import datetime as _dt

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import csv_parts
from ..functions import text as X
from ..operators.sizing import MAX_BROADCAST_BYTES, bounded_count, broadcast_if_small, fence, row_sizes
from ..session import checkpoint_root

# Tasks get the helper with the job; nothing has to be installed on executors.
cloudpickle.register_pickle_by_value(csv_parts)


def read_pages(spark: SparkSession, path: str, ds=None) -> DataFrame:
    """A1/A2: the table of fetched pages ``(page_id, url, html)``.

    A page archive at scale is stored partitioned by fetch date ``ds``
    (``yyyyMMdd``); passing ``ds`` reads that one partition (partition pruning),
    so a daily run never scans the archive's HTML.
    """
    if ds is None:
        return spark.read.schema(S.PAGES).parquet(path)
    schema = T.StructType(S.PAGES.fields + [T.StructField("ds", T.StringType(), True)])
    return (spark.read.schema(schema).parquet(path)
            .filter(F.col("ds") == ds_key(ds)).drop("ds"))


def seed_pages(pages: DataFrame, seeds, max_listed: int = 1_000,
               max_broadcast_rows: int = 100_000) -> DataFrame:
    """A1: the pages that carry the market menu.

    ``seeds`` is a list of URLs (the source had one) or a one-column DataFrame of
    URLs.  Up to ``max_listed`` URLs (proven by a bounded count) become an
    ``IN`` filter that is pushed into the page scan; more are joined as a
    left-semi join, broadcast when proven small.
    """
    if isinstance(seeds, DataFrame):
        s = seeds.select(F.col(seeds.columns[0]).alias("_seed")).distinct()
        if bounded_count(s, max_listed) <= max_listed:
            seeds = [r[0] for r in s.collect()]
        else:
            s = broadcast_if_small(s, max_broadcast_rows)
            return pages.join(s, pages["url"] == s["_seed"], "left_semi")
    return pages.filter(F.col("url").isin(list(seeds)))


def ds_key(ds) -> str:
    """D16 on the driver side: ``yyyyMMdd`` of a logical date (date or ISO text)."""
    if isinstance(ds, str):
        ds = _dt.date.fromisoformat(ds)
    return ds.strftime("%Y%m%d")


def landing_path(base: str, table: str, ds=None) -> str:
    """Landing location of one table (and one logical date)."""
    root = f"{base.rstrip('/')}/{table}"
    return root if ds is None else f"{root}/ds={ds_key(ds)}"


def read_history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A3: full scan of a history table and the folders of its batches (no predicate, every column, no order)."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def version_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/version-{number:010d}"


def table_versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of a replaced table (G7), oldest first; folders of unfinished loads are none."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    return sorted(int(n[len("version-"):]) for n in names if n.startswith("version-"))


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The newest version of a replaced table; without any, no rows."""
    versions = table_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(root, versions[-1]))


def read_landed(spark: SparkSession, base: str, table: str, ds, schema: T.StructType) -> DataFrame:
    """A4: one date's landed NDJSON with the fixed load schema, failing on bad types.

    Unknown fields are not an error for the JSON reader; check them with
    ``audit.unexpected_fields`` (F8).
    """
    return (spark.read.schema(schema).option("mode", "FAILFAST")
            .json(landing_path(base, table, ds)))


def checked_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4 + F8 in one scan of the text: the columns of ``schema`` and ``refused, file, line``.

    ``refused`` is null for a line that holds to the load schema, whose ``file`` and ``line`` are null too.  Else it
    is ``not_an_object``, ``unknown_fields:<names>`` or ``wrong_type``, and the line is given as landed.  Blank
    lines are none.
    """
    bad = "_" + max(schema.names, key=len, default="") + "_"
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where(~X.is_blank("value"))
    row = F.from_json("value", T.StructType(schema.fields + [T.StructField(bad, T.StringType())]),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    names = F.json_object_keys("value")
    # Text that no row holds stands for an empty schema's names.
    stray = F.array_sort(F.array_distinct(F.filter(names, lambda n: ~n.isin(*schema.names, "\x00"))))
    read = fence(lines.select("value", F.col("_metadata.file_path").alias("_file"), row.alias("_row"),
                              names.isNull().alias("_none"), stray.alias("_stray")))
    refused = (F.when(F.col("_none"), F.lit("not_an_object"))
               .when(F.size("_stray") > 0, F.concat(F.lit("unknown_fields:"), F.array_join("_stray", ",")))
               .when(F.col("_row")[bad].isNotNull(), F.lit("wrong_type")))
    return read.select(*[F.col("_row")[n].alias(n) for n in schema.names], refused.alias("refused"),
                       F.when(refused.isNotNull(), F.col("_file")).alias("file"),
                       F.when(refused.isNotNull(), F.col("value")).alias("line"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(path, bytes)`` of every file under ``path``; file content is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("length").alias("bytes")))


def file_text_stats(spark: SparkSession, path: str) -> DataFrame:
    """A5 + D17: per file ``(path, lines, chars, is_blank)``.

    Files are read line by line (splittable), never whole into one row;
    ``chars`` counts characters plus one line end per line.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return (lines.groupBy(F.col("_metadata.file_path").alias("path"))
            .agg(F.count("*").alias("lines"),
                 F.sum(F.length("value") + 1).alias("chars"),
                 F.bool_and(X.is_blank("value")).alias("is_blank")))


def csv_records(spark: SparkSession, path: str, max_splits: int = 400_000) -> DataFrame | None:
    """Records of quoted CSV files as text, ``value, first``, read in parallel however large a file is.

    Lines are read in splits.  Whether a split begins inside quotes, and where the record began that reaches into
    it, follows from the quotes before: counts a split and running sums over the splits of a file.  Each task
    then cuts its split into records; a record that reaches over a border is put together from one part a split.
    ``first`` marks a file's first record.  Order is not kept.  The files are read twice, and a third time if a split
    begins inside quotes.  None if there are more than ``max_splits`` splits, or over 64 MB of their names.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"), F.sum(quotes % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1
    splits = counts.select("file", "block", inside.alias("inside"), "odd")
    # A split wholly inside one record begins none that another could hold the rest of.
    origin = F.last(F.when(~F.col("inside") | (F.col("odd") > 0), F.col("block")), ignorenulls=True).over(before)
    checkpoint_root(spark)
    splits = splits.select("file", "block", F.when(F.col("inside"), origin).alias("begins")).checkpoint()
    rows, size = row_sizes(splits, max_splits)
    if rows > max_splits or size > MAX_BROADCAST_BYTES:
        return None
    # Scans planned at other times may be split otherwise; a split whose state is unknown fails the job.
    known = splits.withColumn("known", F.lit(True))
    unknown = F.raise_error(F.lit("the files were split otherwise while being read")).cast("boolean")
    parts = (lines.join(F.broadcast(known), ["file", "block"], "left").where(F.coalesce("known", unknown))
             .select("value", "file", "block", "begins").mapInArrow(csv_parts.records, csv_parts.ROW))
    whole = parts.where("place in ('first', 'whole')").select("value", (F.col("place") == "first").alias("first"))
    if splits.where("begins is not null").isEmpty():
        return whole
    cut = (parts.where("place in ('first part', 'part')").groupBy("file", "begins")
           .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"),
                F.bool_or(F.col("place") == "first part").alias("first")))
    return whole.unionByName(cut.select(F.array_join("p.value", "\n").alias("value"), "first"))


def read_feed_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                  max_splits: int = 400_000) -> DataFrame:
    """CSV feed with header and quoted cells; every column read as text.

    Files are split (see ``csv_records``), and line ends inside quotes stay.  Cells that hold quotes must be
    quoted, with quotes doubled, as ``write_feed_csv`` does.  Where ``csv_records`` refuses, each file is read by
    one task instead.
    """
    options = {"header": "true", "multiLine": "true", "escape": '"'}
    if schema is None:
        schema = spark.read.options(**options).csv(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = csv_records(spark, path, max_splits)
    if records is None:
        return spark.read.options(**options).schema(schema).csv(path)
    row = F.from_csv(F.regexp_replace("value", r"\r$", ""), schema_ddl(schema), {"multiLine": "true", "escape": '"'})
    return records.where("not first").select(row.alias("row")).select("row.*")


def schema_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
