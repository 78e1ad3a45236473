"""Writers: append, surrogate ids, landing, truncate-load, CSV feed, retention.

All writes are one Spark job per batch (never per row) and commit atomically
through the file committer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import maps as M
from ..operators.sizing import broadcast_if_small
from ..session import scratch_path
from ..sources import readers as R


def _fs(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _fs(spark, old)
    if not fs.rename(source, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table with the fixed schema if it does not exist."""
    if not _exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def assign_ids(df: DataFrame, start: int | Column = 1, col: str = "id",
               stable_input: bool = False) -> DataFrame:
    """Dense increasing ids ``start, start+1, ...`` without a global window.

    A row's place is its file and its index in it, which no split size changes.
    Pass 1 counts rows per file, pass 2 adds a file's offset to the index.  Unless
    the caller states that ``df`` reads whole files (``stable_input``), it is
    written to the shared scratch folder first.  A file without an offset, or
    one of which only some rows are numbered, fails the job.
    """
    spark = df.sparkSession
    if not stable_input:
        path = scratch_path(spark, "ids")
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    counts = tagged.groupBy("_file").agg(F.count("*").alias("_n"), F.max("_at").alias("_last"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = counts.select("_file", F.when(F.col("_n") == F.col("_last") + 1, offset).alias("_off"))
    out = tagged.join(broadcast_if_small(offsets, 200_000), "_file", "left")
    start_col = start if isinstance(start, Column) else F.lit(start)
    found = F.coalesce("_off", F.raise_error(F.lit("rows of a file were not all numbered")).cast("bigint"))
    return out.select((start_col + found + F.col("_at")).cast("bigint").alias(col), *df.columns)


def next_id(spark: SparkSession, path: str) -> int:
    """First free id of a history table (max + 1; 1 when empty)."""
    mx = spark.read.option("recursiveFileLookup", "true").parquet(path).agg(F.max("id")).first()[0]
    return 1 if mx is None else int(mx) + 1


def append(df: DataFrame, path: str) -> None:
    """Append a batch to a history table."""
    df.write.mode("append").parquet(path)


BATCH = "batch string, first_id bigint, rows bigint"


def recorded_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches of a history table: ``batch, first_id, rows``; a batch is listed once it is whole."""
    root = f"{path}/_batches"
    if not _exists(spark, root):
        return spark.createDataFrame([], BATCH)
    return spark.read.schema(BATCH).option("recursiveFileLookup", "true").json(root)


def append_with_ids(spark: SparkSession, valid: DataFrame, path: str, schema: T.StructType,
                    stable_input: bool = False, batch: str | None = None) -> bool:
    """Create if absent, number after the current max id, append in column order.

    With ``batch`` (a date key) the append can be repeated: the batch goes to a folder of its own, and a record
    of its name, first id and rows is written last.  A recorded batch is skipped.  One that was cut short has
    no record; its folder is written over, with ids after those of all other rows.  Without ``batch`` every
    call appends, as the source does.  Returns whether rows were written.
    """
    ensure_table(spark, path, schema)
    if batch is None:
        with_ids = assign_ids(valid, next_id(spark, path), stable_input=stable_input)
        append(with_ids.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), path)
        return True
    if not recorded_batches(spark, path).where(F.col("batch") == batch).isEmpty():
        return False
    folder = f"{path}/rows-{batch}"
    fs, hpath = _fs(spark, folder)
    fs.delete(hpath, True)  # what a run that was cut short left
    first = next_id(spark, path)
    with_ids = assign_ids(valid, first, stable_input=stable_input)
    with_ids.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.parquet(folder)
    rows = spark.read.schema(schema).parquet(folder).count()
    spark.createDataFrame([(batch, first, rows)], BATCH).coalesce(1).write.mode("overwrite").json(f"{path}/_batches/{batch}")
    return True


def export_columns(df: DataFrame, compat_round: bool = False) -> list[Column]:
    """NaN exported as null; optional 10-decimal rounding of doubles."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
            if compat_round:
                c = F.round(c, 10)
        cols.append(c.alias(f.name))
    return cols


def land(df: DataFrame, base: str, table: str, ds, compat_round: bool = False) -> str:
    """G5 + G6: NDJSON under the logical date; re-running a date replaces that date only.

    Nulls are written explicitly and maps as nested objects.
    """
    root = R.landing_path(base, table)
    (df.select(*export_columns(df, compat_round), F.lit(R.ds_key(ds)).alias("ds"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("ignoreNullFields", "false").partitionBy("ds").json(root))
    return R.landing_path(base, table, ds)


def truncate_load(spark: SparkSession, base: str, table: str, ds, schema: T.StructType,
                  dest: str) -> DataFrame:
    """Replace the warehouse table with one date's landed file (strict schema).

    One scan of the landed text parses, tests and writes.  A line with a field the schema does not know, or a
    value of another type, refuses the load; the error names some of those lines.  The rows are written to a
    folder that no reader looks at; one rename makes it the table's newest version.  Whatever fails before leaves
    the table as it was.  The version before stays for readers that have it open, older ones go.  One load of a
    table at a time.
    """
    landed = R.checked_landed(spark, R.landing_path(base, table, ds), schema)
    root = dest.rstrip("/")
    fresh = f"{root}/_loading-{uuid.uuid4().hex}"
    seen = Observation()
    landed.observe(seen, F.count("refused").alias("refused")).where("refused is null") \
          .select(*schema.names).write.parquet(fresh)
    if seen.get["refused"]:
        fs, hpath = _fs(spark, fresh)
        fs.delete(hpath, True)
        lines = landed.where("refused is not null").orderBy("file", "line").limit(5).collect()
        raise ValueError(f"{table}: landed lines refused: {[(r.refused, r.file, r.line[:200]) for r in lines]}")
    versions = R.table_versions(spark, root)
    number = (versions[-1] if versions else 0) + 1
    _rename(spark, fresh, R.version_path(root, number))
    for old in versions[:-1]:
        fs, hpath = _fs(spark, R.version_path(root, old))
        fs.delete(hpath, True)
    return R.read_table(spark, root, schema)


def write_feed_csv(df: DataFrame, path: str) -> None:
    """CSV feed with header; maps as JSON text, columns in alphabetical order."""
    cols = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f.name)
        cols.append((M.map_json(c) if isinstance(f.dataType, T.MapType) else c.cast("string")).alias(f.name))
    df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _age(ds_col: str, run_date):
    """Days from the landing date (a date, or ``yyyyMMdd`` as text or number) to ``run_date``."""
    text = F.col(ds_col).cast("string")
    landed = F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"), text.try_cast("date"))
    return F.datediff(F.lit(run_date).cast("date"), landed)


def retained(df: DataFrame, ds_col: str, run_date, days: int = 13) -> DataFrame:
    """Rows whose landing date is younger than ``days`` at ``run_date`` (kept)."""
    return df.filter(_age(ds_col, run_date) < days)


def expired(df: DataFrame, ds_col: str, run_date, days: int = 13) -> DataFrame:
    """The complement of ``retained`` (what the retention rule deletes)."""
    return df.filter(_age(ds_col, run_date) >= days)



def remove_expired(spark: SparkSession, base: str, table: str, run_date, days: int = 13) -> DataFrame:
    """Delete the landing partitions of ``days`` or more at ``run_date``; returns ``ds, removed`` of all of them.

    Partitions are told by their folder's name (``ds=yyyyMMdd`` or an ISO date); folders of other names stay and
    are not reported.  Only names are listed, no file is read.  A second run finds nothing left to remove.
    """
    root = R.landing_path(base, table)
    fs, hpath = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()] if fs.exists(hpath) else []
    dates = spark.createDataFrame([(n[3:],) for n in names if n.startswith("ds=")], "ds string")
    found = [(r.ds, r.age >= days) for r in dates.select("ds", _age("ds", run_date).alias("age")).collect()
             if r.age is not None]
    for ds, gone in found:
        if gone and not fs.delete(_fs(spark, f"{root}/ds={ds}")[1], True):
            raise OSError(f"cannot remove {root}/ds={ds}")
    return spark.createDataFrame(found, "ds string, removed boolean")
