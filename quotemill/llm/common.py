"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import scratch_path

#: A word: a run of characters other than blank and the controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


#: A Bloom filter's bits a key, and its bits at most (32 MB).  A fuller filter lets more keys
#: through; whoever uses it must be right for any key let through.
FILTER_BITS, MOST_BITS = 16, 1 << 28

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to Python workers, once a session, through Spark's own file distribution."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quotemill-py-"), "quotemill_workers.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder in ("", "llm"):
            for name in sorted(os.listdir(os.path.join(top, folder))):
                if name.endswith(".py"):
                    z.write(os.path.join(top, folder, name), os.path.join("quotemill", folder, name))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of re-running
    what made it.  Texts and ids take about a third less room with zstd than with Spark's default.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (null: 0), natively."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def batches(frames: Iterator, max_chars: int, column: str = "text") -> Iterator:
    """Split incoming pandas frames so that each holds about ``max_chars`` characters.

    A row is never split; one longer than the bound forms a batch of its own.  Memory that
    earlier tasks of this worker have freed goes back to the system before and after.
    """
    give_back()
    for frame in frames:
        sizes = frame[column].str.len().fillna(0).to_numpy()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_chars:
                yield frame.iloc[start:i]
                start, held = i, 0
            held += n
        if start < len(frame):
            yield frame.iloc[start:]
    give_back()


def give_back() -> None:
    """Return freed memory of this Python worker to the system: Spark keeps workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_partitions(df: DataFrame, least: int | None = None) -> DataFrame:
    """Deal rows out when the scan has fewer splits than the cluster has cores."""
    cores = least or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bloom_filter(keys: DataFrame, places: Callable[[int], list[Column]]) -> tuple[np.ndarray, int]:
    """A Bloom filter of the rows, as words of 32 bits, and its number of bits.

    ``places`` gives a key's bit numbers for a size.  The bits are set in Spark;
    what reaches the driver is bounded by MOST_BITS.
    """
    n = keys.count()
    bits = 1 << 16
    while bits < min(MOST_BITS, FILTER_BITS * n):
        bits *= 2
    words = keys.select(F.explode(F.array(*places(bits))).alias("p")).select(
        F.shiftright("p", 5).alias("w"), F.expr("shiftleft(1L, cast(p % 32 as int))").alias("b")).groupBy("w").agg(
        F.bit_or("b").alias("b")).toPandas()
    out = np.zeros(bits // 32, np.uint32)
    out[words["w"].to_numpy()] = words["b"].to_numpy().astype(np.uint32)
    return out, bits
