"""Size checks that guard every broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: No broadcast holds more than this, whatever its row count.
MAX_BROADCAST_BYTES = 64 << 20


def bounded_count(df: DataFrame, bound: int) -> int:
    """Row count capped at ``bound + 1``: proves ``rows <= bound`` cheaply."""
    return df.limit(bound + 1).count()


def row_bytes(df: DataFrame):
    """Bytes of a row's values: texts by their length, nested values by that of their JSON, others eight each."""
    def width(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        return F.lit(8)
    return sum((width(f).cast("long") for f in df.schema.fields), F.lit(16).cast("long"))


def row_sizes(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """Rows and bytes of the first ``max_rows + 1`` rows: proves whether there are more."""
    return tuple(df.select(row_bytes(df).alias("n")).limit(max_rows + 1)
                 .agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the frame is proven to hold at most ``max_rows`` rows and ``max_bytes`` bytes.

    Beyond either bound the frame is returned unhinted and the planner (with AQE)
    picks a shuffle join.  Only the widths of ``max_rows + 1`` rows meet in one task.
    """
    rows, size = row_sizes(df, max_rows)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


#: Bits of the filter that ``possible_members`` broadcasts: 16 a key, at most 256 Mi (32 MB).
BITS_A_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28


def possible_members(df: DataFrame, key: Column, members: DataFrame, member_key: str, count: int) -> DataFrame:
    """Rows of ``df`` whose key may be among the ``count`` keys of ``members``: all that are, and few others.

    One bit a hash value, kept as bitmaps of 4 KB that are broadcast by number; together they hold at most 32 MB
    whatever ``count`` is.  About one in 16 other rows passes, more beyond 16 million keys, so a join on the
    key itself must follow.  Nothing of ``df`` is shuffled and its order stays.
    """
    bits = LEAST_BITS
    while bits < MOST_BITS and bits < BITS_A_KEY * count:
        bits *= 2

    def slot(k: Column) -> Column:
        return F.pmod(F.xxhash64(k), F.lit(bits))
    maps = (members.where(F.col(member_key).isNotNull()).select(slot(F.col(member_key)).alias("s"))
            .groupBy(F.bitmap_bucket_number("s").alias("_number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("_bits")))
    marked = df.withColumn("_slot", F.when(key.isNotNull(), slot(key)))
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = marked.join(F.broadcast(maps), F.bitmap_bucket_number("_slot") == F.col("_number"))
    return found.where(F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*df.columns)


_SCAN_ONLY = {"LogicalRelation", "DataSourceV2Relation", "Project", "Filter", "SubqueryAlias"}


def _scan_only(df: DataFrame) -> bool:
    """True when the plan is scan -> filter -> project only.

    Walks the analyzed logical plan, which exists as soon as the DataFrame does,
    so the check neither plans nor runs anything.
    """
    stack = [df._jdf.queryExecution().analyzed()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() not in _SCAN_ONLY:
            return False
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return True


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one partition per core.

    Parsing pages is CPU-bound.  A page table stored in fewer splits than the
    cluster has cores (a small file, one row group) would leave cores idle, so
    it is spread round-robin.  Only plain scans are considered: their split
    count is known from the file listing without running anything, while the
    partitioning of a shuffled input is already set by the shuffle (and AQE).
    When the input already has enough splits -- any realistically sized
    table -- this is a no-op and nothing is shuffled.
    """
    if not _scan_only(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


#: Parts a core that ``dealt`` makes.
PARTS_A_CORE = 2


def dealt(df: DataFrame) -> DataFrame:
    """Deal rows out evenly over the cores, for CPU-heavy work on rows that a filter or a join has picked.

    The picked rows can lie in few of the input's files, whose tasks would then do all the work while the others
    find nothing to do; that stays so however many files there are.
    """
    return df.repartition(PARTS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def fence(df: DataFrame) -> DataFrame:
    """Keep later filters from re-running the projections that built ``df``.

    Catalyst pushes a filter through deterministic projections by substituting
    each referenced column with its expression, so a filter on an extracted
    field would evaluate the whole extraction once in the filter and again in
    the projection.  Re-emitting each row through a one-element ``inline``
    (a Generate node) stops that: predicates on generated columns stay above
    it, and the projections below run once per row.
    """
    cols = df.columns
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in cols]))))
