"""Mixing sources to target weights (operator 3), DataFrame functions only.

Each source gets a budget of words.  Its documents are put in the order of a
hash-random key by ranges of that key, running sums of their sizes are built from
the sums of the ranges (two levels, so no task sees more than a small share of a
source), and the order is cut at the exact budget.  A budget above the source's
size takes every document whole epochs over and cuts the last epoch.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import WORD, staged, word_count

#: Weights given to sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source gives more than so many times its size.
MOST_EPOCHS = 3
#: Mean rows of one key range of the whole table; sets the number of ranges.
ROWS_PER_RANGE = 512


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``(s, size)`` rows -> one row per source: ``s, source_size, target``.

    Shares the sum of all sizes by weight; a target stops at ``most`` times its
    source's size and the excess is reshared by weight until none is above.  That
    fixpoint is target = min(cap, level * weight) for one level, found by sorting
    the sources by cap / weight: those before the first source that the level
    left over does not fill are at their cap.  The windows hold one pre-aggregated
    row per source.
    """
    s = sizes.groupBy("s").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("s")
    pick = F.array(*[F.lit(int(w)) for w in weights])
    s = s.withColumn("w", F.element_at(pick, (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * most)
    every = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("w"), "s").rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(every))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(by_fill), F.lit(0)))
         .withColumn("open", F.sum("w").over(every) - F.coalesce(F.sum("w").over(by_fill), F.lit(0))))
    holds = F.col("left") * F.col("w") <= F.col("cap") * F.col("open")
    first = F.min(F.when(holds, F.struct(F.col("cap") / F.col("w"), "s", "left", "open"))).over(every)
    s = s.withColumn("level", first)
    share = (F.col("level.left") * F.col("w")).cast("double") / F.col("level.open").cast("double")
    target = F.least(F.col("cap").cast("double"), share)
    return s.select("s", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def running_sums(rows: DataFrame, ranges: int) -> DataFrame:
    """Add ``before``: the sum of ``size`` over rows of the same ``s`` with a smaller key.

    Rows carry ``s, size, key`` (32 hex digits, uniform).  Ranges of the key are
    summed first; their running sums, in two levels, are added to those inside a range.
    """
    per = max(1, math.isqrt(ranges))
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("fine", F.shiftright(part * ranges, 32)).withColumn(
        "coarse", F.floor(F.col("fine") / per).cast("long"))
    fine = rows.groupBy("s", "coarse", "fine").agg(F.sum("size").alias("n"))
    coarse = fine.groupBy("s", "coarse").agg(F.sum("n").alias("n"))

    def before(df, part_by, order, name):
        w = Window.partitionBy(*part_by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")

    start = before(fine, ["s", "coarse"], "fine", "in_coarse").join(
        before(coarse, ["s"], "coarse", "start"), ["s", "coarse"]).select(
        "s", "fine", (F.col("start") + F.col("in_coarse")).alias("start"))
    order = Window.partitionBy("s", "fine").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))
    return rows.join(start, ["s", "fine"]).withColumn("before", F.col("start") + F.col("inside")).drop(
        "start", "inside", "fine", "coarse")


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix",
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, text, source`` -> ``doc_id, source, size, source_size, target, taken``.

    One row out per row in.  ``size`` counts words (null or empty text: 0, never
    taken).  A null source is a source of its own, last in order.  The key is
    md5(seed, doc_id), so reruns agree; rows of one doc_id follow each other by
    size, and fully equal rows are interchangeable.  ``taken`` is the words the
    mix takes of the row, repeats counted, at most ``most`` times its size; per
    source it sums to the whole part of the target.  An empty table gives none.
    """
    s = F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("v"), F.col("source")))
    key = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = staged(docs.select("doc_id", "source", s.alias("s"), word_count(F.col("text")).alias("size"),
                              key.alias("key")), "mix-sizes")
    ranges = max(1, math.ceil(rows.count() / rows_per_range))
    targets = source_targets(rows.select("s", "size"), weights, most)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(0)
    rows = running_sums(rows, ranges).join(targets, "s")
    rest = budget - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    The document at a source's cut, at most one a source, comes with the words
    that fall inside the budget.  Documents of which nothing is taken go.  Rows that share a
    doc_id are told apart by their size and source; equal ones share one decision.
    """
    decided = mix(docs, weights, most, seed).groupBy("doc_id", "source", "size").agg(
        F.sum("taken").alias("all_taken"), F.count("*").alias("rows"))
    d = decided.select(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("size").alias("_n"),
                       (F.col("all_taken") / F.col("rows")).cast("long").alias("_t"))
    out = docs.withColumn("_size", word_count(F.col("text"))).join(
        d, F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s"))
        & (F.col("_size") == F.col("_n"))).where("_t > 0")
    whole = F.expr("_t div _size")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("(_t + _size - 1) div _size"))))
    cut = F.col("_copy") > whole
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), 0)
    lead = F.array_join(F.slice(pieces, F.lit(1), F.expr("cast(_t % _size as int)")), "")
    text = F.when(cut, lead).otherwise(F.col("text"))
    new = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)
