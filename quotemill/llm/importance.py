"""Target-distribution importance resampling (operator 11).

Words of the corpus and of a target set are counted into hashed buckets.  A document's weight is the mean
log ratio of its words' buckets, read from one array of gains.  Seeded Gumbel noise turns weights into scores
whose highest few are a sample without replacement.  The cutoff is found by numeric bisection: repeated exact
count jobs over the persisted scores, then over the ids tied at the cutoff.  What is drawn is written in ranges
of the order, and a row's rank is the rows of earlier ranges plus its place in its own.
"""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import ship, staged
from quotemill.session import scratch_path

BUCKETS = 10_000
SEED = "2024"
#: Documents of fewer words are not drawn; so many of a hundred eligible ones are.
LEAST_WORDS, PERCENT = 20, 10
#: Parts into which one count job cuts the interval that holds the cutoff: four halvings at once.
PARTS = 16
#: Features whose value a task keeps at hand.
MEMO = 200_000

# Letters, digits and all beyond ASCII make words; A-Z are lower-cased.
_WORDS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def features(text: str, longest: int = 1) -> list[bytes]:
    """Runs of 1 to ``longest`` words, joined by one blank, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    out = words
    for n in range(2, longest + 1):
        out = out + [b" ".join(run) for run in zip(*(words[i:] for i in range(n)))]
    return out


class _Memo(dict):
    """Value of a feature, worked out once while it is kept; never more than MEMO entries."""

    def __init__(self, value):
        super().__init__()
        self.value = value

    def __missing__(self, feature: bytes):
        if len(self) >= MEMO:
            self.clear()
        found = self[feature] = self.value(feature)
        return found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> list[int]:
    """Occurrences of features in each bucket, over all rows of ``text``; the driver gets one number a bucket."""
    ship(texts.sparkSession)

    def run(batches):
        bucket_of, counts = _Memo(lambda w: crc32(w) % buckets), [0] * buckets
        for batch in batches:
            for text in batch.column(0):
                for b in map(bucket_of.__getitem__, features(text.as_py(), longest) if text.is_valid else ()):
                    counts[b] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(buckets), pa.int32()), pa.array(counts, pa.int64())], ["bucket", "n"])

    out = [0] * buckets
    for r in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Gain of each bucket in thousandths: floored log ratio of the smoothed shares in target and corpus."""
    k, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log(float((t + 1) * (s_all + k)) / float((s + 1) * (t_all + k))))
            for s, t in zip(corpus, target)]


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise of a document in thousandths, from a hash of its id (null: the word null)."""
    own = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{own}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: str = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score`` of every row of ``docs`` against the ``text`` of ``target``.

    A null or wordless text has no features and weight 0; a null id counts as the word ``null`` in its noise.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs, buckets, longest),
                                              bucket_counts(target, buckets, longest)))

    def run(batches):
        by_bucket = gain.value
        gain_of = _Memo(lambda w: by_bucket[crc32(w) % buckets])
        for batch in batches:
            ids, out = batch.column(0), []
            for i, text in zip(ids.to_pylist(), batch.column(1)):
                own = features(text.as_py(), longest) if text.is_valid else []
                weight = sum(map(gain_of.__getitem__, own)) // len(own) if own else 0
                out.append((len(own), weight, weight + noise(i, seed)))
            made = [pa.array(column, pa.int64()) for column in zip(*out)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([ids, *made], ["doc_id", "n_features", "weight", "score"])

    return docs.mapInArrow(run, "doc_id long, n_features long, weight long, score long")


def _least_value(rows: DataFrame, key: Column, rank: int) -> tuple[int, int, int]:
    """The ``rank``-th smallest value of ``key``, rows below it, rows equal to it; each job counts exactly."""
    r = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = r.lo, r.hi
    while lo < hi:
        cuts = sorted({lo + (hi - lo) * i // PARTS for i in range(1, PARTS)})
        counts = rows.agg(*[F.count(F.when(key <= F.lit(c).cast("long"), 1)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        at = next((i for i, n in enumerate(counts) if n >= rank), None)
        if at is None:
            lo = cuts[-1] + 1
        else:
            lo, hi = (cuts[at - 1] + 1 if at else lo), cuts[at]
    value = F.lit(lo).cast("long")
    r = rows.agg(F.count(F.when(key < value, 1)).alias("below"), F.count(F.when(key == value, 1)).alias("equal")).first()
    return lo, r.below, r.equal


def first_rows(rows: DataFrame, keys: list[Column], many: int) -> Column:
    """Condition that exactly the first ``many`` rows in order of ``keys`` (whole numbers, not null) meet.

    The keys together must tell all rows apart, and ``rows`` must be a written table.
    """
    if many <= 0:
        return F.lit(False)
    tie, taken, before, left = F.lit(True), F.lit(False), [], many
    for key in keys:
        value, below, equal = _least_value(rows.where(tie), key, left)
        taken = taken | (tie & (key < F.lit(value).cast("long")))
        tie, left = tie & (key == F.lit(value).cast("long")), left - below
        if left == equal:
            break
    return taken | tie


def ranked(rows: DataFrame, keys: list[Column], name: str = "rank") -> DataFrame:
    """Number the rows 1, 2, 3 ... in order of ``keys``: written in ranges, one file a range, rows in order.

    Only one row a file (its first key and its number of rows) is gathered for the offsets.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "ranges")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_k{i}" for i in range(len(keys))]
    rows.select("*", *[k.alias(n) for k, n in zip(keys, names)]).repartitionByRange(ranges, *names).sortWithinPartitions(
        *names).write.parquet(path)
    kept = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"),
                                           F.col("_metadata.row_index").alias("_at"))
    files = kept.groupBy("_file").agg(F.min(F.struct(*names)).alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return kept.join(F.broadcast(files), "_file").withColumn(name, F.col("_before") + F.col("_at") + 1).drop(
        "_file", "_at", "_before", *names)


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, seed: str = SEED,
             least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Draw ``percent`` of a hundred eligible documents; ``doc_id, n_features, weight, score, rank``.

    One row out per row in; those not drawn have a null rank.  Eligible are rows with at least ``least_words``
    features.  Ties of score go to the smaller id, null ids after all others, then to fewer features; rows equal
    in all of these differ in no other column and are told apart by their place in the written scores.
    Columns other than ``doc_id`` and ``text`` are not looked at.  An empty table gives none; with an empty
    target every gain only reflects how common a bucket is in the corpus.
    """
    made = scores(docs, target, buckets, longest, seed)
    made = staged(made.withColumn("_place", F.monotonically_increasing_id()), "importance")
    out = ["doc_id", "n_features", "weight", "score"]
    eligible = made.where(F.col("n_features") >= least_words)
    keys = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0).cast("long")),
            F.col("n_features"), F.col("_place")]
    drawn = (F.col("n_features") >= least_words) & first_rows(eligible, keys, eligible.count() * percent // 100)
    rest = made.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked(made.where(drawn), keys).select(*out, "rank").unionByName(rest)
