"""Operator 11 against a plain re-computation."""

import hashlib
import math
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from quotemill.llm import importance as I
from quotemill.llm import queries
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, score string, rank long, _place int"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, target, buckets=10000, least=20, percent=10):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for w in words(t):
                out[crc32(w.encode()) % buckets] += 1
        return out
    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        w = words(text)
        weight = math.floor(sum(gain[crc32(x.encode()) % buckets] for x in w) / len(w)) if w else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = able[:len(able) * percent // 100]
    rest = sorted((r for r in rows if r[1] < least), key=str) + able[len(drawn):]
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in rest], key=str)


def collected(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert collected(queries.op11_importance(spark, SF_SMALL)) == brute(docs, target)


@pytest.mark.parametrize("percent", [0, 10, 37])
def test_edge_rows(spark, percent):
    docs = [(None, "alpha beta " * 12), (None, "Alpha, beta! " * 11), (3, None), (4, ""), (5, "one"), (2**60 + 1, "x y " * 50_000),
            (-7, "é ü 12 " * 9), (8, "café CAFÉ " * 10)] + [(9, "same words " * 15)] * 7 + [(9, "same words " * 16)] * 5
    docs += [(100 + i, "alpha beta " * 10) for i in range(40)]
    target = ["alpha", None, "café"]
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in docs], SCHEMA).repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert collected(I.resample(df, goal, percent=percent)) == brute(docs, target, percent=percent)


def test_equal_rows_over_a_third(spark):
    docs = [(1, "same words " * 15)] * 300 + [(i, f"w{i} other " * 12) for i in range(2, 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    goal = spark.createDataFrame([("same words",)], "text string")
    for percent in (10, 30, 60):
        assert collected(I.resample(df, goal, percent=percent)) == brute(docs, ["same words"], percent=percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 10)], "doc_id long, text string")
    assert I.resample(none, some).count() == 0
    assert collected(I.resample(some, none)) == brute([(1, "a b " * 10)], [])


def test_longer_features():
    assert I.features("A b, C", 3) == [b"a", b"b", b"c", b"a b", b"b c", b"a b c"]


def test_first_rows_counts_exactly(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") * 2**50).alias("b"))
    keys = [-F.col("a"), F.col("b")]
    want = sorted(((-(i % 7), i * 2**50) for i in range(1000)))
    for many in (0, 1, 142, 143, 500, 999, 1000):
        got = df.where(I.first_rows(df, keys, many)).collect()
        assert sorted((-r.a, r.b) for r in got) == want[:many]
