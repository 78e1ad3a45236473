"""Operator 7: held-out accuracy, spans, a brute-force Viterbi, edge rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from quotemill.llm import lang_id, queries
from tests.conftest import SF_SMALL


def small_model(spark):
    rows = [("the cat sat on the mat with this and that " * 5, "en"), ("der hund und die katze sind nicht hier " * 5, "de"),
            ("кот сидит на ковре и смотрит в окно " * 5, "ru"), (None, "en"), ("x", None), ("123", "xx")]
    df = spark.createDataFrame([(*r, "n") for r in rows], "text string, lang string, lang_pred string")
    return lang_id.train(df)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    got = queries.op7_language(spark, SF_SMALL).join(docs, "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert got[0] > 0.95 and got[1] > 20


def test_edge_rows_and_spans(spark):
    model = small_model(spark)
    assert model["langs"] == ["de", "en", "ru"]
    mixed = "the cat sat on the mat and that, кот сидит на ковре и смотрит. "
    rows = [(1, None), (2, ""), (3, "12 !?\n"), (None, "the"), (4, mixed), (4, mixed), (5, "漢字 漢字"), (6, "the cat " * 30000)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, lang_pred string, spans int")
    got = lang_id.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3):
        assert (by[i].lang_pred, by[i].score, by[i].spans) == ("und", 0.0, [])
    assert by[None].lang_pred == "en" and by[6].lang_pred == "en" and len(by[6].spans) == 1
    assert [(mixed[s.start:s.end], s.lang) for s in by[4].spans] == [
        ("the cat sat on the mat and that", "en"), ("кот сидит на ковре и смотрит", "ru")]
    assert 0 < by[4].score < 1 and by[5].lang_pred in model["langs"]
    assert lang_id.predict(df.limit(0), model).count() == 0


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = lang_id.train(df)
    assert [(r.lang_pred, r.score) for r in lang_id.predict(df, model).collect()] == [("und", 0.0)]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 3, 4])
    first = np.array([0, 1, 6, 9])
    scores = rng.normal(size=(13, 3)).astype(np.float32) * 2
    path = lang_id._viterbi(scores, first, sizes, 1.5)
    for a, n in zip(first, sizes):
        def value(p):
            return sum(scores[a + i, x] for i, x in enumerate(p)) - 1.5 * sum(x != y for x, y in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=n), key=value)
        assert abs(value(best) - value(path[a:a + n])) < 1e-5
