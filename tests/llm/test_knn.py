"""Operator 10: recall and scores against brute force, edge rows."""

import numpy as np

from quotemill.llm import knn_tree, queries
from tests.conftest import SF_SMALL


def brute(ids, x, query, k):
    score = (x[ids.tolist().index(query)] * x).sum(axis=1)
    return [(int(i), float(s)) for i, s in sorted(zip(ids, score), key=lambda p: (-p[1], p[0])) if i != query][:k]


def test_recall_on_the_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    got = {}
    for r in queries.op10_nearest(spark, SF_SMALL).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == sorted(i for i in ids if i % 20 == 0)
    hit = 0
    for q, found in got.items():
        want = brute(ids, x, q, 20)
        assert sorted(found) == list(range(1, 21))
        ordered = [found[i] for i in range(1, 21)]
        assert ordered == sorted(ordered, key=lambda p: (-p[1], p[0]))
        everything = dict(brute(ids, x, q, len(ids)))
        assert all(abs(everything[i] - s) < 1e-12 for i, s in ordered)
        hit += len({i for i, _ in want} & {i for i, _ in ordered}) / 20
    assert hit / len(got) >= 0.9


def test_blocks_ties_and_bad_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(600)] + [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(300)]
    bad = [(2000, None), (2020, [0.0] * 4), (2040, [1.0, None, 1.0, 1.0]), (2060, [float("nan")] * 4),
           (2080, [float("inf"), 0.0, 0.0, 0.0]), (2100, [1.0]), (None, [1.0] * 4), (2120, [])]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows + bad + rows[:3]],
                               "vec_id long, embedding array<double>, rank int, v string").repartition(6)
    found = knn_tree.search(df, df.where("vec_id % 20 = 0"), k=20, recall=1.0, block=64, query_block=8,
                            leaf=40, calibration=1000)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert sorted(got) == [i for i in ids if i % 20 == 0]
    for q, have in got.items():
        want = brute(ids, x, q, 20)
        assert [v for _, v, _ in sorted(have)] == [v for v, _ in want]


def test_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.5, 0.5]), (22, [-1.0, 0.0])], schema)
    got = knn_tree.search(df, df.where("vec_id = 20")).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 21, 0.5), (2, 22, -1.0)]
    one = df.where("vec_id = 20")
    assert knn_tree.search(one, one).count() == 0
    assert knn_tree.search(df.limit(0), df).count() == 0
    assert knn_tree.search(df, df.limit(0)).count() == 0
