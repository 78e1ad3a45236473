"""The pipeline against its operators' rules, stage by stage, on a small table."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from quotemill.llm import mixing
from quotemill.llm.common import staged
from tests.conftest import SF_SMALL
from tests.llm.test_bpe import plain
from tests.llm.test_minhash_join import brute as groups
from tests.llm.test_suffix_dedup import brute as repeats


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src1", 0), (9002, "12 34", "en", "src1", 5)], docs.schema)
    docs = staged(docs.unionByName(extra), "pipeline-test")
    columns, results = docs.columns, {}
    before = {0: docs}
    cur = docs
    for k, (name, stage) in enumerate(P.STAGES):
        cur = staged(stage(spark, cur, SF_SMALL), "pipeline-test")
        results[name] = cur
        before[k + 1] = cur
        if name != "encode":
            assert cur.columns == columns, name
    ids = [{r.doc_id for r in before[k].select("doc_id").collect()} for k in range(5)]
    assert ids[1] == ids[0] - {9001, 9002}
    rows = [(r.doc_id, r.text) for r in before[1].collect()]
    assert ids[2] == {i for i, (_, _, kept) in groups(rows).items() if kept}
    rows = before[2].collect()
    want = dict(zip([r.doc_id for r in rows], repeats([r.text for r in rows], 400)))
    after = {r.doc_id: r for r in before[3].collect()}
    assert set(after) == set(want)
    for r in rows:
        n, removed, _, _ = want[r.doc_id]
        if not removed:
            assert after[r.doc_id] == r
        else:
            assert n - removed - 6 <= len(after[r.doc_id].text.encode()) <= n - removed
    words = {}
    for r in before[4].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    taken = {r.doc_id: r.taken for r in mixing.mix(before[3]).collect() if r.taken}
    assert set(words) == set(taken)
    texts = sorted((r.doc_id, plain(r.text)[0]) for r in before[4].collect())
    assert texts == sorted((r.doc_id, r.n_tokens) for r in before[5].collect())


def test_repeated_ids_with_different_texts(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    def words(k, n=60):
        return " ".join(f"w{k}x{j}" for j in range(n))
    rows = [(1, words(k), "en", "src1", 0) for k in range(10)]  # one id, ten texts
    rows += [(k, words(k), "en", "src1", 0) for k in range(20, 30)]
    rows += [(1, words(20), "en", "src2", 0), (1, words(0) + " end", "en", "src1", 0), (25, words(25), "en", "src1", 0)]
    rows += [(None, words(0), "en", "src1", 0), (7, " ", "en", "src1", 0), (7, " ", "en", "src1", 0)]
    docs = spark.createDataFrame(rows, schema)
    first = {}
    for n in (1, 5):
        out = staged(P.drop_near_duplicates(spark, docs.repartition(n), SF_SMALL), "pipeline-test")
        got = sorted((tuple(r) for r in out.collect()), key=str)
        assert first.setdefault("got", got) == got
    texts = [r[1] for r in first["got"] if r[0] is not None]
    assert len([t for t in texts if t != " "]) == 20 and texts.count(" ") == 2
    assert {words(k) for k in range(1, 10)} | {words(k) for k in range(20, 30)} < set(texts)
    assert (1, words(20), "en", "src2", 0) in first["got"] and (20, words(20), "en", "src1", 0) not in first["got"]
    assert (words(0) in texts) != (words(0) + " end" in texts)
    assert sum(r[0] is None for r in first["got"]) == 1


def _clashing(spark):
    """Documents beside columns that operators use inside, with characters that repeats cut in two."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40)
    names = ["score", "spans", "lang_pred", "_text", "_row", "_key", "_runs", "_h", "_t", "_size", "_copy", "_seq", "_digest",
             "_ids", "component_id", "extra0", "key", "h", "size", "target"]
    shared = "\u00e9" * 230  # 460 bytes
    more = spark.createDataFrame([(5001, "a" + shared + "b\ufffd one", "en", "src1", 0), (5002, "xx" + shared + "y\ufffd two", "en", "src1", 0)],
                                 docs.schema)
    docs = docs.unionByName(more)
    return docs.select(*[F.lit(f"{n} kept").alias(n) for n in names], *docs.columns), names


def test_clashing_columns_pass_through(spark):
    docs, names = _clashing(spark)
    cur = docs = staged(docs, "pipeline-test")
    for name, stage in P.STAGES[:-1]:
        cur = staged(stage(spark, cur, SF_SMALL), "pipeline-test")
        assert cur.columns == docs.columns, name
        assert cur.select(*names).distinct().collect() == docs.select(*names).distinct().collect(), name
        if name == "repeats":
            left = {r.doc_id: r.text for r in cur.where("doc_id > 5000").collect()}
            assert left == {5001: "ab\ufffd one", 5002: "xxy\ufffd two"}
    assert cur.count() > 0
    assert P.STAGES[-1][1](spark, cur, SF_SMALL).count() == cur.count()


def test_without_labels_documents_with_letters_stay(spark):
    rows = [(1, "some words", None, "s", 0), (2, "12 34", None, "s", 0), (3, None, None, "s", 0), (4, "", None, "s", 0),
            (5, "\u65e5\u672c", None, "s", 0), (6, "7 x 8", None, "s", 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    assert sorted(r.doc_id for r in P.identify_language(spark, docs, SF_SMALL).collect()) == [1, 5, 6]
