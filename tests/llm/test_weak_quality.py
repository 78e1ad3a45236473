"""Operator 12 against plain re-computations."""

import re
from collections import Counter

import numpy as np
import pytest

from quotemill.llm import queries
from quotemill.llm import weak_quality as Q
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    hit = {j for i, x in enumerate(wins) if n[x] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def more(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(lines), len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text)),
            len([c for c in text if 32 < ord(c) < 127 and not c.isalnum()]), len(set(w)),
            len([x for x in w if x[-1] in ".!?"]), len([x for x in w if all(32 < ord(c) < 127 and not c.isalnum() for c in x)]))


def brute_votes(m):
    out = []
    for _, what, scale, worst_low, low, high, worst_high in Q.RULES:
        x, of = 100 * m[what], 1 if scale == "one" else m[scale]
        out.append(0 if of <= 0 else -1 if (worst_low > 0 and x < worst_low * of) or x > worst_high * of
                   else 1 if low * of <= x <= high * of else 0)
    return out


def brute(texts):
    """Expectation-maximisation row by row, without patterns."""
    ms = [dict(zip(Q.MEASURES, base(t) + more(t))) for t in texts]
    v = np.array([brute_votes(m) for m in ms]).reshape(len(ms), len(Q.RULES))
    share, good, bad = Q.GOOD[0], np.full(v.shape[1], Q.ON_GOOD[0]), np.full(v.shape[1], Q.ON_BAD[0])

    def posterior():
        up, down = np.log(good / (1 - bad)), np.log((1 - good) / bad)
        return 1 / (1 + np.exp(-(np.log(share / (1 - share)) + (v > 0) @ up + (v < 0) @ down)))

    for _ in range(Q.ITERATIONS):
        q = posterior()
        share = np.clip(q.mean(), *Q.GOOD[1:])
        good = np.clip((q @ (v > 0) + Q.PSEUDO * Q.ON_GOOD[0]) / (q @ (v != 0) + Q.PSEUDO), *Q.ON_GOOD[1:])
        bad = np.clip(((1 - q) @ (v < 0) + Q.PSEUDO * Q.ON_BAD[0]) / ((1 - q) @ (v != 0) + Q.PSEUDO), *Q.ON_BAD[1:])
    out = []
    for m, q in zip(ms, posterior()):
        failed = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        out.append((failed, float(q), bool(not failed and q >= 0.5)))
    return ms, out


def compare(rows, got):
    ms, verdicts = brute([t for _, t in rows])
    want = sorted(((i, *m.values(), *v) for (i, _), m, v in zip(rows, ms, verdicts)), key=str)
    got = sorted((tuple(r) for r in got), key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:-2] == b[:-2] and a[-1] == b[-1]
        assert a[-2] == pytest.approx(b[-2], abs=1e-9)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    compare([(r.doc_id, r.text) for r in docs.collect()], Q.judge(docs).collect())
    out = queries.op12_quality(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert out.count() == docs.count()


def test_edge_rows(spark):
    good = "Seven clean words stand in this line. And then nine more words follow in the next."
    rows = [(None, None), (2**62 + 1, ""), (3, " \t\n\x0b\x0c\r "), (4, "a b  c"), (5, "x " * 30_000), (6, "é" * 9), (7, "one"),
            (8, good), (8, good), (9, "###!! %%%$$$ " * 40), (10, "SHOUT!! LOUD!! " * 4 + good), (11, "l\nl \nl\nm\n\n\nm"),
            (12, " | ".join(f"w{i}" for i in range(60)))] + [(20 + i, good + f" Number {i}.") for i in range(30)]
    df = spark.createDataFrame([(i, t, 1, "p", 0.5) for i, t in rows],
                               "doc_id long, text string, n_words int, _pattern string, posterior double").repartition(4)
    got = Q.judge(df).collect()
    compare(rows, got)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[8] and all(kept[20 + i] for i in range(30)) and not kept[9] and not kept[None] and not kept[12]


def test_empty_and_clashes(spark):
    df = spark.createDataFrame([], "doc_id long, text string, kept boolean")
    assert Q.judge(df).count() == 0
    with pytest.raises(ValueError, match="kept"):
        Q.judge(df, ("doc_id", "kept"))
    one = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, note string")
    assert Q.judge(one, ("doc_id", "text", "note")).first()[:3] == (1, "a", "b")


def test_repeated_words_against_positions():
    rng = np.random.default_rng(5)
    for _ in range(300):
        w = [b"abc"[i:i + 1] for i in rng.integers(0, 3, rng.integers(0, 40))]
        assert Q.repeated_words(w) == base(b" ".join(w).decode())[4]


def test_accuracies_recovered():
    """Votes drawn from known accuracies: the estimate finds them and the labels."""
    rng = np.random.default_rng(3)
    n, rules = 40_000, 6
    good = rng.random(n) < 0.8
    spec, sens = np.array([.98, .95, .97, .99, .96, .9]), np.array([.5, .7, .4, .6, .8, .3])
    bad_vote = np.where(good[:, None], rng.random((n, rules)) > spec, rng.random((n, rules)) < sens)
    v = np.where(rng.random((n, rules)) < 0.2, 0, np.where(bad_vote, -1, 1))
    codes = (v + 1) @ (3 ** np.arange(rules - 1, -1, -1))
    share, on_good, on_bad = Q.estimate(dict(Counter(codes.tolist())), rules, 200)
    assert share == pytest.approx(0.8, abs=0.03)
    assert np.allclose(on_good, spec, atol=0.02) and np.allclose(on_bad, sens, atol=0.06)
    verdict = np.array([Q.posterior(Q.votes_of(int(c), rules), share, on_good, on_bad) >= 0.5 for c in codes])
    assert (verdict == good).mean() > 0.93


def test_labels_of_the_given_tables(spark):
    """Held against labels it never sees: clean documents stay, junk goes."""
    sf = "/root/testdata/sf0.1"
    out = queries.op12_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.95
