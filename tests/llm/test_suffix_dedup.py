"""Operator 8 against a plain table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np

from quotemill.llm import queries
from quotemill.llm import suffix_dedup as S
from tests.conftest import SF_SMALL


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(hashlib.md5(d[i:i + length]).digest() for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[hashlib.md5(d[i:i + length]).digest()] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], 400)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_repeats(spark, SF_SMALL).collect()}
    assert got == want


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, other = text(30), text(45)
    texts = ["", None, "short", "z" * 300, "ab" * 90, "\x00" * 70, "é" * 100]
    for i in range(120):
        cut = rng.randrange(0, 40)
        texts.append(text(rng.randrange(3, 30)) + shared[cut:] + text(5) + (other if i % 9 == 0 else other[:60]) + text(9))
    base = text(150)
    for i in range(25):
        near = list(base)
        near[rng.randrange(len(near))] = "#"
        texts.append("".join(near))
    return [*texts, texts[20], texts[20], shared + shared]


def check(spark, largest):
    texts = corpus()
    rows = [(i if i != 9 else None, t, 5, "x") for i, t in enumerate(texts)] + [(40, texts[40], 1, "repeat")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, h string").repartition(5)
    got = sorted(((r.doc_id, r._n_bytes, r._n_removed, r._n_spans, hashlib.sha256(r._kept).hexdigest())
                  for r in S.remove_repeats(df, 64, 16, largest).collect()), key=str)
    want = sorted(((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], 64))), key=str)
    assert got == want


def test_collections(spark):
    check(spark, S.LARGEST)


def test_window_by_window(spark):
    check(spark, 1)


def test_large_group_inside_a_task(monkeypatch):
    rng = random.Random(3)
    text = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    middle = text(60)
    strings = [text(30) + middle + text(30) for _ in range(30)] + [b"x" * 10 + middle + text(20), b"y" * 10 + middle + text(20)]
    strings += [text(4) + strings[0][4:] for _ in range(3)] + [strings[1][:-3] + text(3) for _ in range(3)]
    import pandas as pd
    frame = pd.DataFrame({"anchor": 1, "digest": range(len(strings)), "data": strings,
                          "place": [10 + 5 if s[:1] in b"xy" else 35 for s in strings]})

    def run(large):
        monkeypatch.setattr(S, "LARGE", large)
        found = pd.concat(S._compare([frame], 64))
        return {(d, w) for _, d, a, b in found.itertuples(index=False) for w in range(a, b + 1)}
    seen = Counter(s[i:i + 64] for s in strings for i in range(len(s) - 63))
    want = {(d, i) for d, s in enumerate(strings) for i in range(len(s) - 63) if seen[s[i:i + 64]] > 1}
    assert run(1024) == run(1) == want and want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(df).count() == 0


def test_columnwise_transform_against_all_starts():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(40)] + [b"a" * 30] * 2
    seen = Counter(s[i:i + 7] for s in strings for i in range(len(s) - 6))
    for s, flags in zip(strings, S.repeated_windows(strings, 7)):
        assert flags.tolist()[:len(s)] == [i + 7 <= len(s) and seen[s[i:i + 7]] > 1 for i in range(len(s))]
