"""Operator 13 against plain counting."""

import re
from collections import Counter

import numpy as np
import pytest

from quotemill.llm import collocations as C
from quotemill.llm import queries
from tests.conftest import SF_SMALL


def brute_counts(rows, longest):
    counts = Counter()
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            for n in range(1, longest + 1):
                counts.update(("und" if lang is None else lang, " ".join(w[i:i + n])) for i in range(len(w) - n + 1))
    return counts


def brute(rows, longest=3, least=10, top=2000, subsumed=50):
    f = brute_counts(rows, longest)
    total = Counter()
    for (lang, p), c in f.items():
        if " " not in p:
            total[lang] += c
    cands = {k: c for k, c in f.items() if " " in k[1] and c >= least}
    gone = set()
    for (lang, p), c in cands.items():
        w = p.split(" ")
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                sub = (lang, " ".join(w[i:i + n]))
                if 100 * c >= subsumed * f[sub]:
                    gone.add(sub)
    out = []
    for lang in sorted(total):
        scored = []
        for (other, p), a in cands.items():
            if other == lang and (lang, p) not in gone:
                w = p.split(" ")
                cuts = [(1_000_000 * a * a // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
                s, k = min(cuts)
                scored.append((-s, -a, p.encode(), f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return out


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op13_collocations(spark, SF_SMALL)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collected(got) == brute(rows)


@pytest.mark.parametrize("shards, slots, longest", [(1, 64, 3), (3, 1 << 12, 4)])
def test_counts_for_any_shards_and_slots(spark, shards, slots, longest):
    """Few slots only make phrases active too early; counts stay exact."""
    rng = np.random.default_rng(11)
    words = ["a", "B", "c", "dé", "e", "f", "g", "日本", "h", "i"]
    rows = [(("en", None, "日", "")[int(rng.integers(4))],
             " ".join(words[int(i)] + ("." if rng.random() < .05 else "") for i in rng.zipf(1.4, rng.integers(0, 40)) % 10))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    phrases, totals = C.phrase_counts(df, longest, 4, shards, slots)
    want = brute_counts(rows, longest)
    assert {(r.lang.decode(), r.phrase.decode()): r.f for r in phrases.collect()} == {k: c for k, c in want.items() if c >= 4}
    assert sum(r.total for r in totals.collect()) == sum(c for (_, p), c in want.items() if " " not in p)
    assert collected(C.mine(df, longest, 4, 25, 50, shards, slots)) == brute(rows, longest, 4, 25)


def test_edge_rows(spark):
    rows = [(None, None), ("en", ""), ("en", " \t.\n"), ("en", "new york " * 20_000), ("fr", "a\x00b c d\x85e c d " * 12),
            ("en", "x\ty  z,x y z;x y\x0bz " * 5)] + [("de", "Guten Tag! guten tag")] * 6 + [("es", "uno dos")] * 9
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, n int, phrase string").repartition(3)
    got = collected(C.mine(df, shards=3))
    assert got == brute(rows)
    assert ("de", 1, "guten tag", 12, 12, 12, 24, 1_000_000) in got and not any(r[0] == "es" for r in got)
    assert C.mine(df.limit(0)).count() == 0
    assert C.mine(df.where("text is null")).count() == 0


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**11
    rows = [(1, "the", big + 7), (1, "new", big), (1, "york", big - 1), (2, "new york", big - 1), (2, "the new", big // 3),
            (3, "the new york", big // 3 - 1)]
    p = spark.createDataFrame([(b"en", n, w.encode(), f) for n, w, f in rows], "lang binary, n int, phrase binary, f long")
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in C.scored(p).collect()}
    f = {w: x for _, w, x in rows}
    a = f["the new york"]
    cuts = [10**6 * a * a // (f["the"] * f["new york"]), 10**6 * a * a // (f["the new"] * f["york"])]
    assert got == {"new york": (big - 1, big, big - 1, 10**6 * (big - 1) ** 2 // (big * (big - 1))),
                   "the new york": (a, *((f["the"], f["new york"]) if cuts[0] <= cuts[1] else (f["the new"], f["york"])), min(cuts))}


def test_phrases_start_after_their_parts(spark):
    """A phrase's first scan comes after its words reached the threshold, and it sees every shard once."""
    firsts = [np.full(64, C.UNSET, np.uint8)]
    codes, words = C._words([b"a b. a b A b"])
    assert words == [b"a", b"b"] and codes.tolist() == [-1, 0, 1, -1, 0, 1, 0, 1]

    def counted(scan):
        return [(f, p.tolist(), c.tolist()) for f, p, _, c in C._counted(codes, words, b"en", scan, 2, 2, firsts)]
    assert counted(0) == [(0, [[0], [1]], [3, 3])]
    firsts[0][:] = 0
    assert counted(1)[1:] == [(1, [[0, 1], [1, 0]], [3, 1])]
    assert counted(2) == [(1, [[0, 1], [1, 0]], [3, 1])] and counted(3) == []


def test_keys_and_counts_come_back():
    rng = np.random.default_rng(2)
    for size in (0, 1, 5000):
        keys, counts = rng.integers(0, 2**C.KEY_BITS, size), rng.integers(1, 2**32, size)
        a, b = C._key_blobs(keys, counts)
        order = np.argsort(keys)
        assert (C._read_keys(a) == keys[order]).all() and (C._read_counts(b) == counts[order]).all()


def test_slots_set_by_others_before_the_words_reached(spark):
    """The last shard's words make phrases whose slots those of the first two shards have set before."""
    early = [("en", " ".join(f"{a} {b}" for a in "abcdefghABCDEFGHqrst" for b in "ijklmnopuvwxyz"))] * 6
    late = [("en", "late is it . never is it late")] * 6
    # One batch a partition: their numbers modulo 3 put them into shards 0, 2 and 1.
    df = spark.createDataFrame(spark.sparkContext.parallelize(early + late + early, 3), "lang string, text string")
    phrases, _ = C.phrase_counts(df, 3, 4, 3, 64)
    want = {k: c for k, c in brute_counts(early + late + early, 3).items() if c >= 4}
    assert {(r.lang.decode(), r.phrase.decode()): r.f for r in phrases.collect()} == want


def test_a_phrase_starts_after_its_words_whatever_set_its_slots():
    """The slot of "b c" was set in scan 0 by another phrase; its word c reached the threshold in scan 2."""
    codes, words = C._words([b"a b c"])
    firsts = [np.full(1 << 12, C.UNSET, np.uint8) for _ in range(2)]
    slot = C._keys(C._word_hashes(words), b"en") % (1 << 12)
    firsts[0][slot] = [0, 0, 2]
    firsts[1][:] = 0
    got = {(p.tolist()[0][0], p.shape[1], f) for scan in range(9) for f, p, _, _ in C._counted(
        codes, words, b"en", scan, 3, 3, firsts) if p.shape[1] > 1}
    assert got == {(0, 2, 1), (1, 2, 3), (0, 3, 4)}
    seen = [scan for scan in range(9) if any(p.shape[1] == 3 for _, p, _, _ in C._counted(codes, words, b"en", scan, 3, 3, firsts))]
    assert seen == [4, 5, 6] and C._last_scan([*firsts, firsts[0]], 3) == 6


def test_a_check_after_every_second_scan(spark, monkeypatch):
    """Scans of open phrases are read by every second check only; the last scan is always followed by one."""
    rows = [("en", "a b c. a b"), ("de", "x y z")] * 12
    read, reached = [], C._reached
    monkeypatch.setattr(C, "_reached", lambda part, *rest: read.append(part.count()) or reached(part, *rest))
    phrases, _ = C.phrase_counts(spark.createDataFrame(rows, "lang string, text string").coalesce(1), 3, 4, 4, 1 << 12)
    assert {(r.lang.decode(), r.phrase.decode()): r.f for r in phrases.collect()} == brute_counts(rows, 3)
    # Words after scans 1 and 3, two words after 1, 3, 5 and on to 11, three words at the end.
    assert len(read) == 2 + 5 + 1 or len(read) == 2 + 6 + 1


def test_sums_of_keys():
    keys, counts = C._summed([np.array([1, 5, 5]), np.array([0, 5])], [np.array([2, 3, 4]), np.array([7, 2**32])])
    assert keys.tolist() == [0, 1, 5] and counts.tolist() == [7, 2, 7 + 2**32]
    assert len(C._summed([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])[0]) == 0
