"""Operator 1 against a plain re-computation."""

import hashlib
import zlib

from quotemill.llm import imatch, queries
from tests.conftest import SF_SMALL


def brute(rows, words):
    """Rows (doc_id, text) -> expected digest tuples, fingerprints by one Fingerprinter."""
    make = imatch.Fingerprinter(words)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (i, text), (_, other) in zip(rows, rows[1:] + rows[:1]):
        text, other = text or "", other or ""
        cut = len(text) // 2
        edited = text[:len(text) - cut] + other[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), make(text), make(edited),
                    imatch.likeness(make(text), make(edited)), imatch.likeness(make(text), make(other))))
    return sorted(out, key=str)


def compare(df, rows, **band):
    got = sorted((tuple(r) for r in imatch.fingerprint_edits(df, **band).collect()), key=str)
    assert got == brute(rows, imatch.lexicon(df, **band))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op1_imatch(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows, imatch.lexicon(docs))


def test_lexicon_band(spark):
    df = spark.createDataFrame([("A a b!",), ("a c",), ("a b d",), (None,)], "text string")
    assert imatch.lexicon(df, 0.5, 0.6) == [b"b"]
    assert imatch.lexicon(df, 0.0, 0.3) == [b"c", b"d"]


def test_edge_rows(spark):
    rows = [(None, "one two three four"), (5, ""), (7, None), (9, "é" * 9), (11, "one two"), (12, "x y " * 60000),
            (13, "two\x00 three")]
    df = spark.createDataFrame([(*r, 3, "f") for r in rows], "doc_id long, text string, n_chars long, fingerprint string")
    compare(df.repartition(3), rows, least=0.0, most=1.0)
    same = [(4, "a b c d")] * 5
    compare(spark.createDataFrame(same, "doc_id long, text string"), same, least=0.0, most=1.0)
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert imatch.fingerprint_edits(one).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert imatch.fingerprint_edits(one.limit(0)).count() == 0


def test_likeness_falls_with_edits(spark):
    words = [f"w{i:04d}" for i in range(3000)]
    make = imatch.Fingerprinter([w.encode() for w in words])
    base = make(" ".join(words[:200]))
    assert imatch.likeness(base, make(" ".join(reversed(words[:200])))) == 1
    small, half = make(" ".join(words[2:202])), make(" ".join(words[100:300]))
    far = make(" ".join(words[2000:2200]))
    assert 1 > imatch.likeness(base, small) > imatch.likeness(base, half) > imatch.likeness(base, far)


def test_copies_over_a_third_of_the_rows(spark):
    a, b = "the cat sat on the mat", "a dog ran off with one bone"
    rows = [(i, (a, b, f"single text {i}")[i % 3]) for i in range(60)] + [(60, None), (61, " - "), (62, "cat cat, the mat on sat")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert not set(imatch.lexicon(df)) & (imatch.terms(a) | imatch.terms(b))
    compare(df, rows)
    got = {r.doc_id: r for r in imatch.fingerprint_edits(df).collect()}
    assert got[0].near_next == got[1].near_next == got[59].near_next == got[61].near_next == 0
    assert got[0].near_edited == 0 and got[60].near_next == 1
    assert len({got[i].fingerprint for i in range(0, 60, 3)} | {got[62].fingerprint}) == 1
    assert len({got[i].fingerprint for i in (0, 1, 2, 5, 60)}) == 5 and got[60].fingerprint == got[61].fingerprint


def test_small_table_has_no_lexicon(spark):
    rows = [(i, f"text number {i}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert imatch.lexicon(df) == []
    assert [r.near_next for r in imatch.fingerprint_edits(df).collect()] == [0.0] * 4


def test_counts_are_packed_by_parts(spark, monkeypatch):
    counts = {b"t%d" % i: i + 1 for i in range(500)}
    got = imatch._parted(counts, 8)
    assert sorted(got["part"]) == list(range(8))
    back = {}
    for packed, n in zip(got["terms"], got["n"]):
        back.update(zip(zlib.decompress(packed).split(b" "), memoryview(zlib.decompress(n)).cast("I").tolist()))
    assert back == counts
    df = spark.createDataFrame([(f"all w{i % 7} own{i}",) for i in range(60)], "text string").repartition(5)
    want = sorted([b"all", *(b"w%d" % i for i in range(7))])
    for parts, rows in ((1, 10**6), (64, 1)):
        monkeypatch.setattr(imatch, "PARTS", parts)
        monkeypatch.setattr(imatch, "PART_ROWS", rows)
        assert imatch.lexicon(df, 2 / 60, 1.0) == want
