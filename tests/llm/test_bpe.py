"""Operator 4 against the tokenizers library on whole texts."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

from quotemill.llm import bpe, queries
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(text):
    t = Tokenizer.from_file(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    out = t.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, SF_SMALL).collect()}
    assert got == {r.doc_id: plain(r.text) for r in docs}


ODD = ["", None, "a", " \n ", "<|endoftext|> x<|startoftext|>y <|endof text|>", "I'll we'VE don't 's", "é ́ Å", "x　y z\x1cq\x85",
       "\U0001f600 \U0001f468‍\U0001f469 naïve", "a\x00b", "z" * 5000, "İstanbul ẞ", "1234567890 " * 300]


def test_edge_rows_and_shared_chunks(spark):
    passage = " ".join(f"word{i % 97}x{i % 13}" for i in range(1500))
    texts = ODD + [passage, passage, "lead " + passage + "\ntail", passage + ODD[4], passage * 3]
    rows = [(i if i else None, t, 1, "x") for i, t in enumerate(texts)] + [(3, "a", 0, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(4)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(df, PATH).collect()), key=str)
    assert got == sorted(((i, *plain(t)) for i, t, _, _ in rows), key=str)
    full = {r.doc_id: r for r in bpe.encode(df.where("doc_id > 12"), PATH, result="tokens").collect()}
    t = Tokenizer.from_file(PATH)
    for i, r in full.items():
        assert r.ids == t.encode(texts[i], add_special_tokens=False).ids
        assert r.decoded == t.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_chunks_are_content_defined():
    body = " ".join(f"t{i * 7919 % 100003}" for i in range(4000))
    a, b = bpe.chunks(["intro words " + body, body + " end"])
    assert "".join(a) == "intro words " + body and len(a) > 5
    assert len(set(a) & set(b)) >= len(a) - 2


def test_join_repair_widens_and_merges():
    codec = bpe.Codec(bpe.definition(PATH))
    assert codec.joined(["one two", " three", " four"]) == ["one two", " three", " four"]
    assert codec.joined(["one tw", "o three", " four"]) == ["one two three", " four"]
    assert codec.joined([]) == []
