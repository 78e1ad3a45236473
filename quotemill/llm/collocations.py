"""Phrase collocation mining by dynamic itemset counting (operator 13).

The corpus is cut into shards that are scanned in a cycle.  Words are counted from the first scan on.  As soon
as a check after a scan finds that both subphrases of a longer phrase (without its last, without its first word) have
reached the threshold, the phrase becomes active: it is counted from the next scan on, together with phrases of other lengths, until it
has seen every shard once.  Scans go on until every phrase has completed its cycle.  Counts are exact for every
phrase that reaches the threshold, because its subphrases reach it too.

What a task must know about subphrases is the scan in which they reached the threshold.  It gets a table of one
byte for each of SLOTS hash values: the first scan after which any phrase of that hash had reached it.  An entry
is never changed once set, so a phrase's first scan follows from the tables alone and is the same whenever it is
asked.  Phrases that share a slot or a key of KEY_BITS make others active that never reach the threshold, which costs
work and changes no count: a slot is set if any of its phrases reached the threshold, no phrase begins before its
subphrases have begun, whatever set their slots, and what is returned is counted by text.

The corpus is cut into words once: a shard holds batches, each with its distinct words and the places of each in
the texts as numbers.  Most phrases never reach the threshold.  A scan writes the counts of each batch twice: as
sorted keys, of which a check after the scan sums some three bytes a phrase, and by words, of which only phrases
of set slots are ever spelled out and shuffled.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import ship, staged
from quotemill.session import scratch_path

SHARDS = 4
LONGEST, LEAST, TOP = 3, 10, 2000
#: A candidate goes if a longer one that holds it has so many of a hundred of its occurrences.
SUBSUMED = 50
#: Bytes of one length's table of first scans.  The size is fixed; a fuller table lets more phrases be counted.
SLOTS = 1 << 23
UNSET = 255
#: Bits of a phrase's key, and keys that a check sums in one group on average.
KEY_BITS, GROUP = 40, 1_000_000
#: Scans from one check to the next: a check reads all scans of phrases that have not completed their cycle.
EVERY = 2
#: Phrases of different batches that a task sums before it shuffles them.
TOGETHER = 1_000_000
#: Bytes of text that a task works on at once; one longer text is worked on alone.
BATCH = 4_000_000

#: ``.,;:!?`` and the line ends 10-13 part pieces, marked by a byte that UTF-8 never has.
_BREAK = b"\xff"
_NORMAL = bytes(255 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)).replace(
    bytes(range(65, 91)), bytes(range(97, 123)))


def _mixed(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last."""
    x = (left * np.uint64(0x9E3779B97F4A7C15)) ^ word
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False)


def _keys(hashes: np.ndarray, lang: bytes) -> np.ndarray:
    return (_mixed(hashes, _word_hashes([lang])) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def _words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Codes of the words of the texts one after the other, -1 where a piece ends, and the word of each code."""
    marked = _BREAK.join(texts).translate(_NORMAL).replace(_BREAK, b" \xff ")
    codes, words = pd.factorize(np.array([_BREAK] + marked.split(), object))
    return codes - 1, list(words[1:])


def _groups(codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the phrase of each row of word codes, and one row of each phrase."""
    key = codes[:, 0].astype(np.int64)
    for i in range(1, codes.shape[1]):
        if i > 1:
            key = pd.factorize(key)[0].astype(np.int64)
        key = key * words + codes[:, i]
    own = pd.factorize(key)[0]
    one = np.empty(own.max() + 1, np.int64)
    one[own] = np.arange(len(own))
    return own, one


def _counted(codes: np.ndarray, words: list[bytes], lang: bytes, scan: int, shards: int, longest: int,
             firsts: list[np.ndarray]):
    """``(first scan, word codes, keys, counts)`` of all that is active in this scan, a row of codes for each phrase.

    ``firsts[k]`` has for each slot the scan after which a phrase of k + 1 words had reached the threshold.
    """
    place = np.flatnonzero(codes >= 0)
    hash_of = _word_hashes(words)
    if scan < shards:
        yield 0, np.arange(len(words))[:, None], _keys(hash_of, lang), np.bincount(codes[place], minlength=len(words))
    hashes, starts = hash_of[codes[place]], np.zeros(len(place), np.int64)
    for n in range(2, longest + 1):
        # Occurrences of n - 1 words that reached the threshold; two that start one place apart make one of n words.
        # Another phrase may have set a slot before its own phrase's first scan; none reaches before that scan.
        table = firsts[n - 2]
        reached = table[_keys(hashes, lang) % len(table)]
        live = reached != UNSET
        place, hashes, reached = place[live], hashes[live], np.maximum(reached[live], starts[live])
        left = np.flatnonzero(np.diff(place) == 1)
        starts = np.maximum(reached[left], reached[left + 1]) + 1
        place = place[left]
        hashes = _mixed(hashes[left], hash_of[codes[place + n - 1]])
        active = (starts <= scan) & (scan < starts + shards)
        for first in np.unique(starts[active]).tolist():
            here = np.flatnonzero(starts == first)
            phrases = codes[place[here][:, None] + np.arange(n)]
            own, one = _groups(phrases, len(words))
            yield first, phrases[one], _keys(hashes[here[one]], lang), np.bincount(own)


def _last_scan(firsts: list[np.ndarray], shards: int) -> int:
    """The scan in which the last phrase that the tables let begin completes its cycle."""
    start = 0
    for table in firsts[:-1]:
        scans = table[table != UNSET]
        if not len(scans):
            break
        start = max(start, int(scans.max())) + 1
    return start + shards - 1


def _packed(numbers: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(numbers).tobytes(), 1)


def _key_blobs(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences, byte by byte of their places, and the counts in their order."""
    order = np.argsort(keys)
    steps = np.diff(keys[order], prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8)
    return _packed(steps.T), _packed(counts[order].astype("<u4"))


def _read_keys(blob: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<i8").ravel())


def _read_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[starts], np.add.reduceat(count, starts) if len(starts) else count


def _by_lang(batches, size: int = BATCH):
    """``(lang, texts)`` of about ``size`` bytes each; a longer text comes alone."""
    for batch in batches:
        held: dict[bytes, list[bytes]] = {}
        sizes: dict[bytes, int] = {}
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, text = lang.as_py(), text.as_py()
            if held.get(lang) and sizes[lang] + len(text) > size:
                yield lang, held.pop(lang)
            if lang not in held:
                held[lang], sizes[lang] = [], 0
            held[lang].append(text)
            sizes[lang] += len(text)
        yield from held.items()


def _cut(docs: DataFrame) -> DataFrame:
    """Batches of ``lang, text`` rows as distinct words and, place by place, their numbers."""
    def run(batches):
        for lang, texts in _by_lang(batches):
            codes, words = _words(texts)
            if words:
                row = (lang, _spelled(words), _packed(codes.astype("<i4")))
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], ["lang", "words", "codes"])

    return docs.mapInArrow(run, "lang binary, words binary, codes binary")


def _spelled(words: list[bytes]) -> bytes:
    return zlib.compress(b"\n".join(words), 1)


def _read_words(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split(b"\n")


def _read_codes(blob: bytes, n: int = 1) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), "<i4").reshape(n, -1).T


def _only_used(words: list[bytes], phrases: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words that the phrases have, and the phrases in numbers of these."""
    used = np.flatnonzero(np.bincount(phrases.ravel(), minlength=len(words)))
    number = np.zeros(len(words), np.int64)
    number[used] = np.arange(len(used))
    return [words[i] for i in used], number[phrases]


def _scan(corpus: DataFrame, scan: int, shards: int, longest: int, firsts: list[np.ndarray]) -> DataFrame:
    """Counts of all active phrases in one shard, summed inside each batch and written.

    The tables travel compressed and are given up when the counts are written.
    """
    shared = corpus.sparkSession.sparkContext.broadcast([_packed(t) for t in firsts])

    def run(batches):
        tables = [np.frombuffer(zlib.decompress(t), np.uint8) for t in shared.value]
        for batch in batches:
            for lang, blob, places in zip(*(c.to_pylist() for c in batch.columns)):
                words = _read_words(blob)
                for first, phrases, keys, counts in _counted(_read_codes(places)[:, 0], words, lang, scan, shards, longest,
                                                             tables):
                    own, phrases = _only_used(words, phrases)
                    order = np.argsort(phrases[:, 0], kind="stable")
                    row = (lang, phrases.shape[1], first, len(phrases), int(counts.sum()), *_key_blobs(keys, counts),
                           _spelled(own), _packed(phrases[order].T.astype("<i4")), _packed(counts[order].astype("<u4")))
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _KINDS)], _COLUMNS)

    out = staged(corpus.mapInArrow(run, "lang binary, n int, first int, many long, total long, keys binary, sums binary, "
                                        "words binary, phrases binary, counts binary"), "collocation-scan")
    shared.destroy()
    return out


_KINDS = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 5
_COLUMNS = ["lang", "n", "first", "many", "total", "keys", "sums", "words", "phrases", "counts"]


def _reached(rows: DataFrame, least: int, slots: int) -> np.ndarray:
    """Slots of the keys whose counts, summed over the rows ``many, keys, sums``, reach the threshold.

    Keys are dealt to groups by their value, as many as keep a group near GROUP keys.  The driver gets bits,
    ``slots / 64`` numbers at most.
    """
    many = rows.agg(F.sum("many")).first()[0] or 0
    bits = max(3, (many // GROUP).bit_length())

    def dealt_out(blobs, sums):
        """One row a group of the keys of some batches, summed; the check needs no count beyond what 32 bits hold."""
        keys, counts = _summed([_read_keys(b) for b in blobs], [_read_counts(b) for b in sums])
        counts = np.minimum(counts, 2**32 - 1)
        group = keys >> (KEY_BITS - bits)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(keys)]
        out = [(int(group[a]), *_key_blobs(keys[a:b], counts[a:b])) for a, b in zip(cuts, cuts[1:]) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            list(zip(*out)) or [[]] * 3, (pa.int32(), pa.binary(), pa.binary()))], ["part", "keys", "sums"])

    def deal(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + row[0] > TOGETHER:
                    yield dealt_out(*list(zip(*held))[1:])
                    held, size = [], 0
                held.append(row)
                size += row[0]
        if held:
            yield dealt_out(*list(zip(*held))[1:])

    def total(group: pa.Table) -> pa.Table:
        keys, counts = _summed(*([read(b) for b in group[c].to_pylist()] for c, read in (
            ("keys", _read_keys), ("sums", _read_counts))))
        slot = keys[counts >= least] % slots
        at, own = np.unique(slot >> 6, return_inverse=True)
        word = np.zeros(len(at), np.uint64)
        np.bitwise_or.at(word, own, np.uint64(1) << (slot & 63).astype(np.uint64))
        return pa.table({"at": pa.array(at, pa.int64()), "bits": pa.array(word.view(np.int64), pa.int64())})

    dealt = rows.select("many", "keys", "sums").mapInArrow(deal, "part int, keys binary, sums binary")
    got = dealt.groupBy("part").applyInArrow(total, "at long, bits long").groupBy("at").agg(
        F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(slots // 64, np.uint64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def _by_text(rows: DataFrame, firsts: list[np.ndarray]) -> DataFrame:
    """``lang, n, phrase, c`` of the phrases whose slot is set, summed over about TOGETHER phrases of a task."""
    shared = rows.sparkSession.sparkContext.broadcast([_packed(t) for t in firsts])

    def summed(lang, n, parts):
        codes, words = pd.factorize(np.array([w for own, _, _ in parts for w in own], object))
        starts = np.cumsum([0] + [len(own) for own, _, _ in parts])
        phrases = np.concatenate([codes[start + p] for start, (_, p, _) in zip(starts, parts)])
        own, one = _groups(phrases, len(words))
        counts = np.zeros(len(one), np.int64)
        np.add.at(counts, own, np.concatenate([c for _, _, c in parts]))
        text = words[phrases[one, 0]]
        for i in range(1, n):
            text = text + b" " + words[phrases[one, i]]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(one), pa.binary()), pa.array([n] * len(one), pa.int32()),
             pa.array(text, pa.binary()), pa.array(counts, pa.int64())], ["lang", "n", "phrase", "c"])

    def run(batches):
        tables = [np.frombuffer(zlib.decompress(t), np.uint8) for t in shared.value]
        held: dict[tuple[bytes, int], list] = {}
        for batch in batches:
            for lang, n, blob, codes, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words, phrases = _read_words(blob), _read_codes(codes, n)
                hashes = _word_hashes(words)[phrases]
                h = hashes[:, 0]
                for i in range(1, n):
                    h = _mixed(h, hashes[:, i])
                table = tables[n - 1]
                kept = np.flatnonzero(table[_keys(h, lang) % len(table)] != UNSET)
                if len(kept):
                    parts = held.setdefault((lang, n), [])
                    parts.append((*_only_used(words, phrases[kept]), _read_counts(counts)[kept]))
                    if sum(len(c) for _, _, c in parts) > TOGETHER:
                        yield summed(lang, n, held.pop((lang, n)))
        for (lang, n), parts in held.items():
            yield summed(lang, n, parts)

    return rows.select("lang", "n", "words", "phrases", "counts").mapInArrow(
        run, "lang binary, n int, phrase binary, c long")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, shards: int = SHARDS,
                  slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Exact counts over all ``lang, text`` rows.

    Returns ``lang, n, phrase, f`` of every phrase of 1 to ``longest`` words with f >= ``least``, and
    ``lang, total``, the words of each language.  Phrases and languages are UTF-8 bytes.
    """
    spark = docs.sparkSession
    ship(spark)
    lang = F.coalesce(F.col("lang"), F.lit("und")).cast("binary")
    batches = _cut(docs.where("text is not null").select(lang.alias("lang"), F.col("text").cast("binary").alias("text")))
    path = scratch_path(spark, "collocation-shards")
    batches.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards))).write.partitionBy("shard").parquet(path)
    corpus = spark.read.schema("lang binary, words binary, codes binary, shard long").parquet(path)
    firsts = [np.full(slots, UNSET, np.uint8) for _ in range(longest)]
    scans: list[DataFrame] = []
    scan, last, checked = 0, shards - 1, -1
    while scan <= last:
        part = corpus.where(F.col("shard") == scan % shards).select("lang", "words", "codes")
        scans.append(_scan(part, scan, shards, longest, firsts[:-1]))
        if scan - checked < EVERY and scan < last:
            scan += 1
            continue
        # Phrases that had not completed their cycle at the last check.  What reached the threshold before is set already.
        since = checked - shards + 1
        for n in range(1 if since < 0 else 2, longest):
            open_ = [s.where((F.col("n") == n) & (F.col("first") > since)) for s in scans[max(0, since + 1):]]
            new = _reached(reduce(DataFrame.unionByName, open_), least, slots)
            new = new[firsts[n - 1][new] == UNSET]
            firsts[n - 1][new] = scan
        checked = scan
        last = _last_scan(firsts, shards)
        scan += 1
    every = reduce(DataFrame.unionByName, scans)
    firsts[-1][_reached(every.where(F.col("n") == longest), least, slots)] = 0
    phrases = staged(_by_text(every, firsts).groupBy("lang", "n", "phrase").agg(F.sum("c").alias("f")).where(
        F.col("f") >= least), "collocation-phrases")
    return phrases, every.where("n = 1").groupBy("lang").agg(F.sum("total").alias("total"))


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(phrases: DataFrame, subsumed: int = SUBSUMED) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer candidate subsumes."""
    p = phrases.select("lang", "n", F.col("phrase").cast("string").alias("phrase"), "f")
    words = F.split("phrase", " ", -1)
    many = p.where("n > 1").withColumn("w", words)
    cut = many.select("lang", "phrase", F.col("f").alias("a"), "w", "n", F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("left"),
                     _part(F.col("w"), F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    cut = cut.join(p.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(p.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = [F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")]
    cut = cut.withColumn("num", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")).withColumn(
        "den", wide[1] * wide[2]).withColumn("score", F.expr("num div den"))
    best = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("b"))
    spans = F.expr("flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), "
                   "i -> array_join(slice(w, i, m), ' '))))")
    inside = many.where("n > 2").select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    out = best.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < subsumed * F.col("a")))
    return out.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED,
         shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` collocations of each language.

    Only ``lang`` and ``text`` are looked at.  A null text has no words, a null language counts as ``und``;
    repeated rows count as often as they come; a language without candidates has no row, an empty table none.
    The first ``top`` of a language are taken from the first ``top`` of shares of it, so no task sorts it whole.
    """
    phrases, totals = phrase_counts(docs, longest, least, shards, slots)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    out = scored(phrases, subsumed).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    out = out.join(totals, "lang")
    return out.select(F.col("lang").cast("string").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a",
                      "l", "r", F.col("total").alias("n"), "score")
