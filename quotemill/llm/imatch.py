"""I-Match document fingerprints (operator 1).

Terms whose inverse document frequency lies in a band form the lexicon.  A
text's distinct lexicon terms are sorted and hashed once for the whole lexicon
and once for each of several randomised subsets of it; two texts are alike by the share
of subsets that hash alike.  Subsets of several densities tell small
edits from large ones.  A text with terms but none in the lexicon (short ones, rare languages, copies that
hold more rows than the band allows, small tables) is hashed over all its distinct terms and is alike
only to texts of the same terms.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import batches, ship

#: The band: a term is kept if the share of documents that have it is in [LEAST, MOST].  Its size is at
#: most the mean number of distinct terms of a document divided by LEAST, whatever the corpus.
LEAST, MOST = 1 / 5000, 1 / 10
#: Randomised subsets: chance of a term to be in one, and how many subsets have it.
DENSITIES = ((1 / 4, 8), (1 / 16, 16), (1 / 64, 16), (1 / 256, 16), (1 / 1024, 16))
SEED = 7
#: Parts that terms are counted in, at least, and rows of the corpus for each part beyond.
PARTS, PART_ROWS = 64, 10_000
EMPTY = "----"

# ASCII other than letters and digits parts terms; A-Z are lower-cased.  Other bytes are kept.
_TERMS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms(text: str) -> set[bytes]:
    return set(text.encode("utf-8", "surrogatepass").translate(_TERMS).split())


def _parted(counts: Counter, parts: int) -> pd.DataFrame:
    """One row for each part of the terms, which lie sorted and compressed in it, with their counts in that order."""
    held: dict[int, list[bytes]] = {}
    for term in sorted(counts):
        held.setdefault(zlib.crc32(term) % parts, []).append(term)
    return pd.DataFrame({"part": list(held), "terms": [zlib.compress(b" ".join(t), 1) for t in held.values()],
                         "n": [zlib.compress(np.array([counts[w] for w in t], "<u4").tobytes(), 1) for t in held.values()]})


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> list[bytes]:
    """Sorted terms whose document frequency, over all rows, lies in the band.

    Terms are dealt to parts by their hash; their number grows with the rows, so that a part stays small.
    """
    ship(docs.sparkSession)
    total = docs.count()
    parts = max(PARTS, total // PART_ROWS)

    def document_counts(frames):
        counts = Counter()
        for frame in frames:
            for text in frame["text"]:
                if text:
                    counts.update(terms(text))
                if len(counts) > 1_000_000:
                    yield _parted(counts, parts)
                    counts = Counter()
        yield _parted(counts, parts)

    def in_band(group: pd.DataFrame) -> pd.DataFrame:
        counts = Counter()
        for packed, n in zip(group["terms"], group["n"]):
            own = np.frombuffer(zlib.decompress(n), "<u4").tolist()
            for term, k in zip(zlib.decompress(packed).split(b" "), own):
                counts[term] += k
        return pd.DataFrame({"term": [w for w, n in counts.items() if least * total <= n <= most * total]}, dtype=object)

    band = docs.select("text").mapInPandas(document_counts, "part int, terms binary, n binary").groupBy(
        "part").applyInPandas(in_band, "term binary")
    return sorted(bytes(r.term) for r in band.toLocalIterator())


class Fingerprinter:
    """Fingerprints of texts by one lexicon."""

    def __init__(self, words: list[bytes], densities=DENSITIES, seed: int = SEED):
        self.index = {w: i for i, w in enumerate(words)}
        self.words = np.array(words, object)
        chances = [p for p, n in densities for _ in range(n)]
        draws = np.empty((len(words), len(chances)), np.uint32)
        size = 4 * len(chances)
        for i, w in enumerate(words):
            seeded = hashlib.shake_128(seed.to_bytes(8, "little") + w).digest(size)
            draws[i] = np.frombuffer(seeded, np.uint32)
        self.member = draws < (np.array(chances) * 2**32).astype(np.uint32)

    def __call__(self, text: str | None) -> str:
        """Hashes in hex: 16 digits over all lexicon terms, 4 for each subset, ``----`` for one without terms.

        Without lexicon terms the 16 digits are over all distinct terms, a hash of its own kind, and the
        subsets have none; ``----`` throughout is a text without any term.
        """
        got = self.index
        own = terms(text or "")
        ids = sorted({got[t] for t in own if t in got})
        if not ids:
            empty = EMPTY * self.member.shape[1]
            if not own:
                return 4 * EMPTY + empty
            return hashlib.blake2b(b" ".join(sorted(own)), digest_size=8, person=b"all terms").hexdigest() + empty
        words, member = self.words[ids], self.member[ids]
        out = [hashlib.blake2b(b" ".join(words), digest_size=8).hexdigest()]
        subsets = [EMPTY] * member.shape[1]
        for j in np.flatnonzero(member.any(axis=0)).tolist():
            subsets[j] = hashlib.blake2b(b" ".join(words[member[:, j]]), digest_size=2).hexdigest()
        return "".join(out + subsets)


def likeness(a: str, b: str) -> float:
    """Share of subsets that hash alike, of those in which either text has terms; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    pairs = [(a[i:i + 4], b[i:i + 4]) for i in range(16, len(a), 4)]
    used = [x == y for x, y in pairs if x != EMPTY or y != EMPTY]
    return sum(used) / len(used) if used else 0.0


def _dealt(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows by ranges of doc_id, with the first row of the following range added to each.

    Adds ``part``, ``extra`` (an added row) and ``h``.  Bounds are quantiles of the ids and
    one first row a range, so what the driver holds is as long as the number of
    ranges.  The last range is followed by the first.
    """
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-2**63)).alias("k"),
                       F.xxhash64("text").alias("h"))
    share = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("k", share, 10 * ranges)).first()[0] if share else []
    bounds = np.unique(np.array(bounds or [], np.int64))

    @F.pandas_udf("int")
    def part_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), "right").astype(np.int32))

    firsts = rows.select("k", "h").withColumn("part", part_of("k")).groupBy("part").agg(
        F.min(F.struct("k", "h")).alias("m")).collect()
    firsts = sorted((r.part, r.m.k, r.m.h) for r in firsts)
    goes_to = {(k, h): firsts[i - 1][0] for i, (_, k, h) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def parts(k: pd.Series, h: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, k.to_numpy(), "right").tolist()
        return pd.Series([[p, goes_to[x]] if (x := (a, b)) in goes_to else [p]
                          for p, a, b in zip(own, k.tolist(), h.tolist())])

    return rows.select("doc_id", "text", "k", "h", F.posexplode(parts("k", "h")).alias("extra", "part"))


def fingerprint_edits(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last floor(n/2) code points replaced by the first as
    many (or all) of the next document in order of doc_id; the last is followed by
    the first.  Null ids come before all others, rows of one id follow in order of a hash
    of their text.  A null text counts as empty.  A text without lexicon terms
    has the hash of all its distinct terms and is alike (1) only to texts of the same terms, else 0; only texts
    without any term share the fixed ``----``.  One row out per row in; an empty table gives none.

    One shuffle of the texts by ranges of doc_id puts neighbours together; each range
    also gets the first row of the next.
    """
    spark = docs.sparkSession
    ship(spark)
    ranges = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    shared = spark.sparkContext.broadcast(Fingerprinter(lexicon(docs, least, most)))
    dealt = _dealt(docs, ranges).repartition("part").sortWithinPartitions("part", "extra", "k", "h")

    def run(frames):
        make = shared.value
        held = None  # (part, id or None, text, fingerprint)

        def row(now, after):
            text, other = now[2], after[2]
            cut = len(text) // 2
            edited = text[:len(text) - cut] + other[:cut]
            print_ = now[3] if edited == text else make(edited)
            return (now[1], len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), now[3],
                    print_, likeness(now[3], print_), likeness(now[3], after[3]))

        for frame in batches(frames, 4_000_000):
            out = []
            ids = [None if k == -2**63 else k for k in frame["k"].tolist()]
            for part, extra, i, text in zip(frame["part"].tolist(), frame["extra"].tolist(), ids, frame["text"]):
                if held is not None and held[0] == part and extra and held[4]:
                    continue  # a repeat of the added row
                now = (part, i, text or "", make(text), extra)
                if held is not None and held[0] == part:
                    out.append(row(held, now))
                held = now
            cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            result = pd.DataFrame(out, columns=cols)
            result["doc_id"] = pd.array(result["doc_id"], "Int64")
            yield result

    return dealt.select("part", "extra", "k", "text").mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
