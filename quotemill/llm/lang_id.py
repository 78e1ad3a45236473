"""Language identification with spans (operator 7).

Script ranges narrow the languages a word can be in; character trigram
likelihoods score the word in those that are left; a Viterbi path over the words,
with a penalty for changing language, labels the spans of a text.

The model is a table of hashed trigram counts by language, summed in Spark over
all training documents; its size is fixed by the number of buckets and languages.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import batches, ship

#: Trigram buckets, their additive smoothing, cost in nats of a language change between two words.
BUCKETS = 1 << 16
SMOOTH = 0.5
SWITCH = 12.0
#: A language is a candidate for a script that makes up this share of its training letters.
LEAST_SHARE = 0.01
#: Characters scored at once by one task.
BATCH_CHARS = 2_000_000
UNDETERMINED = "und"

# First code points of script blocks, in order (Unicode).
_SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "syriac"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"),
    (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = tuple(sorted({name for _, name in _SCRIPTS}))


@functools.lru_cache(1)
def _tables():
    """By code point: lower-case form, 0 where it is no letter; script."""
    points = range(0x110000)
    low = np.zeros(0x110000, np.uint32)
    for c in points:
        ch = chr(c)
        if ch.isalpha():
            lower = ch.lower()
            low[c] = ord(lower) if len(lower) == 1 else c
    script = np.zeros(0x110000, np.uint8)
    for first, name in _SCRIPTS:
        script[first:] = SCRIPTS.index(name)
    return low, script


def _letters(texts):
    """Letters of the texts on end, with their places.

    Returns code points (lower-case), trigram buckets, scripts, offset in the joined
    text, word number and the text number of each word.
    """
    low, script = _tables()
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = low[points]
    at = np.flatnonzero(letter)
    if not len(at):
        return None
    here = letter[at].astype(np.uint64)
    # Neighbours that are no letters count as 0, a word's border; the joined text ends with one.
    before = np.where(at > 0, letter[at - 1], 0).astype(np.uint64)
    after = letter[at + 1].astype(np.uint64)
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + here * np.uint64(0xC2B2AE3D27D4EB4F)
             + after * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) % BUCKETS
    starts = np.flatnonzero(before == 0)
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, at[starts], "right")
    return bucket, script[points[at]], at, starts, owner, ends


def _count(frames):
    for frame in batches(frames, BATCH_CHARS):
        out = []
        for lang, rows in frame.groupby("lang"):
            found = _letters(rows["text"].tolist())
            if found is None:
                continue
            n = np.bincount(found[0], minlength=BUCKETS)
            s = np.bincount(found[1], minlength=len(SCRIPTS))
            keys = np.concatenate([np.flatnonzero(n), -1 - np.flatnonzero(s)])
            values = np.concatenate([n[n > 0], s[s > 0]])
            out.append(pd.DataFrame({"lang": lang, "feature": keys, "n": values}))
        if out:
            yield pd.concat(out)


def train(docs: DataFrame) -> dict:
    """Model of the non-null ``text, lang`` rows: languages, candidates by script, trigram scores.

    Counts cover all rows.  What reaches the driver is at most BUCKETS + scripts
    numbers a language.  Documents without a letter teach nothing; without any
    training row the model has no language.
    """
    ship(docs.sparkSession)
    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInPandas(_count, "lang string, feature long, n long").groupBy("lang", "feature").agg(
        F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((BUCKETS, len(langs)), SMOOTH)
    scripts = np.zeros((len(SCRIPTS), len(langs)))
    for i, lang in enumerate(langs):
        mine = counts[counts["lang"] == lang]
        is_gram = (mine["feature"] >= 0).to_numpy()
        feature, n = mine["feature"].to_numpy(), mine["n"].to_numpy()
        table[feature[is_gram], i] += n[is_gram]
        scripts[-1 - feature[~is_gram], i] = n[~is_gram]
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    return {"langs": langs, "candidates": share >= LEAST_SHARE,
            "scores": np.log(table / table.sum(axis=0)).astype(np.float32)}


def _viterbi(scores: np.ndarray, first: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word; texts are runs of ``sizes`` words from ``first`` on.

    All texts advance together, one word a step; the longest come first, so those
    still running are a prefix.
    """
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
    path = np.zeros(len(scores), np.int16)
    moved = np.zeros(scores.shape, bool)  # came from the best other language
    best = np.zeros(len(scores), np.int16)
    state = scores[first].astype(np.float64)
    for t in range(1, sizes[0]):
        n = running[t]
        state = state[:n]
        top = state.argmax(axis=1)
        jump = state[np.arange(n), top] - switch
        rows = first[:n] + t
        move = state < jump[:, None]
        best[rows], moved[rows] = top, move
        state = np.where(move, jump[:, None], state) + scores[rows]
        ended = running[t + 1] if t + 1 < sizes[0] else 0
        path[rows[ended:]] = state[ended:].argmax(axis=1)
    ones = sizes == 1
    path[first[ones]] = scores[first[ones]].argmax(axis=1)
    for t in range(sizes[0] - 1, 0, -1):
        rows = first[:running[t]] + t
        now = path[rows]
        path[rows - 1] = np.where(moved[rows, now], best[rows], now)
    return path


def label(texts, model: dict, switch: float = SWITCH):
    """For each text (no nulls): language, score, spans ``(start, end, lang)`` of its letters."""
    langs = model["langs"]
    out = [(UNDETERMINED, 0.0, [])] * len(texts)
    pieces, start, held = [], 0, 0
    for i, t in enumerate([*texts, None]):
        if t is None or held and held + len(t) > BATCH_CHARS:
            pieces.append((start, i))
            start, held = i, 0
        held += len(t or "")
    found = []
    for lo, hi in pieces:
        got = _letters(texts[lo:hi]) if hi > lo and langs else None
        if got is None:
            continue
        bucket, script, at, starts, owner, ends = got
        word = np.add.reduceat(model["scores"][bucket], starts, axis=0)
        allowed = model["candidates"][script[starts]]
        narrow = allowed.any(axis=1)
        word[narrow] = np.where(allowed[narrow], word[narrow], -1e6)
        size = np.diff(np.append(starts, len(at)))
        begin = at[starts] - np.concatenate([[0], ends[:-1]])[owner]
        found.append((word, owner + lo, size, begin, begin + size))
    if not found:
        return out
    word, owner, size, begin, end = (np.concatenate(x) for x in zip(*found))
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.diff(np.append(first, len(owner)))
    path = _viterbi(word, first, count, switch)
    letters = np.zeros((len(first), len(langs)))
    np.add.at(letters, (np.repeat(np.arange(len(first)), count), path), size)
    total = np.add.reduceat(word.astype(np.float64), first, axis=0)
    pick = letters.argmax(axis=1)
    even = np.exp(total - total.max(axis=1, keepdims=True))
    sure = even[np.arange(len(first)), pick] / even.sum(axis=1)
    share = letters[np.arange(len(first)), pick] / letters.sum(axis=1)
    change = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    last = np.append(change[1:], len(path)) - 1
    which = np.searchsorted(first, change, "right") - 1
    spans = [[] for _ in first]
    for k, a, b, p in zip(which.tolist(), begin[change].tolist(), end[last].tolist(), path[change].tolist()):
        spans[k].append((a, b, langs[p]))
    for k, i in enumerate(owner[first].tolist()):
        # In a text of several languages the evidence for the leading one alone says little.
        score = share[k] * (sure[k] if share[k] == 1 else 1.0)
        out[i] = (langs[pick[k]], float(min(1.0, max(0.0, score))), spans[k])
    return out


def predict(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), switch: float = SWITCH) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred, score, spans``.

    ``spans`` are ``(start, end, lang)`` in code points, by language runs of the
    path.  ``lang_pred`` has the most letters (ties: first in order of name), ``und`` with
    score 0 for a null text, one without letters, and when nothing was learned.
    ``score`` is the share of letters in that language; where it is all, times
    the posterior of the language.  Words in a script of no learned language
    keep all languages as candidates.  One row out per row in.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(frames):
        for frame in batches(frames, 4 * BATCH_CHARS, "_text"):
            got = label(frame["_text"].fillna("").tolist(), shared.value, switch)
            out = frame[list(keep)].copy()
            out["lang_pred"], out["score"] = [g[0] for g in got], [g[1] for g in got]
            out["spans"] = [[{"start": a, "end": b, "lang": c} for a, b, c in g[2]] for g in got]
            yield out

    return docs.select(*keep, F.col("text").alias("_text")).mapInPandas(
        run, f"{fields}, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def determined(docs: DataFrame, model: dict) -> DataFrame:
    """The rows whose language ``predict`` can tell, as they are; without a learned language those with a letter.

    Columns pass through untouched, whatever their names; texts are looked at some millions of characters at a time.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def known(texts: list[str]) -> list[bool]:
        if shared.value["langs"]:
            return [g[0] != UNDETERMINED for g in label(texts, shared.value)]
        found = _letters(texts)
        owners = set() if found is None else set(found[4].tolist())
        return [i in owners for i in range(len(texts))]

    def run(batches_):
        for batch in batches_:
            stay, texts, held = [], [], 0
            for text in batch.column(at):
                text = text.as_py() or ""
                if texts and held + len(text) > BATCH_CHARS:
                    stay += known(texts)
                    texts, held = [], 0
                texts.append(text)
                held += len(text)
            if texts:
                stay += known(texts)
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def remainder(ids, modulus: int):
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit(""))) % modulus
