"""Removal of repeated byte strings (operator 8).

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes.

Work is dealt out by anchors: of the 64-byte pieces inside a window of ``length`` bytes the
one of least hash is the window's anchor, so equal windows have the same anchor at
the same place.  Neighbouring windows with one anchor form a segment, and only segments of
the same anchor can hold equal windows.  Equal segments are found by digest and
need no look inside.  Different segments of one anchor are trimmed to what they can have in common
with another; those that differ still are compared by column-wise
construction of the Burrows-Wheeler transform of the collection: each round inserts one symbol
of every string, from the last to the first, into the transform, and compares each
new suffix with its neighbours, so that the round's common prefixes of ``length`` bytes are
known.  Collections are batches of a bounded number of strings of bounded length, held by
one task; what passes between steps lies in written tables.  An anchor with very many
different segments is settled by counting hashes of its windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import batches, bloom_filter, in_partitions, ship, staged

#: Bytes of a repeated string, of an anchor.
LENGTH, ANCHOR = 400, 64
#: Strings of one collection.
COLLECTION = 256
#: An anchor with more different segments than the first is settled by counting window hashes inside its task (at most
#: 50 MB of them), with more than the second by a grouped count in Spark.
LARGE, LARGEST = 1024, 16_384
BATCH_CHARS = 2_000_000

_END = 255  # never a byte of UTF-8
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _A)


def _hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on that has as many."""
    if len(raw) < width:
        return np.zeros(0, np.uint64)
    h, have, power = _BYTE[raw], 1, int(_A)
    out, done, at = None, 0, 1
    while True:
        if width & at:
            n = len(raw) - done - have + 1
            if out is None:
                out = h.copy()
            else:
                out = out[:n] * np.uint64(pow(int(_A), have, 2**64)) + h[done:done + n]
            done += have
        at *= 2
        if at > width:
            break
        h = h[:-have] * np.uint64(power) + h[have:]
        have, power = 2 * have, power * power % 2**64
    return _mix(out[:len(raw) - width + 1])


def _anchors(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the least (leftmost) of each ``window`` neighbouring values."""
    n = len(h)
    # Value above, place below, in blocks: the least of a window is that of a block's end and the next one's start.
    blocks = -(-n // window)
    key = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    place = np.arange(n, dtype=np.uint64)
    key[:n] = (h >> np.uint64(24) << np.uint64(24)) | (place & np.uint64(0xFFFFFF))
    grid = key.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - window + 1], ahead[window - 1:n])
    low = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    # Texts beyond 2^24 bytes: the place is known but for its upper part.
    start = np.arange(n - window + 1)
    return start + ((low - start) & 0xFFFFFF)


def segments(raw: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Runs of windows with one anchor: first window, number of windows, place of the anchor, its hash."""
    h = _hashes(raw, anchor)
    if len(raw) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    at = _anchors(h, length - anchor + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(np.append(first, len(at)))
    return first, count, at[first], h[at[first]].view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _digest(data: bytes, before: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=before.to_bytes(4, "little")).digest(), "little", signed=True)


def repeated_windows(strings: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Which starts in each string have the next ``length`` bytes in common with another start.

    The transform of the whole collection is built one symbol a string and round.  In a
    round the new suffix of a string is its symbol before the suffix of the last round, so its
    rank is that symbol's rank in the transform; suffixes of earlier rounds keep their order.
    """
    n = len(strings)
    size = np.array([len(s) for s in strings])
    widest = int(size.max())
    text = np.full((n, widest + 1), _END, np.uint8)
    window = np.zeros((n, widest + 1), np.uint64)
    for i, s in enumerate(strings):
        text[i, 1:len(s) + 1] = np.frombuffer(s, np.uint8)
        h = _hashes(text[i, 1:len(s) + 1], length)
        window[i, :len(h)] = h | np.uint64(1)
    found = np.zeros((n, widest + 1), bool)
    # Round 0: the empty suffixes, in order of the strings.
    bwt = text[np.arange(n), size]
    kind = np.int32 if n * (widest + 1) + len(text) < 2**31 else np.int64
    named = (np.arange(n) * (widest + 1) + size).astype(kind)
    numbers = np.arange(n * (widest + 1), dtype=kind)
    at, live = np.arange(n), np.arange(n)
    flat_window, flat_found = window.ravel(), found.ravel()
    for r in range(1, widest + 1):
        on = size[live] >= r
        if not on.all():
            live, at = live[on], at[on]
        rank = np.empty(len(bwt), kind)
        rank[np.argsort(bwt, kind="stable")] = numbers[:len(bwt)]
        at = n + rank[at].astype(np.int64)
        start = size[live] - r
        keep = np.ones(len(bwt) + len(live), bool)
        keep[at] = False
        grown = np.empty(len(keep), bwt.dtype)
        grown[keep], grown[at] = bwt, text[live, start]
        bwt = grown
        grown = np.empty(len(keep), kind)
        grown[keep], grown[at] = named, live * (widest + 1) + start
        named = grown
        if r >= length:
            me = named[at]
            own = flat_window[me]
            for side in (-1, 1):
                near = named[np.clip(at + side, 0, len(named) - 1)]
                same = (flat_window[near] == own) & (own != 0) & (near != me)
                flat_found[near[same]] = flat_found[me[same]] = True
    return found


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def _reach(parts: list[bytes]) -> list[int]:
    """Longest prefix that each has in common with any other."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    near = [_common(parts[a], parts[b]) for a, b in zip(order, order[1:])]
    out = [0] * len(parts)
    for k, i in enumerate(order):
        out[i] = max(near[k - 1] if k else 0, near[k] if k < len(near) else 0)
    return out


def trimmed(group: list[tuple[bytes, int]], length: int) -> list[tuple[int, int]]:
    """Bounds of what a segment (bytes, place of the anchor) can have in common with others of its group.

    Both ways from the anchor, no further than its longest match on that side.  Too
    short for a window: (0, 0).
    """
    ahead = _reach([s[p:] for s, p in group])
    back = _reach([s[:p][::-1] for s, p in group])
    return [(p - b, p + a) if a + b >= length else (0, 0) for (_, p), a, b in zip(group, ahead, back)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


_FOUND = "anchor long, digest long, first int, last int"


def _compare(frames, length: int):
    """Segments, sorted by anchor, -> runs of repeated windows, by collections of whole groups."""
    waiting: list = []  # (anchor, digest, string, offset)
    name, group = None, []

    sure: list = []

    def close():
        """Settle what is equal after trimming; the rest of the group waits for a collection."""
        if len(group) < 2:
            return
        same: dict = {}
        for (d, s, p), (a, b) in zip(group, trimmed([(s, p) for _, s, p in group], length)):
            if b > a:
                same.setdefault(s[a:b], []).append((d, a))
        for s, members in same.items():
            if len(members) > 1:
                sure.extend((name, d, a, a + len(s) - length) for d, a in members)
        if len(same) < 2:
            return
        if len(same) > LARGE:
            hashes = [_hashes(np.frombuffer(s, np.uint8), length) for s in same]
            values, count = np.unique(np.concatenate(hashes), return_counts=True)
            again = values[count > 1]
            for h, members in zip(hashes, same.values()):
                if len(members) == 1:
                    sure.extend((name, d, x + a, y + a) for d, a in members for x, y in _runs(np.isin(h, again)))
            return
        waiting.extend((name, members[0][0], s, members[0][1]) for s, members in same.items())

    def flush():
        rows = list(sure)
        sure.clear()
        if waiting:
            found = repeated_windows([w[2] for w in waiting], length)
            for (a, d, s, offset), flags in zip(waiting, found):
                rows += [(a, d, x + offset, y + offset) for x, y in _runs(flags[:len(s)])]
            waiting.clear()
        return pd.DataFrame(rows, columns=["anchor", "digest", "first", "last"])

    for frame in frames:
        for a, d, s, p in zip(frame["anchor"].tolist(), frame["digest"].tolist(), frame["data"], frame["place"].tolist()):
            if a != name:
                close()
                name, group = a, []
                if len(waiting) >= COLLECTION or len(sure) > 100_000:
                    yield flush()
            group.append((d, bytes(s), p))
    close()
    yield flush()


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, largest: int = LARGEST,
                   as_text: bool = False) -> DataFrame:
    """All columns of every row with ``_n_bytes, _n_removed, _n_spans, _kept`` (the bytes left).

    With ``as_text`` what is left is a string instead: of a character cut in two the rest goes too.

    Texts are UTF-8 bytes, null ones empty.  A string that starts twice counts wherever it
    does: in two rows, equal ones included, or twice in one text, overlaps too.  Matches never cross
    rows.  One row out per row in; null ids are ids like others.  An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))

    def cut(frames):
        for frame in batches(frames, BATCH_CHARS):
            out = []
            for i, (h, text) in enumerate(zip(frame["h"].tolist(), frame["text"])):
                data = _bytes(text)
                first, count, at, name = segments(np.frombuffer(data, np.uint8), length, anchor)
                for f, c, p, a in zip(first.tolist(), count.tolist(), at.tolist(), name.tolist()):
                    out.append((i, h, a, _digest(data[f:f + c + length - 1], p - f), f, c))
            rows = pd.DataFrame(out, columns=["i", "h", "anchor", "digest", "at", "windows"])
            rows.insert(0, "doc_id", pd.array(frame["doc_id"], "Int64")[rows.pop("i").astype(int)])
            yield rows

    rows = staged(in_partitions(keyed).mapInPandas(
        cut, "doc_id long, h long, anchor long, digest long, at int, windows int"), "repeat-segments")
    kinds = staged(rows.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.any_value("windows").alias("windows")), "repeat-kinds")
    whole = kinds.where("n > 1").select("anchor", "digest", F.lit(0).alias("first"), (F.col("windows") - 1).alias("last"))
    mixed = staged(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "repeat-mixed")

    def places(bits):
        return [F.pmod(F.col("anchor"), F.lit(bits)), F.pmod(F.shiftright("anchor", 32), F.lit(bits))]

    known = spark.sparkContext.broadcast(bloom_filter(mixed, places))

    def fetch(frames):
        words, bits = known.value
        for frame in batches(frames, BATCH_CHARS):
            out = {}
            for text in frame["text"]:
                data = _bytes(text)
                first, count, at, name = segments(np.frombuffer(data, np.uint8), length, anchor)
                hit = np.ones(len(name), bool)
                for place in (name % bits, (name >> 32) % bits):
                    hit &= (words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1
                for k in np.flatnonzero(hit).tolist():
                    f, p = int(first[k]), int(at[k])
                    part = data[f:f + int(count[k]) + length - 1]
                    out[int(name[k]), _digest(part, p - f)] = (part, p - f)
            yield pd.DataFrame([(a, d, part, p) for (a, d), (part, p) in out.items()],
                               columns=["anchor", "digest", "data", "place"])

    parts = in_partitions(keyed).mapInPandas(fetch, "anchor long, digest long, data binary, place int")
    parts = parts.groupBy("anchor", "digest").agg(F.any_value(F.struct("data", "place")).alias("x"))
    parts = parts.select("anchor", "digest", "x.data", "x.place").join(mixed, "anchor")
    parts = staged(parts, "repeat-parts")

    dealt = parts.where(F.col("kinds") <= largest).repartition("anchor").sortWithinPartitions("anchor")
    few = dealt.select("anchor", "digest", "data", "place").mapInPandas(
        lambda frames: _compare(frames, length), _FOUND)

    def windows(frames):
        for frame in batches(frames, 100_000, "data"):
            for a, d, data in zip(frame["anchor"].tolist(), frame["digest"].tolist(), frame["data"]):
                h = _hashes(np.frombuffer(data, np.uint8), length)
                yield pd.DataFrame({"anchor": a, "digest": d, "first": np.arange(len(h)), "w": h.view(np.int64)})

    each = parts.where(F.col("kinds") > largest).select("anchor", "digest", "data").mapInPandas(
        windows, "anchor long, digest long, first int, w long")
    again = each.groupBy("anchor", "w").count().where("count > 1").select("anchor", "w")
    many = each.join(again, ["anchor", "w"]).select("anchor", "digest", "first", F.col("first").alias("last"))

    found = staged(whole.unionByName(few).unionByName(many), "repeat-found")
    by_kind = found.groupBy("anchor", "digest").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    spans = rows.join(by_kind, ["anchor", "digest"]).select(
        "doc_id", "h", F.transform("runs", lambda r: F.struct(
            (F.col("at") + r["first"]).alias("first"), (F.col("at") + r["last"]).alias("last"))).alias("runs"))
    # Repeated rows of one id and text have the same runs, each several times.
    spans = staged(spans.groupBy("doc_id", "h").agg(F.flatten(F.collect_set("runs")).alias("_runs")), "repeat-spans")
    return _without(docs, spans, length, as_text)


def _without(docs: DataFrame, spans: DataFrame, length: int, as_text: bool) -> DataFrame:
    """Join the runs to their rows and leave out the bytes they cover."""
    spans = spans.select(F.col("doc_id").alias("_i"), F.col("h").alias("_h"), "_runs")
    both = docs.withColumn("_key", F.xxhash64("text")).join(
        spans, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_h")), "left")
    both = both.drop("_i", "_h", "_key")

    def strip(frames):
        for frame in frames:
            n_bytes, removed, pieces, kept = [], [], [], []
            for text, runs in zip(frame["text"], frame["_runs"]):
                data = _bytes(text)
                gone, out, at, count = 0, [], 0, 0
                for r in sorted((x["first"], x["last"]) for x in (runs if runs is not None else ())):
                    first, end = r[0], r[1] + length
                    if first > at or not count:
                        out.append(data[at:first])
                        count += 1
                        at = first
                    gone += max(0, end - at)
                    at = max(at, end)
                out.append(data[at:])
                n_bytes.append(len(data)), removed.append(gone), pieces.append(count)
                kept.append("".join(x.decode("utf-8", "ignore") for x in out) if as_text else b"".join(out))
            yield frame.drop(columns="_runs").assign(_n_bytes=n_bytes, _n_removed=removed, _n_spans=pieces, _kept=kept)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return both.mapInPandas(strip, f"{fields}, _n_bytes long, _n_removed long, _n_spans long, "
                                f"_kept {'string' if as_text else 'binary'}")
