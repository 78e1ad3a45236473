"""Near-duplicate groups by a chosen-path set similarity join (operator 5).

Every distinct set of word shingles has a sketch of minwise values.  In each of
several independent trees a set starts at the root and follows randomly chosen sketch
positions: a node draws its positions from its own path, so sets that share the value at
a drawn position meet in the child of that name.  A pair of similarity s survives to a
child with chance of about s / threshold a branch.  A pair at the threshold that no smaller node has
compared is missed by all trees with a chance of 4.6e-6, 1.3e-5, 2.1e-4 and 1.3e-3 after one to four draws.

Small nodes are compared exhaustively.  In a large node every set is first linked to the
node's smallest id; sets that confirmed links have already put in one component need
no further comparison, and what remains follows further chosen positions until it is small.
A node still large at the last level is cut into blocks, and every two of them are a group of their own.
All links are confirmed on full sets, so the result holds no false link.

Comparing the sketches of nodes gives no pairs, of which a large group of sets just below the threshold has as many
as the square of its size, but the sets that are close to another one, each once a batch of nodes and with the least
set it hangs together with.  Sets that hang together after some of the nodes are not compared again in the others.
Sets that hang together over all nodes form a cluster, whose full sets meet in one task (or every two of its blocks
do) and are compared there.  A cluster of more than MANY blocks is compared in its nodes instead, so what is
shuffled grows with the number of sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import batches, bloom_filter, in_partitions, ship, staged
from quotemill.llm.graph import components

#: Words of a shingle; links need 100 * common >= PERCENT * union.
SHINGLE, PERCENT = 5, 75
#: Sketch positions (whole values name the nodes of the first level, 8 bits of each are kept), trees, and positions a node draws for its children (each with chance 1 / (similarity * SKETCH)).
SKETCH, TREES = 64, 20
#: Nodes of at most so many sets are compared exhaustively.
SMALL = 128
#: Levels below which a node is compared in any case, in pairs of blocks of about so many sets.
DEEPEST, BLOCK = 3, 512
#: Blocks of a cluster, at most, that are compared two by two; a larger cluster is compared node by node.
MANY = 20
#: One node in so many of the first and the last level is compared before the others.
EARLY = 4
#: Cells of a table of sets and shingles that are filled at a time.
CELLS = 4_000_000
#: A pair goes on unless its minwise values agree in fewer than this share of positions: 4.6 standard
#: deviations below the least share wanted.
AGREE = 0.5
#: Ranges of shingle hashes: a set's least hash in each, 8 bits of it (0: none), is its second sketch.  A pair goes on
#: to the full sets unless the ranges agree less than wanted by more than so many standard deviations.
BINS, SAFE = 256, 4.6
#: Pairs of sketches compared at a time.
PAIRS = 100_000
BATCH_CHARS = 4_000_000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _A)
_PLACE = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _PLACE.get("n", 0)
    if n > have:
        size = max(n, 2 * have)
        with np.errstate(over="ignore"):
            _PLACE["up"] = np.cumprod(np.full(size, _A))
            _PLACE["down"] = np.cumprod(np.full(size, np.uint64(pow(int(_A), -1, 2**64))))
        _PLACE["n"] = size
    return _PLACE["up"][:n], _PLACE["down"][:n]


def words_in(texts: list[str]):
    """Words of the texts on end, A-Z lower-cased.

    Returns the bytes, each word's start, end, hash and text, and the number of words by text.
    """
    data = ("\n".join(texts) + "\n").encode("utf-8", "surrogatepass").translate(_LOWER)
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[raw]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[:len(raw)])])
    word = _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _C)
    text_ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    owner = np.searchsorted(text_ends, starts, "right")
    return raw, starts, ends, word, owner, np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (64 bits) of the texts on end, ascending in each, and their number by text.

    A text of fewer words than a shingle has its whole sequence as one; without words, none.
    """
    _, _, _, word, owner, n_words = words_in(texts)
    n = len(word)
    # A word's place weighs in, so order matters; the sum runs to the shingle's or the text's end.
    first = np.cumsum(n_words) - n_words
    room = (first + n_words)[owner] - np.arange(n)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        ok = room > j
        h[ok] += _mix(word[np.flatnonzero(ok) + j] + np.uint64((j + 1) * int(_A) % 2**64))
    keep = (room >= size) | ((n_words[owner] < size) & (np.arange(n) == first[owner]))
    h, owner = _mix(h[keep]), owner[keep]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], np.bincount(owner[fresh], minlength=len(texts))


def sketches(h: np.ndarray, sizes: np.ndarray, positions: int = SKETCH) -> np.ndarray:
    """Minwise values, one row a non-empty set."""
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), positions), np.uint64)
    if not len(sizes):
        return out
    rng = np.random.default_rng(42)
    odd = rng.integers(0, 2**63, positions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, positions, dtype=np.uint64)
    for j in range(positions):
        least = np.minimum.reduceat(h * odd[j] + add[j], starts)
        out[:, j] = _mix(least)
    return out


def binned(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """8 bits of the least hash in each of BINS equal ranges (0: none), one row a non-empty set."""
    sizes = sizes[sizes > 0]
    out = np.zeros((len(sizes), BINS), np.uint8)
    place = np.repeat(np.arange(len(sizes)) * BINS, sizes) + (h // np.uint64(2**64 // BINS)).astype(np.int64)
    first = np.diff(place, prepend=-1) != 0
    out.ravel()[place[first]] = (h[first] % np.uint64(255)).astype(np.uint8) + 1
    return out


def _close(head: np.ndarray, bins: np.ndarray, x: np.ndarray, y: np.ndarray, agree: float, share: float) -> np.ndarray:
    """Which pairs of rows ``x, y`` agree enough, by minwise values first and by ranges then."""
    good = (head[x] == head[y]).mean(axis=1) >= agree
    at = np.flatnonzero(good)
    p, q = bins[x[at]], bins[y[at]]
    either = ((p | q) > 0).sum(axis=1)
    same = ((p == q) & (p > 0)).sum(axis=1)
    good[at] = same >= share * either - SAFE * np.sqrt(share * (1 - share) * either)
    return good


def _draws(node: np.ndarray, positions: int, chance: float) -> np.ndarray:
    """Which positions each node has chosen, from its name alone."""
    draw = _mix(node[:, None] + np.arange(1, positions + 1, dtype=np.uint64) * _A)
    return (draw >> np.uint64(11)).astype(np.float64) / 2**53 < chance


def branch(ids: np.ndarray, nodes: np.ndarray, sketch: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of every (set, node): row numbers and the children's names."""
    rows, place = np.nonzero(_draws(nodes, sketch.shape[1], chance))
    value = sketch[rows, place].astype(np.uint64)
    name = _mix(nodes[rows] * _A + _mix(value + (place.astype(np.uint64) + np.uint64(1)) * _B))
    return rows, name


def _unpack(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _alike(pairs: DataFrame, sketch: DataFrame, agree: float, share: float) -> DataFrame:
    """The ``(a, b)`` pairs whose sketches agree enough."""
    both = (pairs.join(sketch.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketch.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b"))

    def run(frames):
        for frame in frames:
            if not len(frame):
                continue
            rows = np.concatenate([_unpack(frame[c], np.uint8).reshape(len(frame), -1) for c in ("sa", "sb")])
            x = np.arange(len(frame))
            yield frame.loc[_close(rows[:, :-BINS], rows[:, -BINS:], x, x + len(frame), agree, share), ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _places(bits: int) -> list:
    """A set's places in a filter of ids."""
    return [F.pmod(F.xxhash64("rep", F.lit(i)), F.lit(bits)) for i in (1, 2)]


def _known(frame: pd.DataFrame, words: np.ndarray) -> np.ndarray:
    """Which rows, with their places as ``p1, p2``, a filter lets through."""
    hit = np.ones(len(frame), bool)
    for column in ("p1", "p2"):
        place = frame[column].to_numpy()
        hit &= (words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1
    return hit


def _sketches_of(wanted: DataFrame, sketch: DataFrame) -> DataFrame:
    """The sketches of the sets in ``wanted`` (a written table), and few others: a filter of bounded size tells which.

    Joins that follow shuffle these alone, and drop what the filter let through in error.
    """
    known = sketch.sparkSession.sparkContext.broadcast(bloom_filter(wanted.select("rep").distinct(), _places))
    p1, p2 = _places(known.value[1])

    def run(frames):
        for frame in frames:
            yield frame.loc[_known(frame, known.value[0]), ["rep", "sketch"]]

    return sketch.select("rep", "sketch", p1.alias("p1"), p2.alias("p2")).mapInPandas(run, "rep long, sketch binary")


def _full_sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``rep, n_shingles, shingles`` of the wanted classes, from the texts of their representatives.

    Texts stay in the tasks that read them: a filter of the wanted ids, of bounded size, tells
    which to shingle, and the join after it drops what the filter let through in error.
    """
    wanted = staged(wanted, "dup-wanted")
    known = docs.sparkSession.sparkContext.broadcast(bloom_filter(wanted, _places))
    bits = known.value[1]

    def full(frames):
        words, _ = known.value
        for frame in batches(frames, BATCH_CHARS):
            frame = frame[_known(frame, words)]
            h, sizes = shingle_sets(frame["text"].fillna("").tolist(), size)
            packed, ends = h.tobytes(), 8 * np.cumsum(sizes)
            each = [packed[b - 8 * n:b] for b, n in zip(ends, sizes)]
            yield pd.DataFrame({"rep": frame["rep"].to_numpy(), "shingles": each, "n_shingles": sizes,
                                "name": [hashlib.blake2b(x, digest_size=16).digest() for x in each]})

    rows = docs.where("doc_id is not null").select(F.col("doc_id").alias("rep"), "text")
    p1, p2 = _places(bits)
    rows = in_partitions(rows).select("rep", "text", p1.alias("p1"), p2.alias("p2")).mapInPandas(
        full, "rep long, shingles binary, n_shingles long, name binary")
    exact = reps.select("rep", "name").join(wanted, "rep", "left_semi")
    return staged(rows.join(exact, ["rep", "name"], "left_semi").drop("name").dropDuplicates(["rep"]), "dup-sets")


def _verify(docs: DataFrame, reps: DataFrame, pairs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The ``(a, b)`` pairs that the full sets confirm; sizes alone rule out many before."""
    size = reps.select("rep", "n_shingles")
    sized = (pairs.join(size.withColumnsRenamed({"rep": "a", "n_shingles": "na"}), "a")
             .join(size.withColumnsRenamed({"rep": "b", "n_shingles": "nb"}), "b")
             .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    pairs = staged(sized.select("a", "b"), "dup-sized")
    if pairs.isEmpty():
        return pairs
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = _full_sets(docs, reps, ends, shingle)
    full = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
            .join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a"))

    def confirm(frames):
        for frame in frames:
            good = []
            for x, y in zip(frame["sa"], frame["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield frame.loc[good, ["a", "b"]]

    return full.mapInPandas(confirm, "a long, b long")


def _least_linked(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first one it is connected to by the links ``x, y``, itself included."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[x], least[y])
        new = least.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, least[x], low)
        np.minimum.at(new, least[y], low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _within(node: np.ndarray, rep: np.ndarray, comp: np.ndarray, side: np.ndarray, sketch: np.ndarray, agree: float,
            share: float, cluster: np.ndarray | None = None) -> pd.DataFrame:
    """Sets close to one of another component, and side if not negative, in the same node; rows come sorted by node.

    Sets of one cluster, if given, are not compared.  Each set comes once, with the least set it hangs together with over all the nodes as ``root``.
    Nodes of one size are compared together, a bounded number of pairs at a time; a pair that
    several nodes hold is compared once a step.
    """
    start = np.flatnonzero(np.diff(node, prepend=node[:1] - 1) != 0)
    size = np.diff(np.append(start, len(node)))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    head, bins = np.ascontiguousarray(sketch[:, :-BINS]), np.ascontiguousarray(sketch[:, -BINS:])

    def test(x, y):
        other = (comp[x] != comp[y]) & ((side[x] < 0) | (side[x] != side[y]))
        if cluster is not None:
            other &= cluster[x] != cluster[y]
        x, y = x[other], y[other]
        if not len(x):
            return
        x, y = np.where(rep[x] < rep[y], x, y), np.where(rep[x] < rep[y], y, x)
        order = np.lexsort((rep[y], rep[x]))
        x, y = x[order], y[order]
        fresh = np.ones(len(x), bool)
        fresh[1:] = (rep[x[1:]] != rep[x[:-1]]) | (rep[y[1:]] != rep[y[:-1]])
        x, y = x[fresh], y[fresh]
        good = _close(head, bins, x, y, agree, share)
        found.append((x[good], y[good]))

    for k in np.unique(size[size > 1]).tolist():
        at = start[size == k]
        if k <= 512:
            i, j = np.triu_indices(k, 1)
            step = max(1, PAIRS // len(i))
            for n in range(0, len(at), step):
                test((at[n:n + step, None] + i).ravel(), (at[n:n + step, None] + j).ravel())
            continue
        step = max(1, PAIRS // k)
        for s in at.tolist():
            for n in range(0, k - 1, step):
                i, j = np.nonzero(np.arange(n, min(n + step, k))[:, None] < np.arange(k))
                test(s + n + i, s + j)
    x, y = (np.concatenate(v) for v in zip(*found))
    sets, own = np.unique(rep[np.concatenate([x, y])], return_inverse=True)
    return pd.DataFrame({"rep": sets, "root": sets[_least_linked(len(sets), own[:len(x)], own[len(x):])]})


def _links_within(rep: np.ndarray, comp: np.ndarray, side: np.ndarray, sets: list[np.ndarray],
                  percent: int) -> pd.DataFrame:
    """Sets of one group that links confirmed on the full sets connect, each with the first of them.

    Sets of one component, and of one side if not negative, need no link.
    Intersections are counted for all pairs at once, a bounded number of shingles at a time.
    """
    n, size = len(sets), np.array([len(x) for x in sets], np.int64)
    value, own = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(value, kind="stable")
    value, own = value[order], own[order]
    column = np.cumsum(np.diff(value, prepend=value[:1]) != 0)
    several = np.bincount(column) > 1
    held = several[column]
    column, own = (np.cumsum(several) - 1)[column[held]], own[held]
    both, width = np.zeros((n, n)), max(1, CELLS // n)
    for first in range(0, int(several.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        has = np.zeros((n, int(column[b - 1]) - first + 1), np.float32)
        has[own[a:b], column[a:b] - first] = 1
        both += has @ has.T
    good = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    good &= (comp[:, None] != comp[None, :]) & ((side[:, None] < 0) | (side[:, None] != side[None, :]))
    least = _least_linked(n, *np.nonzero(np.triu(good, 1)))
    tied = np.flatnonzero(least != np.arange(n))
    return pd.DataFrame({"a": rep[least[tied]], "b": rep[tied]})


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Nodes cut into salted blocks of about ``block`` sets: a new node for every two of them and for each alone.

    ``members``: ``node, rep, component, n``.  Adds ``side``: which of the two blocks a row is of, -1 in a block alone.
    Every two rows of a node meet on different sides, or in a block alone, once.
    """
    parts = F.ceil(F.col("n") / block).cast("int")
    cut = members.withColumn("_parts", parts).withColumn("_own", F.pmod(F.xxhash64("rep", "node"), "_parts").cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    lo, hi = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(lo == hi, -1).otherwise((F.col("_own") == hi).cast("int"))
    return cut.select(F.xxhash64("node", lo, hi).alias("node"), "rep", "component", side.alias("side"))


def _by_node(frames, unpack, work):
    """``work`` on the columns that ``unpack`` makes of frames sorted by node, whole nodes at a time.

    The last node of a frame waits for the next one.
    """
    held: list = []
    for frame in frames:
        if not len(frame):
            continue
        node, rows = frame["node"].to_numpy(), unpack(frame)
        cut = int(np.searchsorted(node, node[-1]))
        if cut or (held and held[-1][0][-1] != node[0]):
            held.append(tuple(x[:cut] for x in rows))
            yield from work(*(np.concatenate(x) for x in zip(*held)))
            held = []
        held.append(tuple(x[cut:] for x in rows))
    if held:
        yield from work(*(np.concatenate(x) for x in zip(*held)))


def _apart(members: DataFrame, hung: DataFrame) -> DataFrame:
    """``members`` with their ``cluster`` (themselves, if in none), without nodes that are of one cluster."""
    own = members.join(hung, "rep", "left").withColumn("cluster", F.coalesce("cluster", "rep"))
    mixed = own.groupBy("node").agg(F.min("cluster").alias("_lo"), F.max("cluster").alias("_hi"))
    return own.join(mixed.where("_lo <> _hi").select("node"), "node", "left_semi")


def _close_sets(members: DataFrame, agree: float, share: float) -> DataFrame:
    """``rep, root``: sets whose sketch agrees enough with one of another component and cluster in a node they share.

    ``members``: ``node, rep, sketch, component, side, cluster``.
    """
    def unpack(frame):
        return (*(frame[c].to_numpy() for c in ("node", "rep", "component", "side")),
                _unpack(frame["sketch"], np.uint8).reshape(len(frame), -1), frame["cluster"].to_numpy())

    def work(*rows):
        yield _within(*rows[:-1], agree, share, rows[-1])

    return members.repartition("node").sortWithinPartitions("node").select(
        "node", "rep", "sketch", "component", "side", "cluster").mapInPandas(
        lambda frames: _by_node(frames, unpack, work), "rep long, root long")


def _clusters(close: DataFrame, hung: DataFrame) -> DataFrame:
    """``rep, cluster`` of the sets that hang together: by ``hung``, the clusters so far, or by ``close``."""
    hang = close.where("rep <> root").select(F.col("root").alias("a"), F.col("rep").alias("b")).unionByName(
        hung.select(F.col("cluster").alias("a"), F.col("rep").alias("b")))
    return components(hang).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def _cluster_links(docs: DataFrame, reps: DataFrame, cluster: DataFrame, nodes: DataFrame, comps: DataFrame, percent: int,
                   shingle: int, block: int, many: int) -> DataFrame:
    """Links ``(a, b)`` among sets that hang together (``rep, cluster``), confirmed on the full sets; one for each set that a group connects.

    Clusters of sets that hang together are groups, or every two blocks of theirs; those of more than ``many``
    blocks are compared in the ``nodes`` they share.
    """
    sized = cluster.groupBy("cluster").agg(F.count("*").alias("n"))
    cluster = staged(cluster.join(sized, "cluster"), "dup-clusters")
    few = F.col("n") <= many * block
    groups = cluster.where(few).join(comps, "rep", "left").select(
        F.col("cluster").alias("node"), "rep", F.coalesce("component", "rep").alias("component"), "n")
    groups = _blocks(groups, block)
    large = cluster.where(~few).select("rep", "cluster")
    if not large.isEmpty():
        # Sets of a node meet if they are of one cluster.
        apart = nodes.join(large, "rep").withColumn("node", F.xxhash64("node", "cluster")).drop("cluster")
        groups = groups.unionByName(apart)
    sets = _full_sets(docs, reps, cluster.select("rep"), shingle).select("rep", "shingles")

    def unpack(frame):
        packed = np.empty(len(frame), object)
        packed[:] = frame["shingles"].tolist()
        return (*(frame[c].to_numpy() for c in ("node", "rep", "component", "side")), packed)

    def work(node, rep, comp, side, packed):
        start = np.flatnonzero(np.diff(node, prepend=node[:1] - 1) != 0).tolist()
        out = [_links_within(rep[a:b], comp[a:b], side[a:b], [np.frombuffer(x, np.uint64) for x in packed[a:b]], percent)
               for a, b in zip(start, [*start[1:], len(node)]) if b - a > 1]
        if out:
            yield pd.concat(out)

    return groups.join(sets, "rep").repartition("node").sortWithinPartitions("node").select(
        "node", "rep", "component", "side", "shingles").mapInPandas(
        lambda frames: _by_node(frames, unpack, work), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, trees: int = TREES,
                    positions: int = SKETCH, small: int = SMALL, deepest: int = DEEPEST,
                    agree: float = AGREE, block: int = BLOCK, many: int = MANY) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_shingles, component_id, kept``, one row out per row in.

    A-Z are lower-cased, words are runs of other characters than blank and the
    controls 9-13.  Documents of equal sets form one class, which enters the join once.
    Null, empty and blank texts have no shingle and are linked with nothing.  Of
    rows that repeat a doc_id the one whose set has the least digest stands for the document.
    Rows with a null id are linked with nothing and kept, their component is null.  An
    empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    chance, share = 100.0 / (percent * positions), percent / 100.0

    def prepare(frames):
        """Digest and sketch of every set, and its nodes of the first level in all trees."""
        roots = _mix(np.arange(1, trees + 1, dtype=np.uint64) * _A)
        for frame in batches(frames, BATCH_CHARS):
            h, sizes = shingle_sets(frame["text"].fillna("").tolist(), size)
            packed, ends = h.tobytes(), 8 * np.cumsum(sizes)
            some = np.flatnonzero(sizes)
            sketch = sketches(h, sizes, positions)
            rows = np.repeat(np.arange(len(some)), trees)
            at, node = branch(rows, np.tile(roots, len(some)), sketch[rows], chance)
            count = np.bincount(rows[at], minlength=len(some))
            node = node[np.argsort(rows[at], kind="stable")].view(np.int64)
            cut = np.cumsum(count)
            out = pd.DataFrame({"doc_id": pd.array(frame["doc_id"], "Int64"), "n_shingles": sizes,
                                "name": None, "sketch": None, "nodes": None})
            for column, values in (
                    ("name", [hashlib.blake2b(packed[ends[i] - 8 * sizes[i]:ends[i]], digest_size=16).digest() for i in some]),
                    ("sketch", [x.tobytes() for x in np.hstack(
                        [(sketch >> np.uint64(56)).astype(np.uint8), binned(h, sizes)])]),
                    ("nodes", [node[b - n:b] for b, n in zip(cut, count)])):
                filled = np.empty(len(frame), object)
                for i, v in zip(some.tolist(), values):
                    filled[i] = v
                out[column] = filled
            yield out

    rows = staged(in_partitions(docs).mapInPandas(
        prepare, "doc_id long, n_shingles long, name binary, sketch binary, nodes array<long>"), "dup-rows")
    owner = rows.where("name is not null and doc_id is not null").groupBy("doc_id").agg(F.min("name").alias("name"))
    owner = staged(owner, "dup-owners")
    classes = owner.groupBy("name").agg(F.min("doc_id").alias("rep"))
    reps = rows.withColumnsRenamed({"doc_id": "rep"}).join(classes, ["rep", "name"])
    # A representative has one name: rows stay where the join has put them.
    reps = staged(reps.select("rep", "name", "n_shingles", "sketch", "nodes").dropDuplicates(["rep", "name"]), "dup-reps")
    sketch = reps.select("rep", "sketch")

    members = reps.select("rep", F.explode("nodes").alias("node"))
    counts = members.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1")
    met = staged(members.join(counts, "node").select("node", "rep", "least").distinct(), "dup-nodes")

    stars = met.where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    stars = staged(_alike(stars, sketch, agree, share), "dup-stars")

    def joined(comps, links):
        """Components after the confirmed links: the former ones are their stars."""
        found = staged(links, "dup-links")
        if found.isEmpty():
            return comps
        found = found.unionByName(comps.select(F.col("component").alias("a"), F.col("rep").alias("b")))
        return staged(components(found).select(F.col("node").alias("rep"), "component"), "dup-components")

    # First links: every set of a node with the node's least.
    comps = docs.sparkSession.createDataFrame([], "rep long, component long")
    if not stars.isEmpty():
        comps = joined(comps, _verify(docs, reps, stars, percent, size))
    level, nodes = met.select("node", "rep"), None
    hung = comps.select("rep", F.col("component").alias("cluster")).limit(0)
    for depth in range(deepest + 1):
        with_comp = level.join(comps, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        mixed = with_comp.groupBy("node").agg(
            F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        mixed = mixed.where("lo <> hi").select("node", "n")
        open_ = staged(with_comp.join(mixed, "node"), f"dup-level{depth}")
        large = open_.where(F.col("n") > small)
        whole = open_.where(F.col("n") <= small).select("node", "rep", "component", F.lit(-1).alias("side"))
        if depth == deepest:
            whole = staged(whole.unionByName(_blocks(large, block)), "dup-blocks")
        nodes = whole if nodes is None else nodes.unionByName(whole)
        # Sketches of sets that need no further comparison stay behind.
        sketch = staged(_sketches_of(open_, sketch), "dup-sketches")
        # Clusters are compared whole in the end: what hangs together after a share of the nodes is left out of the others,
        # and what hangs together after a level of the next ones.
        early = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(EARLY)) == 0
        for some in (whole.where(early), whole.where(~early)) if depth in (0, deepest) else (whole,):
            close = staged(_close_sets(_apart(some, hung).join(sketch, "rep"), agree, share), "dup-close")
            if not close.isEmpty():
                hung = staged(_clusters(close, hung), "dup-hung")
        if depth == deepest or large.isEmpty():
            break

        def deeper(frames):
            for frame in frames:
                if not len(frame):
                    continue
                values = _unpack(frame["sketch"], np.uint8).reshape(len(frame), -1)[:, :positions]
                rows, name = branch(frame["rep"].to_numpy(), frame["node"].to_numpy().view(np.uint64), values, chance)
                yield pd.DataFrame({"node": name.view(np.int64), "rep": frame["rep"].to_numpy()[rows]})

        level = large.select("node", "rep").join(sketch, "rep").mapInPandas(deeper, "node long, rep long")
        level = staged(level, "dup-nodes")
    # Few are left beside the stars: full sets are fetched once for all of them.
    if not hung.isEmpty():
        comps = joined(comps, _cluster_links(docs, reps, hung, nodes, comps, percent, size, block, many))

    label = classes.join(comps, "rep", "left").select("name", F.coalesce("component", "rep").alias("component"))
    label = owner.join(label, "name").select("doc_id", "component")
    own = F.coalesce(F.col("component"), F.col("doc_id"))
    return rows.select("doc_id", "n_shingles").join(label, "doc_id", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
