"""Approximate nearest neighbours by largest inner product (operator 10).

A hierarchical k-means tree is fitted on a bounded sample; every vector is filed
under its leaf.  A query walks the tree best bin first: a priority queue holds the
nodes by distance, the nearest is opened, and leaves are visited until their number reaches
what calibration found: the fewest visits at which known exact neighbours of some
queries, searched among all vectors, are found with the wanted recall.

Inner products become distances by one more coordinate: with M the largest norm,
(x, sqrt(M^2 - |x|^2)) is nearest to (q, 0) where q.x is largest.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import in_partitions, ship, staged

#: Vectors the tree is fitted on, children of a node, sample vectors that end the splitting.
SAMPLE, CHILDREN, LEAF = 16_384, 8, 96
#: Queries whose exact neighbours calibrate the visits, and the recall they must reach.
CALIBRATE, RECALL = 128, 0.95
#: Vectors and queries that meet in one task at a time.
BLOCK, QUERY_BLOCK = 4096, 2048


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles): one row an id, without null, zero, or non-finite vectors.

    Rows with a null id take no part.  Of rows that repeat an id the least vector stays.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _split(points: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """k-means: centres and the centre of each point; fewer centres when points coincide."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(12):
        own = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        kept = np.unique(own)
        new = np.array([points[own == j].mean(axis=0) for j in kept])
        if len(new) == len(centres) and np.allclose(new, centres):
            break
        centres = new
    own = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    return centres, own


class Tree:
    """Nodes as lists of centres and children; a leaf has none."""

    def __init__(self, points: np.ndarray, children: int = CHILDREN, leaf: int = LEAF, seed: int = 11):
        self.centres, self.below, self.leaf_no, self.leaves = [], [], [], 0
        self._grow(points, children, leaf, np.random.default_rng(seed))

    def _grow(self, points, children, leaf, rng):
        me = len(self.centres)
        self.centres.append(None), self.below.append(None), self.leaf_no.append(-1)
        own = None
        if len(points) > leaf:
            centres, own = _split(points, children, rng)
        if own is None or len(np.unique(own)) < 2:
            self.leaf_no[me] = self.leaves
            self.leaves += 1
            return me
        used = np.unique(own)
        self.centres[me] = centres[used]
        self.below[me] = [self._grow(points[own == j], children, leaf, rng) for j in used]
        return me

    def file(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point, by the nearest centre at every node."""
        out = np.empty(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.below[node] is None:
                out[rows] = self.leaf_no[node]
                continue
            c = self.centres[node]
            near = ((c**2).sum(axis=1) - 2 * points[rows] @ c.T).argmin(axis=1)
            todo += [(child, rows[near == j]) for j, child in enumerate(self.below[node]) if (near == j).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            while self.below[node] is not None:
                far = ((self.centres[node] - query) ** 2).sum(axis=1)
                order = np.argsort(far, kind="stable")
                for j in order[1:]:
                    heapq.heappush(queue, (float(far[j]), self.below[node][j]))
                node = self.below[node][order[0]]
            out.append(self.leaf_no[node])
        return out


def _lift(v: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(0, norm**2 - (v**2).sum(axis=1)))[:, None]])


def _flat(v: np.ndarray) -> np.ndarray:
    return np.hstack([v, np.zeros((len(v), 1))])


def _best(q_ids, q, ids, v, k) -> pd.DataFrame:
    """The k largest inner products of each query with the block, other ids only, ties by id.

    A matrix product picks who can be among them; their scores are then summed pair
    by pair in one fixed order, so equal vectors get equal scores in any block.
    """
    rough = q @ v.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        floor = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
        slack = 1e-9 * np.sqrt((q**2).sum(axis=1) * (v**2).sum(axis=1).max())
        near = rough >= np.where(np.isfinite(floor), floor - slack, -np.inf)[:, None]
    else:
        near = np.ones(rough.shape, bool)
    near &= np.isfinite(rough)
    at, of = np.nonzero(near)
    score = np.empty(len(at))
    for i in range(0, len(at), 65536):
        score[i:i + 65536] = (q[at[i:i + 65536]] * v[of[i:i + 65536]]).sum(axis=1)
    order = np.lexsort((ids[of], -score, at))
    at, of, score = at[order], of[order], score[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    top = rank < k
    return pd.DataFrame({"query_id": q_ids[at[top]], "vec_id": ids[of[top]], "score": score[top]})


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


_PAIRS = "query_id long, vec_id long, score double"


def _top(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Brute force over all vectors for a bounded set of queries held in memory."""
    shared = vectors.sparkSession.sparkContext.broadcast((ids, queries))

    def run(frames):
        q_ids, q = shared.value
        for frame in frames:
            for i in range(0, len(frame), BLOCK):
                part = frame.iloc[i:i + BLOCK]
                yield _best(q_ids, q, part["vec_id"].to_numpy(), _matrix(part["v"]), k)

    return _top(vectors.select("vec_id", "v").mapInPandas(run, _PAIRS), k)


def build(vectors: DataFrame, sample: int = SAMPLE, **how) -> tuple[Tree, float]:
    """Tree of a sample (the ids of least hash) and the largest norm of all vectors."""
    norm = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0] ** 0.5
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    return Tree(_lift(_matrix(rows["v"]), norm), **how), norm


def calibrate(tree: Tree, filed: DataFrame, queries: DataFrame, k: int, recall: float, count: int) -> int:
    """Fewest leaf visits that find ``recall`` of the exact neighbours of ``count`` queries."""
    some = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(count).toPandas()
    if not len(some):
        return tree.leaves
    q = _matrix(some["v"])
    truth = exact(filed, some["vec_id"].to_numpy(), q, k)
    truth = truth.join(filed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    if not len(truth):
        return tree.leaves
    turn = {i: {leaf: n for n, leaf in enumerate(tree.visits(x, tree.leaves))}
            for i, x in zip(some["vec_id"], _flat(q))}
    needed = np.sort([turn[i][leaf] + 1 for i, leaf in zip(truth["query_id"], truth["leaf"])])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def search(rows: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL, sample: int = SAMPLE,
           calibration: int = CALIBRATE, block: int = BLOCK, query_block: int = QUERY_BLOCK, **how) -> DataFrame:
    """``vec_id, embedding`` tables -> ``query_id, rank, vec_id, score``: k nearest found of each query.

    Candidates are all rows but those of the query's own id.  Vectors that are
    null, zero, or hold a null or non-finite component take no part, nor do those
    whose length differs from the commonest one (ties: the shorter).  Visits are
    widened past the calibrated number until the leaves hold k candidates.
    Empty tables, or queries alone, give an empty result.

    A leaf's vectors are cut into blocks by hash, its queries too, so a leaf
    that holds a third of all vectors is many tasks.
    """
    spark = rows.sparkSession
    ship(spark)
    vectors = staged(usable(rows), "knn-vectors")
    length = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return spark.createDataFrame([], schema)
    vectors = vectors.where(F.size("v") == length.n)
    queries = usable(queries).where(F.size("v") == length.n)
    tree, norm = build(vectors, sample, **how)
    shared = spark.sparkContext.broadcast((tree, norm))

    def file(frames):
        t, m = shared.value
        for frame in frames:
            if len(frame):
                yield frame.assign(leaf=t.file(_lift(_matrix(frame["v"]), m)))

    filed = staged(in_partitions(vectors).mapInPandas(file, "vec_id long, v array<double>, leaf long"), "knn-filed")
    sizes = {r.leaf: r.n for r in filed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    wanted = calibrate(tree, filed, queries, k, recall, calibration)
    q_rows = staged(queries, "knn-queries")
    per_leaf = {leaf: -(-n // block) for leaf, n in sizes.items()}

    # Visits of every query, without its vector.
    def walk(frames):
        t, _ = shared.value
        for frame in frames:
            out = []
            for i, x in zip(frame["vec_id"].tolist(), _flat(_matrix(frame["v"])) if len(frame) else []):
                most, leaves = wanted, []
                while True:
                    leaves = t.visits(x, most)
                    # The query may be one of the candidates itself.
                    if len(leaves) >= t.leaves or sum(sizes.get(leaf, 0) for leaf in leaves) > k:
                        break
                    most *= 2
                out += [(i, leaf) for leaf in leaves if leaf in sizes]
            yield pd.DataFrame(out, columns=["query_id", "leaf"])

    visits = in_partitions(q_rows).mapInPandas(walk, "query_id long, leaf long")
    visits = staged(visits, "knn-visits")
    askers = {r.leaf: -(-r.n // query_block) for r in visits.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    # Few rows: one a leaf, at most the sample's size.
    grid = spark.createDataFrame([(leaf, n, askers.get(leaf, 0)) for leaf, n in per_leaf.items()],
                                 "leaf long, blocks int, askers int")
    grid = F.broadcast(grid)

    def salted(df, key, own, other):
        """A row's own salt by hash, and a copy for each salt of the other side."""
        return (df.join(grid, "leaf").where("askers > 0")
                .withColumn(own[0], F.pmod(F.xxhash64(key), F.col(own[1])).cast("int"))
                .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1))))

    v_side = salted(filed, "vec_id", ("b", "blocks"), ("a", "askers")).select("leaf", "b", "a", "vec_id", "v")
    q_side = salted(visits.join(q_rows.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id"),
                    "query_id", ("a", "askers"), ("b", "blocks")).select("leaf", "b", "a", "query_id", "q")

    def meet(v, q):
        if not len(v) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, matrix = v["vec_id"].to_numpy(), _matrix(v["v"])
        parts = [_best(p["query_id"].to_numpy(), _matrix(p["q"]), ids, matrix, k)
                 for p in (q.iloc[i:i + 512] for i in range(0, len(q), 512))]
        return pd.concat(parts)

    pairs = v_side.groupBy("leaf", "b", "a").cogroup(q_side.groupBy("leaf", "b", "a")).applyInPandas(meet, _PAIRS)
    return _top(pairs, k).select("query_id", "rank", "vec_id", "score")
