"""Operator 5 against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from quotemill.llm import minhash_join as M


def plain_set(text, size=5):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows):
    sets = {i: plain_set(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                ra, rb = sorted((find(a), find(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, name string, rep int").repartition(4)
    return M.near_duplicates(df, **how).collect()


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts, line = [], " ".join(rng.choice(words) for _ in range(12))
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 60, 120]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 5])):
            other = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 6])):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append("\n".join(other).upper() if rng.random() < .3 else " ".join(other))
    texts += [t + " " + line for t in texts[:40]]
    base = [rng.choice(words) for _ in range(80)]
    for i in range(60):
        other = list(base)
        other[i] = "changed"
        texts.append(" ".join(other))
    texts += ["", None, " \n", "one", "ONE", "one two", texts[0], texts[0], "é ü\x00 ß", "x " * 20000, "x " * 30000]
    rng.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_against_all_pairs(spark):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)}
    assert got == brute(rows)


def test_deeper_levels_find_the_same(spark):
    rows = corpus(9)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows, small=3, deepest=3)}
    assert got == brute(rows)


def test_edge_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (None, None), (5, text), (5, text), (9, text), (7, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in run(spark, rows)), key=str)
    assert got == sorted([(None, 4, None, True), (None, 0, None, True), (5, 4, 5, True), (5, 4, 5, True), (9, 4, 5, False),
                          (7, 0, 7, True)], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicates(empty).count() == 0


def test_shingle_sets_match_plain_sets():
    texts = [t or "" for _, t in corpus(2)]
    h, sizes = M.shingle_sets(texts)
    assert sizes.tolist() == [len(plain_set(t)) for t in texts]
    ends = np.cumsum(sizes)
    mine = [set(h[e - n:e].tolist()) for e, n in zip(ends, sizes)]
    for i in range(0, len(texts), 7):
        for j in range(0, len(texts), 5):
            assert len(mine[i] & mine[j]) == len(plain_set(texts[i]) & plain_set(texts[j]))


def test_ranges_let_links_through():
    import numpy as np

    from quotemill.llm import minhash_join as m
    rng = np.random.default_rng(7)
    rows, sizes = [], []
    for n in (1, 4, 30, 300, 5000):
        for _ in range(20):
            base = rng.integers(0, 2**64 - 1, n, dtype=np.uint64)
            part = base[:-(-3 * n // 4)]
            rows += [np.unique(base), np.unique(part)]
            sizes += [len(rows[-2]), len(rows[-1])]
    h, sizes = np.concatenate(rows), np.array(sizes)
    head, bins = (m.sketches(h, sizes) >> np.uint64(56)).astype(np.uint8), m.binned(h, sizes)
    x = np.arange(0, len(sizes), 2)
    assert m._close(head, bins, x, x + 1, m.AGREE, 0.75).all()
    assert not m._close(head[-40:], bins[-40:], np.arange(0, 38, 2), np.arange(2, 40, 2), 0.0, 0.75).any()


def test_large_nodes_of_the_last_level_are_cut_into_blocks(spark):
    n, block = 300, 20
    rows = [(7, i, i, n) for i in range(n)] + [(8, i, i, 5) for i in range(5)]
    made = M._blocks(spark.createDataFrame(rows, "node long, rep long, component long, n long"), block).collect()
    groups = {}
    for r in made:
        groups.setdefault(r.node, []).append((r.rep, r.side))
    assert max(map(len, groups.values())) < 4 * block
    met = [(min(a, b), max(a, b)) for g in groups.values() for k, (a, s) in enumerate(g) for b, t in g[k + 1:]
           if s < 0 or s != t]
    assert len(met) == n * (n - 1) // 2 + 10
    assert len(set(met)) == n * (n - 1) // 2


def test_blocks_find_the_links_of_a_shared_template(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(120)]
    # A template just below the threshold in a third of the rows, and pairs of near copies inside it.
    rows = []
    for i in range(80):
        own = base[:100] + [f"own{i // 2}x{j}" for j in range(20)]
        rows.append((i, " ".join(own + ["end"] * (i % 2))))
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(60))) for i in range(160)]
    want = brute(rows)
    assert len({c for i, (_, c, _) in want.items() if i < 80}) == 40
    got = run(spark, rows, small=4, deepest=0, block=8)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def _template(n):
    rng = random.Random(5)
    base = [f"t{rng.randrange(5000)}" for _ in range(120)]
    return [" ".join(base[:102] + [f"own{i}x{j}" for j in range(18)]) for i in range(n)]


def test_a_node_gives_one_row_for_each_close_set():
    n = 60
    h, sizes = M.shingle_sets(_template(n))
    sketch = np.hstack([(M.sketches(h, sizes) >> np.uint64(56)).astype(np.uint8), M.binned(h, sizes)])
    rep = np.arange(10, 10 + n)
    got = M._within(np.full(n, 3), rep, rep, np.full(n, -1), sketch, M.AGREE, 0.75)
    assert sorted(got["rep"]) == rep.tolist()
    assert set(got["root"]) == {10}


def test_rows_hang_on_the_least_they_are_connected_to():
    x, y = np.array([8, 5, 2, 7, 3]), np.array([9, 8, 5, 3, 1])
    assert M._least_linked(10, x, y).tolist() == [0, 1, 2, 1, 4, 2, 6, 1, 2, 2]


def test_links_on_full_sets_against_plain_ones(monkeypatch):
    texts = [t for _, t in corpus(6) if plain_set(t)][:150]
    h, sizes = M.shingle_sets(texts)
    sets = [h[e - n:e] for e, n in zip(np.cumsum(sizes), sizes)]
    rep = np.arange(len(sets)) * 2
    for cells in (M.CELLS, 1000):
        monkeypatch.setattr(M, "CELLS", cells)
        got = M._links_within(rep, rep, np.full(len(sets), -1), sets, 75)
        label = dict(zip(got["b"], got["a"]))
        assert [label.get(i, i) for i in rep.tolist()] == [c for _, c, _ in brute(list(zip(rep.tolist(), texts))).values()]


def test_clusters_whole_in_blocks_and_by_node_find_the_same(spark):
    rows = corpus(11) + [(10_000 + i, t + (" end" if i % 3 else "")) for i, t in enumerate(_template(30) * 2)]
    want = brute(rows)
    for how in ({"block": 8}, {"block": 8, "many": 0}):
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, rows, **how)} == want, how


def test_sets_that_hang_together_are_compared_once_not_in_every_node(spark, monkeypatch):
    rows, made, kept = list(enumerate(_template(240))), [], M.staged

    def counted(df, name):
        out = kept(df, name)
        if name == "dup-close":
            made.append(out.count())
        return out
    monkeypatch.setattr(M, "staged", counted)
    got = run(spark, rows, small=4, deepest=1, block=8)
    assert {r.doc_id: r.component_id for r in got} == {i: i for i, _ in rows}
    assert sum(made) < 10 * len(rows)


def test_later_nodes_leave_out_what_hangs_together():
    n = 60
    h, sizes = M.shingle_sets(_template(n))
    sketch = np.hstack([(M.sketches(h, sizes) >> np.uint64(56)).astype(np.uint8), M.binned(h, sizes)])
    rep = np.arange(10, 10 + n)
    args = np.repeat([3, 4], n), np.tile(rep, 2), np.tile(rep, 2), np.full(2 * n, -1), np.tile(sketch, (2, 1))
    got = M._within(*args, M.AGREE, 0.75)
    assert got["rep"].tolist() == rep.tolist() and set(got["root"]) == {10}
    assert M._within(*args, M.AGREE, 0.75, np.tile(rep // 100, 2)).empty
    got = M._within(*args, M.AGREE, 0.75, np.tile(np.where(rep < 40, 10, rep), 2))
    assert set(got["root"]) == {10}


def test_only_wanted_sketches_go_on(spark):
    """Sets that need no further comparison do not enter the joins with their sketches."""
    sketch = spark.range(5000).select(F.col("id").alias("rep"), F.encode(F.col("id").cast("string"), "UTF-8").alias("sketch"))
    wanted = spark.createDataFrame([(3,), (77,), (77,), (4999,)], "rep long")
    got = {r.rep: bytes(r.sketch) for r in M._sketches_of(wanted, sketch).collect()}
    assert {r: got.get(r) for r in (3, 77, 4999)} == {3: b"3", 77: b"77", 4999: b"4999"}
    assert len(got) < 20
    assert M._sketches_of(wanted.limit(0), sketch).count() == 0
