"""Operators 2, 3 and 9 on small fixtures."""

import random

from pyspark.sql import functions as F

from quotemill.llm import chat_format, mixing, url_filter
from quotemill.llm.graph import components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    links += [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    want = {x: find(x) for x in parent}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


PAGES = [
    (1, "https://x.example.org/es/9", "<link rel='canonical' href='https://a.example.net/q?x=1&amp;y=2#f'>"),
    (2, "http://a.example.net/q?x=1&y=2", None),
    (3, "https://b.example.net/r", '<META http-equiv="refresh" content="0; url=/s">'),
    (4, "https://b.example.net/s", "<link href=//c.example.com/de/1 rel=canonical>"),
    (5, "https://C.example.com/de/1", ""),
    (6, "https://example.org/en/12", None),
    (7, None, "<link rel=canonical href=https://example.org/en/1>"),
    (8, "no scheme", None), (9, "https://org/", None), (10, "https://org", None), (None, "ftp://u/", None),
    (2, "http://a.example.net/q?x=1&y=2", None),
    (11, "https://xorg/", None),
    (12, "https://m.example.net/1", "<link rel=canonical href='https://z.example.com/de/7'>"),
    (14, "https://n.example.net/1", "<!-- <link rel=canonical href=http://z.com/de/1> --><script>var a = \"<link rel=canonical "
     "href='http://z.com/de/1'>\"</script><STYLE>\n<link rel=canonical href=http://z.com/de/1></STYLE>"
     "<!-- <script> --><link rel=canonical href=/2><!-- open <link rel=canonical href=http://z.com/de/1>"),
    (15, "https://n.example.net/2", "<script><!--</script><link rel=canonical href='http://z.com/de/2'><style>"),
    (16, "https://n.example.net/3", "<script src=a>\n<link rel=canonical href=http://z.com/de/1>"),
    (13, "https://m.example.net/2", "<link rel=canonical href='1'><link rel=canonical href='http://k.org/'>"),
]


def test_url_verdicts(spark):
    df = spark.createDataFrame([(*p, "x", 0) for p in PAGES], "page_id long, url string, html string, rule string, node int")
    got = sorted((r.page_id or -1, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect())
    want = {1: ("x.example.org", "/es/9", "example.org/es/", "block"), 2: ("a.example.net", "/q", None, "block"),
            3: ("b.example.net", "/r", None, "block"), 4: ("b.example.net", "/s", None, "block"),
            5: ("c.example.com", "/de/1", "com/de/", "block"), 6: ("example.org", "/en/12", "example.org/en/1", "block"),
            7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("org", "/", "org/", "allow"),
            10: ("org", "", None, "allow"), -1: ("u", "/", None, "allow"), 11: ("xorg", "/", None, "allow"),
            14: ("n.example.net", "/1", None, "block"), 15: ("n.example.net", "/2", None, "block"),
            16: ("n.example.net", "/3", None, "allow"),
            # 12 and 13 share a class with a blocked and an explicitly allowed address.
            12: ("m.example.net", "/1", None, "allow"), 13: ("m.example.net", "/2", None, "allow")}
    assert len(got) == len(PAGES)
    for page, *rest in got:
        assert tuple(rest) == want[page], page


def test_url_verdicts_redirect_table_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://q.net/a", None)], "page_id long, url string, html string")
    hops = spark.createDataFrame([("http://q.net/a", "http://w.net/b"), ("http://w.net/b", "http://s.com/de/1"),
                                  (None, "http://q.net/a")], "from_url string, to_url string")
    assert [r.verdict for r in url_filter.judge(pages, redirects=hops).collect()] == ["block"]
    assert url_filter.judge(pages.limit(0)).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            out.update(share)
            break
        out.update({s: most * sizes[s] for s in over})
        open_ -= over
    return out


def test_mix_targets_and_budgets(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "b", "tiny" if i % 90 == 0 else "c", None, "Z", "é"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 7, 30])) + rng.choice(["", "\n"]), source))
    rows += [(3, rows[3][1], rows[3][2]), (None, "x y", "a"), (7, None, "a"), (8000, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df, rows_per_range=16).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert taken[s] == int(t + 1e-9), s
    again = mixing.mix(df.repartition(2), rows_per_range=300).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_follow_the_mix(spark):
    rows = [(i, f" a b{i}\tc d ", "ab"[i % 2], 9, 1) for i in range(50)] + [(77, None, "a", 0, 1), (78, "q r s t u", None, 9, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size long")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    want = {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken}
    assert words == want


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0 and mixing.mixed_documents(df).count() == 0
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(df).collect()] == [(0.0, 0)] * 2


SIDE = "pair_id long, turn long, role string, text string, mask int"


def test_preference_segments(spark):
    a = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so"), (1, 2, "user", "so"),
         (2, 0, None, None), (2, 1, "assistant", "x"), (None, 0, "user", "n"), (3, 0, "user", "only"),
         (4, None, "system", "s"), (4, 0, "assistant", "p")]
    b = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "so"),
         (2, 0, None, None), (2, 1, "assistant", "x"), (None, 0, "user", "m"),
         (4, None, "system", "s"), (4, 0, "assistant", "q")]
    got = chat_format.preference_segments(*[spark.createDataFrame([(*r, 9) for r in x], SIDE) for x in (a, b)]).collect()
    rows = {(r.pair_id, r.part, r.turn, r.role, r.copies, r.mask, r.rendered.split("\n")[1].replace("<|end|>", "")) for r in got}
    assert len(rows) == len(got)
    assert rows == {
        (1, "prompt", 0, "user", 1, 0, "hi"), (1, "chosen", 1, "assistant", 1, 1, "yes"), (1, "chosen", 2, "user", 2, 0, "so"),
        (1, "rejected", 1, "assistant", 1, 1, "no"), (1, "rejected", 2, "user", 1, 0, "so"),
        (2, "prompt", 0, None, 1, 0, ""), (2, "prompt", 1, "assistant", 1, 0, "x"),
        (None, "chosen", 0, "user", 1, 0, "n"), (None, "rejected", 0, "user", 1, 0, "m"), (3, "chosen", 0, "user", 1, 0, "only"),
        (4, "prompt", None, "system", 1, 0, "s"), (4, "chosen", 0, "assistant", 1, 1, "p"), (4, "rejected", 0, "assistant", 1, 1, "q")}


def test_swapped_answers(spark):
    t = [(0, 0, "user", "u"), (0, 1, "assistant", "a0"), (1, 0, "assistant", "a1"), (1, 1, "user", "v"),
         (4, 0, "assistant", "alone"), (6, 0, "user", "none"), (7, 0, "assistant", "a7"), (None, 0, "user", None)]
    df = spark.createDataFrame([(*r, 0) for r in t], "conv_id long, turn long, role string, text string, o int")
    _, rejected = chat_format.swapped_answers(df)
    got = {(r.pair_id, r.turn): r.text for r in rejected.collect()}
    assert got == {(0, 0): "u", (0, 1): "a1", (1, 0): "a0", (1, 1): "v", (4, 0): "alone", (6, 0): "none",
                   (7, 0): "a7", (None, 0): None}
    assert chat_format.preference_segments(*chat_format.swapped_answers(df.limit(0))).count() == 0


def test_rounds_are_written_in_few_files(spark, monkeypatch):
    """Whatever the number of shuffle partitions, a round's links lie in a few files a core."""
    from quotemill.llm import graph

    files, write = [], graph.staged

    def noted(df, name):
        out = write(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "staged", noted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 40).alias("b"))
        got = {r.node: r.component for r in graph.components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 40 for i in range(400)}
    assert max(files) <= 2 * spark.sparkContext.defaultParallelism < 97
