"""Plan-shape guarantees the scale design relies on (SURVEY §4, README 'Scale design')."""
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators import consumer as C
from quotemill.operators import extract as E
from quotemill.operators import links as L
from quotemill.operators import validate as V


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _hot_links(spark, n=3000):
    """A third of all links point at one URL, spread over many partitions."""
    return spark.range(0, n, 1, 12).select(
        (F.col("id") % 97).alias("page_id"), F.col("id").cast("int").alias("pos"),
        F.concat(F.lit("label-"), F.col("id").cast("string")).alias("label"),
        F.when(F.col("id") % 3 == 0, F.lit("https://h/hot"))
         .otherwise(F.concat(F.lit("https://h/p"), F.col("id").cast("string"))).alias("target_url"))


def test_dedupe_is_partial_aggregate_without_window(spark):
    d = L.dedupe_links(_hot_links(spark))
    plan = _physical(d)
    assert "partial_min" in plan and "Window" not in plan
    hot = d.filter(F.col("canonical_url") == "https://h/hot").first()
    # first by (page_id, pos): smallest page_id among ids % 3 == 0 is 0 (id 0, pos 0)
    assert (hot.page_id, hot.pos, hot.label) == (0, 0, "label-0")
    assert d.count() == 2001


def test_latest_rows_is_partial_aggregate_without_window(spark):
    ev = spark.range(0, 3000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_id"),
        F.col("id").alias("ts"), F.col("id").alias("event_id"))
    out = C.latest_rows(ev, ["user_id"], ["ts", "event_id"])
    plan = _physical(out)
    assert "partial_max" in plan and "Window" not in plan
    assert out.filter("user_id = 7").first().event_id == 2997


def test_link_page_join_broadcasts_links_and_never_shuffles_html(spark):
    pages = spark.range(0, 200, 1, 4).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://h/p"), F.col("id").cast("string")).alias("url"),
        F.lit("<p>x</p>").alias("html"))
    links = L.dedupe_links(_hot_links(spark, 300))
    joined, unresolved = L.resolve_links(links, pages)
    plan = _physical(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the only exchanges are on the small link side (dedupe) and the broadcast itself
    assert all("html" not in line for line in plan.split("\n") if "Exchange hashpartitioning" in line)
    # targets p<id> for id < 300 with id % 3 != 0 (200) plus the hot URL; pages exist for p0..p199
    assert joined.count() == 133 and unresolved.count() == 67 + 1


def _listing_pages(spark, n):
    html = F.concat(F.lit(f"<table class='{S.COMPANY_TABLE_CLASS}'><tbody><tr><td class='{S.COMPANY_CELL_CLASSES[0]}'><a>C"),
                    F.col("id").cast("string"), F.lit("</a></td></tr></tbody></table>"))
    return spark.range(0, n, 1, 4).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://h/p"), F.col("id").cast("string")).alias("url"), html.alias("html"))


def test_beyond_the_bound_no_html_is_shuffled(spark, scratch):
    path = scratch("pages")
    _listing_pages(spark, 2000).write.parquet(path)
    pages = spark.read.parquet(path)
    links = L.dedupe_links(_hot_links(spark, 300))
    want, missing = L.resolve_links(links, pages, extract=E.company_items, market_col="market_name")
    got, missing_too = L.resolve_links(links, pages, max_broadcast_rows=5, extract=E.company_items, market_col="market_name")
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "html" in plan and plan.count("MapInArrow") == 2  # one node, named once in the tree and once below
    below = plan.split("\n\n")
    assert any("Exchange" in b for b in below)
    assert all("html" not in b for b in below if b.lstrip().startswith("(") and "Exchange" in b.split("\n")[0])
    # The links are read back, not evaluated again.
    assert "partial_min" not in _physical(got) and "partial_min" not in _physical(missing_too)
    key = lambda r: (r.page_id, r.row_pos, r.company_name, r.market_name)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.columns == want.columns
    assert got.count() == 200 and missing.count() == missing_too.count() == 1
    plain, _ = L.resolve_links(links, pages, max_broadcast_rows=5)
    assert sorted(r.market for r in plain.collect()) == sorted(r.market_name for r in want.collect())
    assert plain.columns == ["page_id", "url", "html", "market"]


def test_possible_members_keeps_every_member(spark):
    from quotemill.operators import sizing as Z
    df = spark.range(0, 40000, 1, 6).select(F.when(F.col("id") != 7, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    members = df.where("id % 3 = 0").select(F.col("k").alias("m"))
    for count in (1, 14000, 1 << 40):
        got = Z.possible_members(df, F.col("k"), members, "m", count)
        assert got.columns == ["k", "id"] and "Exchange hashpartitioning(k" not in _physical(got)
        kept = {r.id for r in got.collect()}
        assert set(range(0, 40000, 3)) <= kept and 7 not in kept
        assert count == 1 or len(kept) < 13334 + 26666 / 10
    assert Z.possible_members(df, F.col("k"), members.limit(0), "m", 0).count() == 0


def test_extraction_reads_each_page_once_and_filters_stay_above_the_fence(spark):
    pages = spark.createDataFrame([(1, "u", "<h1>x</h1>", "M (A)")], "page_id long, url string, html string, market string")
    staged = V.stage(V.abbreviate(E.index_items(pages)), "indices")
    valid = V.valid_rows(staged, "indices")
    phys = _physical(valid)
    assert phys.count("MapInArrow") == 1 and "EvalPython" not in phys
    opt = _optimized(valid)
    assert opt.index("Filter") < opt.index("Generate inline") < opt.index("MapInArrow")


def test_pages_by_date_prune_partitions_and_seeds_push_into_scan(spark, scratch):
    from quotemill.sources import readers as R
    path = scratch("archive")
    pages = spark.range(0, 40, 1, 4).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://h/p"), F.col("id").cast("string")).alias("url"),
        F.lit("<p>x</p>").alias("html"), F.when(F.col("id") < 20, "20240403").otherwise("20240404").alias("ds"))
    pages.write.partitionBy("ds").parquet(path)
    day = R.read_pages(spark, path, ds="2024-04-04")
    plan = _physical(day)
    assert "PartitionFilters: [isnotnull(ds" in plan and "20240404" in plan
    assert day.count() == 20
    seeds = spark.createDataFrame([("https://h/p25",), ("https://h/p3",)], "url string")
    seed = R.seed_pages(day, seeds)
    assert "PushedFilters: [In(url" in _physical(seed)
    assert [r.page_id for r in seed.collect()] == [25]


def test_broadcasts_are_bounded_by_bytes_too(spark):
    from quotemill.operators import sizing as Z
    few_long = spark.range(100).select("id", F.repeat(F.lit("é"), 1 << 10).alias("label"), F.array("id").alias("ids"))
    pages = spark.range(1000).select("id")

    def hinted(side):
        return "ResolvedHint" in pages.join(side, "id")._jdf.queryExecution().analyzed().toString()
    assert hinted(Z.broadcast_if_small(few_long, 1000)) and not hinted(Z.broadcast_if_small(few_long, 99))
    assert not hinted(Z.broadcast_if_small(few_long, 1000, max_bytes=200_000))
    assert hinted(Z.broadcast_if_small(few_long.limit(0), 1))
    total = few_long.agg(F.sum(Z.row_bytes(few_long))).first()[0]
    assert 100 * 2048 < total < 100 * 2200
