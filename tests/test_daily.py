"""The daily job on a rendered site (sf0.001): invariants of SURVEY §5.4."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import render as R
from quotemill import schemas as S
from quotemill.plans import daily as D
from quotemill.sources import readers as RD


def test_run_daily_invariants(spark, scratch):
    base = scratch("daily")
    pages = R.site_pages(spark, SF_SMALL)
    pages.write.parquet(f"{base}/pages")
    pages = RD.read_pages(spark, f"{base}/pages")
    seeds = R.menu_pages(spark, SF_SMALL).select("url")
    rules = D.SiteRules(host=R.HOST, content=R.CONTENT)
    audit = {(r.dataset, r.check): r.value for r in D.run_daily(spark, pages, seeds, base, "2024-04-04", rules).collect()}
    for kind in ("indices", "companies"):
        assert audit[(kind, "valid")] + audit[(kind, "rejected")] == audit[(kind, "records")]
        assert audit[(kind, "history_rows")] == audit[(kind, "valid")] == audit[(kind, "loaded_rows")]
        assert audit[(kind, "unexpected_fields")] == 0
    rejects = spark.read.parquet(f"{base}/rejects/indices")
    assert rejects.count() == audit[("indices", "rejected")]
    assert rejects.filter(F.col("reject_reason").isNull()).count() == 0

    # A second run of the date changes nothing in history; the landing date and the warehouse are replaced.
    audit2 = {(r.dataset, r.check): r.value for r in D.run_daily(spark, pages, seeds, base, "2024-04-04", rules).collect()}
    assert {k: v for k, v in audit2.items() if k[1] != "landed_files"} == {k: v for k, v in audit.items() if k[1] != "landed_files"}
    wh = RD.read_table(spark, f"{base}/warehouse/companies", S.COMPANIES)
    assert wh.agg(F.countDistinct("id")).first()[0] == wh.count() == audit[("companies", "loaded_rows")]

    # Appending again is what the source does.
    audit3 = {(r.dataset, r.check): r.value
              for r in D.run_daily(spark, pages, seeds, base, "2024-04-04", rules, append_again=True).collect()}
    assert audit3[("companies", "history_rows")] == 2 * audit[("companies", "history_rows")]
    assert audit3[("companies", "landed_rows")] == audit3[("companies", "history_rows")]
    wh = RD.read_table(spark, f"{base}/warehouse/companies", S.COMPANIES)
    assert wh.agg(F.countDistinct("id")).first()[0] == audit3[("companies", "loaded_rows")]
    assert wh.columns == [f.name for f in S.COMPANIES.fields]


def test_run_daily_reads_the_pages_of_its_date(spark, scratch, monkeypatch):
    path = scratch("archive")
    spark.createDataFrame([(1, "u1", "x", "20240403"), (2, "u2", "y", "20240404")],
                          "page_id long, url string, html string, ds string").write.partitionBy("ds").parquet(path)
    read = []

    def seen(pages, seeds):
        read.append(pages)
        raise InterruptedError
    monkeypatch.setattr(D.R, "seed_pages", seen)
    try:
        D.run_daily(spark, path, ["u2"], scratch("daily"), "2024-04-04")
    except InterruptedError:
        pass
    assert [r.page_id for r in read[0].collect()] == [2]
    assert "PartitionFilters: [isnotnull(ds" in read[0]._jdf.queryExecution().executedPlan().toString()


def test_every_file_of_the_archive_holds_pages_of_both_kinds(spark, monkeypatch):
    from checks import catalog as C
    seen = {}

    def stop(spark, pages, *args):
        found = pages.where("page_id % 10 > 0").groupBy(F.input_file_name()).agg(F.countDistinct(F.expr("page_id % 10")).alias("kinds"))
        seen["kinds"] = [r.kinds for r in found.collect()]
        return spark.createDataFrame([], "check string")
    monkeypatch.setattr(C.D, "run_daily", stop)
    C.q_run_daily(spark, SF_SMALL)
    assert set(seen["kinds"]) == {2}


def test_dealt_rows_lie_evenly(spark):
    from quotemill.operators.sizing import dealt
    rows = dealt(spark.range(0, 4000, 1, 8).where("id < 500"))
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) > 1 and max(held) < 2 * 500 / len(held)
