"""The daily job as one function over a table of fetched pages.

Order of steps follows the source job: index extraction -> company extraction
-> row counts -> full export -> landing of both tables -> size audit ->
content audit -> strict truncate-load of both tables.  Scheduling, retries and
fetching are not part of it (SURVEY §9).

Layout under ``base``::

    staging/<table>/ds=<yyyyMMdd>/status=<valid|rejected>/   extraction, written once
    history/<table>/rows-<yyyyMMdd>/                          append-only typed tables, a folder a date
    history/<table>/_batches/<yyyyMMdd>/                      record of each whole batch
    rejects/<table>/ds=<yyyyMMdd>/                            refused records + reason
    landing/<table>/ds=<yyyyMMdd>/                            NDJSON export of full history
    warehouse/<table>/version-<n>/                            truncate-loaded tables, the newest counts
    links/ds=<yyyyMMdd>/                                      menu links, written once
    audit/ds=<yyyyMMdd>/step=<step>/                          audit rows, written as each step ends
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import audit as A
from ..operators import extract as E
from ..operators import links as L
from ..operators import validate as V
from ..operators.sizing import dealt
from ..sinks import writers as W
from ..sources import readers as R


@dataclass(frozen=True)
class SiteRules:
    """Where the menu is and how its links become page URLs."""
    host: str = S.DEFAULT_HOST
    domains: tuple[str, ...] = S.DEFAULT_DOMAINS
    base_lang: str = "en"
    menu_tag: str = "div"
    menu_class: str = S.MENU_SCOPE_CLASS
    menu_path: tuple[str, ...] = ("ul", "li")
    link_class: str = S.MENU_LINK_CLASS
    content: str | None = None


def crawl(links: DataFrame, pages: DataFrame, kind: str, rules: SiteRules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """B2-B8 and extraction for one crawl: ``(raw records of the target pages, refused links, unresolved links)``."""
    rule = "index" if kind == "indices" else "company"
    kept, refused = L.drop_missing_href(links, rule)
    url = (L.index_page_url("href", rules.host, rules.base_lang) if kind == "indices"
           else L.company_page_url("href", rules.host))
    targets = kept.withColumn("target_url", url).filter(L.within_domains("target_url", rules.domains))
    targets = L.dedupe_links(targets)
    if kind == "indices":
        extract, market = (lambda found: E.index_items(found, rules.content)), "index_abbreviation"
    else:
        extract, market = E.company_items, "market_name"
    raw, unresolved = L.resolve_links(targets, pages, url_col="target_url", extract=extract, market_col=market)
    return raw, refused, unresolved


def stage_records(raw: DataFrame, kind: str) -> DataFrame:
    """Stage 300 (abbreviation) and stage 400 (typing, reasons) of extracted records."""
    staged = V.stage(V.abbreviate(raw) if kind == "indices" else raw, kind)
    return staged.withColumn("status", F.when(F.col("reject_reason").isNull(), "valid").otherwise("rejected"))


def run_daily(spark: SparkSession, pages: DataFrame | str, seeds, base: str, ds,
              rules: SiteRules = SiteRules(), append_again: bool = False) -> DataFrame:
    """Run one logical date end to end; returns the audit rows ``(dataset, check, value, flag)``.

    ``pages`` is a table of fetched pages or the path of an archive partitioned by fetch date, of which the
    pages of ``ds`` alone are read (A2).  A date can be run again, after a failure or not: its rows are appended to history once, everything else
    replaces what the run before left.  ``append_again`` appends on every run, as the source does.
    """
    key = R.ds_key(ds)
    if isinstance(pages, str):
        pages = R.read_pages(spark, pages, ds)
    seed = dealt(R.seed_pages(pages, seeds))
    L.extract_links(seed, rules.menu_tag, rules.menu_class, rules.link_class, inside=rules.menu_path) \
     .write.mode("overwrite").parquet(f"{base}/links/ds={key}")
    links = spark.read.parquet(f"{base}/links/ds={key}")

    def record(step: str, audits: list[DataFrame]) -> None:
        A.union_all(audits).coalesce(1).write.mode("overwrite").parquet(f"{base}/audit/ds={key}/step={step}")

    for kind, schema in S.TABLES.items():
        raw, refused, unresolved = crawl(links, pages, kind, rules)
        staged = stage_records(raw, kind)
        stage_root = f"{base}/staging/{kind}/ds={key}"
        # Extraction runs once: both sides are read back from the written stage.
        staged.write.mode("overwrite").partitionBy("status").parquet(stage_root)
        stage_df = spark.read.parquet(stage_root)
        valid = V.valid_rows(stage_df.filter(F.col("status") == "valid"), kind)
        rejects = V.reject_rows(stage_df.filter(F.col("status") == "rejected"), kind)
        rejects.write.mode("overwrite").parquet(f"{base}/rejects/{kind}/ds={key}")
        W.append_with_ids(spark, valid, f"{base}/history/{kind}", schema, stable_input=True,
                          batch=None if append_again else key)

        counts = stage_df.groupBy().agg(
            F.count("*").alias("records"),
            F.count(F.when(F.col("status") == "valid", 1)).alias("valid"),
            F.count(F.when(F.col("status") == "rejected", 1)).alias("rejected"))
        record(f"stage_{kind}", [
            A.audit_rows(counts, kind, *[(c, c, None) for c in ("records", "valid", "rejected")]),
            A.audit_row(refused.agg(F.count("*").alias("n")), kind, "links_refused", "n"),
            A.audit_row(unresolved.agg(F.count("*").alias("n")), kind, "links_unresolved", "n")])

    # H1 row counts, G5/G6/D18 export of the full history, audits, G7 loads.
    for kind, schema in S.TABLES.items():
        history = R.read_history(spark, f"{base}/history/{kind}", schema)
        record(f"history_{kind}", [A.audit_row(history.agg(F.count("*").alias("n")), kind, "history_rows", "n")])
        W.land(history, f"{base}/landing", kind, ds, compat_round=True)
    for kind, schema in S.TABLES.items():
        landed = R.landing_path(f"{base}/landing", kind, ds)
        drift = A.unexpected_fields(spark, landed, schema).agg(F.count("*").alias("n"))
        record(f"landed_{kind}", [
            A.audit_files(spark, landed, kind, sizes=True), A.audit_text(spark, landed, kind, sizes=True),
            A.audit_row(drift, kind, "unexpected_fields", "n", F.col("n") > 0)])
    for kind, schema in S.TABLES.items():
        loaded = W.truncate_load(spark, f"{base}/landing", kind, ds, schema, f"{base}/warehouse/{kind}")
        record(f"loaded_{kind}", [A.audit_row(loaded.agg(F.count("*").alias("n")), kind, "loaded_rows", "n")])
    return spark.read.parquet(f"{base}/audit/ds={key}").drop("step")
