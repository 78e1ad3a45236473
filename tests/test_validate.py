"""Valid / reject split (F4-F10) and extraction of both page kinds (F1, F2)."""
import math

from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators import extract as E
from quotemill.operators import validate as V

COMPANY_ROW = ('<table class="tabtable-rs_01k0jris"><thead><tr><td class="col_width_1">Head</td></tr></thead><tbody>'
               '<tr><td class="col_width_1"><a>Bank &amp; Co </a></td><td class="col_width_2"> Banks </td>'
               '<td class="col_width_3">1,234.50</td><td class="col_width_4"><font></font><p>+1.5%</p></td>'
               '<td class="col_width_5"><font>-2%</font></td><td class="col_width_6">-</td>'
               '<td class="col_width_7">03-Apr-2024</td></tr>'
               '<tr><td class="col_width_1"></td><td class="col_width_2"></td><td class="col_width_3">nan</td>'
               '<td class="col_width_4"></td><td class="col_width_5"><p>%</p></td><td class="col_width_6">10</td>'
               '<td class="col_width_7"> </td></tr></tbody></table>')


def test_company_items_and_split(spark):
    pages = spark.createDataFrame([(1, "u", COMPANY_ROW, "Nairobi (NSE)")],
                                  "page_id long, url string, html string, market string")
    raw = E.company_items(pages).orderBy("row_pos").collect()
    assert [r.company_name for r in raw] == ["Bank & Co", "N/A"]
    assert [(r.sector, r.price, r.one_day, r.ytd, r.market_cap, r.date) for r in raw] == [
        ("Banks", "1,234.50", "+1.5%", "-2%", "-", "03-Apr-2024"), ("N/A", "nan", "N/A", "%", "10", "")]
    valid, rejects = V.split_valid(E.company_items(pages), "companies")
    rj = rejects.collect()
    assert len(rj) == 1 and rj[0].reject_reason == "market_cap:not_a_number" and rj[0].company_name == "Bank & Co"
    v = valid.collect()
    assert len(v) == 1 and math.isnan(v[0].price) and v[0].ytd is None and v[0].market_cap == 10.0
    assert v[0].market_name == "Nairobi (NSE)"
    assert valid.columns == [f.name for f in S.COMPANIES.fields if f.name != "id"]


INDEX_PAGE = ('<h1 class="page-subtitle">X <small class="subheading-category"> \U0001F1F0\U0001F1EA Nairobi </small></h1>'
              '<div class="c"><font size="1">x As of y As of 04-Apr-2024</font>'
              '<span style="font-weight:bold;font-size: 22pt"> </span><span style="font-weight:bold;font-size: 22pt">74,097.94</span>'
              '<font><span style="color: #ff0000;">-334.95</span></font></div><div class="e"></div>'
              '<table class="tabtable-rs_c4try72e"><tr class="tr_ht1"><td>1M</td><td>3M</td><td>1M</td></tr>'
              '<tr class="tabrow"><td><p>+1.82%</p></td><td><p>-0.55%</p></td><td><p>+9%</p></td><td><p>x</p></td></tr></table>'
              '<table class="tabtable-gr_alterora_elemental_2_grey_1s2"><tr class="tabrow"><td><span>Volume</span></td>'
              '<td><span>Value Traded (BWP)</span><span>661,866.43</span></td></tr></table>')


def test_index_items(spark):
    pages = spark.createDataFrame([(1, "u", INDEX_PAGE, "Johannesburg (JSE)"),
                                   (2, "v", INDEX_PAGE.replace("<span>Volume</span>", "n/a"), "BRVM")],
                                  "page_id long, url string, html string, market string")
    raw = V.abbreviate(E.index_items(pages, "div.c")).orderBy("page_id").collect()
    r = raw[0]
    assert (r.current_date, r.index_abbreviation, r.index_value, r.index_change, r.index_percentage_change) == \
        ("04-Apr-2024", "JSE", "", "74,097.94", "-334.95")
    assert r.indice_name == "\U0001F1F0\U0001F1EA Nairobi"
    assert r.time_periods == {"1M": "+9%", "3M": "-0.55%"}
    assert r.market_summary == {"Volume": "Volume", "Value Traded (BWP)": "661,866.43"}
    assert r.extract_error is None
    assert raw[1].extract_error == "summary_cell_without_span" and raw[1].index_abbreviation == S.SENTINEL_ABBREVIATION
    staged = V.stage(V.abbreviate(E.index_items(pages, "div.c")), "indices")
    assert staged.filter(F.col("reject_reason").isNull()).count() == 1


def test_varchar_trailing_spaces(spark):
    df = spark.createDataFrame([("a" * 250 + " " * 10, "b" * 256)], "company_name string, sector string")
    raw = df.select("company_name", "sector", *[F.lit(None).cast("string").alias(c)
                                                for c in ["price", "one_day", "ytd", "market_cap", "date"]],
                    F.lit("m").alias("market_name"))
    st = V.stage(raw, "companies").first()
    assert len(st._t_company_name) == 255 and st.reject_reason == "sector:too_long"


def test_company_items_rebalanced_rows_same_result(spark):
    rows = "".join(f'<tr><td class="col_width_1"><a>C{i}</a></td><td class="col_width_3">{i}.5</td></tr>'
                   for i in range(300))
    html = f'<table class="tabtable-rs_01k0jris"><tbody>{rows}</tbody></table>'
    pages = spark.createDataFrame([(1, "u", html, "Hot (H)"), (2, "v", COMPANY_ROW, "M (X)")],
                                  "page_id long, url string, html string, market string")
    plain = E.company_items(pages)
    balanced = E.company_items(pages, rebalance_rows=True)
    assert "RebalancePartitions" in balanced._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(plain.collect()) == sorted(balanced.collect())
    assert plain.count() == 302


def test_route_and_conform(spark):
    items = spark.createDataFrame([("indices", 1), ("companies", 2), ("companies", 3), ("other", 4)],
                                  "record_type string, k int")
    routed = V.route(items)
    assert set(routed) == {"indices", "companies"}
    assert (routed["indices"].count(), routed["companies"].count()) == (1, 2)  # unknown types are not stored
    df = spark.createDataFrame([("x", "1", 7)], "company_name string, price string, id int")
    out = V.conform(df.select("company_name", F.col("price").cast("double").alias("price"), "id",
                              *[F.lit(None).alias(c) for c in ["sector", "one_day", "ytd", "market_cap",
                                                                "date", "market_name"]]), S.COMPANIES)
    assert out.columns == [f.name for f in S.COMPANIES.fields]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in S.COMPANIES.fields]
