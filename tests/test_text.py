"""Scalar string functions: FIXTURES.md §3.1-3.3, 3.6, 3.7."""
import math

from conftest import one_col
from quotemill import schemas as S
from quotemill.functions import text as X
from pyspark.sql import functions as F


def test_strip_removes_every_python_whitespace(spark):
    ws = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    assert len(ws) == 29
    out = one_col(spark, [ws + "x y" + ws, "​x"], X.strip)
    assert out == ["x y", "​x"]  # zero-width space is not whitespace


def test_strip_or_default(spark):
    vals = [None, "", "   ", " x ", " Bank "]
    assert one_col(spark, vals, X.strip_or_default) == ["N/A", "N/A", "", "x", "Bank"]


def test_paren_group(spark):
    vals = ["Nairobi (NSE)", "A (x) (y)", "BRVM", "()", "", None, "a(b\nc)", "a(b\rc)"]
    out = one_col(spark, vals, X.paren_group)
    assert out == ["NSE", "x", S.SENTINEL_ABBREVIATION, "", "", None, S.SENTINEL_ABBREVIATION, "b\rc"]


def _num(spark, vals, sentinel, pct):
    rows = one_col(spark, vals, lambda c: X.to_number(c, sentinel, pct))
    return [(r["value"], r["error"]) for r in rows]


def test_index_numbers(spark):
    out = _num(spark, ["74,097.94", "Data not found", "", None, "N/A", ","], S.SENTINEL_DATA, False)
    assert out == [(74097.94, None), (None, None), (None, None), (None, None),
                   (None, "not_a_number"), (None, None)]
    pct = _num(spark, ["-1,190.44", "Change not found", "-0.41%"], S.SENTINEL_CHANGE, False)
    assert pct == [(-1190.44, None), (None, None), (None, "not_a_number")]


def test_company_numbers(spark):
    out = _num(spark, ["+2,287.39%", "%", ",", "N/A"], S.SENTINEL_COMPANY, True)
    assert out == [(2287.39, None), (None, None), (None, None), (None, None)]
    price = _num(spark, ["-", "1e5", ".5", "5.", "+1.82", "1.0d", "1f", "0x10", "inf", "-Infinity", " 12 "],
                 S.SENTINEL_COMPANY, False)
    assert price == [(None, "not_a_number"), (100000.0, None), (0.5, None), (5.0, None), (1.82, None),
                     (None, "not_a_number"), (None, "not_a_number"), (None, "not_a_number"),
                     (None, "not_finite"), (None, "not_finite"), (12.0, None)]
    nan = _num(spark, ["nan"], S.SENTINEL_COMPANY, False)[0]
    assert math.isnan(nan[0]) and nan[1] is None


def test_after_last(spark):
    vals = ["As of 03-Apr-2024", "x As of y As of 04-Apr-2024", "04-Apr-2024", None]
    assert one_col(spark, vals, X.after_last) == ["03-Apr-2024", "04-Apr-2024", "04-Apr-2024", None]


def test_nth_or_positions(spark):
    df = spark.createDataFrame([(0, [" ", "74,097.94"]), (1, ["144.47"]), (2, [])], "i int, a array<string>")
    rows = df.orderBy("i").select(X.nth_or("a", 0, S.SENTINEL_DATA), X.nth_or("a", 1, S.SENTINEL_DATA)).collect()
    assert [tuple(r) for r in rows] == [("", "74,097.94"), ("144.47", S.SENTINEL_DATA),
                                        (S.SENTINEL_DATA, S.SENTINEL_DATA)]


def test_first_nonempty(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, None), (None, "")], "x string, y string")
    assert [r[0] for r in df.select(X.first_nonempty("x", "y")).collect()] == ["a", "b", None, ""]


def test_date_keys(spark):
    df = spark.createDataFrame([("2024-04-03 10:11:12",)], "t string").select(F.to_timestamp("t").alias("t"))
    r = df.select(X.date_key("t"), X.run_stamp("t")).first()
    assert tuple(r) == ("20240403", "20240403101112")


def test_numbers_as_float_reads_them(spark):
    texts = ["1_000", "1_0.2_5e1_0", "٣", "३.५", "𝟎𝟏", "_1", "1_", "1__0", "1_.5", "1._5", "1e_5", "1.5e5_", "٣_٣", "　1 ",
             "²", "½", "一", "1_000_000", "n_an", "in_f", "+_1", "0x1_0"]

    def read(t):
        try:
            return float(t)
        except ValueError:
            return None
    got = one_col(spark, texts, lambda c: X.to_number(c, "none"))
    assert [r["value"] for r in got] == [read(t) for t in texts]
    assert all((r["value"] is None) == (r["error"] == "not_a_number") for r in got)
