"""Property tests: column functions against the Python behaviour they reproduce."""
import json
import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quotemill import schemas as S
from quotemill.functions import maps as M
from quotemill.functions import text as X

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

WS = [c for c in map(chr, range(0x3001)) if c.isspace()]
texty = st.text(alphabet=st.sampled_from(list("ab (),.%-+e") + WS[:6] + ["é", "\n", "\r"]), max_size=12)

digits = st.text(alphabet="0123456789", min_size=1, max_size=4)
number_like = st.one_of(
    st.builds(lambda s, a, b, e: f"{s}{a}.{b}{e}", st.sampled_from(["", "+", "-"]), digits, digits,
              st.sampled_from(["", "e5", "E-2", "e+1"])),
    st.builds(lambda s, a: f"{s}{a}", st.sampled_from(["", "-", " "]), digits),
    st.sampled_from(["nan", "NaN", "inf", "-Infinity", ".5", "5.", "1.0d", "1f", "0x10", "1e", "e5", "--1",
                     "1..2", " 7 ", "+", "", "1 2"]),
)


def _collect(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(df["v"])).collect()]


def _py_float(t):
    try:
        v = float(t)
    except ValueError:
        return None, "not_a_number"
    if math.isinf(v):
        return None, "not_finite"
    return v, None


@SETTINGS
@given(st.lists(texty, min_size=1, max_size=40))
def test_strip_matches_python(spark, values):
    assert _collect(spark, values, X.strip) == [v.strip() for v in values]


@SETTINGS
@given(st.lists(texty, min_size=1, max_size=40))
def test_paren_group_matches_python(spark, values):
    def py(v):
        if not v:
            return v
        m = re.search(r"\((.*?)\)", v)
        return m.group(1) if m else S.SENTINEL_ABBREVIATION
    assert _collect(spark, values, X.paren_group) == [py(v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("As of xy 0-9") + [" "]), max_size=20), min_size=1, max_size=20))
def test_after_last_matches_python(spark, values):
    assert _collect(spark, values, X.after_last) == [v.split("As of")[-1].strip() for v in values]


@SETTINGS
@given(st.lists(number_like, min_size=1, max_size=40))
def test_to_number_matches_python_float(spark, values):
    got = _collect(spark, values, lambda c: X.to_number(c, S.SENTINEL_COMPANY, False))
    for v, r in zip(values, got):
        t = v.replace(",", "")
        want = (None, None) if not t else _py_float(t)
        value, error = r["value"], r["error"]
        if want[0] is not None and math.isnan(want[0]):
            assert value is not None and math.isnan(value) and error is None, v
        else:
            assert (value, error) == want, v


@SETTINGS
@given(st.lists(st.tuples(st.lists(st.sampled_from(["1M", "3M", "YTD", "1Y"]), max_size=6),
                          st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=6)), min_size=1, max_size=10))
def test_zip_map_matches_dict_zip(spark, pairs):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(pairs)],
                               "i int, k array<string>, v array<string>")
    got = [r[0] for r in df.orderBy("i").select(M.zip_map("k", "v")).collect()]
    want = [dict(zip(k, v)) for k, v in pairs]
    assert got == want
    # Insertion order of the first occurrence, as a Python dict keeps it.  Checked
    # through the JSON text: collecting a map into a Python dict reorders keys.
    texts = [r[0] for r in df.orderBy("i").select(M.map_json(M.zip_map("k", "v"))).collect()]
    assert [list(json.loads(t).keys()) for t in texts] == [list(d.keys()) for d in want]
