"""Maps: FIXTURES.md §3.5 (zip, last key wins, empty)."""
import random

from quotemill.functions import maps as M


def _zip(spark, keys, values):
    df = spark.createDataFrame([(keys, values)], "k array<string>, v array<string>")
    r = df.select(M.map_json(M.zip_map("k", "v")).alias("j"), M.zip_map("k", "v").alias("m")).first()
    return r["m"], r["j"]


def test_zip_truncates_to_shorter(spark):
    assert _zip(spark, ["1M", "3M"], ["a", "b", "c"])[0] == {"1M": "a", "3M": "b"}


def test_zip_last_duplicate_wins_first_position_kept(spark):
    m, j = _zip(spark, ["1M", "3M", "1M"], ["a", "b", "c"])
    assert m == {"1M": "c", "3M": "b"}
    assert j == '{"1M":"c","3M":"b"}'


def test_zip_empty(spark):
    assert _zip(spark, [], []) == ({}, "{}")


def test_dict_literal(spark):
    df = spark.createDataFrame([("{'1M': '+1.82%', 'YTD': '-3.64%'}",)], "s string")
    assert df.select(M.parse_dict_literal("s")).first()[0] == {"1M": "+1.82%", "YTD": "-3.64%"}


def test_dict_literal_of_python(spark):
    vals = [r"{'a': None, 'b': 'it\'s', 'c': 'x\xa0y'}", """{'a': "None, 'b': None", 'N': 'None'}""", r"{'a': 'b\\x41'}"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(M.parse_dict_literal("s")).collect()] == [
        {"a": None, "b": "it's", "c": "x\u00a0y"}, {"a": "None, 'b': None", "N": "None"}, {"a": "b\\x41"}]


def _literals(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    rows = df.select("i", M.dict_literal("s").alias("d")).orderBy("i").collect()
    return [(r.d["value"], r.d["error"]) for r in rows]


def test_dict_literal_of_other_values(spark):
    texts = ["{'a': True, 'n': 1.5, 'b': False, 'z': None}", "{'n': -1_000.5e+3, 'm': .5,}", "{}", " { } ",
             r"{u'a': r'\n', 'b': '\n\t\101é\U0001f1ff', 'c': '\q'}", '{"a": true, "f": "\\ud83c\\uddff"}',
             "{'a': '1', 'a': '2'}", '{"a": {"b": [1, 2]}, "c": 1}', '{"a" : "}, {", \'b\':\'x: "y"\'}']
    assert _literals(spark, texts) == [
        ({"a": "true", "n": "1.5", "b": "false", "z": None}, None), ({"n": "-1000.5e+3", "m": ".5"}, None),
        ({}, None), ({}, None), ({"a": "\\n", "b": "\n\tAé\U0001f1ff", "c": "\\q"}, None),
        ({"a": "true", "f": "\U0001f1ff"}, None), ({"a": "2"}, None), ({"a": '{"b":[1,2]}', "c": "1"}, None),
        ({"a": "}, {", "b": 'x: "y"'}, None)]


def test_dict_literal_refuses_with_the_place(spark):
    texts = [None, "", " \n", "x", "{'a': 1", "{'a': 1, 'b': }", "{'a': 1} x", "{'a' 'b': 1}", "{'a': b'x'}", "{1: 'a'}",
             "{'a': {'b': 1}}", "{'a': 1__0}", "{'a': 'b\nc'}", "[1]", "{,}", "{'a': Truex}", "{'a': '''b'''}", '{"a": [1}']
    got = _literals(spark, texts)
    assert got[0] == (None, None) and got[1] == got[2] == (None, "empty")
    assert all(v is None for v, _ in got) and got[5][1] == "not_a_dict@8"
    assert all(e == "not_a_dict@0" for i, (_, e) in enumerate(got) if i > 2 and i != 5)


def test_dict_literal_reads_what_python_writes(spark):
    rng = random.Random(7)
    chars = "ab'\"\\\n\t{}:,é\xa0🇿 nNone\x00\x7f"

    def text():
        return "".join(rng.choice(chars) for _ in range(rng.randrange(9)))
    values = [text, text, lambda: None, lambda: rng.random() < 0.5, lambda: rng.randrange(-10**6, 10**6),
              lambda: rng.uniform(-1e9, 1e9) * 10.0 ** rng.randrange(-20, 20)]
    made = [{text(): rng.choice(values)() for _ in range(rng.randrange(7))} for _ in range(400)]
    made.append({f"key {i}": "v" * 50 for i in range(5000)})
    made.append({"long": "it's \\ " * 20000})
    want = [{k: v if v is None or isinstance(v, str) else str(v).lower() if isinstance(v, bool) else repr(v)
             for k, v in d.items()} for d in made]
    assert _literals(spark, [repr(d) for d in made]) == [(w, None) for w in want]
