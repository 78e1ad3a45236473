"""Writers, readers and audits: G1-G9, A3-A8, F8, H1 invariants."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators import audit as A
from quotemill.sinks import writers as W
from quotemill.sources import readers as R

SCHEMA = "id bigint, k bigint, v double"


def test_assign_ids_dense_across_partitions(spark, scratch):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("k"), (F.col("id") * 1.5).alias("v"))
    df = df.repartition(5, "k")
    out = W.assign_ids(df, 11)
    r = out.agg(F.count("*"), F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(r) == (1000, 11, 1010, 1000)


def test_append_with_ids_continues_after_max(spark, scratch):
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(SCHEMA)
    path = scratch("hist")
    a = spark.range(0, 30).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    W.append_with_ids(spark, a, path, schema)
    W.append_with_ids(spark, a, path, schema)
    r = spark.read.parquet(path).agg(F.count("*"), F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(r) == (60, 1, 60, 60)


def test_land_overwrites_only_its_date_and_writes_nulls(spark, scratch):
    base = scratch("land")
    df = spark.createDataFrame([(1, None, float("nan"), {"a": "b"})], "id long, s string, d double, m map<string,string>")
    W.land(df, base, "t", "2024-04-03")
    W.land(df, base, "t", "2024-04-04")
    W.land(df, base, "t", "2024-04-04")
    lines = spark.read.text(R.landing_path(base, "t")).collect()
    assert len(lines) == 2
    assert lines[0].value == '{"id":1,"s":null,"d":null,"m":{"a":"b"}}'


def test_truncate_load_strict_types(spark, scratch):
    base = scratch("load")
    good = spark.createDataFrame([(1, "x", 2.5)], "id long, company_name string, price double")
    W.land(good, base, "companies", "2024-04-03")
    out = W.truncate_load(spark, base, "companies", "2024-04-03", S.COMPANIES, scratch("wh"))
    assert out.count() == 1 and out.first().price == 2.5
    bad = spark.createDataFrame([(1, "x", "cheap")], "id long, company_name string, price string")
    W.land(bad, base, "companies", "2024-04-05")
    with pytest.raises(Exception):
        W.truncate_load(spark, base, "companies", "2024-04-05", S.COMPANIES, scratch("wh")).count()


def test_unexpected_fields_and_file_audits(spark, scratch):
    base = scratch("drift")
    spark.createDataFrame([(1, "x", "extra"), (2, "y", None)], "id long, company_name string, note string") \
        .write.json(base)
    assert [tuple(r) for r in A.unexpected_fields(spark, base, S.COMPANIES).collect()] == [("note", 1)]
    rows = {r.check: (r.value, r.flag) for r in A.audit_text(spark, base, "c").collect()}
    assert rows == {"landed_rows": (2, False), "landed_blank": (0, False)}
    files = {r.check: (r.value, r.flag) for r in A.audit_files(spark, base, "c").collect()}
    assert files["landed_empty"] == (0, False) and files["landed_files"][0] >= 1


def test_retention_split(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 31)], "ds date")
    run = dt.date(2024, 1, 30)
    kept, gone = W.retained(df, "ds", run, 13), W.expired(df, "ds", run, 13)
    assert kept.count() == 13 and gone.count() == 17
    assert kept.agg(F.min("ds")).first()[0] == dt.date(2024, 1, 18)


def test_feed_csv_roundtrip(spark, scratch):
    path = scratch("feed")
    df = spark.createDataFrame([("JSE", {"1M": "+1.82%"}, "a,b \"q\"")], "abbr string, m map<string,string>, t string")
    W.write_feed_csv(df, path)
    back = R.read_feed_csv(spark, path, "abbr string, m string, t string").first()
    assert (back.abbr, back.m, back.t) == ("JSE", '{"1M":"+1.82%"}', 'a,b "q"')


CELLS = ["plain", "a,b \"q\"", "two\nlines", "\n", "", None, "\"", "\"\"\n\"x", "é\r\nü,\n\n\n", "long\n" * 120 + "end", "x" * 500]


@pytest.mark.parametrize("split", ["200", "2k", "1m"])
def test_csv_is_read_in_splits(spark, scratch, split):
    path = scratch("feed")
    rows = [(f"k{i:04d}", CELLS[(i * i + i // 7) % len(CELLS)], f"t{i}") for i in range(66)]
    (spark.createDataFrame(rows, "a string, b string, c string").coalesce(2).write.option("header", True)
     .options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        back = R.read_feed_csv(spark, path, "a string, b string, c string")
        # Spark reads an empty cell as null, quoted or not.
        assert sorted(map(tuple, back.collect())) == [(a, b or None, c) for a, b, c in rows]
        assert spark.read.text(path).rdd.getNumPartitions() > {"200": 30, "2k": 3, "1m": 0}[split]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_csv_edges(spark, scratch):
    path = scratch("edges")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w", newline="") as f:
        f.write('\r\n"h\r\n1",h2\r\n"x\r\ny",1\r\n\r\n ,2\r\nz\r\n')
    with open(f"{path}/b.csv", "w", newline="") as f:
        f.write('h1,h2')
    open(f"{path}/c.csv", "w").close()
    back = R.read_feed_csv(spark, path, "p string, q string")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, back.collect()), key=key) == sorted([("x\r\ny", "1"), (" ", "2"), ("z", None)], key=key)
    with open(f"{path}/b.csv", "w") as f:
        f.write('h1,h2\n"x\n\ny",1\n\n,2\n"z ""\nq"\n')
    split, whole = (R.read_feed_csv(spark, f"{path}/b.csv", "p string, q string", max_splits=n) for n in (1, 0))
    assert sorted(map(tuple, split.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key) and whole.count() == 3
    assert R.read_feed_csv(spark, f"{path}/b.csv").columns == ["h1", "h2"]


def test_row_counts(spark):
    a, b = spark.range(3), spark.range(5)
    assert sorted(tuple(r) for r in A.row_counts(a=a, b=b).collect()) == [("a", 3), ("b", 5)]


def test_ids_do_not_depend_on_split_size(spark, scratch):
    path = scratch("files")
    spark.range(0, 5000, 1, 5).write.parquet(path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        out = W.assign_ids(spark.read.parquet(path), 3, "new", stable_input=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        rows = out.select("new", "id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert sorted(r["new"] for r in rows) == list(range(3, 5003)) and len({r["id"] for r in rows}) == 5000


def test_refused_load_keeps_the_table(spark, scratch):
    from pyspark.sql import types as T
    schema, base, dest = T.StructType().add("a", "long"), scratch("land"), scratch("wh")
    W.land(spark.createDataFrame([(1,)], "a long"), base, "t", "2024-04-03")
    W.truncate_load(spark, base, "t", "2024-04-03", schema, dest)
    W.land(spark.createDataFrame([(2, "x")], "a long, note string"), base, "t", "2024-04-04")
    W.land(spark.createDataFrame([("x",)], "a string"), base, "t", "2024-04-05")
    for day in ("2024-04-04", "2024-04-05"):
        with pytest.raises(Exception):
            W.truncate_load(spark, base, "t", day, schema, dest)
        assert [r["a"] for r in R.read_table(spark, dest, schema).collect()] == [1]


def test_load_that_fails_before_the_switch_keeps_the_table(spark, scratch, monkeypatch):
    from pyspark.sql import types as T
    schema, base, dest = T.StructType().add("a", "long"), scratch("land"), scratch("wh")
    assert R.read_table(spark, dest, schema).count() == 0

    def load(day, value):
        W.land(spark.createDataFrame([(value,)], "a long"), base, "t", day)
        return W.truncate_load(spark, base, "t", day, schema, dest)
    held = load("2024-04-03", 1)
    with monkeypatch.context() as m:
        def lost(*_):
            raise OSError("lost")
        m.setattr(W, "_rename", lost)
        with pytest.raises(OSError):
            load("2024-04-04", 2)
    assert [r.a for r in R.read_table(spark, dest, schema).collect()] == [1]
    assert [r.a for r in load("2024-04-05", 3).collect()] == [3]
    assert [r.a for r in held.collect()] == [1]  # the version before stays
    load("2024-04-06", 4)
    assert R.table_versions(spark, dest) == [2, 3]
    assert [r.a for r in R.read_table(spark, dest, schema).collect()] == [4]


def test_batches_append_once(spark, scratch, monkeypatch):
    from pyspark.sql.types import _parse_datatype_string
    schema, path = _parse_datatype_string(SCHEMA), scratch("hist")
    a = spark.range(0, 30).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))

    def state():
        r = R.read_history(spark, path, schema).agg(F.count("*"), F.min("id"), F.max("id"), F.countDistinct("id")).first()
        return tuple(r)
    assert W.append_with_ids(spark, a, path, schema, batch="20240403") and state() == (30, 1, 30, 30)
    assert not W.append_with_ids(spark, a, path, schema, batch="20240403") and state() == (30, 1, 30, 30)
    with monkeypatch.context() as m:  # rows are written, their record is not
        m.setattr(W, "BATCH", "no such schema")
        with pytest.raises(Exception):
            W.append_with_ids(spark, a, path, schema, batch="20240404")
    assert W.append_with_ids(spark, a.limit(20), path, schema, batch="20240404") and state() == (50, 1, 50, 50)
    assert W.append_with_ids(spark, a.limit(0), path, schema, batch="20240405")
    assert W.append_with_ids(spark, a, path, schema) and state() == (80, 1, 80, 80)
    got = sorted(tuple(r) for r in W.recorded_batches(spark, path).collect())
    assert got == [("20240403", 1, 30), ("20240404", 31, 20), ("20240405", 51, 0)]


def test_expired_partitions_are_removed(spark, scratch):
    import os
    base = scratch("land")
    for ds in ("2024-03-21", "2024-03-22", "2024-03-23", "2024-04-04"):
        W.land(spark.createDataFrame([(ds,)], "a string"), base, "t", ds)
    os.mkdir(f"{R.landing_path(base, 't')}/ds=latest")
    os.mkdir(f"{R.landing_path(base, 't')}/notes")
    got = sorted(tuple(r) for r in W.remove_expired(spark, base, "t", "2024-04-04").collect())
    assert got == [("20240321", True), ("20240322", True), ("20240323", False), ("20240404", False)]
    assert sorted(r.a for r in spark.read.json(R.landing_path(base, "t")).collect()) == ["2024-03-23", "2024-04-04"]
    assert sorted(n for n in os.listdir(R.landing_path(base, "t")) if n[0] not in "._") == [
        "ds=20240323", "ds=20240404", "ds=latest", "notes"]
    assert not any(r.removed for r in W.remove_expired(spark, base, "t", "2024-04-04").collect())
    assert W.remove_expired(spark, base, "nothing", "2024-04-04").count() == 0


def test_refused_load_names_its_lines_and_scans_once(spark, scratch):
    import os
    base, dest = scratch("land"), scratch("wh")
    folder = R.landing_path(base, "companies", "2024-04-03")
    lines = ['{"id":1,"price":2.5}', "", '{"id":2,"Id":3}', '{"id":"x"}', "nonsense", '{"id":4,"price":null}', "[1]"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(folder)
    read = R.checked_landed(spark, folder, S.COMPANIES)
    assert read._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    got = {(r.id, r.refused, r.line) for r in read.collect() if r.refused}
    assert got == {(2, "unknown_fields:Id", lines[2]), (None, "wrong_type", lines[3]),
                   (None, "not_an_object", lines[4]), (None, "not_an_object", lines[6])}
    with pytest.raises(ValueError, match="unknown_fields:Id"):
        W.truncate_load(spark, base, "companies", "2024-04-03", S.COMPANIES, dest)
    assert not os.path.exists(dest) or os.listdir(dest) == []
    spark.createDataFrame([], "value string").write.mode("overwrite").text(folder)
    assert W.truncate_load(spark, base, "companies", "2024-04-03", S.COMPANIES, dest).count() == 0


def test_audited_sizes(spark, scratch):
    base = scratch("sizes")
    spark.createDataFrame([("é",), ("",)], "value string").coalesce(1).write.text(base)
    rows = {r.check: (r.value, r.flag) for r in A.audit_files(spark, base, "c", sizes=True).collect()}
    assert rows == {"landed_files": (1, False), "landed_empty": (0, False), "landed_bytes": (4, False)}
    rows = {r.check: (r.value, r.flag) for r in A.audit_text(spark, base, "c", sizes=True).collect()}
    assert rows == {"landed_rows": (2, False), "landed_blank": (0, False), "landed_chars": (3, False)}


def test_feed_cells_are_refused_not_lost(spark):
    from quotemill.operators import validate as V
    feed = spark.createDataFrame([(1, "{'a': 'b'}", None), (2, "{'a'", "  "), (3, "{}", "{'n': 1}")], "i int, p string, q string")
    rows = V.stage_literals(feed, ("p", "q")).orderBy("i").collect()
    assert [(r["_t_p"], r["_t_q"], r.reject_reason) for r in rows] == [
        ({"a": "b"}, {}, None), (None, None, "p:not_a_dict@0;q:empty"), ({}, {"n": "1"}, None)]
