"""Every registered query against its DuckDB oracle on the smallest scale factor."""
import math

import duckdb
import pytest

import __spark_entry__ as entry
from checks.oracle import ORACLE
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(map(lambda x: repr(_norm(x)), r)) for r in pdf[cols].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["company_name", "sector", "price", "one_day", "ytd", "market_cap", "date", "market_name"]
