"""Every registered query against its DuckDB oracle on the smallest scale."""
import os
from collections import Counter

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    si = [df.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    def norm(v):
        return repr(v) if isinstance(v, float) else v  # -0.0 and 0.0 differ, as in a text hash
    s = Counter(tuple(norm(r[i]) for i in si) for r in df.collect())
    o = Counter(tuple(norm(r[i]) for i in di) for r in rel.fetchall())
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    measures = ["qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd", "cif_usd"]
    assert df.columns == ["direction", "date", *measures, *[f"{m}_12" for m in measures]]
    assert [f.dataType.simpleString() for f in df.schema.fields] == \
        ["string", "date"] + ["bigint"] * 6 + ["double"] * 6
