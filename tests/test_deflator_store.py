"""The persisted deflator table: one per state of the series, checked while it is written."""
import warnings

import pytest

import __spark_entry__ as E
from tradelake.operators.deflator_store import persist_deflators, series_state, stored_deflators
from tradelake.operators.deflators import DUPLICATED
from tradelake.session import scratch_path

SF = "/root/testdata/sf0.001"
SCHEMA = "date string, ipca double, ipca_i double, brlusd double, cpi double"


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("to_date(date) as date", "ipca", "ipca_i", "brlusd", "cpi")


def test_built_once_per_state(spark, tmp_path):
    store, built = scratch_path(spark, "defl"), []

    def build(v):
        return lambda: built.append(v) or _table(spark, [("2020-01-01", 1.0, 1.01, v, 100.0)])
    assert persist_deflators(spark, store, "one", build(5.0)).first()["brlusd"] == 5.0
    assert persist_deflators(spark, store, "one", build(6.0)).first()["brlusd"] == 5.0
    assert persist_deflators(spark, store, "two", build(7.0)).first()["brlusd"] == 7.0
    assert stored_deflators(spark, store, "one").first()["brlusd"] == 5.0 and built == [5.0, 7.0]
    assert stored_deflators(spark, store, "three") is None


def test_state_follows_the_files(spark, tmp_path):
    f = tmp_path / "cpi.csv"
    f.write_text("date,cpi\n")
    first = series_state(spark, [str(f)], "2020-01")
    assert first == series_state(spark, [str(f)], "2020-01") != series_state(spark, [str(f)], "2020-02")
    f.write_text("date,cpi\n2020-01-01,1\n")
    assert series_state(spark, [str(f)], "2020-01") != first
    with pytest.raises(ValueError):
        series_state(spark, [str(tmp_path / "absent")])


def test_repeated_dates_fail_and_gaps_warn(spark):
    store = scratch_path(spark, "defl")
    with pytest.raises(ValueError, match=DUPLICATED):
        persist_deflators(spark, store, "a", lambda: _table(spark, [("2020-01-01", 1.0, 1.0, 1.0, 1.0)] * 2))
    assert stored_deflators(spark, store, "a") is None
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        persist_deflators(spark, store, "b", lambda: _table(spark, [("2020-01-01", 1.0, 1.0, None, 1.0), ("2020-02-01", 1.0, 1.0, 1.0, 1.0)]))
    assert any("1 of 2 months" in str(w.message) for w in said)


def test_reports_read_the_table_not_the_quotes(spark, monkeypatch):
    monkeypatch.setattr(E, "_DEFLATOR_STORES", {})
    plan = lambda: E._deflators(spark, SF)._jdf.queryExecution().executedPlan().toString()
    before = sorted(map(tuple, E._deflators(spark, SF).collect()))
    assert "o_totalprice" in plan()
    E.persist_series(spark, SF)
    assert "o_totalprice" not in plan() and "Window" not in plan()
    assert sorted(map(tuple, E._deflators(spark, SF).collect())) == before
