from pyspark.sql import functions as F

from tradelake.plans import reports
from tests.conftest import d


def test_balance_one_side_missing(spark):
    df = spark.createDataFrame([("exp", d("2023-01-01"), 3e9), ("imp", d("2023-01-01"), 1e9),
                                ("exp", d("2023-02-01"), 2e9)], "direction string, date date, v double")
    got = {r["date"]: r["b"] for r in reports.balance(df, "v", "b").collect()}
    assert got == {d("2023-01-01"): 2.0, d("2023-02-01"): None}
    assert reports.balance(df, "v", "b", na_omit=True).count() == 1


def test_incomplete_year_dropped(spark):
    rows = [(2022, d(f"2022-{m:02d}-01"), 1) for m in range(1, 13)] + [(2023, d("2023-08-01"), 5)]
    y = reports.yearly_complete(spark.createDataFrame(rows, "year int, date date, fob_usd long"))
    assert [(r["year"], r["fob_usd"]) for r in y.collect()] == [(2022, 12)]


def test_zero_divisor_gives_null(spark):
    df = spark.createDataFrame([(2023, "imp", 0, 5)], "year int, direction string, fob_usd long, freight_usd long")
    assert reports.freight_share_by_year(df).collect()[0]["p"] is None


def test_peak_month_ties_keep_earliest(spark):
    df = spark.createDataFrame([("exp", d("2023-02-01"), 5.0), ("exp", d("2023-01-01"), 5.0),
                                ("exp", d("2023-03-01"), None)], "direction string, date date, v double")
    assert reports.peak_month(df, "v").collect()[0]["date"] == d("2023-01-01")


def test_fiscal_long_from_sheet_lines(spark):
    rows = [("JAN", 1.0, 2.0, 1), ("FEV", 3.0, 4.0, 2), ("TOTAL", 4.0, 6.0, 13), ("JAN", 5.0, 6.0, 14)]
    sheet = spark.createDataFrame(rows, "mes string, i_renda double, total_geral double, line int")
    out = reports.fiscal_long(sheet, 2020)
    got = sorted((r["date"], r["arrecadacao_categoria"], r["imposto_brl"]) for r in out.collect())
    assert got[0] == (d("2020-01-01"), "i_renda", 1e6) and (d("2021-01-01"), "total_geral", 6e6) in got
    assert out.count() == 6


def test_same_month_as_latest(spark):
    df = spark.createDataFrame([(d("2022-03-01"),), (d("2022-04-01"),), (d("2023-03-01"),)], "date date")
    assert sorted(r["date"] for r in reports.same_month_as_latest(df).collect()) == [d("2022-03-01"), d("2023-03-01")]


def test_ordered_nulls_last(spark):
    from tradelake.plans.presentation import ordered
    df = spark.createDataFrame([(d("2023-02-01"),), (None,), (d("2023-01-01"),)], "date date")
    assert [r["date"] for r in ordered(df).collect()] == [d("2023-01-01"), d("2023-02-01"), None]
