import pytest
from pyspark.sql import functions as F

from tradelake.operators.deflate import deflate
from tradelake.operators.deflators import build_deflators, monthly_mid_rate, price_index
from tests.conftest import d

SCHEMA = "date date, ipca double, ipca_i double, brlusd double, cpi double"


def _defl(spark, rows=None):
    rows = rows or [(d("2023-01-01"), 0.5, 1.005, 5.0, 100.0), (d("2023-02-01"), 0.4, 1.00902, 5.1, 101.0),
                    (d("2023-03-01"), 0.3, 1.012047, 5.2, 102.0), (d("2023-04-01"), 0.2, 1.014071, 5.3, None)]
    return spark.createDataFrame(rows, SCHEMA)


def _data(spark):
    return spark.createDataFrame([(d("2023-01-01"), 1000), (d("2023-03-01"), 2000), (d("2023-06-01"), 7)],
                                 "date date, fob_usd long")


def test_base_date_per_series_and_identity(spark):
    out = {r["date"]: r for r in deflate(_data(spark), _defl(spark)).collect()}
    mar = out[d("2023-03-01")]
    assert mar["cpi_basedate"] == d("2023-03-01") and mar["ipca_basedate"] == d("2023-04-01")
    assert mar["fob_usd_deflated"] == 2000  # deflating at the CPI base date is the identity
    jan = out[d("2023-01-01")]
    assert jan["fob_usd_deflated"] == pytest.approx(1000 * 102.0 / 100.0)
    assert jan["fob_brl"] == pytest.approx(5000.0)
    assert jan["fob_brl_deflated"] == pytest.approx(5000.0 * 1.014071 / 1.005)


def test_date_after_last_deflator_kept_with_nulls(spark):
    out = {r["date"]: r for r in deflate(_data(spark), _defl(spark)).collect()}
    jun = out[d("2023-06-01")]
    assert jun["fob_usd"] == 7 and jun["fob_usd_deflated"] is None and jun["fob_brl"] is None


def test_column_order(spark):
    cols = deflate(_data(spark), _defl(spark)).columns
    assert cols == ["date", "fob_usd", "ipca", "ipca_i", "brlusd", "cpi", "cpi_r", "cpi_basedate", "ipca_r",
                    "ipca_basedate", "fob_usd_deflated", "fob_brl", "fob_brl_deflated"]


def test_existing_brl_column_is_deflated(spark):
    data = spark.createDataFrame([(d("2023-01-01"), 10.0)], "date date, imposto_nominal_brl double")
    r = deflate(data, _defl(spark)).collect()[0]
    assert r["imposto_nominal_brl_deflated"] == pytest.approx(10.0 * 1.014071 / 1.005)


def test_explicit_basedate(spark):
    r = {x["date"]: x for x in deflate(_data(spark), _defl(spark), basedate="2023-01-01").collect()}
    assert r[d("2023-01-01")]["fob_usd_deflated"] == 1000
    assert r[d("2023-01-01")]["fob_brl_deflated"] == pytest.approx(5000.0)


def test_missing_basedate_fails(spark):
    with pytest.raises(Exception, match="base date"):
        deflate(_data(spark), _defl(spark), basedate="2022-01-01").collect()


def test_duplicated_dates_fail(spark):
    rows = [(d("2023-01-01"), 0.5, 1.005, 5.0, 100.0), (d("2023-01-01"), 0.5, 1.005, 5.0, 100.0)]
    with pytest.raises(Exception, match="more than once|base date"):
        deflate(_data(spark), _defl(spark, rows)).collect()


def test_guards_hold_for_any_output(spark):
    out = deflate(_data(spark), _defl(spark), basedate="2022-01-01")
    for df in (out.select("fob_brl"), out.groupBy().count()):
        with pytest.raises(Exception, match="base date"):
            df.collect()


def test_empty_deflators_fail(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for df in (deflate(_data(spark), empty), deflate(_data(spark), empty).select("fob_usd")):
        with pytest.raises(Exception, match="base date"):
            df.collect()


def test_converted_column_in_the_input_is_an_error(spark):
    data = spark.createDataFrame([(d("2023-01-01"), 10, 999.0)], "date date, fob_usd long, fob_brl double")
    with pytest.raises(ValueError, match="fob_brl"):
        deflate(data, _defl(spark))


def test_strict_fails_on_a_fact_without_deflators(spark):
    with pytest.raises(Exception, match="No complete deflators"):
        deflate(_data(spark), _defl(spark), strict=True).collect()


def test_price_index_cumulative_product(spark):
    df = spark.createDataFrame([(d("2023-01-01"), 1.0), (d("2023-02-01"), 2.0), (d("2023-03-01"), None),
                                (d("2023-04-01"), 1.0)], "date date, ipca double")
    got = [r["ipca_i"] for r in price_index(df).orderBy("date").collect()]
    assert got[0] == pytest.approx(1.01) and got[1] == pytest.approx(1.01 * 1.02)
    assert got[2] is None and got[3] is None


def test_monthly_mid_rate_null_rule(spark):
    q = spark.createDataFrame([(d("2023-01-02"), 5.0, 5.2), (d("2023-01-03"), 5.2, 5.4), (d("2023-02-01"), None, 5.0)],
                              "date date, bid double, ask double")
    got = {r["date"]: r["brlusd"] for r in monthly_mid_rate(q, start="2023-01-01", to="2023-12-31").collect()}
    assert got[d("2023-01-01")] == pytest.approx((5.1 + 5.3) / 2) and got[d("2023-02-01")] is None


def test_build_deflators_full_join(spark):
    ipca = spark.createDataFrame([(d("2023-01-01"), 1.0), (d("2023-02-01"), 1.0)], "date date, ipca double")
    cpi = spark.createDataFrame([(d("2023-02-01"), 100.0), (d("2023-03-01"), 101.0)], "date date, cpi double")
    q = spark.createDataFrame([(d("2023-01-05"), 5.0, 5.0)], "date date, bid double, ask double")
    full = build_deflators(ipca, q, cpi, start="2023-01-01", to="2023-12-31")
    assert full.count() == 3
    assert build_deflators(ipca, q, cpi, start="2023-01-01", to="2023-12-31", na_omit=True).count() == 0
