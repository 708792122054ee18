import pytest
from pyspark.sql import functions as F

from tradelake.functions.codes import check_codes, clean_code


def _one(spark, value, nchar=8):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(clean_code("x", nchar).alias("y")).collect()[0]["y"]


def test_cleans_codes(spark):
    assert _one(spark, "0101.2100") == "01012100"
    assert _one(spark, "20-01.10-00") == "20011000"
    assert _one(spark, "abc123def456", nchar=None) == "123456"
    assert _one(spark, "abc123def45678") == "12345678"


@pytest.mark.parametrize("bad", ["1234567", "abc1"])
def test_validates_codes(spark, bad):
    with pytest.raises(Exception, match="Not all NCMs valid or NA!"):
        _one(spark, bad)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([("01012100",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(clean_code("x", 8)).collect()] == ["01012100", None, None]


def test_text_without_digits_is_null_and_passes(spark):
    assert _one(spark, "invalid code") is None
    assert _one(spark, "invalid code", nchar=None) is None


def test_report_mode_flags(spark):
    df = spark.createDataFrame([("0101.2100",), ("12",), (None,)], "x string")
    out = check_codes(df, "x", strict=False).collect()
    assert [(r["x"], r["code_valid"]) for r in out] == [("01012100", True), ("12", False), (None, True)]
