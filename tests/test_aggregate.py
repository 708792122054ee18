import pytest
from pyspark.sql import functions as F

from tradelake.operators.aggregate import sum_prefixed


def test_sum_aggregates_correctly(fx1):
    r = sum_prefixed(fx1).collect()[0]
    assert r["qt_stat"] == 1500 and r["kg_net"] == 15000 and r["fob_usd"] == 150000


def test_sum_custom_prefixes_and_names(fx1):
    r = sum_prefixed(fx1, prefixes=["qt_", "fob_"])
    assert r.columns == ["qt_stat", "fob_usd"]
    row = r.collect()[0]
    assert (row["qt_stat"], row["fob_usd"]) == (1500, 150000)


def test_rendered_sum_example(spark):
    df = spark.createDataFrame([(100.0, 5000.0, 15000.0, 75000.0, 2000.0), (250.0, 12000.0, 38000.0, 190000.0, 5000.0),
                                (80.0, 3500.0, 10000.0, 50000.0, 1500.0)],
                               "qt_stat double, kg_net double, fob_usd double, fob_brl double, freight_usd double")
    assert tuple(sum_prefixed(df).collect()[0]) == (430, 20500, 63000, 315000, 8500)
    assert tuple(sum_prefixed(df, prefixes=["qt_", "fob_"]).collect()[0]) == (430, 63000, 315000)


def test_prefix_order_follows_prefixes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "fob_usd long, qt_stat long, fob_brl long")
    assert sum_prefixed(df, prefixes=["fob_", "qt_"]).columns == ["fob_usd", "fob_brl", "qt_stat"]


def test_null_poisons_sum_and_na_rm(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "g string, freight_usd long")
    out = {r["g"]: r["freight_usd"] for r in sum_prefixed(df, by="g").collect()}
    assert out == {"a": None, "b": 2}
    out = {r["g"]: r["freight_usd"] for r in sum_prefixed(df, by="g", na_rm=True).collect()}
    assert out == {"a": 1, "b": 2}


def test_mixed_directions_cif_null(spark):
    df = spark.createDataFrame([("2023-01", "imp", 10, 12), ("2023-01", "exp", 5, None)],
                               "m string, direction string, fob_usd long, cif_usd long")
    r = sum_prefixed(df, by="m").collect()[0]
    assert r["fob_usd"] == 15 and r["cif_usd"] is None


def test_zero_rows_sum_is_zero(spark):
    df = spark.createDataFrame([], "fob_usd long")
    assert sum_prefixed(df).collect()[0]["fob_usd"] == 0


def test_computed_group_key(spark):
    df = spark.createDataFrame([(160, 1), (10, 2), (None, 4)], "country_code int, fob_usd long")
    out = sum_prefixed(df, by=[(F.col("country_code") == 160).alias("china")])
    assert {r["china"]: r["fob_usd"] for r in out.collect()} == {True: 1, False: 2, None: 4}


def test_group_sums_add_up_to_total(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("g"), (F.col("id") * 3).alias("fob_usd"))
    parts = sum(r["fob_usd"] for r in sum_prefixed(df, by="g").collect())
    assert parts == sum_prefixed(df).collect()[0]["fob_usd"]


def test_no_match_raises(spark):
    with pytest.raises(ValueError):
        sum_prefixed(spark.createDataFrame([(1,)], "x long"))


def test_directions_add_up_to_total(spark):
    from tradelake.sources import testdata as td
    facts = td.trade_facts(spark, "/root/testdata/sf0.001")
    by_dir = sum_prefixed(facts, by="direction", prefixes=["qt_stat", "fob_usd"]).collect()
    total = sum_prefixed(facts, prefixes=["qt_stat", "fob_usd"]).collect()[0]
    assert sum(r["fob_usd"] for r in by_dir) == total["fob_usd"]
    assert sum(r["qt_stat"] for r in by_dir) == total["qt_stat"]


def test_scale_settings_follow_the_input():
    from tradelake.session import scale_settings
    for size in (1 << 30, 100 * 10**12, 1 << 50):
        n = int(scale_settings(size)["spark.sql.shuffle.partitions"])
        assert size / n <= 256 << 20 < size / (n - 1)
    assert int(scale_settings(1 << 40, 64 << 20)["spark.sql.shuffle.partitions"]) == 1 << 14
