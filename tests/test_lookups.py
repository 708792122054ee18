import pytest

from tradelake.operators.lookups import merge_lookups, partner_labels


def test_natural_merge_all_strings(spark):
    a = spark.createDataFrame([("01012100", 1, "A")], "co_ncm string, co_unid int, co_cgce_n3 string")
    b = spark.createDataFrame([("A", "Cars")], "co_cgce_n3 string, no_cgce_n3_ing string")
    c = spark.createDataFrame([(1, "KG")], "co_unid int, no_unid string")
    m = merge_lookups([a, b, c], check_unique=True)
    assert m.columns == ["co_ncm", "co_unid", "co_cgce_n3", "no_cgce_n3_ing", "no_unid"]
    assert tuple(m.collect()[0]) == ("01012100", "1", "A", "Cars", "KG")


def test_duplicate_lookup_key_fails(spark):
    a = spark.createDataFrame([("01012100", "A")], "co_ncm string, co_cgce_n3 string")
    b = spark.createDataFrame([("A", "Cars"), ("A", "Autos")], "co_cgce_n3 string, no_cgce_n3_ing string")
    assert merge_lookups([a, b]).count() == 2  # unchecked: the row fans out
    with pytest.raises(Exception, match="Lookup key is not unique"):
        merge_lookups([a, b], check_unique=True).collect()


def test_null_keys_match_null_keys(spark):
    a = spark.createDataFrame([("1", None), ("2", "A")], "co_ncm string, co_cgce_n3 string")
    b = spark.createDataFrame([(None, "unknown"), ("A", "Cars")], "co_cgce_n3 string, no_cgce_n3_ing string")
    got = {r["co_ncm"]: r["no_cgce_n3_ing"] for r in merge_lookups([a, b], check_unique=True).collect()}
    assert got == {"1": "unknown", "2": "Cars"}


def test_partner_labels_no_fan_out(spark):
    countries = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "country_code int, country_name string")
    blocks = spark.createDataFrame([(1, 10, "Bloc X"), (1, 20, "Bloc Y"), (2, 20, "Bloc Y"), (3, 30, "Other")],
                                   "country_code int, block_code int, block_name string")
    got = {r["country_code"]: r["partner"] for r in partner_labels(countries, blocks, [10, 20]).collect()}
    assert got == {1: "Bloc X", 2: "Bloc Y", 3: "C"}
