import pytest
from pyspark.sql import functions as F

from tradelake.operators.checks import coverage_grid, missing_partitions, reconcile

FACTS = "year int, direction string, qt_stat long, kg_net long, fob_usd long, freight_usd long, insurance_usd long"
CTRL = ("file string, year double, qt_stat double, kg_net double, fob_usd double, freight_usd double, "
        "insurance_usd double, number_of_lines double")


def _facts(spark):
    return spark.createDataFrame([(2023, "imp", 1, 10, 100, 5, 2), (2023, "imp", 2, 20, 200, 6, 3),
                                  (2023, "exp", 4, 40, 400, None, None)], FACTS)


def _ctrl(spark, fob_imp=300.0, extra=False):
    rows = [("IMP_2023.csv", 2023.0, 3.0, 30.0, fob_imp, 11.0, 5.0, 2.0),
            ("EXP_2023.csv", 2023.0, 4.0, 40.0, 400.0, None, None, 1.0)]
    if extra:
        rows.append(("EXP_2024.csv", 2024.0, 1.0, 1.0, 1.0, None, None, 1.0))
    return spark.createDataFrame(rows, CTRL)


def _status(df):
    return {(r["year"], r["direction"]): r["status"] for r in df.collect()}


def test_null_equals_null_is_ok(spark):
    assert _status(reconcile(_facts(spark), _ctrl(spark))) == {(2023, "imp"): "ok", (2023, "exp"): "ok"}


def test_one_unit_off_is_a_mismatch(spark):
    rep = reconcile(_facts(spark), _ctrl(spark, fob_imp=301.0))
    assert _status(rep)[(2023, "imp")] == "mismatch"
    row = rep.where("status = 'mismatch' AND measure = 'fob_usd'").collect()[0]
    assert (row["expected"], row["actual"]) == (301.0, 300.0)


def test_large_totals_are_exact(spark):
    facts = spark.createDataFrame([(2023, "imp", 1 << 53), (2024, "imp", 1 << 53)], "year int, direction string, fob_usd long")
    ctrl = spark.createDataFrame([("IMP_2023.csv", 2023, (1 << 53) + 1), ("IMP_2024.csv", 2024, 1 << 53)],
                                 "file string, year int, fob_usd long")
    rep = {r["year"]: (r["status"], r["expected"] - r["actual"]) for r in reconcile(facts, ctrl, measures=["fob_usd"]).collect()}
    assert rep == {2023: ("mismatch", 1), 2024: ("ok", 0)}


def test_uncovered_control_year(spark):
    st = _status(reconcile(_facts(spark), _ctrl(spark, extra=True)))
    assert st[(2024, "exp")] == "uncovered" and st[(2023, "imp")] == "ok"


def test_strict_raises(spark):
    with pytest.raises(Exception, match="differ from the control"):
        reconcile(_facts(spark), _ctrl(spark, fob_imp=1.0), strict=True).collect()


def test_missing_control_columns_are_null(spark):
    exp = spark.createDataFrame([("EXP_2023.csv", 2023.0, 4.0, 40.0, 400.0, 1.0)],
                                "file string, year double, qt_stat double, kg_net double, fob_usd double, "
                                "number_of_lines double")
    imp = _ctrl(spark).where("file like 'IMP%'")
    ctrl = imp.unionByName(exp, allowMissingColumns=True)
    assert set(_status(reconcile(_facts(spark), ctrl)).values()) == {"ok"}


def test_missing_partitions(spark):
    grid = coverage_grid(spark, [2022, 2023], ["imp", "exp"], ["ncm"])
    present = _facts(spark).select("year", "direction").withColumn("type", F.lit("ncm"))
    got = sorted((r["year"], r["direction"]) for r in missing_partitions(grid, present).collect())
    assert got == [(2022, "exp"), (2022, "imp")]


def test_year_and_direction_filters(spark):
    rep = reconcile(_facts(spark), _ctrl(spark, extra=True), years=[2023], directions=["imp"])
    assert _status(rep) == {(2023, "imp"): "ok"}
