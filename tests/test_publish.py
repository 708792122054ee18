"""Staged versions, manifest switch, conflicts, vacuum; the ingest job on top of them."""
import warnings

import pytest
from pyspark.sql import functions as F

from tradelake.operators.aggregate import sum_prefixed
from tradelake.plans import ingest, publish
from tradelake.session import file_system, scratch_path
from tradelake.sources.lake import lake_years, open_ncm
from tradelake.sources.manifest import landing_manifest
from tests.test_ingest import GOOD_EXP, HEAD_EXP, _facts, _write


def _sums(df):
    return {(r["year"], r["direction"]): r["fob_usd"] for r in sum_prefixed(df, by=["year", "direction"], prefixes="fob_").collect()}


WHOLE = {(2023, "imp"): 1000, (2023, "exp"): 1000, (2024, "imp"): 2000}


def _names(spark, lake):
    fs, path = file_system(spark, f"{lake}/version=*/year=*/direction=*")
    return {s.getPath().toString() for s in fs.globStatus(path) or []}


def test_staged_rows_are_invisible_until_the_switch(spark):
    lake = scratch_path(spark, "test-lake")
    publish.publish(_facts(spark), lake)
    staged = publish.stage(_facts(spark).withColumn("fob_usd", F.col("fob_usd") * 5), lake)
    assert _sums(open_ncm(spark, lake)) == WHOLE
    assert _sums(publish.staged_facts(spark, staged)) == {k: 5 * v for k, v in WHOLE.items()}
    publish.commit(spark, staged)
    assert _sums(open_ncm(spark, lake)) == {k: 5 * v for k, v in WHOLE.items()}
    assert _sums(open_ncm(spark, lake, manifest=1)) == WHOLE


def test_a_publication_that_fails_half_way_changes_nothing(spark):
    lake = scratch_path(spark, "test-lake")
    publish.publish(_facts(spark), lake)
    before = _names(spark, lake)

    def refuse(staged):
        assert staged.count() == 3
        raise ValueError("refused")
    with pytest.raises(ValueError, match="refused"):
        publish.publish(_facts(spark).withColumn("fob_usd", F.lit(1)), lake, verify=refuse)
    assert _sums(open_ncm(spark, lake)) == WHOLE and _names(spark, lake) == before
    # rows that fail while they are written
    broken = _facts(spark).withColumn("fob_usd", F.expr("if(year = 2024, raise_error('broken row'), fob_usd)").cast("long"))
    with pytest.raises(Exception, match="broken row"):
        publish.publish(broken, lake)
    assert _sums(open_ncm(spark, lake)) == WHOLE and _names(spark, lake) == before
    assert publish.manifest(spark, lake).number == 1


def test_partitions_have_to_be_named(spark):
    lake = scratch_path(spark, "test-lake")
    publish.publish(_facts(spark), lake)
    one = _facts(spark).where("year = 2024").withColumn("fob_usd", F.lit(9).cast("long"))
    with pytest.raises(ValueError, match="exp 2023"):
        publish.publish(one, lake, partitions=[(2024, "imp"), (2023, "exp")])
    publish.publish(one, lake, partitions=[(2024, "imp")])
    assert _sums(open_ncm(spark, lake)) == {**WHOLE, (2024, "imp"): 9}


def test_the_second_of_two_writers_is_refused(spark):
    lake = scratch_path(spark, "test-lake")
    first = publish.stage(_facts(spark), lake)
    second = publish.stage(_facts(spark).withColumn("fob_usd", F.lit(7).cast("long")), lake)
    publish.commit(spark, first)
    with pytest.raises(publish.PublishConflict):
        publish.commit(spark, second)
    assert _sums(open_ncm(spark, lake)) == WHOLE


def test_vacuum_keeps_what_the_newest_manifests_name(spark):
    lake = scratch_path(spark, "test-lake")
    for k in (1, 2, 3):
        publish.publish(_facts(spark).where("year = 2024 or 1 = %d" % k).withColumn("fob_usd", F.col("fob_usd") * k), lake)
    publish.stage(_facts(spark), lake)  # a writer that died
    assert publish.vacuum(spark, lake, keep=2) == 4  # the first 2024 and the leftover's three partitions
    assert _sums(open_ncm(spark, lake)) == {**WHOLE, (2024, "imp"): 6000}
    assert _sums(open_ncm(spark, lake, manifest=2)) == {**WHOLE, (2024, "imp"): 4000}
    assert publish.vacuum(spark, lake) == 1
    assert _sums(spark.read.parquet(lake)) == {**WHOLE, (2024, "imp"): 6000}
    fs, path = file_system(spark, f"{lake}/version=*")
    assert len(fs.globStatus(path)) == 2  # of the first and of the third publication
    with pytest.raises(ValueError):
        open_ncm(spark, lake, manifest=2)
    with pytest.raises(ValueError):
        publish.vacuum(spark, lake, keep=0)


def test_columns_that_came_later_are_null_before(spark):
    lake = scratch_path(spark, "test-lake")
    publish.publish(_facts(spark).where("year = 2023"), lake)
    publish.publish(_facts(spark).where("year = 2024").withColumn("note", F.lit("new")), lake)
    publish.publish(_facts(spark).where("year = 2023 and direction = 'exp'"), lake)
    assert {(r["year"], r["note"]) for r in open_ncm(spark, lake).collect()} == {(2023, None), (2024, "new")}


def test_filters_prune_versions_and_push_down(spark):
    lake = scratch_path(spark, "test-lake")
    publish.publish(_facts(spark), lake)
    publish.publish(_facts(spark).where("year = 2024"), lake)
    df = open_ncm(spark, lake).where((F.col("year") == 2024) & (F.col("ncm") == "01012100")).select("fob_usd")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(ncm,01012100)" in plan
    assert len(df.inputFiles()) < len(open_ncm(spark, lake).inputFiles()) or df.count() == 1
    assert lake_years(spark, lake) == [2023, 2024]
    assert _sums(open_ncm(spark, lake, last_years=1)) == {(2024, "imp"): 2000}
    plain = ingest.publish_lake(_facts(spark))
    assert lake_years(spark, plain) == [2023, 2024] and _sums(open_ncm(spark, plain, last_years=1)) == {(2024, "imp"): 2000}


# --- the ingest job -------------------------------------------------------------

def _landing(tmp_path, files):
    for side in ("imp", "exp"):
        (tmp_path / f"direction={side}").mkdir(exist_ok=True)
    for name, text in files.items():
        side = "imp" if name.lower().startswith("imp") else "exp"
        _write(tmp_path / f"direction={side}" / name, text)
    return str(tmp_path)


HEAD_IMP = HEAD_EXP.strip() + ";VL_FRETE;VL_SEGURO\n"
GOOD_IMP = GOOD_EXP.strip() + ";1;2\n"
HEAD_MUN = "CO_ANO;CO_MES;SH4;CO_PAIS;SG_UF_MUN;CO_MUN;KG_LIQUIDO;VL_FOB\n"


def test_kinds_do_not_stand_for_each_other(spark, tmp_path):
    landing = _landing(tmp_path, {"IMP_2023.csv": HEAD_IMP + GOOD_IMP, "IMP_2023_MUN.csv": HEAD_MUN + "2023;1;0101;63;SP;3400001;5;50\n",
                                  "IMP_2024_MUN.csv": HEAD_MUN + "2024;1;0101;63;SP;3400001;5;50\n", "notes.csv": "x\n"})
    assert [(f.kind, f.year, f.file) for f in landing_manifest(spark, landing)] == [
        ("hs4", 2023, "IMP_2023_MUN.csv"), ("hs4", 2024, "IMP_2024_MUN.csv"), ("ncm", 2023, "IMP_2023.csv")]
    lake = scratch_path(spark, "test-lake")
    with pytest.raises(ValueError, match="no landed file for imp 2024"):
        ingest.ingest(spark, landing, lake, years=[2024], directions=["imp"])
    ingest.ingest(spark, landing, lake, directions=["imp"])
    assert _sums(open_ncm(spark, lake)) == {(2023, "imp"): 500}
    hs4 = ingest.ingest(spark, landing, scratch_path(spark, "test-lake"), directions=["imp"], kind="hs4")
    assert _sums(open_ncm(spark, hs4)) == {(2023, "imp"): 50, (2024, "imp"): 50}
    with pytest.raises(ValueError, match="of kind ncm"):
        ingest.ingest(spark, landing, lake, directions=["exp"])


def test_names_that_contradict_are_errors(spark, tmp_path):
    landing = _landing(tmp_path, {"IMP_2023.csv": HEAD_IMP + GOOD_IMP})
    _write(tmp_path / "direction=exp" / "imp_2022.csv", HEAD_IMP + GOOD_IMP)
    with pytest.raises(ValueError, match="other direction"):
        landing_manifest(spark, landing)
    (tmp_path / "b").mkdir()
    two = _landing(tmp_path / "b", {"IMP_2023.csv": HEAD_IMP + GOOD_IMP, "imp_2023.CSV": HEAD_IMP + GOOD_IMP})
    with pytest.raises(ValueError, match="two files"):
        landing_manifest(spark, two)


def test_stray_rows_publish_nothing(spark, tmp_path):
    landing = _landing(tmp_path, {"EXP_2023.csv": HEAD_EXP + GOOD_EXP})
    lake = ingest.ingest(spark, landing, scratch_path(spark, "test-lake"), directions=["exp"])
    _landing(tmp_path, {"EXP_2024.csv": HEAD_EXP + GOOD_EXP.replace("2023", "2024") + GOOD_EXP.replace("500", "7")})
    for years in (None, [2024], [2023, 2024]):
        with pytest.raises(ValueError, match=r"EXP_2024.csv holds 1 of 2023"):
            ingest.ingest(spark, landing, lake, years=years, directions=["exp"])
    assert _sums(open_ncm(spark, lake)) == {(2023, "exp"): 500}
    ingest.ingest(spark, landing, lake, years=[2023], directions=["exp"])


def test_a_header_in_another_order_is_named(spark, tmp_path):
    swapped = HEAD_IMP.replace("VL_FRETE;VL_SEGURO", "VL_SEGURO;VL_FRETE")
    landing = _landing(tmp_path, {"IMP_2022.csv": HEAD_IMP + GOOD_IMP.replace("2023", "2022"), "IMP_2023.csv": swapped + GOOD_IMP})
    lake = scratch_path(spark, "test-lake")
    with pytest.raises(ValueError, match="not the official one in .*IMP_2023.csv"):
        ingest.ingest(spark, landing, lake, directions=["imp"])
    assert publish.manifest(spark, lake) is None and not _names(spark, lake)
    # a header that lacks a column as well
    _landing(tmp_path, {"IMP_2023.csv": HEAD_EXP + GOOD_IMP})
    with pytest.raises(ValueError, match="IMP_2023.csv"):
        ingest.ingest(spark, landing, lake, directions=["imp"])
    # case does not matter, as in the rename map
    _landing(tmp_path, {"IMP_2023.csv": HEAD_IMP.lower() + GOOD_IMP})
    ingest.ingest(spark, landing, lake, directions=["imp"])
    assert _sums(open_ncm(spark, lake)) == {(2022, "imp"): 500, (2023, "imp"): 500}


def test_control_rows_without_facts_are_warned_of(spark, tmp_path):
    landing = _landing(tmp_path, {"EXP_2023.csv": HEAD_EXP + GOOD_EXP})
    control = spark.createDataFrame([("EXP_2023.csv", 2023, 500), ("EXP_2024.csv", 2024, 1)], "file string, year int, fob_usd long")
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        ingest.ingest(spark, landing, scratch_path(spark, "test-lake"), directions=["exp"], control=control)
    assert any("EXP_2024.csv" in str(w.message) for w in said)


def test_landing_is_parsed_once(spark, tmp_path):
    landing = _landing(tmp_path, {"EXP_2023.csv": HEAD_EXP + GOOD_EXP})
    control = spark.createDataFrame([("EXP_2023.csv", 2023, 500)], "file string, year int, fob_usd long")
    seen = []
    read = ingest.read_landed
    ingest.read_landed = lambda *a, **k: seen.append(1) or read(*a, **k)
    report = ingest.landing_report
    ingest.landing_report = lambda *a, **k: seen.append(2) or report(*a, **k)
    try:
        ingest.ingest(spark, landing, scratch_path(spark, "test-lake"), directions=["exp"], control=control)
    finally:
        ingest.read_landed, ingest.landing_report = read, report
    assert seen == [1]
