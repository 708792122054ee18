import os

from pyspark.sql import functions as F

from tradelake.operators.aggregate import sum_prefixed
from tradelake.plans import ingest
from tradelake.session import scratch_path
from tradelake.sources.trade_csv import file_counts, read_control, read_ncm_raw, read_table


def _write(path, text):
    with open(path, "wb") as f:
        f.write(text.encode("latin-1"))


def test_latin1_leading_zeros_decimal_comma(spark, tmp_path):
    _write(tmp_path / "ncm.csv", "CO_NCM;NO_NCM_POR;CO_PAIS\n01012100;ação;063\n")
    r = read_table(spark, "ncm", str(tmp_path)).collect()[0]
    assert r["co_ncm"] == "01012100" and r["no_ncm_por"] == "ação" and r["country_code"] == 63
    _write(tmp_path / "imp_totais_conferencia.csv",
           "ARQUIVO;CO_ANO;QT_ESTAT;KG_LIQUIDO;VL_FOB;VL_FRETE;VL_SEGURO;NUMERO_LINHAS\nIMP_2023.csv;2023;7,0;10;20;3;4;1,5\n")
    _write(tmp_path / "exp_totais_conferencia.csv",
           "ARQUIVO;CO_ANO;QT_ESTAT;KG_LIQUIDO;VL_FOB;NUMERO_LINHAS\nEXP_2023.csv;2023;7;8;9;1\n")
    c = {r["file"]: r for r in read_control(spark, str(tmp_path)).collect()}
    # measures become 64-bit integers (as the standard rename does); others stay double
    assert c["IMP_2023.csv"]["qt_stat"] == 7 and c["IMP_2023.csv"]["number_of_lines"] == 1.5
    assert c["IMP_2023.csv"]["year"] == 2023.0
    assert c["EXP_2023.csv"]["freight_usd"] is None


def _facts(spark):
    rows = [(2023, 1, "00012345", 1, 63, "SP", 1, 1, 10, 100, 1000, 5, 2, "imp"),
            (2023, 2, "00012345", 1, 63, "SP", 1, 1, 10, 100, 1000, None, None, "exp"),
            (2024, 1, "01012100", 1, 160, "RJ", 1, 1, 20, 200, 2000, 7, 3, "imp")]
    df = spark.createDataFrame(rows, "year int, month int, ncm string, unit_code int, country_code int, "
                                     "state_abb string, transp_mode_code int, urf_code int, qt_stat long, "
                                     "kg_net long, fob_usd long, freight_usd long, insurance_usd long, "
                                     "direction string")
    return df.withColumn("date", F.make_date("year", "month", F.lit(1))) \
             .withColumn("cif_usd", F.col("fob_usd") + F.col("freight_usd") + F.col("insurance_usd"))


def test_partition_replace_keeps_other_partitions(spark):
    path = scratch_path(spark, "test-lake")
    ingest.publish_lake(_facts(spark), path)
    new = _facts(spark).where("year = 2024").withColumn("fob_usd", F.lit(9).cast("long"))
    ingest.publish_lake(new, path)
    got = {(r["year"], r["direction"]): r["fob_usd"]
           for r in sum_prefixed(spark.read.parquet(path), by=["year", "direction"], prefixes="fob_").collect()}
    assert got == {(2023, "imp"): 1000, (2023, "exp"): 1000, (2024, "imp"): 9}


def test_rewrite_same_input_is_idempotent(spark):
    path = scratch_path(spark, "test-lake")
    ingest.publish_lake(_facts(spark), path)
    first = sorted(map(tuple, spark.read.parquet(path).collect()))
    ingest.publish_lake(_facts(spark), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == first


def test_csv_landing_roundtrip(spark):
    landing = ingest.land_as_csv(_facts(spark))
    raw = read_ncm_raw(spark, landing)
    got = {(r["year"], r["direction"]): (r["ncm"], r["cif_usd"]) for r in raw.collect()}
    assert got[(2023, "imp")] == ("00012345", 1007) and got[(2023, "exp")] == ("00012345", None)
    counts = file_counts(spark, landing + "/direction=imp")
    assert sum(r["rows"] for r in counts.collect()) == 2
    assert sum(r["bad_rows"] for r in counts.collect()) == 0


def test_ingest_validates_before_publishing(spark):
    import pytest
    landing = ingest.land_as_csv(_facts(spark))
    ctrl = spark.createDataFrame([("IMP_2023.csv", 2023.0, 10.0, 100.0, 1001.0, 5.0, 2.0, 1.0)],
                                "file string, year double, qt_stat double, kg_net double, fob_usd double, "
                                "freight_usd double, insurance_usd double, number_of_lines double")
    lake = scratch_path(spark, "test-lake")
    with pytest.raises(Exception, match="differ from the control"):
        ingest.ingest(spark, landing, lake, control=ctrl)
    assert not os.path.exists(lake.replace("file:", ""))
    ok = ctrl.withColumn("fob_usd", F.lit(1000.0))
    ingest.ingest(spark, landing, lake, years=[2023], control=ok)
    assert spark.read.parquet(lake).count() == 2


HEAD_EXP = "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB\n"
GOOD_EXP = "2023;1;01012100;10;63;SP;1;1;5;50;500\n"


def test_bad_rows_and_absent_years_publish_nothing(spark, tmp_path):
    import pytest
    for side in ("imp", "exp"):
        (tmp_path / f"direction={side}").mkdir()
    exp = tmp_path / "direction=exp"
    imp = tmp_path / "direction=imp"
    _write(imp / "IMP_2023.csv", HEAD_EXP.strip() + ";VL_FRETE;VL_SEGURO\n" + GOOD_EXP.strip() + ";1;2\n")
    _write(exp / "EXP_2023.csv", HEAD_EXP + GOOD_EXP + "2023;2;01012100;10;63;SP;1;1;x;50;500\n2023;3;0101\n")
    lake = scratch_path(spark, "test-lake")
    with pytest.raises(ValueError, match=r"EXP_2023.csv \(2\)"):
        ingest.ingest(spark, str(tmp_path), lake, years=[2023])
    with pytest.raises(ValueError, match="no landed file for exp 2024, imp 2024"):
        ingest.ingest(spark, str(tmp_path), lake, years=[2023, 2024])
    assert not os.path.exists(lake.replace("file:", ""))
    _write(exp / "EXP_2023.csv", HEAD_EXP + GOOD_EXP)
    ingest.ingest(spark, str(tmp_path), lake, years=[2023])
    assert spark.read.parquet(lake).count() == 2


def test_only_official_names_are_facts(spark, tmp_path):
    for side in ("imp", "exp"):
        (tmp_path / f"direction={side}").mkdir()
    _write(tmp_path / "direction=exp" / "exp_2023.csv", HEAD_EXP + GOOD_EXP)
    _write(tmp_path / "direction=exp" / "notes_old.csv", HEAD_EXP + GOOD_EXP)
    _write(tmp_path / "direction=imp" / "imp_2023_notes.csv", HEAD_EXP + GOOD_EXP)
    assert [(r["year"], r["direction"]) for r in read_ncm_raw(spark, str(tmp_path)).collect()] == [(2023, "exp")]
    from tradelake.sources.trade_csv import landed_files
    assert [tuple(r) for r in landed_files(spark, str(tmp_path)).collect()] == [("exp", 2023, "EXP_2023.csv")]


def test_rewrite_checks_before_it_writes(spark):
    import pytest
    ctrl = spark.createDataFrame([("IMP_2023.csv", 2023, 1001)], "file string, year int, fob_usd long")
    base = scratch_path(spark, "test-rewrite")
    with pytest.raises(Exception, match="differ from the control"):
        ingest.rewrite(_facts(spark), base, ctrl)
    assert not os.path.exists(base.replace("file:", ""))
    path, report = ingest.rewrite(_facts(spark), base, ctrl.withColumn("fob_usd", F.lit(1000).cast("long")))
    assert {r["status"] for r in report.collect()} == {"ok"} and spark.read.parquet(path).count() == 3


def test_union_missing_columns_derives_direction(spark):
    f = _facts(spark)
    imp = f.where("direction = 'imp'").select("year", "month", "fob_usd", "freight_usd", "insurance_usd")
    exp = f.where("direction = 'exp'").select("year", "month", "fob_usd")
    u = ingest.standardize_union([imp, exp])
    assert sorted((r["direction"], r["cif_usd"]) for r in u.collect()) == [("exp", None), ("imp", 1007), ("imp", 2010)]


def test_hs4_ingest(spark):
    from tradelake.sources import testdata as td
    facts = td.hs4_facts(spark, "/root/testdata/sf0.001")
    landing = ingest.land_hs4_as_csv(facts)
    lake = ingest.ingest(spark, landing, scratch_path(spark, "test-lake"), kind="hs4",
                         control=td.control_totals_mun(spark, "/root/testdata/sf0.001"))
    assert spark.read.parquet(lake).count() == facts.count()
