import pytest

from tradelake.operators.deflate import deflate
from tradelake.operators.deflators import build_deflators
from tradelake.plans.reports import fiscal_long
from tradelake.schemas import NCM_EXP_SCHEMA
from tradelake.session import materialize, scratch_path, shared_dir
from tradelake.sources.series import read_cpi, read_gdp, read_ipca, read_quotes, read_sheet
from tradelake.sources.trade_csv import file_counts
from tests.conftest import d


def _write(path, text, enc="utf-8"):
    with open(path, "wb") as f:
        f.write(text.encode(enc))


def test_landed_series_build_deflators(spark, tmp_path):
    _write(tmp_path / "cpi.csv", "date,cpi\n1996-12-01,99.0\n1997-01-01,100.0\n1997-02-01,101.0\n")
    _write(tmp_path / "ipca.csv", "date,ipca\n1997-01-01,1.0\n1997-02-01,2.0\n")
    _write(tmp_path / "fx.csv", "date,bid,ask\n1997-01-02,1.0,1.2\n1997-02-03,2.0,2.2\n1997-02-04,2.0,2.2\n")
    cpi = read_cpi(spark, str(tmp_path / "cpi.csv"))
    assert cpi.count() == 2  # series start at 1997-01-01
    defl = build_deflators(read_ipca(spark, str(tmp_path / "ipca.csv")), read_quotes(spark, str(tmp_path / "fx.csv")),
                           cpi, to="1997-12-31", na_omit=True)
    rows = {r["date"]: r for r in defl.collect()}
    assert rows[d("1997-02-01")]["brlusd"] == pytest.approx(2.1)
    assert rows[d("1997-02-01")]["ipca_i"] == pytest.approx(1.01 * 1.02)
    data = spark.createDataFrame([(d("1997-01-01"), 100)], "date date, fob_usd long")
    out = deflate(data, defl).collect()[0]
    assert out["fob_usd_deflated"] == pytest.approx(101.0) and out["fob_brl"] == pytest.approx(110.0)


def test_read_gdp(spark, tmp_path):
    _write(tmp_path / "gdp.csv", "date,pib_brl_milhoes\n2020-01-01,600000.5\n")
    assert read_gdp(spark, str(tmp_path / "gdp.csv")).collect()[0]["pib_brl_milhoes"] == 600000.5


def test_read_sheet_decimal_comma(spark, tmp_path):
    _write(tmp_path / "sheet.csv", "MES;I. Renda;Total Geral;LINE\nJAN;1,5;2,5;1\nFEV;3;4;2\nTOTAL;4,5;6,5;13\n",
           enc="latin-1")
    sheet = read_sheet(spark, str(tmp_path / "sheet.csv"))
    assert sheet.columns == ["mes", "i_renda", "total_geral", "line"]
    long = {(r["date"], r["arrecadacao_categoria"]): r["imposto_brl"] for r in fiscal_long(sheet, 2020).collect()}
    assert long[(d("2020-01-01"), "i_renda")] == 1.5e6 and len(long) == 4


def test_landing_probe_strict(spark, tmp_path):
    _write(tmp_path / "exp_2023.csv", "CO_ANO;CO_MES;CO_NCM;CO_UNID;CO_PAIS;SG_UF_NCM;CO_VIA;CO_URF;QT_ESTAT;KG_LIQUIDO;VL_FOB\n"
           "2023;1;01012100;10;63;SP;1;1;5;50;500\n2023;2;01012100;10;63;SP;1;1;x;50;500\n")
    counts = file_counts(spark, str(tmp_path), schema=NCM_EXP_SCHEMA).collect()
    assert sum(r["rows"] for r in counts) == 2 and sum(r["bad_rows"] for r in counts) == 1
    with pytest.raises(Exception, match="unreadable rows"):
        file_counts(spark, str(tmp_path), schema=NCM_EXP_SCHEMA, strict=True).collect()


def test_shared_folder_and_materialize(spark):
    base = shared_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base.rstrip("/"))
    df = spark.range(5)
    assert sorted(r[0] for r in materialize(df).collect()) == [0, 1, 2, 3, 4]
