"""Line numbers over several splits; a sheet's raw export."""
import pytest

from tradelake.plans.reports import fiscal_long
from tradelake.sources.lines import numbered_lines, read_raw_sheet
from tests.conftest import d


def _split(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    return before


def test_numbers_hold_over_splits_and_files(spark, tmp_path):
    for name, n in (("a.txt", 700), ("b.txt", 1), ("c.txt", 55)):
        (tmp_path / name).write_bytes("".join(f"ação {name} {k + 1}\n" for k in range(n)).encode("latin-1"))
    before = _split(spark, "300b")
    try:
        lines = numbered_lines(spark, str(tmp_path))
        got = lines.collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 756
    for r in got:
        name = r["file"].rsplit("/", 1)[-1]
        assert r["value"] == f"ação {name} {r['line']}"


def test_raw_sheet_equals_one_with_numbers(spark, tmp_path):
    rows = ["JAN;1,5;2,5", "FEV;3;4", "", "TOTAL;4,5;6,5"]
    (tmp_path / "sheet.csv").write_bytes("\n".join(["x;y"] * 6 + ["MÊS;I. Renda;Total Geral"] + rows).encode("latin-1"))
    sheet = read_raw_sheet(spark, str(tmp_path / "sheet.csv"))
    assert sheet.columns == ["mes", "i_renda", "total_geral", "line"]
    assert sorted((r["line"], r["mes"], r["i_renda"]) for r in sheet.where("mes is not null").collect()) == [
        (1, "JAN", 1.5), (2, "FEV", 3.0), (4, "TOTAL", 4.5)]
    long = {(r["date"], r["arrecadacao_categoria"]): r["imposto_brl"] for r in fiscal_long(sheet, 2020).collect()}
    assert long[(d("2020-02-01"), "total_geral")] == 4e6 and len(long) == 4
    with pytest.raises(ValueError, match="no file with a header"):
        read_raw_sheet(spark, str(tmp_path / "sheet.csv"), skip=50)


def test_text_in_a_number_fails(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("mes;a\nJAN;1\nFEV;x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_raw_sheet(spark, str(tmp_path / "sheet.csv"), skip=0).collect()
