"""Plan-shape checks: the scale properties described in PLANS.md."""
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from tradelake.operators.aggregate import sum_prefixed
from tradelake.operators.ranking import first_per_group
from tradelake.plans import ingest
from tradelake.sources import testdata as td

SF = "/root/testdata/sf0.001"


def _plan(df, final=False):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


def test_lake_query_prunes_and_pushes_down(spark):
    lake = ingest.publish_lake(td.trade_facts(spark, SF))
    q = sum_prefixed(spark.read.parquet(lake).where((F.col("year") == 1998) & (F.col("ncm") == "00000123")),
                     by=["direction"], prefixes="fob_usd")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(ncm,00000123)" in plan
    assert re.search(r"ReadSchema: struct<ncm:string,fob_usd:bigint>", plan)
    assert "partial_sum" in plan


def test_small_rolled_table_is_broadcast_by_the_planner(spark):
    plan = _plan(E.q_roll3_with_ties(spark, SF), final=True)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_category_report_prunes_years(spark):
    lake = ingest.publish_lake(td.trade_facts(spark, SF))
    from tradelake.plans import reports
    df = reports.category_change_top(spark.read.parquet(lake), E._products(spark, SF), E._deflators(spark, SF), 9, "1998-01-01")
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", _plan(df))
    assert any("year" in f and ">= 1998" in f and "= imp" in f for f in filters)


def test_building_a_report_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    lazy = ["partner_real_rolling", "same_month", "category_change_top10", "partner_vs_rest_real", "effective_rate",
            "yearly_growth_long", "top_partners", "roll3_with_ties", "lookup_merge", "deflators", "fiscal_long"]
    for name in lazy:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        E._QUERIES[name](spark, SF)
        assert [j for j in tracker.getJobIdsForGroup(f"build-{name}") if _is_query(spark, j)] == [], name
    spark.sparkContext.setJobGroup("tests", "tests")


def _is_query(spark, job):
    """Jobs of more than schema inference (one task that reads a footer)."""
    info = spark.sparkContext.statusTracker().getJobInfo(job)
    stages = [spark.sparkContext.statusTracker().getStageInfo(s) for s in info.stageIds]
    return len(stages) > 1 or any(s is not None and not s.name.startswith("parquet at") for s in stages)


def test_every_call_reads_its_tables(spark):
    for name in ("lookup_merge", "deflators", "fiscal_long", "roll_rows12"):
        for _ in range(2):
            assert "FileScan parquet" in _plan(E._QUERIES[name](spark, SF)), name


def test_argmax_limits_before_the_shuffle(spark):
    plan = _plan(first_per_group(td.trade_facts(spark, SF), "direction", "fob_usd", "date"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_k_series_scans_facts_once(spark):
    plan = _plan(E.q_top_partners(spark, SF), final=True)
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
