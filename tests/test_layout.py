"""Clustered lakes skip row groups; co-located tables join without an exchange; rows are the same."""
import pytest
from pyspark.sql import functions as F

from tradelake.operators.aggregate import sum_prefixed
from tradelake.plans import layout, publish
from tradelake.session import scratch_path
from tradelake.sources import testdata as td
from tradelake.sources.lake import open_ncm

SF = "/root/testdata/sf0.01"


def _scanned(df):
    """(result rows, rows that the scan handed on): row groups that were skipped are not among them."""
    rows = sorted(map(tuple, df.collect()))
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    todo, total = [plan], 0
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            total += p.metrics().apply("numOutputRows").value()
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    return rows, total


def test_a_filter_on_either_column_skips_row_groups(spark):
    facts = td.trade_facts(spark, SF).where("year = 1998").repartition(1)
    small = {"parquet.block.size": 1 << 15, "parquet.page.size.row.check.min": 10}
    plain, both = scratch_path(spark, "plain"), scratch_path(spark, "both")
    publish.commit(spark, publish.stage(facts, plain, ["ncm", "month"], options=small))
    ranges = layout.code_ranges(facts, ["ncm", "country_code"])
    assert ranges["country_code"] == (0, 24) and ranges["ncm"][0] >= 0
    publish.commit(spark, publish.stage(facts, both, [layout.z_order(ranges)], options=small))
    read = {}
    for name, where in (("country", F.col("country_code") == 7), ("product", F.col("ncm") < "00000100")):
        for lake in (plain, both):
            df = open_ncm(spark, lake).where(where).groupBy("direction").agg(F.sum("fob_usd"))
            read[name, lake] = _scanned(df)
        assert read[name, plain][0] == read[name, both][0]
    rows = facts.count()
    assert read["country", both][1] < 0.6 * read["country", plain][1] <= 0.6 * rows
    assert read["product", both][1] < 0.6 * rows


def test_bloom_filters_skip_values_inside_the_range(spark):
    # even codes only: an odd one lies between least and greatest everywhere, only the filter can tell
    facts = td.trade_facts(spark, SF).where("year = 1998").withColumn("country_code", F.col("country_code") * 2)
    lake = scratch_path(spark, "bloom")
    layout.cluster(facts, lake, by=["country_code"], distinct={"country_code": 25})
    absent = open_ncm(spark, lake).where("country_code = 7").groupBy("direction").agg(F.sum("fob_usd"))
    assert _scanned(absent) == ([], 0)


def test_clustering_keeps_the_rows(spark):
    facts = td.trade_facts(spark, SF)
    lake = scratch_path(spark, "both")
    layout.cluster(facts, lake)
    key = lambda df: sorted(map(tuple, sum_prefixed(df, by=["year", "direction", "country_code"]).collect()), key=str)
    assert key(open_ncm(spark, lake)) == key(facts)
    odd = spark.createDataFrame([("x", None), (None, 5), ("00000007", 1)], "ncm string, country_code int")
    z = odd.select(layout.z_order({"ncm": (0, 9), "country_code": (0, 9)}).alias("z")).collect()
    assert [r["z"] for r in z][0] == 0 and all(r["z"] is not None for r in z)
    with pytest.raises(ValueError):
        layout.z_order({c: (0, 1) for c in "abcdefgh"}, bits=8)


def test_z_order_interleaves_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    z = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", layout.z_order({"a": (0, 3), "b": (0, 3)}, bits=2)).collect()}
    want = lambda a, b: (a & 1) | (b & 1) << 1 | (a >> 1) << 2 | (b >> 1) << 3
    assert z == {(a, b): want(a, b) for a in range(4) for b in range(4)}


def test_colocated_join_moves_neither_side(spark):
    tag = scratch_path(spark, "bucketed")[-12:]
    facts = layout.colocate(td.trade_facts(spark, SF), f"f_{tag}", "ncm", 4)
    products = layout.colocate(td.product_tables(spark, SF)[0], f"p_{tag}", "co_ncm", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table too large to broadcast
    try:
        joined = facts.join(products, facts["ncm"] == products["co_ncm"], "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = joined.groupBy("co_cgce_n3").agg(F.sum("fob_usd")).collect()
        plain = td.trade_facts(spark, SF).join(td.product_tables(spark, SF)[0], F.col("ncm") == F.col("co_ncm"), "left")
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, got)) == sorted(map(tuple, plain.groupBy("co_cgce_n3").agg(F.sum("fob_usd")).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE f_{tag}")
        spark.sql(f"DROP TABLE p_{tag}")


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    # the share of a task must not grow with the tables: twice the rows take twice the buckets
    import __spark_entry__ as E

    monkeypatch.setattr(layout, "BUCKET_ROWS", 250)
    for n in (4000, 8000):
        d = f"{tmp_path}/{n}"
        spark.range(n).selectExpr("id AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id % 997 AS l_partkey",
                                  "id % 50 AS l_suppkey", "DOUBLE(id % 40) AS l_quantity", "DOUBLE(id) AS l_extendedprice",
                                  "0.04D AS l_discount", "0.02D AS l_tax", "if(id % 2 = 0, 'F', 'O') AS l_linestatus",
                                  "date_add(DATE'1995-01-01', CAST(id % 900 AS INT)) AS l_shipdate"
                                  ).write.parquet(f"{d}/lineitem.parquet")
        spark.range(50).selectExpr("id AS s_suppkey", "id % 25 AS s_nationkey").write.parquet(f"{d}/supplier.parquet")
        spark.range(997).selectExpr("id AS p_partkey", "CAST(id % 50 AS INT) AS p_size", "concat('part ', id) AS p_name",
                                    "if(id % 3 = 0, 'LARGE TIN', 'SMALL TIN') AS p_type").write.parquet(f"{d}/part.parquet")
        before = {t.name for t in spark.catalog.listTables()}
        got = E.q_partner_vs_rest_colocated(spark, d).collect()
        made = sorted({t.name for t in spark.catalog.listTables()} - before)
        try:
            assert got and sorted(map(str, got)) == sorted(map(str, E.q_partner_vs_rest(spark, d).collect()))
            for t in made:
                told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {t}").collect()}
                assert int(told["Num Buckets"]) == n // 250
            assert [t.split("_")[0] for t in made] == ["facts", "products"]
            most = spark.table(made[0]).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
            assert most < 2 * 250
        finally:
            for t in made:
                spark.sql(f"DROP TABLE {t}")
