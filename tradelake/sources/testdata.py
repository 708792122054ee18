"""Adapter: the driver's TPC-H-like tables stand in for trade data.

Everything here is derived by Spark from the given tables, so the work of a
query grows with them. Money is in integer cents (half-up), so sums are exact.

Trade fact (lineitem left join supplier):
  year, month, date     of l_shipdate
  direction             l_linestatus 'F' -> imp, 'O' -> exp
  ncm                   l_partkey as 8 digits; hs4 = (l_partkey mod 100) as 4 digits
  country_code          s_nationkey (countries: nation, blocks: region)
  state_abb             'UF' + two digits of (l_suppkey mod 27)
  unit_code             l_linenumber; transp_mode_code = 1 + l_orderkey mod 9;
  urf_code              l_suppkey; mun_code = l_orderkey mod 5000
  qt_stat, kg_net       l_quantity, 10 x l_quantity (bigint)
  fob_usd               l_extendedprice in cents
  freight_usd           imports only: l_extendedprice x l_tax in cents
  insurance_usd         imports only: l_extendedprice x l_discount in cents
  cif_usd               fob + freight + insurance (NULL for exports)

Deflator sources (per month or day of o_orderdate): daily quotes
bid = o_totalprice / 1e5, ask = 1.01 x bid; with m = 12 x year + month,
cpi = 100 + 0.25 x (m - 23940) and ipca = ((m mod 7) - 1) / 10 (percent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.functions.dates import month_start


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_FACT_EXPRS = [
    "CAST(year(l_shipdate) AS INT) AS year",
    "CAST(month(l_shipdate) AS INT) AS month",
    "lpad(CAST(l_partkey AS STRING), 8, '0') AS ncm",
    "CAST(l_linenumber AS INT) AS unit_code",
    "CAST(s_nationkey AS INT) AS country_code",
    "concat('UF', lpad(CAST(l_suppkey % 27 AS STRING), 2, '0')) AS state_abb",
    "CAST(1 + l_orderkey % 9 AS INT) AS transp_mode_code",
    "CAST(l_suppkey AS INT) AS urf_code",
    "CAST(l_quantity AS BIGINT) AS qt_stat",
    "CAST(l_quantity * 10 AS BIGINT) AS kg_net",
    "CAST(floor(l_extendedprice * 100 + 0.5D) AS BIGINT) AS fob_usd",
    "CASE WHEN l_linestatus = 'F' THEN CAST(floor(l_extendedprice * l_tax * 100 + 0.5D) AS BIGINT) END AS freight_usd",
    "CASE WHEN l_linestatus = 'F' THEN CAST(floor(l_extendedprice * l_discount * 100 + 0.5D) AS BIGINT) END AS insurance_usd",
    "CASE WHEN l_linestatus = 'F' THEN 'imp' WHEN l_linestatus = 'O' THEN 'exp' END AS direction",
    "make_date(year(l_shipdate), month(l_shipdate), 1) AS date",
]

_HS4_EXPRS = [
    "CAST(year(l_shipdate) AS INT) AS year",
    "CAST(month(l_shipdate) AS INT) AS month",
    "lpad(CAST(l_partkey % 100 AS STRING), 4, '0') AS hs4",
    "CAST(s_nationkey AS INT) AS country_code",
    "concat('UF', lpad(CAST(l_suppkey % 27 AS STRING), 2, '0')) AS state_abb",
    "CAST(l_orderkey % 5000 AS INT) AS mun_code",
    "CAST(l_quantity * 10 AS BIGINT) AS kg_net",
    "CAST(floor(l_extendedprice * 100 + 0.5D) AS BIGINT) AS fob_usd",
    "CASE WHEN l_linestatus = 'F' THEN 'imp' WHEN l_linestatus = 'O' THEN 'exp' END AS direction",
    "make_date(year(l_shipdate), month(l_shipdate), 1) AS date",
]


def _lineitem_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return li.join(sup, li.l_suppkey == sup.s_suppkey, "left")


def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NCM-level trade facts with the standard fact schema."""
    return _lineitem_supplier(spark, sf_dir).selectExpr(
        *_FACT_EXPRS, "fob_usd + freight_usd + insurance_usd AS cif_usd")


def hs4_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HS4 / municipality-level facts with the standard HS4 schema."""
    return _lineitem_supplier(spark, sf_dir).selectExpr(*_HS4_EXPRS)


# --- lookups ----------------------------------------------------------------

def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country table: country_code, country_name."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("country_code"), F.col("n_name").alias("country_name"))


def country_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country-to-block table: country_code, block_code, block_name."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("int").alias("country_code"),
        F.col("n_regionkey").cast("int").alias("block_code"),
        F.col("r_name").alias("block_name"))


def product_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three product code tables that share key columns (ncm, category, unit)."""
    p = table(spark, sf_dir, "part")
    code = F.upper(F.substring("p_type", 1, 3))
    ncm = p.select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("co_ncm"),
        (F.col("p_size") % 10).cast("string").alias("co_unid"),
        code.alias("co_cgce_n3"),
        F.col("p_name").alias("no_ncm_ing"))
    cgce = p.groupBy(code.alias("co_cgce_n3")).agg(F.min("p_type").alias("no_cgce_n3_ing"))
    unid = p.groupBy((F.col("p_size") % 10).cast("string").alias("co_unid")).agg(
        F.concat(F.lit("UNIT "), F.min(F.col("p_size") % 10).cast("string")).alias("no_unid"))
    return [ncm, cgce, unid]


# --- deflator sources ---------------------------------------------------------

def _order_months(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(month_start("o_orderdate").alias("date")).distinct()


def cpi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, cpi) monthly index series."""
    m = F.year("date") * 12 + F.month("date")
    return _order_months(spark, sf_dir).select("date", (F.lit(100.0) + F.lit(0.25) * (m - 23940)).alias("cpi"))


def ipca_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, ipca) monthly % change series."""
    m = F.year("date") * 12 + F.month("date")
    return _order_months(spark, sf_dir).select("date", ((m % 7 - 1) / F.lit(10.0)).alias("ipca"))


def fx_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, bid, ask) daily quotes."""
    o = table(spark, sf_dir, "orders")
    bid = F.col("o_totalprice") / F.lit(1e5)
    return o.select(F.to_date("o_orderdate").alias("date"), bid.alias("bid"), (bid * F.lit(1.01)).alias("ask"))


# --- reconciliation control totals -------------------------------------------

_CONTROL_SUMS = [
    "sum(CAST(l_quantity AS BIGINT)) AS q",
    "sum(CAST(l_quantity * 10 AS BIGINT)) AS kg",
    "sum(CAST(floor(l_extendedprice * 100 + 0.5D) AS BIGINT)) AS fob",
    "sum(CAST(floor(l_extendedprice * l_tax * 100 + 0.5D) AS BIGINT)) AS fr",
    "sum(CAST(floor(l_extendedprice * l_discount * 100 + 0.5D) AS BIGINT)) AS ins",
    "count(1) AS n",
]


def _control_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.expr("CAST(year(l_shipdate) AS INT) AS year"), "l_linestatus").agg(
        *[F.expr(x) for x in _CONTROL_SUMS])


def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows as the official files carry them, computed by a plan of
    their own (straight from lineitem, without the fact derivation).

    Columns follow the renamed control schema: file, year, qt_stat, kg_net,
    fob_usd, freight_usd, insurance_usd (bigint), number_of_lines (double); exports
    carry NULL freight and insurance, as their files lack those columns.
    """
    return _control_per_year(spark, sf_dir).selectExpr(
        "concat(CASE WHEN l_linestatus = 'F' THEN 'IMP_' ELSE 'EXP_' END, CAST(year AS STRING), '.csv') AS file",
        "CAST(year AS DOUBLE) AS year", "q AS qt_stat", "kg AS kg_net", "fob AS fob_usd",
        "CASE WHEN l_linestatus = 'F' THEN fr END AS freight_usd",
        "CASE WHEN l_linestatus = 'F' THEN ins END AS insurance_usd",
        "CAST(n AS DOUBLE) AS number_of_lines")


def control_totals_mun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows of the municipality (HS4) files: file, year, kg_net,
    fob_usd (bigint), number_of_lines (double)."""
    return _control_per_year(spark, sf_dir).selectExpr(
        "concat(CASE WHEN l_linestatus = 'F' THEN 'IMP_' ELSE 'EXP_' END, CAST(year AS STRING), '_MUN.csv') AS file",
        "CAST(year AS DOUBLE) AS year", "kg AS kg_net", "fob AS fob_usd",
        "CAST(n AS DOUBLE) AS number_of_lines")


# --- fiscal sheet and GDP -----------------------------------------------------

def first_order_year(spark: SparkSession, sf_dir: str):
    """First year of the orders, as a scalar subquery (identical wherever used)."""
    return table(spark, sf_dir, "orders").selectExpr("min(year(o_orderdate)) AS y").scalar()


def fiscal_sheet(spark: SparkSession, sf_dir: str, first_year, scale: float = 1.0) -> DataFrame:
    """Monthly tax sheet in the official wide layout, from orders.

    One row per month and a TOTAL row per year, each with an explicit ``line``
    (13 lines per year from ``first_year``), labels JAN..DEZ. Columns, in
    millions: i_renda, i_importacao_e_ipi_vinculado, total_geral. ``scale``
    derives the second (already deflated) sheet.
    """
    from tradelake.schemas import MONTH_LABELS
    o = table(spark, sf_dir, "orders")
    cents = "CAST(floor(o_totalprice * 100 + 0.5D) AS BIGINT)"
    urgent = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
    monthly = o.groupBy(F.expr("year(o_orderdate) AS y"), F.expr("month(o_orderdate) AS mo")).agg(
        F.expr(f"sum(CASE WHEN {urgent} THEN 0 ELSE {cents} END) AS a"),
        F.expr(f"sum(CASE WHEN {urgent} THEN {cents} ELSE 0 END) AS b"))
    yearly = monthly.groupBy("y").agg(F.expr("sum(a) AS a"), F.expr("sum(b) AS b")).selectExpr("y", "13 AS mo", "a", "b")
    rows = monthly.unionByName(yearly)
    labels = ", ".join(f"'{x}'" for x in (*MONTH_LABELS, "TOTAL"))
    unit = repr(1e8 / scale) + "D"
    return rows.select(
        F.expr(f"element_at(array({labels}), mo) AS mes"),
        F.expr(f"a / {unit} AS i_renda"),
        F.expr(f"b / {unit} AS i_importacao_e_ipi_vinculado"),
        F.expr(f"(a + b) / {unit} AS total_geral"),
        ((F.col("y") - first_year) * 13 + F.col("mo")).cast("int").alias("line"),
    )


def gdp_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, pib_brl_milhoes): monthly nominal output from order values."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.expr("trunc(to_date(o_orderdate), 'month') AS date")).agg(
        F.expr("sum(CAST(floor(o_totalprice * 100 + 0.5D) AS BIGINT)) / 1000000.0D AS pib_brl_milhoes"))
