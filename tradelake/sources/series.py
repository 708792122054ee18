"""Landed deflator series and sheets (network clients are out of scope).

Files: CPI ``date,cpi``; IPCA ``date,ipca`` (monthly % change); exchange
quotes ``date,bid,ask`` (daily); fiscal sheet exported to CSV with an
explicit ``line`` column; GDP ``date,pib_brl_milhoes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.functions.names import clean_names
from tradelake.schemas import DEFLATOR_START


def _csv(spark, path, schema):
    return spark.read.option("header", "true").schema(schema).csv(path)


def read_cpi(spark: SparkSession, path: str, start: str = DEFLATOR_START) -> DataFrame:
    df = _csv(spark, path, "date date, cpi double")
    return df.where(F.col("date") >= F.to_date(F.lit(start)))


def read_ipca(spark: SparkSession, path: str, start: str = DEFLATOR_START) -> DataFrame:
    df = _csv(spark, path, "date date, ipca double")
    return df.where(F.col("date") >= F.to_date(F.lit(start)))


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, "date date, bid double, ask double")


def read_gdp(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, "date date, pib_brl_milhoes double")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Wide sheet: ``mes`` label, ``line`` number, one numeric column per series.

    Numbers may use a decimal comma; they are parsed as decimals then doubles.
    """
    df = spark.read.option("header", "true").option("sep", ";").option("inferSchema", "false").csv(path)
    df = df.toDF(*clean_names(df.columns))
    nums = [c for c in df.columns if c not in ("mes", "line")]
    return df.select(
        "mes", *[F.regexp_replace(F.col(c), ",", ".").cast("double").alias(c) for c in nums],
        F.col("line").cast("int").alias("line"))
