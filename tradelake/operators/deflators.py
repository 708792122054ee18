"""Deflator table: price indices and exchange rate per month.

The table has one row per month, so it is bounded by the calendar (about 12
rows a year) no matter how large the facts are; that bound is what lets
``deflate`` broadcast it. Duplicated dates are rejected inside the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradelake.functions.dates import last_day_previous_month, month_start
from tradelake.schemas import DEFLATOR_START

INCOMPLETE = "No single deflator row carries the base date."
DUPLICATED = "A date occurs more than once in the deflators."


def _lit_date(x) -> Column:
    return x if isinstance(x, Column) else F.to_date(F.lit(str(x)))


def price_index(ipca: DataFrame, date: str = "date", rate: str = "ipca", name: str = "ipca_i") -> DataFrame:
    """Cumulative index ``prod(1 + rate/100)`` in date order (NULL after a NULL).

    The running window has no partition key: the input is a monthly series
    (hundreds of rows), never a fact table.
    """
    w = Window.partitionBy().orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    factor = F.lit(1.0) + F.col(rate) / F.lit(100.0)
    complete = F.count(F.col(rate)).over(w) == F.count(F.lit(1)).over(w)
    return ipca.withColumn(name, F.when(complete, F.product(factor).over(w)))


def monthly_mid_rate(quotes: DataFrame, start=DEFLATOR_START, to=None, date: str = "date") -> DataFrame:
    """Daily (date, bid, ask) -> monthly (date, brlusd = (mean(bid) + mean(ask)) / 2).

    Quotes are kept between ``start`` and ``to`` (default: last day of the
    previous month). A NULL quote makes the month NULL, as mean() without
    dropping missing values does.
    """
    to_col = last_day_previous_month() if to is None else _lit_date(to)
    q = quotes.where((F.col(date) >= _lit_date(start)) & (F.col(date) <= to_col))
    n = F.count(F.lit(1))
    ok = (F.count("bid") == n) & (F.count("ask") == n)
    return q.groupBy(month_start(date).alias("date")).agg(
        F.when(ok, (F.avg("bid") + F.avg("ask")) / F.lit(2.0)).alias("brlusd"))


def build_deflators(ipca: DataFrame, quotes: DataFrame, cpi: DataFrame, start=DEFLATOR_START,
                    to=None, na_omit: bool = False) -> DataFrame:
    """(date, ipca, ipca_i, brlusd, cpi): IPCA full join BRL/USD full join CPI on date."""
    s = _lit_date(start)
    ipca_i = price_index(ipca.where(F.col("date") >= s).select("date", "ipca"))
    fx = monthly_mid_rate(quotes, start=start, to=to)
    cp = cpi.where(F.col("date") >= s).select("date", "cpi")
    res = (ipca_i.join(fx, "date", "full").join(cp, "date", "full")
           .select("date", "ipca", "ipca_i", "brlusd", "cpi"))
    return res.na.drop("any") if na_omit else res


def with_ratios(deflators: DataFrame, basedate=None, for_join: bool = False) -> DataFrame:
    """Adds cpi_r, cpi_basedate, ipca_r, ipca_basedate (base value / value).

    The base date of a series is ``basedate`` or its latest date with a value.
    Exactly one row must carry each base date and no date may repeat (the
    later join would fan out); both checks are tied to the date, the key of
    the later join, so no choice of output columns prunes them. The base values are window
    aggregates over the whole deflator table, which holds one row per month:
    its size is bounded by the calendar, not by the facts. ``for_join`` adds
    one row without a date, which matches nothing but carries the checks
    into the join even where the table is empty.
    """
    rest = [c for c in deflators.columns if c != "date"]
    real = deflators.selectExpr("*", "true AS __real")
    if for_join:
        blank = deflators.sparkSession.range(1).selectExpr(
            *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in deflators.schema.fields], "false AS __real")
        real = real.unionByName(blank)
    if basedate is not None:
        bd = f"DATE '{str(basedate)}'"
    k = "count_if(__real) OVER (PARTITION BY date) AS __k"
    level2 = ["*", "max(__k) OVER () AS __max_k"]
    for c in ("cpi", "ipca_i"):
        if basedate is None:
            key = f"CASE WHEN {c} IS NOT NULL THEN date END"
            level2 += [f"max({key}) OVER () AS __{c}_bd", f"max_by(__k, {key}) OVER () AS __{c}_n",
                       f"max_by({c}, {key}) OVER () AS __{c}_v"]
        else:
            level2 += [f"{bd} AS __{c}_bd", f"sum(CASE WHEN date = {bd} THEN 1 ELSE 0 END) OVER () AS __{c}_n",
                       f"max(CASE WHEN date = {bd} THEN {c} END) OVER () AS __{c}_v"]

    return real.selectExpr("*", k).selectExpr(*level2).selectExpr(
        f"CASE WHEN __max_k > 1 THEN raise_error('{DUPLICATED}') "
        f"WHEN coalesce(__cpi_n, 0) != 1 OR coalesce(__ipca_i_n, 0) != 1 THEN raise_error('{INCOMPLETE}') "
        "ELSE date END AS date",
        *rest,
        "try_divide(__cpi_v, cpi) AS cpi_r",
        "CAST(__cpi_bd AS DATE) AS cpi_basedate",
        "try_divide(__ipca_i_v, ipca_i) AS ipca_r",
        "CAST(__ipca_i_bd AS DATE) AS ipca_basedate")


def deflator_report(deflators: DataFrame) -> DataFrame:
    """One row: number of months, months with a NULL, duplicated dates (Q4 counts)."""
    n = F.count(F.lit(1))
    any_null = F.lit(False)
    for c in deflators.columns:
        any_null = any_null | F.col(c).isNull()
    per_date = deflators.groupBy("date").agg(n.alias("k"), F.max(any_null.cast("int")).alias("z"))
    return per_date.agg(
        F.sum("k").alias("n_rows"),
        F.sum("z").alias("months_with_null"),
        F.count(F.when(F.col("k") > 1, 1)).alias("duplicated_dates"))
