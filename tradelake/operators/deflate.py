"""Deflate and convert trade values.

``deflate`` left-joins the deflator table on ``date`` and then, in one
projection:
  * every ``*_usd`` column -> ``*_usd_deflated`` = value x cpi_r
  * every ``*_usd`` column -> ``*_brl`` = value x brlusd
  * every ``*_brl`` column, including ones already in the input,
    -> ``*_brl_deflated`` = value x ipca_r
The deflator side has one row per month and is broadcast; its checks hang on
the join key, so they run whatever columns are read, also for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradelake.functions.names import match_suffix
from tradelake.functions.nulls import q
from tradelake.operators.deflators import with_ratios

DEFLATOR_COLUMNS = ("ipca", "ipca_i", "brlusd", "cpi", "cpi_r", "cpi_basedate", "ipca_r", "ipca_basedate")


def deflate(data: DataFrame, deflators: DataFrame, basedate=None, date: str = "date",
            strict: bool = False) -> DataFrame:
    """``data`` with the deflator columns and the converted measures.

    ``strict`` fails the job where a fact finds no complete deflator row;
    otherwise such facts are kept with NULLs. A ``*_brl`` column of the input
    that a ``*_usd`` column would be converted into is an error.
    """
    d1 = with_ratios(deflators, basedate, for_join=True)
    if date != "date":
        d1 = d1.withColumnRenamed("date", date)
    extra = [c for c in d1.columns if c != date]
    clash = [c for c in extra if c in data.columns]
    if clash:
        raise ValueError(f"deflate: input already has deflator columns {clash}")
    taken = [c[: -len("_usd")] + "_brl" for c in match_suffix(data.columns, "_usd")]
    taken = [c for c in taken if c in data.columns]
    if taken:
        raise ValueError(f"deflate: input already has the converted columns {taken}")
    j = data.join(F.broadcast(d1), on=date, how="left")
    if strict:
        found = F.col("cpi_r").isNotNull() & F.col("ipca_r").isNotNull() & F.col("brlusd").isNotNull()
        j = j.withColumn(date, F.when(found, F.col(date)).otherwise(
            F.raise_error(F.concat(F.lit("No complete deflators for "), F.col(date).cast("string")))))
    cols = list(data.columns) + extra

    usd = match_suffix(cols, "_usd")
    brl_names = [c[: -len("_usd")] + "_brl" for c in usd]
    kept = [c for c in cols if c not in set(brl_names)]
    old_brl = match_suffix(kept, "_brl")
    # one projection; each generated column is one SQL expression
    exprs = [f"{q(c)} * cpi_r AS {q(c + '_deflated')}" for c in usd]
    exprs += [f"{q(c)} * brlusd AS {q(n)}" for c, n in zip(usd, brl_names)]
    exprs += [f"{q(c)} * ipca_r AS {q(c + '_deflated')}" for c in old_brl]
    exprs += [f"({q(c)} * brlusd) * ipca_r AS {q(n + '_deflated')}" for c, n in zip(usd, brl_names)]
    return j.selectExpr(*[q(c) for c in kept], *exprs)
