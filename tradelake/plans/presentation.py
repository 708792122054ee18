"""Rounding of floating report columns whose last bits depend on evaluation order.

Averages, running products and sums of doubles differ in the last bits
between engines and partitionings. Columns that pass through one are rounded
to ``DIGITS`` significant digits; all others are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

DIGITS = 9
OFF_TIES = 1 + 1e-12
INEXACT = {"ipca_i", "brlusd", "cpi_r", "ipca_r", "p", "ii_prop", "ii_prop_12", "imp_pct_pib_12",
           "ii_ipi_pct_pib_12", "pct_pib", "value", "total", "last", "current", "d", "s"}
INEXACT_MARKS = ("deflated", "_brl", "balance_", "imposto")


def inexact(name: str) -> bool:
    """True for a floating output column that goes through an average, a running product or a sum of doubles."""
    return name in INEXACT or any(m in name for m in INEXACT_MARKS)


def significant(name: str) -> str:
    """SQL for the column rounded to DIGITS significant digits (Spark).

    The factor moves exact ties, which engines round differently, off the
    middle; + 0.0 turns -0.0 into 0.0.
    """
    text = f"format_string('%.{DIGITS - 1}e', {name} * {OFF_TIES!r}D)"
    return f"CASE WHEN {name} IS NOT NULL THEN CAST({text} AS DOUBLE) + 0.0D END"


def stable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        n = "`" + f.name.replace("`", "``") + "`"
        rounded = isinstance(f.dataType, T.DoubleType) and inexact(f.name)
        cols.append(f"{significant(n)} AS {n}" if rounded else n)
    return df.selectExpr(*cols)


def ordered(df: DataFrame, *cols: str, desc: bool = False) -> DataFrame:
    """Final sort for display, NULLs last as the reference sorts (default: by date).

    A global sort is a range-partitioned shuffle; operators never sort, only
    the final step of a report does, if the caller wants ordered rows.
    """
    keys = cols or ("date",)
    return df.orderBy(*[(F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last()) for c in keys])
