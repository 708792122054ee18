"""Product-code cleaning (8-digit NCM codes by default).

``clean_code`` keeps the digits of a code and turns an empty result into NULL.
``check_codes`` validates lengths inside the plan: strict mode fails the job
with ``raise_error`` on the first bad code, report mode adds a flag column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.schemas import INVALID_CODES


def clean_code(x, nchar: int | None = None) -> Column:
    """Digits of ``x``; NULL when no digit remains.

    With ``nchar`` the result fails the job (strict) when a non-NULL code does
    not have exactly ``nchar`` digits. Codes without any digit become NULL and
    pass, as in the reference.
    """
    c = F.col(x) if isinstance(x, str) else x
    digits = F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))
    if nchar is None:
        return digits
    return F.when(digits.isNull() | (F.length(digits) == nchar), digits).otherwise(
        F.raise_error(F.lit(INVALID_CODES)))


def check_codes(df: DataFrame, column: str, nchar: int = 8, strict: bool = True,
                flag: str = "code_valid") -> DataFrame:
    """Clean ``column`` in place; strict raises, otherwise adds ``flag``."""
    cleaned = clean_code(column)
    if strict:
        return df.withColumn(column, clean_code(column, nchar))
    return (df.withColumn(column, cleaned)
              .withColumn(flag, F.col(column).isNull() | (F.length(column) == nchar)))


def code_label(code: str, name: str) -> Column:
    """``code: name``, the display label of a coded member; the code alone where the name is NULL."""
    return F.concat_ws(": ", F.col(code).cast("string"), F.col(name))
