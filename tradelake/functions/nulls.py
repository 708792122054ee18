"""NULL-propagating aggregates and safe arithmetic.

The reference sums without dropping missing values, so one NULL makes the
whole group NULL. Spark's ``sum`` skips NULLs; ``nsum`` restores the rule with
two counters that stay inside the partial/final hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def q(name: str) -> str:
    """Back-quoted column name for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def nsum_sql(name: str, na_rm: bool = False) -> str:
    """SQL text of ``nsum`` over column ``name``."""
    c = q(name)
    if na_rm:
        return f"coalesce(sum({c}), 0)"
    return f"CASE WHEN count(1) = 0 THEN 0 WHEN count({c}) = count(1) THEN sum({c}) END"


def nsum(x, na_rm: bool = False) -> Column:
    """Sum that is NULL if any input is NULL (``na_rm=False``).

    With ``na_rm=True`` NULLs are skipped and an all-NULL group gives 0.
    Zero rows give 0, as a sum over nothing does in the reference.
    A column given by name is built as one SQL expression.
    """
    if isinstance(x, str):
        return F.expr(nsum_sql(x, na_rm))
    c = x
    if na_rm:
        return F.coalesce(F.sum(c), F.lit(0))
    n_all = F.count(F.lit(1))
    return (F.when(n_all == 0, F.lit(0))
             .when(F.count(c) == n_all, F.sum(c)))


def nsum_over(x, window) -> Column:
    """Window form of ``nsum``: NULL if any row in the frame is NULL."""
    c = _c(x)
    return F.when(F.count(c).over(window) == F.count(F.lit(1)).over(window), F.sum(c).over(window))


def ratio(num, den) -> Column:
    """num / den; NULL for a zero or NULL divisor (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))
