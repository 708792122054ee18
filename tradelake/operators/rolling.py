"""Rolling sums over calendar months (and over rows).

``roll_months`` adds ``{col}_{k}`` = sum of ``col`` over the dates in
[date - (k-1) months, date] within the group, NULL while the window starts
before the group's first date, NULL if any value in the frame is NULL.

Plan: the result depends only on (group, month), so the input is first
reduced to one row per (group, month) with a hash aggregate; the RANGE window
then runs on that table, whose size is bounded by groups x months and not by
the number of facts. Rows of an un-aggregated input get their values through a
null-safe equi-join on (group, month), broadcast or shuffled as the planner
finds from the sizes. Building the result starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tradelake.functions.names import match_prefix
from tradelake.functions.nulls import nsum_over, nsum_sql, q
from tradelake.schemas import DEFAULT_PREFIXES

_M = "__month_idx"


def _by(by) -> list[str]:
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def roll_months(df: DataFrame, by: Sequence[str] | str | None = None,
                prefixes: Sequence[str] | str = DEFAULT_PREFIXES, k: int = 12,
                date: str = "date", one_row_per_date: bool = False) -> DataFrame:
    """Add ``{col}_{k}`` rolling sums (double) for every prefix-matched column.

    ``one_row_per_date=True`` runs the window on the input directly, for input
    already reduced to one row per (by, month) such as the output of
    ``sum_prefixed(by=[*by, date])``. The values would be the same on any
    input (tied dates share the frame either way), but on raw facts that plan
    sorts every row of a group in a single task; the default reduces first.

    Un-aggregated input gets the rolled values by a join on (group, month).
    Dates are the first days of months; any other day fails the job, since two
    days of a month would share one total.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    keys = _by(by)
    cols = match_prefix(df.columns, prefixes, exclude=keys + [date])
    if not cols:
        raise ValueError(f"no column matches prefixes {prefixes!r}")
    d = q(date)
    m = (f"CASE WHEN {d} IS NULL THEN raise_error('roll_months: NULL date') "
         f"WHEN day({d}) <> 1 THEN raise_error('roll_months: a date is not the first of its month') ELSE year({d}) * 12 + month({d}) END")

    if one_row_per_date:
        base = df.selectExpr("*", f"{m} AS {_M}")
    else:
        base = df.groupBy(*keys, F.expr(f"{m} AS {_M}")).agg(*[F.expr(f"{nsum_sql(c)} AS {q(c)}") for c in cols])

    # SQL text, passed as one list per projection; the group's first month
    # and the frame's row count are computed once for all columns
    part = f"PARTITION BY {', '.join(q(x) for x in keys)}" if keys else ""
    frame = f"({part} ORDER BY {_M} RANGE BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    windows = [f"min({_M}) OVER ({part}) AS __first", f"count(1) OVER {frame} AS __n"]
    for i, c in enumerate(cols):
        windows += [f"count({q(c)}) OVER {frame} AS __c{i}", f"sum({q(c)}) OVER {frame} AS __s{i}"]
    base = base.selectExpr("*", *windows)
    rolled = [f"CAST(CASE WHEN {_M} - {k - 1} >= __first AND __c{i} = __n THEN __s{i} END AS DOUBLE) "
              f"AS {q(c + '_' + str(k))}" for i, c in enumerate(cols)]

    if one_row_per_date:
        return base.selectExpr(*[q(c) for c in df.columns], *rolled)

    small = base.selectExpr(*[f"{q(c)} AS __k{i}" for i, c in enumerate(keys)], f"{_M} AS __m2", *rolled)
    joined = df.selectExpr("*", f"{m} AS {_M}")
    cond = [joined[c].eqNullSafe(small[f"__k{i}"]) for i, c in enumerate(keys)] + [joined[_M] == small["__m2"]]
    out = joined.join(small, cond, "left")
    return out.select(*[joined[c] for c in df.columns], *[small[f"{c}_{k}"] for c in cols])


def roll_rows(df: DataFrame, column: str, n: int = 12, order: str = "date",
              by: Sequence[str] | str | None = None, name: str | None = None) -> DataFrame:
    """Sum over the current and previous ``n-1`` rows; NULL unless all ``n`` exist.

    Meant for short series (one row per period): without ``by`` the window is a
    single partition, which is only acceptable because such a series is tiny.
    """
    keys = _by(by)
    part = Window.partitionBy(*keys) if keys else Window.partitionBy()
    frame = part.orderBy(order).rowsBetween(-(n - 1), 0)
    full = F.count(F.lit(1)).over(frame) == n
    out = F.when(full, nsum_over(column, frame)).cast("double")
    return df.withColumn(name or f"{column}_rows{n}", out)
