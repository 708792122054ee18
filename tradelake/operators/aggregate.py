"""Prefix-driven aggregation.

``sum_prefixed`` sums every column whose name starts with one of the prefixes,
per explicit ``by`` keys, keeping the column names. The sums are one hash
aggregate (partial on the map side, final after the shuffle), so a hot key is
pre-combined in every task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.functions.names import match_prefix
from tradelake.functions.nulls import nsum, nsum_sql, q, ratio
from tradelake.schemas import DEFAULT_PREFIXES


def _keys(by) -> list:
    if by is None:
        return []
    if isinstance(by, (str, Column)):
        return [by]
    return list(by)


def _key_names(df: DataFrame, keys: list) -> list[str]:
    return [k for k in keys if isinstance(k, str)]


def sum_prefixed(df: DataFrame, by: Sequence | str | None = None,
                 prefixes: Sequence[str] | str = DEFAULT_PREFIXES, na_rm: bool = False) -> DataFrame:
    """Sum columns matched by prefix per ``by`` (NULL-poisoning unless ``na_rm``).

    ``by`` may hold column names or aliased expressions (a computed key such as
    ``(col('country_code') == 160).alias('partner')``). No ``by`` gives one row.
    """
    keys = _keys(by)
    cols = match_prefix(df.columns, prefixes, exclude=_key_names(df, keys))
    aggs = [F.expr(f"{nsum_sql(c, na_rm)} AS {q(c)}") for c in cols]
    if not aggs:
        raise ValueError(f"no column matches prefixes {prefixes!r}")
    if keys:
        return df.groupBy(*keys).agg(*aggs)
    return df.agg(*aggs)


def share_of_sums(df: DataFrame, by: Sequence | str | None, num: str, den: str,
                  name: str = "p", na_rm_num: bool = False, na_rm_den: bool = False) -> DataFrame:
    """sum(num) and sum(den) per ``by`` plus their ratio (NULL for a zero divisor)."""
    keys = _keys(by)
    out = df.groupBy(*keys) if keys else df
    agg = [nsum(den, na_rm_den).alias(den), nsum(num, na_rm_num).alias(num)]
    res = out.agg(*agg)
    return res.withColumn(name, ratio(num, den))
