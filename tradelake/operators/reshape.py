"""Wide <-> long reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def longer(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "name",
           value: str = "value") -> DataFrame:
    """One row per (ids, value column): Spark's native unpivot."""
    return df.unpivot(list(ids), list(values), name, value)


def wider(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
          names: Sequence) -> DataFrame:
    """Spread ``values_from`` into one column per listed name.

    The name list is given, so the pivot needs no extra job to find it. Each
    (ids, name) must be unique; the value is taken as is.
    """
    return df.groupBy(*ids).pivot(names_from, list(names)).agg(F.first(values_from))
