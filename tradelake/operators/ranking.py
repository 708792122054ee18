"""Top-k and per-group argmax.

``top_k`` is a global sort + limit, which Spark plans as a take-ordered
(each task keeps its own k best, the driver merges k x tasks rows).
``first_per_group`` keeps the best row per group with ``row_number() = 1``,
which Spark turns into a group limit that also runs before the shuffle.
Ties are broken by explicit secondary keys so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _order(desc: Sequence[str], asc: Sequence[str]):
    return [F.col(c).desc_nulls_last() for c in desc] + [F.col(c).asc_nulls_last() for c in asc]


def top_k(df: DataFrame, k: int, desc: Sequence[str] | str, tiebreak: Sequence[str] | str = ()) -> DataFrame:
    desc = [desc] if isinstance(desc, str) else list(desc)
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return df.orderBy(*_order(desc, tiebreak)).limit(k)


def first_per_group(df: DataFrame, by: Sequence[str] | str, desc: Sequence[str] | str,
                    tiebreak: Sequence[str] | str = ()) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    desc = [desc] if isinstance(desc, str) else list(desc)
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    w = Window.partitionBy(*by).orderBy(*_order(desc, tiebreak))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
