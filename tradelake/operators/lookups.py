"""Code-table enrichment.

``merge_lookups`` folds left joins over all columns the tables share (a
natural join), then casts every column to string; ``partner_labels`` collapses member countries of chosen blocks into
the block's name. Lookups are not broadcast by hint: the planner broadcasts a
side only after measuring it, and falls back to a shuffle join beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


DUPLICATE_KEY = "Lookup key is not unique."


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, but the job fails if two rows share ``keys`` (checked in the plan)."""
    part = ", ".join(f"`{k}`" for k in keys)
    guard = f"CASE WHEN count(1) OVER (PARTITION BY {part}) > 1 THEN raise_error('{DUPLICATE_KEY}') END"
    # the filter keeps the guard column from being pruned away
    return df.selectExpr("*", f"{guard} AS __dup").where("__dup IS NULL").drop("__dup")


def natural_left_join(left: DataFrame, right: DataFrame, check_unique: bool = False) -> DataFrame:
    on = [c for c in left.columns if c in set(right.columns)]
    if not on:
        raise ValueError("natural join without common columns")
    if check_unique:
        right = unique_on(right, on)
    # NULL keys match NULL keys, as in an in-memory merge
    r = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") for c in right.columns])
    cond = [left[c].eqNullSafe(r[f"__r_{c}"]) for c in on]
    return left.join(r, cond, "left").select(
        *[left[c] for c in left.columns], *[r[f"__r_{c}"].alias(c) for c in right.columns if c not in set(on)])


def merge_lookups(tables: Sequence[DataFrame], as_string: bool = True, check_unique: bool = False) -> DataFrame:
    """Left-join the tables in order on their common columns; all columns to string.

    With ``check_unique`` every joined table must be unique on the columns it
    is joined on (a duplicate would multiply rows); the job fails otherwise.
    """
    merged = reduce(lambda a, b: natural_left_join(a, b, check_unique), tables)
    if as_string:
        merged = merged.select(*[F.col(c).cast("string").alias(c) for c in merged.columns])
    return merged


def partner_labels(countries: DataFrame, blocks: DataFrame, collapse: Sequence[int],
                   label: str = "partner") -> DataFrame:
    """(country_code, partner): the name of the first listed block a country
    belongs to, else the country's own name.

    ``blocks`` is (country_code, block_code, block_name) and may list a
    country in several blocks; membership is reduced to one row per country
    before joining, so the result never fans out.
    """
    flags = [F.max(F.when(F.col("block_code") == b, F.col("block_name"))).alias(f"__b{i}")
             for i, b in enumerate(collapse)]
    member = blocks.where(F.col("block_code").isin(list(collapse))).groupBy("country_code").agg(*flags)
    j = countries.join(member, "country_code", "left")
    name = F.coalesce(*[F.col(f"__b{i}") for i in range(len(collapse))], F.col("country_name"))
    return j.select("country_code", name.alias(label))
