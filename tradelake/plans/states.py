"""Aggregates kept beside the lake, refreshed only where a partition was replaced.

A state is a mergeable partial aggregate of one partition's facts: per key,
the number of rows and, for every measure, the sum and the number of non-NULL
values. States of different partitions add up to the aggregate of the whole,
with the NULL rule intact (a sum counts only where every row had a value).
States are published like facts; each remembers the version of the partition
it was made from, so a refresh reads exactly the partitions whose version in
the lake's manifest has changed, drops the states of partitions that are gone,
and leaves all others as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.functions.names import match_prefix
from tradelake.functions.nulls import q
from tradelake.plans import publish
from tradelake.schemas import DEFAULT_PREFIXES

ROWS = "n_rows"


def partial_states(facts: DataFrame, by: Sequence[str], prefixes: Sequence[str] = DEFAULT_PREFIXES) -> DataFrame:
    """(year, direction, by..., n_rows, sum and non-NULL count per measure) of some facts."""
    keys = [*publish.KEYS, *[b for b in by if b not in publish.KEYS]]
    measures = match_prefix(facts.columns, prefixes, exclude=keys)
    if not measures:
        raise ValueError(f"no column matches prefixes {prefixes!r}")
    sums = [x for m in measures for x in (F.sum(F.col(q(m))).alias(f"{m}__sum"), F.count(F.col(q(m))).alias(f"{m}__n"))]
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *sums)


def merge_states(states: DataFrame, by: Sequence[str] | None = None, na_rm: bool = False) -> DataFrame:
    """Sums per ``by`` (any of the states' keys), as ``sum_prefixed`` over the facts gives them."""
    measures = [c.removesuffix("__sum") for c in states.columns if c.endswith("__sum")]
    aggs = []
    for m in measures:
        total, values = f"sum({q(m + '__sum')})", f"sum({q(m + '__n')})"
        whole = f"coalesce({total}, 0)" if na_rm else \
            f"CASE WHEN count(1) = 0 THEN 0 WHEN {values} = sum({ROWS}) THEN {total} END"
        aggs.append(F.expr(whole).alias(m))
    return states.groupBy(*by).agg(*aggs) if by else states.agg(*aggs)


def refresh_states(spark: SparkSession, lake: str, store: str, by: Sequence[str] = ("date",),
                   prefixes: Sequence[str] = DEFAULT_PREFIXES) -> list[publish.Partition]:
    """Bring the states in ``store`` up to the lake's manifest; returns the partitions that were aggregated anew.

    One store holds one choice of keys and measures; another choice is an error, not a mixture.
    """
    facts = publish.manifest(spark, lake)
    if facts is None:
        raise ValueError(f"{lake} has no manifest: publish it with plans.publish")
    have = publish.manifest(spark, store)
    made_from = have.made_from if have else {}
    stale = sorted(p for p, v in facts.versions.items() if made_from.get(p) != v)
    gone = sorted(p for p in made_from if p not in facts.versions)
    if not stale and not gone:
        return []
    states = partial_states(publish.read_version(spark, lake, facts, stale), by, prefixes)
    if have is not None and publish.read_version(spark, store, have, []).columns != [
            *[c for c in states.columns if c not in publish.KEYS], *publish.KEYS]:
        raise ValueError(f"{store} holds states of other keys or measures")
    staged = publish.stage(states, store, sort_by=by)
    try:
        publish.commit(spark, staged, stale, made_from={p: facts.versions[p] for p in stale}, remove=gone)
    except Exception:
        publish.discard(spark, store, staged.version)
        raise
    return stale


def read_states(spark: SparkSession, store: str) -> DataFrame:
    """The states as last refreshed."""
    have = publish.manifest(spark, store)
    if have is None:
        raise ValueError(f"{store} holds no states yet")
    return publish.read_version(spark, store, have)
