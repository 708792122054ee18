"""Data-quality operators: reconciliation with control totals and coverage.

``reconcile`` compares per-(year, direction) fact totals with the official
control rows. One left join on (year, direction) answers all of the
reference's questions at once: a control row without facts is *uncovered*,
a row whose measures all match null-safely (NULL equals NULL, as the export
files lack freight and insurance) is *ok*, anything else is a *mismatch*.
The fact side is a hash aggregate (years x directions rows), so the join
is between two small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.functions.names import match_prefix
from tradelake.functions.nulls import nsum, q
from tradelake.schemas import CHECK_MEASURES

MISMATCH = "Fact totals differ from the control totals."


def control_direction(control: DataFrame) -> DataFrame:
    """direction = imp if the file name contains IMP, else exp (NULL -> exp)."""
    return control.withColumn(
        "direction", F.when(F.col("file").contains("IMP"), F.lit("imp")).otherwise(F.lit("exp")))


def fact_totals(data: DataFrame, measures: Sequence[str] = CHECK_MEASURES) -> DataFrame:
    """(year, direction, sums..., number_of_lines) with NULL-poisoning sums."""
    cols = match_prefix(data.columns, measures, exclude=["year", "direction"])
    aggs = [nsum(c).alias(c) for c in cols]
    if "number_of_lines" in measures and "number_of_lines" not in cols:
        aggs.append(F.count(F.lit(1)).alias("number_of_lines"))
    return data.groupBy("year", "direction").agg(*aggs)


def reconcile(data: DataFrame, control: DataFrame, measures: Sequence[str] = CHECK_MEASURES,
              strict: bool = False, years: Sequence[int] | None = None,
              directions: Sequence[str] | None = None) -> DataFrame:
    """Long report (year, direction, file, status, measure, expected, actual).

    ``control`` has ``file``, ``year`` and the measure columns its files carry
    (missing ones count as NULL). Totals are compared as exact decimals and
    reported as 64-bit integers. ``strict=True`` fails the job on a mismatch.
    ``years`` / ``directions`` restrict both sides (partition filters on a lake).
    """
    if "direction" not in control.columns:
        control = control_direction(control)
    if years is not None:
        data = data.where(F.col("year").isin(list(years)))
        control = control.where(F.col("year").isin(list(years)))
    if directions is not None:
        data = data.where(F.col("direction").isin(list(directions)))
        control = control.where(F.col("direction").isin(list(directions)))
    totals = fact_totals(data, measures)
    shared = [m for m in totals.columns if m in set(control.columns) and m not in ("year", "direction")]
    t = totals.selectExpr("CAST(year AS INT) AS __y", "direction AS __d", "true AS __present",
                          *[f"CAST({q(m)} AS DECIMAL(38, 4)) AS {q('__a_' + m)}" for m in shared])
    c = control.selectExpr("CAST(year AS INT) AS year", "direction", "file",
                           *[f"CAST({q(m)} AS DECIMAL(38, 4)) AS {q(m)}" for m in shared])
    # one row per (year, direction): bounded by the calendar, broadcast
    t = F.broadcast(t)
    j = c.join(t, (c.year == t.__y) & (c.direction == t.__d), "left")
    same = " AND ".join(f"({q(m)} <=> {q('__a_' + m)})" for m in shared) or "true"
    status = f"CASE WHEN __present IS NULL THEN 'uncovered' WHEN {same} THEN 'ok' ELSE 'mismatch' END"
    if strict:
        status = f"CASE WHEN ({status}) = 'mismatch' THEN raise_error('{MISMATCH}') ELSE ({status}) END"
    pairs = ", ".join(f"struct('{m}' AS measure, CAST({q(m)} AS BIGINT) AS expected, CAST({q('__a_' + m)} AS BIGINT) AS actual)" for m in shared)
    return j.selectExpr("year", "direction", "file", f"{status} AS status", f"inline(array({pairs}))")


def coverage_grid(spark: SparkSession, years: Sequence[int], directions: Sequence[str],
                  types: Sequence[str]) -> DataFrame:
    """Expected (year, direction, type) partitions, generated from the request."""
    g = spark.range(1).select(F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("year"))
    g = g.select("year", F.explode(F.array(*[F.lit(d) for d in directions])).alias("direction"))
    return g.select("year", "direction", F.explode(F.array(*[F.lit(t) for t in types])).alias("type"))


def _grid_keys(present: DataFrame) -> list[str]:
    return [k for k in ("year", "direction", "type") if k in present.columns]


def missing_partitions(grid: DataFrame, present: DataFrame) -> DataFrame:
    """Grid rows with nothing in ``present`` (e.g. the landed files): (..., status='missing')."""
    keys = _grid_keys(present)
    return grid.join(present.select(*keys).distinct(), on=keys, how="left_anti").withColumn("status", F.lit("missing"))


def covered_partitions(grid: DataFrame, present: DataFrame) -> DataFrame:
    """Grid rows that ``present`` covers: (..., status='landed')."""
    keys = _grid_keys(present)
    return grid.join(present.select(*keys).distinct(), on=keys, how="left_semi").withColumn("status", F.lit("landed"))
