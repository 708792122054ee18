"""Landing -> validated, partitioned Parquet lake.

``publish_lake`` writes facts partitioned by (year, direction) and replaces
only the partitions present in the new data (dynamic overwrite). The write
is rebalanced on the partition keys: adaptive execution splits a hot
(year, direction) into several tasks and merges small ones, so one huge
partition never lands on a single writer. ``ingest`` and ``rewrite`` publish
through ``plans.publish``: staged, checked, then visible as a whole.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.operators.checks import MISMATCH, coverage_grid, missing_partitions, reconcile
from tradelake.plans import publish
from tradelake.schemas import (CSV_OPTIONS, HS4_RAW_SCHEMA, NCM_EXP_FIELDS, NCM_EXP_SCHEMA, NCM_HEADER, NCM_IMP_FIELDS,
                               NCM_IMP_SCHEMA, OFFICIAL_PATH)
from tradelake.session import scratch_path
from tradelake.sources.manifest import as_table, landing_manifest
from tradelake.sources.trade_csv import PROBE, file_counts, landed_files, read_landed

SORT = {"ncm": ("ncm", "month"), "hs4": ("hs4", "month")}


def standardize_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name (absent columns NULL) and derive direction, date, cif_usd.

    ``direction`` is kept when a frame carries it (the path label); otherwise
    it is exp when freight is NULL, else imp.
    """
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = u.columns
    if "freight_usd" not in cols:
        u = u.withColumn("freight_usd", F.lit(None).cast("bigint"))
    if "insurance_usd" not in cols:
        u = u.withColumn("insurance_usd", F.lit(None).cast("bigint"))
    heuristic = F.when(F.col("freight_usd").isNull(), F.lit("exp")).otherwise(F.lit("imp"))
    direction = F.coalesce(F.col("direction"), heuristic) if "direction" in cols else heuristic
    return u.select(
        *[c for c in u.columns if c != "direction"],
        direction.alias("direction"),
        F.make_date("year", "month", F.lit(1)).alias("date"),
        (F.col("fob_usd") + F.col("freight_usd") + F.col("insurance_usd")).alias("cif_usd"))


def publish_lake(facts: DataFrame, path: str | None = None, partition_by: Sequence[str] = ("year", "direction"),
                 sort_by: Sequence[str] = ("ncm", "month")) -> str:
    """Write facts as Parquet partitioned by (year, direction); returns the path."""
    spark = facts.sparkSession
    path = path or scratch_path(spark, "lake")
    keys = list(partition_by)
    cols = [c for c in facts.columns if c not in keys] + keys
    sort = [c for c in sort_by if c in facts.columns]
    (facts.select(*cols)
          .hint("rebalance", *keys)
          .sortWithinPartitions(*keys, *sort)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*keys).parquet(path))
    return path


def rewrite(data: DataFrame, base: str, control: DataFrame | None = None) -> tuple[str, DataFrame | None]:
    """Publish NCM or HS4 facts (chosen by the presence of ``ncm``) under ``base``.

    With ``control`` the totals are checked first: a mismatch raises and
    nothing is written. Returns the dataset path and, with ``control``, the
    (lazy) reconciliation report of what was written.
    """
    if control is not None:
        check_totals(data, control)
    kind = "ncm" if "ncm" in data.columns else "hs4"
    path = f"{base.rstrip('/')}/{kind}"
    publish.publish(data, path, sort_by=SORT[kind])
    report = None
    if control is not None:
        report = reconcile(publish.read_version(data.sparkSession, path, publish.manifest(data.sparkSession, path)), control)
    return path, report


def check_totals(data: DataFrame, control: DataFrame, years: Sequence[int] | None = None,
                 directions: Sequence[str] | None = None) -> None:
    """Raise if a control row that the facts cover does not match; warn of control rows that they don't cover.

    The report is filtered and its findings named; an error raised
    inside the plan could be pushed below the join, to facts without a control row.
    """
    report = reconcile(data, control, years=years, directions=directions)
    # one row per control file and measure at most
    found = report.where(F.col("status") != "ok").select("file", "status", "measure", "expected", "actual").collect()
    bad = sorted((r for r in found if r["status"] == "mismatch"), key=lambda r: (r["file"] or "", r["measure"]))
    if bad:
        raise ValueError(MISMATCH + " " + "; ".join(
            f"{r['file']}: {r['measure']} {r['actual']} for {r['expected']}" for r in bad[:5]))
    uncovered = sorted({r["file"] or "" for r in found})
    if uncovered:
        warnings.warn("control rows without facts: " + ", ".join(uncovered), stacklevel=2)


def land_as_csv(facts: DataFrame, path: str | None = None, file_year: str = "year",
                header: dict[str, str] | None = None) -> str:
    """Write facts in the official landing layout (for tests and benchmarks).

    ``path/direction=imp`` holds import files with 13 columns,
    ``path/direction=exp`` export files with 11, ';' separated with header;
    each official file is a folder ``file=IMP_YYYY.csv`` of part files.
    ``file_year`` names the file a row goes to, ``header`` renames columns of the header line.
    """
    spark = facts.sparkSession
    path = path or scratch_path(spark, "landing")
    for d, fields in (("imp", NCM_IMP_FIELDS), ("exp", NCM_EXP_FIELDS)):
        names = [n for n, _ in fields]
        heads = [(header or {}).get(h, h) for h in NCM_HEADER[: len(names)]]
        out = facts.where(F.col("direction") == d).select(
            *[F.col(n).alias(h) for n, h in zip(names, heads)],
            F.format_string(f"{d.upper()}_%d.csv", F.col(file_year)).alias("file"))
        out.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy("file").csv(f"{path}/direction={d}")
    return path


def land_hs4_as_csv(facts: DataFrame, path: str | None = None, mode: str = "overwrite") -> str:
    """Write HS4 facts as official CSVs under ``path/direction=imp|exp``."""
    spark = facts.sparkSession
    path = path or scratch_path(spark, "landing-hs4")
    names = {"year": "CO_ANO", "month": "CO_MES", "hs4": "SH4", "country_code": "CO_PAIS",
             "state_abb": "SG_UF_MUN", "mun_code": "CO_MUN", "kg_net": "KG_LIQUIDO", "fob_usd": "VL_FOB"}
    out = facts.select(*[F.col(k).alias(v) for k, v in names.items()], "direction",
                       F.format_string("%s_%d_MUN.csv", F.upper("direction"), F.col("year")).alias("file"))
    out.write.mode(mode).options(**CSV_OPTIONS).partitionBy("direction", "file").csv(path)
    return path


def land_table_csv(df: DataFrame, path: str, decimal_comma: bool = False) -> str:
    """Write one official-style table (';', header, latin1) as ``path`` (a folder).

    With ``decimal_comma`` doubles are written as text with a decimal comma.
    """
    cols = []
    for f in df.schema.fields:
        if decimal_comma and f.dataType.typeName() == "double":
            cols.append(F.regexp_replace(F.format_string("%.2f", F.col(f.name)), r"\.", ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    df.select(*cols).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def landing_report(spark: SparkSession, landing: str, kind: str = "ncm") -> DataFrame:
    """Rows, unreadable rows and empty cells of each official file (direction, year, file, rows, bad_rows, null_cells).

    The empty cells stay in the report: without them the reader would skip
    columns, and with them the values that make a row unreadable.
    """
    files = landing_manifest(spark, landing, kind)
    frames = []
    for direction, schema in (("imp", NCM_IMP_SCHEMA), ("exp", NCM_EXP_SCHEMA)):
        paths = [f.path for f in files if f.direction == direction]
        if paths:
            frames.append(file_counts(spark, paths, schema=schema if kind == "ncm" else HS4_RAW_SCHEMA,
                                      year="year" if kind == "ncm" else "CO_ANO"))
    if not frames:
        return spark.createDataFrame([], "direction string, year int, file string, rows bigint, bad_rows bigint, null_cells bigint")
    counts = reduce(DataFrame.unionByName, frames)
    hit = lambda k: F.regexp_extract("file_path", OFFICIAL_PATH, k)
    return counts.groupBy(
        F.lower(hit(1)).alias("direction"), hit(2).cast("int").alias("year"),
        F.concat(F.upper(hit(1)), F.lit("_"), hit(2), F.upper(hit(3)), F.lit(".csv")).alias("file")).agg(
        F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"), F.sum("null_cells").alias("null_cells"))


def missing_files(spark: SparkSession, landing: str, years: Sequence[int], directions: Sequence[str] = ("imp", "exp"),
                  kind: str = "ncm") -> DataFrame:
    """Requested (year, direction, type) without an official landed file, by file name."""
    grid = coverage_grid(spark, years, directions, [kind])
    return missing_partitions(grid, landed_files(spark, landing, kind).withColumn("type", F.lit(kind)))


def landing_table(spark: SparkSession, landing: str) -> DataFrame:
    """The landed official files of every kind: kind, direction, year, file, path, bytes, modified."""
    return as_table(spark, landing_manifest(spark, landing))


def ingest(spark: SparkSession, landing: str, lake: str, years: Sequence[int] | None = None,
           directions: Sequence[str] = ("imp", "exp"), control: DataFrame | None = None,
           kind: str = "ncm") -> str:
    """Landing CSVs -> staged version -> checks -> manifest switch; a failed check raises and the lake reads as before.

    ``kind`` is ``ncm`` or ``hs4`` (municipality files); files of the other
    kind in the same folders are not read. The partitions to publish are named
    by the files: every requested year and direction must have one (all landed
    files, if no years are given), and every row must have the year of its
    file's name. The files are parsed once, by a scan that also counts
    unreadable rows and rows of another year and checks the headers; the totals are
    compared with ``control``, if given, on the staged Parquet.
    """
    if kind not in ("ncm", "hs4"):
        raise ValueError("kind must be 'ncm' or 'hs4'")
    files = landing_manifest(spark, landing, kind, years, directions)
    named = {(f.year, f.direction) for f in files}
    wanted = named if years is None else {(y, d) for y in years for d in directions}
    if wanted - named or not wanted:
        absent = sorted(f"{d} {y}" for y, d in wanted - named)
        raise ValueError("no landed file" + (" for " + ", ".join(absent) if absent else f" of kind {kind} in {landing}"))
    rows = read_landed(spark, files, kind, probe=True)
    corrupt, path = F.col(PROBE[0]), F.col(PROBE[1])
    label = F.concat(F.lit("/"), F.upper("direction"), F.lit("_"), F.col("year").cast("string"),
                     F.lit("_MUN.CSV" if kind == "hs4" else ".CSV"))
    # a folder of part files may be called file=IMP_2024.csv
    name = F.regexp_replace(F.upper(path), "/FILE=", "/")
    stray = corrupt.isNull() & ~F.coalesce(F.contains(name, label), F.lit(False))
    observe = {"rows": F.count(F.lit(1)), "bad_rows": F.count(corrupt), "stray_rows": F.count_if(stray)}
    try:
        staged = publish.stage(rows, lake, SORT[kind], observe, drop=PROBE)
    except Exception as e:
        header = re.search(r"CSV file: (\S+)", str(e))
        if header and "header" in str(e):
            raise ValueError(f"the header is not the official one in {header[1]}") from e
        raise
    try:
        if staged.metrics["bad_rows"]:
            report = landing_report(spark, landing, kind).where("bad_rows > 0")
            names = [f.file for f in files]
            bad = report.where(F.col("file").isin(names)).orderBy("file", "null_cells").take(20)  # enough to name
            raise ValueError("unreadable rows in " + ", ".join(f"{r['file']} ({r['bad_rows']})" for r in bad))
        if staged.metrics["stray_rows"]:
            there = rows.where(stray).groupBy(path.alias("path"), "year").count().orderBy("path", "year").take(20)
            raise ValueError("rows of another year than their file's: " + ", ".join(
                f"{r['path'].rsplit('direction=', 1)[-1]} holds {r['count']} of {r['year']}" for r in there))
        if control is not None:
            check_totals(publish.staged_facts(spark, staged), control, years, directions)
        publish.commit(spark, staged, wanted)
    except Exception:
        publish.discard(spark, lake, staged.version)
        raise
    return lake
