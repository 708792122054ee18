"""Scans of landed official CSV files.

Format of the official files: ';' separated, header line, latin1, decimal
comma. Code columns are read as strings (type inference would drop leading
zeros), control totals as decimals (which accept a decimal comma under a
pt-BR locale). Fact files are read by the paths of the file list, with a
positional schema against which every header line is checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tradelake.functions.names import clean_names
from tradelake.schemas import (CSV_OPTIONS, HS4_RAW_SCHEMA, LONG_MEASURES, NCM_EXP_SCHEMA, NCM_HEADER, NCM_IMP_SCHEMA, RENAME,
                               control_schema)
from tradelake.sources.manifest import LandedFile, as_table, landing_manifest


def _reader(spark: SparkSession, schema=None):
    r = spark.read.options(**CSV_OPTIONS).option("locale", "pt-BR")
    return r.schema(schema) if schema is not None else r.option("inferSchema", "false")


def rename_standard(df: DataFrame) -> DataFrame:
    """Lower-case names, apply the standard rename map, cast codes and measures."""
    cols = []
    for c in df.columns:
        n = RENAME.get(c.lower(), c.lower())
        e = F.col(f"`{c}`")
        if n == "country_code":
            e = e.cast("int")
        elif n == "ncm":
            e = e.cast("string")
        elif n in LONG_MEASURES:
            e = e.cast("bigint")
        cols.append(e.alias(n))
    return df.select(*cols)


def read_table(spark: SparkSession, table: str, directory: str, extension: str = ".csv") -> DataFrame:
    """One official table: clean names, standard renames; control tables typed."""
    path = f"{directory.rstrip('/')}/{table}{extension}"
    schema = control_schema(table, decimal=True)
    df = _reader(spark, schema).csv(path)
    df = df.toDF(*clean_names(df.columns))
    if schema is None:
        return rename_standard(df)
    # measures go from decimal to 64-bit integers directly, as doubles would lose digits beyond 2^53
    df = rename_standard(df)
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("year", "number_of_lines") else F.col(c)
                       for c in df.columns])


def read_control(spark: SparkSession, directory: str, mun: bool = False) -> DataFrame:
    """Import and export control files, row-bound; missing columns are NULL."""
    suffix = "_mun" if mun else ""
    imp = read_table(spark, f"imp_totais_conferencia{suffix}", directory)
    exp = read_table(spark, f"exp_totais_conferencia{suffix}", directory)
    return imp.unionByName(exp, allowMissingColumns=True)


#: Helper columns of ``read_landed(probe=True)``.
PROBE = ("_corrupt_record", "__path")
_KINDS = {"ncm": {"imp": (NCM_IMP_SCHEMA, NCM_HEADER), "exp": (NCM_EXP_SCHEMA, NCM_HEADER[:len(NCM_EXP_SCHEMA)])},
          "hs4": {d: (HS4_RAW_SCHEMA, tuple(HS4_RAW_SCHEMA.names)) for d in ("imp", "exp")}}


def landed_files(spark: SparkSession, base: str, kind: str | None = None) -> DataFrame:
    """(direction, year, file) of the official files below ``base``: a listing, no file is read."""
    return as_table(spark, landing_manifest(spark, base, kind)).select("direction", "year", "file")


def read_landed(spark: SparkSession, files: Sequence[LandedFile], kind: str, probe: bool = False,
                check_header: bool = True) -> DataFrame:
    """Facts of the listed files, one scan per direction over their paths.

    The columns are taken by position; each file's header must hold the
    official names in the official order, as far as columns are read, else the
    scan fails and names the file (``check_header=False`` takes any header). With ``probe`` the text of rows
    that can't be parsed (``_corrupt_record``) and the file's path come along.
    """
    frames = []
    for direction, (schema, header) in _KINDS[kind].items():
        paths = [f.path for f in files if f.kind == kind and f.direction == direction]
        official = StructType([StructField(h, f.dataType) for h, f in zip(header, schema.fields)])
        if not paths:
            raw = spark.createDataFrame([], official)
        else:
            read = official.add(PROBE[0], "string") if probe else official
            raw = _reader(spark, read).option("enforceSchema", "false" if check_header else "true")
            if probe:
                raw = raw.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", PROBE[0])
            raw = raw.csv(paths)
        if probe:
            path = F.col("_metadata.file_path") if paths else F.lit(None).cast("string")
            broken = F.col(PROBE[0]) if paths else F.lit(None).cast("string")
            extra = [broken.alias(PROBE[0]), path.alias(PROBE[1])]
        else:
            extra = []
        named = [F.col(h).alias(f.name) for h, f in zip(header, schema.fields)]
        frames.append(raw.select(*named, *extra).withColumn("direction", F.lit(direction)))
    if kind == "ncm":
        from tradelake.plans.ingest import standardize_union
        return standardize_union(frames)
    both = rename_standard(frames[0].unionByName(frames[1]))
    return both.withColumn("date", F.make_date("year", "month", F.lit(1)))


def read_ncm_raw(spark: SparkSession, base: str) -> DataFrame:
    """NCM facts from the official files in ``base/direction=imp|exp``, with positional schemas.

    Direction comes from the directory; date and cif_usd are derived.
    """
    return read_landed(spark, landing_manifest(spark, base, "ncm"), "ncm")


def read_hs4_raw(spark: SparkSession, base: str) -> DataFrame:
    """HS4 facts from the municipality files in ``base/direction=imp|exp``."""
    return read_landed(spark, landing_manifest(spark, base, "hs4"), "hs4")


def file_counts(spark: SparkSession, base: str | list[str], schema=NCM_IMP_SCHEMA, year: str = "year",
                strict: bool = False) -> DataFrame:
    """Rows, unreadable rows and empty cells per landed file and year (the landing probe).

    Columns: file_path, file_name, year, rows, bad_rows, null_cells. Every
    column is referenced (through ``null_cells``), so the CSV reader parses
    all values and a malformed one marks its row as bad. Input files are
    never deleted; ``strict=True`` fails the job instead.
    """
    s = StructType(list(schema.fields)).add("_corrupt_record", "string")
    df = (_reader(spark, s).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(base))
    empty = " + ".join(f"CASE WHEN `{f.name}` IS NULL THEN 1 ELSE 0 END" for f in schema.fields)
    out = df.groupBy(F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name"), F.col(year)).agg(
        F.count(F.lit(1)).alias("rows"), F.count("_corrupt_record").alias("bad_rows"),
        F.expr(f"sum({empty}) AS null_cells"))
    if strict:
        out = out.withColumn("bad_rows", F.when(F.col("bad_rows") > 0,
                                                F.raise_error(F.lit("Landed files hold unreadable rows."))).otherwise(F.col("bad_rows")))
    return out
