"""The partitioned Parquet lake (year=/direction= directories)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradelake.plans import publish
from tradelake.session import file_system


def lake_years(spark: SparkSession, path: str) -> list[int]:
    """Years of the lake's partitions, from its manifest or its directory names."""
    state = publish.manifest(spark, path)
    if state is not None:
        return sorted({y for y, _ in state.versions})
    fs, pattern = file_system(spark, f"{path.rstrip('/')}/year=*")
    names = [s.getPath().getName().split("=", 1)[1] for s in fs.globStatus(pattern) or []]
    return sorted(int(n) for n in names if n.isdigit())


def _open(spark: SparkSession, path: str, last_years: int | None, number: int | None) -> DataFrame:
    state = publish.manifest(spark, path, number)
    facts = spark.read.parquet(path) if state is None else publish.read_version(spark, path, state)
    if last_years is None:
        return facts
    years = lake_years(spark, path) if number is None else sorted({y for y, _ in state.versions})
    # a bound on the partition key, so older directories are not read
    return facts.where(F.col("year") >= (years[-1] - last_years + 1 if years else 0))


def open_ncm(spark: SparkSession, path: str, last_years: int | None = None, manifest: int | None = None) -> DataFrame:
    """NCM facts as the newest manifest (or the one of that number) has them; a folder without one is read as it is.

    Filters on year / direction prune directories; ``last_years`` bounds the
    years by the lake's latest one.
    """
    return _open(spark, path, last_years, manifest)


def open_hs4(spark: SparkSession, path: str, last_years: int | None = None, manifest: int | None = None) -> DataFrame:
    """HS4 facts, as ``open_ncm``."""
    return _open(spark, path, last_years, manifest)
