"""The deflator table, persisted per state of its series.

Building the table scans the daily quotes and runs three windows; reports only
need its few hundred rows. ``persist_deflators`` builds and writes it once per
*state*, a text that says what the series looked like (their files with size
and time, the month, the options); a report asks for the state it needs and
gets that table or none, so an out-of-date table is never read. Months with a
NULL and repeated dates are counted by the write itself: repeats fail it,
NULLs give a warning.
"""

from __future__ import annotations

import hashlib
import uuid
import warnings
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tradelake.operators.deflators import DUPLICATED
from tradelake.session import delete_path, file_system

SCHEMA = "date date, ipca double, ipca_i double, brlusd double, cpi double"


def series_state(spark: SparkSession, paths: Iterable[str], *options) -> str:
    """What a set of series files looks like now: every file's path, size and time, and the options given."""
    seen = []
    for path in sorted(paths):
        fs, p = file_system(spark, path)
        for found in fs.globStatus(p) or []:
            files = [found] if not found.isDirectory() else fs.listStatus(found.getPath())
            seen += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files if not f.isDirectory()]
    if not seen:
        raise ValueError("no file of the series was found")
    return repr((sorted(seen), options))


def _folder(store: str, state: str) -> str:
    return f"{store.rstrip('/')}/state={hashlib.sha256(state.encode()).hexdigest()[:32]}"


def stored_deflators(spark: SparkSession, store: str, state: str) -> DataFrame | None:
    """The table of that state, or None."""
    fs, p = file_system(spark, f"{_folder(store, state)}/_SUCCESS")
    if not fs.exists(p):
        return None
    return spark.read.schema(SCHEMA).parquet(_folder(store, state))


def persist_deflators(spark: SparkSession, store: str, state: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of that state, built and written first where there is none."""
    have = stored_deflators(spark, store, state)
    if have is not None:
        return have
    table = build().select("date", "ipca", "ipca_i", "brlusd", "cpi")
    seen = Observation("deflators")
    gap = F.col("ipca").isNull() | F.col("ipca_i").isNull() | F.col("brlusd").isNull() | F.col("cpi").isNull()
    draft = f"{store.rstrip('/')}/_draft-{uuid.uuid4().hex}"
    # one row per month: a single file
    table.repartition(1).sortWithinPartitions("date").observe(
        seen, F.count_if(gap).alias("gaps"), F.count(F.lit(1)).alias("months")).write.parquet(draft)
    written = spark.read.schema(SCHEMA).parquet(draft)
    if written.groupBy("date").count().where("count > 1").take(1):
        delete_path(spark, draft)
        raise ValueError(DUPLICATED)
    if seen.get["gaps"]:
        warnings.warn(f"{seen.get['gaps']} of {seen.get['months']} months lack a deflator", stacklevel=2)
    fs, source = file_system(spark, draft)
    _, target = file_system(spark, _folder(store, state))
    if not fs.rename(source, target) or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(target, source.getName())):
        # somebody else wrote the same state meanwhile: theirs holds
        delete_path(spark, draft)
        delete_path(spark, f"{_folder(store, state)}/{source.getName()}")
    return stored_deflators(spark, store, state)
