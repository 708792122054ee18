"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradelake.session import materialize, scratch_path

#: ASCII white space between words, as a Java and Python character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

# functions of this package travel to the workers by value, so that these need not have it installed
cloudpickle.register_pickle_by_value(sys.modules["tradelake"])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage with a copy that survives lost executors; later steps
    read only the columns they need and the planner knows the true size. The
    copies of a process are removed when it ends, or by ``release_scratch``.
    """
    return materialize(df, f"llm-{name}", "zstd")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed as staged copies are."""
    return scratch_path(spark, f"llm-{name}")


def words(text: Column) -> Column:
    """Words between runs of ASCII white space; NULL and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", -1), "")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def running_total(df: DataFrame, order: list[Column], value: str, out: str, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` over the whole table in ``order``.

    The rows are range-partitioned by the order, each partition sums its own
    rows, and the sums of the partitions before it are added: one row per
    partition is broadcast, and no task holds more than one range.
    """
    pid = free_name(df, "__pid")
    ranged = staged(df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id()), name)
    sums = ranged.groupBy(pid).agg(F.sum(value).alias("__s"))
    before = sums.select(pid, (F.sum("__s").over(Window.orderBy(pid)) - F.col("__s")).alias("__before"))
    own = Window.partitionBy(pid).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.join(F.broadcast(before), pid)
            .withColumn(out, F.sum(value).over(own) + F.col("__before"))
            .drop(pid, "__before"))
