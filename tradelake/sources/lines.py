"""Line numbers of text files, found in parallel.

A file's splits are numbered where they lie and a prefix sum over the splits'
line counts (one row per split) turns that into numbers within the file, so a
raw export needs no line column and no task reads the whole file.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradelake.functions.names import clean_names
from tradelake.functions.nulls import q
from tradelake.session import materialize


def numbered_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(file, line, value) of every line of the text files at ``path``; lines count from 1 in each file."""
    # a task reads its splits one after the other, so the ids rise with the lines of a split
    lines = materialize(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.decode(F.col("value").cast("binary"), encoding).alias("value")))
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return lines.join(splits, ["file", "block"]).select(
        "file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"), "value")


def read_raw_sheet(spark: SparkSession, path: str, skip: int = 6, sep: str = ";", label: str = "mes",
                   encoding: str = "ISO-8859-1") -> DataFrame:
    """A sheet's raw export: ``skip`` lines of preamble, a header, then rows whose place gives their ``line`` (from 1).

    Numbers may use a decimal comma; an empty cell is NULL, text where a
    number should be fails the job. Blank lines keep their number.
    """
    lines = numbered_lines(spark, path, encoding)
    heads = lines.where(F.col("line") == skip + 1).select("file", "value").take(2)
    if len(heads) != 1:
        raise ValueError(f"{path} has {'no' if not heads else 'more than one'} file with a header behind {skip} lines")
    names = clean_names(next(csv.reader([heads[0]["value"]], delimiter=sep)))
    schema = ", ".join(f"{q(n)} string" for n in names)
    rows = lines.where(F.col("line") > skip + 1).select(
        F.from_csv("value", schema, {"sep": sep}).alias("r"), (F.col("line") - skip - 1).cast("int").alias("line"))
    number = lambda n: F.regexp_replace(F.nullif(F.trim(F.col(f"r.{q(n)}")), F.lit("")), ",", ".").cast("double")
    return rows.select(F.col(f"r.{q(label)}").alias(label), *[number(n).alias(n) for n in names if n != label], "line")
