"""Layouts of published facts: clustering over several codes, and co-location with a code table.

``cluster`` publishes with rows ordered along a Z-curve over code columns, in
row groups of chosen size with bloom filters: a filter on any one of the
columns leaves out most row groups, not only a filter on the first sort
column. ``colocate`` keeps facts and a large code table bucketed alike on the
code, so that joining them moves neither side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradelake.functions.nulls import q
from tradelake.plans import publish
from tradelake.session import scratch_path

BITS = 8
#: Rows of a bucket: some 70 MB of trade facts as they are dealt to the tasks.
BUCKET_ROWS = 1 << 20


def code_ranges(facts: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Least and greatest value of each code column, codes as numbers: one aggregate, one row."""
    number = lambda c: F.try_to_number(F.col(q(c)).cast("string"), F.lit("9" * 18))
    row = facts.agg(*[f(number(c)).cast("bigint") for c in columns for f in (F.min, F.max)]).first()
    return {c: (row[2 * k] or 0, row[2 * k + 1] or 0) for k, c in enumerate(columns)}


def z_order(ranges: dict[str, tuple[int, int]], bits: int = BITS) -> Column:
    """Position on a Z-curve: the columns' values, scaled to ``bits`` bits each, with their bits interleaved.

    Values that are no number, and NULL, come first in their column.
    """
    if not ranges or bits * len(ranges) > 62:
        raise ValueError("between one column and 62 bits in all")
    terms = []
    for k, (c, (least, most)) in enumerate(ranges.items()):
        value = f"try_cast({q(c)} AS BIGINT)"
        scaled = (f"CAST(coalesce(least({2 ** bits - 1}, greatest(0, floor({2 ** bits} * ({value} - {least}D) / {max(1, most - least + 1)}))), 0) "
                  "AS BIGINT)")
        for b in range(bits):
            terms.append(f"shiftleft(shiftright({scaled}, {b}) & 1L, {b * len(ranges) + k})")
    return F.expr(" | ".join(terms))


def cluster(facts: DataFrame, lake: str, by: Sequence[str] = ("ncm", "country_code"),
            ranges: dict[str, tuple[int, int]] | None = None, row_group_bytes: int = 16 << 20,
            distinct: dict[str, int] | None = None, partitions: Iterable[publish.Partition] | None = None) -> publish.Manifest:
    """Publish facts clustered ``by`` code columns, with a bloom filter on each.

    ``ranges`` are the columns' least and greatest values (measured if not given),
    ``distinct`` the expected number of values of a column in a row group, which sizes its filter.
    """
    ranges = ranges or code_ranges(facts, by)
    options = {"parquet.block.size": row_group_bytes}
    for c in by:
        options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{c}"] = (distinct or {}).get(c, 1000)
    spark = facts.sparkSession
    staged = publish.stage(facts, lake, [z_order(ranges)], options=options)
    try:
        return publish.commit(spark, staged, partitions)
    except Exception:
        publish.discard(spark, lake, staged.version)
        raise


def bucket_count(*tables: DataFrame, rows: int | None = None, least: int = 8) -> int:
    """Buckets for tables that are kept alike: the longest has about ``rows`` rows in each, however many rows there are."""
    return max(least, -(-max(t.count() for t in tables) // (rows or BUCKET_ROWS)))


def colocate(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None,
             partition_by: Sequence[str] = ()) -> DataFrame:
    """Keep ``df`` as a catalog table bucketed and sorted by ``key``, its files at ``path``; returns the table.

    Two tables with the same number of buckets on the key they are joined by
    need no exchange. A bucket is one task's share of the key's hash range: choose
    ``buckets`` so that the largest fits one (``bucket_count``); a key that alone is too large
    for a task belongs into a plain join, whose skew is split at run time.
    """
    path = path or scratch_path(df.sparkSession, "bucketed")
    # dealt by the key first, so that a bucket is one file and not one per task
    writer = (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path)
              .bucketBy(buckets, key).sortBy(key))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
