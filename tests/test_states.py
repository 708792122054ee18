"""Kept aggregates equal a full run and are refreshed for replaced partitions only."""
import pytest
from pyspark.sql import functions as F

from tradelake.operators.aggregate import sum_prefixed
from tradelake.plans import publish, states
from tradelake.session import scratch_path
from tests.test_ingest import _facts


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def _same(spark, store, facts, by):
    merged, full = states.merge_states(states.read_states(spark, store), by=by), sum_prefixed(facts, by=by)
    cols = sorted(full.columns)
    assert sorted(merged.columns) == cols and _rows(merged, cols) == _rows(full, cols)


def test_refresh_reads_what_changed(spark):
    lake, store, facts = scratch_path(spark, "l"), scratch_path(spark, "s"), _facts(spark)
    publish.publish(facts, lake)
    assert states.refresh_states(spark, lake, store) == [(2023, "exp"), (2023, "imp"), (2024, "imp")]
    for by in (["year", "direction"], ["date"], ["direction"], None):
        _same(spark, store, facts, by)
    assert states.refresh_states(spark, lake, store) == [] and publish.manifest(spark, store).number == 1
    changed = facts.where("year = 2024").withColumn("fob_usd", F.lit(5).cast("long")).withColumn("freight_usd", F.lit(None).cast("long"))
    publish.publish(changed, lake)
    assert states.refresh_states(spark, lake, store) == [(2024, "imp")]
    now = facts.where("year <> 2024").unionByName(changed)
    for by in (["year"], ["direction", "date"], None):
        _same(spark, store, now, by)  # with the NULL rule: exports and the changed year have no freight


def test_partitions_that_are_gone_go(spark):
    lake, store, facts = scratch_path(spark, "l"), scratch_path(spark, "s"), _facts(spark)
    publish.publish(facts, lake)
    states.refresh_states(spark, lake, store)
    staged = publish.stage(facts.where("year = 2024"), lake)
    publish.commit(spark, staged, remove=[(2023, "exp")])
    assert states.refresh_states(spark, lake, store) == [(2024, "imp")]
    _same(spark, store, facts.where("not (year = 2023 and direction = 'exp')"), ["year"])


def test_other_keys_are_refused(spark):
    lake, store = scratch_path(spark, "l"), scratch_path(spark, "s")
    publish.publish(_facts(spark), lake)
    with pytest.raises(ValueError, match="no states"):
        states.read_states(spark, store)
    states.refresh_states(spark, lake, store)
    publish.publish(_facts(spark).where("year = 2024"), lake)
    with pytest.raises(ValueError, match="other keys"):
        states.refresh_states(spark, lake, store, by=["country_code"])
    with pytest.raises(ValueError, match="no manifest"):
        states.refresh_states(spark, scratch_path(spark, "l"), store)


def test_na_rm_and_zero_rows(spark):
    part = states.partial_states(_facts(spark), ["date"])
    assert _rows(states.merge_states(part, ["year"], na_rm=True), ["freight_usd"]) == [(5,), (7,)]
    nothing = states.merge_states(part.where("year = 1")).first()
    assert nothing["fob_usd"] == 0 and sum_prefixed(_facts(spark).where("year = 1")).first()["fob_usd"] == 0
