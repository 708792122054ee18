import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tradelake.operators.rolling import roll_months, roll_rows
from tests.conftest import d


def _by_date(df, col):
    return [r[col] for r in df.orderBy("date").collect()]


@pytest.mark.parametrize("one_row", [False, True])
def test_roll_k3(fx1, one_row):
    r = roll_months(fx1, k=3, one_row_per_date=one_row)
    v = _by_date(r, "qt_stat_3")
    assert v[0] is None and v[1] is None and v[2] == 450


def test_roll_custom_columns_k6(fx1):
    r = roll_months(fx1, prefixes=["kg_", "freight_"], k=6)
    assert r.columns == fx1.columns + ["kg_net_6", "freight_usd_6"]
    assert _by_date(r, "kg_net_6")[5] == 7400


def test_rendered_grouped_example(spark):
    rows = [(d("2023-01-01"), "exp", 111), (d("2023-02-01"), "exp", 101), (d("2023-03-01"), "exp", 104),
            (d("2023-01-01"), "imp", 94), (d("2023-02-01"), "imp", 83), (d("2023-03-01"), "imp", 117)]
    df = spark.createDataFrame(rows, "date date, direction string, qt_stat int")
    r = roll_months(df, by="direction", prefixes=["qt_"], k=2)
    got = {(x["direction"], x["date"]): x["qt_stat_2"] for x in r.collect()}
    assert [got[("exp", d(f"2023-0{m}-01"))] for m in (1, 2, 3)] == [None, 212, 205]
    assert [got[("imp", d(f"2023-0{m}-01"))] for m in (1, 2, 3)] == [None, 177, 200]


def test_gap_inside_window_is_not_incomplete(spark):
    rows = [(d("2023-01-01"), 1), (d("2023-02-01"), 2), (d("2023-04-01"), 4), (d("2023-05-01"), 8)]
    r = roll_months(spark.createDataFrame(rows, "date date, fob_usd long"), prefixes="fob_", k=3)
    got = {x["date"]: x["fob_usd_3"] for x in r.collect()}
    assert got[d("2023-04-01")] == 6 and got[d("2023-05-01")] == 12 and got[d("2023-02-01")] is None


def test_ties_share_total(spark):
    rows = [(d("2023-01-01"), 1), (d("2023-02-01"), 2), (d("2023-02-01"), 3)]
    r = roll_months(spark.createDataFrame(rows, "date date, fob_usd long"), prefixes="fob_", k=2)
    assert sorted(x["fob_usd_2"] for x in r.where("date = '2023-02-01'").collect()) == [6, 6]


def test_null_inside_window(spark):
    rows = [(d("2023-01-01"), 1), (d("2023-02-01"), None), (d("2023-03-01"), 3), (d("2023-04-01"), 4),
            (d("2023-05-01"), 5)]
    r = roll_months(spark.createDataFrame(rows, "date date, fob_usd long"), prefixes="fob_", k=2)
    got = {x["date"]: x["fob_usd_2"] for x in r.collect()}
    assert got[d("2023-02-01")] is None and got[d("2023-03-01")] is None and got[d("2023-04-01")] == 7


def test_k1_is_per_date_total(spark):
    rows = [(d("2023-01-01"), 1), (d("2023-01-01"), 2), (d("2023-03-01"), 5)]
    r = roll_months(spark.createDataFrame(rows, "date date, fob_usd long"), prefixes="fob_", k=1)
    assert sorted((x["date"], x["fob_usd_1"]) for x in r.collect()) == \
        [(d("2023-01-01"), 3.0), (d("2023-01-01"), 3.0), (d("2023-03-01"), 5.0)]


def test_null_date_rejected(spark):
    df = spark.createDataFrame([(None, 1)], "date date, fob_usd long")
    with pytest.raises(Exception, match="NULL date"):
        roll_months(df, prefixes="fob_", k=2).collect()


def _brute(rows, k):
    """Reference semantics written as a loop: per group, dates within k-1 months, span-complete, NULL-poisoned."""
    out = []
    groups = {}
    for g, date, v in rows:
        groups.setdefault(g, []).append((date, v))
    for g, items in groups.items():
        first = min(x[0] for x in items)
        first_m = first.year * 12 + first.month
        for date, v in items:
            m = date.year * 12 + date.month
            frame = [w for dd, w in items if m - (k - 1) <= dd.year * 12 + dd.month <= m]
            if m - (k - 1) < first_m or any(w is None for w in frame):
                res = None
            else:
                res = float(sum(frame))
            out.append((g, date, v, res))
    return sorted(out, key=lambda t: (t[0], t[1], -1 if t[2] is None else t[2], -1 if t[3] is None else t[3]))


@pytest.mark.parametrize("k", [1, 3, 12])
def test_roll_matches_brute_force(spark, k):
    rnd = random.Random(k)
    rows = []
    for g in ("a", "b", "c"):
        for _ in range(30):
            y, m = rnd.choice([2021, 2022, 2023]), rnd.randint(1, 12)
            rows.append((g, dt.date(y, m, 1), None if rnd.random() < 0.05 else rnd.randint(0, 100)))
    df = spark.createDataFrame(rows, "g string, date date, fob_usd long")
    got = roll_months(df, by="g", prefixes="fob_", k=k).collect()
    got = sorted(((r["g"], r["date"], r["fob_usd"], r[f"fob_usd_{k}"]) for r in got),
                 key=lambda t: (t[0], t[1], -1 if t[2] is None else t[2], -1 if t[3] is None else t[3]))
    assert got == _brute(rows, k)


def test_roll_rows_complete_only(spark):
    rows = [(d(f"2023-{m:02d}-01"), float(m)) for m in range(1, 13)] + [(d("2024-01-01"), 13.0)]
    r = roll_rows(spark.createDataFrame(rows, "date date, pib double"), "pib", n=12, name="pib12")
    v = _by_date(r, "pib12")
    assert v[:11] == [None] * 11 and v[11] == 78.0 and v[12] == 90.0
