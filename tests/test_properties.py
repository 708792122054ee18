"""Property tests (random inputs) for the sum and rolling operators."""
import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from tradelake.operators.aggregate import sum_prefixed
from tradelake.operators.rolling import roll_months

row = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 23),
                st.one_of(st.none(), st.integers(-1000, 1000)))
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    data = [(g, dt.date(2022 + m // 12, m % 12 + 1, 1), v) for g, m, v in rows]
    return spark.createDataFrame(data, "g string, date date, fob_usd long")


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_sum_matches_python(spark, rows):
    got = {r["g"]: r["fob_usd"] for r in sum_prefixed(_df(spark, rows), by="g", prefixes="fob_").collect()}
    for g in {x[0] for x in rows}:
        vals = [v for gg, _, v in rows if gg == g]
        assert got[g] == (None if any(v is None for v in vals) else sum(vals))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25), k=st.integers(1, 6))
def test_reduced_and_direct_plans_agree(spark, rows, k):
    df = _df(spark, rows)
    a = roll_months(df, by="g", prefixes="fob_", k=k).collect()
    b = roll_months(df, by="g", prefixes="fob_", k=k, one_row_per_date=True).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_k1_roll_equals_per_date_sum(spark, rows):
    df = _df(spark, rows)
    rolled = {(r["g"], r["date"]): r["fob_usd_1"] for r in roll_months(df, by="g", prefixes="fob_", k=1).collect()}
    sums = {(r["g"], r["date"]): r["fob_usd"] for r in sum_prefixed(df, by=["g", "date"], prefixes="fob_").collect()}
    assert rolled == {k: (None if v is None else float(v)) for k, v in sums.items()}
