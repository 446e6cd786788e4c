"""Property tests against brute force on small random inputs (hypothesis)."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dailylake.operators.dedup import duplicate_members, keep_last
from dailylake.plans import gold as G
from test_gold import fact_df

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 4),
                             st.integers(-50, 50)), min_size=1, max_size=25)


@SETTINGS
@given(rows=rows_st)
def test_keep_last_equals_pandas(spark, rows):
    data = [(k, d, v, i) for i, (k, d, v) in enumerate(rows)]  # i = position in input order
    df = spark.createDataFrame(data, "k string, d int, v int, pos int")
    got = sorted(tuple(r) for r in keep_last(df, ["k", "d"], ["pos"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "d", "v", "pos"])
    want = sorted(tuple(x) for x in pdf.drop_duplicates(subset=["k", "d"], keep="last")
                  .itertuples(index=False, name=None))
    assert got == want


@SETTINGS
@given(rows=rows_st)
def test_duplicate_members_equals_pandas(spark, rows):
    data = [(k, d, v, i) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d int, v int, pos int")
    got = sorted(tuple(r) for r in duplicate_members(df, ["k", "d"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "d", "v", "pos"])
    want = sorted(tuple(x) for x in pdf[pdf.duplicated(subset=["k", "d"], keep=False)]
                  .itertuples(index=False, name=None))
    assert got == want


series_st = st.lists(st.tuples(st.integers(0, 60), st.one_of(st.none(), st.integers(-999, 999))),
                     min_size=1, max_size=40, unique_by=lambda t: t[0])


def _avg(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) / len(vals) if vals else None


@SETTINGS
@given(series=series_st)
def test_trailing_windows_equal_brute_force(spark, series):
    base = dt.date(2024, 1, 1)
    ordered = sorted(series)
    rows = [("a", base + dt.timedelta(days=d), None if v is None else Decimal(v) / 100, 0)
            for d, v in ordered]
    f = fact_df(spark, rows)
    roll = {r["date"]: r for r in G.mart_weather_rolling(f).collect()}
    anom = {r["date"]: r for r in G.anomalies(f).collect()}
    vals = [r[2] for r in rows]
    for i, (_, d, v, _) in enumerate(rows):
        a7 = _avg(vals[max(0, i - 6): i + 1])
        got = roll[d]["temp_avg_7d"]
        assert (got is None and a7 is None) or abs(got - a7) < Decimal("1e-9")
        base7 = _avg(vals[max(0, i - 7): i])
        if base7 is None:
            assert d not in anom
        else:
            b = base7.quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert anom[d]["temp_baseline_7d"] == b
            if v is not None:
                diff = (v - b).quantize(Decimal("0.01"), ROUND_HALF_UP)
                assert anom[d]["temp_anomaly_vs_7d"] == diff
                assert anom[d]["is_temp_anomaly_5c"] == (abs(diff) >= 5)
