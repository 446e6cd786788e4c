"""Incremental trailing marts equal a full rebuild after an append and after a backfill."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from conftest import envelope, land
from dailylake.operators.snapshots import Snapshots
from dailylake.plans import gold as G
from dailylake.plans import incremental as INC
from dailylake.plans import pipeline as PL
from test_gold import fact_df

D = dt.date


def _rows(days, locs=("a", "b")):
    out = []
    for loc in locs:
        for i, d in enumerate(days):
            out.append((loc, d, Decimal(f"{(i * 7 + len(loc) * 3) % 40}.{i % 10}5"), 0))
    return out


def _snap(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_append_and_backfill_equal_full_rebuild(spark, tmp_root):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 90, 2)]  # gaps, 3 months
    base = fact_df(spark, _rows(days))
    for name, (build, _) in INC.TRAILING_MARTS.items():
        root = os.path.join(tmp_root, name)
        INC.write_full(build(base), root)
        # append one day, then backfill a day in the middle of February
        new_day, old_day = D(2024, 4, 1), D(2024, 2, 11)
        grown = fact_df(spark, _rows(days + [new_day]))
        INC.refresh_into(spark, grown, root, name, new_day)
        assert _snap(INC.read_mart(spark, root)) == _snap(build(grown))
        filled = fact_df(spark, _rows(sorted(days + [new_day, old_day])))
        INC.refresh_into(spark, filled, root, name, old_day)
        assert _snap(INC.read_mart(spark, root)) == _snap(build(filled))


def test_seed_uses_group_limit(spark):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)]
    build, lookback = INC.TRAILING_MARTS["mart_weather_rolling"]
    q = INC.refresh(fact_df(spark, _rows(days)), build, lookback, D(2024, 2, 15))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_refresh_starts_at_the_earliest_day_the_marts_have_not_seen(spark, tmp_root):
    """A day loaded without gold, before later runs with gold, reaches the marts."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ("2024-02-28", "2024-01-15", "2024-03-01"):
        land(paths.bronze, d, "a", envelope(d, "a", ingested_at=f"{d}T06:00:00+00:00"))
    PL.run(spark, paths, "2024-02-28", landed=True)
    PL.run(spark, paths, "2024-01-15", landed=True, with_gold=False)
    out = PL.run(spark, paths, "2024-03-01", landed=True)
    fact = out["fact_weather_daily"]
    assert fact.count() == 3
    for name, (build, _) in INC.TRAILING_MARTS.items():
        assert _snap(out[name]) == _snap(build(fact))
    assert Snapshots(spark, paths.gold).record()["notes"] == {"staging": 3}
    PL.build_gold(spark, paths)  # nothing was loaded since: no new version
    assert Snapshots(spark, paths.gold).record()["version"] == 2


def test_failed_gold_build_is_made_up_for(spark, tmp_root, monkeypatch):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ("2024-02-01", "2024-01-10", "2024-02-02"):
        land(paths.bronze, d, "a", envelope(d, "a", ingested_at=f"{d}T06:00:00+00:00"))
    PL.run(spark, paths, "2024-02-01", landed=True)

    def fails(*a, **k):
        raise RuntimeError("no space")

    with monkeypatch.context() as m:
        m.setattr(PL.G, "location_moments", fails)
        with pytest.raises(RuntimeError):
            PL.run(spark, paths, "2024-01-10", landed=True)
    out = PL.run(spark, paths, "2024-02-02", landed=True)
    assert out["mart_weather_rolling"].count() == out["mart_weekly_change"].count() == 3
    logged = {(str(r["dt"]), r["status"]) for r in spark.read.parquet(paths.runs).collect()}
    assert logged == {("2024-02-01", "success"), ("2024-01-10", "failed"), ("2024-02-02", "success")}


def test_one_days_load_changes_one_months_moments(spark, tmp_root):
    """z-scores from merged monthly moments equal those of the whole series."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    first = D(2024, 1, 10)
    for i in range(0, 80, 3):
        d = str(first + dt.timedelta(days=i))
        for loc, base in (("a", 1), ("b", 1e7)):  # large values: sums of squares would lose the deviations
            land(paths.bronze, d, loc, envelope(d, loc, temp_avg=str(base + i * i % 17 / 7 if loc == "a" else 59 + i % 5 / 1000), ingested_at=f"{d}T06:00:00+00:00"))
        land(paths.bronze, d, "same", envelope(d, "same", temp_avg="4.5", ingested_at=f"{d}T06:00:00+00:00"))
    PL.backfill(spark, paths, "2024-01-10", "2024-03-28", landed=True)
    months = lambda: Snapshots(spark, paths.gold).record()["tables"][INC.MOMENTS]["folders"]
    before = months()
    land(paths.bronze, "2024-03-29", "a", envelope("2024-03-29", "a", temp_avg="33.25", ingested_at="2024-03-29T06:00:00+00:00"))
    out = PL.run(spark, paths, "2024-03-29", landed=True)
    assert {m for m in months() if months()[m] != before.get(m)} == {"month=2024-03-01"}
    key = lambda df: {(r["location_id"], r["date"]): r["z_score"] for r in df.collect()}
    # the decimal average of the whole series is rounded, which a small deviation shows: compare doubles
    exact = out["fact_weather_daily"].withColumn("temp_avg_c", out["fact_weather_daily"]["temp_avg_c"].cast("double"))
    got, want = key(out["mart_anomalies"]), key(G.mart_anomalies(exact))
    assert got.keys() == want.keys() and len(got) > 80
    for k, z in want.items():
        assert (z is None) == (got[k] is None) and (z is None or abs(got[k] - z) < (1e-9 if k[0] == "b" else 1e-12))
    assert all(z is None for (loc, _), z in got.items() if loc == "same")  # a series without spread
