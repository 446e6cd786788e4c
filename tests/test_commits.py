"""Commits of several tables: crashes at every step, conflicts, vacuum; quarantine, freshness, lasting layers."""

import datetime as dt
import os
import shutil

import pytest

from conftest import envelope, land
from dailylake.operators import snapshots as SN
from dailylake.operators.quality import QualityGateError
from dailylake.operators.snapshots import CommitConflictError, Snapshots
from dailylake.plans import gold as G
from dailylake.plans import layers as LY
from dailylake.plans import perf as P
from dailylake.plans import pipeline as PL

D = dt.date


def _land(paths, day, locations, temp="10"):
    for loc in locations:
        land(paths.bronze, day, loc, envelope(day, loc, temp_avg=temp, ingested_at=f"{day}T06:00:00+00:00"))


def _state(spark, paths):
    """What readers see of staging and gold."""
    out = []
    for name in (PL.STG_DAILY, PL.STG_LOCATIONS, "dim_location", "dim_date", "fact_weather_daily", "mart_weather_rolling", "mart_weekly_change"):
        df = PL.table(spark, paths, name)
        out.append(None if df is None else sorted(str(r) for r in df.drop("loaded_at").collect()))
    return out


def _steps(monkeypatch, stop):
    """Every write of a folder or a record, before and after it happens, is a step; ``stop`` ends the run there."""
    count = [0]

    def step():
        count[0] += 1
        if count[0] == stop:
            raise RuntimeError("power cut")

    def around(fn):
        def wrapped(*a, **k):
            step()
            out = fn(*a, **k)
            step()
            return out
        return wrapped

    for name in ("write_text", "rename_path"):
        monkeypatch.setattr(SN, name, around(getattr(SN, name)))
    monkeypatch.setattr(SN.Change, "_write", around(SN.Change._write))
    return count


@pytest.fixture
def lake(spark, tmp_root):
    """A lake of one loaded day, with a second one in silver; copies of it are cheap."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    _land(paths, "2024-03-01", ["a", "b"])
    PL.run(spark, paths, "2024-03-01", landed=True)
    _land(paths, "2024-03-02", ["a"], "12")
    PL.bronze_to_silver(spark, paths, "2024-03-02", landed=True)

    def copy(name):
        shutil.copytree(paths.root, os.path.join(tmp_root, name))
        return PL.LakePaths(os.path.join(tmp_root, name))

    return copy


def _stopped(spark, monkeypatch, work, stop):
    with monkeypatch.context() as m:
        steps = _steps(m, stop)
        try:
            work()
        except RuntimeError as e:
            assert "power cut" in str(e)
    return steps[0]


def test_a_crash_at_every_step_of_a_load_leaves_old_or_new_tables(spark, lake, monkeypatch):
    day = PL.expected_days(spark, "2024-03-02", "2024-03-02")
    states = lambda paths: [sorted(str(r) for r in PL.table(spark, paths, n).drop("loaded_at").collect()) for n in (PL.STG_DAILY, PL.STG_LOCATIONS)]
    paths = lake("all")
    old = states(paths)
    n = _stopped(spark, monkeypatch, lambda: PL.load_staging(spark, paths, day), None)
    new = states(paths)
    assert n == 8 and old[0] != new[0] and old[1] != new[1]
    seen = []
    for stop in range(1, n + 1):
        paths = lake(f"stop{stop}")
        _stopped(spark, monkeypatch, lambda: PL.load_staging(spark, paths, day), stop)
        seen.append(states(paths))
    assert seen == [old] * (n - 1) + [new]  # the rename of the commit record is the change
    PL.load_staging(spark, paths, day)  # and a rerun ends as an undisturbed run
    assert states(paths) == new


def test_a_crash_in_a_gold_build_leaves_all_tables_as_they_were(spark, lake, monkeypatch):
    start = lake("start")
    old = _state(spark, start)[2:]
    PL.load_staging(spark, start, PL.expected_days(spark, "2024-03-02", "2024-03-02"))
    monkeypatch.setattr(PL.LY, "publish", lambda *a: None)
    n = 16  # six tables, the record and its rename, before and after
    for stop in (2, 7, 12, 13, 14, 15):
        assert _stopped(spark, monkeypatch, lambda: PL.build_gold(spark, start), stop) == stop
        assert _state(spark, start)[2:] == old
    assert _stopped(spark, monkeypatch, lambda: PL.build_gold(spark, start), n) == n  # after the rename: done
    new = _state(spark, start)[2:]
    assert all(a != b for a, b in zip(old[1:], new[1:]))
    PL.build_gold(spark, start)
    assert _state(spark, start)[2:] == new


def test_two_writers_and_vacuum(spark, tmp_root):
    store = Snapshots(spark, os.path.join(tmp_root, "store"))
    mk = lambda *rows: spark.createDataFrame(rows, "dt date, v int")
    day = lambda n: D(2024, 1, n)
    assert store.read("t") is None and store.record()["version"] == 0
    one = store.begin()
    one.replace_partitions("t", mk((day(1), 1), (day(2), 1)), "dt")
    one.replace("u", mk((day(1), 9)))
    one.note(since="2024-01-01")
    assert store.read("t") is None  # nothing is seen before the commit
    assert one.commit() == 1 and store.record()["notes"] == {"since": "2024-01-01"}
    first, second = store.begin(), store.begin()
    first.replace_partitions("t", mk((day(2), 2)), "dt")
    first.commit()
    second.replace("u", mk((day(1), 8)))
    with pytest.raises(CommitConflictError):
        second.commit()
    assert sorted(tuple(r) for r in store.read("t").collect()) == [(day(1), 1), (day(2), 2)]
    assert [tuple(r) for r in store.read("u").collect()] == [(day(1), 9)]
    with pytest.raises(ValueError, match="other columns"):
        store.begin().replace_partitions("t", mk((day(3), 1)).withColumnRenamed("v", "w"), "dt")
    assert store.read("t", keep=lambda v: v > "2024-01-01").count() == 1 and store.read("t", keep=lambda v: False).columns == ["dt", "v"]
    assert store.vacuum(keep=1) == []  # young folders may belong to a change in the making
    gone = store.vacuum(keep=1, older_than_hours=-1)
    assert len(gone) == 1 and gone[0].startswith("u/") and store.versions() == [2]  # the lost writer's folder
    assert store.read("t").count() == 2 and store.read("u").count() == 1


def test_a_conflicting_load_starts_anew(spark, tmp_root, monkeypatch):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ("2024-03-01", "2024-03-02"):
        _land(paths, d, ["a"])
        PL.bronze_to_silver(spark, paths, d, landed=True)
    days = lambda d: PL.expected_days(spark, d, d)
    commit, other = SN.Change.commit, [True]

    def late(self):
        if other.pop() if other else False:  # another load commits between this one's start and end
            PL.load_staging(spark, paths, days("2024-03-02"))
        return commit(self)

    monkeypatch.setattr(SN.Change, "commit", late)
    PL.load_staging(spark, paths, days("2024-03-01"))
    assert sorted(str(r["dt"]) for r in PL.table(spark, paths, PL.STG_DAILY).collect()) == ["2024-03-01", "2024-03-02"]


def test_a_malformed_file_fails_its_day_alone(spark, tmp_root):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ("2024-03-01", "2024-03-02", "2024-03-03", "2024-03-04"):
        _land(paths, d, ["a", "b"])
    PL.run(spark, paths, "2024-03-03", landed=True, with_gold=False)
    land(paths.bronze, "2024-03-02", "c", '{"metadata": {"dt": "2024-03-02", "loc')  # cut off
    land(paths.bronze, "2024-03-03", "c", envelope("2024-03-03", "c", date="2024-13-99"))  # silver of this day is there
    with pytest.raises(QualityGateError, match="malformed_bronze: 1 record.* of 2024-03-02.*location_id=c"):
        PL.run(spark, paths, "2024-03-01", "2024-03-04", landed=True, with_gold=False)
    out = PL.backfill(spark, paths, "2024-03-01", "2024-03-04", landed=True, with_gold=False)
    rep = {str(r["dt"]): (r["passed"], r["failed_rule"]) for r in out["gate_report"].collect()}
    assert rep["2024-03-01"] == rep["2024-03-04"] == (True, None)
    assert not rep["2024-03-02"][0] and rep["2024-03-03"][1].startswith("malformed_bronze: 1 record(s) of 2024-03-03")
    got = sorted({str(r["dt"]) for r in PL.table(spark, paths, PL.STG_DAILY).collect()})
    assert got == ["2024-03-01", "2024-03-03", "2024-03-04"]  # 03-03 as loaded before
    log = [(str(r["dt"]), r["status"], r["records_loaded"]) for r in spark.read.parquet(paths.runs).orderBy("started_at", "dt").collect()]
    assert log[-4:] == [("2024-03-01", "success", 2), ("2024-03-02", "failed", None), ("2024-03-03", "failed", None), ("2024-03-04", "success", 2)]
    with pytest.raises(QualityGateError, match="malformed_bronze"):
        PL.run(spark, paths, "2024-03-02", landed=True)


def test_missing_day_names_its_neighbours(spark, tmp_root):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    for d in ("2024-03-01", "2024-03-03", "2024-03-09"):
        _land(paths, d, ["a"])
    with pytest.raises(QualityGateError, match="2024-03-02: missing_daily_partition.*nearest days with data: 2024-03-01, 2024-03-03"):
        PL.run(spark, paths, "2024-03-01", "2024-03-03", landed=True)


def test_stale_sources_warn_or_fail_in_the_run_log(spark, tmp_root):
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    _land(paths, "2024-03-01", ["a"])
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    PL.run(spark, paths, "2024-03-01", landed=True, now=now + dt.timedelta(hours=31))
    with pytest.raises(QualityGateError, match="source freshness: stg_weather_daily error"):
        PL.run(spark, paths, "2024-03-01", landed=True, now=now + dt.timedelta(hours=50))
    log = spark.read.parquet(paths.runs).orderBy("started_at").collect()
    assert [r["status"] for r in log] == ["success", "failed"]
    assert "stg_locations warn" in log[0]["error_summary"] and "error" in log[1]["error_summary"]


def test_layers_last_beyond_the_session(spark, tmp_root):
    """Another session reads staging, analytics and analytics_bi by name, always as last committed."""
    paths = PL.LakePaths(os.path.join(tmp_root, "lake"))
    days = [f"2024-02-{n:02d}" for n in range(20, 30)] + [f"2024-03-{n:02d}" for n in (1, 2, 4)]
    for i, d in enumerate(days):
        _land(paths, d, ["a", "b"], str(i * i % 23))
    PL.backfill(spark, paths, days[0], days[-1], landed=True)
    _land(paths, "2024-03-05", ["a"], "31.5")
    out = PL.run(spark, paths, "2024-03-05", landed=True)
    fact, dim_d, dim_l = out["fact_weather_daily"], out["dim_date"], out["dim_location"]
    want = {
        f"{LY.STAGING}.stg_weather_daily": PL.table(spark, paths, PL.STG_DAILY), f"{LY.ANALYTICS}.fact_weather_daily": fact,
        f"{LY.ANALYTICS}.dim_location": dim_l, f"{LY.ANALYTICS}.mart_weather_rolling": out["mart_weather_rolling"],
        f"{LY.ANALYTICS}.mart_anomalies": out["mart_anomalies"], f"{LY.BI}.weather_daily_bi": G.weather_daily_bi(fact, dim_d, dim_l),
        f"{LY.BI}.weather_weekly_bi": G.weather_weekly_bi(fact, dim_l), f"{LY.BI}.weather_anomalies_bi": G.weather_anomalies_bi(fact, dim_d, dim_l)}
    other = spark.newSession()
    for name, df in want.items():
        got = other.table(name)
        assert got.columns == df.columns and [f.dataType for f in got.schema] == [f.dataType for f in df.schema], name
        rows = lambda d: sorted(str(r) for r in d.collect())
        assert rows(got) == rows(df), name
    assert other.table(f"{LY.ANALYTICS}.fact_weather_daily").count() == 27


def test_bounds_of_stored_tables_come_from_footers(spark, lake):
    paths = lake("copy")
    gold = Snapshots(spark, paths.gold)
    fact, dim_l = PL.table(spark, paths, "fact_weather_daily"), PL.table(spark, paths, "dim_location")
    found = P.sanity_stored(gold)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(date), MAX(date), COUNT(*)]" in plan
    assert found.collect() == P.sanity(fact).collect()
    for ask in (P.location_range, P.rolling_range, P.country_daily):
        assert ask(fact, dim_l, gold=gold).collect() == ask(fact, dim_l).collect()
    assert gold.bounds("nothing", "date") is None


def test_series_in_buckets_need_no_exchange(spark, lake):
    fact = PL.table(spark, lake("series"), "fact_weather_daily")
    stored = LY.store_series(spark, fact, "analytics_test.fact_by_location", 8)
    for build in (G.mart_weather_rolling, G.mart_weekly_change, G.anomalies):
        plan = build(stored)._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan
        rows = lambda df: sorted(str(r) for r in df.collect())
        assert rows(build(stored)) == rows(build(fact))
    spark.sql("DROP TABLE analytics_test.fact_by_location")
