"""Quality gate: one failing fixture per rule, rule order, and the model tests."""

import datetime as dt

import pytest

from dailylake.operators import quality as Q

DT = dt.date(2024, 3, 1)
TS = dt.datetime(2024, 3, 1, 6)
DAILY_SCHEMA = ("dt date, location_id string, ingested_at timestamp, date date, "
                "temp_min_c double, temp_max_c double, temp_avg_c double, humidity_avg double")
LOC_SCHEMA = ("dt date, location_id string, name string, country string, lat double, "
              "lon double, tz_id string, ingested_at timestamp")


def daily(spark, n=20, **over):
    rows = []
    for i in range(n):
        r = {"dt": DT, "location_id": f"l{i:02d}", "ingested_at": TS, "date": DT,
             "temp_min_c": 1.0, "temp_max_c": 9.0, "temp_avg_c": 5.0, "humidity_avg": 50.0}
        for k, v in over.items():
            if k.startswith("row0_") and i == 0:
                r[k[5:]] = v
            elif not k.startswith("row0_"):
                r[k] = v
        rows.append(tuple(r[c.split()[0]] for c in DAILY_SCHEMA.split(", ")))
    return spark.createDataFrame(rows, DAILY_SCHEMA)


def locs(spark, n=20, **row0):
    rows = []
    for i in range(n):
        r = {"dt": DT, "location_id": f"l{i:02d}", "name": "N", "country": "C", "lat": 1.0,
             "lon": 2.0, "tz_id": "UTC", "ingested_at": TS}
        if i == 0:
            r.update(row0)
        rows.append(tuple(r[c.split()[0]] for c in LOC_SCHEMA.split(", ")))
    return spark.createDataFrame(rows, LOC_SCHEMA)


def first_failure(spark, d, l, expected_dts=None, **kw):
    rep = Q.gate_report(d, l, Q.QualityConfig(), expected_dts=expected_dts, **kw)
    rows = rep.collect()
    assert len(rows) == 1
    return rows[0]["failed_rule"]


def test_clean_day_passes(spark):
    rep = Q.gate_report(daily(spark), locs(spark))
    assert Q.raise_on_failure(rep).first()["passed"] is True


@pytest.mark.parametrize("over,rule", [
    ({"row0_location_id": None}, "daily_not_null:location_id"),
    ({"row0_date": None}, "daily_not_null:date"),
    ({"row0_ingested_at": None}, "daily_not_null:ingested_at"),
    ({"row0_date": dt.date(2024, 2, 29)}, "date_ne_dt"),
    ({"row0_location_id": "l01"}, "duplicate_location_date"),
    ({"temp_min_c": None}, "range_all_null:temp_min_c"),
    ({"row0_temp_max_c": 61.0}, "range:temp_max_c"),
    ({"row0_temp_avg_c": -80.5}, "range:temp_avg_c"),
    ({"row0_humidity_avg": 100.5}, "range:humidity_avg"),
    ({"row0_humidity_avg": float("nan")}, None),  # NaN is NULL, not out of range (T9)
])
def test_daily_rules(spark, over, rule):
    assert first_failure(spark, daily(spark, **over), locs(spark)) == rule


@pytest.mark.parametrize("col", ["location_id", "name", "country", "lat", "lon", "tz_id", "ingested_at"])
def test_location_not_null_rules(spark, col):
    assert first_failure(spark, daily(spark), locs(spark, **{col: None})) == f"locations_not_null:{col}"


def test_rule_order_follows_reference(spark):
    # a NULL ingested_at (C4) is reported before a freshness failure (C5) and a range failure
    d = daily(spark, row0_ingested_at=None, row0_date=dt.date(2024, 2, 1), row0_temp_max_c=99.0)
    assert first_failure(spark, d, locs(spark)) == "daily_not_null:ingested_at"


def test_missing_partition_and_completeness_boundary(spark):
    exp = spark.createDataFrame([(DT,), (dt.date(2024, 3, 2),)], "dt date")
    rep = {r["dt"]: r for r in Q.gate_report(daily(spark), locs(spark), expected_dts=exp).collect()}
    assert rep[dt.date(2024, 3, 2)]["failed_rule"] == "missing_daily_partition"
    assert rep[DT]["passed"]
    # 19 of 20 = 0.95 passes (the rule is ratio < min), 18 of 20 fails
    assert first_failure(spark, daily(spark, n=19), locs(spark, n=20)) is None
    assert first_failure(spark, daily(spark, n=18), locs(spark, n=20)) == "completeness"


def test_completeness_against_registry(spark):
    reg = spark.createDataFrame([(f"l{i:02d}",) for i in range(40)], "location_id string")
    c = Q.completeness(daily(spark), reg).first()
    assert (c["present"], c["expected"], c["ratio"]) == (20, 40, 0.5)
    miss = Q.missing_locations(daily(spark), reg, 10).orderBy("rank").collect()
    assert [r["location_id"] for r in miss] == [f"l{i:02d}" for i in range(20, 30)]


def test_required_columns_and_raise(spark):
    with pytest.raises(Q.QualityGateError, match="without the required columns"):
        Q.gate_report(daily(spark).drop("ingested_at"), locs(spark))
    d = daily(spark, row0_temp_min_c=-99.0)
    rep = Q.gate_report(d, locs(spark))
    with pytest.raises(Q.QualityGateError, match=r"\[QUALITY_GATE\].*range:temp_min_c"):
        Q.raise_on_failure(rep)
    with pytest.raises(Q.QualityGateError, match=r"Sample: range:temp_min_c l00/2024-03-01=-99.0"):
        Q.raise_on_failure(rep, daily=d)


def test_range_counts_ignore_text_and_nan(spark):
    # Text is re-coerced and ignored
    df = spark.createDataFrame([("x", "1"), ("x", "abc"), ("x", "70"), ("x", "NaN")], "dt string, v string")
    r = Q.range_counts(df, [("v", 0.0, 60.0)], ["dt"]).first()
    assert (r["n_valid"], r["n_low"], r["n_high"]) == (2, 0, 1)


def test_null_counts_long_format(spark):
    d = daily(spark, row0_date=None)
    got = {r["column"]: r["n_null"] for r in Q.null_counts(d, ["date", "location_id"], ["dt"]).collect()}
    assert got == {"date": 1, "location_id": 0}


def test_model_tests_and_freshness(spark):
    m = {"m": spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")}
    nn = Q.test_not_null(m, [("m", "k"), ("m", "v")]).collect()
    assert {(r["column"], r["failures"]) for r in nn} == {("k", 1), ("v", 0)}
    assert Q.test_unique(m, [("m", ["k"])]).first()["failures"] == 1
    src = {"s": spark.createDataFrame([(dt.datetime(2024, 3, 1, 0),)], "loaded_at timestamp"),
           "e": spark.createDataFrame([], "loaded_at timestamp")}
    st = {r["source"]: r["status"] for r in Q.source_freshness(src, "2024-03-02 07:00:00").collect()}
    assert st == {"s": "warn", "e": "error"}
    st = {r["source"]: r["status"] for r in Q.source_freshness(src, "2024-03-03 01:00:00").collect()}
    assert st["s"] == "error"
    st = {r["source"]: r["status"] for r in Q.source_freshness(src, "2024-03-02 05:00:00").collect()}
    assert st["s"] == "pass"


@pytest.mark.parametrize("n", [1, 3, 100])
def test_missing_locations_equal_the_product(spark, n):
    """Gaps between registry numbers against days x registry, without that product in the plan."""
    import random
    rng = random.Random(n)
    registry = [f"l{i:03d}" for i in range(40)]
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    rows = [(d, loc) for i, d in enumerate(days) for loc in rng.sample(registry, [0, 1, 5, 20, 39, 40][i % 6])] + [(d, "stranger") for d in days]
    daily = spark.createDataFrame(rows * 2, "dt date, location_id string")
    got = Q.missing_locations(daily, spark.createDataFrame([(loc,) for loc in registry * 2], "location_id string"), n)
    want = []
    for d in days:
        lost = [loc for loc in registry if (d, loc) not in rows]
        want += [(d, k + 1, loc) for k, loc in enumerate(lost[:n])]
    assert sorted(tuple(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_report_scans_and_shuffles_the_daily_rows_once(spark, tmp_root):
    import os
    daily = spark.createDataFrame([(dt.date(2024, 1, 1), f"l{i}", dt.date(2024, 1, 1), dt.datetime(2024, 1, 2), 1.0, 1.0, 1.0, 50.0) for i in range(20)],
                                  "dt date, location_id string, date date, ingested_at timestamp, temp_min_c double, temp_max_c double, temp_avg_c double, humidity_avg double")
    locs = spark.createDataFrame([(dt.date(2024, 1, 1), f"l{i}", "n", "c", 1.0, 1.0, "UTC", dt.datetime(2024, 1, 2)) for i in range(20)],
                                 "dt date, location_id string, name string, country string, lat double, lon double, tz_id string, ingested_at timestamp")
    for name, df in (("daily", daily), ("locs", locs)):
        df.write.parquet(os.path.join(tmp_root, name))
    daily, locs = (spark.read.parquet(os.path.join(tmp_root, n)) for n in ("daily", "locs"))
    rep = Q.gate_report(daily, locs)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 3  # by key, location and day
    row = rep.first()
    assert row["passed"] and (row["present"], row["expected"], row["daily_rows"], row["ratio"]) == (20, 20, 20, 1.0)

