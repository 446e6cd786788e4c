"""Gold models on hand-written series: semantic traps T1-T5, T8, T12, F10-F14."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from dailylake.plans import gold as G
from dailylake.plans.staging import stg_locations, stg_weather_daily

D = dt.date


def fact_df(spark, rows):
    """rows: (location_id, date, temp_avg, precip) -> fact via the staging view."""
    data = [(d, loc, d, Decimal(str(t)) if t is not None else None, None, None,
             Decimal(str(p)) if p is not None else None, None, None, None, None,
             dt.datetime(2024, 1, 1)) for loc, d, t, p in rows]
    schema = ("dt date, location_id string, date date, temp_avg_c decimal(18,6), "
              "temp_min_c decimal(18,6), temp_max_c decimal(18,6), precip_mm decimal(18,6), "
              "humidity_avg decimal(18,6), wind_max_kph decimal(18,6), condition_code int, "
              "condition_text string, ingested_at timestamp")
    return G.fact_weather_daily(stg_weather_daily(spark.createDataFrame(data, schema)))


def test_rolling_counts_rows_not_days(spark):
    # A gap of dates still counts as the adjacent row
    rows = [("a", D(2024, 1, 1), 10, 0), ("a", D(2024, 1, 2), 20, 0), ("a", D(2024, 1, 10), 30, 0)]
    out = {r["date"]: r for r in G.mart_weather_rolling(fact_df(spark, rows)).collect()}
    assert out[D(2024, 1, 10)]["temp_avg_7d"] == Decimal("20")


def test_weekly_change_uses_seventh_previous_row(spark):
    rows = [("a", D(2024, 1, 1) + dt.timedelta(days=2 * i), i, 0) for i in range(9)]
    out = sorted(G.mart_weekly_change(fact_df(spark, rows)).collect(), key=lambda r: r["date"])
    assert [r["temp_wow_change"] for r in out[:7]] == [None] * 7
    assert out[7]["temp_wow_change"] == Decimal("7") and out[8]["temp_wow_change"] == Decimal("7")


def test_baseline_two_stage_rounding_and_flag(spark):
    # The difference is rounded to 2 dp and the flag sees the rounded value
    rows = [("a", D(2024, 1, i), 0, 0) for i in range(1, 8)]
    rows.append(("a", D(2024, 1, 8), Decimal("4.995"), 0))
    out = G.anomalies(fact_df(spark, rows)).where(F.col("date") == D(2024, 1, 8)).first()
    assert out["temp_avg_c"] == Decimal("4.995000")
    assert out["temp_baseline_7d"] == Decimal("0.00")
    assert out["temp_anomaly_vs_7d"] == Decimal("5.00")
    assert out["is_temp_anomaly_5c"] is True
    # the baseline is rounded *before* the subtraction: 0.005 -> 0.01, so 5.00 - 0.01 = 4.99
    rows = [("b", D(2024, 1, 1), 0, 0), ("b", D(2024, 1, 2), Decimal("0.01"), 0),
            ("b", D(2024, 1, 3), 5, 0)]
    out = G.anomalies(fact_df(spark, rows)).where(F.col("date") == D(2024, 1, 3)).first()
    assert out["temp_baseline_7d"] == Decimal("0.01")
    assert out["temp_anomaly_vs_7d"] == Decimal("4.99")
    assert out["is_temp_anomaly_5c"] is False


def test_baseline_rounds_half_away_from_zero(spark):
    rows = [("a", D(2024, 1, 1), Decimal("1.00"), 0), ("a", D(2024, 1, 2), Decimal("1.01"), 0),
            ("a", D(2024, 1, 3), Decimal("9.99"), 0)]
    out = G.anomalies(fact_df(spark, rows)).where(F.col("date") == D(2024, 1, 3)).first()
    assert out["temp_baseline_7d"] == Decimal("1.01")  # 1.005 -> 1.01
    assert out["temp_anomaly_vs_7d"] == Decimal("8.98")


def test_null_precip_is_zero_in_baseline_null_temp_skipped(spark):
    # T3
    rows = [("a", D(2024, 1, 1), 10, None), ("a", D(2024, 1, 2), None, 4),
            ("a", D(2024, 1, 3), 20, None)]
    out = G.anomalies(fact_df(spark, rows)).where(F.col("date") == D(2024, 1, 3)).first()
    assert out["temp_baseline_7d"] == Decimal("10.00")  # null temp skipped
    assert out["precip_baseline_7d"] == Decimal("2.00")  # (0 + 4) / 2
    assert out["precip_anomaly_vs_7d"] == Decimal("-2.00")


def test_first_row_dropped_after_window_but_feeds_later_rows(spark):
    # T5
    rows = [("a", D(2024, 1, 1), 10, 0), ("a", D(2024, 1, 2), 12, 0), ("b", D(2024, 1, 1), 5, 0)]
    out = G.anomalies(fact_df(spark, rows)).collect()
    assert [(r["location_id"], r["date"]) for r in out] == [("a", D(2024, 1, 2))]
    assert out[0]["temp_baseline_7d"] == Decimal("10.00")


def test_zscore_null_for_single_row_and_equal_values(spark):
    # T8
    rows = [("one", D(2024, 1, 1), 3, 0), ("eq", D(2024, 1, 1), 4, 0), ("eq", D(2024, 1, 2), 4, 0),
            ("v", D(2024, 1, 1), 1, 0), ("v", D(2024, 1, 2), 3, 0)]
    out = {(r["location_id"], r["date"]): r["z_score"]
           for r in G.mart_anomalies(fact_df(spark, rows)).collect()}
    assert out[("one", D(2024, 1, 1))] is None
    assert out[("eq", D(2024, 1, 1))] is None
    assert abs(out[("v", D(2024, 1, 2))] - 0.7071067811865475) < 1e-12


def test_weekly_counts_null_rows_and_iso_fields(spark):
    # T12 + F12-F14: Monday weeks, partial weeks kept, ISO year of 2024-12-30 is 2025
    rows = [("a", D(2024, 12, 30), 10, None), ("a", D(2024, 12, 31), None, 2),
            ("a", D(2025, 1, 5), 20, 3), ("a", D(2021, 1, 1), 1, 1)]
    dim = spark.createDataFrame([("a", "A", "R", "C", "UTC")],
                                "location_id string, name string, region string, country string, tz_id string")
    out = {r["week_start"]: r for r in G.weather_weekly_bi(fact_df(spark, rows), dim).collect()}
    w = out[D(2024, 12, 30)]
    assert (w["week_end"], w["iso_year"], w["iso_week"], w["days_in_week"]) == (D(2025, 1, 5), 2025, 1, 3)
    assert w["temp_avg_c_wk"] == Decimal("15.00") and w["precip_mm_wk"] == Decimal("5.00")
    w21 = out[D(2020, 12, 28)]
    assert (w21["iso_year"], w21["iso_week"], w21["days_in_week"]) == (2020, 53, 1)


def test_dim_date_covers_gaps_with_calendar_fields(spark):
    rows = [("a", D(2024, 2, 27), 1, 0), ("b", D(2024, 3, 3), 1, 0)]
    out = G.dim_date(stg_weather_daily(fact_df(spark, rows).withColumn("dt", F.col("date")))) \
        .orderBy("date").collect()
    assert [r["date"] for r in out] == [D(2024, 2, 27) + dt.timedelta(days=i) for i in range(6)]
    thu = out[2]  # 2024-02-29
    assert (thu["year"], thu["month"], thu["day"], thu["iso_dow"], thu["year_month"]) == \
        (2024, 2, 29, 4, "2024-02")
    assert out[5]["iso_dow"] == 7  # Sunday


def test_dim_location_null_ingested_at_wins_and_ties_are_deterministic(spark):
    # T4: Postgres DESC puts NULL first
    schema = ("location_id string, name string, region string, country string, lat double, "
              "lon double, tz_id string, local_time timestamp_ntz, ingested_at timestamp")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("x", "old", None, "C", 1.0, 1.0, "UTC", None, t1),
            ("x", "nul", None, "C", 1.0, 1.0, "UTC", None, None),
            ("y", "new", None, "C", 1.0, 1.0, "UTC", None, t2),
            ("y", "old", None, "C", 1.0, 1.0, "UTC", None, t1),
            ("z", "b", None, "C", 1.0, 1.0, "UTC", None, t1),
            ("z", "a", None, "C", 1.0, 1.0, "UTC", None, t1)]
    src = spark.createDataFrame(rows, schema)
    out = {r["location_id"]: r["name"] for r in G.dim_location(stg_locations(src)).collect()}
    assert out["x"] == "nul" and out["y"] == "new"
    again = {r["location_id"]: r["name"] for r in
             G.dim_location(stg_locations(src.repartition(3))).collect()}
    assert again["z"] == out["z"]


def test_bi_daily_inner_joins_drop_unknown_locations(spark):
    rows = [("a", D(2024, 1, 1), 1, 0), ("ghost", D(2024, 1, 1), 2, 0)]
    f = fact_df(spark, rows)
    dim = spark.createDataFrame([("a", "City", "R", "C")],
                                "location_id string, name string, region string, country string")
    out = G.weather_daily_bi(f, G.dim_date(stg_weather_daily(f.withColumn("dt", F.col("date")))), dim).collect()
    assert [(r["location_id"], r["city"], r["year"]) for r in out] == [("a", "City", 2024)]


def test_rolling_marts_share_one_exchange(spark):
    rows = [("a", D(2024, 1, i), i, 0) for i in range(1, 5)]
    plan = G.mart_weather_rolling(fact_df(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(location_id") == 1
