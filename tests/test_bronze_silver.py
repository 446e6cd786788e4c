"""Bronze scan, flattening, coercion and dedup: traps T6, T7, T9, T13, T14, T16, T18, T19."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import envelope, land
from dailylake.operators import flatten as FL
from dailylake.plans.pipeline import silver_from_bronze
from dailylake.sources import bronze as B
from dailylake.sources import silver as S


def test_landed_pretty_json_read_with_glob_and_identity_from_metadata(spark, landed):
    land(landed, "2024-03-01", "buc_ro", envelope("2024-03-01", "buc_ro"))
    land(landed, "2024-03-01", "other", envelope("2024-03-01", "007"))  # T7: path differs
    land(landed, "2024-03-01", "buc_ro", {"not": "bronze"}, name="notes.json")  # ignored
    b = B.read_bronze(spark, landed, "2024-03-01", landed=True)
    ids = sorted(r["location_id"] for r in FL.silver_daily(b).collect())
    assert ids == ["007", "buc_ro"]  # '007' stays text
    assert dict(FL.silver_daily(b).dtypes)["location_id"] == "string"


def test_typed_coercion_and_nan(spark, landed):
    # Bad numbers -> NULL, NaN -> NULL, bad timestamps -> NULL, code via to_numeric
    rec = envelope("2024-03-01", "a", temp_avg="abc", humidity="NaN", code="1003.0",
                   ingested_at="not a time", lat="x")
    land(landed, "2024-03-01", "a", rec)
    b = B.read_bronze(spark, landed, landed=True)
    d = FL.silver_daily(b).first()
    assert d["temp_avg_c"] is None and d["humidity_avg"] is None
    assert d["condition_code"] == 1003 and d["ingested_at"] is None
    assert d["date"] == dt.date(2024, 3, 1) and d["temp_min_c"] == 5.0
    loc = FL.silver_locations(b).first()
    assert loc["lat"] is None and loc["local_time"] == dt.datetime(2024, 3, 1, 8, 0)


def test_unparseable_date_fails_missing_date_is_null(spark, landed):
    land(landed, "2024-03-01", "a", envelope("2024-03-01", "a", date="31/02/2024"))
    with pytest.raises(Exception):
        FL.silver_daily(B.read_bronze(spark, landed, landed=True)).collect()
    rec = envelope("2024-03-01", "b")
    del rec["payload"]["forecast"]["forecastday"][0]["date"]
    root2 = landed + "2"
    land(root2, "2024-03-01", "b", rec)
    assert FL.silver_daily(B.read_bronze(spark, root2, landed=True)).first()["date"] is None


def test_no_forecastday_keeps_location_row(spark, landed):
    # T13
    land(landed, "2024-03-01", "a", envelope("2024-03-01", "a", forecast=False))
    land(landed, "2024-03-01", "b", envelope("2024-03-01", "b"))
    b = B.read_bronze(spark, landed, landed=True)
    assert FL.silver_daily(b).count() == 1
    assert FL.silver_locations(b).count() == 2


def test_truncated_file_fails_the_scan(spark, landed):
    # T18
    land(landed, "2024-03-01", "a", json.dumps(envelope("2024-03-01", "a"), indent=2)[:150])
    with pytest.raises(Exception):
        B.read_bronze(spark, landed, landed=True).collect()


def test_json_lines_need_the_line_reader(spark, tmp_root):
    # multiLine on a JSON Lines file returns only its first record
    d = os.path.join(tmp_root, "jl", "dt=2024-03-01")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for loc in ["a", "b", "c"]:
            f.write(json.dumps(envelope("2024-03-01", loc)) + "\n")
    root = os.path.join(tmp_root, "jl")
    assert B.read_bronze(spark, root, landed=False).count() == 3
    first_only = (spark.read.schema(B.BRONZE).option("multiLine", True).json(root).count())
    assert first_only == 1


def test_keep_last_in_listing_order(spark, landed):
    # The same (location_id, date) in two files: the later path wins
    land(landed, "2024-03-01", "a1", envelope("2024-03-01", "a", temp_avg="1"))
    land(landed, "2024-03-01", "a2", envelope("2024-03-01", "a", temp_avg="2"))
    daily, locs = silver_from_bronze(B.read_bronze(spark, landed, landed=True))
    rows = daily.collect()
    assert len(rows) == 1 and rows[0]["temp_avg_c"] == 2.0
    assert locs.count() == 1


def test_write_bronze_roundtrip_and_idempotent_overwrite(spark, tmp_root):
    from dailylake.sources.registry import registry_from_rows, validate_registry
    reg = validate_registry(registry_from_rows(spark, [
        {"location_id": "a", "name": "A", "country": "RO", "region": "R", "lat": 1.0, "lon": 2.0,
         "tz": "UTC"}]))
    obs = spark.createDataFrame(
        [("a", dt.date(2024, 3, 1), 1.5, 0.0, 2.0, 0.1, 0.0, 50.0, 3.0, 1000, "Sunny",
          dt.datetime(2024, 3, 2, 6))],
        "location_id string, date date, temp_avg_c double, temp_min_c double, temp_max_c double, "
        "precip_mm double, snow_cm double, humidity_avg double, wind_max_kph double, "
        "condition_code int, condition_text string, ingested_at timestamp")
    root = os.path.join(tmp_root, "bronze")
    B.write_bronze(B.build_envelopes(obs, reg), root)
    B.write_bronze(B.build_envelopes(obs, reg), root)  # rerun replaces, does not append
    b = B.read_bronze(spark, root)
    assert b.count() == 1
    d = FL.silver_daily(b).first()
    assert (d["location_id"], d["temp_avg_c"], d["condition_code"]) == ("a", 1.5, 1000)
    assert d["ingested_at"] == dt.datetime(2024, 3, 2, 6)


def test_registry_requires_coordinates(spark):
    from dailylake.sources.registry import RegistryError, registry_from_rows, validate_registry
    with pytest.raises(RegistryError):
        registry_from_rows(spark, [])
    bad = registry_from_rows(spark, [{"location_id": "a", "lat": None, "lon": 1.0}])
    with pytest.raises(RegistryError, match="missing lat/lon"):
        validate_registry(bad)


def test_silver_overwrite_is_per_partition_and_pruned(spark, tmp_root):
    root = os.path.join(tmp_root, "silver")
    mk = lambda rows: spark.createDataFrame(rows, "dt date, location_id string, date date, v int")
    S.write_silver(mk([(dt.date(2024, 1, 1), "a", dt.date(2024, 1, 1), 1),
                       (dt.date(2024, 1, 2), "a", dt.date(2024, 1, 2), 1)]), root)
    S.write_silver(mk([(dt.date(2024, 1, 2), "a", dt.date(2024, 1, 2), 2)]), root)
    got = {(r["dt"], r["v"]) for r in S.read_silver(spark, root).collect()}
    assert got == {(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)}
    # plan strings are cut after a fixed length, expression ids grow with the session
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    one = S.read_silver(spark, root, dt="2024-01-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-02", plan)
    assert {os.path.basename(os.path.dirname(f)) for f in one.inputFiles()} == {"dt=2024-01-02"}
    assert S.read_silver(spark, root, dt="2024-01-09").count() == 0
    span = S.read_silver(spark, root, dt_from="2024-01-02", dt_to="2024-01-03")
    plan = span._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\]]*>= 2024-01-02[^\]]*<= 2024-01-03", plan)
    assert one.count() == 1
    assert {r["dt"] for r in S.present_dts(spark, root).collect()} == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert S.present_dts(spark, os.path.join(tmp_root, "nothing")).count() == 0


def _bronze(spark, recs):
    import json
    from dailylake.schemas import BRONZE
    rows = spark.createDataFrame([(r["metadata"]["dt"], json.dumps(r)) for r in recs], "dt string, text string")
    parsed = rows.select("dt", F.from_json("text", BRONZE).alias("r"))
    return parsed.select("dt", "r.metadata", "r.payload")


@pytest.mark.parametrize("by", [("dt",), ("dt", "location_id")])
def test_rerun_of_one_location_keeps_the_others(spark, tmp_root, by):
    root = os.path.join(tmp_root, "bronze")
    mk = lambda loc, hour, t: envelope("2024-03-01", loc, temp_avg=t, ingested_at=f"2024-03-01T{hour}:00:00+00:00")
    B.write_bronze(_bronze(spark, [mk("a", "06", "1"), mk("b", "06", "1")]), root, by)
    B.write_bronze(_bronze(spark, [mk("a", "05", "2"), mk("a", "07", "3")]), root, by)
    got = sorted((r["location_id"], r["temp_avg_c"]) for r in FL.silver_daily(B.read_bronze(spark, root)).collect())
    assert got == [("a", 3.0), ("b", 1.0)]


@pytest.mark.parametrize("files", [1, 2])
def test_latest_delivery_wins_in_both_outputs(spark, tmp_root, files):
    """Spark-written bronze: the time of ingestion decides, not the part file's name."""
    from dailylake.plans.pipeline import silver_from_bronze
    root = os.path.join(tmp_root, "bronze")
    early = envelope("2024-03-01", "a", name="Zold", temp_avg="1", ingested_at="2024-03-01T05:00:00+00:00")
    late = envelope("2024-03-01", "a", name="Anew", temp_avg="2", ingested_at="2024-03-01T20:00:00+00:00")
    parts = [[late, early]] if files == 1 else [[late], [early]]
    for p in parts:
        _bronze(spark, p).coalesce(1).write.mode("append").partitionBy("dt").json(root)
    daily, locs = silver_from_bronze(B.read_bronze(spark, root))
    assert [r["temp_avg_c"] for r in daily.collect()] == [2.0] and [r["name"] for r in locs.collect()] == ["Anew"]


def test_duplicates_with_null_keys(spark):
    from dailylake.operators.dedup import duplicate_members
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    assert sorted(r["v"] for r in duplicate_members(df, ["k"]).collect()) == [1, 2, 4, 5]


def test_one_day_lists_its_own_folder(spark, tmp_root):
    root = os.path.join(tmp_root, "bronze")
    recs = [envelope(f"2024-03-0{d}", "a", ingested_at=f"2024-03-0{d}T06:00:00+00:00") for d in (1, 2, 3)]
    B.write_bronze(_bronze(spark, recs), root)
    assert {os.path.basename(os.path.dirname(f)) for f in B.read_bronze(spark, root, dt="2024-03-02").inputFiles()} == {"dt=2024-03-02"}


def test_one_day_write_opens_one_days_files(spark, tmp_root, monkeypatch):
    """A daily landing in a long history reads the folder of its day and no other."""
    root = os.path.join(tmp_root, "bronze")
    days = [str(dt.date(2022, 1, 1) + dt.timedelta(days=i)) for i in range(1000)]
    _bronze(spark, [envelope(d, "a", ingested_at=f"{d}T06:00:00+00:00") for d in days]).coalesce(1).write.partitionBy("dt").json(root)
    before = {d: sorted(os.listdir(os.path.join(root, f"dt={d}"))) for d in days}
    opened = []
    read = B.read_bronze
    monkeypatch.setattr(B, "read_bronze", lambda *a, **k: opened.append(read(*a, **k)) or opened[-1])
    mk = lambda d, loc: envelope(d, loc, temp_avg="7", ingested_at=f"{d}T09:00:00+00:00")
    B.write_bronze(_bronze(spark, [mk("2023-05-05", "b"), mk("2030-01-01", "b")]), root)
    assert [{os.path.basename(os.path.dirname(f)) for f in df.inputFiles()} for df in opened] == [{"dt=2023-05-05"}]
    assert {d for d in days if sorted(os.listdir(os.path.join(root, f"dt={d}"))) != before[d]} == {"2023-05-05"}
    got = FL.silver_daily(read(spark, root, days=["2023-05-05", "2030-01-01"])).collect()
    assert sorted((str(r["dt"]), r["location_id"]) for r in got) == [("2023-05-05", "a"), ("2023-05-05", "b"), ("2030-01-01", "b")]


def test_partitions_are_listed_without_opening_files(spark, tmp_root):
    root = os.path.join(tmp_root, "silver")
    for d in ("2024-01-01", "2024-01-02", "2024-01-06"):
        os.makedirs(os.path.join(root, f"dt={d}"))
        with open(os.path.join(root, f"dt={d}", "part-0.parquet"), "wb") as f:
            f.write(b"not parquet at all")  # opening it would fail
    os.makedirs(os.path.join(root, "dt=2024-01-03"))  # a folder without files
    open(os.path.join(root, "dt=2024-01-03", "_SUCCESS"), "w").close()
    present = S.present_dts(spark, root)
    day = lambda n: dt.date(2024, 1, n)
    assert sorted(r["dt"] for r in present.collect()) == [day(1), day(2), day(6)]
    gaps = [(day(n), day(2), day(6)) for n in (3, 4, 5)]
    rows = lambda *a: sorted(tuple(r) for r in S.missing_dts(present, *a).collect())
    assert rows() == gaps and rows(day(4), day(5)) == gaps[1:] and rows(day(1), day(2)) == []
    assert rows(day(5), day(8)) == [gaps[2], (day(7), day(6), None), (day(8), day(6), None)]
    assert sorted(tuple(r) for r in S.missing_dts(present.limit(0), day(1), day(2)).collect()) == [(day(1), None, None), (day(2), None, None)]
    assert S.partition_hint(spark, root, "2024-01-04", 2).endswith("nearest days with data: 2024-01-02, 2024-01-06")


def test_drifted_column_type_fails(spark, tmp_root):
    from dailylake.schemas import SILVER_DAILY
    root = os.path.join(tmp_root, "silver")
    mk = lambda d, v: spark.createDataFrame([(dt.date(2024, 1, d), "a", v)], ["dt", "location_id", "temp_avg_c"])
    S.write_silver(mk(1, 1.5), root)
    kept = S.read_silver(spark, root, schema=SILVER_DAILY)
    assert kept.columns == ["location_id", "temp_avg_c", "dt"] and kept.first()["temp_avg_c"] == 1.5
    S.write_silver(mk(2, "warm"), os.path.join(tmp_root, "other"))
    with pytest.raises(S.SchemaDriftError, match="temp_avg_c is string, not double"):
        S.read_silver(spark, os.path.join(tmp_root, "other"), schema=SILVER_DAILY)
    S.write_silver(mk(2, "warm"), root)  # one file of many: the scan finds it
    with pytest.raises(Exception, match="temp_avg_c"):
        S.read_silver(spark, root, schema=SILVER_DAILY).select("temp_avg_c").collect()


def test_malformed_records_are_told_apart(spark, tmp_root):
    root = os.path.join(tmp_root, "bronze")
    land(root, "2024-03-01", "a", envelope("2024-03-01", "a"))
    land(root, "2024-03-01", "b", '{"metadata": {"dt": "2024-03-01", "location_id": "b"')  # cut off
    land(root, "2024-03-02", "c", envelope("2024-03-02", "c", date="soon"))
    land(root, "2024-03-03", "d", "not json")
    land(root, "2024-03-04", "e", envelope("2024-03-04", "e", forecast=False))
    got = B.read_bronze(spark, root, landed=True, keep_malformed=True)
    bad = {(r["dt"], r["malformed"]) for r in got.select("dt", "malformed").distinct().collect()}
    assert {d for d, m in bad if m} == {"2024-03-01", "2024-03-02", "2024-03-03"}
    assert ("2024-03-01", False) in bad and ("2024-03-04", False) in bad


def test_whole_number_coercion(spark):
    from dailylake.functions.coerce import to_int
    df = spark.createDataFrame([("3",), ("3.0",), (" 4 ",), ("3.7",), ("1e3",), ("9e99",), ("NaN",), ("x",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(to_int("v")).collect()] == [3, 3, 4, None, 1000, None, None, None, None, None]
