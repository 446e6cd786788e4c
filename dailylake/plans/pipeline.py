"""Daily run and backfill (G10, G11): bronze -> silver -> gate -> staging -> gold.

A day and a date range run the same code: every step is grouped or
partitioned by ``dt``, so a backfill is one Spark job per step instead of one
run per day. Days with malformed records are set aside first, the gate runs
before anything is written to staging. A failing single day stops the run; in a
range each day stands on its own, passing days are loaded and every day's outcome
goes to the run log, as independent scheduled runs per day would behave.

Both staging tables change in one commit, and so do all gold tables
(:mod:`dailylake.operators.snapshots`): a run that ends in between leaves the old
state, and the gold commit names the staging version it was built from.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dailylake.operators import flatten as FL
from dailylake.operators import load as LD
from dailylake.operators import quality as Q
from dailylake.operators.dedup import keep_last
from dailylake.operators.runlog import log_days, utc_now
from dailylake.operators.snapshots import CommitConflictError, Snapshots
from dailylake.plans import gold as G
from dailylake.plans import incremental as INC
from dailylake.plans import layers as LY
from dailylake.schemas import SILVER_DAILY, SILVER_LOCATIONS
from dailylake.session import path_exists, scratch_path
from dailylake.sources import bronze as B
from dailylake.sources import silver as S

STG_DAILY, STG_LOCATIONS = "stg_weather_daily", "stg_locations"


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    @property
    def bronze(self) -> str:
        return self._p("bronze", "observations")

    @property
    def silver_daily(self) -> str:
        return self._p("silver", "daily")

    @property
    def silver_locations(self) -> str:
        return self._p("silver", "locations")

    @property
    def staging(self) -> str:
        """The staging tables, with their commits."""
        return self._p("staging")

    @property
    def gold(self) -> str:
        """Dimensions, fact and marts, with their commits."""
        return self._p("gold")

    @property
    def runs(self) -> str:
        return self._p("monitoring", "pipeline_runs")


def table(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame | None:
    """A staging or gold table as of its last commit; None if it was never written."""
    df = Snapshots(spark, paths.staging if name.startswith("stg_") else paths.gold).read(name)
    return df.drop("month") if df is not None and name in INC.BY_MONTH else df


def silver_from_bronze(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flatten and keep the last record per key *within each dt* (as a per-day run does)."""
    ordered = FL.delivery_order(bronze)
    daily = keep_last(FL.silver_daily(ordered), ["dt", "location_id", "date"], FL.DELIVERY)
    locs = keep_last(FL.silver_locations(ordered), ["dt", "location_id"], FL.DELIVERY)
    return (daily.select(*[f.name for f in SILVER_DAILY.fields]),
            locs.select(*[f.name for f in SILVER_LOCATIONS.fields]))


def bronze_to_silver(spark: SparkSession, paths: LakePaths, dt_from, dt_to=None,
                     landed: bool = False, days: DataFrame | None = None) -> DataFrame:
    """Read bronze for the day(s), flatten, dedup, overwrite those silver days.

    ``days``: only these days of the range. A single day lists its own folder only.
    The JSON is parsed once, into the shared scratch folder. Days with a record that
    is no envelope, or whose dates don't parse, are left out and keep their silver;
    they are returned with the number of such records and a file of them. If no
    other day has rows, that is an error.
    """
    dt_to = dt_to or dt_from
    one = str(dt_from) if str(dt_from) == str(dt_to) else None
    if one is not None and not path_exists(spark, f"{paths.bronze}/dt={one}"):
        raise ValueError(f"no location rows for dt {one} found")
    bronze = B.read_bronze(spark, paths.bronze, dt=one, landed=landed, keep_malformed=True)
    lo, hi = F.lit(str(dt_from)).cast("date"), F.lit(str(dt_to)).cast("date")
    bronze = bronze.where(F.col("dt").try_cast("date").between(lo, hi))
    if days is not None:
        bronze = bronze.join(days.select(F.col("dt").cast("string").alias("dt")), "dt", "left_semi")
    scratch = scratch_path(spark, "parsed")
    bronze.write.parquet(f"{scratch}/records")
    records = spark.read.parquet(f"{scratch}/records")
    (records.where("malformed").groupBy(F.col("dt").cast("date").alias("dt"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("source_file").alias("file")).write.parquet(f"{scratch}/malformed"))
    broken = spark.read.parquet(f"{scratch}/malformed")
    sound = records.join(broken.select(F.col("dt").cast("string").alias("dt")), "dt", "left_anti").drop("malformed")
    if not landed:  # the part files of a Spark write have no order
        sound = sound.drop("source_file")
    first = broken.orderBy("dt").first()
    if first and sound.limit(1).count() == 0:
        raise Q.QualityGateError(malformed_text(first))
    B.require_rows(sound, f"location rows for dt {dt_from}..{dt_to}")
    # before the keep-last aggregate: a scan that stops at the first row
    B.require_rows(FL.silver_daily(sound), f"daily rows for dt {dt_from}..{dt_to}")
    daily, locs = silver_from_bronze(sound)
    S.write_silver(daily, paths.silver_daily)
    S.write_silver(locs, paths.silver_locations)
    return broken


def malformed_text(day) -> str:
    """What the run log and errors say of a row of :func:`bronze_to_silver`'s result."""
    return f"malformed_bronze: {day['n']} record(s) of {day['dt']}, first file {day['file']}"


def expected_days(spark: SparkSession, dt_from, dt_to) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(str(dt_from)).cast("date"), F.lit(str(dt_to)).cast("date"))).alias("dt"))


def gate(spark: SparkSession, paths: LakePaths, dt_from, dt_to=None,
         cfg: Q.QualityConfig = Q.QualityConfig(), registry: DataFrame | None = None,
         strict: bool = True, days: DataFrame | None = None) -> DataFrame:
    """Gate report for the day(s), one row per day, written to the shared scratch folder.

    ``strict``: raise QualityGateError when any day fails (a daily run).
    Otherwise the report is returned and only passing days are loaded, as
    independent scheduled runs per day would do in a backfill. ``days``: only
    these days of the range.
    """
    dt_to = dt_to or dt_from
    expected = expected_days(spark, dt_from, dt_to) if days is None else days
    parts = [S.read_silver(spark, root, dt_from=dt_from, dt_to=dt_to, schema=schema)
             for root, schema in ((paths.silver_daily, SILVER_DAILY), (paths.silver_locations, SILVER_LOCATIONS))]
    if days is not None:
        parts = [p.join(days, "dt", "left_semi") for p in parts]
    daily, locs = parts
    out = scratch_path(spark, "gate")
    Q.gate_report(daily, locs, cfg, expected_dts=expected, expected_locations=registry).write.parquet(out)
    rep = spark.read.parquet(out)
    if strict:
        Q.raise_on_failure(rep, daily=daily, cfg=cfg, expected=locs if registry is None else registry,
                           roots={"missing_daily_partition": paths.silver_daily, "missing_locations_partition": paths.silver_locations})
    return rep


def load_staging(spark: SparkSession, paths: LakePaths, days: DataFrame,
                 locations_mode: str = "replace", attempts: int = 3) -> DataFrame:
    """Load the given silver days (a DataFrame of ``dt``) into staging; returns the rows of each day.

    Both tables are written beside the current ones, checked there, and changed by
    one commit, which notes the earliest day for the next gold build. In replace mode
    the locations are those of the last day, as after a run per day. If another load
    commits first, this one starts anew from its state.
    """
    lo, hi = days.agg(F.min("dt"), F.max("dt")).first()
    counts = scratch_path(spark, "load")
    if lo is None:
        return spark.createDataFrame([], "dt date, records_loaded int")
    daily = S.read_silver(spark, paths.silver_daily, dt_from=lo, dt_to=hi, schema=SILVER_DAILY).join(days, "dt", "left_semi")
    first = hi if locations_mode == "replace" else lo
    locs = S.read_silver(spark, paths.silver_locations, dt_from=first, dt_to=hi, schema=SILVER_LOCATIONS).join(days, "dt", "left_semi")
    named = {str(r["dt"]) for r in days.collect()}  # one a calendar day
    change = Snapshots(spark, paths.staging).begin()
    written = Observation()
    LD.load_daily_replace_dt(spark, LD.staging_daily_rows(daily).observe(written, F.count(F.lit(1)).alias("rows")),
                             paths.staging, check_keys=False, change=change, table=STG_DAILY)
    staged = change.read(STG_DAILY, keep=lambda v: v in named)
    LD.check_daily_keys(staged, date_is_dt=True)
    staged.groupBy("dt").agg(F.count(F.lit(1)).cast("int").alias("records_loaded")).write.parquet(counts)
    loaded = spark.read.parquet(counts)
    total = loaded.agg(F.sum("records_loaded")).first()[0] or 0
    if total != written.get["rows"]:
        raise LD.LoadError(f"{written.get['rows']} rows were written, {total} are there")
    loc_rows = LD.staging_location_rows(locs)
    if locations_mode == "upsert":
        LD.upsert_into(spark, loc_rows, paths.staging, ["location_id"], change=change, table=STG_LOCATIONS)
    else:
        LD.load_locations_full(loc_rows, paths.staging, change=change, table=STG_LOCATIONS)
        LD.check_not_null(change.read(STG_LOCATIONS), ["location_id"], STG_LOCATIONS)
    change.note(since=str(lo))
    try:
        change.commit()
    except CommitConflictError:
        if attempts <= 1:
            raise
        return load_staging(spark, paths, days, locations_mode, attempts - 1)
    return loaded


def _since(staging: Snapshots, seen: int, now: int) -> str | None:
    """The earliest day loaded by the commits after ``seen``; "" if a record of them is gone."""
    found = []
    known = set(staging.versions())
    for version in range(seen + 1, now + 1):
        if version not in known:
            return ""
        note = staging.record(version)["notes"].get("since")
        if note is None:
            return ""
        found.append(note)
    return min(found) if found else None


def build_gold(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """Write dims, fact and marts in one commit; BI views stay views, published with the tables.

    The fact, the trailing-window marts and the monthly moments are refreshed from the
    month of the earliest day loaded since the staging version that the last gold
    commit names, or built whole if there is none. A failed build leaves that version
    as it was, so the next one makes up for it.
    """
    staging, store = Snapshots(spark, paths.staging), Snapshots(spark, paths.gold)
    source, before = staging.record(), store.record()
    g = G.Gold(staging.read(STG_DAILY, record=source), staging.read(STG_LOCATIONS, record=source))
    whole = any(name not in before["tables"] for name in ("dim_date", "dim_location", *INC.BY_MONTH))
    since = "" if whole else _since(staging, before["notes"].get("staging", 0), source["version"])
    if since is not None:
        change = store.begin()
        change.replace("dim_location", g.dim_location())
        # a staging day holds its own date only (checked when loaded), so the folders' names are the bounds
        dts = sorted(part.split("=", 1)[1] for part in source["tables"][STG_DAILY]["folders"])
        change.replace("dim_date", G.dim_date_between(spark, dts[0], dts[-1]))
        start = since[:8] + "01" if since else ""
        fact = G.Gold(staging.read(STG_DAILY, keep=lambda v: v >= start, record=source), g.stg_locations).fact()
        put = change.replace_partitions if since else change.replace
        put(INC.FACT, INC.by_month(fact), "month")
        fact = change.read(INC.FACT).drop("month")
        for name, (build, lookback) in INC.TRAILING_MARTS.items():
            put(name, INC.by_month(INC.refresh(fact, build, lookback, since) if since else build(fact)), "month")
        tail = change.read(INC.FACT, keep=lambda v: v >= start)
        put(INC.MOMENTS, G.location_moments(tail), "month")
        change.note(staging=source["version"])
        change.commit()
    tables = {name: table(spark, paths, name) for name in ("dim_location", "dim_date", INC.FACT, *INC.TRAILING_MARTS)}
    fact, dim_d, dim_l = tables[INC.FACT], tables["dim_date"], tables["dim_location"]
    tables["mart_anomalies"] = G.mart_anomalies_from(fact, store.read(INC.MOMENTS))
    views = {
        "weather_daily_bi": G.present(G.weather_daily_bi(fact, dim_d, dim_l), "date", "location_id"),
        "weather_weekly_bi": G.present(G.weather_weekly_bi(fact, dim_l), "week_start", "location_id"),
        "weather_anomalies_bi": G.present(G.weather_anomalies_bi(fact, dim_d, dim_l), "date", "location_id"),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    LY.publish(spark, staging, store)
    return {**tables, **views}


def model_tests(out: dict[str, DataFrame], stg: DataFrame) -> DataFrame:
    """The failing model tests of a build (model, column, failures); empty if all pass."""
    models = {**out, "stg_weather_daily": stg}
    nulls = Q.test_not_null(models, [("stg_weather_daily", "location_id"), ("stg_weather_daily", "date"),
                                     ("stg_weather_daily", "dt"), ("fact_weather_daily", "location_id"),
                                     ("fact_weather_daily", "date"), ("dim_location", "location_id"),
                                     ("dim_date", "date")])
    unique = Q.test_unique(models, [("dim_location", ["location_id"]), ("dim_date", ["date"]),
                                    ("stg_weather_daily", ["location_id", "date"])])
    return nulls.unionByName(unique).where("failures > 0")


def run(spark: SparkSession, paths: LakePaths, dt_from, dt_to=None,
        cfg: Q.QualityConfig = Q.QualityConfig(), landed: bool = False,
        locations_mode: str = "replace", registry: DataFrame | None = None,
        with_gold: bool = True, strict: bool = True,
        days: DataFrame | None = None, now=None) -> dict[str, DataFrame]:
    """bronze -> silver -> gate -> staging -> gold -> model tests -> freshness for one day or a range.

    ``strict``: a failure of any day (malformed records, a gate rule) raises and nothing
    reaches staging. Otherwise the days that pass are loaded, and it raises only if no
    day passes. ``days``: only these days of the range. Every day's outcome goes to
    the run log at the end, failures of the load, gold, model tests or freshness
    included. ``now``: the time at which the stored tables' freshness is judged (the
    present one by default); a warning is logged with the successful days.
    """
    dt_to = dt_to or dt_from
    started = utc_now()
    wanted = expected_days(spark, dt_from, dt_to) if days is None else days
    rep, warned = None, None
    try:
        broken = bronze_to_silver(spark, paths, dt_from, dt_to, landed=landed, days=days)
        first = broken.orderBy("dt").first()
        if strict and first:
            raise Q.QualityGateError(malformed_text(first))
        rep = gate(spark, paths, dt_from, dt_to, cfg, registry, strict=strict,
                   days=wanted.join(broken.select("dt"), "dt", "left_anti") if first else days)
        said = F.format_string("malformed_bronze: %d record(s) of %s, first file %s", "n", F.col("dt").cast("string"), "file")
        rep = rep.unionByName(broken.select("dt", said.alias("failed_rule"), F.lit(False).alias("passed")), allowMissingColumns=True)
        passed = rep.where("passed").select("dt")
        if passed.limit(1).count() == 0:
            raise Q.QualityGateError(f"no day of {dt_from}..{dt_to} passed the gate")
        loaded = load_staging(spark, paths, passed, locations_mode)
        out = {"gate_report": rep}
        if with_gold:
            out.update(build_gold(spark, paths))
            failing = model_tests(out, table(spark, paths, STG_DAILY)).collect()  # a row for each test
            if failing:
                raise Q.QualityGateError("model tests: " + ", ".join(f"{r['model']}.{r['column']}: {r['failures']}" for r in failing))
            warned = check_freshness(spark, paths, now)
    except Exception as e:
        text = f"{type(e).__name__}: {e}"
        outcome = wanted.select("dt", F.lit(text).alias("failed_rule"))
        if rep is not None:  # a day's own failing rule says more than the run's error
            outcome = rep.select("dt", F.coalesce("failed_rule", F.lit(text)).alias("failed_rule"))
        log_days(outcome, paths.runs, started)
        raise
    log_days(rep.select("dt", "failed_rule"), paths.runs, started, loaded, warned)
    return out


def check_freshness(spark: SparkSession, paths: LakePaths, now=None) -> str | None:
    """Freshness of the stored staging tables: raises on a stale one, returns what is to be warned of."""
    sources = {name: table(spark, paths, name) for name in (STG_DAILY, STG_LOCATIONS)}
    found = Q.source_freshness(sources, now if now is not None else F.current_timestamp()).where("status <> 'pass'").collect()
    if not found:
        return None
    text = "source freshness: " + ", ".join(f"{r['source']} {r['status']} ({r['age_hours']} hours)" for r in found)
    if any(r["status"] == "error" for r in found):
        raise Q.QualityGateError(text)
    return text


def backfill(spark: SparkSession, paths: LakePaths, dt_from, dt_to, strict: bool = False, **kw) -> dict[str, DataFrame]:
    """All days of [dt_from, dt_to] in one run, each day on its own."""
    return run(spark, paths, dt_from, dt_to, strict=strict, **kw)
