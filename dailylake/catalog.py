"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the generated tables of ``sf_dir`` (mapped onto the
weather contract by :mod:`dailylake.sources.tables`) and runs over them whole.
Output columns are named and typed as in the oracle SQL; timestamps with a
time zone are shown as wall-clock UTC (``timestamp_ntz``) and the z-score is
rounded to 6 places, the only floating-point output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dailylake.plans import gold as G
from dailylake.plans import perf as P
from dailylake.sources.tables import Tables
from dailylake.session import configure

# Order prices stand in for temperatures: the anomaly threshold scales with them.
PRICE_ANOMALY_THRESHOLD = 100000.0

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _gold(spark: SparkSession, sf_dir: str) -> G.Gold:
    configure(spark)
    t = Tables(spark, sf_dir)
    return G.Gold(t.staging_daily(), t.staging_locations())


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---- staging / gold ------------------------------------------------------------

@query
def stg_daily(spark, sf_dir):
    return _ntz(_gold(spark, sf_dir).stg_daily, "ingested_at")


@query
def stg_locations(spark, sf_dir):
    return _ntz(_gold(spark, sf_dir).stg_locations, "ingested_at")


@query
def dim_location(spark, sf_dir):
    return _gold(spark, sf_dir).dim_location()


@query
def dim_date(spark, sf_dir):
    return _gold(spark, sf_dir).dim_date()


@query
def fact_daily(spark, sf_dir):
    return _ntz(_gold(spark, sf_dir).fact(), "ingested_at")


@query
def mart_rolling(spark, sf_dir):
    return G.mart_weather_rolling(_gold(spark, sf_dir).fact())


@query
def mart_weekly_change(spark, sf_dir):
    return G.mart_weekly_change(_gold(spark, sf_dir).fact())


@query
def mart_anomalies(spark, sf_dir):
    m = G.mart_anomalies(_gold(spark, sf_dir).fact())
    return m.withColumn("z_score", F.round("z_score", 6))


@query
def bi_daily(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return G.weather_daily_bi(g.fact(), g.dim_date(), g.dim_location())


@query
def bi_weekly(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return G.weather_weekly_bi(g.fact(), g.dim_location())


@query
def bi_anomalies(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return G.weather_anomalies_bi(g.fact(), g.dim_date(), g.dim_location(),
                                  threshold=PRICE_ANOMALY_THRESHOLD)


# ---- analyst queries ---------------------------------------------------------------

@query
def perf_sanity(spark, sf_dir):
    return P.sanity(_gold(spark, sf_dir).fact())


@query
def perf_top_locations(spark, sf_dir):
    return P.top_locations(_gold(spark, sf_dir).dim_location())


@query
def perf_location_range(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return P.location_range(g.fact(), g.dim_location())


@query
def perf_rolling_range(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return P.rolling_range(g.fact(), g.dim_location())


@query
def perf_country_daily(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return P.country_daily(g.fact(), g.dim_location())


# ---- sources and silver ---------------------------------------------------------------

from dailylake.functions.coerce import nan_to_null, to_int  # noqa: E402
from dailylake.operators import flatten as FL  # noqa: E402
from dailylake.operators import load as LD  # noqa: E402
from dailylake.operators import quality as Q  # noqa: E402
from dailylake.operators.dedup import duplicate_groups, duplicate_members, keep_last  # noqa: E402
from dailylake.operators.snapshots import Snapshots  # noqa: E402
from dailylake.plans import pipeline as PL  # noqa: E402
from dailylake.schemas import SILVER_DAILY, SILVER_LOCATIONS, STG_DAILY_COLUMNS  # noqa: E402
from dailylake.sources import bronze as B  # noqa: E402
from dailylake.sources import silver as S  # noqa: E402
from dailylake.sources.registry import validate_registry  # noqa: E402
from dailylake.sources.tables import observations  # noqa: E402
from dailylake.session import scratch_path  # noqa: E402

SILVER_DAILY_COLS = [f.name for f in SILVER_DAILY.fields]
SILVER_LOCATION_COLS = [f.name for f in SILVER_LOCATIONS.fields]

# Range rules in price units (the weather defaults are -80..60 degrees).
PRICE_QUALITY = Q.QualityConfig(temp_min_c=5000.0, temp_max_c=495000.0)
# Wide price bounds: the rows with faults fail by those.
PRICE_FAULTS = Q.QualityConfig(temp_min_c=0.0, temp_max_c=520000.0, min_completeness_ratio=0.9)
# The backfill gate only has to pass on valid prices.
PRICE_GATE = Q.QualityConfig(temp_min_c=0.0, temp_max_c=1e9)
# Freshness is judged against this reference time (a parameter of the check).
FRESHNESS_NOW = "2001-08-04 00:00:00"


def _tables(spark, sf_dir) -> Tables:
    configure(spark)
    return Tables(spark, sf_dir)


def _envelopes(t: Tables) -> DataFrame:
    return B.build_envelopes(t.obs(), t.registry())


def _order_envelopes(t: Tables) -> DataFrame:
    return B.build_envelopes(t.order_obs(), t.registry())


def _silver_daily_out(df: DataFrame) -> DataFrame:
    return _ntz(df.select(*SILVER_DAILY_COLS), "ingested_at")


def _day_silver(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Silver daily and locations for every day, built from in-memory envelopes."""
    env = _envelopes(t)
    return FL.silver_daily(env), FL.silver_locations(env)


@query
def src_registry(spark, sf_dir):
    return validate_registry(_tables(spark, sf_dir).registry())


@query
def silver_daily(spark, sf_dir):
    return _silver_daily_out(_day_silver(_tables(spark, sf_dir))[0])


@query
def silver_locations(spark, sf_dir):
    return _ntz(_day_silver(_tables(spark, sf_dir))[1].select(*SILVER_LOCATION_COLS), "ingested_at")


@query
def silver_dedup(spark, sf_dir):
    """Re-delivered observations: keep the last delivery per (location, day)."""
    t = _tables(spark, sf_dir)
    daily = FL.silver_daily(_order_envelopes(t))
    return _silver_daily_out(keep_last(daily, ["location_id", "date"], ["ingested_at"]))


@query
def scalar_nan_to_null(spark, sf_dir):
    # every tenth reading is broken off: NaN
    value = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    ev = _tables(spark, sf_dir).events.select("event_id", value.alias("value"), "props")
    out = nan_to_null(ev, ["value"])
    return out.select("event_id", "value", to_int(F.get_json_object("props", "$.k")).alias("k"))


@query
def src_bronze_json(spark, sf_dir):
    """Envelopes written as JSON Lines, scanned back with the explicit schema."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "bronze")
    B.write_bronze(_envelopes(t), root)
    return _silver_daily_out(FL.silver_daily(B.read_bronze(spark, root)))


@query
def sink_bronze_roundtrip(spark, sf_dir):
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "bronze")
    B.write_bronze(_envelopes(t), root)
    b = B.read_bronze(spark, root)
    return b.select(F.col("dt").cast("date").alias("dt"),
                    F.col("metadata.location_id").alias("location_id"),
                    F.col("metadata.location_name").alias("location_name"),
                    F.col("metadata.ingested_at").alias("ingested_at"),
                    F.col("metadata.source").alias("source"),
                    F.col("metadata.api_version").alias("api_version"),
                    F.col("metadata.request.q").alias("request_q"),
                    F.col("metadata.request.endpoint").alias("request_endpoint"),
                    F.size("payload.forecast.forecastday").alias("n_days"))


@query
def sink_bronze_rerun(spark, sf_dir):
    """Monthly deliveries, one record an order: all in a first write, of which the
    second write corrects every other location; each key keeps its last record."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "bronze")
    obs = t.order_obs().drop("ingested_at", "dt")
    key = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    key = key.join(t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("location_id")), F.col("o_custkey") == F.col("c_custkey"))
    rows = key.select("location_id", F.col("day").alias("date"), F.trunc("day", "month").alias("dt"),
                      F.col("o_totalprice").cast("decimal(18,2)").alias("temp_avg_c"), "o_orderkey",
                      *[F.lit(None).cast(obs.schema[c].dataType).alias(c) for c in obs.columns if c not in ("location_id", "date", "temp_avg_c")])
    rows = rows.withColumn("ingested_at", F.timestamp_seconds(F.unix_seconds(F.lit("2000-01-01").cast("timestamp")) + F.col("o_orderkey")))
    last = F.max("o_orderkey").over(Window.partitionBy("location_id", "dt"))
    even = F.col("location_id").cast("int") % 2 == 0
    # the first write lacks the last record of the even locations
    first = rows.withColumn("_last", last).where(~even | (F.col("o_orderkey") < F.col("_last")))
    B.write_bronze(B.build_envelopes(first.drop("_last", "o_orderkey"), t.registry()), root)
    B.write_bronze(B.build_envelopes(rows.where(even).drop("o_orderkey"), t.registry()), root)
    out = B.read_bronze(spark, root)
    return out.select(F.col("dt").cast("date").alias("dt"), F.col("metadata.location_id").alias("location_id"),
                      F.get("payload.forecast.forecastday", 0)["day"]["avgtemp_c"].cast("double").alias("temp_avg_c"),
                      F.col("metadata.ingested_at").alias("ingested_at"))


@query
def src_silver_parquet(spark, sf_dir):
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "silver")
    S.write_silver(_day_silver(t)[0], root)
    return _silver_daily_out(S.read_silver(spark, root))


def _finished_only(t: Tables) -> DataFrame:
    return observations(t.orders.where(F.col("o_orderstatus") == "F"), t.customer)


def _days_with_open_orders(t: Tables) -> DataFrame:
    """Days (dt) with at least one order that is not finished."""
    return (t.orders.where(F.col("o_orderstatus") != "F")
            .select(F.to_date("o_orderdate").alias("dt")).distinct())


@query
def sink_silver_overwrite(spark, sf_dir):
    """Write silver from finished orders, then rewrite the days that have other
    orders from all orders: untouched days survive, rewritten days are whole."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "silver")
    first = FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry()))
    S.write_silver(first, root)
    again = _day_silver(t)[0].join(_days_with_open_orders(t), "dt", "left_semi")
    S.write_silver(again, root)
    return _silver_daily_out(S.read_silver(spark, root))


def _stg_out(df: DataFrame) -> DataFrame:
    return _ntz(df.select(*STG_DAILY_COLUMNS), "ingested_at")


@query
def load_daily_replace_dt(spark, sf_dir):
    """Load finished-order days, then reload the days with other orders."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stg_daily")
    first = FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry()))
    LD.load_daily_replace_dt(spark, LD.staging_daily_rows(first), root)
    again = _day_silver(t)[0].join(_days_with_open_orders(t), "dt", "left_semi")
    LD.load_daily_replace_dt(spark, LD.staging_daily_rows(again), root)
    return _stg_out(LD.read_table(spark, root))


@query
def load_locations_full(spark, sf_dir):
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stg_locations")
    LD.load_locations_full(LD.staging_location_rows(_day_silver(t)[1]), root)
    return _ntz(LD.read_table(spark, root).drop("loaded_at"), "ingested_at")


def _open_keys(t: Tables) -> DataFrame:
    """(location, day) pairs with at least one order that is not finished."""
    return (t.orders.where(F.col("o_orderstatus") != "F")
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_nationkey").cast("string").alias("location_id"),
                    F.to_date("o_orderdate").alias("date")).distinct())


@query
def load_upsert_by_key(spark, sf_dir):
    """Upsert corrections: finished-order rows first, then every (location, day)
    with other orders recomputed from all orders (unpartitioned target)."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stg_upsert")
    base = LD.staging_daily_rows(FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry())))
    LD.upsert_into(spark, base, root, ["location_id", "date"])
    upd = LD.staging_daily_rows(_day_silver(t)[0].join(_open_keys(t), ["location_id", "date"], "left_semi"))
    LD.upsert_into(spark, upd, root, ["location_id", "date"])
    return _stg_out(LD.read_table(spark, root))


@query
def load_upsert_partitioned(spark, sf_dir):
    """The same upsert into a table partitioned by month: only the months of the
    corrected keys are rewritten."""
    t = _tables(spark, sf_dir)
    root = scratch_path(spark, "stg_upsert")
    month = F.trunc("date", "month")
    base = LD.staging_daily_rows(FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry())))
    LD.upsert_into(spark, base.withColumn("month", month), root, ["location_id", "date"], "month")
    upd = LD.staging_daily_rows(_day_silver(t)[0].join(_open_keys(t), ["location_id", "date"], "left_semi"))
    LD.upsert_into(spark, upd.withColumn("month", month), root, ["location_id", "date"], "month")
    return _stg_out(LD.read_table(spark, root))


def _backfilled(spark, sf_dir) -> PL.LakePaths:
    t = _tables(spark, sf_dir)
    paths = PL.LakePaths(scratch_path(spark, "lake"))
    B.write_bronze(_envelopes(t), paths.bronze)
    lo, hi = t.obs().agg(F.min("date"), F.max("date")).first()
    PL.backfill(spark, paths, lo, hi, cfg=PRICE_GATE, with_gold=False)
    return paths


@query
def backfill_range(spark, sf_dir):
    """Whole date range through bronze, silver, gate and staging in one run."""
    return _stg_out(PL.table(spark, _backfilled(spark, sf_dir), PL.STG_DAILY))


@query
def backfill_locations(spark, sf_dir):
    """The locations that the same run leaves: those of the last day, as day by day."""
    out = PL.table(spark, _backfilled(spark, sf_dir), PL.STG_LOCATIONS)
    return _ntz(out.drop("loaded_at"), "ingested_at")


@query
def run_log(spark, sf_dir):
    """The run log of the same run: loaded days with their rows, and days without data."""
    log = spark.read.parquet(_backfilled(spark, sf_dir).runs)
    return log.select("dt", "status", "records_loaded", "error_summary")


def _gold_in_two_builds(spark, sf_dir) -> PL.LakePaths:
    """A lake after loads out of order: the later half of the months with gold, then the
    earlier half without, then the refresh."""
    t = _tables(spark, sf_dir)
    paths = PL.LakePaths(scratch_path(spark, "lake"))
    rows = LD.staging_daily_rows(_day_silver(t)[0]).withColumn("dt", F.col("date"))
    locations = LD.staging_location_rows(_day_silver(t)[1])
    middle = t.obs().agg(F.expr("date_add(min(date), cast(datediff(max(date), min(date)) / 2 as int))")).first()[0]
    lowest = t.obs().agg(F.min("date")).first()[0]
    for part, since, gold in ((F.col("date") >= middle, middle, True), (F.col("date") < middle, lowest, False)):
        change = Snapshots(spark, paths.staging).begin()
        LD.load_locations_full(locations, paths.staging, change, PL.STG_LOCATIONS)
        LD.load_daily_replace_dt(spark, rows.where(part), paths.staging, date_is_dt=True, change=change, table=PL.STG_DAILY)
        change.note(since=str(since))
        change.commit()
        if gold:
            PL.build_gold(spark, paths)
    PL.build_gold(spark, paths)
    return paths


@query
def mart_incremental(spark, sf_dir):
    """The stored rolling mart after two builds."""
    return PL.table(spark, _gold_in_two_builds(spark, sf_dir), "mart_weather_rolling")


@query
def bi_weekly_by_name(spark, sf_dir):
    """The weekly view as other sessions read it, by its name in the catalog, after two builds."""
    _gold_in_two_builds(spark, sf_dir)
    return spark.table("analytics_bi.weather_weekly_bi")


# ---- quality -------------------------------------------------------------------------------

def _calendar(df: DataFrame, col: str = "date") -> DataFrame:
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias("dt"))


@query
def q_missing_partitions(spark, sf_dir):
    """Days of the observed range without a silver partition, with their neighbours that have one."""
    t = _tables(spark, sf_dir)
    daily = _day_silver(t)[0]
    root = scratch_path(spark, "silver")
    S.write_silver(daily, root)
    return S.missing_dts(S.present_dts(spark, root))


@query
def q_not_null(spark, sf_dir):
    daily, locs = _day_silver(_tables(spark, sf_dir))
    d_cols = Q.DAILY_REQUIRED + ["temp_min_c", "temp_max_c", "temp_avg_c", "precip_mm",
                                 "humidity_avg", "wind_max_kph"]
    return (Q.null_counts(daily, d_cols, ["dt"], "daily")
            .unionByName(Q.null_counts(locs, Q.LOCATIONS_REQUIRED, ["dt"], "locations")))


@query
def q_range(spark, sf_dir):
    daily = _day_silver(_tables(spark, sf_dir))[0]
    return Q.range_counts(daily, PRICE_QUALITY.ranges(daily.columns), ["dt"])


@query
def q_unique(spark, sf_dir):
    """Top 5 duplicated (location_id, date) groups among re-delivered records."""
    daily = FL.silver_daily(_order_envelopes(_tables(spark, sf_dir)))
    return duplicate_groups(daily, ["location_id", "date"], 5)


@query
def q_duplicate_rows(spark, sf_dir):
    daily = FL.silver_daily(_order_envelopes(_tables(spark, sf_dir)))
    rows = duplicate_members(daily, ["location_id", "date"])
    return _ntz(rows.select("location_id", "date", "ingested_at", "temp_avg_c"), "ingested_at")


@query
def q_fresh_dt(spark, sf_dir):
    """Per ingestion day: records whose observation day differs from it."""
    daily = FL.silver_daily(_order_envelopes(_tables(spark, sf_dir)))
    return Q.freshness_counts(daily)


@query
def q_completeness(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return Q.completeness(_day_silver(t)[0], t.registry())


@query
def q_missing_locations(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return Q.missing_locations(_day_silver(t)[0], t.registry(), 10)


@query
def q_missing_day_locations(spark, sf_dir):
    """Per day: locations of that day without an observation of a finished order."""
    t = _tables(spark, sf_dir)
    daily = FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry()))
    return Q.missing_locations(daily, _day_silver(t)[1], 10)


@query
def q_completeness_day(spark, sf_dir):
    """Finished orders' observations against the day's own locations (the default rule)."""
    t = _tables(spark, sf_dir)
    daily = FL.silver_daily(B.build_envelopes(_finished_only(t), t.registry()))
    return Q.completeness(daily, _day_silver(t)[1])


@query
def q_report(spark, sf_dir):
    t = _tables(spark, sf_dir)
    daily, locs = _day_silver(t)
    rep = Q.gate_report(daily, locs, PRICE_QUALITY, expected_dts=_calendar(t.obs()),
                        expected_locations=t.registry())
    return rep.select("dt", "daily_rows", "location_rows", "dup_groups", "present", "expected",
                      "ratio", "failed_rule", "passed")


def _faulty(t: Tables) -> DataFrame:
    """Silver daily rows, one an order, with the faults that the order's key says.

    Of a location's orders of a day the first one counts, and any whose key 7 divides (a
    second delivery). Keys with certain remainders lack a value, have a day or a
    humidity that can't be, or are lost.
    """
    key = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"), F.col("o_totalprice").cast("double").alias("price"))
    own = key.join(t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("location_id")), F.col("o_custkey") == F.col("c_custkey"))
    first = own.groupBy("location_id", "dt").agg(F.min("o_orderkey").alias("first"))
    own = own.join(first, ["location_id", "dt"]).where("o_orderkey = first or o_orderkey % 7 = 0")
    k = F.col("o_orderkey")
    return own.where(k % 61 != 5).select(
        "dt", F.when(k % 397 != 1, F.col("location_id")).alias("location_id"),
        F.when(k % 389 != 2, F.date_add("dt", 1).cast("timestamp")).alias("ingested_at"),
        F.when(k % 383 == 3, F.date_add("dt", 1)).when(k % 379 != 4, F.col("dt")).alias("date"),
        F.col("price").alias("temp_min_c"), F.col("price").alias("temp_max_c"), F.when(k % 5 != 0, F.col("price")).alias("temp_avg_c"),
        F.when(k % 373 == 6, 140.0).when(k % 367 == 7, -1.0).otherwise(50.0).alias("humidity_avg"))


@query
def q_report_faults(spark, sf_dir):
    """The gate over rows with every kind of fault, against the day's own locations: days pass and fail."""
    t = _tables(spark, sf_dir)
    rep = Q.gate_report(_faulty(t), _day_silver(t)[1], PRICE_FAULTS, expected_dts=_calendar(t.obs()))
    return rep.select("dt", "daily_rows", "location_rows", "dup_groups", "dup_rows", "present", "expected", "ratio", "failed_rule", "passed")


@query
def q_range_faults(spark, sf_dir):
    rows = _faulty(_tables(spark, sf_dir))
    return Q.range_counts(rows, PRICE_FAULTS.ranges(rows.columns), ["dt"])


# ---- model tests -----------------------------------------------------------------------------

@query
def t_not_null(spark, sf_dir):
    g = _gold(spark, sf_dir)
    models = {"stg_weather_daily": g.stg_daily, "fact_weather_daily": g.fact(),
              "dim_location": g.dim_location(), "dim_date": g.dim_date()}
    return Q.test_not_null(models, [("stg_weather_daily", "location_id"),
                                    ("stg_weather_daily", "date"), ("stg_weather_daily", "dt"),
                                    ("fact_weather_daily", "location_id"),
                                    ("fact_weather_daily", "date"),
                                    ("dim_location", "location_id"), ("dim_date", "date")])


@query
def t_unique(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return Q.test_unique({"dim_location": g.dim_location(), "dim_date": g.dim_date()},
                         [("dim_location", ["location_id"]), ("dim_date", ["date"])])


@query
def t_unique_combo(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return Q.test_unique({"stg_weather_daily": g.stg_daily},
                         [("stg_weather_daily", ["location_id", "date"])])


@query
def t_source_freshness(spark, sf_dir):
    t = _tables(spark, sf_dir)
    out = Q.source_freshness({"stg_weather_daily": t.staging_daily(),
                              "stg_locations": t.staging_locations()}, FRESHNESS_NOW)
    return _ntz(out, "max_loaded_at")


@query
def t_faults(spark, sf_dir):
    """Model tests that find something: nulls, repeated locations and repeated keys among faulty rows."""
    rows = {"faulty": _faulty(_tables(spark, sf_dir))}
    nulls = Q.test_not_null(rows, [("faulty", c) for c in ("location_id", "date", "ingested_at", "temp_avg_c")])
    return nulls.unionByName(Q.test_unique(rows, [("faulty", ["location_id"]), ("faulty", ["location_id", "date"])]))


@query
def mart_anomalies_flat(spark, sf_dir):
    """z-scores where every fifth location reads the same value each day: no spread, no score."""
    fact = _gold(spark, sf_dir).fact()
    flat = F.when(F.col("location_id").cast("int") % 5 == 0, F.lit(1000)).otherwise(F.col("temp_avg_c"))
    m = G.mart_anomalies(fact.withColumn("temp_avg_c", flat.cast(fact.schema["temp_avg_c"].dataType)))
    return m.withColumn("z_score", F.round("z_score", 6))
