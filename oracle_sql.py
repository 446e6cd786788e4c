"""DuckDB oracle SQL for each registered query (the driver's correctness gate).

The SQL re-derives everything from the raw driver tables with plain SQL, so it
is independent from the Spark code. Exact decimal averages (Spark:
``avg(decimal)`` then a cast, rounding half away from zero) are written with
integer cents, because DuckDB's decimal average is a double:

    avg at scale s = (2 * sum(cents) * 10^(s-2) + n) // (2 * n)   (values >= 0)
"""

from __future__ import annotations


def avg_exact(x: str, scale: int, precision: int, w: str = "") -> str:
    """Exact half-up ``avg(x)`` of a non-negative 2-dp decimal, as decimal(precision, scale)."""
    cents = f"cast({x} * 100 as bigint)"
    mul = 10 ** (scale - 2)
    num = f"(2 * cast(sum({cents}) {w} as hugeint) * {mul} + count({x}) {w})"
    den = f"nullif(2 * count({x}) {w}, 0)"
    unit = "0." + "0" * (scale - 1) + "1"
    return (f"cast(cast({num} // {den} as decimal(38,0)) * cast({unit} as decimal({scale + 1},{scale}))"
            f" as decimal({precision},{scale}))")


# ---- shared CTEs ---------------------------------------------------------------
OBS = """
oc AS (
  SELECT o.o_orderkey, cast(c.c_nationkey AS varchar) AS location_id,
         cast(o.o_orderdate AS date) AS date, cast(o.o_totalprice AS decimal(18,2)) AS price,
         o.o_orderpriority, o.o_orderstatus
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
obs AS (
  SELECT location_id, date,
         min(price) AS temp_min_c, max(price) AS temp_max_c,
         arg_min(price, o_orderkey) AS temp_avg_c,
         CASE WHEN count(*) > 1 THEN cast(max(price) - min(price) AS decimal(18,2)) END AS precip_mm,
         cast(count_if(o_orderpriority = '5-LOW') AS decimal(18,2)) AS snow_cm,
         cast(count_if(o_orderpriority = '1-URGENT') * 100 // count(*) AS decimal(18,2)) AS humidity_avg,
         max(CASE WHEN o_orderstatus = 'F' THEN price END) AS wind_max_kph,
         cast(substr(min(o_orderpriority), 1, 1) AS int) AS condition_code,
         max(o_orderpriority) AS condition_text,
         cast(date + INTERVAL 1 DAY AS timestamp) AS ingested_at
  FROM oc GROUP BY location_id, date
)"""

NUM = "decimal(18,6)"

STG = f"""
stg AS (
  SELECT date AS dt, location_id, date,
         cast(temp_min_c AS {NUM}) AS temp_min_c, cast(temp_max_c AS {NUM}) AS temp_max_c,
         cast(temp_avg_c AS {NUM}) AS temp_avg_c, cast(precip_mm AS {NUM}) AS precip_mm,
         cast(humidity_avg AS {NUM}) AS humidity_avg, cast(wind_max_kph AS {NUM}) AS wind_max_kph,
         condition_code, condition_text, ingested_at,
         ingested_at + INTERVAL 1 HOUR AS loaded_at
  FROM obs
),
fact AS (
  SELECT location_id, date, dt, temp_min_c, temp_max_c, temp_avg_c, precip_mm, humidity_avg,
         wind_max_kph, condition_code, condition_text, ingested_at
  FROM stg
)"""

REG = """
reg AS (
  SELECT cast(n_nationkey AS varchar) AS location_id, n_name AS name, r_name AS country,
         lower(r_name) AS region, cast(n_nationkey * 3 - 36 AS double) AS lat,
         cast(n_regionkey * 45 - 90 AS double) AS lon, 'UTC' AS tz
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

LOCS = f"""
yearly AS (SELECT location_id, max(date) AS dt FROM obs GROUP BY location_id, year(date)),
snapshots AS (
  SELECT r.location_id, r.name, y.dt FROM reg r LEFT JOIN yearly y ON r.location_id = y.location_id
  UNION ALL
  SELECT location_id, name || ' (renamed)', NULL FROM reg
  WHERE cast(location_id AS int) % 5 = 0 AND location_id IN (SELECT location_id FROM obs)
),
stg_loc AS (
  SELECT l.dt, r.location_id, l.name, r.region, r.country,
         cast(r.lat AS {NUM}) AS lat, cast(r.lon AS {NUM}) AS lon, r.tz AS tz_id,
         cast(l.dt AS timestamp) AS local_time,
         cast(l.dt + INTERVAL 1 DAY AS timestamp) AS ingested_at,
         cast(l.dt + INTERVAL 1 DAY AS timestamp) + INTERVAL 1 HOUR AS loaded_at
  FROM snapshots l JOIN reg r ON r.location_id = l.location_id
),
dim_location AS (
  SELECT location_id, name, region, country, lat, lon, tz_id, local_time
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id
                                     ORDER BY ingested_at DESC NULLS FIRST) AS rn FROM stg_loc)
  WHERE rn = 1
)"""

DIM_DATE = """
bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM stg),
days AS (
  SELECT cast(unnest(generate_series(cast(lo AS timestamp), cast(hi AS timestamp), INTERVAL 1 DAY)) AS date) AS date
  FROM bounds
),
dim_date AS (
  SELECT date, cast(year(date) AS int) AS year, cast(month(date) AS int) AS month,
         cast(day(date) AS int) AS day, cast(isodow(date) AS int) AS iso_dow,
         strftime(date, '%Y-%m') AS year_month
  FROM days
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


GOLD = with_(OBS, STG, REG, LOCS, DIM_DATE)

W_LOC = "(PARTITION BY location_id ORDER BY date ROWS BETWEEN {} PRECEDING AND {})"


def _w(lo: int, hi: str) -> str:
    return W_LOC.format(lo, hi)


def _ntz(c: str) -> str:
    return f"cast({c} AS timestamp) AS {c}"


ORACLE: dict[str, str] = {}

# ---- staging / gold ----------------------------------------------------------------
ORACLE["stg_daily"] = GOLD + """
SELECT dt, location_id, date, temp_min_c, temp_max_c, temp_avg_c, precip_mm, humidity_avg,
       wind_max_kph, condition_code, condition_text, """ + _ntz("ingested_at") + " FROM stg"

ORACLE["stg_locations"] = GOLD + """
SELECT location_id, name, region, country, lat, lon, tz_id, local_time, """ + _ntz("ingested_at") + """
FROM stg_loc"""

ORACLE["dim_location"] = GOLD + " SELECT * FROM dim_location"

ORACLE["dim_date"] = GOLD + " SELECT * FROM dim_date"

ORACLE["fact_daily"] = GOLD + """
SELECT location_id, date, dt, temp_min_c, temp_max_c, temp_avg_c, precip_mm, humidity_avg,
       wind_max_kph, condition_code, condition_text, """ + _ntz("ingested_at") + " FROM fact"

ORACLE["mart_rolling"] = GOLD + f"""
SELECT location_id, date, temp_avg_c,
       {avg_exact('temp_avg_c', 10, 22, 'OVER ' + _w(6, 'CURRENT ROW'))} AS temp_avg_7d,
       {avg_exact('temp_avg_c', 10, 22, 'OVER ' + _w(29, 'CURRENT ROW'))} AS temp_avg_30d
FROM fact"""

ORACLE["mart_weekly_change"] = GOLD + """
SELECT location_id, date, temp_avg_c,
       cast(temp_avg_c - lag(temp_avg_c, 7) OVER (PARTITION BY location_id ORDER BY date)
            AS decimal(19,6)) AS temp_wow_change
FROM fact"""

ORACLE["mart_anomalies"] = GOLD + """,
cents AS (SELECT location_id, date, temp_avg_c, cast(temp_avg_c * 100 AS bigint) AS x FROM fact),
st AS (SELECT location_id, avg(x) AS m, stddev_samp(x) AS sd FROM cents GROUP BY location_id)
SELECT c.location_id, c.date, c.temp_avg_c,
       round(CASE WHEN st.sd IS NULL OR st.sd = 0 THEN NULL ELSE (c.x - st.m) / st.sd END, 6) AS z_score
FROM cents c JOIN st USING (location_id)"""

ORACLE["bi_daily"] = GOLD + """
SELECT d.date, d.year, d.month, l.location_id, l.name AS city, l.country,
       f.temp_avg_c, f.temp_min_c, f.temp_max_c, f.precip_mm
FROM fact f JOIN dim_date d USING (date) JOIN dim_location l USING (location_id)"""

# a week starts on its Monday; its ISO year and number are those of its Thursday
ORACLE["bi_weekly"] = GOLD + f""",
dated AS (
  SELECT f.*, date - cast(isodow(date) - 1 AS int) AS monday FROM fact f
)
SELECT cast(monday AS date) AS week_start, cast(monday + 6 AS date) AS week_end,
       cast(year(monday + 3) AS int) AS iso_year,
       cast((dayofyear(monday + 3) + 6) // 7 AS int) AS iso_week,
       l.location_id, l.name AS city, l.country, l.region, l.tz_id, count(*) AS days_in_week,
       {avg_exact('temp_avg_c', 2, 10)} AS temp_avg_c_wk,
       cast(min(temp_min_c) AS decimal(10,2)) AS temp_min_c_wk,
       cast(max(temp_max_c) AS decimal(10,2)) AS temp_max_c_wk,
       cast(coalesce(sum(precip_mm), 0) AS decimal(10,2)) AS precip_mm_wk,
       {avg_exact('humidity_avg', 2, 10)} AS humidity_avg_wk,
       cast(max(wind_max_kph) AS decimal(10,2)) AS wind_max_kph_wk
FROM dated JOIN dim_location l USING (location_id)
GROUP BY monday, l.location_id, l.name, l.country, l.region, l.tz_id"""

ANOMALY_THRESHOLD_PRICE = 100000

# baseline: the seven rows before a row, by number; rows without any drop out of the join
ORACLE["bi_anomalies"] = GOLD + f""",
numbered AS (
  SELECT *, coalesce(precip_mm, 0) AS wet,
         (SELECT count(*) FROM fact e WHERE e.location_id = f.location_id AND e.date < f.date) AS place
  FROM fact f
),
before AS (
  SELECT n.location_id, n.date, {avg_exact('p.temp_avg_c', 2, 10)} AS t7, {avg_exact('p.wet', 2, 10)} AS w7
  FROM numbered n JOIN numbered p ON p.location_id = n.location_id AND n.place - p.place BETWEEN 1 AND 7
  GROUP BY n.location_id, n.date
)
SELECT n.date, cast(year(n.date) AS int) AS year, cast(month(n.date) AS int) AS month,
       cast(day(n.date) AS int) AS day, cast(isodow(n.date) AS int) AS iso_dow,
       strftime(n.date, '%Y-%m') AS year_month, n.location_id, l.name AS city, l.country, l.region, l.tz_id,
       n.temp_avg_c, t7 AS temp_baseline_7d, cast(n.temp_avg_c - t7 AS decimal(10,2)) AS temp_anomaly_vs_7d,
       n.precip_mm, w7 AS precip_baseline_7d, cast(wet - w7 AS decimal(10,2)) AS precip_anomaly_vs_7d,
       n.wind_max_kph, abs(cast(n.temp_avg_c - t7 AS decimal(10,2))) >= {ANOMALY_THRESHOLD_PRICE} AS is_temp_anomaly_5c
FROM numbered n JOIN before USING (location_id, date) JOIN dim_location l USING (location_id)"""

# ---- analyst queries -------------------------------------------------------------


def _since(days: int, date: str = "date") -> str:
    """The last ``days`` days before the latest fact, that day included."""
    return f"{date} >= (SELECT max(date) FROM fact) - {days}"


FIRST = "(SELECT min({0}) FROM dim_location)"


ORACLE["perf_sanity"] = GOLD + """
SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS rows_total FROM fact"""

ORACLE["perf_top_locations"] = GOLD + """
SELECT location_id, country, region, name FROM dim_location ORDER BY location_id LIMIT 10"""

ORACLE["perf_location_range"] = GOLD + f"""
SELECT location_id, date, temp_avg_c, precip_mm, wind_max_kph FROM fact
WHERE location_id = {FIRST.format('location_id')} AND {_since(30)}"""

# the average is taken over the rows that the filter leaves
ORACLE["perf_rolling_range"] = GOLD + f""",
own AS (
  SELECT location_id, date, temp_avg_c, row_number() OVER (ORDER BY date) AS place FROM fact
  WHERE location_id = {FIRST.format('location_id')} AND {_since(60)}
)
SELECT a.location_id, a.date, a.temp_avg_c, {avg_exact('b.temp_avg_c', 10, 22)} AS temp_avg_7d
FROM own a JOIN own b ON a.place - b.place BETWEEN 0 AND 6 GROUP BY a.location_id, a.date, a.temp_avg_c"""

ORACLE["perf_country_daily"] = GOLD + f"""
SELECT country, date, {avg_exact('temp_avg_c', 2, 10)} AS avg_temp_avg_c
FROM fact JOIN dim_location USING (location_id)
WHERE country = {FIRST.format('country')} AND {_since(30)} GROUP BY country, date"""

# ---- sources and silver -----------------------------------------------------------------

SILVER_D = """
silver_d AS (
  SELECT date AS dt, location_id, ingested_at, date,
         cast(temp_min_c AS double) AS temp_min_c, cast(temp_max_c AS double) AS temp_max_c,
         cast(temp_avg_c AS double) AS temp_avg_c, cast(precip_mm AS double) AS precip_mm,
         cast(snow_cm AS double) AS snow_cm, cast(humidity_avg AS double) AS humidity_avg,
         cast(wind_max_kph AS double) AS wind_max_kph, condition_code, condition_text
  FROM obs
),
silver_l AS (
  SELECT o.date AS dt, o.location_id, r.name, r.region, r.country, r.lat, r.lon, r.tz AS tz_id,
         cast(o.date AS timestamp) AS local_time, o.ingested_at
  FROM obs o LEFT JOIN reg r USING (location_id)
)"""

# one record per order, ingested at next midnight + o_orderkey seconds, filed under that day
ORDER_GRAIN = """
og AS (
  SELECT location_id, date, o_orderkey,
         cast(date + INTERVAL 1 DAY AS timestamp) + to_seconds(o_orderkey) AS ingested_at,
         price, o_orderpriority, o_orderstatus
  FROM oc
),
og_silver AS (
  SELECT cast(ingested_at AS date) AS dt, location_id, ingested_at, date, o_orderkey,
         cast(price AS double) AS temp_min_c, cast(price AS double) AS temp_max_c,
         cast(price AS double) AS temp_avg_c, cast(price AS double) AS precip_mm,
         cast(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS double) AS snow_cm,
         cast(CASE WHEN o_orderpriority = '1-URGENT' THEN 100 ELSE 0 END AS double) AS humidity_avg,
         CASE WHEN o_orderstatus = 'F' THEN cast(price AS double) END AS wind_max_kph,
         cast(substr(o_orderpriority, 1, 1) AS int) AS condition_code,
         o_orderpriority AS condition_text
  FROM og
)"""

SILVER = with_(OBS, STG, REG, LOCS, DIM_DATE, SILVER_D, ORDER_GRAIN)

SILVER_DAILY_SELECT = """
SELECT dt, location_id, cast(ingested_at AS timestamp) AS ingested_at, date, temp_min_c,
       temp_max_c, temp_avg_c, precip_mm, snow_cm, humidity_avg, wind_max_kph, condition_code,
       condition_text"""

ORACLE["src_registry"] = SILVER + " SELECT * FROM reg"

ORACLE["silver_daily"] = SILVER + SILVER_DAILY_SELECT + " FROM silver_d"
ORACLE["src_bronze_json"] = ORACLE["silver_daily"]
ORACLE["src_silver_parquet"] = ORACLE["silver_daily"]
ORACLE["sink_silver_overwrite"] = ORACLE["silver_daily"]

ORACLE["silver_locations"] = SILVER + " SELECT * FROM silver_l"

ORACLE["silver_dedup"] = SILVER + SILVER_DAILY_SELECT + """
FROM (SELECT *, row_number() OVER (PARTITION BY location_id, date ORDER BY ingested_at DESC) AS rn
      FROM og_silver) WHERE rn = 1"""

ORACLE["scalar_nan_to_null"] = """
SELECT event_id, CASE WHEN event_id % 10 = 0 OR isnan(value) THEN NULL ELSE value END AS value,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events"""

ORACLE["sink_bronze_roundtrip"] = SILVER + """
SELECT o.date AS dt, o.location_id, coalesce(r.name, o.location_id) AS location_name,
       strftime(o.ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at,
       'api' AS source, 'v1' AS api_version,
       cast(r.lat AS varchar) || ',' || cast(r.lon AS varchar) AS request_q,
       'history.json' AS request_endpoint, cast(1 AS int) AS n_days
FROM obs o LEFT JOIN reg r USING (location_id)"""

# the last price of each location and month, delivered in two parts
ORACLE["sink_bronze_rerun"] = SILVER + """
SELECT cast(date_trunc('month', date) AS date) AS dt, location_id,
       cast(arg_max(price, o_orderkey) AS double) AS temp_avg_c,
       strftime(cast('2000-01-01' AS timestamp) + to_seconds(max(o_orderkey)), '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at
FROM oc GROUP BY 1, 2"""

# ---- loads -------------------------------------------------------------------------------------

ORACLE["load_daily_replace_dt"] = ORACLE["stg_daily"]
ORACLE["load_upsert_by_key"] = ORACLE["stg_daily"]
ORACLE["backfill_range"] = ORACLE["stg_daily"]
ORACLE["load_upsert_partitioned"] = ORACLE["stg_daily"]
ORACLE["mart_incremental"] = ORACLE["mart_rolling"]

ORACLE["load_locations_full"] = GOLD + """
SELECT dt, location_id, name, region, country, lat, lon, tz_id, local_time,
       cast(ingested_at AS timestamp) AS ingested_at
FROM stg_loc WHERE dt IS NOT NULL AND (location_id, dt) IN (SELECT (location_id, max(date)) FROM obs GROUP BY location_id)"""
ORACLE["backfill_locations"] = GOLD + """
SELECT date AS dt, location_id, name, region, country, cast(lat AS decimal(18,6)) AS lat,
       cast(lon AS decimal(18,6)) AS lon, tz AS tz_id, cast(date AS timestamp) AS local_time,
       cast(ingested_at AS timestamp) AS ingested_at
FROM obs JOIN reg USING (location_id) WHERE date = (SELECT max(date) FROM obs)"""

# ---- quality ------------------------------------------------------------------------------------

CAL = """,
cal AS (
  SELECT cast(unnest(generate_series(cast(min(date) AS timestamp), cast(max(date) AS timestamp),
                                     INTERVAL 1 DAY)) AS date) AS dt
  FROM obs
)"""

ORACLE["q_missing_partitions"] = SILVER + CAL + """
SELECT dt, (SELECT max(date) FROM obs WHERE date < dt) AS before, (SELECT min(date) FROM obs WHERE date > dt) AS after
FROM cal WHERE dt NOT IN (SELECT DISTINCT date FROM obs)"""


def _null_counts(src: str, cols: list[str], dataset: str) -> list[str]:
    return [f"""SELECT dt, '{c}' AS "column", cast(count_if({c} IS NULL) AS bigint) AS n_null,
       '{dataset}' AS dataset FROM {src} GROUP BY dt""" for c in cols]


_DAILY_NN = ["location_id", "date", "ingested_at", "temp_min_c", "temp_max_c", "temp_avg_c",
             "precip_mm", "humidity_avg", "wind_max_kph"]
_LOC_NN = ["location_id", "name", "country", "lat", "lon", "tz_id", "ingested_at"]

ORACLE["q_not_null"] = SILVER + "\n" + "\nUNION ALL\n".join(
    _null_counts("silver_d", _DAILY_NN, "daily") + _null_counts("silver_l", _LOC_NN, "locations"))

_RANGES = [("temp_min_c", 5000.0, 495000.0), ("temp_max_c", 5000.0, 495000.0),
           ("temp_avg_c", 5000.0, 495000.0), ("humidity_avg", 0.0, 100.0)]

ORACLE["q_range"] = SILVER + "\n" + "\nUNION ALL\n".join(
    f"""SELECT dt, '{c}' AS "column", cast({lo} AS double) AS min_v, cast({hi} AS double) AS max_v,
       count({c}) AS n_valid, cast(count_if({c} < {lo}) AS bigint) AS n_low,
       cast(count_if({c} > {hi}) AS bigint) AS n_high FROM silver_d GROUP BY dt"""
    for c, lo, hi in _RANGES)

ORACLE["q_unique"] = SILVER + """
SELECT location_id, date, count(*) AS count FROM og_silver GROUP BY location_id, date
HAVING count(*) > 1 ORDER BY count DESC, location_id, date LIMIT 5"""

ORACLE["q_duplicate_rows"] = SILVER + """
SELECT location_id, date, cast(ingested_at AS timestamp) AS ingested_at, temp_avg_c
FROM (SELECT *, count(*) OVER (PARTITION BY location_id, date) AS n FROM og_silver) WHERE n > 1"""

ORACLE["q_fresh_dt"] = SILVER + """
SELECT dt, count(*) AS n_rows, cast(count_if(date IS NULL) AS bigint) AS n_bad_date,
       cast(count_if(date IS NULL OR date <> dt) AS bigint) AS n_date_ne_dt
FROM og_silver GROUP BY dt"""

ORACLE["q_completeness"] = SILVER + """
SELECT d.dt, count(DISTINCT d.location_id) AS present, (SELECT count(*) FROM reg) AS expected,
       count(DISTINCT d.location_id) / (SELECT count(*) FROM reg) AS ratio
FROM silver_d d WHERE d.location_id IN (SELECT location_id FROM reg) GROUP BY d.dt"""

ORACLE["q_missing_locations"] = SILVER + """,
obs_days AS (SELECT DISTINCT dt FROM silver_d),
missing AS (
  SELECT obs_days.dt, reg.location_id FROM obs_days, reg
  WHERE NOT EXISTS (SELECT 1 FROM silver_d s WHERE s.dt = obs_days.dt AND s.location_id = reg.location_id)
)
SELECT dt, cast(rank AS int) AS rank, location_id
FROM (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY location_id) AS rank FROM missing)
WHERE rank <= 10"""

# daily rows of finished orders only, against the locations that the day has
ORACLE["q_missing_day_locations"] = SILVER + """
SELECT dt, cast(rank AS int) AS rank, location_id FROM (
  SELECT date AS dt, location_id, row_number() OVER (PARTITION BY date ORDER BY location_id) AS rank
  FROM (SELECT DISTINCT date, location_id FROM oc
        EXCEPT SELECT date, location_id FROM oc WHERE o_orderstatus = 'F'))
WHERE rank <= 10"""

ORACLE["q_completeness_day"] = SILVER + """
SELECT date AS dt, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN location_id END) AS present,
       count(DISTINCT location_id) AS expected,
       count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN location_id END) / count(DISTINCT location_id) AS ratio
FROM oc GROUP BY date"""

_RULES = []
for _c in ["location_id", "date", "ingested_at"]:
    _RULES.append((f"d_null_{_c} > 0", f"daily_not_null:{_c}"))
for _c in _LOC_NN:
    _RULES.append((f"l_null_{_c} > 0", f"locations_not_null:{_c}"))
_RULES += [("bad_date > 0", "date_unparseable"), ("date_ne_dt > 0", "date_ne_dt"),
           ("dup_groups > 0", "duplicate_location_date")]
for _c, _lo, _hi in _RANGES:
    _RULES += [(f"valid_{_c} = 0", f"range_all_null:{_c}"), (f"out_{_c} > 0", f"range:{_c}")]
_RULES += [("ratio < 0.95", "completeness")]

_CASE = ("CASE WHEN daily_rows = 0 THEN 'missing_daily_partition' "
         "WHEN location_rows = 0 THEN 'missing_locations_partition' "
         + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in _RULES) + " END")

ORACLE["q_report"] = SILVER + CAL + """,
dstat AS (
  SELECT dt, count(*) AS n_d,
         count_if(location_id IS NULL) AS d_null_location_id, count_if(date IS NULL) AS d_null_date,
         count_if(ingested_at IS NULL) AS d_null_ingested_at,
         count_if(date IS NULL) AS bad_date, count_if(date IS NULL OR date <> dt) AS date_ne_dt,
""" + ",\n".join(f"         count({c}) AS valid_{c}, count_if({c} < {lo} OR {c} > {hi}) AS out_{c}"
                 for c, lo, hi in _RANGES) + """
  FROM silver_d GROUP BY dt
),
lstat AS (
  SELECT dt, count(*) AS n_l, """ + ", ".join(f"count_if({c} IS NULL) AS l_null_{c}" for c in _LOC_NN) + """
  FROM silver_l GROUP BY dt
),
dup AS (
  SELECT dt, count(*) AS dup_groups FROM
    (SELECT dt, location_id, date FROM silver_d GROUP BY 1, 2, 3 HAVING count(*) > 1) GROUP BY dt
),
comp AS (
  SELECT dt, count(DISTINCT location_id) AS present, (SELECT count(*) FROM reg) AS expected
  FROM silver_d WHERE location_id IN (SELECT location_id FROM reg) GROUP BY dt
),
rep AS (
  SELECT cal.dt, coalesce(dstat.n_d, 0) AS daily_rows, coalesce(lstat.n_l, 0) AS location_rows,
         coalesce(dup.dup_groups, 0) AS dup_groups, coalesce(comp.present, 0) AS present,
         coalesce(comp.expected, 0) AS expected,
         CASE WHEN comp.expected > 0 THEN comp.present / comp.expected
              WHEN comp.expected = 0 THEN 0.0 END AS ratio,
         dstat.* EXCLUDE (dt), lstat.* EXCLUDE (dt)
  FROM cal LEFT JOIN dstat USING (dt) LEFT JOIN lstat USING (dt) LEFT JOIN dup USING (dt)
       LEFT JOIN comp USING (dt)
)
SELECT dt, daily_rows, location_rows, dup_groups, present, expected, ratio,
       """ + _CASE + """ AS failed_rule, (""" + _CASE + """) IS NULL AS passed
FROM rep"""

# one row an order, with faults by its key, in place of the day's aggregates
FAULTY = """,
firsts AS (SELECT location_id, date, min(o_orderkey) AS k0 FROM oc GROUP BY 1, 2),
faulty AS (
  SELECT date AS dt, CASE WHEN o_orderkey % 397 <> 1 THEN location_id END AS location_id,
         CASE WHEN o_orderkey % 389 <> 2 THEN date + INTERVAL 1 DAY END AS ingested_at,
         CASE WHEN o_orderkey % 383 = 3 THEN cast(date + INTERVAL 1 DAY AS date) WHEN o_orderkey % 379 <> 4 THEN date END AS date,
         cast(price AS double) AS temp_min_c, cast(price AS double) AS temp_max_c,
         CASE WHEN o_orderkey % 5 <> 0 THEN cast(price AS double) END AS temp_avg_c,
         CASE WHEN o_orderkey % 373 = 6 THEN 140.0 WHEN o_orderkey % 367 = 7 THEN -1.0 ELSE 50.0 END AS humidity_avg
  FROM oc JOIN firsts USING (location_id, date)
  WHERE (o_orderkey = k0 OR o_orderkey % 7 = 0) AND o_orderkey % 61 <> 5
)"""

_swaps = [
    (CAL, CAL + FAULTY),
    ("  FROM silver_d GROUP BY dt\n),\nlstat", "  FROM faulty GROUP BY dt\n),\nlstat"),
    ("SELECT dt, count(*) AS dup_groups FROM\n    (SELECT dt, location_id, date FROM silver_d GROUP BY",
     "SELECT dt, count(*) AS dup_groups, cast(sum(n) AS bigint) AS dup_rows FROM\n    (SELECT dt, location_id, date, count(*) AS n FROM faulty GROUP BY"),
    ("""  SELECT dt, count(DISTINCT location_id) AS present, (SELECT count(*) FROM reg) AS expected
  FROM silver_d WHERE location_id IN (SELECT location_id FROM reg) GROUP BY dt""",
     """  SELECT l.dt, count(DISTINCT f.location_id) AS present, count(DISTINCT l.location_id) AS expected
  FROM silver_l l LEFT JOIN faulty f ON f.dt = l.dt AND f.location_id = l.location_id GROUP BY l.dt"""),
    ("< 5000.0 OR", "< 0.0 OR"), ("> 495000.0", "> 520000.0"), ("ratio < 0.95", "ratio < 0.9"),
    ("coalesce(dup.dup_groups, 0) AS dup_groups,", "coalesce(dup.dup_groups, 0) AS dup_groups, coalesce(dup.dup_rows, 0) AS dup_rows,"),
    ("location_rows, dup_groups, present", "location_rows, dup_groups, dup_rows, present"),
]
_sql = ORACLE["q_report"]
for _old, _new in _swaps:
    assert _old in _sql, _old
    _sql = _sql.replace(_old, _new)
ORACLE["q_report_faults"] = _sql

ORACLE["q_range_faults"] = SILVER + FAULTY + "\n" + "\nUNION ALL\n".join(
    f"""SELECT dt, '{c}' AS "column", cast({lo} AS double) AS min_v, cast({hi} AS double) AS max_v,
       count({c}) AS n_valid, cast(coalesce(count_if({c} < {lo}), 0) AS bigint) AS n_low,
       cast(coalesce(count_if({c} > {hi}), 0) AS bigint) AS n_high FROM faulty GROUP BY dt"""
    for c, lo, hi in [("temp_min_c", 0.0, 520000.0), ("temp_max_c", 0.0, 520000.0), ("temp_avg_c", 0.0, 520000.0), ("humidity_avg", 0.0, 100.0)])

ORACLE["t_faults"] = SILVER + FAULTY + "\n" + "\nUNION ALL ".join(
    [f"""SELECT 'faulty' AS model, '{c}' AS "column", cast(count_if({c} IS NULL) AS bigint) AS failures FROM faulty"""
     for c in ("location_id", "date", "ingested_at", "temp_avg_c")]
    + [f"""SELECT 'faulty', '{keys}', (SELECT count(*) FROM (SELECT {keys} FROM faulty GROUP BY {keys} HAVING count(*) > 1))"""
       for keys in ("location_id", "location_id,date")])

ORACLE["mart_anomalies_flat"] = GOLD + """,
cents AS (
  SELECT location_id, date, CASE WHEN cast(location_id AS int) % 5 = 0 THEN cast(1000 AS decimal(18,6)) ELSE temp_avg_c END AS temp_avg_c,
         CASE WHEN cast(location_id AS int) % 5 = 0 THEN 100000 ELSE cast(temp_avg_c * 100 AS bigint) END AS x FROM fact),
st AS (SELECT location_id, avg(x) AS m, stddev_samp(x) AS sd FROM cents GROUP BY location_id)
SELECT c.location_id, c.date, c.temp_avg_c,
       round(CASE WHEN st.sd IS NULL OR st.sd = 0 THEN NULL ELSE (c.x - st.m) / st.sd END, 6) AS z_score
FROM cents c JOIN st USING (location_id)"""

ORACLE["run_log"] = SILVER + CAL + """
SELECT cal.dt, CASE WHEN count(o.date) > 0 THEN 'success' ELSE 'failed' END AS status,
       cast(nullif(count(o.date), 0) AS int) AS records_loaded,
       CASE WHEN count(o.date) = 0 THEN 'missing_daily_partition' END AS error_summary
FROM cal LEFT JOIN obs o ON o.date = cal.dt GROUP BY cal.dt"""

# every location as the registry names it: the loads know no other snapshot
ORACLE["bi_weekly_by_name"] = ORACLE["bi_weekly"].replace(
    "dim_location l USING (location_id)", "(SELECT *, tz AS tz_id FROM reg) l USING (location_id)")

# ---- model tests -----------------------------------------------------------------------------------

_NN_TESTS = [("stg_weather_daily", "stg", "location_id"), ("stg_weather_daily", "stg", "date"),
             ("stg_weather_daily", "stg", "dt"), ("fact_weather_daily", "fact", "location_id"),
             ("fact_weather_daily", "fact", "date"), ("dim_location", "dim_location", "location_id"),
             ("dim_date", "dim_date", "date")]

ORACLE["t_not_null"] = GOLD + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{m}' AS model, '{c}' AS "column", cast(count_if({c} IS NULL) AS bigint) AS failures FROM {t}"""
    for m, t, c in _NN_TESTS)

ORACLE["t_unique"] = GOLD + """
SELECT 'dim_location' AS model, 'location_id' AS "column",
       (SELECT count(*) FROM (SELECT location_id FROM dim_location GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'dim_date', 'date', (SELECT count(*) FROM (SELECT date FROM dim_date GROUP BY 1 HAVING count(*) > 1))"""

ORACLE["t_unique_combo"] = GOLD + """
SELECT 'stg_weather_daily' AS model, 'location_id,date' AS "column",
       (SELECT count(*) FROM (SELECT location_id, date FROM stg GROUP BY 1, 2 HAVING count(*) > 1)) AS failures"""

FRESHNESS_NOW = "2001-08-04 00:00:00"

ORACLE["t_source_freshness"] = GOLD + f""",
mx AS (
  SELECT 'stg_weather_daily' AS source, max(loaded_at) AS max_loaded_at FROM stg
  UNION ALL SELECT 'stg_locations', max(loaded_at) FROM stg_loc
)
SELECT source, cast(max_loaded_at AS timestamp) AS max_loaded_at,
       date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 AS age_hours,
       CASE WHEN max_loaded_at IS NULL OR date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 48 THEN 'error'
            WHEN date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 30 THEN 'warn'
            ELSE 'pass' END AS status
FROM mx"""
