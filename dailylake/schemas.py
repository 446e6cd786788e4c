"""Table contracts: one explicit StructType per layer table.

Bronze JSON is always read with an explicit schema (never inferred), and every
numeric leaf of the API payload is declared as a string so that a bad value
becomes NULL through ``try_cast`` instead of spoiling the whole record.
"""

from pyspark.sql import types as T

S = T.StringType()

# Exact decimal used for the contract's unconstrained ``numeric`` columns.
NUMERIC = T.DecimalType(18, 6)
# numeric(10,2) of the BI layer.
MONEY = T.DecimalType(10, 2)

# ---- location registry (seed) -------------------------------------------
REGISTRY = T.StructType([
    T.StructField("location_id", S, False),
    T.StructField("name", S, True),
    T.StructField("country", S, True),
    T.StructField("region", S, True),
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lon", T.DoubleType(), True),
    T.StructField("tz", S, True),
])

# ---- bronze envelope ------------------------------------------------------
BRONZE_METADATA = T.StructType([
    T.StructField("dt", S), T.StructField("location_id", S), T.StructField("location_name", S),
    T.StructField("ingested_at", S), T.StructField("source", S), T.StructField("api_version", S),
    T.StructField("request", T.StructType([T.StructField("q", S), T.StructField("endpoint", S)])),
])

BRONZE_CONDITION = T.StructType([T.StructField("code", S), T.StructField("text", S)])

BRONZE_DAY = T.StructType([
    T.StructField("mintemp_c", S), T.StructField("maxtemp_c", S), T.StructField("avgtemp_c", S),
    T.StructField("totalprecip_mm", S), T.StructField("totalsnow_cm", S),
    T.StructField("avghumidity", S), T.StructField("maxwind_kph", S),
    T.StructField("condition", BRONZE_CONDITION),
])

BRONZE_PAYLOAD = T.StructType([
    T.StructField("location", T.StructType([
        T.StructField("name", S), T.StructField("region", S), T.StructField("country", S),
        T.StructField("lat", S), T.StructField("lon", S), T.StructField("tz_id", S),
        T.StructField("local_time", S),
    ])),
    T.StructField("forecast", T.StructType([
        T.StructField("forecastday", T.ArrayType(T.StructType([
            T.StructField("date", S), T.StructField("day", BRONZE_DAY),
        ]))),
    ])),
])

BRONZE = T.StructType([
    T.StructField("metadata", BRONZE_METADATA),
    T.StructField("payload", BRONZE_PAYLOAD),
])

# The envelope where malformed records are kept apart: the last column holds their text.
CORRUPT = T.StructType([*BRONZE.fields, T.StructField("_corrupt", S)])

# ---- silver -------------------------------------------------------------------
DAILY_MEASURES = ["temp_min_c", "temp_max_c", "temp_avg_c", "precip_mm", "snow_cm",
                  "humidity_avg", "wind_max_kph"]

SILVER_DAILY = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("location_id", S),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("date", T.DateType()),
    *[T.StructField(c, T.DoubleType()) for c in DAILY_MEASURES],
    T.StructField("condition_code", T.IntegerType()),
    T.StructField("condition_text", S),
])

SILVER_LOCATIONS = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("location_id", S),
    T.StructField("name", S), T.StructField("region", S), T.StructField("country", S),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("tz_id", S),
    T.StructField("local_time", T.TimestampNTZType()),
    T.StructField("ingested_at", T.TimestampType()),
])

# ---- staging (warehouse contract, loaded_at added at load) -------------------
STG_DAILY_COLUMNS = ["dt", "location_id", "date", "temp_min_c", "temp_max_c", "temp_avg_c",
                     "precip_mm", "humidity_avg", "wind_max_kph", "condition_code",
                     "condition_text", "ingested_at"]

STG_LOCATIONS_COLUMNS = ["dt", "location_id", "name", "region", "country", "lat", "lon",
                         "tz_id", "local_time", "ingested_at"]

# Loader optional columns: a missing one becomes a NULL column (the other six are required).
STG_LOCATIONS_OPTIONAL = ["ingested_at", "lat", "lon", "local_time"]

# ---- run log --------------------------------------------------------------------
PIPELINE_RUNS = T.StructType([
    T.StructField("run_id", S, False),
    T.StructField("dt", T.DateType(), False),
    T.StructField("status", S, False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("duration_sec", T.DecimalType(18, 3)),
    T.StructField("records_loaded", T.IntegerType()),
    T.StructField("error_summary", S),
])
