"""Quality gate (C1-C9) and model tests (C11-C14), reported as DataFrames.

Every check is grouped by ``dt``, so a single-day run and a multi-year
backfill use the same code: the daily rows are scanned and shuffled once, by
their key, and all rules of a day follow from those counters and the day's
location rows (one row per day). ``raise_on_failure`` turns
the first failing rule of each day, in the reference's order, into a
``QualityGateError``; nothing is written before it passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailylake.functions.coerce import to_double
from dailylake.operators.dedup import duplicate_groups
from dailylake.sources.silver import partition_hint

DAILY_REQUIRED = ["location_id", "date", "ingested_at"]
LOCATIONS_REQUIRED = ["location_id", "name", "country", "lat", "lon", "tz_id", "ingested_at"]


class QualityGateError(ValueError):
    def __init__(self, msg: str):
        super().__init__(f"[QUALITY_GATE] {msg}")


@dataclass(frozen=True)
class QualityConfig:
    min_completeness_ratio: float = 0.95
    temp_min_c: float = -80.0
    temp_max_c: float = 60.0
    humidity_min: float = 0.0
    humidity_max: float = 100.0
    temp_columns: tuple[str, ...] = ("temp_min_c", "temp_max_c", "temp_avg_c")
    humidity_column: str = "humidity_avg"

    def ranges(self, columns: list[str]) -> list[tuple[str, float, float]]:
        """(column, lo, hi) for the range rules whose column exists (absent -> skipped)."""
        out = [(c, self.temp_min_c, self.temp_max_c) for c in self.temp_columns]
        out.append((self.humidity_column, self.humidity_min, self.humidity_max))
        return [r for r in out if r[0] in columns]


# ---- C3 -------------------------------------------------------------------------------

def require_columns(df: DataFrame, cols: list[str], name: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise QualityGateError(f"{name} rows come without the required columns {missing}")


# ---- single-rule reports (A5, A6, A7, C5, C9) --------------------------------------

def null_counts(df: DataFrame, cols: list[str], by: list[str] | None = None,
                dataset: str | None = None) -> DataFrame:
    """NULL count per column (and group), all columns in one pass, long format."""
    by = by or []
    agg = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot(by, cols, "column", "n_null") if by else \
        agg.unpivot([], cols, "column", "n_null")
    return long.withColumn("dataset", F.lit(dataset)) if dataset else long


def range_counts(df: DataFrame, ranges: list[tuple[str, float, float]],
                 by: list[str] | None = None) -> DataFrame:
    """Per column: parseable non-NULL values, values below lo, values above hi.

    Values are re-coerced (text that is not a number is ignored, not failed;
    NaN counts as NULL).
    """
    by = by or []
    aggs = []
    for c, lo, hi in ranges:
        v = to_double(c)
        aggs += [F.count(v).alias(f"{c}__valid"),
                 F.count_if(v < F.lit(lo)).alias(f"{c}__low"),
                 F.count_if(v > F.lit(hi)).alias(f"{c}__high")]
    wide = df.groupBy(*by).agg(*aggs)
    per_col = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(float(lo)).alias("min_v"),
                                 F.lit(float(hi)).alias("max_v"),
                                 F.col(f"{c}__valid").alias("n_valid"),
                                 F.col(f"{c}__low").alias("n_low"),
                                 F.col(f"{c}__high").alias("n_high"))
                        for c, lo, hi in ranges])
    return wide.select(*by, F.inline(per_col))


def freshness_counts(daily: DataFrame, by: str = "dt") -> DataFrame:
    """Per dt: rows, unparseable dates, and dates different from dt."""
    d = F.col("date").try_cast("date")
    return daily.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(d.isNull()).alias("n_bad_date"),
        F.count_if(d.isNull() | (d != F.col(by).cast("date"))).alias("n_date_ne_dt"))


def completeness(daily: DataFrame, expected: DataFrame, by: str = "dt") -> DataFrame:
    """present / expected location counts per dt.

    ``expected`` is either per-dt (has a ``dt`` column: the day's silver
    locations, the default rule) or a registry without ``dt`` (all
    configured locations). Present = daily locations that are also expected
    (set intersection as a semi join on the distinct keys).
    """
    d = daily.select(by, F.col("location_id").cast("string").alias("location_id")).distinct()
    if by in expected.columns:
        e = expected.select(by, F.col("location_id").cast("string").alias("location_id")).distinct()
        present = d.join(e, [by, "location_id"], "left_semi").groupBy(by).agg(
            F.count(F.lit(1)).alias("present"))
        exp = e.groupBy(by).agg(F.count(F.lit(1)).alias("expected"))
        out = exp.join(present, by, "left").fillna(0, ["present"])
    else:
        ids = expected.select(F.col("location_id").cast("string").alias("location_id")).distinct()
        n_expected = ids.agg(F.count(F.lit(1))).scalar()
        present = d.join(ids, "location_id", "left_semi").groupBy(by).agg(
            F.count(F.lit(1)).alias("present"))
        days = daily.select(by).distinct()
        out = (days.join(present, by, "left").fillna(0, ["present"])
               .withColumn("expected", n_expected))
    ratio = F.when(F.col("expected") > 0, F.col("present") / F.col("expected")).otherwise(F.lit(0.0))
    return out.select(by, F.col("present").cast("bigint").alias("present"),
                      F.col("expected").cast("bigint").alias("expected"), ratio.alias("ratio"))


def missing_locations(daily: DataFrame, expected: DataFrame, n: int = 10,
                      by: str = "dt") -> DataFrame:
    """Per dt: the first ``n`` expected locations (sorted) without a daily row.

    ``expected`` is per-dt (has a ``dt`` column) or a registry without ``dt``. The
    registry isn't expanded by day: its ids are numbered in order (by one task, which
    sorts one id a location), and the gaps between the numbers that a day has are its
    missing ones, of which the first ``n`` are unrolled. The rest is an anti join.
    """
    present = daily.select(by, F.col("location_id").cast("string").alias("location_id")).distinct()
    ids = expected.select(*([by] if by in expected.columns else []), F.col("location_id").cast("string").alias("location_id")).distinct()
    w = Window.partitionBy(by).orderBy("location_id")
    if by in expected.columns:
        return (ids.join(present, [by, "location_id"], "left_anti")
                .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .select(by, "rank", "location_id"))
    ranked = ids.withColumn("_r", F.row_number().over(Window.orderBy("location_id")).cast("long"))
    have = present.join(ranked, "location_id").select(by, "_r")
    ends = daily.select(by).distinct().withColumn("_r", ids.agg(F.count(F.lit(1))).scalar() + 1)
    at = Window.partitionBy(by).orderBy("_r")
    before = F.coalesce(F.lag("_r").over(at), F.lit(0))
    gaps = have.unionByName(ends).select(by, "_r", before.alias("_p"), (before - F.row_number().over(at) + 1).alias("_m"))
    # _m numbers are missing before this gap
    gaps = gaps.where((F.col("_r") - F.col("_p") > 1) & (F.col("_m") < n))
    last = F.least(F.col("_r") - 1, F.col("_p") + n - F.col("_m"))
    lost = gaps.select(by, "_m", "_p", F.explode(F.sequence(F.col("_p") + 1, last)).alias("_r"))
    lost = lost.select(by, (F.col("_m") + F.col("_r") - F.col("_p")).cast("int").alias("rank"), "_r")
    return lost.join(ranked, "_r").select(by, "rank", "location_id")


# ---- gate report ---------------------------------------------------------------------

def _first_failure(rules: list[tuple[Column, str | Column]]) -> Column:
    return F.coalesce(*[F.when(cond, name if isinstance(name, Column) else F.lit(name))
                        for cond, name in rules])


def gate_report(daily: DataFrame, locations: DataFrame, cfg: QualityConfig = QualityConfig(),
                expected_dts: DataFrame | None = None,
                expected_locations: DataFrame | None = None) -> DataFrame:
    """One row per dt with every counter of the gate and the first failing rule.

    ``expected_dts``: days that must exist (missing -> ``missing_partition``).
    ``expected_locations``: completeness denominator; default = the day's
    silver locations, or pass the registry.
    """
    require_columns(daily, DAILY_REQUIRED, "Daily")
    require_columns(locations, LOCATIONS_REQUIRED, "Locations")
    ranges = cfg.ranges(daily.columns)

    # one pass over the daily rows: their counters by key, which also shows duplicates
    counts = [F.count_if(F.col("ingested_at").isNull()).alias("daily_null_ingested_at")]
    for c, lo, hi in ranges:
        v = to_double(c)
        counts += [F.count(v).alias(f"valid_{c}"), F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias(f"out_{c}")]
    summed = [f"{w}_{c}" for c, _, _ in ranges for w in ("valid", "out")]
    keyed = daily.groupBy(F.col("dt").cast("date").alias("dt"), F.col("location_id").cast("string").alias("location_id"), "date")
    day = F.col("date").try_cast("date")
    rows_if = lambda cond: F.when(cond, F.col("daily_rows")).otherwise(0)
    own = keyed.agg(F.count(F.lit(1)).alias("daily_rows"), *counts).select(
        "dt", "location_id", "daily_rows", "daily_null_ingested_at", *summed,
        rows_if(F.col("location_id").isNull()).alias("daily_null_location_id"), rows_if(F.col("date").isNull()).alias("daily_null_date"),
        rows_if(day.isNull()).alias("bad_date"), rows_if(day.isNull() | (day != F.col("dt"))).alias("date_ne_dt"),
        (F.col("daily_rows") > 1).cast("long").alias("dup_groups"), rows_if(F.col("daily_rows") > 1).alias("dup_rows"))
    # location rows join the stack, so one aggregate by location holds both sides
    there = locations.select(
        F.col("dt").cast("date").alias("dt"), F.col("location_id").cast("string").alias("location_id"), F.lit(1).cast("long").alias("location_rows"),
        *[F.col(c).isNull().cast("long").alias(f"loc_null_{c}") for c in LOCATIONS_REQUIRED])
    stacked = own.unionByName(there, allowMissingColumns=True)
    value_cols = [c for c in stacked.columns if c not in ("dt", "location_id")]
    by_location = stacked.groupBy("dt", "location_id").agg(*[F.sum(c).alias(c) for c in value_cols])
    seen = F.col("daily_rows").isNotNull()
    if expected_locations is None or "dt" in expected_locations.columns:
        if expected_locations is None:
            wanted = F.col("location_rows").isNotNull()
        else:
            days = expected_locations.select(F.col("dt").cast("date").alias("dt"), F.col("location_id").cast("string").alias("location_id")).distinct()
            by_location = by_location.join(days.withColumn("_wanted", F.lit(True)), ["dt", "location_id"], "full")
            wanted = F.col("_wanted").isNotNull()
        folded = [F.count_if(seen & wanted & F.col("location_id").isNotNull()).alias("present"), F.count_if(wanted).alias("expected")]
    else:
        ids = expected_locations.select(F.col("location_id").cast("string").alias("location_id")).distinct()
        by_location = by_location.join(ids.withColumn("_wanted", F.lit(True)), "location_id", "left")
        folded = [F.count_if(seen & F.col("_wanted")).alias("present"),
                  F.when(F.sum("daily_rows") > 0, ids.agg(F.count(F.lit(1))).scalar()).otherwise(0).alias("expected")]
    rep = by_location.groupBy("dt").agg(*[F.sum(c).alias(c) for c in value_cols], *folded)
    if expected_dts is not None:
        rep = rep.join(expected_dts.select(F.col("dt").cast("date").alias("dt")).distinct(), "dt", "full")
    rep = rep.withColumn("ratio", F.when(F.col("expected") > 0, F.col("present") / F.col("expected")))
    rep = rep.fillna(0, ["daily_rows", "location_rows", "dup_groups", "dup_rows", "present", "expected"])

    rules: list[tuple[Column, str | Column]] = [
        (F.col("daily_rows") == 0, "missing_daily_partition"),
        (F.col("location_rows") == 0, "missing_locations_partition"),
    ]
    rules += [(F.col(f"daily_null_{c}") > 0, f"daily_not_null:{c}") for c in DAILY_REQUIRED]
    rules += [(F.col(f"loc_null_{c}") > 0, f"locations_not_null:{c}") for c in LOCATIONS_REQUIRED]
    rules += [(F.col("bad_date") > 0, "date_unparseable"), (F.col("date_ne_dt") > 0, "date_ne_dt"),
              (F.col("dup_groups") > 0, "duplicate_location_date")]
    for c, _, _ in ranges:
        rules += [(F.col(f"valid_{c}") == 0, f"range_all_null:{c}"),
                  (F.col(f"out_{c}") > 0, f"range:{c}")]
    rules += [(F.col("ratio") < F.lit(cfg.min_completeness_ratio), "completeness")]
    failed = _first_failure(rules)
    return rep.withColumn("failed_rule", failed).withColumn("passed", failed.isNull())


def offenders(daily: DataFrame, cfg: QualityConfig = QualityConfig(), n: int = 5) -> DataFrame:
    """Sample of offending daily rows for the freshness and range rules.

    (rule, dt, location_id, date, value), the first ``n`` per rule in
    (dt, location_id, date) order: a bounded, deterministic sample.
    """
    d = F.col("date").try_cast("date")
    parts = [daily.where(d.isNull() | (d != F.col("dt").cast("date")))
             .select(F.lit("date_ne_dt").alias("rule"), "dt", "location_id", "date",
                     F.col("date").cast("string").alias("value"))]
    for c, lo, hi in cfg.ranges(daily.columns):
        v = to_double(c)
        parts.append(daily.where((v < F.lit(lo)) | (v > F.lit(hi)))
                     .select(F.lit(f"range:{c}").alias("rule"), "dt", "location_id", "date",
                             v.cast("string").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy("rule").orderBy("dt", "location_id", "date")
    # top-n per rule: Spark plans this as a per-partition group limit before the shuffle
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def raise_on_failure(report: DataFrame, sample: int = 5, daily: DataFrame | None = None,
                     cfg: QualityConfig = QualityConfig(),
                     expected: DataFrame | None = None, roots: dict[str, str] | None = None) -> DataFrame:
    """Raise with the first failing days (bounded sample); return the report otherwise.

    With ``daily`` the message shows rows of the failing days that break the
    freshness and range rules and duplicated keys with their counts; with
    ``expected`` also locations that are missing, and with ``roots`` (the silver root
    of each missing-partition rule) the nearest days that are there.
    """
    failing = report.where(~F.col("passed"))
    bad = failing.select("dt", "failed_rule").orderBy("dt").limit(sample).collect()
    if not bad:
        return report
    shown = ", ".join(f"dt={r['dt']}: {r['failed_rule']}" for r in bad)
    msg = f"{failing.count()} day(s) failed. First: {shown}"
    lost = next((r for r in bad if roots and r["failed_rule"] in roots), None)
    if lost:
        msg += f". {partition_hint(report.sparkSession, roots[lost['failed_rule']], lost['dt'])}"
    if daily is not None:
        own = daily.join(failing.select("dt"), "dt", "left_semi")
        rows = offenders(own, cfg, sample).orderBy("dt", "location_id", "rule").limit(sample).collect()
        if rows:
            msg += ". Sample: " + ", ".join(f"{r['rule']} {r['location_id']}/{r['date']}={r['value']}" for r in rows)
        rows = duplicate_groups(own, ["dt", "location_id", "date"], sample).collect()
        if rows:
            msg += ". Duplicates: " + ", ".join(f"{r['location_id']}/{r['date']} x{r['count']}" for r in rows)
        if expected is not None:
            if "dt" in expected.columns:
                expected = expected.join(failing.select("dt"), "dt", "left_semi")
            rows = missing_locations(own, expected, sample).orderBy("dt", "rank").limit(sample).collect()
            if rows:
                msg += ". Missing: " + ", ".join(f"{r['dt']} {r['location_id']}" for r in rows)
    raise QualityGateError(msg)


# ---- model tests (C11-C14) ----------------------------------------------------------

def test_not_null(models: dict[str, DataFrame], tests: list[tuple[str, str]]) -> DataFrame:
    """Model test ``not_null``: failing rows per (model, column), one pass per model."""
    parts = []
    for model in dict.fromkeys(m for m, _ in tests):
        cols = [c for m, c in tests if m == model]
        agg = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(agg.unpivot([], cols, "column", "failures")
                     .select(F.lit(model).alias("model"), "column", "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def test_unique(models: dict[str, DataFrame], tests: list[tuple[str, list[str]]]) -> DataFrame:
    """Model test ``unique`` / unique combination: number of key values occurring more than once."""
    parts = []
    for model, keys in tests:
        g = (models[model].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .agg(F.count(F.lit(1)).alias("failures")))
        parts.append(g.select(F.lit(model).alias("model"), F.lit(",".join(keys)).alias("column"),
                              "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_freshness(sources: dict[str, DataFrame], now, warn_hours: float = 30,
                     error_hours: float = 48, field: str = "loaded_at") -> DataFrame:
    """Source freshness on ``max(loaded_at)`` against a passed-in ``now``."""
    parts = []
    for name, df in sources.items():
        m = df.agg(F.max(field).alias("max_loaded_at"))
        at = now if isinstance(now, Column) else F.lit(now)
        age = (F.unix_timestamp(at.cast("timestamp"))
               - F.unix_timestamp("max_loaded_at")) / 3600.0
        parts.append(m.select(F.lit(name).alias("source"), "max_loaded_at",
                              age.alias("age_hours")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_hours), "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    return out.withColumn("status", status)
