"""Calendar functions of the gold layer (Postgres semantics on Spark built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_dow(d) -> Column:
    """extract(isodow): Monday=1 .. Sunday=7."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _c(d)).cast("int")


def year_month(d) -> Column:
    """to_char(date, 'YYYY-MM')."""
    return F.date_format(_c(d), "yyyy-MM")


def week_start(d) -> Column:
    """date_trunc('week', d)::date, weeks start on Monday."""
    return F.date_trunc("week", _c(d)).cast("date")


def week_end(d) -> Column:
    """week_start + interval '6 day'."""
    return F.date_add(week_start(d), 6)


def iso_year(d) -> Column:
    """extract(isoyear): 2024-12-30 belongs to ISO year 2025."""
    return F.extract(F.lit("YEAROFWEEK"), _c(d)).cast("int")


def iso_week(d) -> Column:
    """extract(week): ISO week number 1..53."""
    return F.weekofyear(_c(d)).cast("int")


def calendar(dates_df, date_col: str = "date"):
    """dim_date columns for a one-column DataFrame of dates."""
    d = F.col(date_col)
    return dates_df.select(
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        iso_dow(d).alias("iso_dow"),
        year_month(d).alias("year_month"),
    )
