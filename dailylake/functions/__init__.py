"""Scalar column functions (all built-in Spark expressions, codegen friendly)."""

from dailylake.functions.coerce import (nan_to_null, to_date_strict, to_double, to_int,
                                        to_timestamp_local, to_timestamp_utc)
from dailylake.functions.dates import (calendar, iso_dow, iso_week, iso_year, week_end,
                                       week_start, year_month)
from dailylake.functions.numeric import avg_money, money

__all__ = ["nan_to_null", "to_date_strict", "to_double", "to_int", "to_timestamp_local",
           "to_timestamp_utc", "calendar", "iso_dow", "iso_week", "iso_year", "week_end",
           "week_start", "year_month", "avg_money", "money"]
