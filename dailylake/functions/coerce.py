"""Type coercion with the reference's error semantics (JVM-side, no UDFs).

* ``to_double`` / ``to_int``: unparseable -> NULL (pandas ``to_numeric(errors="coerce")``).
* ``to_date_strict``: unparseable -> error (pandas ``to_datetime`` default); relies
  on ANSI mode, where ``cast`` raises.
* ``to_timestamp_utc`` / ``to_timestamp_local``: unparseable -> NULL.
* ``nan_to_null``: NaN is a value in Spark (and ``NaN > 60`` is true), NULL in pandas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Numeric coercion; NaN becomes NULL as in pandas."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_int(c) -> Column:
    """Integer coercion through double: '3.0' is 3.

    A value that is no whole number or too large is unusable like text that is no number,
    and NULL: one bad code must not fail the load of its day.
    """
    d = to_double(c)
    return F.when(d == F.floor(d), d.try_cast("int"))


def to_date_strict(c) -> Column:
    """Date parse that fails the job on a bad value (ANSI cast); NULL stays NULL."""
    return _c(c).cast("date")


def to_timestamp_utc(c) -> Column:
    """ISO-8601 text (with or without offset) -> UTC timestamp, bad -> NULL."""
    return _c(c).try_cast("timestamp")


def to_timestamp_local(c) -> Column:
    """Wall-clock text -> timestamp without time zone, bad -> NULL."""
    return _c(c).try_cast("timestamp_ntz")


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in the float/double columns (all of them by default)."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or list(floating)) if c in floating]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in targets}) if targets else df
