"""Exact numerics for the BI layer.

Measures are decimals from staging on, so averages are exact: Spark's
``avg(decimal(p,s))`` is a decimal of scale s+4 and the cast to numeric(10,2)
rounds half away from zero, as Postgres does. A double average rounded to two
places would disagree with Postgres on ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dailylake.schemas import MONEY


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """::numeric(10,2)."""
    return _c(c).cast(MONEY)


def avg_money(c) -> Column:
    """avg(x)::numeric(10,2)."""
    return money(F.avg(_c(c)))
