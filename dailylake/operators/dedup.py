"""Keep-one-row-per-key operators.

Both are aggregates, not ``row_number`` windows: ``max(struct(order..., row))``
is computed partially on the map side, so a key holding a third of all rows
is reduced inside each task before the shuffle instead of being sorted in one
task. The whole row takes part in the comparison, which makes ties
deterministic.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _desc_fields(c: Column | str, nulls_first: bool) -> list[Column]:
    """One ``ORDER BY c DESC`` item as struct fields whose maximum is the first row."""
    col = F.col(c) if isinstance(c, str) else c
    # The flag decides where NULLs go: NULLs first -> the null flag ranks highest.
    return [col.isNull() if nulls_first else col.isNotNull(), col]


def latest_by_key(df: DataFrame, keys: list[str], order_desc: list[Column | str],
                  nulls_first: bool = True) -> DataFrame:
    """One row per key: the first row of ``ORDER BY order_desc DESC`` per key.

    ``nulls_first=True`` is the Postgres default for DESC (a NULL wins);
    Spark's own ``desc`` puts NULLs last.
    """
    cols = [c for c in df.columns]
    fields = []
    for i, c in enumerate(order_desc):
        flag, val = _desc_fields(c, nulls_first)
        fields += [flag.alias(f"_o{i}f"), val.alias(f"_o{i}v")]
    best = F.max(F.struct(*fields, F.struct(*[F.col(c) for c in cols]).alias("_row")))
    return (df.groupBy(*[F.col(k) for k in keys]).agg(best.alias("_best"))
            .select(*[F.col(f"_best._row.{c}").alias(c) for c in cols]))


def keep_last(df: DataFrame, keys: list[str], position: list[Column | str]) -> DataFrame:
    """``drop_duplicates(subset=keys, keep="last")`` where ``position`` gives input order.

    DataFrame row order is not a guarantee in Spark, so the position must be
    explicit (bronze: ``flatten.delivery_order``).
    """
    return latest_by_key(df, keys, position, nulls_first=False)


def duplicate_members(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once (pandas ``duplicated(keep=False)``).

    Counts per key are pre-aggregated, then joined back; AQE splits a hot key's
    join partition if needed. NULL keys count as equal.
    """
    dup_keys = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]))
    same = reduce(and_, [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(dup_keys, same, "left_semi")


def duplicate_groups(df: DataFrame, keys: list[str], n: int | None = 5) -> DataFrame:
    """Duplicated key groups with their size, largest first (ties by key)."""
    g = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1"))
    ordered = g.orderBy(F.col("count").desc(), *[F.col(k).asc_nulls_first() for k in keys])
    return ordered.limit(n) if n else g
