"""Physical-plan assertions: pushdown, pruning, shared window exchange, runtime broadcasts."""

import os
import re

from dailylake.catalog import REGISTRY
from dailylake.plans import gold as G
from dailylake.plans import perf as P
from dailylake.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def _final_plan(df) -> str:
    """The adaptive plan after execution, without its 'Initial Plan' section."""
    df.collect()  # executes this DataFrame's own (adaptive) plan; inputs are tiny
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _stored_gold(spark, tmp_root):
    t = Tables(spark, SF)
    g = G.Gold(t.staging_daily(), t.staging_locations())
    root = os.path.join(tmp_root, "gold")
    (g.fact().repartitionByRange("location_id", "date").sortWithinPartitions("location_id", "date")
     .write.parquet(os.path.join(root, "fact")))
    g.dim_location().write.parquet(os.path.join(root, "dim_location"))
    return spark.read.parquet(os.path.join(root, "fact")), spark.read.parquet(os.path.join(root, "dim_location"))


def test_analyst_filters_reach_the_parquet_scan(spark, tmp_root):
    fact, dim = _stored_gold(spark, tmp_root)
    q = P.location_range(fact, dim)
    scan = [ln for ln in q._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in ln]
    assert scan and "EqualTo(location_id" in scan[0] and "GreaterThanOrEqual(date" in scan[0]
    assert "ReadSchema: struct<location_id:string,date:date,temp_avg_c" in scan[0]


def test_column_pruning_on_source_scan(spark):
    df = REGISTRY["perf_sanity"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders_scan = [ln for ln in plan.splitlines() if "orders.parquet" in ln or "o_orderdate" in ln]
    assert orders_scan
    assert "o_orderpriority" not in plan and "o_comment" not in plan


def test_rolling_mart_one_exchange_one_window(spark):
    t = Tables(spark, SF)
    g = G.Gold(t.staging_daily(), t.staging_locations())
    plan = _final_plan(G.mart_weather_rolling(g.fact()))
    assert plan.count("Window [") == 1
    # the three window functions share one exchange on location_id alone
    assert len(re.findall(r"Exchange hashpartitioning\(location_id#\d+, \d+\)", plan)) == 1


def test_dimension_joins_become_broadcasts_at_runtime(spark):
    plan = _final_plan(REGISTRY["bi_anomalies"](spark, SF))
    assert "isFinalPlan=true" in plan
    assert plan.count("BroadcastHashJoin") >= 3
    assert "SortMergeJoin" not in plan


def test_keep_last_is_a_partial_aggregate(spark):
    plan = REGISTRY["silver_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(struct" in plan
    assert "Window" not in plan
