"""What the plans must and must not contain."""

import re
from pathlib import Path

import pytest

from patronage.registry.queries import QUERIES

from .conftest import SAMPLE

ROOT = Path(__file__).resolve().parents[1]
LAZY = [
    "m5_rfm_segments", "a1_rfm_metrics_fanout", "a3_campaign_metrics", "d4_campaign_display", "j5_star_join",
    "a13_ab_summary", "unified_customers", "f28_revenue_lags", "f23_order_counts", "a14_dq_summary", "w5_order_gaps",
    "w2_latest_per_group", "w3_first_per_key", "t6_random_split", "p4_clean_items", "dq6_customer_rejects",
]


def plan_of(spark, name):
    return QUERIES[name](spark, SAMPLE)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_products(spark, name):
    plan = plan_of(spark, name)
    for banned in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan


def test_windows_are_partitioned():
    """No OVER () and no unpartitioned ORDER BY window anywhere in the library."""
    for path in (ROOT / "patronage").rglob("*.py"):
        text = path.read_text()
        assert "Window.orderBy" not in text, path
        assert "localCheckpoint" not in text, path
        assert "crossJoin" not in text, path


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["m5_rfm_segments"](spark, SAMPLE)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PushedFilters: \[(.*?)\].*?ReadSchema: struct<(.*?)>", plan, re.S)
    orders = next(s for s in scans if "o_orderkey" in s[1])
    assert "LessThan" in orders[0] and "o_orderpriority" not in orders[1]


def test_rfm_has_no_join_of_raw_orders_with_customers(spark):
    """Order rows are summed per customer before they meet the customer table."""
    plan = QUERIES["m5_rfm_segments"](spark, SAMPLE)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan


def test_hot_parent_key_is_split_at_run_time(spark):
    """A third of the children share one parent: the adaptive join splits that partition."""
    from pyspark.sql import functions as F

    from patronage.operators.cleanup import keep_with_parent

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(300_000).repartition(8)
        child = rows.select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"))
        parent = spark.range(0, 5000, 2).withColumnRenamed("id", "k").union(spark.createDataFrame([(7,)], "k bigint"))
        kept = keep_with_parent(child, parent, "k")
        found = kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert len(found) == child.filter("k = 7 or k % 2 = 0").count()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_unified_rows_do_not_move_again_for_their_order_history(spark, warehouse):
    """The key of the unified table is that of its parts, so its rows lie where the history's lie."""
    from patronage.operators import features
    from patronage.plans import unify
    from patronage.registry.warehouse import AS_OF

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        history = features.order_history_features(warehouse.sold, AS_OF)
        whole = unify.attach_order_history(warehouse.unified, history)
        moved = whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        parts = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (warehouse.unified, history)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved == sum(parts)
    assert warehouse.unified.where("customer_id is null").isEmpty()
