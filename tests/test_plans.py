"""Plans at scale: what is pruned, what is combined before a shuffle, what is split when hot."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from vitrine.plans.datasets import Datasets
from vitrine.sources.schemas import RAW

AT_HAND = {"orders", "customers", "order_items", "order_payments", "order_reviews", "sellers"}
SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


OWN = [*contract.NAMES, *contract.WITH_ARGUMENTS]


@pytest.mark.parametrize("name", sorted(OWN))
def test_no_query_pairs_all_rows_or_runs_python(spark, name):
    plan = physical(contract.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "InPandas"):
        assert node not in plan


def test_series_scan_only_the_tables_they_need(spark):
    d = contract.datasets(spark, SF)
    scans = {
        "coo_monthly_delivery": {"orders", "customer"},
        "cx_monthly_reviews": {"orders", "customer", "events"},
        "cfo_monthly_revenue": {"orders", "customer"},
    }
    for name, tables in scans.items():
        found = set(re.findall(r"sf0\.001/(\w+)\.parquet", physical(d[name])))
        assert found == tables, name
    # neither items nor payments are joined for punctuality
    assert optimized(d.coo_monthly_delivery).count("Join") == 1


def test_reads_only_used_columns(spark):
    plan = physical(contract.datasets(spark, SF).state_revenue)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and not any("o_orderdate" in s for s in schemas)


def test_top_sellers_is_a_top_k_not_a_sort(spark):
    assert "TakeOrderedAndProject(limit=10" in physical(contract.datasets(spark, SF).top_sellers)


def test_every_aggregation_combines_before_its_shuffle(spark):
    """The input of each shuffle of a grouped dataset holds partial results."""
    for name in ("order_items_agg", "payments_agg", "reviews_agg", "stg_geolocation", "granularity_audit"):
        plan = physical(contract.queries()[name](spark, SF))
        assert "partial_" in plan, name


def skewed_layer(spark, rows=40_000):
    """A third of the orders belongs to one customer, a third of the items to one order and seller."""
    n = F.col("id")
    hot = n % 3 == 0
    orders = spark.range(0, rows, 1, 8).select(
        n.cast("string").alias("order_id"),
        F.when(hot, "hot").otherwise(n.cast("string")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[
            F.lit("2017-03-10 08:00:00").alias(c)
            for c in (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
    )
    customers = spark.range(0, rows, 1, 8).select(
        F.when(n == 0, "hot").otherwise(n.cast("string")).alias("customer_id"),
        n.cast("string").alias("customer_unique_id"),
        F.lit("1").alias("customer_zip_code_prefix"),
        F.lit("x").alias("customer_city"),
        F.lit("SP").alias("customer_state"),
    )
    items = spark.range(0, rows, 1, 8).select(
        F.when(hot, "0").otherwise(n.cast("string")).alias("order_id"),
        F.lit(1).alias("order_item_id"),
        F.lit("p").alias("product_id"),
        F.when(hot, "s0").otherwise(F.concat(F.lit("s"), n % 100)).alias("seller_id"),
        F.lit("2017-03-10 08:00:00").alias("shipping_limit_date"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    payments = orders.select(
        "order_id",
        F.lit(1).alias("payment_sequential"),
        F.lit("x").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(2.0).alias("payment_value"),
    )
    reviews = orders.select(
        F.lit("r").alias("review_id"),
        "order_id",
        F.lit("5").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.lit("2017-03-12").alias("review_creation_date"),
        F.lit("2017-03-12").alias("review_answer_timestamp"),
    )
    sellers = spark.range(100).select(
        F.concat(F.lit("s"), n).alias("seller_id"),
        F.lit("1").alias("seller_zip_code_prefix"),
        F.lit("x").alias("seller_city"),
        F.lit("SP").alias("seller_state"),
    )
    tables = {
        "orders": orders,
        "customers": customers,
        "order_items": items,
        "order_payments": payments,
        "order_reviews": reviews,
        "sellers": sellers,
    }
    return tables.__getitem__


AT_SCALE = {
    # no table of this size is broadcast on the real data, and its hot partitions pass these bounds
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20kb",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20kb",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_customer_with_a_third_of_the_orders_is_split(spark):
    with settings(spark, **AT_SCALE):
        mart = Datasets(spark, skewed_layer(spark)).mart_orders_wide
        rows = mart.collect()
        assert "SortMergeJoin(skew=true)" in physical(mart)
    assert len(rows) == 40_000
    assert sum(r.customer_id == "hot" for r in rows) == 13_334
    assert all(r.customer_state == "SP" for r in rows if r.customer_id == "hot")
    assert sum(r.order_revenue for r in rows) == 40_000


def test_hot_order_and_seller_reach_the_joins_collapsed(spark):
    with settings(spark, **AT_SCALE):
        d = Datasets(spark, skewed_layer(spark))
        rollup = {(r.seller_id, r.order_id): r.items_count for r in d.seller_orders.collect()}
        totals = {r.seller_id: r for r in d.mart_sellers_wide.collect()}
    assert rollup["s0", "0"] == 13_334
    assert sum(rollup.values()) == 40_000
    assert len(totals) == 100
    assert sum(r.total_items_sold for r in totals.values()) == 40_000
    # the join on order_id takes the grouped rows on both sides, never the raw items
    plan = optimized(d.seller_orders)
    join = plan[plan.index("Join Inner") :]
    assert join.count("Aggregate [seller_id") == 1
    assert re.search(r"Aggregate \[order_id#\d+\].*copies", join)


def copied_layer(spark, missing):
    """A third of the orders are copies of one id, or have none."""
    raw = skewed_layer(spark)
    hot = F.col("customer_id") == "hot"
    copies = raw("orders").withColumn("order_id", F.when(hot, F.lit(None if missing else "0")).otherwise(F.col("order_id")))
    layer = {**{t: raw(t) for t in RAW if t in AT_HAND}, "orders": copies.withColumn("customer_id", F.concat("customer_id", F.lit("x")))}
    return layer.__getitem__


@pytest.mark.parametrize("name", ["mart_orders_wide", "recognized_revenue", "leader_history"])
def test_copies_of_an_order_are_split(spark, name):
    with settings(spark, **AT_SCALE):
        df = Datasets(spark, copied_layer(spark, missing=False))[name]
        rows = df.collect()
        assert "SortMergeJoin(skew=true)" in physical(df)
    assert sum(r.order_id == "0" for r in rows) == 13_334


@pytest.mark.parametrize("name", ["mart_orders_wide", "recognized_revenue"])
def test_orders_without_an_id_are_not_joined_to_totals(spark, name):
    with settings(spark, **AT_SCALE):
        df = Datasets(spark, copied_layer(spark, missing=True))[name]
        rows = df.collect()
        plan = optimized(df)
    assert sum(r.order_id is None for r in rows) == 13_334 and len(rows) == 40_000
    if name == "recognized_revenue":  # the union's second branch, of orders without an id, has no join
        with_id, without = plan[plan.index("Union") :].split("\n+- ")
        assert with_id.count("Join LeftOuter") == 1 and "Join" not in without


def test_history_of_the_leader_computes_no_mart(spark):
    plan = physical(contract.datasets(spark, SF).leader_history)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and not any("o_totalprice" in s for s in schemas)


def test_plain_figures_read_no_totals(spark):
    plan = optimized(contract.datasets(spark, SF).state_delivery)
    assert "totals_of" not in plan and plan.count("Join") == 1
