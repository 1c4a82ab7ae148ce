"""Figures over ranges of days from stored sums, repeat purchases, and many relationships at once."""

import datetime as dt
import random

import pytest

import __spark_entry__ as contract
from tests.frames import one, order, raw_layer
from tests.test_updates import random_layer, versions
from vitrine.operators import day_sums, followups
from vitrine.plans import pipeline
from vitrine.plans.datasets import Datasets
from vitrine.sources.keyed import KeyedTable
from vitrine.sources.marts import MartStore
from vitrine.sources.raw import land, parquet_folder

FIGURES = ["cfo_monthly_revenue", "coo_monthly_delivery", "cx_monthly_reviews", "mart_sellers_wide", "state_revenue", "kpi_cards"]


def day(text):
    return dt.date.fromisoformat(text)


@pytest.mark.parametrize(
    "first, last, whole",
    [
        ("2017-01-01", "2017-01-31", 1), ("2017-01-02", "2017-01-31", 0), ("2017-01-01", "2017-02-27", 1),
        ("2017-01-15", "2017-04-15", 2), ("2017-01-31", "2017-02-28", 1), ("2017-03-05", "2017-03-07", 0),
        ("2016-12-31", "2017-01-01", 0), ("2016-02-01", "2016-02-29", 1),
    ],
)
def test_whole_months_of_a_range(first, last, whole):
    start, after = day_sums.edges(day(first), day(last))
    assert (after.year * 12 + after.month) - (start.year * 12 + start.month) == whole


def test_ranges_from_sums_equal_ranges_from_orders(spark, tmp_path):
    pick, raw_dir = random.Random(5), str(tmp_path / "raw")
    names, sellers = [f"o{i}" for i in range(60)], [f"s{i}" for i in range(5)]
    land(raw_layer(spark, **random_layer(pick, names, sellers)), raw_dir)
    store = MartStore(spark, str(tmp_path / "marts"))
    pipeline.refresh(spark, raw_dir, store)
    layer = random_layer(pick, pick.sample(names, 6), sellers)  # sums that a refresh has changed
    for table in ("orders", "order_items", "order_payments"):
        KeyedTable(spark, raw_dir, table).append(versions(spark, table, [(r, False) for r in layer[table]]), "q", 0)
    pipeline.refresh(spark, raw_dir, store)
    raw = parquet_folder(spark, raw_dir)
    window = {"as_of": day("2017-06-20"), "exclude_years": []}
    for first, last in (("2017-01-01", "2017-12-31"), ("2017-01-14", "2017-05-15"), ("2017-03-12", "2017-03-16")):
        plain = Datasets(spark, raw, **window).between(day(first), day(last))
        served = Datasets(spark, raw, store, **window).between(day(first), day(last))
        for name in FIGURES:
            assert served[name].dtypes == plain[name].dtypes, name
            assert sorted(map(str, served[name].collect())) == sorted(map(str, plain[name].collect())), (name, first)


def test_ranges_read_sums_only(spark):
    for name in contract.IN_RANGE:
        files = contract.queries()[name](spark, "/root/testdata/sf0.001").inputFiles()
        read = {part for f in files for part in ("day_states", "month_states", "day_sellers", "month_sellers", "mart_sellers_wide") if f"/{part}/" in f}
        assert files and len(read) <= 5 and all("/marts-" in f and "/mart_orders_wide/" not in f for f in files), name


def test_repeat_purchase_by_hand(spark):
    """Five people. Watched to 2017-01-11, day 10 of those who began on the first.

    a is back on day 2; b on day 5; c, who began on the 8th, is watched for three days; d and e for ten, and e's
    second purchase lies after the end. Day 2: 1 of 5 back, 0.8 still away. Day 5: c has left, 1 of 3: 0.8 * 2/3.
    """
    bought = [("a", "01"), ("a", "03"), ("a", "04"), ("b", "01"), ("b", "06"), ("c", "08"), ("d", "01"), ("e", "01"), ("e", "12")]
    rows = [order(f"o{k}", customer_id=f"c{k}", order_purchase_timestamp=f"2017-01-{d} 08:00:00") for k, (_, d) in enumerate(bought)]
    people = [{"customer_id": f"c{k}", "customer_unique_id": p} for k, (p, _) in enumerate(bought)]
    rows += [order("n1", customer_id=None), order("n2", customer_id="x"), order("n3", customer_id="c0", order_purchase_timestamp=None)]
    people.append({"customer_id": "x", "customer_unique_id": None})
    curve = Datasets(spark, raw_layer(spark, orders=rows, customers=people)).repeat_purchase(day("2017-01-11"))
    assert [tuple(r) for r in curve.collect()] == [(2, 5, 1, 20.0), (5, 3, 1, 46.6667)]
    none = Datasets(spark, raw_layer(spark)).repeat_purchase(day("2017-01-11"))
    assert none.collect() == []


def test_somebody_who_buys_most_and_twice_at_once(spark):
    rows = [order(f"h{k}", customer_id="hot", order_purchase_timestamp="2017-01-01 08:00:00") for k in range(500)]
    rows += [order(f"o{k}", customer_id=f"c{k}", order_purchase_timestamp="2017-01-01 08:00:00") for k in range(3)]
    people = [{"customer_id": c, "customer_unique_id": c} for c in ("hot", "c0", "c1", "c2")]
    curve = Datasets(spark, raw_layer(spark, orders=rows, customers=people)).repeat_purchase(day("2017-01-02"))
    assert [tuple(r) for r in curve.collect()] == [(0, 4, 1, 25.0)]


def test_relationships_of_hot_and_null_keys_in_one_shuffle(spark):
    child = spark.createDataFrame([("hot", "s")] * 400 + [("a", "s"), (None, "t"), ("b", None)], "order_id string, seller_id string")
    parent = spark.createDataFrame([("a",), (None,), ("c",)], "order_id string")
    sellers = spark.createDataFrame([("s",), ("s",)], "seller_id string")
    tests = [("child", "order_id", "parent"), ("child", "seller_id", "sellers"), ("parent", "order_id", "child")]
    found = followups.relationship_tests({"child": child, "parent": parent, "sellers": sellers}, tests)
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows = {(r.dataset, r.column): (r.failures, r.passed) for r in found.collect()}
    assert rows == {("child", "order_id"): (401, False), ("child", "seller_id"): (1, False), ("parent", "order_id"): (1, False)}
    assert plan.count("Exchange hashpartitioning") == 1
    for row, (name, column, of) in zip(found.collect(), tests, strict=True):
        frames = {"child": child, "parent": parent, "sellers": sellers}
        assert tuple(row) == tuple(one(followups.relationship_test(frames[name], name, column, frames[of], column)))


def test_relationships_read_each_key_domain_once(spark):
    plan = contract.queries()["dq_relationships"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(domain") == 1 and plan.count("Exchange hashpartitioning") <= 4
