from decimal import Decimal

import pytest

from tests.frames import item, one, order, raw_layer, review
from vitrine.operators import day_sums, followups, sellers_mart
from vitrine.plans.datasets import Datasets


def datasets(spark, **tables):
    return Datasets(spark, raw_layer(spark, **tables))


def sellers(*ids):
    return [{"seller_id": s, "seller_city": "city", "seller_state": "SP"} for s in ids]


def test_seller_without_delivered_orders_stays(spark):
    d = datasets(
        spark,
        sellers=sellers("s"),
        orders=[order("a", order_status="shipped")],
        order_items=[item("a", "s", 10.0)],
    )
    row = one(d.mart_sellers_wide)
    assert (row.total_orders, row.total_items_sold, row.total_revenue) == (0, 0, 0)
    assert row.total_reviews == 0
    assert row.avg_revenue_per_item is row.avg_delivery_days is row.on_time_pct is None
    assert row.avg_delay_days is row.avg_review_score is None


def test_on_time_share_is_of_all_delivered_orders(spark):
    d = datasets(
        spark,
        sellers=sellers("s"),
        orders=[
            order("on"),
            order("late", order_delivered_customer_date="2017-03-23 01:00:00"),
            order("undated", order_delivered_customer_date=None),
        ],
        order_items=[item(k, "s", 1.0) for k in ("on", "late", "undated")],
    )
    assert one(d.mart_sellers_wide).on_time_pct == pytest.approx(33.33)
    # the monthly share counts only orders whose punctuality is known
    assert one(d.coo_monthly_delivery).on_time_pct == 50.0


def test_price_is_weighted_by_items_and_unrounded(spark):
    d = datasets(
        spark,
        sellers=sellers("s"),
        orders=[order("a"), order("b")],
        order_items=[item("a", "s", 10.0, 1), item("a", "s", 10.0, 2), item("b", "s", 40.0)],
    )
    row = one(d.mart_sellers_wide)
    assert (row.total_orders, row.total_items_sold) == (2, 3)
    assert row.avg_revenue_per_item == 20.0


def test_order_shared_by_sellers_splits_revenue_not_metrics(spark):
    d = datasets(
        spark,
        sellers=sellers("s", "t"),
        orders=[order("a")],
        order_items=[item("a", "s", 10.0, 1), item("a", "t", 5.0, 2)],
        order_reviews=[review("a", 4)],
    )
    s, t = one(d.mart_sellers_wide, seller_id="s"), one(d.mart_sellers_wide, seller_id="t")
    assert (s.total_revenue, t.total_revenue) == (Decimal("10.000"), Decimal("5.000"))
    assert s.avg_review_score == t.avg_review_score == 4.0
    assert s.avg_delivery_days == t.avg_delivery_days == 5.0


def test_copies_of_an_order_fan_out_as_a_join_would(spark):
    """Broken keys must not be hidden: sums count each copy, the pair stays one row."""
    d = datasets(
        spark,
        sellers=sellers("s"),
        orders=[order("a")] * 3,
        order_items=[item("a", "s", 10.0, 1), item("a", "s", 2.5, 2)],
    )
    row = one(d.seller_orders)
    assert (row.order_revenue, row.items_count, row.delivery_days) == (Decimal("37.500"), 6, 5)
    assert one(d.mart_sellers_wide).total_orders == 1


def test_seller_listed_twice_is_one_row_of_doubled_totals(spark):
    d = datasets(
        spark, sellers=sellers("s", "s"), orders=[order("a")], order_items=[item("a", "s", 10.0)]
    )
    row = one(d.mart_sellers_wide)
    assert (row.total_orders, row.total_revenue, row.avg_delivery_days) == (2, 20, 5.0)


def test_seller_orders_of_facts_are_those_of_items(spark):
    by = ("order_month", "day")
    d = datasets(
        spark,
        orders=[order("a"), order("a"), order("b", order_status="shipped"), order("c", order_delivered_customer_date=None)],
        order_items=[
            *(item("a", s, 2.5 * n, n) for s in ("s", "t") for n in (1, 2)),
            item("b", "s", 7.0), item("c", "t", 3.0), item("none", "t", 4.0), item("a", None, 5.0),
        ],
        order_reviews=[review("a", 4)],
    )
    items = d.stg_order_items.filter("seller_id is not null")
    wanted = sellers_mart.seller_orders(items, day_sums.day_of(d.mart_orders_wide), by)
    facts = day_sums.day_of(followups.seller_facts(d.stg_order_items, d.mart_orders_wide))
    found = sellers_mart.seller_orders_of(facts, by)
    assert found.dtypes == wanted.dtypes
    assert sorted(found.collect()) == sorted(wanted.select(found.columns).collect())
    totals = day_sums.day_sellers(found)
    assert totals.filter("seller_id = 's'").first().revenue == 15
    assert totals._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 1 + facts._jdf.queryExecution().executedPlan().toString().count("Exchange")
