import datetime as dt
from decimal import Decimal

from tests.frames import item, one, order, payment, raw_layer, review
from vitrine.plans.datasets import Datasets


def mart(spark, **tables):
    return Datasets(spark, raw_layer(spark, **tables)).mart_orders_wide


def test_delivery_days_count_midnights_and_keep_their_sign(spark):
    m = mart(
        spark,
        orders=[
            order("a", order_purchase_timestamp="2017-03-10 23:59:59",
                  order_delivered_customer_date="2017-03-11 00:00:01"),
            order("b", order_purchase_timestamp="2017-03-10 08:00:00",
                  order_delivered_customer_date="2017-03-08 09:00:00"),
            order("c", order_delivered_customer_date=None),
        ],
    )
    days = {r.order_id: r.delivery_days for r in m.collect()}
    assert days == {"a": 1, "b": -2, "c": None}


def test_delay_is_never_negative_and_null_without_either_date(spark):
    m = mart(
        spark,
        orders=[
            order("early"),
            order("late", order_delivered_customer_date="2017-03-23 01:00:00"),
            order("transit", order_delivered_customer_date=None),
            order("unpromised", order_estimated_delivery_date=None),
        ],
    )
    got = {r.order_id: (r.delay_days, r.is_on_time) for r in m.collect()}
    assert got == {
        "early": (0, True),
        "late": (3, False),
        "transit": (None, None),
        "unpromised": (None, None),
    }


def test_delivered_during_the_promised_day_has_no_delay_but_is_late(spark):
    row = one(mart(spark, orders=[order("a", order_delivered_customer_date="2017-03-20 10:00:00")]))
    assert (row.delay_days, row.is_on_time) == (0, False)
    row = one(mart(spark, orders=[order("a", order_delivered_customer_date="2017-03-20 00:00:00")]))
    assert (row.delay_days, row.is_on_time) == (0, True)


def test_order_without_items_payments_or_review(spark):
    row = one(mart(spark, orders=[order("a")]))
    zero = Decimal("0.000")
    assert (row.order_revenue, row.order_freight, row.total_payment) == (zero, zero, zero)
    assert row.recognized_revenue == zero
    assert row.items_count == 0
    assert row.review_score is None
    assert (row.customer_city, row.customer_state) == (None, None)


def test_null_prices_count_as_zero_revenue_but_as_items(spark):
    row = one(mart(spark, orders=[order("a")], order_items=[item("a", "s", None)]))
    assert (row.order_revenue, row.items_count) == (Decimal("0.000"), 1)


def test_many_items_and_payments_do_not_multiply_each_other(spark):
    row = one(
        mart(
            spark,
            orders=[order("a")],
            order_items=[item("a", "s", 10.25, n) for n in (1, 2, 3)],
            order_payments=[payment("a", 20.1, 1), payment("a", 13.65, 2)],
            order_reviews=[review("a", 2), review("a", 4, "r2")],
            customers=[{"customer_id": "c-a", "customer_city": "x", "customer_state": "SP"}],
        )
    )
    assert row.order_revenue == Decimal("30.750")
    assert row.order_freight == Decimal("3.000")
    assert row.total_payment == row.recognized_revenue == Decimal("33.750")
    assert (row.items_count, row.review_score, row.customer_state) == (3, 4, "SP")


def test_called_off_orders_bring_no_revenue_and_unknown_status_counts(spark):
    statuses = ["canceled", "unavailable", "delivered", None]
    m = mart(
        spark,
        orders=[order(str(i), order_status=s) for i, s in enumerate(statuses)],
        order_payments=[payment(str(i), 5.0) for i in range(4)],
    )
    got = {r.order_id: r.recognized_revenue for r in m.collect()}
    assert [got[str(i)] for i in range(4)] == [0, 0, 5, 5]
    assert all(r.total_payment == 5 for r in m.collect())


def test_month_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("America/Sao_Paulo", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", name)
            d = Datasets(
                spark,
                raw_layer(spark, orders=[order("a", order_purchase_timestamp="2017-10-31 23:30:00")]),
            )
            assert one(d.mart_orders_wide).order_month == dt.datetime(2017, 10, 1)
            assert one(d.cfo_monthly_revenue).month == "2017-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_row_counts_survive_repeated_reviews_and_coordinates(spark):
    tables = {
        "orders": [order("a"), order("b")],
        "order_reviews": [review("a", 3, f"r{i}") for i in range(20)],
        "geolocation": [{"geolocation_zip_code_prefix": "1", "geolocation_lat": float(i)} for i in range(20)],
    }
    assert mart(spark, **tables).count() == 2


def test_null_order_ids_stay_as_rows_of_zeros(spark):
    m = mart(spark, orders=[order("a") | {"order_id": None}] * 2, order_payments=[payment(None, 9.0)])
    assert [(r.order_id, int(r.total_payment)) for r in m.collect()] == [(None, 0), (None, 0)]
