import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.frames import one, order, payment, raw_layer, review
from vitrine.functions.numeric import half_away, python_round
from vitrine.functions.text import dotted, reais, seller_caption, with_unit
from vitrine.operators import cards, kpis
from vitrine.plans.datasets import Datasets
from vitrine.sources.schemas import SELLERS_MART
from vitrine.sources.states import state_centres


def monthly(spark, rows, **window):
    """rows: (key, purchase month, payment, score, on time)"""
    orders, payments, reviews = [], [], []
    for key, month, paid, score, on_time in rows:
        delivered = {True: f"{month}-12 00:00:00", False: f"{month}-27 00:00:00", None: None}[on_time]
        orders.append(
            order(
                key,
                order_purchase_timestamp=f"{month}-02 10:00:00",
                order_delivered_customer_date=delivered,
                order_estimated_delivery_date=f"{month}-20 00:00:00",
            )
        )
        if paid is not None:
            payments.append(payment(key, paid))
        if score is not None:
            reviews.append(review(key, score))
    layer = raw_layer(spark, orders=orders, order_payments=payments, order_reviews=reviews)
    return Datasets(spark, layer, **window)


def test_window_drops_the_open_month_and_excluded_years(spark):
    rows = [(m, m, 10.0, 5, True) for m in ("2015-12", "2016-01", "2016-12", "2017-01", "2017-02", "2017-03")]
    d = monthly(spark, rows, as_of=dt.date(2017, 3, 1))
    for series in (d.cfo_monthly_revenue, d.coo_monthly_delivery, d.cx_monthly_reviews, d.cx_review_volume):
        assert [r.month for r in series.collect()] == ["2015-12", "2017-01", "2017-02"]
    # places take all months
    assert one(d.state_revenue).orders == 6


def test_month_without_purchase_date_drops_out(spark):
    layer = raw_layer(spark, orders=[order("a", order_purchase_timestamp=None)])
    d = Datasets(spark, layer)
    assert d.cfo_monthly_revenue.count() == 0
    assert d.mart_orders_wide.count() == 1


def test_aov_of_a_month_skips_zero_orders_and_the_headline_does_not(spark):
    d = monthly(spark, [("a", "2017-01", 30.0, None, None), ("b", "2017-01", None, None, None)])
    month = one(d.cfo_monthly_revenue)
    assert (month.revenue, month.orders, month.aov) == (Decimal("30.000"), 2, 30.0)
    assert one(d.kpi_finance).aov == 15.0


def test_headlines_are_plain_means_of_rounded_months(spark):
    rows = [
        ("a", "2017-01", 1.0, 5, True),
        ("b", "2017-02", 1.0, 1, True),
        ("c", "2017-02", 1.0, 2, False),
        ("d", "2017-02", 1.0, 2, False),
        ("e", "2017-03", 1.0, None, None),
    ]
    d = monthly(spark, rows)
    delivery, reviews = one(d.kpi_delivery), one(d.kpi_satisfaction)
    assert delivery.on_time_pct == pytest.approx((100.0 + 33.3) / 2)
    assert delivery.avg_delivery_days == pytest.approx((10.0 + 20.0) / 2)
    assert reviews.avg_score == pytest.approx((5.0 + 1.67) / 2)
    assert reviews.csat_pct == pytest.approx(50.0)
    # one pass over the mart gives the same figures as the four series
    fused = one(kpis.orders_headline(d.mart_orders_wide))
    for source in (delivery, reviews, one(d.kpi_finance)):
        for name, value in source.asDict().items():
            assert fused[name] == value


def test_delay_and_volume(spark):
    rows = [("a", "2017-01", 1.0, 5, True), ("b", "2017-01", 1.0, None, False), ("c", "2017-01", 1.0, 4, None)]
    d = monthly(spark, rows)
    assert one(d.coo_monthly_delay).avg_delay_days == 3.5
    assert one(d.cx_review_volume).reviews == 2


def test_empty_marts_give_zeros(spark):
    d = Datasets(spark, raw_layer(spark))
    assert tuple(one(d.kpi_finance)) == (0, 0, 0.0)
    assert tuple(one(d.kpi_delivery)) == (0.0, 0.0)
    assert tuple(one(d.kpi_satisfaction)) == (0.0, 0.0)
    assert tuple(one(d.kpi_top_seller)) == (0,)
    assert tuple(one(d.kpi_active_sellers)) == (0,)
    card = one(d.kpi_cards)
    assert card.kpi_revenue == card.kpi_aov == card.kpi_top_seller_rev == "R$ 0,00"
    assert (card.kpi_orders, card.kpi_on_time, card.kpi_avg_delivery) == ("0", "0.0%", "0.0 days")
    assert (card.kpi_avg_score, card.kpi_csat, card.kpi_active_sellers) == ("0.00 / 5", "0.0%", "0")


def sellers_mart(spark, rows):
    """rows: (seller, state, revenue, orders, on time, score)"""
    full = [(s, "c", st, o, o, Decimal(r), 1.0, 1.0, 0.0, t, sc, 1) for s, st, r, o, t, sc in rows]
    return spark.createDataFrame(full, SELLERS_MART)


def test_top_sellers_cut_ties_by_id_and_skip_zero_revenue(spark):
    rows = [(f"seller-{i:02d}", "SP", 100, 1, 50.0, 3.0) for i in range(12)]
    rows += [("zero", "SP", 0, 1, 50.0, 3.0), ("first", None, 200, 1, None, None)]
    mart = sellers_mart(spark, rows)
    top = kpis.top_sellers(mart).collect()
    assert len(top) == 10
    assert (top[0].seller_label, top[0].total_revenue) == ("first", 200)
    assert [r.seller_label for r in top[1:3]] == ["seller-0", "seller-0"]
    chart = cards.sellers_chart(kpis.top_sellers(mart)).collect()
    assert tuple(chart[0]) == ("first... (None)", 200.0, 0.0, 0.0)
    assert one(kpis.top_seller_headline(mart)).top_seller_revenue == 200
    assert one(kpis.active_sellers_headline(mart)).active_sellers == 14


def test_map_keeps_known_states_only(spark):
    states = spark.createDataFrame(
        [("SP", Decimal("10.125"), 2), ("ZZ", Decimal("1.000"), 1), (None, Decimal("1.000"), 1)],
        "customer_state string, revenue decimal(38,3), orders bigint",
    )
    got = kpis.state_revenue_map(states, state_centres(spark)).collect()
    assert [tuple(r) for r in got] == [("SP", 10.12, 2, -23.55, -46.64)]
    assert state_centres(spark).count() == 27


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize("x, digits, expected", [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-0.25, 1, -0.3)])
def test_half_away(spark, x, digits, expected):
    assert value(spark, half_away(F.lit(x), digits)) == expected


@pytest.mark.parametrize("x", [66.35, 66.25, 66.45, 0.15, 0.05, 99.95, 1234.25, -12.25, 2.675])
def test_python_round(spark, x):
    assert value(spark, python_round(F.lit(x), 1)) == round(x, 1)
    assert value(spark, python_round(F.lit(x), 2)) == round(x, 2)


@pytest.mark.parametrize("x", [0.0, 0.125, 1234567.895, 999.995, 12.5])
def test_texts_equal_the_dashboard_formats(spark, x):
    brl = f"R$ {x:,.2f}".translate(str.maketrans(",.", ".,"))
    assert value(spark, reais(F.lit(x))) == brl
    assert value(spark, with_unit(F.lit(x), 1, "%")) == f"{x:.1f}%"
    assert value(spark, with_unit(F.lit(x), 2, " / 5")) == f"{x:.2f} / 5"
    assert value(spark, reais(F.lit(Decimal(str(x))))) == f"R$ {Decimal(str(x)):,.2f}".translate(str.maketrans(",.", ".,"))
    assert value(spark, dotted(F.lit(int(x)))) == f"{int(x):,}".replace(",", ".")


def test_caption(spark):
    assert value(spark, seller_caption(F.lit("12345678"), F.lit("SP"))) == "12345678... (SP)"
