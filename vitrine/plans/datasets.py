"""Every dataset by name, composed from the ones it is built on."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.fixed_values import INCOMPLETE_YEARS, ORDER_STATUSES, REVIEW_SCORES
from vitrine.operators import assignment, cards, day_sums, followups, kpis, orders_mart, quality, sellers_mart, staging
from vitrine.sources.marts import MartStore
from vitrine.sources.raw import RawReader
from vitrine.sources.readonly import read_only
from vitrine.sources.states import state_centres


class Datasets:
    """Lazy datasets over one raw layer.

    With a `store` the marts are read from it, as a dashboard does; without one they are part of
    the plan, as far as a figure needs them. `days` (first, last) keeps to the orders bought in a
    range of days; the sellers mart is then computed over those.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: RawReader,
        store: MartStore | None = None,
        as_of: dt.date | None = None,
        exclude_years: Iterable[int] = INCOMPLETE_YEARS,
        days: tuple[dt.date, dt.date] | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.store = store
        self.days = days
        self.orders_with = cache(self._orders_with)
        self.window = {"as_of": as_of, "exclude_years": tuple(exclude_years)}

    def __getitem__(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw(name.removeprefix("raw_"))
        return getattr(self, name)

    def query(self, sql: str, **values: object) -> DataFrame:
        """Read-only SQL over the marts and the staging views, each named in braces."""
        names = [n for n in dir(type(self)) if n.startswith(("stg_", "mart_"))]
        return read_only(self.spark, sql, {n: (lambda n=n: self[n]) for n in names}, values)

    # staging

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.orders(self.raw("orders"))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.order_items(self.raw("order_items"))

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.order_payments(self.raw("order_payments"))

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.order_reviews(self.raw("order_reviews"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.customers(self.raw("customers"))

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.sellers(self.raw("sellers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.products(self.raw("products"))

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return staging.category_translation(self.raw("category_translation"))

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.geolocation(self.raw("geolocation"))

    # marts and their parts

    @cached_property
    def order_items_agg(self) -> DataFrame:
        return orders_mart.item_totals(self.stg_order_items)

    @cached_property
    def payments_agg(self) -> DataFrame:
        return orders_mart.payment_totals(self.stg_order_payments)

    @cached_property
    def reviews_agg(self) -> DataFrame:
        return orders_mart.best_reviews(self.stg_order_reviews)

    @cached_property
    def delivery_metrics(self) -> DataFrame:
        return orders_mart.delivery_metrics(self.stg_orders)

    @cached_property
    def recognized_revenue(self) -> DataFrame:
        return orders_mart.recognized_revenue(self.stg_orders, self.stg_order_payments)

    @cached_property
    def _sums(self) -> dict[str, DataFrame] | None:
        """The stored sums of the range by state and by seller, if there are a range and a store."""
        if not (self.store and self.days):
            return None
        table = self.store.sums
        return {
            by: day_sums.in_range(table(f"month_{by}"), table(f"day_{by}"), *self.days) for by in ("states", "sellers")
        }

    def _orders_with(self, *totals: str) -> DataFrame:
        """The orders mart with the columns that these totals fill (items, payments, reviews)."""
        if self.store:
            mart = self.store.orders()
        else:
            tables = {
                "items": lambda: self.stg_order_items,
                "payments": lambda: self.stg_order_payments,
                "reviews": lambda: self.stg_order_reviews,
            }
            mart = orders_mart.orders_mart(self.stg_orders, self.stg_customers, **{t: tables[t]() for t in totals})
        return followups.purchased_between(mart, *self.days) if self.days else mart

    @property
    def mart_orders_wide(self) -> DataFrame:
        return self.orders_with("items", "payments", "reviews")

    @cached_property
    def seller_orders(self) -> DataFrame:
        return sellers_mart.seller_orders(self.stg_order_items, self.orders_with("reviews"))

    @cached_property
    def mart_sellers_wide(self) -> DataFrame:
        if self._sums:
            places = self.store.sellers().select(
                "seller_id", F.col("seller_city").alias("city"), F.col("seller_state").alias("state")
            )
            totals = day_sums.added_totals(self._sums["sellers"], ["seller_id"])
            return sellers_mart.sellers_from_totals(places, totals)
        if self.store:
            return self.store.sellers()
        return sellers_mart.sellers_mart(self.stg_sellers, self.seller_orders)

    # executive figures

    @cached_property
    def cfo_monthly_revenue(self) -> DataFrame:
        if self._sums:
            return day_sums.monthly_revenue(self._sums["states"], **self.window)
        return kpis.monthly_revenue(self.orders_with("payments"), **self.window)

    @cached_property
    def coo_monthly_delivery(self) -> DataFrame:
        if self._sums:
            return day_sums.monthly_delivery(self._sums["states"], **self.window)
        return kpis.monthly_delivery(self.orders_with(), **self.window)

    @cached_property
    def cx_monthly_reviews(self) -> DataFrame:
        if self._sums:
            return day_sums.monthly_reviews(self._sums["states"], **self.window)
        return kpis.monthly_reviews(self.orders_with("reviews"), **self.window)

    @cached_property
    def cx_review_volume(self) -> DataFrame:
        return kpis.monthly_review_volume(self.orders_with("reviews"), **self.window)

    @cached_property
    def coo_monthly_delay(self) -> DataFrame:
        return kpis.monthly_delay(self.orders_with(), **self.window)

    @cached_property
    def top_sellers(self) -> DataFrame:
        return kpis.top_sellers(self.mart_sellers_wide)

    @cached_property
    def state_revenue(self) -> DataFrame:
        if self._sums:
            return day_sums.state_revenue(self._sums["states"])
        return kpis.state_revenue(self.orders_with("payments"))

    @cached_property
    def state_revenue_map(self) -> DataFrame:
        return kpis.state_revenue_map(self.state_revenue, state_centres(self.spark))

    @cached_property
    def kpi_finance(self) -> DataFrame:
        return kpis.finance_headline(self.cfo_monthly_revenue)

    @cached_property
    def kpi_delivery(self) -> DataFrame:
        return kpis.delivery_headline(self.coo_monthly_delivery)

    @cached_property
    def kpi_satisfaction(self) -> DataFrame:
        return kpis.satisfaction_headline(self.cx_monthly_reviews)

    @cached_property
    def kpi_top_seller(self) -> DataFrame:
        return kpis.top_seller_headline(self.mart_sellers_wide)

    @cached_property
    def kpi_active_sellers(self) -> DataFrame:
        return kpis.active_sellers_headline(self.mart_sellers_wide)

    # presentation

    @cached_property
    def kpi_cards(self) -> DataFrame:
        if self._sums:
            orders = day_sums.orders_headline(self._sums["states"], **self.window)
        else:
            orders = kpis.orders_headline(self.orders_with("payments", "reviews"), **self.window)
        return cards.kpi_cards(orders, kpis.sellers_headline(self.mart_sellers_wide))

    @cached_property
    def cfo_chart(self) -> DataFrame:
        return cards.revenue_chart(self.cfo_monthly_revenue)

    @cached_property
    def top_sellers_chart(self) -> DataFrame:
        return cards.sellers_chart(self.top_sellers)

    # quality

    @cached_property
    def dq_unique(self) -> DataFrame:
        return quality.run_tests(self.__getitem__, quality.unique_test)

    @cached_property
    def dq_not_null(self) -> DataFrame:
        return quality.run_tests(self.__getitem__, quality.not_null_test)

    @cached_property
    def dq_suite(self) -> DataFrame:
        return quality.run_tests(self.__getitem__, quality.key_tests)

    @cached_property
    def granularity_audit(self) -> DataFrame:
        return quality.granularity_audit(self.raw)

    # next steps

    @cached_property
    def dq_accepted_values(self) -> DataFrame:
        test = followups.accepted_values_test
        return quality.union_all(
            [
                test(self.stg_orders, "stg_orders", "order_status", ORDER_STATUSES),
                test(self.stg_order_reviews, "stg_order_reviews", "review_score", REVIEW_SCORES),
            ]
        )

    @cached_property
    def dq_relationships(self) -> DataFrame:
        frames = {
            "mart_orders_wide": self.orders_with(),
            "mart_sellers_wide": self.mart_sellers_wide,
            **{n: self[n] for n in ("stg_orders", "stg_customers", "stg_sellers", "stg_order_items")},
        }
        return followups.relationship_tests(
            frames,
            [
                ("mart_orders_wide", "order_id", "stg_orders"),
                ("mart_orders_wide", "customer_id", "stg_customers"),
                ("mart_sellers_wide", "seller_id", "stg_sellers"),
                ("stg_order_items", "order_id", "mart_orders_wide"),
                ("stg_order_items", "seller_id", "mart_sellers_wide"),
            ],
        )

    @cached_property
    def repeated_reviews(self) -> DataFrame:
        return followups.repeated_reviews(self.stg_order_reviews)

    @cached_property
    def mart_customers_wide(self) -> DataFrame:
        return followups.customers_mart(self.stg_customers, self.orders_with("payments"))

    @cached_property
    def customer_cohorts(self) -> DataFrame:
        return followups.customer_cohorts(self.stg_customers, self.orders_with("payments"))

    def repeat_purchase(self, last_day: dt.date) -> DataFrame:
        return followups.repeat_purchase(self.stg_customers, self.orders_with(), last_day)

    @cached_property
    def category_revenue(self) -> DataFrame:
        return followups.category_revenue(*self._category_inputs())

    @cached_property
    def category_monthly_revenue(self) -> DataFrame:
        return followups.category_monthly_revenue(*self._category_inputs())

    def _category_inputs(self) -> list[DataFrame]:
        return [self.stg_order_items, self.orders_with(), self.stg_products, self.stg_category_translation]

    def between(self, first: dt.date, last: dt.date) -> Datasets:
        """The same datasets over the orders bought in a range of days."""
        return Datasets(self.spark, self.raw, self.store, **self.window, days=(first, last))

    def seller_history(self, seller_id: str) -> DataFrame:
        """What one seller sold, from a store; of its files only those that may hold the seller are opened."""
        return self.store.facts_of(seller_id)

    @cached_property
    def leader_history(self) -> DataFrame:
        if self.store and not self.days:
            first = kpis.leaders(self.mart_sellers_wide, 1).select("seller_id").first()
            return self.seller_history(first.seller_id if first else "")
        sold = followups.sold_orders(kpis.leaders(self.mart_sellers_wide, 1), self.stg_order_items)
        if self.store or self.days:
            return followups.seller_history(sold, self.orders_with("reviews"))
        return followups.seller_history_from(sold, self.stg_orders, self.stg_order_reviews)

    @cached_property
    def review_order_match(self) -> DataFrame:
        return followups.review_order_match(self.stg_order_reviews, self.stg_orders)

    def review_assignment(self, folder: str) -> DataFrame:
        """`folder`: a shared one for the tables between rounds."""

        def keep(df: DataFrame, name: str) -> DataFrame:
            path = f"{folder}/{name}-{uuid.uuid4().hex}"
            df.write.parquet(path)
            return df.sparkSession.read.schema(df.schema).parquet(path)

        return assignment.review_assignment(
            self.stg_order_reviews, self.stg_orders, self.stg_order_items, self.stg_products, keep
        )

    @cached_property
    def state_delivery(self) -> DataFrame:
        return followups.state_delivery(self.orders_with())

    @cached_property
    def state_delivery_map(self) -> DataFrame:
        return followups.state_delivery_map(self.state_delivery, state_centres(self.spark))

    @cached_property
    def state_satisfaction(self) -> DataFrame:
        return followups.state_satisfaction(self.orders_with("reviews"))

    @cached_property
    def delay_by_score(self) -> DataFrame:
        return followups.delay_by_score(self.orders_with("reviews"))

    @cached_property
    def score_delay_correlation(self) -> DataFrame:
        return followups.score_delay_correlation(self.orders_with("reviews"))

    def underperforming_sellers(self, least_on_time: float, least_score: float) -> DataFrame:
        return followups.underperforming_sellers(self.mart_sellers_wide, least_on_time, least_score)
