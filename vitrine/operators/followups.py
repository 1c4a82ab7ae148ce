"""Figures and checks that the requirements name as the next steps after the dashboard."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitrine.functions.dates import calendar_days, day, month_label, month_start
from vitrine.functions.fixed_values import UNRECOGNIZED_STATUSES
from vitrine.functions.numeric import half_away, money_or_zero, money_sum, percent, ratio
from vitrine.operators.kpis import satisfaction_aggregates
from vitrine.operators.orders_mart import best_reviews, delivery_columns, plain_key
from vitrine.operators.quality import result_row
from vitrine.operators.sketch import perhaps_among, perhaps_repeated, sketch_of

# --- quality -----------------------------------------------------------------------------------


def accepted_values_test(df: DataFrame, dataset: str, column: str, accepted: list) -> DataFrame:
    """Failures: distinct values outside the list. Null passes."""
    outside = df.filter(~F.col(column).isin(accepted)).groupBy(column).agg(F.lit(1).alias("seen"))
    counted = outside.agg(F.count("seen").alias("failures"))
    return counted.select(*result_row(dataset, column, "accepted_values", F.col("failures")))


def relationship_test(
    child: DataFrame, dataset: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Failures: rows whose key has no parent. Null passes.

    Keys of both sides are collapsed before the join, so a key with a third of the rows is one
    row in it.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = keys.join(known, column, "left_anti")
    counted = orphans.agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("failures"))
    return counted.select(*result_row(dataset, column, "relationships", F.col("failures")))


def relationship_tests(
    frames: dict[str, DataFrame], tests: list[tuple[str, str, str]]
) -> DataFrame:
    """Many relationship tests at once; each is (child, column, parent), the key named alike in both.

    Every dataset is read once for all its keys. The keys of all are stacked with the place of their
    dataset and counted in one grouping, which combines before its only shuffle, so a key with a third of
    the rows is one row a task in it. A key fails a test by its rows in the child if the parent has none.
    Null passes.
    """
    names = sorted(frames)
    columns: dict[str, list[str]] = {}
    for child, column, parent in tests:
        for name in (child, parent):
            columns.setdefault(name, [])
            if column not in columns[name]:
                columns[name].append(column)
    stacked = [
        frames[name].select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("domain"), F.col(c).alias("key")) for c in own])).alias("k")
        ).select("k.domain", "k.key", F.lit(names.index(name)).alias("dataset"))
        for name, own in columns.items()
    ]
    counts = (
        reduce(DataFrame.unionByName, stacked)
        .filter(F.col("key").isNotNull())
        .groupBy("domain", "key")
        .agg(*[F.count_if(F.col("dataset") == k).alias(f"n{k}") for k in range(len(names))])
    )
    failing = [
        F.when((F.col("domain") == column) & (F.col(f"n{names.index(parent)}") == 0), F.col(f"n{names.index(child)}"))
        for child, column, parent in tests
    ]
    totals = counts.agg(*[F.coalesce(F.sum(f), F.lit(0).cast("long")).alias(f"f{k}") for k, f in enumerate(failing)])
    rows = [
        F.struct(F.lit(child).alias("dataset"), F.lit(column).alias("column"), F.col(f"f{k}").alias("failures"))
        for k, (child, column, _) in enumerate(tests)
    ]
    return totals.select(F.inline(F.array(*rows))).select(
        "dataset",
        "column",
        F.lit("relationships").alias("test"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def repeated_reviews(reviews: DataFrame) -> DataFrame:
    """Review ids that occur more than once, and how far their rows agree."""
    per_order = reviews.groupBy("review_id", "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("review_score").alias("low"),
        F.max("review_score").alias("high"),
        F.min("review_created_at").alias("first"),
        F.max("review_created_at").alias("last"),
    )
    return (
        per_order.groupBy("review_id")
        .agg(
            F.sum("rows").alias("copies"),
            F.count("order_id").alias("orders"),
            (F.min("low") == F.max("high")).alias("same_score"),
            F.min("first").alias("first_created_at"),
            F.max("last").alias("last_created_at"),
        )
        .filter(F.col("copies") > 1)
    )


def dated_pairs(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """Pairs of a review (made at reviewed_at) and an order with the order's dates and how far apart they are."""
    dates = orders.groupBy("order_id").agg(
        F.min("order_purchase_at").alias("purchased_at"), F.min("order_delivered_customer_at").alias("delivered_at")
    )
    own = pairs.join(plain_key(dates, "order_id", "dated"), F.col("order_id") == F.col("dated"), "left").drop("dated")
    before = F.coalesce(F.col("delivered_at") <= F.col("reviewed_at"), F.lit(False))
    nearest = F.abs(calendar_days(F.when(before, F.col("delivered_at")).otherwise(F.col("purchased_at")), F.col("reviewed_at")))
    return own.withColumn("after_delivery", before).withColumn("days_apart", nearest)


def review_order_match(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """For each review id under several orders its candidate orders, and which fits best.

    A review is asked for after delivery. So the best candidate is the one delivered last before the
    review was made; if none was, the one bought nearest to it. It is clear if it was delivered
    before and no other candidate is as near in days. One row a review id and order; equal
    candidates are ordered by id.
    """
    pairs = perhaps_repeated(reviews.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull()), "review_id")
    pairs = pairs.groupBy("review_id", "order_id").agg(F.min("review_created_at").alias("reviewed_at"))
    several = pairs.groupBy("review_id").agg(F.count("order_id").alias("candidates")).filter("candidates > 1")
    own = pairs.join(plain_key(several, "review_id", "of"), F.col("review_id") == F.col("of"), "left_semi")
    own = dated_pairs(own, perhaps_among(orders, "order_id", sketch_of(own, "order_id")))
    rank = F.struct((~F.col("after_delivery")).alias("late"), F.coalesce("days_apart", F.lit(2**40)).alias("apart"))
    ties = own.groupBy("review_id", rank.alias("rank")).agg(F.count("order_id").alias("n"), F.min("order_id").alias("least"))
    best = ties.groupBy("review_id").agg(F.min(F.struct("rank", "least", "n")).alias("best"))
    return own.join(plain_key(best, "review_id", "of"), F.col("review_id") == F.col("of")).select(
        "review_id",
        "order_id",
        "purchased_at",
        "delivered_at",
        "reviewed_at",
        "after_delivery",
        "days_apart",
        (F.col("order_id") == F.col("best.least")).alias("is_best"),
        (~F.col("best.rank.late") & (F.col("best.n") == 1)).alias("is_clear"),
    )


# --- customers ---------------------------------------------------------------------------------


def customers_mart(customers: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """One row a person: first and last purchase, cohort month, whether they came back.

    Accounts that name no person are left out, as in the cohorts. Accounts without an id have no
    orders and are not joined.
    """
    people = customers.filter(F.col("customer_unique_id").isNotNull()).select("customer_unique_id", "customer_id")
    account = F.col("customer_id")
    per_account = orders_mart.filter(account.isNotNull()).groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        money_sum("recognized_revenue").alias("revenue"),
        F.min("purchased_at").alias("first"),
        F.max("purchased_at").alias("last"),
    )
    return (
        people.filter(account.isNotNull())
        .join(per_account, "customer_id", "left")
        .unionByName(people.filter(account.isNull()), allowMissingColumns=True)
        .groupBy("customer_unique_id")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.min("first").alias("first_purchase_at"),
            F.max("last").alias("last_purchase_at"),
        )
        .select(
            "customer_unique_id",
            F.coalesce("orders", F.lit(0).cast("long")).alias("total_orders"),
            money_or_zero("revenue").alias("total_revenue"),
            "first_purchase_at",
            "last_purchase_at",
            month_start(F.col("first_purchase_at")).alias("cohort_month"),
            F.coalesce(F.col("orders") > 1, F.lit(False)).alias("is_repeat"),
        )
    )


def customer_cohorts(customers: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """For each cohort month: customers, orders and revenue by months since the first purchase.

    A person has at most one row a month when the first month is looked up over them, so the
    window stays small whoever buys most.
    """
    per_account = (
        orders_mart.filter(F.col("order_month").isNotNull())
        .groupBy("customer_id", "order_month")
        .agg(F.count("order_id").alias("orders"), money_sum("recognized_revenue").alias("revenue"))
    )
    active = (
        per_account.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .filter(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id", "order_month")
        .agg(F.sum("orders").alias("orders"), money_sum("revenue").alias("revenue"))
        .withColumn("first", F.min("order_month").over(W.partitionBy("customer_unique_id")))
    )

    def months(of: str) -> Column:
        return F.year(of) * 12 + F.month(of)

    return (
        active.withColumn("months_since", (months("order_month") - months("first")).cast("long"))
        .groupBy("first", "months_since")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("orders").alias("orders"),
            money_sum("revenue").alias("revenue"),
        )
        .select(month_label(F.col("first")).alias("cohort"), "months_since", "customers", "orders", "revenue")
    )


def repeat_purchase(customers: DataFrame, orders_mart: DataFrame, last_day: dt.date) -> DataFrame:
    """The share of people who have come back by each day after their first purchase.

    A person is watched from their first purchase to `last_day`; who has not bought again by then has only
    been watched for so long. The product-limit estimate takes that in: on each day on which somebody came
    back, the share still away is multiplied by the part of those watched that did not. Purchases after the
    last day do not count. The product runs over the days in order, so it has one value whatever the
    partitioning.
    """
    bought = orders_mart.filter(F.col("purchased_at") < day(last_day + dt.timedelta(days=1)))
    people = customers.filter(F.col("customer_unique_id").isNotNull()).select("customer_id", "customer_unique_id")
    bought = bought.select("customer_id", "purchased_at").join(
        plain_key(people, "customer_id", "account"), F.col("customer_id") == F.col("account")
    )
    # two rows a person are all that leaves a task, whoever buys most
    place = F.row_number().over(W.partitionBy("customer_unique_id").orderBy("purchased_at"))
    firsts = bought.withColumn("place", place).filter(F.col("place") <= 2)
    watched = firsts.groupBy("customer_unique_id").agg(
        F.min("purchased_at").alias("first"), F.max("purchased_at").alias("second"), (F.count("*") > 1).alias("back")
    )
    until = F.when(F.col("back"), F.col("second")).otherwise(day(last_day))
    by_day = (
        watched.select(calendar_days(F.col("first"), until).alias("days"), F.col("back").cast("long").alias("back"))
        .groupBy("days")
        .agg(F.count("*").alias("left"), F.sum("back").alias("came_back"))
    )
    # one row a day of the longest watch, in one array: a few thousand at most
    days = by_day.agg(F.sort_array(F.collect_list(F.struct("days", "left", "came_back"))).alias("by_day"), F.sum("left").alias("people"))
    run = F.aggregate(
        "by_day",
        F.struct(
            F.col("people").alias("at_risk"),
            F.lit(1.0).alias("away"),
            F.array().cast("array<struct<days:bigint,at_risk:bigint,came_back:bigint,away:double>>").alias("done"),
        ),
        lambda acc, x: F.struct(
            (acc["at_risk"] - x["left"]).alias("at_risk"),
            (acc["away"] * ratio(acc["at_risk"] - x["came_back"], acc["at_risk"])).alias("away"),
            F.array_append(
                acc["done"],
                F.struct(
                    x["days"].alias("days"),
                    acc["at_risk"].alias("at_risk"),
                    x["came_back"].alias("came_back"),
                    (acc["away"] * ratio(acc["at_risk"] - x["came_back"], acc["at_risk"])).alias("away"),
                ),
            ).alias("done"),
        ),
    )["done"]
    return (
        days.select(F.inline(run))
        .filter(F.col("came_back") > 0)
        .select(
            F.col("days").alias("days_since_first"),
            "at_risk",
            "came_back",
            half_away(F.lit(100.0) * (F.lit(1.0) - F.col("away")), 4).alias("came_back_pct"),
        )
    )


# --- categories --------------------------------------------------------------------------------


def category_sales(
    items: DataFrame, orders_mart: DataFrame, products: DataFrame, translation: DataFrame, by: list[str]
) -> DataFrame:
    """Item revenue by category in English, else in the original, of orders that were not called off.

    `by` adds order_month or nothing. Items are summed by product and order, then by product, before
    each join. A product or a category that is listed twice counts once: its least name holds.
    """
    valid = orders_mart.filter(
        F.coalesce(~F.col("order_status").isin(UNRECOGNIZED_STATUSES), F.lit(True))
    )
    months = [F.min(c).alias(c) for c in by]
    valid = valid.groupBy("order_id").agg(*months) if months else valid.select("order_id").distinct()
    category = products.groupBy("product_id").agg(F.min("product_category_name").alias("product_category_name"))
    english = translation.groupBy("product_category_name").agg(F.min("product_category_name_english").alias("english"))

    def summed(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key, *by).agg(money_sum("price").alias("price"), F.sum("items").alias("items"))

    sold = items.groupBy("product_id", "order_id").agg(
        F.sum("item_price").alias("price"), F.count("order_item_id").alias("items")
    )
    sold = summed(sold.join(valid, "order_id"), "product_id")
    named = summed(sold.join(category, "product_id", "left"), "product_category_name")
    named = named.join(english, "product_category_name", "left")
    named = named.withColumn("category", F.coalesce("english", "product_category_name"))
    return named.groupBy("category", *by).agg(
        money_sum("price").alias("revenue"), F.sum("items").alias("items_count")
    )


def category_revenue(items: DataFrame, orders_mart: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    return category_sales(items, orders_mart, products, translation, [])


def category_monthly_revenue(
    items: DataFrame, orders_mart: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """Category revenue by month of purchase."""
    sales = category_sales(items, orders_mart, products, translation, ["order_month"])
    return sales.select(month_label(F.col("order_month")).alias("month"), "category", "revenue", "items_count")


# --- slices ------------------------------------------------------------------------------------


def purchased_between(orders_mart: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Orders bought from the first to the last day, both included.

    The bound on the month is implied; it lets a stored mart skip month partitions.
    """
    end = last + dt.timedelta(days=1)
    bought, month = F.col("purchased_at"), F.col("order_month")
    return orders_mart.filter(
        (bought >= day(first))
        & (bought < day(end))
        & (month >= day(first.replace(day=1)))
        & (month < day(end))
    )


def seller_facts(items: DataFrame, orders_mart: DataFrame, copies: bool = True) -> DataFrame:
    """What every seller sold, with the month of the order: one row a seller and copy of an order.

    Items without a seller are left out. The others meet their orders one by one, in a join that adaptive
    execution can split on either side, and are dealt out by ranges of FACT_KEYS. Only there are they summed,
    as this shuffle serves the sums too; so an item is shuffled twice, and the items of an order
    lie side by side in the first. `copies`: not where ids of orders are known to be unique, so
    that none needs a number.
    """
    counted = F.when(F.col("order_item_id").isNotNull(), 1).alias("order_item_id")  # one value for all compresses
    sold = items.filter(F.col("seller_id").isNotNull()).select(
        "seller_id", F.col("order_id").alias("sold_in"), counted, "item_price"
    )
    own = ["order_id", "order_month", *_HISTORY, *_DELIVERY, "review_score"]
    number = F.monotonically_increasing_id() if copies else F.lit(0)
    orders = orders_mart.select(*own, number.alias("copy"))
    # times last, beside the ids that follow the fixed columns of a row: what varies in one run compresses better
    columns = ["seller_id", *own, "copy", "order_item_id", "item_price"]
    columns.append(columns.pop(columns.index("purchased_at")))
    rows = orders.join(sold, F.col("order_id") == F.col("sold_in")).select(*columns)
    return _sums_of(rows.repartitionByRange(*FACT_KEYS).groupBy("seller_id", *own, "copy")).select(
        "order_month", "seller_id", "order_id", *_HISTORY, *_SOLD, *_DELIVERY, "review_score"
    )


def sold_orders(top: DataFrame, items: DataFrame) -> DataFrame:
    """What the sellers in `top`, a leaderboard of few rows, sold: one row a seller and order."""
    return _sold(items.join(top.select("seller_id").distinct(), "seller_id", "left_semi"))


def _sold(items: DataFrame) -> DataFrame:
    return _sums_of(items.groupBy("seller_id", "order_id"))


def _sums_of(items: GroupedData) -> DataFrame:
    return items.agg(money_sum("item_price").alias("seller_revenue"), F.count("order_item_id").alias("seller_items"))


FACT_KEYS = ["order_month", "seller_id", "order_id"]
_HISTORY = ["purchased_at", "order_status"]
_SOLD = ["seller_revenue", "seller_items"]
_DELIVERY = ["delivery_days", "delay_days", "is_on_time"]


def seller_history(sold: DataFrame, orders_mart: DataFrame) -> DataFrame:
    """The sold orders in a stored mart: one row a seller and copy of an order."""
    own = plain_key(sold, "order_id", "sold_in")
    return orders_mart.join(own, F.col("order_id") == F.col("sold_in")).select(
        "seller_id", "order_id", *_HISTORY, *_SOLD, *_DELIVERY, "review_score"
    )


def seller_history_from(sold: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The same from staged tables, of which only the sold orders are taken: no mart is computed."""
    scored = best_reviews(reviews.join(sold.select("order_id").distinct(), "order_id", "left_semi"))
    bought = orders.select("order_id", F.col("order_purchase_at").alias("purchased_at"), "order_status", *delivery_columns())
    return seller_history(sold.join(scored, "order_id", "left"), bought)


def state_delivery(orders_mart: DataFrame) -> DataFrame:
    on_time = F.col("is_on_time")
    known = orders_mart.filter(on_time.isNotNull())

    def mean(column: str) -> Column:
        return half_away(ratio(F.sum(column), F.count(column)), 1)

    return known.groupBy("customer_state").agg(
        F.count(on_time).alias("deliveries"),
        percent(F.sum(on_time.cast("int")), F.count(on_time), 1).alias("on_time_pct"),
        mean("delivery_days").alias("avg_delivery_days"),
        mean("delay_days").alias("avg_delay_days"),
    )


def state_delivery_map(states: DataFrame, centres: DataFrame) -> DataFrame:
    """Delivery of the states that have a centre. The centres are 27 fixed rows."""
    named = states.withColumnRenamed("customer_state", "state")
    return named.join(F.broadcast(centres), "state").select(
        "state", "deliveries", "on_time_pct", "avg_delivery_days", "avg_delay_days", "lat", "lon"
    )


# --- satisfaction and partners -----------------------------------------------------------------


def state_satisfaction(orders_mart: DataFrame) -> DataFrame:
    reviewed = orders_mart.filter(F.col("review_score").isNotNull())
    return reviewed.groupBy("customer_state").agg(
        F.count("review_score").alias("reviews"), *satisfaction_aggregates()
    )


def delay_by_score(orders_mart: DataFrame) -> DataFrame:
    rows = orders_mart.filter(F.col("review_score").isNotNull() & F.col("delay_days").isNotNull())
    return rows.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("orders"),
        half_away(ratio(F.sum("delay_days"), F.count("delay_days")), 2).alias("avg_delay_days"),
    )


def score_delay_correlation(orders_mart: DataFrame) -> DataFrame:
    """Pearson correlation of review score and delay, from exact integer sums.

    Unlike a merged running covariance it has one value whatever the partitioning.
    """
    x, y = F.col("review_score").cast("long"), F.col("delay_days")
    rows = orders_mart.filter(x.isNotNull() & y.isNotNull())

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.coalesce(F.sum(value), F.lit(0).cast("long")).alias(name)
            for name, value in {"x": x, "y": y, "xy": x * y, "xx": x * x, "yy": y * y}.items()
        ],
    )
    cross = exact("n") * exact("xy") - exact("x") * exact("y")
    spread = [
        F.sqrt((exact("n") * exact(f"{v}{v}") - exact(v) * exact(v)).cast("double")) for v in "xy"
    ]
    return sums.select(
        F.col("n").alias("orders"), ratio(cross, spread[0] * spread[1]).alias("correlation")
    )


def underperforming_sellers(
    sellers_mart: DataFrame, least_on_time: float, least_score: float
) -> DataFrame:
    """Active sellers below either bound."""
    active = sellers_mart.filter(F.col("total_orders") > 0)
    late = F.col("on_time_pct") < least_on_time
    poor = F.col("avg_review_score") < least_score
    return active.filter(late | poor).select(
        "seller_id",
        "seller_state",
        "total_orders",
        "on_time_pct",
        "avg_review_score",
        F.coalesce(late, F.lit(False)).alias("is_late"),
        F.coalesce(poor, F.lit(False)).alias("is_poorly_rated"),
    )
