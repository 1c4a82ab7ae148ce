"""Reviews that stand under several orders, given one order each, so that no order has two of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.followups import dated_pairs
from vitrine.operators.orders_mart import plain_key
from vitrine.operators.sketch import perhaps_among, perhaps_repeated, sketch_of

Keep = Callable[[DataFrame, str], DataFrame]

LEAST_LETTERS = 4  # of a word of a category's name that a review may use


def candidates(
    reviews: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, keep: Keep = lambda df, name: df
) -> DataFrame:
    """The pairs that compete: all reviews of the orders that some review under several orders names.

    A pair is better if the order was delivered before the review, then if the review uses a word of the
    name of a category that was bought, then by days between them.

    These orders are few. Rows of reviews, orders and items that a sketch of them rules out are not shuffled.
    """
    named = reviews.filter(F.col("review_id").isNotNull() & F.col("order_id").isNotNull())
    known = perhaps_repeated(named, "review_id").select("review_id", "order_id").distinct()
    several = known.groupBy("review_id").agg(F.count("*").alias("n")).filter("n > 1").select("review_id")
    wanted = known.join(plain_key(several, "review_id", "of"), F.col("review_id") == F.col("of"), "left_semi")
    wanted = keep(plain_key(wanted.select("order_id").distinct(), "order_id", "wanted"), "wanted")
    words = sketch_of(wanted, "wanted")
    named, orders, items = (perhaps_among(rows, "order_id", words) for rows in (named, orders, items))

    text = F.lower(F.concat_ws(" ", "review_comment_title", "review_comment_message"))
    pairs = named.groupBy("review_id", "order_id").agg(F.min("review_created_at").alias("reviewed_at"), F.max(text).alias("text"))
    pairs = pairs.join(wanted, F.col("order_id") == F.col("wanted"), "left_semi")

    bought = items.join(wanted, F.col("order_id") == F.col("wanted"), "left_semi").select("order_id", "product_id").distinct()
    category = products.groupBy("product_id").agg(F.min("product_category_name").alias("category"))
    words = F.explode(F.split(F.lower("category"), "[^\\p{L}]+"))
    words = bought.join(category, "product_id").select("order_id", words.alias("word")).filter(F.length("word") >= LEAST_LETTERS)
    words = plain_key(words.groupBy("order_id").agg(F.collect_set("word").alias("words")), "order_id", "sold_in")
    scored = dated_pairs(pairs, orders).join(words, F.col("order_id") == F.col("sold_in"), "left")
    names = F.coalesce(F.exists("words", lambda w: F.contains(F.col("text"), w)), F.lit(False))
    return scored.select("review_id", "order_id", "after_delivery", "days_apart", names.alias("names_product"))


def _rank() -> Column:
    """A total order of pairs, the least first; both sides share it, so the assignment is the only stable one."""
    return F.struct(
        (~F.col("after_delivery")).alias("late"),
        (~F.col("names_product")).alias("unnamed"),
        F.coalesce("days_apart", F.lit(2**40)).alias("apart"),
        "order_id",
        "review_id",
    )


def assigned(pairs: DataFrame, keep: Keep) -> DataFrame:
    """The pairs that are taken: none could be left for two that both prefer each other.

    In rounds: a pair that is the best left for its review and for its order is taken, and all others of
    these two go. The best of all that are left is always such a pair, so every round takes some and the
    rounds end when none is left. Tables between rounds are written by `keep`; only whether one is empty
    reaches the driver.
    """
    rest, taken = keep(pairs, "pairs"), []
    while True:
        of_review = rest.groupBy("review_id").agg(F.min(_rank()).alias("best"))
        of_order = rest.groupBy("order_id").agg(F.min(_rank()).alias("best"))
        left = of_review.select("review_id", F.col("best.order_id").alias("order_id"))
        right = of_order.select(F.col("best.review_id").alias("review_id"), "order_id")
        found = keep(left.join(right, ["review_id", "order_id"]), "taken")
        taken.append(found)
        for side in ("review_id", "order_id"):
            gone = plain_key(found.select(side), side, "gone")
            rest = rest.join(gone, F.col(side) == F.col("gone"), "left_anti")
        rest = keep(rest, "rest")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, taken)


def review_assignment(
    reviews: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, keep: Keep
) -> DataFrame:
    """One row a review id that stands under several orders: the order it is given, and on what grounds.

    All is null where other reviews took its orders. `candidates` counts its orders.
    """
    pairs = keep(candidates(reviews, orders, items, products, keep), "candidates")
    several = pairs.groupBy("review_id").agg(F.count("*").alias("candidates")).filter("candidates > 1")
    own = pairs.join(assigned(pairs, keep), ["review_id", "order_id"])
    return several.join(plain_key(own, "review_id", "of"), F.col("review_id") == F.col("of"), "left").drop("of")
