"""Sketches of keys: no row that meets a key is left out, and rows that cannot are not shuffled."""

import pytest

from tests.frames import item, order, raw_layer
from tests.test_assignment import review
from vitrine.operators import assignment, sketch
from vitrine.plans.datasets import Datasets

MANY = 2000


def shuffled(df) -> int:
    """Rows that `df` shuffles when it is run."""
    df.collect()

    def rows(node) -> int:
        kind = node.nodeName()
        if kind.startswith("AdaptiveSparkPlan"):
            return rows(node.executedPlan())
        if "QueryStage" in kind:
            return rows(node.plan())
        if kind == "ReusedExchange":
            return 0
        own = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(rows(below.apply(k)) for k in range(below.size()))

    return rows(df._jdf.queryExecution().executedPlan())


def one_in_many(spark):
    """Many orders with an item and a review each; the review of the first stands under the second too."""
    keys = [f"o{k}" for k in range(MANY)]
    orders = [order(k, order_delivered_customer_date="2017-03-10 00:00:00") for k in keys]
    reviews = [review(f"r{max(k, 1)}", f"o{k}", "2017-03-11 00:00:00") for k in range(MANY)]
    return Datasets(spark, raw_layer(spark, orders=orders, order_reviews=reviews, order_items=[item(k, "s", 1.0) for k in keys]))


def test_only_what_may_compete_is_shuffled(spark, tmp_path):
    d = one_in_many(spark)
    pairs = assignment.candidates(d.stg_order_reviews, d.stg_orders, d.stg_order_items, d.stg_products)
    # a hash and a count for each review, and little else of reviews, orders and items
    assert shuffled(pairs) < MANY + 200
    assert shuffled(d.review_order_match) < MANY + 200
    (row,) = d.review_assignment(str(tmp_path)).collect()
    assert (row.review_id, row.candidates, row.order_id) == ("r1", 2, "o0")
    assert {(r.review_id, r.order_id) for r in d.review_order_match.collect()} == {("r1", "o0"), ("r1", "o1")}


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_a_full_sketch_changes_no_result(spark, tmp_path, monkeypatch, words):
    monkeypatch.setattr(sketch, "WORDS", words)
    orders = [order(f"o{k}", order_delivered_customer_date="2017-03-10 00:00:00") for k in range(200)]
    reviews = [review(f"r{k // 2}", f"o{k}", "2017-03-11 00:00:00") for k in range(200)]
    d = Datasets(spark, raw_layer(spark, orders=orders, order_reviews=reviews))
    found = {r.review_id: r.candidates for r in d.review_assignment(str(tmp_path)).filter("order_id is not null").collect()}
    assert found == {f"r{k}": 2 for k in range(100)}
    assert d.review_order_match.count() == 200


def test_sketch_keeps_its_keys_and_few_others(spark):
    rows = spark.range(40000).selectExpr("cast(id as string) as key").union(spark.sql("select cast(null as string)"))
    words = sketch.sketch_of(rows.filter("key % 20 = 0"), "key")
    kept = {r.key for r in sketch.perhaps_among(rows, "key", words).collect()}
    assert {str(k) for k in range(0, 40000, 20)} <= kept and len(kept) < 2100
    nothing = sketch.sketch_of(rows.filter("key is null and key is not null"), "key")
    assert sketch.perhaps_among(rows, "key", nothing).count() == 0


def test_rows_of_a_repeated_key_stay(spark):
    rows = spark.range(1000).selectExpr("cast(if(id < 10, 0, id) as string) as key", "id")
    kept = sketch.perhaps_repeated(rows, "key")
    assert kept.columns == ["key", "id"] and {r.id for r in kept.collect()} >= set(range(10)) and kept.count() < 30
