"""Reviews under several orders, each given one, against a greedy choice over all pairs."""

import random

import __spark_entry__ as contract
from tests.frames import item, order, raw_layer
from vitrine.operators import assignment
from vitrine.plans.datasets import Datasets


def greedy(pairs):
    rank = lambda p: (not p.after_delivery, not p.names_product, 2**40 if p.days_apart is None else p.days_apart, p.order_id, p.review_id)
    reviews, orders, taken = set(), set(), {}
    for p in sorted(pairs, key=rank):
        if p.review_id not in reviews and p.order_id not in orders:
            reviews.add(p.review_id)
            orders.add(p.order_id)
            taken[p.review_id] = p.order_id
    return taken


def review(review_id, key, made, text=None):
    return {"review_id": review_id, "order_id": key, "review_score": "5", "review_creation_date": made, "review_comment_message": text}


def layer(spark, orders, reviews, products=()):
    items = [item(o["order_id"], "s", 1.0) | {"product_id": f"p{k % 3}"} for k, o in enumerate(orders)]
    return raw_layer(spark, orders=orders, order_reviews=reviews, order_items=items, products=list(products))


def test_two_reviews_do_not_take_one_order(spark, tmp_path):
    orders = [order("a", order_delivered_customer_date="2017-03-10 00:00:00"), order("b", order_delivered_customer_date="2017-03-01 00:00:00")]
    reviews = [review(r, o, "2017-03-11 00:00:00") for r in ("x", "y") for o in ("a", "b")]
    found = {r.review_id: r.order_id for r in Datasets(spark, layer(spark, orders, reviews)).review_assignment(str(tmp_path)).collect()}
    assert found == {"x": "a", "y": "b"}
    third = [*reviews, review("z", "a", "2017-03-11 00:00:00"), review("z", "b", "2017-03-11 00:00:00"), review("one", "b", "2017-03-11 00:00:00")]
    rows = Datasets(spark, layer(spark, orders, third)).review_assignment(str(tmp_path)).collect()
    assert {r.review_id: (r.order_id, r.candidates) for r in rows} == {"x": ("a", 2), "y": (None, 2), "z": (None, 2)}


def test_a_named_product_goes_before_days(spark, tmp_path):
    orders = [order("a", order_delivered_customer_date="2017-03-10 00:00:00"), order("b", order_delivered_customer_date="2017-03-01 00:00:00")]
    products = [{"product_id": "p0", "product_category_name": "cama_mesa_banho"}, {"product_id": "p1", "product_category_name": "brinquedos"}]
    reviews = [review("x", o, "2017-03-11 00:00:00", "Os BRINQUEDOS chegaram") for o in ("a", "b")]
    row = Datasets(spark, layer(spark, orders, reviews, products)).review_assignment(str(tmp_path)).first()
    assert (row.order_id, row.names_product, row.days_apart) == ("b", True, 10)


def test_random_pairs_against_a_greedy_choice(spark, tmp_path):
    pick = random.Random(3)
    orders = [
        order(f"o{k}", order_delivered_customer_date=pick.choice([None, f"2017-03-{pick.randint(11, 20)} 00:00:00"]))
        for k in range(25)
    ]
    reviews = [
        review(f"r{pick.randint(0, 14)}", pick.choice([f"o{pick.randint(0, 24)}", "hot", None]), f"2017-03-{pick.randint(11, 25)} 00:00:00", pick.choice(["cama", None]))
        for _ in range(70)
    ]
    products = [{"product_id": "p1", "product_category_name": "cama_mesa"}]
    d = Datasets(spark, layer(spark, orders, reviews, products))
    pairs = assignment.candidates(d.stg_order_reviews, d.stg_orders, d.stg_order_items, d.stg_products).collect()
    want = greedy(pairs)
    found = {r.review_id: r.order_id for r in d.review_assignment(str(tmp_path)).collect()}
    assert found == {r: want.get(r) for r in found} and len(found) > 5
    given = [o for o in found.values() if o]
    assert len(given) == len(set(given))


def test_on_the_given_tables_and_without_reviews(spark, tmp_path):
    rows = contract.queries()["review_assignment"](spark, "/root/testdata/sf0.001").collect()
    given = [r.order_id for r in rows if r.order_id]
    assert rows and len(given) == len(set(given)) and all(r.candidates > 1 for r in rows)
    assert Datasets(spark, raw_layer(spark)).review_assignment(str(tmp_path)).collect() == []
