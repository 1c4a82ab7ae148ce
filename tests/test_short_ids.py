"""Ids as bytes, and builds that shuffle little."""

import re

from pyspark.sql import functions as F

from tests.frames import item, order, payment, raw_layer, review
from tests.test_plans import AT_SCALE, physical, settings, skewed_layer
from vitrine.functions.short_ids import long_id, long_ids, short_id, short_ids
from vitrine.operators import day_sums, followups, sellers_mart
from vitrine.plans import pipeline
from vitrine.plans.datasets import Datasets
from vitrine.session import shuffles_removed
from vitrine.sources.marts import MartStore

DIGEST = "0123456789abcdef" * 2


def test_any_id_comes_back_and_none_are_mixed_up(spark):
    bytes_of = bytes.fromhex(DIGEST).decode("latin-1")
    ids = [None, "", " ", "a", "o1", "ab", DIGEST, DIGEST.upper(), DIGEST[:31], DIGEST[:30], DIGEST[:16], DIGEST * 2, DIGEST[:31] + "g",
           bytes_of, "x" * 7, "x" * 8, "x" * 15, "x" * 16, "x" * 7 + "\x01", "x" * 6 + "\x02\x02", "\x01", "\x02\x02", "\x00", "ß" * 8, "日本"]
    ids += ["é" * n + "0" * k for n in range(4) for k in range(40)]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("short", short_id(F.col("id")))
    found = rows.select("id", "short", long_id(F.col("short")).alias("again")).collect()
    assert [r.again for r in found] == [r.id for r in found] == ids
    assert len({bytes(r.short) for r in found if r.short is not None}) == len({i for i in ids if i is not None})
    assert len(next(r.short for r in found if r.id == DIGEST)) == 16
    assert [r.short for r in found if r.id is None] == [None]


def test_only_ids_change(spark):
    rows = spark.createDataFrame([(DIGEST, DIGEST, 1), (None, "x", 2)], "order_id string, name string, seller_id int")
    short = short_ids(rows)
    assert short.dtypes == [("order_id", "binary"), ("name", "string"), ("seller_id", "int")]
    assert long_ids(short).dtypes == rows.dtypes and long_ids(short).collect() == rows.collect()


def layer(spark, orders=("a", "b", DIGEST)):
    return raw_layer(
        spark,
        orders=[order(k) for k in orders],
        order_items=[item(k, s, 2.5, n) for k in ("a", "b", DIGEST) for n, s in ((1, "s"), (2, "s"), (3, DIGEST))] + [item("a", None, 1.0)],
        order_payments=[payment("a", 7.0)],
        order_reviews=[review("b", 4)],
        customers=[{"customer_id": "c-a", "customer_city": "x", "customer_state": "SP"}],
        sellers=[{"seller_id": "s"}, {"seller_id": DIGEST}],
    )


def text(df):
    return sorted(map(str, df.collect()))


def test_a_build_with_short_ids_stores_what_plain_datasets_hold(spark, tmp_path):
    raw, store = layer(spark, ("a", "b", DIGEST, "none")), MartStore(spark, str(tmp_path))
    pipeline.build(spark, raw, store)
    plain = Datasets(spark, raw)
    assert store.orders().dtypes == [(c, dict(plain.mart_orders_wide.dtypes)[c]) for c in store.orders().columns]
    assert text(store.orders()) == text(plain.mart_orders_wide.select(store.orders().columns))
    assert text(store.sellers()) == text(plain.mart_sellers_wide)
    facts = followups.seller_facts(plain.stg_order_items, plain.mart_orders_wide)
    assert text(store.sums("seller_facts")) == text(facts.select(store.sums("seller_facts").columns))
    assert facts.count() == 6 and store.sums("seller_facts").filter(F.col("seller_id") == DIGEST).count() == 3


def test_facts_of_unique_orders_need_no_numbers_and_no_ids(spark):
    d = Datasets(spark, layer(spark))
    facts = followups.seller_facts(d.stg_order_items, d.mart_orders_wide)
    assert text(followups.seller_facts(d.stg_order_items, d.mart_orders_wide, copies=False)) == text(facts)
    by = ("order_month", "day")
    wanted, found = (
        day_sums.day_sellers(sellers_mart.seller_orders_of(day_sums.day_of(facts), by, copies)) for copies in (True, False)
    )
    assert text(found) == text(wanted) and found.dtypes == wanted.dtypes


def test_copies_of_an_order_are_rows_of_their_own(spark):
    d = Datasets(spark, layer(spark, ("a", "a", "b")))
    facts = followups.seller_facts(d.stg_order_items, d.mart_orders_wide)
    assert sorted((r.order_id, r.seller_id, int(r.seller_items)) for r in facts.collect()) == sorted(
        [("a", "s", 2), ("a", DIGEST, 1)] * 2 + [("b", "s", 2), ("b", DIGEST, 1)]
    )


def test_items_are_shuffled_twice_for_the_facts(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    built = pipeline.build(spark, layer(spark), store)
    plan = physical(followups.seller_facts(built.stg_order_items, short_ids(store.orders())))
    assert plan.count("rangepartitioning(") == 1 and plan.count("hashpartitioning(") <= 2
    assert not re.search(r"hashpartitioning\(seller_id", plan)


def test_shuffle_files_of_a_build_go_with_their_queries(spark, tmp_path):
    kept = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = kept(), spark.conf.get(key, None)
    pipeline.build(spark, layer(spark), MartStore(spark, str(tmp_path)))
    assert kept() <= before and spark.conf.get(key, None) == was
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"


def test_hot_order_of_the_facts_is_split(spark):
    with settings(spark, **AT_SCALE):
        d = Datasets(spark, skewed_layer(spark))
        facts = followups.seller_facts(d.stg_order_items, d.mart_orders_wide)
        rows = facts.collect()
        assert "SortMergeJoin(skew=true)" in physical(facts)
    assert [r.seller_items for r in rows if (r.seller_id, r.order_id) == ("s0", "0")] == [13_334]
    assert sum(r.seller_items for r in rows) == 40_000
