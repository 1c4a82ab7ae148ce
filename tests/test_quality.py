from tests.frames import one, order, raw_layer
from vitrine.operators import quality
from vitrine.plans.datasets import Datasets


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_unique_counts_repeated_values_and_skips_null(spark):
    df = keys(spark, ["a", "a", "a", "b", "b", "c", None, None])
    row = one(quality.unique_test(df, "d", "k"))
    assert tuple(row) == ("d", "k", "unique", 2, False)
    assert one(quality.unique_test(keys(spark, [None, None, "a"]), "d", "k")).passed


def test_not_null_counts_rows(spark):
    row = one(quality.not_null_test(keys(spark, ["a", None, None]), "d", "k"))
    assert tuple(row) == ("d", "k", "not_null", 2, False)


def test_both_tests_from_one_grouping(spark):
    for values in (["a", "a", None, None], ["a"], []):
        df = keys(spark, values)
        apart = [one(quality.unique_test(df, "d", "k")), one(quality.not_null_test(df, "d", "k"))]
        assert sorted(map(tuple, quality.key_tests(df, "d", "k").collect())) == sorted(map(tuple, apart))


def test_null_keys_form_a_group_in_the_grain_audit(spark):
    rows = [order("a") | {"order_id": None}] * 2 + [order("b")]
    audit = Datasets(spark, raw_layer(spark, orders=rows)).granularity_audit
    assert one(audit, table_name="olist_orders").duplicate_count == 1
    assert audit.count() == 9


def test_composite_and_single_grain(spark):
    layer = raw_layer(
        spark,
        order_items=[{"order_id": "a", "order_item_id": 1}, {"order_id": "a", "order_item_id": 2}],
        order_reviews=[{"review_id": "r", "order_id": "a"}, {"review_id": "r", "order_id": "b"}],
    )
    audit = Datasets(spark, layer).granularity_audit
    assert one(audit, table_name="olist_order_items").duplicate_count == 0
    assert one(audit, table_name="olist_order_reviews").duplicate_count == 1


def test_suite_holds_twenty_tests(spark):
    suite = Datasets(spark, raw_layer(spark)).dq_suite
    assert suite.count() == 20
    assert suite.filter("passed").count() == 20
