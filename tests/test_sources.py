import datetime as dt
import hashlib
from decimal import Decimal

import pytest

from tests.frames import item, one, order, payment, raw_layer, review
from vitrine.functions.fixed_values import RAW_FILES
from vitrine.plans import pipeline
from vitrine.plans.datasets import Datasets
from vitrine.sources.marts import MartStore
from vitrine.sources.raw import catalog, csv_folder, land, parquet_folder, read_csv, seed
from vitrine.sources.schemas import ORDERS_MART, RAW, SELLERS_MART, raw_schema
from vitrine.sources.star_schema import star_schema
from vitrine.streaming.ingest import ingest


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def header(table):
    return ",".join(raw_schema(table).names)


def test_byte_order_mark_is_dropped(spark, tmp_path):
    file = write(tmp_path / "t.csv", "﻿" + header("category_translation") + "\nperfumaria,perfumery\n")
    row = one(read_csv(spark, "category_translation", file))
    assert tuple(row) == ("perfumaria", "perfumery")


def test_quoted_newlines_and_quotes_stay_in_one_review(spark, tmp_path):
    file = write(
        tmp_path / "t.csv",
        header("order_reviews") + '\nr1,o1,4,,"linha 1\nlinha ""2"", fim",2018-01-01 00:00:00,2018-01-02 10:00:00\n',
    )
    row = one(read_csv(spark, "order_reviews", file))
    assert row.review_comment_message == 'linha 1\nlinha "2", fim'
    assert row.review_comment_title is None


def test_empty_dates_are_null_and_prefixes_keep_zeros(spark, tmp_path):
    write(tmp_path / f"{RAW_FILES['orders']}.csv", header("orders") + "\na,c,shipped,2017-01-01 10:00:00,,,,2017-02-01 00:00:00\n")
    write(tmp_path / f"{RAW_FILES['customers']}.csv", header("customers") + "\nc,u,01037,sao paulo,SP\n")
    d = Datasets(spark, csv_folder(spark, str(tmp_path)))
    row = one(d.stg_orders)
    assert row.order_purchase_at == dt.datetime(2017, 1, 1, 10)
    assert row.order_approved_at is row.order_delivered_customer_at is None
    assert one(d.stg_customers).zip_code_prefix == "01037"


def test_quoted_nothing_is_null(spark, tmp_path):
    file = write(tmp_path / "t.csv", header("orders") + '\n"a","c","created","2017-01-01 10:00:00","",,"","2017-02-01"\n')
    row = one(read_csv(spark, "orders", file))
    assert row.order_approved_at is row.order_delivered_customer_date is None
    assert row.order_status == "created"


def test_wrong_header_is_an_error(spark, tmp_path):
    file = write(tmp_path / "t.csv", "seller_id,city,zip,state\na,b,c,d\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, "sellers", file).collect()


def test_counts_written_with_a_fraction(spark):
    layer = raw_layer(
        spark,
        products=[{"product_id": "p", "product_name_lenght": "40.0", "product_photos_qty": "2",
                   "product_weight_g": 225.5}],
    )
    row = one(Datasets(spark, layer).stg_products)
    assert (row.product_name_length, row.product_photos_qty) == (40, 2)
    assert row.product_weight_g == Decimal("225.500")
    assert row.product_description_length is None


def test_one_coordinate_a_prefix(spark):
    rows = [
        {"geolocation_zip_code_prefix": z, "geolocation_lat": lat, "geolocation_lng": lng,
         "geolocation_city": c, "geolocation_state": "SP"}
        for z, lat, lng, c in [("1", -2.0, 5.0, "b"), ("1", -2.0, 5.0, "a"), ("1", -1.0, 0.0, "a"), ("2", 0.0, 0.0, "z")]
    ]
    got = Datasets(spark, raw_layer(spark, geolocation=rows)).stg_geolocation.collect()
    assert sorted(tuple(r)[:4] for r in got) == [("1", -2.0, 5.0, "a"), ("2", 0.0, 0.0, "z")]


@pytest.fixture()
def layer(spark):
    return raw_layer(
        spark,
        orders=[order("a"), order("b", order_purchase_timestamp="2017-04-02 00:00:00"),
                order("n", order_purchase_timestamp=None)],
        order_items=[item("a", "s", 10.0), item("b", "s", 5.5)],
        order_payments=[payment("a", 11.0), payment("b", 6.5)],
        order_reviews=[review("a", 5)],
        sellers=[{"seller_id": "s", "seller_city": "x", "seller_state": "SP"}],
        customers=[{"customer_id": "c-a", "customer_state": "RJ"}],
    )


def test_build_stores_what_the_plan_computes(spark, tmp_path, layer):
    raw_dir = f"{tmp_path}/raw"
    land(layer, raw_dir)
    raw = parquet_folder(spark, raw_dir)
    store = MartStore(spark, f"{tmp_path}/marts")
    built = pipeline.build(spark, raw, store)
    lazy = Datasets(spark, raw)
    for name in ("mart_orders_wide", "mart_sellers_wide", "cfo_monthly_revenue", "kpi_cards"):
        assert built[name].dtypes == lazy[name].dtypes
        assert sorted(built[name].collect(), key=str) == sorted(lazy[name].collect(), key=str)
    # a second build replaces the first
    built = pipeline.build(spark, raw, store)
    assert store.orders().count() == 3
    tests, audit = pipeline.verify(built)
    assert tests.count() == 20 and tests.filter("not passed").count() == 0
    assert audit.count() == 9

    sql = "select sum(recognized_revenue) as x from {mart_orders_wide} where customer_state = {state}"
    assert one(store.query(sql, state="RJ")).x == Decimal("11.000")
    assert one(store.query("select count(*) as n from {mart_sellers_wide}")).n == 1


def test_store_schemas_are_the_contract(spark, layer):
    d = Datasets(spark, layer)
    from pyspark.sql.types import StructType

    for name, ddl in (("mart_orders_wide", ORDERS_MART), ("mart_sellers_wide", SELLERS_MART)):
        want = [(f.name, f.dataType) for f in StructType.fromDDL(ddl)]
        assert [(f.name, f.dataType) for f in d[name].schema] == want


def test_month_filter_prunes_partitions_of_the_stored_mart(spark, tmp_path, layer):
    store = MartStore(spark, str(tmp_path))
    pipeline.build(spark, layer, store)
    d = Datasets(spark, layer, store, as_of=dt.date(2017, 4, 20))
    april = d.between(dt.date(2017, 4, 1), dt.date(2017, 4, 30))
    assert [r.order_id for r in april.mart_orders_wide.collect()] == ["b"]
    plan = april.state_revenue._jdf.queryExecution().executedPlan().toString()
    assert plan.split("PartitionFilters: [")[1].split("]")[0].count("order_month") >= 2
    assert one(april.mart_sellers_wide).total_orders == 1
    assert [r.month for r in d.cfo_monthly_revenue.collect()] == ["2017-03"]
    plan = d.cfo_monthly_revenue._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.count("order_month") >= 3


def test_seed_and_catalog(spark, tmp_path):
    for table in RAW:
        write(tmp_path / f"{RAW_FILES[table]}.csv", header(table) + "\n")
    write(tmp_path / f"{RAW_FILES['sellers']}.csv", header("sellers") + "\ns,00001,x,SP\n")
    seed(spark, str(tmp_path), f"{tmp_path}/raw")
    raw = parquet_folder(spark, f"{tmp_path}/raw")
    assert one(raw("sellers")).seller_zip_code_prefix == "00001"
    for table in RAW:
        raw(table).createOrReplaceTempView(RAW_FILES[table])
    d = Datasets(spark, catalog(spark))
    assert one(d.mart_sellers_wide).total_orders == 0
    for table in RAW:
        spark.catalog.dropTempView(RAW_FILES[table])


def test_build_job_from_csv(spark, tmp_path, capsys, monkeypatch):
    csv = tmp_path / "csv"
    csv.mkdir()
    for table in RAW:
        write(csv / f"{RAW_FILES[table]}.csv", header(table) + "\n")
    write(csv / f"{RAW_FILES['sellers']}.csv", header("sellers") + "\ns,1,x,SP\ns,1,x,SP\n")
    code = pipeline.main(["--csv", str(csv), "--root", str(tmp_path / "root")])
    out = capsys.readouterr().out
    assert code == 1
    assert "FAIL 1 unique raw_sellers seller_id" in out
    assert "PASS=18 TOTAL=20" in out
    assert "olist_sellers: 1 repeated keys" in out


def test_arriving_files_are_taken_once(spark, tmp_path):
    landing, raw_dir = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()

    def load():
        query = ingest(spark, "sellers", str(landing), raw_dir, f"{tmp_path}/checkpoint", max_files=1)
        query.awaitTermination()
        return sorted(r.seller_id for r in parquet_folder(spark, raw_dir)("sellers").collect())

    write(landing / "1.csv", header("sellers") + "\na,1,x,SP\n")
    assert load() == ["a"]
    write(landing / "2.csv", header("sellers") + "\nb,1,x,SP\n")
    write(landing / "3.csv", header("sellers") + "\nc,1,x,SP\n")
    assert load() == ["a", "b", "c"]
    assert load() == ["a", "b", "c"]


def test_seeded_and_arrived_rows_are_read_once_each(spark, tmp_path):
    landing, csv, raw_dir = tmp_path / "landing", tmp_path / "csv", str(tmp_path / "raw")
    landing.mkdir()
    csv.mkdir()

    def load():
        ingest(spark, "sellers", str(landing), raw_dir, f"{tmp_path}/checkpoint").awaitTermination()

    def reload(*ids):
        write(csv / f"{RAW_FILES['sellers']}.csv", header("sellers") + "\n" + "".join(f"{i},1,x,SP\n" for i in ids))
        seed(spark, str(csv), raw_dir, ["sellers"])

    def rows():
        return sorted(r.seller_id for r in parquet_folder(spark, raw_dir)("sellers").collect())

    write(landing / "1.csv", header("sellers") + "\nc,1,x,SP\n")
    load()
    assert rows() == ["c"]  # before any seed
    reload("a", "b")
    assert rows() == ["a", "b", "c"]
    write(landing / "2.csv", header("sellers") + "\nd,1,x,SP\n")
    load()
    load()
    assert rows() == ["a", "b", "c", "d"]
    reload("a")  # takes the place of the seed; files that arrived stay
    assert rows() == ["a", "c", "d"]
    write(landing / "3.csv", header("sellers") + "\ne,1,x,SP\n")
    load()
    assert rows() == ["a", "c", "d", "e"]


def test_repeated_batch_takes_the_place_of_its_first_try(spark, tmp_path):
    landing, raw_dir = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    write(landing / "1.csv", header("sellers") + "\na,1,x,SP\n")
    ingest(spark, "sellers", str(landing), raw_dir, f"{tmp_path}/checkpoint").awaitTermination()
    (tmp_path / "checkpoint" / "commits" / "0").unlink()  # as if the driver had died before the commit
    for crc in (tmp_path / "checkpoint" / "commits").glob(".0.crc"):
        crc.unlink()
    ingest(spark, "sellers", str(landing), raw_dir, f"{tmp_path}/checkpoint").awaitTermination()
    assert parquet_folder(spark, raw_dir)("sellers").count() == 1


def test_failed_build_leaves_the_old_pair(spark, tmp_path, layer, monkeypatch):
    store = MartStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.orders()
    pipeline.build(spark, layer, store)
    before = (store.orders().collect(), store.sellers().collect())

    def die(self, mart):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("vitrine.sources.marts.MartVersion.write_sellers", die)
        other = raw_layer(spark, orders=[order("z")])
        with pytest.raises(RuntimeError):
            pipeline.build(spark, other, store)
    assert (store.orders().collect(), store.sellers().collect()) == before
    pipeline.build(spark, raw_layer(spark, orders=[order("z")]), store)
    assert one(store.orders()).order_id == "z" and store.sellers().count() == 0
    store.prune(keep=1)
    assert len(store.published()) == 1 and one(store.orders()).order_id == "z"


def test_star_rows_by_hand(spark, tmp_path):
    """Expected values written out, not taken from the statements that both engines share."""
    at = dt.datetime(1997, 5, 1)
    rows = [(6, 3, "F", 100.5, at), (8, 4, "O", 7.25, at), (97, 5, "P", 1.0, at)]
    names = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "orders.parquet"))
    raw = star_schema(spark, str(tmp_path))
    key = {k: hashlib.md5(f"o{k}".encode()).hexdigest() for k in (6, 8, 97)}
    orders = {r.order_id: r for r in raw("orders").collect()}
    six, eight = orders[key[6]], orders[key[8]]
    assert (six.order_status, eight.order_status, orders[key[97]].order_status) == ("delivered", "shipped", "processing")
    assert six.customer_id == hashlib.md5(b"c3").hexdigest()
    assert six.order_purchase_timestamp == "1997-05-01 13:11:54"  # 6 * 7919 = 47514 seconds into the day
    assert six.order_delivered_customer_date == "1997-05-24 06:32:54"  # 22 + 1 days and 23574 seconds on
    assert eight.order_delivered_customer_date is None
    assert six.order_estimated_delivery_date == "1997-05-17 00:00:00"
    paid = sorted((r.order_id, r.payment_sequential, r.payment_type, r.payment_installments, r.payment_value) for r in raw("order_payments").collect())
    assert paid == sorted([(key[6], 1, "credit_card", 7, 100.5), (key[6], 2, "voucher", 1, 12.5), (key[8], 1, "credit_card", 9, 7.25)])
