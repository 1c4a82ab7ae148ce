"""Rows that arrive again, deletions, bad rows, refreshes, the gate, and read-only SQL."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.frames import item, one, order, payment, raw_layer, review
from vitrine.functions.fixed_values import RAW_FILES
from vitrine.plans import pipeline
from vitrine.plans.datasets import Datasets
from vitrine.sources import quarantine
from vitrine.sources.keyed import KeyedTable, keyed_folder
from vitrine.sources.marts import MartStore
from vitrine.sources.raw import land, parquet_folder, seed
from vitrine.sources.readonly import RefusedStatement
from vitrine.sources.schemas import KEYS, RAW, raw_schema
from vitrine.streaming.ingest import ingest


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))


def header(table):
    return ",".join(raw_schema(table).names)


def order_line(key, status="created", bought="2017-03-10 08:00:00", customer=None):
    return f"{key},{customer or 'c-' + key},{status},{bought},,,,2017-04-20 00:00:00\n"


class Landing:
    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.raw = spark, tmp_path / "landing", str(tmp_path / "raw")
        self.checkpoints, self.files = str(tmp_path / "ingest"), 0

    def put(self, table, body, deletes=False):
        name = f"{table}-deletes" if deletes else table
        head = ",".join(c for c in raw_schema(table).names if c in KEYS[table]) if deletes else header(table)
        self.files += 1
        write(self.path / name / f"{self.files:04d}.csv", f"{head}\n{body}")

    def take(self):
        pipeline.take_in(self.spark, str(self.path), self.raw, self.checkpoints)

    def rows(self, table):
        return parquet_folder(self.spark, self.raw)(table)


@pytest.fixture()
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


# --- upserts


def statuses(landing):
    return sorted((r.order_id, r.order_status) for r in landing.rows("orders").collect())


def test_an_order_that_arrives_again_and_again_counts_once(spark, landing):
    land(raw_layer(spark, orders=[order("a", order_status="created"), order("b")]), landing.raw, ["orders"])
    for status in ("approved", "delivered"):
        landing.put("orders", order_line("a", status))
        landing.take()
        landing.take()
        assert statuses(landing) == [("a", status), ("b", "delivered")]
    # a seed is the oldest version whenever it is loaded
    land(raw_layer(spark, orders=[order("a", order_status="created"), order("c")]), landing.raw, ["orders"])
    assert statuses(landing) == [("a", "delivered"), ("c", "delivered")]


def test_before_any_seed_and_twice_in_one_batch(spark, landing):
    landing.put("orders", order_line("a", "created") + order_line("b", "created") + order_line("a", "approved"))
    landing.put("orders", order_line("a", "shipped"))  # a later file of the same batch
    landing.take()
    assert statuses(landing) == [("a", "shipped"), ("b", "created")]
    land(raw_layer(spark, orders=[order("a"), order("z")]), landing.raw, ["orders"])
    assert statuses(landing) == [("a", "shipped"), ("b", "created"), ("z", "delivered")]


def test_deletions_and_what_comes_after_them(spark, landing):
    land(raw_layer(spark, orders=[order("a"), order("b")]), landing.raw, ["orders"])
    landing.put("orders", "a\n", deletes=True)
    landing.take()
    assert statuses(landing) == [("b", "delivered")]
    landing.put("orders", order_line("a", "shipped"))
    landing.take()
    assert statuses(landing) == [("a", "shipped"), ("b", "delivered")]
    with pytest.raises(ValueError, match="no key"):
        ingest(spark, "geolocation", str(landing.path), landing.raw, deletes=True)


def test_folding_changes_nothing_and_touches_no_other_bucket(spark, landing):
    land(raw_layer(spark, orders=[order(f"k{i}") for i in range(200)]), landing.raw, ["orders"])
    table = KeyedTable(spark, landing.raw, "orders")
    landing.put("orders", order_line("k7", "shipped") + order_line("new", "shipped"))
    landing.put("orders", "k8\n", deletes=True)
    landing.take()
    seeded, before = table.snapshot(1), statuses(landing)
    table.fold()
    folded = table.snapshot()
    assert statuses(landing) == before and folded.laid == [] and ("k8", "delivered") not in before
    changed = {k for k in seeded.base if seeded.base[k] != folded.base.get(k)}
    assert 1 <= len(changed) <= 3 and len(seeded.base) == 16
    assert sorted(r.order_id for r in table.rows(seeded).collect()) == sorted(f"k{i}" for i in range(200))
    table.fold()
    assert table.snapshot().number == folded.number
    table.prune(folded.number)
    assert statuses(landing) == before
    land(raw_layer(spark, orders=[order("k7"), order("k9")]), landing.raw, ["orders"])  # under all batches again
    assert statuses(landing) == [("k7", "shipped"), ("k9", "delivered"), ("new", "shipped")]


def versions(spark, table, rows):
    """Rows as append() takes them: (values, deleted) in order of arrival."""
    schema = raw_schema(table)
    data = [(*[r.get(c) for c in schema.names], None, "f", 0, k, gone) for k, (r, gone) in enumerate(rows)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return spark.createDataFrame(data, f"{fields}, _at timestamp, _file string, _start long, _row long, _deleted boolean")


def test_hot_and_null_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "order_items")
    hot = [item("hot", "s", 1.0, 1)] * 300 + [item("hot", "s", 1.0, n) for n in range(2, 300)]
    table.seed(raw_layer(spark, order_items=[*hot, item(None, "s", 1.0), item("cold", "s", 1.0)])("order_items"))
    batch = [(item("hot", "s", float(k), 1), False) for k in range(500)]
    batch += [(item(None, "t", 2.0), False), (item("hot", "s", 2.0, 2), True), (item("x", "s", 3.0) | {"order_item_id": None}, False)]
    assert table.append(versions(spark, "order_items", batch), "q", 0)
    assert not table.append(versions(spark, "order_items", batch), "q", 0)  # the same batch again
    rows = table.rows().collect()
    of = lambda k, n: [r.price for r in rows if (r.order_id, r.order_item_id) == (k, n)]
    assert of("hot", 1) == [499.0] and of("hot", 2) == [] and of("hot", 3) == [1.0] and of("cold", 1) == [1.0]
    assert sorted(r.seller_id for r in rows if r.order_id is None) == ["s", "t"] and of("x", None) == [3.0]


def test_random_batches_against_a_dictionary(spark, tmp_path):
    pick = random.Random(11)
    table, known = KeyedTable(spark, str(tmp_path), "order_payments"), {}
    for number in range(6):
        batch = []
        for _ in range(40):
            key = (f"o{pick.randint(0, 12)}", pick.randint(1, 3))
            gone = pick.random() < 0.2
            row = payment(key[0], pick.random(), key[1])
            batch.append((row, gone))
            known.pop(key, None) if gone else known.__setitem__(key, row["payment_value"])
        table.append(versions(spark, "order_payments", batch), "q", number)
        if number in (1, 4):
            table.fold()
        rows = table.rows().collect()
        assert {(r.order_id, r.payment_sequential): r.payment_value for r in rows} == known and len(rows) == len(known)


def test_a_reader_keeps_its_snapshot(spark, landing):
    land(raw_layer(spark, orders=[order("a")]), landing.raw, ["orders"])
    raw = keyed_folder(spark, landing.raw)
    assert raw("orders").count() == 1
    landing.put("orders", order_line("b"))
    landing.take()
    assert raw("orders").count() == 1 and landing.rows("orders").count() == 2


# --- bad rows


BAD = (
    order_line("good")
    + "few,fields\n"
    + order_line("odd", bought="yesterday")
    + ',c,created,2017-03-10 08:00:00,,,,2017-04-20 00:00:00\n'
    + 'q,"open,created,2017-03-10 08:00:00,,,,2017-04-20 00:00:00\n'
)


def rejected(spark, raw_dir, table):
    rows = spark.read.option("recursiveFileLookup", "true").parquet(quarantine.rejected_folder(raw_dir, table))
    return sorted((r.reason, r.text[:4]) for r in rows.collect())


def test_bad_rows_are_set_aside_in_a_stream(spark, landing):
    landing.put("orders", BAD)
    write(landing.path / "orders" / "9.csv", "some,other,header\n" + order_line("lost"))
    landing.take()
    assert statuses(landing) == [("good", "created")]
    found = rejected(spark, landing.raw, "orders")
    assert [r for r, _ in found] == [
        "no header with the declared columns",
        "no header with the declared columns",
        "order_id is missing",
        "order_purchase_timestamp is not a time",
        "wrong number of fields",
        "wrong number of fields",
    ]
    landing.put("orders", order_line("next"))
    landing.take()  # the stream goes on
    assert len(statuses(landing)) == 2


def test_bad_numbers_and_all_rows_are_one_or_the_other(spark, tmp_path):
    items = header("order_items") + "\na,1,p,s,2017-01-01 00:00:00,1.5,2\na,x,p,s,2017-01-01 00:00:00,1.5,2\na,3,p,s,,1e,2\n\na,4,p,s,,,\n"
    write(tmp_path / "i.csv", "﻿" + items)
    rows = quarantine.parsed(spark, "order_items", str(tmp_path / "i.csv"))
    good = quarantine.set_aside(rows, "order_items", str(tmp_path / "raw"), "x", 1.0)
    assert sorted((r.order_item_id, r.price) for r in good.collect()) == [(1, 1.5), (4, None)]
    assert [r for r, _ in rejected(spark, str(tmp_path / "raw"), "order_items")] == ["order_item_id is not a number", "price is not a number"]
    assert rows.count() == 4
    reviews = header("order_reviews") + '\nr1,o1,4,,"linha 1\nlinha ""2"", fim",2018-01-01 00:00:00,2018-01-02 10:00:00\nr2,o1,five,,,,\n'
    write(tmp_path / "r.csv", reviews)
    rows = quarantine.parsed(spark, "order_reviews", str(tmp_path / "r.csv")).collect()
    assert sorted((r.review_id, r._reason, r.review_comment_message) for r in rows) == [
        ("r1", None, 'linha 1\nlinha "2", fim'),
        ("r2", "review_score is not a number", None),
    ]


def test_a_load_with_too_many_bad_rows_is_refused(spark, tmp_path):
    write(tmp_path / "csv" / f"{RAW_FILES['orders']}.csv", header("orders") + "\n" + BAD + "".join(order_line(f"g{i}") for i in range(15)))
    raw_dir = str(tmp_path / "raw")
    with pytest.raises(quarantine.RefusedLoad, match="4 of 20"):
        seed(spark, str(tmp_path / "csv"), raw_dir, ["orders"], most_rejected=0.1)
    assert parquet_folder(spark, raw_dir)("orders").count() == 0
    seed(spark, str(tmp_path / "csv"), raw_dir, ["orders"], most_rejected=0.2)
    assert parquet_folder(spark, raw_dir)("orders").count() == 16
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        seed(spark, str(tmp_path / "csv"), raw_dir, ["orders"])


# --- refresh


def marts(store):
    tables = (store.orders(), store.sellers(), store.sums("seller_facts"), store.sums("day_sellers"), store.sums("month_states"))
    return [sorted(map(str, df.collect())) for df in tables]


def rebuilt(spark, landing, tmp_path, name):
    store = MartStore(spark, f"{tmp_path}/full-{name}")
    pipeline.build(spark, parquet_folder(spark, landing.raw), store)
    return marts(store)


def random_layer(pick, orders, sellers):
    state = lambda: pick.choice(["SP", "RJ", "MG"])
    month = lambda: f"2017-0{pick.randint(1, 6)}-1{pick.randint(0, 9)} 08:00:00"
    return {
        "orders": [
            order(
                k,
                customer_id=f"c{pick.randint(0, 15)}",
                order_status=pick.choice(["delivered", "delivered", "shipped", "canceled"]),
                order_purchase_timestamp=pick.choice([month(), month(), month(), None]),
                order_delivered_customer_date=pick.choice([None, "2017-07-01 10:00:00", "2017-03-15 10:00:00"]),
            )
            for k in orders
        ],
        "order_items": [item(k, pick.choice(sellers), pick.choice([None, 10.0, 7.25]), n) for k in orders for n in range(1, pick.randint(1, 4))],
        "order_payments": [payment(k, pick.random() * 100, n) for k in orders for n in range(1, pick.randint(1, 3))],
        "order_reviews": [review(k, pick.randint(1, 5), f"r{pick.randint(0, 3)}") for k in orders if pick.random() < 0.7],
        "customers": [{"customer_id": f"c{i}", "customer_city": "x", "customer_state": state()} for i in range(12)],
        "sellers": [{"seller_id": s, "seller_city": pick.choice("xy"), "seller_state": state()} for s in sellers],
    }


def test_refresh_equals_a_full_build_on_random_batches(spark, landing, tmp_path):
    pick = random.Random(23)
    names, sellers = [f"o{i}" for i in range(40)], [f"s{i}" for i in range(6)]
    land(raw_layer(spark, **random_layer(pick, names[:30], sellers[:4])), landing.raw)
    store = MartStore(spark, f"{tmp_path}/marts")
    pipeline.refresh(spark, landing.raw, store)
    assert marts(store) == rebuilt(spark, landing, tmp_path, "seed")
    for number in range(2):
        layer = random_layer(pick, pick.sample(names, 6), pick.sample(sellers, 2))
        layer["customers"] = pick.sample(layer["customers"], 1)
        tables = pick.sample(sorted(layer), 3)
        for t in tables:
            batch = [(r, t != "customers" and t != "sellers" and pick.random() < 0.2) for r in layer[t]]
            KeyedTable(spark, landing.raw, t).append(versions(spark, t, batch), "q", number)
        pipeline.refresh(spark, landing.raw, store)
        assert marts(store) == rebuilt(spark, landing, tmp_path, number), (number, tables)
        if number == 0:
            for t in RAW:
                KeyedTable(spark, landing.raw, t).fold()
    assert pipeline.refresh(spark, landing.raw, store) and len(store.published()) <= 4  # nothing new, no new version
    published = store.published()
    pipeline.refresh(spark, landing.raw, store)
    assert store.published() == published
    before = marts(store)
    store.prune(keep=1)
    assert marts(store) == before and len(store.published()) == 1


def test_untouched_months_are_neither_read_nor_written(spark, landing, tmp_path, monkeypatch):
    rows = [order(f"o{m}", order_purchase_timestamp=f"2017-0{m}-10 08:00:00") for m in range(1, 7)]
    land(raw_layer(spark, orders=rows, order_items=[item(f"o{m}", "s", 5.0) for m in range(1, 7)],
                   sellers=[{"seller_id": "s"}]), landing.raw)
    store = MartStore(spark, f"{tmp_path}/marts")
    pipeline.refresh(spark, landing.raw, store)
    first = store.current()
    landing.put("order_payments", "o2,1,credit_card,1,50\n")
    landing.put("orders", order_line("o5", "delivered", "2017-04-11 08:00:00"))  # moves from May to April
    landing.take()
    seen = []
    plain = type(first).orders

    def watched(self, months=None):
        seen.append(months)
        return plain(self, months)

    with monkeypatch.context() as m:
        m.setattr(type(first), "orders", watched)
        pipeline.refresh(spark, landing.raw, store)
    touched = {k for k in first.manifest.months if k[:7] in ("2017-02", "2017-04", "2017-05")}
    assert len(touched) == 3 and all(months is not None and months <= touched for months in seen)
    now = store.current().manifest
    kept = {k for k, v in now.months.items() if v == first.name}
    assert {k[:7] for k in kept} == {"2017-01", "2017-03", "2017-06"}
    assert {k[:7] for k in now.months} == {"2017-01", "2017-02", "2017-03", "2017-04", "2017-06"}
    assert marts(store) == rebuilt(spark, landing, tmp_path, "full")
    plan = store.orders().filter(F.col("order_month") >= F.lit("2017-04-01").cast("timestamp_ntz"))
    assert "PartitionFilters: [isnotnull(order_month" in plan._jdf.queryExecution().executedPlan().toString()
    store.prune(keep=1)
    assert marts(store) == rebuilt(spark, landing, tmp_path, "again")  # folders of the older version stay


def test_job_takes_in_and_refreshes(spark, landing, tmp_path, capsys):
    root = tmp_path
    write(root / "csv" / f"{RAW_FILES['orders']}.csv", header("orders") + "\n" + order_line("a", "delivered") + "few,fields\n")
    for t in RAW:
        if t != "orders":
            write(root / "csv" / f"{RAW_FILES[t]}.csv", header(t) + "\n")
    assert pipeline.main(["--csv", str(root / "csv"), "--root", str(root), "--most-rejected", "0.5"]) == 0
    landing.put("orders", order_line("a", "canceled") + order_line("b", "delivered"))
    landing.put("order_payments", "a,1,credit_card,1,50\nb,1,credit_card,1,7\n")
    assert pipeline.main(["--landing", str(landing.path), "--root", str(root), "--fold"]) == 0
    assert "PASS=20 TOTAL=20" in capsys.readouterr().out
    got = {r.order_id: str(r.recognized_revenue) for r in MartStore(spark, f"{root}/marts").orders().collect()}
    assert got == {"a": "0.000", "b": "7.000"}


def test_a_seller_is_looked_up_in_few_files(spark, tmp_path):
    """A seller with a third of all orders spans files; the others and strangers are in one or none of a month."""
    orders = [order(f"o{k}") for k in range(900)]
    items = [item(f"o{k}", "hot" if k % 3 == 0 else f"s{k}", 1.0 + k) for k in range(900)]
    store = MartStore(spark, str(tmp_path))
    raw = raw_layer(spark, orders=orders, order_items=items, sellers=[{"seller_id": "hot"}, {"seller_id": "s1"}])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        built = pipeline.build(spark, raw, store)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = {f for f in store.sums("seller_facts").inputFiles()}
    hot, one_, stranger = (store.facts_of(s) for s in ("hot", "s1", "t-unknown"))
    assert len(files) >= 6 and 1 < len(hot.inputFiles()) < len(files)
    assert len(one_.inputFiles()) == 1 and stranger.inputFiles() == [] == stranger.collect()
    assert hot.count() == 300 and [r.order_id for r in one_.collect()] == ["o1"]
    assert sorted(map(str, built.leader_history.collect())) == sorted(map(str, Datasets(spark, raw).leader_history.collect()))


# --- the gate


def test_a_version_that_fails_its_tests_is_not_published(spark, tmp_path):
    store = MartStore(spark, str(tmp_path))
    good = raw_layer(spark, orders=[order("a")], sellers=[{"seller_id": "s"}])
    pipeline.build(spark, good, store)
    before, names = marts(store), store.published()
    bad = {
        "unique mart_orders_wide order_id": raw_layer(spark, orders=[order("a"), order("a")]),
        "not_null mart_orders_wide order_id": raw_layer(spark, orders=[order(None)]),
        "accepted_values mart_orders_wide order_status": raw_layer(spark, orders=[order("a", order_status="lost")]),
        "unique mart_sellers_wide seller_id": raw_layer(spark, sellers=[{"seller_id": "s", "seller_city": c} for c in "xy"]),
        "not_null mart_sellers_wide seller_id": raw_layer(spark, sellers=[{"seller_id": None}]),
    }
    for failure, layer in bad.items():
        with pytest.raises(pipeline.RejectedBuild, match=failure):
            pipeline.build(spark, layer, store)
        assert store.published() == names and marts(store) == before, failure
    assert json.loads((tmp_path / "published" / f"{names[0]}.json").read_text())["sellers"] == names[0]


# --- read-only SQL


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = MartStore(spark, str(tmp_path_factory.mktemp("marts")))
    pipeline.build(spark, raw_layer(spark, orders=[order("a"), order("b")], sellers=[{"seller_id": "s"}]), store)
    return store


READS = [
    "select count(*) as n from {mart_orders_wide}",
    "with x as (select * from {mart_orders_wide}), y as (select order_id from x) select count(*) as n from x join y using (order_id)",
    "select count(*) as n from (select order_id from {mart_orders_wide} union all select seller_id from {mart_sellers_wide} where 1 = 0)",
    "select count(*) as n from {mart_orders_wide} where order_id in (select order_id from {mart_orders_wide} where customer_id is not null)",
    "select sum(n) as n from (select order_status, count(*) as n from {mart_orders_wide} group by 1 having count(*) > 0 order by 1 limit 5)",
    "select max(r) as n from (select row_number() over (order by order_id) as r from {mart_orders_wide})",
    "select count(*) as n from {mart_orders_wide} o lateral view explode(array(1)) e as z where exists (select 1 from {mart_orders_wide} i where i.order_id = o.order_id)",
    "select n from (values (2)) as t(n) where n = {n}",
]


@pytest.mark.parametrize("sql", READS)
def test_queries_are_answered(store, sql):
    assert one(store.query(sql, n=2)).n == 2


@pytest.mark.parametrize(
    "sql",
    [
        "create view v as select 1 as n",
        "create or replace temp view v as select * from {mart_orders_wide}",
        "create table t as select 1 as n",
        "insert overwrite directory '/tmp/w/refused' using parquet select * from {mart_orders_wide}",
        "insert into {mart_orders_wide} select * from {mart_orders_wide}",
        "from {mart_orders_wide} insert overwrite directory '/tmp/w/refused' using parquet select *",
        "with x as (select * from {mart_orders_wide}) insert into t select * from x",
        "drop table t",
        "set spark.sql.shuffle.partitions = 3",
        "cache table t as select 1",
        "show tables",
        "explain select 1",
        "select * from other",
        "select * from {mart_orders_wide} where order_id in (select a from other)",
        "with x as (select * from other) select * from x",
        "select * from parquet.`/tmp`",
        "select reflect('java.lang.System', 'getProperty', 'user.name')",
        "select * from {unknown}",
        "select 1 as n; select 2 as n",
    ],
)
def test_all_else_is_refused(store, sql):
    with pytest.raises(Exception) as raised:
        store.query(sql).collect()
    assert isinstance(raised.value, RefusedStatement) or "PARSE_SYNTAX_ERROR" in str(raised.value), raised.value
    assert [t.name for t in store.spark.catalog.listTables() if t.name.startswith(("vitrine_", "v"))] == []


def test_values_are_quoted_and_staging_has_names(spark, store):
    text = "o'; drop table x --\\"
    assert one(store.query("select {t} as t, {n} as n, {z} as z", t=text, n=None, z=1.5)).t == text
    d = Datasets(spark, raw_layer(spark, orders=[order("a")]), store)
    assert one(d.query("select s.order_id as k from {stg_orders} s join {mart_orders_wide} m using (order_id)")).k == "a"
    with pytest.raises(RefusedStatement):
        d.query("drop view {stg_orders}")
