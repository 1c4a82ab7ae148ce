"""The build job: raw layer, both marts, the tests that they must pass to be published."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.dates import month_start
from vitrine.functions.fixed_values import ORDER_STATUSES, RAW_FILES
from vitrine.functions.short_ids import short_ids
from vitrine.operators import day_sums, followups, quality, sellers_mart, staging
from vitrine.plans.datasets import Datasets
from vitrine.session import build_session, shared_folder, shuffles_removed
from vitrine.sources.files import names_in
from vitrine.sources.keyed import KeyedTable, Snapshot
from vitrine.sources.marts import WORK, Manifest, MartStore, MartVersion, month_of
from vitrine.sources.raw import RawReader, parquet_folder, seed
from vitrine.streaming.ingest import ingest


class RejectedBuild(RuntimeError):
    """A build that failed its tests; the pair published before stays."""

    def __init__(self, results: list[Row]):
        failed = [f"{r.test} {r.dataset} {r.column} ({r.failures})" for r in results if not r.passed]
        super().__init__("; ".join(failed))
        self.results = results


# --- tests that a version must pass


def observed(mart: DataFrame, name: str, tests: dict[str, tuple[str, str, Column]]) -> tuple[DataFrame, Callable]:
    """The mart, and the results of tests that count rows: they are counted while the mart is written.

    `tests`: for each label the column, the kind of test and what a failing row is.
    """
    seen = Observation(name)
    watched = mart.observe(seen, *[F.count_if(bad).alias(label) for label, (_, _, bad) in tests.items()])

    def results(written: DataFrame) -> list[Row]:
        # nothing is counted where the plan turns out to be empty
        counts = dict.fromkeys(tests, 0) if written.isEmpty() else seen.get
        return [
            Row(dataset=name, column=column, test=test, failures=counts[label], passed=counts[label] == 0)
            for label, (column, test, _) in tests.items()
        ]

    return watched, results


def _watched_orders(mart: DataFrame) -> tuple[DataFrame, Callable]:
    status = F.col("order_status")
    return observed(
        mart,
        "mart_orders_wide",
        {
            "key": ("order_id", "not_null", F.col("order_id").isNull()),
            "status": ("order_status", "accepted_values", status.isNotNull() & ~status.isin(ORDER_STATUSES)),
        },
    )


def _watched_sellers(mart: DataFrame) -> tuple[DataFrame, Callable]:
    missing = F.col("seller_id").isNull()
    return observed(mart, "mart_sellers_wide", {"key": ("seller_id", "not_null", missing)})


def _unique(rows: DataFrame, mart: str, key: str) -> list[Row]:
    return quality.unique_test(short_ids(rows.select(key)), mart, key).collect()  # one row


def _unique_orders(version: MartVersion) -> list[Row]:
    return _unique(version.orders(version.written()), "mart_orders_wide", "order_id")


def _publish(store: MartStore, version: MartVersion, results: list[Row]) -> None:
    """Publishes a version whose rows passed while they were written, if its keys are unique too.

    `results` has the uniqueness of orders already. It is read from what this version wrote, the key columns
    only; an order of a month that it did not write is none of those that it changed. A build that fails is
    never seen; its folders go when the store is pruned.
    """
    results = [*results, *_unique(version.sellers(), "mart_sellers_wide", "seller_id")]
    if not all(r.passed for r in results):
        raise RejectedBuild(results)
    store.publish(version)


# --- full refresh


def build(spark: SparkSession, raw: RawReader, store: MartStore, at: dict[str, int] | None = None) -> Datasets:
    """Full refresh of both marts.

    The orders mart is written first and the sellers mart reads it back, so its joins run once
    and a lost executor never recomputes more than one of the two. Both are published together
    when they are whole and have passed their tests; until then readers have the old pair. `at` are the
    numbers of the raw snapshots that `raw` reads, for a later refresh to go on from.
    """
    with shuffles_removed(spark):
        version = store.new_version(Manifest(raw=at or {}))
        plain = Datasets(spark, raw)
        short = Datasets(spark, lambda table: short_ids(raw(table)))  # what is shuffled has short ids
        orders, order_results = _watched_orders(short.mart_orders_wide)
        version.write_orders(orders)
        unique = _unique_orders(version)
        copies = not all(r.passed for r in unique)
        facts = followups.seller_facts(short.stg_order_items, short_ids(version.orders()), copies)
        version.write_facts(facts, deal=False)
        # the items have met their orders in the facts, so they are not joined again
        facts = day_sums.day_of(short_ids(version.sums("seller_facts")))
        sellers = day_sums.day_sellers(sellers_mart.seller_orders_of(facts, _BY_DAY, copies))
        _write_sums(version, version.orders(), sellers, deal=False)
        _write_sellers(version, plain.stg_sellers, store, order_results, unique)
    return Datasets(spark, raw, store)


_BY_DAY = ("order_month", "day")


def _write_sums(version: MartVersion, orders: DataFrame, sellers: DataFrame, deal: bool = True) -> None:
    """The tables of sums of the months that the version writes; those by month are read off those by day."""
    version.write_sums("day_states", day_sums.day_states(orders))
    version.write_sums("day_sellers", sellers, deal)
    months = version.written()
    version.write_sums("month_states", day_sums.month_states(version.sums("day_states", months)))
    version.write_sums("month_sellers", day_sums.month_sellers(short_ids(version.sums("day_sellers", months))))


def _write_sellers(
    version: MartVersion, sellers: DataFrame, store: MartStore, order_results: Callable, unique: list[Row]
) -> None:
    totals = day_sums.added_totals(version.sums("month_sellers"), ["seller_id"])
    mart, results = _watched_sellers(sellers_mart.sellers_from_totals(sellers, totals))
    version.write_sellers(mart)
    rows = version.orders(version.written())
    _publish(store, version, [*order_results(rows), *results(version.sellers()), *unique])


# --- incremental refresh

_BY_ORDER = ["orders", "order_items", "order_payments", "order_reviews"]


class Changes:
    """What came between two snapshots of the raw layer, and how it reaches the marts.

    A changed item, payment or review changes its order, a changed customer all orders of theirs; an
    order changes the months it was and is in, and the sellers of the items it had and has.
    """

    def __init__(self, spark: SparkSession, raw_dir: str, since: dict[str, int]):
        self.spark = spark
        self.tables = {t: KeyedTable(spark, raw_dir, t) for t in RAW_FILES}
        self.now = {t: table.snapshot() for t, table in self.tables.items()}
        self.then = {t: table.snapshot(since.get(t, 0)) for t, table in self.tables.items()}

    def reseeded(self) -> bool:
        return any(self.now[t].seed != self.then[t].seed for t in self.tables)

    def any(self) -> bool:
        return any(self.now[t].number != self.then[t].number for t in self.tables)

    def numbers(self) -> dict[str, int]:
        return {t: s.number for t, s in self.now.items()}

    def read(self, state: dict[str, Snapshot]) -> RawReader:
        return lambda table: self.tables[table].rows(state[table])

    def arrived(self, table: str) -> DataFrame:
        return self.tables[table].arrived_between(self.then[table], self.now[table])

    def _customers(self) -> DataFrame:
        known = F.col("customer_id").isNotNull()
        return self.arrived("customers").filter(known).select("customer_id").distinct()

    def orders(self) -> DataFrame:
        """order_id of every order that may look different, each once."""
        ids = None
        for table in _BY_ORDER:
            own = self.arrived(table).select("order_id")
            ids = own if ids is None else ids.unionByName(own)
        people = self._customers()
        for state in (self.then, self.now):
            bought = self.read(state)("orders").select("order_id", "customer_id")
            ids = ids.unionByName(bought.join(people, "customer_id", "left_semi").select("order_id"))
        return ids.filter(F.col("order_id").isNotNull()).distinct()

    def nameless_orders(self) -> DataFrame:
        """Orders without an id that came; they have no identity and are only ever added."""
        rows = self.arrived("orders").filter(F.col("order_id").isNull() & ~F.col("_deleted"))
        return rows.select(self.tables["orders"].schema.names)


def _only(raw: RawReader, ids: DataFrame, nameless: DataFrame | None) -> RawReader:
    """The raw layer with no other orders than those."""

    def read(table: str) -> DataFrame:
        if table not in _BY_ORDER:
            return raw(table)
        rows = raw(table)
        own = rows.join(ids, "order_id", "left_semi").select(rows.columns)
        return own.unionByName(nameless) if table == "orders" and nameless is not None else own

    return read


def refresh(spark: SparkSession, raw_dir: str, store: MartStore) -> Datasets:
    """Brings the marts up to what the raw layer is now; equal to a full build, and tested like one.

    The orders that changed are computed anew and take their place in the months they were and are in;
    other months are neither read nor written, the new version names their old folders. The sellers' sums
    of those months lose what these orders brought before and gain what they bring now; the sellers mart is
    made of the sums of all months. Without
    a version to go on from, or after a new seed, both marts are built in full.
    """
    raw = parquet_folder(spark, raw_dir)
    last = store.current().manifest if store.published() else Manifest()
    changes = Changes(spark, raw_dir, last.raw)
    if not last.raw or changes.reseeded():
        return build(spark, changes.read(changes.now), store, changes.numbers())
    if not changes.any():
        return Datasets(spark, raw, store)

    old = store.current()
    sums = {name: dict(months) for name, months in last.sums.items()}
    version = store.new_version(Manifest(dict(last.months), sums, last.sellers, changes.numbers()))
    ids = _kept(changes.orders(), store, version, "changed_orders")
    nameless = changes.nameless_orders()
    before = _only(changes.read(changes.then), ids, None)
    after = _only(changes.read(changes.now), ids, nameless)

    months = _months(before("orders")) | _months(after("orders"))
    folders = {m for m in last.months if _as_text(month_of(m)) in months}
    stay = old.orders(folders)
    gone = stay.join(ids, "order_id", "left_semi").select(stay.columns)
    rest = stay.join(ids, "order_id", "left_anti").select(stay.columns)
    fresh, results = _watched_orders(rest.unionByName(Datasets(spark, after).mart_orders_wide))
    version.forget(folders)
    version.write_orders(fresh)

    come = version.orders(version.written()).join(ids, "order_id", "left_semi").select(stay.columns)
    sold = [
        day_sums.day_sellers(
            sellers_mart.seller_orders(_with_seller(raw), day_sums.day_of(orders), _BY_DAY)
        )
        for raw, orders in ((before, gone), (after, come))
    ]
    sellers = sellers_mart.changed_totals(old.sums("day_sellers", folders), *sold)
    _write_sums(version, version.orders(version.written()), sellers)
    facts = old.sums("seller_facts", folders)
    others = facts.join(ids, "order_id", "left_anti").select(facts.columns)
    version.write_facts(others.unionByName(followups.seller_facts(staging.order_items(after("order_items")), come)))
    unique = _unique_orders(version)
    _write_sellers(version, staging.sellers(changes.read(changes.now)("sellers")), store, results, unique)
    return Datasets(spark, changes.read(changes.now), store)


def _with_seller(raw: RawReader) -> DataFrame:
    return staging.order_items(raw("order_items")).filter(F.col("seller_id").isNotNull())


def _kept(df: DataFrame, store: MartStore, version: MartVersion, name: str) -> DataFrame:
    """A table written beside the marts for the time of a refresh; the next prune takes it."""
    folder = f"{store.root}/{WORK}/version={version.name}/{name}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _as_text(month: str | None) -> str | None:
    return month and month[:7]


def _months(raw_orders: DataFrame) -> set[str | None]:
    """The months of orders. As many as there are months, so they fit the driver."""
    staged = staging.orders(raw_orders)
    rows = staged.select(month_start(F.col("order_purchase_at")).alias("m")).distinct().collect()
    return {r.m and r.m.strftime("%Y-%m") for r in rows}


# --- the job


def verify(built: Datasets) -> tuple[DataFrame, DataFrame]:
    """The twenty key tests and the grain audit over the stored layers."""
    return built.dq_suite, built.granularity_audit


def take_in(spark: SparkSession, landing: str, raw_dir: str, checkpoints: str) -> None:
    """Takes in what lies in the landing folders: <table>/ for rows, <table>-deletes/ for keys to delete.

    Tables side by side; of one table the deletions come after the rows, for it has one writer at a time.
    """
    found = names_in(spark, landing)
    for suffix in ("", "-deletes"):
        queries = [
            ingest(spark, t, f"{landing}/{t}{suffix}", raw_dir, f"{checkpoints}/{t}{suffix}", deletes=bool(suffix))
            for t in RAW_FILES
            if f"{t}{suffix}" in found
        ]
        for query in queries:
            query.awaitTermination()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Build and verify the marketplace marts.")
    parser.add_argument("--csv", help="folder of raw CSV files; loads the raw layer first")
    parser.add_argument("--landing", help="folder in which files of each table arrive; takes them in and refreshes")
    parser.add_argument("--root", help="shared folder of raw layer and marts")
    parser.add_argument("--most-rejected", type=float, help="share of bad rows of a table to set aside in a load")
    parser.add_argument("--fold", action="store_true", help="folds what arrived into the raw tables afterwards")
    args = parser.parse_args(argv)

    spark = build_session()
    root = (args.root or shared_folder(spark)).rstrip("/")
    raw_dir, store = f"{root}/raw", MartStore(spark, f"{root}/marts")
    if args.csv:
        seed(spark, args.csv, raw_dir, most_rejected=args.most_rejected)
    if args.landing:
        take_in(spark, args.landing.rstrip("/"), raw_dir, f"{root}/ingest")
    try:
        built = refresh(spark, raw_dir, store)
    except RejectedBuild as refused:
        print(f"NOT PUBLISHED {refused}")
        return 1
    if args.fold:
        for table in RAW_FILES:
            KeyedTable(spark, raw_dir, table).fold()
    tests, audit = verify(built)

    results = tests.collect()  # twenty rows
    for row in results:
        print("PASS" if row.passed else f"FAIL {row.failures}", row.test, row.dataset, row.column)
    print(f"PASS={sum(r.passed for r in results)} TOTAL={len(results)}")
    for row in audit.collect():  # nine rows
        print(f"{row.table_name}: {row.duplicate_count} repeated keys")
    return int(any(not r.passed for r in results))


if __name__ == "__main__":
    raise SystemExit(main())
