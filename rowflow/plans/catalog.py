"""Every registered query: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import math
import time
from collections import Counter
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import check_status, lag_label, latency_color, latency_label, latency_status, line_total
from ..functions.labels import PROBE_TIMEOUT
from ..operators import digests, dml, integrity, latency, markers, sync
from ..operators.allocation import KeyAllocator
from ..operators.latest import current_rows, drop_tombstones, latest_by_key, live_keys, merge_newest
from ..schemas import ORDERS
from ..session import COMPRESSED, remove, work_dir
from ..sources import generate
from ..sources.changes import (
    change_envelopes,
    change_events,
    decode_envelopes,
    folder_of,
    read_changes,
    sorted_changes,
    typed_changes,
    union_all,
    write_routed,
)
from ..sources.chunks import ChunkedSnapshot
from ..sources.snapshot import snapshot_rows
from ..streaming.lag import LagSampler, RowCounts, lag_samples
from ..streaming.probes import ProbeStatistics, follow
from ..streaming.references import References
from ..streaming.replicate import Upkeep, await_queries, batch_metrics, observed_markers, routed_feed, run_available, start
from ..streaming.signed import SIGNED_CUSTOMER_TIERS, SIGNED_DAILY_ORDERS, Signed, SignedView
from ..streaming.store import KeyedTable
from ..streaming.verify import verify_sync
from . import reports
from .mapping import KEYS, WIDE, Tables, as_of
from .views import CUSTOMER_TIERS, DAILY_ORDERS, View

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the test tables under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


# -- sources -------------------------------------------------------------------------


@query
def snapshot_scan(t: Tables) -> DataFrame:
    return snapshot_rows(t.orders())


@query
def change_scan(t: Tables) -> DataFrame:
    """The order feed out of a feed of two tables, scanned and typed again."""
    path = _write_feed(t, ["orders", "products"])
    envelopes = read_changes(t.spark, path, stream=False)
    return typed_changes(envelopes, "orders", t.orders().schema, KEYS["orders"])


@query
def snapshot_plus_changes(t: Tables) -> DataFrame:
    return current_rows(t.order_feed(), KEYS["orders"])


@query
def current_scan(t: Tables) -> DataFrame:
    """Stored snapshot merged with a stored log."""
    table = KeyedTable(t.spark, work_dir(t.spark, "current"), "orders", t.orders().schema, KEYS["orders"])
    table.create(snapshot_rows(t.orders())).append(t.order_log(), 0)
    return table.current()


# -- upsert semantics ----------------------------------------------------------------


@query
def upsert_latest(t: Tables) -> DataFrame:
    return latest_by_key(t.order_feed(), KEYS["orders"])


@query
def apply_deletes(t: Tables) -> DataFrame:
    """Items after their returns were deleted."""
    return current_rows(t.item_feed(), KEYS["order_items"])


@query
def apply_updates(t: Tables) -> DataFrame:
    """Products after the price updates."""
    changed = ["product_id", "price", "stock_quantity", "is_active"]
    newest = latest_by_key(t.product_feed().select("op", "seq", *changed), KEYS["products"])
    return newest.where(F.col("op") == "u").select(*changed)


@query
def replay_idempotent(t: Tables) -> DataFrame:
    """The whole log delivered twice."""
    delivered = union_all([t.order_feed(), t.order_log()])
    return current_rows(delivered, KEYS["orders"])


@query
def late_and_duplicate(t: Tables) -> DataFrame:
    """The log applied first, and the older snapshot, late, onto the result."""
    applied = latest_by_key(t.order_log(), KEYS["orders"])
    late = latest_by_key(snapshot_rows(t.orders()), KEYS["orders"])
    return drop_tombstones(merge_newest(applied, late, KEYS["orders"]))


@query
def key_change(t: Tables) -> DataFrame:
    """Items moved to another product: one update becomes a delete and an insert."""
    events = t.order_items().select(
        F.lit("u").alias("op"),
        F.lit(9).cast("bigint").alias("seq"),
        F.struct("product_id", "quantity").alias("before"),
        F.struct(F.col("supplier_id").alias("product_id"), "quantity").alias("after"),
    )
    rows = dml.event_rows(events, ["product_id"])
    return rows.groupBy("op", "product_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("quantity").cast("bigint").alias("quantity")
    )


@query
def contract_violations(t: Tables) -> DataFrame:
    """Documents as movement notes, with labels as products: too long or missing values."""
    labels = t.read("labels").select("doc_id", F.col("quality").alias("product_id"))
    rows = t.read("documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("movement_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("source").alias("movement_type"),
        F.col("n_chars").cast("int").alias("quantity"),
        F.col("text").alias("notes"),
        as_of().alias("created_at"),
    )
    return integrity.contract_violations(rows, WIDE["inventory_movements"]).select("movement_id", "reasons")


# -- projections and filters ---------------------------------------------------------


@query
def project_keys(t: Tables) -> DataFrame:
    return t.customers().select("customer_id")


@query
def marker_equals(t: Tables) -> DataFrame:
    return t.customers().where(markers.marked(F.col("last_name"), "Customer#000000007"))


@query
def marker_prefix(t: Tables) -> DataFrame:
    return t.orders().where(F.col("shipping_address").like("batch_%"))


@query
def marker_affix(t: Tables) -> DataFrame:
    return t.customers().where(F.col("email").like("test_%@example.com")).select("customer_id", "email")


@query
def status_in(t: Tables) -> DataFrame:
    return t.orders().where(F.col("order_status").isin("PENDING", "SHIPPED", "DELIVERED"))


@query
def cleanup_predicate(t: Tables) -> DataFrame:
    return t.orders().where(markers.removable_orders())


@query
def line_totals(t: Tables) -> DataFrame:
    return t.order_items().select(
        *KEYS["order_items"], line_total(F.col("quantity"), F.col("unit_price")).alias("line_total")
    )


@query
def fill_defaults(t: Tables) -> DataFrame:
    """New orders given by customer and address only."""
    rows = t.customers().select("customer_id", F.col("email").alias("shipping_address"))
    return dml.fill_defaults(rows, WIDE["orders"], as_of())


# -- joins that drive changes --------------------------------------------------------


def _deleted(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.select("op", "seq", *[F.col(f"before.{k}").alias(k) for k in keys])


@query
def delete_by_join(t: Tables) -> DataFrame:
    orders = t.orders().where(markers.removable_orders(markers.TEST_ITEM_ADDRESSES)).select("order_id")
    return _deleted(dml.delete_events(t.order_items(), orders, 10, ["order_id"]), KEYS["order_items"])


@query
def delete_by_subquery(t: Tables) -> DataFrame:
    orders = t.orders().where(markers.like_any(F.col("shipping_address"), markers.BENCH_ADDRESSES)).select("order_id")
    return _deleted(dml.delete_events(t.order_items(), orders, 10, ["order_id"]), KEYS["order_items"])


@query
def fk_orphans(t: Tables) -> DataFrame:
    """Items whose order was deleted by the feed."""
    orders = live_keys(t.order_feed(), KEYS["orders"])
    return integrity.fk_orphans(t.order_items(), orders, "order_id").select(*KEYS["order_items"], "total_price")


@query
def cascade_delete(t: Tables) -> DataFrame:
    """Items that go with the orders of the test cleanup."""
    parents = dml.delete_events(t.orders(), markers.removable_orders(), 11)
    return _deleted(integrity.cascade_events(parents, t.order_items(), "order_id"), KEYS["order_items"])


@query
def restrict_delete(t: Tables) -> DataFrame:
    """Products that the test cleanup may or may not delete: items that their feed leaves may refer to them."""
    candidates = t.products().where(markers.like_any(F.col("sku"), markers.TEST_SKUS))
    items = live_keys(t.item_feed(), KEYS["order_items"])
    return integrity.restrict_deletes(candidates.select("product_id", "sku"), items, "product_id")


# -- counts and verdicts -------------------------------------------------------------


@query
def table_counts(t: Tables) -> DataFrame:
    return sync.table_counts(t.all())


@query
def marker_count(t: Tables) -> DataFrame:
    tables = t.all()
    return sync.table_counts(
        {
            "orders": tables["orders"].where(F.col("shipping_address").like("batch_%")),
            "customers": tables["customers"].where(F.col("email").like("test_%@example.com")),
            "products": tables["products"].where(F.col("sku").like("SKU_%")),
            "inventory_movements": tables["inventory_movements"].where(F.col("notes").like("Test movement %")),
        }
    )


def _sync_report(t: Tables) -> DataFrame:
    """Source tables against the tables that the feeds lead to."""
    return sync.sync_report(*_counts(t))


@query
def sync_report(t: Tables) -> DataFrame:
    return _sync_report(t)


@query
def sync_exact(t: Tables) -> DataFrame:
    return sync.sync_verdict(_sync_report(t), "exact")


@query
def sync_at_least(t: Tables) -> DataFrame:
    return sync.sync_verdict(_sync_report(t), "at_least")


def _counts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Source counts, and counts of the tables that the feeds lead to."""
    applied = {n: live_keys(feed, KEYS[n]) for n, feed in t.feeds().items()}
    return sync.table_counts(t.all()), sync.table_counts(applied)


@query
def monitor_report(t: Tables) -> DataFrame:
    return reports.monitor_report(*_counts(t), t.probe_results())


@query
def check_report(t: Tables) -> DataFrame:
    return reports.check_report(*_counts(t), t.probe_results())


@query
def monitor_json(t: Tables) -> DataFrame:
    """The whole report as one document, read back into its numbers."""
    report = reports.monitor_report(*_counts(t), t.probe_results())
    document = reports.monitor_json(report, t.probe_results(), as_of())
    counts = "source_count:bigint,target_count:bigint,lag:bigint"
    entry = f"struct<{counts},last_latency_ms:bigint,avg_latency_ms:double,p95_latency_ms:bigint>"
    totals = ["timestamp", "total_probes", "successful_probes", "failed_probes"]
    shape = f"timestamp string, total_probes bigint, successful_probes bigint, failed_probes bigint, tables map<string,{entry}>"
    read = document.select(F.from_json("document", shape).alias("d")).select("d.*")
    exploded = read.select(*totals, F.explode("tables").alias("table", "entry"))
    return exploded.select(*totals, "table", "entry.*")


@query
def report_json(t: Tables) -> DataFrame:
    counts = _sync_report(t).select("table", "source_count", "target_count", "lag", "status")
    return counts.select(F.to_json(F.struct("*")).alias("line"))


@query
def lag_labels(t: Tables) -> DataFrame:
    """Stock of every product against what its items asked for, as signed labels."""
    sold = t.order_items().groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("sold"))
    lag = F.col("stock_quantity").cast("bigint") - F.coalesce(F.col("sold"), F.lit(0))
    return t.products().join(sold, "product_id", "left").select("product_id", lag_label(lag).alias("label"))


# -- summaries -----------------------------------------------------------------------


def _view(feed: DataFrame, keys: list[str], view: View) -> DataFrame:
    return view.compute(current_rows(feed.select("op", "seq", *keys, *view.reads), keys))


@query
def daily_order_summary(t: Tables) -> DataFrame:
    return _view(t.order_feed(), KEYS["orders"], DAILY_ORDERS)


@query
def customer_tier_summary(t: Tables) -> DataFrame:
    return _view(t.customer_feed(), KEYS["customers"], CUSTOMER_TIERS)


# -- latency -------------------------------------------------------------------------


@query
def probe_latency(t: Tables) -> DataFrame:
    return t.joined_probes()


@query
def latency_stats(t: Tables) -> DataFrame:
    return latency.latency_stats(t.probe_results())


@query
def latency_p95(t: Tables) -> DataFrame:
    return latency.latency_stats(latency.last_n(t.probe_results())).select("table", "p95_ms")


@query
def latency_p99(t: Tables) -> DataFrame:
    """Over every probe of all time, as the load summary takes it."""
    return latency.latency_overall(t.probe_results(), (99,))


@query
def latency_last100(t: Tables) -> DataFrame:
    return latency.last_n(t.probe_results())


@query
def latency_overall(t: Tables) -> DataFrame:
    return latency.latency_overall(latency.last_n(t.probe_results()))


@query
def latency_running(t: Tables) -> DataFrame:
    return latency.running_stats(t.probe_results())


@query
def latency_last(t: Tables) -> DataFrame:
    return latency.last_latency(t.probe_results())


@query
def probe_success(t: Tables) -> DataFrame:
    return latency.probe_success(t.probe_results())


def _labels(name: str, label: Callable) -> None:
    def run(t: Tables) -> DataFrame:
        return t.probe_results().select("probe_seq", label(F.col("latency_ms")).alias(name))

    run.__name__ = name
    query(run)


_labels("latency_label", latency_label)
_labels("latency_color", latency_color)
_labels("latency_status", latency_status)
_labels("check_status", check_status)


@query
def load_summary(t: Tables) -> DataFrame:
    return sync.load_summary(t.load_results())


@query
def throughput(t: Tables) -> DataFrame:
    return sync.throughput(t.load_results())


# -- limits --------------------------------------------------------------------------


@query
def latest_orders(t: Tables) -> DataFrame:
    return t.orders().orderBy(F.col("order_id").desc()).limit(5)


@query
def id_pool(t: Tables) -> DataFrame:
    return generate.id_pool(t.products(), "product_id")


# -- change producers ----------------------------------------------------------------


@query
def insert_events(t: Tables) -> DataFrame:
    events = dml.insert_events(t.customers(), 7)
    return events.select("op", "seq", F.col("before").isNull().alias("no_before"), "after.*")


@query
def assign_keys(t: Tables) -> DataFrame:
    """One new order for every customer, keyed after the greatest order."""
    rows = t.customers().select("customer_id")
    return dml.assign_keys(rows, t.orders(), "order_id", "customer_id")


@query
def update_events(t: Tables) -> DataFrame:
    """Everything undelivered is shipped; what is touched carries the statement time."""
    events = dml.update_events(
        t.orders(),
        F.col("order_status") != "DELIVERED",
        {"order_status": F.lit("SHIPPED")},
        8,
        ORDERS.touched,
        as_of(),
    )
    images = [F.col(f"{i}.{c}").alias(f"{i}_{c}") for i in ("before", "after") for c in ("order_status", "updated_at")]
    return events.select("op", "seq", F.col("after.order_id").alias("order_id"), *images)


@query
def delete_events(t: Tables) -> DataFrame:
    doomed = markers.like_any(F.col("notes"), markers.TEST_NOTES)
    return _deleted(dml.delete_events(t.inventory_movements(), doomed, 9), ["movement_id", "notes"])


@query
def cleanup_all(t: Tables) -> DataFrame:
    """Rows left in each table after both cleanups at the source, where items go with their orders and hold their products."""
    return sync.table_counts(markers.after_cleanups(t.all(), KEYS["order_items"]), "remaining")


# -- generated rows ------------------------------------------------------------------


def _generated(maker: Callable, table: str, t: Tables) -> DataFrame:
    numbers = generate.table_numbers(t.customers(), "customer_id")
    return maker(numbers, t.customers(), t.products(), "m1", as_of())[table]


@query
def gen_load_customers(t: Tables) -> DataFrame:
    return _generated(generate.load_rows, "customers", t)


@query
def gen_load_products(t: Tables) -> DataFrame:
    return _generated(generate.load_rows, "products", t)


@query
def gen_load_orders(t: Tables) -> DataFrame:
    return _generated(generate.load_rows, "orders", t)


@query
def gen_load_items(t: Tables) -> DataFrame:
    return _generated(generate.load_rows, "order_items", t)


@query
def gen_batch_orders(t: Tables) -> DataFrame:
    return generate.batch_orders(generate.table_numbers(t.orders(), "order_id"), "batch_m1")


@query
def gen_random(t: Tables) -> DataFrame:
    """Random orders and their items, one each per customer, side by side."""
    numbers = generate.table_numbers(t.customers(), "customer_id")
    made = generate.random_rows(numbers, t.customers(), t.products(), "m2", as_of())
    return made["orders"].join(made["order_items"], "order_no")


# -- streams -------------------------------------------------------------------------


def _write_feed(t: Tables, names: list[str], routed: bool = False) -> str:
    """The feeds of some tables as envelope files in the shared work folder, on request in a folder per table."""
    path = f"{work_dir(t.spark, 'feed')}/feed"
    commit = F.coalesce(F.col("created_at"), as_of())
    encode = change_events if len(names) == 1 else change_envelopes
    changes = union_all([encode(feed, n, KEYS[n], commit) for n, feed in t.feeds(names).items()])
    write_routed(changes, path) if routed else changes.write.options(**COMPRESSED).parquet(path)
    return path


def _stream(t: Tables, names: list[str], batches: int = 2) -> tuple[DataFrame, dict[str, KeyedTable], str]:
    """A feed that arrives in about ``batches`` micro-batches, and empty tables for it."""
    path = _write_feed(t, names)
    schemas = {n: rows.schema for n, rows in t.all().items() if n in names}
    row = schemas[names[0]] if len(names) == 1 else None
    files = len(read_changes(t.spark, path, stream=False, row=row).inputFiles())
    feed = read_changes(t.spark, path, max_files=math.ceil(files / batches), row=row, consume=True)
    root = path.rsplit("/", 1)[0]
    return feed, {n: KeyedTable(t.spark, f"{root}/target", n, schemas[n], KEYS[n]) for n in names}, root


def _routes(t: Tables, names: list[str], batches: int = 2) -> tuple[Callable[[list[str], bool], DataFrame], dict[str, KeyedTable], str]:
    """The same with a folder of the feed per table."""
    path = _write_feed(t, names, routed=True)
    files = Counter(f.rsplit("/", 2)[1] for f in read_changes(t.spark, path, stream=False).inputFiles())

    def feed(names: list[str], unnamed: bool) -> DataFrame:
        found = sum(files[f"table={n}"] for n in names)
        return routed_feed(t.spark, path, max_files=max(1, math.ceil(found / batches)), consume=True)(names, unnamed)

    root = path.rsplit("/", 1)[0]
    tables = {n: KeyedTable(t.spark, f"{root}/target", n, rows.schema, KEYS[n]) for n, rows in t.all().items() if n in names}
    return feed, tables, root


@query
def stream_upserts(t: Tables) -> DataFrame:
    """The order table after its feed went through the single-table job."""
    feed, tables, root = _stream(t, ["orders"])
    run_available(feed, tables, root)
    return tables["orders"].current()


@query
def fanout_apply(t: Tables) -> DataFrame:
    """All five tables out of one job: the sync report against the source, and whether contents are what the feeds say."""
    rows = t.all()
    feed, tables, root = _stream(t, list(rows))
    worked_off = lambda: remove(t.spark, f"{root}/feed")
    report = verify_sync(start(feed, tables, root, interval=None), rows, tables, 3600, worked_off).report
    return report.join(_same_contents(t, tables), "table")


def _same_contents(t: Tables, tables: dict[str, KeyedTable]) -> DataFrame:
    """Whether stored tables hold what their feeds lead to."""
    found = digests.collected_checksums({n: lambda only, k=table: k.current(only=only) for n, table in tables.items()}, KEYS)
    feeds = t.feeds(list(tables)).items()
    expected = digests.collected_checksums({n: lambda only, n=n, f=f: current_rows(f.where(only), KEYS[n]) for n, f in feeds}, KEYS)
    wanted = expected.select("table", F.col("checksum").alias("__wanted"))
    return found.join(wanted, "table").select("table", (F.col("checksum") == F.col("__wanted")).alias("same_content"))


@query
def content_differences(t: Tables) -> DataFrame:
    """Orders after a replication that lost, made up and garbled some, against the orders that their feed leads to."""
    key, amount = F.col("order_id"), F.col("total_amount")
    feed = t.order_feed()
    garbled = F.when(key % 97 == 3, amount + 1).when(key % 97 != 4, amount)
    damaged = feed.where(key % 101 != 5).withColumn("total_amount", garbled.cast(feed.schema["total_amount"].dataType))
    made_up = feed.where((F.col("op") == "r") & (key % 103 == 7)).withColumn("order_id", -key)
    table = KeyedTable(t.spark, work_dir(t.spark, "damaged"), "orders", t.orders().schema, KEYS["orders"])
    table.create(damaged.where(F.col("op") == "r")).append(damaged.where(F.col("op") != "r").unionByName(made_up), 0)
    return digests.content_differences(current_rows(feed, KEYS["orders"]), table.current(), KEYS["orders"])


@query
def orphans_current(t: Tables) -> DataFrame:
    """Orders that items refer to and that are gone, kept current by a job for both tables."""
    feed, tables, root = _stream(t, ["orders", "order_items"])
    for table in tables.values():
        table.create()
    kept = References(t.spark, f"{root}/references", "order_items", "orders", "order_id", tables["orders"].columns["order_id"].dataType)
    kept.build(tables["order_items"], tables["orders"])
    run_available(feed, tables, root, references=[kept])
    remove(t.spark, f"{root}/feed")
    return kept.orphans.current().select("order_id", F.col("n").alias("n_items"))


@query
def restrict_current(t: Tables) -> DataFrame:
    """Products that the test cleanup may or may not delete, by counts of references that followed the stream of items."""
    feed, tables, root = _stream(t, ["order_items", "products"])
    for table in tables.values():
        table.create()
    kept = References(t.spark, f"{root}/references", "order_items", "products", "product_id", tables["products"].columns["product_id"].dataType)
    kept.build(tables["order_items"], tables["products"])
    run_available(feed, tables, root, references=[kept])
    candidates = t.products().where(markers.like_any(F.col("sku"), markers.TEST_SKUS))
    return kept.restrict(candidates.select("product_id", "sku"))


@query
def per_table_jobs(t: Tables) -> DataFrame:
    """Every table out of a job of its own, which reads that table's part of the feed: rows, and whether contents are what the feeds say."""
    feed, tables, root = _routes(t, list(KEYS))
    running = dict(zip(tables, start(feed, tables, root, "per_table", interval=None), strict=True))
    while running:
        for name in [n for n, job in running.items() if await_queries([job], 1)]:
            del running[name]
            remove(t.spark, folder_of(f"{root}/feed", name))  # no other job reads it
    counts = sync.table_counts({n: table.current(columns=[]) for n, table in tables.items()})
    return counts.join(_same_contents(t, tables), "table")


@query
def selected_tables(t: Tables) -> DataFrame:
    """One job for the tables that were asked for, out of the feed of all."""
    feed, tables, root = _routes(t, list(KEYS))
    asked = "customers, products, nonsense"
    run_available(feed, tables, root, select=asked)
    done = {n: table for n, table in tables.items() if table.version() is not None}
    counts = sync.table_counts({n: table.current(columns=[]) for n, table in done.items()})
    return counts.join(_same_contents(t, done), "table")


@query
def lag_over_time(t: Tables) -> DataFrame:
    """The last sample of source and target counts of a job for two tables, with counts kept batch by batch."""
    rows = {n: r for n, r in t.all().items() if n in ("orders", "customers")}
    feed, tables, root = _stream(t, list(rows))
    for table in tables.values():
        table.create()
    counts = RowCounts(t.spark, root).build(tables)
    sampler = LagSampler(lambda: sync.table_counts(rows), counts, root)
    run_available(feed, tables, root, counts=counts)
    sampler.sample()
    newest = lag_samples(t.spark, root).groupBy("table").agg(F.max_by(F.struct("source_count", "target_count", "lag", "lag_label", "status"), "ts").alias("s"))
    return newest.select("table", "s.*")


@query
def steady_latency(t: Tables) -> DataFrame:
    """Statistics of all probes and of the last hundred of each table, kept while the probes arrive in about four batches."""
    path = work_dir(t.spark, "probes")
    results = t.probe_results().withColumn("marker", F.concat(F.lit("probe_"), F.col("probe_seq").cast("string")))
    files = max(2, t.spark.sparkContext.defaultParallelism)  # of one batch: a task each, all cores at work
    results.repartition(4 * files).write.parquet(f"{path}/results")
    feed = t.spark.readStream.schema(results.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/results")
    kept = ProbeStatistics(t.spark, path)
    await_queries([follow(feed, kept, path)])
    recent = latency.latency_stats(kept.recent(), percents=(95,))
    recent = recent.select("table", *[F.col(c).alias(f"recent_{c}") for c in ("n", "avg_ms", "p95_ms")])
    return kept.stats().join(recent, "table").join(kept.last(), "table")


@query
def allocate_keys(t: Tables) -> DataFrame:
    """Two loads of one new order per customer: their rows, their keys, and how many keys anything else has as well."""
    orders, rows = t.orders().select("order_id"), t.customers().select("customer_id")
    keys = KeyAllocator(t.spark, work_dir(t.spark, "keys"), "order_id").create(orders)
    given = [keys.load(rows, name).select("order_id", F.lit(k).alias("load")) for k, name in enumerate(("first", "second"), 1)]
    each = union_all([orders.select("order_id", F.lit(0).alias("load")), *given]).groupBy("order_id")
    each = each.agg(F.count(F.lit(1)).alias("__n"), F.max("load").alias("load"))
    loads = each.groupBy("load").agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("__n") > 1).alias("n_shared"))
    return loads.where(F.col("load") > 0)


@query
def batch_measures(t: Tables) -> DataFrame:
    """Changes and deletes that the job measured over all its batches, and whether its latencies are in order."""
    feed, tables, root = _stream(t, list(KEYS))
    run_available(feed, tables, root)
    measured = batch_metrics(tables, f"{root}/replicate-all")
    ordered = (F.col("min_ms") <= F.col("avg_ms")) & (F.col("avg_ms") <= F.col("max_ms"))
    return measured.groupBy("table").agg(
        F.sum("changes").cast("bigint").alias("changes"),
        F.sum("deletes").cast("bigint").alias("deletes"),
        F.max("last_seq").alias("last_seq"),
        F.bool_and(ordered).alias("latencies_in_order"),
    )


@query
def streamed_visibility(t: Tables) -> DataFrame:
    """Every probe row of the order feed as the running job saw it become visible."""
    feed, tables, root = _stream(t, ["orders"])
    probe = F.col("shipping_address").like("latency_test_%")
    written = datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")  # the job's clock for sources is UTC, too
    began = time.monotonic()
    run_available(feed, tables, root, markers={"orders": ("shipping_address", probe)})
    # A probe may take as long as the run that all of its markers arrive in, however long that is here.
    timeout = PROBE_TIMEOUT + math.ceil(1000 * (time.monotonic() - began))
    seen = observed_markers(t.spark, f"{root}/replicate-all")
    sent = t.orders().where(probe).select(
        F.col("order_id").alias("probe_seq"),
        F.lit("orders").alias("table"),
        F.col("shipping_address").alias("marker"),
        F.to_timestamp_ntz(F.lit(written)).alias("insert_ts"),
    )
    return latency.probe_latency(sent, seen, timeout_ms=timeout).select("table", "marker", "success")


@query
def quarantined_changes(t: Tables) -> DataFrame:
    """A feed with broken messages: what was applied and what was set aside, by reason; together all that was sent."""
    commit = F.coalesce(F.col("created_at"), as_of())
    feed = t.order_feed()
    sent = change_envelopes(feed, "orders", KEYS["orders"], commit, [F.coalesce("order_id", F.lit(0)).alias("key")])
    image, key = F.col("after_json"), F.col("key")
    sent = sent.withColumn(
        "after_json",
        F.when(key % 97 == 1, F.substr(image, F.lit(1), F.lit(9)))
        .when(key % 97 == 2, F.regexp_replace(image, r'"total_amount":[0-9.]+', '"total_amount":"abc"'))
        .when(key % 97 == 3, F.regexp_replace(image, r'"order_id":[0-9]+', '"order_id":null'))
        .otherwise(image),
    )
    sent = sent.withColumn("table", F.when(key % 97 != 5, F.col("table")))
    whole = F.to_json(F.struct(*[c for c in sent.columns if c != "key"]))
    message = F.when(key % 97 == 4, F.substr(whole, F.lit(1), F.lit(30))).otherwise(whole)
    path = work_dir(t.spark, "messages")
    sent.select(message.alias("value")).write.parquet(path)
    received = decode_envelopes(t.spark.read.parquet(path))
    changes = sorted_changes(received, "orders", t.orders().schema, KEYS["orders"])
    return changes.groupBy("reasons").agg(F.count(F.lit(1)).alias("messages"))


@query
def chunked_snapshot(t: Tables) -> DataFrame:
    """Orders copied in four chunks while their log goes on: every chunk sees the source as far as the log is by then."""
    feed, log = t.order_feed(), t.order_log()
    root = work_dir(t.spark, "chunks")
    end = log.agg(F.max("seq")).first()[0] or 0
    reached = [0]
    table = KeyedTable(t.spark, root, "orders", t.orders().schema, KEYS["orders"]).create()

    def goes_on(chunk: int) -> None:
        last = reached[0]
        reached[0] = end * (chunk + 1) // 4
        table.append(log.where((F.col("seq") > last) & (F.col("seq") <= reached[0])), chunk)

    source = lambda inside: current_rows(feed.where((F.col("seq") <= reached[0]) & inside), KEYS["orders"])
    read = ChunkedSnapshot(table, f"{root}/snapshot", source, lambda: reached[0]).run(4, goes_on)
    table.append(log.where(F.col("seq") > reached[0]), read)  # where there were fewer chunks
    return table.current()


@query
def compact_equals_replay(t: Tables) -> DataFrame:
    """A stored snapshot, the log streamed over it, compacted after every batch."""
    feed, tables, root = _stream(t, ["orders"])
    tables["orders"].create(snapshot_rows(t.orders()))
    run_available(feed, tables, root, upkeep=Upkeep(compact_every=1))
    return tables["orders"].current()


def _refreshed(t: Tables, signed: Signed) -> DataFrame:
    """A view built on the snapshot and kept current batch by batch, by what the batches took away and put there."""
    view = signed.view
    feed, tables, root = _stream(t, [view.source])
    table = tables[view.source].create(snapshot_rows(t.all()[view.source]))
    member = table.columns[signed.member].dataType if signed.member else None
    stored = SignedView(t.spark, f"{root}/views", signed, member).build(table)
    run_available(feed, tables, root, views={view.source: [(view, stored)]})
    return stored.current()


@query
def view_incremental(t: Tables) -> DataFrame:
    return _refreshed(t, SIGNED_DAILY_ORDERS)


@query
def tier_view_incremental(t: Tables) -> DataFrame:
    return _refreshed(t, SIGNED_CUSTOMER_TIERS)
