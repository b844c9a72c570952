"""Registry of every query: name -> callable(spark, sf_dir) -> DataFrame.

Reports and diagnostics read the warehouse loaded (once per session) from
the test tables; ``stream_enriched`` loads its own warehouse through the
Structured Streaming loader; ``rollup_quarterly_materialized`` reads the
Parquet roll-up written next to the warehouse.
"""

from __future__ import annotations

import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.plans import diagnostics, extras, reports, views
from starmart.plans.build import new_warehouse, warehouse_for
from starmart.plans.oracle import TEST_YEAR
from starmart.session import checkpoint_root
from starmart.sources import files, testdata
from starmart.streaming.loader import WarehouseLoader
from starmart.schemas import EVENT
from starmart.streaming.pipeline import run_file_sink, run_to_completion, stream_static_join

_LOCK = threading.RLock()
_STREAMED: dict[tuple, object] = {}
_DONE: set = set()


def _on_star(fn, year_param: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = warehouse_for(spark, sf_dir).star()
        return fn(star, year=TEST_YEAR) if year_param else fn(star)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _n_files(spark: SparkSession) -> int:
    """Files to land: one a core, so that writing them keeps every core busy."""
    return max(4, spark.sparkContext.defaultParallelism)


def stream_load(spark: SparkSession, sf_dir: str, n_files: int | None = None,
                max_bytes_per_trigger: str | None = None):
    """Load a fresh warehouse through the streaming loader: masters as a
    batch, then the transactions landed as ``n_files`` CSV files (default:
    the session's parallelism) and consumed with ``availableNow``, a
    quarter of the files per micro-batch, or ``max_bytes_per_trigger`` per
    micro-batch when given (bounded batches at any data size)."""
    n_files = n_files or _n_files(spark)
    wh = new_warehouse(spark, f"{sf_dir}-stream")
    loader = WarehouseLoader(wh)
    loader.load_masters(testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir))
    landing = f"{checkpoint_root(spark)}/starmart-landing/{uuid.uuid4().hex[:10]}"
    testdata.land_transactions(spark, sf_dir, landing, n_files=n_files, fmt="csv")
    run_to_completion(spark, wh, landing, max_files_per_trigger=max(1, n_files // 4),
                      max_bytes_per_trigger=max_bytes_per_trigger, loader=loader)
    return wh, loader, landing


def _streamed(spark: SparkSession, sf_dir: str):
    key = (sf_dir, checkpoint_root(spark))
    with _LOCK:
        if key not in _STREAMED:
            _STREAMED[key] = stream_load(spark, sf_dir)
        return _STREAMED[key]


def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.fact_enriched(_streamed(spark, sf_dir)[0].star())


def load_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read from the landed files, loaded as facts and rejected, for the
    streaming load (read = loaded + rejected, C7)."""
    wh, landing = _streamed(spark, sf_dir)[0], _streamed(spark, sf_dir)[2]
    loaded = wh.read("fact_sales").select(F.count(F.lit(1))).scalar()
    rejected = wh.read("rejects").select(F.count(F.lit(1))).scalar()
    return files.read_transactions(spark, landing).select(
        F.count(F.lit(1)).alias("read_rows"), loaded.alias("loaded_rows"), rejected.alias("rejected_rows"))


def dim_customer_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after loading the whole customer master twice:
    insert-if-absent (D5) leaves it equal to a single load."""
    key = ("reloaded", sf_dir, checkpoint_root(spark))
    with _LOCK:
        if key not in _STREAMED:
            wh = new_warehouse(spark, f"{sf_dir}-reload")
            loader = WarehouseLoader(wh)
            for _ in range(2):
                loader.load_masters(testdata.customers(spark, sf_dir), None)
            _STREAMED[key] = (wh,)
        wh = _STREAMED[key][0]
    return wh.read("dim_customer")


def _once(name: str, spark: SparkSession, sf_dir: str, make):
    key = (name, sf_dir, checkpoint_root(spark))
    with _LOCK:
        if key not in _STREAMED:
            _STREAMED[key] = make()
        return _STREAMED[key]


def _landed(spark: SparkSession, sf_dir: str, **kw) -> str:
    landing = f"{checkpoint_root(spark)}/starmart-landing/{uuid.uuid4().hex[:10]}"
    return testdata.land_transactions(spark, sf_dir, landing, n_files=_n_files(spark), **kw)


def facts_after_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts by year after the landing folder was loaded as a batch, loaded again, and then
    drained by the stream: each file loads once (S6)."""
    def make():
        wh = new_warehouse(spark, f"{sf_dir}-replay")
        loader = WarehouseLoader(wh)
        loader.load_masters(testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir))
        landing = _landed(spark, sf_dir)
        for _ in range(2):
            loader.load_files(landing)
        run_to_completion(spark, wh, landing, loader=loader)
        return wh
    fact = _once("replay", spark, sf_dir, make).read("fact_sales")
    return fact.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("quantity").cast("long")).alias("quantity"),
                                    F.sum("total_amount").cast("double").alias("total_amount"))


def _with_late_masters(spark: SparkSession, sf_dir: str):
    """A stream of transactions with planted faults, while some customers and products are
    missing; then the customers arrive, and the rejects are retried."""
    def make():
        wh = new_warehouse(spark, f"{sf_dir}-rejects")
        loader = WarehouseLoader(wh)
        customers = testdata.customers(spark, sf_dir)
        late = F.col("Customer_ID").cast("long") % testdata.LATE_CUSTOMERS == 3
        absent = F.col("Product_ID").cast("long") % testdata.ABSENT_PRODUCTS == 5
        loader.load_masters(customers.filter(~late), testdata.products(spark, sf_dir).filter(~absent))
        run_to_completion(spark, wh, _landed(spark, sf_dir, faults=True),
                          max_files_per_trigger=-(-_n_files(spark) // 2), loader=loader)  # two micro-batches
        loader.load_masters(customers, None)
        loader.retry_rejects(-1)
        return wh, loader
    return _once("rejects", spark, sf_dir, make)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays rejected, and why."""
    open_ = _with_late_masters(spark, sf_dir)[1].open_rejects()
    return open_.select("orderID", "Customer_ID", "Product_ID", "quantity", "date", "reject_reason")


def facts_after_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of the same load, those of late customers included."""
    return extras.fact_enriched(_with_late_masters(spark, sf_dir)[0].star())


def _with_master_faults(spark: SparkSession, sf_dir: str):
    def make():
        wh = new_warehouse(spark, f"{sf_dir}-masters")
        loader = WarehouseLoader(wh)
        folder = f"{checkpoint_root(spark)}/starmart-landing/{uuid.uuid4().hex[:10]}"
        testdata.with_master_faults(testdata.products(spark, sf_dir)).write.option("header", True).csv(folder)
        loader.load_masters(None, files.read_products(spark, folder))
        return wh, loader
    return _once("masters", spark, sf_dir, make)


def master_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product rows of a CSV master with planted faults that were not stored."""
    found = _with_master_faults(spark, sf_dir)[0].read("master_rejects")
    return found.groupBy("table_name", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"), F.count("business_key").alias("n_keys"))


def products_after_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products stored from the same files: those without a price, and one row of each repeated key."""
    p = _with_master_faults(spark, sf_dir)[0].read("dim_product")
    return p.select("Product_ID", "Product_Category", F.col("price").isNotNull().alias("has_price"))


def rollup_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The materialized roll-up after a first batch, then refreshed from the deltas of a second one (V2)."""
    def make():
        wh = new_warehouse(spark, f"{sf_dir}-rollup")
        loader = WarehouseLoader(wh)
        loader.load_masters(testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir))
        tx = testdata.transactions(spark, sf_dir)
        odd = F.col("orderID").cast("long") % 2 == 1
        loader.process_batch(tx.filter(odd), 0)
        views.materialize_rollup(wh)
        loader.process_batch(tx.filter(~odd), 1)
        views.refresh_rollup(wh, [1])
        return wh
    r = views.read_rollup(_once("rollup", spark, sf_dir, make))
    return r.select("storeName", "year", "quarter", F.col("quarterly_sales").cast("double").alias("quarterly_sales"))


def events_enriched_stream(spark: SparkSession, sf_dir: str):
    """Stream the ``events`` table (one Parquet file picked from the folder by
    glob) through a stream-static join with the customer dimension into an
    exactly-once Parquet sink next to the warehouse. Returns the sink path."""
    wh = warehouse_for(spark, sf_dir)
    out = f"{wh.root}/events_enriched"
    with _LOCK:
        if out not in _DONE:
            events = (spark.readStream.schema(EVENT).option("pathGlobFilter", "events.parquet")
                      .option("maxFilesPerTrigger", 1).parquet(sf_dir))
            cust = wh.star().customer.select("Customer_ID", "customer_key", "City_Category")
            joined = stream_static_join(events.withColumn("Customer_ID", F.col("user_id").cast("string")),
                                        cust, "Customer_ID")
            run_file_sink(joined.select("event_id", "customer_key", "user_id", "City_Category", "event_type",
                                        "value"),
                          out, f"{wh.root}/_stream_checkpoints/events_enriched", partition_by=("event_type",))
            _DONE.add(out)
    return out


def events_by_city_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and customer city, from the streamed enrichment."""
    e = spark.read.parquet(events_enriched_stream(spark, sf_dir))
    return (e.groupBy("event_type", "City_Category")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"),
                 F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value")))


def rollup_quarterly_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    with _LOCK:
        if wh.root not in _DONE:
            views.materialize_rollup(wh)
            _DONE.add(wh.root)
    r = views.read_rollup(wh)
    return r.select("storeName", "year", "quarter", F.col("quarterly_sales").cast("double").alias("quarterly_sales"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {}
    for name, fn in reports.REPORTS.items():
        q[name] = _on_star(fn, name in reports.YEAR_PARAM)
    for name, fn in diagnostics.DIAGNOSTICS.items():
        q[name] = _on_star(fn, False)
    for name, fn in extras.EXTRAS.items():
        q[name] = _on_star(fn, name in extras.YEAR_PARAM)
    q["stream_enriched"] = stream_enriched
    q["rollup_quarterly_materialized"] = rollup_quarterly_materialized
    q["events_by_city_stream"] = events_by_city_stream
    q["load_accounting"] = load_accounting
    q["dim_customer_reloaded"] = dim_customer_reloaded
    for fn in (facts_after_replay, stream_rejects, facts_after_retry, master_rejects, products_after_faults, rollup_refreshed):
        q[fn.__name__] = fn
    return q
