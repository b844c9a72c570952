"""Loading the warehouse: master data, then transaction batches.

``process_batch`` is the one transform for both a batch load and each
micro-batch of the stream (``foreachBatch``):

  1. cleanse (trim ids, parse quantity and date, first failing rule);
  2. left-join customer and product and route every row: facts, or rejects
     with a reason (nothing is silently skipped, nothing blocks). The result
     is evaluated once and staged in the shared checkpoint folder (or cached);
  3. add the new dates of the loading rows to ``dim_date``, before the facts
     that refer to them;
  4. write facts by (year, month, batch_id) and rejects by batch_id with
     dynamic partition overwrite: re-running a batch id rewrites the same
     partitions, so a replay after a failure adds no duplicates;
  5. record the batch in the load ledger (``loads``): source, counts and the
     quarters it touched. A batch costs the same whatever was loaded before.

Exactly once: a rejected row is known by a hash of its raw text (equal rows of
a batch always share one fate), so its identity does not depend on how files
are split. A row that a retry has made a fact stays out of its own batch when
that is replayed. An id recorded for one source is refused for another. A
batch or retry whose facts were compacted is closed: running it again changes
nothing. One writer per warehouse at a time is assumed.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F

from starmart.operators import cleanse as C
from starmart.operators import dims as D
from starmart.operators.enrich import (CUSTOMER_KEY, PRODUCT_KEY, RAW_COLS, enrich, facts, key_bucket, rejects, retryable, store_quarters,
                                        waiting_keys)
from starmart.session import checkpoint_root, delete_path, path_exists
from starmart.sources import buckets, files
from starmart.sources.files import SOURCE_FILE
from starmart.sources.warehouse import (ARRIVALS, ARRIVALS_SEEN, CLOSED, DELTAS, FACT, LOADS, MANIFEST, MASTER_REJECTS, REJECTS, RESOLVED, WAITING,
                                        Warehouse)

RETRY = "retry"


@dataclass
class BatchReport:
    """``read`` is observed on the input; ``loaded``, ``rejected`` and ``skipped`` (rows of
    files that another batch has loaded) are counted on the routed rows. For a retry
    ``read`` counts the rows that resolved."""

    batch_id: int
    loaded: int
    rejected: int
    read: int
    skipped: int = 0


@dataclass
class MasterReport:
    """Rows of one master load: read = stored + existing + duplicates + rejected. ``existing``
    are first rows of keys that the dimension already has."""

    table: str
    read: int
    stored: int
    existing: int
    duplicates: int
    rejected: int


def new_id() -> int:
    """An id for a one-shot load: milliseconds of the clock, which no stream's running batch
    number reaches."""
    return time.time_ns() // 1_000_000


def row_identity():
    """Identity of a raw transaction (with packed texts) within its batch."""
    return F.md5(F.to_json(F.struct(*[C.raw_texts()[c].alias(c) for c in RAW_COLS])))


def identified(routed: DataFrame) -> DataFrame:
    """Routed rows with their raw texts and identity, as the reject table holds them."""
    return C.unpack_raw(routed.withColumn("row_id", row_identity()))


def source_of(raw: DataFrame) -> str:
    """Name of a batch's input, for the ledger: its files, or "memory"."""
    names = raw.inputFiles()
    if not names:
        return "memory"
    return "files:" + hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:16]


class WarehouseLoader:
    def __init__(self, warehouse: Warehouse, persist_batches: bool = False, retry_each_batch: bool = False,
                 lookup_partitions: int | None = None, lookup_buckets: int | None = None):
        """``persist_batches`` caches the routed rows of each micro-batch; by
        default they are staged as Parquet. ``retry_each_batch``
        re-runs the lookups of open rejects after every micro-batch (rows
        wait in quarantine until their master row arrives); retries use
        negative batch ids, -(batch_id + 1), so they never collide with the
        stream's own ids and a replayed batch repeats the same retry.

        ``lookup_partitions`` keeps the lookup columns of the customer and
        product dimensions (business key, surrogate key, price) persisted and
        hash-partitioned by business key across micro-batches: when a
        dimension is too large to broadcast, each batch then shuffles only
        its own rows for the join, instead of re-reading and re-shuffling
        the whole dimension every batch. The copies are rebuilt after every
        master load. ``lookup_buckets`` stores the same columns in the warehouse
        instead, bucketed by business key: nothing is held in memory or rebuilt
        after a restart, and a master load appends its new keys only."""
        if lookup_partitions and lookup_buckets:
            raise ValueError("lookup_partitions and lookup_buckets exclude each other")
        self.wh = warehouse
        self.persist_batches = persist_batches
        self.retry_each_batch = retry_each_batch
        self.lookup_partitions = lookup_partitions
        self.lookup_buckets = lookup_buckets
        self._lookups: dict[str, DataFrame] = {}
        self.reports: list[BatchReport] = []
        self.master_reports: list[MasterReport] = []

    # -- master data -------------------------------------------------------
    def load_masters(self, customers_raw: DataFrame | None, products_raw: DataFrame | None, load_id: int | None = None) -> None:
        """Upsert store, supplier, product and customer dimensions (first
        writer wins per business key; keys continue after the current max).

        Store, supplier and customer do not depend on each other and are
        submitted as concurrent Spark jobs; product waits for store and
        supplier only, while customer may still be running.

        Rows that may not be stored, and later rows of a key of the same load, go to
        ``master_rejects`` with their reason; ``master_reports`` counts them. The keys that
        are new are noted as arrivals, for the retry of rejects that wait for them.
        """
        load_id = time.time_ns() if load_id is None else load_id
        self._drop_lookups()
        wh = self.wh
        judged = {"dim_customer": None if customers_raw is None else C.judge_customers(customers_raw),
                  "dim_product": None if products_raw is None else C.judge_products(products_raw)}
        judged = {name: df.persist(StorageLevel.MEMORY_AND_DISK) for name, df in judged.items() if df is not None}
        products = C.storable(judged["dim_product"]) if "dim_product" in judged else None
        try:
            with ThreadPoolExecutor(max_workers=3) as pool:
                customer = None
                if "dim_customer" in judged:
                    customer = pool.submit(self._upsert, "dim_customer",
                                           D.customer_rows(C.storable(judged["dim_customer"])),
                                           "Customer_ID", "customer_key", load_id, CUSTOMER_KEY)
                if products is not None:
                    parts = [pool.submit(self._upsert, "dim_store", D.store_rows(products), "storeID", "store_key"),
                             pool.submit(self._upsert, "dim_supplier", D.supplier_rows(products),
                                         "supplierID", "supplier_key")]
                    for f in parts:
                        f.result()
                    rows = D.product_rows(products, wh.read("dim_store"), wh.read("dim_supplier"))
                    self._upsert("dim_product", rows, "Product_ID", "product_key", load_id, PRODUCT_KEY)
                if customer is not None:
                    customer.result()
            self._quarantine(judged, load_id)
        finally:
            for df in judged.values():
                df.unpersist()
            self._drop_lookups()  # a batch may have cached them meanwhile

    def _quarantine(self, judged: dict[str, DataFrame], load_id: int) -> None:
        """Keep the master rows that were not stored, and count all."""
        keys = {"dim_customer": ("Customer_ID", CUSTOMER_KEY), "dim_product": ("Product_ID", PRODUCT_KEY)}
        out = None
        for name, df in judged.items():
            key = keys[name][0]
            cols = [F.lit(name).alias("table_name"), F.col(key).alias("business_key"), "raw", F.col("pre_reason").alias("reject_reason")]
            later = C.later_rows(df, key).withColumn("pre_reason", F.lit(C.DUPLICATE_KEY))
            rows = df.filter(F.col("pre_reason").isNotNull()).select(*cols).unionByName(later.select(*cols))
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return
        self.wh.overwrite_partitions(MASTER_REJECTS, out.withColumn("load_id", F.lit(load_id).cast("long")), "load_id")
        kept = (self.wh.read(MASTER_REJECTS).filter(F.col("load_id") == load_id).groupBy("table_name")
                .agg(F.count_if(F.col("reject_reason") == C.DUPLICATE_KEY).alias("d"), F.count(F.lit(1)).alias("n")))
        kept = {r["table_name"]: r for r in kept.collect()}  # one row a dimension
        for name, df in judged.items():
            read, d, n = df.count(), *((kept[name]["d"], kept[name]["n"]) if name in kept else (0, 0))
            stored = self.wh.read(ARRIVALS).filter((F.col("load_id") == load_id) & (F.col("key_kind") == keys[name][1])).count()
            self.master_reports.append(MasterReport(name, read, stored, read - n - stored, d, n - d))

    def _upsert(self, name: str, rows: DataFrame, business_key: str, key_col: str, load_id: int | None = None, kind: str | None = None) -> None:
        staging = f"{checkpoint_root(self.wh.spark)}/starmart-keys/{name}-{uuid.uuid4().hex[:12]}"
        new = D.insert_if_absent(rows, self.wh.read(name), business_key, key_col, "_load_order",
                                 staging=staging)
        if kind:  # noted before they are stored: a key without a note would leave its rejects waiting
            self.wh.append(ARRIVALS, new.select(F.lit(kind).alias("key_kind"), F.col(business_key).alias("business_key"),
                                                F.lit(load_id).cast("long").alias("load_id")), "load_id")
        self.wh.append(name, new)
        delete_path(self.wh.spark, staging)

    # -- transactions --------------------------------------------------------
    def process_batch(self, raw: DataFrame, batch_id: int, persist: bool = False,
                      source: str | None = None) -> BatchReport:
        """Load one batch of raw transactions as ``batch_id``.

        The routed rows are evaluated once: staged as Parquet in the shared
        checkpoint folder (removed at the end), or cached with ``persist`` (for
        micro-batches, bounded by the trigger). ``source`` names the input in
        the ledger; by default it is derived from the input files.

        Rows that carry their file (``files.read_transactions`` and the stream) load once: those
        of files that the manifest has for another batch are skipped, and a file that has
        changed since it was loaded is an error. The batch's files are claimed in the
        manifest before its facts are written.
        """
        wh = self.wh
        source = source or source_of(raw)
        closed = self._closed_report(batch_id, source)
        if closed:
            self.reports.append(closed)
            return closed
        replay = path_exists(wh.spark, f"{wh.path(REJECTS)}/batch_id={batch_id}")
        seen = Observation()
        # raw texts are kept where they tell more than the typed columns, identities are made for rejects only:
        # every row passes the joins' shuffles and the staging, few are rejected
        t = C.pack_raw(C.cleanse_transactions(raw.observe(seen, F.count(F.lit(1)).alias("n"))))
        routed = enrich(t, self._lookup("dim_customer"), self._lookup("dim_product"))
        if replay:  # rows that a retry made facts meanwhile
            late = (wh.read(RESOLVED).filter((F.col("batch_id") == batch_id) & (F.col("resolved_in") != batch_id))
                    .select("row_id", F.lit(C.LATE_MASTER).alias("_late")).distinct())
            routed = routed.withColumn("row_id", row_identity()).join(late, "row_id", "left").withColumn(
                "reject_reason", F.coalesce("reject_reason", "_late")).drop("_late", "row_id")
        routed = routed.withColumn("loads", F.col("reject_reason").isNull()).drop("price", "pre_reason")
        # a row that loads has its keys
        routed = routed.withColumns({c: F.when(~F.col("loads"), F.col(c)) for c in ("Customer_ID", "Product_ID")})
        staging = f"{checkpoint_root(wh.spark)}/starmart-batch/{uuid.uuid4().hex[:12]}"
        if persist:
            routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            routed.write.parquet(staging)  # not by folders of ``loads``: they would sort every row
            routed = wh.spark.read.schema(routed.schema).parquet(staging)
        whole, skipped = routed, 0
        if SOURCE_FILE in routed.columns:
            routed, skipped = self._claim_files(routed, batch_id, source)
        days = (routed.groupBy("loads", F.when(F.col("loads"), F.col("sale_date")).alias("sale_date"))
                .agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            loaded, rejected, quarters = self._summary(days)
            self._add_dates(days.filter("loads"))
            if loaded:
                self._write_facts(routed.filter("loads"), batch_id)
            if rejected:
                wh.overwrite_partitions(REJECTS, rejects(identified(routed.filter(~F.col("loads"))), batch_id), "batch_id")
                wh.overwrite_partitions(WAITING, waiting_keys(routed.filter(~F.col("loads")), batch_id), "key_bucket", "batch_id")
            elif replay:
                # Dimensions only grow, so a replay rejects a subset of what the first
                # run rejected. All of it loaded now, and an empty write leaves the old
                # partition: its rows are marked resolved by this batch.
                self._mark_resolved(self._rejects_of(batch_id).select("batch_id", "row_id"), batch_id)
            report = BatchReport(batch_id, loaded, rejected, int(seen.get["n"]), skipped)
            wh.record_load(batch_id, source, report.read - skipped, loaded, rejected, quarters)
        finally:
            days.unpersist()
            if persist:
                whole.unpersist()
            else:
                delete_path(wh.spark, staging)
        self.reports.append(report)
        return report

    def load_files(self, path: str, fmt: str = "csv", batch_id: int | None = None) -> list[BatchReport]:
        """Load the files of a folder that no batch has loaded yet, as one batch with a new id.

        A load that was interrupted after it claimed its files is finished first, under its own
        id, so its facts are written once. Files that a stream has claimed are left to it.
        Nothing new: no batch."""
        wh = self.wh
        claimed = wh.read(MANIFEST).select("path", F.col("length").alias("was_length"), F.col("modified").alias("was_modified"), "source", "batch_id")
        found = files.listing(wh.spark, path).join(claimed, "path", "left").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._refuse_changed(found)
            open_ = (found.filter(F.col("source").startswith("files:")).select("batch_id").distinct()
                     .join(wh.read(LOADS).select("batch_id"), "batch_id", "left_anti"))
            todo = [(r["batch_id"], [f["path"] for f in wh.read(MANIFEST).filter(F.col("batch_id") == r["batch_id"]).select("path").collect()])
                    for r in open_.collect()]  # interrupted loads; their paths, as a read needs them
            new = [r["path"] for r in found.filter(F.col("batch_id").isNull()).select("path").collect()]
            if new:
                todo.append((new_id() if batch_id is None else batch_id, new))
            return [self.process_batch(files.read_transactions(wh.spark, paths, fmt), n) for n, paths in todo]
        finally:
            found.unpersist()

    @staticmethod
    def _refuse_changed(found: DataFrame) -> DataFrame:
        """Fail if a file of the manifest has another length or time now."""
        changed = found.filter((F.col("length") != F.col("was_length")) | (F.col("modified") != F.col("was_modified"))).select("path").first()
        if changed is not None:
            raise ValueError(f"{changed['path']} was loaded before and has changed since; land changed rows in a new file")
        return found

    def _claim_files(self, routed: DataFrame, batch_id: int, source: str) -> tuple[DataFrame, int]:
        """Note the batch's files in the manifest; the rows without those of files that
        another batch has, and how many these are."""
        wh = self.wh
        own = routed.select(f"{SOURCE_FILE}.*").distinct().persist(StorageLevel.MEMORY_AND_DISK)  # a batch's files
        others = wh.read(MANIFEST).filter(F.col("batch_id") != batch_id).select(
            "path", F.col("length").alias("was_length"), F.col("modified").alias("was_modified"))
        held = own.join(others, "path").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            skipped = 0
            if not held.isEmpty():
                self._refuse_changed(held)
                paths = held.select(F.col("path").alias("_held")).distinct()
                on = F.col(f"{SOURCE_FILE}.path") == F.col("_held")
                skipped = routed.join(paths, on, "left_semi").count()
                routed = routed.join(paths, on, "left_anti")
                own = own.join(held.select("path"), "path", "left_anti")
            claim = own.select("path", "length", "modified", F.lit(source).alias("source"), F.lit(batch_id).cast("long").alias("batch_id"))
            wh.overwrite_partitions(MANIFEST, claim.coalesce(1), "batch_id")
            return routed, skipped
        finally:
            held.unpersist()
            own.unpersist()

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` entry point for a stream of one's own."""
        self.micro_batch(df, batch_id, "stream")

    def micro_batch(self, df: DataFrame, batch_id: int, source: str) -> None:
        self.process_batch(df, batch_id, persist=self.persist_batches, source=source)
        if self.retry_each_batch:
            self.retry_rejects(-(batch_id + 1))

    # -- rejects ----------------------------------------------------------------
    def retry_rejects(self, retry_batch_id: int, everything: bool = False) -> BatchReport:
        """Re-run the lookups for open rejects (unknown customer / product) that wait
        for a key that has arrived since the last retry: the arrivals' buckets of the
        waiting index name the batches to read, and only rows with an arrived key are
        looked up. Without an arrival no reject is read and nothing is recorded.
        ``everything`` looks up all open rejects instead (a warehouse whose masters were
        written by other means). Rows that resolve become facts of
        ``retry_batch_id`` and are recorded as resolved, so they are not
        retried or counted as open again. Re-running the same retry id is
        idempotent. Retry ids share the fact's ``batch_id`` space, so they
        must differ from the loads' batch ids (negative ids are safe).

        Rows are marked resolved before they are written as facts, and a retry
        that did not reach the ledger is finished first by the next one."""
        closed = self._closed_report(retry_batch_id, RETRY)
        if closed:
            self.reports.append(closed)
            return closed
        if not everything and self._arrived(retry_batch_id).isEmpty():
            # an interrupted retry leaves its arrivals unanswered, so there is none to finish either
            report = BatchReport(retry_batch_id, 0, 0, 0)
            self.reports.append(report)
            return report
        marked = self.wh.read(RESOLVED).filter("batch_id != resolved_in").select(F.col("resolved_in").alias("batch_id"))
        cut_off = marked.distinct().join(self.wh.read(LOADS).select("batch_id"), "batch_id", "left_anti")
        for row in cut_off.collect():  # retries that were interrupted: one at most per writer
            if row["batch_id"] != retry_batch_id:
                self._retry(row["batch_id"], everything)
        report = self._retry(retry_batch_id, everything)
        self.reports.append(report)
        return report

    def _arrived(self, retry_batch_id: int) -> DataFrame:
        """Keys of master loads that no other retry has answered."""
        seen = self.wh.read(ARRIVALS_SEEN).filter(F.col("retry_id") != retry_batch_id).select("load_id")
        return self.wh.read(ARRIVALS).join(seen, "load_id", "left_anti")

    def awaited_rejects(self, arrived: DataFrame) -> DataFrame:
        """The rejects of the batches in which a row waits for an arrived key."""
        keys = arrived.select("key_kind", "business_key").distinct().withColumn("key_bucket", key_bucket("business_key"))
        batches = self.wh.read(WAITING).join(keys, ["key_bucket", "key_kind", "business_key"], "left_semi").select("batch_id").distinct()
        return self.wh.read(REJECTS).join(batches, "batch_id", "left_semi")

    def _retry(self, retry_batch_id: int, everything: bool = False) -> BatchReport:
        wh = self.wh
        resolved = wh.read(RESOLVED).filter(F.col("resolved_in") != retry_batch_id)
        arrived = self._arrived(retry_batch_id)
        open_ = retryable(wh.read(REJECTS) if everything else self.awaited_rejects(arrived), resolved)
        t = C.cleanse_transactions(open_)
        if not everything:
            for kind, column in ((CUSTOMER_KEY, "Customer_ID"), (PRODUCT_KEY, "Product_ID")):
                keys = arrived.filter(F.col("key_kind") == kind).select(F.col("business_key").alias(column), F.lit(True).alias(f"_{kind}")).distinct()
                t = t.join(keys, column, "left")
            t = t.filter(F.col(f"_{CUSTOMER_KEY}") | F.col(f"_{PRODUCT_KEY}")).drop(f"_{CUSTOMER_KEY}", f"_{PRODUCT_KEY}")
        checkpoint_root(wh.spark)  # the shared folder the checkpoint below writes to
        fixed = (enrich(t, self._lookup("dim_customer"), self._lookup("dim_product"))
                 .filter(F.col("reject_reason").isNull())
                 .checkpoint(eager=True))  # cut lineage: we write where we read
        days = fixed.groupBy(F.lit(True).alias("loads"), "sale_date").agg(F.count(F.lit(1)).alias("n"))
        loaded, _, quarters = self._summary(days)
        if loaded:
            self._mark_resolved(fixed.select(F.col("src_batch_id").alias("batch_id"), "row_id"), retry_batch_id)
            self._add_dates(fixed)
            self._write_facts(fixed, retry_batch_id)
        seen = arrived.select("load_id").distinct().withColumn("retry_id", F.lit(retry_batch_id).cast("long"))
        wh.overwrite_partitions(ARRIVALS_SEEN, seen.coalesce(1), "retry_id")
        wh.record_load(retry_batch_id, RETRY, loaded, loaded, 0, quarters)
        return BatchReport(retry_batch_id, loaded, 0, loaded)

    # -- steps --------------------------------------------------------------
    def _closed_report(self, batch_id: int, source: str) -> BatchReport | None:
        """The recorded report of a compacted batch (None: the batch may run).
        Refuses an id that the ledger holds for other input."""
        entry = self.wh.load_entry(batch_id)
        if entry is None:
            return None
        if entry["source"] != source:
            raise ValueError(f"batch id {batch_id} already holds {entry['source']}; {source} needs an id of its own")
        if self.wh.read(CLOSED).filter(F.col("batch_id") == batch_id).isEmpty():
            return None
        return BatchReport(batch_id, entry["loaded_rows"], entry["rejected_rows"], entry["read_rows"])

    @staticmethod
    def _summary(days: DataFrame) -> tuple[int, int, list[int]]:
        """(loaded, rejected, touched quarters as yyyyq) of routed rows counted by day."""
        quarter = (F.year("sale_date") * 10 + F.quarter("sale_date")).cast("int")
        row = days.agg(F.sum(F.when(F.col("loads"), F.col("n"))).alias("f"),
                       F.sum(F.when(~F.col("loads"), F.col("n"))).alias("r"),
                       F.collect_set(F.when(F.col("loads"), quarter)).alias("q")).first()
        return int(row["f"] or 0), int(row["r"] or 0), sorted(row["q"])

    def _add_dates(self, loading: DataFrame) -> None:
        """Dates that ``dim_date`` lacks; no file when there is none."""
        new = D.new_dates(loading, self.wh.read("dim_date")).coalesce(1).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not new.isEmpty():
                self.wh.append("dim_date", new)
        finally:
            new.unpersist()

    def _write_facts(self, loading: DataFrame, batch_id: int) -> None:
        # AQE rebalances by (year, month): it coalesces small months and splits
        # large ones, so each output file has a sensible size and a task writes
        # few folders, sequentially (sorted by date inside).
        f = facts(loading, batch_id).hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "date_key")
        self.wh.overwrite_partitions(FACT, f, "year", "month", "batch_id")
        self.wh.overwrite_partitions(DELTAS, store_quarters(loading, batch_id).coalesce(1), "year", "quarter", "batch_id")

    _LOOKUP_COLS = {"dim_customer": ("Customer_ID", ["Customer_ID", "customer_key"]),
                    "dim_product": ("Product_ID", ["Product_ID", "product_key", "price", "store_key"])}

    def _lookup(self, name: str) -> DataFrame:
        key, cols = self._LOOKUP_COLS[name]
        if not self.lookup_partitions and not self.lookup_buckets:
            return self.wh.read(name).select(*cols)
        df = self._lookups.get(name)
        if df is None and self.lookup_buckets:
            df = self._lookups[name] = buckets.lookup(self.wh, name, key, cols, self.lookup_buckets)
        elif df is None:
            # the join keeps an existing partitioning only if it has at least
            # as many partitions as a new shuffle would (spark.sql.shuffle.partitions)
            n = max(int(self.lookup_partitions),
                    int(self.wh.spark.conf.get("spark.sql.shuffle.partitions")))
            df = (self.wh.read(name).select(*cols).repartition(n, key)
                  .persist(StorageLevel.MEMORY_AND_DISK))
            df.count()  # build it now: a join planned on a built cache keeps its partitioning
            self._lookups[name] = df
        return df

    def _drop_lookups(self) -> None:
        if self.lookup_partitions:
            for df in self._lookups.values():
                df.unpersist()
        self._lookups.clear()

    def _rejects_of(self, batch_id: int) -> DataFrame:
        return self.wh.read(REJECTS).filter(F.col("batch_id") == batch_id)

    def _mark_resolved(self, rows: DataFrame, resolved_in: int) -> None:
        self.wh.overwrite_partitions(RESOLVED, rows.select(
            "batch_id", "row_id", F.lit(resolved_in).cast("long").alias("resolved_in")).distinct(), "resolved_in")

    def open_rejects(self) -> DataFrame:
        rej = self.wh.read(REJECTS)
        return rej.join(self.wh.read(RESOLVED).select("batch_id", "row_id"), ["batch_id", "row_id"], "left_anti")
