"""The star schema as Parquet tables under one root folder.

Dimensions are small-to-medium tables appended by insert-if-absent. The
fact is partitioned by ``year``, ``month`` (pruning for date slices) and
``batch_id`` (a replayed micro-batch overwrites exactly its own files with
dynamic partition overwrite). Rejected rows keep their raw text and reason,
partitioned by ``batch_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart import schemas
from starmart.session import checkpoint_root, make_folder, path_exists

DIMENSIONS = {
    "dim_customer": schemas.DIM_CUSTOMER,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_store": schemas.DIM_STORE,
    "dim_supplier": schemas.DIM_SUPPLIER,
    "dim_date": schemas.DIM_DATE,
}
COMPACTED_BATCH_ID = -(1 << 62)  # batch id of rows moved by compaction
FACT = "fact_sales"
REJECTS = "rejects"
RESOLVED = "rejects_resolved"
LOADS = "loads"  # the load ledger
STREAMS = "streams"  # the id range of each stream
STREAM_IDS = 1 << 31  # ids in a range
CLOSED = "loads_closed"  # batches whose facts were compacted
MANIFEST = "manifest"  # files by the batch that loaded them
WAITING = "waiting"  # keys that rejected rows wait for
ARRIVALS = "arrivals"  # keys that master loads have brought
ARRIVALS_SEEN = "arrivals_seen"
MASTER_REJECTS = "master_rejects"
DELTAS = "rollup_deltas"  # what each batch adds to the quarterly roll-up
SCHEMAS = {**DIMENSIONS, FACT: schemas.FACT_SALES, REJECTS: schemas.REJECTS,
           RESOLVED: schemas.REJECTS_RESOLVED, LOADS: schemas.LOADS, CLOSED: schemas.LOADS_CLOSED,
           STREAMS: schemas.STREAMS, MANIFEST: schemas.MANIFEST, WAITING: schemas.WAITING, ARRIVALS: schemas.ARRIVALS,
           ARRIVALS_SEEN: schemas.ARRIVALS_SEEN, MASTER_REJECTS: schemas.MASTER_REJECTS, DELTAS: schemas.ROLLUP_DELTAS}


@dataclass
class Star:
    """The tables a report reads. Any source can build one: the Parquet
    warehouse, or DataFrames in a test."""

    fact: DataFrame
    customer: DataFrame
    product: DataFrame
    store: DataFrame
    supplier: DataFrame
    date: DataFrame

    def register(self, spark: SparkSession | None = None) -> None:
        """Temp views under the warehouse's table names, for SQL users."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_sales": self.fact, "dim_customer": self.customer,
                "dim_product": self.product, "dim_store": self.store,
                "dim_supplier": self.supplier, "dim_date": self.date}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._star: Star | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """Read a table with its declared schema (no footer inference pass;
        an empty table reads as empty)."""
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def create(self) -> "Warehouse":
        """Create every table's folder, so each can be read before its first load: an
        empty folder reads as an empty table of the declared schema."""
        for name in SCHEMAS:
            make_folder(self.spark, self.path(name))
        return self

    def star(self) -> Star:
        """The star tables. Kept between calls (the file listing of the
        partitioned fact is done once) and dropped by every write made
        through this object, so a reader never misses its own loads."""
        if self._star is None:
            self._star = Star(fact=self.read(FACT), customer=self.read("dim_customer"),
                              product=self.read("dim_product"), store=self.read("dim_store"),
                              supplier=self.read("dim_supplier"), date=self.read("dim_date"))
        return self._star

    def preview(self, name: str, n: int = 5) -> DataFrame:
        """First rows of a table (S8): a limit on the scan, which stops reading
        once ``n`` rows are found."""
        return self.read(name).limit(n)

    # -- writes -----------------------------------------------------------
    def append(self, name: str, df: DataFrame, *partition_cols: str) -> None:
        self._star = None
        df.write.mode("append").partitionBy(*partition_cols).parquet(self.path(name))

    def overwrite_partitions(self, name: str, df: DataFrame, *partition_cols: str) -> None:
        """Replace only the partitions ``df`` has rows for (idempotent replay)."""
        self._star = None
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).parquet(self.path(name)))

    # -- load ledger ------------------------------------------------------
    def record_load(self, batch_id: int, source: str, read: int, loaded: int, rejected: int, quarters) -> None:
        """Write the ledger row of a finished batch (its own folder: a replay replaces it)."""
        row = self.spark.createDataFrame([(source, read, loaded, rejected, list(quarters), batch_id)], SCHEMAS[LOADS])
        row.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{self.path(LOADS)}/batch_id={batch_id}")

    def stream_first_id(self, source: str) -> int:
        """The first batch id of a stream: the start of the lowest range of ids that
        neither another stream nor a recorded load has used, kept for its restarts."""
        known = self.read(STREAMS).filter(F.col("source") == source).first()
        if known is not None:
            return known["first_id"]
        used = (self.read(STREAMS).select("first_id")
                .unionByName(self.read(LOADS).filter("batch_id >= 0").select(F.col("batch_id").alias("first_id")))
                .select(F.expr(f"first_id div {STREAM_IDS}").alias("r")).distinct())
        taken = {row["r"] for row in used.collect()}  # one per stream, and per 25 days of one-shot loads
        first = next(r for r in range(len(taken) + 1) if r not in taken) * STREAM_IDS
        self.append(STREAMS, self.spark.createDataFrame([(source, first)], SCHEMAS[STREAMS]).coalesce(1))
        return first

    def load_entry(self, batch_id: int):
        """The ledger row of one batch, or None; reads that batch's folder only."""
        path = f"{self.path(LOADS)}/batch_id={batch_id}"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(SCHEMAS[LOADS]).option("basePath", self.path(LOADS)).parquet(path).first()

    # -- maintenance --------------------------------------------------------
    def compact_facts(self, year_months, upto_batch_id: int | None = None) -> str:
        """Merge the many small per-batch folders of the given (year, month)
        partitions into one folder per month.

        Rows of the batches that the ledger records as finished (with
        ``upto_batch_id``, those up to it) move to ``COMPACTED_BATCH_ID``.
        These batches are closed first, so running one of them again changes
        nothing; rows of all others keep their id and stay replayable. Run it
        while nothing else writes or reads the months. The months' rows are first written to a staging table in
        the shared checkpoint folder (this cuts the lineage, since the
        table is rewritten where it is read, and keeps a copy to restore
        from if the rewrite fails). Then one INSERT OVERWRITE with a
        partial static partition spec replaces exactly those months.
        Returns the staging path.
        """
        spark = self.spark
        pairs = sorted({(int(y), int(m)) for y, m in year_months})
        if not pairs:
            return ""
        cond = None
        for y, m in pairs:
            c = (F.col("year") == y) & (F.col("month") == m)
            cond = c if cond is None else cond | c
        staging = f"{checkpoint_root(spark)}/starmart-compaction/{uuid.uuid4().hex[:12]}"
        finished = self.read(LOADS).select("batch_id")
        if upto_batch_id is not None:
            finished = finished.filter(F.col("batch_id") <= upto_batch_id)
        self.append(CLOSED, finished.join(self.read(CLOSED), "batch_id", "left_anti").coalesce(1))
        rows = (self.read(FACT).filter(cond)
                .join(self.read(CLOSED).withColumn("_moves", F.lit(COMPACTED_BATCH_ID)), "batch_id", "left")
                .withColumn("batch_id", F.coalesce("_moves", "batch_id")).drop("_moves"))
        rows.select(*[f.name for f in SCHEMAS[FACT].fields]).write.parquet(staging)
        staged = spark.read.schema(SCHEMAS[FACT]).parquet(staging)
        table = f"starmart_fact_{uuid.uuid4().hex[:12]}"
        cols = ", ".join(f.name for f in SCHEMAS[FACT].fields if f.name not in ("year", "month", "batch_id"))
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[FACT].fields)
        self._star = None
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet PARTITIONED BY (year, month, batch_id) "
                  f"LOCATION '{self.path(FACT)}'")
        try:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
            for y, m in pairs:
                view = f"{table}_{y}_{m}"
                staged.filter((F.col("year") == y) & (F.col("month") == m)).createOrReplaceTempView(view)
                spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (year={y}, month={m}, batch_id) "
                          f"SELECT {cols}, batch_id FROM {view}")
                spark.catalog.dropTempView(view)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # external: the files stay
        return staging
