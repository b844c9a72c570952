"""Views over the star schema (V1-V3) and the materialized quarterly roll-up.

``register_views`` names the star tables and the STORE_QUARTERLY_SALES view
in the session catalog for SQL users; Catalyst inlines a view into each
query that reads it. ``materialize_rollup`` writes the view as Parquet by
(year, quarter); ``refresh_rollup`` renews only the (year, quarter)
partitions that given load batches touched, with dynamic partition
overwrite. It adds up what each batch left in ``rollup_deltas`` (one row for
a store and quarter) and reads no fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.plans.reports import store_quarterly_sales
from starmart.sources.warehouse import DELTAS, LOADS, Star, Warehouse

ROLLUP = "store_quarterly_sales"


def register_views(spark: SparkSession, star: Star, view_name: str = "STORE_QUARTERLY_SALES") -> None:
    star.register(spark)
    store_quarterly_sales(star).createOrReplaceTempView(view_name)


def _quarters_of_batches(wh: Warehouse, batch_ids) -> DataFrame:
    """The (year, quarter) pairs that the ledger records for the batches, also for
    batches whose facts were compacted meanwhile."""
    q = wh.read(LOADS).filter(F.col("batch_id").isin(*list(batch_ids))).select(F.explode("quarters").alias("q")).distinct()
    return q.select((F.col("q") / 10).cast("int").alias("year"), (F.col("q") % 10).alias("quarter"))


def materialize_rollup(wh: Warehouse) -> None:
    """Write the whole roll-up (first build)."""
    df = store_quarterly_sales(wh.star())
    wh.overwrite_partitions(ROLLUP, df, "year", "quarter")


def refresh_rollup(wh: Warehouse, batch_ids) -> None:
    """Renew the (year, quarter) partitions that ``batch_ids`` added to."""
    wh.overwrite_partitions(ROLLUP, rollup_of_batches(wh, batch_ids), "year", "quarter")


def rollup_of_batches(wh: Warehouse, batch_ids) -> DataFrame:
    """Whole totals of the quarters that ``batch_ids`` added to, from the batches' deltas: the
    touched (year, quarter) pairs prune the deltas' partitions at run time. Stores of one
    name add up, as in the view."""
    touched = F.broadcast(_quarters_of_batches(wh, batch_ids))  # at most 4 per year
    sums = (wh.read(DELTAS).join(touched, ["year", "quarter"], "left_semi")
            .groupBy("store_key", "year", "quarter").agg(F.sum("sales").alias("sales")))
    return (sums.join(wh.read("dim_store").select("store_key", "storeName"), "store_key")
            .groupBy("storeName", "year", "quarter").agg(F.sum("sales").alias("quarterly_sales")))


def read_rollup(wh: Warehouse) -> DataFrame:
    return wh.spark.read.parquet(wh.path(ROLLUP)).select("storeName", "year", "quarter", "quarterly_sales")
