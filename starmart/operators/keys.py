"""Distributed surrogate keys (the AUTO_INCREMENT of a dimension).

Keys are dense, start after the current maximum, and follow business-key
order. No single-partition window over the data and no rows through the
driver: the rows are range-partitioned and sorted by business key, each
row's position inside its partition comes from
``monotonically_increasing_id`` (partition index in the upper bits, row
number in the lower 33), and a partition's offset is the number of rows in
all earlier partitions. Only the per-partition counts (one row per
partition, so bounded by the partition count, not by the data) are summed
in one place and broadcast back.

Partition ids and positions must not change between counting and
numbering, so the ranged rows are materialized once with the partition id
and position stored as columns: by default written as a staging table to
``staging`` (a folder in the shared checkpoint folder), which lets AQE
coalesce the small range partitions of a small dimension and survives the
loss of any executor; without a staging folder they are checkpointed there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.session import checkpoint_root

_ROW_BITS = 33


def assign_surrogate_keys(df: DataFrame, business_key: str, key_col: str,
                          start: Column | int = 0, num_partitions: int | None = None,
                          staging: str | None = None) -> DataFrame:
    """Add ``key_col`` = start + 1, start + 2, ... in ``business_key`` order.

    ``df`` must hold each business key once (see ``dims.first_per_key``).
    """
    spark = df.sparkSession
    ranged = (df.repartitionByRange(num_partitions, business_key) if num_partitions
              else df.repartitionByRange(business_key))
    ranged = (ranged.sortWithinPartitions(business_key)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if staging is not None:
        ranged.write.mode("overwrite").parquet(staging)
        ranged = spark.read.parquet(staging)
    else:
        checkpoint_root(spark)  # make sure a checkpoint folder is set
        ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-task window here is bounded by the
    # number of partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    pos = F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), _ROW_BITS)
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(key_col, (start_col + F.col("_offset") + pos + 1).cast("long"))
            .drop("_part", "_mid", "_offset"))


def next_key_start(existing: DataFrame | None, key_col: str) -> Column:
    """Current maximum key of a dimension (0 when empty), as a scalar subquery."""
    if existing is None:
        return F.lit(0).cast("long")
    return F.coalesce(existing.select(F.max(key_col)).scalar(), F.lit(0)).cast("long")
