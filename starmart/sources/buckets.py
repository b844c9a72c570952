"""Lookup columns of a dimension, stored bucketed and sorted by business key.

A join of a batch to such a table shuffles the batch alone: the stored buckets are the
join's partitions, in any session that opens the warehouse. Spark keeps them if there
are at least as many as ``spark.sql.shuffle.partitions``; with fewer it shuffles both
sides (the result is the same).

The buckets follow the dimension: ``lookup`` compares the row counts (Parquet footers
only) and appends the rows whose key is missing, so an append that was cut off is made
up by the next one. Dimension rows never change once stored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from starmart.session import make_folder
from starmart.sources.warehouse import SCHEMAS, Warehouse


def bucket_table(wh: Warehouse, name: str, key: str, columns: list[str], buckets: int) -> str:
    """Name of the bucketed table, known to the session from now on; its files lie in the warehouse."""
    path = f"{wh.path(name)}_by_{key}_{buckets}"
    table = "starmart_buckets_" + hashlib.md5(path.encode()).hexdigest()[:16]
    make_folder(wh.spark, path)
    types = {f.name: f.dataType.simpleString() for f in SCHEMAS[name].fields}
    wh.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'{c} {types[c]}' for c in columns)}) USING parquet "
                 f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return table


def lookup(wh: Warehouse, name: str, key: str, columns: list[str], buckets: int) -> DataFrame:
    """The columns of a dimension from its buckets, which are brought up to date first."""
    table = bucket_table(wh, name, key, columns, buckets)
    stored, rows = wh.spark.table(table), wh.read(name).select(*columns)
    if stored.count() != rows.count():
        new = rows.join(stored.select(key), key, "left_anti").select(*columns)
        new.repartition(buckets, key).write.insertInto(table)  # one file for each bucket
    return wh.spark.table(table)
