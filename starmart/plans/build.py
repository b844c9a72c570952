"""Building (once) and opening the warehouse the reports read.

The reports run on the star schema, as in any warehouse: the load is done
once, then every report reads the Parquet tables (fact pruned by its year /
month partitions, dimensions joined by key). The warehouse of a test-data
folder is built on first use in a session and reused by later reports.
It lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import threading
import uuid

from pyspark.sql import SparkSession

from starmart.session import checkpoint_root
from starmart.sources import testdata
from starmart.sources.warehouse import Star, Warehouse
from starmart.streaming.loader import WarehouseLoader

_BUILT: dict[tuple, Warehouse] = {}
_LOCK = threading.RLock()


def new_warehouse(spark: SparkSession, label: str = "wh") -> Warehouse:
    slug = re.sub(r"[^A-Za-z0-9]+", "_", label).strip("_")[-40:]
    root = f"{checkpoint_root(spark)}/starmart-wh/{slug}-{uuid.uuid4().hex[:10]}"
    return Warehouse(spark, root).create()


def build_from_testdata(spark: SparkSession, sf_dir: str, warehouse: Warehouse | None = None,
                        batch_id: int = 0) -> Warehouse:
    """One-shot batch load of the test tables (masters, then one batch)."""
    wh = warehouse or new_warehouse(spark, sf_dir)
    loader = WarehouseLoader(wh)
    loader.load_masters(testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir))
    loader.process_batch(testdata.transactions(spark, sf_dir), batch_id, persist=False)
    return wh


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (os.path.abspath(sf_dir), checkpoint_root(spark))
    with _LOCK:
        wh = _BUILT.get(key)
        if wh is None or wh.spark is not spark:
            if wh is not None:
                wh = Warehouse(spark, wh.root)  # same files, new session
            else:
                wh = build_from_testdata(spark, sf_dir)
            _BUILT[key] = wh
    return wh


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    return warehouse_for(spark, sf_dir).star()
