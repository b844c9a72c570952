"""Exactly once: ids, replays, retries and compaction in any order."""

import glob

import pytest

from starmart.plans import views
from starmart.sources import files
from starmart.streaming.loader import WarehouseLoader
from starmart.streaming.pipeline import run_to_completion
from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products, raw_tx

HEADER = "orderID,Customer_ID,Product_ID,quantity,date\n"
KNOWN, LATE = ("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C4", "P1", "2", "2017-01-03")
C4 = [("C4", "M", "18-25", "1", "A", "0", "0")]


def start(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    return wh, loader


def orders(wh):
    return sorted(r.orderID for r in wh.read("fact_sales").collect())


def test_replay_after_a_retry_adds_nothing(spark, new_wh):
    wh, loader = start(spark, new_wh)
    tx = [KNOWN, LATE, LATE, ("O3", "C9", "P1", "1", "2017-01-04")]  # a repeated row too
    loader.process_batch(raw_tx(spark, tx), 0)
    loader.load_masters(raw_customers(spark, C4), None)
    assert loader.retry_rejects(-1000).loaded == 2
    rep = loader.process_batch(raw_tx(spark, tx).repartition(3), 0)
    assert (rep.read, rep.loaded, rep.rejected) == (4, 1, 3)
    assert orders(wh) == ["O1", "O2", "O2"]
    assert [r.orderID for r in loader.open_rejects().collect()] == ["O3"]
    assert loader.retry_rejects(-1000).loaded == 2 and loader.retry_rejects(-1001).loaded == 0
    assert orders(wh) == ["O1", "O2", "O2"]


def test_replay_after_a_retry_of_all_rejects(spark, new_wh):
    wh, loader = start(spark, new_wh)
    loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    loader.load_masters(raw_customers(spark, C4), None)
    loader.retry_rejects(-1000)
    for _ in range(2):
        loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    assert orders(wh) == ["O1", "O2"] and loader.open_rejects().count() == 0


def test_retry_compact_retry(spark, new_wh):
    wh, loader = start(spark, new_wh)
    loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    loader.load_masters(raw_customers(spark, C4), None)
    loader.retry_rejects(-1000)
    wh.compact_facts([(2017, 1)])
    assert loader.retry_rejects(-1000).loaded == 1  # as recorded; nothing is written
    loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    assert orders(wh) == ["O1", "O2"]


def test_interrupted_retry_is_finished_by_the_next(spark, new_wh, monkeypatch):
    wh, loader = start(spark, new_wh)
    loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    loader.load_masters(raw_customers(spark, C4), None)
    with monkeypatch.context() as m:
        m.setattr(WarehouseLoader, "_write_facts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            loader.retry_rejects(-1000)
    loader.process_batch(raw_tx(spark, [KNOWN, LATE]), 0)
    assert orders(wh) == ["O1"]
    loader.retry_rejects(-1001)
    assert orders(wh) == ["O1", "O2"]


def test_batch_ids_are_not_shared(spark, new_wh, tmpdir_path):
    wh, loader = start(spark, new_wh)
    landing = f"{tmpdir_path}/landing"
    import os
    os.makedirs(landing)
    for name, order in (("a", "O1"), ("b", "O2")):
        with open(f"{landing}/{name}.csv", "w") as fh:
            fh.write(HEADER + f"{order},C1,P1,1,2017-01-02\n")
    loader.process_batch(files.read_transactions(spark, f"{landing}/a.csv"), 0)
    with pytest.raises(ValueError, match="id of its own"):
        loader.process_batch(files.read_transactions(spark, f"{landing}/b.csv"), 0)
    loader.process_batch(files.read_transactions(spark, f"{landing}/b.csv"), 1)
    other = f"{tmpdir_path}/other"
    os.makedirs(other)
    for n in (3, 4):  # a restart with another trigger size
        with open(f"{other}/{n}.csv", "w") as fh:
            fh.write(HEADER + f"O{n},C1,P1,1,2017-01-02\n")
        run_to_completion(spark, wh, other, max_files_per_trigger=n - 2, loader=WarehouseLoader(wh))
    assert orders(wh) == ["O1", "O2", "O3", "O4"]


def test_no_date_file_without_a_new_date(spark, new_wh):
    wh, loader = start(spark, new_wh)
    for i in range(3):
        loader.process_batch(raw_tx(spark, [KNOWN]), i)
    parts = glob.glob(wh.path("dim_date").replace("file:", "") + "/part-*")
    assert sum(1 for p in parts if spark.read.parquet(p).count()) == 1 and wh.read("dim_date").count() == 1


def test_rollup_refresh_after_compaction(spark, new_wh):
    wh, loader = start(spark, new_wh)
    loader.process_batch(raw_tx(spark, [KNOWN]), 0)
    views.materialize_rollup(wh)
    loader.process_batch(raw_tx(spark, [("O5", "C2", "P1", "2", "2017-02-02")]), 1)
    wh.compact_facts([(2017, 1), (2017, 2)])
    views.refresh_rollup(wh, [1])
    assert [str(r.quarterly_sales) for r in views.read_rollup(wh).collect()] == ["31.50"]
