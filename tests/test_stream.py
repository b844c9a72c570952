"""Structured Streaming load: stream = batch, replay-safe, progress."""

import uuid

from starmart.plans.build import build_from_testdata, new_warehouse
from starmart.sources import testdata
from starmart.streaming.loader import WarehouseLoader
from starmart.streaming.pipeline import run_to_completion, start_loader
from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products

SF = "/root/testdata/sf0.001"


def _facts(wh):
    return sorted(tuple(r) for r in wh.read("fact_sales")
                  .select("orderID", "customer_key", "product_key", "date_key", "quantity", "total_amount")
                  .collect())


def test_stream_of_landed_files_equals_batch_load(spark, tmpdir_path):
    batch = build_from_testdata(spark, SF)
    wh = new_warehouse(spark, "stream-test")
    loader = WarehouseLoader(wh)
    loader.load_masters(testdata.customers(spark, SF), testdata.products(spark, SF))
    landing = f"{tmpdir_path}/landing"
    testdata.land_transactions(spark, SF, landing, n_files=4)
    ckpt = f"{tmpdir_path}/ckpt"
    run_to_completion(spark, wh, landing, checkpoint_location=ckpt, max_files_per_trigger=1,
                      loader=loader, timeout_s=600)
    assert len(loader.reports) == 4  # one micro-batch per landed file
    assert sum(r.read for r in loader.reports) == sum(r.loaded for r in loader.reports) == \
        batch.read("fact_sales").count()
    assert _facts(wh) == _facts(batch)
    assert sorted(r.full_date for r in wh.read("dim_date").collect()) == \
        sorted(r.full_date for r in batch.read("dim_date").collect())
    # restart from the same checkpoint: nothing new to read, nothing added
    n = wh.read("fact_sales").count()
    run_to_completion(spark, wh, landing, checkpoint_location=ckpt, max_files_per_trigger=1,
                      loader=loader, timeout_s=600)
    assert wh.read("fact_sales").count() == n


def test_stream_rejects_and_late_master(spark, tmpdir_path, new_wh):
    # An unknown customer does not block the stream; it waits in rejects
    wh = new_wh("s2")
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    landing = f"{tmpdir_path}/landing2"
    rows = "orderID,Customer_ID,Product_ID,quantity,date\nO1,C1,P1,1,2017-01-02\nO2,C8,P2,3,2017-01-03\n"
    import os
    os.makedirs(landing, exist_ok=True)
    with open(f"{landing}/part-0.csv", "w") as fh:
        fh.write(rows)
    q, loader = start_loader(spark, wh, landing, checkpoint_location=f"{tmpdir_path}/ck2", loader=loader)
    q.awaitTermination(600)
    # numInputRows counts every read of the batch (facts and rejects each
    # read it when batches are not cached); the loader counts rows once
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] >= 2
    assert (loader.reports[-1].loaded, loader.reports[-1].rejected) == (1, 1)
    loader.load_masters(raw_customers(spark, [("C8", "F", "18-25", "2", "B", "1", "0")]), None)
    assert loader.retry_rejects(1000 + int(uuid.uuid4().int % 1000)).loaded == 1
    assert wh.read("fact_sales").count() == 2


def test_processing_time_mode_picks_up_new_files_and_retries(spark, tmpdir_path, new_wh):
    # R2 / R5 in polling mode, J3 each batch: a file arrives, then another
    import os
    wh = new_wh("s3")
    loader = WarehouseLoader(wh, retry_each_batch=True)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    landing = f"{tmpdir_path}/landing3"
    os.makedirs(landing, exist_ok=True)
    header = "orderID,Customer_ID,Product_ID,quantity,date\n"
    with open(f"{landing}/a.csv", "w") as fh:
        fh.write(header + "O1,C1,P1,1,2017-01-02\nO2,C7,P2,2,2017-01-02\n")
    q, loader = start_loader(spark, wh, landing, checkpoint_location=f"{tmpdir_path}/ck3", loader=loader,
                             available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert wh.read("fact_sales").count() == 1 and loader.open_rejects().count() == 1
        loader.load_masters(raw_customers(spark, [("C7", "M", "26-35", "3", "A", "1", "1")]), None)
        with open(f"{landing}/b.csv", "w") as fh:
            fh.write(header + "O3,C2,P3,1,2017-02-03\n")
        q.processAllAvailable()
    finally:
        q.stop()
    # O3 loaded by its batch; O2 loaded by the retry that followed it
    assert sorted(r.orderID for r in wh.read("fact_sales").collect()) == ["O1", "O2", "O3"]
    assert loader.open_rejects().count() == 0
    assert wh.preview("fact_sales", 2).count() == 2


def test_progress_table_names_every_batch_of_the_ledger(spark, tmpdir_path, new_wh):
    # One row per micro-batch, by the ledger's batch ids
    import os
    import time

    from starmart.streaming.progress import ProgressTable, read_progress
    wh = new_wh("s4")
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    landing = f"{tmpdir_path}/landing4"
    os.makedirs(landing, exist_ok=True)
    for i in range(2):
        with open(f"{landing}/part-{i}.csv", "w") as fh:
            fh.write(f"orderID,Customer_ID,Product_ID,quantity,date\nO{i},C1,P1,1,2017-01-02\n")
    assert read_progress(spark, wh.root).count() == 0
    table = ProgressTable(spark, wh.root)
    spark.streams.addListener(table)
    try:
        run_to_completion(spark, wh, landing, max_files_per_trigger=1, loader=loader, timeout_s=300, progress=table)
        until = time.time() + 30
        while read_progress(spark, wh.root).count() < 2 and time.time() < until:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(table)
    rows = read_progress(spark, wh.root).collect()
    assert sorted(r.batch_id for r in rows) == [0, 1] and len(loader.reports) == 2
    assert {r.ledger_batch_id for r in rows} == {r.batch_id for r in loader.reports}
    assert all(r.input_rows >= 1 and r.durations["addBatch"] > 0 for r in rows)
