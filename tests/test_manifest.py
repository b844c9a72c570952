"""Files load once, retries follow arrivals, refused master rows are kept, the roll-up reads no fact."""

import os

import pytest

from starmart.__main__ import main
from starmart.functions.cleanse import parse_date, parse_int
from starmart.plans import reports, views
from starmart.sources import files
from starmart.streaming.loader import WarehouseLoader
from starmart.streaming.pipeline import run_to_completion
from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products, raw_tx

HEADER = "orderID,Customer_ID,Product_ID,quantity,date\n"


def land(folder, name, *orders):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as fh:
        fh.write(HEADER + "".join(f"{o},C1,P1,1,2017-01-02\n" for o in orders))


@pytest.fixture()
def started(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    return wh, loader


def orders(wh):
    return sorted(r.orderID for r in wh.read("fact_sales").collect())


def test_one_folder_loaded_in_every_way_loads_once(spark, started, tmpdir_path):
    wh, _ = started
    folder = f"{tmpdir_path}/landing"
    land(folder, "a", "O1", "O2")
    args = ["load", "--warehouse", wh.root, "--transactions", folder]
    assert [b[1:] for b in main(args, spark)["batches"]] == [(2, 0)]
    assert main(args, spark)["batches"] == []
    main([*args, "--stream"], spark)
    assert orders(wh) == ["O1", "O2"]
    land(folder, "b", "O3")
    main([*args, "--stream"], spark)
    land(folder, "c", "O4")
    assert [b[1:] for b in main(args, spark)["batches"]] == [(1, 0)]
    assert orders(wh) == ["O1", "O2", "O3", "O4"]
    loader = run_to_completion(spark, wh, folder)
    assert [(r.read, r.skipped, r.loaded) for r in loader.reports] == [(1, 1, 0)] and len(orders(wh)) == 4
    # an API user's own read of the folder is skipped too
    assert WarehouseLoader(wh).process_batch(files.read_transactions(spark, folder), 77).skipped == 4


def test_interrupted_load_is_finished_under_its_own_id(spark, started, tmpdir_path, monkeypatch):
    wh, loader = started
    folder = f"{tmpdir_path}/landing"
    land(folder, "a", "O1")
    with monkeypatch.context() as m:
        m.setattr(type(wh), "record_load", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            loader.load_files(folder, batch_id=5)
    land(folder, "b", "O2")
    assert [r.batch_id for r in loader.load_files(folder, batch_id=6)] == [5, 6]
    assert orders(wh) == ["O1", "O2"]


def test_changed_file_is_refused(spark, started, tmpdir_path):
    _, loader = started
    folder = f"{tmpdir_path}/landing"
    land(folder, "a", "O1")
    loader.load_files(folder)
    land(folder, "a", "O1", "O2")
    with pytest.raises(ValueError, match="changed since"):
        loader.load_files(folder)


def test_retry_reads_only_what_arrivals_touch(spark, started, monkeypatch):
    wh, loader = started
    late = [("C8", "M", "18-25", "1", "A", "0", "0")], [("P8", "Toys", "2.00", "S1", "Store One", "U1", "Supplier One")]
    loader.process_batch(raw_tx(spark, [("O1", "C8", "P1", "1", "2017-01-02"), ("O2", "C8", "P8", "1", "2017-01-02")]), 0)
    loader.process_batch(raw_tx(spark, [("O3", "C9", "P1", "1", "2017-01-02")]), 1)
    assert loader.retry_rejects(-1).loaded == 0  # the masters of the start, which nothing waits for
    with monkeypatch.context() as m:  # no arrival: nothing but the arrivals is read
        read = type(wh).read
        m.setattr(type(wh), "read", lambda self, name: read(self, name) if name.startswith("arrivals") else pytest.fail(name))
        assert loader.retry_rejects(-2).loaded == 0
    loader.load_masters(raw_customers(spark, late[0]), None)
    awaited = loader.awaited_rejects(loader._arrived(-3))
    assert {r.batch_id for r in awaited.collect()} == {0}
    assert loader.retry_rejects(-3).loaded == 1 and orders(wh) == ["O1"]
    loader.load_masters(None, raw_products(spark, late[1]))
    assert loader.retry_rejects(-4).loaded == 1 and orders(wh) == ["O1", "O2"]
    assert [r.orderID for r in loader.open_rejects().collect()] == ["O3"]
    assert loader.retry_rejects(-5, everything=True).loaded == 0


def test_master_rows_are_stored_or_listed(spark, new_wh, tmpdir_path):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    os.makedirs(f"{tmpdir_path}/p")
    with open(f"{tmpdir_path}/p/a.csv", "w") as fh:
        fh.write("Product_ID,Product_Category,price$,storeID,storeName,supplierID,supplierName\nP1,Toys,1.50,S1,One,U1,Un\n P1 ,Toys,9.99,S1,One,U1,Un\n"
                 ",Toys,1.00,S7,Lost,U1,Un\nP2,Toys,abc,S1,One,U1,Un\nP3,Toys,,S1,One,U1,Un\nP4,Toys\n" + "P" * 51 + ",Toys,1.00,S1,One,U1,Un\n")
    people = [("C1", "F", "0-17", "10", "A", "2", "0"), ("", "F", "0-17", "10", "A", "2", "0"), ("C2", "F", "0-17", "ten", "A", "2", "0"), ("C3", "F", "0-17", None, "A", "2", "yes")]
    for again in (0, 1):
        loader.load_masters(raw_customers(spark, people), files.read_products(spark, f"{tmpdir_path}/p"), load_id=again)
    got = {(r.table, r.read, r.stored, r.existing, r.duplicates, r.rejected) for r in loader.master_reports}
    assert got == {("dim_customer", 4, 1, 0, 0, 3), ("dim_product", 7, 2, 0, 1, 4), ("dim_customer", 4, 0, 1, 0, 3), ("dim_product", 7, 0, 2, 1, 4)}
    listed = wh.read("master_rejects").filter("load_id = 1")
    assert sorted((r.table_name, r.business_key, r.reject_reason) for r in listed.collect() if r.business_key) == [
        ("dim_customer", "C2", "bad_occupation"), ("dim_customer", "C3", "bad_marital_status"), ("dim_product", "P1", "duplicate_key"),
        ("dim_product", "P2", "bad_price"), ("dim_product", "P4", "malformed_row"), ("dim_product", "P" * 51, "id_too_long")]
    assert [r.raw for r in listed.collect() if r.reject_reason == "malformed_row"] == ["P4,Toys"]
    assert {str(r.price) for r in wh.read("dim_product").collect()} == {"1.50", "None"}


def test_rollup_from_deltas_reads_no_fact(spark, started):
    wh, loader = started
    loader.process_batch(raw_tx(spark, [("O1", "C1", "P1", "2", "2017-01-10"), ("O2", "C9", "P3", "1", "2017-05-10")]), 0)
    views.materialize_rollup(wh)
    loader.process_batch(raw_tx(spark, [("O3", "C3", "P2", "4", "2017-02-01")]), 1)
    loader.process_batch(raw_tx(spark, [("O3", "C3", "P2", "4", "2017-02-01")]), 1)  # a replay adds nothing
    loader.load_masters(raw_customers(spark, [("C9", "M", "18-25", "1", "A", "0", "0")]), None)
    loader.retry_rejects(-1)
    plan = views.rollup_of_batches(wh, [1, -1])._jdf.queryExecution().toString()
    assert "fact_sales" not in plan and "dynamicpruning" in plan
    views.refresh_rollup(wh, [1, -1])
    rows = lambda df: sorted((r.storeName, r.year, r.quarter, str(r.quarterly_sales)) for r in df.collect())
    assert rows(views.read_rollup(wh)) == rows(reports.store_quarterly_sales(wh.star())) and len(rows(views.read_rollup(wh))) == 2


def test_lenient_dates_and_whole_numbers(spark):
    days = ["2017-02-05", "2017-2-5", "2017/02/05", "2/5/2017", "20170205", "5-Feb-2017", "Feb 5, 2017", "2017-02-05 7:08", "2017-02-05T07:08:09.5Z", "2017/2/5 23:59:59"]
    bad = ["2017-13-01", "2017-02-30", "", None, "soon", "2017"]
    df = spark.createDataFrame([(d,) for d in days + bad], "d string").select(parse_date("d").alias("x"))
    got = [str(r.x) for r in df.collect()]
    assert got == ["2017-02-05"] * len(days) + ["None"] * len(bad), got
    n = spark.createDataFrame([(x,) for x in ["3", " 3 ", "3.0", "3.5", "-2.000", "9999999999", "x", "", None]], "d string").select(parse_int("d").alias("x"))
    assert [r.x for r in n.collect()] == [3, 3, 3, None, -2, None, None, None, None]
