"""Master and transaction files are read by header name, in file order."""

import os

import pytest
from pyspark.sql import functions as F

from starmart.__main__ import main
from starmart.operators import cleanse as C
from starmart.operators import dims as D
from starmart.plans import reports
from starmart.sources import files
from starmart.streaming import WarehouseLoader

from conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products, raw_tx

DOCUMENTED = "Product_ID,Product_Category,price$,storeID,supplierID,storeName,supplierName"


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.mark.parametrize("header,row", [
    (DOCUMENTED, "P1,Toys,1.50,S9,U9,Store Nine,Supplier Nine"),
    ("supplierName,extra,storeID,price$,storeName,Product_ID,supplierID,Product_Category", "Supplier Nine,x,S9,1.50,Store Nine,P1,U9,Toys"),
])
def test_products_by_header_name(spark, tmpdir_path, header, row):
    put(f"{tmpdir_path}/p/a.csv", header, row)
    r = files.read_products(spark, f"{tmpdir_path}/p").first()
    assert (r["Product_ID"], r["price$"], r["storeID"], r["storeName"], r["supplierID"], r["supplierName"]) == (
        "P1", "1.50", "S9", "Store Nine", "U9", "Supplier Nine")


def test_missing_column_fails(spark, tmpdir_path):
    put(f"{tmpdir_path}/p/a.csv", "Product_ID,Product_Category,storeID", "P1,Toys,S9")
    with pytest.raises(ValueError, match="price"):
        files.read_products(spark, f"{tmpdir_path}/p")


def test_stream_reads_by_name_and_restarts_where_it_stopped(spark, new_wh, tmpdir_path):
    wh = new_wh()
    WarehouseLoader(wh).load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    landing = f"{tmpdir_path}/landing"
    put(f"{landing}/a.csv", "date,quantity,orderID,note,Product_ID,Customer_ID", "2017-01-05,2,O1,x,P1,C1")
    main(["load", "--warehouse", wh.root, "--transactions", landing, "--stream"], spark)
    put(f"{landing}/b.csv", "date,quantity,orderID,note,Product_ID,Customer_ID", "2017-01-06,1,O2,x,P2,C2")
    main(["load", "--warehouse", wh.root, "--transactions", landing, "--stream", "--max-files-per-trigger", "2"], spark)
    assert sorted((r["orderID"], r["quantity"]) for r in wh.read("fact_sales").collect()) == [("O1", 2), ("O2", 1)]


def test_two_batch_loads_of_one_month(spark, new_wh, tmpdir_path):
    wh = new_wh()
    WarehouseLoader(wh).load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    for i in (1, 2):
        put(f"{tmpdir_path}/t{i}/a.csv", "orderID,Customer_ID,Product_ID,quantity,date", f"O{i},C1,P1,1,2017-01-0{i}")
        main(["load", "--warehouse", wh.root, "--transactions", f"{tmpdir_path}/t{i}"], spark)
    assert sorted(r["orderID"] for r in wh.read("fact_sales").collect()) == ["O1", "O2"]


def test_first_name_in_file_order_wins(spark, tmpdir_path):
    put(f"{tmpdir_path}/p/a.csv", DOCUMENTED, "P1,Toys,1.50,S1,U1,FIRST,x")
    put(f"{tmpdir_path}/p/b.csv", DOCUMENTED, *[f"Q{i},Toys,1.50,S1,U1,LATER,x" for i in range(3000)])
    rows = C.cleanse_products(files.read_products(spark, f"{tmpdir_path}/p"))
    stores = D.insert_if_absent(D.store_rows(rows), None, "storeID", order_col="_load_order")
    assert [r["storeName"] for r in stores.collect()] == ["FIRST"]


def test_product_without_price_is_rejected(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, [*PRODUCTS, ("P9", "Toys", "n/a", "S1", "Store One", "U1", "Supplier One")]))
    loader.process_batch(raw_tx(spark, [("O1", "C1", "P9", "2", "2017-01-05"), ("O2", "C1", "P1", "1", "2017-01-05")]), 0)
    assert [r["orderID"] for r in wh.read("fact_sales").collect()] == ["O2"]
    assert [(r["orderID"], r["reject_reason"]) for r in wh.read("rejects").collect()] == [("O1", "missing_price")]


def test_averages_skip_null_amounts(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    loader.process_batch(raw_tx(spark, [("O1", "C1", "P1", "1", "2017-01-05"), ("O2", "C1", "P1", "1", "2017-01-05")]), 0)
    star = wh.star()
    star.fact = star.fact.withColumn("total_amount", F.when(F.col("orderID") == "O1", F.col("total_amount")))
    r = reports.q07_avg_by_stay_gender(star).first()
    assert (r["avg_purchase_amount"], r["transaction_count"]) == (10.5, 2)
    assert reports.q14_seasonal(star).first()["avg_transaction_amount"] == 10.5
