"""Master CSV readers, export, views and the materialized roll-up refresh."""

import os

from pyspark.sql import functions as F

from starmart.plans import reports, views
from starmart.sources import files
from starmart.streaming.loader import WarehouseLoader
from tests.conftest import raw_tx


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_master_csvs_load_into_dimensions(spark, tmpdir_path, new_wh):
    # Header CSVs, ``price$`` column, ids with blanks
    _write(f"{tmpdir_path}/c/customers.csv",
           "Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status\n"
           " 1000001 ,F,0-17,10,A,2,0\n1000002,M,55+,16,C,4+,0\n")
    _write(f"{tmpdir_path}/p/products.csv",
           "Product_ID,Product_Category,price$,storeID,storeName,supplierID,supplierName\n"
           "P00069042,Electronics,120.50,S1,Alpha,SUP1,Acme\nP00248942,Toys,9.99,S2,Beta,SUP1,Acme\n")
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(files.read_customers(spark, f"{tmpdir_path}/c"), files.read_products(spark, f"{tmpdir_path}/p"))
    assert sorted(r.Customer_ID for r in wh.read("dim_customer").collect()) == ["1000001", "1000002"]
    p = {r.Product_ID: (str(r.price), r.supplier_key) for r in wh.read("dim_product").collect()}
    assert p == {"P00069042": ("120.50", 1), "P00248942": ("9.99", 1)}
    assert wh.read("dim_supplier").count() == 1 and wh.read("dim_store").count() == 2
    # Export a report
    out = f"{tmpdir_path}/export"
    files.export(reports.q13_supplier_contribution(wh.star()), out)
    assert spark.read.option("header", True).csv(out).count() == 0  # no sales yet


def test_rollup_refresh_rewrites_only_touched_quarters(spark, new_wh):
    # V2: materialize, load a batch into one quarter, refresh only that quarter
    from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    loader.process_batch(raw_tx(spark, [("O1", "C1", "P1", "2", "2017-01-10"),
                                        ("O2", "C2", "P3", "1", "2017-05-10")]), 0)
    views.materialize_rollup(wh)
    before = {(r.storeName, r.year, r.quarter): str(r.quarterly_sales) for r in views.read_rollup(wh).collect()}
    assert before == {("Store One", 2017, 1): "21.00", ("Store Two", 2017, 2): "100.00"}
    loader.process_batch(raw_tx(spark, [("O3", "C3", "P2", "4", "2017-02-01")]), 1)
    views.refresh_rollup(wh, [1])
    after = {(r.storeName, r.year, r.quarter): str(r.quarterly_sales) for r in views.read_rollup(wh).collect()}
    assert after == {("Store One", 2017, 1): "34.00", ("Store Two", 2017, 2): "100.00"}
    # the refreshed roll-up equals the view computed from scratch
    fresh = {(r.storeName, r.year, r.quarter): str(r.quarterly_sales)
             for r in reports.store_quarterly_sales(wh.star()).collect()}
    assert after == fresh


def test_register_views_for_sql(spark, new_wh):
    from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    loader.process_batch(raw_tx(spark, [("O1", "C1", "P1", "2", "2017-01-10")]), 0)
    views.register_views(spark, wh.star())
    row = spark.sql("SELECT storeName, quarterly_sales FROM STORE_QUARTERLY_SALES").first()
    assert (row.storeName, str(row.quarterly_sales)) == ("Store One", "21.00")
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_sales f JOIN dim_date d USING (date_key)").first().n
    assert n == 1
    assert wh.read("fact_sales").filter(F.col("year") == 2017).count() == 1
