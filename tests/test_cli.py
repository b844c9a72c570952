"""The command line: CSV masters and transactions in, report folders out."""

import os

from starmart.__main__ import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_load_stream_report_retry(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/in/customers/c.csv",
           "Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status\n"
           "1000001,F,0-17,10,A,2,0\n1000002,M,55+,16,C,4+,0\n")
    _write(f"{d}/in/products/p.csv",
           "Product_ID,Product_Category,price$,storeID,storeName,supplierID,supplierName\n"
           "P1,Electronics,120.50,S1,Alpha,SUP1,Acme\nP2,Toys,9.99,S2,Beta,SUP2,Bolt\n")
    header = "orderID,Customer_ID,Product_ID,quantity,date\n"
    _write(f"{d}/in/tx/a.csv", header + "O1,1000001,P1,2,2017-03-04\nO1,1000001,P2,1,2017-03-04\n")
    _write(f"{d}/in/tx/b.csv", header + "O2,1000002,P2,5,2017-07-01\nO3,1000003,P1,1,2017-07-02\n")
    wh = f"{d}/dw"
    out = main(["load", "--warehouse", wh, "--customers", f"{d}/in/customers", "--products", f"{d}/in/products",
                "--transactions", f"{d}/in/tx", "--stream", "--max-files-per-trigger", "1", "--checkpoint", f"{d}/ck"], spark=spark)
    assert sorted(out["batches"]) == [(0, 2, 0), (1, 1, 1)]
    out = main(["report", "--warehouse", wh, "--out", f"{d}/results", "q13_supplier_contribution",
                "q16_affinity", "diag_row_counts"], spark=spark)
    q13 = spark.read.option("header", True).csv(f"{d}/results/q13_supplier_contribution")
    assert {r.Product_ID: float(r.total_sales) for r in q13.collect()} == {"P1": 241.0, "P2": 59.94}
    q16 = spark.read.option("header", True).csv(f"{d}/results/q16_affinity").collect()
    assert [(r.Product1_ID, r.Product2_ID, r.times_purchased_together) for r in q16] == [("P1", "P2", "1")]
    _write(f"{d}/in/customers2/c.csv",
           "Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status\n"
           "1000003,M,18-25,1,B,1,1\n")
    main(["load", "--warehouse", wh, "--customers", f"{d}/in/customers2"], spark=spark)
    assert main(["retry", "--warehouse", wh, "--retry-id", "-1000"], spark=spark)["resolved"] == 1
    assert main(["compact", "--warehouse", wh, "--upto-batch", "1", "--months", "2017-07"], spark=spark)["staging"]
    from starmart.sources.warehouse import Warehouse
    assert Warehouse(spark, wh).read("fact_sales").count() == 4
