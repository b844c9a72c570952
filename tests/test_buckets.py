"""Lookups stored in buckets by business key."""

import glob

import pytest
from pyspark.sql import functions as F

from starmart.operators import cleanse as C
from starmart.operators.enrich import enrich
from starmart.sources.buckets import bucket_table
from starmart.sources.warehouse import Warehouse
from starmart.streaming.loader import WarehouseLoader

from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products, raw_tx

KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in KEYS}
    for k in KEYS:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def forget_tables(spark):
    """As in a new session: the catalog knows no table (external ones keep their files)."""
    for t in spark.catalog.listTables():
        if t.name.startswith("starmart_buckets_"):
            spark.sql(f"DROP TABLE {t.name}")


def batch(spark):
    return C.cleanse_transactions(raw_tx(spark, [("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C9", "P4", "2", "2017-01-03"),
                                                 ("O3", "C2", "P9", "1", "2017-01-03")]).withColumn("row_id", F.lit(0).cast("long")))


def test_only_the_batch_is_shuffled_also_after_a_restart(spark, new_wh, no_broadcast):
    wh = new_wh()
    WarehouseLoader(wh, lookup_buckets=8).load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    for restart in range(2):
        loader = WarehouseLoader(Warehouse(spark, wh.root), lookup_buckets=8)
        loader._lookup("dim_customer"), loader._lookup("dim_product")  # brought up to date
        e = enrich(batch(spark), loader._lookup("dim_customer"), loader._lookup("dim_product"))
        plan = e._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert len(exchanges) == 2 and plan.count("Bucketed: true") == 2, plan
        assert plan.count("SelectedBucketsCount: 8 out of 8") == 2
        got = {r["orderID"]: r["reject_reason"] for r in e.collect()}
        assert got["O1"] is None and got["O2"] == C.UNKNOWN_CUSTOMER and got["O3"] == C.UNKNOWN_PRODUCT
        forget_tables(spark)


def test_buckets_follow_master_loads(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh, lookup_buckets=8)
    assert loader._lookup("dim_customer").count() == 0
    loader.load_masters(raw_customers(spark, CUSTOMERS[:2]), raw_products(spark, PRODUCTS))
    assert loader.process_batch(raw_tx(spark, [("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C3", "P2", "1", "2017-01-02")]), 0).rejected == 1
    loader.load_masters(raw_customers(spark, CUSTOMERS), None)
    assert loader.retry_rejects(-5).loaded == 1
    table = bucket_table(wh, "dim_customer", "Customer_ID", ["Customer_ID", "customer_key"], 8)
    want = {tuple(r) for r in wh.read("dim_customer").select("Customer_ID", "customer_key").collect()}
    assert sorted(tuple(r) for r in spark.table(table).collect()) == sorted(want) and len(want) == 3
    assert {r["orderID"] for r in wh.read("fact_sales").collect()} == {"O1", "O2"}


def test_a_cut_off_append_is_made_up(spark, new_wh):
    wh = new_wh()
    loader = WarehouseLoader(wh, lookup_buckets=8)
    many = [(f"C{i}", "F", "26-35", "4", "A", "1", "0") for i in range(50)]
    loader.load_masters(raw_customers(spark, many), None)
    assert loader._lookup("dim_customer").count() == 50
    files = glob.glob(f"{wh.root.replace('file:', '')}/dim_customer_by_Customer_ID_8/part-*")
    assert len(files) == 8  # one for each bucket
    kept = spark.read.parquet(*files[1:]).count()
    assert kept < 50
    table = bucket_table(wh, "dim_customer", "Customer_ID", ["Customer_ID", "customer_key"], 8)
    part = spark.read.parquet(*files[1:]).persist()
    part.count()
    part.repartition(8, "Customer_ID").write.insertInto(table, overwrite=True)  # as if one bucket had not been written
    assert spark.table(table).count() == kept
    again = WarehouseLoader(wh, lookup_buckets=8)._lookup("dim_customer")
    assert again.count() == again.select("Customer_ID").distinct().count() == 50
    part.unpersist()


def test_one_kind_of_lookup_at_a_time(new_wh):
    with pytest.raises(ValueError):
        WarehouseLoader(new_wh(), lookup_partitions=2, lookup_buckets=2)
