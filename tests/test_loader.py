"""Dimensions, surrogate keys, enrichment, rejects, retry and replay."""

from pyspark.sql import functions as F

from starmart.operators import cleanse as C
from starmart.operators.dims import insert_if_absent
from starmart.operators.keys import assign_surrogate_keys
from starmart.streaming.loader import WarehouseLoader
from tests.conftest import CUSTOMERS, PRODUCTS, raw_customers, raw_products, raw_tx


def test_surrogate_keys_dense_in_business_order(spark, tmpdir_path):
    df = spark.createDataFrame([(f"K{i:05d}",) for i in range(997)], "k string").repartition(7)
    for staging in (None, f"{tmpdir_path}/staging"):
        keyed = assign_surrogate_keys(df, "k", "key", start=10, num_partitions=5, staging=staging)
        rows = sorted(keyed.collect(), key=lambda r: r.k)
        assert [r.key for r in rows] == list(range(11, 11 + 997))


def test_insert_if_absent_first_writer_wins(spark):
    # Duplicate ids in one load, changed attributes in a later load
    existing = spark.createDataFrame([(1, "S1", "Store One")], "store_key long, storeID string, storeName string")
    incoming = spark.createDataFrame(
        [("S1", "Renamed", 0), ("S2", "Second", 1), ("S2", "Second again", 2), ("S3", "Third", 3)],
        "storeID string, storeName string, _load_order long")
    new = insert_if_absent(incoming, existing, "storeID", "store_key", "_load_order")
    got = sorted((r.store_key, r.storeID, r.storeName) for r in new.collect())
    assert got == [(2, "S2", "Second"), (3, "S3", "Third")]


def _loaded(spark, new_wh, tx_rows, customers=CUSTOMERS, products=PRODUCTS):
    wh = new_wh()
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, customers), raw_products(spark, products))
    rep = loader.process_batch(raw_tx(spark, tx_rows), 0)
    return wh, loader, rep


def test_masters_build_dims_with_snowflake_keys(spark, new_wh):
    wh, _, _ = _loaded(spark, new_wh, [("O1", "C1", "P1", "1", "2017-01-01")])
    stores = {r.storeID: (r.store_key, r.storeName) for r in wh.read("dim_store").collect()}
    assert stores == {"S1": (1, "Store One"), "S2": (2, "Store Two")}
    prods = {r.Product_ID: (r.product_key, r.store_key, r.supplier_key, str(r.price))
             for r in wh.read("dim_product").collect()}
    assert prods == {"P1": (1, 1, 1, "10.50"), "P2": (2, 1, 2, "3.25"), "P3": (3, 2, 1, "100.00")}
    assert [r.customer_key for r in wh.read("dim_customer").orderBy("Customer_ID").collect()] == [1, 2, 3]


def test_rejects_carry_reasons_and_counts_add_up(spark, new_wh):
    tx = [
        ("O1", " C1 ", "P1 ", "2", "2017-03-04"),   # E1: trimmed ids load
        ("O2", "C9", "P1", "1", "2017-03-04"),      # E2: unknown customer
        ("O3", "C2", "P9", "1", "2017-03-04"),      # E3: unknown product
        ("O4", "C2", "P2", "1", "2017-13-01"),      # E4: bad date
        ("O5", "C2", "P2", "1", ""),                # E4: empty date
        ("O6", "C2", "P2", "two", "2017-03-04"),    # E16: non-numeric quantity
        ("O7", "", "P2", "1", "2017-03-04"),        # E1: blank id
        ("O8", None, "P2", "1", "2017-03-04"),      # E1: null id
        ("O9", "C3", "P3", "3", "2017-03-05"),
    ]
    wh, _, rep = _loaded(spark, new_wh, tx)
    assert (rep.loaded, rep.rejected, rep.read) == (2, 7, 9)
    reasons = {r.orderID: r.reject_reason for r in wh.read("rejects").collect()}
    assert reasons == {"O2": C.UNKNOWN_CUSTOMER, "O3": C.UNKNOWN_PRODUCT, "O4": C.BAD_DATE, "O5": C.BAD_DATE,
                       "O6": C.BAD_QUANTITY, "O7": C.MISSING_CUSTOMER_ID, "O8": C.MISSING_CUSTOMER_ID}
    facts = {r.orderID: (str(r.total_amount), r.date_key, r.year, r.month) for r in wh.read("fact_sales").collect()}
    assert facts == {"O1": ("21.00", 20170304, 2017, 3), "O9": ("300.00", 20170305, 2017, 3)}
    # the raw text is kept for a rejected row
    assert wh.read("rejects").filter("orderID = 'O6'").first().quantity == "two"
    dates = sorted(r.full_date.isoformat() for r in wh.read("dim_date").collect())
    assert dates == ["2017-03-04", "2017-03-05"]


def test_retry_resolves_late_master_rows_once(spark, new_wh):
    # A transaction for an unknown customer waits, then loads once
    wh, loader, rep = _loaded(spark, new_wh, [("O1", "C1", "P1", "1", "2017-01-02"),
                                              ("O2", "C4", "P1", "2", "2017-01-02")])
    assert (rep.loaded, rep.rejected) == (1, 1)
    assert loader.retry_rejects(100).loaded == 0  # still unknown
    loader.load_masters(raw_customers(spark, [("C4", "M", "18-25", "1", "A", "0", "0")]), None)
    assert loader.retry_rejects(101).loaded == 1
    assert loader.retry_rejects(101).loaded == 1  # re-run of the same retry: idempotent
    assert loader.retry_rejects(102).loaded == 0  # nothing open any more
    assert wh.read("fact_sales").count() == 2
    assert loader.open_rejects().count() == 0
    assert wh.read("dim_customer").filter("Customer_ID = 'C4'").first().customer_key == 4


def test_retry_adds_the_dates_it_needs(spark, new_wh):
    wh, loader, _ = _loaded(spark, new_wh, [("O2", "C4", "P1", "2", "2019-07-14")])
    assert wh.read("dim_date").count() == 0  # a rejected row's date is not a fact date yet
    loader.load_masters(raw_customers(spark, [("C4", "M", "18-25", "1", "A", "0", "0")]), None)
    loader.retry_rejects(7)
    assert [r.date_key for r in wh.read("dim_date").collect()] == [20190714]


def test_replay_of_a_batch_adds_nothing(spark, new_wh):
    # The same batch id processed twice
    tx = [("O1", "C1", "P1", "1", "2017-01-02"), ("O1", "C1", "P1", "1", "2017-01-02"),
          ("O2", "C2", "P2", "4", "2017-02-03"), ("O3", "C9", "P2", "4", "2017-02-03")]
    wh, loader, _ = _loaded(spark, new_wh, tx)
    loader.process_batch(raw_tx(spark, tx), 0)
    assert wh.read("fact_sales").count() == 3  # the duplicate line is kept once per load, as in the input
    assert wh.read("rejects").count() == 1
    assert wh.read("dim_date").count() == 2


def test_price_change_keeps_old_amounts(spark, new_wh):
    # total_amount is fixed at load; a later master row does not change it
    wh, loader, _ = _loaded(spark, new_wh, [("O1", "C1", "P1", "2", "2017-01-02")])
    loader.load_masters(None, raw_products(spark, [("P1", "Grocery", "99.99", "S1", "Store One", "U1", "S")]))
    loader.process_batch(raw_tx(spark, [("O2", "C1", "P1", "1", "2017-01-03")]), 1)
    amounts = {r.orderID: str(r.total_amount) for r in wh.read("fact_sales").collect()}
    assert amounts == {"O1": "21.00", "O2": "10.50"}  # first writer wins for the product too


def test_dates_first_seen_in_later_batch(spark, new_wh):
    # A date first seen in the second batch still loads
    wh, loader, _ = _loaded(spark, new_wh, [("O1", "C1", "P1", "1", "2017-01-02")])
    loader.process_batch(raw_tx(spark, [("O2", "C2", "P2", "1", "2018-06-30")]), 1)
    assert wh.read("fact_sales").count() == 2
    d = wh.read("dim_date").filter(F.col("full_date") == F.lit("2018-06-30").cast("date")).first()
    assert d.season == "Summer" and d.date_key == 20180630


def test_cached_batch_path_matches(spark, new_wh):
    tx = [("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C9", "P2", "4", "2017-02-03")]
    wh = new_wh("cached")
    loader = WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    rep = loader.process_batch(raw_tx(spark, tx), 0, persist=True)
    assert (rep.loaded, rep.rejected) == (1, 1)
    assert [r.full_date.isoformat() for r in wh.read("dim_date").collect()] == ["2017-01-02"]


def test_master_duplicates_reported(spark):
    # C4: duplicate business keys in master data are reported
    df = C.cleanse_customers(raw_customers(spark, CUSTOMERS + [(" C1", "M", "x", "1", "B", "1", "1")]))
    dups = {r.Customer_ID: r.n for r in C.duplicate_keys(df, "Customer_ID").collect()}
    assert dups == {"C1": 2}


def test_replay_after_master_arrives_leaves_no_stale_reject(spark, new_wh):
    # a batch rejected a row; its customer arrives; the batch id is replayed
    tx = [("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C5", "P2", "2", "2017-01-02")]
    wh, loader, rep = _loaded(spark, new_wh, tx)
    assert (rep.loaded, rep.rejected) == (1, 1)
    loader.load_masters(raw_customers(spark, [("C5", "F", "46-50", "9", "C", "3", "0")]), None)
    rep = loader.process_batch(raw_tx(spark, tx), 0)
    assert (rep.loaded, rep.rejected) == (2, 0)
    assert sorted(r.orderID for r in wh.read("fact_sales").collect()) == ["O1", "O2"]
    assert loader.open_rejects().count() == 0
    rep = loader.process_batch(raw_tx(spark, tx), 0)  # and once more
    assert (rep.loaded, rep.rejected) == (2, 0)


def test_compaction_merges_committed_batches_only(spark, new_wh):
    import glob
    from starmart.sources.warehouse import COMPACTED_BATCH_ID
    wh, loader, _ = _loaded(spark, new_wh, [("O1", "C1", "P1", "1", "2017-01-02"), ("O2", "C2", "P2", "1", "2017-02-02")])
    loader.process_batch(raw_tx(spark, [("O3", "C3", "P3", "2", "2017-01-20")]), 1)
    b2 = [("O4", "C1", "P2", "3", "2017-01-25")]
    loader.process_batch(raw_tx(spark, b2), 2)
    before = sorted(tuple(r) for r in wh.read("fact_sales").drop("batch_id").collect())
    wh.compact_facts([(2017, 1)], upto_batch_id=1)
    after = wh.read("fact_sales")
    assert sorted(tuple(r) for r in after.drop("batch_id").collect()) == before
    jan = {r.orderID: r.batch_id for r in after.filter("month = 1").collect()}
    assert jan == {"O1": COMPACTED_BATCH_ID, "O3": COMPACTED_BATCH_ID, "O4": 2}
    assert {r.batch_id for r in after.filter("month = 2").collect()} == {0}  # untouched month
    root = wh.path("fact_sales").replace("file:", "")
    assert len(glob.glob(f"{root}/year=2017/month=1/batch_id=*")) == 2
    loader.process_batch(raw_tx(spark, b2), 2)  # a later batch can still be replayed
    assert wh.read("fact_sales").count() == 4


def test_partitioned_lookups_shuffle_only_the_batch(spark, new_wh):
    from starmart.operators.enrich import enrich
    wh = new_wh()
    loader = WarehouseLoader(wh, lookup_partitions=4)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    t = C.cleanse_transactions(raw_tx(spark, [("O1", "C1", "P1", "1", "2017-01-02")])
                               .withColumn("row_id", F.lit(0).cast("long")))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # as if the dimensions were too large to broadcast
        e = enrich(t, loader._lookup("dim_customer"), loader._lookup("dim_product"))
        plan = e._jdf.queryExecution().executedPlan().toString()
        # the join's exchanges carry only the batch's rows (ENSURE_REQUIREMENTS);
        # the lookups are read from the cache in their own partitioning (the
        # REPARTITION_BY_NUM exchanges printed inside them are the one-time build)
        join_exchanges = [ln.strip() for ln in plan.splitlines()
                          if "Exchange hashpartitioning" in ln and "ENSURE_REQUIREMENTS" in ln]
        assert len(join_exchanges) == 2
        assert any("(Customer_ID" in x for x in join_exchanges) and any("(Product_ID" in x for x in join_exchanges)
        assert plan.count("InMemoryTableScan") == 2
        assert e.filter("reject_reason is null").count() == 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    rep = loader.process_batch(raw_tx(spark, [("O2", "C2", "P2", "1", "2017-01-03")]), 1)
    assert (rep.loaded, rep.rejected) == (1, 0)
    loader.load_masters(raw_customers(spark, [("C6", "F", "x", "1", "A", "1", "0")]), None)
    assert not loader._lookups  # rebuilt after a master load
    rep = loader.process_batch(raw_tx(spark, [("O3", "C6", "P2", "1", "2017-01-03")]), 2)
    assert (rep.loaded, rep.rejected) == (1, 0)


def test_staged_rows_hold_raw_texts_once(spark, new_wh, monkeypatch):
    """Every row passes the joins and the staging: identities and raw texts that the typed columns repeat stay out of them,
    and the rejects hold the raw texts and identities all the same."""
    from starmart.streaming import loader as L

    tx = [("O1", "C1", "P1", "2", "2017-01-10"), (" O2", "C2", "P1", "2.0", "2017/01/11"), (" O3 ", "C9", "P1", "+3", "20170112"),
          ("O4", "C9", "P9", "4", "2017-01-13"), ("O5", None, "P1", "x", "2017-01-14"), ("O6", "C1", "P2", "1", "2017-13-14")]
    staged = []
    routed_facts = L.facts
    monkeypatch.setattr(L, "facts", lambda df, batch_id: staged.append(df.columns) or routed_facts(df, batch_id))
    wh = new_wh()
    loader = L.WarehouseLoader(wh)
    loader.load_masters(raw_customers(spark, CUSTOMERS), raw_products(spark, PRODUCTS))
    assert (loader.process_batch(raw_tx(spark, tx), 0).loaded, loader.reports[-1].rejected) == (2, 4)
    assert not [c for c in staged[0] if c == "row_id" or c.startswith("raw_")]
    got = wh.read("rejects").select(*L.RAW_COLS, "reject_reason", "row_id").collect()
    want = raw_tx(spark, tx).withColumn("row_id", F.md5(F.to_json(F.struct(*L.RAW_COLS)))).collect()
    assert sorted((*map(str, r[:5]), r["row_id"]) for r in got) == sorted((*map(str, r[:5]), r["row_id"]) for r in want[2:])
    assert sorted(r["reject_reason"] for r in got) == ["bad_date", "missing_customer_id", "unknown_customer", "unknown_customer"]
