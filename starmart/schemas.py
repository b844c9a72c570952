"""Schemas of the raw inputs and of the warehouse tables.

Raw inputs are read with explicit schemas (streaming file sources require
one, and it avoids an inference pass over large CSVs). Every raw column is a
string: the cleansing step casts with ``try_cast`` / ``try_to_date`` so a bad
value becomes a reject with a reason instead of failing the job.
"""

from pyspark.sql import types as T

S = T.StringType()

# Raw master data as it arrives (CSV headers). ``price$`` is renamed on read.
CUSTOMER_RAW = T.StructType([
    T.StructField("Customer_ID", S),
    T.StructField("Gender", S),
    T.StructField("Age", S),
    T.StructField("Occupation", S),
    T.StructField("City_Category", S),
    T.StructField("Stay_In_Current_City_Years", S),
    T.StructField("Marital_Status", S),
])

PRODUCT_RAW = T.StructType([
    T.StructField("Product_ID", S),
    T.StructField("Product_Category", S),
    T.StructField("price$", S),
    T.StructField("storeID", S),
    T.StructField("storeName", S),
    T.StructField("supplierID", S),
    T.StructField("supplierName", S),
])

# One sales transaction (the stream tuple).
TRANSACTION_RAW = T.StructType([
    T.StructField("orderID", S),
    T.StructField("Customer_ID", S),
    T.StructField("Product_ID", S),
    T.StructField("quantity", S),
    T.StructField("date", S),
])

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("Customer_ID", S, False),
    T.StructField("Gender", S),
    T.StructField("Age", S),
    T.StructField("Occupation", T.IntegerType()),
    T.StructField("City_Category", S),
    T.StructField("Stay_In_Current_City_Years", S),
    T.StructField("Marital_Status", T.IntegerType()),
])

DIM_STORE = T.StructType([
    T.StructField("store_key", T.LongType(), False),
    T.StructField("storeID", S, False),
    T.StructField("storeName", S),
])

DIM_SUPPLIER = T.StructType([
    T.StructField("supplier_key", T.LongType(), False),
    T.StructField("supplierID", S, False),
    T.StructField("supplierName", S),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_key", T.LongType(), False),
    T.StructField("Product_ID", S, False),
    T.StructField("Product_Category", S),
    T.StructField("price", PRICE),
    T.StructField("store_key", T.LongType()),
    T.StructField("supplier_key", T.LongType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("day_of_week", S),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", S),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("season", S),
])

# Fact rows carry their own year/month (partition columns) so a report that
# slices by year prunes fact files without a join, and batch_id so a replayed
# micro-batch overwrites exactly its own files.
FACT_SALES = T.StructType([
    T.StructField("orderID", S, False),
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("product_key", T.LongType(), False),
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("total_amount", AMOUNT),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), False),
])

REJECTS = T.StructType(list(TRANSACTION_RAW.fields) + [
    T.StructField("reject_reason", S, False),
    T.StructField("row_id", S, False),
    T.StructField("batch_id", T.LongType(), False),
])

# A reject fixed by a later retry: which row, and in which load it became a fact.
REJECTS_RESOLVED = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("row_id", S, False),
    T.StructField("resolved_in", T.LongType(), False),
])

# A master row that is not in its dimension, as read (JSON of its raw columns).
MASTER_REJECTS = T.StructType([
    T.StructField("table_name", S, False),
    T.StructField("business_key", S),
    T.StructField("raw", S),
    T.StructField("reject_reason", S, False),
    T.StructField("load_id", T.LongType(), False),
])

# A file whose rows a batch has loaded (or claimed, until the batch is in the ledger).
MANIFEST = T.StructType([
    T.StructField("path", S, False),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("source", S, False),
    T.StructField("batch_id", T.LongType(), False),
])

# Keys that rejected rows of a batch wait for, and keys that a master load has brought.
WAITING = T.StructType([
    T.StructField("key_kind", S, False),
    T.StructField("business_key", S, False),
    T.StructField("key_bucket", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), False),
])
ARRIVALS = T.StructType([
    T.StructField("key_kind", S, False),
    T.StructField("business_key", S, False),
    T.StructField("load_id", T.LongType(), False),
])
#: Arrivals that a retry has answered.
ARRIVALS_SEEN = T.StructType([T.StructField("load_id", T.LongType(), False), T.StructField("retry_id", T.LongType(), False)])

# What a batch adds to a store's quarter.
ROLLUP_DELTAS = T.StructType([
    T.StructField("store_key", T.LongType(), False),
    T.StructField("sales", T.DecimalType(38, 2), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), False),
])

# One row per finished load or retry; quarters are yyyyq.
LOADS = T.StructType([
    T.StructField("source", S, False),
    T.StructField("read_rows", T.LongType(), False),
    T.StructField("loaded_rows", T.LongType(), False),
    T.StructField("rejected_rows", T.LongType(), False),
    T.StructField("quarters", T.ArrayType(T.IntegerType()), False),
    T.StructField("batch_id", T.LongType(), False),
])
#: The first batch id of each stream.
STREAMS = T.StructType([T.StructField("source", S, False), T.StructField("first_id", T.LongType(), False)])
LOADS_CLOSED = T.StructType([T.StructField("batch_id", T.LongType(), False)])

# The columns of the test-data event stream that the event enrichment reads.
EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", S),
    T.StructField("value", T.DoubleType()),
])
