"""Enrichment: transactions joined to the dimensions (J1, J2) and the split
into fact rows and rejects (C5, C6), plus the retry of rejects (J3).

One left join per dimension replaces the per-row key lookups of a
hand-written loader: unmatched rows are not lost or stuck, they carry a
reason. The join strategy is Catalyst's: a dimension under the broadcast
threshold is broadcast (statistics at planning time, then AQE with the real
sizes at run time); a larger one is joined by shuffle, with AQE splitting
skewed keys (a customer with a large share of the transactions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.dates import date_key
from starmart.functions.measures import line_amount
from starmart.operators import cleanse as C

CUSTOMER_KEY, PRODUCT_KEY = "customer", "product"
#: Folders of the index of awaited keys, so that an arrival reads its own share only.
KEY_BUCKETS = 16

RAW_COLS = ("orderID", "Customer_ID", "Product_ID", "quantity", "date")


def enrich(tx_clean: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Cleansed transactions with keys, amount and ``reject_reason`` (null = loads)."""
    j = (tx_clean
         .join(dim_customer.select("Customer_ID", "customer_key"), "Customer_ID", "left")
         .join(dim_product.select("Product_ID", "product_key", "price", *[c for c in ("store_key",) if c in dim_product.columns]),
               "Product_ID", "left"))
    amount = line_amount("quantity", "price")
    lookup = C.first_reason([
        (F.col("customer_key").isNull(), C.UNKNOWN_CUSTOMER),
        (F.col("product_key").isNull(), C.UNKNOWN_PRODUCT),
        (F.col("price").isNull(), C.MISSING_PRICE),
        (amount.isNull(), C.AMOUNT_OVERFLOW),
    ])
    return j.withColumn("total_amount", amount).withColumn(
        "reject_reason", F.coalesce(F.col("pre_reason"), lookup))


def facts(enriched: DataFrame, batch_id) -> DataFrame:
    """Fact rows of an enriched batch, in the warehouse layout."""
    d = F.col("sale_date")
    return (enriched.filter(F.col("reject_reason").isNull())
            .select("orderID", "customer_key", "product_key",
                    date_key(d).alias("date_key"), "quantity", "total_amount",
                    F.year(d).alias("year"), F.month(d).alias("month"),
                    F.lit(batch_id).cast("long").alias("batch_id")))


def rejects(enriched: DataFrame, batch_id) -> DataFrame:
    """Rejected rows with their raw text, reason, batch and row id."""
    return (enriched.filter(F.col("reject_reason").isNotNull())
            .select(*[F.col(f"raw_{c}").alias(c) for c in RAW_COLS], "reject_reason",
                    "row_id", F.lit(batch_id).cast("long").alias("batch_id")))


def waiting_keys(enriched: DataFrame, batch_id) -> DataFrame:
    """The master keys that an enriched batch's rejects wait for, each once."""
    open_ = enriched.filter(F.col("reject_reason").isin(C.UNKNOWN_CUSTOMER, C.UNKNOWN_PRODUCT))
    missing = F.array_compact(F.array(
        F.when(F.col("customer_key").isNull(), F.struct(F.lit(CUSTOMER_KEY).alias("key_kind"), F.col("Customer_ID").alias("business_key"))),
        F.when(F.col("product_key").isNull(), F.struct(F.lit(PRODUCT_KEY).alias("key_kind"), F.col("Product_ID").alias("business_key")))))
    keys = open_.select(F.explode(missing).alias("k")).select("k.*").distinct()
    return keys.withColumn("key_bucket", key_bucket("business_key")).withColumn("batch_id", F.lit(batch_id).cast("long"))


def key_bucket(key):
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def store_quarters(enriched: DataFrame, batch_id) -> DataFrame:
    """What the facts of an enriched batch add to each store's quarter. Facts of products
    without a store add to none."""
    d = F.col("sale_date")
    return (enriched.filter(F.col("reject_reason").isNull() & F.col("store_key").isNotNull())
            .groupBy("store_key", F.year(d).alias("year"), F.quarter(d).alias("quarter"))
            .agg(F.sum("total_amount").cast("decimal(38,2)").alias("sales"))
            .select("store_key", "sales", "year", "quarter", F.lit(batch_id).cast("long").alias("batch_id")))


def retryable(rejects_df: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """Open rejects that a later master row could fix (unknown customer or
    product), as raw transactions with their original (batch_id, row_id)."""
    open_ = rejects_df.filter(F.col("reject_reason").isin(*C.RETRYABLE))
    if resolved is not None:
        open_ = open_.join(resolved.select("batch_id", "row_id"), ["batch_id", "row_id"], "left_anti")
    return open_.select(*RAW_COLS, F.col("batch_id").alias("src_batch_id"), "row_id")
