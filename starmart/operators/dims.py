"""Dimension building: distinct projections, insert-if-absent, date dimension.

Semantics of the reference's loads, kept here:
  * a business key is inserted once; the first writer wins and later rows
    with the same key (in the same load or a later one) change nothing;
  * store and supplier rows are the distinct ids of the product master,
    first name by load order;
  * the date dimension holds every date seen in the transactions and grows
    with each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.dates import date_attributes
from starmart.operators.keys import assign_surrogate_keys, next_key_start


def first_per_key(df: DataFrame, key: str, order_col: str, cols: list[str]) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order_col``.

    ``min_by`` aggregates partially before the shuffle, so a key that
    holds a large share of the rows is reduced map-side first.
    """
    s = F.min_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col)).alias("_first")
    return df.groupBy(key).agg(s).select(key, *[F.col(f"_first.{c}").alias(c) for c in cols])


def insert_if_absent(incoming: DataFrame, existing: DataFrame | None, business_key: str,
                     key_col: str | None = None, order_col: str | None = None,
                     staging: str | None = None) -> DataFrame:
    """Rows of ``incoming`` whose business key is not yet in ``existing``,
    deduplicated (first by ``order_col``) and, with ``key_col``, numbered
    after the current maximum key. The caller appends the result."""
    cols = [c for c in incoming.columns if c not in (business_key, order_col)]
    if order_col:
        incoming = first_per_key(incoming, business_key, order_col, cols)
    else:
        incoming = incoming.dropDuplicates([business_key])
    if existing is not None:
        incoming = incoming.join(existing.select(business_key), business_key, "left_anti")
    if key_col is None:
        return incoming
    keyed = assign_surrogate_keys(incoming, business_key, key_col, next_key_start(existing, key_col),
                                  staging=staging)
    return keyed.select(key_col, business_key, *cols)


def store_rows(products: DataFrame) -> DataFrame:
    return products.select("storeID", "storeName", "_load_order").filter(F.col("storeID").isNotNull())


def supplier_rows(products: DataFrame) -> DataFrame:
    return products.select("supplierID", "supplierName", "_load_order").filter(F.col("supplierID").isNotNull())


def product_rows(products: DataFrame, dim_store: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    """Products with their store and supplier keys: two equi-joins in place of
    two point lookups per product."""
    return (products
            .join(dim_store.select("storeID", "store_key"), "storeID", "left")
            .join(dim_supplier.select("supplierID", "supplier_key"), "supplierID", "left")
            .select("Product_ID", "Product_Category", "price", "store_key", "supplier_key", "_load_order"))


def customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select("Customer_ID", "Gender", "Age", "Occupation", "City_Category",
                            "Stay_In_Current_City_Years", "Marital_Status", "_load_order")


def date_rows(dates: DataFrame, date_col: str = "sale_date") -> DataFrame:
    """dim_date rows for the distinct non-null dates of ``dates``.

    ``date_key`` is yyyymmdd, computed rather than allocated, so concurrent
    or replayed batches always agree on it.
    """
    d = dates.select(F.col(date_col).alias("_d")).filter(F.col("_d").isNotNull()).distinct()
    return d.select(*date_attributes(F.col("_d")))


def dates_of_facts(facts: DataFrame) -> DataFrame:
    """The dates of fact rows, from their computed yyyymmdd key."""
    return facts.select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("sale_date"))


def new_dates(dates: DataFrame, existing: DataFrame | None, date_col: str = "sale_date") -> DataFrame:
    rows = date_rows(dates, date_col)
    if existing is not None:
        rows = rows.join(existing.select("full_date"), "full_date", "left_anti")
    return rows.select("date_key", "full_date", "day_of_week", "day_of_month", "month",
                       "month_name", "quarter", "year", "is_weekend", "season")
