"""Load checks and diagnostic queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.measures import to_double
from starmart.operators.cleanse import row_counts
from starmart.operators.olap import top_n
from starmart.sources.warehouse import Star


def diag_date_span(star: Star) -> DataFrame:
    return star.date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def diag_multi_product_orders(star: Star, n: int = 10) -> DataFrame:
    """Orders with more than one distinct product (the basket sanity check
    before the affinity report), first ``n`` by order id."""
    per = (star.fact.select("orderID", "product_key").groupBy("orderID")
           .agg(F.count_distinct("product_key").alias("product_count"))
           .filter(F.col("product_count") > 1))
    return top_n(per, ["orderID"], n)


def diag_row_counts(star: Star) -> DataFrame:
    return row_counts(star.tables())


def diag_enriched_sample(star: Star, n: int = 10) -> DataFrame:
    """First ``n`` enriched fact rows by order. Only the orders of the first
    ``n`` fact rows can contain them, so the joins see at most those orders
    (a broadcast of at most ``n`` ids), never the whole fact."""
    f = star.fact.select("orderID", "customer_key", "product_key", "quantity", "total_amount")
    first_orders = F.broadcast(top_n(f.select("orderID"), ["orderID"], n).distinct())
    rows = (f.join(first_orders, "orderID", "left_semi")
            .join(star.customer.select("customer_key", "Customer_ID", "Gender"), "customer_key")
            .join(star.product.select("product_key", "Product_ID", "Product_Category"), "product_key"))
    out = top_n(rows, ["orderID", "Product_ID", "quantity", "total_amount"], n)
    return out.select("orderID", "Customer_ID", "Gender", "Product_ID", "Product_Category", "quantity",
                      to_double("total_amount").alias("total_amount"))


DIAGNOSTICS = {
    "diag_date_span": diag_date_span,
    "diag_multi_product_orders": diag_multi_product_orders,
    "diag_row_counts": diag_row_counts,
    "diag_enriched_sample": diag_enriched_sample,
}
