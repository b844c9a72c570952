"""Warehouse-level queries beyond the twenty reports: the dimensions as
loaded, the enriched fact, the streaming load, and the OLAP helpers
(slice/dice, drill, pivot, per-product daily statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.dates import day_type
from starmart.functions.measures import exact_avg, to_double
from starmart.operators import olap
from starmart.sources.warehouse import Star


# -- dimensions as loaded (D1-D6) -------------------------------------------
def dim_customer(star: Star) -> DataFrame:
    return star.customer


def dim_product(star: Star) -> DataFrame:
    return star.product.select("product_key", "Product_ID", "Product_Category",
                               to_double("price").alias("price"), "store_key", "supplier_key")


def dim_store(star: Star) -> DataFrame:
    return star.store


def dim_supplier(star: Star) -> DataFrame:
    return star.supplier


def dim_date(star: Star) -> DataFrame:
    return star.date


# -- enrichment (J1, J2, F15) ----------------------------------------------------
def fact_enriched(star: Star) -> DataFrame:
    """Every fact row with its business ids, date, store and supplier."""
    prod = (star.product.select("product_key", "Product_ID", "store_key", "supplier_key")
            .join(star.store.select("store_key", "storeName"), "store_key")
            .join(star.supplier.select("supplier_key", "supplierName"), "supplier_key"))
    return (star.fact.select("orderID", "customer_key", "product_key", "date_key", "quantity", "total_amount")
            .join(star.customer.select("customer_key", "Customer_ID"), "customer_key")
            .join(prod, "product_key")
            .join(star.date.select("date_key", "full_date"), "date_key")
            .select("orderID", "Customer_ID", "Product_ID", "full_date", "quantity",
                    to_double("total_amount").alias("total_amount"), "storeName", "supplierName"))


def sales_cube_view(star: Star, dims=("customer", "product", "date")) -> DataFrame:
    """Fact rows with the attributes slice / dice / drill work on, joined only
    to the dimensions asked for (Spark cannot drop an unused inner join, so
    a query that needs no customer attribute must not join customers).
    Filters on the view are pushed by Catalyst to the table they come from
    (a year slice reaches the fact's partition column)."""
    cube = star.fact.select("customer_key", "product_key", "date_key", "year", "month", "quantity", "total_amount")
    if "customer" in dims:
        cube = cube.join(star.customer.select("customer_key", "Gender", "Age", "City_Category"), "customer_key")
    if "product" in dims:
        cube = cube.join(star.product.select("product_key", "Product_Category"), "product_key")
    if "date" in dims:
        cube = (cube.join(star.date.select("date_key", "quarter", "full_date", "is_weekend"), "date_key")
                .withColumn("day_type", day_type("is_weekend")))
    return cube


# -- OLAP helpers (P11, G14, G15, G6/G12) ------------------------------------------
def slice_dice_report(star: Star, year: int = 2017, cities=("AMERICA", "ASIA"), gender: str = "F") -> DataFrame:
    cube = olap.slice_dice(sales_cube_view(star, ("customer", "product")),
                           {"year": year, "City_Category": list(cities), "Gender": gender})
    return (cube.groupBy("Product_Category", "City_Category")
            .agg(F.sum("total_amount").alias("_rev"), F.count(F.lit(1)).alias("transaction_count"))
            .select("Product_Category", "City_Category", to_double("_rev").alias("revenue"), "transaction_count"))


def drill_month(star: Star) -> DataFrame:
    out = olap.drill(sales_cube_view(star, ("date",)), "month",
                     [F.sum("total_amount").alias("_rev"), F.sum("quantity").alias("_qty")])
    return out.select("year", "quarter", "month", to_double("_rev").alias("revenue"),
                      F.col("_qty").cast("long").alias("quantity"))


def pivot_quarter(star: Star, year: int = 2017) -> DataFrame:
    cube = sales_cube_view(star, ("product", "date")).filter(F.col("year") == year)
    p = olap.pivot(cube, "Product_Category", "quarter", [1, 2, 3, 4], F.col("total_amount"), prefix="Q")
    return p.select("Product_Category", *[to_double(f"Q{q}").alias(f"Q{q}") for q in (1, 2, 3, 4)])


def product_daily_stats(star: Star) -> DataFrame:
    """Per product over the days it sold: day count, mean, population
    standard deviation of daily sales (aggregate of an aggregate)."""
    daily = (star.fact.select("product_key", "date_key", "total_amount")
             .groupBy("product_key", "date_key").agg(F.sum("total_amount").alias("_d")))
    per = daily.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("days_with_sales"), F.sum("_d").alias("_s"),
        F.stddev_pop(to_double("_d")).alias("_sd"))
    return (per.join(star.product.select("product_key", "Product_ID"), "product_key")
            .select("Product_ID", "days_with_sales", exact_avg("_s", "days_with_sales").alias("avg_daily_sales"),
                    F.round("_sd", 4).alias("stddev_daily_sales")))


EXTRAS = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_store": dim_store,
    "dim_supplier": dim_supplier,
    "dim_date": dim_date,
    "fact_enriched": fact_enriched,
    "slice_dice": slice_dice_report,
    "drill_month": drill_month,
    "pivot_quarter": pivot_quarter,
    "product_daily_stats": product_daily_stats,
}
YEAR_PARAM = {"slice_dice", "pivot_quarter"}
