"""The twenty business reports (and the staged form of the spike report).

Every report is a function ``(star, **params) -> DataFrame`` built with the
DataFrame API. Plan shape, applied throughout:

* a year slice filters the fact's own ``year`` partition column, so the
  scan reads only that year's folders (no join needed to prune);
* facts are aggregated by key first and wide dimension attributes are
  joined afterwards, so the dimension join sees one row per key and group,
  not one per sale; a report grouped above the product level (category,
  store, supplier) joins the narrow product columns first and aggregates by
  those keys, so partial aggregation shrinks the fact before any shuffle;
* the date dimension is broadcast explicitly only where it is filtered to
  a year (at most 366 rows); every other join strategy is left to Catalyst
  and AQE (broadcast under the threshold, shuffle join above it);
* sums stay decimal through ranking and growth, and become double only in
  the final projection; averages are exact decimal sum / count.

``year`` defaults to 2017 as in the original reports; the test data spans
1995-2001, so its checks pass ``year=1997``.
"""

from __future__ import annotations

import threading
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.functions.dates import SEASON_ORDER, day_type, field_position
from starmart.functions.measures import exact_avg, to_double
from starmart.operators import olap
from starmart.session import checkpoint_root
from starmart.sources.warehouse import Star

DEFAULT_YEAR = 2017

# Fixed values that must equal the reference's report output: the spike
# flags and the roll-up total labels.
SPIKE_LABEL = "OUTLIER - High Spike"
NORMAL_LABEL = "Normal"
ALL_STORES = "ALL STORES"
ALL_SUPPLIERS = "ALL SUPPLIERS"
ALL_PRODUCTS = "ALL PRODUCTS"
_STAGED: list[DataFrame] = []
_STAGED_LOCK = threading.Lock()


def _fact(star: Star, *cols: str, year: int | None = None) -> DataFrame:
    f = star.fact
    if year is not None:
        f = f.filter(F.col("year") == year)
    return f.select(*cols)


def _dates(star: Star, year: int | None, *cols: str) -> DataFrame:
    d = star.date
    if year is not None:
        d = d.filter(F.col("year") == year)
        # one year of calendar days: a proven bound, safe to broadcast
        return F.broadcast(d.select("date_key", *cols))
    return d.select("date_key", *cols)


def _quarter(month_col: str = "month"):
    return ((F.col(month_col) - 1) / 3).cast("int") + 1


def _by_product_attrs(f: DataFrame, star: Star, attrs: list[str], group: list, measure: str = "total_amount",
                      out: str = "_rev") -> DataFrame:
    """Sum ``measure`` by product attributes (category, store key, supplier
    key) and ``group``: the narrow product columns are joined to the fact
    first, so partial aggregation reduces the fact to one row per coarse
    group inside each task before anything is shuffled."""
    return (f.join(star.product.select("product_key", *attrs), "product_key")
            .groupBy(*attrs, *group).agg(F.sum(measure).alias(out)))


def _product_names(star: Star) -> DataFrame:
    """Product with its store and supplier names (product-sized)."""
    return (star.product.select("product_key", "Product_ID", "Product_Category", "store_key", "supplier_key")
            .join(star.store.select("store_key", "storeName"), "store_key")
            .join(star.supplier.select("supplier_key", "supplierName"), "supplier_key"))


# Q1 -------------------------------------------------------------------------
def q01_top_products_daytype(star: Star, year: int = DEFAULT_YEAR, n: int = 5) -> DataFrame:
    d = _dates(star, year, "year", "month", "month_name", "is_weekend")
    agg = (_fact(star, "product_key", "date_key", "total_amount", year=year).join(d, "date_key")
           .groupBy("product_key", "year", "month", "month_name", day_type("is_weekend").alias("day_type"))
           .agg(F.sum("total_amount").alias("_rev")))
    j = agg.join(star.product.select("product_key", "Product_ID"), "product_key")
    top = olap.top_n(j, ["day_type", F.desc("_rev"), "Product_ID", "month"], n)
    return top.select("Product_ID", "year", "month_name", "day_type", to_double("_rev").alias("total_revenue"))


# Q2 -------------------------------------------------------------------------
def q02_demographics_city(star: Star) -> DataFrame:
    # One row per customer after the first aggregate, so counting rows of a
    # group counts distinct customers exactly.
    per_cust = _fact(star, "customer_key", "total_amount").groupBy("customer_key").agg(
        F.sum("total_amount").alias("_amt"))
    j = per_cust.join(star.customer.select("customer_key", "Gender", "Age", "City_Category"), "customer_key")
    return (j.groupBy("Gender", "Age", "City_Category")
            .agg(F.sum("_amt").alias("_total"), F.count(F.lit(1)).alias("customer_count"))
            .orderBy(F.desc("_total"), "Gender", "Age", "City_Category")
            .select("Gender", "Age", "City_Category", to_double("_total").alias("total_purchase_amount"),
                    "customer_count"))


# Q3 -------------------------------------------------------------------------
def _by_customer_and_category(star: Star, *measures: str) -> DataFrame:
    """Sums per (customer, product category): the fact meets the product
    dimension first (many products map to one category), and partial
    aggregation reduces it to at most customers x categories rows before the
    customer join, instead of shuffling every sale for both joins."""
    f = _fact(star, "customer_key", "product_key", *measures)
    return (f.join(star.product.select("product_key", "Product_Category"), "product_key")
            .groupBy("customer_key", "Product_Category")
            .agg(*[F.sum(m).alias(f"_{m}") for m in measures]))


def q03_category_by_occupation(star: Star) -> DataFrame:
    per = (_by_customer_and_category(star, "total_amount", "quantity")
           .join(star.customer.select("customer_key", "Occupation"), "customer_key")
           .groupBy("Occupation", "Product_Category")
           .agg(F.sum("_total_amount").alias("_sales"), F.sum("_quantity").alias("total_quantity")))
    return (per.orderBy("Occupation", F.desc("_sales"), "Product_Category")
            .select("Occupation", "Product_Category", to_double("_sales").alias("total_sales"),
                    F.col("total_quantity").cast("long").alias("total_quantity")))


# Q4 -------------------------------------------------------------------------
def q04_gender_age_quarter(star: Star, year: int = DEFAULT_YEAR) -> DataFrame:
    per_cust = (_fact(star, "customer_key", "month", "total_amount", year=year)
                .groupBy("customer_key", _quarter().alias("quarter"))
                .agg(F.sum("total_amount").alias("_amt"), F.count(F.lit(1)).alias("_n")))
    j = per_cust.join(star.customer.select("customer_key", "Gender", "Age"), "customer_key")
    return (j.groupBy("Gender", "Age", "quarter")
            .agg(F.sum("_amt").alias("_total"), F.sum("_n").alias("transaction_count"))
            .orderBy("quarter", "Gender", "Age")
            .select("Gender", "Age", F.col("quarter").cast("int").alias("quarter"),
                    F.lit(year).cast("int").alias("year"),
                    to_double("_total").alias("total_purchases"),
                    F.col("transaction_count").cast("long").alias("transaction_count")))


# Q5 / Q8 ---------------------------------------------------------------------
def _category_by_customer_attr(star: Star, attr: str) -> DataFrame:
    return (_by_customer_and_category(star, "total_amount")
            .join(star.customer.select("customer_key", attr), "customer_key")
            .groupBy("Product_Category", attr).agg(F.sum("_total_amount").alias("_sales")))


def q05_top_occupations(star: Star, n: int = 5) -> DataFrame:
    ranked = olap.top_n_per_group(_category_by_customer_attr(star, "Occupation"), "Product_Category",
                                  F.desc("_sales"), n, rank_col="rank_in_category")
    return (ranked.orderBy("Product_Category", F.desc("_sales"), "Occupation")
            .select("Product_Category", "Occupation", to_double("_sales").alias("total_sales"),
                    "rank_in_category"))


def q08_top_cities(star: Star, n: int = 5) -> DataFrame:
    ranked = olap.top_n_per_group(_category_by_customer_attr(star, "City_Category"), "Product_Category",
                                  F.desc("_sales"), n, rank_col="city_rank")
    return (ranked.orderBy("Product_Category", F.desc("_sales"), "City_Category")
            .select("Product_Category", "City_Category", to_double("_sales").alias("total_revenue"),
                    "city_rank"))


# Q6 -------------------------------------------------------------------------
def q06_city_marital_last6m(star: Star, months: int = 6) -> DataFrame:
    # Dates of the trailing window (bounded by the calendar), then the facts
    # of those dates; year/month in the join key let Spark prune fact
    # partitions dynamically from the small date side.
    d = olap.trailing_months(star.date.select("date_key", "full_date", "year", "month", "month_name"),
                             "full_date", months)
    per = (star.fact.select("customer_key", "date_key", "year", "month", "total_amount")
           .join(d, ["date_key", "year", "month"])
           .groupBy("customer_key", "year", "month", "month_name")
           .agg(F.sum("total_amount").alias("_amt")))
    j = per.join(star.customer.select("customer_key", "City_Category", "Marital_Status"), "customer_key")
    return (j.groupBy("City_Category", "Marital_Status", "year", "month", "month_name")
            .agg(F.sum("_amt").alias("_amt"))
            .orderBy("year", "month", "City_Category", "Marital_Status")
            .select("City_Category", "Marital_Status", "year", "month", "month_name",
                    to_double("_amt").alias("purchase_amount")))


# Q7 -------------------------------------------------------------------------
def q07_avg_by_stay_gender(star: Star) -> DataFrame:
    per_cust = _fact(star, "customer_key", "total_amount").groupBy("customer_key").agg(
        F.sum("total_amount").alias("_amt"), F.count("total_amount").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    j = per_cust.join(star.customer.select("customer_key", "Stay_In_Current_City_Years", "Gender"),
                      "customer_key")
    return (j.groupBy("Stay_In_Current_City_Years", "Gender")
            .agg(F.sum("_amt").alias("_amt"), F.sum("_n").alias("_n"), F.sum("_rows").alias("_rows"))
            .orderBy("Stay_In_Current_City_Years", "Gender")
            .select("Stay_In_Current_City_Years", "Gender",
                    exact_avg("_amt", "_n").alias("avg_purchase_amount"),
                    F.col("_rows").cast("long").alias("transaction_count")))


# Q9 -------------------------------------------------------------------------
def q09_monthly_growth(star: Star, year: int = DEFAULT_YEAR) -> DataFrame:
    monthly = (_by_product_attrs(_fact(star, "product_key", "month", "total_amount", year=year), star,
                                 ["Product_Category"], ["month"])
               .withColumn("year", F.lit(year).cast("int")))
    g = olap.period_growth(monthly, "Product_Category", ["year", "month"], "_rev", "_prev", "growth_percentage")
    return (g.orderBy("Product_Category", "year", "month")
            .select("Product_Category", "year", F.col("month").cast("int").alias("month"),
                    to_double("_rev").alias("monthly_revenue"), to_double("_prev").alias("prev_month_revenue"),
                    "growth_percentage"))


# Q10 ------------------------------------------------------------------------
def q10_weekend_by_age(star: Star, year: int = DEFAULT_YEAR) -> DataFrame:
    d = _dates(star, year, "is_weekend")
    per_cust = (_fact(star, "customer_key", "date_key", "total_amount", year=year).join(d, "date_key")
                .groupBy("customer_key", day_type("is_weekend").alias("day_type"))
                .agg(F.sum("total_amount").alias("_amt"), F.count(F.lit(1)).alias("_n")))
    j = per_cust.join(star.customer.select("customer_key", "Age"), "customer_key")
    return (j.groupBy("Age", "day_type").agg(F.sum("_amt").alias("_amt"), F.sum("_n").alias("_n"))
            .orderBy("Age", "day_type")
            .select("Age", "day_type", to_double("_amt").alias("total_sales"),
                    F.col("_n").cast("long").alias("transaction_count")))


# Q11 ------------------------------------------------------------------------
def q11_top_products_month_daytype(star: Star, year: int = DEFAULT_YEAR, n: int = 5) -> DataFrame:
    d = _dates(star, year, "year", "month", "month_name", "is_weekend")
    agg = (_fact(star, "product_key", "date_key", "total_amount", year=year).join(d, "date_key")
           .groupBy("product_key", "year", "month", "month_name", day_type("is_weekend").alias("day_type"))
           .agg(F.sum("total_amount").alias("_rev")))
    ranked = olap.top_n_per_group(agg, ["year", "month", "day_type"], F.desc("_rev"), n,
                                  rank_col="revenue_rank")
    j = ranked.join(star.product.select("product_key", "Product_ID", "Product_Category"), "product_key")
    return (j.orderBy("month_name", "day_type", "revenue_rank", "Product_ID")
            .select("Product_ID", "Product_Category", "year", "month", "month_name", "day_type",
                    to_double("_rev").alias("total_revenue"), "revenue_rank"))


# Q12 ------------------------------------------------------------------------
def q12_store_quarter_growth(star: Star, year: int = DEFAULT_YEAR) -> DataFrame:
    f = _fact(star, "product_key", "month", "total_amount", year=year).withColumn("quarter", _quarter())
    per = (_by_product_attrs(f, star, ["store_key"], ["quarter"])
           .join(star.store.select("store_key", "storeName"), "store_key")
           .groupBy("storeName", "quarter").agg(F.sum("_rev").alias("_rev")))
    g = olap.period_growth(per, "storeName", "quarter", "_rev", "_prev", "growth_rate_percentage")
    return (g.orderBy("storeName", "quarter")
            .select("storeName", F.col("quarter").cast("int").alias("quarter"),
                    to_double("_rev").alias("quarterly_revenue"), to_double("_prev").alias("prev_quarter_revenue"),
                    "growth_rate_percentage"))


# Q13 ------------------------------------------------------------------------
def q13_supplier_contribution(star: Star) -> DataFrame:
    per = (_fact(star, "product_key", "total_amount", "quantity").groupBy("product_key")
           .agg(F.sum("total_amount").alias("_sales"), F.sum("quantity").alias("_qty"))
           .join(_product_names(star), "product_key")
           .groupBy("storeName", "supplierName", "Product_ID", "Product_Category")
           .agg(F.sum("_sales").alias("_sales"), F.sum("_qty").alias("_qty")))
    return (per.orderBy("storeName", "supplierName", F.desc("_sales"), "Product_ID")
            .select("storeName", "supplierName", "Product_ID", "Product_Category",
                    to_double("_sales").alias("total_sales"), F.col("_qty").cast("long").alias("total_quantity")))


# Q14 ------------------------------------------------------------------------
def q14_seasonal(star: Star) -> DataFrame:
    d = star.date.select("date_key", "season")
    per = (_fact(star, "product_key", "date_key", "year", "total_amount", "quantity").join(d, "date_key")
           .groupBy("product_key", "season", "year")
           .agg(F.sum("total_amount").alias("_sales"), F.sum("quantity").alias("_qty"),
                F.count("total_amount").alias("_n"))
           .join(star.product.select("product_key", "Product_ID", "Product_Category"), "product_key"))
    return (per.orderBy("Product_ID", "year", field_position("season", *SEASON_ORDER))
            .select("Product_ID", "Product_Category", "season", "year",
                    to_double("_sales").alias("total_sales"), F.col("_qty").cast("long").alias("total_quantity"),
                    exact_avg("_sales", "_n").alias("avg_transaction_amount")))


# Q15 ------------------------------------------------------------------------
def q15_volatility(star: Star) -> DataFrame:
    per = (_by_product_attrs(_fact(star, "product_key", "year", "month", "total_amount"), star,
                             ["store_key", "supplier_key"], ["year", "month"])
           .join(star.store.select("store_key", "storeName"), "store_key")
           .join(star.supplier.select("supplier_key", "supplierName"), "supplier_key")
           .groupBy("storeName", "supplierName", "year", "month").agg(F.sum("_rev").alias("_rev")))
    g = olap.period_growth(per, ["storeName", "supplierName"], ["year", "month"], "_rev", "_prev",
                           "volatility_percentage", absolute=True)
    return (g.orderBy("storeName", "supplierName", "year", "month")
            .select("storeName", "supplierName", "year", "month",
                    to_double("_rev").alias("monthly_revenue"), to_double("_prev").alias("prev_month_revenue"),
                    "volatility_percentage"))


# Q16 ------------------------------------------------------------------------
def q16_affinity(star: Star, n: int = 5) -> DataFrame:
    spark: SparkSession = star.fact.sparkSession
    # The pair counts are the heavy step: staged once and read twice.
    staging = f"{checkpoint_root(spark)}/starmart-pairs/{uuid.uuid4().hex[:12]}"
    olap.co_occurrence(_fact(star, "orderID", "product_key"), "orderID", "product_key").write.parquet(staging)
    pairs = spark.read.parquet(staging)
    # Every row of the top n has a count >= the n-th largest count, so only
    # those candidates (all of them, ties included) need names and the
    # business-key tie-break; the cut-off is a scalar subquery over counts.
    cutoff = pairs.select("n").orderBy(F.desc("n")).limit(n).agg(F.min("n")).scalar()
    pairs = pairs.filter(F.col("n") >= cutoff)
    p1 = star.product.select(F.col("product_key").alias("product_key_1"), F.col("Product_ID").alias("_id1"),
                             F.col("Product_Category").alias("_cat1"))
    p2 = star.product.select(F.col("product_key").alias("product_key_2"), F.col("Product_ID").alias("_id2"),
                             F.col("Product_Category").alias("_cat2"))
    named = pairs.join(p1, "product_key_1").join(p2, "product_key_2")
    # orient each pair by business key (surrogate order is load order)
    swap = F.col("_id1") > F.col("_id2")
    out = named.select(
        F.when(swap, F.col("_id2")).otherwise(F.col("_id1")).alias("Product1_ID"),
        F.when(swap, F.col("_cat2")).otherwise(F.col("_cat1")).alias("Product1_Category"),
        F.when(swap, F.col("_id1")).otherwise(F.col("_id2")).alias("Product2_ID"),
        F.when(swap, F.col("_cat1")).otherwise(F.col("_cat2")).alias("Product2_Category"),
        F.col("n").cast("long").alias("times_purchased_together"))
    return olap.top_n(out, [F.desc("times_purchased_together"), "Product1_ID", "Product2_ID"], n)


# Q17 ------------------------------------------------------------------------
def q17_rollup(star: Star) -> DataFrame:
    per = (_fact(star, "product_key", "year", "total_amount").groupBy("year", "product_key")
           .agg(F.sum("total_amount").alias("_rev"))
           .join(_product_names(star).select("product_key", "Product_ID", "storeName", "supplierName"),
                 "product_key"))
    rolled = olap.rollup_additive(
        per, [("year", None), ("storeName", ALL_STORES), ("supplierName", ALL_SUPPLIERS),
              ("Product_ID", ALL_PRODUCTS)],
        {"_rev": F.col("_rev")})
    # sort outside the roll-up (a ROLLUP cannot sort on ungrouped columns)
    return (rolled.orderBy(F.col("year").asc_nulls_last(), "grouping_level", "storeName", "supplierName", "Product_ID")
            .select("storeName", "supplierName", "Product_ID", "year",
                    to_double("_rev").alias("yearly_revenue"), "grouping_level"))


# Q18 ------------------------------------------------------------------------
def q18_half_years(star: Star) -> DataFrame:
    split = olap.conditional_split(
        _fact(star, "product_key", "year", "month", "total_amount", "quantity"),
        ["product_key", "year"], F.col("month") <= 6,
        {"revenue": F.col("total_amount"), "quantity": F.col("quantity")},
        totals={"yearly_revenue": "revenue", "yearly_quantity": "quantity"})
    j = split.join(star.product.select("product_key", "Product_ID", "Product_Category"), "product_key")
    return (j.orderBy("Product_ID", "year")
            .select("Product_ID", "Product_Category", "year",
                    to_double("H1_revenue").alias("H1_revenue"), to_double("H2_revenue").alias("H2_revenue"),
                    F.col("H1_quantity").cast("long").alias("H1_quantity"),
                    F.col("H2_quantity").cast("long").alias("H2_quantity"),
                    to_double("yearly_revenue").alias("yearly_revenue"),
                    F.col("yearly_quantity").cast("long").alias("yearly_quantity")))


# Q19 ------------------------------------------------------------------------
def daily_product_sales(star: Star) -> DataFrame:
    """Sales per product and day (only days with sales), by key."""
    return (_fact(star, "product_key", "date_key", "total_amount")
            .groupBy("product_key", "date_key").agg(F.sum("total_amount").alias("daily_sales")))


def _named_days(days: DataFrame, star: Star) -> DataFrame:
    return (days.join(star.product.select("product_key", "Product_ID", "Product_Category"), "product_key")
            .join(star.date.select("date_key", "full_date"), "date_key"))


def _spike_output(df: DataFrame) -> DataFrame:
    return (df.orderBy(F.desc("sales_ratio"), "Product_ID", "full_date")
            .select("Product_ID", "Product_Category", "full_date",
                    to_double("daily_sales").alias("daily_sales"), "avg_daily_sales", "sales_ratio", "sales_flag"))


def q19_spikes(star: Star, factor: float = 2.0) -> DataFrame:
    """Spikes are found on the narrow (product, day) sums; names join what is left."""
    found = olap.flag_spikes(daily_product_sales(star), "product_key", "daily_sales", factor,
                             spike_label=SPIKE_LABEL, normal_label=NORMAL_LABEL)
    return _spike_output(_named_days(found, star))


def q19b_spikes_staged(star: Star, factor: float = 2.0) -> DataFrame:
    """Same result through two staged tables and SQL: the daily sales are
    materialized once (session cache, spilling to disk), averaged per
    product, and joined back. They are stored by product (a product has one
    row a day at most), so neither the average nor the join shuffles them again."""
    spark: SparkSession = star.fact.sparkSession
    tag = uuid.uuid4().hex[:8]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as a join asks for
    daily = daily_product_sales(star).repartition(parts, "product_key").persist(StorageLevel.MEMORY_AND_DISK)
    with _STAGED_LOCK:  # equal plans share one cache entry: release only stagings of other data
        for old in [x for x in _STAGED if x.sparkSession is spark and not x.sameSemantics(daily)]:
            old.unpersist()
            _STAGED.remove(old)
        if not any(x.sparkSession is spark for x in _STAGED):
            _STAGED.append(daily)
    daily.count()  # built now: a plan on a built cache keeps its partitioning
    daily.createOrReplaceTempView(f"daily_product_sales_{tag}")
    found = spark.sql(f"""
        WITH usual AS (
            SELECT product_key, CAST(SUM(daily_sales) AS DOUBLE) / COUNT(daily_sales) AS avg_daily_sales
            FROM daily_product_sales_{tag} GROUP BY product_key)
        SELECT product_key, date_key, daily_sales, avg_daily_sales, '{SPIKE_LABEL}' AS sales_flag,
               ROUND(CAST(daily_sales AS DOUBLE) / NULLIF(avg_daily_sales, 0), 2) AS sales_ratio
        FROM daily_product_sales_{tag} JOIN usual USING (product_key)
        WHERE daily_sales > {float(factor)} * avg_daily_sales""")
    return _spike_output(_named_days(found, star))


# Q20 ------------------------------------------------------------------------
def store_quarterly_sales(star: Star) -> DataFrame:
    """The STORE_QUARTERLY_SALES view: sales by store name, year, quarter."""
    f = _fact(star, "product_key", "year", "month", "total_amount").withColumn("quarter", _quarter())
    return (_by_product_attrs(f, star, ["store_key"], ["year", "quarter"], out="_s")
            .join(star.store.select("store_key", "storeName"), "store_key")
            .groupBy("storeName", "year", "quarter").agg(F.sum("_s").alias("quarterly_sales"))
            .select("storeName", "year", F.col("quarter").cast("int").alias("quarter"), "quarterly_sales"))


def q20_view_qoq(star: Star, view: DataFrame | None = None) -> DataFrame:
    """Quarter-over-quarter growth read through the view, in SQL."""
    spark: SparkSession = star.fact.sparkSession
    name = f"store_quarterly_sales_{uuid.uuid4().hex[:8]}"
    (view if view is not None else store_quarterly_sales(star)).createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT storeName, year, quarter,
               CAST(quarterly_sales AS DOUBLE) AS quarterly_sales,
               CAST(prev AS DOUBLE) AS prev_quarter_sales,
               ROUND(CAST(quarterly_sales - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0) * 100, 2)
                   AS quarter_over_quarter_growth
        FROM (SELECT *, LAG(quarterly_sales) OVER (PARTITION BY storeName ORDER BY year, quarter) AS prev
              FROM {name})
        ORDER BY storeName, year, quarter""")


REPORTS = {
    "q01_top_products_daytype": q01_top_products_daytype,
    "q02_demographics_city": q02_demographics_city,
    "q03_category_by_occupation": q03_category_by_occupation,
    "q04_gender_age_quarter": q04_gender_age_quarter,
    "q05_top_occupations": q05_top_occupations,
    "q06_city_marital_last6m": q06_city_marital_last6m,
    "q07_avg_by_stay_gender": q07_avg_by_stay_gender,
    "q08_top_cities": q08_top_cities,
    "q09_monthly_growth": q09_monthly_growth,
    "q10_weekend_by_age": q10_weekend_by_age,
    "q11_top_products_month_daytype": q11_top_products_month_daytype,
    "q12_store_quarter_growth": q12_store_quarter_growth,
    "q13_supplier_contribution": q13_supplier_contribution,
    "q14_seasonal": q14_seasonal,
    "q15_volatility": q15_volatility,
    "q16_affinity": q16_affinity,
    "q17_rollup": q17_rollup,
    "q18_half_years": q18_half_years,
    "q19_spikes": q19_spikes,
    "q19b_spikes_staged": q19b_spikes_staged,
    "q20_view_qoq": q20_view_qoq,
}
YEAR_PARAM = {"q01_top_products_daytype", "q04_gender_age_quarter", "q09_monthly_growth",
              "q10_weekend_by_age", "q11_top_products_month_daytype", "q12_store_quarter_growth"}
