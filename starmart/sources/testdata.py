"""Raw retail inputs derived from the TPC-H-like test tables.

The test tables have no stores, genders or age bands, so the raw master
files and the transaction stream are derived from them with plain
arithmetic that any SQL engine can repeat (the oracle SQL does the same):

  customers     customer x nation x region:
                Customer_ID = c_custkey, Occupation = c_nationkey,
                Age = c_mktsegment, City_Category = r_name,
                Gender = F/M by c_custkey parity,
                Stay_In_Current_City_Years = c_custkey mod 5,
                Marital_Status = 1 when c_custkey mod 3 = 0
  products      part: Product_ID = p_partkey, category = p_type,
                price = p_retailprice as decimal(10,2);
                store = nation number (p_partkey mod #nations),
                supplier = supplier number (p_partkey mod #suppliers)
  transactions  lineitem x orders: order, customer, product, whole
                quantity, order date (as text, like a CSV)

All outputs are raw text columns (see ``schemas``), so they run through
the same cleansing as real files. Everything stays lazy: the caller's plan
decides what is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation x region is bounded by the number of nations (25 in TPC-H), so
    # broadcasting it is safe at any scale.
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    k = F.col("c_custkey")
    return (c.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(k.cast("string").alias("Customer_ID"),
                    F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("Gender"),
                    F.col("c_mktsegment").alias("Age"),
                    F.col("c_nationkey").cast("string").alias("Occupation"),
                    F.col("r_name").alias("City_Category"),
                    (k % 5).cast("string").alias("Stay_In_Current_City_Years"),
                    (k % 3 == 0).cast("int").cast("string").alias("Marital_Status")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Scalar subqueries: the counts stay inside the plan (no driver round trip).
    n_nations = nation.select(F.count(F.lit(1))).scalar()
    n_suppliers = supplier.select(F.count(F.lit(1))).scalar()
    k = F.col("p_partkey")
    return (part
            .withColumn("_store", (k % n_nations).cast("int"))
            .withColumn("_supplier", k % n_suppliers)
            .join(F.broadcast(nation), F.col("_store") == F.col("n_nationkey"))
            .join(supplier, F.col("_supplier") == F.col("s_suppkey"))
            .select(k.cast("string").alias("Product_ID"),
                    F.col("p_type").alias("Product_Category"),
                    F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price$"),
                    F.col("n_nationkey").cast("string").alias("storeID"),
                    F.col("n_name").alias("storeName"),
                    F.col("s_suppkey").cast("string").alias("supplierID"),
                    F.col("s_name").alias("supplierName")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; customer and date come from its order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select(  # texts are made once an order, not once a line
        "o_orderkey", F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("date"))
    return (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_orderkey").cast("string").alias("orderID"),
                    "Customer_ID",
                    F.col("l_partkey").cast("string").alias("Product_ID"),
                    F.col("l_quantity").cast("int").cast("string").alias("quantity"),
                    "date"))


#: Remainders by which ``with_faults`` and ``split_masters`` plant their cases.
FAULT_CYCLE, LATE_CUSTOMERS, ABSENT_PRODUCTS = 50, 7, 11


def with_faults(tx: DataFrame) -> DataFrame:
    """Transactions with planted text faults, by order number: no customer, half and no
    quantities, an impossible date; and with forms that are fine: blanks around ids, slashes
    in dates, a time of day, whole numbers with a fraction of zero."""
    n = F.col("orderID").cast("long") % FAULT_CYCLE
    return tx.select(
        F.when(n == 1, F.concat(F.lit(" "), "orderID", F.lit("  "))).otherwise(F.col("orderID")).alias("orderID"),
        F.when(n == 2, F.lit("  ")).when(n == 3, F.concat(F.lit(" "), "Customer_ID")).otherwise(F.col("Customer_ID")).alias("Customer_ID"),
        "Product_ID",
        F.when(n == 4, F.lit("x")).when(n == 5, F.concat("quantity", F.lit(".5"))).when(n == 6, F.concat("quantity", F.lit(".0")))
        .otherwise(F.col("quantity")).alias("quantity"),
        F.when(n == 7, F.lit("2017-13-01")).when(n == 8, F.translate("date", "-", "/")).when(n == 9, F.concat("date", F.lit(" 23:59:59")))
        .otherwise(F.col("date")).alias("date"))


def with_master_faults(products: DataFrame) -> DataFrame:
    """Products with planted faults, by product number: no id, a price that is no number,
    a second row with another price, a blank price."""
    n = F.col("Product_ID").cast("long") % FAULT_CYCLE
    price = F.col("`price$`")
    rows = products.withColumns({
        "Product_ID": F.when(n == 1, F.lit("")).otherwise(F.col("Product_ID")),
        "price$": F.when(n == 2, F.lit("abc")).when(n == 4, F.lit(" ")).otherwise(price)})
    return rows.unionByName(products.filter(n == 3).withColumn("price$", F.lit("1.00")))


def land_transactions(spark: SparkSession, sf_dir: str, landing_dir: str,
                      n_files: int = 4, fmt: str = "csv", faults: bool = False) -> str:
    """Write the transactions as ``n_files`` files into a landing folder, the
    way an upstream system drops them, for the streaming loader to pick up.
    Rows are spread by order so one order's lines land in one file."""
    tx = transactions(spark, sf_dir).repartition(n_files, "orderID")
    tx = with_faults(tx) if faults else tx
    w = tx.write.mode("overwrite")
    if fmt == "csv":
        # blanks around values stay, as upstream wrote them
        w.option("header", True).options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(landing_dir)
    else:
        w.format(fmt).save(landing_dir)
    return landing_dir
