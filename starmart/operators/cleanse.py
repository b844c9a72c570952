"""Cleansing, constraint checks and reject routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.cleanse import clean_id, parse_date, parse_decimal, parse_int

# Fixed reject reasons, in the order the rules are checked (first failing wins).
MISSING_ORDER_ID = "missing_order_id"
MISSING_CUSTOMER_ID = "missing_customer_id"
MISSING_PRODUCT_ID = "missing_product_id"
ID_TOO_LONG = "id_too_long"
BAD_QUANTITY = "bad_quantity"
BAD_DATE = "bad_date"
UNKNOWN_CUSTOMER = "unknown_customer"
UNKNOWN_PRODUCT = "unknown_product"
MISSING_PRICE = "missing_price"
AMOUNT_OVERFLOW = "amount_overflow"
LATE_MASTER = "late_master"  # in a replayed batch: a retry loaded the row after the first run
# Master rows:
MALFORMED = "malformed_row"
BAD_OCCUPATION = "bad_occupation"
BAD_MARITAL_STATUS = "bad_marital_status"
BAD_PRICE = "bad_price"
DUPLICATE_KEY = "duplicate_key"
RETRYABLE = (UNKNOWN_CUSTOMER, UNKNOWN_PRODUCT, LATE_MASTER)

# Fixed values that CSV readers take for a missing one.
MISSING_MARKS = ("", "#n/a", "n/a", "na", "nan", "none", "null")

ID_MAX_LEN = 50  # VARCHAR(50) of the business ids


def first_reason(rules: list[tuple[Column, str]]) -> Column:
    """The reason of the first rule whose condition holds, else null."""
    expr = None
    for cond, reason in rules:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def cleanse_transactions(raw: DataFrame) -> DataFrame:
    """Typed transaction rows plus ``pre_reason``: the first failing rule that
    needs no lookup. Raw text columns are kept for the reject table; other
    columns (such as a row id) pass through."""
    raw_cols = ("orderID", "Customer_ID", "Product_ID", "quantity", "date")
    t = raw.select(
        *[F.col(c) for c in raw.columns if c not in raw_cols],
        *[F.col(c).alias(f"raw_{c}") for c in raw_cols],
        clean_id("orderID").alias("orderID"),
        clean_id("Customer_ID").alias("Customer_ID"),
        clean_id("Product_ID").alias("Product_ID"),
        parse_int("quantity").alias("quantity"),
        parse_date("date").alias("sale_date"),
    )
    too_long = reduce(lambda a, b: a | b, [F.length(c) > ID_MAX_LEN for c in ("orderID", "Customer_ID", "Product_ID")])
    return t.withColumn("pre_reason", first_reason([
        (F.col("orderID").isNull(), MISSING_ORDER_ID),
        (F.col("Customer_ID").isNull(), MISSING_CUSTOMER_ID),
        (F.col("Product_ID").isNull(), MISSING_PRODUCT_ID),
        (too_long, ID_TOO_LONG),
        (F.col("quantity").isNull(), BAD_QUANTITY),
        (F.col("sale_date").isNull(), BAD_DATE),
    ]))


#: What a cleansed transaction says again of each raw text.
_SAME_TEXT = {"orderID": F.col, "Customer_ID": F.col, "Product_ID": F.col, "quantity": lambda c: F.col(c).cast("string"),
              "date": lambda c: F.col("sale_date").cast("string")}


def pack_raw(cleansed: DataFrame) -> DataFrame:
    """Cleansed transactions with one column ``raw`` for their raw texts, null where the typed
    columns give the same texts: what is shuffled and staged holds no second copy."""
    same = reduce(lambda a, b: a & b, [F.col(f"raw_{c}") == text(c) for c, text in _SAME_TEXT.items()])
    texts = F.struct(*[F.col(f"raw_{c}").cast("string").alias(c) for c in _SAME_TEXT])
    return cleansed.withColumn("raw", F.when(~F.coalesce(same, F.lit(False)), texts)).drop(*[f"raw_{c}" for c in _SAME_TEXT])


def raw_texts() -> dict[str, Column]:
    """The raw texts of packed rows, by column."""
    return {c: F.when(F.col("raw").isNull(), text(c)).otherwise(F.col(f"raw.{c}")) for c, text in _SAME_TEXT.items()}


def unpack_raw(packed: DataFrame) -> DataFrame:
    return packed.withColumns({f"raw_{c}": text for c, text in raw_texts().items()}).drop("raw")


def _load_order(raw: DataFrame):
    """Orders master rows as they stand in their files, taken by name; rows that come
    from no file stand in partition order."""
    place = [F.col("_file")] if "_file" in raw.columns else []
    return F.struct(*place, F.monotonically_increasing_id().alias("row"))


def _given(c: str) -> Column:
    """Whether a raw value is there at all (not blank, no mark for a missing one)."""
    t = F.lower(F.trim(F.col(c)))
    return t.isNotNull() & ~t.isin(*MISSING_MARKS)


def _judged(raw: DataFrame, typed: list[Column], rules: list[tuple[Column, str]]) -> DataFrame:
    """Typed master rows with a load order, ``pre_reason`` (null: may be stored) and ``raw``,
    the row as read."""
    names = [c for c in raw.columns if not c.startswith("_")]
    line = F.col("_corrupt_record") if "_corrupt_record" in raw.columns else F.lit(None).cast("string")
    out = raw.select(*[F.col(c).alias(f"raw_{c}") for c in names], *typed, line.alias("_line"), _load_order(raw).alias("_load_order"))
    return (out.withColumn("pre_reason", first_reason([(F.col("_line").isNotNull(), MALFORMED), *rules]))
            .withColumn("raw", F.coalesce("_line", F.to_json(F.struct(*[F.col(f"raw_{c}").alias(c) for c in names]))))
            .drop("_line", *[f"raw_{c}" for c in names]))


def judge_customers(raw: DataFrame) -> DataFrame:
    """Customer master rows, each with the reason that keeps it out of the dimension."""
    return _judged(raw, [
        clean_id("Customer_ID").alias("Customer_ID"),
        F.trim("Gender").alias("Gender"),
        F.trim("Age").alias("Age"),
        parse_int("Occupation").alias("Occupation"),
        F.trim("City_Category").alias("City_Category"),
        F.trim("Stay_In_Current_City_Years").alias("Stay_In_Current_City_Years"),
        parse_int("Marital_Status").alias("Marital_Status"),
    ], [
        (F.col("Customer_ID").isNull(), MISSING_CUSTOMER_ID),
        (F.length("Customer_ID") > ID_MAX_LEN, ID_TOO_LONG),
        (_given("raw_Occupation") & F.col("Occupation").isNull(), BAD_OCCUPATION),
        (_given("raw_Marital_Status") & F.col("Marital_Status").isNull(), BAD_MARITAL_STATUS),
    ])


def judge_products(raw: DataFrame) -> DataFrame:
    """Product master rows (``price$`` renamed ``price``), each with the reason that keeps it
    out of the dimension. A product without a price is stored; its sales are rejected."""
    return _judged(raw, [
        clean_id("Product_ID").alias("Product_ID"),
        F.trim("Product_Category").alias("Product_Category"),
        parse_decimal("price$").alias("price"),
        clean_id("storeID").alias("storeID"),
        F.trim("storeName").alias("storeName"),
        clean_id("supplierID").alias("supplierID"),
        F.trim("supplierName").alias("supplierName"),
    ], [
        (F.col("Product_ID").isNull(), MISSING_PRODUCT_ID),
        (F.greatest(*[F.coalesce(F.length(c), F.lit(0)) for c in ("Product_ID", "storeID", "supplierID")]) > ID_MAX_LEN, ID_TOO_LONG),
        (_given("raw_price$") & F.col("price").isNull(), BAD_PRICE),
    ])


def storable(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("pre_reason").isNull()).drop("pre_reason", "raw")


def cleanse_customers(raw: DataFrame) -> DataFrame:
    """Typed customer master rows with a load order, without those that may not be stored."""
    return storable(judge_customers(raw))


def cleanse_products(raw: DataFrame) -> DataFrame:
    """Typed product master rows with a load order, without those that may not be stored."""
    return storable(judge_products(raw))


def later_rows(judged: DataFrame, key: str) -> DataFrame:
    """Storable rows of a key that an earlier row of the same load has (C4). Only the keys
    that occur more than once are joined back."""
    good = judged.filter(F.col("pre_reason").isNull())
    first = (good.groupBy(key).agg(F.min("_load_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1).select(key, "_first"))
    return good.join(first, key).filter(F.col("_load_order") != F.col("_first")).drop("_first")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Business keys that occur more than once (C4), with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
