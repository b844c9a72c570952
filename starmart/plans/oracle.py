"""Independent SQL (DuckDB dialect) for each registered query.

The oracle does not share code with the Spark side. It builds the star
schema from the raw test tables with the same mapping (``sources/testdata``)
as views keyed by business id, then states each report the way the
original report SQL does: joins on the detail rows, aggregate, window,
order. Surrogate keys appear only where a dimension is checked as loaded
(``row_number`` over the business key: keys are dense in business-key
order on a first load).

Numeric conventions shared with the Spark side (so values hash equal):
sums are decimal and cast to DOUBLE at output; averages are
``CAST(SUM(x) AS DOUBLE) / COUNT(*)``; division guards its divisor with
NULLIF; integer sums are BIGINT; year / month / quarter / rank are INTEGER.
"""

from __future__ import annotations

TEST_YEAR = 1997

PRELUDE = """
WITH
dim_customer AS (
    SELECT CAST(c.c_custkey AS VARCHAR) AS Customer_ID,
           CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS Gender,
           c.c_mktsegment AS Age,
           CAST(c.c_nationkey AS INTEGER) AS Occupation,
           r.r_name AS City_Category,
           CAST(c.c_custkey % 5 AS VARCHAR) AS Stay_In_Current_City_Years,
           CASE WHEN c.c_custkey % 3 = 0 THEN 1 ELSE 0 END AS Marital_Status
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_product AS (
    SELECT CAST(p_partkey AS VARCHAR) AS Product_ID,
           p_type AS Product_Category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price,
           CAST(p_partkey % (SELECT COUNT(*) FROM nation) AS VARCHAR) AS storeID,
           CAST(p_partkey % (SELECT COUNT(*) FROM supplier) AS VARCHAR) AS supplierID
    FROM part
),
dim_store AS (
    SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS storeID, n_name AS storeName
    FROM nation WHERE CAST(n_nationkey AS VARCHAR) IN (SELECT storeID FROM dim_product)
),
dim_supplier AS (
    SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS supplierID, s_name AS supplierName
    FROM supplier WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT supplierID FROM dim_product)
),
fact_sales AS (
    SELECT CAST(l.l_orderkey AS VARCHAR) AS orderID,
           CAST(o.o_custkey AS VARCHAR) AS Customer_ID,
           CAST(l.l_partkey AS VARCHAR) AS Product_ID,
           CAST(o.o_orderdate AS DATE) AS full_date,
           CAST(l.l_quantity AS INTEGER) AS quantity,
           CAST(CAST(l.l_quantity AS INTEGER) * CAST(p.p_retailprice AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS total_amount
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
),
dim_date AS (
    SELECT full_date,
           CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
           dayname(full_date) AS day_of_week,
           CAST(day(full_date) AS INTEGER) AS day_of_month,
           CAST(month(full_date) AS INTEGER) AS month,
           monthname(full_date) AS month_name,
           CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(year(full_date) AS INTEGER) AS year,
           isodow(full_date) >= 6 AS is_weekend,
           CASE WHEN month(full_date) IN (3, 4, 5) THEN 'Spring'
                WHEN month(full_date) IN (6, 7, 8) THEN 'Summer'
                WHEN month(full_date) IN (9, 10, 11) THEN 'Fall'
                ELSE 'Winter' END AS season
    FROM (SELECT DISTINCT full_date FROM fact_sales)
)
"""

Y = TEST_YEAR

QUERIES: dict[str, str] = {}

#: Every sale, with the attributes of all its dimensions: what the reports are stated on.
SALE = """
, sale AS (
    SELECT *, total_amount AS amount, IF(is_weekend, 'Weekend', 'Weekday') AS day_type
    FROM fact_sales JOIN dim_product USING (Product_ID) JOIN dim_customer USING (Customer_ID) JOIN dim_store USING (storeID)
    JOIN dim_supplier USING (supplierID) JOIN dim_date USING (full_date)
)"""

#: What a report measures on a group of sales.
REVENUE, UNITS, ROWS = "CAST(SUM(amount) AS DOUBLE)", "CAST(SUM(quantity) AS BIGINT)", "COUNT(*)"
MEAN = f"{REVENUE} / COUNT(*)"


def _by(keys: str, where: str = "TRUE", **measures: str) -> str:
    """Measures of the sales for each combination of the keys."""
    return SALE + f"""
SELECT {keys}, {", ".join(f"{m} AS {name}" for name, m in measures.items())} FROM sale WHERE {where} GROUP BY ALL"""


def _best(attr: str, measure: str, rank: str, most: int = 5) -> str:
    """Per category the values of ``attr`` with fewer than ``most`` others above them."""
    return SALE + f"""
, totals AS (SELECT Product_Category, {attr}, SUM(amount) AS t FROM sale GROUP BY ALL)
, placed AS (
    SELECT a.Product_Category, a.{attr}, a.t, COUNT(b.t) AS above
    FROM totals a LEFT JOIN totals b ON b.Product_Category = a.Product_Category AND b.t > a.t GROUP BY ALL
)
SELECT Product_Category, {attr}, CAST(t AS DOUBLE) AS {measure}, CAST(above + 1 AS INTEGER) AS {rank} FROM placed WHERE above < {most}"""


def _change(keys: str, period: str, value: str, before: str, change: str, where: str = "TRUE", absolute: bool = False) -> str:
    """Each group's total per period, the total of the period before it (joined by the
    period's place among the group's own periods), and the change in percent."""
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    step = "(a.t - b.t) / NULLIF(b.t, 0)"
    return SALE + f"""
, placed AS (
    SELECT {keys}, {period}, SUM(amount) AS t, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {period}) AS place
    FROM sale WHERE {where} GROUP BY {keys}, {period}
)
SELECT {", ".join("a." + c for c in f"{keys}, {period}".split(", "))}, CAST(a.t AS DOUBLE) AS {value}, CAST(b.t AS DOUBLE) AS {before},
       ROUND({f"ABS({step})" if absolute else step} * 100, 2) AS {change}
FROM placed a LEFT JOIN placed b ON {same} AND b.place = a.place - 1"""


QUERIES["q01_top_products_daytype"] = SALE + f"""
, totals AS (SELECT Product_ID, year, month, month_name, day_type, SUM(amount) AS t FROM sale WHERE year = {Y} GROUP BY ALL)
SELECT Product_ID, year, month_name, day_type, CAST(t AS DOUBLE) AS total_revenue
FROM totals ORDER BY day_type, t DESC, Product_ID, month LIMIT 5"""

QUERIES["q02_demographics_city"] = _by(
    "Gender, Age, City_Category", total_purchase_amount=REVENUE, customer_count="COUNT(DISTINCT Customer_ID)")

QUERIES["q03_category_by_occupation"] = _by("Occupation, Product_Category", total_sales=REVENUE, total_quantity=UNITS)

QUERIES["q04_gender_age_quarter"] = _by(
    "Gender, Age, quarter, year", f"year = {Y}", total_purchases=REVENUE, transaction_count=ROWS)

QUERIES["q05_top_occupations"] = _best("Occupation", "total_sales", "rank_in_category")

QUERIES["q06_city_marital_last6m"] = _by(
    "City_Category, Marital_Status, year, month, month_name",
    "full_date >= (SELECT CAST(MAX(full_date) - INTERVAL 6 MONTH AS DATE) FROM fact_sales)", purchase_amount=REVENUE)

QUERIES["q07_avg_by_stay_gender"] = _by(
    "Stay_In_Current_City_Years, Gender", avg_purchase_amount=MEAN, transaction_count=ROWS)

QUERIES["q08_top_cities"] = _best("City_Category", "total_revenue", "city_rank")

QUERIES["q09_monthly_growth"] = _change(
    "Product_Category", "year, month", "monthly_revenue", "prev_month_revenue", "growth_percentage", f"year = {Y}")

QUERIES["q10_weekend_by_age"] = _by("Age, day_type", f"year = {Y}", total_sales=REVENUE, transaction_count=ROWS)

QUERIES["q11_top_products_month_daytype"] = SALE + f"""
, totals AS (
    SELECT Product_ID, Product_Category, year, month, month_name, is_weekend, SUM(amount) AS t
    FROM sale WHERE year = {Y} GROUP BY ALL
)
SELECT Product_ID, Product_Category, year, month, month_name, IF(is_weekend, 'Weekend', 'Weekday') AS day_type,
       CAST(t AS DOUBLE) AS total_revenue,
       CAST(1 + (SELECT COUNT(*) FROM totals o WHERE o.month = totals.month AND o.is_weekend = totals.is_weekend AND o.t > totals.t) AS INTEGER)
           AS revenue_rank
FROM totals
QUALIFY RANK() OVER (PARTITION BY month, is_weekend ORDER BY t DESC) <= 5"""

QUERIES["q12_store_quarter_growth"] = _change(
    "storeName", "quarter", "quarterly_revenue", "prev_quarter_revenue", "growth_rate_percentage", f"year = {Y}")

QUERIES["q13_supplier_contribution"] = _by(
    "storeName, supplierName, Product_ID, Product_Category", total_sales=REVENUE, total_quantity=UNITS)

QUERIES["q14_seasonal"] = _by(
    "Product_ID, Product_Category, season, year", total_sales=REVENUE, total_quantity=UNITS, avg_transaction_amount=MEAN)

QUERIES["q15_volatility"] = _change(
    "storeName, supplierName", "year, month", "monthly_revenue", "prev_month_revenue", "volatility_percentage", absolute=True)

QUERIES["q16_affinity"] = """
, line AS (SELECT orderID, Product_ID, COUNT(*) AS n FROM fact_sales GROUP BY orderID, Product_ID),
  met AS (
    SELECT x.Product_ID AS low, y.Product_ID AS high, SUM(x.n * y.n) AS times
    FROM line x JOIN line y USING (orderID) WHERE x.Product_ID < y.Product_ID GROUP BY ALL
    ORDER BY times DESC, low, high LIMIT 5
)
SELECT low AS Product1_ID, (SELECT Product_Category FROM dim_product WHERE Product_ID = low) AS Product1_Category,
       high AS Product2_ID, (SELECT Product_Category FROM dim_product WHERE Product_ID = high) AS Product2_Category,
       CAST(times AS BIGINT) AS times_purchased_together
FROM met"""

_LEVELS = [("year", None), ("storeName", "ALL STORES"), ("supplierName", "ALL SUPPLIERS"), ("Product_ID", "ALL PRODUCTS")]


def _subtotals() -> str:
    """One grouped select for each number of levels kept; a level left out shows its label."""
    parts = []
    for kept in range(len(_LEVELS) + 1):
        shown = [f"CAST({c} AS {'INTEGER' if label is None else 'VARCHAR'}) AS {c}" if i < kept else
                 f"CAST({'NULL' if label is None else repr(label)} AS {'INTEGER' if label is None else 'VARCHAR'}) AS {c}"
                 for i, (c, label) in enumerate(_LEVELS)]
        level = 2 ** (len(_LEVELS) - kept) - 1
        parts.append(f"SELECT {', '.join(shown)}, {REVENUE} AS yearly_revenue, CAST({level} AS INTEGER) AS grouping_level FROM sale GROUP BY "
                     + (", ".join(f"sale.{c}" for c, _ in _LEVELS[:kept]) or "()"))
    return SALE + "\n" + "\nUNION ALL\n".join(parts)


QUERIES["q17_rollup"] = _subtotals()

_HALF = {"H1": "month BETWEEN 1 AND 6", "H2": "month BETWEEN 7 AND 12"}
QUERIES["q18_half_years"] = _by(
    "Product_ID, Product_Category, year",
    **{f"{h}_revenue": f"CAST(COALESCE(SUM(amount) FILTER ({when}), 0) AS DOUBLE)" for h, when in _HALF.items()},
    **{f"{h}_quantity": f"CAST(COALESCE(SUM(quantity) FILTER ({when}), 0) AS BIGINT)" for h, when in _HALF.items()},
    yearly_revenue=REVENUE, yearly_quantity=UNITS)

_SPIKES = SALE + """
, per_day AS (
    SELECT Product_ID, Product_Category, full_date, SUM(amount) AS t, SUM(SUM(amount)) OVER mine AS whole, COUNT(*) OVER mine AS days
    FROM sale GROUP BY Product_ID, Product_Category, full_date
    WINDOW mine AS (PARTITION BY Product_ID)
)
SELECT Product_ID, Product_Category, full_date, CAST(t AS DOUBLE) AS daily_sales,
       CAST(whole AS DOUBLE) / days AS avg_daily_sales,
       ROUND(CAST(t AS DOUBLE) / NULLIF(CAST(whole AS DOUBLE) / days, 0), 2) AS sales_ratio,
       'OUTLIER - High Spike' AS sales_flag
FROM per_day WHERE t > 2 * (CAST(whole AS DOUBLE) / days)"""
QUERIES["q19_spikes"] = _SPIKES
QUERIES["q19b_spikes_staged"] = _SPIKES

QUERIES["q20_view_qoq"] = _change(
    "storeName", "year, quarter", "quarterly_sales", "prev_quarter_sales", "quarter_over_quarter_growth")

QUERIES["rollup_quarterly_materialized"] = _by("storeName, year, quarter", quarterly_sales=REVENUE)

QUERIES["diag_date_span"] = """
SELECT MIN(full_date) AS min_date, MAX(full_date) AS max_date FROM dim_date"""

QUERIES["diag_multi_product_orders"] = """
SELECT orderID, COUNT(DISTINCT Product_ID) AS product_count
FROM fact_sales
GROUP BY orderID
HAVING COUNT(DISTINCT Product_ID) > 1
ORDER BY orderID
LIMIT 10"""

QUERIES["diag_row_counts"] = """
SELECT 'fact_sales' AS table_name, COUNT(*) AS row_count FROM fact_sales
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'dim_store', COUNT(*) FROM dim_store
UNION ALL SELECT 'dim_supplier', COUNT(*) FROM dim_supplier
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date"""

QUERIES["diag_enriched_sample"] = SALE + """
SELECT orderID, Customer_ID, Gender, Product_ID, Product_Category, quantity, CAST(amount AS DOUBLE) AS total_amount
FROM sale ORDER BY orderID, Product_ID, quantity, amount LIMIT 10"""

# -- dimensions as loaded: keys dense in business-key order -----------------------
QUERIES["dim_customer"] = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY Customer_ID) AS BIGINT) AS customer_key, *
FROM dim_customer"""

QUERIES["dim_store"] = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY storeID) AS BIGINT) AS store_key, storeID, storeName
FROM dim_store"""

QUERIES["dim_supplier"] = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY supplierID) AS BIGINT) AS supplier_key, supplierID, supplierName
FROM dim_supplier"""

QUERIES["dim_product"] = """
, ks AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY storeID) AS BIGINT) AS store_key, storeID FROM dim_store),
  ksup AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY supplierID) AS BIGINT) AS supplier_key, supplierID
           FROM dim_supplier)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY dp.Product_ID) AS BIGINT) AS product_key,
       dp.Product_ID, dp.Product_Category, CAST(dp.price AS DOUBLE) AS price, ks.store_key, ksup.supplier_key
FROM dim_product dp
JOIN ks ON dp.storeID = ks.storeID
JOIN ksup ON dp.supplierID = ksup.supplierID"""

QUERIES["dim_date"] = """
SELECT date_key, full_date, day_of_week, day_of_month, month, month_name, quarter, year, is_weekend, season
FROM dim_date"""

QUERIES["fact_enriched"] = SALE + """
SELECT orderID, Customer_ID, Product_ID, full_date, quantity, CAST(amount AS DOUBLE) AS total_amount, storeName, supplierName FROM sale"""
QUERIES["stream_enriched"] = QUERIES["fact_enriched"]

QUERIES["slice_dice"] = _by(
    "Product_Category, City_Category", f"year = {Y} AND City_Category IN ('AMERICA', 'ASIA') AND Gender = 'F'",
    revenue=REVENUE, transaction_count=ROWS)

QUERIES["drill_month"] = _by("year, quarter, month", revenue=REVENUE, quantity=UNITS)

QUERIES["pivot_quarter"] = _by("Product_Category", f"year = {Y}", **{
    f"Q{q}": f"CAST(SUM(amount) FILTER (quarter = {q}) AS DOUBLE)" for q in (1, 2, 3, 4)})

QUERIES["product_daily_stats"] = f"""
, daily AS (
    SELECT fs.Product_ID, fs.full_date, SUM(fs.total_amount) AS d
    FROM fact_sales fs GROUP BY fs.Product_ID, fs.full_date
)
SELECT Product_ID, COUNT(*) AS days_with_sales,
       CAST(SUM(d) AS DOUBLE) / COUNT(*) AS avg_daily_sales,
       ROUND(STDDEV_POP(CAST(d AS DOUBLE)), 4) AS stddev_daily_sales
FROM daily GROUP BY Product_ID"""


QUERIES["events_by_city_stream"] = """
SELECT e.event_type, dc.City_Category, COUNT(*) AS n_events, COUNT(DISTINCT e.user_id) AS n_users,
       CAST(SUM(CAST(e.value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events e
JOIN dim_customer dc ON CAST(e.user_id AS VARCHAR) = dc.Customer_ID
GROUP BY e.event_type, dc.City_Category"""


QUERIES["load_accounting"] = """
SELECT COUNT(*) AS read_rows, COUNT(*) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

QUERIES["dim_customer_reloaded"] = QUERIES["dim_customer"]


QUERIES["facts_after_replay"] = """
SELECT CAST(year(full_date) AS INTEGER) AS year, COUNT(*) AS n_rows, CAST(SUM(quantity) AS BIGINT) AS quantity,
       CAST(SUM(total_amount) AS DOUBLE) AS total_amount
FROM fact_sales GROUP BY 1"""

# transactions with planted text faults, by order number modulo 50 (see sources/testdata)
_FAULTY = """
, t AS (
    SELECT l.l_orderkey % 50 AS n, CAST(l.l_orderkey AS VARCHAR) AS o, CAST(o.o_custkey AS VARCHAR) AS c, l.l_partkey AS p,
           o.o_custkey, CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS q, strftime(o.o_orderdate, '%Y-%m-%d') AS d
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

QUERIES["stream_rejects"] = _FAULTY + """
SELECT CASE n WHEN 1 THEN ' ' || o || '  ' ELSE o END AS orderID,
       CASE n WHEN 2 THEN '  ' WHEN 3 THEN ' ' || c ELSE c END AS Customer_ID, CAST(p AS VARCHAR) AS Product_ID,
       CASE n WHEN 4 THEN 'x' WHEN 5 THEN q || '.5' WHEN 6 THEN q || '.0' ELSE q END AS quantity,
       CASE n WHEN 7 THEN '2017-13-01' WHEN 8 THEN replace(d, '-', '/') WHEN 9 THEN d || ' 23:59:59' ELSE d END AS date,
       CASE WHEN n = 2 THEN 'missing_customer_id' WHEN n IN (4, 5) THEN 'bad_quantity' WHEN n = 7 THEN 'bad_date'
            WHEN o_custkey % 7 = 3 THEN 'unknown_customer' ELSE 'unknown_product' END AS reject_reason
FROM t WHERE n IN (2, 4, 5, 7) OR p % 11 = 5"""

QUERIES["facts_after_retry"] = f"""
SELECT fs.orderID, fs.Customer_ID, fs.Product_ID, fs.full_date, fs.quantity,
       CAST(fs.total_amount AS DOUBLE) AS total_amount, ds.storeName, dsup.supplierName
FROM fact_sales fs, dim_product dp, dim_store ds, dim_supplier dsup
WHERE dp.Product_ID = fs.Product_ID AND ds.storeID = dp.storeID AND dsup.supplierID = dp.supplierID
  AND CAST(fs.orderID AS BIGINT) % 50 NOT IN (2, 4, 5, 7) AND CAST(fs.Product_ID AS BIGINT) % 11 <> 5"""

QUERIES["master_rejects"] = """
SELECT 'dim_product' AS table_name,
       CASE p_partkey % 50 WHEN 1 THEN 'missing_product_id' WHEN 2 THEN 'bad_price' ELSE 'duplicate_key' END AS reject_reason,
       COUNT(*) AS n_rows, COUNT(CASE WHEN p_partkey % 50 <> 1 THEN 1 END) AS n_keys
FROM part WHERE p_partkey % 50 IN (1, 2, 3) GROUP BY 2"""

QUERIES["products_after_faults"] = """
SELECT Product_ID, Product_Category, CAST(Product_ID AS BIGINT) % 50 <> 4 AS has_price
FROM dim_product WHERE CAST(Product_ID AS BIGINT) % 50 NOT IN (1, 2)"""

QUERIES["rollup_refreshed"] = QUERIES["rollup_quarterly_materialized"]


def sql(name: str) -> str:
    body = QUERIES[name]
    stripped = body.lstrip()
    if stripped.startswith(","):
        return PRELUDE.rstrip() + stripped + "\n"
    return PRELUDE + body + "\n"


def all_sql() -> dict[str, str]:
    return {k: sql(k) for k in QUERIES}
