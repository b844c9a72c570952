"""Cross-report invariants on the warehouse loaded from the smallest tables."""

import re

import pytest
from pyspark.sql import functions as F

from starmart.plans import build, extras, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return build.warehouse_for(spark, SF).star()


def _total(star):
    return star.fact.agg(F.sum("total_amount")).first()[0]


def test_rollup_grand_total_equals_plain_sum(star):
    r = reports.q17_rollup(star)
    grand = r.filter(F.col("grouping_level") == 15).collect()
    assert len(grand) == 1 and grand[0].storeName == "ALL STORES" and grand[0].year is None
    assert round(grand[0].yearly_revenue, 2) == float(_total(star))
    # every year subtotal equals the sum of its store subtotals
    years = {r.year: r.yearly_revenue for r in r.filter("grouping_level = 7").collect()}
    stores = r.filter("grouping_level = 3").groupBy("year").agg(F.sum("yearly_revenue").alias("s")).collect()
    assert {s.year: round(s.s, 2) for s in stores} == {y: round(v, 2) for y, v in years.items()}


def test_half_years_add_up(star):
    rows = reports.q18_half_years(star).collect()
    assert rows and all(abs(r.H1_revenue + r.H2_revenue - r.yearly_revenue) < 1e-6 for r in rows)
    assert all(r.H1_quantity + r.H2_quantity == r.yearly_quantity for r in rows)


def test_per_group_ranks_start_at_one(star):
    for df, part, rank, n in ((reports.q05_top_occupations(star), "Product_Category", "rank_in_category", 5),
                              (reports.q08_top_cities(star, n=2), "Product_Category", "city_rank", 2)):
        firsts = df.groupBy(part).agg(F.min(rank).alias("m"), F.max(rank).alias("x")).collect()
        assert firsts and all(r.m == 1 and r.x <= n for r in firsts)


def test_view_and_reports_total_equal_fact_total(star):
    total = float(_total(star))
    view = reports.store_quarterly_sales(star).agg(F.sum("quarterly_sales")).first()[0]
    assert float(view) == total
    assert round(reports.q13_supplier_contribution(star).agg(F.sum("total_sales")).first()[0], 2) == total
    assert round(extras.drill_month(star).agg(F.sum("revenue")).first()[0], 2) == total
    seasonal = reports.q14_seasonal(star).agg(F.sum("total_sales")).first()[0]
    assert round(seasonal, 2) == total


def test_staged_and_window_spikes_agree(star):
    a = sorted(tuple(r) for r in reports.q19_spikes(star).collect())
    b = sorted(tuple(r) for r in reports.q19b_spikes_staged(star).collect())
    assert a == b and all(r[-1] == "OUTLIER - High Spike" for r in a)


def test_growth_first_period_is_null(star):
    g = reports.q12_store_quarter_growth(star, year=1997)
    first = g.groupBy("storeName").agg(F.min("quarter").alias("q"))
    rows = g.join(first, ["storeName"]).filter(F.col("quarter") == F.col("q")).collect()
    assert rows and all(r.prev_quarter_revenue is None and r.growth_rate_percentage is None for r in rows)


def test_staged_spikes_shuffle_the_daily_sales_once(spark, star):
    """Stored by product, they are neither shuffled for the average nor for the join; the product table is."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reports.q19b_spikes_staged(star)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"hashpartitioning\(product_key#\d+L?, \d+\), ENSURE_REQUIREMENTS", plan)) <= 1
