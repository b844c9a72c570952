"""Generic OLAP operators on hand-made frames."""

import datetime as dt
import itertools
import re
from collections import Counter

from pyspark.sql import functions as F

from starmart.operators import olap


def test_top_n_per_group_keeps_ties(spark):
    # Tied sums at rank 5 keep both rows (RANK semantics)
    rows = [("a", f"x{i}", v) for i, v in enumerate([90, 80, 70, 60, 50, 50, 40])] + [("b", "y0", 1)]
    df = spark.createDataFrame(rows, "g string, k string, v int")
    out = olap.top_n_per_group(df, "g", F.desc("v"), 5)
    got = sorted((r.g, r.k, r["rank"]) for r in out.collect())
    assert [r for r in got if r[0] == "a"][-2:] == [("a", "x4", 5), ("a", "x5", 5)]
    assert len([r for r in got if r[0] == "a"]) == 6 and ("b", "y0", 1) in got
    assert olap.top_n_per_group(df, "g", F.desc("v"), 5, method="row_number").filter("g = 'a'").count() == 5


def test_period_growth_skips_missing_and_guards_zero(spark):
    # First period, previous 0, missing month in between
    df = spark.createDataFrame([("s", 2017, 1, 0.0), ("s", 2017, 2, 50.0), ("s", 2017, 4, 75.0),
                                ("t", 2017, 1, 10.0)], "e string, y int, m int, v double")
    out = olap.period_growth(df, "e", ["y", "m"], "v", "prev", "g").orderBy("e", "y", "m").collect()
    assert [(r.prev, r.g) for r in out] == [(None, None), (0.0, None), (50.0, 50.0), (None, None)]


def test_rollup_labels_by_grouping_not_null(spark):
    # A real null store name is not mistaken for a subtotal
    df = spark.createDataFrame([(2017, "S1", 10), (2017, None, 5), (2018, "S1", 1)], "y int, s string, v int")
    out = olap.rollup_labelled(df, [("y", None), ("s", "ALL STORES")], [F.sum("v").alias("v")])
    got = {(r.y, r.s, r.grouping_level): r.v for r in out.collect()}
    assert got[(2017, None, 0)] == 5 and got[(2017, "ALL STORES", 1)] == 15
    assert got[(None, "ALL STORES", 3)] == 16 and got[(2018, "S1", 0)] == 1


def test_trailing_months_clamps_month_end(spark):
    # Latest 2020-08-31 -> window starts 2020-02-29
    days = ["2020-08-31", "2020-02-29", "2020-02-28", "2020-03-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = sorted(r.d.isoformat() for r in olap.trailing_months(df, "d", 6).collect())
    assert got == ["2020-02-29", "2020-03-01", "2020-08-31"]


def test_flag_spikes_exactly_twice_is_not_a_spike(spark):
    # Average over days with sales; exactly 2x is normal, above is a spike
    df = spark.createDataFrame([("p", 1, 1.0), ("p", 2, 1.0), ("p", 3, 4.0),
                                ("q", 1, 1.0), ("q", 2, 1.0), ("q", 3, 1.0), ("q", 4, 5.0)],
                               "p string, d int, v double")
    spikes = olap.flag_spikes(df, "p", "v").collect()
    assert [(r.p, r.d) for r in spikes] == [("q", 4)]
    assert spikes[0].avg_daily_sales == 2.0 and spikes[0].sales_ratio == 2.5
    both = olap.flag_spikes(df, "p", "v", keep_normal=True)
    assert both.filter("p = 'p' and d = 3").first().sales_flag == "normal"


def _pairs_brute(lines):
    by_basket = {}
    for b, i in lines:
        by_basket.setdefault(b, []).append(i)
    c = Counter()
    for items in by_basket.values():
        for a, b in itertools.product(items, items):
            if a < b:
                c[(a, b)] += 1
    return dict(c)


def test_co_occurrence_duplicates_multiply(spark):
    # (A, A, B) pairs (A, B) twice; a one-product order gives no pair
    lines = [("o1", "A"), ("o1", "A"), ("o1", "B"), ("o2", "C"), ("o3", "A"), ("o3", "B"), ("o3", "C")]
    df = spark.createDataFrame(lines, "o string, p string")
    got = {(r.p_1, r.p_2): r.n for r in olap.co_occurrence(df, "o", "p").collect()}
    assert got == _pairs_brute(lines) == {("A", "B"): 3, ("A", "C"): 1, ("B", "C"): 1}


def test_co_occurrence_hot_basket_split_is_exact(spark):
    # a basket far above the threshold is spread over salt buckets; same counts
    lines = [("hot", f"p{i % 40:02d}") for i in range(120)] + \
            [(f"o{j}", f"p{(j * 7 + k) % 40:02d}") for j in range(30) for k in range(3)]
    df = spark.createDataFrame(lines, "o string, p string")
    got = {(r.p_1, r.p_2): r.n for r in olap.co_occurrence(df, "o", "p", hot_basket_items=10, salts=4).collect()}
    assert got == _pairs_brute(lines)


def test_co_occurrence_buckets_and_nulls(spark):
    lines = [("o1", f"p{i % 25:02d}") for i in range(60)] + [("o2", "p01"), ("o2", "p02")]
    df = spark.createDataFrame(lines + [("o1", None), ("o2", None)], "o string, p string")
    for size in (1, 4, 2048):  # one item a bucket; a few; all in one
        got = {(r.p_1, r.p_2): r.n for r in olap.co_occurrence(df, "o", "p", hot_basket_items=size).collect()}
        assert got == _pairs_brute(lines)


def test_conditional_split_pivot_drill_slice(spark):
    df = spark.createDataFrame(
        [("a", 2017, 1, 1, 10.0), ("a", 2017, 3, 7, 5.0), ("b", 2017, 4, 11, 2.0), ("b", 2018, 1, 2, 1.0)],
        "c string, year int, quarter int, month int, v double")
    h = {r.c: (r.H1_v, r.H2_v, r.total) for r in olap.conditional_split(
        df.filter("year = 2017"), "c", F.col("month") <= 6, {"v": F.col("v")}, totals={"total": "v"}).collect()}
    assert h == {"a": (10.0, 5.0, 15.0), "b": (0.0, 2.0, 2.0)}
    p = {r.c: (r.Q1, r.Q2, r.Q3, r.Q4) for r in olap.pivot(df, "c", "quarter", [1, 2, 3, 4], F.col("v"),
                                                           prefix="Q").collect()}
    assert p == {"a": (10.0, None, 5.0, None), "b": (1.0, None, None, 2.0)}
    d = {(r.year, r.quarter): r.v for r in olap.drill(df.withColumn("full_date", F.lit(dt.date(2017, 1, 1))),
                                                      "quarter", [F.sum("v").alias("v")]).collect()}
    assert d == {(2017, 1): 10.0, (2017, 3): 5.0, (2017, 4): 2.0, (2018, 1): 1.0}
    s = olap.slice_dice(df, {"year": 2017, "c": ["a"]})
    assert s.count() == 2


def test_rollup_additive_equals_rollup_without_expanding_rows(spark):
    df = spark.createDataFrame([(2017, "A", "p", 1), (2017, "A", None, 2), (2017, None, "q", 4), (2018, "A", "p", 8), (2018, "A", "p", None),
                                (None, "B", "q", 16)], "y int, s string, p string, v long").withColumn("d", F.col("v").cast("decimal(12,2)"))
    levels = [("y", None), ("s", "ALL STORES"), ("p", "ALL PRODUCTS")]
    for rows in (df, df.limit(0)):
        want = olap.rollup_labelled(rows, levels, [F.sum("v").alias("v"), F.sum("d").alias("d")])
        got = olap.rollup_additive(rows, levels, {"v": F.col("v"), "d": F.col("d")})
        place = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=place) == sorted(map(tuple, want.collect()), key=place)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_co_occurrence_joins_ordinary_baskets_without_another_shuffle(spark):
    rows = [(o, p) for o in range(40) for p in range(o % 7)] + [(99, p) for p in range(60)] + [(None, 1), (None, 2), (5, None), (5, 1)]
    df = spark.createDataFrame(rows, "o int, p int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = olap.co_occurrence(df, "o", "p", hot_basket_items=20)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {(r.p_1, r.p_2): r.n for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert re.search(r"SortMergeJoin \[o#\d+\], \[o#\d+\]", plan)
    lines = Counter((o, p) for o, p in rows if o is not None and p is not None)
    want = Counter()
    for (o, p), n in lines.items():
        for (o2, q), m in lines.items():
            if o == o2 and p < q:
                want[p, q] += n * m
    assert got == dict(want)
