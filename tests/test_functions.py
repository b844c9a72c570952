import datetime as dt

from pyspark.sql import functions as F

from starmart.functions import cleanse, dates, measures


def test_date_attributes_calendar_edges(spark):
    # Month and season boundaries, Friday to Monday
    days = ["2017-02-28", "2017-03-01", "2017-05-31", "2017-06-01", "2017-08-31", "2017-09-01",
            "2017-11-30", "2017-12-01", "2017-01-06", "2017-01-07", "2017-01-08", "2017-01-09"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    out = {r.full_date.isoformat(): r for r in df.select(*dates.date_attributes("d")).collect()}
    assert out["2017-02-28"].season == "Winter" and out["2017-03-01"].season == "Spring"
    assert out["2017-05-31"].season == "Spring" and out["2017-06-01"].season == "Summer"
    assert out["2017-08-31"].season == "Summer" and out["2017-09-01"].season == "Fall"
    assert out["2017-11-30"].season == "Fall" and out["2017-12-01"].season == "Winter"
    assert out["2017-12-01"].year == 2017  # December shares the calendar year's Winter
    assert [out[d].is_weekend for d in ("2017-01-06", "2017-01-07", "2017-01-08", "2017-01-09")] == \
        [False, True, True, False]
    fri = out["2017-01-06"]
    assert (fri.day_of_week, fri.month_name, fri.quarter, fri.date_key, fri.day_of_month) == \
        ("Friday", "January", 1, 20170106, 6)
    assert out["2017-11-30"].quarter == 4


def test_field_position_unknown_first(spark):
    # FIELD() ordering, unknown value sorts first (position 0)
    df = spark.createDataFrame([("Winter",), ("Spring",), ("Monsoon",), ("Fall",), (None,)], "s string")
    got = [r.s for r in df.orderBy(dates.field_position("s", *dates.SEASON_ORDER), "s").collect()]
    assert got[:2] == [None, "Monsoon"] and got[2:] == ["Spring", "Fall", "Winter"]


def test_cleanse_ids_dates_numbers(spark):
    # E1, E4, E16
    df = spark.createDataFrame([("  C1 ", "2017-13-01", "x"), ("", "", "3"), (None, "2017-1-5", " 7 ")],
                               "id string, d string, q string")
    rows = df.select(cleanse.clean_id("id").alias("id"), cleanse.parse_date("d").alias("d"),
                     cleanse.parse_int("q").alias("q")).collect()
    assert rows[0].id == "C1" and rows[0].d is None and rows[0].q is None
    assert rows[1].id is None and rows[1].d is None and rows[1].q == 3
    assert rows[2].id is None and rows[2].d == dt.date(2017, 1, 5) and rows[2].q == 7


def test_growth_guards_division(spark):
    # SEM1 / E10: previous 0 or missing gives null, not an error
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None), (50.0, 100.0)], "c double, p double")
    got = [r[0] for r in df.select(measures.growth_pct("c", "p")).collect()]
    assert got == [10.0, None, None, -50.0]
    got = [r[0] for r in df.select(measures.growth_pct("c", "p", absolute=True)).collect()]
    assert got == [10.0, None, None, 50.0]


def test_line_amount_decimal_and_overflow(spark):
    df = spark.createDataFrame([(3, "10.50"), (10 ** 9, "99999999.99")], "q int, p string")
    got = [r[0] for r in df.select(measures.line_amount("q", F.col("p").cast("decimal(10,2)"))).collect()]
    assert str(got[0]) == "31.50" and got[1] is None


def test_tune_for_scale_sizes_partitions(spark):
    from starmart.session import tune_for_scale
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.files.maxPartitionBytes",
                                             "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        conf = tune_for_scale(spark, 100 * (1 << 40))  # 100 TiB
        assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 4096 + 1
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_plain_days_are_decided_without_patterns_and_alike(spark):
    # the cast of the common form stands before the patterns, and gives what they give
    days = {"2017-01-05": dt.date(2017, 1, 5), "2017-13-01": None, "2017-02-30": None, "0001-01-01": dt.date(1, 1, 1),
            " 2017-1-05": dt.date(2017, 1, 5), "2017-01-5 ": dt.date(2017, 1, 5), "017-01-015": None, "+201-01-01": None,
            "2017/01/05": dt.date(2017, 1, 5), "2017-01-05 10:30": dt.date(2017, 1, 5), "1/2/2017": dt.date(2017, 1, 2)}
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", cleanse.parse_date("d").alias("p"))
    assert {r.d: r.p for r in df.collect()} == days
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("length(d#") < plan.index("regexp_replace")  # the common form first, without a regular expression


def test_texts_of_an_order_are_made_below_the_join(spark):
    from starmart.sources import testdata
    plan = testdata.transactions(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("date_format")


def test_landing_gives_every_core_a_file(spark, tmpdir_path, monkeypatch):
    from starmart.plans import catalog
    monkeypatch.setattr(catalog, "_n_files", lambda s: 6)
    assert len(spark.read.text(catalog._landed(spark, "/root/testdata/sf0.001", faults=True)).inputFiles()) == 6
