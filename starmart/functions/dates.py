"""Calendar attributes of a date, all as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's date dimension and reports:
# seasons by calendar month, the custom season sort order, and day types.
SEASON_MONTHS = {
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Fall": (9, 10, 11),
}
SEASON_OTHER = "Winter"  # December, January, February (same calendar year)
SEASON_ORDER = ("Spring", "Summer", "Fall", "Winter")
WEEKEND = "Weekend"
WEEKDAY = "Weekday"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(month) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASON_MONTHS.items():
        cond = m.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASON_OTHER))


def date_key(d) -> Column:
    """yyyymmdd as an int; computed, never allocated, so any writer agrees."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def is_weekend(d) -> Column:
    # weekday(): Monday = 0 ... Sunday = 6
    return F.weekday(_c(d)) >= 5


def day_type(weekend_flag) -> Column:
    return F.when(_c(weekend_flag), F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def date_attributes(d) -> list[Column]:
    """All columns of dim_date for a date column."""
    d = _c(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        is_weekend(d).alias("is_weekend"),
        season(F.month(d)).alias("season"),
    ]


def field_position(c, *values: str) -> Column:
    """Position of ``c`` in ``values`` (1-based), 0 when absent: the FIELD()
    custom ordering. A null or unknown value sorts first."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.array_position(arr, _c(c)).cast("int"), F.lit(0))


def year_range(d, year: int) -> Column:
    """``d`` within calendar ``year`` as a half-open range, so a scan over a
    raw date column can skip row groups by min/max statistics."""
    d = _c(d)
    return (d >= F.lit(f"{year:04d}-01-01").cast("date")) & (d < F.lit(f"{year + 1:04d}-01-01").cast("date"))
