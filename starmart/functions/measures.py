"""Measures: line amounts, exact sums, safe ratios and growth.

Sums are taken in decimal so ranking and ties are decided on exact values;
a result leaves as double only at the output. Division is guarded on the
divisor (0 or missing gives null), whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starmart.schemas import AMOUNT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_amount(quantity, price) -> Column:
    """quantity x unit price as decimal(12,2); null if it does not fit."""
    return F.try_multiply(_c(quantity).cast("decimal(10,0)"), _c(price)).try_cast(AMOUNT)


def to_double(c) -> Column:
    return _c(c).cast("double")


def safe_div(num, den) -> Column:
    """num / den as double; null when den is 0 or null."""
    d = to_double(den)
    return F.when(d != 0, to_double(num) / d)


def exact_avg(sum_col, count_col) -> Column:
    """Average from an exact decimal sum and a count."""
    return safe_div(sum_col, count_col)


def growth_pct(cur, prev, absolute: bool = False, digits: int = 2) -> Column:
    """round((cur - prev) / prev * 100, digits); null without a previous value
    or when it is 0. ``absolute`` gives the volatility form abs(...)."""
    ratio = safe_div(_c(cur) - _c(prev), prev)
    if absolute:
        ratio = F.abs(ratio)
    return F.round(ratio * 100, digits)
