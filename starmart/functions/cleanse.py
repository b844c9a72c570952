"""Cleansing expressions for raw text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


#: Day formats, tried in this order.
DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "yyyyMMdd", "d-MMM-yyyy", "MMM d, yyyy")
TIME_OF_DAY = r"[T ]+[0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?Z?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c) -> Column:
    """Trimmed text id; blank becomes null (a missing id is never the text 'nan')."""
    t = F.trim(_c(c).cast("string"))
    return F.when(F.length(t) > 0, t)


def parse_int(c) -> Column:
    """Integer from text; null when not a whole number (``3.0`` is one, ``3.5`` is not)."""
    t = F.trim(_c(c).cast("string"))
    exact = t.try_cast("decimal(30,10)")
    return F.coalesce(t.try_cast("int"), F.when(exact == F.floor(exact), exact.cast("string").try_cast("decimal(20,0)").cast("string").try_cast("int")))


def parse_decimal(c, dtype: str = "decimal(10,2)") -> Column:
    return F.trim(_c(c).cast("string")).try_cast(dtype)


def parse_date(c) -> Column:
    """Lenient date parse: the day, in one of ``DATE_FORMATS``, with an optional time of
    day after it; null when invalid. Of ambiguous days such as 3/4/2017 the month comes first.

    Ten characters in the common form yyyy-MM-dd have no room for a time of day, so a plain
    cast decides them as the patterns would, at a fraction of their cost."""
    text = _c(c).cast("string")
    plain = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    t = F.regexp_replace(F.trim(text), TIME_OF_DAY, "")
    return F.coalesce(F.when(plain, text.try_cast("date")), F.when(t.rlike("^[0-9]{4}-"), F.try_to_date(t)), *[F.try_to_date(t, f) for f in DATE_FORMATS])
