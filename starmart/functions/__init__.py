"""Column expressions shared by operators and reports."""

from starmart.functions import cleanse, dates, measures

__all__ = ["cleanse", "dates", "measures"]
