"""Calendar and fiscal-calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the fiscal calendar: the year starts on 17 July, so a shift of
# 16 days puts its start on the first of a month.
FISCAL_SHIFT_DAYS = 16
FISCAL_START_MONTH = 7


def leap_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366


def fiscal_month_index(day: Column, shift_days: int = FISCAL_SHIFT_DAYS) -> Column:
    """Months since year 0 of the fiscal calendar; 12 per fiscal year."""
    shifted = F.date_sub(day, shift_days)
    return F.year(shifted) * 12 + F.month(shifted) - FISCAL_START_MONTH


def fiscal_year(day: Column, shift_days: int = FISCAL_SHIFT_DAYS) -> Column:
    """Named after the calendar year in which the fiscal year starts."""
    return F.floor(fiscal_month_index(day, shift_days) / 12).cast("int")


def fiscal_quarter(day: Column, shift_days: int = FISCAL_SHIFT_DAYS) -> Column:
    return (F.floor(F.pmod(fiscal_month_index(day, shift_days), F.lit(12)) / 3) + 1).cast("int")
