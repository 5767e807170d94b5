"""Column helpers shared by the operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F

CENTS = "decimal(12,2)"
TOTAL = "decimal(28,2)"


def money(col: Column) -> Column:
    """One monetary value at the stored precision; overflow raises under ANSI mode."""
    return col.cast(CENTS)


def date_key(day: Column) -> Column:
    """Calendar key in the form YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def any_changed(left: str, right: str, columns: list[str]) -> Column:
    """True if one of the columns differs between two aliases; NULL equals NULL."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
    )


def rounded_ratio(num: str, den: str, digits: int) -> Column:
    """num / den rounded half away from zero, NULL for a zero divisor.

    Both are SQL expressions with at most two decimals. The division is done on whole
    cents, so no intermediate quotient is cut to a smaller scale before it is rounded.
    """
    n, d = (f"CAST(CAST(({x}) AS {TOTAL}) * 100 AS decimal(30,0))" for x in (num, den))
    quotient = (
        f"CAST({2 * 10**digits} * abs({n}) + abs({d}) AS decimal(38,0))"
        f" DIV nullif(2 * abs({d}), 0)"
    )
    signed = f"CAST(IF(sign({n}) = sign({d}), 1, -1) * ({quotient}) AS decimal(20,0))"
    unit = format(Decimal(1).scaleb(-digits), "f")
    return F.expr(f"CAST({signed} * {unit}BD AS decimal(20,{digits}))")


def pct(num: str, den: str, digits: int = 1) -> Column:
    """Share of num in den, in percent."""
    return rounded_ratio(f"CAST(({num}) AS decimal(26,2)) * 100", den, digits)


def growth_pct(now: str, before: str, digits: int = 1) -> Column:
    return pct(f"{now} - {before}", before, digits)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def whole_months(later: Column, earlier: Column) -> Column:
    """Calendar months between two month starts."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
