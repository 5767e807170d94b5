"""ABC classes from a ranked measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from starloom.functions.exprs import TOTAL
from starloom.functions.labels import ABC_LIMITS


def abc_class(running: str, total: str, names: Sequence[str]) -> Column:
    """Class by share of the running total, two columns compared without a division.

    The item that crosses a limit already belongs to the next class.
    """
    share, whole = (F.expr(f"CAST({c} AS {TOTAL}) * {n}") for c, n in ((running, 100), (total, 1)))
    first, second = ABC_LIMITS
    return (
        F.when(share <= whole * F.lit(first), names[0])
        .when(share <= whole * F.lit(second), names[1])
        .otherwise(names[2])
    )
