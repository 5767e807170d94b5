"""Small tables kept beside the fact: what was worked out from each of its folders, once.

A folder of the fact holds a month and never changes, so what was worked out from it stays right: an upsert or a
reload leaves the rows of other folders as they are, and rows of folders that are gone are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.operators import facts
from starloom.operators.checks import stack_rows
from starloom.sources.snapshot import SnapshotStore, month_of
from starloom.workspace import Workspace


def by_folder(
    store: SnapshotStore,
    table: str,
    folders: Sequence[str],
    make: Callable[[DataFrame], DataFrame],
    scratch: Workspace,
    *,
    known: DataFrame | None = None,
) -> DataFrame:
    """The rows of a side table for these folders; ``make`` works out those of folders that have none, from the fact.

    ``make`` returns rows with the fact's month. Of the fact, only the missing folders are read. ``known`` replaces the stored
    rows, where not all of them are still right.
    """
    kept = (store.read(table) if known is None else known).filter(F.col("folder").isin(*folders))
    done = {r[0] for r in kept.select("folder").distinct().collect()}  # a folder is a month
    missing = [f for f in folders if f not in done]
    rows = [kept]
    while missing:
        # Folders of different months, told apart by the month of their rows.
        of_month = {month_of(f): f for f in reversed(missing)}
        missing = [f for f in missing if f not in of_month.values()]
        named = store.spark.createDataFrame(list(of_month.items()), f"{facts.MONTH} int, folder string")
        made = make(facts.with_month(store.scan("fact_sales", list(of_month.values()))))
        rows.append(made.join(named, facts.MONTH).select(*kept.columns))
    return scratch.save(stack_rows(rows), table)
