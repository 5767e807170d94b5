"""Mixing sources to target weights by weighted fair queueing.

Every source's documents stand in a queue, shuffled by a digest of their id. A document's virtual finish time is
the number of its source's words up to its end, divided by the source's weight: at any time, all queues
that still have documents have sent words in proportion to their weights. A queue that ends is repeated,
up to ``passes`` times, each copy of a document finishing later by its source's whole size. All copies are
range-sorted by finish time, whatever their source; the words before each are summed over the sort, and the mix
ends where the sum reaches the budget. The copy that the budget ends in is sent in part.

So each source gets its weight's share of the budget, within the size of a document, or all its passes if that is
less, and the others share what it leaves by weight. ``target`` is that share, worked out from the sources' sizes; it
is reported, and decides nothing.

Both sums, over a queue and over all copies, come from sorted splits and their totals (``prefix_sums``), so no window
holds a source, or rows that share an id. Finish times are whole numbers: words times the least common multiple of
the weights over the weight. Only DataFrame functions are used.

Sizes are words; a null text has none. A null source is a source, the last one. Documents without words are
never taken. Null ids are shuffled like any other; rows that are equal in id stand in a queue by size and by their place in the
table. With no words at all, nothing is taken and all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import as_row, word_count
from starloom.operators.ordering import prefix_sums
from starloom.workspace import Workspace

def source_weights(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """source, source_size, weight: sources by code point, null last, weigh as ``weights`` says, repeating.

    One row per source is all that this window holds; the rows of a source are summed before it.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    return totals.select("source", "source_size", weight.cast("long").alias("weight"))


def _ends(passes: int, words: int, weight: int) -> Column:
    """Whether a source has sent all its passes at the time words / weight; in whole numbers."""
    whole = "decimal(38,0)"
    sent = F.lit(passes) * F.col("source_size").cast("decimal(19,0)")
    return sent.cast(whole) * F.lit(weight).cast(whole) <= F.lit(words).cast(whole) * F.col("weight").cast(whole)


def spent_at(sources: DataFrame, budget: int, passes: int) -> tuple[int, int]:
    """The time at which the budget is spent, as words over weight: (words, weight).

    The words that remain for the sources that do not end, and the sum of their weights. Each step reads one
    row of sums; a source found to end stays ended, so the steps end too.
    """
    words, weight = budget, None
    while True:
        ends = F.lit(False) if weight is None else _ends(passes, words, weight)
        row = sources.agg(
            F.sum(F.when(ends, passes * F.col("source_size")).otherwise(0)).alias("ended"),
            F.sum(F.when(ends, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        now = (budget - (row.ended or 0), row.weight or 0)
        if now == (words, weight) or now[1] == 0:
            return (words, weight or 1) if now[1] else (max(now[0], 0), 0)
        words, weight = now


def finish_times(rows: DataFrame, sources: DataFrame, weights: Sequence[int], passes: int, scratch: Workspace) -> DataFrame:
    """A row for each copy of each document with words: row, source, size, turn and its virtual finish time."""
    placed = rows.where("size > 0").withColumn("place", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    queue = prefix_sums(placed, "size", ["place", "id", "size", "row"], by=["source"], scratch=scratch, name="before")
    named = sources.select(F.col("source").alias("_source"), "source_size", "weight")
    sent = queue.join(named, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))
    )
    until = F.col("turn") * F.col("source_size") + F.col("before") + F.col("size")
    per_word = F.call_function("div", F.lit(lcm(*map(int, weights))), F.col("weight"))
    return sent.select("row", "source", "size", "turn", (until * per_word).alias("finish"))


def fair_mix(
    docs: DataFrame,
    scratch: Workspace,
    weights: Sequence[int],
    *,
    budget_share: float = 1.0,
    passes: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """A row for every document: id, row, source, size, source_size, target, taken, turns, key.

    ``turns`` has, for each copy in the mix, its finish time and the number of its words sent; ``taken`` adds these up.
    ``row`` tells all rows apart. ``size`` replaces the word count, and ``key`` is carried along.
    """
    rows = scratch.save(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            (word_count(text_col) if size is None else size).cast("long").alias("size"),
            F.monotonically_increasing_id().alias("row"),
            (F.lit(None) if key is None else key).cast("binary").alias("key"),
        ),
        "sizes",
    )
    sources = scratch.save(source_weights(rows, weights), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = int(total * budget_share)
    copies = finish_times(rows, sources, weights, passes, scratch)
    # The mix: one sort of all copies, cut where the budget is spent. Equal times: by source, then by place in the table.
    order = ["finish", "source", "turn", "row"]
    timed = prefix_sums(copies, "size", order, scratch=scratch, name="before").where(F.col("before") < budget)
    sent = F.least(F.col("size"), F.lit(budget) - F.col("before")).alias("sent")
    turns = timed.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_list(F.struct("finish", sent))).alias("turns"))

    words, weight = spent_at(sources, budget, passes)
    most = passes * F.col("source_size")
    ends = F.lit(True) if weight == 0 else _ends(passes, words, weight)
    share = F.lit(0.0) if weight == 0 else F.lit(float(words)) * F.col("weight") / F.lit(float(weight))
    aimed = sources.select(
        F.col("source").alias("_source"), "source_size", F.when(ends, most.cast("double")).otherwise(share).alias("target")
    )
    whole = rows.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).join(turns, F.col("row") == F.col("_row"), "left")
    none = F.array().cast("array<struct<finish:bigint,sent:bigint>>")
    return whole.withColumn("turns", F.coalesce("turns", none)).select(
        "id",
        "row",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["sent"]).alias("taken"),
        "turns",
        "key",
    )


def mixed(
    docs: DataFrame,
    scratch: Workspace,
    weights: Sequence[int],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The mix itself, globally sorted by finish time: whole documents, one row for each time one is taken.

    A document that is on its way when the budget is spent is let through. Texts are shuffled to meet what was
    decided without them, and sorted; nothing else moves them. Rows meet by a digest of all their columns: rows that are
    equal in everything are reduced to one before the shuffle, and each copy taken of any of them is that one again.
    """
    sized = docs.select(
        as_row(docs), F.col(id_col).alias("_id"), F.col(source_col).alias("_source_of"), word_count(text_col).alias("_size")
    )
    digest = F.unhex(F.md5(F.to_json("_row", {"ignoreNullFields": "false"})))
    placed = fair_mix(
        sized, scratch, weights, id_col="_id", source_col="_source_of", size=F.col("_size"), key=digest, **options
    )
    taken = placed.select(F.col("key").alias("_key"), "row", F.inline("turns")).drop("sent")
    one = sized.groupBy(digest.alias("_key")).agg(F.first("_row").alias("_row"), F.first("_source_of").alias("_source_of"))
    return one.join(taken, "_key").orderBy("finish", "_source_of", "row").select("_row.*")
