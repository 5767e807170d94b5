"""Values at given ranks, exactly, without putting rows in order.

A histogram of 2^10 equal buckets between the least and the greatest value says in which bucket a rank lies; the next
pass divides only that bucket, and so on until a bucket is one value. Histograms add up, so each pass is one aggregate
whose exchange holds at most 2^10 rows a task and rank; rows are neither sorted nor moved. Values of b bits take
ceil(b / 10) passes after the first, whatever their number, and a value that most rows have is one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

from pyspark.sql import DataFrame, functions as F, types as T

BUCKET_BITS = 10
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Selected:
    """The value of a rank, the number and sum of the rows with greater values, and the rows that have a value."""

    rank: int
    value: int | Decimal
    larger_rows: int
    larger_sum: int | Decimal
    rows: int


def select_ranks(df: DataFrame, value: str, ranks: Callable[[int], Sequence[int]]) -> list[Selected]:
    """What ``value`` is at each of ``ranks(n)``, counted from 0 in ascending order over the n rows that have one.

    Whole numbers and decimals, whose range must fit in 63 bits (else the job fails); doubles are refused, as their
    sums depend on the order. NULL takes no part. No rank may be outside 0..n-1; without ranks the result is empty.
    ``df`` is read once for every pass: give a stored table.
    """
    kind = df.schema[value].dataType
    if isinstance(kind, T.DecimalType):
        scale = kind.scale
    elif isinstance(kind, _WHOLE):
        scale = 0
    else:
        raise TypeError(f"{value} must be a whole number or a decimal, not {kind.simpleString()}")
    units = df.select(F.expr(f"CAST({value} * {10**scale}BD AS decimal(38,0))").alias("v")).filter("v IS NOT NULL")
    n, least, most = units.agg(F.count("*"), F.min("v"), F.max("v")).first()
    wanted = sorted(set(ranks(n)))
    if not wanted:
        return []
    if wanted[0] < 0 or wanted[-1] >= n:
        raise ValueError(f"ranks {wanted} of {n} rows")

    least, most = int(least), int(most)
    bits = (most - least).bit_length()
    if bits > 63:
        raise ValueError(f"the values of {value} are more than 63 bits apart")
    # Offsets from the least value; a bucket is a run of offsets with equal high bits.
    offsets = units.select(F.expr(f"CAST(v - {least}BD AS bigint)").alias("v"))
    # By rank: the first offset of its bucket, the rows before the bucket, the number and the sum of those behind it.
    at = {r: (0, 0, 0, 0) for r in wanted}
    found = False
    while not found:
        shift = max(bits - BUCKET_BITS, 0)
        starts = sorted({low for low, *_ in at.values()})
        inside = F.lit(None).cast("bigint")
        for low in starts:
            inside = F.when(F.col("v").between(low, low + (1 << bits) - 1), F.lit(low)).otherwise(inside)
        histogram = (
            offsets.select("v", inside.alias("part"))
            .filter("part IS NOT NULL")
            .groupBy("part", F.shiftright("v", shift).alias("bucket"))
            .agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total"))
            .collect()
        )
        buckets = {low: sorted((b.bucket, b.n, int(b.total)) for b in histogram if b.part == low) for low in starts}
        at = {r: _narrow(r, *place, buckets[place[0]], shift) for r, place in at.items()}
        bits, found = shift, shift == 0

    def known(units: int) -> int | Decimal:
        return Decimal(f"{units}E-{scale}") if isinstance(kind, T.DecimalType) else units

    return [
        Selected(r, known(low + least), behind, known(total + behind * least), n)
        for r, (low, _, behind, total) in at.items()
    ]


def _narrow(rank, low, before, behind, total, buckets, shift) -> tuple[int, int, int, int]:
    """The bucket that holds a rank, among those of the bucket found before."""
    for i, (bucket, n, _) in enumerate(buckets):
        if rank < before + n:
            after = buckets[i + 1 :]
            return bucket << shift, before, behind + sum(b[1] for b in after), total + sum(b[2] for b in after)
        before += n
    raise RuntimeError("the table changed between two passes")


def sum_of_largest(df: DataFrame, value: str, rows: Callable[[int], int]) -> int | Decimal | None:
    """The sum of the ``rows(n)`` largest values of the n rows, NULL being least; None for no value."""
    n = df.count()
    k = rows(n)
    edge = select_ranks(df, value, lambda known: [known - min(k, known)] if min(k, known) > 0 else [])
    if not edge:
        return None
    of = edge[0]
    with localcontext(prec=76):
        return of.larger_sum + (of.rows - of.rank - of.larger_rows) * of.value


def median(df: DataFrame, value: str) -> float | None:
    """The middle value, or the mean of both; None without values."""
    middle = select_ranks(df, value, lambda n: [(n - 1) // 2, n // 2] if n else [])
    with localcontext(prec=76):
        return float((middle[0].value + middle[-1].value) / 2) if middle else None
