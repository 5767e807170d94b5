"""Helpers of the text operators: reading tables, whole rows as one column, hashing words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words: space and the control characters from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Bytes of text that one numpy step handles, besides a longer text, which is a step of its own.
STEP_BYTES = 2_000_000

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns in one struct, so that no name of theirs can clash with one added here."""
    return F.struct(*[df[c] for c in df.columns]).alias(name)


def no_text(col: str | Column) -> Column:
    """A null text counts as the empty one."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(text: str | Column) -> Column:
    """Words in a text: the runs of anything but white space."""
    return F.regexp_count(no_text(text), F.lit(f"{NOT_SPACE}+")).cast("long")


def mix64(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every output bit depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def in_steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8, about ``most`` bytes together; with the place of the first. Nulls are empty."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        part = column.slice(first, end - first).cast(pa.binary())
        yield first, [text or b"" for text in part.to_pylist()]
        first = end


def word_hashes(texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word of the texts, where each text's words begin, and the words' bytes.

    Returns hashes, offsets (one more than texts), starts of the words in the joined texts, and
    their lengths. With ``fold``, A-Z count as a-z. The bytes of all words are taken in step by
    step, the longest words first, so that memory follows the number of words.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _IS_SPACE[joined]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    lengths = ends - starts
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.searchsorted(starts, text_ends))).astype(np.int64)
    letters = _LOWER[joined] if fold else joined
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = starts[order], lengths[order]
    h = np.full(len(order), 0x243F6A8885A308D3, np.uint64)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for k, n in enumerate(active.tolist()):
        part = h[:n]
        part ^= _BYTE_VALUES[letters[begin[:n] + k]]
        part *= np.uint64(0x9FB21C651E98DF25)
        part ^= part >> np.uint64(29)
    hashes = np.empty_like(h)
    hashes[order] = mix64(h)
    return hashes, offsets, starts, lengths


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Sorted rows in parts that hold whole groups, with where the groups begin and the last one ends.

    Groups are runs of equal keys; nulls are equal. A part is a batch and what the batch before left over, so
    memory follows the batch and the largest group.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        cuts = _group_starts(rows, keys)
        if len(cuts) > 1:
            yield rows.slice(0, cuts[-1]).combine_chunks(), cuts
        rest = rows.slice(cuts[-1])
    if rest is not None:
        yield rest.combine_chunks(), [0, rest.num_rows]


def _group_starts(rows: pa.Table, keys: list[str]) -> list[int]:
    columns = [rows.column(k).to_pylist() for k in keys]
    values = list(zip(*columns))
    return [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1])]
