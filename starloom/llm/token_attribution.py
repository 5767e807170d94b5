"""Token counts of fields and sections, from one encoding of each whole document.

A document is its fields, one behind the other, each ended by a line feed but the last. It is encoded once, so
that the counts add up to what a model will see; encoding the parts alone would cut tokens at their edges.
The tokens' character spans are then joined with the spans of the sections. These cover the document without
gaps: a field is a section, or several, each of which ends behind a match of ``section_end``; a field's line
feed belongs to its last section.

A token that touches several sections goes, by ``rule``, to the one that holds most of its characters, the
earlier if several hold as many ("most"), to the one with its first character ("start"), or to the one with its
last ("end"). A token that holds a part of a character touches the whole character.

A null field is absent and has no section. An empty field has one, which holds its line feed if it has one.
Documents without any field give no rows. Rows that repeat an id are counted on their own.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split before the merges, published with the ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A paragraph ends behind its line feeds.
PARAGRAPH_END = r"\n+"
RULES = ("most", "start", "end")
STEP_BYTES = 2_000_000
#: A run of blanks from this length on is split off before the pattern, which steps back over blanks one by one. Where
#: something follows, the pattern leaves the last blank to it, so the run without that one is a piece of its own; else all of it is.
LONG_RUN = 50_000
#: Fixed value: what the pattern counts as blank.
BLANK = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_LONG = re.compile(f"{BLANK}{{{LONG_RUN},}}")


class Encoder:
    def __init__(self, ranks: bytes):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        table = {base64.b64decode(piece): int(rank) for piece, rank in pairs}
        self._encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for piece, rank in table.items():
            self.sizes[rank] = len(piece)

    def token_sizes(self, text: str) -> np.ndarray:
        """Bytes of each token."""
        tokens, at = [], 0
        for run in _LONG.finditer(text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            tokens += self._encoding.encode_ordinary(text[at : run.start()])
            tokens += self._encoding._encode_single_piece(text[run.start() : stop])
            at = stop
        tokens += self._encoding.encode_ordinary(text[at:] if at else text)
        return self.sizes[tokens]


@lru_cache(maxsize=2)
def _encoder(ranks: bytes) -> Encoder:
    return Encoder(ranks)


def join_spans(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str) -> np.ndarray:
    """For each token, a span of characters, the section it goes to; sections begin at the ascending ``edges``."""
    first = np.searchsorted(edges, starts, side="right") - 1
    last = np.searchsorted(edges, ends - 1, side="right") - 1
    if rule == "start":
        return first
    if rule == "end":
        return last
    crossing = np.flatnonzero(first != last)
    if not len(crossing):
        return first
    # One row for each section that a crossing token touches.
    n = last[crossing] - first[crossing] + 1
    token = np.repeat(crossing, n)
    section = np.repeat(first[crossing], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    until = np.append(edges[1:], np.iinfo(np.int64).max)[section]
    overlap = np.minimum(ends[token], until) - np.maximum(starts[token], edges[section])
    order = np.lexsort((section, -overlap, token))
    out = first.copy()
    out[crossing] = section[order][np.cumsum(n) - n]
    return out


def _sections(columns: list[list[str | None]], names: Sequence[str], sectioned: Sequence[str], end: re.Pattern):
    """Each document's text, and its sections as (field, number, first character)."""
    for values in zip(*columns):
        present = [(name, v) for name, v in zip(names, values) if v is not None]
        parts, at, sections = [], 0, []
        for k, (name, value) in enumerate(present):
            whole = value + "\n" if k + 1 < len(present) else value
            cuts = [0]
            if name in sectioned:
                cuts += [m.end() for m in end.finditer(value) if m.end() < len(value)]
            sections += [(name, n, at + cut) for n, cut in enumerate(cuts)]
            parts.append(whole)
            at += len(whole)
        yield "".join(parts), at, sections


def _count(batch: pa.RecordBatch, names, sectioned, end, rule, encoder: Encoder) -> pa.RecordBatch:
    """All documents of a batch lie on one line of characters, so that one join serves them all."""
    rows, fields, numbers, edges, until, starts, ends, base = [], [], [], [], [], [], [], 0
    columns = [batch.column(1 + k).to_pylist() for k in range(len(names))]
    shift = []
    for row, (text, length, sections) in enumerate(_sections(columns, names, sectioned, end)):
        if not sections:
            continue
        sizes = encoder.token_sizes(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        stop = np.cumsum(sizes)
        if len(stop):
            starts.append(base + char[stop - sizes])
            ends.append(base + char[stop - 1] + 1)
        first = [s[2] for s in sections]
        rows += [row] * len(sections)
        fields += [s[0] for s in sections]
        numbers += [s[1] for s in sections]
        edges += [base + f for f in first]
        until += [base + f for f in first[1:]] + [base + length]
        shift += [base] * len(sections)
        base += length
    tokens = np.zeros(len(rows), np.int64)
    if starts:
        edge = np.array(edges, np.int64)
        to = join_spans(np.concatenate(starts), np.concatenate(ends), edge, rule)
        tokens = np.bincount(to, minlength=len(rows))
    shifts = np.array(shift, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(rows, pa.int64())),
            pa.array(fields, pa.string()),
            pa.array(numbers, pa.int32()),
            pa.array(np.array(edges, np.int64) - shifts, pa.int64()),
            pa.array(np.array(until, np.int64) - shifts, pa.int64()),
            pa.array(tokens, pa.int64()),
        ],
        ["id", "field", "section", "start", "end", "n_tokens"],
    )


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about STEP_BYTES; a longer document is one of its own."""
    rows = max(1, int(batch.num_rows * STEP_BYTES / max(batch.nbytes, 1)))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def section_tokens(
    docs: DataFrame,
    fields: Sequence[str],
    *,
    sectioned: Sequence[str] = (),
    section_end: str = PARAGRAPH_END,
    rule: str = "most",
    ranks: str = RANKS,
    id_col: str = "doc_id",
) -> DataFrame:
    """id, field, section, start, end, n_tokens: one row per section; spans are characters of the document."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    # The ranks' file has a fixed size of half a megabyte; executors need not see its path.
    shared = docs.sparkSession.sparkContext.broadcast(Path(ranks).read_bytes())
    names, cut = list(fields), set(sectioned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(shared.value), re.compile(section_end)
        for batch in batches:
            for part in _parts(batch):
                yield _count(part, names, cut, end, rule, encoder)

    rows = docs.select(F.col(id_col).alias("id"), *[F.col(f).cast("string").alias(f"field{k}") for k, f in enumerate(names)])
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("field", T.StringType()),
            T.StructField("section", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return rows.mapInArrow(run, schema)
