"""Importance resampling of documents towards the word and word-pair distribution of a target set.

Features are all runs of one and of two consecutive words, hashed into buckets by CRC-32. The gain of a bucket is the
logarithm of how much likelier the target is to show it than the documents are; a document's weight is the mean gain of its
features. Weight plus Gumbel noise, drawn from a digest of the id, ranks the documents, so that taking the highest is
sampling without replacement by weight, and reruns agree.

Text is handled by Arrow kernels, a few megabytes at a time: ascii_lower, split_pattern_regex, list_flatten and
dictionary_encode turn texts into indices of distinct words; shifted beside each other, the indices form pairs, which are
encoded once more; CRCs are computed for distinct words, and from theirs for distinct pairs; ``take`` carries buckets and gains
back to the occurrences, and sums over each text's segment finish the job. Texts are read twice: to count, and to weigh.

Counts and gains have ``BUCKETS`` entries whatever the input: they are summed on the executors, and as many rows reach the
driver and go out with the tasks. Ranks come from a global range order (``ordering.number_rows``), never from one task.

A null text has no words; a text without features has weight 0. Rows are kept as they are, repeated ones too: they score
alike, since equal ids have equal noise. A null id counts as an empty one in the digest and comes first among ties.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from starloom.llm.common import STEP_BYTES
from starloom.operators.ordering import number_rows
from starloom.workspace import Workspace

BUCKETS = 10_000
#: Between words, once A-Z are lower-cased: all of ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def steps(texts: pa.Array, most: int = STEP_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(first, end - first)
        first = end


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word and of each pair of words, and where each text's words and pairs begin (one more than texts)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), pattern=BETWEEN)
    flat, parent = pc.list_flatten(parts), pc.list_parent_indices(parts)
    # Separators at the ends of a text leave empty parts.
    filled = pc.greater(pc.binary_length(flat), 0)
    encoded = pc.dictionary_encode(flat.filter(filled))
    parent = parent.filter(filled).to_numpy()
    index = encoded.indices.to_numpy().astype(np.int64)
    vocabulary = np.empty(len(encoded.dictionary), object)
    vocabulary[:] = encoded.dictionary.cast(pa.binary()).to_pylist()
    word_crc = np.fromiter(map(crc32, vocabulary), np.int64, len(vocabulary))
    # The checksum of a word and a space, to be carried on over the next word.
    begun = np.array([crc32(b" ", c) for c in word_crc.tolist()], object)

    together = parent[1:] == parent[:-1]
    pairs = (index[:-1] * len(vocabulary) + index[1:])[together]
    coded = pc.dictionary_encode(pa.array(pairs))
    first, second = np.divmod(coded.dictionary.to_numpy(), max(1, len(vocabulary)))
    pair_crc = np.fromiter(map(crc32, vocabulary[second], begun[first]), np.int64, len(first))

    def spread(crc: np.ndarray, places: pa.Array) -> np.ndarray:
        return pc.take(pa.array(crc % buckets), places).to_numpy(zero_copy_only=False)

    n = np.bincount(parent, minlength=len(texts))
    starts = np.concatenate(([0], np.cumsum(n)))
    pair_starts = np.concatenate(([0], np.cumsum(np.maximum(n - 1, 0))))
    return spread(word_crc, encoded.indices), spread(pair_crc, coded.indices), starts, pair_starts


def bucket_counts(rows: DataFrame, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often the features of all texts fall into each bucket. Each task counts before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in steps(batch.column("text")):
                words, pairs, _, _ = features(texts, buckets)
                total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int64), "n": total[seen]})

    texts = rows.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the target's share of each bucket over the documents', both with one more in every bucket."""
    size, all_documents, all_target = len(documents), int(documents.sum()), int(target.sum())
    ratio = (target + 1.0) * (all_documents + size) / ((documents + 1.0) * (all_target + size))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """The rows without their column ``text``, with n_words, n_features and weight."""
    buckets = len(gain)

    def sums(of_feature: np.ndarray, starts: np.ndarray) -> np.ndarray:
        running = np.concatenate(([0], np.cumsum(gain[of_feature])))
        return running[starts[1:]] - running[starts[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, totals = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for texts in steps(batch.column("text")):
                words, pairs, starts, pair_starts = features(texts, buckets)
                n_words.append(np.diff(starts))
                totals.append(sums(words, starts) + sums(pairs, pair_starts))
            n, total = np.concatenate(n_words), np.concatenate(totals)
            n_features = np.maximum(2 * n - 1, 0)
            found = {"n_words": n, "n_features": n_features, "weight": total // np.maximum(n_features, 1)}
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *map(pa.array, found.values())], [*kept, *found])

    kept = [f for f in docs.schema if f.name != "text"]
    counted = [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]
    return docs.mapInArrow(run, T.StructType([*kept, *counted]))


def resample(
    docs: DataFrame,
    target: DataFrame,
    scratch: Workspace,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    least_words: int = 20,
    percent: int = 25,
    seed: int = 7,
    buckets: int = BUCKETS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """id, n_words, n_features, weight, score and rank of every row; rank is null where a row is not drawn.

    Drawn are ``percent`` of the rows with ``least_words`` words or more. Columns named in ``keep`` come along as the struct ``row``.
    """

    def counted(rows: DataFrame, column: str) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in bucket_counts(rows, column, buckets).collect():  # as many rows as buckets at most
            out[r["bucket"]] = r["n"]
        return out

    gain = gains(counted(docs, text_col), counted(target, target_col))
    row = [F.struct(*[docs[c] for c in keep]).alias("row")] if keep else []
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), *row)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    weighed = scratch.save(weights(texts, gain), "weights")
    scored = weighed.withColumn("h", noise.cast("long")).withColumn(
        "score", F.expr("weight + cast(floor(-1000 * ln(-ln((h + 0.5D) / 4294967296D))) AS long)")
    )
    # Rows that can be drawn come first. The place of a row spreads rows that are equal in all else.
    ordered = scored.withColumns(
        {"_short": F.col("n_words") < least_words, "_down": -F.col("score"), "_place": F.monotonically_increasing_id()}
    )
    numbered = number_rows(ordered, "_number", ["_short", "_down", "id", "_place"], scratch=scratch)
    drawn = percent * weighed.where(F.col("n_words") >= least_words).count() // 100
    rank = F.when(~F.col("_short") & (F.col("_number") <= drawn), F.col("_number"))
    return numbered.select("id", "n_words", "n_features", "weight", "score", rank.alias("rank"), *(["row"] if keep else []))
