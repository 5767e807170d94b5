"""Text quality by a second-order factorisation machine.

Features of a text are its words, hashed, with weights of the square root of their share; statistics of its
structure, each as the step of a fixed scale that it falls on; and metadata, the declared length beside the
true one. A factorisation machine gives every feature a weight and a short vector, and scores the pairs of
features by the product of their vectors. The sum over all pairs is half the difference between the square of
the sum and the sum of the squares, so a text is scored in time linear in its features.

The model is fitted on a sample of labelled rows of at most ``rows``, the first by a digest of their id; all
else, features and scores, is worked out where the texts are. Labels that are null, or that contradict
each other for one id, are not used. Without any usable label every score is 0.5.

Null and empty texts have statistics but no words, and get a score like any other. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import in_steps, word_hashes

#: Labelled rows that the model is fitted on, at most; with their features they take a few tens of MB.
FIT_ROWS = 8_192
WORD_BITS = 14
FACTORS = 8
#: Statistics of a text; each has STEPS features of its own, one of which is set.
STATISTICS = (
    "letters", "upper", "digits", "marks", "high", "spaces", "distinct", "repeats", "mean", "long", "words",
    "lines", "declared", "marked",
)
STEPS = 24
#: Words that every text counts as having besides its own: few words alone say little.
RARE = 16


def _shape() -> tuple[int, int]:
    return 1 << WORD_BITS, (1 << WORD_BITS) + STEPS * len(STATISTICS)


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # 0: marks
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[128:] = 4
    kind[[0x20, *range(0x09, 0x0E)]] = 5
    return kind


_KIND = _classes()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share as a step: fine near 0 and near 1."""
    p = part / np.maximum(whole, 1)
    return np.clip(np.rint((STEPS - 1) * (0.5 + np.sign(p - 0.5) * np.sqrt(np.abs(p - 0.5) / 2))), 0, STEPS - 1)


def _size(n: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(2 * np.log2(1 + np.maximum(n, 0))), 0, STEPS - 1)


def features(texts: list[bytes], declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts, and where each text's begin (one more than texts)."""
    hashes, offsets, starts, lengths = word_hashes(texts)
    n = len(texts)
    words = np.diff(offsets)
    of = np.repeat(np.arange(n), words)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begins = ends - sizes - 1
    counts = np.zeros((n, 6), np.int64)
    for k in range(6):
        total = np.concatenate(([0], np.cumsum(_KIND[joined] == k, dtype=np.int64)))
        counts[:, k] = total[ends - 1] - total[begins]
    lines = np.concatenate(([0], np.cumsum(joined == 0x0A, dtype=np.int64)))
    # One entry per text and distinct word bucket.
    bucket = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    pairs, times = np.unique(of << WORD_BITS | bucket, return_counts=True)
    text_of, word = pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1)
    distinct = np.bincount(text_of, minlength=n)
    again = np.zeros(n, np.int64)
    if len(hashes) > 1:
        np.add.at(again, of[1:], (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]))
    # Words whose last byte is no letter, digit or usual stop, or that are such a byte alone.
    last = joined[starts + lengths - 1] if len(starts) else np.zeros(0, np.uint8)
    marked = np.bincount(of, weights=(_KIND[last] == 0) & ~np.isin(last, np.frombuffer(b".,;:?)\"'", np.uint8)), minlength=n)
    chars = sizes - _continued(joined, begins, ends)
    visible = np.maximum(sizes - counts[:, 5], 1)
    steps = np.stack(
        [
            _share(counts[:, 1] + counts[:, 2] + counts[:, 4], visible),
            _share(counts[:, 2], counts[:, 1] + counts[:, 2]),
            _share(counts[:, 3], visible),
            _share(counts[:, 0], visible),
            _share(counts[:, 4], visible),
            _share(counts[:, 5], sizes),
            _share(distinct, np.maximum(words, 1)),
            _share(again, words),
            _size(sizes / np.maximum(words, 1)),
            # One more length, so that texts without words at the end do not cut the last one's words short.
            _size(np.maximum.reduceat(np.append(lengths, 0), offsets[:-1]) * (words > 0)),
            _size(words),
            _size(words / np.maximum(1, lines[ends - 1] - lines[begins] + 1)),
            _size(np.abs(np.where(declared < 0, 0, declared - chars))),
            _share(marked, words),
        ],
        1,
    ).astype(np.int64)
    word_dim = 1 << WORD_BITS
    stat = word_dim + STEPS * np.arange(len(STATISTICS)) + steps
    value = np.sqrt(times / (words[text_of] + RARE))
    per = distinct + len(STATISTICS)
    index = np.empty(int(per.sum()), np.int64)
    values = np.full(len(index), 1.0 / np.sqrt(len(STATISTICS)))
    at = np.concatenate(([0], np.cumsum(per)))
    is_stat = np.zeros(len(index), bool)
    for k in range(len(STATISTICS)):
        is_stat[at[:-1] + k] = True
    index[is_stat] = stat.ravel()
    index[~is_stat] = word
    values[~is_stat] = value
    return index, values, at


def _continued(joined: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum((joined & 0xC0) == 0x80, dtype=np.int64)))
    return total[ends - 1] - total[begins]


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums of the vectors, which the gradient needs."""
        weighted = self.factors[index] * values[:, None]
        sums = np.add.reduceat(weighted, at[:-1], axis=0)
        squares = np.add.reduceat(weighted**2, at[:-1], axis=0)
        linear = np.add.reduceat(self.weights[index] * values, at[:-1])
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1), sums

    def score(self, index: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(index, values, at)[0], -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, seed: int = 7) -> Model:
    """Logistic loss, the rarer label 0 weighing more by the root of the odds, by adaptive steps over small batches."""
    rng = np.random.default_rng(seed)
    dim = _shape()[1]
    model = Model(0.0, np.zeros(dim), rng.normal(0, 0.05, (dim, FACTORS)))
    if not len(labels):
        return Model(0.0, np.zeros(dim), np.zeros((dim, FACTORS)))
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    importance = np.where(labels == 1, 1.0, np.sqrt(share / (1 - share)))
    seen_w, seen_v, rate, decay = np.full(dim, 1e-2), np.full((dim, FACTORS), 1e-2), 0.1, 1e-5
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for part in np.array_split(order, max(1, len(order) // 64)):
            index = np.concatenate([rows[i][0] for i in part])
            values = np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            at = np.concatenate(([0], np.cumsum(sizes)))
            raw, sums = model.raw(index, values, at)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[part]) * importance[part] / len(part)
            each = np.repeat(slope, sizes) * values
            v = model.factors[index]
            gradient = each[:, None] * (np.repeat(sums, sizes, 0) - v * values[:, None])
            which, place = np.unique(index, return_inverse=True)
            gw = np.bincount(place, each) + decay * model.weights[which]
            gv = np.stack([np.bincount(place, gradient[:, f]) for f in range(FACTORS)], 1) + decay * model.factors[which]
            seen_w[which] += gw**2
            seen_v[which] += gv**2
            model.weights[which] -= rate * gw / np.sqrt(seen_w[which])
            model.factors[which] -= rate * gv / np.sqrt(seen_v[which])
            model.bias -= rate * slope.sum()
    return model


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    declared = batch.column("declared").fill_null(-1).to_numpy(zero_copy_only=False)
    for first, texts in in_steps(batch.column("text")):
        yield first, texts, declared[first : first + len(texts)]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts, declared in _batches(batch):
            index, values, at = features(texts, declared)
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("quality").slice(first, len(texts)),
                    pa.ListArray.from_arrays(offsets, pa.array(index, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(values, pa.float32())),
                ],
                ["quality", "index", "value"],
            )


def is_held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Rows whose labels are never learned: by the CRC-32 of the id as text. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> Model:
    """labels: the id and ``quality``, 0 or 1. At most ``rows`` of them are used, the first by a digest of the id."""
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .select("_id", F.col("low").cast("int").alias("quality"))
    )
    first = usable.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(rows)
    # At most ``rows`` pairs of whole numbers are broadcast. Ids that repeat add at most as many rows again.
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), _declared(docs)).join(F.broadcast(first), "_id")
    sample = found.select("quality", "text", "declared").mapInArrow(_extract, "quality int, index array<int>, value array<float>")
    data = sample.limit(2 * rows).toArrow().to_pandas()
    order = sorted(range(len(data)), key=lambda i: (data["index"][i].tobytes(), int(data["quality"][i])))
    pairs = [(data["index"][i].astype(np.int64), data["value"][i].astype(float)) for i in order]
    return fit(pairs, data["quality"].to_numpy(float)[order])


def _declared(docs: DataFrame) -> Column:
    known = "n_chars" in docs.columns
    return (F.col("n_chars").cast("long") if known else F.lit(None).cast("long")).alias("declared")


def score(docs: DataFrame, model: Model, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size follows from WORD_BITS and FACTORS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for first, texts, declared in _batches(batch):
                scores = model.score(*features(texts, declared))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), pa.array(scores), pa.array(scores >= 0.5).cast(pa.int32())],
                    ["id", "score", "predicted"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _declared(docs))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows with a score of 0.5 or more, with their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text, known = docs.columns.index(text_col), "n_chars" in docs.columns
    chars = docs.columns.index("n_chars") if known else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            declared = np.full(batch.num_rows, -1)
            if known:
                declared = batch.column(chars).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            for first, texts in in_steps(batch.column(text)):
                part = slice(first, first + len(texts))
                good = model.score(*features(texts, declared[part])) >= 0.5
                yield batch.slice(first, len(texts)).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
