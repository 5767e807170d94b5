"""Hard negatives by exact integer scores from float32 products in a residue number system.

Components are turned into floor(scale * x). A block of anchors meets a block of candidates in one matrix product for each
of several small primes: both matrices are reduced to centred residues, multiplied in float32, where every partial sum is a
whole number below 2^24 and so exact, and reduced again. The signed inner products come back from the residues by Chinese
remaindering (Garner's mixed radix). The primes of a block are as many as its largest possible product asks for, by the
Cauchy-Schwarz bound; long vectors are multiplied in sections short enough for float32.

Two rounds of blocks, each followed by a window: the best positives of every anchor among the rows of its label, then, for
each anchor and positive, the best rows of other labels whose score lies between ``low`` percent and all of the positive's.
A block gives back a few rows for each anchor, or anchor and positive, so that a window reads a few rows for each block.
Blocks have a bounded number of rows, dealt by a digest of the id; a label with a third of all rows is more blocks.

Rows without an id, with a null label or vector, or with a component that is null, not finite, or not finite when scaled,
take no part. Of rows that share an id, that with the smallest vector, then label counts. Vectors of another dimension than the anchor's are
no candidates; vectors of no dimension score 0. Scores that do not fit into 64 bits stand at the nearest number that does.
Ties go to the smaller id. An anchor without another row of its label, and a positive without a row in its range, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import whole_groups
from starloom.workspace import Workspace

ANCHOR_BLOCK, CANDIDATE_BLOCK = 1_024, 8_192
#: Anchors of a block that are scored together: bounds the score matrix.
SLICE = 128
SCALE = 256
#: Whole numbers up to here are exact in float32.
EXACT = 2**24
LEAST, MOST = -(2**63), 2**63 - 1
KEYS = ["dim", "label", "a", "c"]


def primes() -> Iterator[int]:
    """251 and the odd primes below it, largest first, then those above."""
    below = [p for p in range(3, 252, 2) if all(p % d for d in range(3, int(p**0.5) + 1, 2))]
    yield from reversed(below)
    yield from (p for p in count(253, 2) if all(p % d for d in range(3, int(p**0.5) + 1, 2)))


def enough_primes(bound: float | int) -> list[int]:
    """So many primes that products of up to ``bound`` either way lie far from half of their range."""
    taken, reach = [], 1
    for p in primes():
        taken.append(p)
        reach *= p
        if reach > 4 * bound:
            return taken
    raise AssertionError


def residue_product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, from 0 to p - 1, in float32 products of centred residues; whole float64 numbers in."""
    half = p // 2
    x, y = ((np.mod(m, p) + half) % p - half for m in (a, b))
    x, y = x.astype(np.float32), y.astype(np.float32)
    section = EXACT // (half * half)
    out = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], section):
        part = x[:, at : at + section] @ y[:, at : at + section].T
        out += part.astype(np.int32) % p
    return out % p


def _norm(m: np.ndarray) -> int:
    """No less than the length of the longest row."""
    top = float(np.abs(m).max(initial=1))
    return int(top) * (int(1024 * np.sqrt(((m / top) ** 2).sum(1).max(initial=0))) + 2) // 1024 + 1


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of whole float64 numbers; beyond 64 bits the nearest number that fits."""
    bound = _norm(a) * _norm(b)
    moduli = enough_primes(bound)
    digits: list[np.ndarray] = []
    for k, p in enumerate(moduli):
        digit = residue_product(a, b, p).astype(np.int64)
        for q, d in zip(moduli, digits):
            digit = (digit - d) * pow(q, -1, p) % p
        digits.append(digit)
    if bound >= 2**62:
        return _large(digits, moduli)
    whole, near, weight = np.zeros((len(a), len(b)), np.uint64), np.zeros((len(a), len(b))), 1
    for d, p in zip(digits, moduli):
        # Modulo 2^64, which the signed result fits; the doubles tell which half of the range it lies in.
        whole += d.astype(np.uint64) * np.uint64(weight % 2**64)
        near += d * float(weight)
        weight *= p
    whole[near > weight / 2] -= np.uint64(weight % 2**64)
    return whole.view(np.int64)


def _large(digits: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    whole, weight = np.zeros(digits[0].shape, object), 1
    for d, p in zip(digits, moduli):
        whole = whole + d.astype(object) * weight
        weight *= p
    whole = np.where(whole > weight // 2, whole - weight, whole)
    return np.clip(whole, LEAST, MOST).astype(np.int64)


def best_places(values: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k highest allowed values; equal ones by column."""
    held = np.where(allowed, values, LEAST)
    if held.shape[1] > k:
        least = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        allowed = allowed & (held >= least[:, None])
    row, column = np.nonzero(allowed)
    # The complement orders from high to low without overflow.
    order = np.lexsort((column, ~values[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label, dim and the scaled components: one row for each id."""
    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    kept = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    one = kept.groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("v"))
    return one.select("vec_id", F.col("v.label").alias("label"), F.size("v.vector").alias("dim"), F.col("v.vector").alias("vector"))


def packed(rows: DataFrame, scale: int) -> DataFrame:
    """The scaled components as bytes: 16-bit numbers where they fit, doubles else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            parts = np.split(flat, ends[:-1])
            cells = [(v.astype(np.int16) if np.abs(v).max(initial=0) < 2**15 else v).tobytes() for v in parts]
            names = ["vec_id", "label", "dim"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(cells, pa.binary())], [*names, "cells"])

    return rows.mapInArrow(run, "vec_id long, label long, dim int, cells binary")


def _matrix(cells: list[bytes], dim: int) -> np.ndarray:
    rows = [np.frombuffer(c, np.int16 if len(c) == 2 * dim else np.float64) for c in cells]
    return np.array(rows, np.float64).reshape(len(cells), dim)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table, int]]:
    """Anchors and candidates of one pair of blocks, the candidates in order of their ids, and the dimension."""
    for rows, cuts in whole_groups(batches, KEYS):
        for low, high in zip(cuts, cuts[1:]):
            group = rows.slice(low, high - low)
            is_anchor = group.column("is_anchor")
            anchors = group.filter(is_anchor)
            others = group.filter(pc.invert(is_anchor)).sort_by("vec_id")
            if anchors.num_rows and others.num_rows:
                yield anchors, others, group.column("dim")[0].as_py()


def _scored(anchors: pa.Table, others: pa.Table, dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    b = _matrix(others.column("cells").to_pylist(), dim)
    for at in range(0, anchors.num_rows, SLICE):
        part = anchors.slice(at, SLICE)
        yield part, scores(_matrix(part.column("cells").to_pylist(), dim), b)


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, others, dim in _groups(batches):
            ids = others.column("vec_id").to_numpy()
            for part, found in _scored(anchors, others, dim):
                own = part.column("vec_id").to_numpy()
                row, column = best_places(found, own[:, None] != ids[None, :], k)
                yield pa.RecordBatch.from_pydict({"anchor_id": own[row], "positive_id": ids[column], "positive_score": found[row, column]})

    return run


def _negatives(k: int, low: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, others, dim in _groups(batches):
            ids, labels = others.column("vec_id").to_numpy(), others.column("own_label").to_numpy()
            for part, found in _scored(anchors, others, dim):
                own = part.column("own_label").to_numpy()
                positives = part.column("positives").to_pylist()
                for turn in range(max(map(len, positives))):
                    at = np.array([i for i, p in enumerate(positives) if len(p) > turn])
                    turned = [positives[i][turn] for i in at]
                    most = np.array([p["score"] for p in turned], np.int64)
                    least = np.array([max(LEAST, min(MOST, -(-low * p["score"] // 100))) for p in turned], np.int64)
                    near = found[at]
                    allowed = (near >= least[:, None]) & (near <= most[:, None]) & (own[at][:, None] != labels[None, :])
                    row, column = best_places(near, allowed, k)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "anchor_id": part.column("vec_id").to_numpy()[at][row],
                            "positive_id": np.array([p["id"] for p in turned], np.int64)[row],
                            "positive_score": most[row],
                            "negative_id": ids[column],
                            "negative_score": near[row, column],
                        }
                    )

    return run


def _meet(anchors: DataFrame, candidates: DataFrame, carried: list[str]) -> DataFrame:
    """Each pair of blocks as one sorted group. Both sides: columns a_blocks, c_blocks, dim, label and what is carried."""

    def placed(rows: DataFrame, mine: str, theirs: str, is_anchor: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("vec_id"), F.col(f"{mine}_blocks")).alias(mine)
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{theirs}_blocks") - 1)).alias(theirs)
        return rows.select("*", own, other, F.lit(is_anchor).alias("is_anchor")).select(*KEYS, "is_anchor", *carried)

    both = placed(anchors, "a", "c", True).unionByName(placed(candidates, "c", "a", False))
    return both.repartition(*KEYS).sortWithinPartitions(*KEYS)


def _blocks(n: Column, most: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / most)).cast("long")


def hard_negatives(
    vectors: DataFrame,
    scratch: Workspace,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``is_anchor`` is told from ``vec_id``."""
    rows = scratch.save(packed(usable(vectors, id_col, vector_col, label_col, scale), scale), "whole")
    anchors = rows.where(is_anchor)

    # Positives: blocks within a label, as many as its rows ask for. One row for each label and dimension.
    per_label = rows.groupBy("dim", "label").agg(
        _blocks(F.count_if(is_anchor), ANCHOR_BLOCK).alias("a_blocks"), _blocks(F.count("*"), CANDIDATE_BLOCK).alias("c_blocks")
    )
    sized = scratch.save(per_label, "labels")
    same = _meet(anchors.join(sized, ["dim", "label"]), rows.join(sized, ["dim", "label"]), ["vec_id", "cells"])
    found = same.mapInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    # At most ``positives`` entries each.
    lists = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("n", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    armed = scratch.save(anchors.join(lists, anchors["vec_id"] == lists["anchor_id"]).drop("anchor_id"), "anchors")

    # Negatives: blocks over all labels.
    sizes = {"a_blocks": _blocks(F.lit(armed.count()), ANCHOR_BLOCK), "c_blocks": _blocks(F.lit(rows.count()), CANDIDATE_BLOCK)}

    def over_all(side: DataFrame) -> DataFrame:
        return side.withColumns(sizes).withColumn("own_label", F.col("label")).withColumn("label", F.lit(0).cast("long"))

    nobody = F.lit(None).cast(armed.schema["positives"].dataType)
    met = _meet(over_all(armed), over_all(rows.withColumn("positives", nobody)), ["vec_id", "own_label", "cells", "positives"])
    mined = met.mapInArrow(
        _negatives(negatives, low), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
