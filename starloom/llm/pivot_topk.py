"""Exact top-k search by integer inner product, with candidates eliminated through a pivot table.

Components are turned into floor(scale * x). The table holds, for every vector, its squared length and its
distances to the pivots. For a query q and a candidate c, the distance of both is at least the largest
difference of their distances to a pivot, so their inner product, half of |q|^2 + |c|^2 - d(q, c)^2, has an
upper bound. Candidates are evaluated in order of their bounds, in portions that double, until the next bound lies
below the k-th best score: that is exact.

Queries and candidates meet in blocks of bounded size: every block of queries with every block of candidates
of the same dimension. Each pair of blocks is one group; its best k per query are merged afterwards.

The pivots are picked from a sample of at most ``SAMPLE`` vectors, the first by a digest of their id, each as far as
possible from those before. The bounds hold for any pivots.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. Of rows
that share an id, the smallest vector counts. Vectors of another dimension than the query's are no candidates. Scores that
do not fit into 64 bits stand at the nearest number that does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import whole_groups
from starloom.workspace import Workspace

SAMPLE, PIVOTS = 512, 16
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4_096
#: Candidates that a query evaluates before it compares bounds.
FIRST = 64
SCALE = 1024
TABLE = "vec_id long, dim int, vector array<double>, square double, distances array<double>"


def whole_components(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64))


def choose_pivots(sample: list[np.ndarray], count: int = PIVOTS) -> dict[int, np.ndarray]:
    """By dimension, vectors of the sample that lie far from each other."""
    out = {}
    for dim in {len(v) for v in sample}:
        same = [v for v in sample if len(v) == dim]
        vectors = np.array(same).reshape(len(same), dim)
        picked = [0]
        nearest = ((vectors - vectors[0]) ** 2).sum(1)
        while len(picked) < min(count, len(vectors)) and nearest.max() > 0:
            picked.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, ((vectors - vectors[picked[-1]]) ** 2).sum(1))
        out[dim] = vectors[picked]
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector: one for each id, without null or non-finite components."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(F.coalesce(finite, F.lit(False)))
    return rows.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(F.col(vector_col).cast("array<double>")).alias("vector"))


def write_table(vectors: DataFrame, scratch: Workspace, scale: int = SCALE) -> DataFrame:
    """The pivot table of all vectors (vec_id, vector)."""
    rows = scratch.save(vectors, "vectors")
    sample = rows.orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(SAMPLE).collect()
    pivots = choose_pivots([whole_components(np.array(r.vector, float), scale) for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("vector")
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = whole_components(lists.flatten().to_numpy(zero_copy_only=False), scale)
            starts = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = flat[(starts[at][:, None] + np.arange(dim)).ravel()].reshape(len(at), dim)
                p = pivots.get(dim, np.zeros((0, dim)))
                distances = np.stack([np.sqrt(((x - v) ** 2).sum(1)) for v in p], 1) if len(p) else np.zeros((len(at), 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at)),
                        pa.array(np.full(len(at), dim), pa.int32()),
                        _lists(x),
                        pa.array((x**2).sum(1)),
                        _lists(distances),
                    ],
                    ["vec_id", "dim", "vector", "square", "distances"],
                )

    return scratch.save(rows.mapInArrow(run, TABLE), "pivots")


def _lists(x: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).ravel()))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, one row of ``a`` with all of ``b``."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, len(a))
    if largest < 2.0**53:
        return (b @ a).astype(np.int64)
    whole = np.array([[int(y) for y in row] for row in b], object).reshape(b.shape).dot(np.array([int(y) for y in a], object))
    return np.array([min(max(int(v), -(2**63)), 2**63 - 1) for v in np.atleast_1d(whole)], np.int64)


def best_of_block(queries: tuple, candidates: tuple, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """query id, the ids and the scores of its k best candidates; both sides: ids, vectors, squares, distances."""
    q_ids, q, q_square, q_distances = queries
    c_ids, c, c_square, c_distances = candidates
    for i in range(len(q_ids)):
        least = np.abs(c_distances - q_distances[i]).max(1) if c_distances.shape[1] else np.zeros(len(c_ids))
        # Wider by what rounding can take away.
        spread = max(q_distances[i].max(initial=0), c_distances.max(initial=0)) ** 2
        slack = 1 + 1e-9 * (q_square[i] + c_square.max(initial=0) + spread)
        bound = (q_square[i] + c_square - least**2) / 2 + slack
        bound[c_ids == q_ids[i]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        order = order[: int((bound > -np.inf).sum())]
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, portion = 0, max(FIRST, k)
        while done < len(order) and (len(ids) < k or bound[order[done]] >= scores[-1]):
            at = order[done : done + portion]
            ids = np.concatenate((ids, c_ids[at]))
            scores = np.concatenate((scores, _products(q[i], c[at])))
            top = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -(2**63) else -scores))[:k]
            ids, scores = ids[top], scores[top]
            done, portion = done + portion, 2 * portion
        yield int(q_ids[i]), ids, scores


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["pair"]):
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for low, high in zip(cuts, cuts[1:]):
                group = rows.slice(low, high - low)
                is_query = group.column("is_query").to_numpy()
                ids, square = group.column("vec_id").to_numpy(), group.column("square").to_numpy()
                vector, distances = _matrix(group.column("vector"), len(ids)), _matrix(group.column("distances"), len(ids))
                sides = [(ids[m], vector[m], square[m], distances[m]) for m in (is_query, ~is_query)]
                out += best_of_block(*sides, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(o[1] for o in out)])),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(o[2] for o in out)])),
                ],
                ["query_id", "vec_id", "score"],
            )

    return run


def top_k(
    vectors: DataFrame,
    scratch: Workspace,
    is_query: Column,
    k: int,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is told from ``vec_id``."""
    table = write_table(usable(vectors, id_col, vector_col), scratch, scale)
    queries = table.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    parts = max(1, -(-table.count() // CANDIDATE_BLOCK))

    def spread(rows: DataFrame, own: int, others: int, query: bool) -> DataFrame:
        """Each row in its own block, beside every block of the other side."""
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(own))
        theirs = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("theirs")
        placed = rows.select("*", mine.cast("int").alias("mine"), theirs)
        pair = F.concat_ws("-", "dim", *(("mine", "theirs") if query else ("theirs", "mine")))
        return placed.select(pair.alias("pair"), F.lit(query).alias("is_query"), "vec_id", "vector", "square", "distances")

    both = spread(queries, blocks, parts, True).union(spread(table, parts, blocks, False))
    ordered = both.repartition("pair").sortWithinPartitions("pair")
    found = ordered.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
