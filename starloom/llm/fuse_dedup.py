"""Exact duplicates between an immutable snapshot and a new batch, screened by binary-fuse filters.

The snapshot keeps one row per digest and, for each bucket of digests, one static filter. The digests
of a new batch, one row each, meet only their bucket's filter: what it rejects is surely new, what it
lets through is joined with the exact digests of the snapshot and then compared byte by byte. Rows of
the new batch that equal each other are grouped before all that.

Texts are equal when identical after all white space is deleted. Nulls count as empty. Of equal rows,
the one with the most code points stays, then the smallest id; a null id comes last, and of rows that
are equal in both, the first one as read. Empty texts are equal to each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import SPACE, as_row, mix64, no_text
from starloom.workspace import Workspace

#: Digests that one filter is made for, about; it then takes some 40 kB.
FILTER_KEYS = 32_768
FILTER_SCHEMA = "bucket long, seed long, segment int, segments int, prints binary"


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(no_text(text), f"{SPACE}+", "")


# The filter, after T. M. Graf and D. Lemire, "Binary Fuse Filters: Fast and Smaller Than Xor Filters".


def _positions(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three places of each key, in neighbouring segments, and its 8-bit fingerprint."""
    h = mix64(keys + np.uint64(seed))
    mask = np.uint64(segment - 1)
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third], 1).astype(np.int64), (h ^ (h >> np.uint64(40))).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, number of segments and fingerprints for distinct 64-bit keys."""
    n = max(len(keys), 2)
    segment = 1 << min(18, int(np.log(n) / np.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    segments = max(1, -(-int(n * factor) // segment) - 2 + 1)
    for seed in range(1, 1000):
        at, prints = _positions(keys, seed, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=size)
        holds = np.zeros(size, np.int64)
        np.bitwise_xor.at(holds, at.ravel(), np.repeat(np.arange(len(keys)), 3))
        rounds: list[tuple[np.ndarray, np.ndarray]] = []
        peeled = 0
        single = np.flatnonzero(count == 1)
        while len(single):
            which, first = np.unique(holds[single], return_index=True)
            rounds.append((which, single[first]))
            peeled += len(which)
            touched = at[which].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(holds, touched, np.repeat(which, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if peeled == len(keys):
            table = np.zeros(size, np.uint8)
            for which, place in reversed(rounds):
                others = table[at[which]]
                table[place] = prints[which] ^ others[:, 0] ^ others[:, 1] ^ others[:, 2] ^ table[place]
            return seed, segment, segments, table.tobytes()
    raise ValueError("no seed works: the keys are not distinct")


def probe(keys: np.ndarray, seed: int, segment: int, segments: int, prints: bytes) -> np.ndarray:
    at, want = _positions(keys, seed, segment, segments)
    got = np.frombuffer(prints, np.uint8)[at]
    return (got[:, 0] ^ got[:, 1] ^ got[:, 2]) == want


def _keys(series: pd.Series) -> np.ndarray:
    return series.to_numpy(np.int64).view(np.uint64)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    made = build_filter(np.unique(_keys(rows.key)))
    return pd.DataFrame([(rows.bucket.iloc[0], *made)], columns=["bucket", "seed", "segment", "segments", "prints"])


def _screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket, each bucket's filter before its digests; a bucket may span batches."""
    bucket, made = None, None
    for rows in batches:
        maybe = np.zeros(len(rows), bool)
        buckets, is_filter = rows.bucket.to_numpy(), rows.prints.notna().to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(rows)]
        for low, high in zip(cuts, cuts[1:]):
            if low < high and is_filter[low]:
                r = rows.iloc[low]
                bucket, made = buckets[low], (int(r.seed), int(r.segment), int(r.segments), r.prints)
                low += 1
            if low < high and bucket == buckets[low]:
                maybe[low:high] = probe(_keys(rows.key.iloc[low:high]), *made)
        yield pd.DataFrame({"digest": rows.digest[~is_filter], "maybe": maybe[~is_filter]})


@dataclass
class Snapshot:
    """Never changed once written: the groups (digest, n, best) and the filters of their buckets."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def _key(digest: str = "digest") -> Column:
    return F.conv(F.hex(F.substring(F.col(digest), 1, 7)), 16, 10).cast("long")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("best"))


def digests(docs: DataFrame, is_new: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, new, digest, and rank, which orders the rows of a group. Write it before use: it numbers rows."""
    text = no_text(text_col)
    rank = F.struct(
        (-F.length(text)).alias("longest"),
        F.col(id_col).isNull().alias("no_id"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("at"),
    )
    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(is_new, F.lit(False)).alias("new"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
        rank.alias("rank"),
    )


def write_snapshot(rows: DataFrame, scratch: Workspace, filter_keys: int = FILTER_KEYS) -> Snapshot:
    """rows: of digests(). Filters are made per bucket of about ``filter_keys`` digests."""
    groups = scratch.save(_grouped(rows), "snapshot")
    buckets = max(1, -(-groups.count() // filter_keys))
    keyed = groups.select(_key().alias("key")).withColumn("bucket", F.expr(f"pmod(xxhash64(key), {buckets})"))
    filters = scratch.save(keyed.groupBy("bucket").applyInPandas(_build, FILTER_SCHEMA), "filters")
    return Snapshot(groups, filters, buckets)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """digest, maybe: false where the snapshot surely lacks the digest."""
    incoming = groups.select(_key().alias("key"), "digest").withColumn(
        "bucket", F.expr(f"pmod(xxhash64(key), {snapshot.buckets})")
    )
    # No key is null: pandas would read whole numbers beside nulls as doubles.
    filters = snapshot.filters.withColumn("key", F.lit(0).cast("long"))
    both = filters.unionByName(incoming, allowMissingColumns=True)
    ordered = both.repartition("bucket").sortWithinPartitions("bucket", F.col("prints").isNull())
    return ordered.mapInPandas(_screen, "digest binary, maybe boolean")


def same_bytes(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The digests of ``pairs`` (digest, id) whose texts, of all the ids named, are one text."""
    found = (
        docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("plain"))
        .join(pairs.withColumnRenamed("id", "wanted"), F.col("id").eqNullSafe(F.col("wanted")))
        .where(F.unhex(F.sha2("plain", 256)) == F.col("digest"))
    )
    checked = found.groupBy("digest").agg(F.min("plain").alias("low"), F.max("plain").alias("high"))
    return checked.where("low = high").select("digest")


def exact_groups(
    docs: DataFrame,
    scratch: Workspace,
    is_new: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_keys: int = FILTER_KEYS,
) -> DataFrame:
    """For every row: id, digest, rank, keep (the rank of the row that stays), n, kept.

    ``is_new`` says of a row whether it belongs to the new batch; null counts as no.
    """
    rows = scratch.save(digests(docs, is_new, id_col, text_col), "digests")
    snapshot = write_snapshot(rows.where("not new"), scratch, filter_keys)
    batch = scratch.save(_grouped(rows.where("new")), "batch")
    maybe = screen(batch, snapshot).where("maybe").select("digest")
    old = snapshot.groups.select("digest", F.col("best").alias("old_best"))
    found = batch.join(maybe, "digest").join(old, "digest")
    pairs = found.selectExpr("digest", "inline(array(struct(best.id AS id), struct(old_best.id AS id)))")
    equal = same_bytes(pairs.distinct(), docs, id_col, text_col).withColumn("joined", F.lit(True))
    # A group of the batch joins that of the snapshot, or stands alone.
    merged = batch.join(equal, "digest", "left").select(
        "digest", "n", "best", F.lit(True).alias("new"), F.col("joined").isNull().alias("alone")
    )
    parts = snapshot.groups.select("digest", "n", "best", F.lit(False).alias("new"), F.lit(False).alias("alone"))
    whole = parts.unionByName(merged).groupBy("digest", "alone").agg(
        F.sum("n").alias("n"), F.min("best").alias("keep"), F.collect_set("new").alias("sides")
    )
    decided = whole.select("digest", "n", "keep", F.explode("sides").alias("new"))
    kept = F.col("rank").eqNullSafe(F.col("keep")).alias("kept")
    return rows.join(decided, ["digest", "new"]).select("id", "new", "digest", "rank", "keep", "n", kept)


def drop_copies(docs: DataFrame, scratch: Workspace, is_new: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns as they are."""
    rows = exact_groups(docs, scratch, is_new, id_col=id_col, text_col=text_col)
    stay = rows.where("kept").select(F.col("id").alias("stay"), F.col("digest"))
    whole = docs.select(F.col(id_col).alias("_id"), as_row(docs)).join(stay, F.col("_id").eqNullSafe(F.col("stay")))
    text = F.col("_row").getField(text_col)
    same = whole.where(F.unhex(F.sha2(normalised(text), 256)) == F.col("digest"))
    # Rows that repeat an id and a text are one here.
    first = F.expr("row_number() OVER (PARTITION BY _id, digest ORDER BY size DESC)")
    return same.withColumn("size", F.length(no_text(text))).withColumn("n", first).where("n = 1").select("_row.*")
