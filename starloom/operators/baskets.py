"""Association rules over baskets of distinct items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.exprs import pct, rounded_ratio
from starloom.workspace import Workspace

# Items of a basket that one task pairs with the whole basket, about.
PART_ITEMS = 200

# Buckets that pairs are screened by: one bit each, 16 MB in all.
PAIR_BUCKETS = 1 << 27


def item_counts(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("item").agg(F.count("*").alias("n"))


def _listed_pairs(
    baskets: DataFrame, frequency: DataFrame, min_pair: int, part_items: int, scratch: Workspace | None = None
) -> DataFrame:
    """item_a, item_b: a row for every basket that holds both, of items frequent enough.

    Each basket is cut into as many parts as its size asks for, one if it is small. Each part
    meets the whole basket under a key of its own, so the pairs of one basket are made
    by as many tasks, and no task holds more than a part's share of them. With ``scratch``, the baskets are written with
    their parts, for pairs that are listed more than once.
    """
    frequent = frequency.filter(F.col("n") >= min_pair).select("item")
    kept = baskets.join(frequent, "item")
    sizes = kept.groupBy("basket").agg(F.count("*").alias("n"))
    sized = kept.join(sizes, "basket").select(
        "basket", "item", F.ceil(F.col("n") / part_items).cast("int").alias("parts")
    )
    if scratch:
        sized = scratch.save(sized, "sized")
    part = F.pmod(F.xxhash64("item"), F.col("parts")).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    left = sized.select("basket", part, F.col("item").alias("item_a"))
    right = sized.select("basket", every, F.col("item").alias("item_b"))
    pairs = left.join(right, ["basket", "part"]).filter(F.col("item_a") < F.col("item_b"))
    return pairs.select("item_a", "item_b")


def _bucket(buckets: int) -> Column:
    """1 to ``buckets``, by the pair."""
    return F.pmod(F.xxhash64("item_a", "item_b"), F.lit(buckets)) + 1


def frequent_buckets(pairs: DataFrame, min_pair: int, buckets: int) -> DataFrame:
    """Bitmaps of the buckets that hold ``min_pair`` pairs or more, 4 KB for each 32,768 buckets."""
    counted = pairs.groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("n"))
    full = counted.filter(F.col("n") >= min_pair)
    return full.groupBy(F.bitmap_bucket_number("bucket").alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bucket")).alias("_bits")
    )


def in_frequent_buckets(pairs: DataFrame, maps: DataFrame, buckets: int) -> DataFrame:
    """The pairs whose bucket is marked.

    The bitmaps are broadcast: ``buckets`` bits and no more, 16 MB for 2^27 of them, whatever the data.
    """
    place = F.bitmap_bit_position(_bucket(buckets))
    byte = F.conv(F.hex(F.substring("_bits", F.expr("cast(_place div 8 AS int)") + 1, F.lit(1))), 16, 10)
    marked = F.expr("shiftright(_byte, cast(_place % 8 AS int)) & 1") == 1
    return (
        pairs.withColumn("_map", F.bitmap_bucket_number(_bucket(buckets)))
        .withColumn("_place", place)
        .join(F.broadcast(maps), "_map")
        .withColumn("_byte", byte.cast("int"))
        .filter(marked)
        .select("item_a", "item_b")
    )


def pair_counts(
    baskets: DataFrame,
    frequency: DataFrame,
    min_pair: int,
    *,
    part_items: int = PART_ITEMS,
    buckets: int | None = None,
    scratch: Workspace | None = None,
) -> DataFrame:
    """Pairs (item_a < item_b) that share at least ``min_pair`` baskets, with counts.

    ``baskets`` holds distinct (basket, item) rows of any type, ``frequency`` the baskets
    per item. An item in fewer than ``min_pair`` baskets is in no such pair and is left out.

    With ``buckets``, pairs are first counted by the bucket that they hash to, a number in place of two
    items. A bucket with fewer than ``min_pair`` pairs holds no pair of that many baskets, so
    only pairs of the other buckets are counted one by one. The result is the same.
    """
    screened = buckets and min_pair > 1
    pairs = _listed_pairs(baskets, frequency, min_pair, part_items, scratch if screened else None)
    if screened:
        maps = frequent_buckets(pairs, min_pair, buckets)
        pairs = in_frequent_buckets(pairs, scratch.save(maps, "pair-buckets") if scratch else maps, buckets)
    counted = pairs.groupBy("item_a", "item_b").agg(F.count("*").alias("n_pair"))
    return counted.filter(F.col("n_pair") >= min_pair)


def pairs_screened(
    baskets: DataFrame, frequency: DataFrame, min_pair: int, buckets: int, *, part_items: int = PART_ITEMS
) -> DataFrame:
    """One row: the different pairs listed, those left by the buckets, and those frequent enough."""
    pairs = _listed_pairs(baskets, frequency, min_pair, part_items)
    left = in_frequent_buckets(pairs, frequent_buckets(pairs, min_pair, buckets), buckets)
    counted = left.groupBy("item_a", "item_b").agg(F.count("*").alias("n_pair"))
    after = counted.agg(
        F.count("*").alias("listed_after"), F.count_if(F.col("n_pair") >= min_pair).alias("frequent")
    )
    before = pairs.groupBy("item_a", "item_b").agg(F.lit(1).alias("one"))
    total = before.agg(F.count("*").alias("listed_before"))
    return after.select(total.scalar().alias("listed_before"), "listed_after", "frequent")


def association_rules(
    baskets: DataFrame,
    min_pair: int,
    *,
    scratch: Workspace,
    support_digits: int = 3,
    part_items: int = PART_ITEMS,
    buckets: int | None = None,
) -> DataFrame:
    """Support, confidence in both directions and lift of the pairs above ``min_pair``."""
    baskets = scratch.save(baskets.select("basket", "item").distinct(), "baskets")
    frequency = scratch.save(item_counts(baskets), "items")
    total = baskets.agg(F.countDistinct("basket").alias("baskets")).first()
    pairs = pair_counts(
        baskets, frequency, min_pair, part_items=part_items, buckets=buckets, scratch=scratch
    )
    joined = (
        pairs.join(frequency.select(F.col("item").alias("item_a"), F.col("n").alias("n_a")), "item_a")
        .join(frequency.select(F.col("item").alias("item_b"), F.col("n").alias("n_b")), "item_b")
        .withColumn("n_baskets", F.lit(total.baskets))
    )
    wide_product = "CAST({} AS decimal(13,0)) * CAST({} AS decimal(13,0))"
    return joined.select(
        "item_a",
        "item_b",
        F.col("n_pair").alias("pair_baskets"),
        pct("n_pair", "n_baskets", support_digits).alias("support_pct"),
        pct("n_pair", "n_a", 2).alias("conf_a_to_b_pct"),
        pct("n_pair", "n_b", 2).alias("conf_b_to_a_pct"),
        rounded_ratio(
            wide_product.format("n_pair", "n_baskets"), wide_product.format("n_a", "n_b"), 3
        ).alias("lift"),
    )
