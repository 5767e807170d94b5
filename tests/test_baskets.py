"""Association rules against a brute-force count in plain Python."""

from collections import Counter
from decimal import Decimal
from itertools import combinations

import pytest

from starloom.operators.baskets import association_rules, item_counts, pair_counts, pairs_screened

SCHEMA = "basket long, item long"


def baskets_with_huge_ones():
    """Many small baskets and three that hold a third of all rows each or nearly so."""
    small = [(b, (b * k) % 23) for b in range(60) for k in (1, 3, 5, 7)]
    huge = [(1000 + h, i) for h in range(3) for i in range(0, 200, h + 1)]
    return sorted(set(small + huge))


def brute_force(rows, least):
    by_basket = {}
    for basket, item in rows:
        by_basket.setdefault(basket, set()).add(item)
    counts = Counter(p for s in by_basket.values() for p in combinations(sorted(s), 2))
    return {p: n for p, n in counts.items() if n >= least}


@pytest.mark.parametrize("least", [1, 2, 4])
@pytest.mark.parametrize("part_items", [10, 1000])
@pytest.mark.parametrize("buckets", [None, 1, 7, 40_000, 1 << 27])
def test_pairs_equal_brute_force(spark, least, part_items, buckets):
    rows = baskets_with_huge_ones()
    df = spark.createDataFrame(rows, SCHEMA)
    got = pair_counts(df, item_counts(df), least, part_items=part_items, buckets=buckets).collect()
    assert {(r.item_a, r.item_b): r.n_pair for r in got} == brute_force(rows, least)


def test_text_ids_and_a_basket_of_5000_items(spark, scratch):
    rows = [("huge", f"i{k:04}") for k in range(5000)]
    rows += [(f"b{b}", f"i{(b * k) % 5003:04}") for b in range(40) for k in (1, 7, 30)]
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "basket string, item string")
    rules = association_rules(df, 2, scratch=scratch).collect()
    assert {(r.item_a, r.item_b): r.pair_baskets for r in rules} == brute_force(rows, 2)


def test_rule_measures(spark, scratch):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (3, 20), (4, 30), (1, 10)], SCHEMA)
    rule = association_rules(df, 1, scratch=scratch).first()
    assert (rule.item_a, rule.item_b, rule.pair_baskets) == (10, 20, 1)
    assert (rule.support_pct, rule.conf_a_to_b_pct, rule.conf_b_to_a_pct, rule.lift) == (
        Decimal("25.000"), Decimal("50.00"), Decimal("50.00"), Decimal("1.000"),
    )


def test_buckets_leave_few_pairs_to_count(spark):
    rows = baskets_with_huge_ones()
    df = spark.createDataFrame(rows, SCHEMA)
    every, wanted = brute_force(rows, 1), brute_force(rows, 4)
    frequent = {i for i, n in Counter(i for _, i in rows).items() if n >= 4}
    listed = sum(1 for a, b in every if a in frequent and b in frequent)
    got = pairs_screened(df, item_counts(df), 4, 1 << 20).first()
    assert (got.listed_before, got.frequent) == (listed, len(wanted))
    assert len(wanted) <= got.listed_after < listed
    # One bucket screens nothing and loses nothing.
    got = pairs_screened(df, item_counts(df), 4, 1).first()
    assert (got.listed_before, got.listed_after, got.frequent) == (listed, listed, len(wanted))


def test_listed_baskets_are_joined_once_for_both_counts(spark, scratch):
    """With a folder to write to, screening and counting read the same stored rows: no join by basket is left to do again."""
    rows = [(b, i) for b in range(40) for i in (b % 5, b % 7 + 10, b % 3 + 20)]
    baskets = scratch.save(spark.createDataFrame(rows, "basket long, item long"), "given")
    counted = pair_counts(baskets, item_counts(baskets), 2, buckets=1 << 10, scratch=scratch)
    read = counted.inputFiles()
    assert any("sized" in f for f in read) and not any("given" in f for f in read)
    assert {(r.item_a, r.item_b): r.n_pair for r in counted.collect()} == brute_force(rows, 2)
