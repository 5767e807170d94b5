"""Late changes against a plain reading of the same notices, and what they leave of the checks."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import late
from starloom.operators.dimensions import highest_key
from starloom.plans import catalog
from starloom.plans.warehouse import open_warehouse
from test_validation import failures

DAY = date(2020, 1, 1)
DIM = "customer_key long, customer_id long, full_name string, city string, mail string, valid_from date, valid_to date, is_current boolean"
NOTICE = "customer_id long, changed_on date, city string, mail string, note string"


def day(n):
    return None if n is None else DAY + timedelta(days=n)


def apply(spark, scratch, dim, notices):
    told = spark.createDataFrame([(k, day(d), c, m, "x") for k, d, c, m in notices], NOTICE)
    return late.apply_late_changes(
        dim, told, natural="customer_id", surrogate="customer_key", changed_on="changed_on", tracked=["city", "mail"], scratch=scratch
    )


def plain(versions, notices):
    """(customer, from, to, city, mail, current) of all versions, and the refused notices."""
    best = {}
    for k, d, c, m in notices:
        rank = (c is not None, c or "", m is not None, m or "")
        if (k, d) not in best or rank > best[k, d][0]:
            best[k, d] = (rank, c, m)
    out, refused = [], []
    used = set()
    for _, k, name, city, mail, since, until, current in versions:
        if until is not None and since >= until:
            out.append((k, since, until, city, mail, current, name))
            continue
        mine = sorted(
            (d, v[1], v[2]) for (kk, d), v in best.items()
            if kk is not None and d is not None and kk == k and since <= d and (until is None or d < until)
        )
        used |= {(k, d) for d, _, _ in mine}
        chain = [(since, city, mail)]
        for d, c, m in mine:
            if d == since:
                chain[-1] = (d, c, m)
            elif (c, m) != chain[-1][1:]:
                chain.append((d, c, m))
        for here, after in zip(chain, [*chain[1:], None]):
            out.append((k, here[0], after[0] if after else until, here[1], here[2], current and after is None, name))
    refused = [key for key in best if key not in used]
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(out, key=key), sorted(refused, key=key)


def seen(result):
    key = lambda r: tuple((x is not None, x) for x in r)
    n = lambda d: None if d is None else (d - DAY).days
    rows = [
        (r.customer_id, n(r.valid_from), n(r.valid_to), r.city, r.mail, r.is_current, r.full_name)
        for r in result.dimension.collect()
    ]
    refused = [(r.customer_id, n(r.changed_on)) for r in result.refused.collect()]
    return sorted(rows, key=key), sorted(refused, key=key)


def history_of(rng, customers):
    rows, number = [], 0
    for k in range(customers):
        edges = sorted(rng.sample(range(60), rng.randint(1, 4)))
        for i, (a, b) in enumerate(zip(edges, [*edges[1:], None])):
            number += 1
            rows.append((number, k, f"n{k}", rng.choice("PQ"), rng.choice([None, "a"]), a, b, b is None))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_reading(spark, scratch, seed):
    rng = random.Random(seed)
    versions = history_of(rng, 12) + [(900, 3, "n3", "P", None, 70, 70, False)]
    notices = [
        (rng.choice([None, *range(14)]), rng.choice([None, *range(90)]), rng.choice(["P", "Q", None]), rng.choice([None, "a", "b"]))
        for _ in range(150)
    ]
    # One customer has a third of all notices.
    notices += [(5, d, rng.choice("PQRS"), "h") for d in range(0, 150, 2)]
    dim = scratch.save(
        spark.createDataFrame([(s, k, f, c, m, day(a), day(b), o) for s, k, f, c, m, a, b, o in versions], DIM), "dim"
    )
    result = apply(spark, scratch, dim, notices)
    assert seen(result) == plain(versions, notices)
    whole = scratch.save(result.dimension, "whole")
    assert whole.select("customer_key").distinct().count() == whole.count()
    assert whole.filter("change = 'inserted'").count() == result.moves.count()
    # Known keys stay with the beginning of their version, and the same notices change nothing more.
    starts = {(r.customer_key, r.valid_from) for r in whole.filter("change <> 'inserted'").collect()}
    assert starts == {(v[0], day(v[5])) for v in versions}
    again = apply(spark, scratch, whole.drop("change"), notices)
    assert again.dimension.filter("change <> 'kept'").count() == again.moves.count() == 0


def test_no_notices_and_an_empty_dimension(spark, scratch):
    dim = spark.createDataFrame([(1, 1, "n", "P", None, day(0), None, True)], DIM)
    assert [r.change for r in apply(spark, scratch, dim, []).dimension.collect()] == ["kept"]
    result = apply(spark, scratch, dim.limit(0), [(1, 3, "P", None)])
    assert (result.dimension.count(), result.moves.count(), result.refused.count()) == (0, 0, 1)


def test_checks_hold_after_a_late_change_and_other_months_stay(spark):
    w = open_warehouse(spark, "/root/testdata/sf0.001")
    result = catalog.late_changes(w)
    customers = w.scratch.save(result.dimension.drop("change"), "late-customers")
    moved = w.scratch.save(late.moved_facts(w.fact_sales, result.moves, surrogate="customer_key", scratch=w.scratch), "moved")
    assert moved.count() > 0
    fact = w.fact_sales.join(moved.select("sales_key", F.col("customer_key").alias("_new")), "sales_key", "left")
    fact = fact.withColumn("customer_key", F.coalesce("_new", "customer_key")).drop("_new")
    # Just the rows of the cut intervals: all others would be given the key they have.
    placed = w.scratch.save(fact, "late-fact").join(customers, "customer_key")
    on = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    assert placed.filter((on < F.col("valid_from")) | (on >= F.col("valid_to"))).count() == 0
    assert moved.filter(F.col("customer_key") <= highest_key(w.dim_customer, "customer_key")).count() == 0
    star = {**w.star(), "scratch": w.scratch, "dim_customer": customers, "fact_sales": w.scratch.save(fact, "late-fact")}
    source = {t: w.scratch.save(df, f"src-{t}") for t, df in w.source().items()}
    # The source knows nothing of the notices, so current attributes differ (57); nothing else does.
    assert failures(star, source, w.calendar) <= {57}
