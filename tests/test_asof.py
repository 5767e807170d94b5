"""The carrying point-in-time join against the plain one, also with a hot key."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators.asof import carry_versions

DAY = date(2020, 1, 1)
VERSIONS = "version_key long, who long, since date, until date"
EVENTS = "event long, who long, day date, version_note string"


def joined(spark, scratch, versions, events, splits=None):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if splits:
        spark.conf.set("spark.sql.shuffle.partitions", splits)
    try:
        got = carry_versions(
            versions, events, key="who", valid_from="since", valid_to="until", at="day", ties=["event"], scratch=scratch
        )
        assert got.columns == [*events.columns, "version"]
        return sorted((r.event, r.version.version_key) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plain(versions, events):
    return sorted(
        (e, k)
        for e, who, day, _ in events
        for k, w, since, until in versions
        if w == who and w is not None and day and since and since <= day and (until is None or day < until)
    )


@pytest.mark.parametrize("splits", [1, 3, 50])
def test_equals_the_plain_join(spark, scratch, splits):
    rng = random.Random(splits)
    versions, key = [], 0
    for who in range(12):
        days = sorted(rng.sample(range(400), rng.randint(0, 9)))
        for i, d in enumerate(days):
            end = days[i + 1] if i + 1 < len(days) else None
            # Some histories have a gap, some end.
            end = end - 1 if end and end - d > 9 and rng.random() < 0.3 else end
            end = d + 5 if end is None and rng.random() < 0.3 else end
            key += 1
            versions.append((key, who, DAY + timedelta(d), None if end is None else DAY + timedelta(end)))
    versions += [(900, 3, DAY, DAY), (901, None, DAY, None), (902, 4, None, None)]
    events = [(i, rng.randrange(14), DAY + timedelta(rng.randrange(-5, 420)), "x") for i in range(600)]
    events += [(700, None, DAY, "x"), (701, 3, None, "x"), (702, 77, DAY, None)]
    events += [(800 + i, 5, DAY + timedelta(200), "same day") for i in range(60)]
    got = joined(spark, scratch, spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(events, EVENTS), splits)
    assert got == plain(versions, events)


def test_empty_sides(spark, scratch):
    some_v = spark.createDataFrame([(1, 1, DAY, None)], VERSIONS)
    some_e = spark.createDataFrame([(1, 1, DAY, "x")], EVENTS)
    assert joined(spark, scratch, some_v.limit(0), some_e) == joined(spark, scratch, some_v, some_e.limit(0)) == []


def test_a_hot_key_costs_the_sum_of_both_sides(spark, scratch):
    """One customer of 10,000 versions and 100,000 orders: the product would be a thousand million pairs."""
    versions = spark.range(10_000).selectExpr(
        "id AS version_key", "7L AS who", "date_add(date'1990-01-01', cast(id AS int)) AS since",
        "if(id = 9999, null, date_add(date'1990-01-01', cast(id AS int) + 1)) AS until",
    )
    events = spark.range(100_000).selectExpr(
        "id AS event", "7L AS who", "date_add(date'1990-01-01', cast(id % 10500 AS int)) AS day", "'' AS version_note"
    )
    got = carry_versions(
        versions, events, key="who", valid_from="since", valid_to="until", at="day", ties=["event"], scratch=scratch
    )
    wrong = got.where(F.col("version.version_key") != F.least(F.col("event") % 10500, F.lit(9999)))
    assert got.count() == 100_000 and wrong.count() == 0
    # Spread over splits, none of which holds most of the key.
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 60_000
