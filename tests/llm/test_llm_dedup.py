import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import SCHEMA, SPACE, odd_rows
from starloom.llm import fuse_dedup


def test_filter_holds_its_keys_and_rejects_nearly_all_others():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 1000, 40_000):
        keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        made = fuse_dedup.build_filter(keys)
        assert fuse_dedup.probe(keys, *made).all()
    others = rng.integers(2**63, 2**64, 100_000, dtype=np.uint64)
    assert fuse_dedup.probe(others, *made).mean() < 0.006
    assert len(made[3]) < 1.4 * len(keys)


@pytest.mark.parametrize("new", ["false", "true", "pmod(xxhash64(doc_id, text, source), 2) = 0", "null"])
def test_odd_rows_equal_a_plain_grouping(spark, scratch, new):
    data = odd_rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = fuse_dedup.exact_groups(docs, scratch, F.expr(new), filter_keys=4).collect()
    groups = {}
    for r in data:
        plain = SPACE.sub("", r[1] or "")
        groups.setdefault(hashlib.sha256(plain.encode()).digest(), []).append(r)
    assert len(got) == len(data)
    for digest, rows in groups.items():
        mine = [g for g in got if bytes(g.digest) == digest]
        keep = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        assert sorted(map(str, (g.id for g in mine))) == sorted(str(r[0]) for r in rows)
        assert {g.n for g in mine} == {len(rows)} and sum(g.kept for g in mine) == 1
        assert all(g.keep.id == keep for g in mine) and [g.id for g in mine if g.kept] == [keep]


def test_rows_that_stay_keep_their_columns(spark, scratch):
    data = odd_rows()
    docs = spark.createDataFrame(data, SCHEMA)
    kept = fuse_dedup.drop_copies(docs, scratch, F.expr("doc_id % 2 = 0"))
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert len(rows) == len({SPACE.sub("", r[1] or "") for r in data}) and set(rows) <= set(data)


def test_empty_tables(spark, scratch):
    docs = spark.createDataFrame([], SCHEMA)
    assert fuse_dedup.exact_groups(docs, scratch, F.lit(True)).count() == 0
    assert fuse_dedup.drop_copies(docs, scratch, F.lit(False)).count() == 0


def test_equal_digests_of_other_bytes_are_not_one_text(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    digest = bytearray(hashlib.sha256(b"ab").digest())
    pairs = spark.createDataFrame([(digest, 1), (digest, 2)], "digest binary, id long")
    assert fuse_dedup.same_bytes(pairs, docs, "doc_id", "text").count() == 1
