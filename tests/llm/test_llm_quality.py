import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plain import SCHEMA, odd_rows
from starloom.llm import fm_quality as fm
from starloom.llm.common import table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return fm.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))


def test_held_out_accuracy(spark, model):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    scored = fm.score(docs, model).join(labels, F.col("id") == F.col("doc_id")).where(fm.is_held_out("id"))
    rows = [(r.score, r.predicted, r.quality) for r in scored.collect()]
    assert len(rows) > 100 and np.mean([p == q for _, p, q in rows]) > 0.97
    good, bad = ([s for s, _, q in rows if q == want] for want in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.99


def test_score_equals_the_sum_over_all_pairs(model):
    texts = [(r[1] or "").encode() for r in odd_rows()]
    index, values, at = fm.features(texts, np.full(len(texts), 3))
    got = model.raw(index, values, at)[0]
    for k, (low, high) in enumerate(zip(at, at[1:])):
        i, x = index[low:high], values[low:high]
        products = (model.factors[i] @ model.factors[i].T) * np.outer(x, x)
        want = model.bias + model.weights[i] @ x + np.triu(products, 1).sum()
        assert got[k] == pytest.approx(want, abs=1e-9)


def test_odd_rows_and_folds(spark, model):
    docs = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    rows = fm.score(docs, model).withColumn("held_out", fm.is_held_out("id")).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 3 == 1)
    again = {(r.id, r.score) for r in fm.score(docs.repartition(1), model).collect()}
    assert again == {(r.id, r.score) for r in rows}


def test_labels_of_the_held_out_fold_change_nothing(spark, model):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    turned = F.when(fm.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    other = fm.train(docs, labels.withColumn("quality", turned))
    assert np.array_equal(other.weights, model.weights) and np.array_equal(other.factors, model.factors)


def test_no_usable_labels(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 1), (9, 7)], "doc_id long, quality int")
    model = fm.train(docs, labels)
    assert {r.score for r in fm.score(docs, model).collect()} == {0.5}
    assert fm.keep_good(docs, model).count() == len(odd_rows())


def test_filter_keeps_columns_and_empty_tables(spark, model):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    kept = fm.keep_good(docs, model)
    good = sorted(str(r.id) for r in fm.score(docs, model).collect() if r.predicted)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == good
    empty = spark.createDataFrame([], SCHEMA)
    assert fm.keep_good(empty, model).count() == 0 and fm.score(empty, model).count() == 0


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = [b"aa bb " + b"c" * 40, b"", b" \n ", b"one", "é ü".encode(), b"x" * 300 + b" y", b"short words only here", b""]
    alone = [fm.features([t], np.array([-1])) for t in texts]
    for order in itertools.permutations(range(len(texts)), 4):
        index, value, at = fm.features([texts[i] for i in order], np.full(4, -1))
        for k, i in enumerate(order):
            assert (index[at[k] : at[k + 1]] == alone[i][0]).all() and np.allclose(value[at[k] : at[k + 1]], alone[i][1])


def test_query_scores_alike_however_rows_are_dealt(spark):
    docs, labels = (table(spark, FOLDER, t) for t in ("documents", "labels"))
    model = fm.train(docs, labels)
    one, seven = (fm.score(docs.repartition(n), model).orderBy("id").collect() for n in (1, 7))
    assert one == seven
