"""Each stage against a plain version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from plain import FOLDER, SPACE, near_components, place, targets, words
from starloom.llm import fm_quality
from starloom.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, scratch):
    docs = table(spark, FOLDER, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.save(stage(spark, out[-1], FOLDER), "stage"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1]) and len(corpus_pipeline.STAGES) == 5


def test_quality(spark, stages):
    model = fm_quality.train(stages[0], table(spark, FOLDER, "labels"))
    good = {r.id for r in fm_quality.score(stages[0], model).collect() if r.score >= 0.5}
    assert rows(stages[1]) == [r for r in rows(stages[0]) if r[0] in good]
    quality = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    kept = [i in good for i, q in quality.items() if q == 1]
    assert sum(kept) / len(kept) > 0.97


def test_exact_copies(stages):
    best = {}
    for r in rows(stages[1]):
        key = SPACE.sub("", r[1])
        best[key] = min(best.get(key, r), r, key=lambda r: (-len(r[1]), r[0]))
    assert rows(stages[2]) == sorted(best.values(), key=str) and len(best) < stages[1].count()


def test_near_copies(stages):
    before = rows(stages[2])
    least = near_components([(r[0], r[1]) for r in before], 5, 80)
    assert rows(stages[3]) == [r for r, c in zip(before, least) if r[0] == c]


def test_mix(stages):
    before = rows(stages[3])
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(words(r[1]))
    want = targets(sizes)
    times = Counter()
    for source in sizes:
        at, queue = 0, sorted((place(r[0]), r) for r in before if r[3] == source)
        for _ in range(3):
            for _, r in queue:
                if at < round(float(want[source])) and words(r[1]):
                    times[r[0]] += 1
                at += len(words(r[1]))
    assert Counter(r[0] for r in rows(stages[4])) == times


def test_pieces(stages):
    coded = stages[5].collect()
    assert Counter(r.doc_id for r in coded) == Counter(r[0] for r in rows(stages[4]))
    assert all(r.lossless and len(r.pieces) == r.n_pieces for r in coded)


def test_run(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, stages[5].collect()))
