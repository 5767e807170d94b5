import heapq
from collections import Counter, defaultdict
from math import lcm

import pytest

from plain import SCHEMA, odd_rows, place, targets, words
from starloom.llm import fair_mix

WEIGHTS = (5, 2, 1)


def plain_queue(got, budget, passes=3):
    """Words taken by row: a heap holds the next copy of each source's queue; rows in the order of ``got``'s places."""
    names = sorted({g.source for g in got}, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    unit = lcm(*WEIGHTS)
    queues = defaultdict(list)
    for g in sorted(got, key=lambda g: (place(g.id), g.size, g.row)):
        if g.size:
            queues[g.source].append(g)
    # A null source stands first among equal times.
    heap = [(q[0].size * unit // weight[s], (s is not None, s or ""), 0, q[0].row, 0, s) for s, q in queues.items()]
    heapq.heapify(heap)
    taken, left = Counter(), budget
    while heap and left > 0:
        finish, name, turn, row, at, s = heapq.heappop(heap)
        size = queues[s][at].size
        taken[row] += min(size, left)
        left -= size
        turn, at = (turn, at + 1) if at + 1 < len(queues[s]) else (turn + 1, 0)
        if turn < passes:
            following = queues[s][at]
            heapq.heappush(heap, (finish + following.size * unit // weight[s], name, turn, following.row, at, s))
    return taken


def check(rows, got, share=1.0):
    """rows: (id, text, source); got: rows of fair_mix."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    want = targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for g in got:
        assert g.source_size == sizes[g.source] and g.target == pytest.approx(float(want[g.source]), abs=1e-6)
        assert 0 <= g.taken <= 3 * g.size
        taken[g.source] += g.taken
    longest = max((g.size for g in got), default=0)
    for source, total in taken.items():
        # Within a document, of its own or, for sources that weigh more than others, of theirs.
        assert abs(total - float(want[source])) <= 5 * longest
    assert sum(taken.values()) == sum(sizes.values())
    assert len({g.row for g in got}) == len(got)
    expected = plain_queue(got, sum(sizes.values()))
    assert {g.row: g.taken for g in got if g.taken} == {k: n for k, n in expected.items() if n}


def test_odd_rows(spark, scratch):
    data = odd_rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    check([(r[0], r[1], r[3]) for r in data], fair_mix.fair_mix(docs, scratch, WEIGHTS).collect())


def test_small_sources_end_and_their_excess_is_shared(spark, scratch):
    data = [(i, "w " * (1 + i % 7), f"s{i % 9}" if i % 10 else "s0") for i in range(500)] + [(900, "x y", "s99")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = fair_mix.fair_mix(docs, scratch, WEIGHTS).collect()
    check(data, got)
    assert [g.target for g in got if g.source == "s99"] == [6.0]


@pytest.mark.parametrize("data", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_no_words(spark, scratch, data):
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = fair_mix.fair_mix(docs, scratch, WEIGHTS).collect()
    assert [(g.taken, g.target) for g in got] == [(0, 0.0)] * len(data)
    assert fair_mix.mixed(docs, scratch, WEIGHTS).count() == 0


def test_mix_holds_each_document_as_often_as_it_is_taken_in_order(spark, scratch):
    data = odd_rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(2)
    turns = fair_mix.fair_mix(docs, scratch, WEIGHTS).collect()
    want = Counter()
    for t in turns:
        assert all(x.sent > 0 for x in t.turns)
        want[t.id, t.size] += len(t.turns)
    mixed = fair_mix.mixed(docs, scratch, WEIGHTS)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, len(words(r.text))) for r in mixed.collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    # Dealt otherwise, rows of equal id, size and finish time may change places.
    order = [(r.doc_id, len(words(r.text))) for r in mixed.collect()]
    assert order == [(r.doc_id, len(words(r.text))) for r in fair_mix.mixed(docs.repartition(5), scratch, WEIGHTS).collect()]


def test_plan_sorts_copies_by_ranges_and_repeated_ids_spread(spark, scratch):
    """A third of all rows without id, and a third with one id: no split holds most of them."""
    data = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "w " * (1 + i % 5), "hot" if i % 4 else f"s{i % 16}") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    got = fair_mix.fair_mix(docs, scratch, WEIGHTS)
    check(data, got.collect())
    rows = scratch.save(docs.selectExpr("doc_id AS id", "source", "cast(length(text) / 2 AS long) AS size", "monotonically_increasing_id() AS row"), "sizes")
    copies = fair_mix.finish_times(rows, fair_mix.source_weights(rows, WEIGHTS), WEIGHTS, 3, scratch)
    assert copies.count() == 9000 and copies.where("finish <= 0").count() == 0
    saved = []
    real = scratch.save
    scratch.save = lambda df, name, **k: (saved.append((name, df)), real(df, name, **k))[1]
    try:
        fair_mix.fair_mix(docs, scratch, WEIGHTS).count()
    finally:
        del scratch.save
    summed = [df for name, df in saved if name == "summed"]
    assert len(summed) == 2 and all("rangepartitioning" in df._jdf.queryExecution().toString() for df in summed)
    for df in summed:
        sizes = [r["count"] for r in df.groupBy("_split").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)
