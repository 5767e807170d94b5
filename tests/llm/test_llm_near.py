import numpy as np
import pytest

from plain import SCHEMA, near_components, odd_rows, shingles
from starloom.llm import signature_join as sj


def near_copies(n: int = 60) -> list[tuple]:
    """Families of near copies, some of which only chains of links join, and texts with a shared passage."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary, 40))
    rows = []
    for family in range(n // 6):
        text = list(rng.choice(vocabulary, int(rng.integers(4, 160))))
        for _ in range(6):
            rows.append((1000 - len(rows), " ".join(text) + (f" {passage}" if family % 3 == 0 else "")))
            for _ in range(int(rng.integers(0, 4))):
                text[int(rng.integers(len(text)))] = str(rng.choice(vocabulary))
    return rows


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 60)])
@pytest.mark.parametrize("part, leaf", [(512, 16), (3, 2)])
def test_components_equal_those_of_all_pairs(spark, scratch, monkeypatch, words, percent, part, leaf):
    monkeypatch.setattr(sj, "PART", part)
    monkeypatch.setattr(sj, "LEAF", leaf)
    rows = near_copies() + [(r[0], r[1]) for r in odd_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sj.components(docs, scratch, words=words, percent=percent).collect()
    want = near_components(rows, words, percent)
    key = lambda i, n, c: (str(i), n, str(c))
    assert sorted(key(g.id, g.n, g.component_id) for g in got) == sorted(
        key(r[0], len(shingles(r[1], words)), c) for r, c in zip(rows, want)
    )


def random_sets(rng, count, size):
    base = sj.mix64(rng.integers(1, 2**62, size).astype(np.uint64))
    out = []
    for _ in range(count):
        k = int(rng.integers(0, max(1, size // 6) + 1))
        new = sj.mix64(rng.integers(1, 2**62, k // 2).astype(np.uint64))
        out.append(np.unique(np.concatenate((rng.permutation(base)[k // 2 :], new))))
    return out


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key_and_bitmaps_lose_no_link(percent):
    rng = np.random.default_rng(5)
    links = 0
    for size in rng.integers(1, 500, 80).tolist():
        sets = random_sets(rng, 12, size)
        bands = sj._bands(max(map(len, sets)))
        keys = [set(sj.segment_keys(s, percent, bands).tolist()) for s in sets]
        bits = [sj.bitmap(s, sj.bitmap_width(len(s))).tobytes() for s in sets]
        sizes, side = np.array([len(s) for s in sets]), np.arange(12) % 2
        pairs = {tuple(sorted(p)) for p in sj.tree_candidates(bits, sizes, list(range(12)), side, percent, None)}
        roots = sj.tree_components(sets, list(range(12)), percent)
        for i in range(12):
            for j in range(i):
                if len(sets[i]) and sj.linked(sets[i], sets[j], percent):
                    links += 1
                    assert keys[i] & keys[j] and roots[i] == roots[j]
                    assert side[i] == side[j] or (j, i) in pairs
    assert links > 500


def test_each_set_shows_no_more_keys_than_it_must():
    rng = np.random.default_rng(9)
    bands = sj._bands(2000)
    for n in (1, 4, 5, 40, 41, 399, 1500):
        tokens = np.unique(sj.mix64(rng.integers(1, 2**62, n).astype(np.uint64)))
        for percent in (80, 90):
            keys = sj.segment_keys(tokens, percent, bands)
            assert 0 < len(keys) <= 2 * (sj._most_different(n, percent) + 1)
    # All elements in one segment: empty ones are keys, so that a partner is not lost.
    same = np.full(40, 7, np.uint64) + np.arange(40, dtype=np.uint64)
    assert len(set(sj.segment_keys(same, 80, bands)) & set(sj.segment_keys(same[3:], 80, bands))) > 0


def test_one_of_each_component_stays(spark, scratch):
    data = [r for r in odd_rows() if r[0] != 10]  # two texts of one id are two components of one name
    more = [(200 + i, "a b c d e f g h i j k l m n o p" + " z" * (i // 2), *["x"] * 2, 1, *["y"] * 9) for i in range(4)]
    docs = spark.createDataFrame(data + more, SCHEMA)
    kept = sj.keep_one(docs, scratch)
    rows = [(r[0], r[1]) for r in data + more]
    want = near_components(rows, 5, 80)
    worded = {str(c) for r, c in zip(rows, want) if shingles(r[1], 5)}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(str(i) for i, t in got if shingles(t, 5)) == sorted(worded)
    assert sum(not shingles(t, 5) for _, t in got) == sum(not shingles(t, 5) for _, t in rows)


def test_empty_table(spark, scratch):
    docs = spark.createDataFrame([], SCHEMA)
    assert sj.components(docs, scratch).count() == 0 and sj.keep_one(docs, scratch).count() == 0


def test_connected(spark, scratch):
    edges = [("c", "b"), ("b", "d"), ("d", "e"), ("e", "f"), ("z", "y"), ("q", "q"), ("f", "g"), ("a", "g")]
    got = sj.connected(spark.createDataFrame(edges, "a string, b string"), scratch).collect()
    assert {(r.a, r.b) for r in got} == {(x, "a") for x in "bcdefg"} | {("z", "y")}


def test_repeated_rows_make_one_set_for_each_node(spark, scratch, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base), " ".join([*base[:59], "other"])]
    rows = [(key, text) for key, text in zip((1, None), texts) for _ in range(300)]
    counts = []
    real = scratch.save
    monkeypatch.setattr(scratch, "save", lambda df, name, **k: (out := real(df, name, **k), name == "sets" and counts.append(out.count()))[0])
    got = sj.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), scratch, words=3, percent=80)
    assert {(r.id, r.component_id) for r in got.collect()} == {(1, 1), (None, 1)} and got.count() == 600
    assert counts == [2]
