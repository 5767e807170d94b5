"""Pairs of fingerprints that share a band are told apart where they meet, and none is lost."""

import random

import numpy as np

from starloom.llm import edit_embedding as ee


def digits_of(rng, n):
    return np.array([rng.randrange(16) for _ in range(n)], np.uint8)


def family(rng, n, size, spoilt, alphabet=16):
    """Copies of a fingerprint with other digits and other ends."""
    base, out = digits_of(rng, n), []
    for _ in range(size):
        near = base.copy()
        at = np.flatnonzero([rng.random() < spoilt for _ in range(n)])
        near[at] = [rng.randrange(alphabet) for _ in at]
        out.append(near[: n - rng.randrange(3)])
    return out


def test_bands_are_few_and_shared_by_all_that_are_alike():
    rng = random.Random(4)
    assert np.mean([len(ee.band_keys(np.zeros(n, np.uint8), 0.8)) for n in range(160, 320)]) < 120
    for n in (1, 2, 3, 7, 9, 31, 39, 64, 71, 130, 199, 256):
        prints = family(rng, n, 30, 0.25)
        keys = [set(ee.band_keys(p, 0.8).tolist()) for p in prints]
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if len(a) and len(b) and ee.likeness(a, b) >= 0.8:
                    assert keys[i] & keys[j]


def rows_of(prints, band):
    """Rows of one band under its first key, as ``banded`` makes them."""
    n = np.array([len(p) for p in prints], np.int64)
    tails = np.zeros((len(prints), ee.TAIL), np.uint8)
    for row, p in zip(tails, prints):
        row[: min(len(p), ee.TAIL)] = p[-ee.TAIL :]
    high, low = ee.packed(n, tails).view(np.int64).T
    code = np.arange(len(prints), dtype=np.int64) << 4 + ee.COUNT_BITS | n
    return {"band": np.full(len(prints), band, np.int64), "code": code, "high": high, "low": low}, n, tails


def test_meetings_equal_all_pairs():
    rng = random.Random(8)
    prints = [p for n in (40, 70, 96, 150, 200) for p in family(rng, n, 14, 0.1)]
    rng.shuffle(prints)
    rows, n, tails = rows_of(prints, 5 << 40)
    may = [[bool(ee.may_be_alike(n[i : i + 1], tails[i : i + 1], n[j : j + 1], tails[j : j + 1], 0.8)[0]) for j in range(i)] for i in range(len(n))]
    alike = [[ee.likeness(prints[i], prints[j]) >= 0.8 for j in range(i)] for i in range(len(n))]

    def got(limit, **more):
        made = list(ee.meetings(rows | more, 0.8, limit))
        return {(int(a), int(b)): bool(c) for part in made for a, b, c, _ in zip(*part)}

    def want(told, limit, least_of=lambda i: i):
        chosen = {i: [j for j in range(least_of(i)) if told[i][j]][:limit] for i in range(len(n))}
        return {(i, j): k == limit - 1 for i, js in chosen.items() for k, j in enumerate(js)}

    assert 100 < sum(map(sum, alike)) < sum(map(sum, may))
    assert got(2) == want(may, 2) and got(1_000) == want(may, 1_000)
    whole = ee.whole_packed([ee.as_text(p) for p in prints])
    assert got(1_000, print=whole) == want(alike, 1_000)
    assert got(1, print=whole, most=np.arange(len(n)) // 2) == want(alike, 1, lambda i: i // 2)
    # Under another key of the band, pairs that have the digit it leaves out in common were met before.
    again = {"band": rows["band"] + (1 << 4 * (ee.BAND_DIGITS - 1))}
    assert not got(2, **again)


def test_parts_of_a_partition_change_nothing(monkeypatch):
    import pyarrow as pa

    rng = random.Random(9)
    prints = [p for n in (64, 90) for p in family(rng, n, 40, 0.1)]
    parts = [rows_of(prints[k : k + size], k << 40)[0] for k, size in ((0, 3), (3, 1), (4, 60), (64, 16))]
    rows = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
    whole = pa.RecordBatch.from_pydict(rows)

    def got(size, least_rows, pairs):
        monkeypatch.setattr(ee, "ROWS", least_rows)
        monkeypatch.setattr(ee, "PAIRS", pairs)
        batches = [whole.slice(at, size) for at in range(0, whole.num_rows, size)]
        return sorted(tuple(r.values()) for b in ee._met(0.8, 2)(iter(batches)) for r in b.to_pylist())

    one = got(1_000, 1_000, 1_000)
    assert len(one) > 50 and all(got(*sizes) == one for sizes in ((1, 1, 7), (7, 5, 1_000), (30, 1, 50)))


def test_families_at_the_threshold_leave_out_no_pair(spark, scratch):
    """Many that are alike by their last digits and not as a whole: the smallest other of a band does not tell."""
    rng = random.Random(6)
    prints = []
    for n in (70, 100, 140):
        base = family(rng, n, 1, 0)[0]
        for _ in range(70):
            near = base.copy()
            at = rng.sample(range(len(near)), round(len(near) * rng.uniform(0.1, 0.5)))
            # The last digits stay nearly as they are.
            at = [x for x in at if x < len(near) - ee.TAIL or rng.random() < 0.4]
            near[at] = [rng.randrange(16) for _ in at]
            prints.append(near)
    rng.shuffle(prints)
    alike = [[ee.likeness(a, b) >= 0.8 for b in prints] for a in prints]
    table = spark.createDataFrame([(i, ee.as_text(p)) for i, p in enumerate(prints)], "id long, fingerprint string")
    written = []

    class Noting(type(scratch)):
        def save_and_release(self, df, name):
            written.append(name)
            return super().save_and_release(df, name)

    got = {r.id: r.near_id for r in ee.near_documents(table.repartition(3), Noting(spark)).collect()}
    assert got == {k: row.index(True) for k, row in enumerate(alike)}
    assert "bands" in written and 5 < sum(k != v for k, v in got.items()) < len(got)
