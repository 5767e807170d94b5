import random
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as entry
from plain import FOLDER, SCHEMA, duck, odd_rows
from starloom.llm import edit_embedding as ee


def plain_print(text):
    """One step at a time, over the whole sequence that the walk notes."""
    moves = (ee._random(99, ee.CLASSES * ee.PERIOD) >> np.uint64(63)).reshape(ee.CLASSES, ee.PERIOD)
    noted, i, j = [], 0, 0
    while i < len(text):
        noted.append(text[i])
        i += int(moves[ee._CLASS_OF[ord(text[i]) & 0xFFFF], j % ee.PERIOD])
        j += 1
    out = []
    for step in ee.sampled_steps()[0].tolist():
        if step >= len(noted):
            break
        out.append(int(ee.mix64(np.array([ord(noted[step]) + (1 << 32)], np.uint64))[0] >> np.uint64(60)))
    return "".join(f"{x:x}" for x in out), len(noted)


def plain_likeness(a, b):
    _, parts = ee.sampled_steps()
    total = sum(parts[: max(len(a), len(b))].tolist())
    return sum(p for x, y, p in zip(a, b, parts.tolist()) if x == y) / total if total else 1.0


def plain_edits(rows):
    """rows: (id, text), in order."""
    out = []
    for (key, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(t)
        edited = t[: n - n // 3] + following[: n // 3]
        own, changed, nxt = (plain_print(x)[0] for x in (t, edited, following))
        out.append((key, n, sha256(edited.encode()).hexdigest(), own, changed, plain_likeness(own, changed), plain_likeness(own, nxt)))
    return out


COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("text", ["", "a", "ab", "aaaa" * 50, "The quick brown fox" * 9, "日本\U0001f600\x00é" * 31, "x" * 5001])
def test_walk_equals_single_steps(text, monkeypatch):
    want, steps = plain_print(text)
    letters = ee.code_points(text)
    left = ee.walk(letters)
    assert ee.fingerprint(text) == want and (left[-1] if len(left) else 0) == steps
    monkeypatch.setattr(ee, "PART", 7)
    assert (ee.walk(letters) == left).all()
    for cut in (1, len(text) // 2):
        if 0 < cut < len(text):
            assert (ee.walk(letters[cut:], int(left[cut - 1])) == left[cut:]).all()
    assert (ee.as_digits(want) == ee.noted(letters, left)).all()


def test_few_edits_stay_alike_and_other_texts_do_not():
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    for n in (300, 3_000):
        base, other = (" ".join(rng.choice(words) for _ in range(n)) for _ in range(2))
        near = base
        for _ in range(5):
            at = rng.randrange(len(near))
            near = near[:at] + rng.choice(["", "x", "yz"]) + near[at + rng.randint(0, 1) :]
        prints = [ee.as_digits(ee.fingerprint(t)) for t in (base, near, other)]
        assert ee.likeness(prints[0], prints[1]) > 0.8 and ee.likeness(prints[0], prints[2]) < 0.3


@pytest.mark.parametrize("splits", [1, 3, 40])
def test_odd_rows_equal_a_plain_version(spark, scratch, splits):
    data = [r for r in odd_rows() if r[1] is None or len(r[1]) < 10_000] + [(9, "", "en", "x", 1, *["o"] * 9)] * 3
    docs = spark.createDataFrame(data, SCHEMA).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", splits)
    try:
        got = ee.edited_fingerprints(docs, scratch)
        assert got.columns == COLUMNS
        rows = sorted((tuple(r) for r in got.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # Equal ids stand in the order of a digest that Spark computes.
    digests = {r.text: r.d for r in docs.selectExpr("coalesce(text, '') AS text", "xxhash64(cast(coalesce(text, '') AS binary)) AS d").collect()}
    ordered = sorted(((r[0], r[1] or "") for r in data), key=lambda r: (r[0] is None, -(r[0] or 0), digests[r[1]]))
    assert rows == sorted(plain_edits(ordered), key=repr)
    assert sorted(map(repr, ee.fingerprints(docs).toPandas()["fingerprint"])) == sorted(repr(r[3]) for r in rows)


def test_one_row_and_none(spark, scratch):
    docs = spark.createDataFrame([(7, "abcdef", "en", "s", 6, *["o"] * 9)], SCHEMA)
    assert [tuple(r) for r in ee.edited_fingerprints(docs, scratch).collect()] == plain_edits([(7, "abcdef")])
    assert ee.edited_fingerprints(docs.where("false"), scratch).collect() == []
    assert ee.near_documents(ee.fingerprints(docs.where("false")), scratch).collect() == []


def test_near_documents(spark, scratch):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(6)) for _ in range(900)]
    rows, family = [], {}
    for f in range(30):
        base = " ".join(rng.choice(words) for _ in range(120 + 30 * f))
        for k in range(1 + f % 4):
            at = rng.randrange(len(base))
            text = base if k != 2 else base[:at] + "Q" + base[at + 1 :]
            rows.append((10 * f + k, text))
            family[10 * f + k] = f
    rows += [(None, "no id"), (None, rows[0][1]), (999, ""), (998, None), (997, "Q"), (996, "Q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.id, r.near_id) for r in ee.near_documents(ee.fingerprints(docs), scratch).collect()]
    assert len(got) == len(rows)
    assert {(k, n) for k, n in got if k is not None and k > 990} == {(999, 998), (998, 998), (997, 996), (996, 996)}
    assert sorted((n for k, n in got if k is None), key=repr) == [0, None]
    for k, n in got:
        if k in family:
            assert n == 10 * family[k]


def test_hot_band_makes_a_row_for_each_node(spark, scratch):
    """A template that all texts share: no pairs among them."""
    base = " ".join(f"word{i % 97}" for i in range(400))
    rows = [(i, base + f" number {i}") for i in range(600)]
    prints = ee.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    got = ee.near_documents(prints, scratch).collect()
    assert len(got) == 600 and {r.near_id for r in got} == {0}


@pytest.mark.parametrize("least", [0.8, 0.6])
def test_near_documents_leave_out_no_pair(spark, scratch, least):
    """Against all pairs: digits changed at random places, ends cut, likenesses about the least one."""
    rng, prints = random.Random(11), []
    for n in [1, 2, 4, 5, 9, 15, 16, 23, 40, 63, 64, 71, 96, 101, 128, 150, 163, 200, 260]:
        base = [rng.randrange(16) for _ in range(n)]
        for _ in range(12):
            spoilt = 1.6 * rng.random() * (1 - least)
            near = [rng.randrange(16) if rng.random() < spoilt else d for d in base]
            prints.append("".join(f"{d:x}" for d in near[: n - int(rng.random() * n / 12)]))
    rng.shuffle(prints)
    digits = [ee.as_digits(p) for p in prints]
    alike = [[ee.likeness(a, b) >= least for b in digits] for a in digits]
    assert sum(map(sum, alike)) > 3 * len(prints)
    table = spark.createDataFrame(list(enumerate(prints)), "id long, fingerprint string").repartition(3)
    got = {r.id: r.near_id for r in ee.near_documents(table, scratch, least=least).collect()}
    assert got == {k: row.index(True) for k, row in enumerate(alike)}


def test_query(spark):
    rows = entry.queries()["op13_edit_embedding"](spark, FOLDER).collect()
    docs = duck().execute("select doc_id, coalesce(text, '') from documents order by doc_id desc").fetchall()
    want = plain_edits(docs)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS[1:]) for r in rows}
    assert len(rows) == len(docs) and got == {w[0]: w[1:] for w in want}
    near = [r.near_edited for r in rows]
    assert np.mean(near) - np.mean([r.near_next for r in rows]) > 0.5
    assert all(r.near_id <= r.doc_id for r in rows)
