import math
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from plain import SCHEMA, odd_rows
from starloom.llm import importance_resample as ir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TARGET = "item_id long, text string, n string"


def found(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows, target, least=20, percent=25, seed=7, buckets=10_000):
    def counted(texts):
        out = [0] * buckets
        for t in texts:
            for f in found(t)[1]:
                out[crc32(f.encode()) % buckets] += 1
        return out

    s, t = counted(r[1] for r in rows), counted(target)
    gain = [
        math.floor(1000 * math.log((y + 1.0) * (sum(s) + buckets) / ((x + 1.0) * (sum(t) + buckets)))) for x, y in zip(s, t)
    ]
    out = []
    for r in rows:
        words, all_found = found(r[1])
        weight = sum(gain[crc32(f.encode()) % buckets] for f in all_found) // max(1, len(all_found))
        h = int(sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(words), len(all_found), weight, score, None])
    fit = sorted((o for o in out if o[1] >= least), key=lambda o: (-o[4], o[0] is not None, o[0] or 0))
    for n, o in enumerate(fit[: percent * len(fit) // 100], 1):
        o[5] = n
    return sorted(map(tuple, out), key=repr)


def test_features_of_odd_texts():
    texts = ["", None, "one", " One, two\x00THREE ", "été ÉTÉ x", "日本語 a-b_c'd", "a " * 5, "   ", "\U0001f600 9z"]
    words, pairs, starts, pair_starts = ir.features(pa.array(texts))
    for i, t in enumerate(texts):
        w, f = found(t)
        assert words[starts[i] : starts[i + 1]].tolist() == [crc32(x.encode()) % 10_000 for x in w]
        assert pairs[pair_starts[i] : pair_starts[i + 1]].tolist() == [crc32(x.encode()) % 10_000 for x in f[len(w) :]]


def test_steps_hold_all_texts():
    texts = pa.array(["x" * n for n in (5, 0, 70, 3, 3, 200)] + [None])
    assert pa.concat_arrays(list(ir.steps(texts, 60))).equals(texts)
    assert [len(s) for s in ir.steps(texts, 60)] == [2, 1, 2, 1, 1]
    assert list(ir.steps(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("least, percent", [(20, 25), (1, 60), (0, 100)])
def test_odd_rows_equal_a_plain_version(spark, scratch, least, percent):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)]
    more = [(100 + i, " ".join(rng.choice(vocabulary, 15 + i % 12)), "en", "s", 1, *["other"] * 9) for i in range(80)]
    data = odd_rows() + more
    target = [" ".join(rng.choice(vocabulary[:9], 40)), None, "", "the lazy dog"]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], TARGET)
    got = ir.resample(docs, bench, scratch, least_words=least, percent=percent, keep=["lang", "row"])
    rows = sorted((tuple(r)[:6] for r in got.collect()), key=repr)
    want = plain(data, target, least, percent)
    # Rows that share id and score may stand in either order.
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert sorted(r[5] for r in rows if r[5]) == sorted(r[5] for r in want if r[5])
    by_rank = {r[5]: (r[0], r[4]) for r in rows if r[5]}
    assert by_rank == {r[5]: (r[0], r[4]) for r in want if r[5]}
    assert got.select("row.lang", "row.row").columns == ["lang", "row"]


def test_empty_tables(spark, scratch):
    docs = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], TARGET)
    assert ir.resample(docs, none, scratch).collect() == []
    one = spark.createDataFrame([odd_rows()[0]], SCHEMA)
    assert [tuple(r)[:4] for r in ir.resample(one, none, scratch).collect()] == [(1, 9, 17, plain([odd_rows()[0]], [])[0][3])]


def test_target_like_documents_weigh_more(spark, scratch):
    docs = [(i, ("red green blue " if i % 4 == 0 else "up down left ") * 10, "en", "s", 1, *["o"] * 9) for i in range(400)]
    bench = spark.createDataFrame([(1, "red green blue " * 20, "x")], TARGET)
    got = ir.resample(spark.createDataFrame(docs, SCHEMA), bench, scratch).collect()
    drawn = [r for r in got if r["rank"]]
    assert len(drawn) == 100 and sum(r["id"] % 4 == 0 for r in drawn) > 90
