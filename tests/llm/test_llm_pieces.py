from collections import Counter

import numpy as np
import pytest

from plain import FOLDER, SCHEMA, odd_rows
from starloom.llm import piece_sampling as ps
from starloom.llm.common import table


@pytest.fixture(scope="module")
def pieces():
    with open(ps.MODEL, "rb") as f:
        return ps.Pieces(f.read())


def all_cuts(pieces, unit):
    """Every way to cut a unit, with its probability."""
    names = {pieces.bytes_of[i].decode(): i for i in np.flatnonzero(np.isfinite(pieces.log_p))}

    def ways(text):
        if not text:
            yield (), 0.0
        for l in range(1, len(text) + 1):
            i = names.get(text[:l])
            if i is not None:
                for rest, log_p in ways(text[l:]):
                    yield (i, *rest), log_p + pieces.log_p[i]

    found = list(ways(unit.replace(ps.MARK, " ")))
    p = np.exp([w[1] for w in found])
    return {w[0]: x for w, x in zip(found, p / p.sum())}


@pytest.mark.parametrize("unit", ["▁hello", "▁▁▁a", "▁in"])
def test_cuts_are_drawn_with_their_probability(pieces, unit):
    want = all_cuts(pieces, unit)
    n = 40_000
    drawn = [(s, w, p) for s, (w, p) in enumerate(ps.Lattice(pieces, ["▁other", unit]).draw(np.ones(n, np.int64), np.arange(n).astype(np.uint64)))]
    ids, sizes = ps._in_order(pieces, n, drawn)
    ends = np.cumsum(sizes)
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(ends - sizes, ends))
    assert set(got) <= set(want)
    for cut, p in want.items():
        assert got[cut] / n == pytest.approx(p, abs=4 * np.sqrt(p * (1 - p) / n) + 1e-4)


def test_texts_come_back_and_cuts_do_not_depend_on_partitions(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    for docs in (odd, table(spark, FOLDER, "documents")):
        coded = ps.encode(docs.repartition(4))
        rows = ps.decode(coded).collect()
        assert len(rows) == docs.count() and coded.columns == ["row", "pieces"]
        assert all(r.decoded == r.row.text for r in rows)
        assert all((r.pieces is None) == (r.row.text is None) for r in rows)
        again = ps.encode(docs.coalesce(1)).collect()
        key = lambda r: (str(r.row), r.pieces)
        assert sorted(map(key, rows), key=str) == sorted(map(key, again), key=str)


def test_small_lattices_cut_alike(pieces, monkeypatch):
    texts = [(r[1] or "").encode() for r in odd_rows()]
    seeds = np.arange(len(texts))
    ids, at = ps.cut(pieces, texts, seeds)
    monkeypatch.setattr(ps, "LATTICE_CHARS", 7)
    few, few_at = ps.cut(pieces, texts[:6], seeds[:6])
    assert np.array_equal(ids[: at[6]], few) and np.array_equal(at[:7], few_at)


def test_other_keys_and_sharpness(pieces):
    text = [b"the quick brown fox jumps over the lazy dog " * 20]
    first, other = (ps.cut(pieces, text, np.array([k]))[0].tolist() for k in (1, 2))
    assert first != other and ps.joined(pieces, np.array(other), np.array([0, len(other)])) == [text[0].decode()]
    with open(ps.MODEL, "rb") as f:
        sharp = ps.Pieces(f.read(), 30.0)
    assert len(ps.cut(sharp, text, np.array([1]))[0]) < len(first)


def test_empty_table_and_foreign_ids(spark, pieces):
    empty = spark.createDataFrame([], SCHEMA)
    assert ps.decode(ps.encode(empty)).count() == 0
    assert ps.joined(pieces, np.array([int(pieces.byte_ids[255])]), np.array([0, 0, 1])) == ["", "�"]


def test_steps_bound_a_worker():
    """A worker's lattice, draws and joined text stay within some 100 MB beside its batch; 200 bytes a lattice character."""
    assert ps.LATTICE_CHARS * 200 <= 30e6 and ps.CUT_BYTES <= 1_000_000 and ps.DECODE_IDS <= 200_000


def test_lattices_look_up_what_can_end_a_piece(pieces, monkeypatch):
    rng = np.random.default_rng(4)
    names = {pieces.bytes_of[i].decode(): i for i in np.flatnonzero(np.isfinite(pieces.log_p))}
    some = rng.choice(sorted(names), 60).tolist()
    units = ["".join(rng.choice(list("qxzjvk"), 90)), "漢" * 40, *("▁" + a.strip() + b.strip() for a, b in zip(some[::2], some[1::2]))]
    units = [u.replace(" ", ps.MARK) for u in units]
    looked, find = [], pieces.find
    monkeypatch.setattr(pieces, "find", lambda h: looked.append(len(h)) or find(h))
    lattice = ps.Lattice(pieces, units)
    for unit, rank in zip(units, lattice.rank):
        for depth in range(1, len(unit) + 1):
            place = lattice.first[depth] + rank
            edges = slice(lattice.edge_first[place], lattice.edge_last[place] + 1)
            got = {(l, i) for l, i in zip(lattice.length[edges].tolist(), lattice.id[edges].tolist()) if i >= 0}
            ends = {l: names.get(unit[depth - l : depth].replace(ps.MARK, " ")) for l in range(1, depth + 1)}
            assert got == {(l, i) for l, i in ends.items() if i is not None}
    # Random letters end hardly any piece; they were looked up with up to 16 lengths each.
    assert sum(looked) < 6 * sum(map(len, units))
