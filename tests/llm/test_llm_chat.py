from collections import Counter

import numpy as np
import pytest

from plain import FOLDER
from starloom.llm import chat_hmm as ch
from starloom.llm.common import table
from starloom.llm.fm_quality import is_held_out
from starloom.llm.queries import op1_chat_hmm

ROWS = "conv_id string, turn long, role string, text string"


@pytest.fixture(scope="module")
def labelled(spark, scratch):
    turns = ch.as_transcript(table(spark, FOLDER, "conversations"))
    return scratch.save(ch.segments(turns, "conv_id", "turn", "text", "role"), "segments")


@pytest.fixture(scope="module")
def model(labelled):
    return ch.train(labelled)


def plain_score(model, lines, path):
    """Log-probability of a reading."""
    before, total = model.states - 1, 0.0
    for line, state in zip(lines, path):
        total += model.moves[before, state] + model.emission(ch.observed(line))[state]
        before = state
    return total


def plain_best(model, lines):
    score = np.full(model.states, -np.inf)
    score[-1] = 0.0
    for line in lines:
        score = (score[:, None] + model.moves).max(0) + model.emission(ch.observed(line))
    return score.max()


@pytest.mark.parametrize("shift, few", [(8, 4096), (1, 2)])
def test_path_is_as_likely_as_the_best_of_one_run(spark, scratch, labelled, model, monkeypatch, shift, few):
    monkeypatch.setattr(ch, "SHIFT", shift)
    monkeypatch.setattr(ch, "FEW", few)
    rows = ch.parse(labelled, model, scratch).orderBy("id", "pos").collect()
    texts = {(r.id, r.told_pos): r.texts for r in labelled.collect()}
    assert len(rows) == len(texts) and max(r.pos for r in rows) > 1
    conversations = {}
    for r in rows:
        lines, path = conversations.setdefault(r.id, ([], []))
        lines += ch._lines(texts[r.id, r.pos])
        path += [2 * ch.ROLES.index(role) + (not begins) for role, begins in zip(r.roles, r.begins)]
    for lines, path in conversations.values():
        assert plain_score(model, lines, path) == pytest.approx(plain_best(model, lines), abs=1e-6)


def test_roles_of_conversations_not_learned_from(spark, scratch):
    """By turns with and without a marker, against always naming the most frequent role of the latter.

    On the largest of the tables: the others have 16 and 59 such turns, too few to learn from or to measure on.
    """
    turns = ch.as_transcript(table(spark, "/root/testdata/sf0.1", "conversations"))
    labelled = scratch.save(ch.segments(turns, "conv_id", "turn", "text", "role"), "more")
    model = ch.train(labelled.where(~is_held_out("id")))
    unseen = scratch.save(labelled.where(is_held_out("id")), "unseen")
    told = unseen.collect()
    truth = {(r.id, r.told_pos): r.role for r in told}
    marked = {(r.id, r.told_pos): ch.marker(r.texts[0])[0] < len(ch.ROLES) for r in told}
    hits = {True: [], False: []}
    for r in ch.parse(unseen, model, scratch).collect():
        hits[marked[r.id, r.pos]].append(r.roles[0] == truth[r.id, r.pos])
    bare = Counter(truth[k] for k, has in marked.items() if not has)
    commonest = max(bare.values()) / sum(bare.values())
    assert np.mean(hits[True]) > 0.99
    assert np.mean(hits[False]) > commonest + 0.1, (np.mean(hits[False]), commonest)


def test_registered_query_is_whole(spark):
    rows = op1_chat_hmm(spark, FOLDER).collect()
    turns = table(spark, FOLDER, "conversations")
    assert len({(r.conv_id, r.turn) for r in rows}) == turns.select("conv_id", "turn").distinct().count()
    assert {r.held_out for r in rows} == {True, False} and all(r.role in ch.ROLES for r in rows)


def test_markers():
    for line, want in [
        ("User: hi", (1, 6)), ("[assistant] x", (2, 12)), ("<|system|>x", (0, 10)), ("**Bot:** y", (2, 9)), ("Q: why?", (1, 3)),
        ("> Human: z", (1, 9)), ("Note: this", (3, 0)), ("no marker here", (4, 0)), ("", (4, 0)), ("*", (4, 0)),
    ]:
        assert ch.marker(line) == want, line


def test_rendering_drops_markers():
    assert ch.rendered(["User: a", "b", "c"], [2, 3, 4]) == "<|user|>\na\nb\n<|assistant|>\nc\n"


@pytest.mark.parametrize(
    "lines, path, want",
    [
        (["User: a", "<|assistant|>", "b"], [2, 3, 3], [("user", ["a", "<|assistant|>", "b"])]),
        (["User: <|user|>", "\\<|system|>", "\\\\<|user|>", "\\x"], [2, 3, 3, 3], [("user", ["<|user|>", "\\<|system|>", "\\\\<|user|>", "\\x"])]),
        (["User: a", "<|assistant|>", "b"], [2, 4, 5], [("user", ["a"]), ("assistant", ["", "b"])]),
        (["<|user|> ", ""], [3, 4], [(None, ["<|user|> "]), ("assistant", [""])]),
    ],
)
def test_renderings_read_back(lines, path, want):
    assert ch.turns(ch.rendered(lines, path)) == want


def test_odd_rows(spark, scratch, model):
    data = [
        ("a", 1, "user", "User: hello"), ("a", 1, "user", "User: again"), ("a", 0, None, None), ("a", None, "tool", ""),
        (None, 3, "assistant", "AI: x\n\ny"), (None, None, "assistant", "Bot: first"), ("", 2, "user", "User: no name"),
        ("b", -7, "user", "line\n" * 5000), ("b", 2**40, "assistant", "[assistant] far"), ("b", -(2**62), "system", "System: s"),
    ]
    docs = spark.createDataFrame([(*d, "x") for d in data], ROWS + ", pos string").repartition(3)
    found = scratch.save(ch.segments(docs, "conv_id", "turn", "text", "role"), "odd")
    rows = {(r.id, r.pos): r for r in ch.parse(found, model, scratch).collect()}
    assert set(rows) == {(d[0], d[1]) for d in data} and len(rows) == 9
    assert len(rows["a", 1].roles) == 2 and len(rows[None, 3].roles) == 3
    assert rows["b", 2**40].rendered.endswith("far\n")
    assert len(rows["b", -7].roles) == 5001


def test_nothing_to_learn_from_and_empty_tables(spark, scratch, model):
    empty = scratch.save(ch.segments(spark.createDataFrame([], ROWS), "conv_id", "turn", "text", "role"), "none")
    assert ch.parse(empty, model, scratch).count() == 0
    flat = ch.train(empty)
    assert np.allclose(flat.moves[-1, [0, 2, 4]], np.log(1 / 3))
    one = scratch.save(ch.segments(spark.createDataFrame([("a", 0, "user", "x")], ROWS), "conv_id", "turn", "text"), "one")
    assert ch.parse(one, flat, scratch).count() == 1


def test_turns_across_parts_are_counted(spark, scratch, monkeypatch):
    monkeypatch.setattr(ch, "SHIFT", 1)
    rows = [("c", i, "user" if i % 2 == 0 else "assistant", "x") for i in range(7)]
    model = ch.train(ch.segments(spark.createDataFrame(rows, ROWS), "conv_id", "turn", "text", "role"))
    s, any_turn = ch.SMOOTHING, ch.SMOOTHING + 3 * ch.SPREAD
    assert np.exp(model.moves[2, 4]) == pytest.approx((3 + any_turn) / (3 + s + 3 * any_turn))
