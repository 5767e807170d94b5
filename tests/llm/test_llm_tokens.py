import numpy as np
import pytest
from tokenizers import Tokenizer

from plain import FOLDER, SCHEMA, odd_rows
from starloom.llm import token_attribution as ta
from starloom.llm.common import table


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


def plain(tokenizer, values, names, rule):
    """Another encoder's offsets, token by token."""
    present = [(n, v) for n, v in zip(names, values) if v is not None]
    text, spans = "", []
    for k, (name, value) in enumerate(present):
        begin = len(text)
        cuts = [0]
        if name == "text":
            i = 0
            while i < len(value):
                if value[i] == "\n":
                    while i < len(value) and value[i] == "\n":
                        i += 1
                    if i < len(value):
                        cuts.append(i)
                else:
                    i += 1
        text += value + ("\n" if k + 1 < len(present) else "")
        ends = [*cuts[1:], len(text) - begin]
        spans += [[name, n, begin + a, begin + b, 0] for n, (a, b) in enumerate(zip(cuts, ends))]
    for low, high in tokenizer.encode(text, add_special_tokens=False).offsets:
        overlap = [max(0, min(high, s[3]) - max(low, s[2])) for s in spans]
        touched = [i for i, o in enumerate(overlap) if o]
        pick = {"start": touched[0], "end": touched[-1], "most": int(np.argmax(overlap))}[rule]
        spans[pick][4] += 1
    return [tuple(s) for s in spans]


@pytest.mark.parametrize("rule", ta.RULES)
def test_counts_equal_those_of_another_encoder(spark, tokenizer, rule):
    fields = ["source", "lang", "text"]
    docs = table(spark, FOLDER, "documents").where("doc_id < 60")
    odd = [r for r in odd_rows() if r[0] not in (7, 8)]
    docs = docs.unionByName(spark.createDataFrame(odd, SCHEMA).select(docs.columns)).repartition(3)
    got = sorted((str(r[0]), *r[1:]) for r in ta.section_tokens(docs, fields, sectioned=["text"], rule=rule).collect())
    want = []
    for r in docs.collect():
        want += [(str(r.doc_id), *s) for s in plain(tokenizer, [r[f] for f in fields], fields, rule)]
    assert got == sorted(want)


def test_boundary_crossing_tokens():
    edges = np.array([0, 4, 4, 6, 10])
    starts, ends = np.array([0, 3, 3, 5, 2, 6]), np.array([3, 7, 5, 7, 11, 10])
    assert ta.join_spans(starts, ends, edges, "start").tolist() == [0, 0, 0, 2, 0, 3]
    assert ta.join_spans(starts, ends, edges, "end").tolist() == [0, 3, 2, 3, 4, 3]
    assert ta.join_spans(starts, ends, edges, "most").tolist() == [0, 2, 0, 2, 3, 3]


def test_long_texts_empty_tables_and_bad_rules(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    rows = ta.section_tokens(docs.where("doc_id in (7, 8)"), ["text"]).collect()
    assert [r.n_tokens > 30_000 for r in rows] == [True, True] and all(r.start == 0 for r in rows)
    assert ta.section_tokens(spark.createDataFrame([], SCHEMA), ["text"]).count() == 0
    assert ta.section_tokens(docs.where("doc_id is null and text is null"), ["text", "lang"]).count() == 0
    with pytest.raises(ValueError):
        ta.section_tokens(docs, ["text"], rule="none")


def test_sections_cover_the_document(spark):
    docs = table(spark, FOLDER, "documents").where("doc_id < 40")
    parts = ta.section_tokens(docs, ["text"], sectioned=["text"]).groupBy("id").sum("n_tokens").collect()
    whole = ta.section_tokens(docs, ["text"]).collect()
    assert {(r.id, r.n_tokens) for r in whole} == {tuple(r) for r in parts}


def encoder():
    from pathlib import Path

    return ta._encoder(Path(ta.RANKS).read_bytes())


@pytest.mark.parametrize("run", [" " * 60_000, "\n" * 60_001, " \t\u3000\r\n" * 11_000, "\x85\xa0" * 30_000])
@pytest.mark.parametrize("around", [("", ""), ("ab", "cd"), ("a ", " 12"), ("", "!x"), ("x\x1c", "\x1cy"), ("'s", "'s")])
def test_long_blank_runs_are_split_as_the_pattern_does(run, around):
    text = around[0] + run + around[1]
    assert (encoder().token_sizes(text) == encoder().sizes[encoder()._encoding.encode_ordinary(text)]).all()


@pytest.mark.parametrize("unit", [" ", "\n", "a", "7", "!", " \n", "\u3000", "é"])
def test_five_megabytes_of_one_kind(unit):
    text = "x" + unit * (5_000_000 // len(unit.encode())) + "y"
    assert encoder().token_sizes(text).sum() == len(text.encode())
