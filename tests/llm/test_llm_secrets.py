import re
import time

from plain import SCHEMA, odd_rows
from starloom.llm import secret_index as si

PLAIN = [
    (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]+"), 0, 24),
]


def spans(text):
    found = []
    for n, (pattern, group, least) in enumerate(PLAIN):
        found += [(m.start(), n, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return sorted(found)


def test_odd_rows_equal_a_plain_scan(spark, scratch):
    more = [
        "secret=token:abcdefgh", "\U0001f600 secret = \"a.b-c/d\"", "AKIA" * 9, "AKIA1234 " + "AKIA" + "Z" * 16,
        "ſecret=abcdefgh toKen=abcdefgh", "password:abc password: abcdefg", "f" * 23 + "g" + "0" * 24 + "G" + "a" * 90,
        "token\"  :  'x' token=======", "token=\napi_key =abcdef", "passwd" * 40 + "=qwerty1",
    ]
    data = odd_rows() + [(100 + i, t, *["other"] * 2, 1, *["other"] * 9) for i, t in enumerate(more)]
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = si.find_secrets(docs, scratch).collect()
    key = lambda i, s: (str(i), s)
    assert sorted(key(g.id, [tuple(x) for x in g.found]) for g in got) == sorted(key(r[0], spans(r[1])) for r in data)


def test_empty_table(spark, scratch):
    assert si.find_secrets(spark.createDataFrame([], SCHEMA), scratch).count() == 0


def test_queries_of_expressions():
    assert si.trigram_query("abcd") == ("and", ("abc", "bcd"))
    assert si.trigram_query("ab|cde") is None
    assert si.trigram_query("abc|xyzw") == ("or", ("abc", ("and", ("xyz", "yzw"))))
    assert si.trigram_query("[Aa]bc+x") is None
    assert si.trigram_query("(abc)+[0-9]*(def|deg)?hij") == ("and", ("abc", "hij"))
    assert si.trigram_query("[0-9a-f]{24,}") is None
    assert si.trigram_query("abc.def$") == ("and", ("abc", "def"))


def test_rules_without_trigrams_and_own_rules(spark, scratch):
    docs = spark.createDataFrame([(1, "key-77 AbcDef"), (2, "none")], "doc_id long, text string")
    rules = [si.Rule("number", "[0-9]{2}", 0, 2), si.Rule("word", "AbcDef", 0, 1)]
    got = {r.id: [tuple(x) for x in r.found] for r in si.find_secrets(docs, scratch, rules).collect()}
    assert got == {1: [(4, 0, 6), (7, 1, 13)], 2: []}
    assert si.find_secrets(docs, scratch, rules[:1]).count() == 2


def test_queries_only_let_more_through():
    texts = [r[1] or "" for r in odd_rows()]

    def holds(q, text):
        if q is None or isinstance(q, str):
            return q is None or q in text.lower()
        return (all if q[0] == "and" else any)(holds(x, text) for x in q[1])

    for rule in si.RULES:
        for text in texts:
            if re.search(rule.pattern, text):
                assert holds(si.trigram_query(rule.pattern), text)


def test_many_matches_in_one_text(spark, scratch):
    """Work grows with the matches, not with their square: 200,000 in one text, and numbers around the group size."""
    texts = [f"x{'é' * (i % 3)} token=abcdef{i % 7}" for i in range(200_000)]
    data = [(0, " ".join(texts))] + [(n, "".join(texts[:n])) for n in (si.GROUP - 1, si.GROUP, si.GROUP + 1, 2 * si.GROUP)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    before = time.monotonic()
    got = {r.id: [tuple(x) for x in r.found] for r in si.find_secrets(docs, scratch).collect()}
    assert time.monotonic() - before < 60
    assert got == {i: spans(t) for i, t in data}
