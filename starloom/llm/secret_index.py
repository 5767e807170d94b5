"""Secret scan through a trigram inverted index.

From each rule's expression follows a Boolean query over trigrams of the lower-cased text: a text that holds a
match holds the trigrams. The index has one row per trigram and document, for the trigrams that the rules
ask for. Postings of a document are combined as its rule's query says; only the documents that remain are
read by the rule's expression. A rule without mandatory trigrams reads every text.

Only DataFrame functions work on the data; the rules are analysed on the driver. Spans are in code points,
the end exclusive; a rule's matches are the leftmost that do not overlap, and those that fail its length test
are dropped after the match, so that they still cover their text. A null text counts as empty. Rows that share
an id share its postings, which can only let more texts through to the expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as C, _parser as P

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import no_text
from starloom.workspace import Workspace

#: At most so many literal strings stand for a part of an expression; beyond, the part asks for nothing.
MOST_STRINGS = 64
#: Matches of a text that are placed together.
GROUP = 128


@dataclass(frozen=True)
class Rule:
    """``tested`` is the group whose length must reach ``least``; 0 is the whole match."""

    kind: str
    pattern: str
    tested: int
    least: int


def _either(word: str) -> str:
    """The letters in either case, as classes: no engine folds other letters into them."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The kinds, their expressions and the least lengths. For hex and access, a run that is too
#: short holds no match that is long enough, so the length can be asked for in the expression.
RULES = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)

# The trigram query of an expression: None asks for nothing, a string is a trigram, and ("and", parts) and
# ("or", parts) combine queries.


def trigram_query(pattern: str):
    """What the lower-cased text of any match must hold."""
    exact, need = _analyse(P.parse(pattern))
    return _all([need, None if exact is None else _of_strings(exact)])


def _all(parts):
    parts = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts):
    parts = list(dict.fromkeys(parts))
    return None if None in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings):
    """Any of the strings, by all of its trigrams; one of fewer than three letters asks for nothing.

    A string that holds another of them is left out: it asks for more, and the other is enough.
    """
    least = [s for s in sorted(strings) if not any(t in s for t in strings if t != s)]
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in least])


def _letters(items) -> set[str] | None:
    """The lower-cased letters of a class, if they are few and plain."""
    letters: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL and arg < 128:
            letters.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] < 128:
            letters |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return letters if len(letters) <= 4 else None


def _analyse(parts) -> tuple[set[str] | None, object]:
    """All strings that a sequence can match, lower-cased (None: unknown or too many), and what it asks for."""
    run: set[str] = {""}
    needs, broken = [], False
    for op, arg in parts:
        strings, need = _part(op, arg)
        needs.append(need)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
        else:
            needs.append(_of_strings(run))
            run, broken = strings or {""}, True
    if broken:
        needs.append(_of_strings(run))
    return (None if broken else run), _all(needs)


def _part(op, arg) -> tuple[set[str] | None, object]:
    if op is C.LITERAL:
        return _letters([(op, arg)]), None
    if op is C.IN:
        return _letters(arg), None
    if op is C.AT:
        return {""}, None
    if op is C.SUBPATTERN:
        return _analyse(arg[-1])
    if op is C.BRANCH:
        found = [_analyse(x) for x in arg[1]]
        if all(s is not None for s, _ in found):
            union = set().union(*(s for s, _ in found))
            if len(union) <= MOST_STRINGS:
                return union, None
        return None, _any([_all([need, _of_strings(s) if s is not None else None]) for s, need in found])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, inner = arg
        strings, need = _analyse(inner)
        if low == 0:
            return (strings | {""} if high == 1 and strings is not None else None), None
        if low == high == 1:
            return strings, need
        return None, _all([need, _of_strings(strings) if strings is not None else None])
    return None, None


def _trigrams(query) -> list[str]:
    if query is None or isinstance(query, str):
        return [query] if query else []
    return [t for part in query[1] for t in _trigrams(part)]


def _holds(query, has) -> Column:
    if isinstance(query, str):
        return has(query)
    join = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return reduce(join, [_holds(part, has) for part in query[1]])


def write_postings(docs: DataFrame, trigrams: Sequence[str], scratch: Workspace, id_col: str, text_col: str) -> DataFrame:
    """trigram, id: a row for each document and trigram it holds, in order of trigrams within a file."""
    low = docs.select(F.col(id_col).alias("id"), F.lower(no_text(text_col)).alias("low"))
    found = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams])
    rows = low.select(F.explode(F.array_compact(found)).alias("trigram"), "id")
    return scratch.save(rows.sortWithinPartitions("trigram"), "postings")


def candidates(postings: DataFrame, queries: dict[int, object]) -> DataFrame:
    """id, rules: the numbers of the rules whose query the document's postings fulfil."""
    trigrams = sorted({t for q in queries.values() for t in _trigrams(q)})
    words = [trigrams[i : i + 60] for i in range(0, len(trigrams), 60)]
    masks = [F.bit_or(_bit(part)).alias(f"mask{k}") for k, part in enumerate(words)]
    place = {t: (k, 1 << i) for k, part in enumerate(words) for i, t in enumerate(part)}

    def has(t: str) -> Column:
        k, bit = place[t]
        return F.col(f"mask{k}").bitwiseAND(F.lit(bit)) != 0

    wanted = postings.where(F.col("trigram").isin(trigrams)).groupBy("id").agg(*masks)
    rules = F.array_compact(F.array(*[F.when(_holds(q, has), F.lit(n)) for n, q in queries.items()]))
    return wanted.select("id", rules.alias("rules")).where("size(rules) > 0")


def _bit(trigrams: Sequence[str]) -> Column:
    pairs = [x for i, t in enumerate(trigrams) for x in (F.lit(t), F.lit(1 << i).cast("long"))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("trigram")), F.lit(0).cast("long"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Start, order and end of the matches that pass, from the lengths of the pieces between the matches.

    Matches are placed within groups of ``GROUP``, then the groups one after the other: an array that grows match by match
    would be copied at each, which is quadratic in the matches of a text.
    """
    between, hits = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), 0)
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), rule.tested)
    size = lambda strings: F.transform(strings, lambda x: F.length(x))
    # The last piece has no match after it.
    lengths = F.arrays_zip(size(between).alias("a"), size(hits).alias("b"), size(tested).alias("c"))
    no_spans = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    nowhere = F.struct(F.lit(0).alias("at"), no_spans.alias("spans"))

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["a"]
        end = start + F.coalesce(x["b"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end")))
        passed = F.when(x["c"] >= rule.least, F.concat(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), passed.alias("spans"))

    def grouped(all_lengths: Column) -> Column:
        groups = F.sequence(F.lit(0), F.ceil(F.size(all_lengths) / GROUP).cast("int") - 1)
        return F.transform(groups, lambda g: F.aggregate(F.slice(all_lengths, g * GROUP + 1, GROUP), nowhere, place))

    def shifted(groups: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            groups,
            begin,
            lambda acc, g: F.struct(
                (acc["at"] + g["at"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")
            ),
        )["starts"]
        return F.flatten(
            F.zip_with(
                groups,
                starts,
                lambda g, by: F.transform(
                    g["spans"],
                    lambda x: F.struct((x["start"] + by).alias("start"), x["kind"].alias("kind"), (x["end"] + by).alias("end")),
                ),
            )
        )

    return _let(_let(lengths, grouped), shifted)


def _let(value: Column, use) -> Column:
    """use(value), with the value worked out once, however often and wherever it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def find_secrets(
    docs: DataFrame,
    scratch: Workspace,
    rules: Sequence[Rule] = RULES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, found: for every row, the spans in order of start, then of their rule's place in ``rules``."""
    queries = {n: q for n, q in enumerate(trigram_query(r.pattern) for r in rules) if q is not None}
    trigrams = sorted({t for q in queries.values() for t in _trigrams(q)})
    rows = docs.select(F.col(id_col).alias("id"), no_text(text_col).alias("text"))
    if trigrams:
        postings = write_postings(docs, trigrams, scratch, id_col, text_col)
        maybe = candidates(postings, queries).withColumnRenamed("id", "_id")
        # One plan at every size: the candidates grow with the documents and are never broadcast.
        rows = rows.join(maybe.hint("merge"), F.col("id").eqNullSafe(F.col("_id")), "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for n, rule in enumerate(rules):
        read = F.col("text").rlike(rule.pattern)
        if n in queries:
            read = F.coalesce(F.array_contains("rules", n), F.lit(False)) & read
        found.append(F.when(read, _spans(F.col("text"), rule, n)).otherwise(none))
    return rows.select("id", F.array_sort(F.concat(*found)).alias("found"))


def as_text(found: Column, rules: Sequence[Rule] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    parts = F.transform(found, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"]))
    return F.concat_ws(",", parts)
