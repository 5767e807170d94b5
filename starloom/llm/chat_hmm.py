"""Parses chat transcripts: a hidden Markov model recovers who speaks, Viterbi finds the likeliest reading.

A transcript is a sequence of lines. The state of a line is a role, and whether the line begins a turn or goes
on with one. What is seen of a line are its speaker marker ("User:", "[assistant]", "Q:", ...) and features: how
it begins and ends, its length, whether it is empty. The model's probabilities are smoothed counts over labelled
conversations, gathered by Spark; only these counts come to the driver, and their number is fixed.

A transcript arrives in segments (conversation, position, text); a segment is any number of lines. No task holds a whole
transcript: for each segment, a matrix tells the best log-probability from any state before it to any state at its
end. Such matrices multiply (with maximum for sum, and sum for product), so 256 neighbouring segments become one, and so on
until a conversation has few. Then the states at the edges of the best path are found from the top down, and within each
segment last. The path is the same as that of one long Viterbi run, but for ties.

Turns are rendered as a role line and the turn's lines without the marker, lines that look like role lines behind a
backslash, so that `turns` reads back just the turns that were found; the renderings of a conversation's segments, in
order of position, make up the whole.

Null texts are empty, and an empty text is one empty line. A null position comes before all others, null conversations
are one conversation. Rows that share a conversation and a position are one segment, their texts in ascending order. Roles
that the model does not know are not learned from. Without anything to learn from, all roles are equally likely.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import no_text, whole_groups
from starloom.workspace import Workspace

ROLES = ("system", "user", "assistant")
#: The words that name a speaker.
NAMES = {
    "system": ("system", "sys", "instruction", "instructions"),
    "user": ("user", "human", "customer", "question", "q", "prompter", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model"),
}
#: Positions that share a matrix, as a power of two, and matrices of a conversation that one task may hold.
SHIFT, FEW = 8, 4_096
#: Added to every count, and to that of a role's name where another role or no turn begins; and the share of a role's turns that may be followed by any turn, seen or not.
SMOOTHING, WRONG_NAME, SPREAD = 0.5, 0.01, 0.02

_ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
_MARKER = re.compile(
    r"[\s>#]*(?:<\|(\w+)\|>|\[(\w+)\]:?|<(\w+)>|\*{1,2}(\w+):?\*{1,2}:?|(\w+)\s?[:>])[ \t]?", re.ASCII
)
_ROLE_LINE = re.compile(rf"(\\*)<\|({'|'.join(ROLES)})\|>")
#: Values of each feature.
SIZES = (len(ROLES) + 2, 5, 4, 8)


def marker(line: str) -> tuple[int, int]:
    """The role that a speaker marker names (the number of roles: another name; one more: none) and its end."""
    found = _MARKER.match(line)
    if not found:
        return len(ROLES) + 1, 0
    name = next(g for g in found.groups() if g is not None).lower()
    role = _ROLE_OF.get(name)
    return (ROLES.index(role), found.end()) if role else (len(ROLES), 0)


def observed(line: str) -> tuple[int, int, int, int]:
    """Marker, first character, last character and length of a line, as small numbers."""
    first, last = line[:1], line.rstrip()[-1:]
    begin = 0 if not first else 1 if first.isupper() else 2 if first.isalpha() else 3 if first.isdigit() else 4
    end = 0 if not last else 1 if last in ".!" else 2 if last == "?" else 3
    return marker(line)[0], begin, end, min(len(line).bit_length(), 7)


@dataclass(frozen=True)
class Model:
    """Log-probabilities. States are begin and go on for each role, and a last one, before the first line."""

    moves: np.ndarray
    seen: tuple[np.ndarray, ...]

    def emission(self, line: tuple[int, int, int, int]) -> np.ndarray:
        return sum(table[:, value] for table, value in zip(self.seen, line))

    @property
    def states(self) -> int:
        return len(self.moves)


def model_of(went_on: Counter, follows: Counter, first: Counter, seen: Counter) -> Model:
    """From counts: lines that go on (role), turns after turns (role, role), first turns (role),
    and features (state, feature, value)."""
    roles = range(len(ROLES))
    states = 2 * len(ROLES) + 1
    moves = np.full((states, states), -np.inf)
    for r in roles:
        any_turn = SMOOTHING + SPREAD * sum(follows[r, q] for q in roles)
        counts = np.array([went_on[r] + SMOOTHING, *(follows[r, q] + any_turn for q in roles)])
        logs = np.log(counts / counts.sum())
        for state in (2 * r, 2 * r + 1):
            moves[state, 2 * r + 1] = logs[0]
            moves[state, [2 * q for q in roles]] = logs[1:]
    counts = np.array([first[q] + SMOOTHING for q in roles])
    moves[-1, [2 * q for q in roles]] = np.log(counts / counts.sum())
    tables = []
    for f, size in enumerate(SIZES):
        added = np.full((states - 1, size), SMOOTHING)
        if f == 0:
            added[:, : len(ROLES)] = WRONG_NAME
            added[[2 * r for r in roles], list(roles)] = SMOOTHING
        counts = np.array([[seen[s, f, v] for v in range(size)] for s in range(states - 1)], float)
        if f > 0:
            # What no line showed is as unlikely in a common state as in a rare one.
            added += SPREAD * counts.sum(1, keepdims=True) / size
        counts += added
        tables.append(np.vstack([np.log(counts / counts.sum(1, keepdims=True)), np.full(size, -np.inf)]))
    return Model(moves, tuple(tables))


# Segments.


def _key(col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def segments(rows: DataFrame, conv_col: str, pos_col: str, text_col: str, role_col: str | None = None) -> DataFrame:
    """conv (a key), id (the conversation as it is), pos, texts, and the role, if there is one and the same."""
    role = F.lit(None).cast("string") if role_col is None else F.col(role_col)
    keyed = rows.select(
        _key(conv_col).alias("conv"),
        F.col(conv_col).alias("id"),
        F.col(pos_col).cast("long").alias("told_pos"),
        no_text(text_col).alias("text"),
        role.alias("role"),
    )
    place = F.coalesce(F.col("told_pos"), F.lit(-(2**63))).alias("pos")
    one = F.when(F.min("role") == F.max("role"), F.min("role")).alias("role")
    texts = F.sort_array(F.collect_list("text")).alias("texts")
    return keyed.groupBy("conv", "id", "told_pos", place).agg(texts, one)


def _lines(texts: Sequence[str]) -> list[str]:
    return [line for text in texts for line in text.split("\n")]


# Learning.


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of what lines show, by state."""
    for batch in batches:
        counts: Counter = Counter()
        for role, texts in zip(batch.column("role").to_pylist(), batch.column("texts").to_pylist()):
            r = ROLES.index(role)
            for k, line in enumerate(_lines(texts)):
                state = 2 * r + (k > 0)
                counts[state, len(SIZES), 0] += 1
                for f, value in enumerate(observed(line)):
                    counts[state, f, value] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)] + [pa.array(list(counts.values()), pa.int64())],
            ["state", "feature", "value", "n"],
        )


def train(labelled: DataFrame) -> Model:
    """labelled: of segments(), with roles; those that the model does not know are passed over."""
    known = labelled.where(F.col("role").isin(*ROLES))
    lines = known.select("role", "texts").mapInArrow(_counted, "state int, feature int, value int, n long")
    counts = lines.groupBy("state", "feature", "value").agg(F.sum("n").alias("n")).collect()
    seen = Counter({(c.state, c.feature, c.value): c.n for c in counts if c.feature < len(SIZES)})
    states = Counter({c.state: c.n for c in counts if c.feature == len(SIZES)})
    # Turns that follow each other: within parts of a conversation, and from part to part.
    turns = known.select("conv", "pos", "role", F.shiftright("pos", SHIFT).alias("part"))
    within = Window.partitionBy("conv", "part").orderBy("pos")
    inner = turns.select(F.lag("role").over(within).alias("a"), F.col("role").alias("b"))
    edges = turns.groupBy("conv", "part").agg(F.min_by("role", "pos").alias("low"), F.max_by("role", "pos").alias("high"))
    across = Window.partitionBy("conv").orderBy("part")
    outer = edges.select(F.lag("high").over(across).alias("a"), F.col("low").alias("b"))
    pairs = inner.union(outer).where("a IS NOT NULL").groupBy("a", "b").count().collect()
    follows = Counter({(ROLES.index(p.a), ROLES.index(p.b)): p["count"] for p in pairs})
    starts = turns.groupBy("conv").agg(F.min_by("role", "pos").alias("role")).groupBy("role").count().collect()
    first = Counter({ROLES.index(s.role): s["count"] for s in starts})
    went_on = Counter({r: states[2 * r + 1] for r in range(len(ROLES))})
    return model_of(went_on, follows, first, seen)


# Decoding.


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of matrices or vectors with maximum for sum and sum for product."""
    return (a[..., :, None] + b).max(-2)


class Reader:
    """Steps of a model, line by line; what lines show repeats, so their steps are kept."""

    def __init__(self, model: Model):
        self.model = model
        self.step = lru_cache(maxsize=4096)(self._step)

    def _step(self, line: tuple[int, int, int, int]) -> np.ndarray:
        return self.model.moves + self.model.emission(line)[None, :]

    def matrix(self, lines: list[str]) -> np.ndarray:
        out = None
        for line in lines:
            step = self.step(observed(line))
            out = step if out is None else _times(out, step)
        return out


def _path(steps: Sequence[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states at the end of each step on the best path from ``entry``, which ends in ``leave``, or anywhere if that is negative."""
    score, back = steps[0][entry], []
    for step in steps[1:]:
        ways = score[:, None] + step
        back.append(ways.argmax(0))
        score = ways.max(0)
    path = [int(score.argmax()) if leave < 0 else leave]
    for pointers in reversed(back):
        path.append(int(pointers[path[-1]]))
    return path[::-1]


def _matrices(rows: pa.Table, states: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("matrix").to_pylist()), float).reshape(-1, states, states)


def _levels(matrices: DataFrame, scratch: Workspace, states: int) -> list[DataFrame]:
    """Tables (conv, pos, matrix), each with the products of 256 positions of the one before."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["conv", "up"]):
            conv, up, all_of = rows.column("conv").to_pylist(), rows.column("up").to_pylist(), _matrices(rows, states)
            out = []
            for low, high in zip(cuts, cuts[1:]):
                product = all_of[low]
                for k in range(low + 1, high):
                    product = _times(product, all_of[k])
                out.append((conv[low], up[low], product.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                ["conv", "pos", "matrix"],
            )

    levels = [matrices]
    while (levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > (FEW if len(levels) > 1 else 0):
        rows = levels[-1].withColumn("up", F.shiftright("pos", SHIFT))
        ordered = rows.repartition("conv", "up").sortWithinPartitions("conv", "up", "pos")
        levels.append(scratch.save(ordered.mapInArrow(multiply, "conv string, pos long, matrix binary"), "level"))
    return levels


_EDGES = "conv string, pos long, entry int, leave int"


def _descend(states: int):
    """The states before and after each row, from those before and after its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["conv", "up"]):
            all_of = _matrices(rows, states)
            entry, leave = rows.column("entry").to_pylist(), rows.column("leave").to_pylist()
            before, after = [], []
            for low, high in zip(cuts, cuts[1:]):
                path = _path(all_of[low:high], entry[low], leave[low])
                before += [entry[low], *path[:-1]]
                after += path
            yield pa.RecordBatch.from_arrays(
                [
                    _flat(rows, "conv"),
                    _flat(rows, "pos"),
                    pa.array(before, pa.int32()),
                    pa.array(after, pa.int32()),
                ],
                ["conv", "pos", "entry", "leave"],
            )

    return run


def _flat(rows: pa.Table, name: str) -> pa.Array:
    column = rows.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _edges(levels: list[DataFrame], scratch: Workspace, states: int) -> DataFrame:
    """conv, pos, entry, leave for every row of the lowest level."""
    top = levels[-1].selectExpr("*", "CAST(0 AS bigint) AS up", f"{states - 1} AS entry", "-1 AS leave")
    ordered = top.repartition("conv").sortWithinPartitions("conv", "up", "pos")
    edges = scratch.save(ordered.mapInArrow(_descend(states), _EDGES), "edges")
    for rows in reversed(levels[:-1]):
        above = edges.withColumnRenamed("pos", "up")
        inside = rows.withColumn("up", F.shiftright("pos", SHIFT)).join(above, ["conv", "up"])
        ordered = inside.repartition("conv", "up").sortWithinPartitions("conv", "up", "pos")
        edges = scratch.save(ordered.mapInArrow(_descend(states), _EDGES), "edges")
    return edges


def rendered(lines: list[str], path: list[int]) -> str:
    """A role line before each turn, and the turn's first line without its marker.

    A line of a turn that looks like a role line, with any number of backslashes before it, gets one more.
    """
    out = []
    for line, state in zip(lines, path):
        if state % 2 == 0:
            out.append(f"<|{ROLES[state // 2]}|>")
            line = line[marker(line)[1] :]
        out.append("\\" + line if _ROLE_LINE.fullmatch(line) else line)
    return "".join(line + "\n" for line in out)


def turns(text: str) -> list[tuple[str | None, list[str]]]:
    """The turns of a rendering, role and lines; the role is None for lines before the first role line."""
    out: list[tuple[str | None, list[str]]] = []
    for line in text.split("\n")[:-1]:
        found = _ROLE_LINE.fullmatch(line)
        if found and not found[1]:
            out.append((found[2], []))
            continue
        if not out:
            out.append((None, []))
        out[-1][1].append(line[1:] if found else line)
    return out


def parse(found: DataFrame, model: Model, scratch: Workspace) -> DataFrame:
    """found: of segments(), saved. For each: id, pos (as told), roles and begins (of its lines) and rendered."""
    shared = found.sparkSession.sparkContext.broadcast(model)  # its size follows from ROLES and SIZES
    states = model.states

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            out = [reader.matrix(_lines(t)).tobytes() for t in batch.column("texts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("pos"), pa.array(out, pa.binary())], ["conv", "pos", "matrix"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            roles, begins, texts = [], [], []
            for t, entry, leave in zip(*(batch.column(c).to_pylist() for c in ("texts", "entry", "leave"))):
                lines = _lines(t)
                path = _path([reader.step(observed(line)) for line in lines], entry, leave)
                roles.append([ROLES[s // 2] for s in path])
                begins.append([s % 2 == 0 for s in path])
                texts.append(rendered(lines, path))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("told_pos"), pa.array(roles, pa.list_(pa.string())), pa.array(begins, pa.list_(pa.bool_())), pa.array(texts, pa.string())],
                ["id", "pos", "roles", "begins", "rendered"],
            )

    matrices = scratch.save(found.select("conv", "pos", "texts").mapInArrow(measure, "conv string, pos long, matrix binary"), "matrices")
    edges = _edges(_levels(matrices, scratch, states), scratch, states)
    rows = found.join(edges, ["conv", "pos"]).select("id", "told_pos", "texts", "entry", "leave")
    kind = found.schema["id"].dataType.simpleString()
    return rows.mapInArrow(read, f"id {kind}, pos long, roles array<string>, begins array<boolean>, rendered string")


def as_transcript(turns: DataFrame, conv_col: str = "conv_id", pos_col: str = "turn", lost: int = 4) -> DataFrame:
    """Turns with their role turned into a speaker marker of the conversation's own style; one in ``lost`` has none.

    For trials of the parser on conversations with known roles.
    """
    styles = [("{}: ", True), ("[{}] ", False), ("<|{}|>", False), ("**{}:** ", True), ("> {}: ", False)]
    style = F.pmod(F.xxhash64(conv_col), F.lit(len(styles)))
    name = F.coalesce(F.col("role"), F.lit("user"))
    mark = F.lit("")
    for k, (form, capital) in enumerate(styles):
        before, after = form.split("{}")
        shown = F.initcap(name) if capital else name
        mark = F.when(style == k, F.concat(F.lit(before), shown, F.lit(after))).otherwise(mark)
    kept = F.pmod(F.xxhash64(conv_col, pos_col), F.lit(lost)) != 0
    return turns.withColumn("text", F.concat(F.when(kept, mark).otherwise(F.lit("")), no_text("text")))
