"""Document fingerprints by a randomised embedding of edit distance into Hamming distance, sampled and banded.

A walk goes over the characters of a text: at each step it notes the character it stands on, then moves on or stays, as a
random bit of the step and the character's class says. All texts share these bits, so two texts walk together over what
they have in common, and after an insertion or deletion their walks fall into step again: what they note differs in about as
many places as few edits allow. The noted sequence, about two steps for each character, is never written out: the walk over
the whole text gives the step at which each character is left, and the character noted at a sampled step is looked up in it.

Sampled steps are the first ``DENSE`` and then ``DENSE`` of every octave of steps, one at random from each of equal parts of it,
so every stretch of a text of any length is seen; each sample is one hex digit, a digest of the character. The digits of the steps
that a text reaches are its fingerprint. The likeness of two fingerprints is the share of steps with equal digits, each sample
standing for its part of the octave, over the longer one's steps.

``near_documents`` finds copies, and leaves out none: equal fingerprints are one node. Digits are cut into bands, and those of
a fingerprint are so many that not all can have two unequal digits in fingerprints that are alike; so two such nodes agree in a band
but for one digit of it, and share the band without that digit. Rows of a band carry the node's last digits, so that nodes which
share it by chance are told apart where they meet, in numbers and not as rows: a task has a band's rows in order and passes
each node's smaller others. What may be alike by the last digits is compared as whole fingerprints, of each band first the
smallest other of a node, then, where these leave it open, all that are smaller than the smallest found. So a band that a third of
all nodes have in common costs a row for each of them if they are copies; it is looked at pair by pair as far as they are unlike.

Null texts count as empty and have the empty fingerprint, like only to itself. Repeated rows stay. Texts are walked whole, one
Arrow batch at a time: a few bytes for each character of one text besides the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import mix64
from starloom.operators.checks import stack_rows
from starloom.operators.ordering import number_rows
from starloom.workspace import Workspace

#: Samples of each octave of steps; all steps below this number.
DENSE = 32
#: Steps after which the bits of the walk repeat, and classes of characters that share bits.
PERIOD, CLASSES = 4_096, 16
OCTAVES = 40
#: Characters that are walked over at once.
PART = 1_000_000
#: Digits of a band; one of them may differ. Bits of its place, and of a number of digits.
BAND_DIGITS, WITHOUT_BITS, COUNT_BITS = 8, 3, 11
#: Bands are met in so many rounds, so that only a share of their rows is in an exchange at any time.
ROUNDS = 4
#: Others that a node gets of each band before any is compared as a whole.
LIMIT = 1
#: Rows of bands, and pairs of them, that a task looks at in one go.
ROWS, PAIRS = 50_000, 100_000
#: Last digits that decide whether a pair is compared as a whole.
TAIL = 32
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def _random(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_CLASS_OF = (_random(7, 1 << 16) % np.uint64(CLASSES)).astype(np.uint8)


@cache
def sampled_steps() -> tuple[np.ndarray, np.ndarray]:
    """The sampled steps in order, and how many steps each stands for."""
    steps, parts = [np.arange(DENSE)], [np.ones(DENSE)]
    for octave in range(OCTAVES):
        part = 2**octave
        first = DENSE * part + part * np.arange(DENSE)
        steps.append(first + (_random(octave + 1, DENSE) % np.uint64(part)).astype(np.int64))
        parts.append(np.full(DENSE, float(part)))
    return np.concatenate(steps), np.concatenate(parts)


@cache
def _walks() -> tuple[list[list[int]], np.ndarray]:
    """Where a step leads that begins a character: by pair of classes for two characters, and by class for one."""
    moves = (_random(99, CLASSES * PERIOD) >> np.uint64(63)).astype(bool).reshape(CLASSES, PERIOD)
    one = np.zeros((CLASSES, PERIOD), np.int64)
    for c in range(CLASSES):
        at = np.flatnonzero(moves[c])
        later = np.concatenate((at, at[:1] + PERIOD))
        one[c] = (later[np.searchsorted(at, np.arange(PERIOD))] + 1) % PERIOD
    two = one[None, :, :].repeat(CLASSES, 0)
    for c in range(CLASSES):
        two[c] = one[:, one[c]]
    return two.reshape(-1, PERIOD).tolist(), one


def walk(letters: np.ndarray, start: int = 0) -> np.ndarray:
    """The step after which each character is left, for code points; the walk begins at step ``start``."""
    two, one = _walks()
    ends = np.zeros(len(letters) + 1, np.int64)
    ends[0] = step = start % PERIOD
    for at in range(0, len(letters), PART):
        classes = _CLASS_OF[letters[at : at + PART] & 0xFFFF]
        even = len(classes) // 2 * 2
        out = []
        note = out.append
        for pair in (classes[0:even:2] * CLASSES + classes[1:even:2]).tobytes():
            step = two[pair][step]
            note(step)
        part = ends[at : at + len(classes) + 1]
        part[2 : even + 1 : 2] = out
        part[1 : even + 1 : 2] = one[classes[0:even:2], part[0:even:2]]
        if even < len(classes):
            part[-1] = step = int(one[classes[-1], part[-2]])
    dwell = np.diff(ends) % PERIOD
    return start + np.cumsum(np.where(dwell == 0, PERIOD, dwell))


def noted(letters: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The digits, 0 to 15, of the sampled steps that the walk reaches."""
    steps, _ = sampled_steps()
    last = int(left[-1]) if len(left) else 0
    at = np.searchsorted(left, steps[: np.searchsorted(steps, last)], side="right")
    return (mix64(letters[at] + np.uint64(1 << 32)) >> np.uint64(60)).astype(np.uint8)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of steps at which two fingerprints' digits are equal."""
    _, parts = sampled_steps()
    both, most = min(len(a), len(b)), max(len(a), len(b))
    return float(parts[:both][a[:both] == b[:both]].sum() / parts[:most].sum()) if most else 1.0


def as_text(digits: np.ndarray) -> str:
    return DIGITS[digits].tobytes().decode()


def as_digits(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    return np.where(raw >= 97, raw - 87, raw - 48).astype(np.uint8)


def fingerprint(text: str | None) -> str:
    letters = code_points(text or "")
    return as_text(noted(letters, walk(letters)))


def _text(value) -> str:
    return "" if value is None else value.decode("utf-8", "replace")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars and fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = [], []
            for value in batch.column("text"):
                letters = code_points(_text(value.as_py()))
                n.append(len(letters))
                found.append(as_text(noted(letters, walk(letters))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(found, pa.string())], ["id", "n_chars", "fingerprint"])

    given = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, n_chars long, fingerprint string")


class _Row:
    """A document with its walk, as it waits for the next one."""

    def __init__(self, key, raw):
        self.key, self.text = key, _text(raw)
        self.letters = code_points(self.text)
        self.left = walk(self.letters)
        self.digits = noted(self.letters, self.left)

    def edited(self, following: "_Row") -> dict:
        n = len(self.letters)
        kept = n - n // 3
        tail = following.letters[: n // 3]
        letters = np.concatenate((self.letters[:kept], tail))
        # The walk over what is kept is the same.
        left = np.concatenate((self.left[:kept], walk(tail, int(self.left[kept - 1]) if kept else 0)))
        digits = noted(letters, left)
        return {
            "n_chars": n,
            "edited_sha256": sha256((self.text[:kept] + following.text[: n // 3]).encode()).hexdigest(),
            "fingerprint": as_text(self.digits),
            "edited_fingerprint": as_text(digits),
            "near_edited": likeness(self.digits, digits),
            "near_next": likeness(self.digits, following.digits),
        }


def edited_fingerprints(docs: DataFrame, scratch: Workspace, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, and that of its text with the last third replaced by the beginning of the next row's.

    id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Next is the row with the next
    smaller id, null ids last, equal ids in order of a digest of their texts; the first one follows the last.

    Texts are range-partitioned by that order once, and each task goes over its rows in order. Only the first and the last
    row of each partition leave it as texts: the last one meets the first of the next partition afterwards.
    """
    # The last key spreads rows that are equal in all else, in the order of the table's files.
    given = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))
    keyed = given.withColumns({"_digest": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last("id"), F.asc("_digest"), F.asc("_place")]
    splits = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(splits, *order).sortWithinPartitions(*order).withColumn("_split", F.spark_partition_id())

    result = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [part.split()[0] for part in result.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: _Row | None = None
        split = None

        def edge(row: _Row, side: str) -> dict:
            return {"id": row.key, "split": split, "side": side, "text": row.text.encode()} | dict.fromkeys(names)

        for batch in batches:
            out = []
            for key, text, split in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "_split"))):
                row = _Row(key, text)
                if before is None:
                    out.append(edge(row, "first"))
                else:
                    out.append({"id": before.key, "split": split, "side": None, "text": None} | before.edited(row))
                before = row
            yield _batch(out)
        if before is not None:
            yield _batch([edge(before, "last")])

    kinds = f"id long, split int, side string, text binary, {result}"

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        schema = pa.schema(list(zip(["id", "split", "side", "text", *names], types)))
        return pa.RecordBatch.from_pylist(rows, schema)

    found = scratch.save_and_release(ordered.mapInArrow(run, kinds), "fingerprints")
    inner = found.where("side IS NULL").select("id", *names)

    # One row of each side for every partition that has rows; the next partition's first row follows the last one's.
    edges = found.where("side IS NOT NULL").select("id", "split", "side", "text")
    numbers = edges.where("side = 'last'").select("split")
    following = numbers.select("split", F.expr("coalesce(lead(split) OVER (ORDER BY split), min(split) OVER ())").alias("after"))
    last = edges.where("side = 'last'").select("id", "split", "text")
    first = edges.where("side = 'first'").select(F.col("id").alias("next_id"), F.col("split").alias("after"), F.col("text").alias("next_text"))
    pairs = last.join(following, "split").join(first, "after").select("id", "text", "next_id", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"id": r["id"]} | _Row(r["id"], r["text"]).edited(_Row(r["next_id"], r["next_text"])) for r in batch.to_pylist()
            ]
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(["id", *names], types))))

    return inner.unionByName(pairs.mapInArrow(close, f"id long, {result}"))


@cache
def _weights() -> np.ndarray:
    """How many steps fingerprints of 0, 1, 2, ... digits stand for."""
    return np.concatenate(([0.0], np.cumsum(sampled_steps()[1])))


@cache
def scheme(n: int, least: float) -> tuple[int, np.ndarray]:
    """How many digits a band has for pairs whose shorter fingerprint has ``n``, and what unequal digits it takes to spoil the last, the
    last two, ... of the bands that it has whole.

    Bands of a size lie side by side from the first digit on, for all fingerprints alike. To spoil a band takes two of its
    digits. No digits: there are no bands that cannot all be spoilt in fingerprints that are alike.
    """
    _, parts = sampled_steps()
    for digits in range(BAND_DIGITS, 1, -1):
        whole = parts[: n // digits * digits].reshape(-1, digits)
        spoilt = np.cumsum(np.sort(whole, 1)[::-1, :2].sum(1))
        if len(spoilt) and spoilt[-1] > (1 - least) * _weights()[n] * (1 + 1e-9):
            return digits, spoilt
    return 0, np.zeros(0)


@cache
def _bands(n: int, least: float) -> list[tuple[int, int]]:
    """The bands of a fingerprint of ``n`` digits, as (digits of a band, number): those in which it meets any that is as long or shorter.

    Unequal digits that a pair has both may stand for no more than what the shorter one's steps exceed ``least`` of the longer
    one's by. Bands are taken from the shorter one's last digits on, which weigh most, until spoiling all takes more.
    """
    weights, found = _weights(), set()
    fewest = max(int(np.searchsorted(weights, least * weights[n] * (1 - 1e-9))), 1)
    for shorter in range(fewest, n + 1):
        digits, spoilt = scheme(shorter, least)
        most = weights[shorter] - least * weights[n] + 1e-9 * weights[n]
        taken = int(np.searchsorted(spoilt, most, side="right")) + 1
        # Without bands, all that meet this length do so in one.
        found.update((digits, shorter // digits - 1 - k) for k in range(taken)) if digits else found.add((0, shorter))
    return sorted(found)


@cache
def _picks(n: int, least: float, turn: int, turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the digits of a round's bands without one digit each, what tells the keys made of them apart, and that digit's place."""
    rows, tags, left_out = [], [], []
    for digits, number in _bands(n, least):
        if number % turns != turn:
            continue
        places = np.arange(digits * number, digits * (number + 1))
        for without in range(max(digits, 1)):
            left = np.delete(places, without) if digits else places
            rows.append(np.concatenate((left, np.full(BAND_DIGITS - 1 - len(left), -1))))
            tags.append(((digits << 11) + number << WITHOUT_BITS) + without)
            left_out.append(places[without] if digits else -1)
    keys = np.array(tags, np.int64) << 4 * (BAND_DIGITS - 1)
    return np.array(rows, np.int64).reshape(-1, BAND_DIGITS - 1), keys, np.array(left_out, np.int64)


def _keys(digits: np.ndarray, least: float, turn: int, turns: int) -> tuple[np.ndarray, np.ndarray]:
    """``band_keys``, and the digit that each leaves out."""
    if not len(digits):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.append(digits, 0).astype(np.int64)
    powers = 1 << 4 * np.arange(BAND_DIGITS - 1, dtype=np.int64)
    places, tags, left_out = _picks(len(digits), least, turn, turns)
    return padded[places] @ powers + tags, padded[left_out]


def band_keys(digits: np.ndarray, least: float, turn: int = 0, turns: int = 1) -> np.ndarray:
    """Numbers of which fingerprints alike to ``least`` share one or more: band, the digit left out, the other digits.

    Every band has its turn in one of ``turns`` rounds.
    """
    return _keys(digits, least, turn, turns)[0]


def banded(nodes: DataFrame, least: float, turn: int = 0, turns: int = 1) -> DataFrame:
    """A row for every band of (node, print, and what else there is as a long) that has its turn: band, code, high, low, and the rest.

    The code is made of the node, the digit that the band's key leaves out, and the number of digits; the last digits are
    packed as in ``packed``.
    """
    rest = [c for c in nodes.columns if c not in ("node", "print")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                keys = [_keys(as_digits(p), least, turn, turns) for p in batch.column("print").to_pylist()]
                rows = np.repeat(np.arange(len(keys)), [len(k) for k, _ in keys])
                node, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "n"))
                left_out = np.concatenate([k for _, k in keys])
                code = (node[rows] << 4 | left_out) << COUNT_BITS | n[rows]
                high, low = packed(n, _unpacked(batch.column("tail"))).view(np.int64).T
                made = [np.concatenate([k for k, _ in keys]), code, high[rows], low[rows]]
                made += [batch.column(c).to_numpy(zero_copy_only=False)[rows] for c in rest]
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()) for m in made], ["band", "code", "high", "low", *rest])

    kinds = ", ".join(f"{c} long" for c in ("band", "code", "high", "low", *rest))
    return _tails(nodes, "print", *rest).mapInArrow(run, kinds)


def node_of(code: str) -> Column:
    return F.shiftright(code, COUNT_BITS + 4)


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("own").to_pylist(), batch.column("other").to_pylist())
            alike = [likeness(as_digits(a), as_digits(b)) >= least for a, b in pairs]
            yield batch.select(["node", "other_node"]).filter(pa.array(alike, pa.bool_()))

    return run


def _tails(nodes: DataFrame, *rest: str) -> DataFrame:
    """node, n, tail, and the rest: the number of digits of (node, print), and the last of them, two in a byte."""
    end = F.substring("print", -TAIL, TAIL)
    return nodes.select("node", F.length("print").alias("n"), F.unhex(F.rpad(end, TAIL, "0")).alias("tail"), *rest)


def packed(n: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Tails as two 64-bit numbers each, with digit p of a fingerprint at place p modulo TAIL."""
    begin = np.where(n >= TAIL, n, 0)[:, None]
    turned = np.take_along_axis(tails, (np.arange(TAIL) - begin) % TAIL, 1)
    return (turned[:, 0::2] << 4 | turned[:, 1::2]).astype(np.uint8).view(np.uint64)


@cache
def _masks() -> np.ndarray:
    """By two places: the numbers that have the places from the first up to the second, one bit of each digit."""
    at = np.arange(TAIL)
    begin, end = np.divmod(np.arange((TAIL + 1) ** 2), TAIL + 1)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    return packed(np.zeros(len(begin), np.int64), inside.astype(np.uint8))


def _possible(n: np.ndarray, tails: np.ndarray, other_n: np.ndarray, other_tails: np.ndarray, least: float) -> np.ndarray:
    """``may_be_alike`` of packed tails. Their TAIL digits lie in one octave or two, whose digits weigh the same."""
    _, parts = sampled_steps()
    weights, masks = _weights(), _masks()
    low, high = np.minimum(n, other_n), np.maximum(n, other_n)
    begin = np.minimum(np.maximum(high - TAIL, 0), low)
    # The first digit of the last octave of what both have.
    octave = (np.maximum(low, 1) - 1) // TAIL * TAIL
    later = masks[(np.maximum(begin, octave) - octave) * (TAIL + 1) + low - octave]
    earlier = masks[np.where(begin < octave, begin % TAIL, TAIL) * (TAIL + 1) + TAIL]
    differ = tails ^ other_tails
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    counts = [np.bitwise_count(differ & m).sum(1, dtype=np.int64) for m in (later, earlier)]
    unequal = weights[high] - weights[low] + counts[0] * parts[octave] + counts[1] * parts[np.maximum(octave - 1, 0)]
    return unequal <= (1 - least) * weights[high] * (1 + 1e-9) + 1e-9


def may_be_alike(n: np.ndarray, tails: np.ndarray, other_n: np.ndarray, other_tails: np.ndarray, least: float) -> np.ndarray:
    """Whether what two fingerprints' numbers of digits and last digits tell leaves a likeness of ``least`` possible.

    ``tails`` are rows of TAIL digits that begin at digit n - TAIL, or at the first one. Places that only one tail has count as
    equal, those past the shorter fingerprint as unequal.
    """
    return _possible(n, packed(n, tails), other_n, packed(other_n, other_tails), least)


def _unpacked(column: pa.Array) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TAIL // 2)
    return np.stack((raw >> 4, raw & 15), 2).reshape(-1, TAIL)


def whole_packed(prints: list[str]) -> np.ndarray:
    """Fingerprints as 64-bit numbers of 16 digits, as many as the longest takes."""
    width = -(-max(map(len, prints), default=0) // 16) * 16
    return np.frombuffer(bytes.fromhex("".join(p.ljust(width, "0") for p in prints)), np.uint64).reshape(len(prints), width // 16)


@cache
def _whole_masks() -> np.ndarray:
    """By number of digits, one bit of each."""
    return whole_packed(["1" * n for n in range(len(sampled_steps()[0]) + 1)])


def _alike(n: np.ndarray, prints: np.ndarray, other_n: np.ndarray, other_prints: np.ndarray, least: float) -> np.ndarray:
    """Whether ``likeness`` is ``least`` or more, of whole packed fingerprints; digits of a number weigh the same."""
    _, parts = sampled_steps()
    weights, low, high = _weights(), np.minimum(n, other_n), np.maximum(n, other_n)
    differ = prints ^ other_prints
    differ |= differ >> np.uint64(1)
    differ |= differ >> np.uint64(2)
    counts = np.bitwise_count(differ & _whole_masks()[low, : prints.shape[1]])
    return (weights[low] - counts @ parts[: 16 * prints.shape[1] : 16]) / weights[high] >= least


def _joined(prints: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in prints)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in prints])


def meetings(rows: dict[str, np.ndarray], least: float, limit: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For rows of ``banded`` in order of band and code, whole bands: node, other_node, more, band of pairs that may be alike.

    The other is smaller. A node has its ``limit`` smallest others of each band, and ``more`` with the last of them: there may be others
    after it. With ``most``, others are smaller than that; with packed ``print``, pairs are alike. A pair that agrees in all of a
    band shares every key of it, and is looked at under the first.
    """
    band, code = rows["band"], rows["code"]
    tails = np.stack((rows["high"], rows["low"]), 1).view(np.uint64)
    n, left_out, node = code & (1 << COUNT_BITS) - 1, code >> COUNT_BITS & 15, code >> COUNT_BITS + 4
    most = rows.get("most", node)
    again = (band >> 4 * (BAND_DIGITS - 1) & (1 << WITHOUT_BITS) - 1) > 0
    begin = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
    head = np.repeat(begin, np.diff(np.append(begin, len(band))))
    found = np.zeros(len(band), np.int64)
    step, open_rows = 0, np.arange(len(band))
    while True:
        # The others are passed in order, so what has found enough, or comes to itself, is done.
        at = head[open_rows] + step
        open_rows = open_rows[(at < open_rows) & (node[np.minimum(at, len(node) - 1)] < most[open_rows]) & (found[open_rows] < limit)]
        if not len(open_rows):
            return
        for begin in range(0, len(open_rows), PAIRS):
            own = open_rows[begin : begin + PAIRS]
            other = head[own] + step
            differ = ~again[own] | (left_out[own] != left_out[other])
            own, other = own[differ], other[differ]
            may = _possible(n[own], tails[own], n[other], tails[other], least)
            own, other = own[may], other[may]
            if "print" in rows:
                alike = _alike(n[own], rows["print"][own], n[other], rows["print"][other], least)
                own, other = own[alike], other[alike]
            found[own] += 1
            if len(own):
                yield node[own], node[other], found[own] == limit, band[own]
        step += 1


def _met(least: float, limit: int):
    """``meetings`` of a partition, in which rows of a band follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []

        def pairs() -> Iterator[pa.RecordBatch]:
            rows = {c: (_joined if c == "print" else np.concatenate)([h[c] for h in held]) for c in held[0]}
            for made in meetings(rows, least, limit):
                yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], ["node", "other_node", "more", "band"])

        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in batch.schema.names if c != "print"}
            if "print" in batch.schema.names:
                rows["print"] = whole_packed(batch.column("print").to_pylist())
            band = rows["band"]
            cut = int(np.searchsorted(band, band[-1])) if len(band) else 0
            # A band may go on in the next batch.
            if cut and sum(len(h["band"]) for h in held) + cut >= ROWS:
                held.append({c: v[:cut] for c, v in rows.items()})
                yield from pairs()
                held, rows = [], {c: v[cut:] for c, v in rows.items()}
            held.append(rows)
        if held:
            yield from pairs()

    return run


def near_documents(prints: DataFrame, scratch: Workspace, *, least: float = 0.8) -> DataFrame:
    """The rows (id, fingerprint, and what else there is) with near_id.

    Equal fingerprints are one node, which stands at its smallest id. near_id is the smallest id of all nodes with a likeness of
    ``least`` or more, the node's own included. A node without an id is like none.
    """
    texts = prints.groupBy(F.col("fingerprint").alias("print")).agg(F.min("id").alias("id"))
    # Numbers in order of the id: smaller than a digest in the exchange of the bands.
    nodes = scratch.save(number_rows(texts, "node", ["id", "print"], scratch=scratch), "nodes")
    known = nodes.where("id IS NOT NULL").select("node", "print")

    def meet(rows: DataFrame, limit: int) -> DataFrame:
        """Pairs of rows of bands, written."""
        together = rows.repartition("band").sortWithinPartitions("band", "code")
        met = together.mapInArrow(_met(least, limit), "node long, other_node long, more boolean, band long")
        return scratch.save_and_release(met, "pairs")

    own, other = (known.select(F.col("node").alias(node), F.col("print").alias(name)) for node, name in (("node", "own"), ("other_node", "other")))
    pairs = [meet(banded(known, least, t, ROUNDS), LIMIT) for t in range(ROUNDS)]
    both = stack_rows(pairs).select("node", "other_node").distinct().join(own, "node").join(other, "other_node")
    close = both.mapInArrow(_verified(least), "node long, other_node long")
    first = scratch.save_and_release(close.groupBy("node").agg(F.min("other_node").alias("like")), "first")

    def left_open(met: DataFrame) -> DataFrame:
        """Nodes and bands of a round that may have others which are smaller than the smallest found, after those that were looked at."""
        told = met.where("more").join(first, "node", "left").withColumn("most", F.coalesce("like", "node"))
        return scratch.save_and_release(told.where("other_node < most").select("node", "most", "band"), "open")

    opened = [left_open(met) for met in pairs]
    seeking = scratch.save_and_release(stack_rows(opened).select("node", "most").distinct(), "seeking")
    like = [first]
    if not seeking.isEmpty():
        bounded = known.join(seeking, "node", "left").withColumn("most", F.coalesce("most", F.lit(0)))
        for turn in range(ROUNDS):
            # Written, so that its size decides whether the rows of all bands are moved for this join.
            bands = scratch.save_and_release(opened[turn].select("band").distinct(), "bands")
            rows = banded(bounded, least, turn, ROUNDS).join(bands, "band", "left_semi").withColumn("node", node_of("code"))
            found = meet(rows.join(known, "node").drop("node"), 1)
            like.append(found.groupBy("node").agg(F.min("other_node").alias("like")))
    found = stack_rows(like).groupBy("node").agg(F.min("like").alias("like"))
    near = found.join(nodes.select(F.col("node").alias("like"), F.col("id").alias("like_id")), "like").drop("like")
    final = nodes.join(near, "node", "left").select(F.md5("print").alias("_print"), F.coalesce("like_id", "id").alias("near_id"))
    return prints.withColumn("_print", F.md5("fingerprint")).join(final, "_print").drop("_print")
