"""Sampled segmentation into the pieces of a SentencePiece vocabulary, and lossless decoding.

All ways to cut a text into pieces form a lattice. A cut has the probability of the product of its pieces,
where a piece of merge rank r counts 1 / (r + SHIFT) to the power ``sharpness``. Forward filtering sums the
probabilities of all ways to reach a place; backward sampling then draws the pieces from the end. The draws come from a
hash of the row's key, the word's place in the text and the step, so a row is cut the same way wherever and
whenever it runs. ``sharpness`` of infinity is not offered; large values approach the best cut.

No piece holds a space mark behind another character, so the lattice falls apart before every run of space
marks that follows a word: each such unit is filtered and drawn on its own, and the units that repeat in a batch are
filtered once. All units of a batch are advanced together, place by place.

Text becomes pieces as in the vocabulary's own encoder: a space mark before it, spaces as space marks. To stay
lossless, a character without a piece of its own, and a true space-mark character, become pieces of single
bytes. Decoding joins the pieces, turns space marks into spaces and drops the first.

A null text has no pieces (null), an empty text has none either (an empty list); both decode to what they were. Equal
keys with equal texts are cut alike; a null key is a key. Texts are cut whole, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.llm.common import as_row, in_steps, mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SHIFT = 50.0
SHARPNESS = 1.0
_UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)
#: Stands for a space-mark character of the text itself, which is no space. No UTF-8 text holds it.
_TRUE_MARK = "\udfff"
#: Text whose units are told apart together, and characters of distinct units that are filtered together, about.
#: A lattice takes some 200 bytes for each of its characters.
CUT_BYTES, LATTICE_CHARS = 1_000_000, 150_000
#: Ids that one step decodes, about.
DECODE_IDS = 200_000
#: In place of a piece's id: longer pieces end so, or none does.
ONLY_END, NO_END = -1, -2


class Pieces:
    """The vocabulary: pieces by id, log-probabilities, and a table from the hash of a piece's end to the piece that it is."""

    def __init__(self, model: bytes, sharpness: float = SHARPNESS):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_proto=model)
        n = p.vocab_size()
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int64)
        lengths, texts, ids, ranks = [], [], [], []
        for i in range(n):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
                continue
            if p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
                self.bytes_of.append(b"")
                continue
            self.bytes_of.append(piece.replace(MARK, " ").encode())
            texts.append(piece)
            ids.append(i)
            lengths.append(len(piece))
            ranks.append(max(0.0, -p.get_score(i)))
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no pieces for single bytes")
        if any(MARK in t.lstrip(MARK) for t in texts):
            raise ValueError("a piece has a space mark behind another character")
        self.log_p = np.full(n, -np.inf)
        self.log_p[ids] = -sharpness * np.log(np.array(ranks) + SHIFT)
        self.byte_log_p = -sharpness * np.log(n + SHIFT)
        self.longest = max(lengths)
        # The ends of all pieces, a piece itself among them: a text's end that is none of these ends no piece.
        hashes, of = self._ends(texts, np.array(lengths, np.int64), np.array(ids, np.int32))
        # Open addressing over the 64-bit hashes; a quarter full, so that few steps find or miss one.
        bits = int(np.ceil(np.log2(4 * len(hashes))))
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.keys, self.ids = np.zeros(size, np.uint64), np.full(size, NO_END, np.int32)
        rest, at = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(rest):
            _, one = np.unique(at, return_index=True)  # one of those that want a place
            one = one[self.ids[at[one]] == NO_END]
            self.keys[at[one]], self.ids[at[one]] = hashes[rest[one]], of[rest[one]]
            rest, at = np.delete(rest, one), (np.delete(at, one) + 1) & (size - 1)

    @staticmethod
    def _ends(texts: list[str], lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ends of the pieces, and the id of the piece that each is, or ONLY_END."""
        size, longest = len(texts), int(lengths.max())
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
        back = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
        piece = np.repeat(np.arange(size), lengths)
        terms = np.zeros((size, longest + 1), np.uint64)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(longest, _MULTIPLIER))
            terms[piece, back] = (codes + np.uint64(1)) * powers[back - 1]
            hashes = mix64(np.cumsum(terms, axis=1)[piece, back])
        # Of equal ends, the piece comes first.
        of = np.where(back == lengths[piece], ids[piece], ONLY_END)
        order = np.lexsort((of, of == ONLY_END, hashes))
        hashes, of = hashes[order], of[order]
        first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        return hashes[first], of[first]

    def spellings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces in one array, where each piece's begin, and their number."""
        sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        return np.frombuffer(b"".join(self.bytes_of), np.uint8), np.cumsum(sizes) - sizes, sizes

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, ONLY_END where longer pieces end so, NO_END where none does."""
        h = mix64(h)
        at = (h >> self.shift).astype(np.int64)
        there = self.ids.take(at)
        hit = self.keys.take(at) == h
        out = np.where(hit, there, NO_END)
        rest = np.flatnonzero(~hit & (there != NO_END))  # the others are at a free place
        at = at[rest]
        while len(rest):
            at = (at + 1) & (len(self.ids) - 1)
            hit = self.keys[at] == h[rest]
            out[rest[hit]] = self.ids[at[hit]]
            on = ~hit & (self.ids[at] != NO_END)
            rest, at = rest[on], at[on]
        return out


class Lattice:
    """Forward-filtered lattices of distinct units.

    A place is a number of characters of a unit. Places are numbered by their depth, and within a depth by
    their unit, the longest first: so the places of one depth lie side by side, those of another depth in
    the same order, and all units are advanced by slices. Every place but the first has edges, the pieces
    that end there.
    """

    def __init__(self, pieces: Pieces, units: list[str]):
        self.pieces = pieces
        sizes = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-sizes, kind="stable")
        self.rank = np.empty_like(order)
        self.rank[order] = np.arange(len(order))
        self.sizes = sizes
        self.deepest = int(sizes.max(initial=0))
        #: Units that have a place of each depth, and the number of the depth's first place.
        self.n = np.searchsorted(-sizes[order], -np.arange(self.deepest + 1), side="right")
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        text = "".join(units).encode("utf-32-le", "surrogatepass")
        depth = np.arange(1, len(text) // 4 + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.codes = np.zeros(self.first[-1], np.uint64)
        self.codes[self.first[depth] + np.repeat(self.rank, sizes)] = np.frombuffer(text, "<u4")
        self._filter()

    def _filter(self) -> None:
        """Edges of all places in order, each with the probability of its place's edges up to it."""
        p = self.pieces
        alpha = np.zeros(len(self.codes))
        shares, lengths, ids, counts = [], [], [], [np.zeros(self.n[0], np.int64)]
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for _ in range(p.longest):
                powers.append(powers[-1] * _MULTIPLIER)
            for t in range(1, self.deepest + 1):
                n, most = int(self.n[t]), min(t, p.longest)
                here = self.codes[self.first[t] : self.first[t] + n]
                found = np.full((n, most), NO_END, np.int32)
                # Ends that some piece has are made longer, by the character before; its first character is multiplied most.
                rows, h = np.arange(n), np.zeros(n, np.uint64)
                for l in range(1, most + 1):
                    h += (self.codes[self.first[t - l + 1] + rows] + np.uint64(1)) * powers[l]
                    got = p.find(h)
                    found[rows, l - 1] = got
                    on = got != NO_END
                    rows, h = rows[on], h[on]
                    if not len(rows):
                        break
                # A character without a piece of its own is spelt in bytes.
                fits = found >= 0
                spelt = ~fits[:, 0]
                fits[:, 0] = True
                row, back = np.nonzero(fits)
                piece = found[row, back]
                log_p = np.where(piece >= 0, p.log_p[piece], 0.0) + alpha[self.first[t - 1 - back] + row]
                starts = np.flatnonzero(row[1:] != row[:-1]) + 1
                starts = np.concatenate((np.zeros(1, np.int64), starts))
                code = here[spelt]
                log_p[starts[spelt]] += utf8_length(code) * p.byte_log_p
                count = np.diff(starts, append=len(row))
                top = np.maximum.reduceat(log_p, starts)
                share = np.exp(log_p - np.repeat(top, count))
                total = np.add.reduceat(share, starts)
                alpha[self.first[t] : self.first[t] + n] = top + np.log(total)
                shares.append(share / np.repeat(total, count))
                lengths.append((back + 1).astype(np.int16))
                ids.append(piece)
                counts.append(count)
        count = np.concatenate(counts)
        self.edge_last = np.cumsum(count) - 1
        self.edge_first = self.edge_last - count + 1
        self.length = np.concatenate(lengths) if lengths else np.zeros(0, np.int16)
        self.id = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        share = np.concatenate(shares) if shares else np.zeros(0)
        running = np.cumsum(share)
        row = np.repeat(np.arange(len(count)), count)
        so_far = running - (running - share)[self.edge_first[row]]
        # Place number plus probability so far: one ascending array to look draws up in.
        self.edge_at = row + np.minimum(so_far, 1.0) * (1 - 1e-9)

    def draw(self, unit: np.ndarray, seed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Backward sampling for all occurrences of units together.

        Yields for one step after the other, from the ends of the units, which occurrences still draw, and their
        pieces: an id, or minus one more than a character that is spelt in bytes.
        """
        # In order of places, so that neighbouring draws look at neighbouring numbers.
        rank = self.rank[unit]
        who = np.argsort(rank, kind="stable")
        rank, depth, seed, step = rank[who], self.sizes[unit[who]], seed[who], 0
        while len(who):
            salt = np.uint64(step * int(_GOLDEN) % 2**64)
            u = (mix64(seed + salt) >> np.uint64(11)).astype(float) / (1 << 53)
            place = self.first[depth] + rank
            edge = np.searchsorted(self.edge_at, place + u * (1 - 2e-9), side="left")
            edge = np.clip(edge, self.edge_first[place], self.edge_last[place])
            piece = self.id[edge].astype(np.int64)
            spelt = np.flatnonzero(piece < 0)
            piece[spelt] = -1 - self.codes[place[spelt]].astype(np.int64)
            yield who, piece
            depth = depth - self.length[edge]
            on = depth > 0
            who, depth, rank, seed, step = who[on], depth[on], rank[on], seed[on], step + 1


def _in_order(pieces: Pieces, n: int, drawn: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of n occurrences, whose pieces were drawn from the end, and each one's number of ids."""
    count = np.zeros(n, np.int64)
    for _, who, _ in drawn:
        count[who] += 1
    last = np.cumsum(count) - 1
    ids = np.empty(int(count.sum()), np.int64)
    for step, who, piece in drawn:
        ids[last[who] - step] = piece
    spelt = np.flatnonzero(ids < 0)
    if not len(spelt):
        return ids, count
    codes = (-1 - ids[spelt]).astype(np.uint64)
    times = np.ones(len(ids), np.int64)
    times[spelt] = utf8_length(codes)
    out = np.repeat(ids, times)
    text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").replace(_TRUE_MARK, MARK)
    out[out < 0] = pieces.byte_ids[np.frombuffer(text.encode(), np.uint8)]
    return out, np.bincount(np.repeat(np.arange(n), count), weights=times, minlength=n).astype(np.int64)


def utf8_length(codes: np.ndarray) -> np.ndarray:
    return 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)


class _Numbers(dict):
    """Units in order of their first appearance, with their numbers."""

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        return number


def cut(pieces: Pieces, texts: list[bytes], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, and where each text's begin (one more than texts)."""
    numbered, found = _Numbers(), []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            marked = (" " + text.decode().replace(MARK, _TRUE_MARK)).replace(" ", MARK)
            found.append(np.array(list(map(numbered.__getitem__, _UNIT.findall(marked))), np.int32))
            counts[i] = len(found[-1])
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    numbers = np.concatenate(found)
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        seed = mix64(np.repeat(mix64(seeds.view(np.uint64)), counts) + (place + 1).astype(np.uint64) * _GOLDEN)
    by_unit = np.argsort(numbers, kind="stable")
    names, drawn = list(numbered), []
    ends = np.cumsum([len(u) for u in names])
    low = 0
    while low < len(names):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + LATTICE_CHARS, side="right")))
        some = by_unit[slice(*np.searchsorted(numbers[by_unit], (low, high)))]
        lattice = Lattice(pieces, names[low:high])
        drawn += [(step, some[who], piece) for step, (who, piece) in enumerate(lattice.draw(numbers[some] - low, seed[some]))]
        low = high
    ids, sizes = _in_order(pieces, len(numbers), drawn)
    of_text = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
    return ids, of_text


def joined(pieces: Pieces, ids: np.ndarray, at: np.ndarray) -> list[str]:
    """The texts of lists of ids; what is no UTF-8 becomes the replacement character."""
    blob, starts, sizes = pieces.spellings()
    n = sizes[ids]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    out = blob[np.repeat(starts[ids] - (ends - n), n) + np.arange(total)].tobytes()
    edges = np.concatenate(([0], ends))[at].tolist()
    return [out[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=2)
def _vocabulary(model: bytes, sharpness: float) -> Pieces:
    return Pieces(model, sharpness)


def _list_array(values: np.ndarray, at: np.ndarray, nulls: np.ndarray) -> pa.ListArray:
    offsets = pa.array(at, pa.int32(), mask=np.append(nulls, False))
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def encode(
    docs: DataFrame,
    model: str = MODEL,
    *,
    key_col: str = "doc_id",
    text_col: str = "text",
    sharpness: float = SHARPNESS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """row (all columns as they are, or those named) and pieces, the ids of a sampled segmentation."""
    # The vocabulary file has a fixed size of half a megabyte; executors need not see its path.
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    kept = docs if keep is None else docs.select(*keep)
    rows = docs.select(as_row(kept, "row"), F.col(text_col).alias("text"), F.xxhash64(key_col).alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _vocabulary(shared.value, sharpness)
        for batch in batches:
            texts = batch.column("text")
            seeds = batch.column("seed").to_numpy(zero_copy_only=False)
            for first, part in in_steps(texts, CUT_BYTES):
                n = len(part)
                ids, at = cut(pieces, part, seeds[first : first + n])
                nulls = texts.slice(first, n).is_null().to_numpy(zero_copy_only=False)
                columns = [batch.column("row").slice(first, n), _list_array(ids, at, nulls)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "pieces"])

    schema = T.StructType([rows.schema["row"], T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str = MODEL, *, pieces_col: str = "pieces") -> DataFrame:
    """Adds ``decoded``, the text of the pieces."""
    shared = rows.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _vocabulary(shared.value, SHARPNESS)
        for batch in batches:
            lists = batch.column(pieces_col)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            first = 0
            while first < len(lists):
                before = ends[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(ends, before + DECODE_IDS, side="right")))
                part = lists.slice(first, end - first)
                at = np.concatenate((np.zeros(1, np.int64), ends[first:end] - before))
                texts = joined(pieces, part.flatten().to_numpy(zero_copy_only=False), at)
                nulls = part.is_null().to_numpy(zero_copy_only=False)
                decoded = pa.array([None if null else t for t, null in zip(texts, nulls)], pa.string())
                columns = [*batch.slice(first, end - first).columns, decoded]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "decoded"])
                first = end

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))
