"""Joins texts whose sets of word shingles are alike, by signature trees.

A text's set holds the hashes of its distinct shingles of ``words`` words; a text of fewer words has its whole
sequence as one shingle, and a text without words has an empty set, which is like nothing. Two texts link
when 100 times the size of the intersection is at least ``percent`` times the size of the union.

1. Texts with equal sets are one node, from here on; so groups of copies, however large, do not grow.
2. Nodes that can link share a block. For sizes a <= b, linked sets differ in at most d = a * (100 - percent) / percent
   elements. All elements are split by their hash into k > d segments, so all but d are the same in both; each set
   needs to show only its d + 1 best ones, those with most elements. Sizes are cut into bands, and a node hashes its
   segments for its own band and for those of smaller partners. Keys travel packed, some thousand nodes together;
   each key that two nodes share names a block, and keys with the same nodes are one block.
3. Within a block, a signature tree is built over the nodes in order of size: each tree node holds the OR of the
   bitmaps of the sets below it, the range of their sizes, and by how much a set can exceed its bits. The dual
   traversal drops a pair of tree nodes when its largest possible overlap is too small for its smallest sizes,
   or when all sets below are already in one component. What remains is compared exactly.
4. A component meets others first through one block of its own choice, in parts of bounded size, represented by
   one of its nodes; that joins most of what is alike in linear time, in a few rounds. Then all blocks that still hold
   several components are traversed in full, pairs of parts at a time, by bitmaps alone, which are small; pairs that
   these leave are compared by their sets, so that no link between components is lost.

Components are right whatever the order; links within a component are not listed. Hash collisions of 64 bits
are neglected. Null texts are empty; rows that repeat an id or a text are rows like others. A null id takes part,
but never names a component, unless it has no other id: then the component is null.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import as_row, in_steps, mix64, no_text, whole_groups, word_hashes
from starloom.workspace import Workspace

WORDS, PERCENT = 5, 80
#: Nodes of a part of a block, about; a task holds the sets of two.
PART = 512
#: Tree nodes with at most so many sets are leaves.
LEAF = 16
FAN_OUT = 4
ROUNDS, FEW_PAIRS = 2, 3

_ONE = np.uint64(1)
_SALT = mix64(np.arange(1, 64, dtype=np.uint64))


# Sets.


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    hashes, offsets, _, _ = word_hashes(texts)
    n = len(hashes)
    whole = np.zeros(max(n - words + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            whole = mix64(whole + hashes[k : n - words + 1 + k] * (_SALT[k] | _ONE)) if len(whole) else whole
        out = []
        for begin, end in zip(offsets.tolist(), offsets[1:].tolist()):
            if end - begin >= words:
                out.append(np.unique(whole[begin : end - words + 1]))
            elif end > begin:
                h = _SALT[40 + min(end - begin, 20) : 41 + min(end - begin, 20)].copy()
                for w in range(begin, end):
                    h = mix64(h + hashes[w : w + 1] * (_SALT[w - begin] | _ONE))
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


# Segments.


def _bands(most: int) -> list[int]:
    """Where bands of sizes begin."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


def _most_different(n: int, percent: int) -> int:
    """Elements that only one of two linked sets has, at most, if the smaller one has n."""
    return n * (100 - percent) // percent


def segment_keys(tokens: np.ndarray, percent: int, bands: list[int]) -> np.ndarray:
    """The keys of a set, for every band in which the smaller of two linked sets may lie.

    Of k segments, two linked sets have all but d the same, d by the smaller set. In an order that only a
    segment's content decides, the best of these is behind fewer than d + 1 others in either set: so the d + 1
    best of each set are enough. Full segments come first, as they say most.
    """
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    smallest = -(-n * percent // 100)
    first, last = (int(np.searchsorted(bands, x, side="right")) - 1 for x in (smallest, n))
    with np.errstate(over="ignore"):
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(tokens))))
    out = []
    for band in range(first, last + 1):
        largest = bands[band + 1] - 1
        differ = _most_different(largest, percent)
        k = differ + differ // 4 + 6
        # Ascending like the tokens, so that segments are slices.
        segment = ((tokens >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        edges = np.searchsorted(segment, np.arange(k + 1, dtype=np.uint64))
        with np.errstate(over="ignore"):
            sums = running[edges[1:]] - running[edges[:-1]]
            place = (np.uint64(band) << np.uint64(40)) + np.arange(k, dtype=np.uint64)
            keys = mix64(sums + mix64(place + _ONE))
        best = np.lexsort((keys, edges[:-1] - edges[1:]))
        out.append(keys[best[: _most_different(min(n, largest), percent) + 1]])
    return np.concatenate(out)


# Steps on batches.


def _describe(words: int):
    """id, n, node and the hash of the text, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in in_steps(batch.column("text")):
                sets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(texts)),
                        batch.column("text_hash").slice(first, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["id", "text_hash", "n", "node"],
                )

    return run


def _pack(words: int, percent: int, parts: int):
    """The keys of many texts, packed by the part of the key space: keys, the texts they belong to, the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in in_steps(batch.column("text")):
                # Copies in one step are one.
                sets = {_digest(s): s for s in shingle_sets(texts, words) if len(s)}
                if not sets:
                    continue
                bands = _bands(max(map(len, sets.values())))
                keys = [segment_keys(s, percent, bands) for s in sets.values()]
                owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
                nodes = np.frombuffer(b"".join(sets), "V16")
                key = np.concatenate(keys)
                part = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
                rows = []
                for p in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
                    at = order[edges[p] : edges[p + 1]]
                    used, place = np.unique(owner[at], return_inverse=True)
                    rows.append((p, key[at].tobytes(), place.astype(np.int32).tobytes(), nodes[used].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32())] + [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)],
                    ["part", "keys", "places", "nodes"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the keys that several nodes share: a block is named after its nodes, and listed once a task."""
    keys, nodes = [], []
    for batch in batches:
        for k, p, n in zip(*(batch.column(c).to_pylist() for c in ("keys", "places", "nodes"))):
            keys.append(np.frombuffer(k, np.uint64))
            nodes.append(np.frombuffer(n, "V16")[np.frombuffer(p, np.int32)])
    if not keys:
        return
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    same[:-1] |= same[1:]
    key = key[same]
    node = np.concatenate(nodes)[order[same]].view([("a", "<u8"), ("b", "<u8")])
    order = np.lexsort((node["b"], node["a"], key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[new], node[new]
    starts = np.flatnonzero(np.diff(key, prepend=key[:1] - _ONE)) if len(key) else np.zeros(0, np.int64)
    sizes = np.diff(starts, append=len(key))
    with np.errstate(over="ignore"):
        names = [
            np.add.reduceat(mix64(node["a"] * (_SALT[k] | _ONE) + node["b"]), starts) if len(starts) else key
            for k in (0, 1)
        ]
    wanted = np.flatnonzero(sizes > 1)
    _, first = np.unique(np.stack([names[0][wanted], names[1][wanted]], 1), axis=0, return_index=True)
    name_bytes = np.stack(names, 1).tobytes()
    for block in wanted[first].tolist():
        low, n = int(starts[block]), int(sizes[block])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name_bytes[16 * block : 16 * block + 16]] * n, pa.binary()),
                pa.array([x.tobytes() for x in node[low : low + n]], pa.binary()),
            ],
            ["block", "node"],
        )


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("node").to_pylist()
            for first, texts in in_steps(batch.column("text")):
                found = shingle_sets(texts, words)
                keep = [i for i, s in enumerate(found) if _digest(s) == wanted[first + i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([wanted[first + i] for i in keep], pa.binary()),
                        pa.array([len(found[i]) for i in keep], pa.int64()),
                        pa.array([bitmap(found[i], bitmap_width(len(found[i]))).tobytes() for i in keep], pa.binary()),
                        pa.array([found[i].tobytes() for i in keep], pa.binary()),
                    ],
                    ["node", "n", "bits", "tokens"],
                )

    return run


# Trees.


def bitmap_width(n: int) -> int:
    """Bits for a set of n elements: a power of two, about eight for each."""
    return 1 << int(np.clip(np.ceil(np.log2(8 * max(n, 1))), 8, 16))


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    """A bit for each element, by the low bits of its hash, packed into 64-bit words."""
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A wider bitmap as one of this width."""
    return np.bitwise_or.reduce(bits.reshape(-1, width // 64), 0)


class Tree:
    """Signature tree over sets in order of size.

    levels[0] are the sets. Each node above has the OR of the bitmaps below it, the range of their sizes, and the
    most by which one of these sets exceeds its bits; leaves are level 1.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        excess = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.bits, self.low, self.high, self.excess = [bits], [sizes], [sizes], [excess]
        self.spans = [[(i, i + 1) for i in range(len(sizes))]]
        fan = LEAF
        while len(self.spans[-1]) > 1 or len(self.spans) == 1:
            starts = np.arange(0, len(self.spans[-1]), fan)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], starts))
            self.low.append(np.minimum.reduceat(self.low[-1], starts))
            self.high.append(np.maximum.reduceat(self.high[-1], starts))
            self.excess.append(np.maximum.reduceat(self.excess[-1], starts))
            self.spans.append([(s, min(s + fan, len(self.spans[-1]))) for s in starts.tolist()])
            fan = FAN_OUT

    def below(self, level: int, node: int) -> tuple[int, int]:
        """The sets of a tree node, which are consecutive."""
        low, high = node, node + 1
        for k in range(level, 0, -1):
            low, high = self.spans[k][low][0], self.spans[k][high - 1][1]
        return low, high


def _root(parent: list[int], at: int) -> int:
    while parent[at] != at:
        parent[at] = parent[parent[at]]
        at = parent[at]
    return at


def traverse(
    bits: np.ndarray, sizes: np.ndarray, group: list[int], side: np.ndarray, percent: int, same: Callable[[int, int], bool]
) -> list[int]:
    """Dual traversal: asks ``same`` of each pair that may link, unless its sets are in one group by then.

    Where it says yes, the groups become one. With both sides 0 and 1 present, only pairs across are tried.
    Returns for each set a number of its group.
    """
    first: dict[int, int] = {}
    parent = [first.setdefault(g, i) for i, g in enumerate(group)]
    order = np.argsort(sizes, kind="stable")
    places = [p for p in (order[side[order] == s] for s in (0, 1)) if len(p)]
    trees = [Tree(bits[p], sizes[p]) for p in places]
    left, right, at_left, at_right = trees[0], trees[-1], places[0].tolist(), places[-1].tolist()
    one = len(trees) == 1

    def may(level: int, x: int, r_level: int, y: int) -> bool:
        """Whether the largest possible overlap below two nodes reaches what their smallest sizes need."""
        l_low, l_high = int(left.low[level][x]), int(left.high[level][x])
        r_low, r_high = int(right.low[r_level][y]), int(right.high[r_level][y])
        if 100 * r_high < percent * l_low or 100 * l_high < percent * r_low:
            return False
        common = int(np.bitwise_count(left.bits[level][x] & right.bits[r_level][y]).sum(dtype=np.int64))
        most = min(l_high, r_high, common + min(int(left.excess[level][x]), int(right.excess[r_level][y])))
        return (100 + percent) * most >= percent * (l_low + r_low)

    def compare(a: tuple[int, int], b: tuple[int, int], within: bool) -> None:
        """Bits that only one set has are elements that only it has."""
        x, y = left.bits[0][slice(*a)][:, None], right.bits[0][slice(*b)][None, :]
        n, m = left.low[0][slice(*a)][:, None], right.low[0][slice(*b)][None, :]
        most = np.minimum(
            n - np.bitwise_count(x & ~y).sum(-1, dtype=np.int64), m - np.bitwise_count(y & ~x).sum(-1, dtype=np.int64)
        )
        fits = (100 + percent) * most >= percent * (n + m)
        for i, j in zip(*np.nonzero(np.triu(fits, 1) if within else fits)):
            u, v = at_left[a[0] + i], at_right[b[0] + j]
            ru, rv = _root(parent, u), _root(parent, v)
            if ru != rv and same(u, v):
                parent[max(ru, rv)] = min(ru, rv)

    def joined(a: tuple[int, int], b: tuple[int, int]) -> bool:
        root = _root(parent, at_left[a[0]])
        return all(_root(parent, p) == root for p in at_left[slice(*a)]) and all(
            _root(parent, p) == root for p in at_right[slice(*b)]
        )

    stack = [(len(left.spans) - 1, 0, len(right.spans) - 1, 0)]
    while stack:
        level, x, r_level, y = stack.pop()
        a, b = left.below(level, x), right.below(r_level, y)
        within = one and (level, x) == (r_level, y)
        if (not within and not may(level, x, r_level, y)) or joined(a, b):
            continue
        if level == 1 and r_level == 1:
            compare(a, b, within)
        elif level >= r_level:
            low, high = left.spans[level][x]
            if within:
                # Pairs within first, as they join what the others then need not try.
                stack += [(level - 1, i, level - 1, j) for i in range(low, high) for j in range(i + 1, high)]
                stack += [(level - 1, i, level - 1, i) for i in range(low, high)]
            else:
                stack += [(level - 1, i, r_level, y) for i in range(low, high)]
        else:
            stack += [(level, x, r_level - 1, j) for j in range(*right.spans[r_level][y])]
    return [_root(parent, i) for i in range(len(group))]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def tree_components(sets: list[np.ndarray], group: list[int], percent: int) -> list[int]:
    """For each set a number of its group, after all links between groups are found and their groups joined."""
    sizes = np.array([len(s) for s in sets], np.int64)
    width = bitmap_width(int(sizes.max(initial=1)))
    bits = np.stack([bitmap(s, width) for s in sets])
    return traverse(bits, sizes, group, np.zeros(len(sets), int), percent, lambda x, y: linked(sets[x], sets[y], percent))


def tree_candidates(
    bitmaps: list[bytes], sizes: np.ndarray, group: list[int], side: np.ndarray, percent: int, most: int | None
) -> list[tuple[int, int]]:
    """The pairs of different groups that may link by their bitmaps; at most ``most`` for each two groups, if given."""
    bits = [np.frombuffer(b, np.uint64) for b in bitmaps]
    width = 64 * min(map(len, bits))
    pairs: list[tuple[int, int]] = []
    times: Counter = Counter()

    def keep(x: int, y: int) -> bool:
        key = (group[x], group[y]) if group[x] < group[y] else (group[y], group[x])
        times[key] += 1
        if most is None or times[key] <= most:
            pairs.append((x, y))
        return False

    traverse(np.stack([folded(b, width) for b in bits]), sizes, group, side, percent, keep)
    return pairs


def _joining(percent: int):
    """For each component of a task that joined another, the smallest name of those it joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["task"]):
            tokens, names = rows.column("tokens").to_pylist(), rows.column("component").to_pylist()
            pairs: set[tuple[bytes, bytes]] = set()
            for low, high in zip(cuts, cuts[1:]):
                if high - low < 2:
                    continue
                sets = [np.frombuffer(t, np.uint64) for t in tokens[low:high]]
                roots = tree_components(sets, list(range(high - low)), percent)
                least: dict[int, bytes] = {}
                for name, root in zip(names[low:high], roots):
                    least[root] = min(name, least.get(root, name))
                pairs |= {(n, least[r]) for n, r in zip(names[low:high], roots) if n != least[r]}
            ordered = sorted(pairs)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in ordered], pa.binary()) for k in (0, 1)], ["a", "b"])

    return run


def _proposing(percent: int, most: int | None):
    """Pairs of nodes of different components that may link: nodes and components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["task"]):
            bits, names, nodes = (rows.column(c).to_pylist() for c in ("bits", "component", "node"))
            sizes, sides = rows.column("n").to_numpy(), rows.column("side").to_numpy()
            found: set[tuple[int, int]] = set()
            for low, high in zip(cuts, cuts[1:]):
                numbers: dict[bytes, int] = {}
                group = [numbers.setdefault(c, len(numbers)) for c in names[low:high]]
                if len(numbers) > 1:
                    part = slice(low, high)
                    pairs = tree_candidates(bits[part], sizes[part], group, sides[part], percent, most)
                    # In one order, so that a pair of several blocks is one.
                    found |= {(low + x, low + y) if nodes[low + x] < nodes[low + y] else (low + y, low + x) for x, y in pairs}
            ordered = sorted(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([of[p[k]] for p in ordered], pa.binary()) for of in (nodes, names) for k in (0, 1)],
                ["x", "y", "a", "b"],
            )

    return run


def _verifying(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            fits = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return run


# The join.


def _by_task(rows: DataFrame) -> DataFrame:
    return rows.repartition("task").sortWithinPartitions("task")


def _part_of(name: str, size: str) -> str:
    return f"pmod(xxhash64({name}), CAST(ceil({size} / {PART}) AS bigint))"


def _contracted(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each component meets others in one block, the largest that holds several, with one of its nodes."""
    present = members.groupBy("block", "component").agg(F.min("node").alias("node"))
    several = present.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    best = F.max(F.struct("size", "block", "node")).alias("best")
    chosen = present.join(several, "block").groupBy("component").agg(best).select("component", "best.*")
    task = F.expr(f"concat(hex(block), '-', {_part_of('component', 'size')})")
    rows = chosen.select(task.alias("task"), "component", "node").join(sets, "node").select("task", "component", "tokens")
    return _by_task(rows).mapInArrow(_joining(percent), "a binary, b binary")


def _completed(members: DataFrame, sets: DataFrame, percent: int, most: int | None, scratch: Workspace) -> DataFrame:
    """Links between components in all blocks: each pair of parts of a block is a task.

    Tasks hold bitmaps; what these cannot rule out, once for each two nodes, is compared by the sets.
    """
    several = (
        members.groupBy("block")
        .agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("block", "size")
    )
    placed = members.join(several, "block").selectExpr(
        "*", f"{_part_of('node', 'size')} AS part", f"CAST(ceil(size / {PART}) AS bigint) AS parts"
    )
    paired = placed.selectExpr("*", "explode(sequence(CAST(0 AS bigint), parts - 1)) AS other")
    task = F.expr("concat(hex(block), '-', least(part, other), '-', greatest(part, other))")
    side = F.expr("CAST(part > other AS int)")
    rows = paired.select(task.alias("task"), side.alias("side"), "component", "node").join(sets.drop("tokens"), "node")
    proposed = _by_task(rows).mapInArrow(_proposing(percent, most), "x binary, y binary, a binary, b binary")
    pairs = scratch.save(proposed.distinct(), "pairs")
    x, y = (sets.select(F.col("node").alias(c), F.col("tokens").alias(t)) for c, t in (("x", "left"), ("y", "right")))
    both = pairs.join(x, "x").join(y, "y").select("a", "b", "left", "right")
    return scratch.save(both.mapInArrow(_verifying(percent), "a binary, b binary"), "links")


def connected(edges: DataFrame, scratch: Workspace) -> DataFrame:
    """a, b: every name in an edge (a, b) but the smallest of its component, with that smallest name.

    Large and small stars in turn, after R. Kiveris et al., "Connected Components in MapReduce and Beyond".
    """
    now = scratch.save(edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a != b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.expr("CAST(xxhash64(a, b) AS decimal(38,0))"))).first()
        if mark == seen:
            return now
        seen = mark
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        others = large.join(lowest, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = scratch.save(lowest.select("a", F.col("m").alias("b")).union(others).distinct(), "stars")


def _renamed(members: DataFrame, names: DataFrame) -> DataFrame:
    new = names.select(F.col("a").alias("component"), F.col("b").alias("_new"))
    return members.join(new, "component", "left").select("block", "node", F.coalesce("_new", "component").alias("component"))


def _name_of(key: Column) -> Column:
    """An id as text that is never null: a null one is nothing behind no sign."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def components(
    docs: DataFrame,
    scratch: Workspace,
    *,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """For every row: id, text_hash, n (shingles), component (a name, null without words), component_id."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(no_text(text_col)).alias("text_hash"), no_text(text_col).alias("text")
    )
    kind = texts.schema["id"].dataType.simpleString()
    rows = scratch.save(
        texts.mapInArrow(_describe(words), f"id {kind}, text_hash long, n long, node binary"), "rows"
    )
    packed = texts.select("text").mapInArrow(
        _pack(words, percent, parts), "part int, keys binary, places binary, nodes binary"
    )
    shared = packed.repartition(parts, "part").mapInArrow(_shared, "block binary, node binary")
    members = scratch.save(shared.distinct().withColumn("component", F.col("node")), "members")
    # The texts of one row for each node that shares a block; one plan at every size, as their number grows.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first")
    wanted = (
        rows.where("node IS NOT NULL").groupBy("node").agg(first)
        .join(members.select("node").distinct(), "node")
        .select("node", _name_of(F.col("first.id")).alias("name"), F.col("first.text_hash").alias("text_hash"))
    )
    named_texts = texts.select(_name_of(F.col("id")).alias("name"), "text_hash", "text")
    # Rows that repeat id and text are one: they meet in the join's order, so nothing is shuffled again.
    met = named_texts.join(wanted.hint("merge"), ["name", "text_hash"])
    found = met.groupBy("name", "text_hash").agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")
    sets = scratch.save(found.mapInArrow(_sets(words), "node binary, n long, bits binary, tokens binary"), "sets")
    for _ in range(ROUNDS):
        names = scratch.save(_contracted(members, sets, percent), "names")
        members = scratch.save(_renamed(members, names), "members")
    # A few pairs of each two components join nearly all that is left; then every pair that remains.
    for most in (FEW_PAIRS, None):
        names = connected(_completed(members, sets, percent, most, scratch), scratch)
        members = scratch.save(_renamed(members, names), "members")
    # Both are written before the rows meet them: so a join's sides are plain exchanges, and adaptive execution can
    # split the rows of a text or a component that holds many of them.
    of_node = scratch.save(members.select("node", "component").distinct(), "of_node")
    named = rows.join(of_node, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    least = scratch.save(least, "least")
    whole = named.join(least.withColumnRenamed("component", "_c"), F.col("component") == F.col("_c"), "left")
    own = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return whole.select("id", "text_hash", "n", "component", own.alias("component_id"))


def keep_one(docs: DataFrame, scratch: Workspace, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The row with the smallest id of each component, and all rows without words, with their columns as they are.

    Rows that repeat both an id and a text of a component are one.
    """
    named = components(docs, scratch, id_col=id_col, text_col=text_col, **options)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("first")
    stay = named.where("component IS NOT NULL").groupBy("component").agg(first).select("first.id", "first.text_hash")
    bare = named.where("component IS NULL").select("id", "text_hash").distinct()
    keep = stay.withColumn("_one", F.lit(True)).union(bare.withColumn("_one", F.lit(False)))
    keep = keep.select(F.col("id").alias("_keep"), F.col("text_hash").alias("_keep_hash"), "_one")
    whole = docs.select(as_row(docs), F.col(id_col).alias("_id"), F.xxhash64(no_text(text_col)).alias("_hash"))
    of_row = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_hash") == F.col("_keep_hash"))
    found = whole.join(keep.hint("merge"), of_row)
    number = F.expr("row_number() OVER (PARTITION BY _id, _hash ORDER BY _hash)")
    return found.withColumn("_n", number).where("_n = 1 OR NOT _one").select("_row.*")
