"""Near copies by SimHash, deletion-variant signatures and the exact five-word Jaccard similarity (the pipeline's near-dedup stage).

Two texts are near copies where the sets of their five-word shingles (lower-cased words) have a
Jaccard similarity of ``LEAST`` or more.  Candidates come from operator 9's method.  A text's
fingerprint is the SimHash of its shingles: a bit is 1 if it is set in over half of their hashes.
It is cut into segments, each segment is indexed under its deletion variants, which have one
position blotted out, variants are joined on equality, and every candidate is verified, in the
end on the whole sets.

Operator 9 links at three of 64 bits.  Two sets at ``LEAST`` differ in 15 % of all bits, about ten
of 64, so this fingerprint is wider and has more segments (:func:`layout`): 81 of five positions of
five bits up to 2^24 rows.  A segment of such a pair differs in one position at most with
probability 0.12, so the pair shares a variant with probability 0.9998 or more, whatever the
sets' sizes.  That wants twice the segments for the shortest sets, where even votes make bits less
steady, and none for those of fewer than four shingles, which equal sets only are near.

Variants are not dealt one by one.  A table (:func:`tables`) deals every fingerprint once and whole, to
the cell that a few of its bits name, and inside a cell the variants of ``INSIDE`` other segments are
indexed.  So what meets is judged by all bits on the spot, and what is alike but not near, of which
large groups have a square of pairs, never leaves the cell.  Nor does a pair that a first look has
joined already: it verifies a few neighbours of each set, and tells the roots of what they join.

No candidate of that index is lost in a crowded bucket.  In one of more than ``CROWD * BUCKET`` sets each is
compared with the bucket's head.  Where that leaves a bucket in several components, members outside
its largest are compared with all of it if they are few.  Otherwise its members
are joined again, exactly, by prefix filtering: two sets at ``LEAST`` share one of the rarest fifth
of either's shingles.  What shares a rare shingle with few is paired; what is crowded even there is
cut into blocks of bounded bytes, and blocks that can hold a missing link are compared as a
whole in one task each, which emits links and no pairs.

Cases: null, empty and all-space texts are one empty shingle and link with each other; texts of
fewer words than a shingle are one shingle; repeated rows share a set and need no pair; null ids
are kept last; very long texts are read whole; an empty table gives an empty result; extra
columns are returned.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, materialise, maybe_in, row_key, scratch
from marlspike.llm.components import components
from marlspike.llm.simhash import votes

WORDS, LEAST = 5, (4, 5)
#: Positions of a segment, one of which a variant blots out.
POSITIONS = 5
#: Share of a fingerprint's bits in which two large sets at ``LEAST`` differ: the angle between them, of a half turn.
DIFFER = math.acos(2 * LEAST[0] / (LEAST[0] + LEAST[1])) / math.pi
#: Candidates lost at ``LEAST``, at most, of large sets (small ones: the docstring above).
LOST = 3e-5
#: Sets that have no near copy but themselves have fewer shingles; sets of twice the segments have at most as many.
LONE, SHORT = 4, 15
#: Bits of the first 128 in which candidates may differ: far above what sets at ``LEAST`` do.
FAR = 44
#: Share of all bits in which candidates may differ, of sets of at most ``SMALL`` shingles; of larger ones as many deviations above ``DIFFER``.
FAR_SHARE, SMALL, DEVIATIONS = 0.25, 32, 4.2
#: Segments that are indexed in a cell, tables that are dealt at a time, and bits of a cell up to 2^22 rows.
INSIDE, PASS, CELL = 20, 8, 5
#: Tables of the first look.
FIRST = 3
#: Sets of a bucket up to which they are paired directly, and times as many up to which they are compared inside a cell.
BUCKET, CROWD = 64, 16
#: Sets and shingles of a block, on average, that is compared as a whole.
BLOCK, BLOCK_SHINGLES = 256, 1 << 18
#: Counters by which shingles are put in order.
SLOTS = 1 << 20
_ROW = ["node", "root", "size", "print"]
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    found = text.translate(_LOWER).split()
    digest = xxhash.xxh3_64_intdigest
    if len(found) < WORDS:
        return np.array([digest(b" ".join(found))], np.uint64)
    words = np.fromiter(map(digest, found), np.uint64, len(found))
    n = len(words) - WORDS + 1
    h = words[:n].copy()
    for k in range(1, WORDS):
        h = _mixed(h) + words[k : k + n]
    return np.unique(_mixed(h))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets have a Jaccard similarity of ``LEAST`` or more."""
    top, below = LEAST
    if min(len(a), len(b)) * below < top * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * below >= top * (len(a) + len(b) - both)


def layout(rows: int) -> tuple[int, int]:
    """Segments of a fingerprint and bits of a position: unlike texts leave about 16 rows or fewer to a bucket."""
    width = max(5, math.ceil((math.log2(max(rows, 2)) - 4) / (POSITIONS - 1)))
    same = (1 - DIFFER) ** width
    meets = same**POSITIONS + POSITIONS * same ** (POSITIONS - 1) * (1 - same)
    return math.ceil(math.log(LOST) / math.log1p(-meets)), width


def _words(segments: int, width: int) -> int:
    return -(-segments * POSITIONS * width // 64)


@functools.cache
def _draws(words: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(42).integers(0, 1 << 64, (words, 2), np.uint64)
    return draw[:, 0], draw[:, 1] | np.uint64(1)


def bit_hashes(found: np.ndarray, words: int) -> np.ndarray:
    """``words`` independent 64-bit hashes of each shingle (a row each)."""
    xor, odd = _draws(words)
    h = found[:, None] ^ xor
    h *= odd
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def fingerprint(found: np.ndarray, words: int) -> np.ndarray:
    """SimHash of a shingle set, 64 bits a word."""
    on = np.zeros(64 * words, np.int64)
    for x in range(0, len(found), 255):
        on += votes(bit_hashes(found[x : x + 255], words))
    return np.packbits(2 * on > len(found), bitorder="little").view("<u8")


def variant_keys(prints: np.ndarray, first: int, last: int, width: int) -> np.ndarray:
    """Variants of segments ``first`` to ``last`` of fingerprints (a row each): segment, blotted position and the other positions' bits."""
    size = POSITIONS * width
    at = slice(first * size // 64, -(-last * size // 64))
    bits = np.unpackbits(np.ascontiguousarray(prints[:, at]).view(np.uint8), axis=1, bitorder="little")
    skip = first * size - 64 * at.start
    bits = bits[:, skip : skip + (last - first) * size].reshape(len(prints), last - first, size)
    whole = bits @ (np.int64(1) << np.arange(size, dtype=np.int64))
    mask = np.array([((1 << width) - 1) << width * gone for gone in range(POSITIONS)], np.int64)
    name = np.arange(first * POSITIONS, last * POSITIONS, dtype=np.int64).reshape(-1, POSITIONS)
    return (name << size | (whole[:, :, None] & ~mask)).reshape(len(prints), -1)


def _sketch(segments: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``node`` (a hash of the shingle set), ``size``, ``print`` and, of short sets, ``more``, their second half of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(segments, width)
        for whole in batches:
            for batch in chunked(whole, "_text"):
                sets = [shingle_set(t or b"") for t in batch.column("_text").cast(pa.binary()).to_pylist()]
                node = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                prints = [fingerprint(s, (1 + (len(s) <= SHORT)) * words) for s in sets]
                keep = [k for k in batch.schema.names if k != "_text"]
                more = [pa.array(node), pa.array([len(s) for s in sets], pa.int32())]
                more += [pa.array([p[a:b].tobytes() for p in prints], pa.binary()) for a, b in ((0, words), (words, None))]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *more], [*keep, "node", "size", "print", "more"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_text"):
            found = [shingle_set(t or b"").tobytes() for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "found"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column("found_a"), batch.column("found_b"))]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def tables(rows: int, segments: int, width: int) -> tuple[int, int]:
    """Tables and bits of a cell: a cell of unlike texts has 2^17 rows or fewer, and pairs at ``LEAST`` share a cell and a variant in it somewhere."""
    bits = max(CELL, math.ceil(math.log2(max(rows, 2))) - 17)
    same = (1 - DIFFER) ** width
    meets = same**POSITIONS + POSITIONS * same ** (POSITIONS - 1) * (1 - same)
    found = (1 - DIFFER) ** bits * -math.expm1(INSIDE * math.log1p(-meets))
    return math.ceil(math.log(LOST / 10) / math.log1p(-found)), bits  # a tenth: tables draw from the same segments


@functools.cache
def drawn(table: int, segments: int, bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments that a table indexes, and the bits that name its cells, one of each of as many other segments."""
    order = np.random.default_rng(1000 + table).permutation(segments)
    return order[:INSIDE], order[INSIDE : INSIDE + bits] * POSITIONS * width + table % (POSITIONS * width)


def _cells_of(prints: np.ndarray, table: int, segments: int, bits: int, width: int) -> np.ndarray:
    at = drawn(table, segments, bits, width)[1]
    on = prints[:, at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)
    return on.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def _deal(first: int, last: int, segments: int, bits: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every row once a table, under its cell there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 4096):
                batch = whole.slice(x, 4096)
                prints = np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                second = batch.column("second").to_numpy(zero_copy_only=False).astype(np.int64) << 26  # the second half's tables are others
                for table in range(first, last):
                    cell = second | table << 16 | _cells_of(prints, table, segments, bits, width)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), *(batch.column(k) for k in _ROW)], ["cell", *_ROW])

    return run


def may_match(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether fingerprints (a row each) are as near as those of sets at ``LEAST``, of ``size`` shingles, are."""
    bits = 64 * x.shape[1]
    usual = DIFFER + DEVIATIONS * math.sqrt(DIFFER * (1 - DIFFER) / bits)
    apart = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return apart <= np.where(size <= SMALL, FAR_SHARE, min(usual, FAR_SHARE)) * bits


def _inside(segments: int, bits: int, width: int, most: int) -> Callable[[pa.Table], Iterator[pa.RecordBatch]]:
    """Of a cell's rows, in order of ``node``, the close pairs of differing roots, once each; of buckets of over ``most``, every row with the head.

    With ``most`` 0 only neighbours in the buckets of one segment are compared: a few pairs a row, to tell the first roots from.
    """
    top, below = LEAST

    def run(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cell, node, root, size = (rows.column(k).to_numpy() for k in ("cell", "node", "root", "size"))
        n, prints = len(node), np.frombuffer(b"".join(rows.column("print").to_pylist()), np.uint64).reshape(len(node), -1)
        found = [np.zeros(0, np.int64)]

        def keep(x: np.ndarray, y: np.ndarray) -> None:
            for at in range(0, len(x), 1 << 15):
                u, v = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
                ok = (root[u] != root[v]) & (np.minimum(size[u], size[v]) * below >= np.maximum(size[u], size[v]) * top)
                u, v = u[ok], v[ok]
                ok = may_match(prints[u], prints[v], np.minimum(size[u], size[v]))
                found.append(np.minimum(u, v)[ok] * n + np.maximum(u, v)[ok])

        for segment in drawn(int(cell[0] >> 16 & 1023), segments, bits, width)[0][: None if most else 1].tolist():
            key = variant_keys(prints, segment, segment + 1, width).ravel()
            who = np.argsort(key, kind="stable")
            key, who = key[who], who // POSITIONS
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            mixed = np.minimum.reduceat(root[who], start) != np.maximum.reduceat(root[who], start)
            mixed = np.repeat(mixed, np.diff(np.append(start, len(key))))
            key, who = key[mixed], who[mixed]
            if not most:
                for d in (1, 2):
                    same = np.flatnonzero(key[d:] == key[:-d])
                    keep(who[same], who[same + d])
            elif len(key):
                columns = [key, node[who], *prints[who, :2].T.copy().view(np.int64)]
                met = _meet(most)(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "node", "f1", "f2"])]))
                for batch in met:
                    if batch.column("key").null_count:
                        keep(*(np.searchsorted(node, batch.column(k).to_numpy()) for k in ("a", "b")))
                    elif batch.num_rows:  # a bucket is told by its cell too
                        named = _mixed(batch.column("key").to_numpy().view(np.uint64) ^ _mixed(cell[:1].view(np.uint64))).view(np.int64)
                        yield batch.set_column(2, "key", pa.array(named))
        pair = np.unique(np.concatenate(found))
        ends, none = [pa.array(node[pair // n]), pa.array(node[pair % n])], pa.nulls(len(pair), pa.int64())
        yield pa.RecordBatch.from_arrays([*ends, none, none, none], ["a", "b", "key", "f1", "f2"])

    return run


def _each_cell(do: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``do`` for every run of rows of one ``cell``, wherever batches cut it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain((b for b in batches if b.num_rows), [None]):
            if batch is not None:
                held.append(batch)
                if held[0].column("cell")[0] == batch.column("cell")[-1]:
                    continue
            if not held:
                return
            rows = pa.Table.from_batches(held)
            cell = rows.column("cell").to_numpy()
            start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])).tolist()
            end = [*start[1:], len(cell)]
            for a, b in zip(start, end) if batch is None else zip(start[:-1], end):
                yield from do(rows.slice(a, b - a))
            held = rows.slice(start[-1]).to_batches()

    return run


def _meet(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows in order of ``key`` and ``node``, the close pairs of each bucket; of one of over ``most`` rows, every row with the head and its key."""
    names = ["key", "node", "f1", "f2"]

    def crowded(key: np.ndarray, node: np.ndarray, f1: np.ndarray, f2: np.ndarray, head: np.ndarray | int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (node, np.broadcast_to(head, node.shape).copy(), key, f1, f2)], ["a", "b", *names[:1], *names[2:]])

    def closed(key: np.ndarray, node: np.ndarray, f1: np.ndarray, f2: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        end, big = np.repeat(start + size, size), np.repeat(size > most, size)
        if big.any():
            yield crowded(*(c[big] for c in (key, node, f1, f2)), np.repeat(node[start], size)[big])
        x = np.flatnonzero(~big)
        for d in itertools.count(1):
            x = x[x + d < end[x]]
            if not len(x):
                return
            y = x + d
            near = sum(np.bitwise_count((f[x] ^ f[y]).view(np.uint64)) for f in (f1, f2)) <= FAR
            pairs, none = [pa.array(node[x[near]]), pa.array(node[y[near]])], pa.nulls(int(near.sum()), pa.int64())
            if len(none):
                yield pa.RecordBatch.from_arrays([*pairs, none, none, none], ["a", "b", *names[:1], *names[2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.zeros(0, np.int64)] * 4
        opened = None  # key and head of a crowded bucket that goes on
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = [np.concatenate([c, batch.column(k).to_numpy()]) for c, k in zip(rows, names)]
            if opened and len(rows[0]):
                lead = int(np.searchsorted(rows[0], opened[0], "right"))
                if lead:
                    yield crowded(*(c[:lead] for c in rows), opened[1])
                rows = [c[lead:] for c in rows]
                opened = None if len(rows[0]) else opened
            if not len(rows[0]):
                continue
            last = len(rows[0]) if batch is None else int(np.searchsorted(rows[0], rows[0][-1]))
            if last:
                yield from closed(*(c[:last] for c in rows))
                rows = [c[last:] for c in rows]
            if len(rows[0]) > most:
                opened = rows[0][0], rows[1][0]
                yield crowded(*rows, opened[1])
                rows = [c[:0] for c in rows]

    return run


def _halves(prints: DataFrame) -> DataFrame:
    """What is dealt to the cells: the fingerprints and, of short sets, their second half; none of sets that have no near copy."""
    some = prints.filter(F.col("size") >= LONE).select("node", "size", "print", "more")
    more = some.filter(F.col("size") <= SHORT).select("node", "size", F.col("more").alias("print"), F.lit(True).alias("second"))
    return materialise(some.select("node", "size", "print", F.lit(False).alias("second")).unionByName(more), "halves")


def _met(halves: DataFrame, first: int, last: int, segments: int, bits: int, width: int, most: int) -> DataFrame:
    """Pairs (``a``, ``b``) of differing roots that share a variant in a cell, and members ``a`` of crowded buckets with the head ``b`` and ``key``."""
    dealt = halves.mapInArrow(_deal(first, last, segments, bits, width), "cell long, node long, root long, size int, print binary")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "node")
    return materialise(dealt.mapInArrow(_each_cell(_inside(segments, bits, width, most)), "a long, b long, key long, f1 long, f2 long"), "met")


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("print_a", "print_b"))
            yield batch.select(["a", "b"]).filter(pa.array(may_match(x, y, batch.column("size").to_numpy())))


def _likely(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The pairs, once each, whose sizes and whole fingerprints allow a similarity of ``LEAST``."""
    top, below = LEAST
    sides = [prints.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("print").alias(f"print_{c}")) for c in ("a", "b")]
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
    least = F.least("size_a", "size_b")
    whole = pairs.join(sides[0], "a").join(sides[1], "b").filter(least * below >= F.greatest("size_a", "size_b") * top)
    return whole.select("a", "b", "print_a", "print_b", least.alias("size")).mapInArrow(_close, "a long, b long")


def _whole_sets(nodes: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``node`` and ``found`` (the shingle set) of each of ``nodes``, from the texts (``docs``: ``_k1``, ``_k2``, ``_text``)."""
    one = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("_k1", "_k2")).alias("k"))
    one = materialise(one.select("k.*", "node"), "chosen")
    texts = maybe_in(docs, one, "_k1", "_k2").join(one, ["_k1", "_k2"]).mapInArrow(_sets, "node long, found binary")
    return materialise(texts.dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that are near copies, by the sets of their texts."""
    pairs = materialise(pairs, "pairs")
    sets = _whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), rows, docs)
    sides = [sets.select(F.col("node").alias(c), F.col("found").alias(f"found_{c}")) for c in ("a", "b")]
    # The sets are wide and a head has many pairs: never broadcast.
    whole = pairs.join(sides[0].hint("merge"), "a").join(sides[1].hint("merge"), "b")
    return materialise(whole.select("a", "b", "found_a", "found_b").mapInArrow(_verify, "a long, b long"), "found")


def _shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for found in batch.column("found"):
            np.add.at(counts, (np.frombuffer(found.as_buffer(), np.uint64) & np.uint64(SLOTS - 1)).astype(np.int64), 1)
    hit = np.flatnonzero(counts)
    for x in range(0, len(hit), 1 << 16):
        y = hit[x : x + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(counts[y])], ["slot", "n"])


def prefix_of(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set: as many as any set at ``LEAST`` must have one of.  The order is the same for all sets."""
    top, below = LEAST
    first = len(found) + (top * len(found)) // -below + 1
    return found[np.lexsort((found, counts[(found & np.uint64(SLOTS - 1)).astype(np.int64)]))[:first]]


def _prefixes(counts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(0, batch.num_rows, 256):
                part = batch.slice(x, 256)
                tokens = [prefix_of(np.frombuffer(f.as_buffer(), np.uint64), counts) for f in part.column("found")]
                home = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
                rest = [pa.array(part.column(k).to_numpy()[home]) for k in ("node", "root", "size")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(np.concatenate(tokens).view(np.int64))], ["node", "root", "size", "token"])

    return run


def links_across(sets: list[np.ndarray], roots: np.ndarray) -> list[tuple[int, int]]:
    """Links that join near copies of differing roots among ``sets``, one for each pair of roots that needs one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    home = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    home, token = home[shared], np.unique(token[shared], return_inverse=True)[1]
    # A bit for each shingle that several sets have: what two sets share is the bits that both have.
    bits = np.zeros((len(sets), (int(token.max()) >> 6) + 1 if len(token) else 1), np.uint64)
    np.bitwise_or.at(bits, (home, token >> 6), np.uint64(1) << (token & 63).astype(np.uint64))
    top, below = LEAST
    out, seen = [], set()
    for x in range(len(sets) - 1):
        both = np.bitwise_count(bits[x + 1 :] & bits[x]).sum(axis=1, dtype=np.int64)
        near = (both * below >= top * (sizes[x + 1 :] + sizes[x] - both)) & (roots[x + 1 :] != roots[x])
        for y in (np.flatnonzero(near) + x + 1).tolist():
            pair = (min(roots[x], roots[y]), max(roots[x], roots[y]))
            if pair not in seen:
                seen.add(pair)
                out.append((x, y))
    return out


def _block_links(group: pa.Table) -> pa.Table:
    node, root = group.column("node").to_numpy(), group.column("root").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("found")]
    found = links_across(sets, root)
    ends = np.array([(node[x], node[y]) for x, y in found], np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ends.min(axis=1)), "b": pa.array(ends.max(axis=1))})


def _in_blocks(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across roots among the members of crowded buckets (``token``, ``node``, ``root``, ``size``), compared in blocks."""
    heads = crowd.groupBy("token").agg(F.min("node").alias("head"))
    clusters = components(crowd.join(heads, "token").select(F.col("node").alias("a"), F.col("head").alias("b")))
    nodes = crowd.select("node", "root", "size").distinct().join(clusters.withColumnRenamed("root", "cluster"), "node")
    by_root = nodes.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    main = by_root.groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    blocks = lambda other: F.ceil(
        F.greatest(F.sum(F.when((F.col("root") != F.col("main")) == other, F.col("n"))) / BLOCK, F.sum(F.when((F.col("root") != F.col("main")) == other, F.col("shingles"))) / BLOCK_SHINGLES)
    )
    counts = by_root.join(main, "cluster").groupBy("cluster", "main").agg(blocks(True).alias("others"), blocks(False).alias("mains"))
    # Blocks of the main root come after the others and are compared with those only: among themselves nothing is missing.
    dealt = nodes.join(counts.filter("others > 0"), "cluster").withColumn("other", F.col("root") != F.col("main"))
    place = F.pmod(F.xxhash64("node"), F.when(F.col("other"), F.col("others")).otherwise(F.col("mains")))
    dealt = dealt.withColumn("block", F.when(F.col("other"), place).otherwise(F.col("others") + place))
    last = F.when(F.col("other"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    dealt = dealt.select("node", "root", "cluster", "block", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_x"))
    dealt = dealt.select("node", "root", "cluster", F.least("block", "_x").alias("i"), F.greatest("block", "_x").alias("j"))
    whole = dealt.join(sets.hint("merge"), "node")
    return whole.groupBy("cluster", "i", "j").applyInArrow(_block_links, "a long, b long")


def _exact(left: DataFrame, sets: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Links across roots among ``left`` (``node``, ``root``, ``size``) by prefix filtering; loses none."""
    whole = materialise(left.join(sets.hint("merge"), "node"), "whole")
    # How often each shingle occurs only orders them, so counts of a fixed number of slots do: at most SLOTS rows come to the driver.
    seen = whole.select("found").mapInArrow(_shingle_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[seen.column("slot").to_numpy()] = seen.column("n").to_numpy()
    prefix = materialise(whole.mapInArrow(_prefixes(counts.astype(np.int32)), "node long, root long, size int, token long"), "prefix")
    mixed = prefix.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("r"), F.max("root").alias("s")).filter("r != s")
    prefix = materialise(prefix.join(mixed.select("token", "n"), "token"), "mixed")
    few = prefix.filter(F.col("n") <= BUCKET)
    other = few.select("token", F.col("node").alias("b"), F.col("root").alias("root2"), F.col("size").alias("size2"))
    top, below = LEAST
    near = F.least("size", "size2") * below >= F.greatest("size", "size2") * top
    pairs = few.join(other, "token").filter((F.col("node") < F.col("b")) & (F.col("root") != F.col("root2")) & near).select(F.col("node").alias("a"), "b").distinct()
    found = _verified(pairs, rows, docs)
    crowd = prefix.filter(F.col("n") > BUCKET).drop("n")
    return found if crowd.isEmpty() else found.unionByName(_in_blocks(crowd, sets))


def _rooted(crowd: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the crowded buckets that ``found`` leaves in several components, with ``root`` and the bucket's largest, ``main``."""
    crowd = crowd.join(components(found).withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    by_root = crowd.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    split = by_root.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("others"), F.count(F.lit(1)).alias("roots"))
    return materialise(crowd.join(split.filter("roots > 1").drop("roots"), "key"), "split")


def near_links(rows: DataFrame, docs: DataFrame, segments: int, width: int) -> DataFrame:
    """Links (``a``, ``b``) of the distinct sets of ``rows`` that join all near copies among the index's candidates."""
    prints = materialise(rows.select("node", "size", "print", "more").dropDuplicates(["node"]), "prints")
    halves = _halves(prints)
    count, bits = tables(prints.count(), segments, width)
    # A first look joins most of each large group, so that the whole index need not pair what is joined already.
    found = _verified(_met(halves.withColumn("root", F.col("node")), 0, FIRST, segments, bits, width, 0).select("a", "b").distinct(), rows, docs)
    roots = components(found)
    halves = materialise(halves.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    # In turn, so that a part of the tables is on disk at a time.
    met = [_met(halves, x, min(x + PASS, count), segments, bits, width, CROWD * BUCKET) for x in range(0, count, PASS)]
    met = functools.reduce(DataFrame.unionByName, met)
    found = found.unionByName(_verified(met.filter("key is null").select("a", "b").distinct(), rows, docs))
    crowd = met.filter("key is not null")
    if crowd.isEmpty():
        return found
    found = found.unionByName(_verified(_likely(crowd, prints), rows, docs))
    # Crowded buckets that the heads have left in several components: strangers in a cluster's bucket are few.
    split = _rooted(crowd, found)
    few = split.filter(F.col("others") <= BUCKET).drop("b")
    other = few.filter("root != main").select("key", F.col("a").alias("b"), F.col("root").alias("root2"), F.col("f1").alias("g1"), F.col("f2").alias("g2"))
    apart = F.bit_count(F.col("f1").bitwiseXOR(F.col("g1"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("g2")))
    pairs = few.join(other, "key").filter((F.col("root") != F.col("root2")) & (apart <= FAR)).select("a", "b")
    found = found.unionByName(_verified(_likely(pairs, prints), rows, docs))
    many = split.filter(F.col("others") > BUCKET)
    if many.isEmpty():
        return found
    left = _rooted(many.select("a", "key"), found).select(F.col("a").alias("node"), "root").distinct()
    left = materialise(left.join(prints.select("node", "size"), "node"), "left")
    if left.isEmpty():
        return found
    return found.unionByName(_exact(left, _whole_sets(left.select("node"), rows, docs), rows, docs))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group that near copies join, that with the smallest id (of equal ids the smallest key), with all columns."""
    text = F.col(text_col).cast("string")
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), *row_key(id_col, text), text.alias("_text"))
    with scratch(df.sparkSession):
        segments, width = layout(df.count())
        schema = f"_id {kind}, _k1 long, _k2 long, node long, size int, print binary, more binary"
        rows = materialise(src.mapInArrow(_sketch(segments, width), schema), "sketches")
        roots = components(near_links(rows, src.select("_k1", "_k2", "_text"), segments, width))
        named = rows.select("_id", "_k1", "_k2", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = named.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), "_k1", "_k2")).alias("b"))
        kept = materialise(best.select("b._k1", "b._k2"), "kept", outlive=True)
    k1, k2 = row_key(id_col, text)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), k1, k2)
    again = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))
    return rows.join(kept, ["_k1", "_k2"], "left_semi").withColumn("_again", again).filter("_again = 1").select("_row.*")
