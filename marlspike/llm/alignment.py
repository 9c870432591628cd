"""Alignment of two tokenisations of each text (operator 11).

Both tokenisers cut the same bytes, a space and the text: one a byte-level BPE file (A), one a sentencepiece model (B),
which adds that space itself.  The ends of all A and B tokens of a batch are merged along a merge path: binary searches
on evenly spaced diagonals cut the merge into pieces of equal work that need nothing of each other, and the pieces then
advance side by side, one token each a step (as numpy vectors over the pieces).  Each step emits the pair of tokens that overlap
up to the lesser end; a step that finds both ends equal closes a group.  Groups that run over the edge of a piece are stitched by
numbering the closed groups across pieces.

Texts are cut into units before they are tokenised: a space that follows neither white space nor the mark of B begins a
unit in both tokenisers (checked for B when it is loaded, else texts stay whole).  Units met of late are remembered.

An id pair's count is the number of documents in which it is linked.  Every document keeps its distinct pairs with their
number of links, written once; counting and scoring read them from there.  Pairs of high counts (``HOT`` at most,
by powers of two) are broadcast, so that no pair that many documents share is a join key; the others are joined by shuffle.

Cases: null and empty texts, and texts whose joined token bytes differ from space and text (such as those with the mark
itself), have no tokens: zeros and an empty list of groups; strings of special tokens are plain text; repeated rows are documents
of their own; very long texts are aligned whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm import bpe
from marlspike.llm.common import chunked, materialise, texts

MARK = "▁"
#: Steps of a piece of the merge, bytes of text merged together, units remembered, and the longest worth it.
STEPS, BATCH_BYTES, REMEMBERED, LONGEST = 64, 1 << 20, 150_000, 64
#: Pairs that are broadcast at most (a few megabytes).
HOT = 1 << 17
_SAFE = re.compile(rf"(?<=[^\s{MARK}]) ")


class Plain(bpe.Vocabulary):
    """A vocabulary to which the strings of added tokens are plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.added, self.split_added = {}, None


def _bytes_of(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARK, " ").encode()


def _table(ids: int, end: str) -> np.ndarray:
    """Each id in decimals with ``end`` behind it, in the eight bytes of a number."""
    if ids > 10**7:
        raise ValueError("ids of more than seven digits")
    return np.frombuffer(b"".join(f"{i}{end}".encode().ljust(8, b"\0") for i in range(ids)), "<u8")


class Tokenizers:
    """Both tokenisers, their token bytes, and the units met of late."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = Plain(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        coded = [_bytes_of(p) for p in pieces]
        size_b = np.array([len(x) for x in coded], np.int64)
        self.sizes = (self.a.sizes, size_b)
        self.starts, self.flat = (self.a.starts, np.cumsum(size_b) - size_b), (self.a.flat, np.frombuffer(b"".join(coded), np.uint8))
        self.pairs = len(self.sizes[0]) * len(pieces)
        if self.pairs >= 1 << 31:
            raise ValueError("more pairs of ids than 31 bits hold")
        one = self.b.encode("a")
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces) and self.b.encode("a b") == one + self.b.encode("b")
        self.last = self.b.encode("a ")[len(one) :]  # what a final space becomes
        self.known: list[dict[str, tuple[bytes, bytes, bool]]] = [{}, {}]
        self.digits = [_table(len(self.sizes[0]), ","), _table(len(self.sizes[0]), "|"), _table(len(pieces), ","), _table(len(pieces), ";")]

    def _spelled(self, k: int, coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of tokeniser ``k``'s lists of ids, all joined, and where each list's begin."""
        ids = np.frombuffer(b"".join(coded), "<u4")
        size = self.sizes[k][ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.flat[k][np.arange(total) + np.repeat(self.starts[k][ids] - (ends - size), size)]
        lists = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)])
        return flat, np.append(0, ends)[lists]

    def _spell(self, a: list[bytes], b: list[bytes], rows: list[bytes]) -> list[bool]:
        """Whether both lists of ids spell the row, for each row."""
        (x, at), (y, bt) = self._spelled(0, a), self._spelled(1, b)
        want = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
        joined = b"".join(rows)
        if np.array_equal(at, want) and np.array_equal(bt, want) and x.tobytes() == joined == y.tobytes():
            return [True] * len(rows)
        return [x[s:e].tobytes() == r == y[u:v].tobytes() for r, s, e, u, v in zip(rows, at[:-1], at[1:], bt[:-1], bt[1:])]

    def _learn(self, units: list[str]) -> dict[str, tuple[bytes, bytes, bool]]:
        """Ids of units, and whether both lists spell space and unit."""
        spaced = [" " + u for u in units]
        a = self.a.encode_batch(spaced)
        b = [np.array(x if u else self.last, "<u4").tobytes() for u, x in zip(units, self.b.encode(units, num_threads=1))]
        return dict(zip(units, zip(a, b, self._spell(a, b, [s.encode() for s in spaced]))))

    def encode(self, rows: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and of B of each text, both empty where the tokens do not spell it."""
        if len(self.known[0]) > REMEMBERED:
            self.known[:] = [{}, self.known[0]]
        known, older = self.known
        parts = [_SAFE.split(t) if self.splits else [t] for t in rows]
        new = set().union(*parts).difference(known)
        known.update({u: older[u] for u in new.intersection(older)})
        fresh = list(new.difference(known))
        known.update(self._learn(fresh))
        out = []
        for t, p in zip(rows, parts):
            found = [known[u] for u in p]
            a, b = b"".join([f[0] for f in found]), b"".join([f[1] for f in found])
            if not t:
                a = b = b""
            elif not all([f[2] for f in found]) and not self._spell([a], [b], [(" " + t).encode()])[0]:
                a = b = b""
            out.append((a, b))
        for u in fresh:
            if len(u) > LONGEST:
                del known[u]
        return out


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def split_path(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How many of ``a`` each piece of the merge has before it: binary searches on the diagonals, all at once.  Of equal ends ``a``'s comes first."""
    d = np.arange(0, len(a) + len(b), steps)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        right = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - 1 - mid, 0, len(b) - 1)])
        low, high = np.where(right, mid + 1, low), np.where(open_ & ~right, mid, high)
    return low


def merge_ends(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and groups of two rising lists of token ends that close together.

    Returns the A and B token numbers of every overlap, in order, and those of the last tokens of every group.
    """
    if not len(a):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    total = len(a) + len(b)
    beyond = np.iinfo(np.int64).max
    ends_a, ends_b = np.append(a, beyond), np.append(b, beyond)
    i = split_path(a, b, steps)
    j = np.arange(0, total, steps) - i
    at_a, at_b = (np.empty((len(i), steps), np.int64) for _ in range(2))
    took = np.empty((len(i), steps), bool)
    for s in range(steps):  # the pieces advance side by side
        at_a[:, s], at_b[:, s] = i, j
        first = ends_a[i] <= ends_b[j]
        took[:, s] = first
        i = np.minimum(i + first, len(a))
        j = np.minimum(j + ~first, len(b))
    at_a, at_b, took = at_a.ravel()[:total], at_b.ravel()[:total], took.ravel()[:total]
    closes = ~took & (ends_a[at_a - 1] == ends_b[at_b])
    return at_a[~closes], at_b[~closes], at_a[closes] - 1, at_b[closes]


def align_batch(both: Tokenizers, rows: list[str]) -> dict[str, pa.Array]:
    """The columns of :func:`align` for a batch of texts."""
    coded = both.encode(rows)
    ids = [np.frombuffer(b"".join([c[k] for c in coded]), "<u4").astype(np.int64) for k in (0, 1)]
    bound = [np.concatenate([[0], np.cumsum([len(c[k]) // 4 for c in coded], dtype=np.int64)]) for k in (0, 1)]
    link_a, link_b, last_a, last_b = merge_ends(*(np.cumsum(size[x]) for size, x in zip(both.sizes, ids)))
    n_a, n_b = np.diff(bound[0]), np.diff(bound[1])
    n_groups = np.diff(np.searchsorted(last_a, bound[0]))
    edges = np.searchsorted(link_a, bound[0])
    # Groups as text: where a token stands is its number and that of the other side's tokens before its group, or up to its end.
    spelled = np.empty(len(ids[0]) + len(ids[1]), "<u8")
    before_b = np.concatenate([[0], last_b[:-1] + 1])
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    where_a = np.arange(len(ids[0])) + np.repeat(before_b[: len(last_b)], size_a)
    where_b = np.arange(len(ids[1])) + np.repeat(last_a + 1, size_b)
    for where, x, last, inner, final in ((where_a, ids[0], last_a, *both.digits[:2]), (where_b, ids[1], last_b, *both.digits[2:])):
        spelled[where] = inner[x]
        spelled[where[last]] = final[x[last]]
    cut = bound[0] + bound[1]
    groups = [spelled[s:e].tobytes().translate(None, b"\0")[:-1] for s, e in zip(cut[:-1], cut[1:])]
    # Distinct pairs of each document with their number of links.
    home = np.repeat(np.arange(len(rows)), np.diff(edges))
    pair = ids[0][link_a] * len(both.sizes[1]) + ids[1][link_b]
    every = np.sort(home << 31 | pair)
    new = np.flatnonzero(np.diff(every, prepend=-1))
    times = np.diff(np.append(new, len(every)))
    packed = (every[new] & ((1 << 31) - 1)) << 32 | times
    place = np.searchsorted(every[new] >> 31, np.arange(len(rows) + 1)).astype(np.int32)
    long = lambda x: pa.array(x.astype(np.int64))
    return {
        "n_a": long(n_a), "n_b": long(n_b), "n_groups": long(n_groups), "n_links": long(np.diff(edges)), "groups": pa.array(groups, pa.binary()).cast(pa.string()),
        "links": pa.ListArray.from_arrays(pa.array(place), pa.array(packed)),
    }


KINDS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string", "links": "array<long>"}


def _aligner(a_path: str, b_path: str, want: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        for whole in batches:
            for batch in chunked(whole, "_text", BATCH_BYTES):
                found = align_batch(both, texts(batch.column("_text")))
                yield pa.RecordBatch.from_arrays([batch.column("_id"), *(found[w] for w in want)], ["_id", *want])

    return run


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", want: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``id_col`` and the columns of ``want``.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links``; ``groups``: ``a1,a2|b1;a3|b2,b3``; ``links``: each distinct pair once, as its pair number
    (A id times B's vocabulary, plus B id) in the upper and its number of links in the lower 32 bits.
    """
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return src.mapInArrow(_aligner(a_path, b_path, tuple(want)), ", ".join([f"_id {kind}", *(f"{w} {KINDS[w]}" for w in want)])).withColumnRenamed("_id", id_col)


def _pairs(rows: DataFrame) -> DataFrame:
    """``_row``, ``pair`` and ``times`` of every distinct pair of every document."""
    each = rows.select("_row", F.explode("links").alias("_l"))
    return each.select("_row", F.shiftright("_l", 32).alias("pair"), F.col("_l").bitwiseAND(F.lit(0xFFFFFFFF)).alias("times"))


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """``pair``, ``n_docs`` and ``best`` (whether no pair of its A id has more), written out."""
    counts = materialise(_pairs(rows).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pairs")
    counts = counts.withColumn("_a", F.floor(F.col("pair") / b_size))
    most = counts.groupBy("_a").agg(F.max("n_docs").alias("_most"))  # one row an A id: A's vocabulary bounds it
    return materialise(counts.join(F.broadcast(most), "_a").select("pair", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best")), "pairs")


def _least_hot(counts: DataFrame) -> int:
    """The least power of two such that ``HOT`` pairs at most have as many documents."""
    by_size = sorted(counts.groupBy(F.expr("length(bin(n_docs))").alias("bits")).count().collect(), reverse=True)  # 64 rows at most
    so_far, bits = 0, 63
    for r in by_size:
        so_far += r["count"]
        if so_far > HOT:
            return 1 << (bits - 1)
        bits = r["bits"]
    return 1


def link_scores(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``_row``, ``n_best`` and ``count_sum`` of the documents that have links."""
    least = _least_hot(counts)
    hot, rest = counts.filter(F.col("n_docs") >= least), counts.filter(F.col("n_docs") < least)
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")]
    near = _pairs(rows).join(F.broadcast(hot), "pair").groupBy("_row").agg(*sums)
    far = _pairs(rows).join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(rest, "pair").groupBy("_row").agg(*sums)
    return near.unionByName(far).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def scored_alignment(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the figures of :func:`align`, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row."""
    out = align(df, a_path, b_path, id_col, text_col)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    figures = ["n_a", "n_b", "n_groups", "n_links"]
    rows = materialise(out.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), *figures, digest, "links"), "aligned")
    scores = link_scores(rows, pair_counts(rows, len(tokenizers(a_path, b_path).sizes[1])))
    zero = F.lit(0).cast("long")
    done = rows.drop("links").join(scores, "_row", "left")
    return done.select(
        F.col("_id").alias(id_col), *figures, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
