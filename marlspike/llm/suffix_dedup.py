"""Removal of repeated long passages by a hash-compared suffix sort (operator 1).

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts elsewhere in the
corpus.  Every such string (a window) is the head of a suffix; windows that are equal stand
together in a sorted suffix array.  To sort a corpus in pieces, each window is filed under its
anchor: the smallest hash of a ``GRAM``-byte string inside it, the leftmost if several.  Equal
windows have equal anchors at equal distances, so only suffixes of one anchor and distance need
sorting together.  Neighbouring windows mostly share their anchor: such a run is one row, a
segment, and there are few of them (one for about 170 bytes).

1. Segments are made in one pass over the texts and written out; anchors seen once are dropped.
2. Segments with the same bytes are one segment with a count; where the count is over one, all
   their windows are repeated.  They are found by hashes and verified: the bytes of a group are
   compared, and a group whose members differ is split by them.
3. Where an anchor has segments of differing bytes, one of each is cut from its text and the
   suffixes are sorted: a merge sort whose comparisons find the common extension of two
   suffixes by binary search over prefix polynomial hashes.  All merges of a batch run in step.
   Windows found equal are compared byte by byte before they count.
4. An anchor may have any number of segments.  Beyond ``CROWD`` they are cut finer: into pieces of
   at most 64, then 8, then 1 windows, filed under the bytes that all windows of such a piece
   share.  Pieces are counted, and sorted, like segments; a piece of one window needs no sort.

Cases: null and empty texts, and texts shorter than the window, keep all bytes; equal rows
repeat each other, wholly, and stand for one row in the search; very long texts are cut into blocks with an overlap; matches never cross
texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import materialise, maybe_flag, maybe_in, row_key, scratch, utf8_buffer

LENGTH, GRAM = 400, 64
#: Bytes hashed together, segments of one anchor that are sorted together, and windows of a piece at each finer cut.
BLOCK, CROWD, FINER = 1 << 20, 512, (64, 8, 1)
_BASE = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k, step = 1, base
    while k < n:
        out[k : 2 * k] = out[: min(k, n - k)] * np.uint64(step)
        k, step = 2 * k, step * step & _M
    return out


class Hashes:
    """Polynomial hashes (modulo 2**64) of all substrings of a byte array, from prefix sums."""

    _table: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(Hashes._table[0]) < n:
            size = max(n, BLOCK + LENGTH + 1)
            Hashes._table = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
        up, self.down = Hashes._table
        self.prefix = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: n - 1], out=self.prefix[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of a block of whole texts: text, first window, windows, distance of the anchor from it, anchor hash."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    grams = _mixed(Hashes(data).of(np.arange(len(data) - gram + 1), gram))
    low = np.uint64((1 << (BLOCK + LENGTH).bit_length()) - 1)  # the bits that hold a place in any block
    least = _sliding_min(grams & ~low | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)  # windows of each text
    at = np.arange(int(sizes.sum())) + np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes)
    if not len(at):
        return none, none, none, none, none
    anchor = (least[at] & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    return np.repeat(np.arange(len(sizes)), sizes)[first], start, count, anchor[first] - start, grams[anchor[first]].view(np.int64)


def blocks(offsets: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """Rows and bytes to hash together: whole texts up to ``BLOCK`` bytes, or a piece of a long one.

    Pieces of one text overlap so that each window lies in exactly one piece.
    """
    row, n = 0, len(offsets) - 1
    while row < n:
        if offsets[row + 1] - offsets[row] > BLOCK:
            a, end = int(offsets[row]), int(offsets[row + 1])
            while a + length <= end:
                yield row, row + 1, a, min(a + BLOCK + length - 1, end)
                a += BLOCK
            row += 1
            continue
        last = min(max(int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1, row + 1), n)
        yield row, last, int(offsets[row]), int(offsets[last])
        row = last


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        data, offsets = utf8_buffer(batch.column("_text"))
        keys = [batch.column(k).to_numpy() for k in ("_k1", "_k2")]
        for r0, r1, a, b in blocks(offsets):
            local = np.clip(offsets[r0 : r1 + 1], a, b) - a
            text, start, count, back, anchor = segments(data[a:b], local)
            raw = memoryview(data[a:b])
            same = [digest(raw[s:e]) for s, e in zip(start.tolist(), (start + count + LENGTH - 1).tolist())]
            home = text + r0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor), pa.array(np.array(same, np.uint64).view(np.int64)), pa.array(keys[0][home]), pa.array(keys[1][home]),
                    pa.array(start + a - offsets[home]), pa.array(count.astype(np.int32)), pa.array(back.astype(np.int32)),
                ],
                ["anchor", "same", "_k1", "_k2", "at", "count", "back"],
            )


_PIECE = "_k1 long, _k2 long, anchor long, same long, split int, known boolean, at long, count int, back int, crowd boolean, bytes binary"
_FIELDS = ["anchor", "same", "split", "known", "at", "count", "back", "crowd"]
#: What makes segments one: their hashes, and a number that tells groups of one hash with differing bytes apart.
_KIND = ["anchor", "same", "split"]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments to sort, cut from their texts."""
    for batch in batches:
        data, offsets = utf8_buffer(batch.column("_text"))
        wanted = batch.column("wanted")
        rows = pc.list_parent_indices(wanted).to_numpy()
        flat = pc.list_flatten(wanted)
        begin = offsets[rows] + flat.field("at").to_numpy()
        end = begin + flat.field("count").to_numpy() + LENGTH - 1
        keys = [batch.column(k).to_numpy()[rows] for k in ("_k1", "_k2")]
        raw = data.tobytes()
        for x in range(0, len(rows), 4096):
            y = slice(x, x + 4096)
            parts = [raw[s:e] for s, e in zip(begin[y].tolist(), end[y].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k[y]) for k in keys), *(flat.field(k).slice(x, 4096) for k in _FIELDS), pa.array(parts, pa.binary())], ["_k1", "_k2", *_FIELDS, "bytes"]
            )


def _finer(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts pieces to windows whose distances from the anchor fall in one range of ``width``, filed under what those windows share."""
    digest = xxhash.xxh3_64_intdigest
    names = ["_k1", "_k2", "anchor", "same", "split", "known", "at", "count", "back", "bytes"]
    read = [n for n in names if n != "split"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(0, batch.num_rows, 1024):
                out: dict[str, list] = {n: [] for n in names}
                part = batch.slice(x, 1024).select(read).to_pylist()
                for r in part:
                    last = r["back"] - r["count"] + 1  # distance of the last window
                    for q in range(last // width, r["back"] // width + 1):
                        high, low = min(r["back"], q * width + width - 1), max(last, q * width)
                        j, n = r["back"] - high, high - low + 1
                        piece = r["bytes"][j : j + n + LENGTH - 1]
                        shared = r["bytes"][r["back"] - q * width : r["back"] - q * width - width + 1 + LENGTH]
                        new = {
                            "_k1": r["_k1"], "_k2": r["_k2"], "anchor": digest(shared, (r["anchor"] * 31 + q) & _M), "same": digest(piece), "known": r["known"],
                            "at": r["at"] + j, "count": n, "back": high, "bytes": piece,
                        }
                        for k in read:
                            out[k].append(new[k])
                for k in ("anchor", "same"):
                    out[k] = np.array(out[k], np.uint64).view(np.int64)
                out["split"] = [0] * len(out["at"])
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names)

    return run


def extension(h: Hashes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bytes, up to ``LENGTH``, that the suffixes at ``x`` and ``y`` have in common: binary search over prefix hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = h.of(x, mid) == h.of(y, mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def suffix_sort(data: np.ndarray, h: Hashes, at: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``at`` by cell, then by their first ``LENGTH`` bytes; and a hash of these bytes.

    ``cell`` must ascend.  A bottom-up merge sort of all cells in step: at each level every
    suffix finds its rank in the sibling run by binary search with hash-compared suffixes.
    """
    whole = h.of(at, LENGTH)

    def less(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        out = or_equal.copy()
        differ = np.flatnonzero(whole[x] != whole[y])
        if len(differ):
            p, q = at[x[differ]], at[y[differ]]
            n = np.minimum(extension(h, p, q), LENGTH - 1)
            out[differ] = data[p + n] < data[q + n]
        return out

    n = len(at)
    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.append(begin, n))
    first, last = np.repeat(begin, size), np.repeat(begin + size, size)
    index = np.arange(n) - first  # place in the cell
    width, widest = 1, int(size.max()) if n else 0
    while width < widest:
        run = index // width
        right = (run & 1) == 1
        other = first + (run ^ 1) * width
        act = np.flatnonzero(other < last)  # the sibling run is not empty
        low = other[act]
        base = low.copy()
        high = np.minimum(low + width, last[act])
        mine, is_right = order[act], right[act]
        while True:
            busy = np.flatnonzero(low < high)
            if not len(busy):
                break
            mid = (low[busy] + high[busy]) >> 1
            # A right suffix comes after equal left ones, a left one before equal right ones.
            before = less(order[mid], mine[busy], is_right[busy])
            low[busy] = np.where(before, mid + 1, low[busy])
            high[busy] = np.where(before, high[busy], mid)
        pair = first[act] + (run[act] & ~1) * width
        own = act - (first[act] + run[act] * width)
        moved = order.copy()
        moved[pair + own + (low - base)] = mine
        order, width = moved, width * 2
    return order, whole


def _verified(data: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether the windows at ``at`` (ascending) equal those at ``to``; after an equal neighbour only the last byte is new."""
    step = np.zeros(len(at), bool)
    step[1:] = (np.diff(at) == 1) & (np.diff(to) == 1)
    ok = data[at + LENGTH - 1] == data[to + LENGTH - 1]
    heads = np.flatnonzero(~step)
    for a in range(0, len(heads), 2048):
        i = heads[a : a + 2048, None]
        span = np.arange(LENGTH)[None, :]
        ok[heads[a : a + 2048]] = (data[at[i] + span] == data[to[i] + span]).all(axis=1)
    return ok


def repeated(data: np.ndarray, at: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """For each window its class: the number of the first window of the class (a window that stands alone is its own)."""
    order, whole = suffix_sort(data, Hashes(data), at, cell)
    head = np.ones(len(at), bool)
    head[1:] = (whole[order[1:]] != whole[order[:-1]]) | (cell[order[1:]] != cell[order[:-1]])
    begin = np.flatnonzero(head)
    least = np.minimum.reduceat(order, begin)
    out = np.empty(len(at), np.int64)
    out[order] = np.repeat(least, np.diff(np.append(begin, len(at))))
    rest = np.flatnonzero(out != np.arange(len(at)))
    rest = rest[np.argsort(at[rest], kind="stable")]
    if len(rest) and not _verified(data, at[rest], at[out[rest]]).all():
        seen: dict[tuple[int, bytes], int] = {}  # two windows with one hash: class by the bytes themselves
        out = np.array([seen.setdefault((c, data[p : p + LENGTH].tobytes()), i) for i, (c, p) in enumerate(zip(cell.tolist(), at.tolist()))])
    return out


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows.  Batches are ordered by anchor; work is done on whole groups of at least a block."""

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {k: t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in t.column_names if k != "bytes"}
        data, offsets = utf8_buffer(t.column("bytes").combine_chunks())
        count = col["count"].astype(np.int64)
        group = np.cumsum(np.concatenate([[0], np.diff(col["anchor"]) != 0]))
        row = np.repeat(np.arange(len(count)), count)
        j = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[row] + j
        cell = group[row] * LENGTH + (col["back"][row] - j)
        order = np.argsort(cell, kind="stable")
        cls = np.empty(len(at), np.int64)
        cls[order] = order[repeated(data, at[order], cell[order])]
        many = np.bincount(cls, minlength=len(at))[cls] > 1
        mine = np.flatnonzero(many & ~col["known"][row])
        if len(mine):
            owner, first = np.unique(row[mine], return_index=True)
            last = np.append(first[1:], len(mine)) - 1
            # All windows of a segment hold its anchor, so what lies between two repeated ones is covered.
            lo, hi = col["at"][owner] + j[mine[first]], col["at"][owner] + j[mine[last]] + LENGTH
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (col["_k1"][owner], col["_k2"][owner], lo, hi)], ["_k1", "_k2", "lo", "hi"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size < BLOCK:
            continue
        t = pa.Table.from_batches(held)
        edge = np.flatnonzero(np.diff(t.column("anchor").to_numpy())) + 1
        start = 0
        sizes = np.cumsum(np.concatenate([[0], t.column("count").to_numpy() + LENGTH - 1]))
        for e in edge.tolist():
            if sizes[e] - sizes[start] >= BLOCK or e == edge[-1]:
                yield from work(t.slice(start, e - start))
                start = e
        held = t.slice(start).to_batches()
        size = int(sizes[-1] - sizes[start])
    if held:
        yield from work(pa.Table.from_batches(held))


def _span(df: DataFrame) -> DataFrame:
    return df.select("_k1", "_k2", F.col("at").alias("lo"), (F.col("at") + F.col("count") + LENGTH - 1).alias("hi"))


def _sort_groups(pieces: DataFrame) -> DataFrame:
    dealt = pieces.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(_sorted_spans, "_k1 long, _k2 long, lo long, hi long")


def _verified_kinds(members: DataFrame, held: DataFrame) -> DataFrame:
    """``members`` with groups of one hash but differing bytes told apart; ``held`` has ``_KIND`` and ``bytes`` of every member of a group of several."""
    several = held.groupBy(*_KIND, "bytes").count().groupBy(*_KIND).agg(F.count(F.lit(1)).alias("n"))
    mixed = materialise(several.filter("n > 1").select(*_KIND), "mixed")
    if mixed.isEmpty():
        return members
    each = held.join(mixed, _KIND).select(*_KIND, "_k1", "_k2", "at", "bytes").distinct()
    rank = F.dense_rank().over(Window.partitionBy(*_KIND).orderBy("bytes"))
    told = each.select(*_KIND, "_k1", "_k2", "at", rank.alias("_rank"))
    return members.join(told, [*_KIND, "_k1", "_k2", "at"], "left").withColumn("split", F.coalesce("_rank", "split")).drop("_rank")


def _kinds(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct segments by anchor and bytes, and the anchors of several of them with how many.

    Both are written out, so that joins on a frequent anchor can be split.
    """
    one = F.min(F.struct("_k1", "_k2", "at", "count", "back")).alias("one")
    kinds = members.groupBy(*_KIND).agg(((F.count(F.lit(1)) > 1) | F.max("known")).alias("known"), (F.count(F.lit(1)) > 1).alias("twice"), one)
    kinds = materialise(kinds, "kinds")
    return kinds, materialise(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("width")).filter("width > 1"), "widths")


def _several(members: DataFrame) -> DataFrame:
    """Hashes that several members share, written out so that a join on a frequent one can be split."""
    return materialise(members.groupBy(*_KIND).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*_KIND), "several")


def _cut_from(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of segments (``_k1``, ``_k2`` and ``_FIELDS``) from their texts."""
    by_text = wanted.groupBy("_k1", "_k2").agg(F.collect_list(F.struct(*_FIELDS)).alias("wanted"))
    return maybe_in(rows, wanted, "_k1", "_k2").join(by_text, ["_k1", "_k2"]).mapInArrow(_cut, _PIECE)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """Spans (``_k1``, ``_k2``, ``lo``, ``hi``) of repeated bytes of the texts of ``rows`` (``_k1``, ``_k2``, ``_text``)."""
    with scratch(rows.sparkSession):
        once, whole = _once(rows)
        spans = _all_spans(once)
        return materialise((spans if whole is None else spans.unionByName(whole)).distinct(), "spans", outlive=True)


def _once(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """One row of each key, and the spans of keys that have several: whole texts, for each string of them starts in the other row too.

    Of all other texts none is moved for that.
    """
    size = F.octet_length("_text").cast("long")
    copies = rows.groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("n"), F.max(size).alias("hi")).filter("n > 1")
    copies = materialise(copies.select("_k1", "_k2", F.lit(0).cast("long").alias("lo"), "hi"), "copies")
    if copies.isEmpty():
        return rows, None
    told = maybe_flag(rows, copies, "_k1", "_k2")
    one = materialise(told.filter("_maybe").drop("_maybe").dropDuplicates(["_k1", "_k2"]), "once")
    return told.filter("not _maybe").drop("_maybe").unionByName(one), copies.filter(F.col("hi") >= LENGTH)


def _all_spans(rows: DataFrame) -> DataFrame:
    schema = "anchor long, same long, _k1 long, _k2 long, at long, count int, back int"
    every = materialise(rows.mapInArrow(_segment_rows, schema), "segments")
    often = materialise(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "often")
    some = every.join(often, "anchor", "left_semi").withColumns({"known": F.lit(False), "split": F.lit(0)})
    some = materialise(some, "repeated")
    alike = materialise(some.join(_several(some), _KIND, "left_semi").withColumn("crowd", F.lit(False)), "alike")
    some = _verified_kinds(some, _cut_from(rows, alike))
    kinds, widths = _kinds(some)
    spans = [_span(some.join(kinds.filter("twice").select(*_KIND), _KIND, "left_semi"))]
    sort = kinds.join(widths, "anchor").select("one.*", *_KIND, "known", (F.col("width") > CROWD).alias("crowd"))
    pieces = materialise(_cut_from(rows, materialise(sort, "sort")), "pieces")
    spans.append(_sort_groups(pieces.filter("not crowd")))
    for width in FINER:
        crowd = pieces.filter("crowd")
        if crowd.isEmpty():
            break
        fine = materialise(crowd.drop("crowd").mapInArrow(_finer(width), _PIECE.replace(" crowd boolean,", "")), "finer")
        fine = _verified_kinds(fine, fine.join(_several(fine), _KIND, "left_semi"))
        kinds, widths = _kinds(fine)
        repeats = kinds.filter("twice").select(*_KIND)
        spans.append(_span(fine.filter("not known").join(repeats, _KIND, "left_semi")))
        sort = kinds.join(widths, "anchor").select(*(F.col(f"one.{k}").alias(k) for k in ("_k1", "_k2", "at")), *_KIND, F.col("known").alias("_known"), (F.col("width") > CROWD).alias("crowd"))
        pieces = fine.join(sort, [*_KIND, "_k1", "_k2", "at"]).withColumn("known", F.col("_known")).drop("_known")
        pieces = materialise(pieces, "pieces")
        spans.append(_sort_groups(pieces.filter("not crowd")))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def _runs(spans: list[dict[str, int]] | None) -> list[list[int]]:
    """Spans in order, those that touch or overlap as one."""
    runs: list[list[int]] = []
    for s in sorted((x["lo"], x["hi"]) for x in spans or ()):
        if runs and s[0] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s[1])
        else:
            runs.append([*s])
    return runs


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8_buffer(batch.column("_text"))
        raw, o = data.tobytes(), offsets.tolist()
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "n_passage_words")}
        passages = batch.column("passages").to_pylist()
        for i, found in enumerate(batch.column("spans").to_pylist()):
            text = raw[o[i] : o[i + 1]]
            runs = _runs(found)
            out["n_passage_words"].append(sum(b - a for a, b in _runs(passages[i])))
            edges = [0, *(x for r in runs for x in r), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(len(runs))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append([{"lo": a, "hi": b} for a, b in runs])
            out["kept"].append(kept)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], ["_id", *out])


def _listed(spans: DataFrame, name: str) -> DataFrame:
    return spans.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("lo", "hi")).alias(name))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Every row's ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, removed ``spans`` and ``kept`` bytes.

    What goes is a matter of bytes, so a passage of many short words may stay though it repeats.  A ``report``
    finds word spans of the same texts (:func:`marlspike.llm.passages.shared_passages`); then
    ``n_passage_words`` tells how many words of a row lie in them.
    """
    kind = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), *row_key(id_col, text), text.alias("_text"))
    keyed = rows.select("_k1", "_k2", "_text")
    out = rows.join(_listed(repeated_spans(keyed), "spans"), ["_k1", "_k2"], "left")
    if report is None:
        out = out.withColumn("passages", F.lit(None).cast("array<struct<lo:long,hi:long>>"))
    else:
        out = out.join(_listed(report(keyed), "passages"), ["_k1", "_k2"], "left")
    schema = f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo:long,hi:long>>, kept binary, n_passage_words long"
    out = out.mapInArrow(_remove, schema).withColumnRenamed("_id", id_col)
    return out if report else out.drop("n_passage_words")
