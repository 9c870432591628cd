"""Exact duplicates through content-defined chunk recipes (operator 6).

Each normalised text is cut where a rolling hash of its last 16 bytes says so, which does not
depend on where in a text the bytes stand.  Chunks are deduplicated once by a 64-bit hash and
verified: a hash whose chunks are not all the same bytes is no identifier, and its chunks are
named by SHA-256 instead.  A text is then the ordered list of its chunks' identifiers (its
recipe), and texts are equal when their recipes are.  Chunk bytes cross the network once, for
the verification; texts never do.

Cases: null, empty and all-space texts have the empty recipe and form one group; of repeated
rows (same id, same text) one is kept; a tie in length goes to the smallest id, null ids last;
very long texts become long recipes; an empty table gives an empty result; extra columns are
ignored by :func:`exact_groups` and returned by :func:`drop_exact_copies`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import byte_chunks, materialise, row_key, utf8_buffer

#: A cut where these bits of the rolling hash are zero (1 KB on average), and the longest chunk.
CUT_MASK, LONGEST = np.uint32(0x3FF << 20), 8192
_ROLL = 16
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of a UTF-8 buffer without ``[\\x20\\x09-\\x0D]``."""
    keep = ~_SPACE[data]
    upto = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], upto[offsets]


def cut_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks of the texts of a buffer, in order, and the text that each belongs to."""
    n = len(data)
    h = _GEAR[data]
    reach = 1
    while reach < _ROLL:
        g = h.copy()
        g[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = g, reach * 2
    sizes = np.diff(offsets)
    cuts = np.flatnonzero((h & CUT_MASK) == 0) + 1  # the next byte begins a chunk
    cuts = cuts[cuts < n]
    home = np.searchsorted(offsets, cuts, "right") - 1
    ok = cuts - offsets[home] >= _ROLL  # the hash must not have seen the text before
    starts = np.union1d(cuts[ok], offsets[:-1][sizes > 0])
    ends = np.append(starts[1:], n)
    extra = (ends - starts - 1) // LONGEST
    if extra.any():  # long stretches without a cut are cut at fixed steps
        rep = np.repeat(np.arange(len(starts)), extra)
        step = np.arange(len(rep)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        starts = np.union1d(starts, starts[rep] + step * LONGEST)
    return starts, np.searchsorted(offsets, starts, "right") - 1


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    data, offsets = utf8_buffer(batch.column("_text"))
    for a, b in byte_chunks(offsets):
        part, off = normalise(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        starts, home = cut_points(part, off)
        yield a, b, part.tobytes(), off, starts, home


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, _, starts, _ in _pieces(batch):
            ends = [*starts[1:].tolist(), len(raw)]
            parts = list(dict.fromkeys(raw[s:e] for s, e in zip(starts.tolist(), ends)))
            hashes = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(parts, pa.binary())], ["h", "chunk"])


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, raw, off, starts, home in _pieces(batch):
            ends = [*starts[1:].tolist(), len(raw)]
            parts = [raw[s:e] for s, e in zip(starts.tolist(), ends)]
            hashes = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64).astype(np.int64)
            digests = [hashlib.sha256(p).digest() for p in parts]
            edges = pa.array(np.searchsorted(home, np.arange(b - a + 1)).astype(np.int32))
            o = off.tolist()
            sha = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(o, o[1:])]
            rows = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("_id"), rows.column("_k1"), rows.column("_k2"), rows.column("_n"), pa.array(sha),
                    pa.ListArray.from_arrays(edges, pa.array(hashes)),
                    pa.ListArray.from_arrays(edges, pa.array(digests, pa.binary())),
                ],
                ["_id", "_k1", "_k2", "_n", "text_sha256", "hashes", "digests"],
            )


def chunk_store(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct chunks by hash: ``h``, one of its chunks, and ``verified`` (all its chunks are the same bytes)."""
    chunks = df.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(_chunks, "h long, chunk binary")
    both = chunks.groupBy("h").agg(F.min("chunk").alias("chunk"), F.max("chunk").alias("_most"))
    return both.select("h", "chunk", (F.col("chunk") == F.col("_most")).alias("verified"))


def recipes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, a key of the row, code points, digest of the normalised text and ``recipe`` of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = df.select(F.col(id_col).alias("_id"), *row_key(id_col, text), F.char_length(text).cast("long").alias("_n"), text.alias("_text"))
    schema = f"_id {kind}, _k1 long, _k2 long, _n long, text_sha256 string, hashes array<long>, digests array<binary>"
    rows = materialise(src.mapInArrow(_recipes, schema), "recipes")
    unsure = materialise(chunk_store(df, text_col).filter(~F.col("verified")).select("h"), "unsure")
    hit = (
        rows.select("_k1", "_k2", F.explode("hashes").alias("h")).join(unsure, "h", "left_semi")
        .groupBy("_k1", "_k2").agg(F.collect_set("h").alias("_unsure"))
    )
    name = F.transform(
        F.arrays_zip("hashes", "digests"),
        lambda e: F.when(F.array_contains("_unsure", e["hashes"]), F.hex(e["digests"])).otherwise(F.hex(e["hashes"])),
    )
    return rows.join(hit, ["_k1", "_k2"], "left").select(
        "_id", "_k1", "_k2", "_n", "text_sha256", F.array_join(name, ",").alias("recipe")
    )


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and the row's key."""
    # Both sides of the join are written out, so that a group of very many copies can be split.
    rows = materialise(recipes(df, id_col, text_col), "named")
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), "_k1", "_k2"))
    groups = materialise(rows.groupBy("recipe").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size")), "groups")
    again = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))
    joined = rows.join(groups, "recipe").withColumn("_again", again)
    first = (F.col("_k1") == F.col("b._k1")) & (F.col("_k2") == F.col("b._k2")) & (F.col("_again") == 1)
    return joined.select(
        F.col("_id").alias(id_col), F.col("b.id").alias("keep_id"), "group_size", first.alias("kept"), "text_sha256", "_k1", "_k2"
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    kept = exact_groups(df, id_col, text_col).filter("kept").select("_k1", "_k2")
    k1, k2 = row_key(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), k1, k2)
    again = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))
    return rows.join(kept, ["_k1", "_k2"], "left_semi").withColumn("_again", again).filter("_again = 1").select("_row.*")
