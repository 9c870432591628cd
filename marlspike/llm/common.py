"""Pieces shared by the corpus operators: settled intermediates and Arrow text batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.sources.shared import scratch  # noqa: F401
from marlspike.sources.shared import settle as materialise  # noqa: F401

CHUNK_BYTES = 1 << 20
#: Bits of the bitmap of :func:`maybe_in`.
MARKS = 1 << 24


def row_key(*cols: Column | str) -> list[Column]:
    """A 128-bit key of a row as two bigints; rows that agree in all ``cols`` share it (nulls count as values)."""
    flat = [F.col(c) if isinstance(c, str) else c for c in cols]
    tags = [c.isNull() for c in flat]
    return [
        F.xxhash64(F.lit(tag), *flat, *tags).alias(name) for name, tag in (("_k1", "a"), ("_k2", "b"))
    ]


def maybe_in(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """``rows`` whose ``names`` may be among those of ``keys``: none of these is lost, and most others go before they are moved.

    A bitmap of ``MARKS`` bits is set at a hash of each key; it is two megabytes, whatever the number of keys.
    """
    place = (F.pmod(F.xxhash64(*names), F.lit(MARKS)) + 1).alias("_place")
    bucket, bit = F.bitmap_bucket_number("_place"), F.bitmap_bit_position("_place")
    marks = keys.select(place).groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    tested = rows.withColumn("_place", place).withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(marks), "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return tested.filter(F.getbit(byte, F.expr("cast(_bit % 8 as int)")) == 1).select(*rows.columns)


def maybe_flag(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """``rows`` with ``_maybe``: true where ``names`` are among those of ``keys``, false for most others; no row is moved (see :func:`maybe_in`)."""
    place = (F.pmod(F.xxhash64(*names), F.lit(MARKS)) + 1).alias("_place")
    bucket, bit = F.bitmap_bucket_number("_place"), F.bitmap_bit_position("_place")
    marks = keys.select(place).groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    tested = rows.withColumn("_place", place).withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(marks), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return tested.select(*rows.columns, F.coalesce(F.getbit(byte, F.expr("cast(_bit % 8 as int)")) == 1, F.lit(False)).alias("_maybe"))


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array with offsets; a null is an empty text."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, at least one row each, so that work arrays stay small."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def chunked(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold at most ``limit`` bytes together (a longer text stands alone)."""
    _, offsets = utf8_buffer(batch.column(column))
    for a, b in byte_chunks(offsets, limit):
        yield batch.slice(a, b - a)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a column, null as empty."""
    return [t or "" for t in column.to_pylist()]
