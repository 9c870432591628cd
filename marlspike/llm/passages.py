"""Passages of over fifty words that several documents share: a report beside operator 1, whose law counts bytes.

Words are split at ASCII white space and lower-cased (A-Z).  A window is ``LEAST`` words.  As in operator 1,
each window is filed under its anchor, here the smallest hash of ``GRAM`` words inside it, and a run
of windows with one anchor is one row, a segment.  Anchors that one document alone has are dropped
first, which leaves little; segments with equal words count as one; where an anchor has several
kinds of segments, their windows are met by hash.  Two windows count as equal if their own 64-bit
hashes and those of their anchors are.  Nothing is removed here, so they are not compared again.

Cases: null and empty texts, and texts of fewer words, share nothing; rows with equal id and text are one
document; a passage that only repeats inside one document is none; very long texts are cut into blocks with
an overlap; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, materialise, maybe_in, scratch, utf8_buffer
from marlspike.llm.suffix_dedup import Hashes, _mixed, blocks, segments

LEAST, GRAM = 51, 32
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts of a UTF-8 buffer, one after the other, and where each text's begin."""
    raw = data.tobytes().translate(_LOWER)
    texts = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    edge = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for t in texts for w in t), np.uint64, int(edge[-1])), edge


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in chunked(whole, "_text"):
            words, edge = word_hashes(*utf8_buffer(batch.column("_text")))
            keys = [batch.column(k).to_numpy() for k in ("_k1", "_k2")]
            for r0, r1, a, b in blocks(edge, LEAST):
                text, start, count, back, anchor = segments(words[a:b], np.clip(edge[r0 : r1 + 1], a, b) - a, LEAST, GRAM)
                if not len(text):
                    continue
                same = _mixed(Hashes(words[a:b]).of(start, count + (LEAST - 1))).view(np.int64)
                home = text + r0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(same), pa.array(keys[0][home]), pa.array(keys[1][home]), pa.array((start + a - edge[home]).astype(np.int32)), pa.array(count.astype(np.int32))],
                    ["anchor", "same", "_k1", "_k2", "at", "count"],
                )


_FIELDS = ["anchor", "same", "kmin", "kmax", "at", "count"]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of the segments that a text is wanted for."""
    for whole in batches:
        for batch in chunked(whole, "_text"):
            words, edge = word_hashes(*utf8_buffer(batch.column("_text")))
            wanted = batch.column("wanted")
            row, flat = pc.list_parent_indices(wanted).to_numpy(), pc.list_flatten(wanted)
            col = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in _FIELDS}
            count = col["count"].astype(np.int64)
            of = np.repeat(np.arange(len(row)), count)
            j = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            w = _mixed(Hashes(words).of(edge[row[of]] + col["at"][of] + j, LEAST)).view(np.int64)
            for x in range(0, len(of), 1 << 16):
                y = slice(x, x + (1 << 16))
                yield pa.RecordBatch.from_arrays([*(pa.array(col[k][of[y]]) for k in _FIELDS[:4]), pa.array(j[y].astype(np.int32)), pa.array(w[y])], [*_FIELDS[:4], "j", "w"])


def shared_passages(rows: DataFrame) -> DataFrame:
    """Spans (``_k1``, ``_k2``, ``lo``, ``hi``, in words) of ``rows`` (``_k1``, ``_k2``, ``_text``) that lie in windows of another document too."""
    with scratch(rows.sparkSession):
        return materialise(_spans(rows).distinct(), "passages", outlive=True)


def _spans(rows: DataFrame) -> DataFrame:
    every = materialise(rows.mapInArrow(_segment_rows, "anchor long, same long, _k1 long, _k2 long, at int, count int"), "windows")
    ends = [F.min("_k1").alias("kmin"), F.max("_k1").alias("kmax")]
    often = materialise(every.groupBy("anchor").agg(*ends).filter("kmin != kmax").select("anchor"), "often")
    some = materialise(every.join(often, "anchor", "left_semi"), "shared")
    kinds = materialise(some.groupBy("anchor", "same").agg(*ends, F.min(F.struct("_k1", "_k2", "at", "count")).alias("one")), "kinds")
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    wanted = kinds.join(several, "anchor", "left_semi").select("one.*", "anchor", "same", "kmin", "kmax")
    wanted = materialise(wanted, "wanted")
    by_text = wanted.groupBy("_k1", "_k2").agg(F.collect_list(F.struct(*_FIELDS)).alias("wanted"))
    schema = "anchor long, same long, kmin long, kmax long, j int, w long"
    windows = materialise(maybe_in(rows, wanted, "_k1", "_k2").join(by_text, ["_k1", "_k2"]).mapInArrow(_windows, schema), "kinds")
    met = windows.groupBy("anchor", "w").agg(F.min("kmin").alias("kmin"), F.max("kmax").alias("kmax")).filter("kmin != kmax").select("anchor", "w")
    # All windows of a segment hold its anchor, so what lies between two shared ones is covered.
    partly = windows.join(met, ["anchor", "w"], "left_semi").select("anchor", "same", F.col("j").alias("lo"), F.col("j").alias("hi"))
    wholly = kinds.filter("kmin != kmax").select("anchor", "same", F.lit(0).alias("lo"), (F.col("one.count") - 1).alias("hi"))
    found = materialise(partly.unionByName(wholly).groupBy("anchor", "same").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "found")
    at = F.col("at").cast("long")
    return some.join(found, ["anchor", "same"]).select("_k1", "_k2", (at + F.col("lo")).alias("lo"), (at + F.col("hi") + LEAST).alias("hi"))
