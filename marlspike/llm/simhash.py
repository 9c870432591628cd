"""Near duplicates by SimHash and deletion-variant signatures (operator 9).

A fingerprint has 64 bits.  Of two that differ in three bits or fewer, one of their two halves
differs in one bit at most, so both have a common variant of that half with one bit blotted
out.  Distinct fingerprints are indexed under all 64 such variants, joined on equality and
verified.  In a bucket of more than ``BUCKET`` fingerprints pairs would pile up; there two
fingerprints are linked through a word that is within one bit of one and two bits of the
other, which exists exactly when they differ in three bits at most.  That costs a fixed number
of rows a fingerprint, and no link is lost.

Cases: null, empty and all-space texts have fingerprint zero and link like any other; texts of
fewer words than a shingle are one shingle; equal texts share a fingerprint and need no pair;
repeated rows share a component; null ids never name a component unless all are null; very
long texts are read whole; an empty table gives an empty result; extra columns are ignored by
:func:`near_groups` and returned by :func:`drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import chunked, materialise, row_key
from marlspike.llm.components import components

#: Fingerprints of a bucket up to which they are paired directly.
BUCKET = 256
DISTANCE = 3
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many of at most 255 hashes (a row each, of one or more 64-bit words) have each bit set."""
    bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.uint8)


def _fold(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    on = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


def _remixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the same shingles that are independent of the first ones, for further fingerprints."""
    h = (hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def fingerprint_set(text: bytes, words: int = 3, seed: int = 42, extra: int = 0) -> list[int]:
    """SimHash of a text's word shingles, and ``extra`` independent ones, as unsigned 64-bit integers."""
    found = text.translate(_LOWER).split()
    if not found:
        return [0] * (1 + extra)
    line = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) < words:
        hashes = np.array([digest(line, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = [0, *(ends[: len(found) - words] + 1).tolist()]
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[words - 1 :].tolist())], np.uint64)
    return [_fold(hashes), *(_fold(_remixed(hashes, k)) for k in range(1, extra + 1))]


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit integer."""
    return fingerprint_set(text, words, seed)[0]


def _prints(words: int, seed: int, extra: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunked(whole, "_text"):
                rows = batch.column("_text").cast(pa.binary()).to_pylist()
                prints = np.array([fingerprint_set(t or b"", words, seed, extra) for t in rows], np.uint64).view(np.int64)
                keep = [k for k in batch.schema.names if k != "_text"]
                names = ["fp", *(f"fp{k}" for k in range(1, extra + 1))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k) for k in keep), *(pa.array(np.ascontiguousarray(prints[:, k])) for k in range(1 + extra))], [*keep, *names]
                )

    return run


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, extra: int = 0) -> DataFrame:
    """``_id``, the row's key and ``fp`` (64 bits as a signed long) of every row, with ``fp1`` and so on for ``extra`` ones."""
    kind = df.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    src = df.select(F.col(id_col).alias("_id"), *row_key(id_col, text), text.alias("_text"))
    more = "".join(f", fp{k} long" for k in range(1, extra + 1))
    return src.mapInArrow(_prints(words, seed, extra), f"_id {kind}, _k1 long, _k2 long, fp long{more}")


def _variants(prints: DataFrame) -> DataFrame:
    """Each fingerprint under its 64 one-wildcard half signatures; ``key`` holds half, position and the other bits."""
    return prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).selectExpr(
        "fp",
        "shiftleft(cast(v as bigint), 32) | ((if(v < 32, fp, shiftrightunsigned(fp, 32)) & 4294967295L)"
        " & ~shiftleft(1L, v % 32)) as key",
    )


def _hub_links(prints: DataFrame) -> DataFrame:
    """Links among ``prints`` at a distance of three at most, through words one bit from one and two from the other."""
    one = [0] + [1 << i for i in range(64)]
    two = [1 << i | 1 << j for i in range(64) for j in range(i)]
    signed = lambda xs: np.array(xs, np.uint64).view(np.int64).tolist()
    near = F.array(*map(F.lit, signed(one)))
    far = F.array(*map(F.lit, signed(two)))
    hubs = prints.select("fp", F.explode(near).alias("m"), F.lit(True).alias("near")).unionByName(
        prints.select("fp", F.explode(far).alias("m"), F.lit(False).alias("near"))
    )
    hubs = hubs.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("hub"), "near")
    head = hubs.groupBy("hub").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("head"), F.count(F.lit(1)).alias("n"))
    head = head.filter("head is not null and n > 1").select("hub", "head")
    return hubs.join(head, "hub").filter("fp != head").select(F.col("fp").alias("a"), F.col("head").alias("b")).distinct()


def links(prints: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) that join all distinct fingerprints of ``prints`` (column ``fp``) within ``DISTANCE`` bits.

    Every pair at that distance is linked, or both are linked to a common third.
    """
    full = _variants(prints).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    full = materialise(full, "buckets")
    few = full.filter(F.col("n") <= BUCKET).select("key", "fp")
    other = few.select("key", F.col("fp").alias("fp2"))
    pairs = few.join(other, "key").filter((F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= DISTANCE))
    found = pairs.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct()
    crowd = full.filter(F.col("n") > BUCKET)
    if not crowd.isEmpty():  # the hub plan is large: it is built only where there is something to link
        found = found.unionByName(_hub_links(crowd.select("fp").distinct()))
    return materialise(found, "found")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42, extra: int = 0) -> DataFrame:
    """One row a document: ``id_col``, ``fingerprint`` (hex), ``component_id``, ``group_size`` and the row's key.

    ``component_id`` is the smallest id that links reach, the row's own included.  With ``extra``
    fingerprints a document is also linked where any of those is within ``DISTANCE``: each gives a
    near copy another chance, and none makes unlike texts alike.
    """
    rows = materialise(fingerprints(df, id_col, text_col, words, seed, extra), "prints")
    prints = materialise(rows.groupBy("fp").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("n")), "distinct")
    every = links(prints.select("fp"))
    for k in range(1, extra + 1):
        # Links of another fingerprint, told in terms of the first: each value stands for the least first one that has it.
        pairs = rows.select("fp", F.col(f"fp{k}").alias("other")).distinct()
        head = materialise(pairs.groupBy("other").agg(F.min("fp").alias("head")), "heads")
        same = pairs.join(head, "other").filter("fp != head").select(F.col("fp").alias("a"), F.col("head").alias("b"))
        found = links(head.select(F.col("other").alias("fp")))
        ends = [head.select(F.col("other").alias(c), F.col("head").alias(f"head_{c}")) for c in ("a", "b")]
        told = found.join(ends[0], "a").join(ends[1], "b").select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
        every = every.unionByName(same).unionByName(told)
    roots = components(every)
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("group_size"))
    of_print = named.join(groups, "root").select("fp", "component_id", "group_size")
    return rows.join(of_print, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_size", "_k1", "_k2"
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: int = 0) -> DataFrame:
    """One row of each group, that with the smallest id (of equal ids the smallest key), with all columns."""
    groups = near_groups(df, id_col, text_col, extra=extra)
    best = groups.withColumn("_c", F.coalesce(F.col("component_id").cast("string"), F.lit(""))).groupBy("_c", "component_id").agg(
        F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "_k1", "_k2")).alias("b")
    )
    kept = best.select("b._k1", "b._k2")
    k1, k2 = row_key(id_col, F.col(text_col).cast("string"))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), k1, k2)
    again = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))
    return rows.join(kept, ["_k1", "_k2"], "left_semi").withColumn("_again", again).filter("_again = 1").select("_row.*")
