"""Sharding of whole groups by longest-processing-time scheduling (operator 2).

Groups (equal texts, or any key) stay together.  The law is ``bytes``: sizes near equal.
Groups that weigh more than a set share of a shard are scheduled by themselves; there can be
only ``shards * SHARE`` of those, however large the corpus.  The others are bundled by their
key into a fixed number of bundles, which are groups too.  Both lists, of bounded length, are
sorted by size and dealt through a heap to the least-loaded shard; the resulting tables are
small enough to broadcast, so rows move only to be numbered.

Slots are numbered in two steps (a row's place in its part of the shard, plus the parts
before), since a shard may hold more rows than one task should sort.

Cases: a null text weighs 16 like an empty one and goes with it; a group larger than a fair
shard fills a shard of its own; ties in size go by key; repeated rows are numbered apart; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import materialise

#: A group is scheduled alone from 1/SHARE of an even shard; the others go to SHARE bundles a shard.
SHARE = 256
OVERHEAD = 16


def schedule(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest processing time first: each item, largest first, to the least-loaded shard (ties: lowest number)."""
    heap = [(0, s) for s in range(shards)]
    out: dict[str, int] = {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def _bundle(key: Column, count: int) -> Column:
    """Number of the bundle of a hexadecimal group key."""
    return F.pmod(F.conv(F.substring(key, 1, 12), 16, 10).cast("long"), F.lit(count))


def assign(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (with ``group``, hexadecimal, and ``size``) and their ``shard``."""
    spark = rows.sparkSession
    groups = materialise(rows.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // (shards * SHARE)))
    bundles = shards * SHARE
    # At most shards * SHARE groups can weigh total / (shards * SHARE) each: both lists are bounded.
    large = [(r["size"], "g" + r["group"]) for r in groups.filter(F.col("size") >= least).collect()]
    small = groups.filter(F.col("size") < least).groupBy(_bundle(F.col("group"), bundles).alias("bundle")).agg(F.sum("size").alias("size"))
    small = [(r["size"], f"b{r['bundle']}") for r in small.collect()]
    shard_of = schedule(large + small, shards)
    own = spark.createDataFrame([(k[1:], s) for k, s in shard_of.items() if k[0] == "g"], "group string, own int")
    part = spark.createDataFrame([(int(k[1:]), s) for k, s in shard_of.items() if k[0] == "b"], "bundle long, part int")
    out = rows.join(F.broadcast(own), "group", "left").withColumn("bundle", _bundle(F.col("group"), bundles))
    return out.join(F.broadcast(part), "bundle", "left").withColumn("shard", F.coalesce("own", "part")).drop("own", "part", "bundle")


def number(rows: DataFrame, by: str, order: list[Column], spread: Column) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2 and so on within each value of ``by``.

    Each value of ``by`` is dealt by ``spread`` to about as many parts as a part has rows.
    """
    counts = rows.groupBy(by).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("_parts"))
    dealt = rows.join(F.broadcast(counts), by).withColumn("_part", F.pmod(spread, F.col("_parts")))
    dealt = materialise(dealt.drop("_parts"), "dealt")
    held = dealt.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select(by, "_part", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order)) - 1
    placed = dealt.withColumn("_place", place)
    return placed.join(first, [by, "_part"]).withColumn("slot", F.col("_first") + F.col("_place")).drop("_part", "_first", "_place")


def shard_documents(df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (null under this law)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    raw = text.cast("binary")
    rows = df.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.sha2(raw, 256).alias("group"),
    )
    rows = materialise(rows, "rows")
    out = number(assign(rows, shards), "shard", [F.col("_id"), F.col("group")], F.xxhash64("_id", "group"))
    return out.select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("group").alias("text_sha256"),
    )
