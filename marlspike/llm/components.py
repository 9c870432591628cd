"""Connected components of a link table by alternating large and small stars, all in DataFrames.

Each round hangs every node under the smallest node it can see; rounds go on until the links
no longer change, which takes about the logarithm of the longest chain.  Every round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.llm.common import materialise, scratch

ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(rest).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node in ``links`` (``a``, ``b``).

    Links may repeat and point either way; self links and links with a null end are dropped.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") != F.col("b")).alias("ok"))
    with scratch(links.sparkSession):
        now = materialise(ordered.filter("ok").select("a", "b").distinct(), "links")
        mark = _mark(now)
        for _ in range(ROUNDS):
            if not mark[0]:
                break
            now = materialise(_small_star(_large_star(now)), "links")
            before, mark = mark, _mark(now)
            if mark == before:
                break
        else:
            raise RuntimeError("the components have not settled")
        return materialise(now.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots", outlive=True)
