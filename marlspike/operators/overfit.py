"""The probability of backtest overfitting for any number of trials.

Trials are dealt into tiles, and the halves of the blocks (bit masks) into ranges.  Each pair of a tile and a range is one piece
of work: a product of the range's masks with the tile's block sums.  A first pass finds each mask's best trial in sample, the best of
each tile and then of all; a second counts the trials that do better than it out of sample.  Nothing is broadcast, and a piece holds one
tile and one range whatever the number of trials.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.sources.shared import settle

#: Trials of a tile, bits of the masks of a range, masks that are multiplied together.
TILE, RANGE_BITS, TOGETHER = 2048, 16, 256


def _masks(number: int, n_blocks: int) -> np.ndarray:
    """The masks of a range that choose half the blocks."""
    ids = np.arange(number << RANGE_BITS, min((number + 1) << RANGE_BITS, 1 << n_blocks), dtype=np.int64)
    return ids[np.bitwise_count(ids) == n_blocks // 2]


def _means(masks: np.ndarray, n_blocks: int, tile: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Means of a tile's trials in and out of sample (masks by trials), some masks at a time."""
    s, n = (np.array(tile.column(c)[0].as_py(), float).reshape(-1, n_blocks).T for c in ("s", "n"))
    chosen = (masks[:, None] >> np.arange(n_blocks)) & 1
    for a in range(0, len(masks), TOGETHER):
        out = chosen[a : a + TOGETHER].astype(float)
        with np.errstate(invalid="ignore", divide="ignore"):
            yield slice(a, a + TOGETHER), ((1 - out) @ s) / ((1 - out) @ n), (out @ s) / (out @ n)


def pbo_tiled(trials: DataFrame, n_blocks: int = 20, trial: str = "trial", t: str = "t", r: str = "r") -> DataFrame:
    """What :func:`marlspike.operators.stats.pbo` gives: ``n_paths`` and ``pbo``.  Ties in sample go to the first trial."""
    if n_blocks < 4 or n_blocks > 31:
        raise ValueError("n_blocks must lie between 4 and 31")
    n, n_trials = trials.agg(F.count_distinct(t), F.count_distinct(trial)).first()
    size = n // n_blocks
    if n_trials < 2 or size < 2:
        raise ValueError("needs two trials and two rows a block")
    kind = trials.schema[trial].dataType.simpleString()
    i = F.row_number().over(Window.partitionBy(trial).orderBy(t)) - 1
    block = F.least(F.floor(i / size), F.lit(n_blocks - 1))
    sums = trials.select(F.col(trial).alias("trial"), F.col(r).alias("_r"), block.alias("_b"))
    cell = lambda b, c: F.coalesce(F.sum(F.when(F.col("_b") == b, F.lit(1.0) if c == "n" else F.col("_r"))), F.lit(0.0))
    packed = sums.groupBy("trial").agg(F.array(*(cell(b, "s") for b in range(n_blocks))).alias("s"), F.array(*(cell(b, "n") for b in range(n_blocks))).alias("n"))
    tiles = packed.groupBy(F.pmod(F.xxhash64("trial"), F.lit(-(-n_trials // TILE))).alias("tile")).agg(F.sort_array(F.collect_list(F.struct("trial", "s", "n"))).alias("x"))
    tiles = settle(tiles.select("tile", F.col("x.trial").alias("trials"), F.flatten("x.s").alias("s"), F.flatten("x.n").alias("n")), "tiles")
    ranges = F.sequence(F.lit(0), F.lit(max(0, (1 << n_blocks >> RANGE_BITS) - 1)))
    pieces = tiles.select("*", F.explode(ranges).alias("range"))

    def best(piece: pa.Table) -> pa.Table:
        masks = _masks(piece.column("range")[0].as_py(), n_blocks)
        names = piece.column("trials").combine_chunks().flatten()
        loss, place, outside = np.empty(len(masks)), np.empty(len(masks), np.int64), np.empty(len(masks))
        for at, inside, out in _means(masks, n_blocks, piece):
            k = np.nanargmax(inside, axis=1)  # the first of equal ones: trials are sorted
            row = np.arange(len(k))
            loss[at], place[at], outside[at] = -inside[row, k], k, out[row, k]
        return pa.table({"mask": masks, "loss": loss, "trial": names.take(pa.array(place)), "outside": outside})

    each = pieces.groupBy("tile", "range").applyInArrow(best, f"mask long, loss double, trial {kind}, outside double")
    won = each.groupBy("mask").agg(F.min(F.struct("loss", "trial", "outside")).alias("b")).select("mask", F.shiftright("mask", RANGE_BITS).cast("int").alias("range"), F.col("b.outside").alias("outside"))
    bars = settle(won.groupBy("range").agg(F.sort_array(F.collect_list(F.struct("mask", "outside"))).alias("x")), "best")
    every = F.sequence(F.lit(0).cast("long"), F.lit(-(-n_trials // TILE) - 1).cast("long"))
    bars = bars.select("range", F.explode(every).alias("tile"), F.col("x.mask").alias("masks"), F.col("x.outside").alias("outside"))

    def above(piece: pa.Table, bar: pa.Table) -> pa.Table:
        if not len(piece) or not len(bar):
            return pa.table({"mask": pa.array([], pa.int64()), "above": pa.array([], pa.int64())})
        masks, level = (np.array(bar.column(c)[0].as_py()) for c in ("masks", "outside"))
        count = np.empty(len(masks), np.int64)
        for at, _, out in _means(masks, n_blocks, piece):
            count[at] = (out > level[at, None]).sum(axis=1)
        return pa.table({"mask": masks, "above": count})

    counted = pieces.groupBy("tile", "range").cogroup(bars.groupBy("tile", "range")).applyInArrow(above, "mask long, above long")
    ranks = counted.groupBy("mask").agg((F.sum("above") + 1).alias("rank"))
    return ranks.agg(F.count(F.lit(1)).alias("n_paths"), F.avg((F.col("rank") / n_trials > 0.5).cast("double")).alias("pbo"))
