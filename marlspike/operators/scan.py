"""Recursive features as distributed scans.

``x[t] = b * x[t-1] + g[t]`` is solved in blocks of a key's rows (:mod:`marlspike.operators.blocks`): inside a block by a running
sum in closed form, across blocks by a fold over one short array a key.  No row loop and no window over a whole key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.operators.blocks import BLOCK, _headed, _within, fold, last_known, with_block


def affine_scan(
    df: DataFrame, key: Sequence[str], order: str, beta: float, inputs: Mapping[str, Column], initial: Mapping[str, Column] | None = None,
    row: Column | None = None, opening: Mapping[str, str] | None = None,
) -> DataFrame:
    """``df`` with ``_i`` (a row's number in its key) and a column for each of ``inputs`` (output name to ``g``), its first value being ``b * initial + g``.

    ``initial`` is that of a key's first row, 0 by default.  Where ``g`` needs the row before, which a block's first row lacks, it is 0 there in
    ``inputs``; ``opening`` gives it in SQL from ``x.head``, that row's ``row``, and ``a.last``, the ``row`` before it (null at a key's first).
    The length of a block's parts keeps powers of ``beta`` far from overflow.
    """
    if not 0 < beta < 1:
        raise ValueError("beta must lie between 0 and 1")
    initial, opening, row = dict(initial or {}), opening or {}, row if row is not None else F.struct(F.lit(0).alias("none"))
    length = max(1, min(4096, int(500 / -math.log(beta))))
    at = [BLOCK, "_part"]
    along = Window.partitionBy(*key, BLOCK).orderBy(order)
    rows = (df if BLOCK in df.columns else with_block(df, order)).select(
        "*", (F.row_number().over(along) - 1).alias("_j"), row.alias("_row"), *(g.alias(f"_g_{n}") for n, g in inputs.items()),
        *(initial.get(n, F.lit(0.0)).cast("double").alias(f"_c_{n}") for n in inputs),
    )
    rows = rows.withColumn("_part", F.floor(F.col("_j") / length)).withColumn("_p", F.col("_j") % length)
    inside = Window.partitionBy(*key, *at).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    power = F.pow(F.lit(beta), F.col("_p"))
    rows = rows.select("*", *((power * F.sum(F.pow(F.lit(beta), -F.col("_p")) * F.col(f"_g_{n}")).over(inside)).alias(f"_l_{n}") for n in inputs))
    ends = rows.groupBy(*key, *at).agg(
        F.count(F.lit(1)).alias("n"), F.min_by("_row", "_p").alias("head"), F.max_by("_row", "_p").alias("tail"),
        *(F.max_by(f"_l_{n}", "_p").alias(f"e_{n}") for n in inputs), *(F.min_by(f"_c_{n}", "_p").alias(f"c_{n}") for n in inputs),
    )
    kind = ends.schema["tail"].dataType.simpleString()
    start = {f"k_{n}": f"get(s, 0).c_{n}" for n in inputs} | {"before": "0L", "last": f"cast(null as {kind})"}
    # What a part's rows get from before it, at its first row: they fade by ``beta`` a row.
    into = {n: f"(a.k_{n} * {beta!r}D + {f'if(x._part = 0, {opening[n]}, 0D)' if n in opening else '0D'})" for n in inputs}
    step = {f"k_{n}": f"x.e_{n} + {into[n]} * pow({beta!r}D, x.n - 1)" for n in inputs} | {"before": "a.before + x.n", "last": "x.tail"}
    emit = {f"_k_{n}": into[n] for n in inputs} | {"_before": "a.before"}
    behind = _within(key, ["_p"], at)
    both = _headed(rows, fold(ends, key, start, step, at, emit))
    both = both.select(*rows.columns, "_head", *(F.first(c).over(behind).alias(c) for c in emit)).filter("_head is null")
    done = [(F.col(f"_l_{n}") + F.col(f"_k_{n}") * power).alias(n) for n in inputs]
    return both.select(*df.columns, (F.col("_before") + F.col("_j")).alias("_i"), *done)


def rsi_value(gain: Column, loss: Column) -> Column:
    """RSI from average gain and loss: 0 if both are 0, 100 without losses."""
    return F.when((loss == 0) & (gain == 0), 0.0).when(loss == 0, 100.0).otherwise(100.0 * (1 - 1 / (1 + gain / F.nullif(loss, F.lit(0.0)))))


def wilder_rsi(
    df: DataFrame, period: int, key: Sequence[str] = ("symbol",), order: str = "d", close: str = "close", state: DataFrame | None = None
) -> DataFrame:
    """``df`` with ``avg_gain``, ``avg_loss`` and ``rsi``.

    Without ``state`` the averages start at 0 on a key's first row and ``rsi`` is null on its first
    ``period`` rows.  With ``state`` (key, ``last_close``, ``avg_gain``, ``avg_loss``) the recursion
    resumes and every row has its value; keys without state start anew.
    """
    if period < 2:
        raise ValueError("period must be at least 2")
    rows = df
    if state is not None:
        held = state.select(*key, F.col("last_close").alias("_lc"), F.col("avg_gain").alias("_ag"), F.col("avg_loss").alias("_al"))
        rows = df.join(held, list(key), "left")
    else:
        rows = df.select("*", *(F.lit(None).cast("double").alias(c) for c in ("_lc", "_ag", "_al")))
    rows = with_block(rows, order)
    before = F.lag(F.col(close)).over(Window.partitionBy(*key, BLOCK).orderBy(order))
    rows = rows.withColumn("_step", F.col(close) - F.coalesce(before, F.col("_lc")))
    first = F.row_number().over(Window.partitionBy(*key, BLOCK).orderBy(order)) == 1
    rise = lambda step: F.when(first, 0.0).otherwise(F.coalesce(F.greatest(step, F.lit(0.0)), F.lit(0.0)) / period)
    moved = "x.head.c - coalesce(a.last.c, x.head.lc)"
    opening = {n: f"coalesce(greatest({sign}({moved}), 0D), 0D) / {period}" for n, sign in (("avg_gain", ""), ("avg_loss", "-"))}
    scanned = affine_scan(
        rows, key, order, (period - 1) / period, {"avg_gain": rise(F.col("_step")), "avg_loss": rise(-F.col("_step"))},
        {"avg_gain": F.coalesce("_ag", F.lit(0.0)), "avg_loss": F.coalesce("_al", F.lit(0.0))},
        F.struct(F.col(close).cast("double").alias("c"), F.col("_lc").alias("lc")), opening,
    )
    ready = F.col("_lc").isNotNull() | (F.col("_i") >= period)
    return scanned.select(*df.columns, "avg_gain", "avg_loss", F.when(ready, rsi_value(F.col("avg_gain"), F.col("avg_loss"))).alias("rsi"))


def rsi_state(rsi: DataFrame, key: Sequence[str] = ("symbol",), order: str = "d", close: str = "close") -> DataFrame:
    """The last state of every key, to resume from."""
    last = F.max_by(F.struct(F.col(close).alias("last_close"), "avg_gain", "avg_loss"), order)
    return rsi.groupBy(*key).agg(F.max(order).alias("last_at"), last.alias("s")).select(*key, "last_at", "s.*")


def ema(df: DataFrame, span: int, key: Sequence[str] = ("symbol",), order: str = "d", value: str = "close", out: str = "ema") -> DataFrame:
    """``df`` with the exponential mean of ``value`` (weight ``2 / (span + 1)``, started at the first value), null on a key's first ``span`` rows."""
    alpha = 2 / (span + 1)
    scanned = affine_scan(df, key, order, 1 - alpha, {"_ema": alpha * F.col(value)}, {"_ema": F.col(value)})  # the first mean is the first value
    return scanned.select(*df.columns, F.when(F.col("_i") >= span, F.col("_ema")).alias(out))


def trend_states(df: DataFrame, start: float, end: float, key: Sequence[str] = ("symbol",), order: str = "week_start", rsi: str = "rsi") -> DataFrame:
    """``df`` with ``in_trend``: opened by the previous row's ``rsi <= start``, closed by ``>= end``, false at first."""
    if start >= end:
        raise ValueError("a trend must start below its end")
    # Each row opens, closes or keeps the state of the rows behind it, so the state is the last event before a row.
    event = F.when(F.col(rsi) <= start, True).when(F.col(rsi) >= end, False)
    rows = last_known(df, key, [order], {"_event": event})
    return rows.withColumn("in_trend", F.coalesce("_event", F.lit(False))).drop("_event", BLOCK)
