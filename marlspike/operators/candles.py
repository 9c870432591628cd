"""Conforming and resampling of candles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def week_start(d: Column | str) -> Column:
    """Monday of a date's week."""
    return F.trunc(d, "week")


def split_factors(bars: DataFrame, key: Sequence[str] = ("symbol",), day: str = "d", factor: str = "split_factor") -> DataFrame:
    """``bars`` with ``adjust``: the product of all split factors after the bar (nulls and ones count as none)."""
    after = Window.partitionBy(*key).orderBy(F.col(day).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    logs = F.when(F.col(factor) > 0, F.ln(factor))
    own = F.sum(logs).over(Window.partitionBy(*key, day))
    return bars.withColumn("adjust", F.exp(F.coalesce(F.sum(logs).over(after), F.lit(0.0)) - F.coalesce(own, F.lit(0.0))))


def adjust_bars(bars: DataFrame, prices: Sequence[str] = ("open", "high", "low", "close"), volume: str = "volume") -> DataFrame:
    """Prices divided and volume multiplied by the splits still to come."""
    done = split_factors(bars)
    return done.withColumns({p: F.col(p) / F.col("adjust") for p in prices} | {volume: F.col(volume) * F.col("adjust")}).drop("adjust")


def conform_daily(sources: Mapping[int, DataFrame], priority: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """One bar for each symbol and day from several sources: highest priority first (null last), then the lowest source id.

    Every source has ``symbol``, ``d``, the four prices and ``volume``; ``priority`` has ``source_id`` and ``priority``.
    """
    wanted = ["symbol", "d", "open", "high", "low", "close", "volume"]
    # The order of the sources is known before any bar is read: a row a source of ``sources``.
    known = {p["source_id"]: p["priority"] for p in priority.filter(F.col("source_id").isin(list(sources))).select("source_id", "priority").collect()}
    order = sorted(sources, key=lambda i: (known.get(i) is None, -(known.get(i) or 0), i))
    every: DataFrame | None = None
    for source_id, df in sources.items():
        branch = df.select(*wanted, F.lit(source_id).alias("source_id"), F.lit(order.index(source_id)).alias("_rank"))
        branch = branch.filter(F.col("d") >= F.lit(start)) if start else branch
        branch = branch.filter(F.col("d") <= F.lit(end)) if end else branch
        every = branch if every is None else every.unionByName(branch)
    best = Window.partitionBy("symbol", "d").orderBy("_rank")
    one = every.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n", "_rank")
    midnight = F.col("d").cast("timestamp")
    return one.select("*", midnight.alias("period_start"), (midnight + F.expr("interval 86399 seconds")).alias("period_end"))


def resample(bars: DataFrame, key: Sequence[str], period: Column, order: str, name: str = "week_start", more: Mapping[str, Column] | None = None) -> DataFrame:
    """OHLC of each key and period: first open, highest high, lowest low, last close, summed volume."""
    return bars.groupBy(*key, period.alias(name)).agg(
        F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"), *(c.alias(n) for n, c in (more or {}).items()),
    )


def weekly_candles(daily: DataFrame, key: Sequence[str] = ("symbol",), since: date | None = None) -> DataFrame:
    """Weekly bars (Monday to Sunday); with ``since``, of every week from that date's Monday on."""
    days = daily.filter(F.col("d") >= F.trunc(F.lit(since), "week")) if since else daily
    out = resample(days, key, week_start("d"), "d")
    return out.withColumn("week_end", F.date_add("week_start", 6))


def tick_candles(ticks: DataFrame, unit: str, key: Sequence[str], t: str = "ts", price: str = "value") -> DataFrame:
    """Bars of ``unit`` (``hour``, ``day``) from ticks; ties in time go by the tick's ``event_id``."""
    at = F.struct(t, "event_id")
    return ticks.filter(F.col(price).isNotNull()).groupBy(*key, F.date_trunc(unit, t).alias("period")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
