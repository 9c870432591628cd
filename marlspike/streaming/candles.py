"""Streaming counterparts: candles from late and replayed ticks, and RSI state kept by key in event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, date, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def stream_candles(
    ticks: DataFrame, unit: str = "1 day", late: str = "3 days", key: str = "event_type", t: str = "ts", price: str = "value", event_id: str = "event_id", once: bool = False
) -> DataFrame:
    """Bars of a tick stream; ticks more than ``late`` behind are dropped by the watermark.

    ``once`` drops a tick that comes again (by ``event_id``) within ``late``, so that a replayed source counts no volume twice.
    Spark chains such a step with an aggregate in append mode only, where a bar comes out when the watermark has passed it.
    """
    rows = ticks.filter(F.col(price).isNotNull()).withWatermark(t, late)
    rows = rows.dropDuplicatesWithinWatermark([event_id]) if once else rows
    at = F.struct(t, event_id)
    bars = rows.groupBy(F.window(t, unit), F.col(key).alias("symbol"))
    return bars.agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.count(F.lit(1)).alias("volume")
    ).select("symbol", F.col("window.start").alias("period"), "open", "high", "low", "close", "volume")


def upsert_sink(upsert: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each batch; replays change nothing as the merge is by key."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch)

    return write


class RsiProcessor(StatefulProcessor):
    """Wilder RSI of each key's closes in order of arrival; the state is the last close and both averages."""

    def __init__(self, period: int = 14) -> None:
        self.period = period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("rsi", "close double, gain double, loss double, seen long")

    def advance(self, symbol: str, bars: list[tuple[date, float]]) -> pd.DataFrame:
        """RSI of ``bars`` (date and close, in order), which follow those before."""
        close, gain, loss, seen = self.state.get() if self.state.exists() else (None, 0.0, 0.0, 0)
        n, out = self.period, []
        for d, x in bars:
            step = 0.0 if close is None else x - close
            gain = (gain * (n - 1) + max(step, 0.0)) / n
            loss = (loss * (n - 1) + max(-step, 0.0)) / n
            value = None if seen < n else 0.0 if gain == loss == 0 else 100.0 if loss == 0 else 100 * (1 - 1 / (1 + gain / loss))
            out.append((symbol, d, x, value))
            close, seen = x, seen + 1
        self.state.update((close, gain, loss, seen))
        return pd.DataFrame(out, columns=["symbol", "d", "close", "rsi"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars = pd.concat(list(rows)).sort_values("d")
        yield self.advance(key[0], list(zip(bars["d"], bars["close"])))

    def close(self) -> None:
        pass


def _millis(d: date) -> int:
    return int(datetime(d.year, d.month, d.day, tzinfo=UTC).timestamp() * 1000)


class OrderedRsiProcessor(RsiProcessor):
    """The same in order of the bars' days: bars wait until the watermark has passed them.

    A bar that comes again while it waits replaces the one before; one of a day that has been let go, replayed or too late, is
    dropped, so that no value is ever computed out of order.  What waits is bounded by the bars of the allowed lateness.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "d date", "close double")
        self.gone = handle.getValueState("gone", "d date")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        gone = self.gone.get()[0] if self.gone.exists() else None
        for part in rows:
            for d, close in zip(part["d"], part["close"]):
                if gone is None or d > gone:
                    self.waiting.updateValue((d,), (close,))
                    self.handle.registerTimer(_millis(d))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted((d, close) for (d,), (close,) in self.waiting.iterator() if _millis(d) <= passed)
        if due:
            for d, _ in due:
                self.waiting.removeKey((d,))
            self.gone.update((due[-1][0],))
            yield self.advance(key[0], due)


def stream_rsi(bars: DataFrame, period: int = 14, late: str = "0 days") -> DataFrame:
    """RSI of a stream of bars (``symbol``, ``d``, ``close``), equal to that of all bars in order.

    Bars may come up to ``late`` after the latest day seen, in any order and more than once; a bar comes out once the watermark has passed its day.
    """
    timed = bars.select("symbol", "d", "close", F.timestamp_seconds(F.unix_date("d") * 86_400).alias("t")).withWatermark("t", late)
    return timed.groupBy("symbol").transformWithStateInPandas(OrderedRsiProcessor(period), "symbol string, d date, close double, rsi double", "append", "EventTime")
