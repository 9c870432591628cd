"""Trading signals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.functions.scalars import position, sign_label, trend_sign
from marlspike.operators.asof import asof
from marlspike.operators.scan import trend_states


@dataclass(frozen=True)
class RsiParams:
    """Thresholds of the RSI strategy."""

    rsi_period: int = 14
    trend_start: float = 40.0
    trend_end: float = 70.0
    oversold: float = 30.0
    overbought: float = 70.0


@dataclass(frozen=True)
class MomentumParams:
    """Parameters of the momentum strategy; bad values are refused here."""

    horizon: int = 52
    vol_target: float = 0.10
    leverage_cap: float | None = None
    vol_scaling: bool = True

    def __post_init__(self) -> None:
        if self.horizon < 1:
            raise ValueError("horizon must be at least 1")
        if not self.vol_target > 0:
            raise ValueError("vol_target must be positive")
        if self.leverage_cap is not None and not self.leverage_cap > 0:
            raise ValueError("leverage_cap must be positive")


def rsi_signal(rsi: Column, in_trend: Column, p: RsiParams) -> Column:
    """SELL above overbought; BUY below oversold inside a trend; else NEUTRAL.  Both bounds are exclusive."""
    return F.when(in_trend & (rsi < p.oversold), "BUY").when(rsi > p.overbought, "SELL").otherwise("NEUTRAL")


def rsi_signals(daily_rsi: DataFrame, weekly_rsi: DataFrame, params: RsiParams | None = None) -> DataFrame:
    """Daily signals: the day's RSI against the trend state of its week, or of the latest week before, else no trend."""
    p = params or RsiParams()
    weeks = trend_states(weekly_rsi.filter("rsi is not null"), p.trend_start, p.trend_end).select("symbol", "week_start", "in_trend")
    days = daily_rsi.filter("rsi is not null").withColumn("week", F.trunc("d", "week"))
    rows = asof(days, weeks, "week", "week_start", ["in_trend"], by=["symbol"]).withColumn("in_trend", F.coalesce("in_trend", F.lit(False)))
    fixed = {f"p_{k}": F.lit(v) for k, v in asdict(p).items()}
    trigger = F.to_json(F.struct(F.round("rsi", 4).alias("rsi"), "in_trend", *(v.alias(k) for k, v in fixed.items())), {"ignoreNullFields": "false"})
    return rows.withColumn("signal", rsi_signal(F.col("rsi"), F.col("in_trend"), p)).withColumn("trigger_params", trigger)


def signal_changes(signals: DataFrame, key: Sequence[str] = ("symbol",), order: str = "d", signal: str = "signal") -> DataFrame:
    """Rows whose signal differs from the key's row before; the first row of a key counts as a change."""
    before = F.lag(signal).over(Window.partitionBy(*key).orderBy(order))
    return signals.withColumn("_before", before).filter(~F.col(signal).eqNullSafe(F.col("_before"))).withColumnRenamed("_before", "previous_signal")


def formation_sum(df: DataFrame, horizon: int, value: str = "excess_log_return", key: Sequence[str] = ("symbol",), order: str = "week_start") -> DataFrame:
    """``df`` with ``formation``: the sum of the last ``horizon`` rows, null until there are as many; a value that is not finite is an error."""
    finite = F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    checked = F.when(finite, F.col(value)).otherwise(F.raise_error(F.lit("a return is not finite")).cast("double"))
    frame = Window.partitionBy(*key).orderBy(order).rowsBetween(-(horizon - 1), Window.currentRow)
    rows = df.withColumn("_v", checked)
    return rows.withColumn("formation", F.when(F.count("_v").over(frame) == horizon, F.sum("_v").over(frame))).drop("_v")


def momentum_signals(returns: DataFrame, params: MomentumParams | None = None, eps: float = 0.0) -> DataFrame:
    """Sign and position of trailing excess returns, one row a symbol and week, warm-up weeks dropped."""
    p = params or MomentumParams()
    rows = formation_sum(returns.filter("excess_log_return is not null"), p.horizon)
    rows = rows.withColumn("signal", trend_sign(F.col("formation"), eps)).filter("signal is not null")
    rows = rows.withColumn("position", position(F.col("signal"), F.col("realized_vol_26w"), p.vol_target, p.leverage_cap, p.vol_scaling))
    trigger = F.struct(
        "signal", F.round("formation", 6).alias("formation"), F.round("realized_vol_26w", 6).alias("realized_vol_26w"), F.round("position", 6).alias("position"),
        F.lit(p.horizon).alias("horizon"), F.lit(p.vol_target).alias("vol_target"), F.lit(p.leverage_cap).cast("double").alias("leverage_cap"), F.lit(p.vol_scaling).alias("vol_scaling"),
    )
    return rows.withColumn("label", sign_label(F.col("signal"))).withColumn("trigger_params", F.to_json(trigger, {"ignoreNullFields": "false"}))


def read_trigger(signals: DataFrame) -> DataFrame:
    """``signal`` and ``realized_vol_26w`` from the JSON that :func:`momentum_signals` wrote; rows without a signal are dropped."""
    parsed = F.from_json("trigger_params", "signal int, realized_vol_26w double")
    return signals.withColumn("_p", parsed).filter("_p.signal is not null").withColumns({"signal": F.col("_p.signal"), "realized_vol_26w": F.col("_p.realized_vol_26w")}).drop("_p")
