"""Fixed schemas and natural keys of the layers' tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

CANDLE = "symbol string, candle_date date, price_open double, price_high double, price_low double, price_close double, volume_traded double"
ACTIONS = ", split_factor double, div_cash double"
AUDIT = ", source_id bigint, datetime_update timestamp"


@dataclass(frozen=True)
class Table:
    """A table: its schema, natural key and partition column."""

    name: str
    ddl: str
    key: tuple[str, ...]
    partition: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _series(name: str, day: str, value: str, kind: str = "double") -> Table:
    return Table(f"bronze.{name}", f"{day} date, {value} {kind}{AUDIT}", (day,))


TABLES = {
    t.name: t
    for t in (
        Table("control.source_priority", "source_id bigint, source_name string, priority bigint", ("source_id",)),
        Table("control.quarantine", "source string, payload_hash string, reason string, payload string, datetime_update timestamp", ("source", "payload_hash", "reason")),
        Table("control.check_results", "run_id string, table_name string, check_name string, n_rows bigint, n_failing bigint, datetime_update timestamp", ("run_id", "table_name", "check_name")),
        Table("strategy.strategy", "strategy_id bigint, strategy_name string", ("strategy_id",)),
        Table(
            "strategy.rsi_params",
            "param_version bigint, is_active boolean, rsi_period bigint, trend_start double, trend_end double, oversold double, overbought double",
            ("param_version",),
        ),
        Table(
            "strategy.momentum_params",
            "param_version bigint, is_active boolean, horizon bigint, vol_target double, vol_lookback bigint, periods_per_year bigint, leverage_cap double, scheme string, cap double",
            ("param_version",),
        ),
        Table(
            "strategy.experiment_runs",
            "run_id string, created_at timestamp, label string, strategy string, cost_mult double, params string, portfolio_params string, n_folds bigint, "
            "cv_sharpe double, cv_sortino double, cv_annual_return double, cv_max_drawdown double, cv_calmar double, deflated_sharpe double, pbo double, hlz_tstat double, "
            "n_trials bigint, holdout_spent boolean, holdout_sharpe double, promoted boolean, "
            "gate_mean_delta double, gate_t_hac double, gate_pass boolean, gate_n_obs bigint, gate_max_lag bigint, gate_threshold double, gate_cost_mult double",
            ("run_id", "strategy", "cost_mult"),
        ),
        *(Table(f"bronze.{n}", CANDLE + AUDIT, ("symbol", "candle_date"), "candle_date") for n in ("exchange_a", "exchange_b", "chart_etf")),
        Table("bronze.eod_etf", CANDLE + ACTIONS + AUDIT, ("symbol", "candle_date"), "candle_date"),
        _series("valuation_score", "d", "value"),
        Table("bronze.dollar_index", f"d date, price_open double, price_high double, price_low double, price_close double, volume_traded double{AUDIT}", ("d",)),
        *(_series(n, "obs_date", "obs_value") for n in ("rate_10y", "rate_2y", "rate_funds", "volatility_index")),
        *(_series(n, "metric_date", "metric_value", "bigint") for n in ("supply", "active_addresses", "transactions")),
        Table("bronze.money_vintages", f"obs date, rs date, re date, value double{AUDIT}", ("obs", "rs")),
        Table("bronze.interest", f"term string, window_start date, d date, interest bigint{AUDIT}", ("term", "window_start", "d")),
        Table(
            "silver.candles",
            "symbol string, temporality string, period_start timestamp, period_end timestamp, time_open timestamp, time_close timestamp, trades_count bigint, "
            "open double, high double, low double, close double, volume double, source_id bigint, datetime_update timestamp",
            ("symbol", "temporality", "period_start"),
            "period_start",
        ),
        Table(
            "silver.rsi",
            "symbol string, temporality string, rsi_period bigint, period_start timestamp, close double, avg_gain double, avg_loss double, rsi double, datetime_update timestamp",
            ("symbol", "temporality", "rsi_period", "period_start"),
            "period_start",
        ),
        Table(
            "gold.signals",
            "symbol string, temporality string, signal_start timestamp, strategy_id bigint, signal string, trigger_params string, datetime_update timestamp",
            ("symbol", "temporality", "signal_start", "strategy_id"),
            "signal_start",
        ),
        Table(
            "gold.weights",
            "week_start date, strategy_id bigint, symbol string, include_capped boolean, weight double, datetime_update timestamp",
            ("week_start", "strategy_id", "symbol", "include_capped"),
            "week_start",
        ),
    )
}
