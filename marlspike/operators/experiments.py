"""The experiment grid: four strategies over all folds and cost multipliers, and the ledger rows of a run."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlspike.functions.scalars import trend_sign
from marlspike.operators import backtest, stats
from marlspike.operators.portfolio import PortfolioParams
from marlspike.operators.signals import MomentumParams, formation_sum
from marlspike.sources.shared import settle

METRICS = ("sharpe", "sortino", "annual_return", "max_drawdown", "calmar")


@dataclass(frozen=True)
class GridConfig:
    """What a run fixes: strategy and portfolio parameters, folds, costs, and the gate between momentum and history."""

    passive: Mapping[str, float]
    momentum: MomentumParams = field(default_factory=MomentumParams)
    portfolio: PortfolioParams = field(default_factory=PortfolioParams)
    split: backtest.SplitConfig = field(default_factory=backtest.SplitConfig)
    multipliers: tuple[float, ...] = (1.0, 1.5, 2.0)
    holdout: date | None = None
    with_capped: bool = True
    gate_mult: float = 1.0
    gate_lag: int = 52
    gate_threshold: float = 1.64

    def __post_init__(self) -> None:
        if self.gate_mult not in self.multipliers:
            raise ValueError("the gate needs a cost multiplier of the grid")


def every_signal(returns: DataFrame, horizon: int) -> DataFrame:
    """Every symbol's weeks with the momentum sign, null while it warms up."""
    rows = formation_sum(returns.filter("excess_log_return is not null"), horizon)
    return rows.withColumn("signal", trend_sign(F.col("formation"))).select("symbol", "week_start", "signal", "realized_vol_26w", "is_capped")


def run_grid(returns: DataFrame, costs: DataFrame, cfg: GridConfig) -> DataFrame:
    """Results of the weeks that all strategies share: ``strategy``, ``fold``, ``cost_mult``, ``return_week``, ``gross``, ``net``, ``turnover``.

    ``returns``: weekly returns with ``is_capped``, none of the holdout; read many times, so settle it before.
    """
    folds = settle(backtest.walk_forward(returns.select("week_start"), cfg.split, cfg.holdout), "folds")
    tests = folds.filter("role = 'test'").select("fold", F.col("week_start").alias("return_week"))
    fixed = {"params": cfg.portfolio, "multipliers": cfg.multipliers, "with_capped": cfg.with_capped}
    momentum = backtest.backtest(every_signal(returns, cfg.momentum.horizon), returns, costs, **fixed)
    each = {
        "momentum": momentum.join(tests, "return_week"),
        "history": backtest.baseline_history(returns, folds, costs, **fixed),
        "hold": backtest.baseline_hold(returns, folds, costs, **fixed),
        "passive": backtest.baseline_passive(returns, folds, costs, cfg.passive, multipliers=cfg.multipliers),
    }
    out: DataFrame | None = None
    for name, df in each.items():
        part = df.select(F.lit(name).alias("strategy"), "fold", "cost_mult", "return_week", "gross", "net", "turnover")
        out = part if out is None else out.unionByName(part)
    return settle(backtest.aligned(settle(out, "weeks"), ["fold", "cost_mult"], len(each)), "grid")


def grid_results(grid: DataFrame, cfg: GridConfig) -> DataFrame:
    """Means over folds by strategy and cost multiplier; the gate's figures on momentum at the gate's multiplier, null elsewhere."""
    by_fold = stats.period_stats(grid, ["strategy", "cost_mult", "fold"])
    rows = by_fold.groupBy("strategy", "cost_mult").agg(F.count(F.lit(1)).alias("n_folds"), *(F.avg(c).alias(f"cv_{c}") for c in METRICS))
    net = lambda name: F.max(F.when(F.col("strategy") == name, F.col("net")))
    pooled = grid.filter(F.col("cost_mult") == cfg.gate_mult).groupBy("fold", "return_week").agg(net("momentum").alias("a"), net("history").alias("b"))
    order = pooled.select(F.struct("fold", "return_week").alias("at"), F.lit("momentum").alias("strategy"), F.lit(cfg.gate_mult).alias("cost_mult"), "a", "b")
    gate = stats.hac_tstat(order, ["strategy", "cost_mult"], "at", "a", "b", cfg.gate_lag)
    gate = gate.select("strategy", "cost_mult", F.col("n").alias("gate_n_obs"), "mean_delta", "t_stat", (F.col("t_stat") > cfg.gate_threshold).alias("gate_pass"))
    return rows.join(gate, ["strategy", "cost_mult"], "left")


def ledger_rows(results: DataFrame, cfg: GridConfig, run_id: str, run_at: datetime, label: str | None = None) -> DataFrame:
    """:func:`grid_results` as rows of the run ledger; what needs a grid of several trials stays null."""
    m = asdict(cfg.momentum)
    params = {
        "momentum": {"strategy": "momentum", **m}, "history": {"strategy": "history", "vol_target": m["vol_target"]},
        "hold": {"strategy": "hold", "vol_target": m["vol_target"]}, "passive": {"strategy": "passive"},
    }
    book = json.dumps(asdict(cfg.portfolio))
    books = {name: json.dumps({"weights": dict(cfg.passive)}) if name == "passive" else book for name in params}
    text = lambda by: F.coalesce(*(F.when(F.col("strategy") == k, F.lit(v if isinstance(v, str) else json.dumps(v))) for k, v in by.items()))
    gated = lambda x: F.when(F.col("gate_n_obs").isNotNull(), F.lit(x))
    none = lambda kind: F.lit(None).cast(kind)
    return results.select(
        F.lit(run_id).alias("run_id"), F.lit(run_at).cast("timestamp").alias("created_at"), F.lit(label).cast("string").alias("label"), "strategy", "cost_mult",
        text(params).alias("params"), text(books).alias("portfolio_params"), "n_folds", *(f"cv_{c}" for c in METRICS),
        none("double").alias("deflated_sharpe"), none("double").alias("pbo"), none("double").alias("hlz_tstat"), F.lit(1).cast("long").alias("n_trials"),
        F.lit(False).alias("holdout_spent"), none("double").alias("holdout_sharpe"), F.lit(False).alias("promoted"),
        F.col("mean_delta").alias("gate_mean_delta"), F.col("t_stat").alias("gate_t_hac"), "gate_pass", "gate_n_obs",
        gated(cfg.gate_lag).cast("long").alias("gate_max_lag"), gated(cfg.gate_threshold).alias("gate_threshold"), gated(cfg.gate_mult).alias("gate_cost_mult"),
    )
