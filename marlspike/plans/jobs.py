"""The jobs over a catalogue of tables: payloads to bronze tables, bars to candles, features, signals and weights, and experiment runs.

Every job can be replayed: each table is written by key upserts.  The daily jobs process a few days
before their range again (``reprocess_days``), so that what was late for the last run comes in with the next.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlspike.operators import candles, experiments, features, portfolio, quality, scan, signals
from marlspike.sources import landing
from marlspike.sources.shared import settle
from marlspike.sources.tables import Catalog

RSI_STRATEGY, MOMENTUM_STRATEGY = 1, 3
#: Days before a run's range that are processed again.
REPROCESS_DAYS = 3
PRICES = {"price_open": "open", "price_high": "high", "price_low": "low", "price_close": "close", "volume_traded": "volume"}


def land(catalog: Catalog, table: str, raw: DataFrame, run_at: datetime, start: date | None = None, end: date | None = None, reprocess_days: int = REPROCESS_DAYS) -> DataFrame:
    """Payloads of a configured source into its bronze table; what was not landed goes into the quarantine and is returned: rejects of bars, rows without a value of series.

    ``start`` (less ``reprocess_days``) and ``end`` bound the days that are taken; without ``start`` all are.
    """
    cfg = landing.SOURCES[table]
    since = start - timedelta(days=reprocess_days) if start else None
    landed = landing.land(raw, cfg, since, end or start, run_at)
    _store(catalog, table, landed, run_at)
    return landed.missing if isinstance(cfg, landing.SeriesSource) else landed.rejects


def _store(catalog: Catalog, table: str, landed: landing.Landed, run_at: datetime) -> None:
    """Rows to their table, the rest to the quarantine, where each content stays as it first came."""
    catalog.upsert(table, landed.rows)
    catalog.seed("control.quarantine", landing.quarantined(table, landed, run_at))


def land_vintages(catalog: Catalog, raw: DataFrame, source_id: int, run_at: datetime) -> DataFrame:
    """Vintage payloads; the end of a vintage that was open is updated by its key.  Returns rows without a value."""
    landed = landing.vintages(raw, source_id, run_at)
    _store(catalog, "bronze.money_vintages", landed, run_at)
    return landed.missing


def land_interest(catalog: Catalog, rows: DataFrame, term: str | Column, window_start: date | Column, source_id: int, run_at: datetime) -> DataFrame:
    """A request window of weekly interest (or several, whose terms and windows are columns).  Returns weeks without a value."""
    kept, gone = landing.land_interest(rows, term, window_start, source_id, run_at)
    none = rows.sparkSession.createDataFrame([], "payload string")
    _store(catalog, "bronze.interest", landing.Landed(kept, gone, none), run_at)
    return gone


def _bars(rows: DataFrame) -> DataFrame:
    return rows.select("symbol", F.col("candle_date").alias("d"), *(F.col(a).alias(b) for a, b in PRICES.items()))


def bronze_sources(catalog: Catalog, tables: Mapping[int, str], adjusted: frozenset[int] = frozenset()) -> dict[int, DataFrame]:
    """Bars of each source; those in ``adjusted`` carry split factors and are brought onto one basis over their whole history."""
    out = {}
    for source_id, name in tables.items():
        rows = catalog.read(name)
        bars = _bars(rows)
        if source_id in adjusted:
            factors = rows.select("symbol", F.col("candle_date").alias("d"), "split_factor")
            bars = candles.adjust_bars(bars.join(factors, ["symbol", "d"])).drop("split_factor")
        out[source_id] = bars
    return out


def conform(catalog: Catalog, sources: Mapping[int, DataFrame], start: date, end: date, run_at: datetime) -> None:
    """Daily candles of the range, then the weekly candles of every week from the range's first on."""
    priority = catalog.read("control.source_priority").select("source_id", "priority")
    stamp = F.lit(run_at).cast("timestamp")
    daily = candles.conform_daily(sources, priority, start, end)
    catalog.upsert("silver.candles", daily.withColumns({"temporality": F.lit("1d"), "datetime_update": stamp}))
    days = read_daily(catalog, start - timedelta(days=start.weekday()))
    weekly = candles.weekly_candles(days, since=start).withColumns(
        {"temporality": F.lit("1w"), "period_start": F.col("week_start").cast("timestamp"), "period_end": F.col("week_end").cast("timestamp"), "datetime_update": stamp}
    )
    catalog.upsert("silver.candles", weekly, update=["open", "high", "low", "close", "volume", "period_end", "datetime_update"])


def read_daily(catalog: Catalog, start: date | None = None) -> DataFrame:
    rows = catalog.read("silver.candles", start).filter("temporality = '1d'")
    return rows.select("symbol", F.to_date("period_start").alias("d"), "open", "high", "low", "close", "volume")


def read_weekly(catalog: Catalog) -> DataFrame:
    rows = catalog.read("silver.candles").filter("temporality = '1w'")
    return rows.select("symbol", F.to_date("period_start").alias("week_start"), "close")


def refresh_rsi(catalog: Catalog, period: int, start: date, run_at: datetime) -> None:
    """RSI rows from ``start`` on for both temporalities, resumed from the state stored before it (keys without state start anew)."""
    for temporality, rows, order in (("1d", read_daily(catalog).select("symbol", "d", "close"), "d"), ("1w", read_weekly(catalog), "week_start")):
        since = F.lit(start) if order == "d" else F.trunc(F.lit(start), "week")
        stored = catalog.read("silver.rsi").filter((F.col("temporality") == temporality) & (F.col("rsi_period") == period))
        stored = settle(stored.select("symbol", F.to_date("period_start").alias(order), "close", "avg_gain", "avg_loss").filter(F.col(order) < since), "state")
        state = scan.rsi_state(stored, order=order).drop("last_at")
        known = state.select("symbol")
        resumed = scan.wilder_rsi(rows.filter(F.col(order) >= since).join(known, "symbol", "left_semi"), period, order=order, state=state)
        fresh = scan.wilder_rsi(rows.join(known, "symbol", "left_anti"), period, order=order)
        out = resumed.unionByName(fresh).withColumns(
            {
                "temporality": F.lit(temporality), "rsi_period": F.lit(period), "period_start": F.col(order).cast("timestamp"),
                "datetime_update": F.lit(run_at).cast("timestamp"),
            }
        )
        catalog.upsert("silver.rsi", out)


def run_rsi_signals(
    catalog: Catalog, sources: Mapping[int, DataFrame], start: date | None, end: date | None, run_at: datetime, reprocess_days: int = REPROCESS_DAYS
) -> None:
    """Bronze to signals of the RSI strategy for a range of dates (by default the day before the run) and ``reprocess_days`` before it."""
    start, end = landing.run_range(start, end, run_at.date())
    start -= timedelta(days=reprocess_days)
    p = catalog.active("strategy.rsi_params")
    params = signals.RsiParams(p["rsi_period"], p["trend_start"], p["trend_end"], p["oversold"], p["overbought"])
    conform(catalog, sources, start, end, run_at)
    refresh_rsi(catalog, params.rsi_period, start, run_at)
    rsi = catalog.read("silver.rsi").filter(F.col("rsi_period") == params.rsi_period)
    daily = rsi.filter("temporality = '1d'").select("symbol", F.to_date("period_start").alias("d"), "close", "rsi").filter(F.col("d").between(F.lit(start), F.lit(end)))
    weekly = rsi.filter("temporality = '1w'").select("symbol", F.to_date("period_start").alias("week_start"), "rsi")
    out = signals.rsi_signals(daily, weekly, params)
    out = out.withColumns(
        {"temporality": F.lit("1d"), "signal_start": F.col("d").cast("timestamp"), "strategy_id": F.lit(RSI_STRATEGY), "datetime_update": F.lit(run_at).cast("timestamp")}
    )
    catalog.upsert("gold.signals", out)


def in_universe(rows: DataFrame, universe: Collection[str]) -> DataFrame:
    """Rows of the universe's symbols; an empty universe is an error."""
    if not universe:
        raise ValueError("the universe is empty")
    return rows.filter(F.col("symbol").isin(sorted(universe)))


def run_momentum(
    catalog: Catalog, actions: DataFrame | None, rate: DataFrame | None, capped: frozenset[str], run_at: datetime, universe: Collection[str]
) -> None:
    """Weekly candles of the ``universe`` to momentum signals, and from the stored signals to both weight books."""
    p = catalog.active("strategy.momentum_params")
    params = signals.MomentumParams(p["horizon"], p["vol_target"], p["leverage_cap"])
    actions = in_universe(actions, universe) if actions is not None else None
    returns = features.weekly_returns(in_universe(read_weekly(catalog), universe), actions, rate)
    rows = signals.momentum_signals(returns, params)
    stamp = F.lit(run_at).cast("timestamp")
    catalog.upsert(
        "gold.signals",
        rows.select(
            "symbol", F.lit("1w").alias("temporality"), F.col("week_start").cast("timestamp").alias("signal_start"), F.lit(MOMENTUM_STRATEGY).alias("strategy_id"),
            F.col("label").alias("signal"), "trigger_params", stamp.alias("datetime_update"),
        ),
    )
    stored = in_universe(catalog.read("gold.signals").filter(F.col("strategy_id") == MOMENTUM_STRATEGY), universe)
    read = signals.read_trigger(stored.select("symbol", F.to_date("signal_start").alias("week_start"), "trigger_params"))
    book = portfolio.build_weights(read.withColumn("is_capped", F.col("symbol").isin(list(capped))), portfolio.PortfolioParams(p["scheme"], p["cap"]))
    catalog.upsert("gold.weights", book.withColumns({"strategy_id": F.lit(MOMENTUM_STRATEGY), "datetime_update": stamp}))


def run_experiments(
    catalog: Catalog, returns: DataFrame, costs: DataFrame, cfg: experiments.GridConfig, run_id: str, run_at: datetime, label: str | None = None
) -> DataFrame:
    """Runs the grid and adds its rows to the ledger (a run that is there already stays as it is); returns the run's rows."""
    returns = settle(returns, "returns")
    results = experiments.grid_results(experiments.run_grid(returns, costs, cfg), cfg)
    catalog.seed("strategy.experiment_runs", experiments.ledger_rows(results, cfg, run_id, run_at, label))
    return catalog.read("strategy.experiment_runs").filter(F.col("run_id") == run_id)


def run_checks(catalog: Catalog, run_id: str, run_at: datetime, rules: Mapping[str, Mapping[str, str]] = quality.RULES) -> DataFrame:
    """Key, range and gap checks of every table that was ever written, added to the check results; returns the run's.  A run that is there already stays."""
    stamp = F.lit(run_at).cast("timestamp")
    found: DataFrame | None = None
    for name, table in catalog.tables.items():
        if name == "control.check_results" or not catalog.exists(name):
            continue
        part = quality.table_checks(catalog.read(name), table.key, rules.get(name), quality.GAPS.get(name)).select(F.lit(name).alias("table_name"), "*")
        found = part if found is None else found.unionByName(part)
    if found is not None:
        catalog.seed("control.check_results", found.select(F.lit(run_id).alias("run_id"), "*", stamp.alias("datetime_update")))
    return catalog.read("control.check_results").filter(F.col("run_id") == run_id)


def signal_changes(catalog: Catalog) -> DataFrame:
    """Changes of the stored signals, each strategy's by itself."""
    return signals.signal_changes(catalog.read("gold.signals"), ("symbol", "strategy_id"), "signal_start")
