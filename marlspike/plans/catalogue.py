"""Registered queries over the given tables, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.operators import asof, backtest, candles, experiments, features, overfit, portfolio, quality, scan, signals, stats
from marlspike.plans.sql import (
    ACTIONS, BARS, DAILY_RSI, INTEREST, MOMENTUM, RETURNS, SERIES, VINTAGES, WEEKLY_RSI, WEEKS, WEIGHTS, query, r, trend_cte,
)
from marlspike.sources import market
from marlspike.sources.landing import CandleSource, SeriesSource, backfill, parse_candles, parse_chart, parse_eod, parse_metric_pages, parse_observations, split_missing
from marlspike.sources.shared import settle
from marlspike.sources.tables import merged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame) -> DataFrame:
    """All doubles to six decimals."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.calendar_series(spark, sf_dir)


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candles.weekly_candles(market.bars(spark, sf_dir))


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = market.bars(spark, sf_dir)
    rate = market.one_series(_series(spark, sf_dir), "funds")
    return features.weekly_returns(candles.weekly_candles(prices), market.actions(prices), rate).withColumn("is_capped", F.col("symbol") == market.CAPPED)


def _books_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns that a backtest reads many times."""
    return settle(_returns(spark, sf_dir), "returns")


OHLC = ", ".join(r(c) for c in ("open", "high", "low", "close", "volume"))


@registered(query(f"SELECT symbol, d, {OHLC} FROM bars", BARS))
def daily_candles(spark, sf_dir):
    return rounded(market.bars(spark, sf_dir))


@registered(query(f"SELECT symbol, week_start, {OHLC}, week_start + 6 AS week_end FROM weeks", BARS, WEEKS))
def weekly_candles(spark, sf_dir):
    return rounded(_weeks(spark, sf_dir))


def _ticks(unit: str) -> str:
    return f"""SELECT event_type, date_trunc('{unit}', ts) AS period, {r('arg_min(value, (ts, event_id))', 'open')}, {r('max(value)', 'high')},
        {r('min(value)', 'low')}, {r('arg_max(value, (ts, event_id))', 'close')}, count(*) AS volume FROM events WHERE value IS NOT NULL GROUP BY ALL"""


@registered(_ticks("hour"))
def tick_candles_hourly(spark, sf_dir):
    return rounded(candles.tick_candles(market.table(spark, sf_dir, "events"), "hour", ["event_type"]))


@registered(_ticks("day"))
def tick_candles_daily(spark, sf_dir):
    return rounded(candles.tick_candles(market.table(spark, sf_dir, "events"), "day", ["event_type"]))


@registered(query(f"SELECT symbol, d, split_factor, {r('adjust')} FROM factors", BARS, ACTIONS))
def split_adjustment(spark, sf_dir):
    return rounded(candles.split_factors(market.actions(market.bars(spark, sf_dir))).select("symbol", "d", "split_factor", "adjust"))


@registered(
    query(
        f"""SELECT symbol, d, {OHLC}, source_id, period_start, period_start + INTERVAL 86399 SECOND AS period_end FROM (
            SELECT symbol, d, open, high, low, close, volume, CASE WHEN day(d) % 7 = 3 THEN 2 ELSE 1 END AS source_id, CAST(d AS TIMESTAMP) AS period_start FROM bars)""",
        BARS,
    )
)
def conform_daily(spark, sf_dir):
    prices = market.bars(spark, sf_dir)
    acts = market.actions(prices).select("symbol", "d", "split_factor")
    factors = candles.split_factors(acts).select("symbol", "d", "adjust")
    raw = prices.join(factors, ["symbol", "d"])
    raw = raw.withColumns({c: F.col(c) * F.col("adjust") for c in ("open", "high", "low", "close")} | {"volume": F.col("volume") / F.col("adjust")}).drop("adjust")
    a = prices.filter(F.dayofmonth("d") % 7 != 3)
    b = candles.adjust_bars(raw.join(acts, ["symbol", "d"]))
    priority = spark.createDataFrame([(1, 2), (2, 1)], "source_id int, priority int")
    out = candles.conform_daily({1: a, 2: b}, priority)
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("period_start", "period_end")}))


RSI_COLS = f"close_, i, {r('avg_gain')}, {r('avg_loss')}, {r('rsi')}"


@registered(query(f"SELECT symbol, d, {r('close')}, {r('avg_gain')}, {r('avg_loss')}, {r('rsi')} FROM daily_rsi", BARS, DAILY_RSI))
def rsi_daily(spark, sf_dir):
    return rounded(scan.wilder_rsi(market.bars(spark, sf_dir).select("symbol", "d", "close"), 14))


@registered(query(f"SELECT symbol, week_start, {r('close')}, {r('avg_gain')}, {r('avg_loss')}, {r('rsi')} FROM weekly_rsi", BARS, WEEKS, WEEKLY_RSI))
def rsi_weekly(spark, sf_dir):
    return rounded(scan.wilder_rsi(_weeks(spark, sf_dir).select("symbol", "week_start", "close"), 14, order="week_start"))


@registered(
    query(f"SELECT symbol, d, {r('close')}, {r('avg_gain')}, {r('avg_loss')}, {r('rsi')} FROM daily_rsi WHERE d >= DATE '1999-01-01'", BARS, DAILY_RSI)
)
def rsi_incremental(spark, sf_dir):
    """Resumed from the state at the end of 1998."""
    prices = market.bars(spark, sf_dir).select("symbol", "d", "close")
    cut = F.lit(date(1999, 1, 1))
    state = scan.rsi_state(scan.wilder_rsi(prices.filter(F.col("d") < cut), 14))
    return rounded(scan.wilder_rsi(prices.filter(F.col("d") >= cut), 14, state=state))


@registered(query(f"SELECT symbol, week_start, {r('rsi')}, in_trend FROM tr", BARS, WEEKS, WEEKLY_RSI, trend_cte()))
def trend_states(spark, sf_dir):
    weekly = scan.wilder_rsi(_weeks(spark, sf_dir).select("symbol", "week_start", "close"), 14, order="week_start")
    return rounded(scan.trend_states(weekly.filter("rsi is not null"), 40, 70).select("symbol", "week_start", "rsi", "in_trend"))


SIGNALS = """
sg AS (SELECT d.symbol, d.d, d.rsi, coalesce(t.in_trend, FALSE) AS in_trend
       FROM (SELECT *, CAST(date_trunc('week', d) AS DATE) AS wk FROM daily_rsi WHERE rsi IS NOT NULL) d
       ASOF LEFT JOIN tr t ON d.symbol = t.symbol AND d.wk >= t.week_start),
signals AS (SELECT *, CASE WHEN in_trend AND rsi < 30 THEN 'BUY' WHEN rsi > 70 THEN 'SELL' ELSE 'NEUTRAL' END AS signal FROM sg)"""


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = settle(market.bars(spark, sf_dir), "bars")
    daily = scan.wilder_rsi(prices.select("symbol", "d", "close"), 14)
    weekly = scan.wilder_rsi(candles.weekly_candles(prices).select("symbol", "week_start", "close"), 14, order="week_start")
    return signals.rsi_signals(settle(daily, "daily_rsi"), settle(weekly, "weekly_rsi"))


@registered(query(f"SELECT symbol, d, {r('rsi')}, in_trend, signal FROM signals", BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, trend_cte(), SIGNALS))
def rsi_signals(spark, sf_dir):
    return rounded(_signals(spark, sf_dir).select("symbol", "d", "rsi", "in_trend", "signal"))


@registered(
    query(
        """SELECT symbol, d, signal, previous_signal FROM (SELECT symbol, d, signal, lag(signal) OVER (PARTITION BY symbol ORDER BY d) AS previous_signal FROM signals)
        WHERE signal IS DISTINCT FROM previous_signal""",
        BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, trend_cte(), SIGNALS,
    )
)
def signal_changes(spark, sf_dir):
    return signals.signal_changes(_signals(spark, sf_dir)).select("symbol", "d", "signal", "previous_signal")


EMA = """
en AS (SELECT symbol, d, close, row_number() OVER (PARTITION BY symbol ORDER BY d) - 1 AS i FROM bars),
er AS (SELECT symbol, i, close AS e FROM en WHERE i = 0
       UNION ALL SELECT n.symbol, n.i, n.close * (2e0 / 101) + r.e * (1 - 2e0 / 101) FROM er r JOIN en n ON n.symbol = r.symbol AND n.i = r.i + 1)"""


@registered(
    query(f"SELECT en.symbol, en.d, {r('CASE WHEN en.i >= 100 THEN er.e END', 'ema')} FROM en JOIN er ON en.symbol = er.symbol AND en.i = er.i", BARS, EMA)
)
def ema_100(spark, sf_dir):
    return rounded(scan.ema(market.bars(spark, sf_dir), 100).select("symbol", "d", "ema"))


@registered(
    query(
        f"""SELECT symbol, d, {r('lr', 'log_return')},
            {r('CASE WHEN i > 30 THEN stddev_samp(lr) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(365e0) END', 'realized_vol_30d')}
            FROM (SELECT symbol, d, ln(close / lag(close) OVER w) AS lr, row_number() OVER w AS i FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY d))""",
        BARS,
    )
)
def volatility_daily(spark, sf_dir):
    w = Window.partitionBy("symbol").orderBy("d")
    rows = market.bars(spark, sf_dir).withColumn("log_return", features.log_ratio(F.col("close"), F.lag("close").over(w)))
    return rounded(features.realized_vol(rows, "log_return", 30, 365, out="realized_vol_30d").select("symbol", "d", "log_return", "realized_vol_30d"))


RETURN_COLS = [
    "div_adj", "price_simple_return", "price_log_return", "simple_return", "log_return", "annual_pct", "rf_week", "excess_return", "excess_log_return", "realized_vol_26w",
]


@registered(query("SELECT symbol, week_start, " + ", ".join(r(c) for c in ["close", *RETURN_COLS]) + " FROM returns", BARS, WEEKS, ACTIONS, SERIES, RETURNS))
def weekly_returns(spark, sf_dir):
    return rounded(_returns(spark, sf_dir).select("symbol", "week_start", "close", *RETURN_COLS))


@registered(query(f"SELECT b.symbol, b.d, {r('s.vix', 'vix')}, {r('s.ten', 'ten')} FROM bars b ASOF LEFT JOIN series s ON b.d >= s.d", BARS, SERIES))
def asof_backward(spark, sf_dir):
    s = _series(spark, sf_dir)
    sides = {f"_{n}": (market.one_series(s, n).withColumnRenamed("value", n), "d", [n]) for n in ("vix", "ten")}
    return rounded(asof.asof_many(market.bars(spark, sf_dir).select("symbol", "d"), sides, "d"))


@registered(
    query(
        f"""SELECT b.symbol, b.d, {r('w.close', 'week_close')} FROM (SELECT *, CAST(date_trunc('week', d) AS DATE) AS wk FROM bars) b
        ASOF LEFT JOIN weeks w ON b.symbol = w.symbol AND b.wk > w.week_start""",
        BARS, WEEKS,
    )
)
def asof_strict(spark, sf_dir):
    """The close of the week before the day's week."""
    days = market.bars(spark, sf_dir).select("symbol", "d", F.trunc("d", "week").alias("wk"))
    weeks = _weeks(spark, sf_dir).select("symbol", "week_start", F.col("close").alias("week_close"))
    return rounded(asof.asof(days, weeks, "wk", "week_start", ["week_close"], by=["symbol"], strict=True).drop("wk"))


@registered(
    query(
        f"SELECT b.symbol, b.d, {r('w.close', 'week_close')} FROM bars b ASOF LEFT JOIN (SELECT *, week_start + 6 AS known FROM weeks) w ON b.symbol = w.symbol AND b.d > w.known",
        BARS, WEEKS,
    )
)
def asof_lagged(spark, sf_dir):
    """A week's close becomes known after its Sunday."""
    weeks = _weeks(spark, sf_dir).select("symbol", "week_start", F.col("close").alias("week_close"))
    days = market.bars(spark, sf_dir).select("symbol", "d")
    return rounded(asof.asof(days, weeks, "d", "week_start", ["week_close"], by=["symbol"], strict=True, lag_days=6))


def _vintage(name: str, days: int) -> str:
    return f"""{name} AS (SELECT b.d, arg_max(v.value, (v.obs, v.rs)) AS {name} FROM (SELECT DISTINCT d FROM bars) b JOIN vintages v
        ON v.rs <= b.d AND v.re >= b.d AND v.obs <= b.d - {days} GROUP BY b.d)"""


VINTAGE_VIEWS = ",".join(_vintage(n, k) for n, k in (("m", 0), ("m52", 364), ("m13", 91)))


@registered(
    query(
        f"SELECT b.d, {r('m')}, {r('m52')}, {r('m13')} FROM (SELECT DISTINCT d FROM bars) b LEFT JOIN m USING (d) LEFT JOIN m52 USING (d) LEFT JOIN m13 USING (d)",
        BARS, VINTAGES, VINTAGE_VIEWS,
    )
)
def vintage_asof(spark, sf_dir):
    days = market.bars(spark, sf_dir).select("d").distinct()
    return rounded(asof.vintage_asof(days, market.vintages(spark, sf_dir), "d", "obs", "rs", "re", "value", {"m": 0, "m52": 364, "m13": 91}))


SCORE = "score AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(l_tax) * 10 AS value FROM lineitem GROUP BY 1)"


@registered(query(f"SELECT b.symbol, b.d, {r('s.value', 'score')} FROM bars b JOIN score s ON s.d = b.d + 1", BARS, SCORE))
def offset_join(spark, sf_dir):
    score = market.score_series(spark, sf_dir).select(F.col("d").alias("_sd"), F.col("value").alias("score"))
    return rounded(asof.offset_join(market.bars(spark, sf_dir).select("symbol", "d"), score, "d", "_sd", 1, ["score"]))


STITCH = """
sw AS (SELECT term, window_start, dense_rank() OVER (PARTITION BY term ORDER BY window_start) AS wi FROM (SELECT DISTINCT term, window_start FROM interest)),
sp AS (SELECT c.term, c.window_start, sum(p.interest) / nullif(sum(c.interest), 0) AS factor FROM interest c JOIN sw wc USING (term, window_start)
       JOIN sw wp ON wp.term = c.term AND wp.wi = wc.wi - 1 JOIN interest p ON p.term = c.term AND p.window_start = wp.window_start AND p.d = c.d GROUP BY ALL),
sc AS (SELECT w.term, w.window_start, exp(sum(ln(coalesce(sp.factor, 1e0))) OVER (PARTITION BY w.term ORDER BY w.wi)) AS scale FROM sw w LEFT JOIN sp USING (term, window_start)),
sv AS (SELECT i.term, i.d, i.interest * sc.scale AS v FROM interest i JOIN sc USING (term, window_start)
       QUALIFY row_number() OVER (PARTITION BY i.term, i.d ORDER BY i.window_start) = 1),
stitched AS (SELECT term, d, 100 * v / max(v) OVER (PARTITION BY term) AS interest FROM sv)"""


@registered(query(f"SELECT term, d, {r('interest')} FROM stitched", INTEREST, STITCH))
def interest_stitched(spark, sf_dir):
    return rounded(features.stitch_windows(market.interest(spark, sf_dir)))


@registered(
    query(
        f"SELECT symbol, week_start, {r('formation')}, signal, {r('realized_vol_26w')}, {r('position')}, CASE signal WHEN 1 THEN 'BUY' WHEN -1 THEN 'SELL' ELSE 'NEUTRAL' END AS label FROM momentum",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM,
    )
)
def momentum_signals(spark, sf_dir):
    out = signals.momentum_signals(_returns(spark, sf_dir))
    return rounded(out.select("symbol", "week_start", "formation", "signal", "realized_vol_26w", "position", "label"))


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = signals.momentum_signals(_returns(spark, sf_dir))
    return portfolio.build_weights(rows.select("symbol", "week_start", "signal", "realized_vol_26w", "is_capped"))


@registered(
    query(f"SELECT symbol, week_start, include_capped, {r('weight')} FROM weights", BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS)
)
def portfolio_weights(spark, sf_dir):
    return rounded(_weights(spark, sf_dir).select("symbol", "week_start", "include_capped", "weight"))


@registered(
    query(
        f"SELECT week_start, include_capped, count(*) AS legs, {r('sum(abs(weight))', 'gross')}, {r('sum(weight)', 'net')} FROM weights GROUP BY ALL",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS,
    )
)
def gross_leverage(spark, sf_dir):
    a = _weights(spark, sf_dir).groupBy("week_start", "include_capped")
    return rounded(a.agg(F.count(F.lit(1)).alias("legs"), F.sum(F.abs("weight")).alias("gross"), F.sum("weight").alias("net")))


COSTS = "costs AS (SELECT * FROM (VALUES ('1-URGENT', 80e0), ('2-HIGH', 5e0), ('3-MEDIUM', 4e0), ('4-NOT SPECIFIED', 12e0), ('5-LOW', 8e0)) c(symbol, bps))"

BACKTEST = """
steps AS (SELECT week_start, lead(week_start) OVER (ORDER BY week_start) AS return_week FROM (SELECT DISTINCT week_start FROM returns WHERE excess_log_return IS NOT NULL)),
held AS (SELECT s.return_week, w.symbol, w.weight FROM weights w JOIN steps s USING (week_start) WHERE w.include_capped AND s.return_week IS NOT NULL),
prior AS (SELECT h.symbol, h.weight, s.return_week FROM held h JOIN steps s ON s.week_start = h.return_week WHERE s.return_week IN (SELECT return_week FROM held)),
moves AS (SELECT return_week, symbol, coalesce(h.weight, 0) AS w1, coalesce(p.weight, 0) AS w0 FROM held h FULL JOIN prior p USING (return_week, symbol)),
bt AS (SELECT m.return_week, sum(m.w1 * coalesce(x.excess_return, 0)) AS gross, sum(abs(m.w1 - m.w0)) AS turnover, sum(-abs(m.w1 - m.w0) * c.bps / 10000) AS cost
       FROM moves m JOIN costs c USING (symbol) LEFT JOIN returns x ON x.symbol = m.symbol AND x.week_start = m.return_week GROUP BY 1)"""


def _costs(spark: SparkSession) -> DataFrame:
    return backtest.cost_grid(market.CLASSES, market.BPS, spark)


@registered(
    query(
        f"SELECT return_week, k.cost_mult, {r('gross')}, {r('gross + cost * k.cost_mult', 'net')}, {r('turnover')} FROM bt, (VALUES (1e0), (1.5e0), (2e0)) k(cost_mult)",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS, COSTS, BACKTEST,
    )
)
def momentum_backtest(spark, sf_dir):
    rows = _books_input(spark, sf_dir)
    return rounded(backtest.backtest(experiments.every_signal(rows, 52), rows, _costs(spark), multipliers=(1.0, 1.5, 2.0)))


FOLDS = """
fw AS (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT week_start FROM returns)),
fk AS (SELECT k AS fold, 104 + k * ((n - 104) // 5) AS s, CASE WHEN k < 4 THEN 104 + (k + 1) * ((n - 104) // 5) ELSE n END AS e FROM (SELECT any_value(n) AS n FROM fw), (SELECT CAST(unnest(generate_series(0, 4)) AS INTEGER) AS k)),
folds AS (SELECT fold, 'train' AS role, week_start FROM fk, fw WHERE i < s - 3 UNION ALL SELECT fold, 'test', week_start FROM fk, fw WHERE i >= s + 2 AND i < e)"""


def _folds(returns: DataFrame) -> DataFrame:
    return backtest.walk_forward(returns.select("week_start"))


@registered(query("SELECT fold, role, week_start FROM folds", BARS, WEEKS, ACTIONS, SERIES, RETURNS, FOLDS))
def walk_forward(spark, sf_dir):
    return _folds(_returns(spark, sf_dir))


def _fixed(signs: str) -> str:
    return f"""
{signs},
fx AS (SELECT t.fold, t.week_start AS return_week, s.symbol, g.signal, s.realized_vol_26w AS v, s.symbol = '1-URGENT' AS is_capped
       FROM folds t JOIN returns s ON s.week_start = t.week_start - 7 JOIN signs g ON g.fold = t.fold AND g.symbol = s.symbol
       WHERE t.role = 'test' AND g.signal <> 0 AND s.realized_vol_26w > 0),
fy AS (SELECT *, signal / v / sum(1 / v) OVER (PARTITION BY fold, return_week) AS w FROM fx),
fz AS (SELECT *, sum(CASE WHEN is_capped THEN greatest(abs(w) - 0.2e0, 0) ELSE 0e0 END) OVER (PARTITION BY fold, return_week) AS freed,
              sum(CASE WHEN is_capped THEN 0e0 ELSE abs(w) END) OVER (PARTITION BY fold, return_week) AS other FROM fy),
held AS (SELECT fold, return_week, symbol, CASE WHEN is_capped THEN sign(w) * least(abs(w), 0.2e0) WHEN other > 0 THEN w * (1 + freed / other) ELSE w END AS weight FROM fz),
steps AS (SELECT fold, week_start AS a, lead(week_start) OVER (PARTITION BY fold ORDER BY week_start) AS b FROM folds WHERE role = 'test'),
prior AS (SELECT h.fold, s.b AS return_week, h.symbol, h.weight FROM held h JOIN steps s ON s.fold = h.fold AND s.a = h.return_week
          WHERE (s.fold, s.b) IN (SELECT fold, return_week FROM held)),
moves AS (SELECT fold, return_week, symbol, coalesce(h.weight, 0) AS w1, coalesce(p.weight, 0) AS w0 FROM held h FULL JOIN prior p USING (fold, return_week, symbol)),
bt AS (SELECT m.fold, m.return_week, sum(m.w1 * coalesce(x.excess_return, 0)) AS gross, sum(abs(m.w1 - m.w0)) AS turnover, sum(-abs(m.w1 - m.w0) * c.bps / 10000) AS cost
       FROM moves m JOIN costs c USING (symbol) LEFT JOIN returns x ON x.symbol = m.symbol AND x.week_start = m.return_week GROUP BY ALL)"""


FIXED_COLS = f"SELECT fold, return_week, 1e0 AS cost_mult, {r('gross')}, {r('gross + cost', 'net')}, {r('turnover')} FROM bt"
HOLD = _fixed("signs AS (SELECT fold, symbol, 1 AS signal FROM (SELECT DISTINCT fold FROM folds), (SELECT DISTINCT symbol FROM returns))")
HISTORY = _fixed(
    """signs AS (SELECT f.fold, x.symbol, CAST(sign(avg(x.excess_log_return)) AS INTEGER) AS signal FROM folds f JOIN returns x USING (week_start)
       WHERE f.role = 'train' AND x.excess_log_return IS NOT NULL GROUP BY ALL)"""
)


@registered(query(FIXED_COLS, BARS, WEEKS, ACTIONS, SERIES, RETURNS, FOLDS, COSTS, HOLD))
def baseline_hold(spark, sf_dir):
    rows = _books_input(spark, sf_dir)
    return rounded(backtest.baseline_hold(rows, _folds(rows), _costs(spark)))


@registered(query(FIXED_COLS, BARS, WEEKS, ACTIONS, SERIES, RETURNS, FOLDS, COSTS, HISTORY))
def baseline_history(spark, sf_dir):
    rows = _books_input(spark, sf_dir)
    return rounded(backtest.baseline_history(rows, _folds(rows), _costs(spark)))


PASSIVE = {"2-HIGH": 0.6, "3-MEDIUM": 0.4}
DRIFT = """
pn AS (SELECT fold, week_start, row_number() OVER (PARTITION BY fold ORDER BY week_start) - 1 AS i FROM folds WHERE role = 'test'),
pd AS (SELECT p.*, CASE WHEN e.symbol IS NULL THEN 0e0 ELSE 1e0 END AS ae, CASE WHEN b.symbol IS NULL THEN 0e0 ELSE 1e0 END AS ab,
              1 + coalesce(e.simple_return, 0) AS ge, coalesce(e.excess_return, 0) AS xe, 1 + coalesce(b.simple_return, 0) AS gb, coalesce(b.excess_return, 0) AS xb
       FROM pn p LEFT JOIN returns e ON e.symbol = '2-HIGH' AND e.week_start = p.week_start LEFT JOIN returns b ON b.symbol = '3-MEDIUM' AND b.week_start = p.week_start),
p0 AS (SELECT *, CASE WHEN ae + ab > 0 THEN 0.6e0 * ae / (0.6e0 * ae + 0.4e0 * ab) ELSE 0e0 END AS te, CASE WHEN ae + ab > 0 THEN 0.4e0 * ab / (0.6e0 * ae + 0.4e0 * ab) ELSE 0e0 END AS tb FROM pd),
pr AS (SELECT fold, i, week_start, te AS we, tb AS wb, ae + ab > 0 AS held, te + tb AS turnover, (te * 5e0 + tb * 4e0) / -10000 AS cost, te * xe + tb * xb AS gross,
              CASE WHEN ae + ab > 0 THEN 1 ELSE 0 END AS since,
              CASE WHEN ae + ab > 0 THEN te * ge / (te * ge + tb * gb) ELSE 0e0 END AS qe, CASE WHEN ae + ab > 0 THEN tb * gb / (te * ge + tb * gb) ELSE 0e0 END AS qb FROM p0 WHERE i = 0
       UNION ALL
       SELECT fold, i, week_start, we, wb, held, CASE WHEN buys THEN abs(we - oe) + abs(wb - ob) ELSE 0e0 END, CASE WHEN buys THEN (abs(we - oe) * 5e0 + abs(wb - ob) * 4e0) / -10000 ELSE 0e0 END,
              we * xe + wb * xb, since, CASE WHEN held THEN we * ge / (we * ge + wb * gb) ELSE oe END, CASE WHEN held THEN wb * gb / (we * ge + wb * gb) ELSE ob END
       FROM (SELECT d.*, q.qe AS oe, q.qb AS ob, q.since >= 52 AND d.ae + d.ab > 0 AS buys, CASE WHEN q.since >= 52 THEN d.te ELSE q.qe END AS we, CASE WHEN q.since >= 52 THEN d.tb ELSE q.qb END AS wb,
                    CASE WHEN q.since >= 52 THEN d.ae + d.ab > 0 ELSE q.qe + q.qb > 0 END AS held,
                    CASE WHEN q.since >= 52 AND d.ae + d.ab > 0 THEN 1 WHEN q.since >= 52 THEN q.since ELSE q.since + 1 END AS since
             FROM pr q JOIN p0 d ON d.fold = q.fold AND d.i = q.i + 1)),
po AS (SELECT fold, week_start AS return_week, gross, turnover, cost FROM pr WHERE held)"""


@registered(
    query(
        f"SELECT fold, return_week, 1e0 AS cost_mult, {r('gross')}, {r('gross + cost', 'net')}, {r('turnover')} FROM po",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, FOLDS, DRIFT,
    )
)
def baseline_passive(spark, sf_dir):
    rows = _books_input(spark, sf_dir)
    return rounded(backtest.baseline_passive(rows, _folds(rows), _costs(spark), PASSIVE))


STATS = """
eq AS (SELECT *, exp(sum(ln(1 + net)) OVER w) AS equity FROM (SELECT return_week, gross + cost AS net FROM bt) WINDOW w AS (ORDER BY return_week)),
dd AS (SELECT *, equity / greatest(1e0, max(equity) OVER (ORDER BY return_week)) - 1 AS drawdown FROM eq),
st AS (SELECT count(*) AS n, avg(net) AS m, stddev_samp(net) AS sd, stddev_samp(net) FILTER (net < 0) AS dsd, exp(sum(ln(1 + net)) * 52 / count(*)) - 1 AS ar,
              least(min(drawdown), 0) AS mdd, sum(net) FILTER (net > 0) AS gains, -sum(net) FILTER (net < 0) AS losses FROM dd)"""


@registered(
    query(
        f"SELECT n, {r('m / sd * sqrt(52e0)', 'sharpe')}, {r('m / dsd * sqrt(52e0)', 'sortino')}, {r('ar', 'annual_return')}, {r('mdd', 'max_drawdown')}, {r('ar / -mdd', 'calmar')}, {r('gains / losses', 'profit_factor')} FROM st",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS, COSTS, BACKTEST, STATS,
    )
)
def performance(spark, sf_dir):
    rows = _books_input(spark, sf_dir)
    done = backtest.backtest(experiments.every_signal(rows, 52), rows, _costs(spark)).withColumn("_all", F.lit(1))
    return rounded(stats.period_stats(done, ["_all"]).drop("_all"))


LOSS_WEEK = "date'1999-02-01' and date'1999-02-07'"


@registered(
    query(
        f"SELECT n, {r('m / sd * sqrt(52e0)', 'sharpe')}, {r('m / dsd * sqrt(52e0)', 'sortino')}, {r('ar', 'annual_return')}, {r('mdd', 'max_drawdown')}, {r('ar / -mdd', 'calmar')}, {r('gains / losses', 'profit_factor')} FROM st",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS, COSTS, BACKTEST,
        STATS.replace("exp(sum(ln(1 + net)) OVER w) AS equity", "product(1 + net) OVER w AS equity").replace("exp(sum(ln(1 + net)) * 52 / count(*)) - 1", "pow(product(1 + net), 52e0 / count(*)) - 1")
        .replace("gross + cost AS net", f"CASE WHEN return_week BETWEEN {LOSS_WEEK.replace('date', 'DATE ')} THEN -1e0 ELSE gross + cost END AS net"),
    )
)
def performance_total_loss(spark, sf_dir):
    """The same book with everything lost in one week: the equity stays at nothing from there on."""
    rows = _books_input(spark, sf_dir)
    done = backtest.backtest(experiments.every_signal(rows, 52), rows, _costs(spark)).withColumn("_all", F.lit(1))
    done = done.withColumn("net", F.when(F.expr(f"return_week between {LOSS_WEEK}"), -1.0).otherwise(F.col("net")))
    return rounded(stats.period_stats(done, ["_all"]).drop("_all"))


HAC = """
hd AS (SELECT row_number() OVER (ORDER BY a.week_start) AS i, a.excess_return - b.excess_return AS d FROM returns a JOIN returns b USING (week_start)
       WHERE a.symbol = '2-HIGH' AND b.symbol = '3-MEDIUM' AND a.excess_return IS NOT NULL AND b.excess_return IS NOT NULL),
hm AS (SELECT count(*) AS n, avg(d) AS m FROM hd),
hg AS (SELECT y.i - x.i AS lag, sum((x.d - m) * (y.d - m)) / any_value(n) AS g FROM hd x JOIN hd y ON y.i BETWEEN x.i AND x.i + 52, hm GROUP BY 1),
hv AS (SELECT sum(CASE WHEN lag = 0 THEN g ELSE 2 * (1 - lag / 53e0) * g END) AS v FROM hg)"""


@registered(
    query(
        f"SELECT n, {r('m', 'mean_delta')}, {r('CASE WHEN v > 0 THEN m / sqrt(v / n) ELSE 0 END', 't_stat')} FROM hm, hv", BARS, WEEKS, ACTIONS, SERIES, RETURNS, HAC
    )
)
def newey_west(spark, sf_dir):
    rows = _books_input(spark, sf_dir).filter("excess_return is not null")
    a = rows.filter("symbol = '2-HIGH'").select("week_start", F.col("excess_return").alias("a"))
    b = rows.filter("symbol = '3-MEDIUM'").select("week_start", F.col("excess_return").alias("b"))
    return rounded(stats.hac_tstat(a.join(b, "week_start").withColumn("_all", F.lit(1)), ["_all"], "week_start", "a", "b").drop("_all"))


def _pbo(blocks: int) -> str:
    half = (1 << blocks) - 1
    return f"""
tn AS (SELECT symbol, week_start, excess_return AS r, row_number() OVER (PARTITION BY symbol ORDER BY week_start) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n
       FROM returns WHERE excess_return IS NOT NULL AND week_start IN (SELECT week_start FROM returns WHERE excess_return IS NOT NULL GROUP BY 1 HAVING count(*) = 5)),
tb AS (SELECT symbol, least(i // (n // {blocks}), {blocks - 1}) AS b, sum(r) AS s, count(*) AS c FROM tn GROUP BY ALL),
tm AS (SELECT mask FROM (SELECT unnest(generate_series(0, {half})) AS mask) WHERE bit_count(mask) = {blocks // 2}),
tp AS (SELECT mask, symbol, sum(s) FILTER ((mask >> b) & 1 = 0) / sum(c) FILTER ((mask >> b) & 1 = 0) AS inside,
              sum(s) FILTER ((mask >> b) & 1 = 1) / sum(c) FILTER ((mask >> b) & 1 = 1) AS outside FROM tm, tb GROUP BY ALL),
tw AS (SELECT mask, arg_max(symbol, inside) AS best FROM tp GROUP BY 1),
tk AS (SELECT p.mask, count(*) FILTER (p.outside > q.outside) + 1 AS rank FROM tp p JOIN tw USING (mask) JOIN tp q ON q.mask = p.mask AND q.symbol = tw.best GROUP BY 1)"""


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _books_input(spark, sf_dir).filter("excess_return is not null").select("week_start", F.col("symbol").alias("trial"), F.col("excess_return").alias("r"))
    full = rows.groupBy("week_start").agg(F.count(F.lit(1)).alias("n")).filter("n = 5")
    return rows.join(full, "week_start", "left_semi").withColumnRenamed("week_start", "t")


PBO_ROW = f"SELECT count(*) AS n_paths, {r('avg(CASE WHEN rank / 5e0 > 0.5 THEN 1e0 ELSE 0e0 END)', 'pbo')} FROM tk"


@registered(query(PBO_ROW, BARS, WEEKS, ACTIONS, SERIES, RETURNS, _pbo(6)))
def overfit_probability(spark, sf_dir):
    return rounded(stats.pbo(_trials(spark, sf_dir), n_blocks=6))


@registered(query(PBO_ROW, BARS, WEEKS, ACTIONS, SERIES, RETURNS, _pbo(20)))
def overfit_probability_20(spark, sf_dir):
    """All 184,756 halves of 20 blocks."""
    return rounded(stats.pbo(_trials(spark, sf_dir), n_blocks=20))


@registered(query(PBO_ROW, BARS, WEEKS, ACTIONS, SERIES, RETURNS, _pbo(20)))
def overfit_probability_tiled(spark, sf_dir):
    """The same in tiles of trials and ranges of halves, without a broadcast."""
    return rounded(overfit.pbo_tiled(_trials(spark, sf_dir), n_blocks=20))


def _phi(x: str) -> str:
    """The normal distribution as a series, for |x| up to about 6."""
    return f"(0.5 + exp(-{x} * {x} / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 90), lambda j: pow({x}, 2 * j + 1) * sqrt(pi()) / (pow(2e0, j + 1) * gamma(j + 1.5)))))"


DEFLATED = f"""
dt AS (SELECT symbol AS trial, excess_return AS r FROM returns
       WHERE excess_return IS NOT NULL AND week_start IN (SELECT week_start FROM returns WHERE excess_return IS NOT NULL GROUP BY 1 HAVING count(*) = 5)),
da AS (SELECT trial, count(*) AS t, avg(r) AS m, stddev_samp(r) AS s FROM dt GROUP BY 1),
db AS (SELECT trial, any_value(t) AS t, any_value(m / s) AS sr, avg(pow(r - m, 3)) / pow(avg(pow(r - m, 2)), 1.5) AS skew, avg(pow(r - m, 4)) / pow(avg(pow(r - m, 2)), 2) AS kurt
       FROM dt JOIN da USING (trial) GROUP BY 1),
dc AS (SELECT *, count(*) OVER () AS n_trials, stddev_samp(sr) OVER () AS sd FROM db),
dq AS (SELECT 1 - 1e0 / n_trials AS p1, 1 - 1 / (n_trials * exp(1e0)) AS p2 FROM dc LIMIT 1),
dz AS (SELECT 0 AS k, -8e0 AS a1, 8e0 AS b1, -8e0 AS a2, 8e0 AS b2 UNION ALL
       SELECT k + 1, CASE WHEN f1 < p1 THEN m1 ELSE a1 END, CASE WHEN f1 < p1 THEN b1 ELSE m1 END, CASE WHEN f2 < p2 THEN m2 ELSE a2 END, CASE WHEN f2 < p2 THEN b2 ELSE m2 END
       FROM (SELECT *, {_phi('m1')} AS f1, {_phi('m2')} AS f2 FROM (SELECT *, (a1 + b1) / 2 AS m1, (a2 + b2) / 2 AS m2 FROM dz, dq WHERE k < 60))),
de AS (SELECT n_trials, trial, sr, sd * (0.4227843351e0 * (SELECT max_by(a1, k) FROM dz) + 0.5772156649e0 * (SELECT max_by(a2, k) FROM dz)) AS expected_max, t, skew, kurt
       FROM dc ORDER BY sr DESC LIMIT 1),
df AS (SELECT *, (sr - expected_max) / sqrt(greatest(1e-12, 1 - skew * sr + (kurt - 1) / 4 * sr * sr) / (t - 1)) AS z FROM de)"""


@registered(query(f"SELECT n_trials, trial, {r('sr')}, {r('expected_max')}, {r(_phi('z'), 'deflated_sharpe')} FROM df", BARS, WEEKS, ACTIONS, SERIES, RETURNS, DEFLATED))
def deflated_sharpe(spark, sf_dir):
    return rounded(stats.deflated_sharpe(_trials(spark, sf_dir)))


@registered(
    query(
        f"""SELECT symbol, n, {r('sharpe')}, {r('sharpe / sqrt(52e0) * sqrt(n)', 't_stat')}, {r('sharpe', 'haircut_sharpe')}, sharpe / sqrt(52e0) * sqrt(n) > 3 AS significant
        FROM (SELECT symbol, count(*) AS n, avg(excess_return) / stddev_samp(excess_return) * sqrt(52e0) AS sharpe FROM returns WHERE excess_return IS NOT NULL GROUP BY 1)""",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS,
    )
)
def sharpe_haircut(spark, sf_dir):
    rows = _returns(spark, sf_dir).filter("excess_return is not null")
    each = stats.period_stats(rows, ["symbol"], order="week_start", r="excess_return").select("symbol", "n", "sharpe")
    return rounded(stats.hlz(each))


CYCLE_SQL = " ".join(f"WHEN d < DATE '{e}' THEN {i}" for i, e in enumerate(market.EPOCHS))
TRAIN_DAILY = f"""
{trend_cte()},
{INTEREST},
{STITCH},
pv AS (SELECT symbol, d, CASE WHEN i > 30 THEN stddev_samp(lr) OVER (PARTITION BY symbol ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(365e0) END AS realized_vol_30d
       FROM (SELECT symbol, d, ln(close / lag(close) OVER w) AS lr, row_number() OVER w AS i FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY d))),
pn AS (SELECT symbol, d, close, row_number() OVER (PARTITION BY symbol ORDER BY d) - 1 AS i FROM bars),
pe AS (SELECT symbol, i, d, close AS e FROM pn WHERE i = 0
       UNION ALL SELECT n.symbol, n.i, n.d, n.close * (2e0 / 366) + r.e * (1 - 2e0 / 366) FROM pe r JOIN pn n ON n.symbol = r.symbol AND n.i = r.i + 1),
dn AS (SELECT d, dollar, row_number() OVER (ORDER BY d) - 1 AS i FROM series),
de AS (SELECT i, d, dollar, dollar AS e FROM dn WHERE i = 0
       UNION ALL SELECT n.i, n.d, n.dollar, n.dollar * (2e0 / 366) + r.e * (1 - 2e0 / 366) FROM de r JOIN dn n ON n.i = r.i + 1),
dx AS (SELECT de.d, de.dollar, CASE WHEN de.i >= 365 THEN de.e END AS ema FROM de),
sy AS (SELECT d, vix, ten, two, supply, ln(addresses / lag(addresses, 365) OVER (ORDER BY d)) AS ay, ln(transactions / lag(transactions, 365) OVER (ORDER BY d)) AS ty FROM series),
dd AS (SELECT DISTINCT d FROM bars),
d1 AS (SELECT dd.d, dx.dollar, dx.ema FROM dd ASOF LEFT JOIN dx ON dd.d >= dx.d),
d2 AS (SELECT dd.d, sy.* EXCLUDE (d) FROM dd ASOF LEFT JOIN sy ON dd.d >= sy.d),
d3 AS (SELECT dd.d, s.interest FROM dd ASOF LEFT JOIN (SELECT d + 6 AS known, interest FROM stitched WHERE term = '1-URGENT') s ON dd.d > s.known),
wr AS (SELECT symbol, week_start, rsi FROM weekly_rsi WHERE rsi IS NOT NULL),
jd AS (SELECT b.symbol, b.d, b.close, b.rsi, w.rsi AS rsi_weekly FROM (SELECT *, CAST(date_trunc('week', d) AS DATE) AS wk FROM daily_rsi WHERE rsi IS NOT NULL) b
       ASOF LEFT JOIN wr w ON b.symbol = w.symbol AND b.wk > w.week_start),
jx AS (SELECT jd.*, s.value AS score, d1.dollar, d1.ema AS dema, d2.* EXCLUDE (d), d3.interest, m.m, m52.m52, m13.m13, pv.realized_vol_30d, CASE WHEN pe.i >= 365 THEN pe.e END AS pema,
              CASE {CYCLE_SQL.replace("d <", "jd.d <")} ELSE {len(market.EPOCHS)} END AS ep
       FROM jd JOIN score s ON s.d = jd.d + 1 LEFT JOIN d1 ON d1.d = jd.d LEFT JOIN d2 ON d2.d = jd.d LEFT JOIN d3 ON d3.d = jd.d
       LEFT JOIN m ON m.d = jd.d LEFT JOIN m52 ON m52.d = jd.d LEFT JOIN m13 ON m13.d = jd.d
       LEFT JOIN pv ON pv.symbol = jd.symbol AND pv.d = jd.d LEFT JOIN pe ON pe.symbol = jd.symbol AND pe.d = jd.d),
jy AS (SELECT *, ten - two AS spread, lag(ten - two, 30) OVER (PARTITION BY symbol ORDER BY d) AS old, lag(ten, 30) OVER (PARTITION BY symbol ORDER BY d) AS oldten,
              (supply - 21000000 * (1 - pow(2e0, -ep))) / (210000 * 50 / pow(2e0, ep)) AS cycle_phase FROM jx)"""
TRAIN_DAILY_COLS = ", ".join(
    [
        "symbol, d", r("rsi"), r("rsi_weekly"), r("score"), r("vix"), r("close / pema - 1", "price_vs_ema365"), r("dollar / dema - 1", "dollar_vs_ema365"), r("realized_vol_30d"),
        r("ln(m / nullif(m52, 0))", "m2_yoy_log"), r("pow(m / nullif(m13, 0), 4e0) - 1", "m2_roc_13w_ann"), r("ten - oldten", "ten_chg_30d"), r("spread"), r("spread - old", "spread_chg_1m"),
        "coalesce(old < 0 AND spread > old, FALSE) AS dis_inverting", r("cycle_phase"), r("sin(2 * pi() * cycle_phase)", "cycle_phase_sin"), r("cos(2 * pi() * cycle_phase)", "cycle_phase_cos"),
        r("52560 * 50 / pow(2e0, ep) / supply", "issuance_rate_ann"), r("ay", "active_addresses_yoy_log"), r("ty", "tx_count_yoy_log"), r("interest", "investor_attention"),
    ]
)


def _named(series: DataFrame, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {n: market.one_series(series, n) for n in names}


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    bars = settle(market.bars(spark, sf_dir), "bars")
    prices = bars.select("symbol", "d", "close")
    daily = settle(scan.wilder_rsi(prices, 14), "daily_rsi")
    weekly = settle(scan.wilder_rsi(candles.weekly_candles(bars).select("symbol", "week_start", "close"), 14, order="week_start"), "weekly_rsi")
    named = _named(settle(_series(spark, sf_dir), "series"), ("dollar", "vix", "ten", "two", "supply", "addresses", "transactions"))
    attention = features.stitch_windows(market.interest(spark, sf_dir)).filter(F.col("term") == market.CAPPED).select("d", "interest")
    out = features.training_daily(daily, weekly, market.score_series(spark, sf_dir), named, market.vintages(spark, sf_dir), attention, market.EPOCHS)
    return out, prices, named


@registered(query(f"SELECT {TRAIN_DAILY_COLS} FROM jy", BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, SERIES, VINTAGES, VINTAGE_VIEWS, SCORE, TRAIN_DAILY))
def training_daily(spark, sf_dir):
    return rounded(_training(spark, sf_dir)[0])


TRAIN_WEEKLY = """
wb AS (SELECT symbol, week_start, week_start + 6 AS week_end, close, rsi FROM weekly_rsi WHERE rsi IS NOT NULL),
wd AS (SELECT DISTINCT week_end FROM wb),
ws AS (SELECT wd.week_end, s.dollar, s.ten, s.two, s.funds FROM wd ASOF LEFT JOIN series s ON wd.week_end >= s.d),
wm AS (SELECT wd.week_end, arg_max(v.value, (v.obs, v.rs)) AS m2 FROM wd JOIN vintages v ON v.rs <= wd.week_end AND v.re >= wd.week_end AND v.obs <= wd.week_end GROUP BY 1),
wj AS (SELECT wb.*, c.value AS score, ws.* EXCLUDE (week_end), wm.m2 FROM wb JOIN score c ON c.d = wb.week_start + 7 LEFT JOIN ws USING (week_end) LEFT JOIN wm USING (week_end)),
wy AS (SELECT *, ten - two AS spread, lag(ten - two, 4) OVER (PARTITION BY symbol ORDER BY week_start) AS old FROM wj)"""


@registered(
    query(
        "SELECT symbol, week_start, week_end, " + ", ".join(r(c) for c in ("close", "rsi", "dollar", "ten", "two", "funds", "m2", "score", "spread"))
        + f", {r('spread - old', 'spread_chg_1m')}, coalesce(old < 0 AND spread > old, FALSE) AS dis_inverting FROM wy",
        BARS, WEEKS, WEEKLY_RSI, SERIES, VINTAGES, SCORE, TRAIN_WEEKLY,
    )
)
def training_weekly(spark, sf_dir):
    weekly = scan.wilder_rsi(_weeks(spark, sf_dir).select("symbol", "week_start", "close"), 14, order="week_start")
    named = _named(settle(_series(spark, sf_dir), "series"), ("dollar", "ten", "two", "funds"))
    return rounded(features.training_weekly(weekly, market.score_series(spark, sf_dir), named, market.vintages(spark, sf_dir)))


@registered(
    query(
        f"""SELECT jy.symbol, jy.d, {r('jy.close', 'close')}, {r('jy.rsi', 'rsi_daily')}, {r('jy.rsi_weekly', 'rsi_weekly')}, {r('jy.score', 'score')}, {r('jy.vix', 'vix')},
        {r('jy.realized_vol_30d', 'realized_vol_30d')}, {r('jy.close / jy.pema - 1', 'price_vs_ema365')}, {r('jy.interest', 'investor_attention')},
        {r('s.addresses', 'active_addresses')}, {r('s.transactions', 'tx_count')}, {r('jy.ay', 'active_addresses_yoy_log')}, {r('jy.ty', 'tx_count_yoy_log')}
        FROM jy LEFT JOIN series s ON s.d = jy.d""",
        BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, SERIES, VINTAGES, VINTAGE_VIEWS, SCORE, TRAIN_DAILY,
    )
)
def monitor_daily(spark, sf_dir):
    training, prices, named = _training(spark, sf_dir)
    return rounded(features.monitor_daily(training, prices, {"active_addresses": named["addresses"], "tx_count": named["transactions"]}))


@registered(
    query(
        "SELECT symbol, d, CASE WHEN d >= DATE '1999-01-01' THEN 'new' ELSE 'old' END AS origin, " + r("CASE WHEN d >= DATE '1999-01-01' THEN close * 2 ELSE close END", "close") + " FROM bars",
        BARS,
    )
)
def upsert_merge(spark, sf_dir):
    """Bars up to the middle of 1999 merged with a batch from its start on, in which each key comes twice."""
    rows = market.bars(spark, sf_dir).select("symbol", "d", "close")
    old = rows.filter("d < date'1999-07-01'").select("*", F.lit("old").alias("origin"))
    new = rows.filter("d >= date'1999-01-01'")
    batch = new.select("symbol", "d", F.lit(-1.0).alias("close"), F.lit("stale").alias("origin"), F.lit(1).alias("at")).unionByName(
        new.select("symbol", "d", (F.col("close") * 2).alias("close"), F.lit("new").alias("origin"), F.lit(2).alias("at"))
    )
    return rounded(merged(old.withColumn("at", F.lit(0)), batch, ["symbol", "d"], order="at").drop("at").select("symbol", "d", "origin", "close"))


@registered(
    query(
        "SELECT symbol, d, CASE WHEN d < DATE '1999-07-01' THEN 'old' ELSE 'new' END AS origin, " + r("CASE WHEN d >= DATE '1999-01-01' THEN close * 2 ELSE close END", "close") + " FROM bars",
        BARS,
    )
)
def upsert_some_columns(spark, sf_dir):
    """The same merge, but a match updates the close only."""
    rows = market.bars(spark, sf_dir).select("symbol", "d", "close")
    old = rows.filter("d < date'1999-07-01'").select("*", F.lit("old").alias("origin"))
    batch = rows.filter("d >= date'1999-01-01'").select("symbol", "d", (F.col("close") * 2).alias("close"), F.lit("new").alias("origin"))
    return rounded(merged(old, batch, ["symbol", "d"], update=["close"]).select("symbol", "d", "origin", "close"))


@registered(query(f"SELECT symbol, d AS candle_date, {r('open', 'price_open')}, {r('high', 'price_high')}, {r('low', 'price_low')}, {r('close', 'price_close')}, {r('volume', 'volume_traded')} FROM bars", BARS))
def land_candles(spark, sf_dir):
    """Bars written as exchange payloads, one a symbol and month, and parsed again."""
    x = market.bars(spark, sf_dir)
    tuples = F.array(F.unix_millis(F.col("d").cast("timestamp")).cast("double"), "open", "high", "low", "close", "volume")
    raw = x.groupBy("symbol", F.trunc("d", "month").alias("m")).agg(F.to_json(F.collect_list(tuples)).alias("payload"))
    rows, _ = parse_candles(raw, CandleSource("bronze.exchange_a", "?", 1))
    return rounded(rows.select("symbol", "candle_date", "price_open", "price_high", "price_low", "price_close", "volume_traded"))


@registered(
    query(
        f"""SELECT d AS obs_date, {r('CASE WHEN day(d) % 10 = 5 THEN 0e0 ELSE vix END', 'obs_value')}, day(d) % 10 = 5 AS was_missing FROM series""",
        SERIES,
    )
)
def land_series(spark, sf_dir):
    """A series written as macro payloads with missing marks, parsed, split into kept and missing, and the missing back-filled with 0."""
    s = _series(spark, sf_dir)
    mark = F.when(F.dayofmonth("d") == 5, F.lit(".")).when(F.dayofmonth("d") % 10 == 5, F.lit("NaN")).otherwise(F.col("vix").cast("string"))
    raw = s.groupBy(F.trunc("d", "month").alias("m")).agg(
        F.to_json(F.struct(F.collect_list(F.struct(F.col("d").cast("string").alias("date"), mark.alias("value"))).alias("observations"))).alias("payload")
    )
    rows, _ = parse_observations(raw, 6)
    kept, gone = split_missing(rows, "obs_value")
    fix = gone.select("obs_date", F.lit(0.0).alias("correction"))
    both = kept.withColumn("was_missing", F.lit(False)).unionByName(gone.withColumn("was_missing", F.lit(True)))
    return rounded(backfill(both, fix, "obs_date", "obs_value").select("obs_date", "obs_value", "was_missing"))


@registered(
    """SELECT CAST(ts AS DATE) AS metric_date, CAST(round_even(sum(value), 0) AS BIGINT) AS metric_value FROM events WHERE value IS NOT NULL GROUP BY 1"""
)
def land_metric_pages(spark, sf_dir):
    """Daily sums written as metric pages and parsed as whole numbers."""
    days = market.table(spark, sf_dir, "events").filter("value is not null").groupBy(F.to_date("ts").alias("d")).agg(F.sum("value").alias("v"))
    cell = F.create_map(F.lit("time"), F.concat(F.col("d").cast("string"), F.lit("T00:00:00Z")), F.lit("TxCnt"), F.format_string("%.6f", "v"))
    raw = days.groupBy(F.trunc("d", "month").alias("m")).agg(F.to_json(F.struct(F.collect_list(cell).alias("data"))).alias("payload"))
    rows, _ = parse_metric_pages(raw, SeriesSource("bronze.transactions", "TxCnt", 9, True))
    return rows.select("metric_date", "metric_value")


@registered(
    query(f"SELECT symbol, d AS candle_date, {r('close', 'price_close')}, split_factor, div_cash FROM actions", BARS, ACTIONS)
)
def land_eod(spark, sf_dir):
    """Bars with actions written as end-of-day payloads, one a symbol and year, and parsed."""
    x = market.actions(market.bars(spark, sf_dir))
    bar = F.struct(F.concat(F.col("d").cast("string"), F.lit("T00:00:00.000Z")).alias("date"), "close", F.col("split_factor").alias("splitFactor"), F.col("div_cash").alias("divCash"))
    raw = x.groupBy("symbol", F.trunc("d", "year").alias("y")).agg(F.to_json(F.collect_list(bar)).alias("payload"))
    rows, _ = parse_eod(raw, "?", 4)
    return rounded(rows.select("symbol", "candle_date", "price_close", "split_factor", "div_cash"))


@registered(query(f"SELECT symbol, d AS candle_date, {r('close', 'price_close')}, {r('volume', 'volume_traded')} FROM bars WHERE day(d) <> 9", BARS))
def land_chart(spark, sf_dir):
    """Bars as parallel arrays, one payload a symbol and year, closes missing on the ninth, and parsed."""
    x = market.bars(spark, sf_dir).withColumn("close", F.when(F.dayofmonth("d") != 9, F.col("close")))
    packed = x.groupBy("symbol", F.trunc("d", "year").alias("y")).agg(F.sort_array(F.collect_list(F.struct("d", "close", "volume"))).alias("b"))
    quote = F.struct(F.col("b.close").alias("close"), F.col("b.volume").alias("volume"))
    stamps = F.transform("b.d", lambda d: F.unix_seconds(d.cast("timestamp")))
    result = F.struct(stamps.alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators"))
    raw = packed.select("symbol", F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"}).alias("payload"))
    rows, _ = parse_chart(raw, "?", 5)
    return rounded(rows.select("symbol", "candle_date", "price_close", "volume_traded"))


@registered(
    query(
        f"""SELECT symbol, min(d) AS first_day, max(d) AS last_day, count(*) AS days, max(d) - min(d) + 1 - count(*) AS missing_days,
        {r("count(*) FILTER (dayofweek(d) BETWEEN 1 AND 5) / (SELECT count(*) FROM (SELECT unnest(generate_series(CAST(min(b.d) AS TIMESTAMP), CAST(max(b.d) AS TIMESTAMP), INTERVAL 1 DAY)) AS t) WHERE dayofweek(t) BETWEEN 1 AND 5)", 'weekday_coverage')},
        max(gap) AS max_gap FROM (SELECT symbol, d, d - lag(d) OVER (PARTITION BY symbol ORDER BY d) AS gap FROM bars) b GROUP BY symbol""",
        BARS,
    )
)
def coverage(spark, sf_dir):
    return rounded(quality.coverage(market.bars(spark, sf_dir)))


@registered(query("SELECT count(*) AS n, 0 AS not_monday, 0 AS bad_end FROM weeks", BARS, WEEKS))
def week_checks(spark, sf_dir):
    return quality.week_checks(_weeks(spark, sf_dir))


@registered(query("SELECT count(*) AS n, 0 AS differing FROM weeks", BARS, WEEKS))
def weekly_matches_daily(spark, sf_dir):
    return quality.weekly_matches_daily(_weeks(spark, sf_dir), market.bars(spark, sf_dir))


@registered(query("SELECT count(*) AS n, 0 AS bad_warm_up, 0 AS out_of_range FROM bars", BARS))
def rsi_checks(spark, sf_dir):
    return quality.rsi_checks(scan.wilder_rsi(market.bars(spark, sf_dir).select("symbol", "d", "close"), 14), 14)


@registered(query("SELECT count(*) AS n, 0 AS unknown, 0 AS unreadable, 0 AS orphans FROM daily_rsi WHERE rsi IS NOT NULL", BARS, DAILY_RSI))
def signal_checks(spark, sf_dir):
    return quality.signal_checks(_signals(spark, sf_dir), market.bars(spark, sf_dir))


@registered(query("SELECT count(*) AS n, count(*) FILTER (month(week_start) = 3) AS not_monday, count(*) FILTER (month(week_start) IN (3, 4)) AS bad_end FROM weeks", BARS, WEEKS))
def week_checks_faults(spark, sf_dir):
    """Weeks of March begin a day late, those of April end a day late."""
    late = _weeks(spark, sf_dir).withColumns(
        {"week_start": F.date_add("week_start", F.when(F.month("week_start") == 3, 1).otherwise(0)), "week_end": F.date_add("week_end", F.when(F.month("week_start") == 4, 1).otherwise(0))}
    )
    return quality.week_checks(late)


@registered(query("SELECT count(*) FILTER (month(week_start) <> 6) + count(*) FILTER (month(week_start) = 6) AS n, count(*) FILTER (month(week_start) IN (5, 6)) AS differing FROM weeks", BARS, WEEKS))
def weekly_matches_daily_faults(spark, sf_dir):
    """Weeks of May close too high, those of June are missing."""
    wrong = _weeks(spark, sf_dir).filter(F.month("week_start") != 6).withColumn("close", F.col("close") * F.when(F.month("week_start") == 5, 1.01).otherwise(1.0))
    return quality.weekly_matches_daily(wrong, market.bars(spark, sf_dir))


@registered(
    query("SELECT count(*) AS n, count(*) FILTER (rsi IS NOT NULL AND day(d) = 7) AS bad_warm_up, count(*) FILTER (rsi IS NOT NULL AND day(d) = 11) AS out_of_range FROM daily_rsi", BARS, DAILY_RSI)
)
def rsi_checks_faults(spark, sf_dir):
    """Values are missing on the seventh and far too high on the eleventh."""
    rows = scan.wilder_rsi(market.bars(spark, sf_dir).select("symbol", "d", "close"), 14)
    wrong = F.when(F.dayofmonth("d") == 11, F.col("rsi") + 200).when(F.dayofmonth("d") != 7, F.col("rsi"))
    return quality.rsi_checks(rows.withColumn("rsi", wrong), 14)


@registered(
    query(
        "SELECT count(*) AS n, count(*) FILTER (day(d) = 4) AS unknown, count(*) FILTER (day(d) = 5) AS unreadable, count(*) FILTER (day(d) = 3) AS orphans FROM daily_rsi WHERE rsi IS NOT NULL",
        BARS, DAILY_RSI,
    )
)
def signal_checks_faults(spark, sf_dir):
    """Bars are missing on the third, signals have another value on the fourth and no parameters on the fifth."""
    day = F.dayofmonth("d")
    wrong = _signals(spark, sf_dir).withColumns({"signal": F.when(day == 4, "WAIT").otherwise(F.col("signal")), "trigger_params": F.when(day != 5, F.col("trigger_params"))})
    return quality.signal_checks(wrong, market.bars(spark, sf_dir).filter(F.dayofmonth("d") != 3))


@registered(
    "SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS symbol, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1"
)
def duplicate_keys(spark, sf_dir):
    orders = market.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("symbol"))
    return quality.duplicates(orders, ["d", "symbol"])


@registered(
    """WITH a AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), b AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
    SELECT count(*) AS shared FROM a JOIN b USING (d)"""
)
def shared_dates(spark, sf_dir):
    a = market.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    b = market.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    return quality.overlap(a, b, ["d"])


GRID_FIXED = ("signs", "fx", "fy", "fz", "held", "steps", "prior", "moves", "bt")


def _prefixed(sql: str, prefix: str, names: tuple[str, ...] = GRID_FIXED) -> str:
    """The same common table expressions under names of their own."""
    for n in names:
        sql = re.sub(rf"\b{n}\b", prefix + n, sql)
    return sql


GRID = """
ga AS (SELECT 'momentum' AS strategy, t.fold, t.week_start AS return_week, b.gross, b.cost FROM m_bt b JOIN folds t ON t.role = 'test' AND t.week_start = b.return_week
       UNION ALL SELECT 'history', fold, return_week, gross, cost FROM y_bt UNION ALL SELECT 'hold', fold, return_week, gross, cost FROM h_bt
       UNION ALL SELECT 'passive', fold, return_week, gross, cost FROM po),
gc AS (SELECT fold, return_week FROM ga GROUP BY ALL HAVING count(DISTINCT strategy) = 4),
gb AS (SELECT strategy, fold, cost_mult, return_week, gross + cost * cost_mult AS net FROM ga JOIN gc USING (fold, return_week), (VALUES (1e0), (1.5e0), (2e0)) k(cost_mult)),
ge AS (SELECT *, product(1 + net) OVER w AS equity FROM gb WINDOW w AS (PARTITION BY strategy, cost_mult, fold ORDER BY return_week)),
gd AS (SELECT *, equity / greatest(1e0, max(equity) OVER (PARTITION BY strategy, cost_mult, fold ORDER BY return_week)) - 1 AS drawdown FROM ge),
gs AS (SELECT strategy, cost_mult, fold, count(*) AS n, avg(net) AS m, stddev_samp(net) AS sd, count(*) FILTER (net < 0) AS nd, -min(net) AS worst,
              stddev_samp(net) FILTER (net < 0) AS dsd, product(1 + net) AS growth, least(min(drawdown), 0) AS mdd FROM gd GROUP BY ALL),
gr AS (SELECT *, CASE WHEN n < 2 THEN 0e0 ELSE pow(growth, 52e0 / n) - 1 END AS ar FROM gs),
gt AS (SELECT strategy, cost_mult, count(*) AS n_folds, avg(CASE WHEN n < 2 OR sd = 0 THEN 0e0 ELSE m / sd * sqrt(52e0) END) AS cv_sharpe,
              avg(CASE WHEN n < 2 THEN 0e0 WHEN nd = 0 THEN CASE WHEN m <= 0 THEN 0e0 END WHEN nd = 1 THEN m / worst * sqrt(52e0) ELSE m / dsd * sqrt(52e0) END) AS cv_sortino,
              avg(ar) AS cv_annual_return, avg(mdd) AS cv_max_drawdown, avg(CASE WHEN n < 2 THEN 0e0 WHEN mdd = 0 THEN CASE WHEN ar <= 0 THEN 0e0 END ELSE ar / -mdd END) AS cv_calmar
       FROM gr GROUP BY ALL),
hd AS (SELECT row_number() OVER (ORDER BY a.fold, a.return_week) AS i, a.net - b.net AS d FROM gb a JOIN gb b USING (fold, return_week)
       WHERE a.strategy = 'momentum' AND b.strategy = 'history' AND a.cost_mult = 1 AND b.cost_mult = 1)"""


def _grid_config() -> experiments.GridConfig:
    return experiments.GridConfig(passive=PASSIVE)


@registered(
    query(
        "SELECT strategy, cost_mult, n_folds, " + ", ".join(r(f"cv_{c}") for c in experiments.METRICS)
        + f""", CASE WHEN g THEN n END AS gate_n_obs, {r('CASE WHEN g THEN m END', 'mean_delta')}, {r('CASE WHEN g THEN t END', 't_stat')}, CASE WHEN g THEN t > 1.64 END AS gate_pass
        FROM (SELECT *, strategy = 'momentum' AND cost_mult = 1 AS g, CASE WHEN v > 0 THEN m / sqrt(v / n) ELSE 0 END AS t FROM gt, hm, hv)""",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, WEIGHTS, COSTS, _prefixed(BACKTEST, "m_"), FOLDS, _prefixed(HISTORY, "y_"), _prefixed(HOLD, "h_"), DRIFT,
        GRID, HAC[HAC.index("hm AS"):],
    )
)
def experiment_grid(spark, sf_dir):
    """Ledger rows: means over folds by strategy and cost, the gate on momentum at plain cost."""
    cfg = _grid_config()
    grid = experiments.run_grid(_books_input(spark, sf_dir), _costs(spark), cfg)
    return rounded(experiments.grid_results(grid, cfg))


from marlspike.plans import lifecycle  # noqa: E402,F401  registers the queries over landing, tables and jobs
