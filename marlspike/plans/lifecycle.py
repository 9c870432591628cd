"""Registered queries over payload landing, the table layer and the jobs: each runs what the jobs run, in a catalogue of its own in the shared folder."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.operators import backtest, candles, experiments, portfolio, quality, signals
from marlspike.plans import catalogue as c
from marlspike.plans import jobs
from marlspike.plans.sql import ACTIONS, BARS, DAILY_RSI, INTEREST, MOMENTUM, RETURNS, SERIES, VINTAGES, WEEKLY_RSI, WEEKS, query, r, trend_cte
from marlspike.schemas import TABLES
from marlspike.sources import landing, market
from marlspike.sources.shared import folder, settle
from marlspike.sources.tables import Catalog
from marlspike.streaming import candles as streaming

registered, rounded = c.registered, c.rounded
RUN, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)


def _catalog(spark: SparkSession) -> Catalog:
    return Catalog(spark, folder(spark, "catalogue"))


def _bronze(prices: DataFrame) -> DataFrame:
    """Bars as a bronze table has them."""
    return prices.select("symbol", F.col("d").alias("candle_date"), *(F.col(b).alias(a) for a, b in jobs.PRICES.items()))


def _pages(rows: DataFrame, of: str, item, wrap) -> DataFrame:
    """A payload for each month of ``rows``: ``item`` of every row, together as ``wrap`` has them."""
    return rows.groupBy(F.trunc(of, "month").alias("m")).agg(wrap(F.sort_array(F.collect_list(item))).alias("payload")).select("payload")


@registered(query(f"SELECT symbol, d AS candle_date, {r('close', 'price_close')}, 1::BIGINT AS source_id FROM bars WHERE d < DATE '1998-06-01'", BARS))
def land_closed_candles(spark, sf_dir):
    """Candles landed at noon of 1 June 1998: the day of the run is open, and later ones are not there yet."""
    x = market.bars(spark, sf_dir)
    candle = F.array(F.unix_millis(F.col("d").cast("timestamp")).cast("double"), "open", "high", "low", "close", "volume")
    raw = x.groupBy("symbol", F.trunc("d", "month").alias("m")).agg(F.to_json(F.collect_list(candle)).alias("payload")).select("symbol", "payload")
    landed = landing.land(raw, landing.SOURCES["bronze.exchange_a"], None, None, datetime(1998, 6, 1, 12))
    return rounded(landed.rows.select("symbol", "candle_date", "price_close", "source_id"))


@registered(query(f"SELECT symbol, d AS candle_date, {r('close', 'price_close')} FROM bars WHERE d < DATE '1998-06-01' AND d >= DATE '1998-03-01'", BARS))
def land_open_bars(spark, sf_dir):
    """End-of-day bars of a range of days, without the day of the run."""
    x = market.bars(spark, sf_dir)
    bar = F.struct(F.col("d").cast("string").alias("date"), "close")
    raw = x.groupBy("symbol", F.trunc("d", "month").alias("m")).agg(F.to_json(F.collect_list(bar)).alias("payload")).select("symbol", "payload")
    landed = landing.land(raw, landing.SOURCES["bronze.eod_etf"], date(1998, 3, 1), date(1998, 12, 31), datetime(1998, 6, 1, 12))
    return rounded(landed.rows.select("symbol", "candle_date", "price_close"))


@registered(query("SELECT obs, rs, re, " + r("value") + " FROM vintages WHERE day(rs) <> 9", VINTAGES))
def land_vintages(spark, sf_dir):
    """Vintage observations, those that start on a ninth without a value."""
    v = market.vintages(spark, sf_dir)
    mark = F.when(F.dayofmonth("rs") == 9, F.lit(".")).otherwise(F.format_string("%.9f", F.col("value").cast("double")))
    item = F.struct(F.col("obs").cast("string").alias("date"), F.col("rs").cast("string").alias("realtime_start"), F.col("re").cast("string").alias("realtime_end"), mark.alias("value"))
    raw = _pages(v, "obs", item, lambda many: F.to_json(F.struct(many.alias("observations"))))
    return rounded(landing.vintages(raw, 1, RUN).rows.select("obs", "rs", "re", "value"))


@registered(query(f"SELECT d, {r('vix', 'value')}, FALSE AS is_reject FROM series WHERE day(d) <> 8 AND day(d) <> 21 UNION ALL SELECT d, NULL, TRUE FROM series WHERE day(d) = 21", SERIES))
def land_metric_csv(spark, sf_dir):
    """Lines of a metric: a value, none on an eighth, and on a 21st a line that is cut short."""
    s = market.one_series(c._series(spark, sf_dir), "vix")
    day = F.date_format("d", "yyyy-MM-dd")
    line = F.when(F.dayofmonth("d") == 21, day).otherwise(F.concat_ws(",", day, F.lit("0"), F.when(F.dayofmonth("d") == 8, "NaN").otherwise(F.format_string("%.9f", "value"))))
    raw = _pages(s, "d", line, lambda many: F.concat(F.lit("date,time,value\n"), F.array_join(many, "\n")))
    landed = landing.land(raw, landing.SOURCES["bronze.valuation_score"], None, None, RUN)
    cut = landed.rejects.select(F.to_date("payload").alias("d"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_reject"))
    return rounded(landed.rows.select("d", "value", F.lit(False).alias("is_reject")).unionByName(cut))


@registered(query(f"SELECT d, {r('dollar', 'price_close')} FROM series WHERE day(d) <> 4 AND d < DATE '1998-06-01'", SERIES))
def land_dollar_index(spark, sf_dir):
    """The index as chart payloads, a fourth without a close, up to the day before the run."""
    s = market.one_series(c._series(spark, sf_dir), "dollar")
    packed = s.groupBy(F.trunc("d", "month").alias("m")).agg(F.sort_array(F.collect_list(F.struct("d", F.when(F.dayofmonth("d") != 4, F.col("value")).alias("v")))).alias("b"))
    stamps = F.transform("b.d", lambda d: F.unix_seconds(d.cast("timestamp")))
    result = F.struct(stamps.alias("timestamp"), F.struct(F.array(F.struct(F.col("b.v").alias("close"))).alias("quote")).alias("indicators"))
    raw = packed.select(F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"}).alias("payload"))
    landed = landing.land(raw, landing.SOURCES["bronze.dollar_index"], None, None, datetime(1998, 6, 1))
    return rounded(landed.rows.select("d", "price_close"))


@registered(query("SELECT term, window_start, d, interest FROM interest WHERE day(d) % 7 <> 3", INTEREST))
def land_interest(spark, sf_dir):
    """Weekly interest of every request window as it comes: text values, some weeks partial."""
    x = market.interest(spark, sf_dir)
    rows = x.select("term", "window_start", F.col("d").cast("string").alias("date"), F.format_string("%.1f", F.col("interest").cast("double")).alias("interest"), (F.dayofmonth("d") % 7 == 3).alias("is_partial"))
    kept, _ = landing.land_interest(rows, F.col("term"), F.col("window_start"), 1, RUN)
    return kept.select("term", "window_start", "d", "interest")


@registered(query("SELECT term, max(window_start) AS window_start FROM interest GROUP BY term", INTEREST))
def resume_points(spark, sf_dir):
    return landing.resume_points(market.interest(spark, sf_dir))


@registered(
    """WITH b AS (SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events),
    w AS (SELECT s + CAST(k * 9 AS INTEGER) AS window_start, e FROM b, range(0, 5000) t(k) WHERE k = 0 OR s + CAST(k * 9 AS INTEGER) + 5 < e)
    SELECT window_start, least(window_start + 14, e) AS window_end FROM w"""
)
def request_windows(spark, sf_dir):
    """Windows of 14 days that overlap by 5, over the days of the events."""
    first, last = market.table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return landing.request_windows(spark, first, last, 14, 5)


OUTCOMES = """SELECT 'landed' AS outcome, count(*) AS n FROM series WHERE month(d) <> 4 AND day(d) <> 5 UNION ALL
    SELECT 'missing', count(*) FROM series WHERE month(d) <> 4 AND day(d) = 5 UNION ALL SELECT 'unreadable', count(DISTINCT date_trunc('month', d)) FROM series WHERE month(d) = 4"""


@registered(query(OUTCOMES, SERIES))
def landing_outcomes(spark, sf_dir):
    """Payloads of a rate, landed twice: April's are cut off and fifths have no value; what was not landed is in the quarantine, once."""
    s = market.one_series(c._series(spark, sf_dir), "ten")
    item = F.struct(F.col("d").cast("string").alias("date"), F.when(F.dayofmonth("d") == 5, ".").otherwise(F.format_string("%.9f", "value")).alias("value"))
    raw = _pages(s, "d", item, lambda many: F.to_json(F.struct(many.alias("observations"))))
    raw = settle(raw.select(F.when(F.col("payload").rlike(r'"date":"\d+-04-'), F.expr("substr(payload, 1, length(payload) - 2)")).otherwise(F.col("payload")).alias("payload")), "payloads")
    catalog = _catalog(spark)
    for at in (RUN, LATER):
        jobs.land(catalog, "bronze.rate_10y", raw, at)
    held = catalog.read("control.quarantine").groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return held.unionByName(catalog.read("bronze.rate_10y").agg(F.lit("landed").alias("outcome"), F.count(F.lit(1)).alias("n")))


@registered(
    query(
        f"""SELECT symbol, d AS candle_date, {r("CASE WHEN d >= DATE '1998-01-01' THEN close * 2 ELSE close END", "price_close")}, CASE WHEN d >= DATE '1998-01-01' THEN 2 ELSE 1 END AS run
        FROM bars WHERE d BETWEEN DATE '1997-06-15' AND DATE '1998-03-15'""",
        BARS,
    )
)
def catalogue_upsert(spark, sf_dir):
    """Bars up to the middle of 1998, then a batch from its start on that comes twice; read between two days."""
    x, catalog, name = settle(_bronze(market.bars(spark, sf_dir)), "bronze"), _catalog(spark), "bronze.exchange_a"
    stamped = lambda rows, at: rows.withColumn("datetime_update", F.lit(at).cast("timestamp"))
    catalog.upsert(name, stamped(x.filter("candle_date < date'1998-07-01'"), RUN))
    batch = stamped(x.filter("candle_date >= date'1998-01-01'").withColumn("price_close", F.col("price_close") * 2), LATER)
    for rows in (batch, batch, batch.limit(0)):
        catalog.upsert(name, rows)
    out = catalog.read(name, date(1997, 6, 15), date(1998, 3, 15))
    return rounded(out.select("symbol", "candle_date", "price_close", F.when(F.col("datetime_update") == F.lit(LATER), 2).otherwise(1).alias("run")))


@registered(
    query(
        """SELECT symbol, count(*) AS n, count(*) FILTER (d BETWEEN DATE '1997-03-05' AND DATE '1998-02-10' AND symbol = '2-HIGH') AS counted,
        min(d) AS first_day, max(d) AS last_day FROM bars GROUP BY symbol""",
        BARS,
    )
)
def catalogue_delete(spark, sf_dir):
    """A dry run counts a symbol's rows between two days, the run deletes them; what is left, with what is gone added again."""
    catalog, name = _catalog(spark), "bronze.exchange_b"
    catalog.upsert(name, _bronze(market.bars(spark, sf_dir)))
    what = ("2-HIGH", "all", "1997-03-05", "1998-02-10", "bronze")
    counted, gone = catalog.clean_tables(*what)[name], catalog.clean_tables(*what, dry_run=False)[name]
    if counted != gone or sum(catalog.clean_tables(*what).values()):
        raise ValueError("a dry run and its run disagree")
    left = catalog.read(name).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("candle_date").alias("first_day"), F.max("candle_date").alias("last_day"))
    hit = F.when(F.col("symbol") == "2-HIGH", F.lit(gone)).otherwise(0).cast("long")
    return left.select("symbol", (F.col("n") + hit).alias("n"), hit.alias("counted"), "first_day", "last_day")


@registered("SELECT CAST(n_nationkey AS BIGINT) AS source_id, n_name AS source_name, CAST(n_regionkey AS BIGINT) AS priority FROM nation")
def catalogue_seed(spark, sf_dir):
    """Nations as priorities: a second seed with other values adds those that the first left out and changes none."""
    x = market.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("source_id"), F.col("n_name").alias("source_name"), F.col("n_regionkey").cast("long").alias("priority"))
    catalog = _catalog(spark)
    catalog.seed("control.source_priority", x.filter("source_id % 3 != 0"))
    catalog.seed("control.source_priority", x.withColumn("priority", F.when(F.col("source_id") % 3 == 0, F.col("priority")).otherwise(-1)))
    return catalog.read("control.source_priority")


@registered(
    """SELECT CAST(r_regionkey AS BIGINT) AS param_version, r_regionkey = 2 AS is_active, 10 + CAST(r_regionkey AS BIGINT) AS rsi_period,
    CAST((SELECT 10 + max(r_regionkey) FROM region WHERE r_regionkey = 2) AS BIGINT) AS active_period FROM region"""
)
def active_version(spark, sf_dir):
    """Regions as parameter versions, all active but one: one is made the only active one."""
    x = market.table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("param_version"))
    values = {"is_active": F.col("param_version") != 1, "rsi_period": F.col("param_version") + 10} | {n: F.lit(1.0) for n in ("trend_start", "trend_end", "oversold", "overbought")}
    catalog = _catalog(spark)
    catalog.seed("strategy.rsi_params", x.withColumns(values))
    catalog.activate("strategy.rsi_params", 2)
    used = catalog.active("strategy.rsi_params")["rsi_period"]
    return catalog.read("strategy.rsi_params").select("param_version", "is_active", "rsi_period", F.lit(used).cast("long").alias("active_period"))


@registered(
    query(
        f"SELECT symbol, week_start, signal, {r('round(realized_vol_26w, 6)', 'realized_vol_26w')}, 52 AS horizon, {r('round(formation, 6)', 'formation')} FROM momentum",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM,
    )
)
def trigger_round_trip(spark, sf_dir):
    """Signals read back from the JSON in which they are stored."""
    stored = signals.momentum_signals(c._returns(spark, sf_dir)).select("symbol", "week_start", "trigger_params")
    read = signals.read_trigger(stored)
    kept = F.from_json("trigger_params", "horizon int, formation double")
    return rounded(read.withColumn("p", kept).select("symbol", "week_start", "signal", "realized_vol_26w", "p.horizon", "p.formation"))


@registered(
    query(
        f"""SELECT symbol, week_start, {r('CAST(signal AS DOUBLE) / count(*) OVER (PARTITION BY week_start)', 'weight')} FROM momentum WHERE signal <> 0 AND symbol <> '1-URGENT'""",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM,
    )
)
def equal_weights(spark, sf_dir):
    """The book without the capped leg, every sign alike."""
    rows = signals.momentum_signals(c._returns(spark, sf_dir)).select("symbol", "week_start", "signal", "realized_vol_26w", "is_capped")
    book = portfolio.build_weights(rows, portfolio.PortfolioParams("equal_weight"), books=(False,))
    return rounded(book.select("symbol", "week_start", "weight"))


ROLLING = c.FOLDS.replace("i < s - 3", "i < s - 3 AND i >= s - 104")


@registered(query("SELECT fold, role, week_start FROM folds", BARS, WEEKS, ACTIONS, SERIES, RETURNS, ROLLING))
def walk_forward_rolling(spark, sf_dir):
    return backtest.walk_forward(c._returns(spark, sf_dir).select("week_start"), backtest.SplitConfig(mode="rolling"))


HOLDOUT = "DATE '1999-01-04'"


@registered(
    query(
        f"SELECT week_start, week_start >= {HOLDOUT} AS is_holdout FROM (SELECT DISTINCT week_start FROM returns)",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS,
    )
)
def holdout_weeks(spark, sf_dir):
    """Weeks before the holdout, which the folds refuse to mix with it, and those of the holdout."""
    weeks, start = settle(c._returns(spark, sf_dir).select("week_start").distinct(), "weeks"), date(1999, 1, 4)
    cfg = backtest.SplitConfig(min_train=20, n_splits=2)
    try:
        backtest.walk_forward(weeks, cfg, start)
    except backtest.HoldoutViolation:
        known = backtest.before_holdout(weeks, start)
        backtest.walk_forward(known, cfg, start)
        held = backtest.open_holdout(weeks, start, 50)
        return known.withColumn("is_holdout", F.lit(False)).unionByName(held.withColumn("is_holdout", F.lit(True)))
    raise ValueError("weeks of the holdout were taken")


ROLLS = {"4-NOT SPECIFIED": 120.0, "1-URGENT": 30.0}


@registered(
    query(
        f"""SELECT b.return_week, 1.5e0 AS cost_mult, {r('b.gross', 'gross')}, {r('b.gross + b.cost * 1.5e0 + x.roll', 'net')}, {r('b.turnover', 'turnover')} FROM bt b JOIN (
            SELECT return_week, -sum(abs(weight) * CASE symbol WHEN '4-NOT SPECIFIED' THEN pow(1.012e0, 1 / 52e0) - 1 WHEN '1-URGENT' THEN pow(1.003e0, 1 / 52e0) - 1 ELSE 0 END) AS roll
            FROM held GROUP BY return_week) x USING (return_week)""",
        BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, c.WEIGHTS, c.COSTS, c.BACKTEST,
    )
)
def backtest_with_rolls(spark, sf_dir):
    """The momentum backtest where two symbols cost something to hold."""
    rows = c._books_input(spark, sf_dir)
    return rounded(backtest.backtest(experiments.every_signal(rows, 52), rows, c._costs(spark), multipliers=(1.5,), rolls=ROLLS))


@registered(query(f"SELECT symbol, week_start, {c.OHLC} FROM weeks WHERE week_start >= DATE '1998-06-01'", BARS, WEEKS))
def weekly_candles_since(spark, sf_dir):
    """Weeks made anew from the Monday of a run's first day on."""
    days = market.bars(spark, sf_dir)
    out = candles.weekly_candles(days.filter("d >= date'1998-06-01'"), since=date(1998, 6, 3))
    return rounded(out.select("symbol", "week_start", "open", "high", "low", "close", "volume"))


def _with_bars(spark: SparkSession, sf_dir: str) -> Catalog:
    """A catalogue of bronze bars and parameters."""
    catalog = _catalog(spark)
    catalog.upsert("bronze.exchange_a", _bronze(market.bars(spark, sf_dir)))
    catalog.seed("control.source_priority", spark.createDataFrame([(1, "a", 1)], TABLES["control.source_priority"].schema))
    catalog.seed("strategy.rsi_params", spark.createDataFrame([(1, True, 14, 40.0, 70.0, 30.0, 70.0)], TABLES["strategy.rsi_params"].schema))
    catalog.seed("strategy.momentum_params", spark.createDataFrame([(1, True, 52, 0.1, 26, 52, None, "inverse_vol", 0.2)], TABLES["strategy.momentum_params"].schema))
    return catalog


def _ran(spark: SparkSession, sf_dir: str) -> Catalog:
    """The RSI job over the whole history in two runs, of which the second takes three days of the first again."""
    catalog = _with_bars(spark, sf_dir)
    sources = jobs.bronze_sources(catalog, {1: "bronze.exchange_a"})
    jobs.run_rsi_signals(catalog, sources, date(1990, 1, 1), date(1997, 9, 30), RUN)
    jobs.run_rsi_signals(catalog, sources, date(1997, 10, 1), date(2010, 1, 1), LATER)
    return catalog


@registered(
    query("SELECT symbol, CAST(d AS TIMESTAMP) AS signal_start, signal, " + r("round(rsi, 4)", "rsi") + ", in_trend, CASE WHEN d >= DATE '1997-09-28' THEN 2 ELSE 1 END AS run FROM signals", BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, trend_cte(), c.SIGNALS)
)
def job_rsi_signals(spark, sf_dir):
    """Stored signals of the job: bars conformed, weeks, RSI resumed from its stored state, signals with their parameters."""
    rows = _ran(spark, sf_dir).read("gold.signals")
    read = F.from_json("trigger_params", "rsi double, in_trend boolean")
    run = F.when(F.col("datetime_update") == F.lit(LATER), 2).otherwise(1)
    return rounded(rows.select("symbol", F.col("signal_start").cast("timestamp_ntz").alias("signal_start"), "signal", read["rsi"].alias("rsi"), read["in_trend"].alias("in_trend"), run.alias("run")))


UNIVERSE = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
_MOMENTUM = MOMENTUM.replace("FROM returns WHERE", "FROM returns WHERE symbol <> '5-LOW' AND")
_WEIGHTS = c.WEIGHTS.replace("SELECT m.*,", "SELECT m.* REPLACE (round(m.realized_vol_26w, 6) AS realized_vol_26w),")


@registered(query(f"SELECT symbol, week_start, include_capped, {r('weight')}, 3 AS strategy_id FROM weights", BARS, WEEKS, ACTIONS, SERIES, RETURNS, _MOMENTUM, _WEIGHTS))
def job_momentum(spark, sf_dir):
    """Stored weights of the job over a universe of four symbols, run twice: candles, signals, and weights from the stored signals' parameters."""
    catalog = _with_bars(spark, sf_dir)
    jobs.conform(catalog, jobs.bronze_sources(catalog, {1: "bronze.exchange_a"}), date(1990, 1, 1), date(2010, 1, 1), RUN)
    actions = settle(market.actions(market.bars(spark, sf_dir)), "actions")
    rate = settle(market.one_series(c._series(spark, sf_dir), "funds"), "rate")
    for at in (RUN, LATER):
        jobs.run_momentum(catalog, actions, rate, frozenset({market.CAPPED}), at, UNIVERSE)
    return rounded(catalog.read("gold.weights").select("symbol", "week_start", "include_capped", "weight", F.col("strategy_id").cast("int").alias("strategy_id")))


@registered(query("SELECT obs, rs, re, " + r("value") + " FROM vintages", VINTAGES))
def catalogue_vintages(spark, sf_dir):
    """Vintages that land while they are open, then again with their ends."""
    v, catalog = settle(market.vintages(spark, sf_dir), "vintages"), _catalog(spark)
    for end, at in ((F.lit("9999-12-31"), RUN), (F.col("re").cast("string"), LATER)):
        item = F.struct(
            F.col("obs").cast("string").alias("date"), F.col("rs").cast("string").alias("realtime_start"), end.alias("realtime_end"), F.format_string("%.9f", F.col("value").cast("double")).alias("value")
        )
        jobs.land_vintages(catalog, _pages(v, "obs", item, lambda many: F.to_json(F.struct(many.alias("observations")))), 1, at)
    return rounded(catalog.read("bronze.money_vintages").select("obs", "rs", "re", "value"))


@registered(query("SELECT term, window_start, d, interest, day(d) % 5 = 0 AS is_new FROM interest", INTEREST))
def catalogue_interest(spark, sf_dir):
    """Weeks of interest that land without every fifth day's, then whole; what was there and came again is as before."""
    x, catalog = settle(market.interest(spark, sf_dir), "interest"), _catalog(spark)
    rows = x.select("term", "window_start", F.col("d").cast("string").alias("date"), F.col("interest").cast("string").alias("interest"), F.lit(False).alias("is_partial"))
    for some, at in ((F.dayofmonth(F.to_date("date")) % 5 != 0, RUN), (F.dayofmonth(F.to_date("date")) % 5 == 0, LATER)):
        jobs.land_interest(catalog, rows.filter(some), F.col("term"), F.col("window_start"), 1, at)
    return catalog.read("bronze.interest").select("term", "window_start", "d", "interest", (F.col("datetime_update") == F.lit(LATER)).alias("is_new"))


@registered(
    query(
        """SELECT table_name, check_name, n_rows, n_failing FROM (
            SELECT 'bronze.exchange_a' AS table_name, count(*) AS n_rows, count(*) FILTER (gap > 1) AS gaps FROM (SELECT d - lag(d) OVER (PARTITION BY symbol ORDER BY d) AS gap FROM bars)),
            LATERAL (SELECT unnest([{'check_name': 'repeated key', 'n_failing': 0}, {'check_name': 'null in key', 'n_failing': 0}, {'check_name': 'not above zero', 'n_failing': 0},
                {'check_name': 'high below low', 'n_failing': 0}, {'check_name': 'negative volume', 'n_failing': 0}, {'check_name': 'gap', 'n_failing': gaps}], recursive := true))
        UNION ALL SELECT 'control.quarantine', check_name, (SELECT count(*) FROM bars WHERE day(d) = 7), 0 FROM (SELECT unnest(['repeated key', 'null in key']) AS check_name)
        UNION ALL SELECT 'bronze.interest', check_name, n, CASE check_name WHEN 'outside 0 to 100' THEN bad ELSE 0 END FROM (SELECT count(*) AS n, count(*) FILTER (day(d) = 3) AS bad FROM interest),
            (SELECT unnest(['repeated key', 'null in key', 'outside 0 to 100']) AS check_name)""",
        BARS, INTEREST,
    )
)
def catalogue_checks(spark, sf_dir):
    """Key, range and gap checks of all tables of a catalogue, run twice under one id; some interest is far too high, bars without a close wait in the quarantine."""
    catalog, x = _catalog(spark), _bronze(market.bars(spark, sf_dir))
    catalog.upsert("bronze.exchange_a", x)
    gone = x.filter(F.dayofmonth("candle_date") == 7).select("symbol", "candle_date", F.lit(None).cast("double").alias("price_close"))
    catalog.seed("control.quarantine", landing.quarantined("bronze.exchange_a", landing.Landed(gone.limit(0), gone, spark.createDataFrame([], "payload string")), RUN))
    catalog.upsert("bronze.interest", market.interest(spark, sf_dir).withColumn("interest", F.col("interest") + F.when(F.dayofmonth("d") == 3, 500).otherwise(0)))
    jobs.run_checks(catalog, "nightly", RUN)
    return jobs.run_checks(catalog, "nightly", LATER).select("table_name", "check_name", "n_rows", "n_failing")


@registered(
    query(
        "SELECT symbol, d, signal, previous_signal, CAST(1 AS BIGINT) AS strategy_id FROM (SELECT symbol, d, signal, lag(signal) OVER (PARTITION BY symbol ORDER BY d) AS previous_signal FROM signals)"
        " WHERE signal IS DISTINCT FROM previous_signal UNION ALL SELECT symbol, min(d), 'NEUTRAL', NULL, 9 FROM signals GROUP BY symbol",
        BARS, WEEKS, DAILY_RSI, WEEKLY_RSI, trend_cte(), c.SIGNALS,
    )
)
def strategy_signal_changes(spark, sf_dir):
    """Changes of two strategies' stored signals, of which the second never moves."""
    x, catalog = c._signals(spark, sf_dir), _catalog(spark)
    rows = x.select("symbol", F.lit("1d").alias("temporality"), F.col("d").cast("timestamp").alias("signal_start"), F.lit(1).alias("strategy_id"), "signal", "trigger_params")
    catalog.upsert("gold.signals", rows.unionByName(rows.withColumns({"strategy_id": F.lit(9), "signal": F.lit("NEUTRAL")})))
    return jobs.signal_changes(catalog).select("symbol", F.to_date("signal_start").alias("d"), "signal", "previous_signal", "strategy_id")


LEDGER = "SELECT strategy, cost_mult, CAST(n_folds AS BIGINT) AS n_folds, " + ", ".join(r(f"cv_{m}") for m in experiments.METRICS) + ", 'nightly' AS run_id, strategy = 'momentum' AND cost_mult = 1 AS has_gate FROM gt"


@registered(
    query(
        LEDGER, BARS, WEEKS, ACTIONS, SERIES, RETURNS, MOMENTUM, c.WEIGHTS, c.COSTS, c._prefixed(c.BACKTEST, "m_"), c.FOLDS, c._prefixed(c.HISTORY, "y_"), c._prefixed(c.HOLD, "h_"), c.DRIFT,
        c.GRID[: c.GRID.index(",\nhd AS")],
    )
)
def experiment_ledger(spark, sf_dir):
    """A run of the grid in the ledger, where it stands once although it ran twice."""
    catalog, returns = _catalog(spark), c._books_input(spark, sf_dir)
    for at in (RUN, LATER):
        rows = jobs.run_experiments(catalog, returns, c._costs(spark), c._grid_config(), "nightly", at)
    return rounded(rows.select("strategy", "cost_mult", "n_folds", *(f"cv_{m}" for m in experiments.METRICS), "run_id", F.col("gate_n_obs").isNotNull().alias("has_gate")))


@registered(c._ticks("day").replace("event_type,", "event_type AS symbol,", 1))
def streamed_candles(spark, sf_dir):
    """Daily bars of the events as a stream, written by key."""
    events, at = market.table(spark, sf_dir, "events"), folder(spark, "stream")
    settled = settle(events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"), "ticks")
    ticks = spark.readStream.schema(settled.schema).option("maxFilesPerTrigger", 4).parquet(settled.inputFiles()[0].rsplit("/", 1)[0])
    bars = streaming.stream_candles(ticks, late="100000 days")
    key = ["symbol", "period"]

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/bars/batch={number}")

    query_ = bars.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query_.awaitTermination()
    out = spark.read.parquet(f"{at}/bars")
    newest = out.groupBy(*key).agg(F.max_by(F.struct("open", "high", "low", "close", "volume"), "batch").alias("b"))
    return rounded(newest.select("symbol", F.col("period").cast("timestamp_ntz").alias("period"), "b.*"))
