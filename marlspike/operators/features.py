"""Returns, volatilities, stitched series and point-in-time training tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.operators.asof import asof, asof_many, offset_join, vintage_asof
from marlspike.operators.candles import split_factors, week_start
from marlspike.operators.scan import ema
from marlspike.sources.shared import settle


def _along(key: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*key).orderBy(order)


def realized_vol(
    df: DataFrame, returns: str, rows: int, per_year: int, key: Sequence[str] = ("symbol",), order: str = "d", out: str = "realized_vol"
) -> DataFrame:
    """``df`` with the annualised deviation of the last ``rows`` returns, null on a key's first ``rows`` rows."""
    w = _along(key, order)
    frame = w.rowsBetween(-(rows - 1), Window.currentRow)
    vol = F.stddev_samp(returns).over(frame) * F.sqrt(F.lit(float(per_year)))
    return df.withColumn(out, F.when(F.row_number().over(w) > rows, vol))


def log_ratio(a: Column, b: Column) -> Column:
    """``ln(a / b)``, null where the ratio is not positive or ``b`` is 0."""
    return F.ln(F.try_divide(a, b))


def weekly_returns(weeks: DataFrame, actions: DataFrame | None = None, rate: DataFrame | None = None) -> DataFrame:
    """Price, total and excess returns of weekly closes with the volatility of the last 26 weeks.

    ``weeks``: ``symbol``, ``week_start``, ``close``.  ``actions``: ``symbol``, ``d``, ``split_factor``,
    ``div_cash``, dividends being adjusted by later splits.  ``rate``: ``d``, ``value`` in per cent a year,
    read as of the Monday.
    """
    rows = weeks.filter(F.col("close").isNotNull()).select("symbol", "week_start", "close")
    if actions is None:
        rows = rows.withColumn("div_adj", F.lit(0.0))
    else:
        paid = split_factors(actions).filter(F.col("div_cash") > 0)
        by_week = paid.groupBy("symbol", week_start("d").alias("week_start")).agg(F.sum(F.col("div_cash") / F.col("adjust")).alias("div_adj"))
        rows = rows.join(by_week, ["symbol", "week_start"], "left").withColumn("div_adj", F.coalesce("div_adj", F.lit(0.0)))
    before = F.lag("close").over(_along(("symbol",), "week_start"))
    plain, total = F.try_divide("close", before), F.try_divide(F.col("close") + F.col("div_adj"), before)
    rows = rows.withColumns(
        {"price_simple_return": plain - 1, "price_log_return": F.ln(plain), "simple_return": total - 1, "log_return": F.ln(total)}
    )
    if rate is None:
        rows = rows.withColumn("annual_pct", F.lit(None).cast("double"))
    else:
        known = rate.select(F.col("d").alias("_rd"), F.col("value").alias("annual_pct"))
        rows = asof(rows, known, "week_start", "_rd", ["annual_pct"])
    growth = F.pow(1 + F.col("annual_pct") / 100, F.lit(7 / 365))
    rows = rows.withColumns({"rf_week": growth - 1, "excess_return": F.col("simple_return") - (growth - 1), "excess_log_return": F.col("log_return") - F.ln(growth)})
    return realized_vol(rows, "log_return", 26, 52, order="week_start", out="realized_vol_26w")


def stitch_windows(raw: DataFrame) -> DataFrame:
    """One 0-100 series from overlapping request windows, each on its own scale.

    ``raw``: ``term``, ``window_start``, ``d``, ``interest``.  Each window is scaled onto the one before by
    the ratio of their sums over shared dates; a date keeps its earliest window's value.
    """
    rows = raw.filter(F.col("interest").isNotNull())
    windows = rows.select("term", "window_start").distinct()
    numbered = windows.withColumn("wi", F.dense_rank().over(_along(("term",), "window_start")))
    placed = rows.join(numbered, ["term", "window_start"])
    before = placed.select("term", (F.col("wi") + 1).alias("wi"), "d", F.col("interest").alias("_before"))
    shared = placed.join(before, ["term", "wi", "d"]).groupBy("term", "wi").agg(F.try_divide(F.sum("_before"), F.sum("interest")).alias("factor"))
    scaled = numbered.join(shared, ["term", "wi"], "left")
    run = _along(("term",), "wi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scaled = scaled.withColumn("scale", F.exp(F.sum(F.ln(F.coalesce("factor", F.lit(1.0)))).over(run)))
    first = placed.groupBy("term", "d").agg(F.min_by(F.struct("interest", "wi"), "window_start").alias("f"))
    values = first.select("term", "d", F.col("f.interest").alias("interest"), F.col("f.wi").alias("wi")).join(scaled.select("term", "wi", "scale"), ["term", "wi"])
    values = values.withColumn("v", F.col("interest") * F.col("scale"))
    return values.select("term", "d", (100 * F.try_divide("v", F.max("v").over(Window.partitionBy("term")))).alias("interest"))


def yearly_growth(series: DataFrame, order: str = "d", value: str = "value", rows: int = 365, out: str = "yoy_log") -> DataFrame:
    """Log growth of one calendar series over ``rows`` rows.  The series has one row a date."""
    return series.withColumn(out, log_ratio(F.col(value), F.lag(value, rows).over(Window.partitionBy().orderBy(order))))


def cycle_features(df: DataFrame, day: str, supply: str, epochs: Sequence[str]) -> DataFrame:
    """Supply-cycle features; ``epochs`` are the dates at which the block subsidy halves."""
    e = F.lit(len(epochs))
    for i, at in reversed(list(enumerate(epochs))):
        e = F.when(F.col(day) < F.lit(at).cast("date"), i).otherwise(e)
    rows = df.withColumn("_e", e).withColumn("_subsidy", 50 / F.pow(F.lit(2.0), F.col("_e")))
    done = 21_000_000 * (1 - F.pow(F.lit(2.0), -F.col("_e")))
    rows = rows.withColumn("cycle_phase", F.try_divide(F.col(supply) - done, 210_000 * F.col("_subsidy")))
    turn = 2 * F.pi() * F.col("cycle_phase")
    return rows.withColumns(
        {"cycle_phase_sin": F.sin(turn), "cycle_phase_cos": F.cos(turn), "issuance_rate_ann": F.try_divide(52_560 * F.col("_subsidy"), F.col(supply))}
    ).drop("_e", "_subsidy")


def spread_features(df: DataFrame, long: str, short: str, rows: int, key: Sequence[str], order: str) -> DataFrame:
    """Term spread, its change over ``rows`` rows, and whether it is rising from below zero."""
    out = df.withColumn("spread", F.col(long) - F.col(short))
    old = F.lag("spread", rows).over(_along(key, order))
    return out.withColumns({"spread_chg_1m": F.col("spread") - old, "dis_inverting": F.coalesce((old < 0) & (F.col("spread") > old), F.lit(False))})


def training_daily(
    daily_rsi: DataFrame, weekly_rsi: DataFrame, score: DataFrame, series: Mapping[str, DataFrame], vintages: DataFrame, interest: DataFrame, epochs: Sequence[str]
) -> DataFrame:
    """Daily point-in-time features for every symbol; raw levels stay inside.

    ``daily_rsi``: ``symbol``, ``d``, ``close``, ``rsi`` over the whole series (warm-up included).
    ``series`` has calendar series ``dollar``, ``vix``, ``ten``, ``two``, ``supply``, ``addresses`` and
    ``transactions`` (``d``, ``value``); ``score`` (``d``, ``value``) is published a day late;
    ``interest`` (``d``, ``interest``) becomes known after its week.
    """
    logret = log_ratio(F.col("close"), F.lag("close").over(_along(("symbol",), "d")))
    px = realized_vol(daily_rsi.withColumn("_lr", logret), "_lr", 30, 365, out="realized_vol_30d")
    px = ema(px, 365, out="_ema").drop("_lr")
    base = settle(px.filter("rsi is not null"), "base")
    dollar = ema(series["dollar"].withColumn("_one", F.lit(1)), 365, key=("_one",), value="value", out="_dollar_ema")
    rights = {
        "_dollar": (dollar.select("d", F.col("value").alias("_dollar_value"), "_dollar_ema"), "d", ["_dollar_value", "_dollar_ema"]),
        "_addr": (yearly_growth(series["addresses"], out="active_addresses_yoy_log"), "d", ["active_addresses_yoy_log"]),
        "_tx": (yearly_growth(series["transactions"], out="tx_count_yoy_log"), "d", ["tx_count_yoy_log"]),
        "_interest": (interest.select(F.date_add("d", 7).alias("_known"), F.col("interest").alias("investor_attention")), "_known", ["investor_attention"]),
    } | {f"_{n}": (series[n].select("d", F.col("value").alias(n)), "d", [n]) for n in ("vix", "ten", "two", "supply")}
    # What does not depend on the symbol is found once a date, then joined to all symbols.
    dates = base.select("d").distinct()
    dates = offset_join(dates, score.select(F.col("d").alias("_sd"), F.col("value").alias("score")), "d", "_sd", 1, ["score"])
    dates = settle(asof_many(settle(dates, "days"), rights, "d"), "dates")
    dates = vintage_asof(dates, vintages, "d", "obs", "rs", "re", "value", {"_m": 0, "_m52": 364, "_m13": 91})
    weeks = weekly_rsi.filter("rsi is not null").select("symbol", F.date_add("week_start", 7).alias("_next"), F.col("rsi").alias("rsi_weekly"))
    rows = asof(base, weeks, "d", "_next", ["rsi_weekly"], by=["symbol"]).join(dates, "d")
    rows = cycle_features(rows, "d", "supply", epochs)
    rows = spread_features(rows, "ten", "two", 30, ("symbol",), "d")
    return rows.select(
        "symbol", "d", "rsi", "rsi_weekly", "score", "vix", (F.try_divide("close", "_ema") - 1).alias("price_vs_ema365"),
        (F.try_divide("_dollar_value", "_dollar_ema") - 1).alias("dollar_vs_ema365"), "realized_vol_30d",
        log_ratio(F.col("_m"), F.col("_m52")).alias("m2_yoy_log"), (F.pow(F.try_divide("_m", "_m13"), F.lit(4.0)) - 1).alias("m2_roc_13w_ann"),
        (F.col("ten") - F.lag("ten", 30).over(_along(("symbol",), "d"))).alias("ten_chg_30d"), "spread", "spread_chg_1m", "dis_inverting",
        "cycle_phase", "cycle_phase_sin", "cycle_phase_cos", "issuance_rate_ann", "active_addresses_yoy_log", "tx_count_yoy_log", "investor_attention",
    )


def training_weekly(weekly_rsi: DataFrame, score: DataFrame, series: Mapping[str, DataFrame], vintages: DataFrame) -> DataFrame:
    """Weekly point-in-time features: everything as known on the week's Sunday."""
    base = settle(weekly_rsi.filter("rsi is not null").select("symbol", "week_start", F.date_add("week_start", 6).alias("week_end"), "close", "rsi"), "base")
    rights = {f"_{n}": (series[n].select("d", F.col("value").alias(n)), "d", [n]) for n in ("dollar", "ten", "two", "funds")}
    dates = settle(asof_many(base.select("week_end").distinct(), rights, "week_end"), "dates")
    dates = vintage_asof(dates, vintages, "week_end", "obs", "rs", "re", "value", {"m2": 0})
    score = score.select(F.col("d").alias("_sd"), F.col("value").alias("score"))
    rows = offset_join(base.join(dates, "week_end"), score, "week_start", "_sd", 7, ["score"])
    return spread_features(rows, "ten", "two", 4, ("symbol",), "week_start")


def monitor_daily(training: DataFrame, bars: DataFrame, levels: Mapping[str, DataFrame]) -> DataFrame:
    """Closes and the ``levels`` of the day (``d``, ``value`` each) beside the features that a monitor plots, for every symbol."""
    features = ["rsi_weekly", "score", "vix", "realized_vol_30d", "price_vs_ema365", "investor_attention", "active_addresses_yoy_log", "tx_count_yoy_log"]
    rows = training.select("symbol", "d", F.col("rsi").alias("rsi_daily"), *features).join(bars.select("symbol", "d", "close"), ["symbol", "d"])
    for name, df in levels.items():
        rows = rows.join(df.select("d", F.col("value").alias(name)), "d", "left")
    return rows
