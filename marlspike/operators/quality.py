"""Data-quality checks as aggregates; each returns counts, so a clean table gives zeros."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.operators.blocks import last_known
from marlspike.operators.candles import weekly_candles

_BAR = {"not above zero": "price_close <= 0", "high below low": "price_high < price_low", "negative volume": "volume_traded < 0"}
#: Conditions under which a row of a table fails, by the check's name.
RULES: dict[str, dict[str, str]] = {
    **{f"bronze.{n}": _BAR for n in ("exchange_a", "exchange_b", "chart_etf", "eod_etf")},
    "bronze.interest": {"outside 0 to 100": "interest not between 0 and 100"},
    "bronze.money_vintages": {"ends before its start": "re < rs", "known before it was": "rs < obs"},
    "silver.candles": {
        "high below low": "high < low", "close outside": "close not between low and high", "negative volume": "volume < 0", "unknown temporality": "temporality not in ('1d', '1w')",
        "week not from Monday": "temporality = '1w' and weekday(period_start) <> 0", "week not of seven days": "temporality = '1w' and datediff(period_end, period_start) <> 6",
    },
    "silver.rsi": {"outside 0 to 100": "rsi not between 0 and 100", "negative average": "avg_gain < 0 or avg_loss < 0"},
    "gold.signals": {"unknown signal": "signal not in ('BUY', 'SELL', 'NEUTRAL')", "unreadable parameters": "trigger_params is null or try_parse_json(trigger_params) is null"},
    "gold.weights": {"more than everything": "abs(weight) > 1 + 1e-9", "week not from Monday": "weekday(week_start) <> 0"},
}
#: Tables whose days must follow each other: the columns that tell the series apart, the day, and the most days between two.
GAPS: dict[str, tuple[tuple[str, ...], str, int]] = {
    "bronze.exchange_a": (("symbol",), "candle_date", 1), "bronze.exchange_b": (("symbol",), "candle_date", 1), "bronze.chart_etf": (("symbol",), "candle_date", 5),
    "bronze.eod_etf": (("symbol",), "candle_date", 5), "silver.candles": (("symbol", "temporality"), "period_start", 7), "silver.rsi": (("symbol", "temporality", "rsi_period"), "period_start", 7),
}


def table_checks(
    rows: DataFrame, key: Sequence[str], rules: Mapping[str, str] | None = None, gap: tuple[Sequence[str], str, int] | None = None
) -> DataFrame:
    """``check_name``, ``n_rows`` and ``n_failing`` of all checks of a table, in one pass: repeated keys (rows too many), nulls in keys, ``rules``, gaps.

    A condition that is null does not fail.
    """
    failing = {"null in key": " or ".join(f"{k} is null" for k in key), **(rules or {})}
    if gap is not None:
        series, day, most = gap
        rows = last_known(rows, series, [day], {"_before": F.col(day)})
        failing["gap"] = f"datediff({day}, _before) > {most}"
    counts = rows.agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count_distinct(F.struct(*key))).alias("c"), *(F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(failing.values()))
    )
    named = [F.struct(F.lit(n).alias("check_name"), F.col("n").alias("n_rows"), F.col(c).alias("n_failing")) for n, c in (("repeated key", "c"), *((n, f"c{i}") for i, n in enumerate(failing)))]
    return counts.select(F.inline(F.array(*named)))


def week_checks(weeks: DataFrame) -> DataFrame:
    """Weeks not starting on Monday, or not ending six days later."""
    return weeks.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.dayofweek("week_start") != 2).alias("not_monday"), F.count_if(F.col("week_end") != F.date_add("week_start", 6)).alias("bad_end"))


def weekly_matches_daily(weeks: DataFrame, daily: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Weeks whose bar differs from its days', or that only one side has."""
    again = weekly_candles(daily).select("symbol", "week_start", *(F.col(c).alias(f"_{c}") for c in ("open", "high", "low", "close", "volume")))
    both = weeks.join(again, ["symbol", "week_start"], "full")
    same = F.lit(True)
    for c in ("open", "high", "low", "close", "volume"):
        same = same & (F.abs(F.col(c) - F.col(f"_{c}")) <= tolerance * F.greatest(F.abs(c), F.lit(1.0)))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differing"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys two sources share."""
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "left_semi").agg(F.count(F.lit(1)).alias("shared"))


def coverage(df: DataFrame, day: str = "d", key: Sequence[str] = ("symbol",)) -> DataFrame:
    """First and last date, days missing, share of weekdays covered, and the longest gap of each key."""
    days = df.select(*key, F.col(day).alias("_d")).distinct()
    gap = F.datediff("_d", F.lag("_d").over(Window.partitionBy(*key).orderBy("_d")))
    weekday = F.dayofweek("_d").between(2, 6)
    a = days.withColumn("_gap", gap).groupBy(*key).agg(
        F.min("_d").alias("first_day"), F.max("_d").alias("last_day"), F.count(F.lit(1)).alias("days"), F.count_if(weekday).alias("weekdays"), F.max("_gap").alias("max_gap")
    )
    span = F.datediff("last_day", "first_day") + 1
    possible = F.size(F.filter(F.sequence("first_day", "last_day"), lambda x: F.dayofweek(x).between(2, 6)))
    return a.select(*key, "first_day", "last_day", "days", (span - F.col("days")).alias("missing_days"), F.try_divide("weekdays", possible).alias("weekday_coverage"), "max_gap")


def rsi_checks(rsi: DataFrame, period: int, key: Sequence[str] = ("symbol",), order: str = "d") -> DataFrame:
    """Warm-up rows that are not exactly the first ``period``, and values outside 0 to 100."""
    i = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    rows = rsi.withColumn("_i", i)
    wrong = F.col("rsi").isNull() != (F.col("_i") <= period)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("bad_warm_up"), F.count_if((F.col("rsi") < 0) | (F.col("rsi") > 100)).alias("out_of_range"))


def signal_checks(signals: DataFrame, bars: DataFrame) -> DataFrame:
    """Signals without a bar, of an unknown value, or with unreadable parameters."""
    orphans = signals.join(bars.select("symbol", "d").distinct(), ["symbol", "d"], "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    unknown = ~F.col("signal").isin("BUY", "SELL", "NEUTRAL")
    rest = signals.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(unknown).alias("unknown"), F.count_if(F.get_json_object("trigger_params", "$.rsi").isNull()).alias("unreadable")
    )
    return rest.join(orphans)
