"""Parsing of raw payload files into typed rows.

Every parser takes a frame with one payload a row (``payload``, JSON or CSV text) and returns
``(rows, rejects)``: what could be read, and the payloads that could not.  Other columns of the
payload rows are carried into both; a ``symbol`` column among them names each payload's symbol
in place of the parser's own.

:func:`land` takes the payloads of a configured source and loses none: what it does not land comes back as missing values
(a bar without a close, an observation without a number) or as rejects (what could not be read), which
:func:`quarantined` turns into rows of the quarantine table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Parsed = tuple[DataFrame, DataFrame]


class Landed(NamedTuple):
    """Rows to land, rows without a value, and payloads that could not be read."""

    rows: DataFrame
    missing: DataFrame
    rejects: DataFrame


DAY_MS = 86_400_000


@dataclass(frozen=True)
class CandleSource:
    """An exchange or quote source of candles."""

    table: str
    symbol: str
    source_id: int


@dataclass(frozen=True)
class BarSource:
    """A source of daily bars: payloads of end-of-day arrays (``eod``) or charts (``chart``)."""

    table: str
    symbol: str
    source_id: int
    shape: str = "eod"


@dataclass(frozen=True)
class SeriesSource:
    """A series: the metric's name in the payload, where it lands, and its payload's shape.

    ``shape`` is ``pages`` (metric cells), ``observations``, ``csv`` or ``dollar``; ``whole`` values are
    rounded half to even.
    """

    table: str
    metric: str
    source_id: int
    whole: bool = False
    shape: str = "pages"


def raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as payloads."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))


def _carried(raw: DataFrame) -> list[str]:
    """Columns of payload rows besides the payload."""
    return [c for c in raw.columns if c != "payload"]


def _with_symbol(raw: DataFrame, symbol: str) -> DataFrame:
    """Payload rows with a symbol: their own, or else ``symbol``."""
    return raw if "symbol" in raw.columns else raw.withColumn("symbol", F.lit(symbol))


def _number(text: Column) -> Column:
    """A number; ``.``, empty and NaN are missing, anything else must parse."""
    t = F.trim(text)
    return F.when(F.lower(t).isin("", ".", "nan"), None).otherwise(t.cast("double"))


def parse_candles(raw: DataFrame, cfg: CandleSource) -> Parsed:
    """Arrays of ``[open_ms, open, high, low, close, volume]``; the date is the UTC date of the opening."""
    raw = _with_symbol(raw, cfg.symbol)
    rest = _carried(raw)
    rows = raw.withColumn("c", F.from_json("payload", "array<array<double>>"))
    bad = rows.filter("c is null").select(*rest, "payload")
    x = rows.filter("c is not null").select(*rest, F.explode("c").alias("x"))
    names = ("price_open", "price_high", "price_low", "price_close", "volume_traded")
    out = x.select(
        *rest, F.to_date(F.timestamp_millis(F.col("x")[0].cast("long"))).alias("candle_date"),
        *(F.col("x")[i + 1].alias(n) for i, n in enumerate(names)), F.lit(cfg.source_id).cast("long").alias("source_id"), F.col("x")[0].cast("long").alias("open_ms"),
    )
    return out, bad


def closed_candles(rows: DataFrame, as_of_ms: int) -> DataFrame:
    """Candles whose day is over at ``as_of_ms``."""
    return rows.filter(F.col("open_ms") + DAY_MS <= as_of_ms)


def _priced(parsed: Parsed) -> Parsed:
    """Bars with a close and a date."""
    rows, bad = parsed
    return rows.filter("price_close is not null and candle_date is not null"), bad


def parse_chart(raw: DataFrame, symbol: str, source_id: int) -> Parsed:
    """Parallel arrays of a chart payload; bars without a close are skipped, payloads with an error are rejected."""
    return _priced(chart_bars(raw, symbol, source_id))


def chart_bars(raw: DataFrame, symbol: str, source_id: int) -> Parsed:
    """The same with the bars that have no close."""
    numbers = "open:array<double>,high:array<double>,low:array<double>,close:array<double>,volume:array<double>"
    shape = f"struct<chart:struct<error:string,result:array<struct<timestamp:array<bigint>,indicators:struct<quote:array<struct<{numbers}>>>>>>>"
    raw = _with_symbol(raw, symbol)
    rest = _carried(raw)
    rows = raw.withColumn("j", F.from_json("payload", shape)).withColumn("r", F.get("j.chart.result", F.lit(0)))
    ok = F.col("r").isNotNull() & F.col("j.chart.error").isNull()
    q = F.get("r.indicators.quote", F.lit(0))
    none = F.array().cast("array<double>")  # a missing array must not void the others
    zipped = F.arrays_zip(F.col("r.timestamp").alias("t"), *(F.coalesce(q[n], none).alias(n) for n in ("open", "high", "low", "close", "volume")))
    bars = rows.filter(ok).select(*rest, F.explode(zipped).alias("_b"))
    bars = bars.select(*rest, *(F.col(f"_b.{n}").alias(f"_{n}") for n in ("t", "open", "high", "low", "close", "volume")))
    out = bars.select(
        *rest, F.to_date(F.timestamp_seconds("_t")).alias("candle_date"), F.col("_open").alias("price_open"), F.col("_high").alias("price_high"),
        F.col("_low").alias("price_low"), F.col("_close").alias("price_close"), F.col("_volume").alias("volume_traded"), F.lit(source_id).cast("long").alias("source_id"),
    )
    return out, rows.filter(~ok).select(*rest, "payload")


def parse_dollar_index(raw: DataFrame, source_id: int) -> Parsed:
    """Chart payloads of the dollar index: ``d`` and the bar's prices, the date being the key; bars without a close are skipped."""
    rows, bad = dollar_bars(raw, source_id)
    return rows.filter("price_close is not null and d is not null"), bad


def dollar_bars(raw: DataFrame, source_id: int) -> Parsed:
    """The same with the bars that have no close."""
    rows, bad = chart_bars(raw, "dollar", source_id)
    return rows.drop("symbol").withColumnRenamed("candle_date", "d"), bad.drop("symbol")


def parse_eod(raw: DataFrame, symbol: str, source_id: int) -> Parsed:
    """Arrays of end-of-day bars with split factor and dividend; bars without a close are skipped, an error object is rejected."""
    return _priced(eod_bars(raw, symbol, source_id))


def eod_bars(raw: DataFrame, symbol: str, source_id: int) -> Parsed:
    """The same with the bars that have no close."""
    shape = "array<struct<date:string,open:double,high:double,low:double,close:double,volume:double,splitFactor:double,divCash:double>>"
    raw = _with_symbol(raw, symbol)
    rest = _carried(raw)
    rows = raw.withColumn("is_list", F.ltrim("payload").startswith("[")).withColumn("j", F.when(F.col("is_list"), F.from_json("payload", shape)))
    bars = rows.filter("j is not null").select(*rest, F.explode("j").alias("_b"))
    out = bars.select(
        *rest, F.to_date(F.substring("_b.date", 1, 10)).alias("candle_date"), F.col("_b.open").alias("price_open"), F.col("_b.high").alias("price_high"),
        F.col("_b.low").alias("price_low"), F.col("_b.close").alias("price_close"), F.col("_b.volume").alias("volume_traded"), F.col("_b.splitFactor").alias("split_factor"),
        F.col("_b.divCash").alias("div_cash"), F.lit(source_id).cast("long").alias("source_id"),
    )
    return out, rows.filter("j is null").select(*rest, "payload")


def parse_observations(raw: DataFrame, source_id: int) -> Parsed:
    """Macro observations: ``obs_date``, ``obs_value``."""
    rest = _carried(raw)
    rows = raw.withColumn("j", F.from_json("payload", "observations array<struct<date:string,value:string>>"))
    out = rows.filter("j.observations is not null").select(*rest, F.explode("j.observations").alias("_o"))
    out = out.select(*rest, F.to_date("_o.date").alias("obs_date"), _number(F.col("_o.value")).alias("obs_value"), F.lit(source_id).cast("long").alias("source_id"))
    return out, rows.filter("j.observations is null").select(*rest, "payload")


def parse_vintages(raw: DataFrame, source_id: int) -> Parsed:
    """Macro observations with the dates on which each value was known; open ends are 9999-12-31."""
    rest = _carried(raw)
    rows = raw.withColumn("j", F.from_json("payload", "observations array<struct<realtime_start:string,realtime_end:string,date:string,value:string>>"))
    out = rows.filter("j.observations is not null").select(*rest, F.explode("j.observations").alias("_o"))
    out = out.select(
        *rest, F.to_date("_o.date").alias("obs"), F.to_date("_o.realtime_start").alias("rs"), F.coalesce(F.to_date("_o.realtime_end"), F.lit(date(9999, 12, 31))).alias("re"),
        _number(F.col("_o.value")).alias("value"), F.lit(source_id).cast("long").alias("source_id"),
    )
    return out, rows.filter("j.observations is null").select(*rest, "payload")


def parse_metric_pages(raw: DataFrame, cfg: SeriesSource) -> Parsed:
    """Pages of metric cells, the metric's name being configured."""
    rest = _carried(raw)
    rows = raw.withColumn("j", F.from_json("payload", "data array<map<string,string>>"))
    cells = rows.filter("j.data is not null").select(*rest, F.explode("j.data").alias("_m"))
    value = _number(F.element_at("_m", cfg.metric))
    value = F.bround(value, 0).cast("long") if cfg.whole else value
    out = cells.select(*rest, F.to_date(F.substring(F.element_at("_m", "time"), 1, 10)).alias("metric_date"), value.alias("metric_value"), F.lit(cfg.source_id).cast("long").alias("source_id"))
    return out, rows.filter("j.data is null").select(*rest, "payload")


def parse_metric_csv(raw: DataFrame, source_id: int) -> Parsed:
    """Lines ``date,unix time,value`` under a header; lines of fewer fields or without a date are rejected, empty ones skipped."""
    lines = raw.select(F.posexplode(F.split("payload", r"\r?\n")).alias("_at", "line")).withColumn("f", F.split("line", ","))
    day = F.try_to_date(F.trim(F.col("f")[0]), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.expr("try_cast(trim(f[0]) as date)")
    kept = lines.filter(F.size("f") >= 3).withColumn("d", day)
    out = kept.filter("d is not null").select("d", _number(F.col("f")[2]).alias("value"), F.lit(source_id).cast("long").alias("source_id"))
    undated = (F.size("f") >= 3) & (F.col("_at") > 0) & day.isNull()
    return out, lines.filter(((F.size("f") < 3) & (F.trim("line") != "")) | undated).select(F.col("line").alias("payload"))


def parse_interest(rows: DataFrame, term: str | Column, window_start: date | Column, source_id: int) -> DataFrame:
    """Weekly interest of a request window (or of several, whose terms and windows are columns); partial weeks are dropped, values rounded half to even."""
    full = rows.filter(~F.coalesce("is_partial", F.lit(False)))
    return full.select(
        F.lit(term).alias("term"), F.lit(window_start).cast("date").alias("window_start"), F.to_date("date").alias("d"),
        F.bround(_number(F.col("interest").cast("string")), 0).cast("long").alias("interest"), F.lit(source_id).cast("long").alias("source_id"),
    )


def before(rows: DataFrame, day: str, as_of: date) -> DataFrame:
    """Bars of days that are over."""
    return rows.filter(F.col(day) < F.lit(as_of))


def run_range(start: date | None, end: date | None, today: date) -> tuple[date, date]:
    """The days of a run: by default yesterday, and from ``start`` that one day; an end before its start is an error."""
    start = start or today - timedelta(days=1)
    end = end or start
    if end < start:
        raise ValueError("the end lies before the start")
    return start, end


def in_range(rows: DataFrame, day: str, start: date | None, end: date | None = None) -> DataFrame:
    """Rows from ``start`` to ``end``, by default that one day; an end before its start is an error."""
    if start is None:
        return rows
    end = end or start
    if end < start:
        raise ValueError("the end lies before the start")
    return rows.filter(F.col(day).between(F.lit(start), F.lit(end)))


def split_missing(rows: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a value, and those without, which are reported and never made up."""
    gone = F.col(value).isNull() | F.isnan(F.col(value).cast("double"))
    return rows.filter(~gone), rows.filter(gone)


def backfill(rows: DataFrame, corrections: DataFrame, day: str, value: str) -> DataFrame:
    """Corrections (``day``, ``correction``) where the value is missing, and only there."""
    return rows.join(corrections, day, "left").withColumn(value, F.coalesce(value, "correction")).drop("correction")


def request_windows(spark: SparkSession, start: date, end: date, days: int, overlap: int) -> DataFrame:
    """Overlapping windows that cover ``start`` to ``end``; the first that reaches the end is the last."""
    step = days - overlap
    if step <= 0:
        raise ValueError("windows must be longer than their overlap")
    count = max(0, -(-((end - start).days - days) // step)) + 1
    rows = spark.range(count).select(F.date_add(F.lit(start), (F.col("id") * step).cast("int")).alias("window_start"))
    return rows.select("window_start", F.least(F.date_add("window_start", days), F.lit(end)).alias("window_end"))


def resume_points(interest: DataFrame) -> DataFrame:
    """The latest window stored for each term: where its next request begins."""
    return interest.groupBy("term").agg(F.max("window_start").alias("window_start"))


def _stamped(rows: DataFrame, as_of: datetime | None) -> DataFrame:
    return rows.withColumn("datetime_update", F.lit(as_of).cast("timestamp"))


def _series(raw: DataFrame, cfg: SeriesSource) -> tuple[str, str, Parsed]:
    """Day and value columns of a series, and its parsed payloads."""
    if cfg.shape == "observations":
        return "obs_date", "obs_value", parse_observations(raw, cfg.source_id)
    if cfg.shape == "csv":
        return "d", "value", parse_metric_csv(raw, cfg.source_id)
    if cfg.shape == "dollar":
        return "d", "price_close", dollar_bars(raw, cfg.source_id)
    return "metric_date", "metric_value", parse_metric_pages(raw, cfg)


def land(raw: DataFrame, cfg: CandleSource | BarSource | SeriesSource, start: date | None, end: date | None, as_of: datetime | None) -> Landed:
    """What a source's payloads hold of a range of days: closed candles and bars, values, and what cannot be landed."""
    if isinstance(cfg, CandleSource):
        day, value, (rows, bad) = "candle_date", "price_close", parse_candles(raw, cfg)
        rows = closed_candles(rows, int(as_of.timestamp() * 1000)).drop("open_ms")
    elif isinstance(cfg, BarSource):
        day, value, (rows, bad) = "candle_date", "price_close", (eod_bars if cfg.shape == "eod" else chart_bars)(raw, cfg.symbol, cfg.source_id)
        rows = before(rows, day, as_of.date())
    else:
        day, value, (rows, bad) = _series(raw, cfg)
        rows = before(rows, day, as_of.date()) if cfg.shape == "dollar" and as_of else rows
    kept, gone = split_missing(in_range(rows, day, start, end), value)
    return Landed(_stamped(kept, as_of), gone, bad)


def land_series(raw: DataFrame, cfg: SeriesSource, start: date | None = None, end: date | None = None, as_of: datetime | None = None) -> Parsed:
    """Values of a date range and the rows without a value."""
    landed = land(raw, cfg, start, end, as_of)
    return landed.rows, landed.missing


def vintages(raw: DataFrame, source_id: int, as_of: datetime | None = None) -> Landed:
    """Vintages with a value, those without, and what could not be read."""
    rows, bad = parse_vintages(raw, source_id)
    kept, gone = split_missing(rows, "value")
    return Landed(_stamped(kept, as_of), gone, bad)


def land_vintages(raw: DataFrame, source_id: int, as_of: datetime | None = None) -> Parsed:
    """Vintages with a value, and those without."""
    return vintages(raw, source_id, as_of)[:2]


def quarantined(source: str, landed: Landed, run_at: datetime) -> DataFrame:
    """What was not landed, one row a source, content and reason (``unreadable`` or ``missing``), however often it comes."""
    gone = landed.missing.select(F.lit("missing").alias("reason"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"))
    bad = landed.rejects.select(F.lit("unreadable").alias("reason"), F.coalesce("payload", F.lit("")).alias("payload"))
    rows = gone.unionByName(bad).withColumn("payload_hash", F.sha2("payload", 256)).dropDuplicates(["payload_hash", "reason"])
    return rows.select(F.lit(source).alias("source"), "payload_hash", "reason", "payload", F.lit(run_at).cast("timestamp").alias("datetime_update"))


def land_interest(rows: DataFrame, term: str | Column, window_start: date | Column, source_id: int, as_of: datetime | None = None) -> Parsed:
    """Whole weeks of one request window with a value, and those without."""
    kept, gone = split_missing(parse_interest(rows, term, window_start, source_id), "interest")
    return _stamped(kept, as_of), gone


SOURCES: dict[str, CandleSource | BarSource | SeriesSource] = {
    s.table: s
    for s in (
        CandleSource("bronze.exchange_a", "BTCUSD", 1), CandleSource("bronze.exchange_b", "BTCUSD", 2),
        SeriesSource("bronze.rate_10y", "value", 3, shape="observations"), SeriesSource("bronze.rate_2y", "value", 4, shape="observations"),
        SeriesSource("bronze.rate_funds", "value", 5, shape="observations"), SeriesSource("bronze.volatility_index", "value", 6, shape="observations"),
        SeriesSource("bronze.supply", "SplyCur", 7, True), SeriesSource("bronze.active_addresses", "AdrActCnt", 8, True), SeriesSource("bronze.transactions", "TxCnt", 9, True),
        SeriesSource("bronze.valuation_score", "value", 10, shape="csv"), SeriesSource("bronze.dollar_index", "price_close", 11, shape="dollar"),
        BarSource("bronze.chart_etf", "", 12, "chart"), BarSource("bronze.eod_etf", "", 13, "eod"),
    )
}
