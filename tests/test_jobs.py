"""The daily jobs end to end on a small catalogue: a replay changes nothing, a range of days extends what is there."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marlspike.operators import backtest, experiments, scan
from marlspike.plans import catalogue, jobs
from marlspike.schemas import TABLES
from marlspike.sources import market
from marlspike.sources.tables import Catalog

RUN = datetime(2024, 1, 1)
UNIVERSE = {"1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"}


@pytest.fixture(scope="module")
def catalog(spark, small, tmp_path_factory):
    c = Catalog(spark, str(tmp_path_factory.mktemp("catalogue")))
    bars = market.bars(spark, small).filter("d < date'1996-07-01'")
    prices = bars.select("symbol", F.col("d").alias("candle_date"), *(F.col(b).alias(a) for a, b in jobs.PRICES.items()))
    c.upsert("bronze.exchange_a", prices.filter(F.dayofmonth("candle_date") % 7 != 3))
    c.upsert("bronze.exchange_b", prices)
    c.seed("control.source_priority", spark.createDataFrame([(1, "a", 2), (2, "b", 1)], TABLES["control.source_priority"].schema))
    c.seed("strategy.rsi_params", spark.createDataFrame([(1, True, 14, 40.0, 70.0, 30.0, 70.0)], TABLES["strategy.rsi_params"].schema))
    c.seed("strategy.momentum_params", spark.createDataFrame([(1, True, 8, 0.1, 26, 52, None, "inverse_vol", 0.2)], TABLES["strategy.momentum_params"].schema))
    return c


def table(catalog, name):
    return sorted(str(tuple(r)) for r in catalog.read(name).drop("datetime_update").collect())


def test_jobs_replay_and_resume(spark, catalog):
    sources = jobs.bronze_sources(catalog, {1: "bronze.exchange_a", 2: "bronze.exchange_b"})
    first, cut, last = date(1995, 1, 1), date(1996, 4, 1), date(1996, 6, 30)
    jobs.run_rsi_signals(catalog, sources, first, date(1996, 3, 31), RUN)
    jobs.run_rsi_signals(catalog, sources, cut, last, RUN)
    got = {n: table(catalog, n) for n in ("silver.candles", "silver.rsi", "gold.signals")}
    jobs.run_rsi_signals(catalog, sources, cut, last, RUN)
    assert got == {n: table(catalog, n) for n in got}
    stored = catalog.read("silver.rsi").filter("temporality = '1d'").select("symbol", F.to_date("period_start").alias("d"), F.round("avg_gain", 9), F.round("avg_loss", 9))
    whole = scan.wilder_rsi(jobs.read_daily(catalog).select("symbol", "d", "close"), 14).select("symbol", "d", F.round("avg_gain", 9), F.round("avg_loss", 9))
    assert stored.exceptAll(whole).count() == 0 and whole.exceptAll(stored).count() == 0
    chosen = catalog.read("silver.candles").filter("temporality = '1d'").groupBy("source_id").count().collect()
    assert {r["source_id"] for r in chosen} == {1, 2}


def test_momentum_job(spark, catalog):
    rate = spark.createDataFrame([(date(1995, 1, 1), 5.0)], "d date, value double")
    for _ in range(2):
        jobs.run_momentum(catalog, None, rate, frozenset({"1-URGENT"}), RUN, UNIVERSE)
        now = table(catalog, "gold.weights")
    assert now == table(catalog, "gold.weights") and len(now) > 0
    rsi_rows = catalog.read("gold.signals").filter(F.col("strategy_id") == jobs.RSI_STRATEGY).count()
    assert rsi_rows > 0  # the other strategy's rows stay
    gross = catalog.read("gold.weights").groupBy("week_start", "include_capped").agg(F.sum(F.abs("weight")).alias("g")).collect()
    assert all(r["g"] <= 1 + 1e-9 for r in gross)
    assert {r[0] for r in catalog.read("gold.weights").select("symbol").distinct().collect()} == UNIVERSE  # the fifth symbol is no part of it
    with pytest.raises(ValueError):
        jobs.run_momentum(catalog, None, rate, frozenset(), RUN, set())


def test_late_bars_come_in_with_the_next_run(spark, small, tmp_path):
    c = Catalog(spark, str(tmp_path))
    c.seed("control.source_priority", spark.createDataFrame([(1, "a", 2)], TABLES["control.source_priority"].schema))
    c.seed("strategy.rsi_params", spark.createDataFrame([(1, True, 2, 40.0, 70.0, 30.0, 70.0)], TABLES["strategy.rsi_params"].schema))
    day = lambda i: date(2024, 1, i)
    bar = lambda i, p: ("s", day(i), p, p, p, p, 1.0)
    frame = lambda *rows: {1: spark.createDataFrame(rows, "symbol string, d date, open double, high double, low double, close double, volume double")}
    jobs.run_rsi_signals(c, frame(bar(1, 10.0), bar(2, 8.0), bar(4, 9.0)), day(1), day(4), RUN)
    jobs.run_rsi_signals(c, frame(bar(1, 10.0), bar(2, 8.0), bar(3, 12.0), bar(4, 9.0), bar(5, 9.5)), None, None, datetime(2024, 1, 6))  # yesterday, and three days before
    assert sorted(r["d"].day for r in jobs.read_daily(c).collect()) == [1, 2, 3, 4, 5]
    whole = scan.wilder_rsi(jobs.read_daily(c).select("symbol", "d", "close"), 2)
    stored = c.read("silver.rsi").filter("temporality = '1d'").select("symbol", F.to_date("period_start").alias("d"), "avg_gain")
    for r in whole.join(stored.withColumnRenamed("avg_gain", "g"), ["symbol", "d"]).collect():
        assert r["g"] == pytest.approx(r["avg_gain"])


def test_landing_jobs(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    raw = lambda text: spark.createDataFrame([(text,)], "payload string")
    ms = 86_400_000
    bad = jobs.land(c, "bronze.exchange_a", spark.createDataFrame([(f"[[{19000 * ms},1,2,1,2,5],[{19003 * ms},1,2,1,3,5],[{19722 * ms},1,2,1,4,5],[{19723 * ms},9,9,9,9,9]]",), ("no",)], "payload string"), RUN)
    assert [r["price_close"] for r in c.read("bronze.exchange_a").orderBy("candle_date").collect()] == [2.0, 3.0, 4.0] and bad.count() == 1  # the day of the run is open
    jobs.land(c, "bronze.eod_etf", spark.createDataFrame([('[{"date":"2023-05-01","close":2,"splitFactor":1,"divCash":0},{"date":"2024-01-01","close":3}]', "x")], "payload string, symbol string"), RUN)
    jobs.land(c, "bronze.chart_etf", raw('{"chart":{"result":[{"timestamp":[1683000000],"indicators":{"quote":[{"close":[3]}]}}]}}'), RUN, date(2023, 5, 4))
    assert c.read("bronze.eod_etf").count() == 1 and c.read("bronze.chart_etf").count() == 1  # 2 May lies in the days that are taken again
    for table, text, day in (
        ("bronze.rate_10y", '{"observations":[{"date":"2023-05-01","value":"3.5"},{"date":"2023-05-02","value":"."}]}', "obs_date"),
        ("bronze.supply", '{"data":[{"time":"2023-05-01","SplyCur":"7.5"},{"time":"2023-05-02","SplyCur":""}]}', "metric_date"),
        ("bronze.valuation_score", "d,t,v\n2023-05-01,1,0.5\n2023-05-02,2,NaN", "d"),
        ("bronze.dollar_index", '{"chart":{"result":[{"timestamp":[1682942400,1704067200],"indicators":{"quote":[{"close":[101,102]}]}}]}}', "d"),
    ):
        gone = jobs.land(c, table, raw(text), RUN)
        rows = c.read(table).collect()
        assert [r[day] for r in rows] == [date(2023, 5, 1)] and gone.count() == (0 if table.endswith("index") else 1), table
    vintage = lambda end: raw(f'{{"observations":[{{"realtime_start":"2023-01-10","realtime_end":"{end}","date":"2023-01-02","value":"5"}}]}}')
    jobs.land_vintages(c, vintage("9999-12-31"), 1, RUN)
    jobs.land_vintages(c, vintage("2023-02-01"), 1, RUN)
    assert [r["re"] for r in c.read("bronze.money_vintages").collect()] == [date(2023, 2, 1)]
    weeks = spark.createDataFrame([("2024-01-01", "12", False), ("2024-01-08", None, False), ("2024-01-15", "56", True)], "date string, interest string, is_partial boolean")
    assert jobs.land_interest(c, weeks, "t", date(2024, 1, 1), 1, RUN).count() == 1 and [r["interest"] for r in c.read("bronze.interest").collect()] == [12]


def test_runs_are_added_to_the_ledger_once(spark, small, tmp_path):
    c = Catalog(spark, str(tmp_path))
    returns, costs = catalogue._returns(spark, small), catalogue._costs(spark)
    cfg = experiments.GridConfig(passive=catalogue.PASSIVE, split=backtest.SplitConfig(min_train=60, n_splits=2), multipliers=(1.0, 2.0))
    for _ in range(2):
        rows = jobs.run_experiments(c, returns, costs, cfg, "r1", RUN, "first")
        assert rows.count() == 8
    jobs.run_experiments(c, returns, costs, cfg, "r2", RUN)
    ledger = c.read("strategy.experiment_runs")
    assert ledger.count() == 16 and ledger.filter("gate_t_hac is not null").count() == 2 and ledger.filter("n_folds = 2").count() == 16
    gate = ledger.filter("gate_n_obs is not null and run_id = 'r1'").first()
    assert (gate["strategy"], gate["cost_mult"], gate["gate_max_lag"]) == ("momentum", 1.0, 52) and '"horizon": 52' in gate["params"]
    with pytest.raises(ValueError):
        experiments.GridConfig(passive={}, multipliers=(2.0,))
