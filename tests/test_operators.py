"""Hand-worked numbers, invariants and sequential references for the market operators."""

import math
import random
import re
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marlspike.operators import asof, backtest, candles, features, portfolio, quality, scan, signals, stats

DAY = date(2024, 1, 1)


def days(spark, values, symbol="s", name="close"):
    return spark.createDataFrame([(symbol, DAY + timedelta(days=i), float(v) if v is not None else None) for i, v in enumerate(values)], f"symbol string, d date, {name} double")


def walk(n, seed):
    rnd, x, out = random.Random(seed), 100.0, []
    for _ in range(n):
        x *= math.exp(rnd.gauss(0, 0.02))
        out.append(x)
    return out


def wilder(closes, n):
    gain = loss = 0.0
    out = []
    for i, c in enumerate(closes):
        step = c - closes[i - 1] if i else 0.0
        if i:
            gain, loss = (gain * (n - 1) + max(step, 0)) / n, (loss * (n - 1) + max(-step, 0)) / n
        value = 0.0 if gain == loss == 0 else 100.0 if loss == 0 else 100 * (1 - 1 / (1 + gain / loss))
        out.append((gain, loss, None if i < n else value))
    return out


def test_rsi_by_hand(spark):
    rows = scan.wilder_rsi(days(spark, [10, 8, 12]), 2).orderBy("d").collect()
    assert [r["rsi"] for r in rows][:2] == [None, None] and rows[2]["rsi"] == pytest.approx(80)
    assert (rows[2]["avg_gain"], rows[2]["avg_loss"]) == pytest.approx((2.0, 0.5))
    state = spark.createDataFrame([("s", 12.0, 2.0, 0.5)], "symbol string, last_close double, avg_gain double, avg_loss double")
    r = scan.wilder_rsi(days(spark, [10]), 2, state=state).first()
    assert (r["avg_gain"], r["avg_loss"]) == pytest.approx((1.0, 1.25)) and r["rsi"] is not None


@pytest.mark.parametrize("period,n", [(2, 3000), (14, 5000), (200, 900)])
def test_rsi_equals_the_loop_across_blocks(spark, period, n):
    closes = walk(n, period)
    got = scan.wilder_rsi(days(spark, closes), period).orderBy("d").collect()
    for r, (g, l, v) in zip(got, wilder(closes, period)):
        assert r["avg_gain"] == pytest.approx(g, rel=1e-9, abs=1e-12) and r["avg_loss"] == pytest.approx(l, rel=1e-9, abs=1e-12)
        assert (r["rsi"] is None) == (v is None) and (v is None or r["rsi"] == pytest.approx(v, abs=1e-7))


def test_rsi_resumes(spark):
    df = days(spark, walk(300, 5))
    whole = {r["d"]: r["rsi"] for r in scan.wilder_rsi(df, 14).collect()}
    cut = DAY + timedelta(days=200)
    state = scan.rsi_state(scan.wilder_rsi(df.filter(F.col("d") < F.lit(cut)), 14))
    for r in scan.wilder_rsi(df.filter(F.col("d") >= F.lit(cut)), 14, state=state).collect():
        assert r["rsi"] == pytest.approx(whole[r["d"]])


def test_rsi_edges(spark):
    flat = scan.wilder_rsi(days(spark, [5] * 5), 2).orderBy("d").collect()
    up = scan.wilder_rsi(days(spark, [1, 2, 3, 4]), 2).orderBy("d").collect()
    assert flat[-1]["rsi"] == 0 and up[-1]["rsi"] == 100
    with pytest.raises(ValueError):
        scan.wilder_rsi(days(spark, [1]), 1)


def test_ema(spark):
    v = walk(900, 3)
    a, x, want = 2 / 51, v[0], [v[0]]
    for y in v[1:]:
        x = a * y + (1 - a) * x
        want.append(x)
    got = scan.ema(days(spark, v), 50).orderBy("d").collect()
    assert all(r["ema"] is None for r in got[:50]) and [r["ema"] for r in got[50:]] == pytest.approx(want[50:])


def test_trend_latch(spark):
    df = spark.createDataFrame([("s", DAY + timedelta(days=7 * i), v) for i, v in enumerate([35.0, 50.0, 75.0, 60.0, 50.0])], "symbol string, week_start date, rsi double")
    assert [r["in_trend"] for r in scan.trend_states(df, 40, 70).orderBy("week_start").collect()] == [False, True, True, False, False]
    with pytest.raises(ValueError):
        scan.trend_states(df, 70, 70)


def test_signal_matrix(spark):
    cases = [(25.0, True, "BUY"), (80.0, True, "SELL"), (50.0, True, "NEUTRAL"), (80.0, False, "SELL"), (25.0, False, "NEUTRAL"), (30.0, True, "NEUTRAL"), (70.0, True, "NEUTRAL")]
    df = spark.createDataFrame(cases, "rsi double, t boolean, want string")
    assert df.filter(signals.rsi_signal(F.col("rsi"), F.col("t"), signals.RsiParams()) != F.col("want")).count() == 0


def test_asof_kinds(spark):
    left = spark.createDataFrame([("a", date(2024, 1, d)) for d in (1, 5, 9)] + [("b", date(2024, 1, 5))], "k string, d date")
    right = spark.createDataFrame([("a", date(2024, 1, 5), 1), ("a", date(2024, 1, 2), 0), ("a", date(2024, 1, 8), None)], "k string, t date, v int")
    pick = lambda **m: {(r["k"], r["d"].day): r["v"] for r in asof.asof(left, right, "d", "t", ["v"], by=["k"], **m).collect()}
    assert pick() == {("a", 1): None, ("a", 5): 1, ("a", 9): None, ("b", 5): None}
    assert pick(strict=True)[("a", 5)] == 0
    assert pick(strict=True, lag_days=2)[("a", 5)] == 0 and pick(lag_days=4)[("a", 9)] == 1


def test_asof_plans_have_no_nested_loop(spark):
    left, right = days(spark, range(5)), days(spark, range(5)).select("d", F.col("close").alias("v"))
    for df in (asof.asof(left, right.withColumnRenamed("d", "t"), "d", "t", ["v"]), asof.asof(left, right.select(F.lit("s").alias("symbol"), F.col("d").alias("t"), "v"), "d", "t", ["v"], by=["symbol"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_vintages_with_open_ends(spark):
    v = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 1, 10), date(2024, 1, 19), 1.0), (date(2024, 1, 1), date(2024, 1, 20), date(9999, 12, 31), 2.0), (date(2024, 1, 8), date(2024, 1, 15), date(9999, 12, 31), 3.0)],
        "obs date, rs date, re date, value double",
    )
    left = spark.createDataFrame([(date(2024, 1, x),) for x in (5, 12, 16, 25)], "d date")
    got = {r["d"].day: (r["now"], r["old"]) for r in asof.vintage_asof(left, v, "d", "obs", "rs", "re", "value", {"now": 0, "old": 14}).collect()}
    assert got == {5: (None, None), 12: (1.0, None), 16: (3.0, 1.0), 25: (3.0, 3.0)}
    assert asof.vintage_asof(left.limit(0), v, "d", "obs", "rs", "re", "value", {"now": 0}).columns == ["d", "now"]


def test_split_factors(spark):
    df = spark.createDataFrame([("s", date(2024, 1, d), f) for d, f in ((1, 1.0), (2, 2.0), (3, None), (4, 3.0), (4, 1.0))], "symbol string, d date, split_factor double")
    got = sorted((r["d"].day, round(r["adjust"], 9)) for r in candles.split_factors(df).collect())
    assert got == [(1, 6.0), (2, 3.0), (3, 3.0), (4, 1.0), (4, 1.0)]


def test_conform_takes_the_highest_priority(spark):
    bar = lambda p: spark.createDataFrame([("s", DAY, p, p, p, p, 1.0)], "symbol string, d date, open double, high double, low double, close double, volume double")
    priority = spark.createDataFrame([(1, 5), (2, 9)], "source_id int, priority int")
    out = candles.conform_daily({1: bar(1.0), 2: bar(2.0), 3: bar(3.0)}, priority).collect()
    assert len(out) == 1 and out[0]["source_id"] == 2 and out[0]["period_end"].second == 59
    assert candles.conform_daily({1: bar(1.0)}, priority, start=DAY + timedelta(days=1)).count() == 0


def test_week_start(spark):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (8, 10, 14, 15)], "d date")
    assert [r[0].day for r in df.select(candles.week_start("d")).collect()] == [8, 8, 8, 15]


def test_weekly_returns_with_dividend(spark):
    weeks = spark.createDataFrame([("s", date(2024, 1, 1), 100.0), ("s", date(2024, 1, 8), 110.0)], "symbol string, week_start date, close double")
    acts = spark.createDataFrame([("s", date(2024, 1, 9), 1.0, 2.0), ("s", date(2024, 1, 20), 2.0, 0.0)], "symbol string, d date, split_factor double, div_cash double")
    rate = spark.createDataFrame([(date(2023, 12, 29), 5.0)], "d date, value double")
    r = features.weekly_returns(weeks, acts, rate).filter("week_start = date'2024-01-08'").first()
    assert r["price_simple_return"] == pytest.approx(0.10) and r["simple_return"] == pytest.approx(0.11)
    assert r["excess_return"] == pytest.approx(0.11 - (1.05 ** (7 / 365) - 1))


def test_formation_needs_finite_returns(spark):
    df = days(spark, [1, 2, 3, 4], name="excess_log_return").withColumnRenamed("d", "week_start")
    assert [r["formation"] for r in signals.formation_sum(df, 3).orderBy("week_start").collect()] == [None, None, 6.0, 9.0]
    bad = df.withColumn("excess_log_return", F.lit(float("nan")))
    with pytest.raises(Exception, match="finite"):
        signals.formation_sum(bad, 2).collect()
    for wrong in ({"horizon": 0}, {"vol_target": 0}, {"leverage_cap": -1}):
        with pytest.raises(ValueError):
            signals.MomentumParams(**wrong)


def test_trigger_json_round_trip(spark):
    rows = [("s", DAY + timedelta(days=7 * i), 0.01, 0.2 if i else None, False) for i in range(3)]
    df = spark.createDataFrame(rows, "symbol string, week_start date, excess_log_return double, realized_vol_26w double, is_capped boolean")
    out = signals.momentum_signals(df, signals.MomentumParams(horizon=1))
    back = signals.read_trigger(out.select("week_start", "trigger_params")).orderBy("week_start").collect()
    assert [(r["signal"], r["realized_vol_26w"]) for r in back] == [(1, None), (1, 0.2), (1, 0.2)]


def test_portfolio_properties(spark):
    rnd = random.Random(20230623)
    rows = [(w, f"s{i}", rnd.choice([-1, 0, 1, None]), rnd.uniform(0.02, 0.8), i == 0) for w in range(400) for i in range(9)]
    df = spark.createDataFrame(rows, "week_start int, symbol string, signal int, realized_vol_26w double, is_capped boolean")
    out = portfolio.build_weights(df).collect()
    books = {}
    for r in out:
        books.setdefault((r["week_start"], r["include_capped"]), []).append(r)
        assert not r["is_capped"] or (abs(r["weight"]) <= 0.2 + 1e-12 and r["include_capped"])
    for rs in books.values():
        gross = sum(abs(r["weight"]) for r in rs)
        assert gross == pytest.approx(min(1.0, 0.2) if all(r["is_capped"] for r in rs) else 1.0)
    equal = portfolio.build_weights(df, portfolio.PortfolioParams("equal_weight", 1.0), books=(False,))
    assert all(abs(r["g"] - 1) < 1e-9 for r in equal.groupBy("week_start").agg(F.sum(F.abs("weight")).alias("g")).collect())
    for bad in ({"scheme": "erc"}, {"cap": 0.0}, {"cap": 1.5}):
        with pytest.raises(ValueError):
            portfolio.PortfolioParams(**bad)


def weeks_of(spark, rows):
    return spark.createDataFrame(rows, "symbol string, week_start date, signal int, realized_vol_26w double, is_capped boolean, excess_return double")


def test_backtest_against_a_loop(spark):
    """Books, costs, skipped weeks and re-entry as a plain loop over weeks has them."""
    rnd = random.Random(8)
    n, symbols, bps = 60, ["a", "b", "c"], {"a": 80.0, "b": 5.0, "c": 8.0}
    weeks = [DAY + timedelta(days=7 * i) for i in range(n)]
    table = {(s, w): (0 if i in (20, 21) else rnd.choice([-1, 0, 1, None]), rnd.uniform(0.05, 0.5), rnd.gauss(0, 0.02)) for s in symbols for i, w in enumerate(weeks) if rnd.random() < 0.95}
    rows = weeks_of(spark, [(s, w, sig, vol, s == "a", r) for (s, w), (sig, vol, r) in table.items()])
    costs = spark.createDataFrame(list(bps.items()), "symbol string, bps double")
    got = {(r["return_week"], r["cost_mult"]): r for r in backtest.backtest(rows, rows, costs, multipliers=(1.0, 2.0)).collect()}
    calendar, want, before = sorted({w for _, w in table}), {}, {}
    for w, nxt in zip(calendar, calendar[1:]):
        book = {s: table[s, w][0] / table[s, w][1] for s in symbols if (s, w) in table and table[s, w][0]}
        gross = sum(map(abs, book.values()))
        if not gross:
            before = {}
            continue
        book = {s: x / gross for s, x in book.items()}
        if abs(book.get("a", 0)) > 0.2:
            freed = abs(book["a"]) - 0.2
            book["a"] = math.copysign(0.2, book["a"])
            other = sum(abs(x) for s, x in book.items() if s != "a")
            book = {s: x if s == "a" or not other else x * (1 + freed / other) for s, x in book.items()}
        moved = {s: abs(book.get(s, 0) - before.get(s, 0)) for s in {*book, *before}}
        want[nxt] = (sum(x * table.get((s, nxt), (0, 0, 0))[2] for s, x in book.items()), sum(moved.values()), -sum(m * bps[s] / 1e4 for s, m in moved.items()))
        before = book
    assert {k[0] for k in got} == set(want)
    for w, (g, t, c) in want.items():
        assert (got[w, 1.0]["gross"], got[w, 1.0]["turnover"], got[w, 1.0]["net"], got[w, 2.0]["net"]) == pytest.approx((g, t, g + c, g + 2 * c))
    with pytest.raises(Exception, match="no cost"):
        backtest.backtest(rows, rows, costs.filter("symbol <> 'b'")).collect()


def test_walk_forward_bounds(spark):
    weeks = spark.createDataFrame([(DAY + timedelta(days=7 * i),) for i in range(120)], "week_start date")
    cfg = backtest.SplitConfig(min_train=20, n_splits=3, purge=3, embargo=2)
    folds = {}
    for r in backtest.walk_forward(weeks, cfg).collect():
        folds.setdefault((r["fold"], r["role"]), []).append((r["week_start"] - DAY).days // 7)
    assert sorted(folds[0, "train"]) == list(range(17)) and sorted(folds[0, "test"]) == list(range(22, 53)) and max(folds[2, "test"]) == 119
    rolling = backtest.walk_forward(weeks, backtest.SplitConfig(20, 3, 3, 2, "rolling")).filter("fold = 1 and role = 'train'").count()
    assert rolling == 17
    with pytest.raises(ValueError):
        backtest.walk_forward(weeks.limit(10), cfg)
    assert backtest.open_holdout(weeks, DAY + timedelta(days=7 * 100), 20).count() == 20
    with pytest.raises(ValueError):
        backtest.open_holdout(weeks, DAY, 250)


def test_period_stats(spark):
    rnd = random.Random(2)
    r = [rnd.gauss(0.001, 0.02) for _ in range(80)]
    rows = [("x", i, v) for i, v in enumerate(r)] + [("one", 0, 0.1)] + [("up", i, 0.01 * (i + 1)) for i in range(3)] + [("flat", i, 0.01) for i in range(3)]
    got = {x["k"]: x for x in stats.period_stats(spark.createDataFrame(rows, "k string, t int, r double"), ["k"], "t", "r").collect()}
    down = [v for v in r if v < 0]
    assert got["x"]["sharpe"] == pytest.approx(statistics.mean(r) / statistics.stdev(r) * 52**0.5)
    assert got["x"]["sortino"] == pytest.approx(statistics.mean(r) / statistics.stdev(down) * 52**0.5)
    total, peak, worst, e = math.prod(1 + v for v in r), 1.0, 0.0, 1.0
    for v in r:
        e *= 1 + v
        peak = max(peak, e)
        worst = min(worst, e / peak - 1)
    assert got["x"]["annual_return"] == pytest.approx(total ** (52 / 80) - 1) and got["x"]["max_drawdown"] == pytest.approx(worst)
    assert got["x"]["profit_factor"] == pytest.approx(sum(v for v in r if v > 0) / -sum(down))
    assert got["one"]["sharpe"] == 0 and got["flat"]["sharpe"] == 0 and got["up"]["sortino"] is None and got["up"]["calmar"] is None


def test_total_loss(spark):
    """A return of -1 leaves nothing, whatever follows; one below -1 turns the sign."""
    cases = {"gone": [0.1, -1.0, 0.2], "short": [0.1, -1.5, 0.2], "twice": [0.5, -1.5, -1.5, 0.1], "plain": [0.1, -0.5, 0.2]}
    df = spark.createDataFrame([(k, i, v) for k, r in cases.items() for i, v in enumerate(r)], "k string, t int, r double")
    curve = {(r["k"], r["t"]): r["equity"] for r in stats.equity(df, ["k"], "t", "r").collect()}
    got = {x["k"]: x for x in stats.period_stats(df, ["k"], "t", "r").collect()}
    for k, r in cases.items():
        e, peak, worst = 1.0, 1.0, 0.0
        for i, v in enumerate(r):
            e *= 1 + v
            peak = max(peak, e)
            worst = min(worst, (e - peak) / peak)
            assert curve[k, i] == pytest.approx(e)
        assert got[k]["max_drawdown"] == pytest.approx(worst)
        assert got[k]["annual_return"] is None if e < 0 else got[k]["annual_return"] == pytest.approx(e ** (52 / len(r)) - 1)
    assert got["gone"]["annual_return"] == -1 and got["gone"]["max_drawdown"] == -1 and got["gone"]["calmar"] == -1 and got["short"]["calmar"] is None


def test_passive_book_after_a_total_loss(spark):
    """A lost position stays lost until the next rebalance, one week in which all is lost leaves the weights, and every symbol has a cost."""
    w = [DAY + timedelta(days=7 * i) for i in range(8)]
    moves = {"e": [0.1, -1.0, 0.3, 0.0, 0.2, 0.1, 0.1, 0.1], "b": [0.0, 0.1, 0.1, -1.0, 0.1, 0.1, 0.0, 0.0]}
    ret = spark.createDataFrame([(s, x, r, r) for s, rs in moves.items() for x, r in zip(w, rs)], "symbol string, week_start date, simple_return double, excess_return double")
    folds = spark.createDataFrame([(0, "test", x) for x in w], "fold int, role string, week_start date")
    costs = spark.createDataFrame([("e", 10.0), ("b", 10.0)], "symbol string, bps double")
    got = backtest.baseline_passive(ret, folds, costs, {"e": 0.6, "b": 0.4}, rebalance=6).orderBy("return_week").collect()
    now, want = {"e": 0.6, "b": 0.4}, []
    for i in range(8):
        now = {"e": 0.6, "b": 0.4} if i == 6 else now
        want.append(sum(x * moves[s][i] for s, x in now.items()))
        grown = {s: x * (1 + moves[s][i]) for s, x in now.items()}
        total = sum(map(abs, grown.values()))
        now = {s: x / total for s, x in grown.items()} if total else now
    assert [r["gross"] for r in got] == pytest.approx(want)
    with pytest.raises(Exception, match="no cost"):
        backtest.baseline_passive(ret, folds, costs.filter("symbol <> 'b'"), {"e": 0.6, "b": 0.4}).collect()


def test_newey_west_at_lag_zero(spark):
    rnd = random.Random(3)
    d = [rnd.gauss(0.1, 1) for _ in range(50)]
    df = spark.createDataFrame([(1, i, v, 0.0) for i, v in enumerate(d)], "k int, t int, a double, b double")
    m = statistics.mean(d)
    assert stats.hac_tstat(df, ["k"], "t", "a", "b", 0).first()["t_stat"] == pytest.approx(m / math.sqrt(statistics.pvariance(d) / 50))
    gamma = lambda l: sum((d[i] - m) * (d[i - l] - m) for i in range(l, 50)) / 50
    v = gamma(0) + sum(2 * (1 - l / 6) * gamma(l) for l in range(1, 6))
    assert stats.hac_tstat(df, ["k"], "t", "a", "b", 5).first()["t_stat"] == pytest.approx(m / math.sqrt(v / 50))


def test_pbo_against_enumeration(spark, monkeypatch):
    from itertools import combinations

    rnd = random.Random(4)
    trials = {k: [rnd.gauss(0, 1) for _ in range(26)] for k in "abcd"}
    df = spark.createDataFrame([(k, i, v) for k, r in trials.items() for i, v in enumerate(r)], "trial string, t int, r double")
    blocks = [list(range(i * 4, (i + 1) * 4 if i < 5 else 26)) for i in range(6)]
    over = paths = 0
    for test in combinations(range(6), 3):
        out = [i for b in test for i in blocks[b]]
        inside = [i for i in range(26) if i not in out]
        mean = lambda k, ix: sum(trials[k][i] for i in ix) / len(ix)
        best = max("abcd", key=lambda k: (mean(k, inside), -ord(k)))
        over += (sum(mean(k, out) > mean(best, out) for k in "abcd") + 1) / 4 > 0.5
        paths += 1
    row = stats.pbo(df, 6).first()
    assert row["n_paths"] == paths == 20 and row["pbo"] == pytest.approx(over / paths)
    with pytest.raises(ValueError):
        stats.pbo(df, 20)
    monkeypatch.setattr(stats, "MOST_SUMS", 23)
    with pytest.raises(ValueError, match="sums"):
        stats.pbo(df, 6)


def test_deflated_sharpe_and_haircut(spark):
    rnd = random.Random(6)
    rows = [(k, rnd.gauss(0.02 * k, 1)) for k in range(5) for _ in range(200)]
    df = spark.createDataFrame(rows, "trial int, r double")
    many, one = stats.deflated_sharpe(df).first(), stats.deflated_sharpe(df.filter("trial = 4")).first()
    assert 0 < many["deflated_sharpe"] < one["deflated_sharpe"] < 1 and one["expected_max"] == 0
    s = spark.createDataFrame([(1.5, 520), (1.0, 1)], "sharpe double, n int")
    a, b = stats.hlz(s).collect()
    assert a["t_stat"] == pytest.approx(1.5 / math.sqrt(52) * math.sqrt(520)) and a["significant"] and b["t_stat"] == 0
    assert stats.hlz(s, n_independent=10).first()["t_stat"] < a["t_stat"]


def test_passive_drift(spark):
    w = [DAY + timedelta(days=7 * i) for i in range(5)]
    ret = spark.createDataFrame([(s, x, r, r) for s, r in (("e", 0.1), ("b", 0.0)) for x in w], "symbol string, week_start date, simple_return double, excess_return double")
    folds = spark.createDataFrame([(0, "test", x) for x in w], "fold int, role string, week_start date")
    costs = spark.createDataFrame([("e", 10.0), ("b", 10.0)], "symbol string, bps double")
    got = backtest.baseline_passive(ret, folds, costs, {"e": 0.6, "b": 0.4}, rebalance=3).orderBy("return_week").collect()
    assert [r["gross"] for r in got][:2] == pytest.approx([0.06, 0.66 / 1.06 * 0.1])
    drifted = 0.6 * 1.1**3 / (0.6 * 1.1**3 + 0.4)
    assert got[3]["turnover"] == pytest.approx(2 * (drifted - 0.6)) and got[3]["gross"] == pytest.approx(0.06) and got[1]["turnover"] == 0


def test_stitching(spark):
    rows = [("t", date(2024, 1, 1), date(2024, 1, d), v) for d, v in ((1, 50), (8, 100))] + [("t", date(2024, 1, 8), date(2024, 1, d), v) for d, v in ((8, 50), (15, 100))]
    df = spark.createDataFrame(rows, "term string, window_start date, d date, interest int")
    assert {r["d"].day: r["interest"] for r in features.stitch_windows(df).collect()} == {1: 25.0, 8: 50.0, 15: 100.0}


def test_signal_changes(spark):
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate(["BUY", "BUY", "SELL", None, None])], "symbol string, d int, signal string")
    assert [r["d"] for r in signals.signal_changes(df).orderBy("d").collect()] == [0, 2, 3]


def test_truncation_does_not_change_the_past(spark):
    df = days(spark, walk(120, 11))
    whole = scan.wilder_rsi(df, 14).filter(F.col("d") < F.lit(DAY + timedelta(days=80)))
    cut = scan.wilder_rsi(df.filter(F.col("d") < F.lit(DAY + timedelta(days=80))), 14)
    assert whole.exceptAll(cut).count() == 0


def test_quality_finds_faults(spark):
    bad = spark.createDataFrame([("s", date(2024, 1, 2), date(2024, 1, 9))], "symbol string, week_start date, week_end date")
    r = quality.week_checks(bad).first()
    assert (r["not_monday"], r["bad_end"]) == (1, 1)
    gaps = spark.createDataFrame([("s", date(2024, 1, 1)), ("s", date(2024, 1, 5))], "symbol string, d date")
    r = quality.coverage(gaps).first()
    assert (r["missing_days"], r["max_gap"], r["weekday_coverage"]) == (3, 4, 0.4)
    assert quality.duplicates(gaps.unionByName(gaps), ["symbol", "d"]).count() == 2



def test_blocked_scans_against_windows(spark):
    """Numbers and last known values equal a window over the whole key, whatever the months; null keys are keys, and an empty table is one."""
    from pyspark.sql import Window

    from marlspike.operators import blocks

    rng = random.Random(1)
    rows = [(k, date(2020, 1, 1) + timedelta(days=i), rng.random() if rng.random() < 0.3 else None) for k in ("a", "b", None) for i in range(400) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    w = Window.partitionBy("k").orderBy("d")
    key = lambda rs, *cols: sorted(str([r["k"], r["d"], *(r[c] for c in cols)]) for r in rs.collect())
    assert key(blocks.numbered(df, ["k"], "d"), "_i") == key(df.withColumn("_i", F.row_number().over(w) - 1), "_i")
    for inclusive in (False, True):
        until = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        got = blocks.last_known(df, ["k"], ["d"], {"p": F.col("v"), "q": F.struct("d", "v")}, inclusive)
        want = df.withColumns({"p": F.last("v", ignorenulls=True).over(until), "q": F.last(F.struct("d", "v"), ignorenulls=True).over(until)})
        assert key(got, "p", "q") == key(want, "p", "q")
    assert blocks.numbered(df.limit(0), ["k"], "d").count() == 0 and blocks.last_known(df.limit(0), [], ["d"], {"p": F.col("v")}).count() == 0


def test_no_window_holds_a_whole_key(spark):
    """Scans, latches and as-of joins shuffle and sort by key and month only."""
    bars = spark.createDataFrame([("a", date(2024, 1, 1) + timedelta(days=i), 1.0 + i % 7) for i in range(90)], "symbol string, d date, close double")
    weeks = bars.select("symbol", F.col("d").alias("week_start"), F.col("close").alias("rsi"))
    made = {
        "rsi": scan.wilder_rsi(bars, 3), "ema": scan.ema(bars, 3), "latch": scan.trend_states(weeks, 2, 5),
        "asof": asof.asof(bars, weeks, "d", "week_start", ["rsi"], by=["symbol"], strict=True),
    }
    for name, df in made.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts = re.findall(r"windowspecdefinition\(([^)]*?)(?: ASC| DESC)", plan)
        assert parts and all("_block#" in p for p in parts), name


def test_trend_latch_at_any_block_edge(spark):
    """The latch equals a loop, wherever months end."""
    rng = random.Random(6)
    rows = [(s, date(2022, 1, 3) + timedelta(days=3 * i), rng.choice([10.0, 40.0, 55.0, 70.0, 90.0, 55.0, 55.0, None])) for s in "ab" for i in range(150)]
    got = {(r["symbol"], r["week_start"]): r["in_trend"] for r in scan.trend_states(spark.createDataFrame(rows, "symbol string, week_start date, rsi double"), 40, 70).collect()}
    for s in "ab":
        open_ = False
        for _, d, rsi in (r for r in rows if r[0] == s):
            assert got[s, d] is open_
            open_ = open_ if rsi is None else True if rsi <= 40 else False if rsi >= 70 else open_


@pytest.mark.parametrize("tile", [7, 2048])
def test_pbo_in_tiles(spark, monkeypatch, tile):
    """Many trials in many tiles, ties among them, against numpy over all at once; and no join without a key."""
    import itertools

    import numpy as np

    from marlspike.operators import overfit

    monkeypatch.setattr(overfit, "TILE", tile)
    monkeypatch.setattr(overfit, "RANGE_BITS", 5)
    rng = np.random.default_rng(8)
    r = rng.integers(-4, 5, (120, 33)).astype(float)
    r[50:60] = r[10]
    rows = [(f"t{k:03d}", i, float(r[k, i])) for k in range(120) for i in range(33)]
    got = overfit.pbo_tiled(spark.createDataFrame(rows, "trial string, t int, r double"), 8)
    parts = [np.arange(b * 4, 33 if b == 7 else b * 4 + 4) for b in range(8)]
    over = []
    for test in itertools.combinations(range(8), 4):
        out = np.concatenate([parts[b] for b in test])
        inside = np.setdiff1d(np.arange(33), out)
        best = int(r[:, inside].mean(axis=1).round(12).argmax())
        outside = r[:, out].mean(axis=1)
        over.append((int((outside.round(12) > outside[best].round(12)).sum()) + 1) / 120 > 0.5)
    row = got.first()
    assert row["n_paths"] == 70 and row["pbo"] == pytest.approx(sum(over) / 70)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan


def test_pbo_of_a_hundred_thousand_trials(spark):
    from marlspike.operators import overfit

    df = spark.range(100_000).select(F.col("id").alias("trial"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("t")).withColumn("r", F.pmod(F.xxhash64("trial", "t"), F.lit(1000)) / 1000.0)
    row = overfit.pbo_tiled(df, 6).first()
    assert row["n_paths"] == 20 and 0.2 < row["pbo"] < 0.8
