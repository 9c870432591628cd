"""Walk-forward backtests as long frames: one row a run, fold and week, never a loop over weeks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.functions.scalars import trend_sign
from marlspike.operators.portfolio import PortfolioParams, build_weights
from marlspike.operators.stats import compounded
from marlspike.sources.shared import settle


@dataclass(frozen=True)
class SplitConfig:
    """Walk-forward layout in weeks."""

    min_train: int = 104
    n_splits: int = 5
    purge: int = 3
    embargo: int = 2
    mode: str = "expanding"

    def __post_init__(self) -> None:
        if self.mode not in ("expanding", "rolling"):
            raise ValueError("mode must be expanding or rolling")
        if min(self.min_train, self.n_splits) < 1 or min(self.purge, self.embargo) < 0:
            raise ValueError("sizes of a split must be positive")


class HoldoutViolation(ValueError):
    """Weeks of the sealed holdout where only weeks before it may be."""


def walk_forward(weeks: DataFrame, cfg: SplitConfig | None = None, holdout: date | None = None) -> DataFrame:
    """``fold``, ``role`` (train, test) and ``week_start`` of every fold, from the distinct weeks, none of which may lie in the holdout.

    A week from ``holdout`` on is refused, not dropped: who passes one has looked at what is sealed (:func:`before_holdout` cuts them).
    Train ends ``purge`` weeks before the test part, which begins ``embargo`` weeks late; the last fold
    takes the remainder.  One row a week: the frame is as long as the calendar, not as the data.
    """
    cfg = cfg or SplitConfig()
    days = weeks.select("week_start").distinct()
    last, n = days.agg(F.max("week_start"), F.count(F.lit(1))).first()
    if holdout and last is not None and last >= holdout:
        raise HoldoutViolation(f"weeks up to {last} lie in the holdout, which begins on {holdout}")
    if n < cfg.min_train + cfg.n_splits:
        raise ValueError(f"{n} weeks are too few for {cfg.n_splits} folds after {cfg.min_train}")
    size = (n - cfg.min_train) // cfg.n_splits
    bounds = []
    for k in range(cfg.n_splits):
        start = cfg.min_train + k * size
        end = start + size if k < cfg.n_splits - 1 else n
        begin = 0 if cfg.mode == "expanding" else max(0, start - cfg.min_train)
        bounds.append((k, begin, max(begin, start - cfg.purge), start + min(cfg.embargo, end - start), end))
    numbered = days.withColumn("i", F.row_number().over(Window.orderBy("week_start")) - 1)
    role = [
        F.when((F.col("i") >= b) & (F.col("i") < p), F.struct(F.lit(k).alias("fold"), F.lit("train").alias("role"))).when(
            (F.col("i") >= t) & (F.col("i") < e), F.struct(F.lit(k).alias("fold"), F.lit("test").alias("role"))
        )
        for k, b, p, t, e in bounds
    ]
    return numbered.select("week_start", F.explode(F.array_compact(F.array(*role))).alias("f")).select("f.fold", "f.role", "week_start")


def before_holdout(rows: DataFrame, start: date, week: str = "week_start") -> DataFrame:
    """Rows of the weeks before the holdout."""
    return rows.filter(F.col(week) < F.lit(start))


def open_holdout(weeks: DataFrame, start: date, least: int = 250) -> DataFrame:
    """Weeks from ``start`` on; fewer than ``least`` are an error."""
    held = weeks.select("week_start").distinct().filter(F.col("week_start") >= F.lit(start))
    if held.count() < least:
        raise ValueError(f"the holdout has fewer than {least} weeks")
    return held


def _recorded(weights: DataFrame, calendar: DataFrame, by: Sequence[str]) -> DataFrame:
    """Return weeks of ``weights`` with ``previous``: the week before in ``calendar`` if a book was held there, else null."""
    along = Window.partitionBy(*by).orderBy("return_week")
    held = weights.select(*by, "return_week").distinct().withColumn("_held", F.lit(True))
    steps = calendar.join(held, [*by, "return_week"], "left")
    before = F.when(F.lag("_held").over(along), F.lag("return_week").over(along))
    return steps.withColumn("previous", before).filter("_held").select(*by, "return_week", "previous")


def _priced(rows: DataFrame, costs: DataFrame) -> DataFrame:
    """``rows`` with ``_bps`` of their symbol; a symbol without a cost is an error."""
    known = costs.select("symbol", F.col("bps").alias("_bps"))
    missing = F.raise_error(F.concat(F.lit("no cost for "), F.col("symbol"))).cast("double")
    return rows.join(known, "symbol", "left").withColumn("_bps", F.coalesce("_bps", missing))


def week_results(
    weights: DataFrame, returns: DataFrame, costs: DataFrame, calendar: DataFrame, by: Sequence[str] = (), rolls: Mapping[str, float] | None = None
) -> DataFrame:
    """``gross``, ``turnover``, ``cost`` and ``roll`` of each return week.

    ``weights``: ``by``, ``return_week``, ``symbol``, ``weight``.  ``returns``: ``symbol``, ``week_start``,
    ``excess_return`` (missing counts as 0).  ``costs``: ``symbol``, ``bps``; a traded symbol without one is an
    error.  ``calendar``: ``by`` and every week at which a book could have been held; after a week
    without a book the next is bought from nothing.  ``rolls``: basis points a year that holding a symbol costs, none by default.
    """
    key = [*by, "return_week"]
    weights = settle(weights, "books")
    now = weights.select(*key, "symbol", F.col("weight").alias("w1"))
    follows = _recorded(weights, calendar, by)
    # The book before, placed at the week that follows it, so both books meet in one grouped sum.
    later = follows.filter("previous is not null").select(*by, F.col("previous").alias("_p"), F.col("return_week").alias("_next"))
    earlier = weights.withColumnRenamed("return_week", "_p").join(later, [*by, "_p"])
    before = earlier.select(*by, F.col("_next").alias("return_week"), "symbol", F.col("weight").alias("w0"))
    both = now.unionByName(before, allowMissingColumns=True).groupBy(*key, "symbol").agg(
        F.coalesce(F.sum("w1"), F.lit(0.0)).alias("w1"), F.coalesce(F.sum("w0"), F.lit(0.0)).alias("w0")
    )
    paid = both.join(returns.select("symbol", F.col("week_start").alias("return_week"), F.col("excess_return").alias("_r")), ["symbol", "return_week"], "left")
    paid = _priced(paid, costs)
    moved = F.abs(F.col("w1") - F.col("w0"))
    finite = F.when(~F.isnan("_r") & (F.abs("_r") < float("inf")), F.col("_r")).otherwise(0.0)
    sums = paid.groupBy(*key).agg(F.sum(F.col("w1") * finite).alias("gross"), F.sum(moved).alias("turnover"), F.sum(-moved * F.col("_bps") / 10_000.0).alias("cost"), F.sum(roll_cost(rolls or {}, "symbol", "w1")).alias("roll"))
    return sums


def with_costs(results: DataFrame, multipliers: Sequence[float]) -> DataFrame:
    """One copy of each week for every cost multiplier, with ``net``; the multiplier is that of trading costs, not of rolls."""
    rows = results.withColumn("cost_mult", F.explode(F.array(*(F.lit(float(m)) for m in multipliers))))
    roll = F.col("roll") if "roll" in results.columns else F.lit(0.0)
    return rows.withColumn("net", F.col("gross") + F.col("cost") * F.col("cost_mult") + roll).drop("cost", "roll")


def backtest(
    signals: DataFrame, returns: DataFrame, costs: DataFrame, params: PortfolioParams | None = None, multipliers: Sequence[float] = (1.0,), with_capped: bool = True,
    rolls: Mapping[str, float] | None = None,
) -> DataFrame:
    """Momentum backtest: the book formed from one week's signals earns the next week's returns.

    ``signals``: ``symbol``, ``week_start``, ``signal``, ``realized_vol_26w``, ``is_capped`` for every week, null signals included.
    """
    weeks = signals.select("week_start").distinct()
    steps = weeks.select("week_start", F.lead("week_start").over(Window.orderBy("week_start")).alias("return_week")).filter("return_week is not null")
    book = build_weights(signals.filter("signal is not null"), params, books=(with_capped,)).drop("include_capped")
    held = book.join(steps, "week_start").select("return_week", "symbol", "weight")
    return with_costs(week_results(held, returns, costs, steps.select("return_week"), rolls=rolls), multipliers)


def _sized(returns: DataFrame) -> DataFrame:
    """Volatility of exactly one week before the return week."""
    return returns.select("symbol", F.date_add("week_start", 7).alias("return_week"), "realized_vol_26w", "is_capped")


def baseline_fixed(
    signs: DataFrame | None, returns: DataFrame, folds: DataFrame, costs: DataFrame, params: PortfolioParams | None = None, multipliers: Sequence[float] = (1.0,), with_capped: bool = True
) -> DataFrame:
    """A book of constant signs over each fold's test weeks (``signs``: ``fold``, ``symbol``, ``signal``; None: always long)."""
    tests = folds.filter("role = 'test'").select("fold", F.col("week_start").alias("return_week"))
    rows = _sized(returns).join(tests, "return_week")
    rows = rows.withColumn("signal", F.lit(1)) if signs is None else rows.join(signs, ["fold", "symbol"])
    book = build_weights(rows, params, by=("fold", "return_week"), books=(with_capped,))
    return with_costs(week_results(book.select("fold", "return_week", "symbol", "weight"), returns, costs, tests, by=("fold",)), multipliers)


def baseline_history(returns: DataFrame, folds: DataFrame, costs: DataFrame, **more) -> DataFrame:
    """Sign of each symbol's mean excess log return over the fold's training weeks, held through its test weeks."""
    train = folds.filter("role = 'train'").select("fold", "week_start")
    ok = F.col("excess_log_return").isNotNull() & ~F.isnan("excess_log_return")
    mean = returns.filter(ok).join(train, "week_start").groupBy("fold", "symbol").agg(F.avg("excess_log_return").alias("m"))
    signs = mean.select("fold", "symbol", trend_sign(F.col("m")).alias("signal")).filter("signal != 0")
    return baseline_fixed(signs, returns, folds, costs, **more)


def baseline_hold(returns: DataFrame, folds: DataFrame, costs: DataFrame, **more) -> DataFrame:
    """Every symbol long at inverse volatility."""
    return baseline_fixed(None, returns, folds, costs, **more)


def baseline_passive(
    returns: DataFrame, folds: DataFrame, costs: DataFrame, targets: Mapping[str, float], rebalance: int = 52, multipliers: Sequence[float] = (1.0,)
) -> DataFrame:
    """Fixed target weights that drift with total returns and are restored every ``rebalance`` weeks.

    Within a block the weight before normalising is the target times the product of the growths so far,
    so the drift is a running product, not a recursion.  Only symbols with a row in a block's first
    week are held in it; costs fall due in that week, against the drifted book before it.  A block that
    is due waits for a week in which any target has a row; if there is none in a fold's first week, the
    first block begins after a whole period has passed.  A position that falls to nothing stays there until
    the next block; a symbol without a cost is an error.
    """
    tests = folds.filter("role = 'test'").select("fold", F.col("week_start").alias("return_week"))
    weeks = tests.withColumn("i", F.row_number().over(Window.partitionBy("fold").orderBy("return_week")) - 1)
    found = returns.filter(F.col("symbol").isin(list(targets))).select("symbol", F.col("week_start").alias("return_week"), "simple_return", "excess_return", F.lit(True).alias("_there"))
    calendar = weeks.join(found.select("return_week").distinct().withColumn("_any", F.lit(True)), "return_week", "left")
    listed = calendar.groupBy("fold").agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("_any", F.lit(False)).alias("any")))).alias("w"))
    due = f"""aggregate(w, struct(0 as since, cast(array() as array<int>) as starts), (a, x) ->
        if(x.i = 0 or a.since >= {rebalance}, if(x.any, struct(1 as since, concat(a.starts, array(x.i)) as starts), a), struct(a.since + 1 as since, a.starts as starts)), a -> a.starts)"""
    starts = listed.select("fold", F.posexplode(F.expr(due)).alias("block", "start"))
    steps = starts.select("fold", "block", F.posexplode(F.sequence("start", F.col("start") + (rebalance - 1))).alias("step", "i"))
    weeks = settle(weeks.join(steps, ["fold", "i"]), "blocks")
    pairs = F.explode(F.map_from_arrays(F.array(*map(F.lit, targets)), F.array(*(F.lit(float(x)) for x in targets.values()))))
    rows = weeks.select("*", pairs.alias("symbol", "target")).join(found, ["symbol", "return_week"], "left")
    block = Window.partitionBy("fold", "block", "symbol").orderBy("step")
    rows = rows.withColumn("_in", F.first(F.coalesce("_there", F.lit(False))).over(block)).filter("_in")
    sound = ~F.isnan("simple_return") & (F.abs("simple_return") < float("inf"))
    rows = rows.withColumn("_g", F.when(sound, 1 + F.col("simple_return")).otherwise(1.0))
    # A week in which the last position is lost as well leaves its weights as they were.
    lost = F.min(F.when(F.col("_g") == 0, F.col("step"))).over(Window.partitionBy("fold", "block", "symbol"))
    rows = rows.withColumn("_lost", lost).withColumn("_all_lost", F.max(F.coalesce("_lost", F.lit(rebalance))).over(Window.partitionBy("fold", "block")))
    rows = rows.withColumn("_g", F.when((F.col("step") == F.col("_all_lost")) & (F.col("_lost") == F.col("_all_lost")), 1.0).otherwise(F.col("_g")))
    so_far = compounded(F.col("_g"), block.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_start", F.col("target") * so_far).withColumn("_end", F.col("_start") * F.col("_g"))
    week = Window.partitionBy("fold", "return_week")
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(F.abs(c)).over(week)), F.lit(0.0))
    rows = rows.withColumns({"weight": share("_start"), "_drifted": share("_end")})
    gross = rows.groupBy("fold", "return_week").agg(F.sum(F.col("weight") * F.coalesce("excess_return", F.lit(0.0))).alias("gross"))
    bought = rows.filter("step = 0").select("fold", "block", "symbol", F.col("weight").alias("w1"))
    last = rows.filter(F.col("step") == rebalance - 1).select("fold", (F.col("block") + 1).alias("block"), "symbol", F.col("_drifted").alias("w0"))
    moved = bought.unionByName(last, allowMissingColumns=True).groupBy("fold", "block", "symbol").agg(
        F.abs(F.coalesce(F.sum("w1"), F.lit(0.0)) - F.coalesce(F.sum("w0"), F.lit(0.0))).alias("moved")
    )
    paid = _priced(moved, costs).groupBy("fold", "block").agg(F.sum("moved").alias("turnover"), F.sum(-F.col("moved") * F.col("_bps") / 10_000.0).alias("cost"))
    first = weeks.filter("step = 0").select("fold", "block", "return_week").join(paid, ["fold", "block"]).drop("block")
    out = gross.join(first, ["fold", "return_week"], "left")
    out = out.withColumns({"turnover": F.coalesce("turnover", F.lit(0.0)), "cost": F.coalesce("cost", F.lit(0.0))})
    return with_costs(out, multipliers)


def aligned(results: DataFrame, by: Sequence[str], strategies: int) -> DataFrame:
    """Rows of the weeks that all ``strategies`` have in common."""
    full = results.groupBy(*by, "return_week").agg(F.count_distinct("strategy").alias("_n")).filter(F.col("_n") == strategies)
    return results.join(full.drop("_n"), [*by, "return_week"], "left_semi")


def cost_grid(classes: Mapping[str, str], bps: Mapping[str, float], spark) -> DataFrame:
    """``symbol`` and ``bps`` from symbol classes; a class without a cost is an error."""
    rows = [(s, float(bps[c])) for s, c in classes.items()]
    return spark.createDataFrame(rows, "symbol string, bps double")


def roll_cost(rolls: Mapping[str, float], symbol: str, weight: str, periods: int = 52) -> Column:
    """What holding ``weight`` costs in a period: the yearly rate of ``rolls`` (basis points by symbol, others 0) compounded down to a period."""
    rate = F.lit(0.0)
    for name, bps in rolls.items():
        rate = F.when(F.col(symbol) == name, (1 + bps / 10_000) ** (1 / periods) - 1).otherwise(rate)
    return -rate * F.abs(weight)
