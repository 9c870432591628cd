"""Performance and overfit statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marlspike.functions.scalars import normal_cdf, normal_quantile

_GAMMA = 0.5772156649
#: Numbers that :func:`pbo` broadcasts at most.
MOST_SUMS = 1 << 20


def _guarded(mean: Column, spread: Column, ppy: int, same: Column) -> Column:
    return F.when(same, 0.0).otherwise(F.try_divide(mean, spread) * math.sqrt(ppy))


def compounded(growth: Column, over: WindowSpec | None = None) -> Column:
    """Product of growth factors, as an aggregate or over a window: 0 from a factor of 0 on, its sign changed by each negative one; nulls count as 1."""
    on = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    size = on(F.sum(F.when(growth != 0, F.ln(F.abs(growth)))))
    lost, turns = on(F.count_if(growth == 0)), on(F.count_if(growth < 0))
    return F.when(lost > 0, 0.0).otherwise(F.exp(F.coalesce(size, F.lit(0.0))) * F.when(turns % 2 == 1, -1.0).otherwise(1.0))


def equity(df: DataFrame, by: Sequence[str], order: str, r: str) -> DataFrame:
    """``df`` with ``equity`` (compounded from 1) and ``drawdown`` (against the peak so far, at least 1).

    A return of -1 leaves nothing from there on; one below -1 turns the sign, as compounding says.
    """
    run = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("equity", compounded(1 + F.col(r), run))
    peak = F.greatest(F.lit(1.0), F.max("equity").over(run))
    return rows.withColumn("drawdown", F.col("equity") / peak - 1)


def period_stats(df: DataFrame, by: Sequence[str], order: str = "return_week", r: str = "net", ppy: int = 52) -> DataFrame:
    """Sharpe, Sortino, yearly return, drawdown, Calmar and profit factor of each group, infinite ratios as null.

    Fewer than two rows or no variance give 0.  A total loss is a yearly return of -1; where losses beyond
    -1 leave a negative product, which has no yearly rate, that return and Calmar are null.
    """
    x = F.col(r)
    down = F.when(x < 0, x)
    rows = equity(df, by, order, r)
    a = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), (F.max(x) == F.min(x)).alias("flat"), F.count(down).alias("n_down"),
        F.stddev_samp(down).alias("down_sd"), F.max(F.abs(down)).alias("down_one"), (F.max(down) == F.min(down)).alias("down_flat"),
        compounded(1 + x).alias("growth"), F.least(F.min("drawdown"), F.lit(0.0)).alias("max_drawdown"),
        F.coalesce(F.sum(F.when(x > 0, x)), F.lit(0.0)).alias("gains"), F.coalesce(F.sum(F.abs(down)), F.lit(0.0)).alias("losses"),
    )
    few = F.col("n") < 2
    spread = F.when(F.col("n_down") == 1, F.col("down_one")).otherwise(F.col("down_sd"))
    sortino = F.when(few, 0.0).when(F.col("n_down") == 0, F.when(F.col("mean") <= 0, 0.0)).when((F.col("n_down") > 1) & F.col("down_flat"), 0.0).otherwise(
        F.col("mean") / spread * math.sqrt(ppy)
    )
    yearly = F.when(few, 0.0).when(F.col("growth") >= 0, F.pow("growth", ppy / F.col("n")) - 1)
    a = a.withColumns({"sharpe": F.when(few, 0.0).otherwise(_guarded(F.col("mean"), F.col("sd"), ppy, F.col("flat"))), "sortino": sortino, "annual_return": yearly})
    calmar = F.when(few, 0.0).when(F.col("max_drawdown") == 0, F.when(F.col("annual_return") <= 0, 0.0)).otherwise(F.col("annual_return") / -F.col("max_drawdown"))
    factor = F.when(F.col("losses") == 0, F.when(F.col("gains") == 0, 0.0)).otherwise(F.try_divide("gains", "losses"))
    return a.select(*by, "n", "sharpe", "sortino", "annual_return", "max_drawdown", calmar.alias("calmar"), factor.alias("profit_factor"))


def hac_tstat(pairs: DataFrame, by: Sequence[str], order: str, a: str, b: str, max_lag: int = 52) -> DataFrame:
    """Newey-West t statistic (Bartlett weights) of the mean of ``a - b``; 0 where the variance is not positive."""
    rows = pairs.select(*by, F.col(order).alias("_t"), (F.col(a) - F.col(b)).alias("d"))
    rows = rows.select("*", (F.row_number().over(Window.partitionBy(*by).orderBy("_t")) - 1).alias("i"), F.avg("d").over(Window.partitionBy(*by)).alias("m"))
    rows = rows.select(*by, "i", (F.col("d") - F.col("m")).alias("e"), "m")
    lagged = rows.select(*by, "e", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), "i").select(*by, "lag", (F.col("i") + F.col("lag")).alias("i"), F.col("e").alias("e0"))
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2.0 * (1 - F.col("lag") / (max_lag + 1)))
    sums = rows.join(lagged, [*by, "i"]).groupBy(*by).agg(F.sum(weight * F.col("e") * F.col("e0")).alias("s"))
    base = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.first("m").alias("mean_delta"))
    variance = F.col("s") / F.col("n")
    t = F.when(variance > 0, F.col("mean_delta") / F.sqrt(variance / F.col("n"))).otherwise(0.0)
    return base.join(sums, list(by)).select(*by, "n", "mean_delta", t.alias("t_stat")) if by else base.crossJoin(F.broadcast(sums)).select("n", "mean_delta", t.alias("t_stat"))


def deflated_sharpe(trials: DataFrame, trial: str = "trial", r: str = "r") -> DataFrame:
    """Probability that the best trial's Sharpe ratio exceeds what the best of as many idle trials would show."""
    x = F.col(r)
    each = trials.groupBy(trial).agg(
        F.count(F.lit(1)).alias("t"), F.try_divide(F.avg(x), F.stddev_samp(x)).alias("sr"), F.skewness(x).alias("skew"), (F.kurtosis(x) + 3).alias("kurt")
    )
    best = F.max(F.struct("sr", "t", "skew", "kurt", F.col(trial).alias("trial")))
    a = each.agg(F.count(F.lit(1)).alias("n_trials"), F.coalesce(F.stddev_samp("sr"), F.lit(0.0)).alias("sd"), best.alias("b")).select("n_trials", "sd", "b.*")
    a = a.withColumns({"z1": normal_quantile(1 - 1 / F.col("n_trials")), "z2": normal_quantile(1 - 1 / (F.col("n_trials") * math.e))})
    expected = F.when(F.col("n_trials") == 1, 0.0).otherwise(((1 - _GAMMA) * F.col("z1") + _GAMMA * F.col("z2")) * F.col("sd"))
    factor = F.greatest(F.lit(1e-12), 1 - F.col("skew") * F.col("sr") + (F.col("kurt") - 1) / 4 * F.col("sr") ** 2)
    a = a.withColumn("expected_max", expected).withColumn("_z", (F.col("sr") - F.col("expected_max")) / F.sqrt(factor / (F.col("t") - 1)))
    return a.select("n_trials", "trial", "sr", "expected_max", normal_cdf("_z").alias("deflated_sharpe"))


def pbo(trials: DataFrame, n_blocks: int = 20, trial: str = "trial", t: str = "t", r: str = "r") -> DataFrame:
    """Probability of backtest overfitting by combinatorially symmetric cross-validation.

    Returns are summed by trial and block; every choice of half the blocks is a bit mask, and each mask
    is scored from those sums (at most 31 blocks).  The sums are the one thing that is broadcast, so there
    may be ``MOST_SUMS`` of them (16 MB).  Ties in sample go to the first trial.
    """
    if n_blocks < 4 or n_blocks > 31:
        raise ValueError("n_blocks must lie between 4 and 31")
    n, n_trials = trials.agg(F.count_distinct(t), F.count_distinct(trial)).first()
    size = n // n_blocks
    if n_trials < 2 or size < 2:
        raise ValueError("needs two trials and two rows a block")
    if n_trials * n_blocks > MOST_SUMS:
        raise ValueError(f"more than {MOST_SUMS} sums of trials and blocks")
    i = F.row_number().over(Window.partitionBy(trial).orderBy(t)) - 1
    block = F.least(F.floor(i / size), F.lit(n_blocks - 1))
    sums = trials.select(F.col(trial).alias("_trial"), F.col(r).alias("_r"), block.alias("_b")).groupBy("_trial", "_b").agg(F.sum("_r").alias("s"), F.count(F.lit(1)).alias("n"))
    packed = sums.groupBy("_trial").agg(F.transform(F.sort_array(F.collect_list(F.struct("_b", "s", "n"))), lambda x: F.struct(x["s"].alias("s"), x["n"].alias("n"))).alias("blocks"))
    ranked = packed.withColumn("k", F.row_number().over(Window.orderBy("_trial")))
    table = ranked.agg(F.sort_array(F.collect_list(F.struct("k", "blocks"))).alias("all"))  # trials x blocks numbers
    masks = trials.sparkSession.range(1 << n_blocks).filter(F.bit_count("id") == n_blocks // 2).withColumnRenamed("id", "mask")
    paths = masks.join(F.broadcast(table))
    score = lambda bit: (
        f"transform(all, x -> struct(aggregate(sequence(0, {n_blocks - 1}), 0D, (a, i) -> a + if((shiftright(mask, i) & 1) = {bit}, x.blocks[i].s, 0D))"
        f" / aggregate(sequence(0, {n_blocks - 1}), 0L, (a, i) -> a + if((shiftright(mask, i) & 1) = {bit}, x.blocks[i].n, 0L)) as p, -x.k as k))"
    )
    scored = paths.select(F.expr(score(0)).alias("inside"), F.expr(score(1)).alias("outside"))
    best = scored.withColumn("k", -F.array_max("inside")["k"]).withColumn("p", F.expr("outside[cast(k - 1 as int)].p"))
    above = best.select((F.expr("size(filter(outside, x -> x.p > p))") + 1).alias("rank"))
    return above.agg(F.count(F.lit(1)).alias("n_paths"), F.avg((F.col("rank") / n_trials > 0.5).cast("double")).alias("pbo"))


def hlz(df: DataFrame, sharpe: str = "sharpe", n: str = "n", n_independent: int = 1) -> DataFrame:
    """``df`` with the t statistic after the haircut for ``n_independent`` tests, the haircut Sharpe ratio and ``significant``."""
    from statistics import NormalDist

    q = NormalDist().inv_cdf
    cut = 0.0 if n_independent <= 1 else q(1 - 0.5 / n_independent) * (1 - _GAMMA) + _GAMMA * q(1 - 0.5 / (n_independent * math.e))
    t = F.when(F.col(n) < 2, 0.0).otherwise(F.col(sharpe) / math.sqrt(52) * F.sqrt(n) - cut)
    rows = df.withColumn("t_stat", t)
    return rows.withColumns({"haircut_sharpe": F.when(F.col(n) < 2, 0.0).otherwise(F.col("t_stat") / F.sqrt(n) * math.sqrt(52)), "significant": F.col("t_stat") > 3.0})
