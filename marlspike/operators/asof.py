"""Point-in-time joins.

:func:`asof` sweeps both sides once, in time order within a key: the sides are tagged and
unioned, and each left row takes the last right row before it, found in the month's rows or carried
into the month (:mod:`marlspike.operators.blocks`).  There is no range join and no window over a whole key.
:func:`vintage_asof` files validity intervals under the months they span, so the join is on
equality.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.operators.blocks import last_known


def _sweep(left: DataFrame, rights: Mapping[str, tuple[DataFrame, Sequence[str]]], by: Sequence[str], t: str, strict: bool) -> DataFrame:
    """``left`` with a struct column for each right side; every right side has ``by``, ``_t`` and its value columns."""
    row = F.struct(*(F.col(c) for c in left.columns))
    sides = [left.select(*by, F.col(t).alias("_t"), F.lit(0 if strict else 1).alias("_side"), row.alias("_left"))]
    for name, (df, values) in rights.items():
        packed = F.struct(*(F.col(v) for v in values)).alias(name)
        sides.append(df.select(*by, "_t", F.lit(1 if strict else 0).alias("_side"), packed))
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side, allowMissingColumns=True)
    if not by:  # calendar series, one row a date: one window over dates, never over fact rows
        until_now = Window.orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return every.select("_left", *(F.last(name, ignorenulls=True).over(until_now).alias(name) for name in rights)).filter("_left is not null")
    found = last_known(every, by, ["_t", "_side"], {f"_at_{name}": F.col(name) for name in rights}, inclusive=True)
    return found.filter("_left is not null").select("_left", *(F.col(f"_at_{name}").alias(name) for name in rights))


def asof_many(
    left: DataFrame, rights: Mapping[str, tuple[DataFrame, str, Sequence[str]]], t: str, by: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """``left`` with the latest row of each right side at or before ``t`` (before it, if ``strict``).

    ``rights`` maps a name to a frame, its time column and its value columns.  Without ``by`` the
    right sides are calendar series, one row a date: the sweep then runs over the distinct times of
    ``left`` only, and its result is joined back on the time.  One pass serves all right sides.
    """
    prepared = {n: (df.withColumn("_t", F.col(rt)), values) for n, (df, rt, values) in rights.items()}
    columns = [F.col(f"{n}.{v}").alias(v) for n, (_, _, values) in rights.items() for v in values]
    if by:
        swept = _sweep(left, prepared, by, t, strict)
        return swept.select("_left.*", *columns)
    times = _sweep(left.select(t).distinct(), prepared, (), t, strict).select(F.col(f"_left.{t}").alias("_at"), *columns)
    return left.join(times, F.col(t) == F.col("_at"), "left").drop("_at")


def asof(
    left: DataFrame, right: DataFrame, t: str, right_t: str, values: Sequence[str], by: Sequence[str] = (), strict: bool = False, lag_days: int = 0
) -> DataFrame:
    """Latest right row with ``right_t + lag_days <= t`` (``<`` if strict) for each left row; left rows without one get nulls."""
    shifted = right.withColumn("_shifted", F.date_add(right_t, lag_days)) if lag_days else right.withColumn("_shifted", F.col(right_t))
    return asof_many(left, {"_right": (shifted, "_shifted", list(values))}, t, by, strict)


def _month(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def vintage_asof(
    left: DataFrame, vintages: DataFrame, t: str, obs: str, start: str, end: str, value: str, lookback_days: Mapping[str, int]
) -> DataFrame:
    """Value of the latest observation known at ``t``, for each lookback, in one pass.

    A vintage is known from ``start`` to ``end`` (both included).  ``lookback_days`` maps an output
    column to the least age in days of the observation.  Ties in ``obs`` go to the later ``start``.
    """
    days = left.select(F.col(t).alias("_d")).distinct()
    low, high = days.agg(F.min("_d"), F.max("_d")).first()
    if low is None:
        return left.select("*", *(F.lit(None).cast(vintages.schema[value].dataType).alias(n) for n in lookback_days))
    first, last = F.greatest(start, F.lit(low)), F.least(end, F.lit(high))
    filed = vintages.filter((F.col(start) <= F.lit(high)) & (F.col(end) >= F.lit(low)) & F.col(value).isNotNull()).select(
        F.col(obs).alias("_obs"), F.col(start).alias("_start"), F.col(end).alias("_end"), F.col(value).alias("_value"),
        F.explode(F.sequence(_month(first), _month(last))).alias("_month"),
    )
    known = days.withColumn("_month", _month(F.col("_d"))).join(filed, "_month").filter("_start <= _d and _d <= _end")
    picks = [
        F.max_by("_value", F.when(F.col("_obs") <= F.date_sub("_d", n), F.struct("_obs", "_start"))).alias(name) for name, n in lookback_days.items()
    ]
    return left.join(known.groupBy("_d").agg(*picks), F.col(t) == F.col("_d"), "left").drop("_d")


def offset_join(left: DataFrame, right: DataFrame, t: str, right_t: str, days: int, values: Sequence[str]) -> DataFrame:
    """Inner join on ``right_t = t + days``: undoes a publication lag."""
    side = right.select(F.date_sub(right_t, days).alias("_t"), *values)
    return left.join(side, F.col(t) == F.col("_t")).drop("_t")
