"""Column functions of the strategies."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def usable(x: Column) -> Column:
    """Positive and finite."""
    return x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf"))


def trend_sign(x: Column, eps: float = 0.0) -> Column:
    """1, -1, or 0 within ``eps`` of 0; null stays null."""
    return F.when(x > eps, 1).when(x < -eps, -1).when(x.isNotNull(), 0)


def sign_label(sign: Column) -> Column:
    return F.when(sign > 0, "BUY").when(sign < 0, "SELL").otherwise("NEUTRAL")


def vol_scale(vol: Column, target: float, cap: float | None = None) -> Column:
    """``target / vol``, at most ``cap``; null where the volatility cannot be used."""
    scale = F.lit(target) / F.when(usable(vol), vol)
    return F.when(usable(vol), F.least(scale, F.lit(cap)) if cap is not None else scale)


def position(sign: Column, vol: Column, target: float, cap: float | None = None, scaling: bool = True) -> Column:
    """Signed size: 0 when flat even without a usable volatility, the bare sign without scaling."""
    sized = sign * vol_scale(vol, target, cap) if scaling else sign.cast("double")
    return F.when(sign == 0, 0.0).otherwise(sized)


def cost(dw: Column, bps: Column | float, multiplier: Column | float = 1.0) -> Column:
    """Return lost to trading ``dw`` of weight, never positive."""
    bps, multiplier = (x if isinstance(x, Column) else F.lit(float(x)) for x in (bps, multiplier))
    return -(bps * multiplier / 10_000.0) * F.abs(dw)


@F.pandas_udf(DoubleType())
def normal_cdf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Normal distribution function; meant for one row a strategy, Spark having no error function."""
    for x in batches:
        yield x.map(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)), na_action="ignore").astype(float)


@F.pandas_udf(DoubleType())
def normal_quantile(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Inverse of :func:`normal_cdf`, null outside 0 to 1."""
    from statistics import NormalDist

    quantile = NormalDist().inv_cdf
    for p in batches:
        yield p.map(lambda v: quantile(v) if 0 < v < 1 else None, na_action="ignore").astype(float)
