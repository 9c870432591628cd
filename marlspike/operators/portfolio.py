"""Weekly weight books from signals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlspike.functions.scalars import usable

SCHEMES = ("inverse_vol", "equal_vol", "risk_parity", "equal_weight")


@dataclass(frozen=True)
class PortfolioParams:
    """Weighting scheme and the cap on each capped leg; bad values are refused here."""

    scheme: str = "inverse_vol"
    cap: float = 0.20

    def __post_init__(self) -> None:
        if self.scheme not in SCHEMES:
            raise ValueError(f"scheme must be one of {SCHEMES}")
        if not 0 < self.cap <= 1:
            raise ValueError("cap must lie in (0, 1]")


def raw_weights(signals: DataFrame, params: PortfolioParams, book: Sequence[str]) -> DataFrame:
    """Weights of gross 1 in each book: signs spread evenly, or by inverse volatility (flat and unsized rows drop out)."""
    each = Window.partitionBy(*book)
    if params.scheme == "equal_weight":
        active = signals.filter(F.col("signal") != 0)
        return active.withColumn("weight", F.col("signal") / F.count(F.lit(1)).over(each))
    sized = signals.filter((F.col("signal") != 0) & usable(F.col("realized_vol_26w"))).withColumn("_raw", F.col("signal") / F.col("realized_vol_26w"))
    gross = F.sum(F.abs("_raw")).over(each)
    return sized.withColumn("_gross", gross).filter("_gross > 0").withColumn("weight", F.col("_raw") / F.col("_gross")).drop("_raw", "_gross")


def cap_sleeve(weights: DataFrame, cap: float, book: Sequence[str]) -> DataFrame:
    """Clips capped legs once and spreads what they give up over the others by weight; a book of capped legs only keeps its smaller gross."""
    each = Window.partitionBy(*book)
    over = F.when(F.col("is_capped"), F.greatest(F.abs("weight") - cap, F.lit(0.0))).otherwise(0.0)
    rows = weights.withColumns({"_freed": F.sum(over).over(each), "_other": F.sum(F.when(~F.col("is_capped"), F.abs("weight")).otherwise(0.0)).over(each)})
    clipped = F.signum("weight") * F.least(F.abs("weight"), F.lit(cap))
    grown = F.col("weight") * (1 + F.coalesce(F.try_divide("_freed", "_other"), F.lit(0.0)))
    return rows.withColumn("weight", F.when(F.col("is_capped"), clipped).otherwise(grown)).drop("_freed", "_other")


def build_weights(signals: DataFrame, params: PortfolioParams | None = None, by: Sequence[str] = ("week_start",), books: Sequence[bool] = (True, False)) -> DataFrame:
    """Both books of every week: with the capped sleeve, and without it (left out before weighting).

    ``signals``: the columns of ``by``, ``symbol``, ``signal``, ``realized_vol_26w``, ``is_capped``.
    """
    p = params or PortfolioParams()
    rows = signals.withColumn("include_capped", F.explode(F.array(*(F.lit(b) for b in books))))
    rows = rows.filter(F.col("include_capped") | ~F.col("is_capped"))
    book = [*by, "include_capped"]
    return cap_sleeve(raw_weights(rows, p, book), p.cap, book)
