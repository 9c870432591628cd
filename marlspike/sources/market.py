"""Market-shaped frames derived from the order tables: prices, actions, series, vintages, interest windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CAPPED = "1-URGENT"
CLASSES = {"1-URGENT": "crypto", "2-HIGH": "equity", "3-MEDIUM": "bond", "4-NOT SPECIFIED": "commodity", "5-LOW": "credit"}
BPS = {"crypto": 80.0, "equity": 5.0, "bond": 4.0, "commodity": 12.0, "credit": 8.0}
EPOCHS = ("1996-07-01", "1998-01-01", "1999-07-01", "2001-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, key: str = "o_orderpriority") -> DataFrame:
    """Daily bars of a walk index driven by each day's mean order price."""
    orders = table(spark, sf_dir, "orders").filter("o_totalprice is not null and o_orderdate is not null")
    days = orders.groupBy(F.col(key).cast("string").alias("symbol"), F.to_date("o_orderdate").alias("d")).agg(F.avg("o_totalprice").alias("p"), F.count(F.lit(1)).alias("v"))
    along = Window.partitionBy("symbol").orderBy("d")
    days = days.withColumn("x", F.col("p") / F.avg("p").over(Window.partitionBy("symbol")) - 1)
    run = F.sum("x").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    days = days.withColumn("close", 100.0 * F.exp(0.05 * run)).withColumn("open", F.coalesce(F.lag("close").over(along), "close"))
    return days.select(
        "symbol", "d", "open", (F.greatest("open", "close") * 1.01).alias("high"), (F.least("open", "close") * 0.99).alias("low"), "close", F.col("v").cast("double").alias("volume")
    )


def actions(prices: DataFrame) -> DataFrame:
    """Two splits of 2:1, a dividend on each quarter's first day, factors missing on some days."""
    month = Window.partitionBy("symbol", F.trunc("d", "month"))
    quarter = Window.partitionBy("symbol", F.trunc("d", "quarter"))
    split = (F.col("d") == F.min("d").over(month)) & (
        ((F.col("symbol") == "2-HIGH") & (F.trunc("d", "month") == F.lit("1997-06-01").cast("date")))
        | ((F.col("symbol") == "3-MEDIUM") & (F.trunc("d", "month") == F.lit("1999-03-01").cast("date")))
    )
    return prices.select(
        "symbol", "d", "close", F.when(split, 2.0).when(F.dayofmonth("d") == 13, None).otherwise(1.0).alias("split_factor"),
        F.when(F.col("d") == F.min("d").over(quarter), 0.5).otherwise(0.0).alias("div_cash"),
    )


def calendar_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday series, one row a date."""
    items = table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    days = items.filter(F.dayofweek("d").between(2, 6)).groupBy("d").agg(
        (F.avg("l_extendedprice") / 1000).alias("dollar"), (F.avg("l_tax") * 100).alias("vix"), (F.avg("l_discount") * 100).alias("ten"),
        (F.avg("l_quantity") / 5).alias("two"), ((F.avg("l_discount") + F.avg("l_tax")) * 50).alias("funds"),
        F.count(F.lit(1)).cast("double").alias("addresses"), F.sum("l_quantity").alias("transactions"),
    )
    run = Window.partitionBy().orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("supply", 15_000_000.0 + 10 * F.sum("addresses").over(run))


def one_series(series: DataFrame, name: str) -> DataFrame:
    return series.select("d", F.col(name).alias("value"))


def score_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily score, one row a date."""
    return table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg((F.avg("l_tax") * 10).alias("value"))


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly totals as known over time: each later shipment revises its week's total."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("od"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.to_date("l_shipdate").alias("sd"), "l_quantity")
    known = orders.join(items, "o_orderkey").groupBy(F.trunc("od", "week").alias("obs"), F.greatest("od", "sd").alias("rs")).agg(F.sum("l_quantity").alias("q"))
    along = Window.partitionBy("obs").orderBy("rs")
    total = F.sum("q").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.coalesce(F.date_sub(F.lead("rs").over(along), 1), F.lit("9999-12-31").cast("date"))
    return known.select("obs", "rs", end.alias("re"), total.alias("value"))


def interest(spark: SparkSession, sf_dir: str, weeks: int = 80, step: int = 60) -> DataFrame:
    """Weekly order counts inside overlapping windows, each on its own scale of 0 to 100."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("term"), F.trunc(F.to_date("o_orderdate"), "week").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    week = (F.datediff("d", F.lit("1995-01-02").cast("date")) / 7).cast("int")
    last = F.floor(week / step)
    spread = counts.withColumn("_k", F.explode(F.sequence(F.greatest(F.lit(0), F.ceil((week - weeks + 1) / step)), F.greatest(last, F.lit(0)))))
    rows = spread.withColumn("window_start", F.date_add(F.lit("1995-01-02").cast("date"), (F.col("_k") * step * 7).cast("int")))
    top = F.max("n").over(Window.partitionBy("term", "window_start"))
    return rows.select("term", "window_start", "d", F.bround(100.0 * F.col("n") / top, 0).cast("long").alias("interest"))
