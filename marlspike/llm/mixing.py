"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 4).

Targets: every source gets its weight's share of the words asked for, but no more than
``CEILING`` times its own words; what a source cannot take is shared again by weight.  A
source's target is met by complete epochs of all its documents first; what is left is filled
by sampling without repetition: each document gets the key ``-ln(u) / quality`` with ``u``
drawn from a hash of the seed and its id, documents are sorted by key within the source, and
taken while the running sum of their words keeps to the budget (the last one if that comes
nearer).

The running sum is taken in two steps, as one source may hold most rows: a source's keys are
cut into about as many ranges as a range has rows, sums of ranges come first, and rows are
then summed inside their range.

Cases: null and empty texts have no words and are never taken beyond complete epochs (taken
is 0); a null source is a source of its own and comes last; repeated rows have equal keys and
are taken one after the other; a source without words has target 0; an empty table gives an
empty result; extra columns are ignored by :func:`mix` and returned by :func:`mixed_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlspike.llm.common import materialise, row_key

WEIGHTS, SHARE, CEILING = (3, 1, 2), 1.5, 2.0
WORD = r"[^\x20\x09-\x0D]+"


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``source``, ``source_size``, ``n`` and ``target`` from each source's words (``source_size``) and rows (``n``).

    One row a source: with the sources in the order of ceiling by weight, the first ``k`` stop at
    their ceilings where that leaves no other above its own.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("w", weight).withColumn("cap", F.col("source_size") * ceiling)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    t = t.withColumn("ask", F.sum("source_size").over(Window.partitionBy()) * share)
    t = t.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("rest", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    t = t.withColumn("level", (F.col("ask") - F.col("before")) / F.col("rest"))
    # The first source whose share at this level stays below its ceiling sets the level of all that follow.
    t = t.withColumn("fits", F.col("level") * F.col("w") <= F.col("cap"))
    first = F.first(F.when(F.col("fits"), F.col("level")), ignorenulls=True)
    t = t.withColumn("at", first.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return t.select("source", "source_size", "n", F.coalesce(F.col("at") * F.col("w"), F.col("cap")).alias("target"))


#: Middles of the ranges of quality that are counted to spread a source's keys evenly.
_LEVELS = [(i + 0.5) / 20 for i in range(20)]


def quality(text: Column) -> Column:
    """A document's weight in sampling, 0.05 to 1: the share of its characters that are letters or white space."""
    rest = F.char_length(F.regexp_replace(text, r"[\p{L}\x20\x09-\x0D]++", ""))  # runs of letters go at once: little is copied
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide(F.char_length(text) - rest, F.char_length(text)), F.lit(0.05)))


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, weight: Column | None = None
) -> DataFrame:
    """Every row's ``size``, ``source_size``, ``target`` and ``taken`` (words), with ``epochs`` (times taken) and its key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    k1, k2 = row_key(id_col, text, source_col)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, source_col), 11) + 0.5) / float(1 << 53)
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (quality(text) if weight is None else weight).cast("double").alias("q"), u.alias("u"), k1, k2,
    ).select("*", (-F.log("u") / F.col("q")).alias("key"))
    rows = materialise(rows.drop("u"), "sized")
    level = F.least(F.greatest(F.floor(F.col("q") * 20), F.lit(0)), F.lit(19))
    levels = F.array(*(F.count_if(level == i) / F.count(F.lit(1)) for i in range(20))).alias("levels")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), levels)
    shares, totals = totals.select(F.col("source").alias("_s"), "levels"), totals.drop("levels")
    plan = targets(totals).withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialise(plan.join(shares, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "targets")
    same = rows["source"].eqNullSafe(plan["source"])
    # The share of the source's keys to expect below this one: it grows with the key, so ranges keep the order of keys.
    below = sum((F.col("levels")[i] * (1 - F.exp(-F.col("key") * q)) for i, q in enumerate(_LEVELS)), F.lit(0.0))
    part = F.floor(below * F.ceil(F.sqrt("n")))
    dealt = rows.join(plan, same).drop(plan["source"]).withColumn("part", part)
    sums = dealt.groupBy("source", "part").agg(F.sum("size").alias("held"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_source"), F.col("part").alias("_part"), F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("ahead")
    )
    within = Window.partitionBy("source", "part").orderBy("key", "_id", "_k1", "_k2").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = dealt.withColumn("run", F.sum("size").over(within))
    run = run.join(sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
    upto = F.col("ahead") + F.col("run")
    # A document at the edge of the budget is taken if that comes nearer to it than leaving it.
    more = (upto - F.col("size") / 2.0 <= F.col("budget")) & (F.col("size") > 0) & (F.col("budget") > 0)
    epochs = F.when(F.col("size") > 0, F.col("whole") + F.when(more, 1).otherwise(0)).otherwise(F.col("whole")).cast("int")
    return run.select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target", (epochs * F.col("size")).cast("long").alias("taken"),
        epochs.alias("epochs"), "_k1", "_k2",
    )


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with all its columns."""
    plan = mix(df, id_col, text_col, source_col, seed).groupBy("_k1", "_k2").agg(F.sum("epochs").alias("_times"), F.count(F.lit(1)).alias("_same"))
    k1, k2 = row_key(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")), source_col)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), k1, k2)
    again = F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1)))
    # Rows that are the same in every respect share what was decided for them together.
    times = F.floor(F.col("_times") / F.col("_same")) + F.when(F.col("_again") <= F.col("_times") % F.col("_same"), 1).otherwise(0)
    out = rows.join(plan.filter("_times > 0"), ["_k1", "_k2"]).withColumn("_again", again).withColumn("_n", times.cast("int"))
    return out.filter("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_epoch")).select("_row.*")
