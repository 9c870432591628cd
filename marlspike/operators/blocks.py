"""Ordered scans of long keys in blocks.

What a row needs of all rows before it (their number, a last known value) is found in two levels: inside a block of a
key, which is a month of its time, by a window; across the blocks by a fold over one short array a key.  So no window holds a
key's whole history: the months of a key are worked on side by side, and rows are shuffled once, by key and block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BLOCK = "_block"
#: Values of a whole-numbered order column that make a block.
SPAN = 4096


def block_of(df: DataFrame, order: str) -> Column:
    """The month of a date or time, the span of a whole number; other orders have one block."""
    kind = df.schema[order].dataType.simpleString()
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.coalesce(F.year(order) * 12 + F.month(order), F.lit(-1))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(F.floor(F.col(order) / SPAN).cast("long"), F.lit(-(1 << 62)))
    return F.lit(0)


def with_block(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn(BLOCK, block_of(df, order))


def _headed(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """``rows`` and, for each block, a row with what is carried into it (``_head``), so that one shuffle brings both together."""
    return rows.unionByName(carried.withColumn("_head", F.lit(True)), allowMissingColumns=True)


def _within(key: Sequence[str], order: Sequence[str], at: Sequence[str] = (BLOCK,)) -> WindowSpec:
    """A block's rows in order behind its head."""
    return Window.partitionBy(*key, *at).orderBy(F.col("_head").desc_nulls_last(), *order)


def fold(
    ends: DataFrame, key: Sequence[str], start: Mapping[str, str], step: Mapping[str, str], at: Sequence[str] = (BLOCK,), emit: Mapping[str, str] | None = None
) -> DataFrame:
    """What is carried into each block: ``key``, the columns ``at`` that tell a key's blocks in order, and a column for each of ``emit`` (by default of ``start``).

    ``ends`` has a row a key and block.  ``start`` gives each carried value before a key's first block and ``step`` its value
    after a block, both in SQL: ``a`` is what was carried into the block (a struct), ``x`` the block's row, ``s`` all rows of the key.
    ``emit`` is said in ``a`` and ``x`` too.
    """
    emit = emit or {n: f"a.{n}" for n in start}
    rest = [c for c in ends.columns if c not in key and c not in at]
    packed = ends.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*at, *rest))).alias("s"))
    fields = lambda by: ", ".join(f"{v} as {n}" for n, v in by.items())
    out = f"struct({', '.join(f'x.{c} as {c}' for c in at)}, {fields(emit)})"
    first = f"struct({fields(start)})"
    # An empty array of the right type to begin with.
    empty = f"slice(transform(array(get(s, 0)), x -> transform(array({first}), a -> {out})[0]), 2, 0)"
    scan = f"""aggregate(s, struct({first} as now, {empty} as out), (b, x) -> struct(
        transform(array(b.now), a -> struct({fields(step)}))[0] as now, concat(b.out, transform(array(b.now), a -> {out})) as out)).out"""
    return packed.select(*key, F.inline(F.expr(scan)))


def numbered(df: DataFrame, key: Sequence[str], order: str, name: str = "_i") -> DataFrame:
    """``df`` with its ``_block`` and the number of each row within its key, from 0."""
    rows = with_block(df, order)
    carried = fold(rows.groupBy(*key, BLOCK).agg(F.count(F.lit(1)).alias("n")), key, {"_before": "0L"}, {"_before": "a._before + x.n"})
    inside = _within(key, [order])
    both = _headed(rows, carried).withColumn(name, F.first("_before").over(inside) + F.row_number().over(inside) - 2)
    return both.filter("_head is null").drop("_head", "_before")


def last_known(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Mapping[str, Column], inclusive: bool = False) -> DataFrame:
    """``df`` with its ``_block`` and, for each of ``values``, the last one that is not null among the key's rows before each row.

    ``order``'s first column tells the block; ``inclusive`` counts the row itself.
    """
    rows = with_block(df, order[0])
    rows = rows.select("*", *(v.alias(f"_v_{n}") for n, v in values.items()))
    place = F.struct(*(F.col(c) for c in order))
    ends = rows.groupBy(*key, BLOCK).agg(*(F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)).alias(f"_v_{n}") for n in values))
    kinds = {f.name: f.dataType.simpleString() for f in ends.schema.fields if f.name.startswith("_v_")}
    carried = fold(ends, key, {n: f"cast(null as {k})" for n, k in kinds.items()}, {n: f"coalesce(x.{n}, a.{n})" for n in kinds})
    until = _within(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    both = _headed(rows, carried).select("*", *(F.last(f"_v_{n}", ignorenulls=True).over(until).alias(n) for n in values))
    return both.filter("_head is null").drop("_head", *kinds)
