"""Layered Parquet tables with key-based upserts and filtered deletes.

A table is partitioned by the month of its time column.  Every change writes new files into a
fresh folder and then a small snapshot, a JSON file that names the folders which hold each month.
The snapshot is written whole under another name and becomes the newest by one rename, so that readers
see the table before or after a change and never between; files are not changed once written.
An upsert reads only the months that its batch touches and names new folders for exactly those.

A writer may be lost at any step.  Before its snapshot lies there whole, nothing has happened (its
files are swept by the next writer); after that the next writer, or :meth:`Catalog.recover`, finishes
the rename, deletes included.  One writer a table is assumed: of two, the later fails.  The last
``keep`` snapshots and their files stay for readers that still use them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.schemas import TABLES, Table
from marlspike.sources.shared import scratch, settle

MONTH = "_month"
LAYERS = ("bronze", "silver", "gold")


def latest(batch: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One row a key: the one with the greatest ``order``, of equal ones that with the greatest values in the other columns' order."""
    rest = [c for c in batch.columns if c not in keys and c != order]
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in ([order] if order else []) + rest), *([] if order or rest else [F.lit(1)]))
    return batch.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, order: str | None = "datetime_update") -> DataFrame:
    """``target`` after the upsert: new keys are added; on a match the ``update`` columns (default: all) come from the batch."""
    batch = latest(batch, keys, order if order in batch.columns else None).select(*target.columns)
    if update is None:
        rows = target.withColumn("_gen", F.lit(0)).unionByName(batch.withColumn("_gen", F.lit(1)))
        w = Window.partitionBy(*keys).orderBy(F.col("_gen").desc())
        return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_gen")
    kept = [c for c in target.columns if c not in keys]
    old, new = target.alias("o"), batch.alias("n")
    match = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    there, came = F.col(f"o._there"), F.col(f"n._came")
    joined = old.withColumn("_there", F.lit(True)).alias("o").join(new.withColumn("_came", F.lit(True)).alias("n"), match, "full")
    cols = [F.coalesce(f"o.{k}", f"n.{k}").alias(k) if k in keys else _pick(k, k in update, there, came).alias(k) for k in target.columns if k in keys or k in kept]
    return joined.select(*cols)


def _pick(name: str, updated: bool, there: Column, came: Column) -> Column:
    old, new = F.col(f"o.{name}"), F.col(f"n.{name}")
    return F.when(came.isNull(), old).when(there.isNull(), new).otherwise(new if updated else old)


class Catalog:
    """Tables under one root folder, which must be shared by the cluster."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, Table] = TABLES, keep: int = 2) -> None:
        self.spark, self.root, self.tables, self.keep = spark, root.rstrip("/"), dict(tables), keep

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _names(self, path: str) -> list[str]:
        """What lies in a folder, empty if there is none."""
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _snapshots(self, name: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.path(name)}/_snapshots") if re.fullmatch(r"\d+\.json", n))

    def _snapshot(self, name: str, number: int) -> dict[str, list[str]]:
        """The folders that hold each month; a table without months has the one month ``""``."""
        fs, p = self._fs(f"{self.path(name)}/_snapshots/{number}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _newest(self, name: str) -> tuple[int, dict[str, list[str]]]:
        there = self._snapshots(name)
        return (there[-1], self._snapshot(name, there[-1])) if there else (0, {})

    def exists(self, name: str) -> bool:
        """Whether the table was ever written."""
        return bool(self._snapshots(name))

    def _rows(self, name: str, months: tuple[str | None, str | None] = (None, None)) -> DataFrame:
        """The stored rows; of a partitioned table with ``MONTH``, the partition column itself, so that filters on it prune files."""
        table, (_, live) = self.tables[name], self._newest(name)
        schema = table.schema.add(MONTH, "string") if table.partition else table.schema
        top = self.path(name)
        held = [f"{top}/{folder}/{MONTH}={m}" if table.partition else f"{top}/{folder}" for m, folders in sorted(live.items()) for folder in folders]
        if not held:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", top).parquet(*held).select(*schema.names)
        if table.partition:
            low, high = months
            rows = rows.filter(F.col(MONTH) >= low) if low else rows
            rows = rows.filter(F.col(MONTH) <= high) if high else rows
        return rows

    def read(self, name: str, start: date | None = None, end: date | None = None) -> DataFrame:
        """The table, empty if it was never written; ``start`` and ``end`` bound the days of its time column and the months that are read."""
        table = self.tables[name]
        if not table.partition:
            if start or end:
                raise ValueError(f"{name} has no time column to bound")
            return self._rows(name)
        rows = self._rows(name, (f"{start:%Y-%m}" if start else None, f"{end:%Y-%m}" if end else None))
        day = F.to_date(table.partition)
        rows = rows.filter(day >= F.lit(start)) if start else rows
        rows = rows.filter(day <= F.lit(end)) if end else rows
        return rows.select(*table.schema.names)

    @staticmethod
    def _month(table: Table) -> Column:
        return F.coalesce(F.date_format(table.partition, "yyyy-MM"), F.lit("none"))

    @staticmethod
    def _shaped(table: Table, rows: DataFrame) -> DataFrame:
        """``rows`` with the table's columns and types, null where they have none."""
        return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields))

    def _write(self, name: str, rows: DataFrame) -> dict[str, list[str]]:
        """Writes ``rows`` into a fresh folder; returns it for each month that has rows.  A large month is split over several tasks."""
        table, folder = self.tables[name], f"_v={uuid.uuid4().hex}"
        path = f"{self.path(name)}/{folder}"
        if not table.partition:
            rows.select(*table.schema.names).write.parquet(path)
            return {"": [folder]}
        rows.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *table.key).write.partitionBy(MONTH).parquet(path)
        return {n.partition("=")[2]: [folder] for n in self._names(path) if n.startswith(f"{MONTH}=")}

    def _stage(self, name: str, number: int, live: dict[str, list[str]]) -> str:
        """Writes snapshot ``number`` whole, under a name that readers do not see."""
        top = f"{self.path(name)}/_snapshots"
        part, whole = f"{top}/{number}.part-{uuid.uuid4().hex}", f"{top}/{number}.next-{uuid.uuid4().hex}"
        fs, p = self._fs(part)
        out = fs.create(p, False)
        out.write(bytearray(json.dumps(live).encode()))
        out.close()
        fs.rename(p, self._fs(whole)[1])
        return whole

    def _flip(self, name: str, staged: str, number: int) -> None:
        """Makes a staged snapshot the newest."""
        fs, p = self._fs(f"{self.path(name)}/_snapshots/{number}.json")
        if fs.exists(p) or not fs.rename(self._fs(staged)[1], p):
            raise RuntimeError(f"{name} was changed by another writer")

    def _commit(self, name: str, number: int, live: dict[str, list[str]]) -> None:
        self._flip(name, self._stage(name, number, live), number)
        self._sweep(name)

    def _replace(self, name: str, rows: DataFrame, months: Iterable[str] | None) -> None:
        """Puts ``rows`` in place of the given months, or of the whole table; months that lose their last row go."""
        number, live = self._newest(name)
        kept = {} if months is None else {m: f for m, f in live.items() if m not in set(months)}
        self._commit(name, number + 1, kept | self._write(name, rows))

    def _sweep(self, name: str) -> None:
        """Deletes old snapshots, what lost writers left, and folders that no snapshot names."""
        top = self.path(name)
        there = self._snapshots(name)
        kept = there[-self.keep :]
        used = {folder for n in kept for folders in self._snapshot(name, n).values() for folder in folders}
        for n in self._names(f"{top}/_snapshots"):
            if n not in {f"{k}.json" for k in kept}:
                self._delete(f"{top}/_snapshots/{n}")
        for n in self._names(top):
            if n.startswith("_v=") and n not in used:
                self._delete(f"{top}/{n}")

    def recover(self, name: str) -> int:
        """Finishes the change of a lost writer whose snapshot lies there whole, and sweeps what others left; returns how many were finished."""
        number = (self._snapshots(name) or [0])[-1]
        staged = [n for n in self._names(f"{self.path(name)}/_snapshots") if n.startswith(f"{number + 1}.next-")]
        for n in staged[:1]:
            self._flip(name, f"{self.path(name)}/_snapshots/{n}", number + 1)
        self._sweep(name)
        return len(staged[:1])

    def upsert(self, name: str, batch: DataFrame, update: Sequence[str] | None = None, order: str | None = "datetime_update") -> None:
        """Merges ``batch`` by the table's key.  An empty batch changes nothing, and a replay changes nothing.  The batch is worked out once."""
        table = self.tables[name]
        self.recover(name)
        with scratch(self.spark):
            self._merge(name, table, settle(self._shaped(table, batch), "batch"), update, order)

    def _merge(self, name: str, table: Table, batch: DataFrame, update: Sequence[str] | None, order: str | None) -> None:
        if not table.partition:
            if not batch.isEmpty():
                self._replace(name, merged(self.read(name), batch, table.key, update, order), None)
            return
        batch = batch.withColumn(MONTH, self._month(table))
        months = [r[0] for r in batch.select(MONTH).distinct().collect()]  # months of one batch
        if months:
            touched = self._rows(name).filter(F.col(MONTH).isin(months))
            self._replace(name, merged(touched, batch, table.key, update, order), months)

    def seed(self, name: str, rows: DataFrame) -> None:
        """Adds rows whose key is not there yet; others stay as they are.  Of rows with one key the one with the greatest values is added."""
        fresh = rows.join(self.read(name), list(self.tables[name].key), "left_anti")
        self.upsert(name, fresh, order=None)

    def append(self, name: str, rows: DataFrame) -> None:
        """Appends to a ledger."""
        table = self.tables[name]
        self.recover(name)
        rows = self._shaped(table, rows)
        number, live = self._newest(name)
        new = self._write(name, rows.withColumn(MONTH, self._month(table)) if table.partition else rows)
        self._commit(name, number + 1, live | {m: live.get(m, []) + folders for m, folders in new.items()})

    def activate(self, name: str, version: int) -> None:
        """Makes one parameter version the only active one, in one overwrite."""
        self.recover(name)
        rows = self.read(name)
        if rows.filter(F.col("param_version") == version).isEmpty():
            raise ValueError(f"{name} has no version {version}")
        self._replace(name, rows.withColumn("is_active", F.col("param_version") == version), None)

    def active(self, name: str) -> dict:
        """The active parameters of the highest version; none is an error."""
        row = self.read(name).filter("is_active").orderBy(F.desc("param_version")).limit(1).first()
        if row is None:
            raise ValueError(f"{name} has no active version")
        return row.asDict()

    def clean_tables(self, symbol: str, temporality: str, start: date | str, end: date | str, layer: str = "all", dry_run: bool = True) -> dict[str, int]:
        """Counts, and unless ``dry_run`` deletes (each table in one change), rows by symbol, temporality and dates; ``all`` must be written out to match everything."""
        if layer not in (*LAYERS, "all"):
            raise ValueError("unknown layer")
        if not all((symbol, temporality, start, end)):
            raise ValueError("every dimension needs a value; write 'all' to match everything")
        out = {}
        for name, table in self.tables.items():
            if not table.partition or (layer != "all" and not name.startswith(layer + ".")):
                continue
            if not dry_run:
                self.recover(name)
            if not self.exists(name):
                continue
            names = table.schema.names
            hit = F.lit(True)
            if symbol != "all":
                hit = hit & (F.col("symbol") == symbol)
            if temporality != "all" and "temporality" in names:
                hit = hit & (F.col("temporality") == temporality)
            day = F.to_date(table.partition)
            if start != "all":
                hit = hit & (day >= F.lit(start).cast("date"))
            if end != "all":
                hit = hit & (day <= F.lit(end).cast("date"))
            hit = F.coalesce(hit, F.lit(False))
            bound = tuple(None if x == "all" else str(x)[:7] for x in (start, end))
            rows = self._rows(name, bound)
            out[name] = rows.filter(hit).count()
            if out[name] and not dry_run:
                months = [r[0] for r in rows.filter(hit).select(MONTH).distinct().collect()]
                self._replace(name, self._rows(name).filter(F.col(MONTH).isin(months) & ~hit), months)
        return out
