"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_made: list[str] = []
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` where it is set; else, and in local mode only, a folder inside the warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("on a cluster spark.checkpoint.dir must name a shared folder")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_marlspike"


def folder(spark: SparkSession, tag: str, outlive: bool = False) -> str:
    """A new folder's path in the shared folder; it goes as what is settled goes."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    lists = (_made, *_scopes.get())
    lists[max(len(lists) - 1 - outlive, 0)].append(path)
    return path


def settle(df: DataFrame, tag: str = "settled", outlive: bool = False) -> DataFrame:
    """``df`` written as Parquet and read back: what is used several times is computed once, and a lost executor costs one stage.

    Inside a :func:`scratch` block it goes with the block, unless it is to ``outlive`` it.
    """
    path = folder(df.sparkSession, tag, outlive)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    n = len(paths)
    while paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is settled inside the block is deleted at its end: a result must be settled to ``outlive`` it, or be computed in it."""
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        _delete(spark, mine)


def discard(spark: SparkSession) -> int:
    """Deletes what has been settled so far outside :func:`scratch`, once results that read it are written; returns how many folders there were."""
    return _delete(spark, _made)
