"""Every registered market query against its SQL on the smallest tables."""

import duckdb
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from marlspike.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Queries that join a side of one row (bounds, a gate), which needs no key.
ONE_ROW_SIDES = {"experiment_grid", "experiment_ledger", "newey_west", "overfit_probability", "overfit_probability_20", "signal_checks", "signal_checks_faults"}


#: Queries that need more weeks than the smallest tables have.
LARGER = {n: "/root/testdata/sf0.01" for n in ("overfit_probability_20", "overfit_probability_tiled")}


def views(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def con(small):
    return views(small)


@pytest.fixture
def written(monkeypatch):
    """Plans of everything that is written as Parquet on the way to a result."""
    plans, plain = [], DataFrameWriter.parquet

    def parquet(self, *args, **more):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return plain(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, small, con, name, written):
    if name in LARGER:
        small, con = LARGER[name], views(LARGER[name])
    df = catalogue.QUERIES[name](spark, small)
    for plan in (*written, df._jdf.queryExecution().executedPlan().toString()):
        assert name in ONE_ROW_SIDES or ("NestedLoop" not in plan and "Cartesian" not in plan)
        assert plan.count("lineitem.parquet") <= 3
    columns = sorted(df.columns)
    want = con.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    got = sorted(map(str, map(tuple, df.select(*columns).collect())))
    assert got == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["symbol", "d", "rsi", "in_trend", "signal"] and df.count() > 0
