"""Every query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from strandline import queries as core

SF = "/root/testdata/sf0.001"
QUERIES, SQL = core.queries(), core.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    result = duck.execute(SQL[name])
    at = [d[0] for d in result.description]
    assert sorted(at) == columns
    assert got == sorted(tuple(plain(r[at.index(c)]) for c in columns) for r in result.fetchall())


def test_entry_point(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns


def test_filter_by_support_keeps_every_call(spark):
    """Judging drops no call: it changes filters, types and origin."""
    from strandline.operators import calling, support

    records = calling.records(core.obs(spark, SF))
    judged = support.judge(records, core.DNA_LOW)
    assert judged.count() == records.count()
    assert judged.where("NOT array_contains(origin, 'DNA') OR size(filter) = 0").isEmpty()


def test_neighbour_quality_reads_whole_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(core.reads, "low_neighbours", lambda s, q: F.length(s))
    assert core.q_neighbour_quality(spark, SF).agg(F.max("low")).first()[0] > 60
