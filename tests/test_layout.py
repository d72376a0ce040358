"""Observations stored by place: merges without an exchange, regions as part of the scan."""

from __future__ import annotations

import pytest

from strandline import queries
from strandline.operators import calling
from strandline.sources import layout

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    obs = queries.obs(spark, SF)
    spark.sql("DROP TABLE IF EXISTS stored_obs")
    layout.store_observations(obs.where("sample <> 'RNA_TUMOR'"), "stored_obs", 4)
    layout.store_observations(obs.where("sample = 'RNA_TUMOR'"), "stored_obs", 4, mode="append")
    yield obs
    spark.sql("DROP TABLE stored_obs")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merges_need_no_exchange(spark, stored):
    table = layout.stored_observations(spark, "stored_obs")
    for f in (calling.merged_counts, calling.calls, lambda o: calling.allele_stats(o).groupBy("chrom", "pos").count(), calling.reference_codes):
        assert "Exchange" not in plan_of(f(table))
        assert "Exchange" in plan_of(f(stored))
    assert rows_of(calling.merged_counts(table)) == rows_of(calling.merged_counts(stored))
    assert rows_of(calling.calls(table).select("chrom", "pos", "alts", "mods")) == rows_of(calling.calls(stored).select("chrom", "pos", "alts", "mods"))


def test_a_region_is_part_of_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    part = layout.stored_observations(spark, "stored_obs", "7", 10, 120)
    plan = plan_of(part)
    assert "EqualTo(chrom,7)" in plan and "GreaterThanOrEqual(pos,10)" in plan and "LessThanOrEqual(pos,120)" in plan
    want = calling.region(stored, "7", 10, 120)
    assert rows_of(part.select(*sorted(part.columns))) == rows_of(want.select(*sorted(want.columns))) and part.count() > 5


def test_files_are_sorted_by_place(spark, stored):
    files = [r[0] for r in spark.table("stored_obs").selectExpr("input_file_name()").distinct().collect()]
    assert len(files) == 8  # four buckets, written twice
    for f in files:
        places = [tuple(r) for r in spark.read.parquet(f).select("chrom", "pos").collect()]
        assert places == sorted(places)
