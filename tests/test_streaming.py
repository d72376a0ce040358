"""Streams give what the batch gives, whatever the order of files."""

from __future__ import annotations

from strandline import queries
from strandline.operators import calling
from strandline.sources import pileup
from strandline.streaming import observations as S


def last_of(stream, name, folder):
    q = stream.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", folder).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None and len(q.recentProgress) > 1
    return stream.sparkSession.table(name)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_running_statistics_are_the_batch(spark, tmp_path):
    obs = queries.obs(spark, "/root/testdata/sf0.001").select("chrom", "pos", "ref", "sample", "base", "bq", "mq", "plus")
    obs.repartition(3).write.parquet(str(tmp_path / "obs"))
    stream = S.observation_stream(spark, str(tmp_path / "obs"), files_per_trigger=1)
    assert rows_of(last_of(S.running_allele_stats(stream), "running_stats", str(tmp_path / "c1"))) == rows_of(calling.allele_stats(obs))


def test_pileup_text_as_a_stream(spark, tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    for k in range(3):
        lines = ["[mpileup] 1 samples", *[f"1\t{10 + n}\ta\t6\t..{'Cg'[k % 2]}^I.$,T\t{'I' * 6}\t{'I' * 6}" for n in range(k + 2)]]
        (folder / f"{k}.txt").write_text("\n".join(lines) + "\n")
    batch = pileup.observations(pileup.read_pileup(spark, str(folder)), "DNA_TUMOR")
    stream = S.pileup_stream(spark, str(folder), "DNA_TUMOR", files_per_trigger=1)
    counts = last_of(S.running_counts(stream), "running_counts", str(tmp_path / "c2"))
    assert rows_of(counts) == rows_of(calling.merged_counts(batch)) and counts.count() == 4
    called = calling.find_variants(counts).where("size(mods) > 0")
    assert rows_of(called.select("chrom", "pos", "mods")) == rows_of(calling.calls(batch).select("chrom", "pos", "mods"))
