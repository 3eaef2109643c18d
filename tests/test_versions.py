"""Published versions of a growing log: replays, merging, and readers that hold an old version."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from uttermill.streaming import jobs, versions


def batch(spark, n):
    return spark.range(n * 10, n * 10 + 10).coalesce(1)


def files(path) -> list[Path]:
    return [p for p in Path(path).rglob("part-*.parquet")]


def test_hundred_batches_end_in_few_files(spark, tmp_path):
    at = str(tmp_path / "t")
    for n in range(100):
        assert versions.append(batch(spark, n), at, n)
        if n % 10 == 9:
            versions.publish(spark, at)
    assert sorted(r.id for r in versions.read(spark, at).collect()) == list(range(1000))
    entries = versions._entries(spark, at, versions.versions(spark, at)[-1])
    assert [e[0] for e in entries] == [2, 1, 1, 1, 1, 0, 0, 0, 0]
    assert [(a[2] + 1, b[1]) for a, b in zip(entries, entries[1:], strict=False)] == [(e[1], e[1]) for e in entries[1:]]
    named = sum(len(files(f"{at}/log/{e[3]}")) for e in entries)
    assert named == len(entries)
    # Folders of replaced versions are gone but for those that the kept versions name.
    assert len(versions.versions(spark, at)) == versions.KEEP + 1
    assert len(files(f"{at}/log")) <= 60


def test_replay_changes_nothing(spark, tmp_path):
    at = str(tmp_path / "t")
    for n in range(9):
        versions.append(batch(spark, n), at, n)
    v = versions.publish(spark, at)
    before = {p: p.stat().st_mtime_ns for p in files(at)}
    for n in (8, 3):
        assert not versions.append(batch(spark, n), at, n)
        assert versions.publish(spark, at) == v
    assert {p: p.stat().st_mtime_ns for p in files(at)} == before
    # Written, not yet published: the second write replaces the first.
    versions.append(batch(spark, 9), at, 9)
    versions.append(batch(spark, 9), at, 9)
    assert versions.read(spark, at).count() == 90
    versions.publish(spark, at)
    assert versions.read(spark, at).count() == 100


def test_reader_keeps_its_version_during_merging(spark, tmp_path):
    at = str(tmp_path / "t")
    for n in range(7):
        versions.append(batch(spark, n), at, n)
    old = versions.publish(spark, at)
    reader = versions.read(spark, at)
    versions.append(batch(spark, 7), at, 7)
    new = versions.publish(spark, at)
    assert [e[0] for e in versions._entries(spark, at, new)] == [1]
    assert reader.count() == 70
    assert versions.read(spark, at, old).count() == 70
    assert versions.read(spark, at).count() == 80
    with pytest.raises(ValueError):
        versions.read(spark, at, 99)
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path / "nothing"))


def test_half_written_batch_is_not_published(spark, tmp_path):
    at = str(tmp_path / "t")
    versions.append(batch(spark, 0), at, 0)
    versions.append(batch(spark, 1), at, 1)
    (tmp_path / "t/log/batch_id=1/_SUCCESS").unlink()
    versions.publish(spark, at)
    assert versions.published(spark, at) == 0
    versions.append(batch(spark, 1), at, 1)
    versions.publish(spark, at)
    assert versions.read(spark, at).count() == 20


def test_totals_write_changed_groups_only(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("src", "out", "log"))
    schema = "g long, v long"
    spark.range(1000).select((F.col("id") % 100).alias("g"), F.col("id").alias("v")).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(src)
        jobs.running_totals(stream, ["g"], {"total": F.col("v")}, out, log)

    run()
    for step in range(9):
        spark.createDataFrame([(7, step), (200 + step, 1)], schema).coalesce(1).write.mode("append").parquet(src)
        run()
        newest = max(int(p.name.split("=")[1]) for p in Path(out, "log").glob("batch_id=*"))
        assert spark.read.parquet(f"{out}/log/batch_id={newest}").count() == 2
    want = spark.read.schema(schema).parquet(src).groupBy("g").agg(F.count(F.lit(1)).alias("n_samples"), F.sum("v").alias("total"))
    assert sorted(jobs.current_totals(spark, out).collect()) == sorted(want.collect())
    # A replay of the last batch, as after a failure before the checkpoint was written.
    before = sorted(jobs.current_totals(spark, out).collect())
    again = spark.createDataFrame([((7,), (99, 99), 9)], "key struct<g:long>, value struct<n_samples:long,total:long>, batch_id long")
    assert not versions.append(again, out, 9)
    versions.publish(spark, out, versions.newest_per_key)
    assert sorted(jobs.current_totals(spark, out).collect()) == before
    # Merged folders hold one row a group.
    merged = next(Path(out, "log").glob("merged-1-*"))
    rows = spark.read.parquet(str(merged))
    assert rows.count() == rows.select("key").distinct().count()
