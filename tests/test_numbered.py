"""Row numbers of saved tables."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from uttermill.operators import pairing
from uttermill.sources import readers, writers


@pytest.fixture
def saved(spark, tmp_path):
    path = str(tmp_path / "saved")
    spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("text")).repartitionByRange(7, "k").sortWithinPartitions(
        "k").write.option("maxRecordsPerFile", 30).parquet(path)
    return path


def test_numbers_follow_the_saved_order(spark, saved):
    got = readers.load_numbered(spark, saved)
    assert got.columns == ["k", "text", "row_idx"]
    assert {(r.k, r.row_idx) for r in got.collect()} == {(i, i) for i in range(1000)}
    # A filter leaves the numbers as they are.
    assert [r.row_idx for r in got.where("k % 100 = 7").orderBy("k").collect()] == list(range(7, 1000, 100))


def test_no_row_is_sorted_or_moved(spark, saved):
    plan = readers.load_numbered(spark, saved)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    lines = [line for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]
    # File counts only: the partial count and the sum over files.
    assert all("_file" in line or "SinglePartition" in line for line in lines), lines
    assert "text" not in "".join(lines)


def test_task_numbers_go_by_value(spark, tmp_path):
    path = tmp_path / "many"
    for i, part in enumerate((99999, 100000, 5)):
        one = tmp_path / f"one{i}"
        spark.range(1).select(F.lit(part).alias("k")).coalesce(1).write.parquet(str(one))
        path.mkdir(exist_ok=True)
        shutil.copy(next(one.glob("part-*.parquet")), path / f"part-{part:05d}-x-c000.snappy.parquet")
    got = readers.load_numbered(spark, str(path)).orderBy("row_idx").collect()
    assert [r.k for r in got] == [5, 99999, 100000]


def test_zip_of_saved_tables(spark, saved, tmp_path):
    other = str(tmp_path / "other")
    spark.range(1000).orderBy("id").select((F.col("id") * 3).alias("v")).write.option("maxRecordsPerFile", 11).parquet(other)
    got = pairing.zip_numbered(readers.load_numbered(spark, saved), readers.load_numbered(spark, other)).collect()
    assert {(r.k, r.v) for r in got} == {(i, 3 * i) for i in range(1000)}
    short = readers.load_numbered(spark, other).where("row_idx < 999")
    with pytest.raises(Exception, match="row counts differ"):
        pairing.zip_numbered(readers.load_numbered(spark, saved), short).count()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "k long").write.parquet(str(tmp_path / "none"))
    assert readers.load_numbered(spark, str(tmp_path / "none")).count() == 0


def test_ordered_write_has_a_task_for_few_files(spark, tmp_path, monkeypatch):
    """Files by the thousand are not left to the few tasks that their bytes would give."""
    monkeypatch.setattr(writers, "TASK_FILES", 5)
    path = str(tmp_path / "ordered")
    rows = spark.range(600).select((F.col("id") % 3).alias("s"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    writers.write_ordered(rows, path, ["s", F.desc("k")], 7, 600, ["v", "k"])
    tasks = {f.name.split("-")[1] for f in (tmp_path / "ordered").glob("part-*.parquet")}
    assert len(tasks) > 10
    got = readers.load_numbered(spark, path).orderBy("row_idx").collect()
    assert [r.row_idx for r in got] == list(range(600))
    assert max(r.n for r in readers.load(spark, path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()) <= 7
    none = lambda v: -1 if v % 50 == 0 else v
    assert [(r.v % 3, none(r.v)) for r in got] == sorted(((v % 3, none(v)) for v in range(600)), key=lambda x: (x[0], -x[1]))


def test_files_are_counted_once(spark, saved):
    """The numbers of the files are pinned: no later read aggregates them again."""
    plan = readers.load_numbered(spark, saved)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_empty_ordered_write(spark, tmp_path):
    path = str(tmp_path / "none")
    writers.write_ordered(spark.createDataFrame([], "k long"), path, ["k"], 7, 0)
    assert readers.load_numbered(spark, path).count() == 0
