"""Resuming by row, shards of bounded size, bucketed pairing and reuse that notices change."""

from __future__ import annotations

import collections
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from uttermill.operators import layout, ordering, pairing, resume
from uttermill.sources import readers, writers


@pytest.mark.parametrize("bits", [64, 1024, 1 << 16])
def test_remaining_rows_are_exact(spark, bits):
    rnd = random.Random(bits)
    rows = [(rnd.choice([None, *range(300)]), rnd.choice(["a", "b", None]), i) for i in range(900)]
    done = [(rnd.choice([None, *range(300)]), rnd.choice(["a", "b", None])) for _ in range(250)]
    df = spark.createDataFrame(rows, "k long, c string, i int").repartition(3)
    there = spark.createDataFrame(done, "k long, c string")
    got = resume.remaining(df, there, ["k", "c"], bits=bits)
    assert sorted(r.i for r in got.collect()) == [i for k, c, i in rows if (k, c) not in set(done)]


def test_filter_knows_every_done_key_and_few_others(spark):
    done = spark.range(0, 4000)
    words = resume.done_filter(done, ["id"], bits=1 << 16)
    assert words.count() <= 1 << 10
    known = spark.range(0, 40_000).withColumn("known", resume.may_know(words, ["id"], bits=1 << 16))
    assert known.where("id < 4000 AND known").count() == 4000
    assert known.where("id >= 4000 AND known").count() < 1500


def test_filters_of_two_runs_merge(spark, tmp_path):
    one, two = spark.range(0, 500), spark.range(500, 900)
    resume.done_filter(one, ["id"], 1 << 14).write.parquet(str(tmp_path / "f1"))
    resume.done_filter(two, ["id"], 1 << 14).write.parquet(str(tmp_path / "f2"))
    both = resume.merged(spark.read.parquet(str(tmp_path / "f1")), spark.read.parquet(str(tmp_path / "f2")))
    assert sorted(both.collect()) == sorted(resume.done_filter(one.union(two), ["id"], 1 << 14).collect())
    left = resume.remaining(spark.range(1000), one.union(two), ["id"], both, 1 << 14)
    assert sorted(r.id for r in left.collect()) == list(range(900, 1000))


def test_nothing_done_and_nothing_to_do(spark):
    none = spark.createDataFrame([], "id long")
    assert resume.remaining(spark.range(10), none, ["id"]).count() == 10
    assert resume.remaining(none, spark.range(10), ["id"]).count() == 0
    with pytest.raises(ValueError):
        resume.done_filter(none, ["id"], 100)


def test_merged_shard_is_written_in_bounded_parts(spark, tmp_path):
    """Ten thousand boundaries without a transcript make one shard; no file, so no task, exceeds the bound."""
    n, bound = 2, 5000
    df = spark.range(20_100).select(F.col("id").alias("row_idx"), ((F.col("id") % n != 0) | (F.col("id") > 20_000)).alias("ok"),
                                    F.repeat(F.lit("x"), (F.col("id") * 7 % 90).cast("int")).alias("text"))
    sharded = layout.assign_shards(df, n, matched=F.col("ok"))
    assert sharded.groupBy("shard").count().agg(F.max("count")).first()[0] >= 10_000
    at = str(tmp_path / "out")
    manifest = writers.write_bounded(sharded, at, F.length("text"), bound).collect()
    assert max(r.n_bytes for r in manifest) <= bound + 90
    assert sum(r.n_rows for r in manifest) == sharded.count()
    by_shard = collections.defaultdict(list)
    for r in sorted(manifest, key=lambda r: (r.shard, r.part)):
        by_shard[r.shard].append(r)
    for parts in by_shard.values():
        assert [p.part for p in parts] == list(range(len(parts)))
        assert all(a.last_row < b.first_row for a, b in zip(parts, parts[1:], strict=False))
    for r in manifest[:5]:
        folder = Path(at) / f"shard={r.shard}" / f"part={r.part}"
        assert len(list(folder.glob("*.parquet"))) == 1
    # The manifest is no part of the table.
    assert spark.read.parquet(at).count() == sharded.count()


def test_bounded_shards_of_corpora_and_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK", 7)
    rows = [(c, 0, i, i % 5) for c, n in (("a", 60), (None, 33)) for i in range(n)]
    df = spark.createDataFrame(rows, "corpus string, shard int, row_idx long, size int")
    got = writers.write_bounded(df, str(tmp_path / "o"), F.col("size"), 13, by=["corpus"]).collect()
    want = collections.Counter()
    for c in ("a", None):
        total = 0
        for cc, _, _, size in rows:
            if cc == c:
                want[c, total // 13] += 1
                total += size
    assert {(r.corpus, r.part): r.n_rows for r in got} == dict(want)


def test_bounded_files_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    """Files of a few bytes still spread over tasks; a small shard lies with one task, a merged one with several."""
    monkeypatch.setattr(writers, "RUN_PARTS", 8)
    shard = F.when(F.col("id") < 800, F.floor(F.col("id") / 20)).otherwise(1000).alias("shard")
    df = spark.range(1600).select(F.col("id").alias("row_idx"), shard, F.lit(10).alias("size"))
    at = tmp_path / "out"
    manifest = writers.write_bounded(df, str(at), F.col("size"), 50).collect()
    assert {r.n_rows for r in manifest} == {5} and len(manifest) == 320
    tasks = collections.defaultdict(collections.Counter)
    for file in at.glob("shard=*/part=*/*.parquet"):
        tasks[file.parts[-3]][file.name.split("-")[1]] += 1
    every = sum(tasks.values(), collections.Counter())
    assert sum(every.values()) == 320
    assert max(every.values()) <= 160
    assert len(tasks["shard=1000"]) > 1
    assert all(len(made) == 1 for name, made in tasks.items() if name != "shard=1000")


def test_bucketed_pairing_moves_nothing(spark, tmp_path):
    swaps = [("/audio/", "/text/"), (".wav", ".txt")]
    audio = pairing.with_pair_key(spark.range(300).select(F.concat(F.lit("/audio/"), "id", F.lit(".wav")).alias("path")), swaps)
    texts = spark.range(200).select(F.concat(F.lit("/text/"), "id", F.lit(".txt")).alias("pair_key"), F.col("id").cast("string").alias("transcript"))
    name = f"b{tmp_path.name}".replace("-", "_")
    one = writers.save_bucketed(audio, f"{name}_audio", str(tmp_path / "audio"), "pair_key", 8)
    writers.save_bucketed(texts, f"{name}_texts", str(tmp_path / "texts"), "pair_key", 8)
    # As a later session finds it.
    two = readers.register_bucketed(spark, f"{name}_again", str(tmp_path / "texts"), texts.schema, "pair_key", 8)
    assert len(list((tmp_path / "audio").glob("part-*"))) == 8
    found = pairing.pair_bucketed(one, two)
    assert {(r.path, r.transcript) for r in found.collect()} == {(f"/audio/{i}.wav", str(i)) for i in range(200)}
    for mode in ("skip", "keep", "only"):
        plan = pairing.pair_bucketed(one, two, missing=mode)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan or mode == "only" and "BroadcastExchange" in plan, plan
    assert pairing.pair_bucketed(one, two, missing="only").count() == 100
    assert pairing.pair_bucketed(one, two, missing="keep").where("transcript IS NULL").count() == 100
    with pytest.raises(Exception, match="no transcript for"):
        pairing.pair_bucketed(one, two, missing="fail").count()
    with pytest.raises(ValueError):
        pairing.pair_bucketed(one, two, missing="other")
    for t in ("audio", "texts", "again"):
        spark.sql(f"DROP TABLE {name}_{t}")


def test_reuse_notices_changed_inputs_and_plans(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).coalesce(1).write.parquet(src)
    calls = []

    def build(limit=100):
        calls.append(limit)
        return spark.read.parquet(src).where(F.col("id") < limit)

    def states():
        return {p: p.stat().st_mtime_ns for p in Path(out).rglob("part-*.parquet")}

    assert writers.materialize_fresh(spark, out, build, [src]).count() == 10
    before = states()
    assert writers.materialize_fresh(spark, out, build, [src]).count() == 10
    assert states() == before
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(src)
    assert writers.materialize_fresh(spark, out, build, [src]).count() == 15
    assert len({p.parent for p in states()}) == 2
    assert writers.materialize_fresh(spark, out, lambda: build(3), [src]).count() == 3
    # A build that failed half way is not reused.
    newest = max(Path(out).glob("state=*"), key=lambda p: p.stat().st_mtime_ns)
    (newest / "_SUCCESS").unlink()
    for p in newest.glob("part-*"):
        p.unlink()
    assert writers.materialize_fresh(spark, out, lambda: build(3), [src]).count() == 3
