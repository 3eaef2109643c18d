from __future__ import annotations

import json

from pyspark.sql import functions as F

from uttermill.operators import evaluation, layout, ordering, quality, vocab
from uttermill.plans import catalogue
from uttermill.sources import readers, writers
from uttermill.streaming import jobs


def test_annotation_map(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k1":"v1",\n "k1":"v2", "k2":"你好"}', encoding="utf-8")
    got = {r["key"]: r["sentence"] for r in readers.scan_json_map(spark, str(tmp_path / "a.json")).collect()}
    assert got == {"k1": "v2", "k2": "你好"}


def test_listing_and_transcripts(spark, tmp_path):
    for name, body in (("b.mp3", "x"), ("a.flac", "yy"), ("c.txt", "one\ntwo")):
        (tmp_path / name).write_text(body)
    files = readers.list_files(spark, str(tmp_path), ["*.mp3", "*.flac"])
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    assert [r["path"].rsplit("/", 1)[1] for r in files.orderBy("path").collect()] == ["a.flac", "b.mp3"]
    text = readers.read_transcripts(spark, str(tmp_path)).first()
    assert text["path"].endswith("c.txt") and text["text"] == "one\ntwo"


def test_unreadable_files_are_left_out(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"RIFF0000WAVE")
    (tmp_path / "b.wav").write_bytes(b"<html>")
    files = readers.read_binary(spark, str(tmp_path), "*.wav")
    assert [r["path"][-5:] for r in files.where(quality.readable_media("content")).collect()] == ["a.wav"]


def test_predictions_roundtrip(spark, tmp_path):
    rows = [("a", 'quote " and, comma'), ("b", "two\nlines"), ("c", "")]
    writers.write_predictions(spark.createDataFrame(rows, "file_id string, transcript string").coalesce(1), str(tmp_path / "p"))
    got = readers.scan_predictions(spark, str(tmp_path / "p"))
    assert sorted(map(tuple, got.collect())) == rows
    dropped = readers.scan_predictions(spark, str(tmp_path / "p"), skip_first=True)
    assert sorted(map(tuple, dropped.collect())) == rows[1:]


def test_vocabulary_file(spark, tmp_path):
    freq = spark.createDataFrame([("a", 20), ('"', 20), ("你", 30)], "ch string, n long")
    writers.write_vocab(vocab.build_vocab(freq), str(tmp_path / "v"))
    part = next((tmp_path / "v").glob("part-*"))
    assert json.loads(part.read_text(encoding="utf-8")) == {"|": 0, '"': 1, "a": 2, "你": 3, "[UNK]": 4, "[PAD]": 5}
    assert vocab.to_mapping(readers.load_vocab(spark, str(tmp_path / "v")))["你"] == 3


def test_materialize_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert writers.materialize(spark, path, build).count() == 3
    assert writers.materialize(spark, path, build).count() == 3
    assert calls == [1]


def test_shards_and_caps(spark, tmp_path):
    df = spark.range(25).withColumnRenamed("id", "row_idx")
    writers.write_sharded(layout.assign_shards(df, 10), str(tmp_path / "s"))
    back = readers.load(spark, str(tmp_path / "s"))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {1: 11, 2: 10, 3: 4}
    writers.write_capped(df.coalesce(1), str(tmp_path / "c"), 10)
    assert len(list((tmp_path / "c").glob("part-*"))) == 3


def test_text_chunks_concatenate(spark, tmp_path):
    df = spark.range(10).select(F.col("id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    chunks = evaluation.concat_text(ordering.row_index(df, ["id"]), "text", "row_idx", 4)
    writers.append_text(chunks, str(tmp_path / "blob"))
    writers.append_text(chunks, str(tmp_path / "blob"))
    parts = readers.load(spark, str(tmp_path / "blob")).orderBy("call", "chunk").collect()
    assert [r["text"] for r in parts] == ["t0t1t2t3", "t4t5t6t7", "t8t9"] * 2
    assert [r["call"] for r in parts] == [1, 1, 1, 2, 2, 2]


def test_report_files(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "A"), ("2", "b", "c"), ("3", ",", "x")], "utt_id string, ref string, pred string")
    writers.write_report(evaluation.error_report(df, "utt_id", "ref", "pred"), str(tmp_path / "r"), "utt_id", 10)
    assert readers.load(spark, str(tmp_path / "r/all_predictions")).count() == 2
    assert readers.load(spark, str(tmp_path / "r/incorrect_predictions")).first()["utt_id"] == "2"


def _stream(spark, tmp_path, n=3):
    src = str(tmp_path / "in")
    spark.range(30).select("id", (F.col("id") % 3).alias("m")).repartition(n).write.mode("append").parquet(src)
    return src, readers.stream_corpus(spark, src, spark.read.parquet(src).schema, files_per_batch=1)


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    src, stream = _stream(spark, tmp_path)
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    jobs.stream_to_table(stream, out, log, lambda d: d.where("id >= 10"))
    assert spark.read.parquet(out).count() == 20
    spark.range(100, 105).select("id", F.lit(0).cast("long").alias("m")).write.mode("append").parquet(src)
    jobs.stream_to_table(stream, out, log, lambda d: d.where("id >= 10"))
    assert spark.read.parquet(out).count() == 25


def test_stream_totals_and_snapshot(spark, tmp_path):
    src, stream = _stream(spark, tmp_path)
    jobs.running_totals(stream, ["m"], {"total": F.col("id")}, str(tmp_path / "tot"), str(tmp_path / "l1"))
    batch = spark.read.parquet(src).groupBy("m").agg(F.count(F.lit(1)).alias("n_samples"), F.sum("id").alias("total"))
    got = jobs.current_totals(spark, str(tmp_path / "tot"))
    assert sorted(got.collect()) == sorted(batch.collect())
    jobs.stream_snapshot(stream, str(tmp_path / "snap"), str(tmp_path / "l2"), every=2)
    snap = jobs.read_snapshot(spark, str(tmp_path / "snap"))
    assert sorted(snap.collect()) == sorted(spark.read.parquet(src).collect())


def test_snapshot_leaves_out_batches_not_yet_published(spark, tmp_path):
    src, stream = _stream(spark, tmp_path)
    at = str(tmp_path / "snap")
    jobs.stream_snapshot(stream, at, str(tmp_path / "log"))
    spark.range(1).select(F.lit(7).cast("long").alias("id"), F.lit(0).cast("long").alias("m")).write.parquet(f"{at}/log/batch_id=99")
    assert jobs.read_snapshot(spark, at).count() == 30
    jobs.stream_snapshot(stream, at, str(tmp_path / "log"))
    assert jobs.read_snapshot(spark, at).count() == 31
    assert len(list((tmp_path / "snap/versions").glob("slot=*"))) <= 2


def test_listing_is_sorted_and_names_a_file_once(spark, tmp_path):
    for name in ("b.txt", "a.txt", "a.wav", "c.md"):
        (tmp_path / name).write_text("x")
    found = readers.list_files(spark, str(tmp_path), ["*.txt", "a.*"]).select("path").collect()
    assert [r["path"].rsplit("/", 1)[1] for r in found] == ["a.txt", "a.wav", "b.txt"]


def test_every_query_has_a_name_of_its_own():
    assert len(catalogue.QUERIES) == len(set(catalogue.QUERIES))
