from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from uttermill.functions import text as X
from uttermill.operators import augment, corpora, layout, ordering, pairing, quality, scoring, vocab


def brute_shards(flags: list[bool], n: int) -> dict[int, int]:
    out, shard = {}, 1
    for i, ok in enumerate(flags):
        if ok:
            out[i] = shard
            if i % n == 0 and i:
                shard += 1
    return out


def test_shards_merge_where_the_boundary_is_missing(spark):
    flags = [i not in (3, 8) for i in range(12)]
    df = spark.createDataFrame(list(enumerate(flags)), "row_idx long, ok boolean")
    got = {r[0]: r["shard"] for r in layout.assign_shards(df, 4, matched=F.col("ok")).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 4: 1, **dict.fromkeys((5, 6, 7, 9, 10, 11), 2)}


@pytest.mark.parametrize("block", [3, 4096])
def test_shards_against_the_loop(spark, monkeypatch, block):
    monkeypatch.setattr(ordering, "BLOCK", block)
    rng = random.Random(block)
    flags = {c: [rng.random() < 0.8 for _ in range(n)] for c, n in (("hot", 300), ("a", 40), ("b", 1))}
    rows = [(c, i, ok) for c, fs in flags.items() for i, ok in enumerate(fs)]
    df = spark.createDataFrame(rows, "corpus string, row_idx long, ok boolean")
    out = layout.assign_shards(df, 7, by=["corpus"], matched=F.col("ok")).collect()
    got = {(r["corpus"], r["row_idx"]): r["shard"] for r in out}
    want = {(c, i): s for c, fs in flags.items() for i, s in brute_shards(fs, 7).items()}
    assert got == want


def test_row_index_over_a_hot_group(spark):
    rows = [("hot", i) for i in range(500)] + [("a", 1), ("b", 5), ("b", 2), (None, 7), (None, 3)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    got = {(r["g"], r["k"]): r["row_idx"] for r in ordering.row_index(df, ["k"], ["g"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want |= {(g, k): i for i, k in enumerate(sorted(k for h, k in rows if h == g))}
    assert got == want
    total = ordering.row_index(df.select("g", "k"), ["g", "k"])
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert {(r["g"], r["k"]): r["row_idx"] for r in total.collect()} == {r: i for i, r in enumerate(order)}


def test_bucket_index_equals_row_index(spark):
    df = spark.range(0, 1000, 3).withColumn("g", F.col("id") % 2)
    a = ordering.row_index(df, ["id"], ["g"])
    b = ordering.bucket_index(df, F.floor(F.col("id") / 50), ["id"], ["g"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_large_starts_are_not_broadcast(spark, monkeypatch):
    from uttermill import session

    monkeypatch.setattr(session.small_side, "__defaults__", (1,))
    df = spark.range(200).withColumn("g", F.col("id") % 5)
    out = ordering.row_index(df, ["id"], ["g"])
    assert {(r["g"], r["row_idx"]) for r in out.collect()} == {(g, i) for g in range(5) for i in range(40)}


def test_shuffle_is_a_stable_permutation(spark):
    df = spark.range(777)
    one = ordering.seeded_shuffle(df, "id", 3).collect()
    two = ordering.seeded_shuffle(df.repartition(7), "id", 3).collect()
    assert sorted(one) == sorted(two)
    assert sorted(r["shuffle_pos"] for r in one) == list(range(777))
    other = ordering.seeded_shuffle(df, "id", 3, epoch=1).collect()
    assert sorted(other) != sorted(one)
    assert ordering.skip_batches(ordering.seeded_shuffle(df, "id", 3), "shuffle_pos", 64, 3).count() == 777 - 192


def test_replicas_of_a_hot_key_shuffle_apart(spark):
    hot = corpora.replicate(spark.range(3), 500)
    out = ordering.seeded_shuffle(hot, ["id", "replica"], prefix=1)
    assert sorted(r["shuffle_pos"] for r in out.collect()) == list(range(1500))
    first = out.where("shuffle_pos < 300").groupBy("id").count().collect()
    assert all(r["count"] > 60 for r in first)


def test_interleave_stops_at_the_shortest(spark):
    rows = [("a", i) for i in range(5)] + [("b", i) for i in range(2)] + [("c", i) for i in range(9)]
    df = spark.createDataFrame(rows, "s string, k int")
    got = layout.interleave(df, "s", ["b", "a"], ["k"]).orderBy("position").collect()
    assert [(r["s"], r["k"], r["position"]) for r in got] == [("b", 0, 0), ("a", 0, 1), ("b", 1, 2), ("a", 1, 3)]
    assert layout.interleave(df, "s", ["b", "none"], ["k"]).count() == 0


def test_batches_cut_the_start_token_only_if_all_have_it(spark):
    rows = [(0, [7, 1]), (1, [7]), (2, [7, 2, 3]), (3, [5])]
    df = spark.createDataFrame(rows, "row_idx long, labels array<int>")
    got = layout.assemble_batches(df, "row_idx", "labels", 2, bos_id=7).orderBy("row_idx").collect()
    assert [r["labels"] for r in got] == [[1], [-100], [7, 2, 3], [5, -100, -100]]
    fixed = layout.assemble_batches(df, "row_idx", "labels", 2, max_length=4).orderBy("row_idx").collect()
    assert {len(r["labels"]) for r in fixed} == {4}


def test_retention_is_numeric_and_split(spark):
    rows = [("r", f"run/checkpoint-{s}") for s in (9, 10, 100, 20)] + [("q", "run/checkpoint-1")]
    df = spark.createDataFrame(rows, "run string, path string").withColumn("step", layout.checkpoint_step("path"))
    got = layout.retain_newest(df, "run", "step", 2, "path").collect()
    assert {r["path"] for r in got if r["kept"] and r["run"] == "r"} == {"run/checkpoint-100", "run/checkpoint-20"}
    assert len(got) == 5
    names = spark.createDataFrame(
        [("r", n) for n in ("checkpoint-9-epoch-1", "checkpoint-10-epoch-0", "checkpoint-99", "x-checkpoint-50-epoch-1")],
        "run string, name string",
    )
    assert layout.last_checkpoint(names, ["run"], "name").first()["name"] == "checkpoint-10-epoch-0"


def test_vocabulary(spark):
    freq = spark.createDataFrame([("b", 20), ("a", 16), ("z", 15), ("|", 99)], "ch string, n long")
    mapping = vocab.to_mapping(vocab.build_vocab(freq))
    assert mapping == {"|": 0, "a": 1, "b": 2, "[UNK]": 3, "[PAD]": 4}
    df = spark.createDataFrame([("ab a",), ("",), ("a😀|你b",)], "t string")
    ids = [r[0] for r in df.select(vocab.encode("t", mapping)).collect()]
    assert ids == [[1, 2, 0, 1], [], [1, 3, 0, 3, 2]]
    back = df.select(vocab.decode(vocab.encode("t", mapping), mapping), vocab.decode(vocab.encode("t", mapping), mapping, False))
    assert [tuple(r) for r in back.collect()] == [("ab a", "ab a"), ("", ""), ("a b", "a[UNK] [UNK]b")]
    preds = spark.createDataFrame([("[1, 2]",), ("plain",), (None,)], "p string")
    assert [r[0] for r in preds.select(vocab.prediction_text("p", mapping)).collect()] == ["ab", "plain", None]


def test_vocabulary_of_wide_characters(spark):
    freq = spark.createDataFrame([("😀", 20), ("你", 20)], "ch string, n long")
    mapping = vocab.to_mapping(vocab.build_vocab(freq))
    assert mapping == {"|": 0, "你": 1, "😀": 2, "[UNK]": 3, "[PAD]": 4}
    df = spark.createDataFrame([("你😀😁 ",)], "t string")
    assert df.select(vocab.encode("t", mapping)).first()[0] == [1, 2, 3, 0]


def test_corpus_weights(spark):
    a, b = spark.createDataFrame([("xx",)], "t string"), spark.createDataFrame([("xy",)], "t string")
    got = {r["ch"]: r["n"] for r in vocab.weighted_frequency([(a, "t", 2), (b, "t", 1)]).collect()}
    assert got == {"x": 5, "y": 1}


def test_pairing(spark):
    audio = spark.createDataFrame([("/audio/1.wav",), ("/audio/2.wav",), ("/audio/3.wav",)], "path string")
    first = spark.createDataFrame([("/a/1.txt", "one"), ("/a/2.txt", "")], "path string, text string")
    second = spark.createDataFrame([("/b/1.txt", "uno"), ("/b/2.txt", "dos")], "path string, text string")
    sa, sb = [("audio", "a"), (".wav", ".txt")], [("audio", "b"), (".wav", ".txt")]
    got = pairing.pair_fallback(audio, first, second, sa, sb).orderBy("path").collect()
    assert [tuple(r) for r in got] == [("/audio/1.wav", "one"), ("/audio/2.wav", "")]
    assert pairing.pair_skip(audio, first, sa).count() == 2
    assert [r[0] for r in pairing.having_partner(audio, first, sa, present=False).collect()] == ["/audio/3.wav"]
    with pytest.raises(Exception, match="no transcript for /audio/3.wav"):
        pairing.pair_strict(audio, first, sa).collect()
    assert pairing.pair_strict(audio.limit(2), first, sa).count() == 2


def test_predictions(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "file_id string")
    preds = spark.createDataFrame([("a", "old", 0), ("a", "new", 5), ("b", "", 1)], "file_id string, transcript string, i int")
    last = pairing.last_write(preds, "file_id", "transcript", "i")
    assert [tuple(r) for r in pairing.attach_predictions(rows, last).collect()] == [("a", "new")]
    every = pairing.attach_predictions(rows, last, drop_blank=False).orderBy("file_id").collect()
    assert [r["transcript"] for r in every] == ["new", "", ""]


def test_positional_needs_equal_counts(spark):
    with pytest.raises(ValueError, match="row counts differ"):
        pairing.attach_positional(spark.range(3), spark.range(4).toDF("v"), ["id"], ["v"])


def test_filters_and_funnel(spark):
    df = spark.createDataFrame(
        [("abcd", 1.0), ("abc", 1.0), (" abcd\t", 30.0), ("abcdef", 29.9), (None, 2.0), ("abcdefg", 1.5)],
        "t string, sec double",
    )
    stages = {"text": quality.min_text("t", 3), "band": quality.duration_band("sec")}
    assert tuple(quality.funnel(df, stages).first()) == (6, 4, 1)
    marked = quality.admit(df, {"text": quality.min_text("t", 3), "long": quality.below_duration("sec")})
    kept, out = quality.split_admitted(marked)
    assert kept.count() == 3
    assert sorted(r["reject_reason"] for r in out.collect()) == ["long", "text", "text"]
    assert df.where(quality.char_band("t")).count() == 3
    with pytest.raises(ValueError, match="available: sec, t"):
        quality.require_columns(df, ["nope"])


def test_media_header(spark):
    rows = [(bytearray(b),) for b in (b"RIFFxxxxWAVE", b"fLaC", b"PAR1", b"", b"RIFFxxxxWEBP", b"\xff\xfa\x90", b"\0\0\0\x20ftypM4A ")] + [(None,)]
    df = spark.createDataFrame(rows, "content binary")
    assert [r[0] for r in df.select(quality.readable_media("content")).collect()] == [True, True, False, False, False, True, True, False]


def test_replication_and_masks(spark):
    df = spark.createDataFrame([(i, [1.0] * 60) for i in range(40)], "utt_id int, f array<float>")
    copies = corpora.replicate(df, 3)
    assert copies.count() == 120
    plan = augment.augmentation_plan(copies).cache()
    touched = plan.where("time_mask or stretch or freq_mask").count()
    assert 30 < touched < 90
    masked = augment.mask_vector(plan.withColumn("on", F.lit(True)), "f", "on", "time")
    widths = [r["time_stop"] - r["time_start"] for r in masked.collect()]
    zeros = [sum(1 for x in r["f"] if x == 0) for r in masked.collect()]
    assert widths == zeros and max(widths) <= 25 and len(set(widths)) > 10
    train = spark.createDataFrame([("train",), ("test",)], "split string")
    assert corpora.replicate_split(train, 5).count() == 6


def test_matrix_mask_axis(spark):
    df = spark.createDataFrame([(1, 0, [[1.0] * 40] * 30)], "utt_id int, replica int, f array<array<float>>")
    on = df.withColumn("on", F.lit(True))
    rows = augment.mask_matrix(on, "f", 0, "on", "freq").first()["f"]
    cols = augment.mask_matrix(on, "f", 1, "on", "freq").first()["f"]
    assert all(len(set(r)) == 1 for r in rows)
    assert all(r == cols[0] for r in cols)


def test_noise_only_where_drawn(spark):
    df = corpora.replicate(spark.createDataFrame([(i, [0.0] * 50) for i in range(50)], "utt_id int, f array<float>"), 2)
    rows = augment.add_noise(df, "f").collect()
    hit = [r for r in rows if r["noise_amp"] is not None]
    assert 10 < len(hit) < 50
    assert all(set(r["f"]) == {0.0} for r in rows if r["noise_amp"] is None)
    assert all(0.001 <= r["noise_amp"] <= 0.015 and max(map(abs, r["f"])) < 0.1 for r in hit)


def test_frames(spark):
    df = spark.createDataFrame([("c", 1, [1.0] * 10), ("c", 2, [2.0] * 3)], "corpus string, id int, s array<float>")
    framed = augment.frames(df, "s", "id", 4, 2, "corpus")
    assert [(r["frame"], r["energy"]) for r in framed.orderBy("frame").collect()] == [(i, 1.0) for i in range(4)]
    assert augment.frame_stats(framed, "corpus").first()["n_frames"] == 4


def test_mix_is_monotone_and_specs_align(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("corpus"))
    small = {r["k"] for r in corpora.mix(df, {"a": 0.2, "b": 0.0}, "k").collect()}
    large = {r["k"] for r in corpora.mix(df, {"a": 0.5}, "k").collect()}
    assert small < large and 120 < len(small) < 280
    specs = corpora.parse_specs("x+y", "c1+c2", None, "t1+t2", "10+30")
    assert [(s.split, s.text_col, s.samples) for s in specs] == [("train", "t1", 10), ("train", "t2", 30)]
    assert corpora.sampling_fractions(specs) == {"x": 0.25, "y": 0.75}
    with pytest.raises(ValueError, match="2 corpora but 3 configs"):
        corpora.parse_specs("x+y", "a+b+c")


def test_union_of_drifting_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "id int, file_id string")
    assert corpora.concat([a, spark.createDataFrame([(2,)], "id int")]).where("file_id is null").count() == 1


def test_scorer(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "yy")], "file_id string, t string")
    got = scoring.score(df, "file_id", ["t"], load=lambda: lambda b: b["t"] * 2).collect()
    assert {r["file_id"]: r["pred"] for r in got} == {"a": "xx", "b": "yyyy"}
    with pytest.raises(ValueError, match="either predict or load"):
        scoring.score(df, "file_id", ["t"])
    assert X.normalize("t") is not None


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(10)], "g string, step long")
    kept = layout.retain_newest(df, "g", "step", 2, "step").collect()
    assert len(kept) == 10 and sorted(r["step"] for r in kept if r["kept"]) == [6, 7, 8, 9]
    rows = ordering.row_index(df, ["step"], by=["g"])
    assert layout.assign_shards(rows, 3, by=["g"]).count() == 10


def test_strict_pairs_fail_whatever_is_read(spark):
    audio = spark.createDataFrame([("a.wav",), ("b.wav",)], "path string")
    texts = spark.createDataFrame([("a.txt", "x")], "path string, text string")
    out = pairing.pair_strict(audio, texts, [(".wav", ".txt")])
    for read in (out, out.select("path")):
        with pytest.raises(Exception, match="no transcript for b.wav"):
            read.count()


def test_weighted_mix_has_the_shares(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 100, "s").otherwise("l").alias("corpus"))
    got = {r[0]: r[1] for r in corpora.mix_weighted(df, {"s": 0.5, "l": 0.5}, "id").groupBy("corpus").count().collect()}
    assert got == {"s": 100, "l": 100}
    assert corpora.parse_specs("a+b", "x+y", samples="0.3+0.7")[1].samples == 0.7
