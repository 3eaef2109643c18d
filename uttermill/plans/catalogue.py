"""One query per operator group over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill import schema
from uttermill.functions import arrays as A
from uttermill.functions import text as X
from uttermill.operators import augment, corpora, evaluation, layout, ordering, pairing, quality, resume, scoring, vocab
from uttermill.plans import lifecycles
from uttermill.plans import standins as S
from uttermill.session import scratch_path
from uttermill.sources import readers, splitscan, writers
from uttermill.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _join(c, sep: str = " "):
    return F.array_join(c.cast("array<string>"), sep)


def _int(c):
    return c.cast("int")


# --- text ---------------------------------------------------------------------


@query
def normalize_transcripts(spark, sf):
    return S.utterances(spark, sf).select("utt_id", X.normalize("sentence").alias("sentence"))


@query
def normalize_vocab_text(spark, sf):
    return S.utterances(spark, sf).select(
        "utt_id",
        X.vocab_clean("sentence").alias("lowered"),
        X.vocab_clean("sentence", lower=False).alias("cased"),
        X.optional_clean("sentence", True, True).alias("switched"),
    )


@query
def normalize_basic(spark, sf):
    return S.utterances(spark, sf).select("utt_id", X.normalize_basic("sentence").alias("sentence"))


@query
def normalize_marked(spark, sf):
    """The cleaners over texts that hold every kind of mark they remove."""
    marked = S.marked_utterances(spark, sf)
    return marked.select(
        "utt_id",
        X.normalize("sentence").alias("normalized"),
        X.vocab_clean("sentence").alias("lowered"),
        X.normalize_basic("sentence").alias("basic"),
        X.strip("sentence").alias("stripped"),
    )


@query
def strip_length_filter(spark, sf):
    kept = S.utterances(spark, sf).where(quality.min_text("sentence", quality.MIN_CHARS_VOCAB))
    return kept.select(
        "utt_id",
        X.stripped_length("sentence").cast("bigint").alias("n_chars"),
        _int(quality.min_text("sentence", quality.MIN_CHARS_CORPUS)).alias("corpus_ok"),
        _int(quality.min_text("sentence", quality.MIN_CHARS_PSEUDO)).alias("pseudo_ok"),
    )


@query
def rewrite_urls(spark, sf):
    pages = S.table(spark, sf, "pages")
    swapped = X.rewrite_path("url", [("e", "E"), ("http://", "s3a://"), (".com", ".txt")])
    return pages.select("page_id", swapped.alias("path"), X.basename("url").alias("name"))


@query
def markup_filter(spark, sf):
    return S.table(spark, sf, "pages").select(
        "page_id",
        _int(X.has_markup("url")).alias("url_markup"),
        _int(X.has_markup("html")).alias("html_markup"),
    )


@query
def parse_id_list(spark, sf):
    emb = S.table(spark, sf, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000).cast("int"))
    listed = F.concat(F.lit("["), _join(whole, ", "), F.lit("]"))
    text = emb.select("vec_id", listed.alias("listed"), F.col("label").cast("string").alias("plain"))
    ids = X.parse_id_list("listed")
    return text.select(
        "vec_id",
        F.size(ids).cast("bigint").alias("n_ids"),
        _join(ids).alias("ids"),
        _int(X.parse_id_list("plain").isNull()).alias("plain_is_text"),
    )


# --- filters ------------------------------------------------------------------


@query
def duration_filters(spark, sf):
    return (
        S.utterances(spark, sf)
        .where(quality.below_duration("input_length"))
        .select(
            "utt_id",
            "input_length",
            _int(quality.below_duration("input_length", quality.MAX_SECONDS_PREFILTER)).alias("prefilter_ok"),
            _int(quality.duration_band("input_length")).alias("band_ok"),
        )
    )


@query
def sample_duration(spark, sf):
    emb = S.table(spark, sf, "embeddings").withColumn("seconds", A.duration("embedding", 16))
    return evaluation.corpus_totals(emb, ["label"], "seconds")


@query
def label_filters(spark, sf):
    # Characters stand in for tokens; the truncated form is the operator's result.
    tokens = S.utterances(spark, sf).select(
        "utt_id", "sentence", X.chars("sentence").alias("labels")
    )
    return tokens.select(
        "utt_id",
        F.size("labels").cast("bigint").alias("n_tokens"),
        _int(quality.below_tokens("labels")).alias("below_max"),
        _int(quality.token_band("labels")).alias("band_ok"),
        _int(quality.char_band("sentence")).alias("chars_ok"),
        F.array_join(A.truncate("labels", quality.MAX_LABEL_TOKENS), "").alias("truncated"),
    )


@query
def filter_funnel(spark, sf):
    stages = {
        "text": quality.min_text("sentence", quality.MIN_CHARS_CORPUS),
        "duration": quality.below_duration("input_length", quality.MAX_SECONDS_PREFILTER),
        "label": quality.char_band("sentence", maximum=1500),
    }
    return quality.funnel(S.utterances(spark, sf), stages, ["corpus"])


def _cut_up(name: str, width: int):
    """A whole array as rows of ``width`` numbers, the last one perhaps shorter."""
    count = F.ceil(F.size(name) / width).cast("int")
    starts = F.when(F.size(name) > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(name, i * width + 1, F.lit(width)))


@query
def shape_filter(spark, sf):
    emb = S.table(spark, sf, "embeddings")
    rows = _cut_up("embedding", 8)
    shaped = emb.select("vec_id", rows.alias("features"))
    return shaped.where(A.has_shape("features", 8, 8)).select(
        "vec_id", _int(A.has_shape("features", *quality.FEATURE_SHAPE)).alias("model_shape")
    )


@query
def media_signature(spark, sf):
    page = S.table(spark, sf, "pages").withColumn("content", F.col("html").cast("binary"))
    # 3C21 are the bytes "<!", 3C68 the bytes "<h".
    return page.select(
        "page_id",
        _int(quality.readable_media("content", ["3C21", "3C68"])).alias("is_page"),
        _int(quality.readable_media("content")).alias("is_audio"),
    )


#: Leading bytes (hex) of MPEG audio, WAVE, WEBP, an ``ftyp`` box, MPEG 2.5, no audio, and none.
_HEADERS = (
    "FFFA9064", "524946462400000057415645", "524946462400000057454250", "0000001866747970", "FFE31800", "FF101800", "",
    # A UTF-16 text, reserved version, layer, bit rate and sampling rate, a plain layer III frame.
    "FFFE6100", "FFEB9064", "FFF99064", "FFFBF064", "FFFB9C64", "FFFB9064",
)


@query
def media_headers(spark, sf):
    """Pages behind built headers, so that the audio test has something to find."""
    kind = F.element_at(F.array(*[F.lit(h) for h in _HEADERS]), (F.pmod("page_id", F.lit(len(_HEADERS))) + 1).cast("int"))
    content = F.concat(F.unhex(kind), F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    return S.table(spark, sf, "pages").select("page_id", _int(quality.readable_media(content)).alias("is_audio"))


def _admitted(spark, sf) -> DataFrame:
    labels = S.table(spark, sf, "labels").withColumnRenamed("doc_id", "utt_id")
    rows = S.utterances(spark, sf).join(labels, "utt_id", "left")
    rules = {
        "short text": quality.min_text("sentence", quality.MIN_CHARS_CORPUS),
        "too long": quality.below_duration("input_length"),
        "too many tokens": F.length("sentence") < quality.MAX_TOKENS,
        "toxic or unknown": F.col("toxic") == 0,
        "low quality": F.col("quality") == 1,
    }
    return quality.admit(rows, rules)


@query
def admission_split(spark, sf):
    """Admitted rows and quarantine side by side."""
    admitted, quarantine = quality.split_admitted(_admitted(spark, sf))
    none = admitted.select("utt_id", F.lit("").alias("reason"))
    return none.union(quarantine.select("utt_id", "reject_reason"))


@query
def admission_report(spark, sf):
    return _admitted(spark, sf).groupBy(F.coalesce("reject_reason", F.lit("admitted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("input_length"), 4).alias("seconds")
    )


# --- joins --------------------------------------------------------------------

_CLEAN = [("audio", "clean"), (".wav", ".txt")]
_COMMON = [("audio", "common"), (".wav", ".txt")]


@query
def pair_strict(spark, sf):
    return pairing.pair_strict(S.audio_paths(spark, sf), S.text_files(spark, sf, "clean"), _CLEAN)


@query
def pair_skip(spark, sf):
    texts = S.text_files(spark, sf, "clean", labelled=True)
    return pairing.pair_skip(S.audio_paths(spark, sf), texts, _CLEAN)


@query
def pair_fallback(spark, sf):
    first = S.text_files(spark, sf, "common", quality=1).withColumn(
        "text", F.concat(F.lit("first: "), "text")
    )
    second = S.text_files(spark, sf, "clean", labelled=True)
    return pairing.pair_fallback(S.audio_paths(spark, sf), first, second, _COMMON, _CLEAN)


@query
def pair_missing(spark, sf):
    texts = S.text_files(spark, sf, "clean", labelled=True)
    return pairing.having_partner(S.audio_paths(spark, sf), texts, _CLEAN, present=False)


@query
def pair_present(spark, sf):
    texts = S.text_files(spark, sf, "clean", labelled=True)
    return pairing.having_partner(S.audio_paths(spark, sf), texts, _CLEAN)


@query
def pair_bucketed(spark, sf):
    """Recordings and transcripts stored by key in equal buckets, paired twice from there."""
    audio = pairing.with_pair_key(S.audio_paths(spark, sf), [("/audio/", "/text/"), (".wav", ".txt")])
    texts = S.text_files(spark, sf, "text", labelled=True).withColumnsRenamed({"path": "pair_key", "text": "transcript"})
    sides = []
    for part, df in (("audio", audio), ("texts", texts)):
        at = scratch_path(spark, part)
        sides.append(writers.save_bucketed(df, f"{part}_{at[-32:]}", at, "pair_key", 16))
    found = pairing.pair_bucketed(*sides).select("path", F.md5("transcript").alias("digest"))
    lacking = pairing.pair_bucketed(*sides, missing="only").select("path", F.lit(None).cast("string").alias("digest"))
    return found.unionByName(lacking)


@query
def annotation_join(spark, sf):
    events = S.table(spark, sf, "events")
    entries = events.select(
        "event_id", F.explode(F.from_json("props", "map<string,string>")).alias("field", "key")
    )
    wavs = S.table(spark, sf, "documents").select(
        F.concat(F.lit("wavs/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"),
        F.col("n_chars"),
    )
    return pairing.annotation_join(entries, wavs, "wavs").select(
        "event_id", "field", "key", "path", "n_chars"
    )


@query
def attach_predictions(spark, sf):
    preds = S.predictions(spark, sf).withColumnRenamed("pred", "transcript")
    last = pairing.last_write(preds, "file_id", "transcript", "model")
    return pairing.attach_predictions(S.spoken(spark, sf).select("file_id", "role"), last)


@query
def attach_predictions_default(spark, sf):
    preds = S.predictions(spark, sf).withColumnRenamed("pred", "transcript")
    last = pairing.last_write(preds, "file_id", "transcript", "model")
    said = S.spoken(spark, sf).select("file_id", "role")
    out = pairing.attach_predictions(said, last, drop_blank=False)
    return out.select("*", _int(F.col("transcript") == "").alias("is_blank"))


@query
def map_lookup(spark, sf):
    parsed = F.from_json("props", "map<string,string>")
    return S.table(spark, sf, "events").select(
        "event_id",
        pairing.lookup(parsed, F.lit("k")).alias("k"),
        pairing.lookup(parsed, F.lit("absent")).alias("absent"),
    )


@query
def attach_positional(spark, sf):
    docs = S.table(spark, sf, "documents")
    left = docs.select("doc_id", "source")
    right = docs.select(F.col("doc_id").alias("other_id"), F.col("n_chars").alias("value"))
    return pairing.attach_positional(
        left, right, ["source", "doc_id"], [F.desc("value"), "other_id"]
    ).select("row_idx", "doc_id", "other_id", "value")


# --- aggregates ---------------------------------------------------------------


@query
def corpus_totals(spark, sf):
    return evaluation.corpus_totals(S.utterances(spark, sf))


def _rtf_rows(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("model"),
        F.col("value").alias("gen_time"),
        (F.get_json_object("props", "$.k").cast("double") + 1).alias("seconds"),
    )


@query
def rtf_by_model(spark, sf):
    out = evaluation.real_time_factor(_rtf_rows(S.table(spark, sf, "events")))
    return out.select(
        "model",
        "n_samples",
        F.round("gen_seconds", 4).alias("gen_seconds"),
        F.round("audio_seconds", 4).alias("audio_seconds"),
        F.round("rtf", 6).alias("rtf"),
    )


@query
def cer_by_utterance(spark, sf):
    pairs = S.turn_pairs(spark, sf).select(
        "conv_id", "turn", X.normalize("ref").alias("ref"), X.normalize("pred").alias("pred")
    )
    return evaluation.with_edits(pairs, "ref", "pred").select(
        "conv_id", "turn", "ref_chars", "edits",
        F.round(F.try_divide(F.col("edits"), F.col("ref_chars")), 6).alias("cer"),
    )


@query
def cer_corpus(spark, sf):
    return evaluation.raw_and_normalized_cer(S.turn_pairs(spark, sf), "ref", "pred", ["role"])


@query
def cer_by_model(spark, sf):
    timed = S.predictions(spark, sf).select(
        "model", "role", "ref", "pred",
        (F.length("ref") / 16.0).alias("seconds"),
        (F.length("pred") / 64.0).alias("gen_time"),
    )
    out = evaluation.model_comparison(timed, "ref", "pred", ["model", "role"])
    return out.withColumn("rtf", F.round("rtf", 6)).withColumn("model", F.col("model").cast("bigint"))


@query
def cer_relabel(spark, sf):
    out = evaluation.relabel(
        S.predictions(spark, sf), "ref", "pred", quality.RELABEL_CER, name="label"
    )
    return out.select(
        "file_id", F.col("model").cast("bigint").alias("model"),
        _int(F.col("relabelled")).alias("relabelled"), "label",
    )


def _report(spark, sf) -> DataFrame:
    return evaluation.error_report(S.predictions(spark, sf), ["file_id", "model"], "ref", "pred")


@query
def error_report(spark, sf):
    return _report(spark, sf).where("norm_target <> norm_pred").withColumn("model", F.col("model").cast("bigint"))


@query
def first_rows(spark, sf):
    last = _report(spark, sf).where(F.col("model") == 2).drop("model")
    return ordering.first_rows(last, ["file_id"], 100)


@query
def char_frequency(spark, sf):
    docs = S.texts(spark, sf, "documents", "doc_id").select("lang", "text")
    return vocab.char_frequency(docs, "text", ["lang"])


@query
def char_union(spark, sf):
    keys = {"documents": "doc_id", "conversations": "conv_id", "benchmark": "item_id"}
    sources = [(S.texts(spark, sf, name, key), "text") for name, key in keys.items()]
    return vocab.char_union(sources).select("ch", F.ascii("ch").cast("bigint").alias("code"))


def _vocabulary(spark, sf) -> DataFrame:
    return lifecycles.vocabulary(
        [(S.texts(spark, sf, "documents", "doc_id"), "text", True), (S.table(spark, sf, "benchmark"), "text", False)]
    )


@query
def build_vocab(spark, sf):
    return _vocabulary(spark, sf).select("ch", F.col("id").cast("bigint").alias("id"))


@query
def encode_chars(spark, sf):
    mapping = vocab.to_mapping(_vocabulary(spark, sf))
    turns = S.texts(spark, sf, "conversations", "conv_id", "turn")
    return turns.select("conv_id", "turn", _join(vocab.encode("text", mapping)).alias("ids"))


@query
def decode_chars(spark, sf):
    mapping = vocab.to_mapping(_vocabulary(spark, sf))
    ids = S.texts(spark, sf, "conversations", "conv_id", "turn").select(
        "conv_id", "turn", vocab.encode("text", mapping).alias("ids")
    )
    return ids.select("conv_id", "turn", vocab.decode("ids", mapping).alias("text"))


@query
def concat_text(spark, sf):
    docs = S.table(spark, sf, "documents").select("doc_id", "text")
    numbered = docs.join(ordering.row_index(docs.select("doc_id"), ["doc_id"]), "doc_id")
    chunks = evaluation.concat_text(numbered, "text", "row_idx", 100)
    return chunks.select("chunk", "n_rows", F.md5("text").alias("digest"))


@query
def concat_text_bytes(spark, sf):
    """As :func:`concat_text`, in stretches of 50 kB per language."""
    docs = S.table(spark, sf, "documents").select("doc_id", "lang", "text")
    keys = ordering.row_index(docs.select("lang", "doc_id"), ["doc_id"], ["lang"])
    chunks = evaluation.concat_text(docs.join(keys, ["lang", "doc_id"]), "text", "row_idx", by=["lang"], chunk_bytes=50_000)
    return chunks.select("lang", F.col("chunk").cast("bigint").alias("chunk"), "n_rows", F.md5("text").alias("digest"))


@query
def mean_batch_metric(spark, sf):
    events = S.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 64).alias("batch"), "value"
    )
    out = evaluation.mean_of_batches(events, "batch", ["value"])
    return out.withColumn("mean_value", F.round("mean_value", 4))


def _distributions(spark, sf) -> DataFrame:
    emb = S.table(spark, sf, "embeddings")
    rotated = F.concat(F.slice("embedding", F.lit(2), F.size("embedding")), F.slice("embedding", 1, 1))
    return emb.select(
        (F.col("label") - 3).alias("label"),
        F.transform(A.log_softmax("embedding", 2.0), lambda x: F.exp(x)).alias("p"),
        A.log_softmax(rotated, 2.0).alias("log_q"),
    )


@query
def masked_divergence(spark, sf):
    out = evaluation.masked_divergence(_distributions(spark, sf), "p", "log_q", "label")
    return out.select(
        "n_positions",
        F.round("divergence", 6).alias("divergence"),
        F.round(evaluation.weighted_loss(F.lit(1.5), "divergence"), 6).alias("loss"),
    )


# --- corpora ------------------------------------------------------------------


@query
def concat_corpora(spark, sf):
    docs = S.utterances(spark, sf).select(
        F.lit("documents").alias("corpus"), F.col("utt_id").cast("string").alias("utt_id"),
        "split", "sentence", "input_length",
    )
    turns = S.spoken(spark, sf).select(
        F.lit("conversations").alias("corpus"), F.col("file_id").alias("utt_id"),
        F.col("role").alias("split"), F.col("ref").alias("sentence"),
    )
    items = S.table(spark, sf, "benchmark").select(
        F.lit("benchmark").alias("corpus"), F.col("item_id").cast("string").alias("utt_id"),
        F.col("text").alias("sentence"),
    )
    return corpora.concat([docs, turns, items]).select(
        "corpus", "utt_id", "split", "input_length", F.length("sentence").cast("bigint").alias("n_chars")
    )


@query
def combine_corpora(spark, sf):
    root = scratch_path(spark, "corpora")
    docs = S.table(spark, sf, "documents").select(
        F.lit("documents").alias("corpus"), F.col("lang").alias("config"), F.lit("train").alias("split"),
        F.col("doc_id").cast("string").alias("utt_id"), "text",
    )
    items = S.spoken(spark, sf).select(
        F.lit("turns").alias("corpus"), F.lit("all").alias("config"), F.col("role").alias("split"),
        F.col("file_id").alias("utt_id"), F.col("ref").alias("text"),
    )
    writers.save(docs.unionByName(items), root, ["corpus", "config", "split"])
    specs = corpora.parse_specs("documents+documents+turns", "en+fr+all", "train+train+user")
    return corpora.combine(spark, root, specs).select(
        "corpus", "config", "split", "utt_id", "sentence"
    )


@query
def combine_sampled(spark, sf):
    """The same corpus table; counts per entry set the shares, one corpus is named twice."""
    root = scratch_path(spark, "sampled")
    docs = S.table(spark, sf, "documents").select(
        F.col("source").alias("corpus"), F.col("lang").alias("config"), F.lit("train").alias("split"),
        F.col("doc_id").cast("string").alias("utt_id"), "text",
    )
    writers.save(docs, root, ["corpus", "config", "split"])
    specs = corpora.parse_specs("src0+src1+src0", "en+en+fr", samples="120+60+20")
    out = corpora.combine_sampled(spark, root, specs, "utt_id", seed=3)
    return out.select(F.col("source").cast("bigint").alias("source"), "utt_id", "position", F.md5("sentence").alias("digest"))


@query
def mix_weighted_shared_keys(spark, sf):
    """Three corpora that number their rows alike; the third is not asked for."""
    docs = S.table(spark, sf, "documents").select("doc_id", F.explode(F.array(*[F.lit(c) for c in "abc"])).alias("corpus"))
    return corpora.mix_weighted(docs, {"a": 0.3, "b": 0.7}, "doc_id", seed=7)


@query
def mix_corpora(spark, sf):
    shares = {"en": 0.25, "fr": 0.5, "de": 0.75, "es": 1.0}
    return corpora.mix(S.utterances(spark, sf), shares, "utt_id", "split", seed=7).select(
        "utt_id", "split", "corpus"
    )


@query
def mix_weighted(spark, sf):
    weights = {s.name: s.samples for s in corpora.parse_specs("src0+src1", "all+all", samples="0.3+0.7")}
    return corpora.mix_weighted(S.utterances(spark, sf), weights, "utt_id", seed=7).select("utt_id", "corpus")


@query
def retain_newest_by_quality(spark, sf):
    docs = S.table(spark, sf, "documents").select("doc_id").join(S.table(spark, sf, "labels"), "doc_id", "left")
    runs = docs.select(F.col("quality").alias("run"), F.col("doc_id").alias("step"))
    return layout.retain_newest(runs, "run", "step", 50, "step")


@query
def cast_and_check(spark, sf):
    events = quality.require_columns(S.table(spark, sf, "events"), ["event_id", "ts", "value"])
    return events.select(
        "event_id",
        F.col("ts").cast("date").cast("string").alias("day"),
        F.floor("value").cast("bigint").alias("whole"),
        F.col("value").cast("float").cast("double").alias("single"),
    )


def _copies(spark, sf, k: int) -> DataFrame:
    emb = S.table(spark, sf, "embeddings").select(F.col("vec_id").alias("utt_id"), "embedding")
    return corpora.replicate(emb, k)


@query
def replicate_augment(spark, sf):
    plan = augment.augmentation_plan(_copies(spark, sf, corpora.REPLICAS["features"]))
    masked = augment.mask_vector(plan, "embedding", "time_mask", "time")
    masked = augment.mask_vector(masked, "embedding", "freq_mask", "freq")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return masked.select(
        "utt_id", F.col("replica").cast("bigint").alias("replica"),
        *[_int(F.col(c)).alias(c) for c in ("time_mask", "stretch", "freq_mask")],
        "time_start", "time_stop", "freq_start", "freq_stop",
        F.round(total, 3).alias("total"),
    )


@query
def mask_matrices(spark, sf):
    """A band of rows and one of columns zeroed in every copy of a matrix of eight columns."""
    rows = _copies(spark, sf, 2).withColumn("features", _cut_up("embedding", 8)).withColumn("on", F.lit(True))
    masked = augment.mask_matrix(rows, "features", 0, "on", "time", max_width=6)
    masked = augment.mask_matrix(masked, "features", 1, "on", "freq", max_width=6)
    total = F.aggregate(F.flatten("features"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    zeros = F.size(F.filter(F.flatten("features"), lambda x: x == 0))
    return masked.select("utt_id", F.col("replica").cast("bigint").alias("replica"), F.round(total, 3).alias("total"), zeros.cast("bigint").alias("zeros"))


@query
def add_noise(spark, sf):
    noisy = augment.add_noise(_copies(spark, sf, corpora.REPLICAS["ctc"]), "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return noisy.select(
        "utt_id", F.col("replica").cast("bigint").alias("replica"),
        F.round("noise_amp", 8).alias("noise_amp"), F.round(total, 3).alias("total"),
    )


@query
def frame_stats(spark, sf):
    emb = S.table(spark, sf, "embeddings")
    framed = augment.frames(emb, "embedding", "vec_id", 16, 8, "label")
    stats = augment.frame_stats(framed, "label")
    return stats.select(
        "label", "n_frames", F.round("mean_energy", 6).alias("mean_energy"),
        F.round("std_energy", 6).alias("std_energy"),
    )


# --- layout -------------------------------------------------------------------


@query
def assign_shards(spark, sf):
    keys = ordering.row_index(S.matched_keys(spark, sf), ["doc_id"])
    sharded = layout.assign_shards(keys, 50, matched=F.col("matched") == 1)
    texts = S.table(spark, sf, "documents").select("doc_id", "text")
    # The flush looks at matched rows, short ones included; the text filter is last.
    kept = sharded.join(texts, "doc_id").where(quality.min_text("text", quality.MIN_CHARS_PSEUDO))
    return kept.select("doc_id", "row_idx", "shard")


@query
def assign_shards_by_corpus(spark, sf):
    keys = ordering.row_index(S.matched_keys(spark, sf), ["doc_id"], by=["corpus"])
    return layout.assign_shards(
        keys, 20, by=["corpus"], matched=F.col("matched") == 1
    ).select("doc_id", "corpus", "row_idx", "shard")


@query
def interleave_splits(spark, sf):
    keys = S.utterances(spark, sf).select("utt_id", "split")
    return layout.interleave(keys, "split", ["en", "de", "fr", "es"], ["utt_id"])


@query
def interleave_weighted(spark, sf):
    """Shares of four languages, up to the first end and up to the last."""
    keys = S.utterances(spark, sf).select("utt_id", "split")
    weights = {"en": "0.5", "de": "0.25", "fr": "0.2", "es": "0.05"}
    parts = [
        layout.interleave_weighted(keys, "split", weights, ["utt_id"], stop).withColumn("stop", F.lit(stop)) for stop in ("first", "all")
    ]
    return parts[0].unionByName(parts[1])


@query
def assemble_batches(spark, sf):
    turns = S.table(spark, sf, "conversations")
    codes = F.transform(X.chars("text"), lambda c: F.ascii(c))
    # Start token 1 on every row but the system turns.
    starts = F.when(F.col("role") == "system", codes).otherwise(F.concat(F.array(F.lit(1)), codes))
    keyed = turns.select("conv_id", "turn", "role")
    pos = ordering.row_index(keyed, ["role", "conv_id", "turn"])
    rows = turns.select("conv_id", "turn", starts.alias("labels")).join(pos, ["conv_id", "turn"])
    out = layout.assemble_batches(rows, "row_idx", "labels", 16, bos_id=1)
    return out.select("row_idx", "batch", F.size("labels").cast("bigint").alias("width"), F.md5(_join(F.col("labels"))).alias("digest"))


@query
def padding_mask(spark, sf):
    """Padded ids, their attention mask, and the ids with padding ignored."""
    codes = F.transform(X.chars("text"), lambda c: F.ascii(c))
    rows = S.table(spark, sf, "conversations").select("conv_id", "turn", codes.alias("ids"))
    mask = A.attention_mask("ids", 400)
    ignored = A.ignore_padding(A.pad("ids", 400, 0), mask)
    return rows.select(
        "conv_id", "turn", F.size(mask).cast("bigint").alias("width"),
        F.aggregate(mask, F.lit(0).cast("bigint"), lambda n, m: n + m).alias("n_real"), F.md5(_join(ignored)).alias("digest"),
    )


@query
def shift_and_mask(spark, sf):
    codes = F.transform(X.chars("text"), lambda c: F.ascii(c))
    tokens = S.texts(spark, sf, "conversations", "conv_id", "turn").select("conv_id", "turn", codes.alias("t"))
    masked = A.mask_prompt("t", 32)
    return tokens.select(
        "conv_id", "turn",
        _join(A.shift_right("t", 1)).alias("shifted"),
        _join(A.decoder_input("t")).alias("inputs"),
        _join(masked).alias("targets"),
        _join(A.restore_padding(masked, 0)).alias("restored"),
    )


@query
def ctc_greedy(spark, sf):
    emb = S.table(spark, sf, "embeddings")
    # Frames of 4 scores.
    frames = _cut_up("embedding", 4)
    ids = emb.select("vec_id", F.transform(frames, lambda f: A.argmax(f)).alias("best"))
    return ids.select(
        "vec_id", _join(F.col("best")).alias("ids"), _join(A.ctc_collapse("best", 0)).alias("collapsed")
    )


@query
def retain_newest_ties(spark, sf):
    """Runs whose steps and types recur: two rows a run, chosen among equals."""
    runs = S.table(spark, sf, "events").select(F.col("user_id").alias("run"), F.hour("ts").cast("bigint").alias("step"), "event_type")
    return layout.retain_newest(runs, "run", "step", 2, "event_type", ties="rank")


@query
def retain_newest(spark, sf):
    runs = S.table(spark, sf, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"))
    return layout.retain_newest(runs, "run", "step", 3, "step")


def _runs(spark, sf) -> DataFrame:
    return S.table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("run"),
        F.concat(
            F.when(F.col("event_type") == "error", "broken-").otherwise("checkpoint-"),
            F.col("event_id").cast("string"), F.lit("-epoch-"),
            F.get_json_object("props", "$.k"),
        ).alias("path"),
    )


@query
def latest_per_group(spark, sf):
    return layout.last_checkpoint(_runs(spark, sf).drop("event_id"), ["run"], "path")


@query
def checkpoint_steps(spark, sf):
    return _runs(spark, sf).select("event_id", layout.checkpoint_step("path").alias("step"))


@query
def seeded_shuffle(spark, sf):
    keys = S.utterances(spark, sf).select("utt_id")
    return ordering.seeded_shuffle(keys, "utt_id", seed=0)


@query
def epoch_shuffle(spark, sf):
    keys = S.utterances(spark, sf).select("utt_id")
    first = ordering.seeded_shuffle(keys, "utt_id", seed=0, epoch=1, name="pos_1")
    second = ordering.seeded_shuffle(keys, "utt_id", seed=0, epoch=2, name="pos_2")
    return first.join(second, "utt_id")


@query
def resume_skip(spark, sf):
    keys = S.utterances(spark, sf).select("utt_id")
    shuffled = ordering.seeded_shuffle(keys, "utt_id", seed=0)
    return ordering.skip_batches(shuffled, "shuffle_pos", 64, 3)


# --- streams ------------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    schema = S.table(spark, sf, "events").schema
    return readers.stream_corpus(spark, f"{sf}/events.parquet*", schema)


@query
def stream_totals(spark, sf):
    out, ckpt = scratch_path(spark, "totals"), scratch_path(spark, "totals-log")
    rows = _rtf_rows(_event_stream(spark, sf))
    jobs.running_totals(
        rows, ["model"], {"gen_seconds": F.col("gen_time"), "audio_seconds": F.col("seconds")}, out, ckpt
    )
    totals = jobs.current_totals(spark, out)
    return totals.select(
        "model", "n_samples", F.round("gen_seconds", 4).alias("gen_seconds"),
        F.round("audio_seconds", 4).alias("audio_seconds"),
    )


@query
def stream_filter(spark, sf):
    out, ckpt = scratch_path(spark, "filtered"), scratch_path(spark, "filtered-log")
    schema = S.table(spark, sf, "documents").schema
    stream = readers.stream_corpus(spark, f"{sf}/documents.parquet*", schema)

    def clean(df: DataFrame) -> DataFrame:
        named = df.withColumnRenamed("text", "transcription")
        return named.where(quality.min_text("transcription", quality.MIN_CHARS_CORPUS)).select(
            "doc_id", X.normalize("transcription").alias("transcription")
        )

    jobs.stream_to_table(stream, out, ckpt, clean)
    return readers.load(spark, out)


@query
def stream_snapshot(spark, sf):
    out, ckpt = scratch_path(spark, "snapshot"), scratch_path(spark, "snapshot-log")
    rows = _event_stream(spark, sf).select(
        F.col("event_id").cast("string").alias("file_id"), F.col("event_type").alias("transcript")
    )
    jobs.stream_snapshot(rows, out, ckpt)
    return jobs.read_snapshot(spark, out)


@query
def stream_resume(spark, sf):
    """Two runs over one growing folder: the second takes up what the first has not seen."""
    source, out, ckpt = (scratch_path(spark, name) for name in ("resumed", "resumed-out", "resumed-log"))
    docs = S.table(spark, sf, "documents").select("doc_id", "text")
    early = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    for part in (early, ~early):
        docs.where(part).write.mode("append").parquet(source)
        stream = readers.stream_corpus(spark, source, docs.schema)
        jobs.stream_to_table(stream, out, ckpt, lambda df: df.where(quality.min_text("text", quality.MIN_CHARS_CORPUS)))
    return readers.load(spark, out).select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


# --- files --------------------------------------------------------------------


@query
def roundtrip_io(spark, sf):
    """Prediction CSV, text files per row and a cached table, written and read back."""
    base = scratch_path(spark, "roundtrip")
    said = S.spoken(spark, sf).select("file_id", F.col("ref").alias("transcript"))
    writers.write_predictions(said, f"{base}/preds")
    from_csv = readers.scan_predictions(spark, f"{base}/preds")
    kept = writers.materialize(spark, f"{base}/table", lambda: from_csv)
    again = writers.materialize(spark, f"{base}/table", lambda: from_csv.limit(0))
    return kept.join(again.withColumnRenamed("transcript", "cached"), "file_id")


def _saved_in_order(spark, sf, name: str) -> str:
    """Keys of all documents, saved in a stated order in files of few rows."""
    path = scratch_path(spark, name)
    docs = S.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    writers.write_ordered(docs, path, ["source", F.desc("doc_id")], 70, docs.count())
    return path


@query
def row_index_saved(spark, sf):
    numbered = readers.load_numbered(spark, _saved_in_order(spark, sf, "numbered"))
    return numbered.select("row_idx", "doc_id")


@query
def attach_saved(spark, sf):
    """Predictions by row number: both tables were saved in one order, in files of different sizes."""
    path = _saved_in_order(spark, sf, "rows")
    other = scratch_path(spark, "predictions")
    values = readers.load_numbered(spark, path).select("row_idx", (F.col("n_chars") * 2).alias("value"))
    writers.write_ordered(values, other, ["row_idx"], 33, S.table(spark, sf, "documents").count(), ["value"])
    rows = readers.load_numbered(spark, path).select("row_idx", "doc_id")
    return pairing.zip_numbered(rows, readers.load_numbered(spark, other))


@query
def transcript_files(spark, sf):
    base = scratch_path(spark, "texts")
    items = S.table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value"))
    items.write.partitionBy("item_id").text(base)
    item = F.regexp_extract("path", "item_id=([0-9]+)", 1).cast("bigint").alias("item_id")
    listed = readers.list_files(spark, base, ["*.txt", "part-*"], recursive=True)
    files = ordering.row_index(listed, ["path"], name="place")
    read = readers.read_transcripts(spark, f"{base}/*", "*.txt")
    texts = read.select(item, F.regexp_replace("text", "\n$", "").alias("text"))
    return files.select(item, "length", "place").join(texts, "item_id")


@query
def annotation_files(spark, sf):
    """One JSON object ``{key: sentence}`` per file, fifty keys each."""
    base = scratch_path(spark, "annotations")
    entry = F.struct(F.col("item_id").cast("string"), "text")
    bucket = F.floor(F.col("item_id") / 50).alias("bucket")
    objects = S.table(spark, sf, "benchmark").groupBy(bucket).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    )
    objects.write.partitionBy("bucket").text(base)
    return readers.scan_json_map(spark, f"{base}/*").select(F.col("key").cast("bigint").alias("item_id"), "sentence")


def _sayings(spark, sf) -> DataFrame:
    """Turns with line feeds, quotation marks and commas in their texts."""
    text = F.regexp_replace(F.replace("ref", F.lit("th"), F.lit('"th",')), "([.?])", '$1\n\n""')
    return S.spoken(spark, sf).select("file_id", "role", text.alias("transcript"))


@query
def csv_splits(spark, sf):
    """Prediction files whose fields span lines, read by ranges of bytes."""
    base = scratch_path(spark, "csv")
    writers.write_predictions(_sayings(spark, sf), base)
    return splitscan.read_csv(spark, base, schema.PREDICTION).select("file_id", F.md5("transcript").alias("digest"))


@query
def csv_skip_first(spark, sf):
    """A file per role without its first data row, by the reader of ranges and by the one of whole files."""
    base = scratch_path(spark, "roles")
    rows = _sayings(spark, sf).repartition("role").sortWithinPartitions("role", "file_id")
    rows.write.partitionBy("role").option("header", True).option("escape", '"').option("quoteAll", True).csv(base)
    parts = [
        splitscan.read_csv(spark, f"{base}/*", schema.PREDICTION, skip_first=True).select("file_id", F.lit("ranges").alias("reader")),
        readers.scan_predictions(spark, f"{base}/*", skip_first=True).select("file_id", F.lit("files").alias("reader")),
    ]
    return parts[0].unionByName(parts[1])


@query
def json_splits(spark, sf):
    """Four JSON objects per source with a line for every document, read by ranges of bytes."""
    base = scratch_path(spark, "objects")
    bucket = F.pmod(F.hash("doc_id"), F.lit(4)).alias("bucket")
    docs = S.table(spark, sf, "documents").select("*", bucket)
    entry = F.concat(F.lit(", "), F.regexp_replace(F.to_json(F.create_map(F.col("doc_id").cast("string"), F.col("text"))), r"^\{|\}$", ""))
    lines = docs.select("source", "bucket", F.lit(1).alias("part"), entry.alias("value"))
    ends = docs.select("source", "bucket").distinct().select("source", "bucket", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.lit('{"none": [1, {"a": "}"}]').alias("value")), F.struct(F.lit(2).alias("part"), F.lit("}").alias("value")),
    )).alias("end")).select("source", "bucket", "end.*")
    whole = lines.unionByName(ends).repartition("source", "bucket").sortWithinPartitions("source", "bucket", "part")
    whole.select("source", "bucket", "value").write.partitionBy("source", "bucket").text(base)
    read = splitscan.read_json_map(spark, f"{base}/*/*").where(F.col("key") != "none")
    return read.select(F.col("key").cast("bigint").alias("doc_id"), F.md5("value").alias("digest"))


@query
def vocab_file(spark, sf):
    path = scratch_path(spark, "vocab")
    writers.write_vocab(_vocabulary(spark, sf), path)
    return readers.load_vocab(spark, path).select("ch", F.col("id").cast("bigint").alias("id"))


@query
def sharded_files(spark, sf):
    base = scratch_path(spark, "shards")
    keys = ordering.row_index(S.matched_keys(spark, sf).select("doc_id", "matched"), ["doc_id"])
    sharded = layout.assign_shards(keys, 50, matched=F.col("matched") == 1)
    writers.write_sharded(sharded, base)
    read = readers.load(spark, f"{base}/shard=*").withColumn("_path", F.col("_metadata.file_path"))
    shard = F.regexp_extract("_path", "shard=([0-9]+)", 1).cast("bigint")
    return read.groupBy(shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
        F.count_distinct("_path").alias("n_files"),
    )


@query
def sharded_bounded(spark, sf):
    """Shards of fifty positions that merge where a boundary has no transcript, in files of 20 kB of text."""
    keys = ordering.row_index(S.matched_keys(spark, sf), ["doc_id"])
    sharded = layout.assign_shards(keys, 50, matched=F.col("matched") == 1).select("doc_id", "row_idx", "shard")
    texts = S.table(spark, sf, "documents").select("doc_id", "text")
    rows = sharded.join(texts, "doc_id")
    manifest = writers.write_bounded(rows, scratch_path(spark, "bounded"), F.octet_length("text"), 20_000)
    return manifest.select(*[F.col(c).cast("bigint").alias(c) for c in ("shard", "part", "first_row", "last_row", "n_rows", "n_bytes")])


@query
def reuse_fresh(spark, sf):
    """A table of counts kept while its input stays; one more input file makes a new one."""
    base = scratch_path(spark, "reuse")
    docs = S.table(spark, sf, "documents").select("doc_id", "lang")
    docs.where(F.col("lang") != "en").write.parquet(f"{base}/in")

    def build(marker: str) -> DataFrame:
        counts = readers.load(spark, f"{base}/in", docs.schema).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        return writers.materialize_fresh(spark, f"{base}/out", lambda: counts, [f"{base}/in"]).select(F.lit(marker).alias("state"), "lang", "n")

    first, same = build("first"), build("same")
    docs.where(F.col("lang") == "en").write.mode("append").parquet(f"{base}/in")
    return first.unionByName(same).unionByName(build("grown"))


@query
def resume_rows(spark, sf):
    """A run that stopped after two languages; the next one does exactly what is missing."""
    out = scratch_path(spark, "half")
    docs = S.table(spark, sf, "documents").select("doc_id", "lang", "text")

    def work(rows: DataFrame, run: int) -> None:
        rows.select("doc_id", F.length(X.normalize("text")).cast("bigint").alias("n_chars"), F.lit(run).alias("run")).write.mode("append").parquet(out)

    work(docs.where(F.col("lang").isin("en", "de")), 1)
    done = readers.load(spark, out).select("doc_id")
    work(resume.remaining(docs, done, ["doc_id"]), 2)
    return readers.load(spark, out).select("doc_id", "n_chars", F.col("run").cast("bigint").alias("run"))


@query
def report_files(spark, sf):
    base = scratch_path(spark, "report")
    writers.write_report(_report(spark, sf), base, ["file_id", "model"])
    model = F.col("model").cast("bigint").alias("model")
    every = readers.load(spark, f"{base}/all_predictions").select("file_id", model, F.lit(0).alias("wrong"))
    wrong = readers.load(spark, f"{base}/incorrect_predictions").select("file_id", model, F.lit(1).alias("wrong"))
    return every.union(wrong)


@query
def text_blob(spark, sf):
    base = scratch_path(spark, "blob")
    turns = S.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    keys = ordering.row_index(turns.select("conv_id", "turn"), ["conv_id", "turn"])
    chunks = evaluation.concat_text(turns.join(keys, ["conv_id", "turn"]), "text", "row_idx", 100)
    for _ in range(2):
        writers.append_text(chunks, base)
    parts = readers.load(spark, base)
    return parts.select(
        F.col("call").cast("bigint").alias("call"), "chunk", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest")
    )


# --- caller functions ---------------------------------------------------------


@query
def batch_scorer(spark, sf):
    said = S.spoken(spark, sf)

    def long_enough(text: pd.Series) -> pd.Series:
        return text.str.len() > 100

    kept = scoring.filter_rows(said, long_enough, ["ref"])
    scored = scoring.score(kept, "file_id", ["ref"], lambda b: b["ref"].str[::-1])
    return scoring.map_rows(
        scored, {"pred": F.col("pred"), "timed": _int(F.col("gen_time") >= 0)}, ["file_id"]
    )


@query
def collate_batches(spark, sf):
    """Turns in batches of 64 as a caller's collator sees them: width, padding and the first of each."""
    turns = S.table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    rows = turns.join(ordering.row_index(turns.select("conv_id", "turn"), ["conv_id", "turn"]), ["conv_id", "turn"])

    def pad(batch: pd.DataFrame) -> pd.DataFrame:
        width = int(batch["n"].max())
        return pd.DataFrame({"first_conv": [batch["conv_id"].iloc[0]], "n_rows": [len(batch)], "width": [width], "n_pad": [int((width - batch["n"]).sum())]})

    return scoring.collate(rows, "row_idx", 64, pad, "first_conv bigint, n_rows bigint, width bigint, n_pad bigint", ["conv_id", "n"])


@query
def map_batches(spark, sf):
    def double(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(value=batch["value"] * 2)

    rows = S.table(spark, sf, "events").select("event_id", "value")
    return scoring.map_batches(rows, double, "event_id bigint, value double")


# --- whole jobs ---------------------------------------------------------------


@query
def job_training_table(spark, sf):
    docs = S.table(spark, sf, "documents")
    audio = docs.select(
        F.concat(F.lit("/data/audio/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path"),
        (F.col("n_chars").cast("double") / 64).alias("input_length"),
    )
    texts = S.text_files(spark, sf, "clean", labelled=True)
    out = lifecycles.training_table(audio, texts, _CLEAN, corpora.REPLICAS["ctc"], max_tokens=1500)
    return out.select("path", "input_length", "transcript", F.col("replica").cast("bigint").alias("replica"))


@query
def job_formal_evaluation(spark, sf):
    preds = S.predictions(spark, sf).select("file_id", "pred", F.col("model").cast("bigint").alias("model"))
    return lifecycles.formal_evaluation(S.spoken(spark, sf).select("file_id", "ref"), preds)


@query
def job_pseudo_labels(spark, sf):
    preds = S.predictions(spark, sf).select(
        "file_id", F.col("pred").alias("transcript"), F.col("model").alias("row_idx")
    )
    return lifecycles.pseudo_labels(S.spoken(spark, sf), preds, "ref")


FLAGSHIP = "cer_corpus"
