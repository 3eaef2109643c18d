"""Utterances, pairs and predictions derived from the driver's tables.

The tables hold no audio and no model output.  Documents stand in for
utterances (64 characters are one second), adjacent conversation turns for
reference and prediction, and three rewritings of a turn for three models.
Holes come from the data: a document without a label has no transcript, a
system turn has no prediction, and a hash of the id makes a third blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.functions.hashing import hash_bits
from uttermill.session import spread


SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; a stated schema saves reading footers first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *keys: str) -> DataFrame:
    """A table whose text is worked on; small ones use all cores."""
    return spread(table(spark, sf_dir, name), *keys)


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id").select(
        F.col("doc_id").alias("utt_id"),
        F.col("source").alias("corpus"),
        F.col("lang").alias("split"),
        F.col("text").alias("sentence"),
        (F.col("n_chars").cast("double") / 64).alias("input_length"),
    )


#: Letters and the marks that stand in for them.
MARKED = ("qxzjkwv", "。“Ａ\t々！；")


def marked_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances with special tokens, CJK and curly marks, wide letters and outer white space."""
    text = F.translate(F.replace("sentence", F.lit("th"), F.lit("[UNK]")), *MARKED)
    padded = F.concat(F.lit("\u3000\t"), text, F.lit("\u3000 \n"))
    return utterances(spark, sf_dir).select("utt_id", padded.alias("sentence"))


def matched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document key, with 1 where a transcript (a label row) exists."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("corpus"))
    hit = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("_hit"))
    return docs.join(hit, "doc_id", "left").select(
        "doc_id", "corpus", F.coalesce("_hit", F.lit(False)).cast("int").alias("matched")
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the turn that follows it.

    An equi-join on (conversation, turn) and no window: a conversation of any
    length spreads over all tasks.
    """
    turns = table(spark, sf_dir, "conversations")
    ref = texts(spark, sf_dir, "conversations", "conv_id", "turn").select("conv_id", "turn", "role", F.col("text").alias("ref"))
    pred = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("pred"))
    return ref.join(pred, ["conv_id", "turn"])


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as utterances with a file id."""
    return texts(spark, sf_dir, "conversations", "conv_id", "turn").select(
        F.concat_ws("/", "conv_id", "turn").alias("file_id"),
        "role",
        F.col("text").alias("ref"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three predictions per non-system turn: (file_id, role, ref, model, pred)."""
    said = spoken(spark, sf_dir).where(F.col("role") != "system")
    blank = hash_bits("hole", F.col("file_id")) % 3 == 0
    texts = F.array(
        *[
            F.when(blank, F.lit("")).otherwise(text)
            for text in (
                F.col("ref"),
                F.reverse("ref"),
                F.replace("ref", F.lit("e"), F.lit("")),
            )
        ]
    )
    return said.select("*", F.posexplode(texts).alias("model", "pred"))


def audio_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(F.lit("/data/audio/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("path")
    )


def text_files(
    spark: SparkSession, sf_dir: str, folder: str, labelled: bool = False, quality: int | None = None
) -> DataFrame:
    """(path, text) of all documents, of the labelled, or of one quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    if labelled or quality is not None:
        labels = table(spark, sf_dir, "labels")
        if quality is not None:
            labels = labels.where(F.col("quality") == quality)
        docs = docs.join(labels.select("doc_id"), "doc_id")
    path = F.concat(
        F.lit(f"/data/{folder}/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")
    )
    return docs.select(path.alias("path"), "text")
