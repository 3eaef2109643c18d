"""The four end-to-end jobs, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.functions import text as X
from uttermill.operators import corpora, evaluation, ordering, pairing, quality, vocab
from uttermill.session import pin


def training_table(
    audio: DataFrame, texts: DataFrame, swaps: list[tuple[str, str]], replicas: int = 1,
    min_chars: int = quality.MIN_CHARS_CORPUS, max_seconds: float = quality.MAX_SECONDS_PREFILTER,
    max_tokens: int = quality.MAX_TOKENS,
) -> DataFrame:
    """Pair, clean out short and long rows, replicate.

    ``audio`` carries ``path`` and ``input_length`` (and whatever else is to be
    kept).  The filter on seconds needs no transcript, so it runs before the
    join; the only shuffle is the join itself.
    """
    short_enough = audio.where(quality.below_duration("input_length", max_seconds))
    paired = pairing.pair_skip(short_enough, texts, swaps)
    kept = paired.where(
        quality.min_text("transcript", min_chars) & (F.length("transcript") < max_tokens)
    )
    return corpora.replicate(kept, replicas)


def formal_evaluation(
    references: DataFrame, preds: DataFrame, key: str = "file_id", by: Sequence[str] = ("model",)
) -> DataFrame:
    """Error rate, raw and normalised, of predictions joined to references.

    ``references`` holds ``key`` and ``ref``; ``preds`` holds ``key``, ``pred``
    and the grouping columns.
    """
    return evaluation.raw_and_normalized_cer(references.join(preds, key), "ref", "pred", by)


def pseudo_labels(
    df: DataFrame, preds: DataFrame, label: str, key: str = "file_id", value: str = "transcript",
    written: str = "row_idx", threshold: float = quality.RELABEL_CER, seed: int = 0,
) -> DataFrame:
    """Attach the last prediction per id, drop blanks, relabel, shuffle.

    The shuffle reads its input twice, so the scored rows are pinned before it
    and no edit distance is taken a second time.
    """
    last = pairing.last_write(preds, key, value, written)
    attached = pairing.attach_predictions(df, last, key, value)
    relabelled = evaluation.relabel(attached, label, value, threshold, name=label)
    chosen = relabelled.select(*df.columns, F.col("relabelled").cast("int").alias("relabelled"))
    usable = chosen.where(quality.char_band(label, 0, quality.MAX_LABEL_CHARS + 1))
    return ordering.seeded_shuffle(pin(usable), key, seed)


def vocabulary(
    sources: Sequence[tuple[DataFrame, str, bool]], min_count: int = vocab.MIN_COUNT
) -> DataFrame:
    """Vocabulary over several corpora, each ``(frame, text column, lower)``."""
    cleaned = [
        (df.select(X.vocab_clean(text, lower).alias("_t")), "_t", 1) for df, text, lower in sources
    ]
    return vocab.build_vocab(vocab.weighted_frequency(cleaned), min_count)
