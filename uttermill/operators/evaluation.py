"""Corpus totals and error rates; every total is a mergeable partial aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.functions import metrics as M
from uttermill.functions import text as X
from uttermill.functions.arrays import percent
from uttermill.operators.ordering import running_total


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row, however often they are read.

    Catalyst merges a projection that holds a Python function into the next one
    and copies its expressions to every place of use.  It does not merge
    through a generator, here one of a single row.
    """
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def corpus_totals(df: DataFrame, by: Sequence[str] = ("corpus",), seconds: str = "input_length") -> DataFrame:
    """Rows kept and seconds of audio."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(seconds).alias("total_seconds")
    )


def real_time_factor(
    df: DataFrame, by: Sequence[str] = ("model",), seconds: str = "seconds", gen: str = "gen_time"
) -> DataFrame:
    """Generation seconds per second of audio, with the sums behind it."""
    total, spent = F.sum(seconds), F.sum(gen)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        spent.alias("gen_seconds"),
        total.alias("audio_seconds"),
        F.try_divide(spent, total).alias("rtf"),
    )


def with_edits(df: DataFrame, ref: str, pred: str, prefix: str = "") -> DataFrame:
    """Edits and reference length per row; NULL edits when the reference is empty."""
    n = F.length(ref).cast("bigint")
    return df.withColumn(f"{prefix}ref_chars", n).withColumn(
        f"{prefix}edits", F.when(n > 0, M.edit_distance(ref, pred))
    )


def _cer(edits: str, chars: str) -> Column:
    # Rows with an empty reference carry NULL edits and no characters.
    return percent(F.try_divide(F.sum(edits), F.sum(chars)))


def corpus_cer(df: DataFrame, ref: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Total edits over total reference characters, in percent."""
    scored = with_edits(df.select(*by, ref, pred), ref, pred)
    aggs = [
        F.count("edits").alias("n_scored"),
        F.sum("edits").alias("edits"),
        F.sum("ref_chars").alias("ref_chars"),
        _cer("edits", "ref_chars").alias("cer"),
    ]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def raw_and_normalized_cer(
    df: DataFrame, ref: str, pred: str, by: Sequence[str] = (), normalizer=X.normalize
) -> DataFrame:
    """Raw and normalised error rate side by side, one pass.

    The raw rate covers all rows with a reference; the normalised one those
    whose reference is non-empty after cleaning.
    """
    both = with_once(df.select(*by, ref, pred), _nref=normalizer(ref), _npred=normalizer(pred))
    scored = with_edits(with_edits(both, ref, pred, "raw_"), "_nref", "_npred", "norm_")
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("norm_edits").alias("n_scored"),
        F.sum("norm_edits").alias("edits"),
        F.sum("norm_ref_chars").alias("ref_chars"),
        _cer("norm_edits", "norm_ref_chars").alias("cer"),
        _cer("raw_edits", "raw_ref_chars").alias("cer_ortho"),
    ]
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def model_comparison(
    df: DataFrame, ref: str, pred: str, by: Sequence[str] = ("model", "split"),
    seconds: str = "seconds", gen: str = "gen_time", normalizer=X.normalize,
) -> DataFrame:
    """Error rate and real-time factor per model and split."""
    used = df.select(*by, seconds, gen, ref, pred)
    cleaned = with_once(used, _ref=normalizer(ref), _pred=normalizer(pred))
    scored = with_edits(cleaned, "_ref", "_pred")
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum("edits").alias("edits"),
        F.sum("ref_chars").alias("ref_chars"),
        _cer("edits", "ref_chars").alias("cer"),
        F.try_divide(F.sum(gen), F.sum(seconds)).alias("rtf"),
    )


def relabel(
    df: DataFrame, label: str, pred: str, threshold: float, normalizer=X.normalize_basic,
    name: str = "label",
) -> DataFrame:
    """Take the prediction as label where its error rate is below ``threshold``.

    An empty reference or a missing prediction keeps the label.
    """
    cleaned = with_once(df, _ref=normalizer(label), _pred=normalizer(pred))
    scored = cleaned.withColumn("relabelled", M.within_cer("_ref", "_pred", threshold))
    chosen = F.when(F.col("relabelled"), F.col(pred)).otherwise(F.col(label))
    return scored.withColumn(name, chosen).drop("_ref", "_pred")


def error_report(
    df: DataFrame, key: str | Sequence[str], ref: str, pred: str, normalizer=X.normalize, errors_only: bool = False
) -> DataFrame:
    """Target and prediction, raw and normalised, for rows with a usable reference."""
    keys = [key] if isinstance(key, str) else list(key)
    named = df.select(*keys, F.col(ref).alias("target"), F.col(pred).alias("pred"))
    cleaned = with_once(named, norm_target=normalizer("target"), norm_pred=normalizer("pred"))
    rows = cleaned.where(F.length("norm_target") > 0)
    return rows.where(F.col("norm_target") != F.col("norm_pred")) if errors_only else rows


def mean_of_batches(df: DataFrame, batch: str, values: Sequence[str]) -> DataFrame:
    """Unweighted mean over batches of the mean inside each batch."""
    inner = df.groupBy(batch).agg(*[F.avg(v).alias(v) for v in values])
    return inner.agg(
        F.count(F.lit(1)).alias("n_batches"), *[F.avg(v).alias(f"mean_{v}") for v in values]
    )


def divergence(target: Column | str, log_pred: Column | str) -> Column:
    """Sum over one position of ``p * (log p - log q)``; zero mass counts zero.

    A probability q of 0 (its logarithm is NULL or minus infinity) makes the sum infinite.
    """
    terms = F.zip_with(
        target, log_pred,
        lambda p, lq: F.when(p > 0, p * (F.ln(p) - F.coalesce(lq, F.lit(float("-inf"))))).otherwise(F.lit(0.0)),
    )
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def masked_divergence(
    df: DataFrame, target: str, log_pred: str, label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Divergence summed over labelled positions, per labelled position."""
    kept = (F.col(label) >= 0) & F.col(target).isNotNull() & F.col(log_pred).isNotNull()
    total = F.sum(F.when(kept, divergence(target, log_pred)))
    aggs = [
        F.count_if(kept).alias("n_positions"),
        F.try_divide(total, F.count_if(kept)).alias("divergence"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def weighted_loss(
    ce_loss: Column | str, divergence_value: Column | str, weight: float = 1.0,
    temperature: float = 2.0,
) -> Column:
    """``0.8 * ce + weight * divergence * temperature**2`` (fixed factors)."""
    ce = F.col(ce_loss) if isinstance(ce_loss, str) else ce_loss
    kl = F.col(divergence_value) if isinstance(divergence_value, str) else divergence_value
    return 0.8 * ce + weight * kl * temperature**2


def concat_text(
    df: DataFrame, text: str, pos: str, chunk_rows: int = 1000, by: Sequence[str] = (), chunk_bytes: int | None = None
) -> DataFrame:
    """All text in ``pos`` order without separators, as ordered chunks.

    ``pos`` is a dense position.  One value per corpus would outgrow any task,
    so a value holds ``chunk_rows`` texts, or with ``chunk_bytes`` the texts that begin
    in one stretch of so many bytes (a number is skipped where a longer text spans a stretch); read in chunk order they are the
    whole concatenation.
    """
    chunk = F.floor(F.col(pos) / chunk_rows).alias("chunk")
    if chunk_bytes:
        sized = df.withColumn("_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"))
        df = running_total(sized, pos, "_bytes", by, "_before")
        chunk = F.floor(F.col("_before") / chunk_bytes).alias("chunk")
    return df.groupBy(*by, chunk).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(text).alias("_t")))),
                lambda r: r["_t"],
            ),
            "",
        ).alias("text"),
    )
