"""Row filters, the admission rules and the one-pass funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.functions import arrays as A
from uttermill.functions import text as X

# Limits of the corpus builders and trainers.
MIN_CHARS_CORPUS = 3
MIN_CHARS_PSEUDO = 5
MIN_CHARS_VOCAB = 1
MAX_SECONDS = 30.0
MAX_SECONDS_PREFILTER = 29.5
MIN_SECONDS = 1.5
MAX_TOKENS = 448
MAX_LABEL_TOKENS = 128
MIN_LABEL_CHARS = 5
MAX_LABEL_CHARS = 450
FEATURE_SHAPE = (80, 3000)
RELABEL_CER = 15.0

# Leading bytes of the readable container formats.
AUDIO_MAGIC = ("664C6143", "494433", "4F676753")


def min_text(c: Column | str, k: int) -> Column:
    """More than ``k`` characters after trimming Unicode white space."""
    return X.stripped_length(c) > k


def below_duration(c: Column | str, maximum: float = MAX_SECONDS) -> Column:
    return A._col(c) < maximum


def duration_band(
    c: Column | str, minimum: float = MIN_SECONDS, maximum: float = MAX_SECONDS
) -> Column:
    """Both bounds are strict, unlike ``between``."""
    return (A._col(c) > minimum) & (A._col(c) < maximum)


def below_tokens(c: Column | str, maximum: int = MAX_TOKENS) -> Column:
    return F.size(A._col(c)) < maximum


def token_band(c: Column | str, maximum: int = MAX_LABEL_TOKENS) -> Column:
    """At least one token, at most ``maximum``."""
    return (F.size(A._col(c)) > 0) & (F.size(A._col(c)) <= maximum)


def char_band(
    c: Column | str, minimum: int = MIN_LABEL_CHARS, maximum: int = MAX_LABEL_CHARS
) -> Column:
    """Strictly between the two character counts, untrimmed."""
    return (F.length(A._col(c)) > minimum) & (F.length(A._col(c)) < maximum)


def readable_media(content: Column | str, magic: Sequence[str] = AUDIO_MAGIC) -> Column:
    """True when the payload starts with one of the (hex) signatures.

    With the audio signatures also: WAVE inside RIFF, an ``ftyp`` box, and an MPEG audio
    frame: eleven sync bits, then no reserved version, layer, bit rate or sampling rate.
    FFFE is taken for the mark of a UTF-16 text (as a frame it would be layer I with a checksum).
    """
    head = A._col(content)
    hits = [F.hex(F.substring(head, 1, len(m) // 2)) == m for m in magic]
    if magic is AUDIO_MAGIC:
        code = F.hex(F.substring(head, 1, 12))
        hits.append(code.startswith("52494646") & (F.substring(code, 17, 8) == "57415645"))
        hits.append(F.substring(code, 9, 8) == "66747970")
        hits.append(F.regexp_like(code, F.lit("^FF(E[2-7]|F[2-7A-DF])[0-9A-E][0-9A-B]")))
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return F.coalesce(out, F.lit(False))


def admit(df: DataFrame, rules: Mapping[str, Column], name: str = "reject_reason") -> DataFrame:
    """Name the first rule a row breaks; NULL admits it.

    A rule that evaluates to NULL counts as broken: a consumer would fail there.
    """
    reason = F.lit(None).cast("string")
    for rule, ok in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)).otherwise(reason)
    return df.withColumn(name, reason)


def split_admitted(df: DataFrame, name: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """The admitted rows and the quarantine."""
    return df.where(F.col(name).isNull()).drop(name), df.where(F.col(name).isNotNull())


def funnel(df: DataFrame, stages: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows left after every stage, all counted in one pass."""
    counts = [F.count(F.lit(1)).alias("n_input")]
    passed = F.lit(True)
    for stage, ok in stages.items():
        passed = passed & F.coalesce(ok, F.lit(False))
        counts.append(F.count_if(passed).alias(f"n_{stage}"))
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail before planning when a column is missing, listing what is there."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {', '.join(sorted(df.columns))}")
    return df
