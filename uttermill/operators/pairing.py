"""Matching recordings, transcripts, annotations and predictions by key.

All matches are equi-joins on unique right-hand keys.  No side carries a
broadcast hint: Spark broadcasts by measured size, and a hot left key is split
by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.functions.text import rewrite_path
from uttermill.operators.ordering import row_index

Swaps = list[tuple[str, str]]


def _with_key(audio: DataFrame, path: str, swaps: Swaps, name: str) -> DataFrame:
    return audio.withColumn(name, rewrite_path(path, swaps))


def _texts(texts: DataFrame, path: str, text: str, key: str, name: str) -> DataFrame:
    return texts.select(F.col(path).alias(key), F.col(text).alias(name))


def pair_strict(
    audio: DataFrame, texts: DataFrame, swaps: Swaps, path: str = "path", text: str = "text"
) -> DataFrame:
    """Attach the transcript at the rewritten path; a missing one is an error.

    The check is a filter, so every plan over the result runs it, whatever
    columns it reads; it fails the job, not the planning.
    """
    left = _with_key(audio, path, swaps, "_key")
    right = _texts(texts, path, text, "_key", "_text")
    failed = F.raise_error(F.concat(F.lit("no transcript for "), F.col(path)))
    joined = left.join(right.withColumn("_hit", F.lit(True)), "_key", "left")
    found = F.when(F.col("_hit"), F.lit(True)).otherwise(failed.cast("boolean"))
    return joined.where(found).select(*audio.columns, F.col("_text").alias("transcript"))


def pair_skip(
    audio: DataFrame, texts: DataFrame, swaps: Swaps, path: str = "path", text: str = "text"
) -> DataFrame:
    """Attach the transcript; recordings without one are left out."""
    left = _with_key(audio, path, swaps, "_key")
    right = _texts(texts, path, text, "_key", "transcript")
    return left.join(right, "_key").select(*audio.columns, "transcript")


def pair_fallback(
    audio: DataFrame,
    first: DataFrame,
    second: DataFrame,
    first_swaps: Swaps,
    second_swaps: Swaps,
    path: str = "path",
    text: str = "text",
) -> DataFrame:
    """Transcript of the first source, else of the second, else skip.

    Presence decides, not content: an empty first transcript still wins.
    """
    left = _with_key(_with_key(audio, path, first_swaps, "_k1"), path, second_swaps, "_k2")
    one = _texts(first, path, text, "_k1", "_t1").withColumn("_h1", F.lit(True))
    two = _texts(second, path, text, "_k2", "_t2").withColumn("_h2", F.lit(True))
    chosen = F.when(F.col("_h1"), F.col("_t1")).otherwise(F.col("_t2"))
    return (
        left.join(one, "_k1", "left")
        .join(two, "_k2", "left")
        .where(F.col("_h1") | F.col("_h2"))
        .select(*audio.columns, chosen.alias("transcript"))
    )


def with_pair_key(audio: DataFrame, swaps: Swaps, path: str = "path", name: str = "pair_key") -> DataFrame:
    """The rewritten path as a column of its own, to be stored as the key of a bucketed table."""
    return _with_key(audio, path, swaps, name)


def pair_bucketed(audio: DataFrame, texts: DataFrame, key: str = "pair_key", missing: str = "skip") -> DataFrame:
    """Pair two tables that are bucketed by ``key`` in equal numbers; neither side moves.

    ``missing`` decides about recordings without a transcript: ``skip`` leaves them out,
    ``keep`` keeps them with a null, ``only`` gives just them, ``fail`` fails the job.
    """
    side = texts.hint("merge")
    if missing == "only":
        return audio.join(side, key, "left_anti")
    if missing == "skip":
        return audio.join(side, key)
    if missing not in ("keep", "fail"):
        raise ValueError(f"missing is skip, keep, only or fail, not {missing}")
    out = audio.join(side.withColumn("_hit", F.lit(True)), key, "left")
    if missing == "fail":
        failed = F.raise_error(F.concat(F.lit("no transcript for "), F.col(key)))
        out = out.where(F.when(F.col("_hit"), F.lit(True)).otherwise(failed.cast("boolean")))
    return out.drop("_hit")


def having_partner(
    audio: DataFrame, texts: DataFrame, swaps: Swaps, path: str = "path", present: bool = True
) -> DataFrame:
    """Rows whose partner exists, or with ``present=False`` the skipped ones."""
    left = _with_key(audio, path, swaps, "_key")
    right = texts.select(F.col(path).alias("_key"))
    return left.join(right, "_key", "left_semi" if present else "left_anti").drop("_key")


def annotation_join(
    annotations: DataFrame, audio: DataFrame, directory: str, suffix: str = ".wav",
    key: str = "key", path: str = "path",
) -> DataFrame:
    """Annotation rows joined to ``directory/key.suffix``."""
    keyed = annotations.withColumn(path, F.concat(F.lit(f"{directory}/"), F.col(key), F.lit(suffix)))
    return keyed.join(audio, path)


def last_write(preds: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value written last.

    An aggregate, not a window: repeated keys shrink before the shuffle.
    """
    return preds.groupBy(key).agg(F.max_by(value, order).alias(value))


def attach_predictions(
    df: DataFrame, preds: DataFrame, key: str = "file_id", value: str = "transcript",
    drop_blank: bool = True,
) -> DataFrame:
    """Prediction by id, empty text when there is none; blanks dropped on request.

    With ``drop_blank`` a missing id cannot survive, so the join is an inner one
    and the blank test reaches the prediction scan.
    """
    side = preds.select(key, value)
    if drop_blank:
        return df.join(side.where(F.col(value) != ""), key)
    out = df.join(side, key, "left")
    return out.withColumn(value, F.coalesce(value, F.lit("")))


def attach_positional(
    df: DataFrame, values: DataFrame, order_by: Sequence[str | Column],
    value_order: Sequence[str | Column],
) -> DataFrame:
    """Zip two tables by position in their stated orders.

    Unequal row counts would shift every later pair, so they raise.
    """
    left, right = row_index(df, order_by), row_index(values, value_order)
    n_left, n_right = left.count(), right.count()
    if n_left != n_right:
        raise ValueError(f"row counts differ: {n_left} and {n_right}")
    return left.join(right, "row_idx")


def zip_numbered(left: DataFrame, right: DataFrame, name: str = "row_idx") -> DataFrame:
    """Zip two tables that carry dense row numbers, such as saved ones.

    Unequal row counts would shift every later pair, so a row without a partner
    fails the job; the check is part of the join and needs no count beforehand.
    """
    one = left.withColumnRenamed(name, "_l").withColumn("_one", F.lit(True))
    two = right.withColumnRenamed(name, "_r").withColumn("_two", F.lit(True))
    both = one.join(two, F.col("_l") == F.col("_r"), "full")
    failed = F.raise_error(F.concat(F.lit("row counts differ: no partner for row "), F.coalesce("_l", "_r").cast("string")))
    whole = F.when(F.col("_one") & F.col("_two"), F.lit(True)).otherwise(failed.cast("boolean"))
    names = [c for c in left.columns if c != name] + [c for c in right.columns if c != name]
    return both.where(whole).select(F.col("_l").alias(name), *names)


def lookup(map_col: Column | str, key: Column | str, default: str = "") -> Column:
    """Map lookup with a default for absent keys."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.try_element_at(m, k), F.lit(default))
