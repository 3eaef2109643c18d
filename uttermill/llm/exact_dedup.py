"""Exact dedup in salted stages that compare whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.llm.common import ascii_lower, keep_ids, staged

SALTS = 32


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text is an
    empty one.  The largest key of equal texts stays.

    A census of digests shows which can have a second row.  Only rows with such
    a digest send their text: equal (digest, salt, text) rows are combined in
    each task first (the partial aggregate), salted groups are merged after the
    first shuffle, and the winners of all salts are combined after the second.
    The text itself is a grouping key in every stage, so a group of any size is
    spread over ``salts`` tasks and two texts with one digest stay apart.  The
    decisions go back by (SHA-256, xxHash64, length).

    Rows that repeat a key and its text share one decision.  A null key loses
    against any other; if all are null, keep_id is null and the rows stay.  An
    empty table gives an empty result; other columns are not read.
    """
    body = ascii_lower(F.col(text))
    ident = [F.sha2("_body", 256).alias("text_sha256"), F.xxhash64("_body").alias("_second"), F.octet_length("_body").alias("_bytes")]
    census = staged(docs.select(F.col(key).alias("_key"), body.alias("_body")).select("_key", *ident), "digests")
    on = ["text_sha256", "_second", "_bytes"]
    several = census.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    suspects = census.join(several, on, "left_semi").select("_key").distinct()
    bodies = keep_ids(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), suspects, "_key")
    bodies = bodies.select("_key", ascii_lower(F.col("_text")).alias("_body"))
    bodies = bodies.select("_key", "_body", *ident, F.pmod(F.hash("_key"), F.lit(salts)).alias("_salt"))
    merged = bodies.groupBy(*on, "_salt", "_body").agg(F.max("_key").alias("_best"), F.count(F.lit(1)).alias("_rows"))
    winners = merged.groupBy(*on, "_body").agg(F.max("_best").alias("_best"), F.sum("_rows").alias("_rows"))
    found = winners.select(*on, "_best", "_rows", F.lit(True).alias("_found"))
    keep = F.when(F.col("_found"), F.col("_best")).otherwise(F.col("_key"))
    return census.join(found, on, "left").select(
        F.col("_key").alias(key), keep.alias("keep_id"), F.coalesce("_rows", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_key").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    groups = exact_groups(docs, key, text)
    return keep_ids(docs, groups.where("kept").select(key), key)
