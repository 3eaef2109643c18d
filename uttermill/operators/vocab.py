"""Character vocabulary: counting, pruning, ids, encoding and decoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.functions.text import chars, parse_id_list

# Special entries and the pruning threshold.
UNK, PAD, DELIMITER = "[UNK]", "[PAD]", "|"
MIN_COUNT = 15


def char_frequency(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Occurrences per character.

    The exploded rows never leave the task: partial aggregation shrinks them to
    one row per character before the shuffle.
    """
    exploded = df.select(*by, F.explode(chars(text)).alias("ch"))
    return exploded.groupBy(*by, "ch").agg(F.count(F.lit(1)).alias("n"))


def weighted_frequency(sources: Sequence[tuple[DataFrame, str, int]]) -> DataFrame:
    """Frequencies of several corpora, each ``(frame, text column, weight)``.

    A weight of 2 counts a corpus twice; 1 is the normal case.
    """
    parts = [
        char_frequency(df, text).select("ch", (F.col("n") * weight).alias("n"))
        for df, text, weight in sources
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("ch").agg(F.sum("n").alias("n"))


def char_union(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct characters over several corpora."""
    parts = [df.select(F.explode(chars(text)).alias("ch")) for df, text in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def prune(freq: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Characters seen more than ``min_count`` times."""
    return freq.where(F.col("n") > min_count)


def assign_ids(kept: DataFrame) -> DataFrame:
    """Ids by code point order; the space becomes the delimiter, then UNK and PAD.

    The delimiter always exists, and a literal delimiter among the characters
    is dropped so that it cannot take the space's entry.  There are at most
    1,114,112 code points, so gathering them in one row has a fixed bound, and
    the corpus behind ``kept`` is read once.
    """
    known = F.collect_set(F.when(F.col("ch") != DELIMITER, F.col("ch")))
    ordered = F.array_sort(F.array_union(known, F.array(F.lit(" "))))
    table = kept.agg(F.concat(ordered, F.array(F.lit(UNK), F.lit(PAD))).alias("_all"))
    ids = table.select(F.posexplode("_all").alias("id", "ch"))
    return ids.select(
        F.when(F.col("ch") == " ", DELIMITER).otherwise(F.col("ch")).alias("ch"), "id"
    )


def build_vocab(freq: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return assign_ids(prune(freq, min_count))


def to_mapping(vocab: DataFrame) -> dict[str, int]:
    """The vocabulary on the driver; one entry per code point at most."""
    return {r["ch"]: r["id"] for r in vocab.select("ch", "id").collect()}


def encode(text: Column | str, mapping: Mapping[str, int]) -> Column:
    """Ids of every character, UNK for the unknown, the delimiter for a space.

    The vocabulary travels inside the plan as an array indexed by code point
    (Catalyst folds it once), so encoding is a projection: no join, no shuffle,
    constant work per character.
    """
    unk = mapping[UNK]
    by_point = {ord(c): i for c, i in mapping.items() if len(c) == 1 and c != DELIMITER}
    by_point[ord(" ")] = by_point[ord(DELIMITER)] = mapping[DELIMITER]
    table = ",".join(str(by_point.get(p, unk)) for p in range(max(by_point) + 1))
    ids = F.split(F.lit(table), ",").cast("array<int>")
    return F.transform(chars(text), lambda c: F.coalesce(F.get(ids, F.ascii(c)), F.lit(unk)))


def decode(ids: Column | str, mapping: Mapping[str, int], skip_special: bool = True) -> Column:
    """Text of an id array; UNK and PAD are skipped, the delimiter is a space."""
    col = F.col(ids) if isinstance(ids, str) else ids
    by_id = {i: c for c, i in mapping.items()}
    special = {i: c for i, c in by_id.items() if c in (UNK, PAD)}
    row = "".join(
        " " if by_id.get(i, DELIMITER) in (DELIMITER, UNK, PAD) else by_id[i]
        for i in range(max(by_id) + 1)
    )
    table = F.split(F.lit(row), "")
    if skip_special:
        plain = F.filter(col, lambda i: ~i.isin(list(special)))
        return F.array_join(F.transform(plain, lambda i: F.get(table, i)), "")

    def name(i: Column) -> Column:
        out = F.get(table, i)
        for k, token in special.items():
            out = F.when(i == k, F.lit(token)).otherwise(out)
        return out

    return F.array_join(F.transform(col, name), "")


def prediction_text(pred: Column | str, mapping: Mapping[str, int]) -> Column:
    """Prediction as text, whether stored as text or as a printed id list."""
    col = F.col(pred) if isinstance(pred, str) else pred
    return F.coalesce(decode(parse_id_list(col), mapping), col)
