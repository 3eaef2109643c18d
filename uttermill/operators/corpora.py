"""Combining, mixing and replicating corpora."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.functions.hashing import hash_uniform, key_hash
from uttermill.operators.layout import interleave_weighted
from uttermill.operators.ordering import row_index
from uttermill.sources.readers import load_corpus

# How often each builder repeats its training split.
REPLICAS = {"features": 2, "ctc": 3, "adapter": 5, "waveform": 30}


@dataclass(frozen=True)
class CorpusSpec:
    """One entry of a combined corpus."""

    name: str
    config: str
    split: str
    text_col: str
    samples: float | None = None


def parse_specs(
    names: str, configs: str, splits: str | None = None, text_cols: str | None = None,
    samples: str | None = None, default_split: str = "train", default_text: str = "text",
) -> list[CorpusSpec]:
    """``a+b`` lists to one spec per corpus; lists of unequal length are an error."""
    name_list = names.split("+")

    def aligned(label: str, value: str | None, default: str | None) -> list[str | None]:
        if value is None:
            return [default] * len(name_list)
        parts = value.split("+")
        if len(parts) != len(name_list):
            raise ValueError(f"{len(name_list)} corpora but {len(parts)} {label}")
        return parts

    rows = zip(
        name_list,
        aligned("configs", configs, None),
        aligned("splits", splits, default_split),
        aligned("text columns", text_cols, default_text),
        aligned("sample counts", samples, None),
        strict=True,
    )
    return [CorpusSpec(n, c, s, t, float(k) if k else None) for n, c, s, t, k in rows]


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a corpus lacks become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def combine(
    spark: SparkSession, root: str, specs: Sequence[CorpusSpec], text: str = "sentence"
) -> DataFrame:
    """Read every spec, bring its text column to one name and concatenate."""
    return concat(
        [
            load_corpus(spark, root, s.name, s.config, s.split).withColumnRenamed(s.text_col, text)
            for s in specs
        ]
    )


def combine_sampled(
    spark: SparkSession, root: str, specs: Sequence[CorpusSpec], key: str, text: str = "sentence", seed: int = 0, stop: str = "first"
) -> DataFrame:
    """Read every spec and interleave them in proportion to their stated ``samples``.

    A spec without a count weighs 1.  ``source`` is the place of the spec in the list, so a
    corpus may be named twice; inside a spec the rows go in the order of a hash of the
    seed and ``key``, which has to be unique in it.  Only keys are ranked; the rows
    meet their positions in one join.
    """
    parts = [
        load_corpus(spark, root, s.name, s.config, s.split).withColumnRenamed(s.text_col, text).withColumn("source", F.lit(str(i)))
        for i, s in enumerate(specs)
    ]
    rows = concat(parts)
    weights = {str(i): s.samples or 1 for i, s in enumerate(specs)}
    keys = rows.select("source", key, key_hash(seed, F.col("source"), F.col(key)).alias("_h"))
    placed = interleave_weighted(keys, "source", weights, ["_h", key], stop).drop("_h")
    return rows.join(placed, ["source", key]).withColumn("source", F.col("source").cast("int"))


def sampling_fractions(specs: Sequence[CorpusSpec]) -> dict[str, float]:
    """Share of each corpus, from its stated sample count."""
    counts = {s.name: float(s.samples or 1) for s in specs}
    total = sum(counts.values())
    return {name: n / total for name, n in counts.items()}


def mix(
    df: DataFrame, fractions: Mapping[str, float], key: str, corpus: str = "corpus", seed: int = 0
) -> DataFrame:
    """Keep a stated fraction of each corpus; corpora without one are left out.

    The choice is a hash of the key, so it is the same in every run, and a
    larger fraction keeps all rows of a smaller one.
    """
    fraction = F.lit(None).cast("double")
    for name, share in fractions.items():
        fraction = F.when(F.col(corpus) == name, F.lit(float(share))).otherwise(fraction)
    drawn = hash_uniform(seed, F.col(key)) < fraction
    return df.where(F.col(corpus).isin(list(fractions)) & drawn)


def mix_weighted(
    df: DataFrame, weights: Mapping[str, float], key: str, corpus: str = "corpus", seed: int = 0
) -> DataFrame:
    """Rows of the named corpora in the proportions of ``weights``, whatever their sizes.

    The mix is as large as the corpus that runs out first allows: with T that size,
    a corpus gives its first floor(T * share) rows in the order of a hash.  Ranks come
    from :func:`row_index`, so no corpus is ordered in one task.
    """
    total = float(sum(weights.values()))
    share = F.lit(None).cast("double")
    for name, w in weights.items():
        share = F.when(F.col(corpus) == name, F.lit(w / total)).otherwise(share)
    keys = df.where(F.col(corpus).isin(list(weights))).select(corpus, key, key_hash(seed, F.col(key)).alias("_h"))
    ranked = row_index(keys, ["_h", key], [corpus], "_rank")
    # One row per named corpus reaches the driver.
    sizes = {r[0]: r[1] for r in ranked.groupBy(corpus).count().collect()}
    size = min(int(sizes.get(c, 0) / (w / total) + 1e-9) for c, w in weights.items() if w > 0)
    taken = ranked.where(F.col("_rank") < F.floor(F.lit(size) * share + 1e-9))
    taken = taken.select(F.col(corpus).alias("_corpus"), F.col(key).alias("_key"))
    # A key may occur in other corpora too.
    return df.join(taken, (F.col(corpus) == F.col("_corpus")) & F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def replicate(df: DataFrame, k: int, name: str = "replica") -> DataFrame:
    """``k`` copies of every row, numbered from 0; rows do not move."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(name))


def replicate_split(
    df: DataFrame, k: int, split: str = "split", only: Sequence[str] = ("train",), name: str = "replica"
) -> DataFrame:
    """Replicate the named splits; the others keep one copy."""
    copies = F.when(F.col(split).isin(list(only)), F.lit(k - 1)).otherwise(F.lit(0))
    return df.select("*", F.explode(F.sequence(F.lit(0), copies)).alias(name))
