"""Augmentation as hashed plan columns and array transforms, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.functions import arrays as A
from uttermill.functions.hashing import hash_normals, hash_uniform

# Widths, amplitudes and probabilities of the augmentation recipe.
MAX_BAND = 25
NOISE_RANGE = (0.001, 0.015)
NOISE_SHARE = 0.3
AUGMENT_SHARE = 0.5
TIME_MASK_BELOW = 0.3
STRETCH_ABOVE = 0.2
FREQ_MASK_BETWEEN = (0.3, 0.7)


def augmentation_plan(
    df: DataFrame, key: str = "utt_id", replica: str = "replica", seed: int = 0, stretch: bool = True
) -> DataFrame:
    """Which steps hit this copy: ``time_mask``, ``stretch``, ``freq_mask``.

    Half of the copies stay untouched; for the others one draw decides, and its
    overlapping ranges give some copies two steps.
    """
    gate = hash_uniform(seed, F.col(key), F.col(replica), "gate")
    draw = hash_uniform(seed, F.col(key), F.col(replica), "draw")
    on = F.col("_gate") < AUGMENT_SHARE
    low, high = FREQ_MASK_BETWEEN
    return (
        df.withColumn("_gate", gate)
        .withColumn("_draw", draw)
        .withColumn("time_mask", on & (F.col("_draw") < TIME_MASK_BELOW))
        .withColumn("stretch", on & (F.col("_draw") > STRETCH_ABOVE) & F.lit(stretch))
        .withColumn("freq_mask", on & (F.col("_draw") > low) & (F.col("_draw") < high))
        .drop("_gate", "_draw")
    )


def band(
    size: Column, key: str, replica: str, purpose: str, seed: int = 0, max_width: int = MAX_BAND
) -> tuple[Column, Column]:
    """Start and stop of a contiguous band narrower than ``max_width``."""
    width = hash_uniform(seed, F.col(key), F.col(replica), purpose, "width") * max_width
    start = hash_uniform(seed, F.col(key), F.col(replica), purpose, "start") * (size - width)
    first = F.floor(F.greatest(start, F.lit(0.0)))
    return first, first + F.floor(width)


def mask_vector(
    df: DataFrame, features: str, when: str, purpose: str, key: str = "utt_id",
    replica: str = "replica", seed: int = 0, max_width: int = MAX_BAND,
) -> DataFrame:
    """Zero a band of a flat feature array in the copies flagged by ``when``.

    The band lands in ``<purpose>_start`` and ``<purpose>_stop``.
    """
    start, stop = band(F.size(features), key, replica, purpose, seed, max_width)
    out = df.withColumn(f"{purpose}_start", F.when(F.col(when), start)).withColumn(
        f"{purpose}_stop", F.when(F.col(when), stop)
    )
    zeroed = A.zero_band(features, F.col(f"{purpose}_start"), F.col(f"{purpose}_stop"))
    return out.withColumn(features, F.when(F.col(when), zeroed).otherwise(F.col(features)))


def mask_matrix(
    df: DataFrame, features: str, axis: int, when: str, purpose: str, key: str = "utt_id",
    replica: str = "replica", seed: int = 0, max_width: int = MAX_BAND,
) -> DataFrame:
    """As :func:`mask_vector` for a matrix; ``axis`` 0 masks rows, 1 columns."""
    size = F.size(features) if axis == 0 else F.size(F.get(features, F.lit(0)))
    start, stop = band(size, key, replica, purpose, seed, max_width)
    out = df.withColumn("_start", start).withColumn("_stop", stop)
    zeroed = A.zero_band_matrix(features, axis, F.col("_start"), F.col("_stop"))
    return out.withColumn(
        features, F.when(F.col(when), zeroed).otherwise(F.col(features))
    ).drop("_start", "_stop")


def add_noise(
    df: DataFrame, samples: str, key: str = "utt_id", replica: str = "replica", seed: int = 0
) -> DataFrame:
    """Gaussian noise of a hashed amplitude on a hashed share of the copies."""
    hit = hash_uniform(seed, F.col(key), F.col(replica), "noise") < NOISE_SHARE
    low, high = NOISE_RANGE
    amp = low + hash_uniform(seed, F.col(key), F.col(replica), "amp") * (high - low)
    out = df.withColumn("noise_amp", F.when(hit, amp))
    normals = hash_normals(F.size(samples), seed, F.col(key), F.col(replica))
    amplitudes = F.array_repeat("noise_amp", F.size(samples))
    steps = F.zip_with(normals, amplitudes, lambda z, a: z * a)
    noisy = F.zip_with(samples, steps, lambda v, e: (v + e).cast("float"))
    return out.withColumn(
        samples, F.when(F.col("noise_amp").isNotNull(), noisy).otherwise(F.col(samples))
    )


def frames(df: DataFrame, samples: str, key: str, win: int, hop: int, *keep: str) -> DataFrame:
    """One row per full frame: its number and mean energy."""
    count = F.floor((F.size(samples) - win) / hop)
    numbers = F.when(F.size(samples) >= win, F.sequence(F.lit(0).cast("bigint"), count))
    energies = F.transform(
        numbers,
        lambda k: F.aggregate(
            F.slice(samples, (k * hop + 1).cast("int"), F.lit(win)),
            F.lit(0.0),
            lambda a, x: a + x.cast("double") * x.cast("double"),
        )
        / win,
    )
    return df.select(key, *keep, F.posexplode(energies).alias("frame", "energy"))


def frame_stats(framed: DataFrame, by: str) -> DataFrame:
    """Frame count, mean and spread of the energy per group."""
    return framed.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_frames"),
        F.avg("energy").alias("mean_energy"),
        F.stddev_samp("energy").alias("std_energy"),
    )
