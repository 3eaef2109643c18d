"""Global and per-group positions without a one-task window.

A bare ``row_number() over (order by ...)`` moves a whole table, or a whole hot
group, into one task.  Here the rows are cut into ordered buckets first; only
per-bucket counts are summed up in order, and rows are numbered inside their
bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from uttermill.functions.hashing import key_hash
from uttermill.session import pin, small_side

#: Width of one block in :func:`running_total`; bounds every window to this many rows.
BLOCK = 4096


def _before(by: Sequence[str], order: str) -> W:
    return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "row_idx",
) -> DataFrame:
    """Dense 0-based position in a total order, per group when ``by`` is given.

    Range-sort, number the rows of each sorted partition, add what lies in the
    partitions before.  The sorted rows are pinned, because a second range sort
    may draw other boundaries.  Pass keys, not wide rows, and join back.  A group
    of any size is fine: it spreads over as many partitions as it needs, given
    that ``by`` and ``order_by`` together are unique.
    """
    by = list(by)
    local = pin(df.orderBy(*by, *order_by).withColumn("_mid", F.monotonically_increasing_id()))
    local = local.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per (group, partition it touches).
    spans = local.groupBy(*by, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    starts = spans.select(
        *by,
        "_part",
        (F.coalesce(F.sum("_n").over(_before(by, "_part")), F.lit(0)) - F.col("_first")).alias(
            "_shift"
        ),
    )
    on = [F.col("l._part") == F.col("s._part")]
    on += [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
    joined = local.alias("l").join(small_side(starts).alias("s"), on)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._pos") + F.col("s._shift")).alias(name),
    )


def bucket_index(
    df: DataFrame,
    bucket: Column,
    order_by: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "row_idx",
) -> DataFrame:
    """As :func:`row_index`, for an order that has a monotone bucket expression.

    ``bucket`` must not be NULL and must not decrease along ``order_by`` (an integer key divided by a
    constant, a prefix of a hash).  No sample and no pinning are needed: the
    buckets are a function of the row.  ``df`` is read twice, the first time for
    its key columns only.
    """
    by = list(by)
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(_before(by, "_bucket")), F.lit(0)).alias("_shift"),
    )
    within = F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order_by))
    numbered = tagged.withColumn("_rn", within)
    # Plain equality on the bucket lets the join use the window's partitioning.
    on = [F.col("_bucket") == F.col("_b")]
    on += [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return numbered.join(starts, on).select(
        *df.columns, (F.col("_rn") - 1 + F.col("_shift")).alias(name)
    )


def running_total(
    df: DataFrame, pos: str, value: str, by: Sequence[str] = (), name: str = "total_before"
) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``pos`` (dense integers).

    Two levels: totals of whole blocks are summed in order, then rows inside
    their block, so that no window sees more than :data:`BLOCK` rows of a group
    plus one row per block.
    """
    by = list(by)
    tagged = df.withColumn("_block", F.floor(F.col(pos) / BLOCK))
    blocks = tagged.groupBy(*by, "_block").agg(F.sum(value).alias("_v"))
    starts = blocks.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_v").over(_before(by, "_block")), F.lit(0)).alias("_shift"),
    )
    inside = F.coalesce(F.sum(value).over(_before([*by, "_block"], pos)), F.lit(0))
    on = [F.col("_block") == F.col("_b")]
    on += [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return (
        tagged.withColumn("_in", inside)
        .join(starts, on)
        .select(*df.columns, (F.col("_in") + F.col("_shift")).alias(name))
    )


def seeded_shuffle(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = 0,
    epoch: int | None = None,
    name: str = "shuffle_pos",
    prefix: int = 4,
) -> DataFrame:
    """A permutation that depends on seed, epoch and key alone.

    The position is the rank of a hash.  Rows sharing the first ``prefix`` hex
    digits form a bucket; hashing fills all 16**prefix buckets evenly.  ``key``
    must be unique; replicated rows take the replica number into it.
    """
    parts = [seed] if epoch is None else [seed, epoch]
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_h", key_hash(*parts, *[F.col(k) for k in keys]))
    out = bucket_index(hashed, F.substring("_h", 1, prefix), ["_h", *keys], name=name)
    return out.drop("_h")


def skip_batches(df: DataFrame, pos: str, batch_size: int, n: int) -> DataFrame:
    """Leave out the first ``n`` batches, as a resumed run does."""
    return df.where(F.col(pos) >= n * batch_size)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a report in ascending order of the named columns, null first.

    Only the sort columns are ordered and pinned, spread over many tasks whatever ``n`` is.  The
    key at the last place then cuts the rows in a filter.  Where rows with one
    key reach over the cut, as many of them as fit are taken.
    """
    keys = list(order_by)
    placed = row_index(df.select(*keys), keys, name="_place")
    # One row reaches the driver.
    last = placed.where(F.col("_place") == n - 1).select(*keys).first()
    if last is None:
        return df if n > 0 else df.limit(0)
    cut = F.struct(*[F.lit(last[k]).cast(df.schema[k].dataType) for k in keys])
    place = F.struct(*keys)
    at = placed.where(place == cut).agg(F.count(F.lit(1)), F.min("_place")).first()
    if at[1] + at[0] == n:
        return df.where(place <= cut)
    return df.where(place < cut).unionByName(df.where(place == cut).limit(n - at[1]))
