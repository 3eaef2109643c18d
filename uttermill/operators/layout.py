"""How rows are laid out: shards, batches, interleaving, retention."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from uttermill.functions import arrays as A
from uttermill.operators.ordering import row_index, running_total

#: Parts a group is ranked in before its winners meet.
SALTS = 64
# Rows per shard of the three builders.
SHARD_ROWS = {"small": 2000, "ctc": 1000, "adapter": 500}


def shard_table(
    df: DataFrame, n: int, pos: str = "row_idx", by: Sequence[str] = (), matched: Column | None = None
) -> DataFrame:
    """Shard number of every block of ``n`` input positions.

    A shard is flushed after the input row at a multiple of ``n`` (not at 0),
    so block ``k`` holds the positions ``(k-1)*n+1 .. k*n`` and block 0 the first
    row alone.  Where that row has no transcript the flush is skipped and two
    shards merge.  The result has one row per block: ``by``, ``block``, ``shard``.
    """
    matched = F.lit(True) if matched is None else matched
    block = F.ceil(F.col(pos) / n).alias("block")
    flushed = (F.col(pos) == F.col("block") * n) & (F.col("block") > 0) & F.col("_ok")
    blocks = (
        df.select(*by, pos, block, F.coalesce(matched, F.lit(False)).alias("_ok"))
        .groupBy(*by, "block")
        .agg(F.max(flushed.cast("int")).alias("_flush"))
    )
    counted = running_total(blocks, "block", "_flush", by, name="_before")
    return counted.select(*by, "block", (F.col("_before") + 1).cast("bigint").alias("shard"))


def assign_shards(
    df: DataFrame, n: int, pos: str = "row_idx", by: Sequence[str] = (), matched: Column | None = None
) -> DataFrame:
    """Add the ``shard`` each matched input row is written to.

    Only positions and the match flag take part in the aggregation; the rows
    themselves meet the small block table in an equi-join.
    """
    matched = F.lit(True) if matched is None else matched
    shards = shard_table(df, n, pos, by, matched)
    keyed = df.where(matched).withColumn("block", F.ceil(F.col(pos) / n))
    # A null group is a group.
    other = shards.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("block").alias("_block"), "shard")
    on = [F.col("block") == F.col("_block")] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return keyed.join(other, on).select(*df.columns, "shard")


def interleave(
    df: DataFrame, source: str, sources: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Round-robin over ``sources`` until the shortest one ends.

    ``position`` is the place in the interleaved order.
    """
    chosen = df.where(F.col(source).isin(list(sources)))
    ranked = row_index(chosen, order_by, [source], "_turn")
    counts = ranked.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    # One row per named source reaches the driver.
    found = [r["n"] for r in counts.collect()]
    limit = min(found) if len(found) == len(sources) else 0
    place = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col(source)) - 1
    return ranked.where(F.col("_turn") < limit).select(
        *df.columns, (F.col("_turn") * len(sources) + place).cast("bigint").alias("position")
    )


#: Repeats of a row that one task writes when a short source is cycled.
CYCLES = 4096


def _units(weights: Mapping[str, float | str]) -> dict[str, int]:
    """Virtual time between two picks of each source, as exact whole numbers."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if not exact or min(exact.values()) <= 0:
        raise ValueError("every source needs a weight above 0")
    scale = math.lcm(*[w.denominator for w in exact.values()])
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.lcm(*whole.values())
    return {s: common // w for s, w in whole.items()}


def interleave_weighted(
    df: DataFrame, source: str, weights: Mapping[str, float | str], order_by: Sequence[str | Column], stop: str = "first"
) -> DataFrame:
    """Interleave the named sources so that at any place each has given its share.

    The pick number ``k`` (from 0) of a source is due at the virtual time
    (k + 1) / weight; picks go by that time, then in the order of ``weights``.  With
    ``stop="first"`` the result ends with the last row of the source that runs out
    first, with ``stop="all"`` it ends when every source has run out once, shorter
    ones starting again.  ``position`` is the place, ``cycle`` the repeat of the row.

    Weights are read as decimal fractions and times are whole numbers, so there is no
    rounding.  How many picks of each source come before a given time follows from
    the time alone: the position needs the rank of a row in its own source and no
    common sort.  A source without rows ends the result at once (``first``) or is
    left out (``all``).  Pass keys, not wide rows.
    """
    if stop not in ("first", "all"):
        raise ValueError(f"stop is first or all, not {stop}")
    names, units = list(weights), _units(weights)
    ranked = row_index(df.where(F.col(source).isin(names)), order_by, [source], "_turn")
    # One row per named source reaches the driver.
    sizes = {r[0]: r[1] for r in ranked.groupBy(source).count().collect()}
    ends = [(sizes.get(s, 0) * units[s], i) for i, s in enumerate(names) if stop == "first" or sizes.get(s, 0)]
    last, at = (min if stop == "first" else max)(ends, default=(0, 0))
    if last >= 1 << 62:
        raise ValueError("weights too fine for sources of this size")
    # Picks of a source up to the end: those of a later source at the very end do not come any more.
    picks = {s: (last - (i > at)) // units[s] for i, s in enumerate(names)}

    def of_source(value: Mapping[str, int]) -> Column:
        out = F.lit(None).cast("bigint")
        for s in names:
            out = F.when(F.col(source) == s, F.lit(value[s]).cast("bigint")).otherwise(out)
        return out

    rows = ranked.withColumn("_size", of_source({s: sizes.get(s, 0) for s in names})).withColumn("_picks", of_source(picks))
    rows = rows.withColumn("_left", F.col("_picks") - F.col("_turn")).where("_left > 0")
    cycles = F.floor((F.col("_left") - 1) / F.col("_size"))
    most = max(((picks[s] - 1) // n for s, n in sizes.items()), default=0)
    if most > CYCLES:
        # A few rows make very many: deal runs of repeats out to all tasks.
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.floor(cycles / CYCLES))).alias("_run")).repartition(source, "_turn", "_run")
        first = F.col("_run") * CYCLES
        rows = rows.withColumn("cycle", F.explode(F.sequence(first, F.least(cycles, first + CYCLES - 1)))).drop("_run")
    elif most > 0:
        rows = rows.withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("bigint"), cycles)))
    else:
        rows = rows.withColumn("cycle", F.lit(0).cast("bigint"))
    rows = rows.withColumn("_due", (F.col("cycle") * F.col("_size") + F.col("_turn") + 1) * of_source(units))
    order = of_source({s: i for i, s in enumerate(names)})
    # For each source: its picks due before this one.  Equal times go in source order.
    before = F.lit(0).cast("bigint")
    for i, s in enumerate(names):
        if sizes.get(s, 0):
            early = F.col("_due") - F.when(order > i, F.lit(0)).otherwise(F.lit(1))
            before = before + F.call_function("div", early, F.lit(units[s]).cast("bigint"))
    return rows.select(*df.columns, "cycle", before.alias("position"))


def assemble_batches(
    df: DataFrame, pos: str, labels: str, batch_size: int, pad_id: int = A.IGNORED,
    max_length: int | None = None, bos_id: int | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Fixed-size batches padded to their longest row, or to ``max_length``.

    With ``bos_id`` a leading start token is cut, provided every row of the
    batch starts with it.  ``pos`` is a dense position, so a batch, and with it
    every window here, holds ``batch_size`` rows.
    """
    batched = df.withColumn("batch", F.floor(F.col(pos) / batch_size))
    same = W.partitionBy(*by, "batch")
    longest = F.lit(max_length) if max_length else F.max(F.size(labels)).over(same)
    out = batched.withColumn("_width", longest)
    if bos_id is not None:
        starts = F.coalesce(F.get(labels, F.lit(0)) == bos_id, F.lit(False))
        out = out.withColumn("_cut", F.bool_and(starts).over(same))
    out = out.withColumn(labels, A.pad(labels, F.col("_width"), pad_id))
    if bos_id is not None:
        out = out.withColumn(
            labels,
            F.when(F.col("_cut"), A.decoder_target(labels)).otherwise(F.col(labels)),
        )
    return out.select(*df.columns, "batch")


def checkpoint_step(name: Column | str, prefix: str = "checkpoint") -> Column:
    """Numeric step in a ``prefix-<step>`` name; NULL for other names."""
    col = F.col(name) if isinstance(name, str) else name
    # Fixed value: the run-name format on disk.
    found = F.regexp_extract(col, rf"^.*{prefix}-([0-9]+)", 1)
    return F.when(found != "", found.cast("bigint"))


def retain_newest(
    df: DataFrame, by: str, step: str, keep: int, tiebreak: str, ties: str = "fail"
) -> DataFrame:
    """Mark the ``keep`` newest rows per group; the others are to be deleted.

    The ranking alone would sort a hot group in one task.  Rows are ranked inside
    salted parts of their group first, the best of each part are ranked
    again, and the oldest kept row then decides about all others.  A null group is
    a group.

    Rows with one step and tiebreak are told apart by nothing.  Where such a tie lies
    across the cut, ``ties="fail"`` fails the job and ``ties="rank"`` keeps as many of them as
    fit, chosen by a hash of the whole row (which then needs columns that can be grouped).
    """
    if ties not in ("fail", "rank"):
        raise ValueError(f"ties is fail or rank, not {ties}")
    order = [F.desc(step), F.desc(tiebreak)]
    salt = F.pmod(F.xxhash64(step, tiebreak), F.lit(SALTS)).alias("_salt")

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        ranked = rows.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col("_rn") <= keep + 1)

    top = best(best(df.select(by, step, tiebreak, salt), by, "_salt").drop("_rn"), by)
    place = F.struct(step, tiebreak)
    cuts = top.groupBy(F.col(by).alias("_by")).agg(
        F.min(F.when(F.col("_rn") <= keep, place)).alias("_cut"), F.max(F.when(F.col("_rn") == keep + 1, place)).alias("_next"),
    )
    cuts = cuts.select("_by", "_cut", F.coalesce(F.col("_next") == F.col("_cut"), F.lit(False)).alias("_tied"))
    told = df.join(cuts, F.col(by).eqNullSafe(F.col("_by")))
    across = F.col("_tied") & (place == F.col("_cut"))
    kept = (place >= F.col("_cut")).cast("int")
    if ties == "fail":
        failed = F.raise_error(F.concat(F.lit("rows tie at the cut of group "), F.coalesce(F.col(by).cast("string"), F.lit("null"))))
        return told.select(*df.columns, F.when(across, failed.cast("int")).otherwise(kept).alias("kept"))
    # How many of the tied rows are among the best of their group.
    fit = top.where(F.col("_rn") <= keep).join(cuts.where("_tied"), F.col(by).eqNullSafe(F.col("_by")))
    fit = fit.where(place == F.col("_cut")).groupBy(F.col("_by").alias("_group")).agg(F.count(F.lit(1)).alias("_fit"))
    tied = told.where(across).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    tied = tied.withColumn("_id", F.struct(F.xxhash64(*df.columns), F.xxhash64(F.lit(1), *df.columns)))
    copies = tied.select(F.col(by).alias("_by"), "_id", F.explode(F.sequence(F.lit(1), F.least("_copies", F.lit(keep)).cast("int"))).alias("_copy"))
    drawn = copies.withColumn("_rn", F.row_number().over(W.partitionBy("_by").orderBy("_id", "_copy"))).where(F.col("_rn") <= keep)
    drawn = drawn.join(fit, F.col("_by").eqNullSafe(F.col("_group"))).where(F.col("_rn") <= F.col("_fit"))
    drawn = drawn.groupBy("_by", F.col("_id").alias("_same")).agg(F.count(F.lit(1)).alias("_kept"))
    back = tied.join(drawn, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_id") == F.col("_same")), "left")
    back = back.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    chosen = (F.col("_copy") <= F.coalesce("_kept", F.lit(0))).cast("int").alias("kept")
    return told.where(~across).select(*df.columns, kept.alias("kept")).unionByName(back.select(*df.columns, chosen))


def latest_per_group(df: DataFrame, by: Sequence[str], path: str, step: str) -> DataFrame:
    """Path with the highest numeric step per group."""
    return df.groupBy(*by).agg(
        F.max_by(path, step).alias(path), F.max(step).alias(step)
    )


def last_checkpoint(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Newest ``checkpoint-<step>-epoch-<epoch>`` per group; other names are ignored."""
    # Fixed value: the run-name format on disk.
    pattern = r"^checkpoint-(\d+)-epoch-(\d+)$"
    runs = df.where(F.regexp_like(F.col(name), F.lit(pattern))).withColumn(
        "step", F.regexp_extract(name, pattern, 1).cast("bigint")
    )
    return latest_per_group(runs, by, name, "step")
