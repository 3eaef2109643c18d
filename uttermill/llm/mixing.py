"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from uttermill.llm.common import staged, word_count
from uttermill.operators.ordering import row_index

#: Cells of one refinement of the rank scale.
CELLS = 1024


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, source_size, target) per source.

    Sources in code point order, null last, take ``weights`` in turn and share
    the sum of all sizes; a target stops at ``cap`` times its source's size and
    the excess goes to the others by weight.  The level that solves this rises
    with each round, so two sums per round are all the driver sees.
    """
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    ranked = row_index(per, [F.col(source).asc_nulls_last()], name="_rank")
    share = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("_rank", F.lit(len(weights))).cast("int"))
    table = staged(ranked.select(source, "source_size", share.alias("_w"), (F.col("source_size") * float(cap)).alias("_top")), "sources")
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, None
    while level != before:
        full = F.col("_w") * F.lit(level) > F.col("_top")
        used, left = table.agg(F.sum(F.when(full, F.col("_top"))), F.sum(F.when(~full, F.col("_w")))).first()
        if not left:
            level = float("inf")
            break
        before, level = level, (whole - (used or 0.0)) / left
    return table.select(source, "source_size", F.least("_top", F.col("_w") * F.lit(level)).alias("target"))


def _boundary(cells: DataFrame, source: str, cell: str) -> DataFrame:
    """Per source the cell in which the running sum passes what is left to take."""
    order = W.partitionBy(source).orderBy(cell)
    before = F.sum("_sum").over(order) - F.col("_sum")
    marked = cells.withColumn("_before", before).where("_before + _sum > _left")
    least = F.min(F.struct(cell, "_before")).alias("_m")
    return marked.groupBy(source).agg(least).select(source, F.col(f"_m.{cell}").alias(cell), F.col("_m._before").alias("_before"))


def _last_rows(last: DataFrame, ends: DataFrame) -> DataFrame:
    """(_source, _end_row): the last row taken of a group of equal rows that is taken in part.

    Row numbers ascend by part of the staged table, so counts by part tell in which
    one the row lies, and only that part's rows are numbered.
    """
    partly = ends.where("_take < _n").select(F.col("_source").alias("_s"), F.col("_hash").alias("_h"), "_take")
    same = last.join(partly, last["_source"].eqNullSafe(partly["_s"]) & (last["_hash"] == partly["_h"]))
    same = same.select("_source", "_take", "_row", F.shiftright("_row", 33).alias("_part"))
    parts = same.groupBy("_source", "_part").agg(F.count(F.lit(1)).alias("_c"), F.first("_take").alias("_take"))
    upto = F.sum("_c").over(W.partitionBy("_source").orderBy("_part"))
    parts = parts.withColumn("_upto", upto).where("_upto >= _take and _upto - _c < _take")
    parts = parts.select(F.col("_source").alias("_s"), F.col("_part").alias("_p"), (F.col("_take") - F.col("_upto") + F.col("_c")).alias("_nth"))
    inside = same.join(parts, same["_source"].eqNullSafe(parts["_s"]) & (same["_part"] == parts["_p"]))
    inside = inside.withColumn("_i", F.row_number().over(W.partitionBy("_source", "_part").orderBy("_row")))
    return inside.where("_i = _nth").select("_source", F.col("_row").alias("_end_row"))


def mix_sources(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (1, 2, 3), cap: int = 3, importance: Column | None = None, seed: int = 20,
) -> DataFrame:
    """(key, size, source_size, target, taken, copies) for every row of ``docs``.

    A source whose target is r times its size gives every document floor(r)
    whole copies for certain.  The rest of the target goes to a Pareto sample: a
    document is included with a probability p that grows with ``importance``
    (default 1 + log2(1 + words)) and has the mean r - floor(r) over the source's
    words; documents are ranked by (u / (1 - u)) / (p / (1 - p)), u a hash of the
    key and text, and taken in this order until the words left are used up.  The last one
    is taken if at least half of it fits, so a source misses its target by half a
    document at most.

    The cut on the rank scale is found by sums over 1024 cells, then over 1024
    cells of the one cell it falls into; only that last cell's rows, a millionth
    of a source, are sorted, equal ones as one row.  No source is ordered in one task.

    A null text has size 0; null is a source of its own; rows with one key
    and text get one rank, and are taken one by one; an empty table gives an empty result.  Other columns are not read.
    """
    size = word_count(F.col("_text"))
    rows = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.col(text).alias("_text"))
    rows = rows.select("_key", "_source", size.alias("size"), F.xxhash64(F.lit(seed), "_key", "_text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    gain = F.lit(1.0) + F.log2(F.col("size") + 1.0) if importance is None else importance
    bits = F.shiftrightunsigned("_hash", 11)
    rows = staged(rows.select("*", gain.alias("_gain"), ((bits + 0.5) / F.lit(float(1 << 53))).alias("_u")), "sizes")
    targets = source_targets(rows, "_source", "size", weights, cap)
    gains = rows.groupBy("_source").agg(F.try_divide(F.sum(F.col("_gain") * F.col("size")), F.sum("size")).alias("_mean"))
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    per = targets.alias("t").join(gains.alias("g"), F.col("t._source").eqNullSafe(F.col("g._source")))
    per = per.select("t._source", "source_size", "target", "_mean", F.floor(ratio).alias("_whole"), (ratio - F.floor(ratio)).alias("_part"))
    per = staged(per.withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size")), "targets")

    def with_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        right = right.withColumnRenamed("_source", "_s")
        return left.join(right, left["_source"].eqNullSafe(right["_s"]), how).drop("_s")

    chance = F.greatest(F.lit(1e-9), F.least(F.lit(0.999), F.col("_part") * F.coalesce(F.try_divide("_gain", "_mean"), F.lit(1.0))))
    odds = (F.col("_u") / (1 - F.col("_u"))) * ((1 - chance) / chance)
    ranked = with_source(rows, per).withColumn("_z", odds / (1 + odds))
    ranked = ranked.withColumn("_coarse", F.floor(F.col("_z") * CELLS)).withColumn("_fine", F.floor(F.col("_z") * CELLS * CELLS))
    sums = [F.sum("size").alias("_sum"), F.first("_left").alias("_left")]
    coarse = staged(_boundary(ranked.groupBy("_source", "_coarse").agg(*sums), "_source", "_coarse"), "coarse")

    def within(cut: DataFrame, cell: str) -> DataFrame:
        cut = cut.withColumnsRenamed({"_source": "_s", cell: "_cell", "_before": "_done"})
        inside = ranked.join(cut, ranked["_source"].eqNullSafe(cut["_s"]) & (ranked[cell] == cut["_cell"]))
        return inside.withColumn("_left", F.col("_left") - F.col("_done")).drop("_s", "_cell")

    inside = within(coarse, "_coarse")
    fine = _boundary(inside.groupBy("_source", "_fine").agg(*sums), "_source", "_fine")
    done = coarse.select(F.col("_source").alias("_c"), F.col("_before").alias("_outer"))
    fine = fine.join(done, fine["_source"].eqNullSafe(done["_c"])).select("_source", "_fine", (F.col("_before") + F.col("_outer")).alias("_before"))
    fine = staged(fine, "fine")
    last = within(fine, "_fine")
    # Equal rows are one group here, so a cell that is full of them stays small.
    groups = last.groupBy("_source", "_z", "_hash", "size").agg(F.count(F.lit(1)).alias("_n"), F.first("_left").alias("_left"))
    so_far = F.sum(F.col("size") * F.col("_n")).over(W.partitionBy("_source").orderBy("_z", "_hash", "size").rowsBetween(W.unboundedPreceding, -1))
    room = F.col("_left") - F.coalesce(so_far, F.lit(0))
    fits = F.when(room < 0, 0).otherwise(F.least("_n", F.floor(F.coalesce(F.try_divide(room, "size"), F.lit(float(1 << 53))) + 0.5)))
    taken = groups.withColumn("_take", fits.cast("bigint")).where("_take > 0")
    end = F.max(F.struct("_z", "_hash", "_take", "_n")).alias("_e")
    ends = staged(taken.groupBy("_source").agg(end).select("_source", "_e._z", "_e._hash", "_e._take", "_e._n"), "ends")
    ends = with_source(ends, _last_rows(last, ends), "left").withColumnsRenamed({"_z": "_end", "_hash": "_end_hash"})
    ends = ends.select("_source", "_end", "_end_hash", F.coalesce("_end_row", F.lit(2**63 - 1)).alias("_end_row"))
    cut = fine.select("_source", F.col("_fine").alias("_cut"))
    final = with_source(with_source(ranked, cut, "left"), ends, "left")
    before_end = F.struct("_z", "_hash", "_row") <= F.struct("_end", "_end_hash", "_end_row")
    chosen = (F.col("_fine") < F.col("_cut")) | (F.col("_end").isNotNull() & before_end)
    # A source whose sample takes everything has no cut.
    extra = F.when(F.col("_left") <= 0, 0).when(F.col("_cut").isNull(), 1).otherwise(F.coalesce(chosen.cast("int"), F.lit(0)))
    copies = F.col("_whole") + extra
    return final.select(
        F.col("_key").alias(key), "size", "source_size", "target",
        (F.col("size") * copies).cast("bigint").alias("taken"), copies.cast("bigint").alias("copies"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as :func:`mix_sources` takes it, columns unchanged.

    Rows with one key are repeated as often as the one of them that is taken most.
    """
    plan = mix_sources(docs, key, text, source, **options).groupBy(key).agg(F.max("copies").alias("_copies"))
    plan = plan.select(F.col(key).alias("_mix_key"), "_copies").where("_copies > 0")
    joined = docs.join(plan, docs[key].eqNullSafe(plan["_mix_key"]))
    repeated = joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy"))
    return repeated.drop("_copy")
