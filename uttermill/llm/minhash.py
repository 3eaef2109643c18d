"""MinHash near-dedup with bottom-k sketches from one hash function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from uttermill.llm import words as X
from uttermill.llm.common import keep_ids, staged
from uttermill.llm.components import connected
from uttermill.operators import resume
from uttermill.operators.ordering import row_index

#: Words of a shingle and retained values of a sketch.
WIDTH, K = 5, 64
#: Similar sets agree in at least 75 of 100; their union sketch of 64 values then
#: has 48 in common on average and fewer than 20 with a chance below 1e-13, about that of
#: two word hashes meeting by chance.
NEAR, LEAST = 75, 20
#: A set up to this size has similar sets only up to K: sketches hold both whole.
WHOLE = K * NEAR // 100
#: Rounds in which a list meets one member of its own before all pairs that are left.
ROUNDS = 2
#: What tells classes of equal sets apart.
NAME = ["n", "one", "two"]


def _sets(body: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    low = X.lowered(body)
    first, end, begin = X.spans(low, offsets)
    unit = X.hashes(low, first, end)
    every = X.runs(unit, WIDTH)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        if b - a >= WIDTH:
            yield X.distinct(every[a : b - WIDTH + 1])
        else:
            yield X.runs(unit[a:b], int(b - a), 7 + int(b - a)) if b > a else np.empty(0, np.uint64)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _identity(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size of each set and two hashes of it as a whole: what names a class of equal sets."""
    one = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
    two = [int(X.mix64(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, body, offsets in X.slices(batch, "_text"):
            sets = list(_sets(body, offsets))
            arrays = [part.column("_key"), *_identity(sets), _lists([s[:K] for s in sets])]
            yield pa.RecordBatch.from_arrays(arrays, ["_key", *NAME, "sketch"])


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, body, offsets in X.slices(batch, "_text"):
            sets = list(_sets(body, offsets))
            yield pa.RecordBatch.from_arrays([part.column("_key"), *_identity(sets), _lists(sets)], ["_key", *NAME, "members"])


def _entries(reps: DataFrame) -> DataFrame:
    """(value, rep, n, core): inverted lists over the rarest retained values of each sketch.

    Two similar sets share at least c of their s retained values, so they share one of
    the s - c + 1 that come first in any common order.  In the order of document
    frequency these are the rare ones: what a third of all documents hold makes a
    list only for documents that hold little else.  ``core`` is high for what is most
    like its group.
    """
    values = reps.select("rep", "n", F.explode("sketch").alias("value"))
    shared = staged(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared")
    held = values.join(shared, "value")
    own = W.partitionBy("rep")
    held = held.withColumn("_at", F.row_number().over(own.orderBy("df", "value"))).withColumn("_of", F.count(F.lit(1)).over(own)).withColumn("core", F.sum("df").over(own))
    needed = F.when(F.col("n") <= WHOLE, F.ceil(F.col("n") * NEAR / 100.0)).otherwise(LEAST)
    return held.where(F.col("_at") <= F.col("_of") - needed + 1).select("value", "rep", "n", "core")


def _sized(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * NEAR


def _stars(lists: DataFrame, turn: int) -> DataFrame:
    """Each list's members paired with one of them: first the most central, later one drawn by a hash."""
    first = F.col("core") if turn == 0 else F.lit(0)
    centre = lists.groupBy("value").agg(F.max(F.struct(first.alias("_f"), F.xxhash64(F.lit(turn), "rep").alias("_h"), "rep", "n", "component")).alias("_c"))
    centre = staged(centre.select("value", F.col("_c.rep").alias("a"), F.col("_c.n").alias("m"), F.col("_c.component").alias("_ac")), "centres")
    met = lists.join(centre, "value").where((F.col("component") != F.col("_ac")) & _sized("n", "m"))
    return met.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct()


def _mixed(lists: DataFrame) -> DataFrame:
    """Lists with members of several components; ``_main`` is the largest of them."""
    sizes = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("_n"))
    main = sizes.groupBy("value").agg(F.max(F.struct("_n", "component")).alias("_m"), F.count(F.lit(1)).alias("_k"))
    main = staged(main.where("_k > 1").select("value", F.col("_m.component").alias("_main")), "mixed-lists")
    return staged(lists.join(main, "value"), "mixed-members")


def _rest(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs between different components that share a list and can still be similar.

    Members of lists that are not one component are indexed by their full sets,
    rarest shingle first.  Sets of sizes m and n are similar only if they share
    75 / 175 of m + n; so their first common shingle is among the first quarter of
    both, and what follows it must be enough.  A copy with many changes of its own
    has these first and meets no one, however large its group is.  Members outside
    a list's largest component meet the whole list.
    """
    open_ends = staged(_mixed(lists).select("rep", "component").distinct(), "open")
    members = sets.join(open_ends, "rep").select("rep", "n", "component", F.explode("members").alias("value"))
    shared = staged(members.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-members")
    own = W.partitionBy("rep")
    held = members.join(shared, "value").withColumn("_at", F.row_number().over(own.orderBy("df", "value"))).withColumn("_of", F.count(F.lit(1)).over(own))
    held = held.withColumn("left", F.col("_of") - F.col("_at") + 1).where(F.col("left") * 100 >= F.col("n") * NEAR)
    tagged = _mixed(staged(held.select("value", "rep", "n", "component", "left"), "member-lists"))
    minor = tagged.where("component <> _main").select(
        F.col("value").alias("_v"), F.col("rep").alias("a"), F.col("n").alias("m"), F.col("component").alias("_ac"), F.col("left").alias("_al")
    )
    right = tagged.select("value", F.col("rep").alias("b"), "n", "component", "left", (F.col("component") == F.col("_main")).alias("_is_main"))
    enough = F.least("_al", "left") * (100 + NEAR) >= (F.col("m") + F.col("n")) * NEAR
    on = (F.col("_ac") != F.col("component")) & (F.col("_is_main") | (F.col("a") < F.col("b"))) & _sized("m", "n") & enough
    met = minor.join(right, (F.col("_v") == F.col("value")) & on)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _attach(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        one = table.select(F.col("rep").alias(f"_{end}"), F.col("n").alias(f"n{end}"), F.col(column).alias(f"_{column}{end}"))
        pairs = pairs.join(one, F.col(end) == F.col(f"_{end}")).drop(f"_{end}")
    return pairs


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose union sketch allows similarity and whose full sets have it."""
    both = _attach(pairs, sets, "sketch")
    union = F.slice(F.array_sort(F.transform(F.array_union("_sketcha", "_sketchb"), lambda x: F.struct(*_order(x)))), 1, K)
    common = F.array_intersect("_sketcha", "_sketchb")
    hit = F.size(F.array_intersect(common, F.transform(union, lambda x: x["v"])))
    likely = both.where((hit * K >= F.size(union) * LEAST)).select("a", "b")
    full = _attach(likely, sets, "members")
    inter = F.size(F.array_intersect("_membersa", "_membersb"))
    return full.where(inter * 100 >= (F.col("na") + F.col("nb") - inter) * NEAR).select("a", "b")


def _order(x: Column) -> list[Column]:
    """Unsigned order of a signed 64-bit value."""
    return [x.bitwiseXOR(F.lit(-(2**63))).alias("k"), x.alias("v")]


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when their sets of five-word shingles (A-Z lower-cased)
    have a Jaccard similarity of at least 0.75; a component is what links reach and its
    smallest key stays.

    Equal sets are one class.  A class keeps the 64 smallest values of one hash;
    inverted lists of retained values generate overlaps, the sketch of the union
    estimates the similarity and drops pairs far from it, and the full sets decide.
    A list meets one of its members in two rounds, after which the dense groups are
    one component each; then all pairs of a list between different components
    that can be similar follow, so no link that could join two components is left out.

    Keys are compared as they are; a null key is a row of its own that is not linked,
    with a null component.  Rows that repeat a key and text are one document; rows of one
    key with different texts are documents of their own, each with its own component.
    Null and empty texts have no shingle and are linked with nothing.  An empty
    table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    shape = f"_key {kind}, n long, one long, two long"
    sketched = staged(own.mapInArrow(_sketch, f"{shape}, sketch array<long>"), "sketches")
    some = sketched.where("n > 0 and _key is not null")
    # Numbers ascend with the smallest key, so the smallest number of a component has its smallest key.
    classes = some.groupBy(*NAME).agg(F.min("_key").alias("_key"))
    classes = staged(row_index(classes, ["_key", *NAME], name="rep"), "classes")
    chosen = some.join(classes, ["_key", *NAME]).dropDuplicates(["_key", *NAME])
    reps = staged(chosen.select("rep", "n", "sketch"), "representatives")
    entries = staged(_entries(reps), "lists")
    listed = staged(classes.join(entries.select("rep").distinct(), "rep", "left_semi"), "listed")
    # A filter of the listed keys, not a join that would shuffle every text; the join that follows is exact.
    bits = resume.bits_for(listed.count())
    wanted = resume.may_know(resume.done_filter(listed, ["_key"], bits), ["_key"], bits)
    sets = own.where(wanted).mapInArrow(_full, f"{shape}, members array<long>")
    sets = sets.join(listed, ["_key", *NAME]).dropDuplicates(["_key", *NAME])
    # Members are in order, so the first are the sketch; classes without a list are in no pair.
    sets = staged(sets.select("rep", "n", F.slice("members", 1, K).alias("sketch"), "members"), "sets")
    links = labels = None
    for turn in range(ROUNDS + 1):
        if labels is None:
            lists = entries.withColumn("component", F.col("rep"))
        else:
            lists = entries.join(labels, F.col("rep") == F.col("node"), "left").select("value", "rep", "n", "core", F.coalesce("component", "rep").alias("component"))
        pairs = staged(_stars(lists, turn) if turn < ROUNDS else _rest(lists, sets), "pairs")
        found = staged(_verified(pairs, sets), "links")
        links = found if links is None else links.union(found)
        labels = staged(connected(links), "labels")
    ends = classes.select(F.col("rep").alias("component"), F.col("_key").alias("_component"))
    named = classes.join(labels, F.col("rep") == F.col("node"), "left").select(*NAME, F.coalesce("component", "rep").alias("component"))
    named = named.join(ends, "component").select(*[F.col(c).alias(f"_{c}") for c in NAME], "_component")
    same = [F.col(c) == F.col(f"_{c}") for c in NAME]
    out = sketched.select("_key", *NAME).join(named, [F.col("n") > 0, F.col("_key").isNotNull(), *same], "left")
    component = F.coalesce("_component", "_key")
    return out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("_key") == component, F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of :func:`near_groups`, with all its columns.

    Rows that share a key share its fate: they stay if one of them does.
    """
    return keep_ids(docs, near_groups(docs, key, text).where("kept").select(key), key)
