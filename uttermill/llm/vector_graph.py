"""Embedding near-dedup: robust-pruned flat graphs on overlapping shards, range-expanding search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.llm.common import staged
from uttermill.llm.components import connected
from uttermill.session import small_side

#: Vectors of a part of a shard; rows and rounds that cluster centres are fitted on; most centres of one level.
PART, SAMPLE, ROUNDS, MOST = 1200, 8192, 8, 512
#: Parts of a shard that is not split into shards of its own; vectors of one splitting task; levels of
#: splitting, each of which makes shards up to MOST times smaller.
ROOM, CHUNK, LEVELS = 16, 4096, 8
#: Shards a vector belongs to at first, and the most before it belongs to all.
OVERLAP, OVERLAP_MOST = 3, 9
#: Neighbours of a node, nodes expanded at least, and the pruning factor on squared distances.
DEGREE, EXPAND, ALPHA = 24, 24, 1.44
#: How far below the threshold the search still expands.
SLACK = 0.04
#: Vectors an audit compares with all others, more while it sees fewer true links than asked for.
AUDIT, TRUE_LINKS = (64, 512, 2048), 256
#: The recall below which shards overlap more, and the one below which there is no result.
RECALL, RECALL_LEAST = 0.95, 0.9


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def search(vectors: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, low: float, expand: int = EXPAND) -> np.ndarray:
    """Cosines of the nodes each query meets; -2 where it does not come by.

    Greedy: the best node met and not expanded yet is expanded ``expand`` times,
    and from then on only while it is at least ``low``.  Range expansion: all nodes
    at or above ``low`` are expanded at once whenever they are met.
    """
    n, nodes = len(queries), len(vectors)
    score = np.full((n, nodes), -2.0)
    done = np.zeros((n, nodes), bool)
    score[:, start] = queries @ vectors[start]
    every, step = np.arange(n), 0
    while True:
        waiting = np.where(done, -2.0, score)
        best = waiting.argmax(1)
        value = waiting[every, best]
        go = (value > -2.0) & ((step < expand) | (value >= low))
        if not go.any():
            return score
        near_q, near_n = np.nonzero(waiting >= low)
        q, node = np.concatenate([every[go], near_q]), np.concatenate([best[go], near_n])
        done[q, node] = True
        ahead = edges[node]
        flat = np.unique((q[:, None] * nodes + ahead)[ahead >= 0])
        flat = flat[score.reshape(-1)[flat] == -2.0]
        for a in range(0, len(flat), 65_536):
            i, j = np.divmod(flat[a : a + 65_536], nodes)
            score[i, j] = np.einsum("ij,ij->i", vectors[j], queries[i])
        step += 1


def robust_prune(near: np.ndarray, own: np.ndarray, found: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Up to ``degree`` of each row's candidates ``found`` (-1: none) for the nodes ``own``.

    The closest candidate is taken and those much closer to it than to the node
    are dropped, until the list is full.  ``near`` holds all cosines of the shard.
    """
    far = np.where((found >= 0) & (found != own[:, None]), 2 - 2 * near[own[:, None], found], np.inf)
    alive, kept = far.copy(), np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for k in range(degree):
        at = alive.argmin(1)
        some = np.isfinite(alive[rows, at])
        if not some.any():
            break
        picked = found[rows, at]
        kept[some, k] = picked[some]
        between = 2 - 2 * near[picked[:, None], found]
        alive[(ALPHA * between <= far) | (found == picked[:, None])] = np.inf
        alive[rows, at] = np.inf
    return kept


def build(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, int]:
    """Pruned neighbour lists of a shard, and its medoid.  Nodes enter in growing batches."""
    n = len(vectors)
    near = vectors @ vectors.T
    medoid = int((vectors @ vectors.mean(0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]])
    edges = np.full((n, DEGREE), -1)
    at = 1
    while at < n:
        batch = order[at : at + min(at, 256)]
        score = search(vectors, edges, medoid, vectors[batch], 2.0)
        width = min(3 * DEGREE, n)
        found = np.argpartition(-score, width - 1, axis=1)[:, :width]
        found = np.where(np.take_along_axis(score, found, 1) > -2.0, found, -1)
        edges[batch] = robust_prune(near, batch, found)
        # Every edge gets its way back; lists that overflow are pruned again.
        to, source = edges[batch], np.repeat(batch[:, None], DEGREE, 1)
        to, source = to[to >= 0], source[edges[batch] >= 0]
        ranked = np.argsort(to, kind="stable")
        to, source = to[ranked], source[ranked]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.empty(0, np.int64)
        lengths = np.diff(np.append(first, len(to)))
        target = to[first]
        extra = np.full((len(target), int(lengths.max()) if len(target) else 0), -1)
        extra[np.repeat(np.arange(len(target)), lengths), np.arange(len(to)) - np.repeat(first, lengths)] = source
        if len(target):
            edges[target] = robust_prune(near, target, np.concatenate([edges[target], extra], 1))
        at += len(batch)
    return edges, medoid


def _centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means on a bounded sample."""
    centre = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        own = (sample @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 0, total / np.maximum(size, 1e-300), centre)
    return centre


def _assign(centres: np.ndarray, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("unit"))
            count = min(overlap, len(centres))
            own = np.argsort(-(vectors @ centres.T), axis=1, kind="stable")[:, :count]
            take = np.repeat(np.arange(len(vectors)), count)
            shard = pa.array(own.reshape(-1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([shard, batch.column("rep").take(pa.array(take)), batch.column("unit").take(pa.array(take))], ["shard", "rep", "unit"])

    return run


def _nearest(overlap: int):
    """Each vector of a chunk with its nearest leaders; without a leader the vector stays where it is."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        count = min(overlap, max(right.num_rows, 1))
        take = pa.array(np.repeat(np.arange(left.num_rows), count))
        if left.num_rows and right.num_rows:
            own = np.argsort(-(_matrix(left["unit"]) @ _matrix(right["leader_unit"]).T), axis=1, kind="stable")[:, :count]
            leader = right["leader"].take(pa.array(own.reshape(-1)))
        else:
            leader = pa.nulls(len(take), right["leader"].type)
        return pa.table({"shard": left["shard"].take(take), "leader": leader, "rep": left["rep"].take(take), "unit": left["unit"].take(take)})

    return run


def _split(placed: DataFrame, overlap: int, kind: str) -> DataFrame:
    """``placed`` with every shard above ROOM parts split, level by level.

    A hash picks the leaders of a shard, one per PART members and about MOST at the most, and each member joins
    the shards of its nearest leaders.  Members come in chunks of about CHUNK, to each of which the leaders are
    sent, so neither a task nor a broadcast grows with the shard.  Dense regions have as many leaders
    as their share of the members.
    """
    ready = []
    for level in range(LEVELS):
        sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("members"))
        large = staged(sizes.where(F.col("members") > ROOM * PART), "large-shards")
        if large.isEmpty():
            break
        ready.append(placed.join(small_side(large.select("shard")), "shard", "left_anti"))
        chunks = F.ceil(F.col("members") / CHUNK)
        big = placed.join(small_side(large), "shard").withColumn("chunk", F.pmod(F.xxhash64(F.lit(31), "rep"), chunks))
        wanted = F.least(F.lit(MOST), F.ceil(F.col("members") / PART))
        leaders = big.where(F.pmod(F.xxhash64(F.lit(level), "shard", "rep"), F.col("members")) < wanted)
        leaders = leaders.select(
            F.col("shard").alias("shard"), F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("chunk"), F.col("rep").alias("leader"), F.col("unit").alias("leader_unit"),
        )
        keys = ["shard", "chunk"]
        groups = big.select(*keys, "rep", "unit").groupBy(*keys).cogroup(leaders.groupBy(*keys))
        moved = groups.applyInArrow(_nearest(overlap), f"shard long, leader {kind}, rep {kind}, unit array<double>")
        shard = F.when(F.col("leader").isNull(), F.col("shard")).otherwise(F.xxhash64("shard", "leader"))
        placed = staged(moved.select(shard.alias("shard"), "rep", "unit"), "split-shards")
    for one in ready:
        placed = placed.unionByName(one)
    return placed


def _build(table: pa.Table) -> pa.Table:
    edges, medoid = build(_matrix(table["unit"]))
    rep = np.array(table["rep"].to_pylist())
    rows, _ = np.nonzero(edges >= 0)
    loose = rep if len(rep) == 1 else np.empty(0, rep.dtype)
    return pa.table({"rep": pa.array(np.concatenate([rep[rows], loose])), "other": pa.array(np.concatenate([rep[edges[edges >= 0]], loose]))})


def _search(threshold: float):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        members, queries = _matrix(left["unit"]), _matrix(right["unit"])
        rep, asked = np.array(left["rep"].to_pylist()), np.array(right["rep"].to_pylist())
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if len(rep) and len(asked):
            place = {r: i for i, r in enumerate(rep.tolist())}
            lists = [[place[x] for x in row or () if x in place] for row in left["others"].to_pylist()]
            edges = np.full((len(rep), max(1, *map(len, lists)) if lists else 1), -1)
            for i, row in enumerate(lists):
                edges[i, : len(row)] = row
            medoid = int((members @ members.mean(0)).argmax())
            for a in range(0, len(asked), 400):
                score = search(members, edges, medoid, queries[a : a + 400], threshold - SLACK)
                q, node = np.nonzero(score >= threshold)
                found.append((asked[a + q], rep[node]))
        a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        apart = a != b
        return pa.table({"a": pa.array(np.minimum(a, b)[apart]), "b": pa.array(np.maximum(a, b)[apart])})

    return run


def _links(reps: DataFrame, centres: np.ndarray, overlap: int, threshold: float, kind: str) -> DataFrame:
    """Pairs of ``reps`` found by graphs on shards that overlap ``overlap``-fold."""
    placed = staged(reps.select("rep", "unit").mapInArrow(_assign(centres, overlap), f"shard long, rep {kind}, unit array<double>"), "shards")
    if overlap < len(centres):
        placed = _split(placed, max(2, overlap - 1), kind)
    parts = staged(placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts")), "parts")
    cut = placed.join(small_side(parts), "shard").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    lists = cut.groupBy("shard", "part").applyInArrow(lambda t: _build(t), f"rep {kind}, other {kind}")
    union = staged(lists.groupBy("rep").agg(F.collect_set("other").alias("others")), "neighbours")
    every = F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)
    members = cut.join(union, "rep").select("shard", "part", F.explode(every).alias("with"), "rep", "unit", "others")
    again = [F.col(c).alias(c) for c in ("shard", "rep", "unit")]
    queries = cut.select(F.explode(every).alias("_p"), F.col("part").alias("with"), *again).withColumnRenamed("_p", "part")
    keys = ["shard", "part", "with"]
    found = members.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_search(threshold), f"a {kind}, b {kind}")
    return staged(found.distinct(), "found")


def audit(reps: DataFrame, links: DataFrame, threshold: float, samples: tuple[int, ...] = AUDIT, least: int = TRUE_LINKS) -> tuple[int, int]:
    """(links found, true links) of the first vectors by a hash, compared with every vector.

    Takes as many as the first of ``samples``; the next one while fewer than ``least`` true links are seen
    and vectors are left.
    """
    found = total = 0
    for sample in samples:
        chosen = reps.orderBy(F.xxhash64(F.lit(17), "rep"), "rep").limit(sample).select("rep", "unit").toArrow()
        found, total = _audited(reps, links, threshold, chosen)
        if total >= least or len(chosen) < sample:
            break
    return found, total


def _audited(reps: DataFrame, links: DataFrame, threshold: float, chosen: pa.Table) -> tuple[int, int]:
    ids, vectors = np.array(chosen["rep"].to_pylist()), _matrix(chosen["unit"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                own = np.array(part.column("rep").to_pylist())
                i, j = np.nonzero(_matrix(part.column("unit")) @ vectors.T >= threshold)
                a, b = own[i], ids[j]
                apart = a != b
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[apart]), pa.array(np.maximum(a, b)[apart])], ["a", "b"])

    kind = reps.schema["rep"].dataType.simpleString()
    true = reps.select("rep", "unit").mapInArrow(compare, f"a {kind}, b {kind}").distinct()
    hit = true.join(links.withColumn("_hit", F.lit(1)), ["a", "b"], "left")
    total, found = hit.agg(F.count(F.lit(1)), F.count("_hit")).first()
    return found, total


def _audited_links(reps: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Links between vectors of one length, of the first overlap whose recall is enough."""
    sample = _matrix(reps.orderBy(F.xxhash64(F.lit(5), "rep")).limit(SAMPLE).select("unit").toArrow()["unit"])
    centres = _centres(sample, int(min(MOST, len(sample), -(-reps.count() // PART))))
    overlap = min(OVERLAP, len(centres))
    while True:
        links = _links(reps, centres, overlap, threshold, kind)
        found, total = audit(reps, links, threshold)
        if found >= RECALL * total:
            return links
        if overlap == len(centres):
            if found >= RECALL_LEAST * total:
                return links
            raise RuntimeError(f"the search finds {found} of {total} links")
        overlap = min(overlap + 3 if overlap < OVERLAP_MOST else len(centres), len(centres))


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``table``.

    Vectors with a cosine of at least ``threshold`` (double precision) are linked.
    n_links counts the other rows linked directly; the smallest key of a component
    stays.

    Equal vectors are one class.  Cluster centres come from at most 8,192 classes;
    every class joins the shards of its three nearest centres; a shard above 16 parts
    is split by leaders of its own, as often as it takes, and what remains is cut into parts of about 1,200.  Each part builds a robust-pruned
    graph; the neighbour lists of a vector are united over its shards.  Every
    vector then searches all parts of its shards from their medoids, expanding the
    range around it.  Only pairs whose cosine was computed and reaches the threshold
    are links.  An audit, at every size and after every overlap, compares 64 vectors with all others, or up to
    2,048 until 256 true links are seen; while recall is below 0.95, shards overlap more, at last all of them.
    Should less than 0.9 be found even then, the job fails.

    Vectors that are null, empty, zero, or hold null or non-finite components are
    linked with nothing.  Vectors of each length are compared among themselves, one length after the other. A null key
    is never linked and its component is null.  Rows that repeat a key are counted each.
    An empty table gives an empty result.
    """
    kind = table.schema[key].dataType.simpleString()
    own = table.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_v"))
    square = F.aggregate("_v", F.lit(0.0), lambda s, x: s + x * x)
    fine = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce((F.size("_v") > 0) & fine & F.col("_key").isNotNull(), F.lit(False))
    valid = own.where(good)
    largest = F.array_max(F.transform("_v", lambda x: F.abs(x)))
    valid = valid.where(largest > 0)
    # Scaled first, so that squares neither overflow nor vanish.
    valid = valid.withColumn("_v", F.transform("_v", lambda x: x / largest))
    classes = staged(valid.groupBy("_v").agg(F.min("_key").alias("rep"), F.count(F.lit(1)).alias("size")), "vector-classes")
    unit = F.transform("_v", lambda x: x / F.sqrt(square))
    reps = staged(classes.select("rep", "size", unit.alias("unit")), "units")
    lengths = reps.groupBy(F.size("unit").alias("length")).count().where("count > 1").orderBy("length").toArrow()["length"].to_pylist()
    links = table.sparkSession.createDataFrame([], f"a {kind}, b {kind}")
    for length in lengths:
        links = links.union(_audited_links(reps.where(F.size("unit") == length), threshold, kind))
    both = links.union(links.select("b", "a")).join(reps.select(F.col("rep").alias("b"), "size"), "b")
    counts = both.groupBy(F.col("a").alias("_r")).agg(F.sum("size").alias("_more"))
    labels = connected(links)
    named = classes.join(counts, F.col("rep") == F.col("_r"), "left").join(labels, F.col("rep") == F.col("node"), "left")
    named = staged(named.select(F.col("_v").alias("_w"), (F.coalesce("_more", F.lit(0)) + F.col("size") - 1).alias("_links"), F.coalesce("component", "rep").alias("_component")), "vector-links")
    scaled = own.withColumn("_s", F.when(good & (largest > 0), F.transform("_v", lambda x: x / largest)))
    out = scaled.select("_key", "_s").join(named, F.col("_s") == F.col("_w"), "left")
    component = F.coalesce("_component", "_key")
    return out.select(
        F.col("_key").alias(key), F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("_key") == component, F.lit(True)).alias("kept"),
    )
