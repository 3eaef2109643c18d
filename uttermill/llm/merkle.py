"""Merkle manifest of a table: block trees in van Emde Boas order, proofs and their check.

Leaves are numbered inside their group and cut into aligned subtrees of
:data:`HEIGHT` levels.  A subtree is one row: its nodes lie in one binary value in
van Emde Boas order, so construction and sibling retrieval find a node by address
arithmetic alone.  The roots of the blocks are the leaves of the next level, until
each group has one block; the roots of the groups form a last tree of the same kind.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.llm.common import staged
from uttermill.operators.ordering import row_index
from uttermill.session import small_side

#: Levels of edges in a block; a block has at most ``2 ** HEIGHT`` leaves and 64 kB of nodes.
HEIGHT = 10
WIDTH = 1 << HEIGHT
DIGEST = 32
#: Columns that a manifest adds to its leaves.
OWN = frozenset({"tree", "at", "digest", "path", "subroot", "root"})
_BLOCK = "tree long, block long, size int, nodes binary, digest string"


@functools.cache
def layout(levels: int) -> np.ndarray:
    """Address of every node of a complete tree with ``levels`` levels of nodes.

    Nodes go by heap number: 1 is the root, 2i and 2i + 1 are the children of i,
    entry 0 is unused.  The upper half of the levels comes first, then the subtrees
    below it from left to right, each laid out in the same way.
    """
    if levels == 1:
        return np.zeros(2, np.int64)
    top = levels // 2
    upper, lower = layout(top), layout(levels - top)
    size = (1 << (levels - top)) - 1
    trees = np.arange(1 << top)[:, None]
    out = np.zeros(1 << levels, np.int64)
    out[: 1 << top] = upper
    for depth in range(levels - top):
        first = 1 << (top + depth)
        out[first : 2 * first] = ((1 << top) - 1 + trees * size + lower[1 << depth : 2 << depth]).ravel()
    return out


def _height(block: int, size: int) -> int:
    """Levels of edges in a block: full, but for the only block of a small tree."""
    return HEIGHT if block else (size - 1).bit_length()


def _widths(size: int, height: int) -> list[int]:
    """Nodes of each level of a block, leaves first; the last run of a level may be a single node."""
    out = [size]
    for _ in range(height):
        out.append((out[-1] + 1) // 2)
    return out


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _block_of(table: pa.Table) -> pa.Table:
    """One block row from its at most ``WIDTH`` leaves (tree, at, digest)."""
    at = table.column("at").to_numpy()
    row = table.column("digest").to_pylist()
    row = [row[i] for i in np.argsort(at, kind="stable")]
    block, size = int(at.min()) >> HEIGHT, len(row)
    height = _height(block, size)
    address = layout(height + 1)
    nodes = np.zeros((len(address) - 1, DIGEST), np.uint8)
    for depth in range(height, -1, -1):
        places = address[1 << depth : (1 << depth) + len(row)]
        nodes[places] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, DIGEST)
        if depth:
            row = [_hash("".join(row[i : i + 2])) for i in range(0, len(row), 2)]
    return pa.table(
        {
            "tree": pa.array([table.column("tree")[0].as_py()], pa.int64()), "block": pa.array([block], pa.int64()),
            "size": pa.array([size], pa.int32()), "nodes": pa.array([nodes.tobytes()], pa.binary()), "digest": pa.array(row, pa.string()),
        }
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Block tables from the leaves (tree, at, digest) upwards; in the last one every tree has one block."""
    out, rows = [], leaves.select("tree", "at", "digest")
    while True:
        tagged = rows.withColumn("block", F.shiftright("at", HEIGHT))
        blocks = staged(tagged.groupBy("tree", "block").applyInArrow(_block_of, _BLOCK), "merkle-blocks")
        out.append(blocks)
        # One number reaches the driver; a level has a 1,024th of the rows of the one before.
        if not blocks.agg(F.max("block")).first()[0]:
            return out
        rows = blocks.select("tree", F.col("block").alias("at"), "digest")


def _siblings(children: pa.Table, blocks: pa.Table) -> pa.Table:
    """Children of one block with their path: siblings inside the block, then the block's own path."""
    if not children.num_rows or not blocks.num_rows:
        return children.append_column("path", pa.nulls(children.num_rows, pa.list_(_STEP)))
    block, size = blocks.column("block")[0].as_py(), blocks.column("size")[0].as_py()
    height = _height(block, size)
    address = layout(height + 1)
    body = blocks.column("nodes")[0].as_py()
    upper = blocks.column("path")[0].as_py()
    widths = _widths(size, height)
    paths = []
    for child in (children.column("at").to_numpy() & (WIDTH - 1)).tolist():
        path = []
        for level in range(height):
            place = child >> level
            other, digest = place ^ 1, ""
            if other < widths[level]:
                start = int(address[(1 << (height - level)) + other]) * DIGEST
                digest = body[start : start + DIGEST].hex()
            path.append({"digest": digest, "left": other < place})
        paths.append(path + upper)
    return children.append_column("path", pa.array(paths, pa.list_(_STEP)))


_STEP = pa.struct([("digest", pa.string()), ("left", pa.bool_())])
_PATH = "array<struct<digest string, left boolean>>"


def _with_paths(children: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add the path of each child (tree, at, ...); ``blocks`` carry the path of their own root."""
    tagged = children.withColumn("_block", F.shiftright("at", HEIGHT))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema.fields)
    pairs = tagged.groupBy("tree", "_block").cogroup(blocks.select("tree", "block", "size", "nodes", "path").groupBy("tree", "block"))
    return pairs.applyInArrow(_siblings, f"{fields}, path {_PATH}").drop("_block")


def _descend(levels: list[DataFrame], children: DataFrame, tops: DataFrame) -> DataFrame:
    """Paths of ``children`` through all ``levels``; ``tops`` (tree, path) continues above the last block."""
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for depth in range(len(levels) - 1, -1, -1):
        blocks = levels[depth].join(above.select("tree", "block", "path"), ["tree", "block"])
        rows = levels[depth - 1].select("tree", F.col("block").alias("at")) if depth else children
        found = _with_paths(rows, blocks)
        above = found.withColumnRenamed("at", "block")
    return found


@dataclass(frozen=True)
class Manifest:
    """The tables of a manifest.

    ``leaves`` has the group, the key, other chosen columns, ``tree`` (number of the
    group), ``at`` (number in the group) and ``digest``; ``trees`` (tree, subroot);
    ``levels`` and ``top`` are block tables, lowest first.
    """

    leaves: DataFrame
    trees: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]

    @property
    def root(self) -> str | None:
        """The root over all groups; None for an empty table."""
        row = self.top[-1].select("digest").first()
        return row[0] if row else None


def leaf_digest(columns: Sequence[Column | str]) -> Column:
    """SHA-256 over length-prefixed values, ``-`` for a null; lowercase hex.

    The length counts UTF-8 bytes, so no two rows of values read alike.
    """
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def build(rows: DataFrame, group: str, key: str, digest: str = "digest", keep: Sequence[str] = ()) -> Manifest:
    """Merkle trees over the ``digest`` (hex) of ``rows``, one tree per ``group``, and one over the groups.

    Leaves ascend by ``key`` (null first), ties by digest, so equal rows are
    neighbours and reruns agree; groups ascend bytewise, null first, and a null
    group is a group.  Numbers come from :func:`row_index`: a group with most of the rows is
    spread over many tasks, and no task sees more than a block of ``WIDTH``
    leaves.  An empty table has no root.  ``keep`` names columns that the leaves
    carry along; others are not read.  The names of the manifest's own columns
    (:data:`OWN`) are an error here.
    """
    if clash := OWN & {group, key, *keep}:
        raise ValueError(f"rename {sorted(clash)} first")
    # The running number tells equal rows apart, which lets the range sort cut a run of them.
    narrow = rows.select(
        F.col(group).alias("_group"), F.col(key).alias("_key"), F.col(digest).alias("digest"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    ).withColumn("_tie", F.monotonically_increasing_id())
    narrow = staged(narrow, "merkle-rows")
    groups = row_index(narrow.select("_group").distinct(), ["_group"], name="tree")
    other = groups.select(F.col("_group").alias("_same"), "tree")
    told = narrow.join(small_side(other), narrow["_group"].eqNullSafe(other["_same"])).drop("_same")
    ranked = row_index(told, ["_key", "digest", "_tie"], ["tree"], "at")
    leaves = staged(ranked.select("tree", "at", "_group", "_key", "digest", *[f"_keep_{c}" for c in keep]), "merkle-leaves")
    levels = _levels(leaves)
    trees = levels[-1].select("tree", F.col("digest").alias("subroot"))
    top = _levels(trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.col("subroot").alias("digest")))
    names = {"_group": group, "_key": key, **{f"_keep_{c}": c for c in keep}}
    return Manifest(leaves.withColumnsRenamed(names), trees, levels, top)


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """Add ``path``, ``subroot`` and ``root`` to ``leaves`` (rows of the manifest's leaves; default: all).

    ``path`` has one step per level from the leaf to the root: the sibling's digest
    and whether it stands left; a node without sibling has an empty one.
    """
    leaves = manifest.leaves if leaves is None else leaves
    ends = manifest.top[-1].select("tree", F.array().cast(_PATH).alias("path"))
    spots = manifest.trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), "subroot")
    tops = _descend(manifest.top, spots, ends).select(F.col("at").alias("tree"), "path", "subroot")
    tops = staged(tops.withColumn("root", F.lit(manifest.root).cast("string")), "merkle-tops")
    found = _descend(manifest.levels, leaves, tops.select("tree", "path"))
    return found.join(small_side(tops.select("tree", "subroot", "root")), "tree")


def fold(digest: Column | str, path: Column | str = "path") -> Column:
    """The root that a leaf digest and its path lead to."""
    start = F.col(digest) if isinstance(digest, str) else digest

    def up(node: Column, step: Column) -> Column:
        pair = F.when(step["left"], F.concat(step["digest"], node)).otherwise(F.concat(node, step["digest"]))
        return F.sha2(pair, 256)

    return F.aggregate(path, start, up)


def write_manifest(manifest: Manifest, path: str) -> None:
    """Leaves, trees and block tables below ``path``, replacing what was there."""
    manifest.leaves.write.mode("overwrite").parquet(f"{path}/leaves")
    manifest.trees.write.mode("overwrite").parquet(f"{path}/trees")
    for name, tables in (("levels", manifest.levels), ("top", manifest.top)):
        for depth, table in enumerate(tables):
            table.write.mode("overwrite" if depth == 0 else "append").parquet(f"{path}/{name}/depth={depth}")


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    def tables(name: str) -> list[DataFrame]:
        deepest = spark.read.schema(f"{_BLOCK}, depth int").parquet(f"{path}/{name}").agg(F.max("depth")).first()[0] or 0
        return [spark.read.schema(_BLOCK).parquet(f"{path}/{name}/depth={d}") for d in range(deepest + 1)]

    return Manifest(spark.read.parquet(f"{path}/leaves"), spark.read.parquet(f"{path}/trees"), tables("levels"), tables("top"))


def changed(manifest: Manifest, other: Manifest) -> DataFrame:
    """(tree, block) of the lowest blocks whose digests differ, found from the block roots only.

    Both manifests number the same groups alike; blocks that one side lacks count as changed.
    """
    mine = manifest.levels[0].select("tree", "block", F.col("digest").alias("_a"))
    theirs = other.levels[0].select("tree", "block", F.col("digest").alias("_b"))
    both = mine.join(theirs, ["tree", "block"], "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("tree", "block")
