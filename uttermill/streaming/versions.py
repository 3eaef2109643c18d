"""A table made of numbered batches, read under published versions and merged as it grows.

``log/`` holds a folder per batch and merged folders, ``versions/`` a small manifest per
version that lists the folders of that version.  A version appears with its one file; the
folders it names stay until :data:`KEEP` newer versions exist, so a reader keeps the one it
has begun with.  Every :data:`FAN` folders of a level become one of the next, so a row is
written again once a level and a version of n batches names about FAN * log(n) / log(FAN) folders.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
KEEP = 2
#: Bytes of one file of a merged folder.
FILE_BYTES = 128 << 20
_BATCH = r"batch_id=(\d+)"
_MANIFEST = "level int, first long, last long, folder string"

Fold = Callable[[DataFrame], DataFrame]


def _path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API, which reaches every store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbered(spark: SparkSession, path: str, pattern: str) -> dict[tuple[int, ...], str]:
    """Completely written folders below ``path`` that match, by the numbers in their names, ascending."""
    fs, at = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    found = {tuple(int(g) for g in m.groups()): n for n in names if (m := re.fullmatch(pattern, n))}
    return {k: found[k] for k in sorted(found) if _written(spark, f"{path}/{found[k]}")}


def _written(spark: SparkSession, folder: str) -> bool:
    fs, at = _path(spark, f"{folder}/_SUCCESS")
    return fs.exists(at)


def _remove(spark: SparkSession, folder: str) -> None:
    fs, at = _path(spark, folder)
    fs.delete(at, True)


def _versions(spark: SparkSession, path: str) -> dict[tuple[int, ...], str]:
    """Folders by (version, last batch)."""
    return _numbered(spark, f"{path}/versions", r"version-(\d+)-upto-(\d+)")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    return [v for v, _ in _versions(spark, path)]


def published(spark: SparkSession, path: str) -> int:
    """The last batch in the newest version, -1 before the first; a listing tells it."""
    return max((upto for _, upto in _versions(spark, path)), default=-1)


def _entries(spark: SparkSession, path: str, version: int) -> list[tuple[int, int, int, str]]:
    """(level, first batch, last batch, folder); a few rows for each level."""
    folder = next(f for (v, _), f in _versions(spark, path).items() if v == version)
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/versions/{folder}").collect()
    return sorted(((r.level, r["first"], r["last"], r.folder) for r in rows), key=lambda e: e[1])


def append(batch: DataFrame, path: str, batch_id: int) -> bool:
    """Write a batch under its number.

    A batch that a version holds already is left out, and one that was written but not
    published replaces itself: a replay after a failure changes nothing.
    """
    if batch_id <= published(batch.sparkSession, path):
        return False
    batch.write.mode("overwrite").parquet(f"{path}/log/batch_id={batch_id}")
    return True


def publish(spark: SparkSession, path: str, fold: Fold | None = None, upto: int | None = None) -> int:
    """Make a version of all written batches up to ``upto``; gives its number.

    ``fold`` turns the rows of merged folders into the rows that stay of them.  It must give the same
    table whether it sees the batches at once or in merged parts.  Nothing new: the
    newest version stays.
    """
    version, last = max(_versions(spark, path), default=(0, -1))
    fresh = [n for (n,) in _numbered(spark, f"{path}/log", _BATCH) if n > last and (upto is None or n <= upto)]
    if not fresh:
        return version
    entries = _entries(spark, path, version) if version else []
    entries += [(0, n, n, f"batch_id={n}") for n in fresh]
    level = 0
    while any(e[0] >= level for e in entries):
        while len(group := [e for e in entries if e[0] == level][:FAN]) == FAN:
            merged = (level + 1, group[0][1], group[-1][2], f"merged-{level + 1}-{group[0][1]}-{group[-1][2]}")
            if not _written(spark, f"{path}/log/{merged[3]}"):
                _merge(spark, path, [e[3] for e in group], merged[3], fold)
            entries = sorted([e for e in entries if e not in group] + [merged], key=lambda e: e[1])
        level += 1
    rows = spark.createDataFrame(entries, _MANIFEST).coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path}/versions/version-{version + 1}-upto-{entries[-1][2]}")
    _clean(spark, path)
    return version + 1


def _merge(spark: SparkSession, path: str, folders: list[str], target: str, fold: Fold | None) -> None:
    size = 0
    for folder in folders:
        fs, at = _path(spark, f"{path}/log/{folder}")
        size += fs.getContentSummary(at).getLength()
    rows = spark.read.parquet(*[f"{path}/log/{f}" for f in folders])
    files = max(1, -(-size // FILE_BYTES))
    # A fold shuffles, so its result may be few partitions only by another shuffle; plain rows are put together.
    out = fold(rows).repartition(files) if fold else rows.coalesce(files)
    out.write.mode("overwrite").parquet(f"{path}/log/{target}")


def _clean(spark: SparkSession, path: str) -> None:
    """Remove versions before the kept ones, and published folders that none of the kept names."""
    found = _versions(spark, path)
    kept, last = list(found)[-(KEEP + 1) :], max(found)[1]
    named = {e[3] for v, _ in kept for e in _entries(spark, path, v)}
    for at in set(found) - set(kept):
        _remove(spark, f"{path}/versions/{found[at]}")
    fs, log = _path(spark, f"{path}/log")
    for status in fs.listStatus(log):
        name = status.getPath().getName()
        match = re.fullmatch(rf"{_BATCH}|merged-\d+-\d+-(\d+)", name)
        if match and int(match[1] or match[2]) <= last and name not in named:
            _remove(spark, f"{path}/log/{name}")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest unless one is named; merged and single batches alike."""
    found = versions(spark, path)
    if not found or (version is not None and version not in found):
        raise ValueError(f"no version {'' if version is None else version} at {path}".replace("  ", " "))
    names = [e[3] for e in _entries(spark, path, found[-1] if version is None else version)]
    return spark.read.parquet(*[f"{path}/log/{n}" for n in names])


def newest_per_key(rows: DataFrame) -> DataFrame:
    """Of rows (key, value, batch_id) the one of the last batch for each key; a partial aggregate, no window."""
    return rows.groupBy("key").agg(F.max_by("value", "batch_id").alias("value"), F.max("batch_id").alias("batch_id"))
