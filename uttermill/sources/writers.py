"""Sinks: shards, tables, prediction files, vocabularies and reports."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.operators.ordering import first_rows, running_total


def write_sharded(df: DataFrame, path: str, shard: str = "shard", by: Sequence[str] = ()) -> None:
    """One folder per shard.

    Rows meet by shard before the write, so a shard is one file and a task
    keeps one file open.
    """
    df.repartition(*by, shard).write.mode("overwrite").partitionBy(*by, shard).parquet(path)


#: Parts of a shard that a task of a bounded write makes together, and its least number of tasks a core.
RUN_PARTS = 64
CORE_TASKS = 4


def write_bounded(
    df: DataFrame, path: str, size: Column, max_bytes: int, pos: str = "row_idx", shard: str = "shard", by: Sequence[str] = ()
) -> DataFrame:
    """Shards as folders of files of bounded size, and a manifest of their row ranges.

    A shard has no bound: where boundary rows have no transcript, shards merge.  The
    running sum of ``size`` along ``pos`` inside a shard gives each row its ``part``, a new one
    every ``max_bytes``; a part is one file, at most its last row above the bound, and a task writes
    whole parts.  :data:`RUN_PARTS` parts of a shard go to one task, which makes the folder of the shard once,
    so a merged shard still spreads.  The manifest (by, shard, part, first_row, last_row, n_rows, n_bytes) is
    counted from what was written, lies in ``path/_manifest`` and comes back.
    """
    spark = df.sparkSession
    keys = [*by, shard]
    cut = running_total(df.withColumn("_size", size.cast("bigint")), pos, "_size", keys, "_before")
    parts = cut.withColumn("part", F.floor(F.col("_before") / max_bytes).cast("int")).drop("_before")
    # A stated number of tasks is not merged by bytes: small files cost their creation.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), CORE_TASKS * spark.sparkContext.defaultParallelism)
    placed = parts.repartition(tasks, *keys, F.floor(F.col("part") / RUN_PARTS)).sortWithinPartitions(*keys, "part", pos)
    placed.write.mode("overwrite").partitionBy(*keys, "part").parquet(path)
    manifest = spark.read.parquet(path).groupBy(*keys, "part").agg(
        F.min(pos).alias("first_row"), F.max(pos).alias("last_row"), F.count(F.lit(1)).alias("n_rows"), F.sum("_size").alias("n_bytes"),
    )
    # The hidden name keeps it out of the table.
    manifest.write.mode("overwrite").parquet(f"{path}/_manifest")
    return spark.read.parquet(f"{path}/_manifest")


def write_capped(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Files of at most ``rows_per_file`` rows; no shuffle."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


#: Files that one task of an ordered or bounded write is meant to make.  A small file costs its
#: creation, not its bytes, by which tasks are cut otherwise.
TASK_FILES = 250


def write_ordered(
    df: DataFrame, path: str, order_by: Sequence[str | Column], rows_per_file: int, n_rows: int, columns: Sequence[str] = ("*",)
) -> None:
    """``columns`` of the rows in a stated order, in files of at most ``rows_per_file`` rows numbered in that order.

    The ``n_rows`` rows are dealt out by ranges of the order to tasks of about :data:`TASK_FILES` files.
    """
    tasks = max(1, math.ceil(n_rows / (rows_per_file * TASK_FILES)))
    placed = df.repartitionByRange(tasks, *order_by).sortWithinPartitions(*order_by)
    placed.select(*columns).write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table of ``buckets`` files by the hash of ``key``, each sorted by it, under ``name`` in the catalog.

    Two tables with equal buckets join on their keys without an exchange, as often as they
    are read.  Rows meet by bucket before the write, so a bucket is one file.
    """
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """(file_id, transcript) CSV with a header, replacing what was there."""
    (
        df.select("file_id", "transcript")
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .csv(path)
    )


def append_text(chunks: DataFrame, path: str, order: str = "chunk", text: str = "text") -> None:
    """Append text chunks as rows (call, chunk, text): nothing is put between them.

    A later call has a higher number; (call, chunk) is the order of the whole text.
    """
    spark = chunks.sparkSession
    try:
        last = spark.read.parquet(path).agg(F.max("call")).first()[0]
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    rows = chunks.select(F.lit((last or 0) + 1).alias("call"), F.col(order).alias("chunk"), F.col(text).alias("text"))
    rows.write.mode("append").parquet(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """The vocabulary as one JSON object; a few thousand entries by nature."""
    packed = vocab.agg(
        F.to_json(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("ch", "id"))))
        ).alias("value")
    )
    packed.coalesce(1).write.mode("overwrite").text(path)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a table once; later calls read what is there.

    A failed write leaves no committed file behind, so it reads as absent and
    the table is built again.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fingerprint(spark: SparkSession, plan: DataFrame, inputs: Sequence[str]) -> str:
    """A digest of the plan and of path, length and time of every file below ``inputs``.

    The listing is read as a table, so it may be long; expression numbers, which differ in
    every session, are taken out of the plan.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(inputs))
        .select("path", "length", "modificationTime")
    )
    # Sums of hashes do not depend on the order of the listing.
    row = files.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")),
        F.sum(F.hash("path", "length", "modificationTime").cast("bigint")),
    ).first()
    text = plan._jdf.queryExecution().analyzed().treeString()
    told = re.sub(r"#\d+L?|@[0-9a-f]+|\(\d+\) ", "", text)
    return hashlib.sha256(f"{row[0]}:{row[1]}:{row[2]}:{told}".encode()).hexdigest()[:32]


def materialize_fresh(spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: Sequence[str]) -> DataFrame:
    """Build a table once for every state of its inputs and plan; reuse it while neither changes.

    Each state has a folder of its own, named by the :func:`fingerprint` and complete when its
    success mark is there.  So a failed build leaves nothing that is read, readers of the
    state before go on, and going back to earlier inputs finds their table.  The fingerprint is taken
    before the build: inputs that change meanwhile are noticed by the next call.
    """
    plan = build()
    at = f"{path}/state={fingerprint(spark, plan, inputs)}"
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if not mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark):
        plan.write.mode("overwrite").parquet(at)
    return spark.read.schema(plan.schema).parquet(at)


def write_report(report: DataFrame, path: str, key: str | Sequence[str], n: int | None = None) -> None:
    """All predictions and all wrong ones, or the first ``n`` of each in the order of ``key``."""
    keys = [key] if isinstance(key, str) else list(key)

    def part(rows: DataFrame) -> DataFrame:
        return rows if n is None else first_rows(rows, keys, n)

    part(report).write.mode("overwrite").parquet(f"{path}/all_predictions")
    wrong = report.where(F.col("norm_target") != F.col("norm_pred"))
    part(wrong).write.mode("overwrite").parquet(f"{path}/incorrect_predictions")
