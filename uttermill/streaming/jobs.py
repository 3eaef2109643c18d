"""The batch operators as streams that stop when the input is used up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttermill.streaming import versions

Transform = Callable[[DataFrame], DataFrame]


def stream_to_table(
    stream: DataFrame, path: str, checkpoint: str, transform: Transform | None = None
) -> None:
    """Stateless map or filter into a Parquet table, exactly once.

    The checkpoint keeps which files are done; a second call continues there.
    """
    out = transform(stream) if transform else stream
    query = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _run(stream: DataFrame, mode: str, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_snapshot(stream: DataFrame, path: str, checkpoint: str, every: int = 1) -> None:
    """Append each micro-batch to a log; publish a version every ``every`` batches and at the end.

    A replayed batch changes nothing, and readers see a whole version or the
    one before.  Small batches are merged as the log grows (:mod:`versions`).
    A path belongs to one checkpoint; a stream without any batch publishes nothing.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        versions.append(batch, path, batch_id)
        if batch_id > 0 and batch_id % every == 0:
            versions.publish(batch.sparkSession, path, upto=batch_id)

    _run(stream, "append", checkpoint, on_batch)
    versions.publish(stream.sparkSession, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest published version."""
    return versions.read(spark, path)


def running_totals(
    stream: DataFrame, by: Sequence[str], sums: dict[str, Column], path: str, checkpoint: str
) -> None:
    """Grouped sums kept as streaming state; each batch writes the totals of its changed groups.

    State holds one row per group.  A batch is a set of (key, value, batch number)
    rows; the newest row of a key is its total.  A replayed batch changes nothing, and
    merging batches keeps one row a key.
    """
    totals = stream.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    rows = totals.select(F.struct(*by).alias("key"), F.struct("n_samples", *sums).alias("value"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        versions.append(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path, batch_id)
        versions.publish(batch.sparkSession, path, versions.newest_per_key, batch_id)

    _run(rows, "update", checkpoint, on_batch)


def current_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals written by :func:`running_totals`."""
    return versions.newest_per_key(versions.read(spark, path)).select("key.*", "value.*")
