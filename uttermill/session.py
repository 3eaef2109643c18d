"""Session settings and the one place that knows about scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings every job wants; sizes such as executor memory stay with the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole transcripts travel in these batches; keep one well below a gigabyte.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "uttermill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local session where the setting is
    empty; a cluster without the setting is an error, because a folder of one
    machine does not survive the loss of that machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="uttermill-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
        configured = sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and cut its lineage there.

    Used where a plan is read more than once and a recomputation could split
    the rows into other partitions (range boundaries come from a sample).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Row limit of an explicit broadcast; above it the join stays a shuffle join.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark narrow ``df`` for broadcast if it has at most ``limit`` rows.

    The rows are counted, up to the limit, before the hint is given; a larger
    side comes back without a hint and Spark shuffles it.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: Scans with this many splits are never dealt out anew.
SPREAD = 16


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of a small scan out to all cores; large scans pass through.

    A table of a few megabytes is one or two splits, which leaves most cores
    idle in work that costs far more than reading.  The split count of a plain
    scan is known without running it; from SPREAD splits on, a fixed small number,
    nothing is shuffled, however many cores there are.
    """
    cores = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD)
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
