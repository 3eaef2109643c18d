"""Sources: annotation maps, file listings, corpora, predictions, streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttermill import schema as S
from uttermill.session import pin, small_side


def _json_map(spark: SparkSession, path: str | list[str], value_type: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    # Repeated keys: the last one wins.
    parsed = F.from_json("value", f"map<string,{value_type}>")
    return raw.select(F.explode(parsed).alias("key", "value"))


def scan_json_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A JSON object ``{key: sentence}`` per file, as (key, sentence) rows.

    A file is one row of one task; ``splitscan.read_json_map`` reads large ones in parallel.
    """
    return _json_map(spark, path, "string").withColumnRenamed("value", "sentence")


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary JSON object as (ch, id) rows."""
    return _json_map(spark, path, "int").toDF("ch", "id")


def list_files(
    spark: SparkSession, root: str, globs: Sequence[str] = ("*",), recursive: bool = False
) -> DataFrame:
    """Path, length and modification time in path order; file contents are never opened.

    All ``globs`` make one pattern, so a file that several of them match is listed once.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", globs[0] if len(globs) == 1 else "{" + ",".join(globs) + "}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
    )
    return files.select("path", "length", "modificationTime").orderBy("path")


def read_binary(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, length and content of whole files."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "content")
    )


def read_transcripts(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """One row per text file: (path, text)."""
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def load_corpus(
    spark: SparkSession, root: str, name: str, config: str | None = None, split: str | None = None
) -> DataFrame:
    """A named corpus out of a table partitioned by corpus, config and split.

    The conditions are on partition columns, so other folders are not listed.
    """
    df = spark.read.parquet(root).where(F.col("corpus") == name)
    if config is not None:
        df = df.where(F.col("config") == config)
    return df if split is None else df.where(F.col("split") == split)


def load(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A saved dataset, or all that match a glob such as ``prefix*``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def _file_place(path: Column) -> list[Column]:
    """Sort keys that put the files of a saved table in the order they were written.

    Spark numbers the files of a write by task and then by file; without such a
    name the path decides.  Numbers go by value: part-100000 follows part-99999.
    """
    name = F.substring_index(path, "/", -1)
    folder = F.substr(path, F.lit(1), F.length(path) - F.length(name))
    task = F.regexp_extract(name, r"^part-([0-9]+)", 1).try_cast("bigint")
    number = F.regexp_extract(name, r"-c([0-9]+)(?:\.|$)", 1).try_cast("bigint")
    return [folder, task, number, name]


def load_numbered(spark: SparkSession, path: str | list[str], name: str = "row_idx") -> DataFrame:
    """A saved Parquet table with the 0-based number of each row in the saved order.

    A Parquet row knows its place in its file, so one number per file is all that is
    missing: rows are counted by file (no column is read), the counts summed up in
    file order and joined back.  Nothing is sorted, and the only exchange holds one row per
    file.  These numbers are pinned, so the files are counted once however often the rows are
    read.  Any filter above keeps the numbers, as they are places in the files.
    """
    df = load(spark, path)
    place, at = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = df.select(place.alias("_file"), at.alias("_at")).groupBy("_file").agg((F.max("_at") + 1).alias("_n"))
    files = files.select("_file", "_n", *[c.alias(f"_k{i}") for i, c in enumerate(_file_place(F.col("_file")))])
    # One row per file, which the listing of the table holds already.
    before = W.orderBy("_k0", "_k1", "_k2", "_k3").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = df.select("*", place.alias("_path"), at.alias("_at"))
    joined = rows.join(small_side(pin(starts)), F.col("_path") == F.col("_file"))
    return joined.select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def register_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """Name a bucketed table that an earlier session has written."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def scan_predictions(spark: SparkSession, path: str | list[str], skip_first: bool = False) -> DataFrame:
    """Prediction CSV with a header, quoted fields may span lines.

    ``skip_first`` leaves out the first data row of every file, as an older
    reader did; the default keeps it.  A file is read by one task; ``splitscan.read_csv``
    reads large ones in parallel.
    """
    df = (
        spark.read.schema(S.PREDICTION)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    if not skip_first:
        # An empty field is an empty prediction, not a missing one.
        return df.withColumn("transcript", F.coalesce("transcript", F.lit("")))
    # A multi-line file is one task, so ids grow in file order from its start.
    tagged = df.select(
        "*", F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_id")
    )
    first = tagged.groupBy("_file").agg(F.min("_id").alias("_id"))
    kept = tagged.join(first, ["_file", "_id"], "left_anti")
    return kept.select("file_id", F.coalesce("transcript", F.lit("")).alias("transcript"))


def stream_corpus(
    spark: SparkSession, root: str, schema: T.StructType, glob: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """A folder of Parquet files as a stream, in batches of bounded file count."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(root)
    )
