"""Large quoted CSV files and large JSON objects, read by as many tasks as they have splits.

Spark's text source cuts a file into byte ranges and gives each task the pieces between
two separators that begin in its range.  With the line feed as separator the pieces
are lines, with the quotation mark they are what lies inside and outside of JSON
strings.  Whether a split begins inside a quoted field or a string, and how deep in a JSON value,
follows from a summary of every split before it: the summaries are one small row a
split, combined in order.  With that state each task cuts its own range into records;
only the ends that reach over a split bound are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttermill.session import small_side

#: Splits whose start states are broadcast: about 100 bytes each, and one for every 128 MB of input.
SPLITS = 2_000_000
_SPLIT = ["file", "split"]
#: What a task cuts out: a whole record, the end of one begun before the split, the begin of one that goes on.
WHOLE, TAIL, OPEN = 0, 1, 2
#: Lines that are no record where no field is open.
_BLANK = ("", "\r")
_RECORD = "file string, split long, seq long, kind int, record string"
_SUMMARY = "file string, split long, filled int, odd long, even_depth long, odd_depth long"


def _pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """(file, split, piece); the pieces of a split are in order inside their task."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("piece")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Stretches of a batch that belong to one split."""
    if not batch.num_rows:
        return
    files, splits = batch.column("file"), batch.column("split")
    n = batch.num_rows
    new = pc.or_(pc.not_equal(files.slice(1), files.slice(0, n - 1)), pc.not_equal(splits.slice(1), splits.slice(0, n - 1)))
    bounds = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist(), n]
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield (files[a].as_py(), splits[a].as_py()), batch.slice(a, b - a)


def _after(flips: np.ndarray, state: int) -> np.ndarray:
    """State before each piece and after the last, where ``flips`` tells which pieces end in a change."""
    return np.concatenate([[0], np.cumsum(flips, dtype=np.int64)]) + state & 1


# --- states of the splits -----------------------------------------------------


def _csv_summaries(lines: DataFrame, quote: str) -> DataFrame:
    """Of each split: the parity of its quotation marks, and whether any line has content."""
    marks = F.length("piece") - F.length(F.replace("piece", F.lit(quote)))
    odd = (F.sum(marks.cast("bigint")) % 2).alias("odd")
    filled = F.max((~F.col("piece").isin(*_BLANK)).cast("int")).alias("filled")
    none = [F.lit(0).cast("bigint").alias(f"{c}_depth") for c in ("even", "odd")]
    return lines.groupBy(*_SPLIT).agg(odd, filled).select("*", *none)


def _json_flips(pieces: pa.Array) -> np.ndarray:
    """Which pieces end at a quotation mark that is not escaped."""
    escaped = pc.match_substring_regex(pieces, r"(?:^|[^\\])(?:\\\\)*\\$")
    return ~escaped.to_numpy(zero_copy_only=False)


def _depths(pieces: pa.Array) -> np.ndarray:
    """Opened minus closed brackets in each piece."""
    total = np.zeros(len(pieces), np.int64)
    for bracket, by in (("{", 1), ("[", 1), ("}", -1), ("]", -1)):
        total += by * pc.count_substring(pieces, bracket).to_numpy(zero_copy_only=False)
    return total


def _json_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: whether it turns the state, and its depth for either state at its begin."""
    def row(key: tuple[str, int], odd: int, depths: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"file": key[0], "split": key[1], "filled": 1, "odd": odd, "even_depth": depths[0], "odd_depth": depths[1]}],
            pa.schema([("file", pa.string()), ("split", pa.int64()), ("filled", pa.int32()), *[(c, pa.int64()) for c in ("odd", "even_depth", "odd_depth")]]),
        )

    at, odd, depths = None, 0, [0, 0]
    for batch in batches:
        for key, part in _runs(batch):
            if key != at:
                if at is not None:
                    yield row(at, odd, depths)
                at, odd, depths = key, 0, [0, 0]
            pieces = part.column("piece")
            inside = _after(_json_flips(pieces), odd)
            depth = _depths(pieces)
            for state in (0, 1):
                depths[state] += int(depth[inside[:-1] == state].sum())
            odd = int(inside[-1])
    if at is not None:
        yield row(at, odd, depths)


def _starts(summaries: DataFrame) -> DataFrame:
    """(file, split, state, depth, first) of each split, by a window over one row a split.

    ``state`` and ``depth`` hold at its begin; ``first`` marks the first split of a file with any content.
    """
    before = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    named = summaries.withColumnsRenamed({"file": "_file", "split": "_split"})
    state = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    turned = named.withColumn("state", state)
    mine = F.when(F.col("state") == 0, F.col("even_depth")).otherwise(F.col("odd_depth"))
    deep = turned.withColumn("_depth", mine)
    empty = F.coalesce(F.max("filled").over(before), F.lit(0)) == 0
    return deep.select(
        "_file", "_split", "state", F.coalesce(F.sum("_depth").over(before), F.lit(0)).alias("depth"),
        (empty & (F.col("filled") == 1)).alias("first"),
    )


def _with_state(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with the state of their split, still in order."""
    same = (F.col("file") == F.col("_file")) & (F.col("split") == F.col("_split"))
    columns = [*_SPLIT, "piece", "state", "depth", "first"]
    if starts.limit(SPLITS + 1).count() <= SPLITS:
        return pieces.join(F.broadcast(starts), same).select(*columns)
    # More splits than fit a broadcast: meet by split, then restore the order.
    numbered = pieces.withColumn("_id", F.monotonically_increasing_id()).join(starts, same)
    return numbered.repartition(*_SPLIT).sortWithinPartitions(*_SPLIT, "_id").select(*columns)


# --- cutting ------------------------------------------------------------------


def _records(key: tuple[str, int], seq: int, kind: int, records: list[str]) -> pa.RecordBatch:
    n = len(records)
    return pa.record_batch(
        [
            pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(range(seq, seq + n), pa.int64()),
            pa.array([kind] * n, pa.int32()), pa.array(records, pa.string()),
        ],
        names=["file", "split", "seq", "kind", "record"],
    )


class _Cutter:
    """Cuts the pieces of one split, fed in order, into records."""

    def __init__(self, key: tuple[str, int], state: int, depth: int, first: bool, separator: str, in_record: bool) -> None:
        self.key, self.state, self.depth, self.separator = key, state, depth, separator
        #: Pieces of the record that is open, None between two records.
        self.open: list[str] | None = [] if in_record else None
        #: Whether that record began before this split.
        self.early = in_record
        #: The first record of a file has the number -1.
        self.seq = -1 if first else 0

    def _out(self, kind: int, records: list[str]) -> Iterator[pa.RecordBatch]:
        if records:
            yield _records(self.key, self.seq, kind, records)
            self.seq += len(records)

    def _close(self, last: list[str]) -> Iterator[pa.RecordBatch]:
        record = self.separator.join([*(self.open or []), *last])
        yield from self._out(TAIL if self.early else WHOLE, [record])
        self.open, self.early = None, False

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.open is not None:
            yield from self._out(TAIL if self.early else OPEN, [self.separator.join(self.open)])


class _CsvCutter(_Cutter):
    """A record ends at a line end outside of quotation marks."""

    def __init__(self, key: tuple[str, int], state: int, depth: int, first: bool, quote: str) -> None:
        super().__init__(key, state, depth, first, "\n", bool(state))
        self.quote = quote

    def feed(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        marks = pc.count_substring(lines, self.quote).to_numpy(zero_copy_only=False)
        states = _after(marks & 1, self.state)
        self.state = int(states[-1])
        ends = np.flatnonzero(states[1:] == 0) + 1
        if not len(ends):
            self.open = [*(self.open or []), *lines.to_pylist()]
            return
        first = 0
        if self.open is not None:
            first = int(ends[0])
            yield from self._close(lines.slice(0, first).to_pylist())
            ends = ends[1:]
        if len(ends):
            bounds = np.concatenate([[first], ends]).astype(np.int32)
            whole = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines)
            yield from self._out(WHOLE, [r for r in pc.binary_join(whole, "\n").to_pylist() if r not in _BLANK])
            first = int(ends[-1])
        if first < len(lines):
            self.open = lines.slice(first).to_pylist()


class _JsonCutter(_Cutter):
    """An entry of the outer object ends at a comma, or its brackets, at depth 1 outside of strings."""

    def __init__(self, key: tuple[str, int], state: int, depth: int, first: bool) -> None:
        # What stands before the outer object, or after it, counts as an entry and is blank.
        super().__init__(key, state, depth, False, '"', True)

    def feed(self, pieces: pa.Array) -> Iterator[pa.RecordBatch]:
        states = _after(_json_flips(pieces), self.state)
        outside = states[:-1] == 0
        change = np.where(outside, _depths(pieces), 0)
        depth = self.depth + np.concatenate([[0], np.cumsum(change)])
        comma = pc.match_substring(pieces, ",").to_numpy(zero_copy_only=False) & (depth[:-1] == 1)
        bracket = pc.match_substring_regex(pieces, r"[\[\]{}]").to_numpy(zero_copy_only=False)
        self.state, self.depth = int(states[-1]), int(depth[-1])
        texts = pieces.to_pylist()
        done: list[str] = []
        first = 0
        for at in np.flatnonzero(outside & (comma | bracket)).tolist():
            parts = self._split(texts[at], int(depth[at]))
            if len(parts) == 1:
                continue
            before = [*texts[first:at], parts[0]]
            if self.early:
                yield from self._close(before)
            else:
                done.append(self.separator.join([*(self.open or []), *before]))
            done += parts[1:-1]
            # What follows the cut is the first part of the next entry.
            texts[at], first, self.open = parts[-1], at, None
        yield from self._out(WHOLE, done)
        self.open = [*(self.open or []), *texts[first:]]

    @staticmethod
    def _split(text: str, depth: int) -> list[str]:
        """A piece outside of strings, cut where the outer object opens, closes or goes on."""
        parts, begin = [], 0
        for i, c in enumerate(text):
            cut = c == "," and depth == 1
            if c in "{[":
                cut = depth == 0
                depth += 1
            elif c in "}]":
                depth -= 1
                cut = depth == 0
            if cut:
                parts.append(text[begin:i])
                begin = i + 1
        return [*parts, text[begin:]]


def _cut(make: Callable[..., _Cutter]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = None
        for batch in batches:
            for key, part in _runs(batch):
                if cutter is None or cutter.key != key:
                    if cutter is not None:
                        yield from cutter.finish()
                    cutter = make(key, *[part.column(c)[0].as_py() for c in ("state", "depth", "first")])
                yield from cutter.feed(part.column("piece"))
        if cutter is not None:
            yield from cutter.finish()

    return run


def _stitched(cut: DataFrame, separator: str) -> DataFrame:
    """Whole records, those over split bounds put together; (file, split, seq) is the place of the begin."""
    ends = cut.where(F.col("kind") != WHOLE)
    # At most two rows a split.  A begin and the ends up to the next begin are one record.
    upto = W.partitionBy("file").orderBy("split", "seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    owned = ends.withColumn("_owner", F.sum((F.col("kind") == OPEN).cast("int")).over(upto))
    parts = F.sort_array(F.collect_list(F.struct("split", "seq", "record")))
    joined = owned.groupBy("file", "_owner").agg(parts.alias("_parts"))
    whole = joined.select(
        "file", F.col("_parts")[0]["split"].alias("split"), F.col("_parts")[0]["seq"].alias("seq"),
        F.array_join(F.transform("_parts", lambda p: p["record"]), separator).alias("record"),
    )
    return cut.where(F.col("kind") == WHOLE).select("file", "split", "seq", "record").unionByName(whole)


# --- readers ------------------------------------------------------------------


def csv_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, split, seq, record) of CSV files whose quoted fields may span lines.

    (split, seq) ascends with the place in the file; the first record of a file has
    the ``seq`` -1.  Quotation marks stand around fields only, and inside of them
    doubled.  Blank lines between records are left out.
    """
    lines = _pieces(spark, path, "\n")
    states = _with_state(lines, _starts(_csv_summaries(lines, quote)))
    cut = states.mapInArrow(_cut(lambda *start: _CsvCutter(*start, quote)), _RECORD)
    return _stitched(cut, "\n")


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool = True, skip_first: bool = False, quote: str = '"'
) -> DataFrame:
    """CSV files with quoted multi-line fields as rows of ``schema``, read in parallel.

    Gives the rows of Spark's multi-line reader with doubled quotes, which reads a file in one task.
    ``header`` leaves out the first record of every file, ``skip_first`` one more.
    """
    records = csv_records(spark, path, quote)
    if header:
        records = records.where(F.col("seq") >= 0)
    if skip_first:
        # Where the first record of a file that is left begins; this reads the input once more.
        place = F.struct("split", "seq")
        lowest = records.groupBy(F.col("file").alias("_in")).agg(F.min(place).alias("_first"))
        records = records.join(small_side(lowest), F.col("file") == F.col("_in")).where(place > F.col("_first"))
    options = {"escape": quote, "quote": quote, "multiLine": "true", "mode": "PERMISSIVE"}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.regexp_replace("record", r"\r$", ""), fields, options)
    return records.select(parsed.alias("row")).select("row.*")


def json_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, seq, record) of the entries ``"key": value`` of one JSON object per file."""
    pieces = _pieces(spark, path, '"')
    states = _with_state(pieces, _starts(pieces.mapInArrow(_json_summaries, _SUMMARY)))
    cut = states.mapInArrow(_cut(_JsonCutter), _RECORD)
    return _stitched(cut, '"').where(F.regexp_like("record", F.lit(r"\S")))


def read_json_map(spark: SparkSession, path: str | list[str], value_type: str = "string") -> DataFrame:
    """A JSON object per file as (key, value) rows; of repeated keys in a file the last one wins.

    An entry that is no JSON fails the job.
    """
    entries = json_entries(spark, path)
    parsed = F.from_json(F.concat(F.lit("{"), "record", F.lit("}")), f"map<string,{value_type}>")
    bad = F.raise_error(F.concat(F.lit("no JSON entry: "), F.substring("record", 1, 200)))
    pairs = entries.select("file", F.struct("split", "seq").alias("_at"), F.explode(F.coalesce(parsed, bad.cast(f"map<string,{value_type}>"))))
    last = pairs.groupBy("file", "key").agg(F.max_by("value", "_at").alias("value"))
    return last.select("key", "value")
