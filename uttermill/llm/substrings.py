"""Substring dedup by super-k-mer partitioning of word windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.llm import words as X

#: Words of a window, words of a minimiser.
WINDOW, MINIMISER = 13, 4
#: Windows that a bucket is meant to hold.
BUCKET = 250_000
#: A minimiser candidate is heavy from this share of all on; so at most 50,000 are.
HEAVY = 1 / 50_000
#: Bytes of packed strings that a task gathers before it sends them.
FLUSH = 16 << 20
_LAST = np.iinfo(np.int64).max
#: Cells of the table that says which keys may repeat.
CELLS = 1 << 16


def _keys(part: pa.RecordBatch) -> np.ndarray:
    """Document ids; a null id counts as larger than any other."""
    return part.column("_key").cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _rows(part: pa.RecordBatch) -> np.ndarray:
    return part.column("_row").to_numpy()


def _planes(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers byte by byte: the high bytes, mostly equal, pack to next to nothing."""
    return b"".join(c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)


def _numbers(raw: bytes, columns: int, n: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, 8 * columns * n).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(columns, n)


def _named(own: DataFrame) -> DataFrame:
    """``own`` with _row, which names a row together with its key: equal rows lose equal words.

    It is a hash of the text for a null key and for keys that repeat (or share a cell of
    a fixed table with one that does), and 0, which packs to nothing, for all others.
    """
    cell = F.pmod(F.xxhash64("_key"), F.lit(CELLS)).cast("int")
    again = own.where("_key is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = again.select(cell.alias("cell")).distinct().toArrow()["cell"].to_numpy()
    several = F.col("_key").isNull()
    if len(found):
        table = np.zeros(CELLS, np.uint8)
        table[found] = 1
        several |= F.lit(bytearray(table.tobytes())).substr(cell + 1, F.lit(1)) == F.lit(bytearray(b"\1"))
    return own.withColumn("_row", F.when(several, F.xxhash64("_text")).otherwise(F.lit(0)).cast("long"))


def _count_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent word runs of each slice with their counts; at 0 the number of windows."""
    for batch in batches:
        for _, body, offsets in X.slices(batch, "_text"):
            first, end, begin = X.spans(body, offsets)
            at, _ = X.windows_per_text(begin, MINIMISER)
            found = np.sort(X.runs(X.hashes(body, first, end), MINIMISER)[at])
            start = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
            n = np.diff(np.append(start, len(found)))
            often = n >= 3
            windows = len(X.windows_per_text(begin, WINDOW)[0])
            value = np.append(found[start[often]].view(np.int64), 0)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(np.append(n[often], windows))], ["value", "n"])


def _groups(first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each window the smallest document that holds the same 128-bit window hash."""
    order = np.lexsort((doc, second, first))
    a, b = first[order], second[order]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, bool)
    least = np.empty(len(doc), np.int64)
    least[order] = doc[order][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    return least


def _stretches(start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of runs of neighbouring windows with equal ``same``."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] != start[:-1] + 1
    for s in same:
        fresh[1:] |= s[1:] != s[:-1]
    at = np.flatnonzero(fresh)
    return at, np.diff(np.append(at, len(start)))


def _pack_windows(buckets: int, heavy: np.ndarray):
    """Task function: super-k-mers of each split, packed per bucket, and windows settled inside a slice."""
    names = ["bucket", "n", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        squeeze, size, turn = zstandard.ZstdCompressor(level=3), 0, 0

        def flush():
            rows = []
            for bucket, parts in held.items():
                *numbers, texts = [np.concatenate(c) for c in zip(*parts, strict=True)]
                rows.append((bucket, len(numbers[0]), squeeze.compress(_planes(*numbers) + texts.tobytes())))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

        for batch in batches:
            for part, body, offsets in X.slices(batch, "_text"):
                first, end, begin = X.spans(body, offsets)
                at, owner = X.windows_per_text(begin, WINDOW)
                if not len(at):
                    continue
                unit = X.hashes(body, first, end)
                doc, row, start = _keys(part)[owner], _rows(part)[owner], at - begin[owner]
                least = _groups(X.runs(unit, WINDOW)[at], X.runs(X.hashes(body, first, end, 2), WINDOW, 2)[at], doc)
                gone = np.flatnonzero(doc > least)
                run_at, run_n = _stretches(start[gone], owner[gone])
                if len(run_at):
                    # Rows that are settled already pass through some bucket unchanged.
                    turn += 1
                    raw = _planes(doc[gone][run_at], row[gone][run_at], start[gone][run_at], run_n)
                    yield pa.RecordBatch.from_arrays([pa.array([turn % buckets]), pa.array([-len(run_at)]), pa.array([squeeze.compress(raw)])], names)
                short = X.runs(unit, MINIMISER)
                place = np.minimum(np.searchsorted(heavy, short), max(len(heavy) - 1, 0))
                weighty = heavy[place] == short if len(heavy) else np.zeros(len(short), bool)
                key = (short >> np.uint64(1)) | (weighty.astype(np.uint64) << np.uint64(63))
                span = len(unit) - WINDOW + 1
                low = key[:span].copy()
                for k in range(1, WINDOW - MINIMISER + 1):
                    np.minimum(low, key[k : k + span], out=low)
                stay = np.flatnonzero(doc == least)
                run_at, run_n = _stretches(start[stay], owner[stay], low[at][stay])
                head = stay[run_at]
                bucket = (X.mix64(low[at][head]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                head, run_n, bucket = head[order], run_n[order], bucket[order]
                # Words with one space after each: a super-k-mer is one stretch of these bytes.
                length = end - first
                tidy = np.concatenate([[0], np.cumsum(length + 1)])
                source = np.repeat(first - tidy[:-1], length + 1) + np.arange(tidy[-1])
                text = np.append(body, np.uint8(32))[source]
                text[tidy[1:] - 1] = 32
                a, size_of = tidy[at[head]], tidy[at[head] + run_n + WINDOW - 1] - tidy[at[head]]
                ends = np.concatenate([[0], np.cumsum(size_of)])
                packed = text[np.repeat(a - ends[:-1], size_of) + np.arange(ends[-1])]
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.array([0])
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    held.setdefault(int(bucket[i]), []).append(
                        (doc[head[i:j]], row[head[i:j]], start[head[i:j]], size_of[i:j], packed[ends[i] : ends[j]])
                    )
                size += len(packed)
                if size > FLUSH:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def _count_windows(table: pa.Table) -> pa.Table:
    """One bucket: unpack, sort all windows, and name those a smaller document holds too."""
    docs, rows, starts, lengths, texts, out = [], [], [], [], [], []
    loose = zstandard.ZstdDecompressor()
    for n, payload in zip(table["n"].to_pylist(), table["payload"], strict=True):
        raw = loose.decompress(payload.as_py())
        k = abs(n)
        numbers = _numbers(raw, 4, k)
        if n < 0:
            out.append(tuple(numbers))
            continue
        for held, column in zip((docs, rows, starts, lengths), numbers, strict=True):
            held.append(column)
        texts.append(np.frombuffer(raw, np.uint8, offset=32 * k))
    if docs:
        body, doc, row, start = np.concatenate(texts), np.concatenate(docs), np.concatenate(rows), np.concatenate(starts)
        first, end, begin = X.spans(body, np.concatenate([[0], np.cumsum(np.concatenate(lengths))]))
        at, owner = X.windows_per_text(begin, WINDOW)
        owned, place = doc[owner], start[owner] + at - begin[owner]
        least = _groups(X.runs(X.hashes(body, first, end), WINDOW)[at], X.runs(X.hashes(body, first, end, 2), WINDOW, 2)[at], owned)
        gone = np.flatnonzero(owned > least)
        run_at, run_n = _stretches(place[gone], owned[gone], row[owner][gone])
        out.append((owned[gone][run_at], row[owner][gone][run_at], place[gone][run_at], run_n))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
    return pa.table([pa.array(c) for c in columns], ["_doc", "_of", "start", "n"])


def _cut(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, body, offsets in X.slices(batch, "_text"):
                first, end, begin = X.spans(body, offsets)
                marks, count, removed, kept = part.column("_marks"), np.diff(begin), [], []
                raw = body.tobytes()
                for i in range(part.num_rows):
                    f, e = first[begin[i] : begin[i + 1]], end[begin[i] : begin[i + 1]]
                    found = marks[i].values
                    if found is None or not len(found):
                        stay = slice(None)
                        removed.append(0)
                    else:
                        s = found.field("start").to_numpy()
                        n = found.field("n").to_numpy() + WINDOW - 1
                        step = np.zeros(count[i] + 1, np.int64)
                        np.add.at(step, np.minimum(s, count[i]), 1)
                        np.add.at(step, np.minimum(s + n, count[i]), -1)
                        covered = np.cumsum(step)[:-1] > 0
                        removed.append(int(covered.sum()))
                        stay = ~covered
                    kept.append(b" ".join([raw[a:b] for a, b in zip(f[stay], e[stay], strict=True)]).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), pa.array(count.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    [key, "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_text) for every row of ``docs``.

    A window is 13 consecutive words of one document.  A word goes if a window
    over it also starts in a document with a smaller key; windows are judged on
    the input.  Kept words are joined by one space.

    Neighbouring windows with one minimiser (the smallest hash of four words in
    them) travel as one packed string, a super-k-mer, to the minimiser's bucket,
    which sorts all its windows by 128-bit hashes of their 13 words.  Before that each slice of a split settles its own
    repeats: only windows of the smallest document in it travel.  So a passage
    that a third of all documents share leaves a slice once.  Word runs that are
    frequent in the corpus (at most 50,000) are minimisers only where a window has no other,
    so that the various surroundings of such a passage spread over the buckets.
    The number of buckets follows the number of windows.

    Keys are integers.  A null key counts as larger than any other.  Keys only say which
    document is smaller: rows with one key, or with null, remove nothing from each other, and
    each loses what its own windows repeat.  Where keys repeat, a row is named by its key and a
    64-bit hash of its text.  Null texts have no word; texts under 13 words lose
    none.  An empty table gives an empty result.
    """
    own = _named(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")))
    seen = own.mapInArrow(_count_candidates, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    windows = seen.where("value = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = seen.where((F.col("value") != 0) & (F.col("n") >= max(HEAVY * windows, 16.0))).select("value").toArrow()
    heavy = np.sort(often["value"].to_numpy().view(np.uint64))
    buckets = max(1, -(-windows // BUCKET))
    sent = own.mapInArrow(_pack_windows(buckets, heavy), "bucket long, n long, payload binary")
    marks = sent.groupBy("bucket").applyInArrow(lambda table: _count_windows(table), "_doc long, _of long, start long, n long")
    per = marks.groupBy("_doc", "_of").agg(F.collect_set(F.struct("start", "n")).alias("_marks"))
    same = (F.coalesce(own["_key"].cast("long"), F.lit(int(_LAST))) == per["_doc"]) & (own["_row"] == per["_of"])
    joined = own.join(per, same, "left").select("_key", "_text", "_marks")
    kind = docs.schema[key].dataType.simpleString()
    return joined.mapInArrow(_cut(key), f"`{key}` {kind}, n_words long, n_removed long, kept_text string")
