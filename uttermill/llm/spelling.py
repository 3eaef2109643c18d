"""Spelling variants: words at one edit, found by composing finite-state machines.

Two words at one edit agree on everything outside a short stretch.  Rows of a group
share all code points before and after such a stretch (its *window*), so a group is
an initial state of the vocabulary's acceptor, with what follows the window as a
common ending.  A task builds the minimised acceptor of its groups and enumerates
the paths of acceptor, one-edit transducer and acceptor from each initial state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttermill.llm.common import ascii_lower, staged
from uttermill.session import small_side

#: Code points of a group, and about those of one machine; a larger group gets narrower windows.
LIMIT = 200_000
_GROUP = ["short", "start", "stop", "head", "tail"]


def runs(text: Column | str, pattern: str) -> Column:
    """All matches of ``pattern`` (without groups) in the text with A-Z lower-cased; a null text has none."""
    return F.regexp_extract_all(ascii_lower(F.col(text) if isinstance(text, str) else text), F.lit(f"({pattern})"), 1)


def vocabulary(docs: DataFrame, words: Column, least: int = 5, often: int = 3) -> DataFrame:
    """(word, n): the words of at least ``least`` code points that occur ``often`` times or more.

    ``words`` is an array for each row.  Counts are combined in each task before the
    shuffle, so a very common word is one row a task.
    """
    each = docs.select(F.explode(words).alias("word"))
    return each.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)


class Machine:
    """Minimised acceptors that share their states, and the search for words one edit apart."""

    def __init__(self) -> None:
        self._known: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.arcs: list[dict[str, int]] = []
        self._meets: dict[tuple[int, int], bool] = {}

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        state = self._known.setdefault(key, len(self.final))
        if state == len(self.final):
            self.final.append(final)
            self.arcs.append(dict(arcs))
        return state

    def accept(self, words: list[str]) -> int:
        """Initial state of the minimal acceptor of sorted distinct ``words``.

        Words are added in order; a state is closed, and merged with an equal one,
        when no later word can pass through it.
        """
        spine: list[tuple[str, list[tuple[str, int]]]] = [("", [])]
        ends = [False]

        def close(depth: int) -> None:
            while len(spine) > depth:
                symbol, arcs = spine.pop()
                spine[-1][1].append((symbol, self._state(ends.pop(), arcs)))

        before = ""
        for word in words:
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            close(same + 1)
            for symbol in word[same:]:
                spine.append((symbol, []))
                ends.append(False)
            ends[-1] = True
            before = word
        close(1)
        return self._state(ends[0], spine[0][1])

    def meets(self, x: int, y: int) -> bool:
        """Whether some word is accepted from both states."""
        known, todo = self._meets, [(x, y)]
        while todo:
            pair = todo[-1]
            if pair in known:
                todo.pop()
                continue
            one, two = self.arcs[pair[0]], self.arcs[pair[1]]
            if pair[0] == pair[1] or (self.final[pair[0]] and self.final[pair[1]]):
                known[pair] = True
                continue
            nexts = [(s, two[c]) for c, s in one.items() if c in two]
            if any(known.get(p) for p in nexts):
                known[pair] = True
                continue
            open_ = [p for p in nexts if p not in known]
            if open_:
                todo.append(open_[0])
            else:
                known[pair] = False
        return known[x, y]

    def common(self, x: int, y: int) -> Iterator[str]:
        """The words accepted from both states."""
        if not self.meets(x, y):
            return
        todo = [(x, y, "")]
        while todo:
            p, q, word = todo.pop()
            if self.final[p] and self.final[q]:
                yield word
            two = self.arcs[q]
            todo += [(s, two[c], word + c) for c, s in self.arcs[p].items() if c in two and self.meets(s, two[c])]

    def near(self, short: int, long: int, last: bool) -> Iterator[tuple[str, str]]:
        """Pairs (u, v) one edit apart: both of the first acceptor, or v, longer by one, of the second.

        The transducer copies symbols in its first state, makes one edit, and copies
        again in its second.  A replacement is met with the smaller symbol on u's side, an
        insertion as far right as it can stand, so every pair has one path.  An insertion at the very end
        belongs to the window that follows, if there is one (``last`` is false).
        """
        todo = [(short, long, "")]
        while todo:
            s, g, word = todo.pop()
            mine = self.arcs[s]
            symbols = sorted(mine)
            for i, a in enumerate(symbols):
                for b in symbols[i + 1 :]:
                    for rest in self.common(mine[a], mine[b]):
                        yield word + a + rest, word + b + rest
            theirs = self.arcs[g] if g >= 0 else {}
            for b, after in theirs.items():
                if last and self.final[s] and self.final[after]:
                    yield word, word + b
                for a, then in self.arcs[after].items():
                    if a != b and a in mine:
                        for rest in self.common(mine[a], then):
                            yield word + a + rest, word + b + a + rest
            todo += [(state, theirs.get(a, -1), word + a) for a, state in mine.items()]


def _pairs(rows: list[dict]) -> list[tuple]:
    """Pairs of near words in whole groups that follow each other, each group sorted."""
    machine, out, first = Machine(), [], 0
    while first < len(rows):
        stop, key = first, [rows[first][k] for k in _GROUP]
        while stop < len(rows) and [rows[stop][k] for k in _GROUP] == key:
            stop += 1
        group, first = rows[first:stop], stop
        width = key[2] - key[1]
        short = [r["middle"] for r in group if r["chars"] == width]
        long = [r["middle"] for r in group if r["chars"] > width]
        if not short or len(group) < 2:
            continue
        head, tail = key[3], key[4]
        n = {r["middle"]: r["n"] for r in group}
        begin = machine.accept(short), machine.accept(long) if long else -1
        out += [(head + u + tail, n[u], head + v + tail, n[v]) for u, v in machine.near(*begin, key[0] == key[2])]
    return out


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows sorted by group; holds the rows of one machine at a time."""
    schema = pa.schema([("a", pa.string()), ("n_a", pa.int64()), ("b", pa.string()), ("n_b", pa.int64())])

    def found(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        pairs = _pairs(rows)
        for i in range(0, len(pairs), 10_000):
            columns = zip(*pairs[i : i + 10_000], strict=True)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    held: list[dict] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh = _starts(batch, held)
        for at, row in enumerate(batch.to_pylist()):
            if fresh[at] and size >= LIMIT:
                yield from found(held)
                held, size = [], 0
            held.append(row)
            size += row["chars"] + 1
    if held:
        yield from found(held)


def _starts(batch: pa.RecordBatch, held: list[dict]) -> np.ndarray:
    """Which rows of the batch begin a group."""
    fresh = np.zeros(batch.num_rows, bool)
    fresh[0] = not held or any(held[-1][k] != batch.column(k)[0].as_py() for k in _GROUP)
    for k in _GROUP:
        values = batch.column(k)
        differs = pa.compute.not_equal(values.slice(1), values.slice(0, batch.num_rows - 1))
        fresh[1:] |= differs.to_numpy(zero_copy_only=False)
    return fresh


def _window(word: str, start: Column, stop: Column, extra: Column, short: Column) -> Column:
    """The row of a word in the window [start, stop) of a class; ``extra`` is 1 for the longer side."""
    text = F.col(word)
    return F.struct(
        short.cast("int").alias("short"), start.cast("int").alias("start"), stop.cast("int").alias("stop"),
        F.substr(text, F.lit(1), start).alias("head"), F.substr(text, stop + extra + 1, F.length(text)).alias("tail"),
        F.substr(text, start + 1, stop + extra - start).alias("middle"), (stop + extra - start).cast("int").alias("chars"),
    )


def _first_windows(vocab: DataFrame) -> DataFrame:
    """Both halves of each word, as the shorter or equal side of its length and the longer side of the one below."""
    def halves(short: Column, extra: int) -> list[Column]:
        half, more = F.floor(short / 2).cast("int"), F.lit(extra)
        return [
            F.when((half > 0) & (short >= 0), _window("word", F.lit(0), half, more, short)),
            F.when(short >= 0, _window("word", half, short, more, short)),
        ]

    length = F.length("word")
    rows = vocab.select("n", F.explode(F.array_compact(F.array(*halves(length, 0), *halves(length - 1, 1)))).alias("w"))
    return rows.select("w.*", "n")


def _narrower(rows: DataFrame) -> DataFrame:
    """Both halves of each row's window."""
    middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
    extra = F.col("chars") - (F.col("stop") - F.col("start"))
    whole = rows.withColumn("_word", F.concat("head", "middle", "tail"))
    parts = F.array(
        _window("_word", F.col("start"), middle, extra, F.col("short")), _window("_word", middle, F.col("stop"), extra, F.col("short")),
    )
    return whole.select("n", F.explode(parts).alias("w")).select("w.*", "n")


def near_pairs(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, n_a, b, n_b): every pair of words of ``vocab`` (word, n) at one edit, once.

    A pair of lengths l and l or l + 1 differs in the first or second half of l code points, so each
    word is a row in two halves of two lengths.  Groups above ``limit`` code points are cut
    into narrower windows until they fit; a window of one code point
    holds at most one word for each symbol or pair of symbols, and is cut no more.
    """
    rows, done = staged(_first_windows(vocab), "windows"), []
    while True:
        sizes = rows.groupBy(*_GROUP).agg(F.sum(F.col("chars") + 1).alias("_size"))
        heavy = staged(sizes.where((F.col("_size") > limit) & (F.col("stop") - F.col("start") > 1)).drop("_size"), "heavy")
        if heavy.isEmpty():
            done.append(rows)
            break
        # At most one heavy group for every ``limit`` code points.
        done.append(rows.join(small_side(heavy), _GROUP, "left_anti").select(*rows.columns))
        rows = staged(_narrower(rows.join(small_side(heavy), _GROUP, "left_semi").select(*rows.columns)), "windows")
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    placed = every.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "middle")
    return placed.mapInArrow(_search, "a string, n_a long, b string, n_b long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows by pointer jumping; chains have no cycles."""
    links = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        other = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        jumped = links.join(other, F.col("root") == F.col("_at"), "left")
        links = staged(jumped.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        # One flag reaches the driver; a form has twice the count, so at most log2 of 64 rounds.
        if links.where("_moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(words: DataFrame, word: str = "word", n: str = "n", factor: float = 2.0, limit: int = LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every distinct word.

    Near words differ by exactly one inserted, deleted or replaced code point.  The
    form is the near word of the largest count (ties: the first in code point order), if that is
    at least ``factor`` times the word's own and above it; else null.  The root is where following forms ends, the
    word itself if it has none.  Counts of repeated words are added up, a null
    count is 0, rows without a word are no words; an empty table gives an empty result.
    Other columns are not read.
    """
    if factor <= 1:
        raise ValueError("a form must be more frequent than its word")
    counted = words.select(F.col(word).alias("word"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("n"))
    vocab = staged(counted.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    pairs = near_pairs(vocab, limit)
    both = F.array(
        F.struct(F.col("a").alias("word"), (-F.col("n_b")).alias("less"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), (-F.col("n_a")).alias("less"), F.col("a").alias("near")),
    )
    each = pairs.select(F.explode(both).alias("p")).select("p.*")
    best = each.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "near")).alias("_best"))
    enough = (-F.col("_best.less") >= F.lit(factor) * F.col("n")) & (-F.col("_best.less") > F.col("n"))
    told = staged(
        vocab.join(best, "word", "left").select(
            "word", F.when(enough, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, -F.col("_best.less")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
