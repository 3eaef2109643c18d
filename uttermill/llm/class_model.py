"""LM scoring with a Brown class-based bigram model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttermill.llm import words as X
from uttermill.llm.common import staged

#: Words whose classes are exchanged first, groups that stand for all others meanwhile, classes.
HEADS, SHAPES, CLASSES = 1024, 1024, 64
UNITS = HEADS + SHAPES
#: Sweeps over the first words, and over all words.
SWEEPS, WORD_SWEEPS = 6, 1
#: Added to every count, as in the base score.
DELTA = 0.1
#: Weight of the class model against the word model, and of class pairs' backing-off.
SHARE, BACK = 0.85, 5.0
#: Bytes of text in one chunk.
CHUNK = 1 << 20
#: The end of a text, as a word hash.
END_HASH = np.uint64(0x5851F42D4C957F2D)
#: Rows of unit counts that one group adds up.
BLOCKS = 64
#: Class counts beside words that are compared with all classes at a time.
SLICE = 1 << 14


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte by byte plane, as high bytes are mostly zero."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(payload: bytes, *parts: tuple[str, int]) -> list[np.ndarray]:
    raw, offset, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8), 0, []
    for kind, n in parts:
        size = np.dtype(kind).itemsize
        block = raw[offset : offset + n * size].reshape(size, n).T
        out.append(np.ascontiguousarray(block).view(kind).reshape(-1))
        offset += n * size
    return out


def _steps(words: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, which have fewer bytes."""
    return np.diff(words, prepend=np.uint64(0))


def _shapes(body: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group of a word by its last three bytes, which carry its ending."""
    tail = np.maximum(end - 3, first)
    return (X.hashes(body, tail, end, 5) % np.uint64(SHAPES)).astype(np.uint16)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of texts as numbers: sorted distinct word hashes, and each token's place among them."""
    turn, part_id = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        for part, body, offsets in X.slices(batch, "_text", CHUNK):
            low = X.lowered(body)
            first, end, begin = X.spans(low, offsets)
            n = np.diff(begin)
            unit = X.hashes(low, first, end)
            shape = _shapes(low, first, end)
            # Every text ends with one more token.
            at = begin[1:]
            tokens, shape = np.insert(unit, at, END_HASH), np.insert(shape, at, 0)
            learn = np.repeat(~np.asarray(part.column("held_out").to_pylist(), bool), n + 1)
            words, example, place = np.unique(tokens, return_index=True, return_inverse=True)
            place = place.reshape(-1)
            counts = np.bincount(place[learn], minlength=len(words)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part_id + turn]), pa.array([len(words)]),
                    pa.array([_pack(_steps(words), counts, shape[example])]),
                    pa.array([_pack(place.astype(np.uint32))]),
                    pa.array([(n + 1).tolist()], pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("_key")),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("held_out")),
                ],
                ["chunk", "n", "vocabulary", "tokens", "sizes", "keys", "held_out"],
            )
            turn += 1


def _vocabulary(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, counts, shapes) of a chunk."""
    steps, counts, shapes = _unpack(row["vocabulary"], ("<u8", row["n"]), ("<u4", row["n"]), ("<u2", row["n"]))
    return np.cumsum(steps, dtype=np.uint64), counts, shapes


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of the words that make at least one in 65,536 tokens of a split."""
    held, pending = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        words, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(place.reshape(-1), weights=np.concatenate([n for _, n in held]), minlength=len(words)).astype(np.int64)

    for batch in batches:
        for row in batch.to_pylist():
            words, counts, _ = _vocabulary(row)
            held.append((words, counts))
            pending += len(words)
            if pending > 1 << 21:
                held, pending = [merged()], 0
    words, counts = merged()
    often = (counts > 0) & (counts * 65536 >= counts.sum())
    yield pa.RecordBatch.from_arrays([pa.array(words[often].view(np.int64)), pa.array(counts[often])], ["word", "n"])


def _is_head(words: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return heads[np.minimum(np.searchsorted(heads, words), len(heads) - 1)] == words


def _units(words: np.ndarray, shapes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Unit of each word: its own for a head (``heads`` sorted), else the one of its shape."""
    return np.where(_is_head(words, heads), np.searchsorted(heads, words), shapes.astype(np.int64) + HEADS)


def _neighbours(row: dict, value: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value before, value, place) of the training tokens of a chunk; ``end`` stands before a text."""
    place = _unpack(row["tokens"], ("<u4", sum(row["sizes"])))[0]
    here = value[place]
    before = np.concatenate([[end], here[:-1]])
    learn = np.repeat(~np.array(row["held_out"], bool), np.array(row["sizes"], np.int64))
    # Each text ends with the end token, so the one before a text's first is that one.
    return before[learn], here[learn], place[learn]


def _bigrams(heads: np.ndarray):
    """Counts of neighbouring units in the training texts of a split, by blocks of left units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.zeros(UNITS * UNITS, np.uint32)
        end = int(np.searchsorted(heads, END_HASH))
        for batch in batches:
            for row in batch.to_pylist():
                words, _, shapes = _vocabulary(row)
                before, here, _ = _neighbours(row, _units(words, shapes, heads), end)
                pair = np.sort(before * UNITS + here)
                at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.empty(0, np.int64)
                matrix[pair[at]] += np.diff(np.append(at, len(pair))).astype(np.uint32)
        square = matrix.reshape(UNITS, UNITS)
        for block in range(BLOCKS):
            flat = square[block::BLOCKS].reshape(-1)
            at = np.flatnonzero(flat)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([len(at)]), pa.array([_pack(at.astype(np.uint32), flat[at])])], ["block", "n", "payload"]
                )

    return run


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(UNITS // BLOCKS * UNITS, np.int64)
    for n, payload in zip(table["n"].to_pylist(), table["payload"], strict=True):
        at, count = _unpack(payload.as_py(), ("<u4", n), ("<u4", n))
        total[at] += count
    return pa.table({"block": table["block"].slice(0, 1), "payload": pa.array([_pack(total)], pa.binary())})


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit by the exchange algorithm.

    In turn, from the most frequent on, a unit leaves its class and joins the one
    that raises the likelihood of the class bigrams most; a sweep without a move ends it.
    """
    pairs = pairs.astype(np.float64)
    size = pairs.sum(0)
    order = np.argsort(-size, kind="stable")
    member = np.empty(len(pairs), np.int64)
    member[order] = np.arange(len(pairs)) % classes
    one = np.eye(classes)[member]
    table = one.T @ pairs @ one
    spread_r, spread_l = pairs @ one, (one.T @ pairs).T
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not size[u] and not pairs[u].any():
                continue
            old, own = member[u], pairs[u, u]
            right, left = spread_r[u].copy(), spread_l[u].copy()
            right[old] -= own
            left[old] -= own
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own
            rows, columns = table.sum(1), table.sum(0)
            gain = (_xlogx(table + right) - _xlogx(table)).sum(1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(1)
            inner = np.diag(table)
            gain += _xlogx(inner + right + left + own) - _xlogx(inner + right) - _xlogx(inner + left) + _xlogx(inner)
            gain -= _xlogx(rows + right.sum() + own) - _xlogx(rows) + _xlogx(columns + left.sum() + own) - _xlogx(columns)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            if new != old:
                moved += 1
                member[u] = new
                spread_r[:, old] -= pairs[:, u]
                spread_r[:, new] += pairs[:, u]
                spread_l[:, old] -= pairs[u]
                spread_l[:, new] += pairs[u]
        if not moved:
            break
    return member


def best_classes(pairs: np.ndarray, member: np.ndarray, word: np.ndarray, beside: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of each word after one exchange against the class bigrams ``pairs``.

    ``member`` holds the words' classes.  ``word`` (sorted places in ``member``), ``beside`` and ``n`` are
    counts of the classes beside them: class c after the word is c, before it ``CLASSES + c``.
    Every word is taken out of its class and put where the likelihood of the class bigrams rises most;
    all words see the same table.
    """
    pairs = pairs.astype(np.float64)
    rows, columns = pairs.sum(1), pairs.sum(0)
    base = np.concatenate([pairs.T, pairs])
    flat = _xlogx(base)
    out = member.astype(np.int64).copy()
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(word))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, side="right")))
        part, cuts = slice(starts[at], ends[to - 1]), starts[at:to] - starts[at]
        own = word[starts[at:to]]
        old = out[own]
        side, count = beside[part].astype(np.int64), n[part].astype(np.float64)
        each, entry = np.arange(len(own)), np.arange(len(side))
        left_at = old[np.repeat(each, np.diff(np.append(cuts, len(side))))]
        change = _xlogx(base[side] + count[:, None]) - flat[side]
        was = base[side, left_at]
        change[entry, left_at] = _xlogx(was) - _xlogx(np.maximum(was - count, 0))
        gain = np.add.reduceat(change, cuts)
        for total, these in ((rows, side < CLASSES), (columns, side >= CLASSES)):
            size = np.add.reduceat(np.where(these, count, 0.0), cuts)
            move = _xlogx(total + size[:, None]) - _xlogx(total)
            move[each, old] = _xlogx(total[old]) - _xlogx(np.maximum(total[old] - size, 0))
            gain -= move
        best = gain.argmax(1)
        out[own] = np.where(gain[each, best] > gain[each, old] + 1e-9, best, old)
        at = to
    return out


def _ask(buckets: int, heads: np.ndarray, class_of: np.ndarray):
    """The distinct words of every chunk with the classes beside them, cut by hash range.

    Equal words meet in one bucket.  Heads have their class already and send counts only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
        end = int(class_of[np.searchsorted(heads, END_HASH)])
        for batch in batches:
            for row in batch.to_pylist():
                words, counts, shapes = _vocabulary(row)
                kind = class_of[_units(words, shapes, heads)] if row["known"] is None else _unpack(row["known"], ("<u4", row["n"]), ("u1", row["n"]))[1].astype(np.int64)
                before, here, place = _neighbours(row, kind, end)
                own = ~_is_head(words, heads)[place]
                # Only the end token, a head, has nothing after it.
                after = np.append(here[1:], 0)
                seen = np.concatenate([place[own].astype(np.int64) * 2 * CLASSES + after[own], place[own].astype(np.int64) * 2 * CLASSES + CLASSES + before[own]])
                seen, n = np.unique(seen, return_counts=True)
                of, beside = seen // (2 * CLASSES), (seen % (2 * CLASSES)).astype(np.uint8)
                per = np.bincount(of, minlength=len(words)).astype(np.uint8)
                cuts = np.concatenate([[0], np.searchsorted(words, edges), [len(words)]])
                inner = np.searchsorted(of, cuts)
                some = np.flatnonzero(np.diff(cuts))
                rows = []
                for b in some:
                    w, e = slice(cuts[b], cuts[b + 1]), slice(inner[b], inner[b + 1])
                    rows.append(_pack(_steps(words[w]), counts[w], kind[w].astype(np.uint8), per[w], beside[e], n[e].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), row["chunk"])), pa.array(some), pa.array(np.diff(cuts)[some]), pa.array(np.diff(inner)[some]), pa.array(rows, pa.binary())],
                    ["chunk", "bucket", "n", "m", "payload"],
                )

    return run


def _answer(pairs: np.ndarray):
    """One bucket: corpus counts and classes of its words, sent back per chunk; its sums by class under chunk -1."""

    def run(table: pa.Table) -> pa.Table:
        asked = []
        for n, m, payload in zip(table["n"].to_pylist(), table["m"].to_pylist(), table["payload"], strict=True):
            asked.append(_unpack(payload.as_py(), ("<u8", n), ("<u4", n), ("u1", n), ("u1", n), ("u1", m), ("<u4", m)))
            asked[-1][0] = np.cumsum(asked[-1][0], dtype=np.uint64)
        words, counts, kinds, per, beside, n = (np.concatenate(c) for c in zip(*asked, strict=True))
        distinct, example, place = np.unique(words, return_index=True, return_inverse=True)
        place = place.reshape(-1)
        total = np.bincount(place, weights=counts).astype(np.int64)
        # Equal (word, class beside) of all chunks become one count.
        entry = np.repeat(place, per) * (2 * CLASSES) + beside
        entry, back = np.unique(entry, return_inverse=True)
        n = np.bincount(back.reshape(-1), weights=n, minlength=len(entry))
        best = best_classes(pairs, kinds[example], entry // (2 * CLASSES), entry % (2 * CLASSES), n)
        rows, offset = [], 0
        for w, *_ in asked:
            at = place[offset : offset + len(w)]
            rows.append(_pack(total[at].astype(np.uint32), best[at].astype(np.uint8)))
            offset += len(w)
        types = np.bincount(best[total > 0], minlength=CLASSES)
        mass = np.bincount(best, weights=total, minlength=CLASSES).astype(np.int64)
        bucket = table["bucket"][0].as_py()
        return pa.table(
            {
                "chunk": pa.array([*table["chunk"].to_pylist(), -1], pa.int64()), "bucket": pa.array([bucket] * (len(rows) + 1), pa.int64()),
                "n": pa.array([*table["n"].to_pylist(), CLASSES], pa.int64()), "payload": pa.array([*rows, _pack(types, mass)], pa.binary()),
            }
        )

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Types and tokens of each class in the buckets of a split."""
    total = np.zeros((2, CLASSES), np.int64)
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            total += np.array(_unpack(payload, ("<i8", CLASSES), ("<i8", CLASSES)))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total[0]), pa.array(total[1])], ["kind", "types", "mass"])


def _join(left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk with the corpus counts and classes of its words."""
    replies = right.sort_by("bucket")
    parts = [_unpack(p.as_py(), ("<u4", n), ("u1", n)) for n, p in zip(replies["n"].to_pylist(), replies["payload"], strict=True)]
    known = _pack(*[np.concatenate(c) for c in zip(*parts, strict=True)])
    return left.append_column("known", pa.array([known] * left.num_rows, pa.binary()))


def _class_bigrams(end_class: int):
    """Counts of neighbouring classes in the training texts of a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                kind = _unpack(row["known"], ("<u4", row["n"]), ("u1", row["n"]))[1].astype(np.int64)
                before, here, _ = _neighbours(row, kind, end_class)
                total += np.bincount(before * CLASSES + here, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "n"])

    return run


def fit(chunks: DataFrame, buckets: int, word_sweeps: int = WORD_SWEEPS, first: int = HEADS) -> tuple[DataFrame, dict]:
    """Chunks with the counts and classes of their words, and the model's bounded tables.

    ``first`` words, :data:`HEADS` at most, are exchanged before all others.
    """
    often = chunks.select("n", "vocabulary").mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = often.orderBy(F.desc("n"), "word").limit(min(first, HEADS) - 1).toArrow()["word"].to_numpy().view(np.uint64)
    heads = np.unique(np.append(top, END_HASH))
    sent = chunks.select("n", "vocabulary", "tokens", "sizes", "held_out").mapInArrow(_bigrams(heads), "block long, n long, payload binary")
    units = np.zeros((UNITS, UNITS), np.int64)
    for row in sent.groupBy("block").applyInArrow(lambda t: _add(t), "block long, payload binary").toLocalIterator():
        units[row["block"] :: BLOCKS] = _unpack(row["payload"], ("<i8", UNITS // BLOCKS * UNITS))[0].reshape(-1, UNITS)
    class_of = exchange(units)
    one = np.eye(CLASSES)[class_of]
    pairs = one.T @ units @ one
    end_class = int(class_of[np.searchsorted(heads, END_HASH)])
    coded = chunks.withColumn("known", F.lit(None).cast("binary"))
    for turn in range(word_sweeps):
        asked = coded.select("chunk", "n", "vocabulary", "tokens", "sizes", "held_out", "known")
        asked = asked.mapInArrow(_ask(buckets, heads, class_of), "chunk long, bucket long, n long, m long, payload binary")
        answered = staged(asked.groupBy("bucket").applyInArrow(_answer(pairs), "chunk long, bucket long, n long, payload binary"), "answers")
        kept = [c for c in chunks.columns if c != "vocabulary" or turn + 1 < word_sweeps]
        shape = ", ".join(f"{c} {chunks.schema[c].dataType.simpleString()}" for c in kept) + ", known binary"
        replies = answered.where("chunk >= 0").select("chunk", "bucket", "n", "payload")
        coded = staged(chunks.select(*kept).groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(lambda a, b: _join(a, b), shape), "coded")
        # One row per pair of classes.
        cells = coded.select("n", "tokens", "sizes", "held_out", "known").mapInArrow(_class_bigrams(end_class), "cell long, n long")
        table = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        pairs = np.zeros(CLASSES * CLASSES)
        pairs[table["cell"].to_numpy()] = table["n"].to_numpy()
        pairs = pairs.reshape(CLASSES, CLASSES)
    sums = answered.where("chunk = -1").select("payload").mapInArrow(_sums, "kind long, types long, mass long")
    sums = sums.groupBy("kind").agg(F.sum("types").alias("types"), F.sum("mass").alias("mass")).toArrow()
    class_types, class_total = np.zeros(CLASSES), np.zeros(CLASSES)
    class_types[sums["kind"].to_numpy()], class_total[sums["kind"].to_numpy()] = sums["types"].to_numpy(), sums["mass"].to_numpy()
    total, types = int(class_total.sum()), int(class_types.sum())
    room = class_total + DELTA * (class_types + 1)
    share = room / (total + DELTA * (types + CLASSES))
    steps = (pairs + BACK * share) / (pairs.sum(1, keepdims=True) + BACK)
    unknown = DELTA / room
    # An unknown word comes from any class, and is followed as the classes it may be of.
    steps = np.concatenate([steps, (steps @ unknown)[:, None]], 1)
    steps = np.concatenate([steps, (share * unknown / (share @ unknown))[None] @ steps])
    return coded, {"total": total, "types": types, "room": room, "steps": steps, "end_class": end_class}


def _score(key: str, model: dict):
    """Scores of the texts of chunks from their tokens and the counts and classes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(batch.select(["n", "tokens", "sizes", "known"]).to_pylist()):
                count, kind = _unpack(row["known"], ("<u4", row["n"]), ("u1", row["n"]))
                count, kind = count.astype(np.float64), np.where(count > 0, kind, CLASSES)
                sizes = np.array(row["sizes"])
                token = _unpack(row["tokens"], ("<u4", int(sizes.sum())))[0]
                starts = np.cumsum(sizes) - sizes
                plain = (count + DELTA) / (model["total"] + DELTA * (model["types"] + 1))
                emit = np.where(kind < CLASSES, (count + DELTA) / np.append(model["room"], 1.0)[kind], 1.0)
                here = kind[token]
                before = np.concatenate([[0], here[:-1]])
                before[starts] = model["end_class"]
                chance = SHARE * model["steps"][before, here] * emit[token] + (1 - SHARE) * plain[token]
                sums = [np.add.reduceat(x, starts) for x in ((count[token] > 0).astype(np.int64), np.log10(plain)[token], np.log10(chance))]
                keys, held = batch.column("keys").slice(at, 1).flatten(), batch.column("held_out").slice(at, 1).flatten()
                total = pa.array(np.full(len(sizes), model["total"], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [keys, held, pa.array(sizes), pa.array(sums[0]), total, pa.array(sums[1]), pa.array(sums[2])],
                    [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged chunks of all texts as numbers."""
    held = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("_key"), held.alias("held_out"), F.col(text).alias("_text"))
    shape = f"chunk long, n long, vocabulary binary, tokens binary, sizes array<long>, keys array<{kind}>, held_out array<boolean>"
    return staged(own.mapInArrow(_encode, shape), "chunks")


def class_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", word_sweeps: int = WORD_SWEEPS, first: int = HEADS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    The model learns from rows whose crc32(key as text) mod 10 is not 0.  Words are
    lower-cased (A-Z); every text has one end token more.  The probability of a
    token is 0.85 times that of its class after the class before it times that of the
    word in its class, plus 0.15 times the word model of the base score.  All
    counts are smoothed.  An unknown word may come from any class; after each class the
    probabilities of all known words and one unknown word add up to one.

    Exchange clustering starts with the 1,024 most frequent words and 1,024 groups that stand for all
    others, by their ending, on the counts of all neighbours.  Then every other word is exchanged on
    its own: the counts of the 64 classes before and after it in all training texts meet in one
    bucket, the word leaves its class and joins the one that raises the likelihood of the class bigrams most.
    All words of a sweep see one table, which is counted anew after it (``word_sweeps`` of them, at least one).
    So classes cover the whole vocabulary at every size.  The first words are found by counts of
    words that make one in 65,536 tokens of a split; only which words start depends on it.

    Chunks of texts send their distinct words to hash ranges and get the corpus counts and classes back; a
    word comes once a chunk, so frequent words make no hot task.  The driver holds the tables of the first units and of
    the classes, both of a fixed size.

    Null texts are empty and consist of the end token.  A null key counts as the text
    ''.  Repeated rows are scored each.  An empty table gives an empty result.
    """
    if word_sweeps < 1:
        raise ValueError("word_sweeps must be at least 1")
    chunks = encoded(docs, key, text)
    coded, model = fit(chunks, max(1, 2 * docs.rdd.getNumPartitions()), word_sweeps, first)
    kind = docs.schema[key].dataType.simpleString()
    result = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return coded.select("n", "tokens", "sizes", "keys", "held_out", "known").mapInArrow(_score(key, model), result)
