"""Toxicity classifier: FTRL-proximal logistic regression on hashed n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from uttermill.llm import words as X
from uttermill.llm.common import keep_ids

#: Weights are at most 2**BITS, which bounds what is sent to the executors.
BITS = 20
#: Labelled rows per class used in training.
SAMPLE = 8_000
#: Code points per class used in training.
BUDGET = 1 << 25
PASSES = 2
#: Learning rate, its offset, and the two penalties of FTRL-proximal.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 12.0, 1.0
THRESHOLD = 0.7


def features(body: np.ndarray, offsets: np.ndarray, used: np.ndarray | None = None, bits: int = BITS) -> list[np.ndarray]:
    """Distinct hashed features of each text: words, pairs, and pairs that skip one or two words.

    Words are lower-cased (A-Z) and stripped of nothing else; a text without
    words has no feature and scores by the intercept.  With ``used``, features
    whose slot is False there are left out before the sort that makes them distinct.
    """
    low = X.lowered(body)
    first, end, begin = X.spans(low, offsets)
    unit = X.hashes(low, first, end)
    shift = np.uint64(64 - bits)
    parts, owners = [unit >> shift], [np.repeat(np.arange(len(begin) - 1), np.diff(begin))]
    for gap in (1, 2, 3):
        at, owner = X.windows_per_text(begin, gap + 1)
        pair = X.mix64(unit[at] * np.uint64(0x8CB92BA72F3D8DD7 + 2 * gap) + unit[at + gap] if len(at) else np.empty(0, np.uint64))
        parts.append(pair >> shift)
        owners.append(owner)
    if used is not None:
        masks = [used[p.astype(np.int64)] for p in parts]
        parts, owners = [p[m] for p, m in zip(parts, masks, strict=True)], [o[m] for o, m in zip(owners, masks, strict=True)]
    code = X.distinct((np.concatenate(owners).astype(np.uint64) << np.uint64(bits)) | np.concatenate(parts))
    cuts = np.searchsorted(code, np.arange(len(begin), dtype=np.uint64) << np.uint64(bits))
    slot = (code & np.uint64((1 << bits) - 1)).astype(np.int64)
    return [slot[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """Weights held as accumulated gradients (z) and their squares (n), one rate per coordinate."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, slots: np.ndarray) -> np.ndarray:
        z = self.z[slots]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(self.n[slots])) / ALPHA + L2)

    def learn(self, slots: np.ndarray, label: int) -> None:
        """One step; every feature of a text has the value 1, the last slot is the intercept."""
        slots = np.append(slots, len(self.z) - 1)
        w = self.weights(slots)
        g = _sigmoid(w.sum()) - label
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] += g * g


def train(docs: DataFrame, marked: DataFrame, sample: int = SAMPLE, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept) learnt from at most ``sample`` rows of each class.

    ``docs`` has (_key, _text), ``marked`` (_label_key, _label).  The rows are the
    first of each class in the order of a hash of the key, so the choice does not
    depend on partitioning.  Keys are chosen without texts; the chosen ones (at most
    twice ``sample``) are broadcast to find their rows.  Equal rows count once, texts above a 64th of ``budget``
    code points are not learnt from, and of a key's rows no more than ``sample`` and, by class, ``budget`` code points are taken.  The bounded sample is learnt in one
    task and only weights that L1 leaves non-zero reach the driver.
    """
    keyed = marked.select("_label_key", F.col("_label").cast("int").alias("label"), F.xxhash64(F.lit(3), "_label_key").alias("rank"))
    some = [keyed.where(F.col("label") == y).orderBy("rank", "_label_key").limit(sample) for y in (0, 1)]
    keys = F.broadcast(some[0].union(some[1]))
    mark = F.xxhash64(F.lit(3), "_text").alias("mark")
    rows = docs.select("_key", mark, F.length(F.coalesce("_text", F.lit(""))).alias("length")).where(F.col("length") <= budget // 64)
    rows = rows.join(keys, F.col("_key") == F.col("_label_key")).select("label", "rank", "_key", "mark", "length").distinct()
    # A key may have many texts: rows are bounded again, then code points.
    few = [rows.where(F.col("label") == y).orderBy("rank", "_key", "mark").limit(sample) for y in (0, 1)]
    so_far = F.sum("length").over(W.partitionBy("label").orderBy("rank", "_key", "mark"))
    few = few[0].union(few[1]).withColumn("so_far", so_far).where(F.col("so_far") <= budget)
    few = few.select(F.col("_key").alias("_label_key"), F.col("mark").alias("_label_mark"), "label", "rank")
    chosen = docs.select("_key", "_text", mark).join(F.broadcast(few), (F.col("_key") == F.col("_label_key")) & (F.col("mark") == F.col("_label_mark")))
    chosen = chosen.dropDuplicates(["_key", "mark"]).select(F.col("_text").alias("text"), "label", "rank")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, labels, ranks = [], [], []
        for batch in batches:
            for part, body, offsets in X.slices(batch, "text"):
                seen += features(body, offsets)
                labels += part.column("label").to_pylist()
                ranks += part.column("rank").to_pylist()
        model = Ftrl()
        # Classes count alike: the rarer one is shown more often in each pass.
        ones = sum(labels)
        times = [max(1, round((len(labels) - ones) / ones)) if y and ones else 1 for y in labels]
        order = np.repeat(np.argsort(ranks, kind="stable"), np.array(times, dtype=np.int64)[np.argsort(ranks, kind="stable")]) if labels else []
        for turn in range(PASSES):
            for i in np.random.default_rng(turn).permutation(order):
                model.learn(seen[i], labels[i])
        every = np.arange(len(model.z))
        w = model.weights(every)
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(w[used])], ["slot", "weight"])

    # A shuffle, so that documents are read in parallel and only chosen rows reach the one task.
    alone = chosen.repartition(1).sortWithinPartitions("rank", "label", "text")
    learnt = alone.mapInArrow(fit, "slot long, weight double").toArrow()
    slot, weight = learnt["slot"].to_numpy(), learnt["weight"].to_numpy()
    bias = slot == 1 << BITS
    return slot[~bias], weight[~bias], float(weight[bias].sum())


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
    budget: int = BUDGET,
) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``.

    Rows with crc32(key as text) mod 3 = 1 are never learnt from.  Inputs of the
    score are the words of the whole text alone.  A null or empty text scores by
    the intercept; null labels and null keys are not learnt from; without any
    label every score is 0.5.  ``sample`` and ``budget`` bound the rows
    and code points learnt from per class; scoring covers all rows.
    """
    slot = F.pmod(F.crc32(F.coalesce(F.col("_key").cast("string"), F.lit("")).cast("binary")), F.lit(3))
    marked = labels.select(F.col(key).alias("_label_key"), F.col(label).alias("_label")).where("_label is not null and _label_key is not null")
    marked = marked.where(F.pmod(F.crc32(F.col("_label_key").cast("string").cast("binary")), F.lit(3)) != 1)
    marked = marked.groupBy("_label_key").agg(F.max("_label").alias("_label"))
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    slots, weights, bias = train(own, marked, sample, budget)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[slots] = weights
        used = dense != 0
        for batch in batches:
            for part, body, offsets in X.slices(batch, "_text"):
                raw = np.array([dense[f].sum() for f in features(body, offsets, used)]) + bias
                yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("held_out"), pa.array(_sigmoid(raw))], [key, "held_out", "score"])

    kind = docs.schema[key].dataType.simpleString()
    given = own.select("_key", (slot == 1).alias("held_out"), "_text")
    scored = given.mapInArrow(score, f"`{key}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    clean = toxicity(docs, labels, key, text).where("predicted = 0").select(key)
    return keep_ids(docs, clean, key)
