"""Taking up a half-finished job row by row.

The keys that are done go into a Bloom filter of a stated size.  A row that it does not
know is not done, so it is taken without a join; only the rows that it may know meet
the done keys in an exact anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the filter in bits: a megabyte, whatever the number of keys.
BITS = 1 << 23
#: Bits set for each key.
HASHES = 5


def bits_for(n: int) -> int:
    """Size of a filter with at least 16 bits for each of ``n`` keys, from 8 KB to 8 MB; above that it knows more keys falsely."""
    return 1 << min(26, max(16, (16 * n).bit_length()))


def _places(keys: Sequence[str], bits: int, hashes: int) -> list[Column]:
    # A struct tells a null from the value before it.
    return [F.pmod(F.xxhash64(F.lit(i), F.struct(*keys)), F.lit(bits)) for i in range(hashes)]


def done_filter(done: DataFrame, keys: Sequence[str], bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """(word, bits) of the filter: at most bits / 64 rows, merged in each task before the shuffle."""
    if bits % 64:
        raise ValueError("the size is a multiple of 64")
    place = done.select(F.explode(F.array(*_places(keys, bits, hashes))).alias("_at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_at").bitwiseAND(F.lit(63)).cast("int"))
    return merged(place.select(F.shiftright("_at", 6).cast("int").alias("word"), bit.alias("bits")))


def merged(*filters: DataFrame) -> DataFrame:
    """One filter for the keys of all; they must have the same size and number of hashes."""
    every = filters[0]
    for other in filters[1:]:
        every = every.unionByName(other)
    return every.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_know(words: DataFrame, keys: Sequence[str], bits: int = BITS, hashes: int = HASHES) -> Column:
    """Whether the filter may hold the key: false is certain, true is not.

    The filter, ``bits`` / 8 bytes, is sent to each executor once; only the places of a
    row's bits go to the vectorised test.
    """
    found = words.toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    # Bytes, in which a place is a byte and a bit whatever the machine.
    sent = words.sparkSession.sparkContext.broadcast(table.astype("<i8").view(np.uint8))

    @F.pandas_udf("boolean")
    def known(*places: pd.Series) -> pd.Series:
        out = np.ones(len(places[0]), bool)
        for place in places:
            at = place.to_numpy()
            out &= (sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return pd.Series(out)

    return known(*_places(keys, bits, hashes))


def remaining(
    rows: DataFrame, done: DataFrame, keys: Sequence[str], words: DataFrame | None = None, bits: int = BITS, hashes: int = HASHES
) -> DataFrame:
    """The rows whose key is not among the ``done`` ones, each as often as it occurs.

    ``words`` is a filter saved by an earlier run (:func:`done_filter`), else one is built.
    It has to know every done key and may know others.  A full filter
    sends all rows through the join, which changes the cost and not the result.
    Null keys are keys.
    """
    keys = list(keys)
    known = may_know(done_filter(done, keys, bits, hashes) if words is None else words, keys, bits, hashes)
    there = done.select(*[F.col(k).alias(f"_done_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_done_{k}"))
    return rows.where(~known).unionByName(rows.where(known).join(there, same, "left_anti"))
