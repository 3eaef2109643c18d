"""Edit distance and error-rate expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttermill.functions.bitdistance import distances

#: Pairs whose distance table has at most this many cells stay in the JVM.
SMALL_TABLE = 4096


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _table_cells(a: Column, b: Column) -> Column:
    return F.length(a).cast("bigint") * F.length(b)


def _long_distance(a: Column, b: Column, needed: Column) -> Column:
    """Distance of the ``needed`` pairs; all other rows send NULL to Python."""

    def work(left: pd.Series, right: pd.Series) -> pd.Series:
        live = left.notna() & right.notna()
        out = pd.Series(pd.NA, index=left.index, dtype="Int64")
        if live.any():
            out[live] = distances(left[live].tolist(), right[live].tolist())
        return out

    return F.pandas_udf(work, T.LongType())(F.when(needed, a), F.when(needed, b))


def edit_distance(a: Column | str, b: Column | str) -> Column:
    """Exact Levenshtein distance over code points, as bigint.

    Equal strings cost one compare, and short pairs use the built-in, at about
    13 ns per cell of the table.  Longer pairs go, in Arrow batches, to the
    bit-parallel form, which fills 64 cells per word operation.
    """
    a, b = _col(a), _col(b)
    small = _table_cells(a, b) <= SMALL_TABLE
    return (
        F.when(a == b, F.lit(0).cast("bigint"))
        .when(small, F.levenshtein(a, b).cast("bigint"))
        .otherwise(_long_distance(a, b, (a != b) & ~small))
    )


def utterance_cer(ref: Column | str, pred: Column | str) -> Column:
    """Edits per reference character; NULL when the reference is empty."""
    ref, pred = _col(ref), _col(pred)
    return F.when(F.length(ref) > 0, edit_distance(ref, pred) / F.length(ref))


def within_cer(ref: Column | str, pred: Column | str, threshold: float) -> Column:
    """``100 * edits / length < threshold``, with work only where it is open.

    ``d < t * len / 100`` holds for whole ``d`` exactly up to
    ``ceil(t * len / 100) - 1``.  A length difference above that bound settles a
    pair at once; short pairs use the built-in bounded distance.  The bound takes
    exact decimals, so a distance sitting on the threshold is not let through.
    """
    ref, pred = _col(ref), _col(pred)
    n = F.length(ref)
    exact = F.lit(str(threshold)).cast("decimal(9,4)")
    bound = (F.ceil(exact * n / 100) - 1).cast("int")
    possible = (n > 0) & (F.abs(n - F.length(pred)) <= bound)
    small = _table_cells(ref, pred) <= SMALL_TABLE
    near = F.call_function("levenshtein", ref, pred, F.greatest(bound, F.lit(0)))
    far = _long_distance(ref, pred, possible & ~small & (ref != pred))
    return F.coalesce(
        F.when(~possible, F.lit(False))
        .when(ref == pred, F.lit(True))
        .when(small, near >= 0)
        .otherwise(far <= bound),
        F.lit(False),
    )
