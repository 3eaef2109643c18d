"""Hooks for functions the caller brings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Predict = Callable[[pd.DataFrame], "pd.Series[str]"]


def score(
    df: DataFrame, key: str, inputs: list[str], predict: Predict | None = None,
    load: Callable[[], Predict] | None = None,
) -> DataFrame:
    """Run a caller's predictor over Arrow batches: key, ``pred``, ``gen_time``.

    ``load`` builds the predictor once per task, for models too big to pickle.
    The batch's elapsed seconds are spread evenly over its rows.  Only the key
    and the named inputs travel to Python.
    """
    if (predict is None) == (load is None):
        raise ValueError("give either predict or load")
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = predict if predict is not None else load()
        for batch in batches:
            start = time.perf_counter()
            pred = fn(batch[inputs])
            spent = time.perf_counter() - start
            share = spent / len(batch) if len(batch) else 0.0
            yield pd.DataFrame({key: batch[key], "pred": list(pred), "gen_time": share})

    return df.select(key, *inputs).mapInPandas(
        run, f"`{key}` {key_type}, pred string, gen_time double"
    )


def map_rows(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Row to row: derived columns, and of the source columns only ``keep``."""
    return df.select(*(keep or []), *[c.alias(n) for n, c in columns.items()])


def filter_rows(df: DataFrame, predicate: Callable[..., pd.Series], inputs: list[str]) -> DataFrame:
    """Keep rows for which a caller's vectorised predicate holds.

    The predicate sees the named columns only.  Built-in conditions belong in
    ``where`` before this call, so that they run first.
    """
    test = F.pandas_udf(predicate, "boolean")
    return df.where(test(*inputs))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Batch to batch over Arrow batches of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def collate(
    df: DataFrame, pos: str, batch_size: int, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, inputs: list[str]
) -> DataFrame:
    """Exact batch to batch: a caller's function over each ``batch_size`` rows of dense ``pos``, in order.

    Unlike :func:`map_batches` the batches do not depend on how rows are partitioned.  The function sees
    ``pos`` and the named inputs; a ``batch`` column with the batch number comes before what it returns.
    """
    numbered = df.select(F.floor(F.col(pos) / batch_size).cast("bigint").alias("batch"), pos, *inputs)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = fn(rows.sort_values(pos, ignore_index=True)[[pos, *inputs]]).copy()
        out.insert(0, "batch", int(key[0]))
        return out

    return numbered.groupBy("batch").applyInPandas(run, f"batch bigint, {schema}")
