"""Ties, cuts, byte bounds, headers, exact batches, matrix masks, and the guard of the entry."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from uttermill.operators import augment, evaluation, layout, ordering, quality, scoring

ROOT = Path(__file__).resolve().parents[1]


def kept(df):
    return sorted((r.run or "", r.step, r.note, r.kept) for r in df.collect())


@pytest.fixture
def runs(spark):
    # Four rows tie at the cut of "a" (two of them equal in every column); "b" has no tie; one null run.
    rows = [("a", 9, "x", 1), ("a", 5, "x", 1), ("a", 5, "x", 2), ("a", 5, "x", 3), ("a", 5, "x", 3),
            ("b", 3, "x", 1), ("b", 2, "x", 1), ("b", 1, "x", 1), (None, 1, "x", 1), (None, 1, "x", 1), (None, 1, "x", 1)]
    return spark.createDataFrame(rows, "run string, step int, tie string, note int").repartition(3)


def test_ties_across_the_cut_are_ranked(runs):
    for keep in (2, 3):
        out = layout.retain_newest(runs, "run", "step", keep, "tie", ties="rank")
        assert out.columns == [*runs.columns, "kept"]
        got = {r[0]: (r[1], r[2]) for r in out.groupBy("run").agg(F.sum("kept"), F.count("*")).collect()}
        assert got == {"a": (keep, 5), "b": (min(keep, 3), 3), None: (min(keep, 3), 3)}
        assert sorted(out.drop("kept").collect(), key=str) == sorted(runs.collect(), key=str)
        again = layout.retain_newest(runs.repartition(5), "run", "step", keep, "tie", ties="rank")
        assert kept(again) == kept(out)


def test_ties_across_the_cut_fail_unless_ranked(runs):
    with pytest.raises(Exception, match="rows tie at the cut of group"):
        layout.retain_newest(runs, "run", "step", 2, "tie").collect()
    # All five rows of "a" and all of the others fit.
    assert {r.kept for r in layout.retain_newest(runs, "run", "step", 5, "tie").collect()} == {1}
    with pytest.raises(ValueError):
        layout.retain_newest(runs, "run", "step", 2, "tie", ties="any")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 7, 50])
def test_first_rows_of_wide_rows(spark, n):
    rows = [(None, 1, "w"), ("a", 2, "w"), ("a", 2, "v"), ("a", 2, "u"), ("b", None, "w"), ("b", 1, "w"), ("c", 0, "w")]
    df = spark.createDataFrame(rows, "k string, i int, wide string").repartition(3)
    got = ordering.first_rows(df, ["k", "i"], n)
    assert got.columns == df.columns
    order = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0)
    assert sorted(order(r) for r in got.collect()) == sorted(order(r) for r in rows)[:n]


def test_first_rows_sort_no_wide_column(spark):
    df = spark.range(500).withColumn("wide", F.repeat(F.lit("x"), 50))
    plan = ordering.first_rows(df, ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_text_in_stretches_of_bytes(spark):
    texts = ["ab", "é", None, "", "x" * 25, "yz", "w" * 9, "v"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_idx long, text string")
    got = evaluation.concat_text(df, "text", "row_idx", chunk_bytes=10).orderBy("chunk").collect()
    assert [(r.chunk, r.n_rows, r.text) for r in got] == [(0, 5, "abé" + "x" * 25), (2, 1, "yz"), (3, 1, "w" * 9), (4, 1, "v")]


@pytest.mark.parametrize(("head", "audio"), [
    ("FFFB9064", True), ("FFF38064", True), ("FFFE6100", False), ("FFFE9064", False), ("FFEB9064", False), ("FFF99064", False),
    ("FFFBF064", False), ("FFFB9C64", False), ("FFE31800", True), ("FF", False), ("FFFB", False), ("FEFF0061", False),
])
def test_mpeg_frame_bits(spark, head, audio):
    df = spark.createDataFrame([(bytearray.fromhex(head),)], "content binary")
    assert df.select(quality.readable_media("content")).first()[0] is audio


def test_collate_sees_exact_batches(spark):
    df = spark.range(25).select(F.col("id").alias("pos"), (F.col("id") * 2).alias("v")).repartition(7)

    def spread(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"first": [batch["pos"].iloc[0]], "sorted": [bool(batch["pos"].is_monotonic_increasing)], "total": [batch["v"].sum()]})

    got = scoring.collate(df, "pos", 10, spread, "first long, sorted boolean, total long", ["v"]).orderBy("batch").collect()
    assert [tuple(r) for r in got] == [(0, 0, True, 90), (1, 10, True, 290), (2, 20, True, 220)]


@pytest.mark.parametrize("axis", [0, 1])
def test_matrix_band(spark, axis):
    df = spark.createDataFrame([(i, 0, [[1.0] * 30] * 40) for i in range(20)], "utt_id int, replica int, f array<array<float>>")
    out = augment.mask_matrix(df.withColumn("on", F.col("utt_id") % 2 == 0), "f", axis, "on", "band").collect()
    widths = set()
    for r in out:
        lines = r.f if axis == 0 else list(zip(*r.f, strict=True))
        dark = [i for i, line in enumerate(lines) if not any(line)]
        assert all(all(line) for i, line in enumerate(lines) if i not in dark)
        assert dark == list(range(dark[0], dark[0] + len(dark))) if dark else True
        assert r.utt_id % 2 == 0 or not dark
        widths.add(len(dark))
    assert max(widths) < augment.MAX_BAND and len(widths) > 3


def test_entry_without_a_dependency_of_the_training_operators():
    """The other queries stay when a package that only those operators need is missing."""
    code = (
        "import sys; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e\n"
        "from uttermill.plans.catalogue import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(QUERIES)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
