from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uttermill.functions import metrics as M
from uttermill.functions.bitdistance import distances
from uttermill.operators import evaluation


def table(a: str, b: str) -> int:
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


WORDS = st.text(alphabet="ab你😀é", max_size=150)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(WORDS, WORDS), max_size=12))
def test_bit_parallel_equals_the_table(pairs):
    got = distances([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == [table(a, b) for a, b in pairs]


@pytest.mark.parametrize("n", [63, 64, 65, 127, 128, 129, 300])
def test_word_boundaries(n):
    rng = random.Random(n)
    left = ["".join(rng.choice("abc") for _ in range(n)) for _ in range(5)]
    right = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 2 * n))) for _ in range(5)]
    assert distances(left, right).tolist() == [table(a, b) for a, b in zip(left, right, strict=True)]


def test_short_patterns_with_one_very_long_text():
    left = ["abc"] * 300 + ["abd"]
    right = ["acb"] * 300 + ["x" * 200_000 + "bd"]
    assert distances(left, right, cells=1 << 12).tolist() == [2] * 300 + [200_000]


def _pairs(spark):
    rng = random.Random(0)
    rows = [("", "abc"), ("abc", ""), (None, "a"), ("a", None), ("same", "same"), ("", "")]
    for n in (5, 20, 60, 90, 200, 400):
        for _ in range(8):
            ref = "".join(rng.choice("abcdefgh 你好") for _ in range(n))
            pred = list(ref)
            for _ in range(rng.randint(0, n // 4)):
                pred[rng.randrange(n)] = rng.choice("xyz")
            rows.append((ref, "".join(pred)[: rng.randint(n // 2, n)] if rng.random() < 0.3 else "".join(pred)))
    # 3 edits on 20 characters sit exactly on 15 percent.
    rows += [("a" * 20, "a" * 17 + "bbb"), ("a" * 20, "a" * 18 + "bb"), ("a" * 200, "a" * 170 + "b" * 30)]
    return rows, spark.createDataFrame(rows, "ref string, pred string")


def test_distance_and_threshold(spark):
    rows, df = _pairs(spark)
    got = df.select(
        "ref", "pred", M.edit_distance("ref", "pred"), M.within_cer("ref", "pred", 15.0), M.utterance_cer("ref", "pred")
    ).collect()
    assert len(got) == len(rows)
    for ref, pred, d, near, cer in got:
        if ref is None or pred is None:
            assert (d, near) == (None, False)
            continue
        want = table(ref, pred)
        assert d == want
        assert near == (len(ref) > 0 and 100 * want < 15 * len(ref))
        assert cer == (want / len(ref) if ref else None)


def test_corpus_rate_is_a_micro_average(spark):
    df = spark.createDataFrame(
        [("m", "abcd", "abcd"), ("m", "ab", "xy"), ("m", "", "zz"), ("n", "a b", "A, b")],
        "model string, ref string, pred string",
    )
    got = {r["model"]: r for r in evaluation.corpus_cer(df, "ref", "pred", ["model"]).collect()}
    assert (got["m"]["edits"], got["m"]["ref_chars"], got["m"]["cer"]) == (2, 6, 33.33)
    both = {r["model"]: r for r in evaluation.raw_and_normalized_cer(df, "ref", "pred", ["model"]).collect()}
    assert both["n"]["cer"] == 0.0 and both["n"]["cer_ortho"] == 66.67
    assert both["m"]["n_rows"] == 3 and both["m"]["n_scored"] == 2


def test_no_reference_at_all_gives_null(spark):
    df = spark.createDataFrame([("", "x")], "ref string, pred string")
    assert evaluation.corpus_cer(df, "ref", "pred").first()["cer"] is None


def test_relabel_keeps_label_without_evidence(spark):
    df = spark.createDataFrame(
        [("a b c d", "a b c d!!"), ("", "x"), ("abc", None), ("abc", "xyz")], "ref string, pred string"
    )
    got = [r["label"] for r in evaluation.relabel(df, "ref", "pred", 15.0).select("label").collect()]
    # The marks become one space, one edit on seven characters.
    assert got == ["a b c d!!", "", "abc", "abc"]


def test_masked_divergence(spark):
    df = spark.createDataFrame(
        [([0.5, 0.5], [0.25, 0.75], 1), ([1.0, 0.0], [0.5, 0.5], -100)], "p array<double>, q array<double>, label int"
    ).withColumn("lq", F.transform("q", lambda x: F.ln(x)))
    row = evaluation.masked_divergence(df, "p", "lq", "label").first()
    assert row["n_positions"] == 1
    assert abs(row["divergence"] - 0.14384103622589045) < 1e-12


def test_mean_of_batches_is_unweighted(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "b int, v double")
    assert evaluation.mean_of_batches(df, "b", ["v"]).first()["mean_v"] == 6.0
