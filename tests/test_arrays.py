from __future__ import annotations

from pyspark.sql import functions as F

from uttermill.functions import arrays as A


def one(spark, values, expr, kind="array<int>"):
    return spark.createDataFrame([(values,)], f"a {kind}").select(expr(F.col("a"))).first()[0]


def test_prompt_mask(spark):
    assert one(spark, [9, 9, 1, 5, 6], lambda c: A.mask_prompt(c, 1)) == [-100, -100, -100, 5, 6]
    assert one(spark, [1, 5, 6], lambda c: A.mask_prompt(c, 1)) == [1, 5, 6]
    assert one(spark, [5, 6], lambda c: A.mask_prompt(c, 1)) == [5, 6]


def test_ctc_collapse(spark):
    assert one(spark, [0, 1, 1, 0, 1, 2, 2], lambda c: A.ctc_collapse(c, 0)) == [1, 1, 2]
    assert one(spark, [0, 0], lambda c: A.ctc_collapse(c, 0)) == []
    assert one(spark, [], lambda c: A.ctc_collapse(c, 0)) == []


def test_padding_and_shifts(spark):
    assert one(spark, [1, 2], lambda c: A.pad(c, 4, -100)) == [1, 2, -100, -100]
    assert one(spark, [1, 2], lambda c: A.attention_mask(c, 4)) == [1, 1, 0, 0]
    assert one(spark, [1, 2], lambda c: A.ignore_padding(A.pad(c, 3, 7), A.attention_mask(c, 3))) == [1, 2, -100]
    assert one(spark, [1, -100], lambda c: A.restore_padding(c, 5)) == [1, 5]
    assert one(spark, [1, 2, 3], lambda c: A.shift_right(c, 9)) == [9, 1, 2]
    assert one(spark, [], lambda c: A.shift_right(c, 9)) == []
    assert one(spark, [1, 2, 3], A.decoder_input) == [1, 2]
    assert one(spark, [1, 2, 3], A.decoder_target) == [2, 3]
    assert one(spark, [1, 2, 3], lambda c: A.truncate(c, 2)) == [1, 2]


def test_numbers(spark):
    assert one(spark, [0.5, 2.0, 2.0], A.argmax, "array<float>") == 1
    assert one(spark, [0.0] * 8, lambda c: A.duration(c, 16), "array<float>") == 0.5
    assert abs(sum(one(spark, [1.0, 2.0, 3.0], A.softmax, "array<double>")) - 1) < 1e-12
    row = spark.range(1).select(A.percent(F.lit(0.02675)), A.percent(F.lit(0.00125))).first()
    assert list(row) == [2.68, 0.13]


def test_shape_and_bands(spark):
    m = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]
    kind = "array<array<float>>"
    assert one(spark, m, lambda c: A.has_shape(c, 2, 3), kind) is True
    assert one(spark, [[1.0], [1.0, 2.0]], lambda c: A.has_shape(c, 2, 1), kind) is False
    assert one(spark, m, lambda c: A.zero_band_matrix(c, 0, F.lit(0), F.lit(1)), kind) == [[0, 0, 0], m[1]]
    assert one(spark, m, lambda c: A.zero_band_matrix(c, 1, F.lit(1), F.lit(3)), kind) == [[1, 0, 0], [4, 0, 0]]
