"""Declared row types; corpora never rely on schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

UTTERANCE = T.StructType(
    [
        T.StructField("utt_id", T.StringType(), False),
        T.StructField("corpus", T.StringType(), False),
        T.StructField("split", T.StringType(), False),
        T.StructField("sentence", T.StringType()),
        T.StructField("input_length", T.DoubleType()),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("input_features", T.ArrayType(T.ArrayType(T.FloatType()))),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("file_id", T.StringType(), False),
        T.StructField("transcript", T.StringType()),
    ]
)

VOCABULARY = T.StructType(
    [
        T.StructField("ch", T.StringType(), False),
        T.StructField("id", T.IntegerType(), False),
    ]
)

ANNOTATION = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("sentence", T.StringType()),
    ]
)

REPORT = T.StructType(
    [
        T.StructField("utt_id", T.StringType(), False),
        T.StructField("target", T.StringType()),
        T.StructField("pred", T.StringType()),
        T.StructField("norm_target", T.StringType()),
        T.StructField("norm_pred", T.StringType()),
    ]
)
