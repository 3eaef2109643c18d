"""Chat formatting: exact round trips, the loss mask, typed parts, odd rows, and no Python in the plan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttermill.llm import chat

SHAPE = "conv_id long, turn long, role string, text string, formatted string, _conv int"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|end|>", "<|start|>", "<|message|>", "<|image|>", "<|im_start|>",
         "<\\s>", "<\\\\|end|>", "[\\INST]", "\\", "<", "[", "|", ">", "<|", "|>", "é", "\U0001f600", "\n", "$1", "a b", "![x](p.png)", "![", "](q.MP3)"]


def read(out):
    cols = out.select("*", chat.read_turns().alias("turns"), chat.read_loss().alias("loss"))
    return {r.conv_id: r for r in cols.collect()}


def conversations(seed: int):
    rnd = random.Random(seed)
    return {
        c: [(rnd.choice(["user", "assistant", "system", "", "<|end|>", "a<s>b"]), "".join(rnd.choices(MARKS, k=rnd.randint(0, 12)))) for _ in range(rnd.randint(1, 7))]
        for c in range(150)
    }


@pytest.mark.parametrize("seed", range(3))
def test_round_trip(spark, seed):
    talks = conversations(seed)
    rows = [(c, t, role, text, "x", 1) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    random.Random(seed).shuffle(rows)
    got = read(chat.format_conversations(spark.createDataFrame(rows, SHAPE).repartition(4)))
    assert set(got) == set(talks)
    for c, turns in talks.items():
        r = got[c]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.n_turns == len(turns)
        assert list(r.loss) == [text for role, text in turns if role == "assistant"]
        assert r.formatted.startswith("<s>") and r.formatted.endswith("</s>")
        assert r.formatted.count("<|start|>") == r.formatted.count("<|message|>") == r.formatted.count("<|end|>") == len(turns)
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == 1
        assert r.formatted.count("[INST]") == 0
        for span in r.loss_spans:
            cut = r.formatted[span.start : span.start + span.length]
            assert cut.encode() == r.formatted.encode()[span.first_byte : span.first_byte + span.bytes]
            before = r.formatted[: span.start]
            assert before.endswith("<|start|>assistant<|message|>") and r.formatted[span.start + span.length :].startswith("<|end|>")
        marks = sum(r.formatted.count(chat.placeholder(k)) for k in chat.ENDINGS)
        assert marks == sum(len(f) for f in r.attachments)


def test_typed_parts(spark):
    def part(kind, **fields):
        return tuple(fields.get(f.name) if f.name != "kind" else kind for f in chat.PART.fields)

    rows = [
        (1, 0, "user", [part("text", text="see <|image|> "), part("image", ref="a.png", width=57, height=28), part("audio", ref="b", seconds=2.0),
                        part("document", ref="c.pdf", pages=3), part("video", text="other"), None, part("image")]),
        (1, 1, "assistant", None), (2, 0, "assistant", []),
    ]
    shape = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                          T.StructField("content", T.ArrayType(chat.PART))])
    got = read(chat.format_conversations(spark.createDataFrame(rows, shape), parts="content"))
    one = got[1]
    assert one.formatted == ("<s><|start|>user<|message|>see <\\|image|> <|image|><|audio|><|document|>other<|image|><|end|>"
                             "<|start|>assistant<|message|><|end|></s>")
    assert [tuple(f) for f in one.attachments[0]] == [
        ("image", "a.png", None, 3), ("audio", "b", None, 25), ("document", "c.pdf", None, 1536), ("image", None, None, 1)]
    assert one.expanded_tokens == 3 + 25 + 1536 + 1
    assert [t.text for t in one.turns] == ["see <|image|> other", ""]
    assert list(got[2].loss) == [""] and got[2].n_turns == 1


def test_embeds_are_cut_out_and_put_back(spark):
    text = "Look ![a [cat](x.JPG) and ![](s.wav)![d](r.pdf), not ![z](y.txt)."
    got = read(chat.format_conversations(spark.createDataFrame([(5, 0, "assistant", text, "", 0)], SHAPE)))[5]
    assert "Look <|image|> and <|audio|><|document|>, not ![z](y.txt)." in got.formatted
    assert [(f.kind, f.ref, f.tokens) for f in got.attachments[0]] == [("image", "x.JPG", 1), ("audio", "s.wav", 13), ("document", "r.pdf", 512)]
    assert list(got.loss) == [text] == [t.text for t in got.turns]


def test_odd_rows(spark):
    long = "<s> é" * 200_000
    rows = [(None, 0, "user", "a", "", 0), (None, 0, "user", "a", "", 0), (None, None, None, None, "", 0), (1, None, "user", "first", "", 0),
            (1, 0, None, None, "", 0), (1, 0, "assistant", "b", "", 0), (1, 0, "assistant", "b", "", 0), (2, 0, "assistant", long, None, None)]
    out = chat.format_conversations(spark.createDataFrame(rows, SHAPE))
    none = out.where("conv_id IS NULL").select(chat.read_turns().alias("turns")).collect()
    assert sorted([(t.role, t.text) for t in r.turns] for r in none) == [[("", "")], [("user", "a")], [("user", "a")]]
    got = read(out.where("conv_id IS NOT NULL"))
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "first"), ("", ""), ("assistant", "b"), ("assistant", "b")]
    assert list(got[1].loss) == ["b", "b"]
    assert list(got[2].loss) == [long]
    assert chat.format_conversations(spark.createDataFrame([], SHAPE)).count() == 0


def test_many_turns(spark):
    n = 20_000
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), (n - F.col("id")).alias("turn"),
                                 F.when(F.col("id") % 2 == 0, F.lit("assistant")).otherwise(F.lit("user")).alias("role"), F.col("id").cast("string").alias("text"))
    got = read(chat.format_conversations(rows))[1]
    assert [t.text for t in got.turns] == [str(i) for i in range(n - 1, -1, -1)]
    assert list(got.loss) == [str(i) for i in range(n - 1, -1, -1) if i % 2 == 0]


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", "", 0)], SHAPE)
    plan = chat.format_conversations(df).select(chat.read_turns(), chat.read_loss())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
