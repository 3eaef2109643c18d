"""Weighted interleaving against a pick-by-pick simulation; mixes of corpora that share keys."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from uttermill.operators import corpora, layout
from uttermill.sources import writers


def simulate(sizes: dict[str, int], weights: dict[str, str], stop: str) -> list[tuple[str, int, int]]:
    """(source, rank, cycle) pick by pick: always the source that is furthest behind its share."""
    share = {s: Fraction(w) for s, w in weights.items()}
    live = [s for s in weights if stop == "first" or sizes.get(s, 0)]
    taken = dict.fromkeys(live, 0)
    out, done = [], set()
    if any(not sizes.get(s, 0) for s in live):
        return out
    while live:
        s = min(live, key=lambda s: ((taken[s] + 1) / share[s], list(weights).index(s)))
        out.append((s, taken[s] % sizes[s], taken[s] // sizes[s]))
        taken[s] += 1
        if taken[s] == sizes[s]:
            done.add(s)
            if stop == "first" or len(done) == len(live):
                return out
    return out


CASES = [
    ({"a": 10, "b": 10}, {"a": "1", "b": "1"}),
    ({"a": 7, "b": 40, "c": 3}, {"a": "0.5", "b": "0.3", "c": "0.2"}),
    ({"a": 1, "b": 30}, {"b": "0.1", "a": "0.9"}),
    ({"a": 12, "b": 5, "c": 9, "x": 4}, {"c": "3", "a": "2.5", "b": "0.25"}),
    ({"a": 4}, {"a": "2"}),
    ({"a": 4, "b": 6}, {"a": "1", "z": "1", "b": "2"}),
]


@pytest.mark.parametrize("stop", ["first", "all"])
@pytest.mark.parametrize(("sizes", "weights"), CASES)
def test_equals_simulation(spark, sizes, weights, stop):
    rows = [(s, i, f"{s}{i}") for s, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "source string, rank int, note string").repartition(3)
    out = layout.interleave_weighted(df, "source", weights, ["rank"], stop)
    got = sorted(out.collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(len(got)))
    assert [(r.source, r["rank"], r.cycle) for r in got] == simulate(sizes, weights, stop)
    assert all(r.note == f"{r.source}{r['rank']}" for r in got)


def test_short_source_is_cycled_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(layout, "CYCLES", 10)
    df = spark.range(401).select(F.when(F.col("id") == 0, "a").otherwise("b").alias("source"), "id")
    got = sorted(layout.interleave_weighted(df, "source", {"a": "3", "b": "1"}, ["id"], "all").collect(), key=lambda r: r.position)
    assert [(r.source, r.cycle) for r in got] == [(s, c) for s, _, c in simulate({"a": 1, "b": 400}, {"a": "3", "b": "1"}, "all")]


def test_bad_weights(spark):
    df = spark.createDataFrame([("a", 1)], "source string, id int")
    for weights, stop in (({}, "first"), ({"a": 0}, "first"), ({"a": 1}, "never")):
        with pytest.raises(ValueError):
            layout.interleave_weighted(df, "source", weights, ["id"], stop)


def test_empty(spark):
    df = spark.createDataFrame([], "source string, id int")
    assert layout.interleave_weighted(df, "source", {"a": 1, "b": 2}, ["id"], "all").count() == 0


def test_mix_of_corpora_with_the_same_keys(spark):
    df = spark.createDataFrame([(c, k) for c in "abc" for k in range(100)], "corpus string, id int")
    got = {r[0]: r[1] for r in corpora.mix_weighted(df, {"a": 0.3, "b": 0.7}, "id").groupBy("corpus").count().collect()}
    assert got == {"a": 42, "b": 99}


def test_counts_set_the_shares(spark, tmp_path):
    rows = [(c, "x", "train", f"{c}{i}", f"text {i}") for c, n in (("one", 50), ("two", 400)) for i in range(n)]
    writers.save(spark.createDataFrame(rows, "corpus string, config string, split string, utt_id string, words string"), str(tmp_path / "t"), ["corpus", "config", "split"])
    specs = corpora.parse_specs("one+two", "x+x", text_cols="words+words", samples="1+3")
    out = corpora.combine_sampled(spark, str(tmp_path / "t"), specs, "utt_id")
    got = {r[0]: r[1] for r in out.groupBy("source").count().collect()}
    assert got == {0: 50, 1: 149}
    assert [r.corpus for r in out.orderBy("position").limit(8).collect()] == ["two", "two", "one", "two"] + ["two", "two", "one", "two"]
