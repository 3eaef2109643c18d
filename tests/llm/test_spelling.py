"""Spelling variants against all pairs, the machines against sets, and odd rows."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from uttermill.llm import spelling

SHAPE = "word string, n long, a string, short int"


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute(words: dict[str, int]) -> set[tuple]:
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] and words[best] > words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), form[w] and words[form[w]]) for w in words}


def lexicon(seed: int, alphabet: str, size: int, lengths: range) -> dict[str, int]:
    rnd = random.Random(seed)
    return {"".join(rnd.choices(alphabet, k=rnd.choice(lengths))): rnd.choice([0, 1, 1, 2, 3, 8, 20]) for _ in range(size)}


@pytest.mark.parametrize("seed", range(4))
def test_machine_accepts_its_words_only(seed):
    words = sorted(lexicon(seed, "ab", 60, range(0, 7)))
    machine = spelling.Machine()
    start = machine.accept(words)

    def all_from(state, prefix=""):
        found = [prefix] if machine.final[state] else []
        return found + [w for a, s in machine.arcs[state].items() for w in all_from(s, prefix + a)]

    assert sorted(all_from(start)) == words
    # Minimal: no two states accept the same words.
    rights = [tuple(sorted(all_from(s))) for s in range(len(machine.final))]
    assert len(set(rights)) == len(rights)


@pytest.mark.parametrize(("alphabet", "limit"), [("ab", 200_000), ("ab", 40), ("abcé\U0001f600", 30), ("abcdefgh", 200_000)])
def test_variants_equal_brute_force(spark, alphabet, limit):
    words = lexicon(len(alphabet), alphabet, 260, range(0, 9))
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], SHAPE).repartition(3)
    got = spelling.variants(df, limit=limit).collect()
    assert len(got) == len(words)
    assert {tuple(r) for r in got} == brute(words)


def test_each_pair_once(spark):
    words = lexicon(9, "aab", 200, range(4, 9))
    for limit in (10**6, 25):
        pairs = spelling.near_pairs(spark.createDataFrame(list(words.items()), "word string, n long"), limit).collect()
        seen = collections.Counter(frozenset((r.a, r.b)) for r in pairs)
        assert set(seen) == {frozenset((u, v)) for u in words for v in words if one_edit(u, v)}
        assert set(seen.values()) <= {1}


def test_odd_rows(spark):
    assert spelling.variants(spark.createDataFrame([], SHAPE)).count() == 0
    long = "é" * 3000
    rows = [(None, 5, "x", 1), ("abcde", None, None, None), ("abcde", 1, "", 0), ("abcdf", 2, None, 2), ("abcdf", 2, None, 2),
            (long, 1, None, None), (long[:1500] + "x" + long[1500:], 7, None, None)]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, SHAPE), limit=500).collect()}
    assert set(got) == {"abcde", "abcdf", long, rows[-1][0]}
    assert (got["abcde"].form, got["abcde"].root, got["abcde"].n, got["abcde"].n_near, got["abcde"].form_n) == ("abcdf", "abcdf", 1, 1, 4)
    assert got[long].root == rows[-1][0]
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame(rows, SHAPE), factor=1.0)


def test_vocabulary(spark):
    docs = spark.createDataFrame([("Don't REPEAT repeat",), ("repeat Éclair éclair",), (None,), ("",)], "text string")
    got = spelling.vocabulary(docs, spelling.runs("text", "[A-Za-zÀ-ÿ]+"), least=3, often=1).collect()
    assert {(r.word, r.n) for r in got} == {("don", 1), ("repeat", 3), ("Éclair", 1), ("éclair", 1)}


def test_long_chain_ends_at_its_root(spark):
    # Each step changes one letter and doubles the count.
    words = {"a" * (12 - i) + "b" * i: 2**i for i in range(13)}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {r.root for r in got.collect()} == {"b" * 12}
    assert got.where(F.col("form").isNull()).count() == 1
