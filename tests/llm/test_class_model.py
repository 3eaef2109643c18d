"""The class model against loops over words: moves, classes, probabilities and scores."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest

from uttermill.llm import class_model as C
from uttermill.llm import words as X


def _likelihood(table):
    f = lambda x: float((x * np.log(np.maximum(x, 1.0))).sum())
    return f(table), f(table.sum(1)), f(table.sum(0))


def test_best_classes_against_moves_one_by_one(monkeypatch):
    monkeypatch.setattr(C, "SLICE", 7)
    rng = np.random.default_rng(3)
    k = C.CLASSES
    words, member = 12, rng.integers(0, k, 12)
    member[5] = member[4]
    counts = rng.integers(0, 4, (words, 2 * k)) * (rng.random((words, 2 * k)) < 0.15)
    counts[7] = 0
    pairs = rng.integers(0, 30, (k, k)).astype(float)
    for w in range(words):
        pairs[member[w]] += counts[w, :k]
        pairs[:, member[w]] += counts[w, k:]
    word, beside = np.nonzero(counts)
    found = C.best_classes(pairs, member, word, beside, counts[word, beside])
    for w in range(words):
        gain = []
        for c in range(k):
            right, left = pairs.copy(), pairs.copy()
            right[member[w]] -= counts[w, :k]
            right[c] += counts[w, :k]
            left[:, member[w]] -= counts[w, k:]
            left[:, c] += counts[w, k:]
            a, rows, _ = _likelihood(right)
            b, _, columns = _likelihood(left)
            gain.append(a - rows + b - columns)
        assert gain[found[w]] == pytest.approx(max(gain))
    assert found[7] == member[7]


def _hash(word):
    if word is None:
        return int(C.END_HASH)
    body = np.frombuffer(word.encode(), np.uint8)
    return int(X.hashes(body, np.array([0]), np.array([len(body)]))[0])


@pytest.mark.parametrize("sweeps", [1, 3])
def test_scores_against_loops(spark, monkeypatch, sweeps):
    monkeypatch.setattr(C, "CHUNK", 400)
    rng = np.random.default_rng(1)
    names = [["red", "blue", "green"], ["cat", "dog", "hen"], ["runs", "sits"]]
    rows = [(i, " ".join(f"{rng.choice(names[j % 3])}{rng.integers(0, 3) or ''}" for j in range(rng.integers(0, 30)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "x" * 5000), (203, "Red cat RUNS"), (203, "Red cat RUNS"), (None, "red dog")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chunks = C.encoded(docs)
    parts = chunks.collect()
    assert len(parts) > 5
    # Six heads, so that most words are placed by their own neighbours.
    coded, model = C.fit(chunks, 4, sweeps, first=6)
    vocabulary = {r["chunk"]: C._vocabulary(r.asDict())[0] for r in parts}
    kind, count = {}, {}
    for r in coded.collect():
        n, k = C._unpack(r["known"], ("<u4", r["n"]), ("u1", r["n"]))
        for w, c, x in zip(vocabulary[r["chunk"]].tolist(), n.tolist(), k.tolist(), strict=True):
            assert count.setdefault(w, c) == c and (not c or kind.setdefault(w, x) == x)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = [(i, [*(t or "").translate({c: c + 32 for c in range(65, 91)}).split(), None]) for i, t in rows]
    true = collections.Counter(_hash(w) for i, t in tokens if not held(i) for w in t)
    assert {w: c for w, c in count.items() if c} == dict(true)
    pairs = np.zeros((C.CLASSES, C.CLASSES))
    end = kind[_hash(None)]
    assert end == model["end_class"]
    for i, t in tokens:
        if not held(i):
            line = [end, *[kind[_hash(w)] for w in t]]
            for a, b in zip(line, line[1:]):
                pairs[a, b] += 1
    mass, types = np.zeros(C.CLASSES), np.zeros(C.CLASSES)
    for w, c in true.items():
        mass[kind[w]] += c
        types[kind[w]] += 1
    room = mass + 0.1 * (types + 1)
    share = room / (mass.sum() + 0.1 * (types.sum() + C.CLASSES))
    steps = (pairs + C.BACK * share) / (pairs.sum(1, keepdims=True) + C.BACK)
    assert np.allclose(model["steps"][:-1, :-1], steps)
    posterior = share * 0.1 / room / (share * 0.1 / room).sum()
    after = [*steps, posterior @ steps]
    for row in after:
        known = sum(row[kind[w]] * (c + 0.1) / room[kind[w]] for w, c in true.items())
        assert known + sum(row * 0.1 / room) == pytest.approx(1)
    got = collections.defaultdict(list)
    for r in C.class_scores(docs, word_sweeps=sweeps, first=6).collect():
        got[r.doc_id].append(r)
    plain = lambda w: (true[w] + 0.1) / (mass.sum() + 0.1 * (types.sum() + 1))
    for i, t in tokens:
        score, before = 0.0, end
        for w in map(_hash, t):
            chance = after[before][kind[w]] * (true[w] + 0.1) / room[kind[w]] if true[w] else sum(after[before] * 0.1 / room)
            score += np.log10(C.SHARE * chance + (1 - C.SHARE) * plain(w))
            before = kind[w] if true[w] else C.CLASSES
        assert got[i][0].score == pytest.approx(score)
    assert len(got[203]) == 2 and got[203][0] == got[203][1]


def test_words_of_one_kind_meet_in_classes_beyond_the_first(spark):
    """3,000 words, each seen a few times, of which only the 1,024 first can be heads."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        line = []
        for _ in range(8):
            line += [f"a{rng.integers(0, 1500)}xxx", f"b{rng.integers(0, 1500)}xxx"]
        rows.append((i, " ".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    r = C.class_scores(docs).where("not held_out").agg({"base_score": "sum", "score": "sum", "n_tokens": "sum"}).first()
    base, score = r["sum(base_score)"] / r["sum(n_tokens)"], r["sum(score)"] / r["sum(n_tokens)"]
    # Alternation halves the choice at each word.
    assert score > base + 0.2


def test_empty_table_and_sweeps(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string, score double, held_out string")
    assert C.class_scores(nothing).count() == 0
    with pytest.raises(ValueError):
        C.class_scores(nothing, word_sweeps=0)
