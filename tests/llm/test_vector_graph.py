"""Vector links on several shards, lengths and sparse tables against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from uttermill.llm import vector_graph as V


def _brute(rows, threshold=0.95):
    ids = np.array([i for i, _ in rows])
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    top = np.arange(len(ids))
    while True:
        low = np.minimum(top, [top[r].min() if r.any() else len(ids) for r in near])
        if (low == top).all():
            return {int(i): (int(n), int(ids[c])) for i, n, c in zip(ids, near.sum(1), top, strict=True)}
        top = low


def test_several_shards_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(700):
        base = rng.normal(size=16)
        rows += [base + 0.04 * rng.normal(size=16) for _ in range(rng.integers(1, 14))]
    rows = [(i, v.tolist()) for i, v in enumerate(rows)]
    true = _brute(rows)
    got = {r.vec_id: r for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()}
    assert len(rows) > 3 * V.PART and len(got) == len(rows)
    links = sum(n for n, _ in true.values())
    assert 0.95 * links <= sum(r.n_links for r in got.values()) <= links
    assert all(got[i].n_links <= n for i, (n, _) in true.items())
    assert sum(got[i].component_id == c for i, (_, c) in true.items()) >= 0.95 * len(rows)


def test_each_length_is_compared(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (9, [1.0, 2.001])]
    rows += [(10 + i, [float(i), 1.0, 0.0]) for i in range(3)] + [(20, [2.0, 1.01, 0.0]), (30, [5.0]), (31, [0.0, 0.0]), (32, None), (33, [1.0, 2.0, 0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {i: got[i] for i in (1, 2, 9)} == {1: (2, 1), 2: (2, 1), 9: (2, 1)}
    assert got[12] == (1, 12) and got[20] == (1, 12)
    assert all(got[i] == (0, i) for i in (10, 11, 30, 31, 32, 33))


def test_audit_grows_until_links_are_seen(spark, monkeypatch):
    rows = [(i, [float(j == i % 50) + (0.01 if j == 50 and i >= 3000 else 0.0) for j in range(51)]) for i in range(50)]
    rows += [(3000, rows[7][1][:50] + [0.01])]
    reps = spark.createDataFrame(rows, "rep long, unit array<double>")
    links = spark.createDataFrame([], "a long, b long")
    assert V.audit(reps, links, 0.95, samples=(2, 20, 100), least=1)[1] in (0, 1)
    assert V.audit(reps, links, 0.95, samples=(2, 100), least=2) == (0, 1)
    # A search that finds nothing is no result.
    monkeypatch.setattr(V, "_links", lambda *a: links)
    with pytest.raises(RuntimeError):
        V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


def test_large_shards_are_split_level_by_level(spark, monkeypatch):
    for name, value in (("PART", 60), ("MOST", 5), ("ROOM", 2), ("CHUNK", 100)):
        monkeypatch.setattr(V, name, value)
    levels, sizes = [], []
    plain = V.staged

    def spy(df, name):
        out = plain(df, name)
        if name == "split-shards":
            levels.append(out.count())
        if name == "parts":
            sizes.append(out.agg({"parts": "max"}).first()[0])
        return out

    monkeypatch.setattr(V, "staged", spy)
    rng = np.random.default_rng(9)
    dense = rng.normal(size=12)
    rows = [dense + 0.5 * rng.normal(size=12) for _ in range(400)]
    for _ in range(400):
        base = rng.normal(size=12)
        rows += [base + 0.03 * rng.normal(size=12) for _ in range(rng.integers(1, 6))]
    rows = [(i, v.tolist()) for i, v in enumerate(rows)]
    true = _brute(rows)
    got = {r.vec_id: r for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()}
    # Five centres for 1,500 vectors: shards of about 900 become shards of one or two parts, in two levels or more.
    assert len(levels) >= 2 and sizes[0] <= 4
    links = sum(n for n, _ in true.values())
    assert len(got) == len(rows) and 0.9 * links <= sum(r.n_links for r in got.values()) <= links
    assert all(got[i].n_links <= n for i, (n, _) in true.items())
