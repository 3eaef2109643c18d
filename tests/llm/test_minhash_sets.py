"""Full sets of the documents that have a list, and of no others by a shuffle of texts."""

from __future__ import annotations

import pytest

from uttermill.llm import minhash
from uttermill.operators import resume


def _rows(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), "a text of its own that no one shares at all", None, ""]
    texts += [" ".join(f"u{k}x{i}" for i in range(30)) for k in range(20)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (101, texts[1]), (101, texts[2])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _found(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(docs).collect()), key=repr)


@pytest.mark.parametrize("bits", [None, 64])
def test_texts_are_not_shuffled(spark, monkeypatch, bits):
    """A filter of the listed keys chooses the texts; one that is full changes no result."""
    docs = _rows(spark)
    if bits:
        monkeypatch.setattr(resume, "bits_for", lambda n: bits)
    plans, staged = [], minhash.staged

    def spy(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(minhash, "staged", spy)
    got = _found(docs)
    assert len(plans) == 1 and "LeftSemi" not in plans[0]
    by_id = {(k, n): c for k, n, c, _ in got}
    assert by_id[(100, 36)] == by_id[(101, 36)] == 100
    assert by_id[(102, 7)] == by_id[(101, 7)] == 101
    assert [(n, c) for k, n, c, _ in got if k is None] == [(36, None)]
    assert len(got) == 28


def test_filter_grows_with_its_keys():
    assert resume.bits_for(0) == 1 << 16
    assert all(16 * n <= resume.bits_for(n) <= 32 * n for n in (5000, 100_000, 4_000_000))
    assert resume.bits_for(10**9) == 1 << 26
