"""One or no key for many rows: targets of mixes and bounds of what is learnt from."""

from __future__ import annotations

import collections
import zlib

import pyarrow as pa
import pytest

from uttermill.llm import minhash, mixing, pii, toxicity


@pytest.mark.parametrize("keys", ["null", "seven", "own"])
@pytest.mark.parametrize("same", [True, False])
def test_mix_meets_targets_whatever_the_keys(spark, keys, same):
    rows = []
    for i in range(300):
        key = None if keys == "null" else i % 7 if keys == "seven" else i
        text = "one two three four five" if same else f"a{i} two three four five"
        rows.append((key, text, "abc"[i // 200 + (i // 250)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 300
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        target.setdefault(r.source_size, set()).add(r.target)
        assert r.taken in (0, 5, 10, 15)
    # Sources b and c have 50 rows each: targets 500 and 750 words, the latter at its top.
    assert taken[1000] == pytest.approx(min(target[1000]), abs=2.5)
    assert taken[500 // 2] == pytest.approx(sum(target[500 // 2]), abs=5)
    again = mixing.mix_sources(docs.repartition(2)).collect()
    count = lambda rows: collections.Counter((r.doc_id, r.size, r.target, r.taken) for r in rows)
    assert count(again) == count(got)


def _learnt_rows(monkeypatch, module, run):
    """Rows that reach the one learning task."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, plain = [], DataFrame.repartition

    def spy(self, n, *columns):
        if n == 1:
            seen.append(self.count())
        return plain(self, n, *columns)

    monkeypatch.setattr(DataFrame, "repartition", spy)
    result = run()
    assert result.count() > 0
    return seen[0]


def test_learning_rows_of_one_key_are_bounded(spark, monkeypatch):
    rows = [(1, f"call 555-{i:04d} now") for i in range(600)] + [(2, "x 1")] * 300 + [(None, "y 2"), (3, "z 3 " * 2000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _learnt_rows(monkeypatch, pii, lambda: pii.personal_data(docs, sample=50)) == 50
    monkeypatch.undo()
    # Without the text of 8,000 code points, equal rows once.
    assert _learnt_rows(monkeypatch, pii, lambda: pii.personal_data(docs, budget=64 * 4000)) == 602
    monkeypatch.undo()
    assert _learnt_rows(monkeypatch, pii, lambda: pii.personal_data(docs, budget=64 * 20)) <= 77


def test_labelled_rows_of_one_key_are_bounded(spark, monkeypatch):
    # Keys that are not held out.
    a, b, c = [k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1][:3]
    rows = [(a, f"bad word {i}") for i in range(600)] + [(b, "fine text")] * 50 + [(None, "a"), (c, None), (c, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(a, 1), (b, 0), (b, 0), (c, 0), (None, 1)], "doc_id long, toxic int")
    # Ten texts of one key, one of another, an empty and a null one.
    assert _learnt_rows(monkeypatch, toxicity, lambda: toxicity.toxicity(docs, marks, sample=10)) == 13
    monkeypatch.undo()
    # 768 code points of texts that have 10 to 12.
    assert 3 + 64 <= _learnt_rows(monkeypatch, toxicity, lambda: toxicity.toxicity(docs, marks, budget=64 * 12)) <= 3 + 76
    assert isinstance(toxicity.toxicity(docs, marks).toArrow(), pa.Table)


def test_one_key_with_several_texts_keeps_its_links(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, c), (1, a), (5, c), (5, None), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(docs).collect())
    want = [(1, 56, 1, True)] * 3 + [(2, 57, 1, False), (3, 57, 1, False), (4, 56, 4, True), (5, 56, 4, False), (5, 0, 5, True), (None, 56, None, True)]
    assert got == collections.Counter(want)
    # The same key in two components: each text has its own.
    rows = [(8, a), (8, b), (2, a + " more"), (3, b + " more")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(2, 2, True), (3, 3, True), (8, 2, False), (8, 3, False)]
