"""The Merkle manifest against a plain recursion, its layout, and odd rows."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from uttermill.llm import merkle


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves: list[str]) -> list[list[str]]:
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[str]:
    return [lv[(at >> k) ^ 1] if (at >> k) ^ 1 < len(lv) else "" for k, lv in enumerate(levels[:-1])]


def brute(rows):
    """{(doc_id, leaf): (subroot, root, siblings)} for (doc_id, lang, leaf) rows; equal rows give several values."""
    groups = collections.defaultdict(list)
    for doc_id, lang, leaf in rows:
        groups[lang].append(((doc_id is not None, doc_id or 0), leaf, doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([leaf for _, leaf, _ in sorted(groups[g], key=lambda r: r[:2])]) for g in names]
    top = levels_of([t[-1][0] for t in trees])
    out = collections.defaultdict(list)
    for n, (g, tree) in enumerate(zip(names, trees, strict=True)):
        for at, (_, leaf, doc_id) in enumerate(sorted(groups[g], key=lambda r: r[:2])):
            out[doc_id, g, leaf].append((tree[-1][0], top[-1][0], tuple(siblings(tree, at) + siblings(top, n))))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 7, 11])
def test_layout_keeps_subtrees_together(levels):
    address = merkle.layout(levels)
    assert sorted(address[1:]) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        assert sorted(address[1 : 1 << top]) == list(range((1 << top) - 1))
        # A lower subtree is one run of addresses.
        for root in range(1 << top, 2 << top):
            nodes, mine = [root], []
            while nodes and nodes[0] < 1 << levels:
                mine += nodes
                nodes = [c for n in nodes for c in (2 * n, 2 * n + 1)]
            places = np.sort(address[mine])
            assert (np.diff(places) == 1).all()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    out = [(i, "en", sha(f"{i}")) for i in range(2600)]
    out += [(i, None, sha(f"n{i}")) for i in range(9000, 9003)]
    out += [(i, lang, sha(f"{lang}{i}")) for lang, n in (("", 1), ("de", 1024), ("é", 1025), ("Z", 5)) for i in range(20000, 20000 + n)]
    out += [(7, "Z", sha("twice"))] * 3 + [(None, "Z", sha("none")), (None, "Z", sha("two"))]
    rnd.shuffle(out)
    return out


def test_manifest_equals_recursion(spark, rows):
    df = spark.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, lang string, leaf string, path long").repartition(5)
    manifest = merkle.build(df, "lang", "doc_id", "leaf")
    got = collections.defaultdict(list)
    for r in merkle.prove(manifest).withColumn("folded", merkle.fold("digest")).collect():
        assert r.folded == r.root
        got[r.doc_id, r.lang, r.digest].append((r.subroot, r.root, tuple(s.digest for s in r.path)))
    assert {k: sorted(v) for k, v in got.items()} == brute(rows)


def test_proofs_of_some_rows_from_a_written_manifest(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string")
    manifest = merkle.build(df, "lang", "doc_id", "leaf")
    merkle.write_manifest(manifest, str(tmp_path))
    again = merkle.read_manifest(spark, str(tmp_path))
    assert again.root == manifest.root
    want = brute(rows)
    some = merkle.prove(again, again.leaves.where("lang = 'en' AND doc_id IN (0, 1023, 1024, 2599)")).collect()
    assert len(some) == 4
    for r in some:
        assert [(r.subroot, r.root, tuple(s.digest for s in r.path))] == want[r.doc_id, "en", r.digest]
    forged = df.withColumn("leaf", F.when((F.col("doc_id") == 1500) & (F.col("lang") == "en"), F.lit(sha("x"))).otherwise(F.col("leaf")))
    other = merkle.build(forged, "lang", "doc_id", "leaf")
    assert other.root != manifest.root
    spots = merkle.changed(manifest, other).collect()
    assert [r.block for r in spots] == [1500 >> merkle.HEIGHT]
    wrong = merkle.prove(manifest, manifest.leaves.where("lang = 'en' AND doc_id = 3")).withColumn("folded", merkle.fold(F.lit(sha("x"))))
    assert wrong.first().folded != manifest.root


def test_empty_and_single(spark):
    shape = "doc_id long, lang string, leaf string"
    none = merkle.build(spark.createDataFrame([], shape), "lang", "doc_id", "leaf")
    assert none.root is None
    assert merkle.prove(none).count() == 0
    one = merkle.build(spark.createDataFrame([(1, None, sha("a"))], shape), "lang", "doc_id", "leaf")
    row = merkle.prove(one).first()
    assert (row.root, row.subroot, row.path) == (sha("a"), sha("a"), [])


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "en", sha("a"))], "doc_id long, tree string, leaf string")
    with pytest.raises(ValueError):
        merkle.build(df, "tree", "doc_id", "leaf")


def test_leaf_digest_tells_values_apart(spark):
    long = "é" * 300_000
    rows = [(1, None), (1, ""), (1, "-"), (None, "1"), (None, None), (1, long)]
    df = spark.createDataFrame(rows, "a long, b string")

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    got = [r.h for r in df.select(merkle.leaf_digest(["a", "b"]).alias("h")).collect()]
    assert sorted(got) == sorted(sha(field(a) + field(b)) for a, b in rows)
    assert len(set(got)) == len(rows)
