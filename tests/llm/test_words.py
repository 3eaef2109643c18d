"""Word hashes: no structure by which different words meet, and what depended on it."""

from __future__ import annotations

import random

import numpy as np
import pytest

from uttermill.llm import words


def hashed(texts: list[bytes], seed: int = 1) -> np.ndarray:
    ends = np.cumsum([len(t) for t in texts])
    body = np.frombuffer(b"".join(texts), np.uint8)
    return words.hashes(body, ends - np.array([len(t) for t in texts]), ends, seed)


def thue_morse(n: int) -> tuple[str, str]:
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_equal_spans_and_no_others_are_equal():
    rnd = random.Random(1)
    texts = [bytes(rnd.choices(range(256), k=rnd.choice([0, 1, 2, 7, 8, 9, 16, 17, 127, 128, 129, 400]))) for _ in range(3000)]
    texts += texts[:500] + [b"", b"\0", b"\0\0", b"\0" * 8, b"\0" * 9, b"\0" * 128, b"\0" * 129]
    rnd.shuffle(texts)
    for seed in (1, 2, 5):
        got = hashed(texts, seed)
        by_text: dict[bytes, int] = {}
        for t, h in zip(texts, got.tolist(), strict=True):
            assert by_text.setdefault(t, h) == h
        assert len(set(by_text.values())) == len(by_text)
    assert not (hashed(texts, 1) == hashed(texts, 2)).any()


def test_place_in_the_text_does_not_matter():
    word, body = b"caf\xc3\xa9-and-more", b""
    spans = []
    for pad in range(20):
        body += b" " * pad
        spans.append((len(body), len(body) + len(word)))
        body += word
    first, end = np.array(spans).T
    assert len(set(words.hashes(np.frombuffer(body, np.uint8), first, end).tolist())) == 1


@pytest.mark.parametrize("n", [16, 64, 128, 1024, 4096])
def test_words_that_cancel_out_in_polynomials(n):
    a, b = (w.encode() for w in thue_morse(n))
    for seed in (1, 2, 5):
        x, y = hashed([a, b], seed).tolist()
        assert x != y


def test_operators_tell_such_words_apart(spark):
    """One text with the word, one with its complement: equal in a polynomial hash, different here."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from uttermill.llm import minhash, packing, substrings

    one, two = thue_morse(1024)
    texts = [" ".join(["same"] * 3 + [w] + ["same"] * 9) for w in (one, two)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert [r.n_removed for r in substrings.remove_repeats(docs).orderBy("doc_id").collect()] == [0, 0]
    assert [r.component_id for r in minhash.near_groups(docs).orderBy("doc_id").collect()] == [0, 1]
    import zlib

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack(docs, path).orderBy("doc_id", "start").collect()
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for p in pieces:
            if p.doc_id == doc_id:
                want = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(want)
