"""Training-data operators on small fixtures: brute force, round trips, held-out accuracy, odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from uttermill.llm import (  # noqa: E402
    class_model, exact_dedup, minhash, mixing, packing, pii, substrings, toxicity, url_filter, vector_graph,
)
from uttermill.llm.components import connected  # noqa: E402
from uttermill.llm.queries import RULES  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def corpus() -> list[tuple]:
    """Near copies, exact copies, a shared passage, a hot source, null and empty texts, one long text."""
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choices("abcdefgñé", k=rnd.randint(2, 6))) for _ in range(900)]
    passage = " ".join(rnd.choices(vocabulary, k=30))
    texts: list[str | None] = []
    for i in range(60):
        words = rnd.choices(vocabulary, k=rnd.randint(1, 90))
        texts.append(" ".join(words))
        if i % 3 == 0:
            texts.append(" ".join(words).upper() if i % 2 else "  ".join(words))
            copy = list(words)
            copy[rnd.randrange(len(copy))] = "other"
            texts.append("\n".join(copy))
        if i % 5 == 0:
            texts.append(" ".join(words[:20]) + " " + passage + "  " + " ".join(words[:7]))
    texts += [None, "", " \t\n", "one", "one", "One two", " ".join(rnd.choices(vocabulary, k=6000))]
    return [(i, t, "en", None if i % 9 == 0 else f"s{i % 4 if i % 2 else 0}", i, i, True) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(connected(spark.createDataFrame(links, "a long, b long")).collect())
    want = roots({n for x in links for n in x if n is not None} - set(), [x for x in links if None not in x])
    assert got == {n: r for n, r in want.items()}


def test_near_groups(docs, rows, nothing):
    sets = {}
    for i, t, *_ in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    want = roots(sets, links)
    got = by_id(minhash.near_groups(docs))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}
    assert len(links) > 20
    assert minhash.near_groups(nothing).count() == 0
    assert minhash.without_near_copies(docs).columns == docs.columns


def test_exact_groups(docs, rows, nothing):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    got = by_id(exact_dedup.exact_groups(docs))
    for body, ids in groups.items():
        for i in ids:
            want = (max(ids), len(ids), i == max(ids), hashlib.sha256(body.encode()).hexdigest())
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == want
    assert exact_dedup.exact_dedup(docs).count() == len(groups)
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_packing_is_exact_and_tight(docs, rows, nothing):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack(docs, TOKENIZER).collect()
    mine, places = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        mine[p.doc_id].append(p)
        places[p.sequence_id].append((p.offset, p.length))
    for i, t, *_ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)
        at = 0
        for p in sorted(mine[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].astype("<u4").tobytes())
        assert at == len(ids)
    padding = 0
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.LENGTH
        padding += 0 if end & (end - 1) == 0 else packing.LENGTH - end
    assert padding <= 0.02 * sum(p.length for p in pieces)
    assert packing.pack(nothing, TOKENIZER).count() == 0


def test_packing_limits(spark):
    rows = [(i, "word " * (i % 40 + 6), 5) for i in range(300)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, bearing long"), TOKENIZER, loss="bearing", segments=8, loss_limit=30)
    segments, bearing = collections.Counter(), collections.Counter()
    for r in out.collect():
        segments[r.sequence_id] += 1
        # A piece bears at most its tokens, and at most what its document bears.
        bearing[r.sequence_id] += min(5, r.length)
    assert max(segments.values()) <= 8 and max(bearing.values()) <= 30


@pytest.mark.parametrize("text", ["", "a", "a b", "x  y", "x  y", "a  b\n c", "don't  <|endoftext|> é　 z", "  a \x1f b", " lead 12 3,4"])
def test_encoder_equals_the_tokenizer(text):
    encoder = packing.Encoder(TOKENIZER)
    raw = np.frombuffer((text * 3).encode(), np.uint8)
    ids, begin = encoder.batch(raw, np.array([0, len(raw)]))
    assert ids.tolist() == encoder.whole.encode(text * 3, add_special_tokens=False).ids and begin.tolist() == [0, len(ids)]


def test_vectors(spark):
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(60, 8))
    data = [b + rnd.normal(scale=s, size=8) for b in base for s in (0.02, 0.1, 0.3)] + [base[0]] * 5
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [None] * 8, [float("inf")] * 8, [1.0]]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate([*data, *odd])]
    got = {r.vec_id: r for r in vector_graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = np.array(data) / np.linalg.norm(data, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = roots(range(len(rows)), zip(*np.nonzero(near), strict=True))
    assert [got[i].n_links for i in range(len(data))] == near.sum(1).tolist()
    assert all(got[i].component_id == want[i] and got[i].kept == (want[i] == i) for i in range(len(rows)))
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert vector_graph.near_vectors(empty).count() == 0


def test_urls(spark):
    pages = [
        (0, "http://a.example.com/en/x", ""), (1, "http://www.example.com/en/x", ""), (2, "http://x.net/es/1?q", ""),
        (3, "http://free.org/a", '<link href="http://x.net/es/9" rel="canonical">'), (4, "http://free.org/b#top", '<LINK rel=canonical href="/a">'),
        (5, "http://other.org/", '<meta http-equiv="refresh" content="0; url=http://www.example.com/en/z">'), (6, None, None), (7, "nothing", "<p>"),
        (8, "http://WWW.Example.COM", '<link rel="canonical" href="http://x.net/fr/">'), (9, "http://free.org/c", ""),
    ]
    out = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES)
    got = {r.page_id: r for r in out.collect()}
    assert [got[i].verdict for i in range(10)] == ["block", "allow", "block", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert (got[0].rule, got[1].rule, got[2].rule, got[3].rule) == ("example.com/en/", "www.example.com/en/", "net/es/", None)
    assert (got[2].host, got[2].path, got[6].host, got[8].host, got[8].path) == ("x.net", "/es/1", "", "www.example.com", "")
    log = spark.createDataFrame([("http://free.org/c", "http://y.net/fr/1")], "a string, b string")
    again = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES, redirects=log)
    assert {r.page_id: r.verdict for r in again.collect()}[9] == "block"


def test_repeats(docs, rows, nothing):
    first, own = {}, {}
    for i, t, *_ in rows:
        own[i] = WORD.findall(t or "")
        for k in range(len(own[i]) - 12):
            first.setdefault(tuple(own[i][k : k + 13]), i)
    got, removed = by_id(substrings.remove_repeats(docs)), 0
    for i, w in own.items():
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        assert (got[i].n_words, got[i].n_removed, got[i].kept_text) == (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
        removed += len(gone)
    assert removed > 300
    assert substrings.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("shared", [None, 7])
def test_repeats_under_one_key(spark, shared):
    passage, own = [f"p{k}" for k in range(20)], [f"w{k}" for k in range(60)]
    texts = [(1, passage), (shared, [*passage, *own[:5]]), (shared, own), (shared, [*own[:3], *passage]), (shared, [*passage, *own[:5]])]
    rows = [(i, " ".join(w)) for i, w in texts]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    got = sorted((r.n_words, r.n_removed, r.kept_text) for r in out.collect() if r.doc_id != 1)
    want = [(25, 20, " ".join(own[:5]))] * 2 + [(23, 20, " ".join(own[:3])), (60, 0, " ".join(own))]
    assert got == sorted(want)


def test_class_model(docs, rows, nothing):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows}
    tokens = {i: [*words(t), None] for i, t, *_ in rows}
    count = collections.Counter(x for i, w in tokens.items() if not held[i] for x in w)
    total, types = sum(count.values()), len(count)
    got = by_id(class_model.class_scores(docs))
    for i, w in tokens.items():
        base = sum(np.log10((count[x] + 0.1) / (total + 0.1 * (types + 1))) for x in w)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(count[x] > 0 for x in w), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert class_model.class_scores(nothing).count() == 0


def test_exchange_finds_classes():
    pairs = np.zeros((8, 8))
    for a in range(8):
        for b in range(8):
            pairs[a, b] = 50 if a % 2 != b % 2 else 1
    found = class_model.exchange(pairs, 2)
    assert len({found[i] for i in (0, 2, 4, 6)}) == len({found[i] for i in (1, 3, 5, 7)}) == 1 and found[0] != found[1]


def test_mixing(docs, rows, nothing):
    got = by_id(mixing.mix_sources(docs))
    sizes = collections.Counter()
    for i, t, _, source, *_ in rows:
        assert got[i].size == len(WORD.findall(t or ""))
        sizes[source] += got[i].size
    order = [*sorted(s for s in sizes if s), None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    taken = collections.Counter()
    for i, _, _, source, *_ in rows:
        assert got[i].source_size == sizes[source] and got[i].target == pytest.approx(target[source])
        assert got[i].taken <= 3 * got[i].size
        taken[source] += got[i].taken
    for s in order:
        largest = max(got[i].size for i, _, _, source, *_ in rows if source == s)
        assert abs(taken[s] - target[s]) <= largest
    assert by_id(mixing.mix_sources(docs.repartition(5))) == got
    assert mixing.mixed(docs).columns == docs.columns and mixing.mix_sources(nothing).count() == 0


def test_personal_data(spark, nothing):
    patterns = [re.compile(p) for p in (f"{pii.EMAIL_LOCAL}@{pii.EMAIL_HOST}", pii.IP, pii.CARD, pii.PHONE)]
    texts = [
        "mail a.b@c.de, x@y and a@b.c_d@e.f or @z.q", "1.2.3.4.5.6.7.8 300.1.1.1 10.0.0.255", "4111 1111-1111 1111 and 4111111111111112",
        "+1 (626) 555-5759 call +49 30 1234567, +12", None, "", "nothing here", "1" * 3000 + "." + "2" * 50, "ü é 1.1.1.1 +4912345678",
    ]
    got = by_id(pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts):
        want = []
        for k, p in enumerate(patterns):
            for m in p.finditer(t or ""):
                digits = re.sub("[^0-9]", "", m.group())
                if k == 1 and any(len(x.lstrip("0")) > 3 or int(x) > 255 for x in m.group().split(".")):
                    continue
                if k == 2 and not (12 <= len(digits) <= 19 and pii._luhn(digits)) or k == 3 and not 9 <= len(digits) <= 15:
                    continue
                want.append((m.start(), m.end(), k))
        assert got[i].base == pii._write(want)
        assert set(filter(None, got[i].base.split(","))) <= set(filter(None, got[i].spans.split(",")))
    assert pii.personal_data(nothing).count() == 0


def test_field_spreads_over_repeats():
    model = {"node": np.zeros((pii.FEATURES, pii.LABELS)), "chain": np.zeros((pii.LABELS, pii.LABELS)), "skip": 8 * np.eye(pii.LABELS)}
    text = "call +1 626 5555759 now, or 5555759 again"
    assert pii.more_spans([text], [pii.base_spans(text)], model) == [[(28, 35, 3)]]


def test_field_reaches_every_repeat():
    model = {"node": np.zeros((pii.FEATURES, pii.LABELS)), "chain": np.zeros((pii.LABELS, pii.LABELS)), "skip": 8 * np.eye(pii.LABELS)}
    text = "call +1 626 5555759 now" + ", or 5555759 again" * 50
    starts = [m.start() for m in re.finditer("5555759", text)][1:]
    assert pii.more_spans([text], [pii.base_spans(text)], model) == [[(a, a + 7, 3) for a in starts]]


def test_field_settles_along_a_chain():
    model = {"node": np.zeros((pii.FEATURES, pii.LABELS)), "chain": 12 * np.eye(pii.LABELS), "skip": np.zeros((pii.LABELS, pii.LABELS))}
    text = "+1 626 5555759" + "".join(f" x{k}" for k in range(40))
    g = pii._graph([text], [pii.base_spans(text)])
    want = np.linalg.matrix_power(np.exp(12 * np.eye(pii.LABELS)) / (np.exp(12) + pii.LABELS - 1) + (1 - np.eye(pii.LABELS)) / (np.exp(12) + pii.LABELS - 1), 40)[4]
    assert np.abs(pii.marginals(g, model)[-1] - want).max() < 0.01


def test_toxicity(spark, nothing):
    rnd = random.Random(1)
    plain, bad = [f"w{i}" for i in range(200)], ["vile", "scum"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = rnd.choices(plain, k=40)
        if toxic:
            w[rnd.randrange(40)] = rnd.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, "")]
    marks = spark.createDataFrame([*labels, (None, 1)], "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), marks))
    unseen = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert sum(p == y for p, y in unseen) >= 0.97 * len(unseen) and len(unseen) > 100
    assert got[1000].predicted == got[1001].predicted == 0
    assert toxicity.toxicity(nothing, marks).count() == 0


@pytest.mark.parametrize("learn", ["toxicity", "pii"])
def test_sample_is_fetched_in_parallel(spark, learn, monkeypatch):
    docs = spark.range(0, 700, 1, 7).selectExpr("id as doc_id", "concat('mail a', id, '@b.de') as text")
    marks = spark.range(0, 300, 1, 3).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    plans, real = [], type(docs).mapInArrow

    def note(self, *args, **more):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return real(self, *args, **more)

    monkeypatch.setattr(type(docs), "mapInArrow", note)
    toxicity.toxicity(docs, marks) if learn == "toxicity" else pii.personal_data(docs)
    assert "Repartition 1, true" in plans[0] and not any("Repartition 1, false" in p for p in plans)


def test_pipeline_columns(spark, docs, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns[:3] == ["doc_id", "start", "length"] and rows.count() > 0
