"""Personal data: fixed patterns, completed by a skip-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Kinds in the order that sorts equal starts.
KINDS = ("email", "ip", "card", "phone")
#: The patterns of the four kinds.
EMAIL_LOCAL, EMAIL_HOST = r"[A-Za-z0-9._%+-]+", r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The same matches without going back over a run of digits: what comes before a full run
# of digits is never in the middle of one, and no quantifier gives a character back.
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(PHONE)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SIGNAL = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_EDGE = ".,;:!?\"'()[]{}<>"

#: Texts learnt from, rounds of learning, the largest change of settled messages, and what a span needs.
SAMPLE, STEPS, SETTLED, SURE = 4000, 200, 1e-4, 0.95
#: Code points learnt from.
BUDGET = 1 << 25
FEATURES = 64
LABELS = 1 + len(KINDS)

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the four patterns: leftmost matches of each kind that do not overlap, checked."""
    out: list[Span] = []
    if not _SIGNAL.search(text):
        return out
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end(), 0))
            free = host.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def tokens_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, core) of the words that hold a digit or ``@``, stripped of punctuation at the ends.

    All other words are outside by the model's design, so the field has no node for them.
    """
    out = []
    for m in _TOKEN.finditer(text):
        word = m.group()
        left = len(word) - len(word.lstrip(_EDGE))
        core = word.strip(_EDGE)
        if core:
            out.append((m.start() + left, m.start() + left + len(core), core))
    return out


def _features(text: str, tokens: list[tuple[int, int, str]], i: int) -> list[int]:
    """Active features of token ``i``: its shape, and whether its neighbours are candidates too."""
    start, end, core = tokens[i]
    digits = sum("0" <= c <= "9" for c in core)
    letters = sum(c.isalpha() for c in core)
    dots, dashes = core.count("."), core.count("-")
    near_l = i > 0 and start - tokens[i - 1][1] <= 3
    near_r = i + 1 < len(tokens) and tokens[i + 1][0] - end <= 3
    checks = [
        "@" in core, "@" in core and "." in core.partition("@")[2], core.startswith("+"), start > 0 and text[start - 1] == "+",
        start > 0 and text[start - 1] == "(", end < len(text) and text[end] == ")", dots == 3 and not letters, letters > 0, letters > digits,
        "=" in core, "_" in core, "/" in core, ":" in core, near_l, near_r, len(core) > 24,
        digits == len(core), 12 <= digits <= 19 and not letters and not dots, 9 <= digits <= 15 and not letters,
        digits == len(core) and 12 <= digits <= 19 and _luhn(core if core.isascii() else "1"),
        dots == 3 and not letters and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in core.split(".")),
    ]
    return [0, *[1 + k for k, c in enumerate(checks) if c], 24 + min(digits, 20), 46 + min(dots, 4), 52 + min(dashes, 4), 58 + min(letters, 4)]


def _graph(texts: list[str], spans: list[list[Span]]) -> dict:
    """Nodes of all texts, chain edges between neighbours, and a hub for each group of equal tokens.

    Equal tokens (without case and outer punctuation) share a hub, and so do tokens with
    equal digits: any two repeats are two edges apart, and edges grow with the text only.
    """
    feats, owner, where, gold, chain, hubs, skip = [], [], [], [], [], [], []
    for t, text in enumerate(texts):
        if not _SIGNAL.search(text):
            continue
        tokens, groups = tokens_of(text), {}
        first, s = len(feats), 0
        own = sorted(spans[t])
        for i, (start, end, core) in enumerate(tokens):
            node = first + i
            feats.append(_features(text, tokens, i))
            owner.append(t)
            where.append((start, end))
            while s < len(own) and own[s][1] <= start and (s + 1 >= len(own) or own[s + 1][0] <= start):
                s += 1
            hit = next((k + 1 for a, b, k in own[max(0, s - 3) : s + 4] if a < end and start < b), 0)
            gold.append(hit)
            if i and start - tokens[i - 1][1] <= 3:
                chain.append((node - 1, node))
            digits = _digits(core)
            for word in {core.lower(), digits if len(digits) >= 7 else core.lower()}:
                groups.setdefault(word, []).append(node)
        for nodes in groups.values():
            if len(nodes) > 1:
                skip += [(len(hubs), node) for node in nodes]
                hubs.append(t)
    pack = lambda e: np.array(e, np.int64).reshape(-1, 2)
    x = np.zeros((len(feats), FEATURES), np.float32)
    for i, f in enumerate(feats):
        x[i, f] = 1
    ints = {"owner": np.array(owner, np.int64), "gold": np.array(gold, np.int64), "hubs": np.array(hubs, np.int64)}
    return {"x": x, "where": where, "chain": pack(chain), "skip": pack(skip), **ints}


def _votes(g: dict) -> np.ndarray:
    """How often each hub's tokens were matched as each label."""
    votes = np.zeros((len(g["hubs"]), LABELS), np.int64)
    np.add.at(votes, (g["skip"][:, 0], g["gold"][g["skip"][:, 1]]), 1)
    return votes


def _seen_kind(votes: np.ndarray) -> np.ndarray:
    """The kind matched most often, 0 where none was."""
    return np.where(votes[:, 1:].any(1), votes[:, 1:].argmax(1) + 1, 0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[str]) -> dict:
    """Potentials by pseudo-likelihood: each label given its token and the labels it is linked to.

    A hub has the kind that the other tokens of its group were matched as.
    """
    g = _graph(texts, [base_spans(t) for t in texts])
    x, y = g["x"], g["gold"]
    one = np.eye(LABELS, dtype=np.float32)[y]

    def beside(edges: np.ndarray, a: int, b: int) -> np.ndarray:
        total = np.zeros_like(one)
        np.add.at(total, edges[:, a], one[edges[:, b]])
        return total

    hub, node = g["skip"].T
    others = _votes(g)[hub]
    others[np.arange(len(node)), y[node]] -= 1
    repeated = np.zeros_like(one)
    np.add.at(repeated, node, np.eye(LABELS, dtype=np.float32)[_seen_kind(others)])
    near = {"node": x, "left": beside(g["chain"], 1, 0), "right": beside(g["chain"], 0, 1), "skip": repeated}
    weight = {k: np.zeros((v.shape[1], LABELS)) for k, v in near.items()}
    square = {k: np.full_like(v, 1e-8) for k, v in weight.items()}
    for _ in range(STEPS if len(x) else 0):
        off = (_softmax(sum(near[k] @ weight[k] for k in near)) - one) / max(len(x), 1)
        for k in near:
            grad = near[k].T @ off + 1e-5 * weight[k]
            square[k] += grad * grad
            weight[k] -= 0.5 * grad / np.sqrt(square[k])
    # One table per edge kind: rows are the label of the earlier token, or of the hub.
    return {"node": weight["node"], "chain": (weight["left"] + weight["right"].T) / 2, "skip": weight["skip"]}


def marginals(g: dict, model: dict) -> np.ndarray:
    """Label probabilities of all nodes by loopy belief propagation; pattern matches are observed.

    A hub with a matched token is observed too, as the kind matched most often.  Messages
    of a text pass until none changes by more than ``SETTLED``, whatever other texts are
    there; one that never settles ends after 100 rounds and four for each of its nodes.
    """
    nodes = len(g["x"])
    local = np.concatenate([g["x"] @ model["node"], np.zeros((len(g["hubs"]), LABELS))])
    gold = np.concatenate([g["gold"], _seen_kind(_votes(g))])
    text = np.concatenate([g["owner"], g["hubs"]])
    seen = gold > 0
    local[seen] = -1e3
    local[seen, gold[seen]] = 0.0
    local = np.exp(local - local.max(1, keepdims=True))
    pairs = {"chain": g["chain"], "skip": np.stack([g["skip"][:, 0] + nodes, g["skip"][:, 1]], 1)}
    tables = {k: np.exp(model[k] - model[k].max()) for k in pairs}
    limit = 100 + 4 * np.bincount(text, minlength=1)
    out = np.empty_like(local)
    live = np.arange(len(local))
    ahead = {k: np.full((len(e), LABELS), 1 / LABELS) for k, e in pairs.items()}
    back = {k: m.copy() for k, m in ahead.items()}
    turn = 0
    while len(live):
        log = np.zeros_like(local)
        for k, e in pairs.items():
            np.add.at(log, e[:, 1], np.log(ahead[k] + 1e-30))
            np.add.at(log, e[:, 0], np.log(back[k] + 1e-30))
        belief = local * np.exp(log - log.max(1, keepdims=True))
        out[live] = belief
        change = np.zeros(len(limit))
        for k, e in pairs.items():
            if len(e):
                f, b = (belief[e[:, 0]] / (back[k] + 1e-30)) @ tables[k], (belief[e[:, 1]] / (ahead[k] + 1e-30)) @ tables[k].T
                f = 0.5 * ahead[k] + 0.5 * f / np.maximum(f.sum(1, keepdims=True), 1e-300)
                b = 0.5 * back[k] + 0.5 * b / np.maximum(b.sum(1, keepdims=True), 1e-300)
                moved = np.maximum(np.abs(f - ahead[k]).max(1), np.abs(b - back[k]).max(1))
                np.maximum.at(change, text[e[:, 0]], moved)
                ahead[k], back[k] = f, b
        turn += 1
        open_ = (change > SETTLED) & (turn <= limit)
        stay = open_[text]
        if not stay.all():
            # Settled texts leave with their beliefs.
            place = np.cumsum(stay) - 1
            for k, e in pairs.items():
                keep = stay[e[:, 0]]
                pairs[k], ahead[k], back[k] = place[e[keep]], ahead[k][keep], back[k][keep]
            live, local, text = live[stay], local[stay], text[stay]
    out = out[:nodes]
    return out / np.maximum(out.sum(1, keepdims=True), 1e-300)


def more_spans(texts: list[str], spans: list[list[Span]], model: dict) -> list[list[Span]]:
    """What the field adds: runs of linked tokens of one kind that no pattern covers."""
    g = _graph(texts, spans)
    added: list[list[Span]] = [[] for _ in texts]
    if not len(g["x"]):
        return added
    chance = marginals(g, model)
    label = np.where(chance.max(1) >= SURE, chance.argmax(1), 0)
    linked = {(int(a), int(b)) for a, b in g["chain"]}
    for i in np.flatnonzero((label > 0) & (g["gold"] == 0)):
        own, (start, end), kind = added[g["owner"][i]], g["where"][i], int(label[i]) - 1
        # Numbers of one phone, or of one card written in groups, are one span.
        joins = kind == 3 or kind == 2 and own and end - own[-1][0] <= 23
        if joins and (i - 1, i) in linked and label[i - 1] == label[i] and g["gold"][i - 1] == 0 and own:
            own[-1] = (own[-1][0], end, kind)
        else:
            own.append((start, end, kind))
    return added


def _write(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, budget: int = BUDGET) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans) for every row of ``docs``.

    ``base`` lists the matches of the four patterns and the counts are theirs;
    ``spans`` holds all of these and what the field adds, as kind:start:end in code
    points, by start and kind.  Whole texts are read.

    The field's nodes are the words with a digit or ``@``.  Neighbouring nodes share
    potentials, and so do all repeated or similar ones of a text by way of one hub; pattern matches are
    observed, and loopy message passing until nothing changes gives every other node its label.  A span
    is added at a probability of 0.95 or more.  Potentials are learnt from the pattern matches in
    at most ``sample`` texts that hold a digit or ``@``, chosen by a hash of the key; equal rows
    count once, texts above a 64th of ``budget`` code points are not learnt from, and all of them hold ``budget`` at most.

    Null and empty texts have no span.  Repeated rows are judged each; null keys stay
    null.  An empty table gives an empty result.
    """
    own = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    mark = [F.xxhash64(F.lit(9), "_key").alias("_rank"), F.xxhash64(F.lit(9), "_text").alias("_mark")]
    some = own.where(F.regexp_like("_text", F.lit("[0-9@]"))).select(*mark, F.length("_text").alias("_length"))
    chosen = some.where(F.col("_length") <= budget // 64).distinct().orderBy("_rank", "_mark").limit(sample)
    # At most ``sample`` rows.
    chosen = chosen.withColumn("_sum", F.sum("_length").over(W.orderBy("_rank", "_mark"))).where(F.col("_sum") <= budget)
    picked = own.select("_text", *mark).join(F.broadcast(chosen.select("_rank", "_mark")), ["_rank", "_mark"]).dropDuplicates(["_rank", "_mark"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(b.column("_rank").to_pylist(), b.column("_text").to_pylist(), strict=True))
        model = fit([t for _, t in rows])
        yield pa.RecordBatch.from_arrays([pa.array(list(model)), pa.array([m.reshape(-1).tolist() for m in model.values()])], ["name", "weights"])

    # A shuffle, so that documents are read in parallel and only chosen rows reach the one task.
    learnt = picked.select("_rank", "_text").repartition(1).mapInArrow(learn, "name string, weights array<double>").collect()
    model = {r["name"]: np.array(r["weights"]).reshape(-1, LABELS) for r in learnt}
    model = model or {"node": np.zeros((FEATURES, LABELS)), "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = part.column("_text").to_pylist()
                base = [base_spans(t) for t in texts]
                more = more_spans(texts, base, model)
                counts = [[sum(k == kind for *_, k in s) for s in base] for kind in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), *[pa.array(c, pa.int64()) for c in counts], pa.array([_write(s) for s in base], pa.string()),
                     pa.array([_write(s + m) for s, m in zip(base, more, strict=True)], pa.string())],
                    [key, *[f"n_{k}" for k in KINDS], "base", "spans"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return own.mapInArrow(find, f"`{key}` {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string")
