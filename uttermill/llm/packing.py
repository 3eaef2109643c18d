"""Token packing: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from uttermill.llm import words as X

#: Tokens of a sequence, its segments, and tokens in it that bear loss.
LENGTH, SEGMENTS, LOSS = 2048, 256, 2048
#: Remainders of documents that wait for a place in one task.
POOL = 512
END = 1
#: Segments whose ids a Python worker remembers.
CACHE = 400_000
_WORKER: dict = {}


class Encoder:
    """Ids of texts, exactly as the tokenizer file gives them for the whole text.

    A byte-level BPE with the usual pattern never joins what stands before a
    single space to what follows, so a text can be cut there and equal pieces are
    encoded once.  The file's vocabulary goes to ``tiktoken``, whose merge order
    is the id order; pieces with a special token, and files of another kind, go to
    ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        before = spec.get("pre_tokenizer") or {}
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        cuts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        self.cut = bool(cuts and not spec.get("normalizer") and not spec["model"].get("continuing_subword_prefix"))
        self.fast = self._ranks(spec) if self.cut else None
        self.keys, self.at, self.ids = np.empty(0, np.uint64), np.zeros((0, 2), np.int64), np.empty(0, np.uint32)

    def _ranks(self, spec):
        try:
            import public_tokenizers
            import tiktoken
        except ModuleNotFoundError:
            return None
        letters = _byte_letters()
        specials = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in specials}
        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, pieces: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in pieces]
        odd = [self.fast is None or any(s in p for s in self.special) for p in pieces]
        return [
            self.whole.encode(t, add_special_tokens=False).ids if o else self.fast.encode_ordinary(t)
            for t, o in zip(texts, odd, strict=True)
        ]

    def batch(self, body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts and where each text's ids begin."""
        first = np.unique(offsets[:-1][np.diff(offsets) > 0]) if not self.cut else _cuts(body, offsets)
        if not len(first):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        end = np.append(first[1:], len(body))
        keys = X.hashes(body, first, end)
        unique, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == unique
        raw = body.tobytes()
        new = np.flatnonzero(~known)
        lists = self._encode([raw[first[example[i]] : end[example[i]]] for i in new])
        if len(self.keys) + len(new) > CACHE:
            # Start afresh with what this slice needs.
            old = [self.ids[a : a + n] for a, n in self.at[place[known]]]
            keep, lists = np.concatenate([np.flatnonzero(known), new]), old + lists
            self.keys, self.at, self.ids = np.empty(0, np.uint64), np.zeros((0, 2), np.int64), np.empty(0, np.uint32)
        else:
            keep = new
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate([np.asarray(x, np.uint32) for x in lists]) if lists else np.empty(0, np.uint32)
        begin = len(self.ids) + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if lists else np.empty(0, np.int64)
        keys_all = np.concatenate([self.keys, unique[keep]])
        order = np.argsort(keys_all, kind="stable")
        self.at = np.concatenate([self.at, np.stack([begin, sizes], 1) if lists else np.zeros((0, 2), np.int64)])[order]
        self.keys, self.ids = keys_all[order], np.concatenate([self.ids, flat])
        at = self.at[np.searchsorted(self.keys, unique)][inverse.reshape(-1)]
        total = np.concatenate([[0], np.cumsum(at[:, 1])])
        gather = np.repeat(at[:, 0] - total[:-1], at[:, 1]) + np.arange(total[-1])
        return self.ids[gather], total[np.searchsorted(first, offsets)]


def _byte_letters() -> dict[str, int]:
    """Byte of each letter in a byte-level vocabulary: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _cuts(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces that can be encoded alone: texts, and spaces after a visible character."""
    space = (body >= 9) & (body <= 13) | (body == 32) | (body >= 28) & (body <= 31)
    ok = np.zeros(len(body), bool)
    ok[1:] = (body[1:] == 32) & ~space[:-1]
    # White space beyond ASCII starts with one of these bytes; no cut right after such a character.
    wide = np.zeros(len(body), bool)
    wide[2:] |= body[:-2] == 0xC2
    wide[3:] |= np.isin(body[:-3], (0xE1, 0xE2, 0xE3))
    ok &= ~wide
    ok[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(ok)


class Packer:
    """Places remainders in open order under limits on tokens, segments and loss-bearing tokens."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, np.float64)
        self.items: list[tuple] = []
        self.need = np.zeros((0, 3))
        self.sequence = 0
        self.out: list[tuple] = []

    def place(self, pieces: list[tuple]) -> None:
        """One sequence: (doc, start, ids, doc_tokens) back to back from offset 0."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray, loss: int | None = None) -> None:
        """Whole sequences are cut off a long document at once; its remainder joins the pool."""
        length, start = int(self.limits[0]), 0
        while len(ids) - start >= length and self.limits[2] >= length:
            self.place([(doc, start, ids[start : start + length], len(ids))])
            start += length
        rest = ids[start:]
        step = int(min(self.limits[0], self.limits[2]))
        for a in range(0, len(rest), step):
            part = rest[a : a + step]
            self.items.append((doc, start + a, part, len(ids)))
            self.need = np.vstack([self.need, [len(part), 1, len(part) if loss is None else min(loss, len(part))]])

    def pack(self, keep: int) -> None:
        """Fill sequences while more than ``keep`` remainders wait.

        The next item is the one whose demand vector has the largest dot product
        with the room left, both as shares of the limits.  When none fits whole,
        the item that comes next is cut to fill the sequence to its last token.
        """
        while len(self.items) > keep:
            room, chosen = self.limits.copy(), []
            free = np.ones(len(self.items), bool)
            share = self.need / self.limits
            cut = None
            while room[0] > 0 and room[1] > 0 and room[2] > 0 and free.any():
                fits = free & (self.need <= room).all(axis=1)
                if fits.any():
                    best = int(np.argmax(np.where(fits, share @ (room / self.limits), -1.0)))
                    chosen.append(self.items[best])
                    room -= self.need[best]
                    free[best] = False
                    continue
                best = int(np.argmax(np.where(free, self.need[:, 0], -1.0)))
                take = int(min(room[0], room[2], len(self.items[best][2]) - 1))
                if take > 0:
                    doc, start, ids, total = self.items[best]
                    chosen.append((doc, start, ids[:take], total))
                    cut = (best, (doc, start + take, ids[take:], total))
                break
            if cut:
                best, left = cut
                self.items[best] = left
                self.need[best] = [len(left[2]), 1, min(self.need[best][2], len(left[2]))]
            if room[0] > 0 and len(self.items) - (~free).sum() == 0:
                self._finish(chosen)
            else:
                self.place(chosen)
            self.items = [x for x, f in zip(self.items, free, strict=True) if f]
            self.need = self.need[free]

    def _finish(self, pieces: list[tuple]) -> None:
        """The last tokens of a task: sequences as long as powers of two, which need no padding."""
        left = sum(len(p[2]) for p in pieces)
        while left:
            size, group = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                doc, start, ids, total = pieces.pop(0)
                group.append((doc, start, ids[:size], total))
                if len(ids) > size:
                    pieces.insert(0, (doc, start + size, ids[size:], total))
                size -= min(size, len(ids))
            self.place(group)


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", loss: str | None = None,
    length: int = LENGTH, segments: int = SEGMENTS, loss_limit: int = LOSS,
) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is its ids and an end token.  Whole sequences are cut off long
    documents; the remainders are packed under limits on tokens, segments and
    loss-bearing tokens (column ``loss``: how many of a row's tokens bear loss, all
    where null or not given).  Each task packs the rows of its split as they are
    tokenized, with at most ``POOL`` remainders in memory, so ids never cross the
    network; a hot source is as many splits as any other rows.  ``sequence_id``
    joins the split's number and a running number.

    Null texts are empty ones: a single end token.  Repeated rows are packed each.
    An empty table gives an empty result.
    """
    limits = (length, segments, loss_limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _WORKER.get(tokenizer) or _WORKER.setdefault(tokenizer, Encoder(tokenizer))
        packer, task = Packer(limits), TaskContext.get().partitionId() << 40

        def rows(schema):
            columns = list(zip(*packer.out, strict=True)) or [[]] * 7
            packer.out = []
            arrays = [pa.array(columns[0], schema.field("_key").type), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            arrays[5] = pa.array(np.asarray(arrays[5], np.int64) + task)
            return pa.RecordBatch.from_arrays(arrays, names)

        schema = None
        for batch in batches:
            schema = batch.schema
            for part, body, offsets in X.slices(batch, "_text"):
                ids, begin = encoder.batch(body, offsets)
                bearing = part.column("_loss").to_pylist()
                for i, doc in enumerate(part.column("_key").to_pylist()):
                    packer.add(doc, np.append(ids[begin[i] : begin[i + 1]], np.uint32(END)), bearing[i])
                    if len(packer.items) > 2 * POOL:
                        packer.pack(POOL)
                yield rows(schema)
        if schema is not None:
            packer.pack(0)
            yield rows(schema)

    kind = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    shape = f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in names[1:])
    given = docs.selectExpr(f"`{key}` as _key", f"`{text}` as _text", f"cast({f'`{loss}`' if loss else 'null'} as long) as _loss")
    return given.mapInArrow(run, shape)
