"""Words and word hashes of whole texts, in NumPy over Arrow buffers.

Works on UTF-8 bytes: the separators of :data:`uttermill.llm.common.WORD` are
ASCII, so no character has to be decoded.  Callers cut a batch into slices of a
few megabytes first, which bounds the temporary arrays whatever the batch holds;
a single longer text is a slice of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in one slice.
SLICE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Longer spans are hashed one by one.
LONG = 128
#: Keeps the lowest bytes, by their number.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows with at most ``limit`` bytes, or one row."""
    column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)])
    row, rows = 0, batch.num_rows
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        part = column.slice(row, stop - row)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2]
        body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        yield batch.slice(row, stop - row), body, offsets - offsets[0]
        row = stop


def lowered(body: np.ndarray) -> np.ndarray:
    """A-Z to a-z; bytes of other characters are never in that range."""
    return _LOWER[body]


def spans(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte) of every word, and where each text's words begin in these arrays."""
    inside = ~_SPACE[body]
    fresh = np.zeros(len(body) + 1, bool)
    fresh[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    first = np.flatnonzero(inside & (~before | fresh[:-1]))
    end = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    return first, end, np.searchsorted(first, offsets)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by a sort (faster here than a hash table)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _long(word: np.ndarray, seed: int) -> int:
    digest = hashlib.blake2b(word.tobytes(), digest_size=8, salt=seed.to_bytes(16, "little"))
    return int.from_bytes(digest.digest(), "little")


def hashes(body: np.ndarray, first: np.ndarray, end: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each span; another ``seed`` gives an independent hash.

    Eight bytes at a time are mixed into the state of every span that has that many, so no
    sum or polynomial is left in which different spans could cancel out: for one length, spans of up to eight
    bytes never collide.  The few spans above :data:`LONG` bytes take BLAKE2.
    """
    size = end - first
    # Any eight bytes as one number, whatever their alignment.
    lanes = np.ndarray((len(body) + 1,), "<u8", np.concatenate([body, np.zeros(8, np.uint8)]).data, strides=(1,))
    mult, start = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F * (2 * seed + 1) & (2**64 - 1))
    out = mix64(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + start)
    rows, offset = np.flatnonzero(size <= LONG), 0
    while len(rows):
        left = np.minimum(size[rows] - offset, 8)
        lane = lanes[first[rows] + offset] & _MASKS[np.maximum(left, 0)]
        out[rows] = mix64(out[rows] * mult + mix64(lane ^ start))
        offset += 8
        rows = rows[size[rows] > offset]
    for row in np.flatnonzero(size > LONG).tolist():
        out[row] = _long(body[first[row] : end[row]], seed)
    return out


def runs(units: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``width`` consecutive hashes (``len - width + 1`` of them)."""
    n = len(units) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9FB21C651E98DF25 + 2 * seed) + units[k : k + n]
    return mix64(total)


def windows_per_text(begin: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For :func:`runs` over all words: which runs lie inside one text, and that text's number."""
    counts = np.maximum(np.diff(begin) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.repeat(begin[:-1] - starts, counts) + np.arange(counts.sum()), owner
