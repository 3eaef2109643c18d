"""Edit distance of many string pairs at once, bit-parallel over NumPy words.

One 64-bit word holds 64 rows of the distance table as vertical differences
(Myers 1999, with the carries between words of Hyyro 2003).  All words of all
pairs advance together: word ``w`` is one text column behind word ``w - 1``, so
the carry it needs is the one computed a step earlier.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_TOP = np.uint64(63)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a (longest, pairs) matrix, and the lengths."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full((len(texts), int(sizes.max(initial=0))), -1, dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return np.ascontiguousarray(out.T), sizes


def _group(patterns: list[str], texts: list[str]) -> np.ndarray:
    """Distances of non-empty pairs in ascending order of text length.

    Patterns end at the top bit of the last word.  The rows in front of a
    shorter one have no vertical difference, which makes them copies of row 0.
    """
    pat, m = _codes(patterns)
    txt, n = _codes(texts)
    pairs, columns = len(patterns), txt.shape[0]
    words = (pat.shape[0] + 63) // 64
    lane = np.arange(pairs)

    # One bit mask per (word, character of the patterns, pair); the last
    # character slot stays empty and serves every character not in a pattern.
    alphabet = np.unique(pat[pat >= 0])
    slots = len(alphabet) + 1
    match = np.zeros(words * slots * pairs, dtype=np.uint64)
    up = np.zeros((words, pairs), dtype=np.uint64)
    for i in range(pat.shape[0]):
        live = np.flatnonzero(m > i)
        row = words * 64 - m[live] + i
        flag = _ONE << (row % 64).astype(np.uint64)
        slot = np.searchsorted(alphabet, pat[i, live])
        match[(row // 64 * slots + slot) * pairs + live] |= flag
        up[row // 64, live] |= flag
    slot = np.minimum(np.searchsorted(alphabet, txt), slots - 2)
    slot = np.where(alphabet[slot] == txt, slot, slots - 1) * pairs
    origin = (np.arange(words) * slots * pairs)[:, None] + lane

    down = np.zeros((words, pairs), dtype=np.uint64)
    carry_up = np.zeros((words + 1, pairs), dtype=np.uint64)
    carry_down = np.zeros((words + 1, pairs), dtype=np.uint64)
    carry_up[0] = 1
    score, done = m.copy(), 0
    for step in range(columns + words - 1):
        lo, hi = max(0, step - columns + 1), min(words, step + 1)
        column = step - words + 1
        while n[done] <= column:
            done += 1
        eq = match.take(origin[lo:hi, done:] + slot[step - hi + 1 : step - lo + 1, done:][::-1])
        pv, mv = up[lo:hi, done:], down[lo:hi, done:]
        in_up, in_down = carry_up[lo:hi, done:], carry_down[lo:hi, done:]
        xv = eq | mv
        eq |= in_down
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        out_up, out_down = ph >> _TOP, mh >> _TOP
        ph = (ph << _ONE) | in_up
        mh = (mh << _ONE) | in_down
        carry_up[lo + 1 : hi + 1, done:] = out_up
        carry_down[lo + 1 : hi + 1, done:] = out_down
        up[lo:hi, done:] = mh | ~(xv | ph)
        down[lo:hi, done:] = ph & xv
        if column >= 0:
            score[done:] += out_up[-1].view(np.int64) - out_down[-1].view(np.int64)
    return score


def distances(left: list[str], right: list[str], cells: int = 1 << 22) -> np.ndarray:
    """Levenshtein distance of every pair, as int64.

    Pairs of like pattern length advance together; ``cells`` bounds the mask
    table and the padded texts of one group.
    """
    size = np.array([(len(a), len(b)) for a, b in zip(left, right, strict=True)]).reshape(-1, 2)
    out = size.max(axis=1).astype(np.int64)
    words = (size[:, 0] + 63) // 64
    order = np.lexsort((size[:, 1], words))
    order = order[size[order].min(axis=1) > 0]
    slots = len(set("".join(left))) + 1
    start = 0
    while start < len(order):
        # Enough lanes to pay for the fixed cost of a step, then only alike ones.
        wide = words[order[start:]]
        lanes = np.arange(1, len(wide) + 1)
        fits = (wide * slots * lanes <= cells) & ((wide * lanes <= 4096) | (wide == wide[0]))
        longest = np.maximum.accumulate(size[order[start:], 1])
        fits &= (lanes <= 4096) & (longest * lanes <= cells)
        fits[0] = True
        stop = start + (len(fits) if fits.all() else int(fits.argmin()))
        group = order[start:stop]
        group = group[np.argsort(size[group, 1], kind="stable")]
        out[group] = _group([left[i] for i in group], [right[i] for i in group])
        start = stop
    return out
