"""Reproducible randomness: hashes of keys, the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(p: Column | str | int) -> Column:
    if isinstance(p, Column):
        return p.cast("string")
    return F.lit(str(p))


def key_hash(*parts: Column | str | int) -> Column:
    """md5 over ``:``-joined parts; plain strings and ints are literals."""
    return F.md5(F.concat_ws(":", *[_part(p) for p in parts]).cast("binary"))


def hash_bits(*parts: Column | str | int) -> Column:
    """The first 32 bits of :func:`key_hash` as a bigint."""
    return F.conv(F.substring(key_hash(*parts), 1, 8), 16, 10).cast("bigint")


def hash_uniform(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1)."""
    return hash_bits(*parts) / F.lit(4294967296.0)


def hash_normals(n: Column, *parts: Column | str | int) -> Column:
    """Array of ``n`` standard normals.

    One md5 holds four 32-bit numbers, and two of them make two normals (Box and
    Muller), so a digest is taken for every fourth element only.
    """
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / 4), F.lit(0)).cast("int"))

    def four(j: Column) -> Column:
        return F.transform(
            F.array(key_hash(*parts, j)), lambda h: F.array(*_normals(h, 1), *_normals(h, 17))
        )[0]

    return F.slice(F.flatten(F.transform(blocks, four)), F.lit(1), n)


def _normals(digest: Column, at: int) -> tuple[Column, Column]:
    def bits(start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")

    radius = F.sqrt(-2.0 * F.ln((bits(at) + 1) / F.lit(4294967297.0)))
    angle = F.lit(6.283185307179586) * (bits(at + 8) / F.lit(4294967296.0))
    return radius * F.cos(angle), radius * F.sin(angle)
