"""Token and feature array helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Label value that a loss or metric ignores (fixed value).
IGNORED = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate(c: Column | str, n: int) -> Column:
    return F.slice(_col(c), 1, n)


def pad(c: Column | str, width: Column | int, value: int) -> Column:
    """Right-pad to ``width``; longer arrays stay as they are."""
    col = _col(c)
    width = width if isinstance(width, Column) else F.lit(width)
    return F.concat(col, F.array_repeat(F.lit(value), F.greatest(width - F.size(col), F.lit(0))))


def attention_mask(c: Column | str, width: Column | int) -> Column:
    """1 for real positions, 0 for padding, as :func:`pad` lays them out."""
    return pad(F.transform(_col(c), lambda _: F.lit(1)), width, 0)


def ignore_padding(c: Column | str, mask: Column | str) -> Column:
    """Put :data:`IGNORED` wherever the mask is not 1."""
    return F.zip_with(
        _col(c), _col(mask), lambda x, m: F.when(m == 1, x).otherwise(F.lit(IGNORED))
    )


def restore_padding(c: Column | str, pad_id: int) -> Column:
    return F.transform(_col(c), lambda x: F.when(x == IGNORED, F.lit(pad_id)).otherwise(x))


def shift_right(c: Column | str, start_id: int) -> Column:
    """Prepend the start id and drop the last token."""
    col = _col(c)
    return F.when(
        F.size(col) > 0,
        F.concat(F.array(F.lit(start_id)), F.slice(col, F.lit(1), F.size(col) - 1)),
    ).otherwise(col)


def decoder_input(c: Column | str) -> Column:
    """All tokens but the last."""
    col = _col(c)
    return F.slice(col, F.lit(1), F.greatest(F.size(col) - 1, F.lit(0)))


def decoder_target(c: Column | str) -> Column:
    """All tokens but the first."""
    col = _col(c)
    return F.slice(col, F.lit(2), F.greatest(F.size(col) - 1, F.lit(0)))


def mask_prompt(c: Column | str, start_id: int) -> Column:
    """Ignore everything up to and including the first ``start_id``.

    Only when it sits past the first position; otherwise nothing changes.
    """
    col = _col(c)
    pos = F.array_position(col, F.lit(start_id))
    return F.when(
        pos > 1, F.transform(col, lambda x, i: F.when(i < pos, F.lit(IGNORED)).otherwise(x))
    ).otherwise(col)


def argmax(c: Column | str) -> Column:
    """0-based index of the largest element, the first one on ties."""
    col = _col(c)
    return (F.array_position(col, F.array_max(col)) - 1).cast("int")


def ctc_collapse(c: Column | str, blank: int) -> Column:
    """Merge runs of equal ids, then drop the blank."""
    col = _col(c)
    return F.filter(
        col, lambda x, i: (x != blank) & ((i == 0) | (x != F.get(col, F.greatest(i - 1, F.lit(0)))))
    )


def zero_band(c: Column | str, start: Column, stop: Column) -> Column:
    """Zero the elements with ``start <= index < stop``."""
    return F.transform(
        _col(c),
        lambda v, i: F.when((i >= start) & (i < stop), F.lit(0).cast("float")).otherwise(v),
    )


def zero_band_matrix(c: Column | str, axis: int, start: Column, stop: Column) -> Column:
    """Zero a contiguous band of rows (axis 0) or columns (axis 1)."""
    if axis == 0:
        return F.transform(
            _col(c),
            lambda row, i: F.when(
                (i >= start) & (i < stop), F.transform(row, lambda _: F.lit(0).cast("float"))
            ).otherwise(row),
        )
    return F.transform(_col(c), lambda row: zero_band(row, start, stop))


def duration(samples: Column | str, rate: int | Column) -> Column:
    """Seconds of audio."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    return F.size(_col(samples)).cast("double") / rate


def has_shape(c: Column | str, rows: int, cols: int) -> Column:
    """True for a ``rows`` x ``cols`` matrix; every row is checked."""
    col = _col(c)
    return (F.size(col) == rows) & F.forall(col, lambda r: F.size(r) == cols)


def softmax(c: Column | str) -> Column:
    """Softmax of one array; the total is taken once per row, not per element."""
    col = _col(c).cast("array<double>")
    top = F.array_max(col)
    powers = F.zip_with(col, F.array_repeat(top, F.size(col)), lambda x, t: F.exp(x - t))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(powers, F.array_repeat(total, F.size(col)), lambda x, t: x / t)


def percent(c: Column) -> Column:
    """A ratio as percent with two decimals (half up)."""
    return F.round(100 * c, 2)


def log_softmax(c: Column | str, temperature: float = 1.0) -> Column:
    """``x - max - ln(sum(exp(x - max)))`` of the values over the temperature: nothing underflows to ln(0)."""
    scaled = F.transform(_col(c), lambda x: x.cast("double") / temperature)
    shifted = F.zip_with(scaled, F.array_repeat(F.array_max(scaled), F.size(scaled)), lambda x, t: x - t)
    total = F.ln(F.aggregate(shifted, F.lit(0.0), lambda a, x: a + F.exp(x)))
    return F.zip_with(shifted, F.array_repeat(total, F.size(shifted)), lambda x, t: x - t)
