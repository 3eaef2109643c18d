"""Transcript cleaning as pure column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Character lists the cleaned text has to agree with.
SPECIAL_TOKENS = ("[UNK]", "[PAD]")
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# U+3002, U+3005 to U+3007, U+3010, U+3011, U+FF01, U+FF0C, U+FF1A, U+FF1F, U+FFE4, U+FFE9
CJK_PUNCTUATION = "。々〆〇【】！，：？￤￩"
EXTRA_MARKS = "、：；？！"
# , ? . ! - ; : " U+201C % U+2018 U+201D U+FFFD ' U+00BB U+00AB
SENTENCE_MARKS = ",?.!-;:\"“%‘”�'»«"

# White space as str.strip and str.split see it: the Unicode property plus the
# four information separators.
_SPACE = r"[\s\x1C-\x1F]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters that NFKC never changes and that never combine with each other.
_NFKC_STABLE = (
    r"\x00-\x7FÀ-ÿ、-〩ぁ-ゖァ-ヺ一-鿿가-힣"
)


#: UTF-8 bytes of the texts that a Python task holds as strings at a time, one text at least.
SLICE_BYTES = 1 << 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_chars(c: Column | str, chars: str) -> Column:
    """Remove every code point listed in ``chars`` in one pass."""
    return F.translate(_col(c), chars, "")


def drop_special_tokens(c: Column | str) -> Column:
    """Remove the literal special tokens, one after the other."""
    out = _col(c)
    for token in SPECIAL_TOKENS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def drop_cjk_punctuation(c: Column | str) -> Column:
    return drop_chars(c, CJK_PUNCTUATION)


def drop_ascii_punctuation(c: Column | str) -> Column:
    return drop_chars(c, ASCII_PUNCTUATION)


def drop_extra_marks(c: Column | str) -> Column:
    return drop_chars(c, EXTRA_MARKS)


def drop_sentence_marks(c: Column | str) -> Column:
    return drop_chars(c, SENTENCE_MARKS)


def drop_blanks(c: Column | str) -> Column:
    """Remove U+0020 only; tabs, newlines and U+3000 stay."""
    return F.replace(_col(c), F.lit(" "), F.lit(""))


def normalize(c: Column | str) -> Column:
    """Full transcript normaliser.

    All removals are of single code points, and lower-casing neither makes nor
    hides one of them, so the five removal steps are one ``translate`` pass.
    """
    every = CJK_PUNCTUATION + ASCII_PUNCTUATION + EXTRA_MARKS + SENTENCE_MARKS + " "
    return F.lower(drop_chars(drop_special_tokens(c), "".join(dict.fromkeys(every))))


def vocab_clean(c: Column | str, lower: bool = True) -> Column:
    """Cleaner used before characters are counted; keeps U+FF01 and spaces."""
    drop = SENTENCE_MARKS + CJK_PUNCTUATION.replace("！", "")
    out = drop_chars(c, "".join(dict.fromkeys(drop)))
    return F.lower(out) if lower else out


def optional_clean(
    c: Column | str, do_lower_case: bool = False, do_remove_punctuation: bool = False
) -> Column:
    """Switches applied before encoding; both off leaves the text alone."""
    out = _col(c)
    if do_lower_case:
        out = F.lower(out)
    if do_remove_punctuation:
        out = drop_punctuation_but_apostrophe(out)
    return out


def drop_punctuation_but_apostrophe(c: Column | str) -> Column:
    return drop_chars(c, ASCII_PUNCTUATION.replace("'", ""))


def strip(c: Column | str) -> Column:
    """Trim Unicode white space on both ends (plain ``trim`` knows U+0020 only)."""
    return F.trim(_col(c), F.lit(SPACES))


def stripped_length(c: Column | str) -> Column:
    return F.length(strip(c))


def nfkc(c: Column | str) -> Column:
    """Compatibility composition.

    Spark has no built-in for it.  Only text holding a character outside the
    stable ranges is sent to Python; for all other rows the batch carries NULL.
    A batch stays in Arrow, and a slice of :data:`SLICE_BYTES` of it at a time is
    composed and sent back, so a task's memory does not grow with the batch's strings.
    """

    def compose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            place = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
            for a, b in pairwise([0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(texts)]):
                some = texts.slice(a, b - a).to_pylist()
                yield pa.array([t if t is None else unicodedata.normalize("NFKC", t) for t in some], pa.string())

    col = _col(c)
    # As many bytes as characters means ASCII; no need to search that.
    plain = F.octet_length(col) == F.length(col)
    doubtful = F.when(~plain & F.regexp_like(col, F.lit(f"[^{_NFKC_STABLE}]")), col)
    return F.coalesce(F.arrow_udf(compose, T.StringType())(doubtful), col)


def normalize_basic(c: Column | str, compose: bool = True) -> Column:
    """Language-agnostic normaliser.

    Bracketed and parenthesised spans go, marks, symbols and punctuation become
    spaces, runs of white space one space.  ``compose=False`` leaves NFKC out and
    keeps the plan free of Python; right for text known to be NFKC already.
    """
    out = F.lower(_col(c))
    out = F.regexp_replace(out, r"[<\[][^>\]]*[>\]]", "")
    out = F.regexp_replace(out, r"\([^)]+?\)", "")
    out = nfkc(out) if compose else out
    out = F.lower(F.regexp_replace(out, r"[\p{M}\p{S}\p{P}]", " "))
    return F.regexp_replace(out, f"(?U){_SPACE}+", " ")


def chars(c: Column | str) -> Column:
    """Array of code points; an empty text has none."""
    col = _col(c)
    return F.when(F.length(col) == 0, F.array().cast("array<string>")).otherwise(F.split(col, ""))


def parse_id_list(c: Column | str) -> Column:
    """``"[1, 23]"`` to a bigint array (NULL for a number beyond it); NULL when the text is no bracketed list."""
    col = _col(c)
    ids = F.transform(
        F.regexp_extract_all(col, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("bigint")
    )
    return F.when(col.startswith("[") & col.endswith("]"), ids)


def has_markup(c: Column | str) -> Column:
    """True when the text holds a pair of angle brackets."""
    return F.regexp_like(_col(c), F.lit("<[^>]*>"))


def rewrite_path(c: Column | str, swaps: list[tuple[str, str]]) -> Column:
    """Replace every occurrence of each pair, in the given order."""
    out = _col(c)
    for old, new in swaps:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def basename(c: Column | str) -> Column:
    return F.element_at(F.split(_col(c), "/"), -1)
