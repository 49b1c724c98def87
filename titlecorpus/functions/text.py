"""Text expressions: whitespace, tokens, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from titlecorpus.schema import TASK_PREFIX

# Python's str.isspace() set over the BMP (29 code points). Java's \s is
# ASCII-only and (?U)\s misses U+001C..U+001F, so the class is spelled out.
WS_CLASS = (
    "[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
_WS_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
              (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
              (0x3000, 0x3000))
# The same 29 characters as a plain set, for btrim.
WS_CHARS = "".join(chr(c) for lo, hi in _WS_RANGES for c in range(lo, hi + 1))
NON_WS_CLASS = "[^" + WS_CLASS[1:]
# Separator of sentence spans: end punctuation followed by whitespace.
SPAN_SPLIT = "[.!?]+[ \\t\\n\\x{0b}\\f\\r]+"
# Token rule: lower-case, split on runs of anything but letters and digits.
TOKEN_SPLIT = "[^\\p{L}\\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ws(c) -> Column:
    """Runs of whitespace -> one space, then strip (NULL stays NULL)."""
    # Every whitespace character becomes a plain space, runs of spaces
    # collapse to one, and only a single space can remain at either end.
    spaces = F.translate(_col(c), WS_CHARS, " " * len(WS_CHARS))
    return F.trim(F.regexp_replace(spaces, "  +", " "))


def strip_ws(c) -> Column:
    """Python-style str.strip() on the Unicode whitespace set."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def is_blank(c) -> Column:
    """True for NULL, empty, or whitespace-only text."""
    # The scan stops at the first non-whitespace character.
    return F.coalesce(~_col(c).rlike(NON_WS_CLASS), F.lit(True))


def tokenize(c) -> Column:
    """Lower-cased letter/digit runs, in order; empty strings removed."""
    parts = F.split(F.lower(_col(c)), TOKEN_SPLIT)
    return F.filter(parts, lambda t: t != F.lit(""))


def task_prefix(c, prefix: str = TASK_PREFIX) -> Column:
    """``prefix + text`` (NULL stays NULL)."""
    return F.concat(F.lit(prefix), _col(c))
