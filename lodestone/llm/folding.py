"""Folding of accents, widths and look-alike letters, as Spark columns and as Python tables.

The tables are derived from the Unicode database by rule; only the look-alike letters are
fixed values.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cyrillic and Greek letters drawn like a Latin one.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Һ": "H", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I",
    "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
}


def _scripts() -> range:
    return range(0xA0, 0x2000)


@lru_cache(1)
def invisible() -> str:
    """Characters that print nothing: format characters and their kin."""
    extra = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
    return "".join(chr(c) for c in range(0xE0200) if c in extra or (c < 0xE0000 and unicodedata.category(chr(c)) == "Cf"))


@lru_cache(1)
def spaces() -> str:
    """Every horizontal space but the plain one."""
    return "".join(chr(c) for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs")


@lru_cache(1)
def letter_table() -> dict[str, str]:
    """Accented, wide and look-alike letters to one plain ASCII character each."""
    out = {}
    for c in [*_scripts(), *range(0xFF01, 0xFF5F)]:
        ch = chr(c)
        plain = unicodedata.normalize("NFKD", ch)
        plain = "".join(LOOKALIKES.get(x, x) for x in plain if not unicodedata.combining(x))
        if len(plain) == 1 and plain.isascii() and plain != ch:
            out[ch] = plain
    return out | LOOKALIKES


def fold_ascii(col: Column) -> Column:
    """Plain form of a short text, inside the JVM: letters folded, invisible characters dropped,
    odd spaces made plain, combining marks removed. The case is kept; null stays null."""
    table = letter_table()
    gone = "[" + "".join(f"\\x{{{ord(x):x}}}" for x in invisible() if ord(x) < 0x10000) + "\\x{300}-\\x{36f}]"
    wide = spaces()
    source = "".join(table) + wide
    target = "".join(table.values()) + " " * len(wide)
    return F.translate(F.regexp_replace(col, gone, ""), source, target)
