"""One form for texts that look the same, by a compiled longest-match transducer.

The transducer works over grapheme clusters: a base character with all its combining marks
(also across invisible characters) is one input symbol, so the longest match always wins. The
mapping is computed once from the Unicode database by rule, checked for conflicts, and applied
to each text in one left-to-right pass.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.folding import LOOKALIKES, invisible, spaces
from lodestone.session import cut, spread

# Signs drawn like a plain one.
SIGNS = {"‐": "-", "‑": "-", "․": ".", "ꞌ": "'", "ː": ":", "∶": ":", "∕": "/", "⁄": "/", "∣": "|", "ǃ": "!"}
_PICTURE = "←-⇿⌀-➿⬀-⯿\U0001f000-\U0001faff"


@lru_cache(1)
def _marks() -> str:
    """Combining marks, and the half-width voicing signs, which belong to the kana before them."""
    return "".join(chr(c) for c in range(0x300, 0x20000) if unicodedata.combining(chr(c))) + "\uff9e\uff9f"


def _wide(ch: str) -> str:
    """Full-width, half-width and ligature forms to their ordinary characters."""
    return unicodedata.normalize("NFKC", ch) if 0xFF00 <= ord(ch) <= 0xFFEF or 0xFB00 <= ord(ch) <= 0xFB06 else ch


@lru_cache(200_000)
def cluster_form(cluster: str) -> str:
    """The consistent form of one grapheme cluster."""
    before = None
    while cluster != before:
        before = cluster
        body = "".join(_wide(c) for c in cluster if c not in _SETS["gone"])
        plain = (" " if c in _SETS["space"] else SIGNS.get(c, LOOKALIKES.get(c, c)) for c in unicodedata.normalize("NFD", body))
        cluster = unicodedata.normalize("NFC", "".join(plain))
    return cluster


_SETS = {"gone": frozenset(invisible()), "space": frozenset(spaces())}


@lru_cache(1)
def transducer() -> Callable[[str], str]:
    """The compiled mapping. Raises ValueError if the single-character table has a conflict: an
    output that is itself rewritten, which would make the form depend on the number of passes."""
    table = {}
    # Every character that a table names, a width or presentation form, or one with a canonical mapping.
    mapped = (c for c in (*range(0xA0, 0xD800), *range(0xF900, 0x10000), *range(0x1D100, 0x1D200), *range(0x2F800, 0x2FA20)) if not 0x3400 <= c <= 0xA000 and not 0xAC00 <= c < 0xD7B0)
    for ch in sorted({*map(chr, mapped), *SIGNS, *LOOKALIKES}):
        if unicodedata.category(ch) != "Cn" and not unicodedata.combining(ch) and (form := cluster_form(ch)) != ch:
            table[ch] = form
    for source, form in table.items():
        if form != cluster_form(form) or any(x in table for x in form):
            raise ValueError(f"U+{ord(source):04X} maps to {form!r}, which is rewritten again")
    gone, marks, blanks = re.escape(invisible()), re.escape(_marks()), re.escape(spaces())
    singles = re.escape("".join(x for x in table if x not in _SETS["space"]))
    # Alternatives in order: joined pictures stay as they are, blanks at a line's end go, then clusters, syllables, single characters, line ends.
    # First of all runs of plain characters are passed over, up to one that a mark may follow.
    pattern = re.compile(
        rf"(?P<plain>[!-~\n]+(?![{gone}{marks}])| (?=[!-~]))|"
        rf"(?P<keep>[{_PICTURE}][︎️]?(?:‍[{_PICTURE}][︎️]?)+)"
        rf"|(?P<end>[ \t{blanks}{gone}]+(?=[\r\n]|\Z))"
        rf"|(?P<cluster>[^{gone}{marks}\n\r](?:[{gone}]*[{marks}])+|[\u1100-\u115e][{gone}]*[\u1161-\u11a7](?:[{gone}]*[\u11a8-\u11ff])?)"
        rf"|(?P<blank>[{blanks}])|(?:[{gone}](?![ \t{blanks}{gone}]*(?:[\r\n]|\Z))|[{singles}](?![{gone}]*[{marks}]))+"
        r"|\r\n?"
    )

    # Most texts hold nothing to rewrite: no character of the tables and no blank at a line's end.
    foreign = frozenset(table) | _SETS["gone"] | _SETS["space"] | frozenset(_marks()) | frozenset(map(chr, range(0x1100, 0x1200)))

    def rewrite(m: re.Match) -> str:
        x = m[0]
        if m.lastgroup == "plain":
            return x
        if m["keep"]:
            return x.replace("️", "").replace("︎", "")
        if m["end"]:
            return ""
        if m["cluster"]:
            return cluster_form(x)
        if m["blank"]:
            return " "
        return "\n" if x[0] == "\r" else "".join(map(cluster_form, x))

    def form(text: str) -> str:
        straight = "\r" not in text and " \n" not in text and "\t\n" not in text and text[-1:] not in (" ", "\t")
        if straight and (text.isascii() or foreign.isdisjoint(text)):
            return text
        return pattern.sub(rewrite, text)

    return form


def visual_form(c: Column | str) -> Column:
    """The consistent form of each text; null stays null."""

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series) -> pd.Series:
        return texts.map(transducer(), na_action="ignore")

    return rewritten(c)


def forms(documents: DataFrame) -> DataFrame:
    """(doc_id, form): every text in its one consistent form."""
    return spread(documents.select("doc_id", "text")).select("doc_id", visual_form("text").alias("form"))


def look_alike_pairs(documents: DataFrame) -> DataFrame:
    """(left_doc_id, right_doc_id): documents whose texts look the same but are not the same string.

    Only 128-bit hashes of texts and forms are shuffled. Forms that a single string has are
    dropped by partial aggregation before any join, so copies of one text, however many, meet
    no partner. Null texts and null ids take no part; an empty text looks like one that holds
    invisible characters only; a doc_id that occurs twice with the same text counts once.
    """
    d = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))
    d = d.select("doc_id", F.md5(F.col("text")).alias("t"), F.md5(visual_form("text")).alias("f")).distinct()
    mixed = d.groupBy("f").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("f")
    d = cut(d.join(mixed, "f", "left_semi"))
    # Different texts of one form meet once; only then do their documents follow.
    t = d.select("f", "t").distinct()
    texts = t.select("f", F.col("t").alias("lt")).join(t.select("f", F.col("t").alias("rt")), "f").where("lt < rt").select("lt", "rt")
    pairs = texts.join(d.select(F.col("t").alias("lt"), F.col("doc_id").alias("x")), "lt").join(d.select(F.col("t").alias("rt"), F.col("doc_id").alias("y")), "rt")
    return pairs.where("x <> y").select(F.least("x", "y").alias("left_doc_id"), F.greatest("x", "y").alias("right_doc_id")).distinct()
