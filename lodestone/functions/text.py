"""Text functions as Spark columns.

What needs Unicode's tables (compatibility forms, accents, entities) or sequence similarity runs
in Arrow batches, once per distinct value; the rest are built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import words
from lodestone.functions.batches import per_value
from lodestone.functions.words import NAME_NOISE, PLACEHOLDERS, SEPARATORS



# Words for yes and no.
YES = ("true", "yes", "y", "1", "available", "supported")
NO = ("false", "no", "n", "0", "unavailable", "unsupported", "none")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def collapse_whitespace(c: Column) -> Column:
    """Control characters to spaces, one kind of line end, single spaces, trimmed lines, at most
    one blank line; null gives an empty text."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", " ")
    t = F.regexp_replace(t, "\\r\\n?", "\n")
    t = F.regexp_replace(t, "[ \\t\\x{a0}\\x{200b}\\x{200c}\\x{200d}\\x{feff}]+", " ")
    t = F.regexp_replace(t, "(?m)^ +| +$", "")
    return F.regexp_replace(F.regexp_replace(t, "\\n{3,}", "\n\n"), "^\\s+|\\s+$", "")


def _applied(name: str, fn: Callable, c: Column, ddl: str = "string", kind: pa.DataType = pa.string()) -> Column:
    return per_value(name, fn, ddl, kind)(c)


def ascii_fold(c: Column) -> Column:
    """Letters without accents; what has no ASCII form is dropped."""
    return _applied("fold", words.folded, c)


def strip_html(c: Column) -> Column:
    """The readable text of markup: scripts and styles gone, line breaks kept, entities resolved; null gives an empty text."""
    return F.coalesce(_applied("unmarked", words.unmarked, c), F.lit(""))


def truncate(c: Column, size: int, suffix: str = "…") -> Column:
    """At most ``size`` characters, cut at a word where there is one."""
    return _applied(f"truncate {size} {suffix}", partial(words.shortened, size=size, suffix=suffix), c)


def clean_text(c: Column, size: int | None = None) -> Column:
    """Plain text in compatibility form, or null for nothing and for placeholders."""
    return _applied(f"clean {size}", partial(words.cleaned, size=size), c)


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by hyphens, or null."""
    return _applied("slug", words.slug, c)


def drop_tagline(c: Column) -> Column:
    """The head before the first separator that leaves at least two characters."""
    return _applied("head", words.head, c)


def canonical_name(c: Column, drop_noise: bool = True, tagline: bool = True) -> Column:
    """Comparison key of a name: case, accents, spaces, taglines and legal forms make no difference."""
    return _applied(f"key {drop_noise} {tagline}", partial(words.name_key, drop_noise=drop_noise, tagline=tagline), c)


def name_tokens(c: Column) -> Column:
    """Distinct words of a name that carry identity; null gives none."""
    return F.coalesce(_applied("tokens", words.identity_words, c, "array<string>", pa.list_(pa.string())), F.array().cast("array<string>"))


def token_ratio(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b))).otherwise(0.0)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity of two keys: 1 if equal, 0 if either is missing. The order matters.

    The keys must be columns of a shuffled or stored table, each distinct pair once: a Python
    function cannot take over expressions with lambdas from the same projection.
    """

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        seen: dict[tuple, float] = {}
        out = []
        for p in zip(x, y):
            if p[0] is None or p[1] is None:
                out.append(0.0)
                continue
            if p not in seen:
                seen[p] = 1.0 if p[0] == p[1] else SequenceMatcher(None, *p).ratio()
            out.append(seen[p])
        return pd.Series(out, dtype="float64")

    return ratio(a, b)


class Similarity:
    """Ratcliff-Obershelp similarity of pairs of texts given by their places, as difflib has it; 0 where one is missing.

    Short ASCII texts are matched many at a time; difflib itself takes the rest.
    """

    def __init__(self, texts: list[str | None]):
        self.texts = texts
        self.missing = np.array([t is None for t in texts], bool)
        self.short = np.array([t is not None and t.isascii() and len(t) < 128 for t in texts], bool)
        self.lengths = np.array([len(t) if ok else 0 for t, ok in zip(texts, self.short)], np.int64)
        self.codes = np.zeros((len(texts), max(1, int(self.lengths.max(initial=0)))), np.uint8)
        for k in np.flatnonzero(self.short):
            self.codes[k, : self.lengths[k]] = np.frombuffer(texts[k].encode(), np.uint8)

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        many = self.short[x] & self.short[y]
        for k in np.flatnonzero(~many & ~self.missing[x] & ~self.missing[y]):
            out[k] = SequenceMatcher(None, self.texts[x[k]], self.texts[y[k]]).ratio()
        rows = np.flatnonzero(many)
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            i, j = x[part], y[part]
            both = self.lengths[i] + self.lengths[j]
            out[part] = np.where(both > 0, 2.0 * _matched(self.codes[i], self.lengths[i], self.codes[j], self.lengths[j]) / np.maximum(both, 1), 1.0)
        return out


def _matched(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Characters in the matching blocks of each row: the longest common block, earliest in a, then in b; then left and right of it."""
    total = np.zeros(len(a), np.int64)
    zero = np.zeros(len(a), np.int64)
    some = (la > 0) & (lb > 0)
    todo = [v[some] for v in (np.arange(len(a)), zero, la, zero, lb)]
    while len(todo[0]):
        row, a0, a1, b0, b1 = todo
        i, j = np.arange((a1 - a0).max())[:, None], np.arange((b1 - b0).max())[:, None]
        u = np.where(i < a1 - a0, a[row, np.minimum(a0 + i, a.shape[1] - 1)], 0).astype(np.uint8)
        v = np.where(j < b1 - b0, b[row, np.minimum(b0 + j, b.shape[1] - 1)], 1).astype(np.uint8)
        # Lengths of the runs that end with the row of a and each place in b, 256 times, so that the places' ranks fit in.
        run, new, ranked = (np.zeros((len(j) + 1, len(row)), np.uint16) for _ in range(3))
        rank = (255 - np.arange(len(j))).astype(np.uint16)[:, None]
        best, ends = np.zeros(len(row), np.uint16), np.zeros(len(row), np.int64)
        for k in range(len(i)):
            np.add(run[:-1], np.uint16(256), out=new[1:])
            np.multiply(new[1:], v == u[k], out=new[1:])
            run, new = new, run
            # Longest first, then the least end in a, then in b.
            top = np.add(run[1:], rank, out=ranked[1:]).max(0)
            more = (top >> 8) > (best >> 8)
            best[more], ends[more] = top[more], k + 1
        size = (best >> 8).astype(np.int64)
        ai, bi = a0 + ends, b0 + 256 - (best & 255).astype(np.int64)
        np.add.at(total, row, size)
        todo = [np.concatenate(z) for z in ((row, row), (a0, ai), (ai - size, a1), (b0, bi), (bi - size, b1))]
        on = np.tile(size > 0, 2) & (todo[2] > todo[1]) & (todo[4] > todo[3])
        todo = [z[on] for z in todo]
    return total


def sentences(c: Column) -> Column:
    """Sentences of a text, parted after a full stop, question or exclamation mark."""
    return F.split(c, "(?<=[.!?])\\s+")


def tri_state(c: Column) -> Column:
    """Words for yes and no to a boolean; anything else is unknown."""
    w = F.lower(F.trim(c))
    return F.when(w.isin(*YES), True).when(w.isin(*NO), False)


def code_word(c: Column, known: tuple[str, ...] = ()) -> Column:
    """A code in one spelling: trimmed, lower case, blanks and hyphens as underscores; null if it is not among the ``known``."""
    w = F.translate(F.lower(F.trim(c)), " -", "__")
    return F.when(w.isin(*known), w) if known else w


def distinct_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items of an array whose key is new, first spelling kept, in order."""
    return once(items, lambda v: once(F.transform(v, key), lambda keys: F.filter(v, lambda x, i: F.array_position(keys, keys[i]) == i + 1)))


def clean_list(items: Column, size: int = 80, most: int | None = None) -> Column:
    """Clean texts of an array without blanks, each once whatever its case, at most ``most``; null gives an empty one."""
    fn = partial(words.distinct_texts, size=size, most=most)
    return F.coalesce(_applied(f"list {size} {most}", fn, items, "array<string>", pa.list_(pa.string())), F.array().cast("array<string>"))


def content_hash(*parts: Column) -> Column:
    """First 16 hex digits of SHA-256 over the parts, each ended by a unit separator; null reads 'None'."""
    body = F.concat(*[F.concat(F.coalesce(p.cast("string"), F.lit("None")), F.lit("\x1f")) for p in parts])
    return F.substring(F.sha2(body, 256), 1, 16)
