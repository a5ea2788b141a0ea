"""Freely typed values brought to a reference list, by a trie walked with a Levenshtein automaton.

All labels of a field lie in one trie, and so do the alias paths to them: the names their glosses
list, further names given as a table, and their words in sorted order. The automaton's state is
the row of edit distances of a trie prefix to the value (with neighbouring swaps); a branch is
left as soon as no entry below it can stay within the distance allowed for the value's length.
Words cut short with a dot are walked as open ends. The reference list is broadcast once.
"""

from __future__ import annotations

import re
import unicodedata
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.folding import invisible, letter_table
from lodestone.session import bounded_rows

# Words put around a value that do not change what it means.
BEFORE = (("ai", "powered"), ("best",), ("ai",), ("top",), ("new",), ("the",), ("my",), ("great",))
AFTER = (("and", "more"), ("tools",), ("tool",), ("apps",), ("app",), ("ai",), ("etc",), ("software",))

_TABLE = str.maketrans(letter_table() | {c: None for c in invisible()})
_JOIN = re.compile(r"\s*[&+]\s*|(?<=[^\W\d_])\s*/\s*(?=[^\W\d_])")


def _folded(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.translate(_TABLE))
    return "".join(c for c in text if not unicodedata.combining(c)).translate(_TABLE).casefold()


def plain(text: str) -> str:
    """Lower-case words of a value, parted by one space; signs between words read as 'and'."""
    return " ".join(re.findall(r"\$\d+|[^\W_]+", _JOIN.sub(" and ", _folded(text))))


def allowed(length: int) -> int:
    """Edits allowed for a value of so many characters."""
    return 0 if length <= 3 else 1 if length <= 7 else 2 if length <= 12 else 3


class Trie:
    """Entries (text -> ids), searched for all within an edit distance."""

    __slots__ = ("root", "terms")

    def __init__(self, entries: list[tuple[str, int]]):
        self.root: dict = {}
        self.terms: dict[int, set] = {}
        for text, ident in entries:
            node = self.root
            for c in text:
                node = node.setdefault(c, {})
            self.terms.setdefault(id(node), set()).add(ident)

    def begun(self, words: list[tuple[str, bool]]) -> set:
        """Entries of just these words, of which those marked may be only the beginning."""
        states = [self.root]
        for k, (word, open_end) in enumerate(words):
            if k:
                states = [x[" "] for x in states if " " in x]
            for c in word:
                states = [x[c] for x in states if c in x]
            if open_end:
                ends, todo = [], states
                while todo:
                    ends += todo
                    todo = [child for x in todo for c, child in x.items() if c != " "]
                states = ends
        return set().union(*(self.terms.get(id(x), ()) for x in states))

    def exact(self, text: str) -> set:
        node = self.root
        for c in text:
            node = node.get(c)
            if node is None:
                return set()
        return self.terms.get(id(node), set())

    def within(self, text: str, k: int) -> dict[int, int]:
        """{id: least distance} of all entries within ``k`` edits (insert, delete, replace, swap).

        A state holds the distances of a trie prefix to the value's prefixes that differ from it
        by at most ``k`` in length: 2k + 1 numbers, the automaton's width.
        """
        found: dict[int, int] = {}
        n, far = len(text), k + 1
        first = [far] * k + list(range(k + 1))
        # A state: node, depth, row (row[x] is the distance to text[: depth - k + x]), row before, last character.
        stack = [(self.root, 0, first, None, "")]
        while stack:
            node, depth, row, before, last = stack.pop()
            end = n - depth + k
            if 0 <= end <= 2 * k and row[end] <= k:
                for ident in self.terms.get(id(node), ()):
                    if row[end] < found.get(ident, far):
                        found[ident] = row[end]
            deeper = depth + 1
            for c, child in node.items():
                new, least, left = [], far, far
                for x in range(2 * k + 1):
                    j = deeper - k + x
                    if j < 0 or j > n:
                        left = far
                    elif j == 0:
                        left = deeper if deeper < far else far
                    else:
                        d = row[x] + (text[j - 1] != c)
                        if x < 2 * k and row[x + 1] + 1 < d:
                            d = row[x + 1] + 1
                        if left + 1 < d:
                            d = left + 1
                        if before is not None and j > 1 and text[j - 1] == last and text[j - 2] == c and before[x] + 1 < d:
                            d = before[x] + 1
                        left = d if d < far else far
                    new.append(left)
                    if left < least:
                        least = left
                if least <= k:
                    stack.append((child, deeper, new, row, c))
                elif min(row) < k and deeper < n + k:  # a swap may still come within reach
                    stack.append((child, deeper, new, row, c))
        return found


#: Opens the paths of words in sorted order, which no plain text holds.
_SORTED = "\x01"


def _in_order(words: list[str]) -> str:
    return _SORTED + " ".join(sorted(w for w in words if w != "and"))


class Canon:
    """All entries of one field: (id, label, gloss, further names)."""

    def __init__(self, entries: list[tuple[int, str, str | None, tuple[str, ...]]]):
        paths: list[tuple[str, int]] = []
        for ident, label, gloss, further in sorted(entries):
            listed = (gloss.split(":", 1)[1] if gloss and ":" in gloss else re.sub(r"^Tools for ", "", gloss or "")).rstrip(". ").split("; ")
            names = [label, *listed, *further]
            for name in names + [x.replace("-", "") for x in names if "-" in x]:
                words = plain(name).split()
                if words:
                    paths.append((" ".join(words), ident))
                    if len([w for w in words if w != "and"]) > 1:
                        paths.append((_in_order(words), ident))
        self.trie = Trie(paths)

    def forms(self, value: str) -> list[list[str]]:
        """The words of a value, and what is left as decorations are taken off, outermost first."""
        bare = plain(value).split()
        forms = [bare] if bare else []
        while bare:
            for d in BEFORE:
                if tuple(bare[: len(d)]) == d and len(bare) > len(d):
                    bare = bare[len(d) :]
                    break
            else:
                for d in AFTER:
                    if tuple(bare[-len(d) :]) == d and len(bare) > len(d):
                        bare = bare[: -len(d)]
                        break
                else:
                    break
            forms.append(bare)
        return forms

    def all_within(self, value: str) -> dict[int, int]:
        """{entry: least distance} of all entries within the distance allowed for the value's length."""
        found: dict[int, int] = {}

        def take(ids, distance: int) -> None:
            for x in ids:
                found[x] = min(distance, found.get(x, distance))

        forms = self.forms(value)
        for f in forms:
            take(self.trie.exact(" ".join(f)), 0)
            if len(f) > 1:
                take(self.trie.exact(_in_order(f)), 0)
        if "." in value:
            given = re.findall(r"[^\s.]+\.?", _folded(value).replace("&", " and ").replace("_", " "))
            if any(len(g) > 3 and g.endswith(".") for g in given):
                take(self.trie.begun([(g.rstrip("."), g.endswith(".") and len(g) > 2) for g in given]), 0)
        for f in forms:
            text = " ".join(f)
            for ident, distance in self.trie.within(text, allowed(len(text))).items():
                take((ident,), distance)
        return found

    def find(self, value: str) -> int:
        """The entry a value means, the nearest and of equals the smallest id, or 0."""
        forms = self.forms(value)
        for f in forms:
            if hit := self.trie.exact(" ".join(f)):
                return min(hit)
        found = self.all_within(value)
        return min(found, key=lambda x: (found[x], x)) if found else 0


_BUILT: dict[tuple[int, str], tuple[Canon, dict]] = {}


class Reference:
    """A reference list of at most ``max_entries`` rows, broadcast once for all its fields.

    ``aliases`` (field_name, label, alias) are further names of entries, at most as many.
    """

    def __init__(self, canonical: DataFrame, aliases: DataFrame | None = None, max_entries: int = 200_000):
        rows = bounded_rows(canonical.select("field_name", "canonical_id", "label", "gloss").where("field_name is not null and label is not null and canonical_id is not null"), max_entries, "the reference list")
        further: dict[tuple[str, str], list[str]] = {}
        if aliases is not None:
            for r in bounded_rows(aliases.select("field_name", "label", "alias").where("alias is not null"), max_entries, "the table of aliases"):
                further.setdefault((r["field_name"], r["label"]), []).append(r["alias"])
        entries: dict[str, list] = {}
        for r in rows:
            entries.setdefault(r["field_name"], []).append((r["canonical_id"], r["label"], r["gloss"] or "", tuple(sorted(further.get((r["field_name"], r["label"]), ())))))
        self.labels = {f: sorted({e[1] for e in x}) for f, x in entries.items()}
        self.shared = canonical.sparkSession.sparkContext.broadcast(entries)

    def column(self, field: str, kind: str, use) -> object:
        """A column function: ``use`` (canon, value) of each distinct value; null gives null."""
        shared = self.shared

        def one(values: pd.Series) -> list:
            key = (shared.id if hasattr(shared, "id") else id(shared.value), field)
            if key not in _BUILT:
                _BUILT.clear() if len(_BUILT) > 8 else None
                _BUILT[key] = (Canon(shared.value.get(field, [])), {})
            canon, seen = _BUILT[key]
            out = []
            for v in values:
                if v is None:
                    out.append(None)
                    continue
                got = seen.get((kind, v))
                if got is None:
                    if len(seen) > 200_000:
                        seen.clear()
                    got = seen[(kind, v)] = use(canon, v)
                out.append(got)
            return out

        return one

    def ids(self, field: str):
        """Column -> the entry's id, 0 if nothing on the list is meant."""
        one = self.column(field, "id", lambda canon, v: canon.find(v))

        @F.pandas_udf("int")
        def ids(values: pd.Series) -> pd.Series:
            return pd.Series(one(values), dtype="Int32")

        return ids

    def distances(self, field: str):
        """Column -> all entries within the distance allowed, with their distances."""
        one = self.column(field, "all", lambda canon, v: [{"canonical_id": i, "distance": d} for i, d in sorted(canon.all_within(v).items())])

        @F.pandas_udf("array<struct<canonical_id:int,distance:int>>")
        def distances(values: pd.Series) -> pd.Series:
            return pd.Series(one(values), dtype=object)

        return distances


def _blank(c: Column) -> Column:
    return c.rlike("^[\\s\\p{Z}\\p{Cf}]*$")


def typed(values: DataFrame, field: str, reference: Reference) -> DataFrame:
    """The values (row_id, pos, value) that are neither null, blank nor a label, character for character."""
    v = values.where(F.col("value").isNotNull() & ~_blank(F.col("value")))
    labels = reference.labels.get(field, [])
    if len(labels) <= 500:
        return v.where(~F.col("value").isin(labels)) if labels else v
    known = v.sparkSession.createDataFrame([(x,) for x in labels], "value string")
    return v.join(known, "value", "left_anti").select("row_id", "pos", "value")


def mapped(values: DataFrame, field: str, reference: Reference) -> DataFrame:
    """(field_name, row_id, pos, canonical_id) of values (row_id, pos, value) of one field.

    Values that are null, blank or already a label, character for character, give no row; all
    others do, with 0 if nothing on the list is meant. The table is read once and nothing is
    shuffled. Of several entries the nearest wins, then the smallest id.
    """
    v = typed(values, field, reference)
    return v.select(F.lit(field).alias("field_name"), F.col("row_id").cast("bigint").alias("row_id"), F.col("pos").cast("int").alias("pos"), reference.ids(field)("value").alias("canonical_id"))


def every_match(values: DataFrame, field: str, reference: Reference) -> DataFrame:
    """(field_name, row_id, pos, canonical_id, distance): all entries within the distance allowed."""
    v = typed(values, field, reference).select("row_id", "pos", F.explode(reference.distances(field)("value")).alias("m"))
    return v.select(F.lit(field).alias("field_name"), F.col("row_id").cast("bigint").alias("row_id"), F.col("pos").cast("int").alias("pos"), "m.canonical_id", "m.distance")


def typed_values(candidates: DataFrame, tools: DataFrame) -> dict[str, DataFrame]:
    """field -> (row_id, pos, value) of the freely typed categories, primary tasks and pricing models."""
    scalar = lambda c: tools.select(F.col("tool_no").alias("row_id"), F.lit(0).alias("pos"), F.col(c).alias("value"))
    return {"categories": candidates.select("row_id", F.posexplode("categories").alias("pos", "value")), "primary_task": scalar("primary_task"), "pricing_model": scalar("pricing.model")}


def canonical_values(candidates: DataFrame, tools: DataFrame, canonical: DataFrame, aliases: DataFrame | None = None, every: bool = False) -> DataFrame:
    """``mapped`` (or, with ``every``, ``every_match``) for all typed values of both tables."""
    reference = Reference(canonical, aliases)
    parts = [(every_match if every else mapped)(v, field, reference) for field, v in typed_values(candidates, tools).items()]
    return parts[0].union(parts[1]).union(parts[2])
