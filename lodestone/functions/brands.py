"""Whether names, texts and domains speak of the same brand, as Spark columns."""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions import urls, words

#: Keys shorter than this are no proof inside a longer text.
STEM = 4


def _told(name: str, value: str) -> bool:
    needle = words.name_key(name)
    if not needle:
        return False
    if len(needle) < STEM:
        return any(words.name_key(w) == needle for w in words.identity_words(value))
    forms = (words.name_key(value, drop_noise=noise, tagline=False) for noise in (False, True))
    return any(f and needle in f for f in forms)


def tells_name(name: Column, value: Column) -> Column:
    """Whether a text (title, heading, label) bears a name; false if either is missing."""

    @F.arrow_udf("boolean")
    def told(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([bool(x and y and _told(x, y)) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())

    return told(name, value)


def names_overlap(a: Column, b: Column, a_words: Column, b_words: Column) -> Column:
    """Whether two name keys are equal, one holds the other, or the names share a word; false if either is missing."""
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return F.coalesce((a == b) | ((F.length(short) >= STEM) & F.contains(long, short)) | F.arrays_overlap(a_words, b_words), F.lit(False))


def domain_tells_name(name_key: Column, url: Column) -> Column:
    """Whether the registrable domain of an address is named after a product (by its name's key)."""
    from lodestone.functions.text import canonical_name

    label = canonical_name(F.substring_index(urls.product(url)["domain"], ".", 1))
    return F.coalesce((name_key == label) | ((F.length(name_key) >= STEM) & F.contains(label, name_key)), F.lit(False))
