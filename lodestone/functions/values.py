"""Dates, prices, numbers, arrays and maps as Spark columns."""

import re
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import partial

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.batches import per_value

# Signs and codes of currencies.
CURRENCIES = {"$": "USD", "€": "EUR", "£": "GBP", "¥": "JPY", "usd": "USD", "eur": "EUR", "gbp": "GBP"}
# Fixed value: the form of a price.
PRICE = "(?i)([$€£¥]|usd|eur|gbp)\\s?(\\d{1,5}(?:[.,]\\d{1,2})?)"
# Words for no price.
FREE = ("free", "$0", "no cost")
# Words too general to be stored.
VAGUE = (
    "ai content", "ai", "content", "ai output", "ai input", "data", "anything", "everything", "various", "misc", "miscellaneous", "other", "others", "n/a", "generic",
    "all formats", "any format", "any", "stuff", "information", "ai generated content", "ai-generated content", "output", "input",
)
#: The first year of a date that is believed.
FIRST_YEAR = 1990


def dated(text: str, today: date, facts: bool = False) -> dict | None:
    """The date a text tells and how precisely: year, month or day; None for no date, old and future ones."""
    from dateutil import parser

    t = " ".join(text.split())
    if m := re.fullmatch(r"(\d{4})(?:-(0[1-9]|1[0-2]))?", t):
        found = date(int(m[1]), int(m[2] or 1), 1) if int(m[1]) else None
        precision = "month" if m[2] else "year"
    else:
        try:
            found = parser.parse(t, default=datetime(2000, 1, 1)).date()
        except (ValueError, OverflowError, TypeError):
            return None
        precision = "day" if re.search(r"(?<!\d)\d{1,2}(?!\d)", t) else "month"
    if found is None or found.year < FIRST_YEAR or found > today:
        return None
    return {"date": found, "precision": precision}


def parse_date(c: Column, today: date) -> Column:
    """struct(date, precision) of a text; null where it tells no date up to ``today``."""
    kind = pa.struct([("date", pa.date32()), ("precision", pa.string())])
    return per_value(f"date {today}", partial(dated, today=today), "struct<date:date,precision:string>", kind)(c)


def days_since(c: Column, today: date) -> Column:
    """Whole days from a date to ``today``; null for none and for the future."""
    day = F.lit(today)
    return F.when(c.cast("date") <= day, F.datediff(day, c.cast("date")))


def _amount(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def price(c: Column) -> Column:
    """struct(amount, currency): the first price of a text; 0 where it only says that nothing is to be paid."""
    sign, amount = F.lower(F.regexp_extract(c, PRICE, 1)), F.regexp_extract(c, PRICE, 2)
    codes = F.create_map(*[F.lit(x) for pair in CURRENCIES.items() for x in pair])
    free = F.lower(c).rlike("|".join(re.escape(x) for x in FREE))
    return F.when(amount != "", F.struct(_amount(amount).alias("amount"), F.try_element_at(codes, sign).alias("currency"))).when(free, F.struct(F.lit(0.0).alias("amount"), F.lit(None).cast("string").alias("currency")))


def lowest_price(c: Column, most: float = 100_000) -> Column:
    """The lowest price of a text that is more than nothing and at most ``most``; null where there is none."""
    amounts = F.transform(F.regexp_extract_all(c, F.lit(PRICE), 2), _amount)
    return F.array_min(F.filter(amounts, lambda x: (x > 0) & (x <= most)))


def quantize(c: Column, places: int = 2) -> Column:
    """Rounded half up."""
    return F.round(c, places)


def share_points(weight: float, share: Column) -> Column:
    """The points that a share of a weight gives, to four places."""
    return F.round(F.lit(weight) * share, 4)


def weighted(parts: Sequence[tuple[float, Column]], most: float = 100.0) -> Column:
    """The sum of weights times fractions (0 to 1, null as 0), between 0 and ``most``."""
    total = sum((F.lit(w) * F.least(F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) for w, x in parts), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(most), total))


def graded(c: Column, steps: Sequence[tuple[float, float]], below: float = 0.0) -> Column:
    """The value of the first step (least, value), highest first, that ``c`` reaches; null gives ``below``."""
    out = F.when(F.lit(False), F.lit(below))
    for least, value in steps:
        out = out.when(c >= least, F.lit(value))
    return out.otherwise(F.lit(below))


def is_empty(c: Column, kind: str) -> Column:
    """Whether a value of a kind (``simpleString`` of its type) is missing: null, an empty text, list or map. 0 and false are values."""
    if kind == "string":
        return c.isNull() | (c == "")
    if kind.startswith(("array", "map")):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull()


def completeness(columns: Sequence[tuple[str, str]]) -> Column:
    """The share of (column, kind) that are filled, to three places."""
    return F.round(sum(((~is_empty(F.col(n), k)).cast("int") for n, k in columns), F.lit(0)) / len(columns), 3)


def distinct_items(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items of an array whose key is new, the first of each, in order; null items are left out."""
    kept = F.filter(items, lambda x: x.isNotNull())
    keys = F.transform(kept, key)
    return F.filter(kept, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def united(*lists: Column) -> Column:
    """The items of text lists in order, each once whatever its case; null lists count as empty."""
    none = F.array().cast("array<string>")
    return distinct_items(F.concat(*[F.coalesce(x, none) for x in lists]), F.lower)


def distinct_refs(refs: Column) -> Column:
    """References (name, url, ...) each once by name, whatever its case, and url; those without a name are left out."""
    named = F.filter(F.coalesce(refs, F.array()), lambda r: r["name"].isNotNull() & (F.trim(r["name"]) != ""))
    return distinct_items(named, lambda r: F.concat(F.lower(r["name"]), F.lit("\x1f"), F.coalesce(r["url"], F.lit(""))))


def merged_map(first: Column, second: Column) -> Column:
    """The entries of two maps; where both have a key the first one's value stays. Null maps count as empty."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(first, none), F.coalesce(second, none)
    return F.map_concat(a, F.map_filter(b, lambda k, _: ~F.map_contains_key(a, k)))


def without_vague(items: Column, vague: Sequence[str] = VAGUE) -> Column:
    """The texts of a list that say something."""
    none = F.array().cast("array<string>")
    return F.filter(F.coalesce(items, none), lambda x: x.isNotNull() & (F.trim(x) != "") & ~F.lower(F.trim(x)).isin(*vague))


def inferred(items: Column, known: Sequence[tuple[str, str]]) -> Column:
    """The label of the first item that is a known key or, in the order of the keys, holds one of more than three characters."""
    pairs = F.array(*[F.struct(F.lit(k.lower()).alias("k"), F.lit(v).alias("v")) for k, v in known])

    def label(x: Column) -> Column:
        word = F.lower(F.trim(x))
        exact = F.filter(pairs, lambda p: p["k"] == word)
        held = F.filter(pairs, lambda p: (F.length(p["k"]) > 3) & F.contains(word, p["k"]))
        return F.coalesce(F.get(exact, F.lit(0))["v"], F.get(held, F.lit(0))["v"])

    found = F.transform(F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x.isNotNull()), label)
    return F.get(F.filter(found, lambda v: v.isNotNull()), F.lit(0))
