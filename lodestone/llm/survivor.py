"""The best value of each field in a group of duplicates, in one aggregation.

For every field the maximum of one composite struct (usable, trust, time, smallest id) is taken;
rows are never gathered or sorted, so a group of any size costs one partial aggregate per task.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import weburls
from lodestone.session import bounded_rows

# Words that stand where a description is missing.
EMPTY_TEXT = r"^(n a|na|none|null|nil|nan|undefined|unknown|tbd|tba|todo|empty|blank|missing|untitled|test|description|coming soon|to be (added|announced|defined|done|confirmed|written)|not (available|provided|specified)|lorem ipsum.*|(no |missing |your |the |product |tool |add |insert |sample |placeholder |a )*(description|text|summary|tagline)( here| goes here| available| yet| provided| found| given| text| to be added| coming soon| not available| unavailable| missing| pending| tbd)*)$"
CUT_OFF = r"(…|\.{3}|\[\s*(…|\.{2,}|more)\s*\]|\(\s*(…|\.{3}|more)\s*\)|\bread more)\s*[.\"”)]*\s*$"
# Words that stand where a category is missing.
EMPTY_CATEGORY = r"^(n a|na|none|null|nil|nan|undefined|unknown|tbd|tba|other|others|misc|miscellaneous|various|uncategori[sz]ed|un categori[sz]ed|general|default|category|categories|no category|unassigned|untitled|test|x)$"


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " "))


def usable_text(c: Column) -> Column:
    """A description that tells something and is not cut off; null and blank are not usable."""
    p = _plain(c)
    return F.coalesce((p != "") & ~p.rlike(EMPTY_TEXT) & ~c.rlike(CUT_OFF), F.lit(False))


def usable_categories(c: Column) -> Column:
    """A list with at least one entry that names a category."""
    return F.coalesce(F.exists(c, lambda x: F.coalesce((_plain(x) != "") & ~_plain(x).rlike(EMPTY_CATEGORY), F.lit(False))), F.lit(False))


def _squeezed(text: str | None) -> str:
    return re.sub(r"[^\w]|_", "", (text or "").lower())


def row_trust(sources: Column, configs: DataFrame, unknown: float = 0.5, max_sources: int = 20_000) -> Column:
    """The highest trust of a row's sources, known by name, key or host of their URL.

    ``configs`` is a registry of at most ``max_sources`` rows; it is broadcast once as a table of
    keys, so the lookup needs no join. Null trust counts ``unknown``; a row without sources ranks
    last (-1). A source the registry does not know also counts ``unknown``.
    """
    rows = bounded_rows(configs.select("source_key", "name", "homepage", "listing_url", "trust"), max_sources, "the source registry")
    trusts: dict[tuple[str, str], float] = {}
    for r in rows:
        trust = unknown if r["trust"] is None or math.isnan(r["trust"]) else float(r["trust"])
        hosts = [(weburls.spelled(u) or {}).get("host") for u in (r["homepage"], r["listing_url"]) if u]
        for key in [("name", _squeezed(r["source_key"])), ("name", _squeezed(r["name"])), *[("host", h) for h in hosts]]:
            if key[1]:
                trusts[key] = max(trust, trusts.get(key, trust))
    shared = configs.sparkSession.sparkContext.broadcast(trusts)

    def of(names: list, urls: list) -> float:
        known, best = shared.value, -1.0
        for name, url in zip(names, urls):
            t = known.get(("name", _squeezed(name)))
            if t is None and url:
                t = known.get(("host", (weburls.spelled(url) or {}).get("host")))
            best = max(best, unknown if t is None else t)
        return best

    @F.arrow_udf("double")
    def trust(names: pa.Array, urls: pa.Array) -> pa.Array:
        seen: dict[tuple, float] = {}
        out = []
        for n, u in zip(names.to_pylist(), urls.to_pylist()):
            key = (tuple(n or ()), tuple(u or ()))
            if key not in seen:
                seen[key] = of(*key)
            out.append(seen[key])
        return pa.array(out, pa.float64())

    present = F.filter(F.coalesce(sources, F.array()), lambda s: s.isNotNull())
    return trust(F.transform(present, lambda s: s["name"]), F.transform(present, lambda s: s["url"]))


def survivors(groups: DataFrame, configs: DataFrame) -> DataFrame:
    """(group_no, field_name, prep_id, value_text, value_list): per group and field the row whose value survives.

    Among rows with a usable value the most trusted wins, then the latest discovered_at (null is
    earliest), then the smallest prep_id; a field without a usable value gives no row. Rows
    without group_no or prep_id are left out.
    """
    g = groups.select("group_no", "prep_id", "observed_description", "categories", "discovery_sources", "discovered_at")
    g = g.where("group_no is not null and prep_id is not null").withColumn("trust", row_trust(F.col("discovery_sources"), configs))

    def best(usable: Column, value: str) -> Column:
        rank = F.struct("trust", F.coalesce(F.unix_micros("discovered_at"), F.lit(-(2**62))).alias("at"), (-F.col("prep_id")).alias("id"), F.col(value).alias("value"))
        return F.max(F.when(usable, rank))

    one = g.withColumn("discovered_at", F.col("discovered_at").cast("timestamp")).groupBy("group_no")
    out = one.agg(
        best(usable_text(F.col("observed_description")), "observed_description").alias("t"),
        best(usable_categories(F.col("categories")), "categories").alias("c"),
    )
    rows = F.array(
        F.struct(F.lit("observed_description").alias("field_name"), (-F.col("t.id")).alias("prep_id"), F.col("t.value").alias("value_text"), F.lit(None).cast("array<string>").alias("value_list")),
        F.struct(F.lit("categories").alias("field_name"), (-F.col("c.id")).alias("prep_id"), F.lit(None).cast("string").alias("value_text"), F.col("c.value").alias("value_list")),
    )
    return out.select("group_no", F.explode(rows).alias("r")).select("group_no", "r.*").where("prep_id is not null")
