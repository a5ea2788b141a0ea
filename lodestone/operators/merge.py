"""Merging rows of one key: first value wins, gaps are filled, lists are united in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text, urls


def first_value(c: Column, *order: Column) -> Column:
    """Aggregate: the value that is not null (nor blank) and comes first by ``order``."""
    present = F.when(c.isNotNull() & (c.cast("string") != ""), F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], c.alias("v")))
    return F.min(present)["v"]


def first_array(c: Column, *order: Column) -> Column:
    """Aggregate: the first array by ``order`` that is not empty."""
    return F.min(F.when(F.size(c) > 0, F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], c.alias("v"))))["v"]


def united(df: DataFrame, key: str, items: str, order: Sequence[str], out: str) -> DataFrame:
    """(key, out): the distinct items of an array column per key, by first appearance.

    Items are reduced to their first place by partial aggregation before a key's list is made,
    so a key with very many rows carries its distinct items only.
    """
    e = df.select(key, *order, F.posexplode(items).alias("at", "item")).where("item is not null")
    first = e.groupBy(key, "item").agg(F.min(F.struct(*order, "at")).alias("place"))
    lists = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("l"))
    return lists.select(key, F.transform("l", lambda x: x["item"]).alias(out))


def merge_candidates(candidates: DataFrame) -> DataFrame:
    """One row per exact identity of raw sightings.

    The order is row_id; the first row's scalars win, missing ones are filled from later rows;
    categories and contributing sources are united. Rows with a null row_id are left out.
    """
    c = candidates.select("row_id", "name", "source_key", "source_name", "listing_url", "website", "tagline", "categories", "discovered_at").where("row_id is not null")
    c = c.withColumn("key", urls.candidate_key(F.col("name"), F.col("website"), F.col("listing_url")))
    o = F.col("row_id")
    one = c.groupBy("key").agg(
        F.min("row_id").alias("row_id"),
        F.count("*").alias("sightings"),
        F.countDistinct("source_key").alias("sources"),
        F.min_by("name", "row_id").alias("name"),
        F.min_by("source_key", "row_id").alias("source_key"),
        first_value(F.col("website"), o).alias("website"),
        first_value(F.col("listing_url"), o).alias("listing_url"),
        first_value(F.col("tagline"), o).alias("tagline"),
        F.min("discovered_at").alias("first_seen"),
    )
    return one.join(united(c, "key", "categories", ["row_id"], "categories"), "key", "left").withColumn("categories", F.coalesce("categories", F.array().cast("array<string>")))


def _keyed(candidates: DataFrame) -> DataFrame:
    return candidates.where("row_id is not null").withColumn("key", urls.candidate_key(F.col("name"), F.col("website"), F.col("listing_url")))


def merged_signals(candidates: DataFrame) -> DataFrame:
    """(key, signal, value): the signals of all sightings of one identity, named source.signal, the first row's value of each.

    One row per signal, so an identity that very many sources show is no single value; signals
    that are no JSON object, null values and rows without source are left out.
    """
    c = _keyed(candidates).where("source_key is not null").select("key", "row_id", "source_key", F.explode(F.from_json("raw_signals", "map<string,string>")).alias("name", "value")).where("value is not null")
    return c.groupBy("key", F.concat_ws(".", "source_key", "name").alias("signal")).agg(F.min_by("value", "row_id").alias("value"))


def contributions(candidates: DataFrame) -> DataFrame:
    """(key, source_key, listing_url, row_id): which sources showed an identity where, the first row of each."""
    return _keyed(candidates).groupBy("key", "source_key", "listing_url").agg(F.min("row_id").alias("row_id"))


def golden_records(groups: DataFrame) -> DataFrame:
    """One record per group_no from rows already grouped.

    The primary row is the one that is verified, has a website, the most filled fields and the
    most sources (ties: smallest prep_id). Its scalars win, gaps are filled from the other rows
    in prep_id order; categories, issues and source keys are united, flags are or-ed and the
    other names become aliases. Null lists count as empty, null flags as false.
    """
    g = groups.select("group_no", "prep_id", "name", "website", "observed_description", "categories", "source_keys", "discovered_at", "verification_status", "issues", "needs_review", F.coalesce(F.size("discovery_sources"), F.lit(0)).alias("n_sources")).where("group_no is not null and prep_id is not null")
    filled = sum((F.coalesce(x, F.lit(False)).cast("int") for x in (F.col("website") != "", F.col("observed_description") != "", F.size("categories") > 0, F.col("discovered_at").isNotNull())), F.lit(0))
    verified = (text.code_word(F.col("verification_status")) == "verified").cast("int")
    rank = F.struct((-F.coalesce(verified, F.lit(0))).alias("v"), F.col("website").isNull().cast("int").alias("w"), (-filled).alias("f"), (-F.greatest("n_sources", F.lit(0))).alias("s"), F.col("prep_id").alias("id"))
    g = g.withColumn("rank", rank)
    primary = g.groupBy("group_no").agg(F.min("rank").alias("top"))
    g = g.join(primary, "group_no").withColumn("own", (F.col("rank.id") != F.col("top.id")).cast("int"))
    o = (F.col("own"), F.col("prep_id"))
    one = g.groupBy("group_no").agg(
        F.min("top.id").alias("prep_id"),
        F.count("*").alias("members"),
        first_value(F.col("name"), *o).alias("name"),
        first_value(F.col("website"), *o).alias("website"),
        first_value(F.col("observed_description"), *o).alias("observed_description"),
        F.max("discovered_at").alias("last_seen"),
        F.max(F.coalesce("needs_review", F.lit(False))).alias("needs_review"),
        F.array_sort(F.collect_set(F.nullif("name", F.lit("")))).alias("aliases"),
    )
    for items in ("categories", "source_keys", "issues"):
        one = one.join(united(g, "group_no", items, ["own", "prep_id"], items), "group_no", "left").withColumn(items, F.coalesce(items, F.array().cast("array<string>")))
    return one


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by ``order``, found by partial aggregation of whole rows."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*[F.col(c) for c in (*order, *rest)])
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("row")).select(*keys, "row.*").select(*df.columns)
