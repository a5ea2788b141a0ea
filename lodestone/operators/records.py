"""Records over a resumable workflow: keys, latest rows, filled gaps, limits on work, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text, urls, values


def _or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def record_key(candidate_id: Column, identity_key: Column, source_key: Column, name: Column, listing: Column) -> Column:
    """The key a sighting is known by when work on it is resumed: its id, else its identity, else a hash of
    where it was seen. The website is no part of it, as later work fills it in."""
    given = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(given(candidate_id), given(identity_key), text.content_hash(_or_blank(source_key), _or_blank(name), _or_blank(listing)))


def verification_key(candidate_id: Column, websites: Sequence[Column], listings: Sequence[Column]) -> Column:
    """A hash of id, website and listing, each the first of its places that is filled."""
    first = lambda cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    return text.content_hash(_or_blank(candidate_id), _or_blank(first(websites)), _or_blank(first(listings)))


def facts_key(url: Column) -> Column:
    """A hash of an address in normal form; null for none."""
    page = urls.normalize_url(url)
    return F.when(page.isNotNull(), text.content_hash(F.lit("official_facts"), page))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key by ``order``, found by partial aggregation of whole rows; rows with a null key are left out."""
    row = F.struct(*[F.col(c) for c in df.columns])
    there = df.where(" and ".join(f"{k} is not null" for k in keys))
    return there.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(row, F.struct(*order)).alias("row")).select("row.*")


def same_ids(df: DataFrame, ident: str, order: str) -> DataFrame:
    """(ident, kept, rows): the first row of each id and how many rows it stands for."""
    return df.where(F.col(ident).isNotNull()).groupBy(ident).agg(F.min(order).alias("kept"), F.count("*").alias("rows"))


def limited_work(df: DataFrame, needs: Column, order: str, limit: int) -> DataFrame:
    """Rows up to the last that the limit on work allows: at most ``limit`` rows for which ``needs`` holds,
    and all other rows before the first one beyond it. ``order`` is unique; negative means no limit.

    The first row beyond the limit is found by a top-k query, so no task orders all rows.
    """
    if limit < 0:
        return df
    beyond = df.where(needs).select(order).orderBy(order).limit(limit + 1).agg(F.count("*").alias("n"), F.max(order).alias("edge")).first()
    return df if beyond["n"] <= limit else df.where(F.col(order) < F.lit(beyond["edge"]))


def gap_filled(df: DataFrame, column: str, value: Column, verified: str | None = None) -> DataFrame:
    """``df`` with a column filled where it is empty and not among the ``verified`` fields, and whether it was."""
    kind = df.schema[column].dataType.simpleString()
    free = F.lit(True) if verified is None else ~F.coalesce(F.array_contains(verified, column), F.lit(False))
    fill = values.is_empty(F.col(column), kind) & free & ~values.is_empty(value, kind)
    return df.withColumn(f"{column}_filled", fill).withColumn(column, F.when(F.col(f"{column}_filled"), value).otherwise(F.col(column)))


def applied(df: DataFrame, facts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the values of ``facts`` (one row per key) where they are not empty, and the names of those ``applied``."""
    f = facts.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    j = df.join(f, key, "left")
    filled = {c: ~values.is_empty(F.col(f"_{c}"), df.schema[c].dataType.simpleString()) for c in columns}
    names = F.array_sort(F.array_compact(F.array(*[F.when(filled[c], F.lit(c)) for c in columns])))
    j = j.withColumn("applied", names)
    return j.select(*[F.when(filled[c], F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in filled else F.col(c) for c in df.columns], "applied")


def enriched(rows: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``website`` filled from ``resolved`` (key, found, origin) only where it is empty, and its origin."""
    own = F.nullif(F.trim("website"), F.lit(""))
    j = rows.join(resolved.select(key, F.col("found").alias("_found"), F.col("origin").alias("_origin")), key, "left")
    origin = F.when(own.isNotNull(), "discovery_listing").when(F.col("_found").isNotNull(), F.coalesce("_origin", F.lit("directory_detail_page"))).otherwise("none")
    return j.withColumn("origin", origin).withColumn("website", F.coalesce(own, "_found")).select(*rows.columns, "origin")


def strongest(df: DataFrame, key: str, rank: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Per key the row with the least rank, by one partial aggregation."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*keep), F.struct(*rank)).alias("row")).select(key, "row.*")


def audit(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(ident, other): each pair told on both sides, once; a row per partner, so a record with very many is no single value."""
    p = pairs.select(F.col(left).alias("ident"), F.col(right).alias("other")).where("ident is not null and other is not null and ident <> other")
    return p.union(p.select("other", "ident")).distinct()


def outcomes(df: DataFrame, rejected: Column, review: Column) -> DataFrame:
    """``df`` with one outcome each: rejected, review or selected; unknown counts as no."""
    no = F.lit(False)
    return df.withColumn("outcome", F.when(F.coalesce(rejected, no), "rejected").when(F.coalesce(review, no), "review").otherwise("selected"))


def source_refs(df: DataFrame, ident: str, refs: str, fallback: Column) -> DataFrame:
    """(ident, refs): the references of a record, each once; one made from ``fallback`` (name) where there is none."""
    kept = values.distinct_refs(F.col(refs))
    names = F.transform(kept, lambda r: r["name"])
    return df.select(ident, F.when(F.size(names) > 0, names).when(fallback.isNotNull(), F.array(fallback)).otherwise(F.array().cast("array<string>")).alias("refs"))


