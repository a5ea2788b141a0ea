"""Preparing raw sightings: clean fields, one spelling of addresses, a deterministic identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text, urls

# Separators that glue a tagline to a name.
TAGLINE = r" (\||—|–|::|•|·) "


def _issues() -> Column:
    found = F.array(
        F.when(F.col("identity_basis") == "name", F.lit("weak_identity_name_only")),
        F.when(F.col("website").isNull(), F.lit("no_official_website_observed")),
        F.when(F.col("observed_description").isNull(), F.lit("no_description_observed")).when(F.length("observed_description") < 20, F.lit("observed_description_too_short")),
        F.when(F.size("categories") == 0, F.lit("no_categories_observed")),
        F.when(F.col("name").rlike(TAGLINE), F.lit("name_may_contain_a_tagline")),
        F.when(F.col("discovered_at").isNull(), F.lit("no_discovered_at_recorded")),
    )
    return F.array_compact(found)


REVIEWED = ("weak_identity_name_only", "no_official_website_observed", "name_may_contain_a_tagline")


def prepare(candidates: DataFrame) -> DataFrame:
    """One row per sighting, prepared or with a reject_reason (no_name, no_pointer, no_identity).

    Needs row_id, name, source_key, website, listing_url, tagline, categories, discovered_at; nulls
    are taken as missing, other columns are left out. Addresses and names are parsed once per
    distinct value of an Arrow batch, the rest runs in generated code, over the scan's own
    partitions; nothing is shuffled.
    """
    c = candidates.select(
        "row_id",
        "source_key",
        text.clean_text(F.col("name"), 200).alias("name"),
        urls.address(F.col("website")).alias("site"),
        urls.address(F.col("listing_url")).alias("page"),
        text.clean_text(F.col("tagline"), 320).alias("observed_description"),
        text.clean_list(F.col("categories")).alias("categories"),
        "discovered_at",
    )
    c = c.withColumn("name_key", text.canonical_name(F.col("name"))).withColumn("slug", text.slugify(F.col("name")))
    c = c.withColumn("identity", urls.identity_of([("website", F.col("site.product"), "high"), ("listing", F.col("page.product"), "medium")], F.col("name_key")))
    c = c.withColumn("website", F.col("site.url")).withColumn("listing_url", F.col("page.url"))
    reason = F.when(F.col("name").isNull(), "no_name").when(F.col("website").isNull() & F.col("listing_url").isNull(), "no_pointer").when(F.col("identity").isNull(), "no_identity")
    c = c.select(
        "row_id",
        "source_key",
        reason.alias("reject_reason"),
        urls.entity_id("tool", F.col("identity.key")).alias("candidate_id"),
        F.col("identity.key").alias("identity_key"),
        F.col("identity.basis").alias("identity_basis"),
        F.col("identity.confidence").alias("identity_confidence"),
        "name",
        "name_key",
        "slug",
        "website",
        F.col("site.product.domain").alias("website_domain"),
        "listing_url",
        "observed_description",
        "categories",
        "discovered_at",
    )
    c = c.withColumn("issues", _issues())
    return c.withColumn("needs_review", F.arrays_overlap("issues", F.array(*[F.lit(x) for x in REVIEWED])))


def accepted(prepared: DataFrame) -> DataFrame:
    """Rows without a reject reason."""
    return prepared.where("reject_reason is null")


def rejected(prepared: DataFrame) -> DataFrame:
    """Rows with a reject reason."""
    return prepared.where("reject_reason is not null")
