"""The registry of sources, from a table or a YAML file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a source in the file.
FIELDS = ("key", "name", "homepage", "listing_url", "tier", "roles", "access", "trust", "rate_limit_rps", "respect_robots_txt", "enabled", "notes")
SCHEMA = "source_key string, name string, homepage string, listing_url string, tier int, source_roles array<string>, access string, trust double, rate_limit_rps double, respect_robots_txt boolean, enabled boolean, notes string, extra map<string,string>"


def load_yaml(spark: SparkSession, path: str) -> DataFrame:
    """The registry of a YAML file: ``defaults`` under every entry of ``sources``; unknown keys go to
    ``extra``; entries that are no mappings are skipped; a repeated key or missing name is an error."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    rows, seen = [], set()
    for entry in data.get("sources") or []:
        if not isinstance(entry, dict):
            continue
        e = {**(data.get("defaults") or {}), **entry}
        if not e.get("key") or not e.get("name"):
            raise ValueError(f"a source without key or name: {entry!r}")
        if e["key"] in seen:
            raise ValueError(f"source {e['key']!r} is listed twice")
        seen.add(e["key"])
        extra = {k: str(v) for k, v in e.items() if k not in FIELDS}
        num = lambda x: None if x is None else float(x)
        rows.append((e["key"], e["name"], e.get("homepage"), e.get("listing_url"), int(e.get("tier", 3)), list(e.get("roles") or []), e.get("access"), num(e.get("trust")), num(e.get("rate_limit_rps")), bool(e.get("respect_robots_txt", True)), bool(e.get("enabled", True)), e.get("notes"), extra))
    return spark.createDataFrame(rows, SCHEMA)


def active(registry: DataFrame, role: str | None = None) -> DataFrame:
    """Enabled sources (of a role) in the order of tier and key."""
    r = registry.where(F.col("enabled"))
    if role:
        r = r.where(F.array_contains("source_roles", role))
    return r.orderBy("tier", "source_key")


def primary(registry: DataFrame) -> DataFrame:
    """Sources of the first tier in the order of their keys."""
    return registry.where(F.col("tier") == 1).orderBy("source_key")


def summary(registry: DataFrame) -> DataFrame:
    """(tier, sources, enabled_sources, accesses): the registry by tier."""
    return registry.groupBy("tier").agg(F.count("*").alias("sources"), F.count_if("enabled").alias("enabled_sources"), F.countDistinct("access").alias("accesses"))


def roles(registry: DataFrame) -> DataFrame:
    """(role, sources, enabled_sources, best_trust) over all sources."""
    r = registry.select(F.explode("source_roles").alias("role"), "enabled", F.nanvl("trust", F.lit(None).cast("double")).alias("trust"))
    return r.groupBy("role").agg(F.count("*").alias("sources"), F.count_if("enabled").alias("enabled_sources"), F.max("trust").alias("best_trust"))
