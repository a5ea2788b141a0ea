"""Scans of JSON lines: malformed lines and other root kinds are told apart, never dropped silently."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANDIDATE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "source_key", "source_name", "listing_url", "website", "tagline")]
    + [T.StructField("categories", T.ArrayType(T.StringType())), T.StructField("raw_signals", T.StringType()), T.StructField("raw_payload", T.StringType()), T.StructField("discovered_at", T.StringType())]
)


def root_kind(line: Column) -> Column:
    """object, array, string, number, boolean, null or malformed: the root of a JSON text; null for blank."""
    t = F.trim(line)
    first = F.substring(t, 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")
    return F.when(t.isNotNull() & (t != ""), F.when(F.try_parse_json(t).isNotNull() | (t == "null"), kind).otherwise("malformed"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line, kind) of JSON-lines files; a path that does not exist gives no rows.

    Blank lines are skipped. line_no orders lines within a file's split; with the file it orders
    the whole input.
    """
    if not any(ch in path for ch in "*?[") and "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], "file string, line_no bigint, line string, kind string")
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    return raw.where(F.trim("line") != "").withColumn("kind", root_kind(F.col("line")))


def classify(lines: DataFrame) -> DataFrame:
    """Candidate rows of scanned lines with skip_reason.

    malformed, not_a_mapping, no_name, no_source_key or no_pointer; null for rows to keep. A
    source key that is missing is taken from the file's name unless the file is the merged feed;
    a time that can't be read becomes null. ``repairs`` names the fields where that was done.
    """
    stem = F.regexp_extract("file", r"([^/]+?)(\.jsonl?)?(\.gz)?$", 1)
    r = lines.withColumn("r", F.when(F.col("kind") == "object", F.from_json("line", CANDIDATE)))
    blank = lambda c: F.nullif(F.regexp_replace(c, "^[\\s\\p{Z}]+|[\\s\\p{Z}]+$", ""), F.lit(""))
    key = F.coalesce(blank(F.col("r.source_key")), F.when(stem != "candidates", stem))
    reason = (
        F.when(F.col("kind") == "malformed", "malformed")
        .when(F.col("kind") != "object", "not_a_mapping")
        .when(blank(F.col("r.name")).isNull(), "no_name")
        .when(key.isNull(), "no_source_key")
        .when(blank(F.col("r.website")).isNull() & blank(F.col("r.listing_url")).isNull(), "no_pointer")
    )
    time = F.try_to_timestamp("r.discovered_at")
    repairs = F.array_compact(F.array(F.when(blank(F.col("r.source_key")).isNull() & key.isNotNull(), F.lit("source_key")), F.when(blank(F.col("r.discovered_at")).isNotNull() & time.isNull(), F.lit("discovered_at"))))
    return r.select("file", "line_no", reason.alias("skip_reason"), repairs.alias("repairs"), *[F.col(f"r.{f.name}").alias(f.name) for f in CANDIDATE if f.name not in ("source_key", "discovered_at")], key.alias("source_key"), time.alias("discovered_at"))


def load_report(classified: DataFrame) -> DataFrame:
    """(file, rows, kept, repaired, skipped): what became of the lines of each file; skipped counts by reason."""
    reasons = ("malformed", "not_a_mapping", "no_name", "no_source_key", "no_pointer")
    counts = F.create_map(*[x for r in reasons for x in (F.lit(r), F.count_if(F.col("skip_reason") == r))])
    kept = F.col("skip_reason").isNull()
    return classified.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(kept).alias("kept"), F.count_if(kept & (F.size("repairs") > 0)).alias("repaired"), counts.alias("skipped"))


def load_candidates(spark: SparkSession, path: str, source_keys: list[str] | None = None) -> DataFrame:
    """Kept candidate rows of a file or folder, of all sources or the given ones."""
    rows = classify(read_lines(spark, path)).where("skip_reason is null")
    return rows.where(F.col("source_key").isin(source_keys)) if source_keys else rows


def signal(json: Column, key: str) -> Column:
    """A whole-number signal of a JSON object: digits only, with k and m for thousands and millions; else null."""
    v = F.lower(F.get_json_object(json, f"$.{key}"))
    factor = F.when(v.endswith("k"), 1_000).when(v.endswith("m"), 1_000_000).otherwise(1)
    number = F.regexp_extract(v, r"^(\d+(?:\.\d+)?)[km]?$", 1)
    return F.when(number != "", F.round(number.cast("double") * factor).cast("bigint"))
