"""Reports derived from tables: counters, rates, first examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def count_by(df: DataFrame, code: str) -> DataFrame:
    """(code, n)"""
    return df.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"))


def count_items(df: DataFrame, items: str) -> DataFrame:
    """(code, n): rows per element of an array column; an element counts once a row."""
    return df.select(F.explode(F.array_distinct(items)).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def rate(part: Column, whole: Column) -> Column:
    """part / whole to four places, null over nothing."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 4)


def by_source(prepared: DataFrame) -> DataFrame:
    """Counts and rates per source with a row for all (null source marked 'all')."""
    n = lambda cond: F.count_if(cond)
    r = prepared.rollup("source_key").agg(
        F.grouping("source_key").alias("total"),
        F.count("*").alias("rows"),
        n(F.col("reject_reason").isNull()).alias("accepted"),
        n(F.col("website").isNotNull()).alias("with_website"),
        n(F.col("identity_confidence") == "high").alias("high_confidence"),
        n(F.coalesce(F.col("needs_review"), F.lit(False))).alias("needs_review"),
        n(F.size("categories") > 0).alias("with_categories"),
    )
    return r.select(F.when(F.col("total") == 1, F.lit("all")).otherwise(F.coalesce("source_key", F.lit(""))).alias("source_key"), "rows", "accepted", "with_website", "high_confidence", "needs_review", "with_categories", rate(F.col("accepted"), F.col("rows")).alias("acceptance_rate"))


def examples(df: DataFrame, code: str, order: str, n: int, salts: int = 64) -> DataFrame:
    """(code, place, order): the first ``n`` rows of every code.

    Ranks are taken within salted parts of a code first, and then among the at most
    ``n * salts`` rows that are left, so no task ever sorts or holds a whole code.
    """
    part = W.partitionBy("code", "salt").orderBy(order)
    rows = df.where(F.col(code).isNotNull()).select(F.col(code).alias("code"), order, F.pmod(F.xxhash64(order), F.lit(salts)).alias("salt"))
    kept = rows.withColumn("r", F.row_number().over(part)).where(F.col("r") <= n)
    kept = kept.withColumn("r", F.row_number().over(W.partitionBy("code").orderBy(order))).where(F.col("r") <= n)
    return kept.select("code", (F.col("r") - 1).cast("int").alias("place"), order)
