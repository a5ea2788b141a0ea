"""Joins of the engine: resume by key, cascading lookup, semi-join of allowed ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.merge import keep_first


def pending(rows: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key is not done yet, the first of each key by ``order``; a null key is never done."""
    first = keep_first(rows.where(F.col(key).isNotNull()), [key], [order])
    left = first.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti").select(*rows.columns)
    return left.union(rows.where(F.col(key).isNull()))


def cascade(left: DataFrame, right: DataFrame, steps: Sequence[tuple[str, str, str]], right_id: str, order: str) -> DataFrame:
    """Each left row with the right row found by the first key that finds one.

    ``steps`` are (label, left column, right column), strongest first. On the right the first
    row of a key by ``order`` stands for it. Adds ``matched`` (right_id) and ``matched_by``.
    All steps are tried in one join: keys are labelled and stacked, so each side is shuffled once;
    missing keys meet nothing and stay out of the join. Equal left rows all stay.
    """
    label = lambda k, c: F.struct(F.lit(k).alias("step"), F.col(c).cast("string").alias("key"))
    keyed = F.explode(F.array(*[label(k, r) for k, (_, _, r) in enumerate(steps)]))
    found = right.select(F.col(order).alias("o"), F.col(right_id).alias("matched"), keyed.alias("k")).where("k.key is not null")
    found = found.groupBy("k.step", "k.key").agg(F.min_by("matched", F.struct("o", "matched")).alias("matched"))
    present = F.filter(F.array(*[label(k, c) for k, (_, c, _) in enumerate(steps)]), lambda x: x["key"].isNotNull())
    names = F.array(*[F.lit(label) for label, _, _ in steps])
    own = left.columns
    probes = left.select("*", F.posexplode_outer(present).alias("_place", "_k"))
    hit = probes.where("_k is not null").withColumn("_step", F.col("_k.step")).withColumn("_key", F.col("_k.key"))
    hit = hit.join(found.select(F.col("step").alias("_step"), F.col("key").alias("_key"), F.col("matched").alias("_matched")), ["_step", "_key"], "left")
    alone = probes.where("_k is null").withColumn("_step", F.lit(0)).withColumn("_matched", F.lit(None).cast(found.schema["matched"].dataType))
    both = hit.select(*own, "_place", "_step", "_matched").union(alone.select(*own, "_place", "_step", "_matched"))
    best = both.groupBy(*own).agg(F.min(F.when(F.col("_matched").isNotNull(), F.struct("_step", "_matched"))).alias("_best"), F.count_if(F.coalesce("_place", F.lit(0)) == 0).alias("_rows"))
    best = best.select(*own, "_best", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows")))
    return best.select(*own, F.col("_best._matched").alias("matched"), F.try_element_at(names, F.col("_best._step") + 1).alias("matched_by"))


def allowed(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids."""
    return rows.join(ids.select(key), key, "left_semi").select(*rows.columns)


def remaining(all_keys: Column, done: Column) -> Column:
    """Array difference, without repeats, in order."""
    return F.array_except(all_keys, done)
