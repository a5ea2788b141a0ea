"""Selecting the best rows under a quota per class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def quota(rows: DataFrame, key: str, group: str, score: str, target: int, cap: int, floor: float | None = None, salts: int = 64) -> DataFrame:
    """(key, group, score, outcome) with order: score descending, then key ascending.

    The outcome of a row that is not taken is ``over_quota`` if it stood before the last row
    taken (or the target was never reached), else ``next_batch``; with a ``floor``, rows without
    a score or below it are ``not_eligible`` and take no place. A class is ranked in salted parts
    first, and only their first ``cap`` rows meet; rows that repeat a key share its outcome.
    """
    r = rows.select(key, group, score)
    eligible = F.lit(True) if floor is None else F.coalesce(F.col(score) >= floor, F.lit(False))
    place = F.struct(F.coalesce(-F.col(score).cast("double"), F.lit(float("inf"))).alias("s"), F.col(key).alias("k"))
    p = r.where(eligible).select(F.col(group).alias("_group"), place.alias("place")).distinct()
    rank = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("place"))
    top = p.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(salts))).withColumn("n", rank("_group", "salt")).where(F.col("n") <= cap)
    top = top.withColumn("n", rank("_group")).where(F.col("n") <= cap)
    # The last row taken: one row for the driver.
    last = top.orderBy("place").limit(target).agg(F.max("place").alias("edge"), F.count("*").alias("taken")).first()
    edge = F.struct(F.lit(last["edge"]["s"] if last["taken"] else None).cast("double").alias("s"), F.lit(last["edge"]["k"] if last["taken"] else None).cast(r.schema[key].dataType).alias("k"))
    before = (place <= edge) if last["taken"] else F.lit(False)
    limits = top.groupBy("_group").agg(F.max("place").alias("limit"))
    out = r.join(limits, F.col(group).eqNullSafe(F.col("_group")), "left")
    inside = F.coalesce(place <= F.col("limit"), F.lit(False))
    outcome = F.when(~eligible, "not_eligible").when(inside & before, "selected").when(F.lit(last["taken"] >= target) & ~before, "next_batch").otherwise("over_quota")
    return out.select(key, group, score, outcome.alias("outcome"))
