"""Typed edges between entities, from columns of a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text, urls
from lodestone.operators.merge import keep_first


def relationships(tools: DataFrame) -> DataFrame:
    """(source_id, relationship, target_name, target_id, confidence), each edge once.

    company develops tool; tool solves task; tool is tagged with each tag. Ids are deterministic;
    a company is known by its site where it has one. Missing values give no edge.
    """
    t = tools.select("tool_no", "name", "company", "website", "primary_task", "tags", urls.identity(F.col("name"), F.col("website"), F.lit(None).cast("string"), F.col("company")).alias("i"))
    t = t.where("i is not null").withColumn("tool_id", urls.entity_id("tool", F.col("i.key")))
    verified = F.col("i.confidence") == "high"
    edge = lambda s, r, n, tid, yes, no: F.struct(s.alias("source_id"), F.lit(r).alias("relationship"), n.alias("target_name"), tid.alias("target_id"), F.when(verified, yes).otherwise(no).alias("confidence"))
    firm = F.coalesce(urls.entity_id("company", urls.product(F.col("website"))["domain"]), urls.entity_id("company", text.canonical_name(F.col("company"))))
    name, task = text.clean_text(F.col("name")), text.clean_text(F.col("primary_task"))
    one = F.array(
        F.when(text.clean_text(F.col("company")).isNotNull(), edge(firm, "develops", name, F.col("tool_id"), 0.95, 0.6)),
        F.when(task.isNotNull(), edge(F.col("tool_id"), "solves", task, urls.entity_id("task", text.canonical_name(F.col("primary_task"))), 0.9, 0.55)),
    )
    tags = F.transform(text.clean_list(F.col("tags")), lambda x: edge(F.col("tool_id"), "tagged", x, F.lit(None).cast("string"), 0.8, 0.5))
    e = t.select("tool_no", F.explode(F.array_compact(F.concat(one, tags))).alias("e")).select("tool_no", "e.*")
    e = e.withColumn("target", F.coalesce("target_id", F.lower("target_name")))
    return keep_first(e, ["source_id", "relationship", "target"], ["tool_no"]).select("source_id", "relationship", "target_name", "target_id", "confidence")
