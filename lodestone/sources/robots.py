"""robots.txt as tables: rules from texts, decisions for addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.text import once

_STATE = "struct<agents:array<string>,ruled:boolean,rules:array<struct<agent:string,allow:boolean,pattern:string>>>"


def rules(texts: DataFrame) -> DataFrame:
    """(origin, agent, allow, pattern) of robots files (origin, body).

    Consecutive user-agent lines share the rules after them; only a user-agent line after a rule
    opens a new group. Comments, blank lines, other fields and empty values are without effect.
    """
    lines = F.transform(F.split(F.coalesce("body", F.lit("")), "\\r\\n|\\n|\\r"), lambda x: F.trim(F.regexp_replace(x, "#.*$", "")))
    fields = F.transform(F.filter(lines, lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("f"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    empty = F.from_json(F.lit('{"agents":[],"ruled":false,"rules":[]}'), _STATE)

    def step(s: Column, x: Column) -> Column:
        agents, found = s["agents"], s["rules"]
        agent = x["f"] == "user-agent"
        rule = x["f"].isin("allow", "disallow") & (F.size(agents) > 0)
        name = F.when(x["v"] != "", F.array(F.lower(x["v"]))).otherwise(F.array().cast("array<string>"))
        added = F.transform(agents, lambda a: F.struct(a.alias("agent"), (x["f"] == "allow").alias("allow"), F.coalesce(F.try_url_decode(F.regexp_replace(x["v"], "\\+", "%2B")), x["v"]).alias("pattern")))
        return F.struct(
            F.when(agent, F.when(s["ruled"], name).otherwise(F.concat(agents, name))).otherwise(agents).alias("agents"),
            F.when(agent, F.lit(False)).otherwise(s["ruled"] | rule).alias("ruled"),
            F.when(rule & (x["v"] != ""), F.concat(found, added)).otherwise(found).alias("rules"),
        ).cast(_STATE)

    made = F.aggregate(fields, empty, step, lambda s: s["rules"])
    return texts.select("origin", F.explode(made).alias("r")).select("origin", "r.*")


def _regex(pattern: Column) -> Column:
    body = F.regexp_replace(pattern, "\\$$", "")
    parts = F.transform(F.split(body, "\\*"), lambda x: F.concat(F.lit("\\Q"), F.replace(x, F.lit("\\E"), F.lit("")), F.lit("\\E")))
    return F.concat(F.lit("^"), F.array_join(parts, ".*"), F.when(pattern.endswith("$"), F.lit("$")).otherwise(F.lit("")))


def can_fetch(addresses: DataFrame, rule_table: DataFrame, user_agent: str) -> DataFrame:
    """(url, allowed) for addresses (url, origin).

    The most specific group that names the agent counts, else the one for all; in it the longest
    matching pattern decides, an allowing one on a tie. No rule forbids nothing.
    """
    token = user_agent.split("/")[0].strip().lower()
    named = rule_table.where((F.col("agent") != "*") & F.contains(F.lit(token), F.col("agent")))
    best = named.groupBy("origin").agg(F.max_by("agent", F.length("agent")).alias("best"))
    mine = rule_table.join(best, "origin", "left").where(F.col("agent") == F.coalesce("best", F.lit("*")))
    path = once(F.regexp_extract("url", r"^[^:]+://[^/?#]*([^#]*)", 1), lambda x: F.when(x.startswith("/"), x).otherwise(F.concat(F.lit("/"), x)))
    a = addresses.select("url", "origin", F.coalesce(F.try_url_decode(F.regexp_replace(path, "\\+", "%2B")), path).alias("path"))
    hit = a.join(mine, "origin", "left")
    hit = hit.withColumn("regex", _regex(F.col("pattern"))).withColumn("match", F.coalesce(F.expr("regexp_like(path, regex)"), F.lit(False)))
    choice = F.max(F.when(F.col("match"), F.struct(F.length("pattern").alias("n"), "allow")))
    return hit.groupBy("url").agg(choice.alias("c")).select("url", F.coalesce("c.allow", F.lit(True)).alias("allowed"))
