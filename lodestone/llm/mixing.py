"""Mixing sources to target shares of a token budget, by nested hash thresholds.

Tokens are summed by source and hash bucket; the bucket in which a source's budget is spent is
found from that small histogram, by running sums in Spark, and only its documents are looked at
again with the next bits of the hash. The result is one 60-bit threshold per source, and the selection is a filter: no
sort, no sampling, the same rows at any number of partitions.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.session import cut, maybe_broadcast, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this public vocabulary parts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BITS, LEVELS = 12, 5


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("lodestone", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counter(path: str = TOKENIZER):
    """A pandas UDF that counts the tokens of a text; null counts 0."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(path).encode_ordinary
        return texts.map(lambda t: len(encode(t)) if t else 0)

    return count


def source_name(c: Column) -> Column:
    """One spelling of a source: lower case, words joined by underscores; blank becomes null."""
    return F.nullif(F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " ")), " ", "_"), F.lit(""))


def _digit(h: Column, level: int) -> Column:
    return F.shiftright(h, 60 - BITS * (level + 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def plan(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, tokenizer: str = TOKENIZER, max_targets: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(mix, shares).

    mix: doc_id, source, tokens, copies (at least 1). shares: one row per target.

    Each source is to give ``target_share`` of the total (by default all tokens of the
    documents). Whole passes over a source are taken while they fit, at most ``max_repeats``;
    the rest of the budget is one more copy of the documents whose hash lies under the source's
    threshold. A source whose documents do not suffice even so is used ``max_repeats`` times in
    full and its shortfall is reported; one without documents gives nothing. Documents without
    a target, with a null id or without tokens are left out; rows that repeat a doc_id stay
    together. Targets are a dimension of at most ``max_targets`` rows; repeated targets of a
    source are added, a null share counts 0 and null max_repeats 1.
    """
    d = spread(documents.select("doc_id", source_name(F.col("source")).alias("source"), "text"))
    d = d.select("doc_id", "source", token_counter(tokenizer)("text").alias("tokens"), F.xxhash64(F.lit(17), "doc_id").bitwiseAND(F.lit((1 << 60) - 1)).alias("h"))
    d = cut(d.where("doc_id is not null and tokens > 0"))
    sums = d.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    wanted = targets.select(source_name(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("reps"))
    wanted = wanted.where("source is not null").groupBy("source").agg(F.sum("share").alias("share"), F.max("reps").alias("reps"))
    total = total_tokens if total_tokens is not None else d.agg(F.sum("tokens")).first()[0] or 0
    if (named := wanted.count()) > max_targets:
        raise ValueError(f"the table of targets has more than {max_targets} rows; it is meant to be a small dimension")
    need = F.col("share") * F.lit(float(total))
    state = wanted.join(sums, "source").withColumn("whole", F.least(F.floor(need / F.col("tokens")), F.col("reps")).cast("int"))
    state = state.withColumn("rest", F.when(F.col("whole") < F.col("reps"), need - F.col("whole") * F.col("tokens")).otherwise(0.0))
    state = cut(state.select("source", "whole", "rest", F.lit(0).cast("bigint").alias("threshold"), (F.col("rest") > 0).alias("open")))
    # Refine the boundary bucket of each source, level by level; the table of states has one row per target.
    for level in range(LEVELS):
        live = state.where("open").select("source", "rest", "threshold")
        prefix = F.shiftright("h", 60 - BITS * level) if level else F.lit(0).cast("bigint")
        part = d.join(maybe_broadcast(live, named, max_targets), "source").where(prefix == F.col("threshold"))
        histogram = part.groupBy("source", "rest", _digit(F.col("h"), level).alias("b")).agg(F.sum("tokens").alias("n"))
        running = histogram.withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("b")))
        over = F.col("upto") > F.col("rest")
        edge = running.groupBy("source").agg(F.min(F.when(over, F.struct("b", "n"))).alias("edge"), F.coalesce(F.max(F.when(~over, F.col("upto"))), F.lit(0)).alias("taken"))
        state = state.join(edge, "source", "left")
        rest = F.when(F.col("open"), F.col("rest") - F.col("taken")).otherwise(F.col("rest"))
        at = F.shiftleft("threshold", BITS)
        fits = F.col("edge").isNull()  # the whole bucket fits
        if level == LEVELS - 1:  # one document (or copies of one id) is left: take it if that comes closer
            closer = (F.col("edge.n") < 2 * (F.col("rest") - F.col("taken"))).cast("bigint")
            new = F.when(fits, at + (1 << BITS)).otherwise(at + F.col("edge.b") + closer)
            still = F.lit(False)
        else:
            new = F.when(fits, F.shiftleft(at + (1 << BITS), BITS * (LEVELS - 1 - level))).otherwise(at + F.col("edge.b"))
            still = F.col("open") & ~fits
        state = cut(state.select("source", "whole", rest.alias("rest"), F.when(F.col("open"), new).otherwise(F.col("threshold")).alias("threshold"), still.alias("open")))
    kept = state.where("whole > 0 or threshold > 0").select("source", "whole", "threshold")
    copies = F.col("whole") + (F.col("h") < F.col("threshold")).cast("int")
    mix = d.join(maybe_broadcast(kept, named, max_targets), "source").withColumn("copies", copies.cast("int")).where("copies > 0").select("doc_id", "source", "tokens", "copies")
    used = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_used"), F.max("copies").alias("most_copies"))
    shares = wanted.join(sums, "source", "left").join(used, "source", "left").na.fill(0, ["tokens", "docs", "tokens_used", "most_copies"])
    shares = shares.select(
        "source",
        F.col("share").alias("target_share"),
        F.col("reps").alias("max_repeats"),
        "docs",
        F.col("tokens").alias("tokens_available"),
        "tokens_used",
        "most_copies",
        F.try_divide(F.col("tokens_used").cast("double"), F.lit(float(total))).alias("share_reached"),
        (F.col("tokens") * F.col("reps") < F.col("share") * total).alias("falls_short"),
    )
    return mix, shares
