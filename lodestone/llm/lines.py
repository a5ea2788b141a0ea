"""The lines of stored pages and how they recur: on how many addresses and hosts, and beside what.

A line is known by the hash of its normalised text: lower case, the page's own host as a mark,
words with digits as one, no bullets. Only hashes and numbers are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import weburls
from lodestone.session import cut

#: A line recurs when it stands on at least so many hosts.
HOSTS = 3
#: A line is hot with more than one row in so many, of which there can't be more than HOT.
HOT = 1000
#: Words from which on a line that ends like a sentence is prose.
PROSE = 6


def normalised(line: Column, host: Column) -> Column:
    """A line without what differs between pages of one layout."""
    x = F.lower(line)
    x = F.when((F.length(host) > 3) & F.contains(x, host), F.replace(x, host, F.lit("<h>"))).otherwise(x)
    x = F.regexp_replace(x, "[0-9]++(?:[.,:-][0-9]++)*+", "0")
    x = F.when(x.rlike("0[a-z]|[a-z]0"), F.regexp_replace(x, "\\b[a-z0]*0[a-z0]*", "0")).otherwise(x)
    x = F.when(x.rlike("[\\s\\x{a0}]{2}|\\x{a0}"), F.regexp_replace(x, "[\\s\\x{a0}]++", " ")).otherwise(x)
    return F.ltrim(F.rtrim(x), F.lit(" •›*✓»·–-"))


def is_prose(line: Column) -> Column:
    """Whether a line reads as a sentence."""
    return line.rlike(f"^\\s*+(?:\\S++\\s++){{{PROSE - 1}}}\\S.*[.!?…][\\s\"'”)]*$")


def of_pages(pages: DataFrame, ident: str, *flags: tuple[str, Column]) -> DataFrame:
    """(ident, host, address, place, key, prose, *flags): one row per line that is not blank.

    ``pages`` has ident, url, final_url and text; null texts have no lines. ``flags`` are named
    expressions over the column ``line``.
    """
    p = pages.where(F.col("text").isNotNull()).select(ident, weburls.parts(F.col("final_url")).alias("_f"), weburls.parts(F.col("url")).alias("_u"), "text")
    host = F.coalesce("_f.host", "_u.host", F.lit(""))
    address = F.xxhash64(F.coalesce("_f.page", "_u.page", F.lit("")))
    p = p.select(ident, host.alias("host"), address.alias("address"), F.posexplode(F.split("text", "\r\n?|\n")).alias("place", "line"))
    p = p.where(F.col("line").rlike("[^\\s\\x{a0}]"))
    return p.select(ident, F.xxhash64("host").alias("host"), "address", "place", F.xxhash64(normalised(F.col("line"), F.col("host"))).alias("key"), is_prose(F.col("line")).alias("prose"), *[c.alias(n) for n, c in flags])


def recurrence(lines: DataFrame, *sums: tuple[str, Column]) -> DataFrame:
    """(key, hosts, addresses, *sums): on how many hosts and addresses each line stands.

    Counted in two steps, by line and host and then by line, so that a line that a third of all
    pages have meets at most one partial row per host; ``sums`` are boolean expressions that are
    counted by address on the way.
    """
    once = lines.groupBy("key", "host", "address").agg(*[F.max(c).cast("long").alias(n) for n, c in sums]) if sums else lines.select("key", "host", "address").distinct()
    by_host = once.groupBy("key", "host").agg(F.count("*").alias("addresses"), *[F.sum(n).alias(n) for n, _ in sums])
    return by_host.groupBy("key").agg(F.count("*").alias("hosts"), F.sum("addresses").alias("addresses"), *[F.sum(n).alias(n) for n, _ in sums])


def with_counts(lines: DataFrame, counts: DataFrame, rows: int) -> DataFrame:
    """``lines`` (of so many ``rows``) with the columns of ``counts`` (key, addresses, ...), null where a line has none.

    The counts of hot lines, at most ``HOT`` by their share, are broadcast; only the other lines
    are shuffled by key, so no task gets a line that a third of all pages have.
    """
    counts = cut(counts)
    is_hot = F.col("addresses") * HOT > rows
    hot = F.broadcast(counts.where(is_hot))
    rest = lines.join(hot.select("key"), "key", "left_anti").join(counts.where(~is_hot), "key", "left")
    return lines.join(hot, "key").unionByName(rest)
