"""Groups from pairwise links: union-find within partitions, forests merged hierarchically.

Each task runs union-find over its part of the edges and keeps only a spanning forest (one edge
``root - node`` for each node that is no root). Forests are then merged level by level in bounded
partitions: before each level a share of the nodes is contracted into neighbours and kept aside
with its parent, so the forest shrinks whatever the graph, until one bounded task holds what is
left; then the nodes kept aside get the component of their parents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut

EDGE = "src bigint, dst bigint"


def spanning_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over all edges of a partition; gives the edges root - node, root the smallest id."""
    place: dict[int, int] = {}
    parent: list[int] = []
    smallest: list[int] = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def node(v: int) -> int:
        k = place.get(v)
        if k is None:
            k = place[v] = len(parent)
            parent.append(k)
            smallest.append(v)
        return k

    for b in batches:
        for u, v in zip(b["src"].tolist(), b["dst"].tolist()):
            x, y = find(node(u)), find(node(v))
            if x != y:
                if smallest[y] < smallest[x]:
                    x, y = y, x
                parent[y] = x
    ids = np.fromiter(place, dtype="int64", count=len(place))
    roots = np.fromiter((smallest[find(k)] for k in range(len(parent))), dtype="int64", count=len(parent))
    keep = ids != roots
    for at in range(0, len(ids), 200_000):
        part = slice(at, at + 200_000)
        yield pd.DataFrame({"src": roots[part][keep[part]], "dst": ids[part][keep[part]]})


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _contracted(forest: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
    """(parents, edges): about a third of the nodes merged into a neighbour, and the edges that remain.

    A hash of node and step makes every node a head or a tail; a tail with a head beside it is
    merged into the smallest such head. Parents are heads and so never merged themselves in the
    same step: no chains arise, whatever the graph.
    """
    is_head = lambda c: F.xxhash64(F.col(c), F.lit(step)).bitwiseAND(F.lit(1)) == 1
    parents = cut(_both_ways(forest).where(is_head("dst") & ~is_head("src")).groupBy("src").agg(F.min("dst").alias("parent")).select(F.col("src").alias("child"), "parent"))
    moved = forest.join(parents, F.col("src") == F.col("child"), "left").select(F.coalesce("parent", "src").alias("src"), "dst")
    moved = moved.join(parents, F.col("dst") == F.col("child"), "left").select("src", F.coalesce("parent", "dst").alias("dst"))
    return parents, moved.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_edges: int = 1_000_000) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node id of its group.

    While the forest has more than ``max_edges`` edges, it is merged in bounded partitions and
    contracted; then one task of at most so many edges finds the components of what is left, and
    the merged nodes follow their parents. Null ends and self links are no links: rows with a null
    end are dropped, a node that only links to itself does not appear. Repeated and turned links
    change nothing. An empty input gives an empty result.
    """
    e = edges.select(F.col(left).cast("bigint").alias("src"), F.col(right).cast("bigint").alias("dst"))
    e = e.where("src is not null and dst is not null and src <> dst")
    forest = cut(e.mapInPandas(spanning_forest, EDGE))
    count, merges = forest.count(), []
    while count > max_edges:
        parents, rest = _contracted(forest, len(merges))
        merges.append(parents)
        tasks = -(-count // max_edges)
        forest = cut(rest.repartition(tasks, "src").mapInPandas(spanning_forest, EDGE))
        count = forest.count()
    forest = cut(forest.repartition(1).mapInPandas(spanning_forest, EDGE))
    found = forest.select(F.col("src").alias("node"), F.col("src").alias("component")).distinct().union(forest.select(F.col("dst").alias("node"), F.col("src").alias("component")))
    if not merges:
        return found
    for parents in reversed(merges):
        heads = parents.select(F.col("parent").alias("node")).distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
        found = found.union(heads)
        children = parents.join(found, F.col("parent") == F.col("node")).select(F.col("child").alias("node"), "component")
        found = cut(found.union(children))
    least = found.groupBy("component").agg(F.min("node").alias("least"))
    return found.join(least, "component").select("node", F.col("least").alias("component"))


# Tiers that prove a merge, by their plain words.
MERGING_TIERS = "^(match ?tier )?((identical id)|(tier )?(a canonical url|b product identity|c explicit alias|d strong combination))$"
_NOTHING = "^(|-+|n a|none|null|nan|nil|unknown)$"


def _words(col) -> "F.Column":
    """Lower-case words of a code, however it is spelled: camel case, quotes, dots, dashes."""
    spaced = F.regexp_replace(col, "([a-z])([A-Z])", "$1 $2")
    return F.trim(F.regexp_replace(F.lower(spaced), "[^a-z0-9]+", " "))


def merge_links(matches: DataFrame) -> DataFrame:
    """The rows of a match table that link their two ends, as (src, dst).

    A row links if its decision means merge, or if the decision is missing (null, blank or the
    word null) and its tier proves a merge. A merge with neither a merging tier nor any evidence
    is no link; blank evidence and dashes or words for nothing count as none.
    """
    m = matches.select(
        F.col("left_id").alias("src"),
        F.col("right_id").alias("dst"),
        F.coalesce(F.regexp_replace(_words(F.col("decision")), "^match decision ", ""), F.lit("")).alias("decision"),
        F.coalesce(_words(F.col("tier")).rlike(MERGING_TIERS), F.lit(False)).alias("proven"),
        (~F.coalesce(F.trim(F.regexp_replace(F.lower("evidence"), "[^\\p{L}\\p{N}]+", " ")), F.lit("")).rlike(_NOTHING)).alias("evident"),
    )
    merge = F.col("decision").rlike(r"\b(merge[ds]?|merging|same|duplicate)\b") & ~F.col("decision").rlike(r"\b(no|not|non|never|un|veto|vetoed|dont|don t|without|reject|rejected|unmerged)\b")
    missing = F.col("decision").isin("", "null")
    return m.where((merge & (F.col("proven") | F.col("evident"))) | (missing & F.col("proven"))).select("src", "dst")


def grouped_tools(matches: DataFrame, max_edges: int = 1_000_000) -> DataFrame:
    """(tool_no, group_no) of every tool with a link; see ``merge_links`` for what links."""
    c = connected_components(merge_links(matches), max_edges=max_edges)
    return c.select(F.col("node").alias("tool_no"), F.col("component").alias("group_no"))
