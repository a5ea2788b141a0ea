import random

import pytest

from lodestone.llm import components as C

SCHEMA = "pair_no bigint, left_id bigint, right_id bigint, decision string, tier string, evidence string, src string, node int"


def brute(edges):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        for v in (a, b):
            parent.setdefault(v, v)
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


@pytest.mark.parametrize("max_edges", [1_000_000, 40, 3])
def test_groups_equal_brute_force(spark, max_edges):
    rng = random.Random(3)
    edges = [(rng.randint(1, 260), rng.randint(1, 260)) for _ in range(170)] + [(1, k) for k in range(300, 360)] + [(k, k + 1) for k in range(500, 560)]
    edges += [(None, 3), (4, None), (7, 7)] + edges[:20] + [(b, a) for a, b in edges[:20]]
    df = spark.createDataFrame(edges, "src bigint, dst bigint").repartition(5)
    got = {r["node"]: r["component"] for r in C.connected_components(df, max_edges=max_edges).collect()}
    assert got == brute(edges)


def test_what_links(spark):
    rows = [
        (1, 1, 2, "merge", "identical_id", None), (2, 3, 2, "MatchDecision.MERGE", None, "alias of x"), (3, 5, 6, '"merge"', "no_matching_evidence", " - "), (4, 7, 8, None, "MatchTier.A_CANONICAL_URL", None),
        (5, 9, 10, "null", "tier-d-strong-combination", ""), (6, 11, 12, " ", "tier_e_review", "x"), (7, 13, 14, "no_merge", "identical_id", "x"), (8, 15, 16, "merge vetoed", "identical_id", "x"),
        (9, 17, 18, "auto-merge", "tier b product identity", "n/a"), (10, 19, 20, "review", "identical_id", "x"), (11, 21, 22, "do not merge", "tier_c_explicit_alias", "x"), (12, None, 1, "merge", "identical_id", "x"),
    ]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA)
    got = {tuple(r) for r in C.grouped_tools(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9), (10, 9), (17, 17), (18, 17)}


def test_empty(spark):
    assert C.grouped_tools(spark.createDataFrame([], SCHEMA)).count() == 0
