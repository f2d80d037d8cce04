"""The hierarchy operator against a plain walk, with cycles, hot groups and deep chains."""

import random

import pytest

from claimspark.operators import hierarchy

LINKS = "source_id string, child string, parent string, stated bigint"


def walk(links):
    up = {(s, c): p for s, c, p in links}
    nodes = {(s, x) for s, c, p in links for x in (c, p)}
    out = {}
    for s, n in nodes:
        seen, at = [], n
        while True:
            if at in seen:
                out[(s, n)] = (min(seen[seen.index(at) :]), -1)
                break
            seen.append(at)
            if (s, at) not in up:
                out[(s, n)] = (at, len(seen) - 1)
                break
            at = up[(s, at)]
    return out


@pytest.mark.parametrize("fragment_rows", [100_000, 25])
def test_random_forests(spark, fragment_rows):
    rng = random.Random(7)
    links = []
    for s in ("hot", "a", "b"):
        n = 160 if s == "hot" else 12
        for i in range(1, n):
            links.append((s, f"n{i:03d}", f"n{rng.randrange(i):03d}" if rng.random() < 0.7 else f"n{i - 1:03d}"))
    links += [("hot", "c1", "c2"), ("hot", "c2", "c3"), ("hot", "c3", "c1"), ("hot", "below", "c2"), ("a", "z1", "z2"), ("a", "z2", "z1")]
    df = spark.createDataFrame([(*x, 1) for x in links], LINKS).repartition(3)
    rows = hierarchy.forest(df, fragment_rows=fragment_rows).collect()
    assert {(r.source_id, r.node): (r.root_node, r.depth) for r in rows} == walk(links)
    for r in rows:
        if r.depth >= 0:
            assert r.path[0] == r.root_node and r.path[-1] == r.node and len(r.path) == r.depth + 1
        else:
            assert r.path is None
    bare = hierarchy.forest(df, fragment_rows=fragment_rows, paths=False).collect()
    assert {(r.source_id, r.node): (r.root_node, r.depth) for r in bare} == walk(links) and all(r.path is None and r.cycle_members is None for r in bare)
    rings = {frozenset(r.cycle_members) for r in rows if r.cycle_members}
    assert rings == {frozenset({"c1", "c2", "c3"}), frozenset({"z1", "z2"})}


def test_chain_across_fragments(spark):
    n = 150
    df = spark.createDataFrame([("s", f"n{i:03d}", f"n{i - 1:03d}", 1) for i in range(1, n)], LINKS)
    depth = {r.node: r.depth for r in hierarchy.forest(df, fragment_rows=20).collect()}
    assert depth == {f"n{i:03d}": i for i in range(n)}


def test_deep_chain_is_linear_without_paths():
    """One task's contraction of a chain keeps numbers, not paths."""
    import tracemalloc

    import pandas as pd

    def peak(n):
        rows = pd.DataFrame({"grp": "s", "node": [f"n{i:06d}" for i in range(n)], "parent": [None] + [f"n{i:06d}" for i in range(n - 1)], "steps": 1, "least": [f"n{i:06d}" for i in range(n)], "frag": None})
        tracemalloc.start()
        depths = [d for pdf in hierarchy._contract(iter([rows])) for d in pdf["depth"]]
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sorted(depths) == list(range(n))
        return top

    assert peak(20_000) < 3 * peak(10_000)


def test_many_hot_groups_are_joined(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "MOST_HOT", 0)
    links = [(s, f"n{i:02d}", f"n{i // 2:02d}") for s in "abc" for i in range(1, 40)]
    rows = hierarchy.forest(spark.createDataFrame([(*x, 1) for x in links], LINKS), fragment_rows=10).collect()
    assert {(r.source_id, r.node): (r.root_node, r.depth) for r in rows} == walk(links)


def test_nulls_ties_and_empty(spark):
    rows = [("s", "a", "p2", 1), ("s", "a", "p1", 1), ("s", "a", None, 1), ("s", None, "a", 1), (None, "x", "y", 1), ("s", "a", "a", 9), ("s", "a", "p3", 2)]
    got = {r.node: r for r in hierarchy.forest(spark.createDataFrame(rows, LINKS)).collect()}
    assert got["a"].parent == "p3" and got["a"].n_parents == 3 and set(got) == {"a", "p1", "p2", "p3"}
    assert hierarchy.forest(spark.createDataFrame([], LINKS)).count() == 0


def test_links_from_either_end(spark):
    schema = "source_id string, label string, broader_labels array<string>, narrower_labels array<string>, extra int"
    rows = [("s", "Big Cat", ["  CAT "], None, 1), ("s", "cat", None, ["big-cat", "Cat"], 2), ("s", None, ["cat"], [], 3), ("s", "", ["cat"], None, 4), ("s", "x", [None, " "], None, 5)]
    links = hierarchy.label_links(spark.createDataFrame(rows, schema)).collect()
    assert [(r.child, r.parent, r.stated) for r in links] == [("big cat", "cat", 2)]
    tree = hierarchy.forest(hierarchy.label_links(spark.createDataFrame(rows, schema)))
    assert [(r.ancestor, r.descendant, r.distance) for r in hierarchy.descendants(tree).collect()] == [("cat", "big cat", 1)]
