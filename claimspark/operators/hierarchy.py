"""Parent-child links to full hierarchies.

Method: every partition contracts its own parent chains to *fragment exits*
(the first ancestor that lives elsewhere); the exits form a smaller quotient
forest, which is solved by the same operator; then the fragments are expanded
with the paths of their exits.  Cycles show up either inside one partition
(local) or as a cycle of the quotient (global).

Partitions are keyed by the forest's group (one source), split into buckets
where a group is hot, so the first contraction is almost complete.  A quotient
keeps only nodes to which some other partition points; its nodes are placed by
random mates (a "tail" node moves to the partition of its "head" parent), so
each level shortens every chain by a constant factor whatever the layout.

Defined results: null or blank labels make no link; a link of a node to itself
is ignored; repeated links count once; a node with several parents follows the
one stated most often (the smallest among equals); ``n_parents`` counts all of
them, whose links stay in the table of links; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions.columns import normalize_label
from claimspark.runtime import cut, parallelism

#: Rows that one task may contract: a quotient of at most so many rows is solved in one task.
FRAGMENT_ROWS = 100_000

#: Hot groups that are passed to all tasks at most; more of them are joined.
MOST_HOT = 100_000

_STATE = "grp string, node string, exit string, root string, depth bigint, steps bigint, least string, frag array<string>, members array<string>"


def label_links(terms: DataFrame) -> DataFrame:
    """(source_id, child, parent, stated) from broader_labels and narrower_labels, either end."""
    own = normalize_label("label")
    other = normalize_label("other")
    up = terms.select("source_id", own.alias("child"), F.explode("broader_labels").alias("other")).select("source_id", "child", other.alias("parent"))
    down = terms.select("source_id", own.alias("parent"), F.explode("narrower_labels").alias("other")).select("source_id", other.alias("child"), "parent")
    return (
        up.unionByName(down)
        .where("source_id is not null and child <> '' and parent <> '' and child <> parent")
        .groupBy("source_id", "child", "parent")
        .agg(F.count("*").alias("stated"))
    )


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follow parents inside the partition; one row per node with its exit, root or cycle.

    What is kept for a node is a few numbers; its path, where paths are asked
    for, is put together from the fragments only when its row is written.
    """
    up: dict[tuple[str, str], tuple[str | None, int, str, list[str] | None]] = {}
    for pdf in batches:
        for g, n, p, k, least, f in zip(pdf["grp"], pdf["node"], pdf["parent"], pdf["steps"], pdf["least"], pdf["frag"]):
            up[(g, n)] = (p, int(k), least, None if f is None else list(f))
    # key -> (exit, root, depth, smallest label of the chain); exit None where solved, depth -1 on or below a cycle
    done: dict[tuple[str, str], tuple[str | None, str | None, int, str]] = {}
    members: dict[tuple[str, str], list[str]] = {}
    for start in up:
        walk: list[tuple[str, str]] = []
        place: dict[tuple[str, str], int] = {}
        at = start
        while at not in done and at in up and at not in place:
            place[at] = len(walk)
            walk.append(at)
            parent = up[at][0]
            if parent is None:
                break
            at = (at[0], parent)
        if walk and up[walk[-1]][0] is None and walk[-1] not in done:
            last = walk.pop()
            done[last] = (None, last[1], 0, up[last][2])
        elif at in place and at not in done:
            ring = walk[place[at] :]
            root = min(up[k][2] for k in ring)
            for k in ring:
                done[k] = (None, root, -1, root)
            if all(up[k][3] is not None for k in ring):
                members[min(ring)] = [x for k in ring for x in up[k][3]]
            walk = walk[: place[at]]
        for k in reversed(walk):
            parent, steps, least, _ = up[k]
            above = (k[0], parent)
            if above not in done:  # the parent lives in another partition
                done[k] = (parent, None, steps, least)
                continue
            exit_, root, depth, low = done[above]
            done[k] = (None, root, -1, root) if depth == -1 else (exit_, root, depth + steps, min(least, low) if exit_ is not None else least)

    def path(k: tuple[str, str]) -> list[str] | None:
        if up[k][3] is None or done[k][2] == -1:
            return None if up[k][3] is None else []
        out: list[str] = []
        while k in up:
            out += up[k][3]
            if up[k][0] is None:
                break
            k = (k[0], up[k][0])
        return out

    rows, labels = [], 0
    for (g, n), (e, r, d, low) in done.items():
        f = path((g, n))
        rows.append((g, n, e, r, d, d, low, f, members.get((g, n))))
        labels += 1 + len(f or ())
        if labels >= 100_000:
            yield pd.DataFrame(rows, columns=["grp", "node", "exit", "root", "depth", "steps", "least", "frag", "members"])
            rows, labels = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["grp", "node", "exit", "root", "depth", "steps", "least", "frag", "members"])


def _solve(nodes: DataFrame, level: int, fragment_rows: int) -> DataFrame:
    """nodes: (grp, node, parent, steps, least, frag), where frag runs from the node to just below its parent (a root's frag is itself).

    steps is its length and least its smallest label; frag is null where no paths are asked for.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    parts = max(-(-total // fragment_rows), 1)
    if level == 0:
        size = nodes.groupBy("grp").agg(F.count("*").alias("n"))
        hot = cut(size.where(F.col("n") > fragment_rows).select("grp", F.ceil(F.col("n") / fragment_rows).alias("splits")))
        # few groups are hot; should they be many, they are joined, and a large partition is split by AQE
        few = hot.count() <= MOST_HOT
        keyed = nodes.join(F.broadcast(hot) if few else hot, "grp", "left").withColumn("bucket", F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64("node"), F.col("splits"))).otherwise(F.lit(0).cast("bigint")))
        parts = max(parts, min(parallelism(spark), total // 2_000 + 1))
        placed = keyed.repartition(parts, "grp", "bucket")
    elif parts == 1:
        placed = nodes.repartition(1)
    else:
        head = lambda c: F.pmod(F.xxhash64("grp", c, F.lit(level)), F.lit(2)) == 1
        mate = F.when(F.col("parent").isNotNull() & ~head("node") & head("parent"), F.col("parent")).otherwise(F.col("node"))
        placed = nodes.withColumn("mate", mate).repartition(parts, "grp", "mate")
    state = cut(placed.select("grp", "node", "parent", "steps", "least", "frag").mapInPandas(_contract, _STATE))
    open_ = state.where(F.col("exit").isNotNull())
    if open_.isEmpty():
        return state.drop("exit", "steps", "least")
    targets = open_.select("grp", F.col("exit").alias("node")).distinct()
    quotient = (
        state.join(targets, ["grp", "node"], "left_semi")
        # a solved target is a root of the quotient that keeps its own path
        .select("grp", "node", F.col("exit").alias("parent"), "steps", "least", "frag", "root", "depth")
    )
    solved = quotient.where(F.col("parent").isNull()).select("grp", F.col("node").alias("exit"), F.col("root").alias("x_root"), F.col("depth").alias("x_depth"), F.col("frag").alias("x_frag"))
    pending = quotient.where(F.col("parent").isNotNull())
    if pending.isEmpty():
        above, rings = solved, None
    else:
        # targets that are solved already end their chains as roots of the quotient
        own = F.when(F.col("frag").isNotNull(), F.array("node")).alias("frag")
        nodes_q = pending.select("grp", "node", "parent", "steps", "least", "frag").unionByName(quotient.where(F.col("parent").isNull()).select("grp", "node", "parent", F.lit(1).cast("bigint").alias("steps"), F.col("node").alias("least"), own))
        deep = _solve(nodes_q, level + 1, fragment_rows)
        base = solved.select("grp", F.col("exit").alias("root"), "x_root", "x_depth", "x_frag")
        joined = deep.join(base, ["grp", "root"], "left")
        below_cycle = F.col("depth") == -1
        through = F.col("x_root").isNotNull() & ~below_cycle
        above = joined.select(
            "grp",
            F.col("node").alias("exit"),
            F.when(through, F.col("x_root")).otherwise(F.col("root")).alias("x_root"),
            F.when(below_cycle, F.lit(-1)).when(F.col("x_depth") == -1, F.lit(-1)).when(through, F.col("depth") + F.col("x_depth")).otherwise(F.col("depth")).cast("bigint").alias("x_depth"),
            # the quotient root's frag holds only itself: replace it by its own path
            F.when(below_cycle | (F.col("x_depth") == -1), F.array().cast("array<string>")).when(through, F.concat(F.slice("frag", 1, F.size("frag") - 1), "x_frag")).otherwise(F.col("frag")).alias("x_frag"),
        )
        rings = deep.where(F.col("members").isNotNull()).select("grp", "node", F.col("members").alias("ring"))
    lifted = open_.join(above, ["grp", "exit"]).select(
        "grp",
        "node",
        F.col("x_root").alias("root"),
        F.when(F.col("x_depth") == -1, F.lit(-1)).otherwise(F.col("depth") + F.col("x_depth")).cast("bigint").alias("depth"),
        F.when(F.col("x_depth") == -1, F.array().cast("array<string>")).otherwise(F.concat("frag", "x_frag")).alias("frag"),
        "members",
    )
    out = state.where(F.col("exit").isNull()).select("grp", "node", "root", "depth", "frag", "members").unionByName(lifted)
    if rings is not None:
        out = out.join(rings, ["grp", "node"], "left").withColumn("members", F.coalesce("members", "ring")).drop("ring")
    return cut(out)


def forest(links: DataFrame, group: str = "source_id", child: str = "child", parent: str = "parent", weight: str | None = "stated", fragment_rows: int = FRAGMENT_ROWS, paths: bool = True) -> DataFrame:
    """Full hierarchy of parent-child links.

    One row per node: (group, node, root, depth, path, parent, n_parents,
    cycle_members); path runs from the root to the node.  On or below a cycle depth
    is -1, path null and root the smallest node of the cycle; the cycle's
    members stand on one of its rows.  Without ``paths`` path and cycle_members
    are null: a node then costs a few numbers, however deep it is.
    """
    w = F.col(weight) if weight else F.lit(1)
    clean = links.where(F.col(group).isNotNull() & F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent)))
    ends = clean.select(F.col(group).alias("grp"), F.col(child).alias("node"), F.col(parent).alias("parent"), w.cast("bigint").alias("w")).unionByName(
        clean.select(F.col(group).alias("grp"), F.col(parent).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("w"))
    )
    counted = ends.groupBy("grp", "node", "parent").agg(F.sum("w").alias("w"))
    nodes = cut(
        counted.groupBy("grp", "node").agg(
            F.min_by("parent", F.when(F.col("parent").isNotNull(), F.struct(-F.col("w"), F.col("parent")))).alias("parent"),
            F.count("parent").alias("n_parents"),
        )
    )
    frag = F.array("node") if paths else F.lit(None).cast("array<string>")
    solved = _solve(nodes.select("grp", "node", "parent", F.lit(1).cast("bigint").alias("steps"), F.col("node").alias("least"), frag.alias("frag")), 0, fragment_rows)
    return solved.join(nodes, ["grp", "node"]).select(
        F.col("grp").alias(group),
        "node",
        F.col("root").alias("root_node"),
        F.col("depth").cast("int").alias("depth"),
        F.when(F.col("depth") >= 0, F.reverse("frag")).alias("path"),
        "parent",
        "n_parents",
        F.col("members").alias("cycle_members"),
    )


def descendants(tree: DataFrame, group: str = "source_id") -> DataFrame:
    """(group, ancestor, descendant, distance) for every pair on a path; one row per pair, never collected."""
    return (
        tree.where("depth > 0")
        .select(group, F.col("node").alias("descendant"), "depth", F.posexplode("path").alias("at", "ancestor"))
        .where("at < depth")
        .select(group, "ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
    )


def descendant_counts(tree: DataFrame, group: str = "source_id") -> DataFrame:
    """(group, node, n_descendants, height); counted from the exploded paths with partial aggregation."""
    d = descendants(tree, group)
    return d.groupBy(group, F.col("ancestor").alias("node")).agg(F.count("*").alias("n_descendants"), F.max("distance").alias("height"))
