"""Consolidating pairwise matches into groups.

Method: alternate *large-star* and *small-star* edge rewrites, each a
distributed join, until the edges no longer change; every record then points
to the smallest identifier of its component.

A large-star joins every node's larger neighbours to the smallest node of the
neighbourhood, a small-star its smaller ones.  The neighbourhood is never
gathered: its minimum comes from a partially aggregated ``min`` and is joined
back to the edges.  The edges of hubs (nodes with more than 1 / HUB_SHARE of all
edges, so at most HUB_SHARE of them) stay where they are and get the minimum by
a broadcast; no task receives a hub's edges.

Defined results: a null or blank side links nothing; a pair of equal keys and
repeated pairs add nothing; an empty table gives no rows; keys compare by code
points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.runtime import cut

#: A key with more than 1 / HUB_SHARE of all edges is a hub, so there are at most HUB_SHARE of them.
HUB_SHARE = 16_384
#: Fewer edges than this are never a hub's.
LEAST_HUB = 100_000


_OUTER = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def _bare(c):
    return F.regexp_replace(c, _OUTER, "")


def _key(c: str):
    k = _bare(F.col(c))
    return F.when(k != "", k)


def decision_links(decisions: DataFrame) -> DataFrame:
    """(a, b) of the decisions that merge; keys and decisions without outer spaces, decisions in any case."""
    return decisions.where(F.lower(_bare(F.col("decision"))) == "merge").select(_key("left_key").alias("a"), _key("right_key").alias("b"))


def cluster_links(clusters: DataFrame) -> DataFrame:
    """(a, b): each key of a cluster with the cluster's smallest key; a star, not all pairs."""
    keys = F.filter(F.transform("occurrence_keys", _bare), lambda x: x.isNotNull() & (x != ""))
    return clusters.select(keys.alias("keys")).where(F.size("keys") > 1).select(F.array_min("keys").alias("a"), F.explode("keys").alias("b"))


def _to_minimum(edges: DataFrame, n: int) -> DataFrame:
    """edges (u, v) -> (u, v, m): m is the smallest of u and all v of u.

    A hub's minimum goes to its edges by a broadcast of the hubs, which are at
    most n / (n / HUB_SHARE) = HUB_SHARE keys; every other key's edges, at most
    n / HUB_SHARE of them, meet their minimum in a join on the key.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("d")).select("u", F.least("u", "m").alias("m"), "d")
    most = max(n // HUB_SHARE, LEAST_HUB)
    if n <= most:
        return edges.join(least.select("u", "m"), "u")
    hubs = F.broadcast(least.where(F.col("d") > most).select("u", F.col("m").alias("hub_m")))
    marked = edges.join(hubs, "u", "left")
    at_hubs = marked.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m"))
    return at_hubs.unionByName(marked.where("hub_m is null").select("u", "v").join(least.select("u", "m"), "u"))


def _state(edges: DataFrame) -> tuple[int, object]:
    """Row count and an order-free fingerprint of the edges; two numbers, whatever the size."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_minimum(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _to_minimum(down, n)
    return starred.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node with at least one other node, and the smallest node it is linked to."""
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        n = before[0]
        edges = cut(small_star(cut(large_star(edges, n)), n))
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def occurrence_groups(decisions: DataFrame, clusters: DataFrame) -> DataFrame:
    """(occurrence_key, group_key) of the keys that decisions and clusters link."""
    links = decision_links(decisions).unionByName(cluster_links(clusters))
    return connected_components(links).select(F.col("node").alias("occurrence_key"), F.col("component").alias("group_key"))
