"""Queries of the hierarchy operator and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators import hierarchy
from claimspark.runtime import load


def _tree(spark: SparkSession, d: str, paths: bool = True) -> DataFrame:
    return hierarchy.forest(hierarchy.label_links(load(spark, d, "draft_terms")), paths=paths)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d, paths=False).select("source_id", "node", "root_node", "depth")


def p7_paths(spark: SparkSession, d: str) -> DataFrame:
    tree = hierarchy.cut(_tree(spark, d))
    counts = hierarchy.descendant_counts(tree)
    zero = F.lit(0)
    return tree.join(counts, ["source_id", "node"], "left").select(
        "source_id", "node", "root_node", "depth", F.array_join("path", " > ").alias("path"), F.coalesce("n_descendants", zero.cast("bigint")).alias("n_descendants"), F.coalesce("height", zero).alias("height")
    )


def p7_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(_tree(spark, d))


def p7_cycles(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).where(F.col("cycle_members").isNotNull()).select("source_id", "root_node", F.explode("cycle_members").alias("member")).distinct()


def queries():
    return {f.__name__: f for f in (p7_found, p7_paths, p7_descendants, p7_cycles)}


_LINKS = r"""
norm as (select source_id, trim(regexp_replace(lower(label), '[^\p{L}\p{N}_]+', ' ', 'g')) own, broader_labels, narrower_labels from draft_terms),
stated as (
  select source_id, own child, trim(regexp_replace(lower(u.x), '[^\p{L}\p{N}_]+', ' ', 'g')) parent from norm, unnest(broader_labels) u(x)
  union all
  select source_id, trim(regexp_replace(lower(u.x), '[^\p{L}\p{N}_]+', ' ', 'g')), own from norm, unnest(narrower_labels) u(x)
),
counted as (select source_id, child, parent, count(*) n from stated where source_id is not null and child <> '' and parent <> '' and child <> parent group by all),
parents as (select source_id, child, parent from counted qualify row_number() over (partition by source_id, child order by n desc, parent) = 1),
nodes as (select source_id, child node from counted union select source_id, parent from counted)
"""
_UP = r"""
, up as (
  select source_id, node, node pos, 0 hops, [node] path from nodes
  union all
  select u.source_id, u.node, p.parent, u.hops + 1, list_prepend(p.parent, u.path)
  from up u join parents p on p.source_id = u.source_id and p.child = u.pos where not list_contains(u.path, p.parent)
),
last as (select * from up qualify row_number() over (partition by source_id, node order by hops desc) = 1),
closed as (
  -- the last node of a walk that has a parent goes back into the walk: a cycle from that parent on
  select l.*, p.parent back from last l left join parents p on p.source_id = l.source_id and p.child = l.pos
)
"""
_FOUND = "with recursive " + _LINKS + _UP + """
select source_id, node, case when back is null then pos else list_min(path[1:list_position(path, back)]) end root_node,
  case when back is null then hops else -1 end::int depth from closed
"""
_DESCENDANTS = "with recursive " + _LINKS + _UP + """
select c.source_id, u.pos ancestor, c.node descendant, u.hops::int distance from closed c join up u on u.source_id = c.source_id and u.node = c.node
where c.back is null and u.hops > 0
"""


def oracle_sql():
    return {
        "p7_found": _FOUND,
        "p7_descendants": _DESCENDANTS,
        "p7_paths": "with recursive " + _LINKS + _UP + """,
tree as (select source_id, node, case when back is null then pos else list_min(path[1:list_position(path, back)]) end root_node,
  case when back is null then hops else -1 end::int depth, case when back is null then array_to_string(path, ' > ') end path from closed),
below as (select c.source_id, u.pos node, count(*) n_descendants, max(u.hops)::int height from closed c join up u on u.source_id = c.source_id and u.node = c.node
  where c.back is null and u.hops > 0 group by all)
select t.*, coalesce(n_descendants, 0) n_descendants, coalesce(height, 0) height from tree t left join below using (source_id, node)
""",
        "p7_cycles": "with recursive " + _LINKS + _UP + """
select distinct source_id, list_min(ring) root_node, unnest(ring) member from (select source_id, path[1:list_position(path, back)] ring from closed where back is not null)
""",
    }
