"""Guarded entity resolution within each source.

1. Candidates.  Two names meet if they are equal, or if their Indel similarity
   reaches the threshold; blocks of names are compared as matrices, so that only
   pairs with enough letters in common are scored.  Names are compared once each,
   however often they occur.
2. Representatives.  Occurrences of a source with the same names, definition and
   kind are one representative, so copies are never compared with each other.
   Candidates reach their representatives as stars, which have the same
   components as all pairs would have.
3. Components of the candidate graph are independent of each other (the guards
   read only members of the two clusters to be joined); each is resolved in
   order by a fold over its pairs: exact and lexical matches merge unless a
   hierarchy link, analogy wording or different definitions forbid it between
   any two members.  Pairs from AMBIGUOUS up to the lexical threshold go to the
   adjudicator if there is one, else they stay apart as ambiguous.
4. Without an adjudicator such pairs merge nothing, so they connect no component
   either.  Their decisions are read from the clusters as these were at the
   pair's turn, by replaying the merges of the two clusters, and only where
   decisions are asked for; otherwise such pairs aren't even looked for.

Defined results: null and blank labels are occurrences without names and stay
alone; repeated rows count once; a hierarchy link between two names keeps their
terms apart, whichever end states it.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from claimspark.functions.columns import fold_label
from claimspark.functions.text import close_names, definitions_apart
from claimspark.operators.hierarchy import forest
from claimspark.runtime import cut, parallelism

LEXICAL, AMBIGUOUS = 90.0, 78.0
#: Names of one side of a comparison; a source of fewer is compared in one piece.
BLOCK, SMALL = 4096, 512
#: Candidate pairs that one task may join to components; a source of more is split.
EDGES = 200_000
ANALOGY = re.compile(r"\b(?:analog(?:y|ous)|metaphor|resembles|like but|compared with)\b")


def occurrences(terms: DataFrame) -> DataFrame:
    """(source_id, key, rep, names, label, definition, kind, confidence, ord) of distinct term rows."""
    rows = terms.where("source_id is not null and fragment_index is not null and term_index is not null").select("source_id", "fragment_index", "term_index", "label", "aliases", "definition", "kind", "confidence")
    # a position that stands in several rows (copies, late corrections) keeps one of them
    one = rows.groupBy("source_id", "fragment_index", "term_index").agg(F.min_by(F.struct("label", "aliases", "definition", "kind", "confidence"), F.to_json(F.struct("label", "aliases", "definition", "kind", "confidence"))).alias("r")).select("source_id", "fragment_index", "term_index", "r.*")
    names = F.array_sort(F.array_distinct(F.filter(F.transform(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>"))), fold_label), lambda n: n.isNotNull() & (n != ""))))
    keyed = one.select("source_id", F.concat_ws(":", "fragment_index", "term_index").alias("key"), F.struct("fragment_index", "term_index").alias("ord"), names.alias("names"), "label", "definition", "kind", "confidence")
    return keyed.withColumn("rep", F.sha2(F.concat_ws("\u0001", "source_id", F.array_join("names", "\u0002"), F.coalesce(fold_label("definition"), F.lit("")), F.coalesce("kind", F.lit("")), F.when(F.size("names") == 0, F.col("key")).otherwise("")), 256))


#: (one member, the other, score) -> whatever verdict() reads
Adjudicator = Callable[[dict, dict, float], object]


PAIR = "source_id string, left string, right string, score double"
DECISION = "source_id string, left string, right string, decision string, stage string, score double"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows of strings and doubles as a batch."""
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.float64() if kind == "double" else pa.string()) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def similar_names(names: DataFrame, threshold: float = AMBIGUOUS) -> DataFrame:
    """(source_id, left, right, score) of distinct folded names of a source with score >= threshold, left < right.

    A similarity of t means a common subsequence of at least t (a + b) / 2 letters,
    so two names have as many letters in common, whatever their order.  The names
    of a source stand in blocks by their length; for two blocks one product of
    matrices counts the common letters of every pair, and the pairs that have
    enough get the subsequences of their names as given and with sorted words, for
    all pairs at once.  Nothing is indexed, so no pair is met twice and common
    letters don't matter; names of few letters need no case of their own.
    """
    t = threshold / 100
    rank = F.row_number().over(W.partitionBy("source_id").orderBy("size", "name"))
    ranked = names.where("name <> ''").select("source_id", "name").distinct().withColumn("size", F.length("name")).withColumn("block", F.floor((rank - 1) / BLOCK))
    blocks = cut(ranked.groupBy("source_id", "block").agg(F.collect_list("name").alias("names"), F.min("size").alias("least"), F.max("size").alias("most")))
    right = blocks.where("block > 0").select("source_id", F.col("block").alias("later"), F.col("names").alias("right"), F.col("least").alias("right_least"))
    # blocks go up in length: the longest name of the earlier one must reach the shortest of the later one
    two = blocks.join(right, "source_id").where(F.col("later") > F.col("block")).where(F.col("most") >= F.col("right_least") * (t / (2 - t)) - 1e-9).select("source_id", "block", "later", F.col("names").alias("left"), "right")
    one = blocks.select("source_id", "block", F.col("block").alias("later"), F.col("names").alias("left"), F.lit(None).cast("array<string>").alias("right"))
    work = one.unionByName(two).repartition(8 * parallelism(names.sparkSession), "source_id", "block", "later").select("source_id", "left", "right")

    def compared(batches):
        # small sources share a product
        few: list[tuple[str, str]] = []
        for batch in batches:
            found: list[tuple] = []
            for source, left, right in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names = [(source, n) for n in left]
                if right is None and len(names) < SMALL:
                    few += names
                    if len(few) >= SMALL:
                        found += close_names(few, None, threshold)
                        few = []
                else:
                    found += close_names(names, right and [(source, n) for n in right], threshold)
            yield _batch(found, PAIR)
        yield _batch(list(close_names(few, None, threshold)), PAIR)

    return work.mapInArrow(compared, PAIR)


def candidates(occ: DataFrame, close: DataFrame) -> DataFrame:
    """(source_id, a, b) that connect all representatives with a name in common or similar names.

    The representatives of a name meet its smallest one and similar names meet by
    theirs: stars with the same components as all pairs have.
    """
    reps = occ.select("source_id", "rep", F.explode("names").alias("name")).distinct()
    first = reps.groupBy("source_id", "name").agg(F.min("rep").alias("hub"))
    exact = reps.join(first, ["source_id", "name"]).where("rep <> hub").select("source_id", F.col("hub").alias("a"), F.col("rep").alias("b"))
    lexical = (
        close.join(first.select("source_id", F.col("name").alias("left"), F.col("hub").alias("a")), ["source_id", "left"])
        .join(first.select("source_id", F.col("name").alias("right"), F.col("hub").alias("b")), ["source_id", "right"])
        .where("a <> b")
        .select("source_id", "a", "b")
    )
    return exact.unionByName(lexical).distinct()


def linked_names(terms: DataFrame) -> DataFrame:
    """(source_id, x, y), x < y: names that a broader or narrower link connects."""
    sides = F.concat(F.coalesce("broader_labels", F.array().cast("array<string>")), F.coalesce("narrower_labels", F.array().cast("array<string>")))
    # folded before they are exploded, so once for each row
    rows = terms.where(F.size(sides) > 0).select("source_id", fold_label("label").alias("l"), F.array_distinct(F.transform(sides, fold_label)).alias("os")).select("source_id", "l", F.explode("os").alias("o")).where("l <> '' and o <> '' and l <> o")
    return rows.select("source_id", F.least("l", "o").alias("x"), F.greatest("l", "o").alias("y")).distinct()


STAR = "source_id string, rep string, component string"


def _stars(batches):
    """(source_id, rep, component): the smallest representative that the pairs of this partition connect each one to."""
    root: dict[tuple[str, str], tuple[str, str]] = {}

    def find(x: tuple[str, str]) -> tuple[str, str]:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    for batch in batches:
        for source, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
            x, y = find((source, a)), find((source, b))
            if x != y:
                root[max(x, y)] = min(x, y)
    rows = list(root)
    for start in range(0, len(rows), 10_000):
        yield _batch([(*x, find(x)[1]) for x in rows[start : start + 10_000]], STAR)


def _components(pairs: DataFrame, edges: int = EDGES) -> DataFrame:
    """(source_id, rep, component): each task joins the pairs of its sources; of a source that is split the stars of all tasks are joined by _spanned()."""
    many = cut(pairs.groupBy("source_id").agg(F.count("*").alias("n")).where(F.col("n") > edges).select("source_id", F.ceil(F.col("n") / edges).alias("splits")))
    n = 4 * parallelism(pairs.sparkSession)
    if many.isEmpty():
        return cut(pairs.select("source_id", "a", "b").repartition(n, "source_id").mapInArrow(_stars, STAR))
    split = pairs.join(F.broadcast(many), "source_id", "left").withColumn("bucket", F.when(F.col("splits").isNotNull(), F.pmod(F.xxhash64("a"), F.col("splits"))).otherwise(F.lit(0)))
    stars = cut(split.repartition(n, "source_id", "bucket").select("source_id", "a", "b").mapInArrow(_stars, STAR))
    parts = stars.join(F.broadcast(many), "source_id", "left_semi").where("rep <> component").select("source_id", F.col("component").alias("a"), F.col("rep").alias("b"))
    return cut(stars.join(F.broadcast(many), "source_id", "left_anti").unionByName(_spanned(parts)))


def _spanned(pairs: DataFrame) -> DataFrame:
    """(source_id, rep, component) by the forest operator: each representative points to its smallest neighbour, repeated."""
    edges = cut(pairs.select("source_id", F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    label = edges.select("source_id", F.col("u").alias("rep")).unionByName(edges.select("source_id", F.col("v").alias("rep"))).distinct().withColumn("component", F.col("rep"))
    both = edges.unionByName(edges.select("source_id", F.col("v").alias("u"), F.col("u").alias("v")))
    label = cut(label)
    while True:
        # the smallest label around each node, then a jump to the root of the pointers
        near = both.join(label.select("source_id", F.col("rep").alias("v"), "component"), ["source_id", "v"]).groupBy("source_id", F.col("u").alias("rep")).agg(F.min("component").alias("near"))
        hook = label.join(near, ["source_id", "rep"]).where("near < component").groupBy("source_id", F.col("component").alias("child")).agg(F.min("near").alias("parent"))
        hook = cut(hook)
        if hook.isEmpty():
            return label
        roots = forest(hook, weight=None, paths=False).select("source_id", F.col("node").alias("component"), "root_node")
        label = cut(label.join(roots, ["source_id", "component"], "left").select("source_id", "rep", F.coalesce("root_node", "component").alias("component")))


def verdict(answer) -> bool:
    """What an adjudicator says: a boolean, yes or no in words, or a mapping or object with ``merge`` or ``decision``."""
    if isinstance(answer, dict):
        answer = answer.get("merge", answer.get("decision"))
    elif not isinstance(answer, (bool, str)) and answer is not None:
        answer = getattr(answer, "merge", getattr(answer, "decision", None))
    return answer.strip().lower() in ("merge", "same", "yes", "true") if isinstance(answer, str) else bool(answer)


def _apart(left: str | None, right: str | None) -> str:
    """What in two definitions, the earlier member's first, forbids their members to be one thing."""
    return "analogy" if ANALOGY.search(f"{left or ''} {right or ''}".casefold()) else "definition" if definitions_apart(left, right) else ""


def _forbidden(names, definitions, a, b, linked: set[tuple[str, str]]) -> str:
    return "hierarchy" if linked and any((min(x, y), max(x, y)) in linked for x in names[a] for y in names[b]) else _apart(definitions[a], definitions[b])


def _resolve(members: pd.DataFrame, close: dict[int, dict[int, float]], at: dict[str, list[int]], linked: set[tuple[str, str]], lexical: float, adjudicator: Adjudicator | None = None, merges: list[tuple[int, int]] | None = None, told: bool = True) -> tuple[list[int], list[tuple[int, int, str, str, float]]]:
    """(the root of each member, decisions): a fold over the pairs in the order of their members.

    close: member -> {later member: score}; at: name -> its members.  Pairs of one
    name are walked, not stored, and a member is reported once for each name and
    outcome, with the first member it met, so a name of k meanings gives no more
    than 2k rows.  An adjudicator is asked once for each pair of names.  merges
    gets every pair that joined two clusters.  Without told there are no
    decisions: pairs of one cluster, or of two that a guard keeps apart, are passed over.
    """
    names, definitions = list(members["names"]), list(members["definition"])
    root = list(range(len(names)))
    group = {i: [i] for i in root}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    memo: dict[tuple[int, int], str] = {}

    def forbidden(a: int, b: int) -> str:
        key = (a, b) if a < b else (b, a)
        if key not in memo:
            memo[key] = _forbidden(names, definitions, *key, linked)
        return memo[key]

    def merge(ra: int, rb: int) -> None:
        if ra != rb:
            low, high = min(ra, rb), max(ra, rb)
            root[high] = low
            group[low] += group.pop(high)
            for x in barred.pop(high, ()):
                barred[x].discard(high)
                barred[x].add(low)
                barred.setdefault(low, set()).add(x)
            if merges is not None:
                merges.append((a, b))

    shown = lambda i: {"names": list(names[i]), "definition": definitions[i]}
    asked: dict[tuple, bool] = {}
    barred: dict[int, set[int]] = {}
    once: set[tuple[int, str]] = set()
    decisions = []
    for a in range(len(names)):
        same = {j for n in names[a] for j in at[n] if j > a}
        for b in sorted(same | close.get(a, {}).keys()):
            score = 100.0 if b in same else close[a][b]
            ra, rb = find(a), find(b)
            if not told and (ra == rb or rb in barred.get(ra, ())):
                continue
            why = forbidden(a, b)
            if not why and ra != rb:
                why = next((w for x in group[ra] for y in group[rb] if (w := forbidden(x, y))), "")
            if why:
                found = (a, b, "distinct", why, score)
                if not told:
                    barred.setdefault(ra, set()).add(rb)
                    barred.setdefault(rb, set()).add(ra)
            elif score >= lexical:
                merge(ra, rb)
                found = (a, b, "merge", "exact" if b in same else "lexical", score)
            elif adjudicator is not None:
                key = tuple(sorted((tuple(names[a]), tuple(names[b]))))
                if key not in asked:
                    asked[key] = verdict(adjudicator(shown(a), shown(b), score))
                if asked[key]:
                    merge(ra, rb)
                found = (a, b, "merge" if asked[key] else "distinct", "adjudicated", score)
            else:
                found = (a, b, "ambiguous", "lexical", score)
            if told and (b not in same or (b, found[2]) not in once):
                decisions.append(found)
                if b in same:
                    once.add((b, found[2]))
    return [find(i) for i in range(len(names))], decisions


def _order(key: str) -> tuple[int, int]:
    fragment, term = key.split(":")
    return int(fragment), int(term)


def _standing(pairs: list[tuple[str, str]], members: dict[str, tuple], merges: list[tuple[str, str]], linked: set[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """For each pair that no guard forbids by itself what else keeps it apart when its turn comes: a guard between two members of its clusters, or nothing.

    members: key -> (names, definition); merges: the pairs that joined clusters.
    """
    at = {_order(k): v for k, v in members.items()}
    names, definitions = {k: v[0] for k, v in at.items()}, {k: v[1] for k, v in at.items()}
    group, root = {k: [k] for k in at}, {k: k for k in at}
    memo: dict[tuple, str] = {}

    def forbidden(a, b) -> str:
        key = (a, b) if a < b else (b, a)
        if key not in memo:
            memo[key] = _forbidden(names, definitions, *key, linked)
        return memo[key]

    todo = sorted(((_order(x), _order(y)) for x, y in merges), reverse=True)
    found = {}
    for turn, pair in sorted(((_order(x), _order(y)), (x, y)) for x, y in pairs):
        while todo and todo[-1] < turn:
            low, high = sorted(root[k] for k in todo.pop())
            for k in group[high]:
                root[k] = low
            group[low] += group.pop(high)
        ra, rb = (root[k] for k in turn)
        found[pair] = "" if ra == rb else next((w for x in group[ra] for y in group[rb] if (w := forbidden(x, y))), "")
    return found


@F.pandas_udf(T.StringType())
def _apart_udf(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([_apart(x, y) for x, y in zip(left, right)])


def _waiting(reps: DataFrame, close: DataFrame, links: DataFrame, keyed: DataFrame, merges: DataFrame, lexical: float) -> DataFrame:
    """(source_id, left, right, decision, stage, score) of the pairs that are similar, but not enough to merge.

    reps: (source_id, rep, ord, names, definition); keyed: (source_id, rep, own,
    cluster_key); merges: (source_id, cluster_key, x, y).
    """
    named = reps.select("source_id", "rep", F.explode("names").alias("name"))
    met = close.join(named.select("source_id", F.col("name").alias("left"), F.col("rep").alias("a")), ["source_id", "left"]).join(named.select("source_id", F.col("name").alias("right"), F.col("rep").alias("b")), ["source_id", "right"]).where("a <> b")
    met = met.groupBy("source_id", F.least("a", "b").alias("x_rep"), F.greatest("a", "b").alias("y_rep")).agg(F.max("score").alias("score")).where(F.col("score") < lexical)
    known = reps.join(keyed, ["source_id", "rep"])
    side = lambda s: known.select("source_id", F.col("rep").alias(f"{s}_rep"), F.struct("ord", F.col("own").alias("key"), "names", "definition", "cluster_key").alias(s))
    both = met.join(side("x"), ["source_id", "x_rep"]).join(side("y"), ["source_id", "y_rep"]).where(~F.arrays_overlap("x.names", "y.names"))
    first = F.col("x.ord") < F.col("y.ord")
    both = cut(both.select("source_id", F.when(first, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("b"), "score"))

    def barred(pairs: DataFrame, on: list[str], left: str, right: str) -> DataFrame:
        crossed = pairs.select("source_id", *on, F.explode(left).alias("m"), F.col(right).alias("others")).select("source_id", *on, "m", F.explode("others").alias("n"))
        return crossed.select("source_id", *on, F.least("m", "n").alias("x"), F.greatest("m", "n").alias("y")).join(links, ["source_id", "x", "y"], "left_semi").distinct()

    told = both.select("source_id", F.col("a.key").alias("left"), F.col("b.key").alias("right"), "a", "b", "score")
    linked = barred(told.withColumns({"l": F.col("a.names"), "r": F.col("b.names")}), ["left", "right"], "l", "r").select("source_id", "left", "right").distinct().withColumn("linked", F.lit(True))
    judged = told.join(linked, ["source_id", "left", "right"], "left").withColumn("apart", _apart_udf("a.definition", "b.definition"))
    judged = cut(judged.select("source_id", "left", "right", F.when(F.col("linked"), "hierarchy").otherwise(F.col("apart")).alias("why"), "score", F.col("a.cluster_key").alias("p"), F.col("b.cluster_key").alias("q")))
    # no guard between the two: then one between other members of their clusters may stand in the way
    open_pairs = judged.where("why = ''").select("source_id", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), F.struct("left", "right", "score").alias("pair"))
    asked = open_pairs.groupBy("source_id", "p", "q").agg(F.collect_list("pair").alias("pairs"))
    members = known.groupBy("source_id", "cluster_key").agg(F.collect_list(F.struct(F.col("own").alias("key"), "names", "definition")).alias("members"))
    grown = members.join(merges.groupBy("source_id", "cluster_key").agg(F.collect_list(F.struct("x", "y")).alias("merges")), ["source_id", "cluster_key"], "left")
    end = lambda s: grown.select("source_id", F.col("cluster_key").alias(s), F.col("members").alias(f"{s}_members"), F.col("merges").alias(f"{s}_merges"))
    rows = asked.join(end("p"), ["source_id", "p"]).join(end("q"), ["source_id", "q"])
    every = lambda s: F.array_distinct(F.flatten(F.transform(f"{s}_members", lambda m: m["names"])))
    bars = barred(rows.select("source_id", "p", "q", every("p").alias("l"), every("q").alias("r")), ["p", "q"], "l", "r").groupBy("source_id", "p", "q").agg(F.collect_list(F.struct("x", "y")).alias("bars"))
    rows = rows.join(bars, ["source_id", "p", "q"], "left").select("source_id", "pairs", F.when(F.col("p") == F.col("q"), F.col("p_members")).otherwise(F.concat("p_members", "q_members")).alias("members"), F.when(F.col("p") == F.col("q"), F.coalesce("p_merges", F.array())).otherwise(F.concat(F.coalesce("p_merges", F.array()), F.coalesce("q_merges", F.array()))).alias("merges"), "bars")

    def replayed(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                score = {(x["left"], x["right"]): x["score"] for x in row["pairs"]}
                why = _standing(list(score), {m["key"]: (m["names"], m["definition"]) for m in row["members"]}, [(m["x"], m["y"]) for m in row["merges"]], {(x["x"], x["y"]) for x in row["bars"] or ()})
                out += [(row["source_id"], *p, "distinct" if w else "ambiguous", w or "lexical", score[p]) for p, w in why.items()]
            yield _batch(out, DECISION)

    return judged.where("why <> ''").select("source_id", "left", "right", F.lit("distinct").alias("decision"), F.col("why").alias("stage"), "score").unionByName(rows.mapInArrow(replayed, DECISION))


def _folds(terms: DataFrame, occ: DataFrame, lexical: float, threshold: float, adjudicator: Adjudicator | None, told: bool) -> tuple[DataFrame, ...]:
    close = cut(similar_names(occ.select("source_id", F.explode("names").alias("name")).distinct(), min(lexical, threshold)))
    # pairs that can't merge connect nothing
    firm = close if adjudicator is not None else close.where(F.col("score") >= lexical)
    pairs = cut(candidates(occ, firm))
    reps = cut(occ.groupBy("source_id", "rep").agg(F.min("ord").alias("ord"), F.first("names").alias("names"), F.min("definition").alias("definition")))
    comp = _components(pairs)
    links = linked_names(terms)
    inside = comp.join(reps, ["source_id", "rep"])
    spoken = inside.select("source_id", "component", F.explode("names").alias("name")).distinct()
    bars = links.join(spoken.withColumnRenamed("name", "x"), ["source_id", "x"]).join(spoken.select("source_id", "component", F.col("name").alias("y")), ["source_id", "component", "y"])
    nothing = F.lit(None)
    blank = (nothing.cast("bigint").alias("fragment_index"), nothing.cast("int").alias("term_index"), nothing.cast("array<string>").alias("names"), nothing.cast("string").alias("definition"))
    rows = inside.select("source_id", "component", F.lit("r").alias("kind"), "rep", F.lit(None).cast("string").alias("other"), F.lit(None).cast("double").alias("score"), "ord.fragment_index", "ord.term_index", "names", "definition")
    where = spoken.withColumnRenamed("name", "left")
    rows = rows.unionByName(firm.join(where, ["source_id", "left"]).select("source_id", "component", F.lit("p").alias("kind"), F.col("left").alias("rep"), F.col("right").alias("other"), "score", *blank))
    rows = rows.unionByName(bars.select("source_id", "component", F.lit("l").alias("kind"), F.col("x").alias("rep"), F.col("y").alias("other"), nothing.cast("double").alias("score"), *blank))

    def one(source: str, rows: list[dict]) -> list[tuple]:
        members = [r for r in rows if r["kind"] == "r"]
        at: dict[str, list[int]] = {}
        for i, r in enumerate(members):
            for n in r["names"]:
                at.setdefault(n, []).append(i)
        close: dict[int, dict[int, float]] = {}
        for r in rows:
            if r["kind"] == "p":
                for i in at.get(r["rep"], ()):
                    for j in at.get(r["other"], ()):
                        if i != j:
                            later = close.setdefault(min(i, j), {})
                            later[max(i, j)] = max(later.get(max(i, j), 0.0), r["score"])
        linked = {(r["rep"], r["other"]) for r in rows if r["kind"] == "l"}
        merges: list[tuple[int, int]] = []
        roots, decisions = _resolve({k: [r[k] for r in members] for k in ("names", "definition")}, close, at, linked, lexical, adjudicator, merges, told)
        keys = [f"{r['fragment_index']}:{r['term_index']}" for r in members]
        out = [(source, "r", r["rep"], None, keys[roots[i]], None, None) for i, r in enumerate(members)]
        out += [(source, "m", keys[a], keys[b], keys[roots[a]], None, None) for a, b in merges if told]
        return out + [(source, "d", keys[a], keys[b], d, s, score) for a, b, d, s, score in decisions]

    def folded(batches):
        """Components one after another: rows come sorted, so a component is whole when the next begins."""
        out: list[tuple] = []
        for (source, _), rows in itertools.groupby((r for batch in batches for r in batch.to_pylist()), key=lambda r: (r["source_id"], r["component"])):
            out += one(source, list(rows))
            if len(out) >= 10_000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    schema = "source_id string, kind string, x string, y string, value string, stage string, score double"
    placed = rows.repartition(4 * parallelism(terms.sparkSession), "source_id", "component").sortWithinPartitions("source_id", "component", "fragment_index", "term_index")
    return reps, close, links, cut(placed.mapInArrow(folded, schema))


def resolve(terms: DataFrame, lexical: float = LEXICAL, threshold: float = AMBIGUOUS, adjudicator: Adjudicator | None = None) -> tuple[DataFrame, DataFrame]:
    """((source_id, key, cluster_key), (source_id, left, right, decision, stage, score)).

    cluster_key is the key of the cluster's first occurrence.  Decisions are
    between representatives, shown by their first occurrences.  The adjudicator
    runs on the executors, on pairs scored from ``threshold`` up to ``lexical``.
    """
    keyed, decisions = resolved(terms, lexical, threshold, adjudicator, told=True)
    return keyed, decisions()


def resolved(terms: DataFrame, lexical: float = LEXICAL, threshold: float = AMBIGUOUS, adjudicator: Adjudicator | None = None, told: bool = False, occ: DataFrame | None = None) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """resolve() with decisions that are made when they are called for.

    told: they will be, so they are made together with the clusters; otherwise
    only what decides the clusters is compared.  occ: checkpointed
    occurrences(terms), if the caller has them.
    """
    occ = cut(occurrences(terms)) if occ is None else occ
    told = told or adjudicator is not None
    reps, close, links, done = _folds(terms, occ, lexical, threshold if told else lexical, adjudicator, told)
    cluster = done.where("kind = 'r'").select("source_id", F.col("x").alias("rep"), F.col("value").alias("cluster_key"))
    # a representative without candidates is a cluster of its copies
    alone = reps.select("source_id", "rep", F.concat_ws(":", "ord.fragment_index", "ord.term_index").alias("own"))
    each = alone.join(cluster, ["source_id", "rep"], "left").select("source_id", "rep", "own", F.coalesce("cluster_key", "own").alias("cluster_key"))
    keyed = occ.select("source_id", "key", "rep").join(each, ["source_id", "rep"]).select("source_id", "key", "cluster_key")

    def decisions() -> DataFrame:
        if not told:
            return resolved(terms, lexical, threshold, told=True, occ=occ)[1]()
        made = done.where("kind = 'd'").select("source_id", F.col("x").alias("left"), F.col("y").alias("right"), F.col("value").alias("decision"), "stage", "score")
        if adjudicator is not None:
            return made
        merges = done.where("kind = 'm'").select("source_id", F.col("value").alias("cluster_key"), "x", "y")
        return made.unionByName(_waiting(reps, close, links, each, merges, lexical))

    return keyed, decisions


def clusters(terms: DataFrame, keyed: DataFrame, occ: DataFrame | None = None) -> DataFrame:
    """(source_id, cluster_key, cluster_id, canonical_label, n_labels, n_occurrences) of resolved occurrences.

    cluster_id is derived from content: the exclusive or of the hashes of the
    members' distinct (label, definition, kind), so no cluster is gathered.
    occ: occurrences(terms), if the caller has them.
    """
    occ = (occurrences(terms) if occ is None else occ).select("source_id", "key", F.trim("label").alias("label"), "definition", "kind", "confidence")
    joined = cut(keyed.join(occ, ["source_id", "key"]))
    per = joined.where("label is not null and label <> ''").groupBy("source_id", "cluster_key", "label").agg(F.count("*").alias("n"), F.max("confidence").alias("c"))
    best = per.groupBy("source_id", "cluster_key").agg(F.min_by("label", F.struct(-F.col("n"), -F.coalesce("c", F.lit(-1.0)), F.length("label"), fold_label("label"), F.col("label"))).alias("canonical_label"), F.count("*").alias("n_labels"))
    sign = F.sha2(F.concat_ws("\u001f", F.coalesce(fold_label("label"), F.lit("")), F.coalesce(fold_label("definition"), F.lit("")), F.coalesce("kind", F.lit(""))), 256)
    signs = joined.select("source_id", "cluster_key", sign.alias("sign")).distinct().groupBy("source_id", "cluster_key").agg(F.bit_xor(F.conv(F.substring("sign", 1, 15), 16, 10).cast("bigint")).alias("x"))
    sizes = joined.groupBy("source_id", "cluster_key").agg(F.count("*").alias("n_occurrences"))
    return sizes.join(signs, ["source_id", "cluster_key"]).join(best, ["source_id", "cluster_key"], "left").select("source_id", "cluster_key", F.concat(F.lit("cluster-"), F.lpad(F.lower(F.hex("x")), 16, "0")).alias("cluster_id"), "canonical_label", "n_labels", "n_occurrences")
