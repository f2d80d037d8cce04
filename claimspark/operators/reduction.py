"""Reduction of draft terms to one canonical set per source.

Aggregations only: a value that "wins" is a min_by over a struct, so all of it
runs with partial aggregation and a hot label is combined before the shuffle.
Order-dependent choices carry their order columns; nothing relies on row order.

Defined results: null and blank labels form no term; confidences outside 0..1
(and NaN) count as absent; a group without verified evidence or below the
least confidence gives no term; repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.functions.columns import collapse, fold_label, is_blank
from claimspark.runtime import cut

LEAST_CONFIDENCE = 0.55
BUDGETS = {"terms": 250, "relations": 400, "axioms": 200, "mental_models": 60}
ABSTRACT_SIZE = 8


def trusted(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when((c >= 0) & (c <= 1) & ~F.isnan(c), c)


def drafts(terms: DataFrame) -> DataFrame:
    """Distinct draft rows with their label key, usable confidence and verified evidence."""
    flat = terms.select("term_id", "source_id", "fragment_index", "term_index", "label", "aliases", "kind", "definition", "broader_labels", "narrower_labels", "related_labels", "confidence", "evidence").distinct()
    good = F.filter(F.coalesce("evidence", F.array().cast(flat.schema["evidence"].dataType)), lambda e: F.coalesce(e["verified"], F.lit(False)))
    return flat.withColumn("label_key", fold_label("label")).withColumn("confidence", trusted("confidence")).withColumn("evidence", good).where("source_id is not null and label_key <> ''")


def merged_evidence(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys + (chunk_id, quote_sha256, page_start, page_end, quote): distinct verified evidence of each group."""
    e = rows.select(*keys, F.explode("evidence").alias("e")).select(*keys, F.col("e.source_id").alias("evidence_source"), "e.chunk_id", "e.quote_sha256", F.coalesce("e.page_start", F.lit(0)).alias("page_start"), F.coalesce("e.page_end", F.lit(0)).alias("page_end"), "e.quote")
    return e.groupBy(*keys, "evidence_source", "chunk_id", "quote_sha256", "page_start", "page_end").agg(F.min("quote").alias("quote"))


def evidence_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return merged_evidence(rows, keys).groupBy(*keys).agg(F.count("*").alias("n_evidence"))


def canonical_labels(rows: DataFrame) -> DataFrame:
    """(source_id, label_key, label, n): the most frequent spelling, then the most trusted, the shortest, the smallest."""
    per = rows.groupBy("source_id", "label_key", F.trim("label").alias("label")).agg(F.count("*").alias("n"), F.max(F.coalesce("confidence", F.lit(-1.0))).alias("c"))
    return per.groupBy("source_id", "label_key").agg(F.min_by("label", F.struct(-F.col("n"), -F.col("c"), F.length("label"), F.col("label"))).alias("label"), F.sum("n").alias("n"))


def best_definitions(rows: DataFrame) -> DataFrame:
    """(source_id, label_key, definition): of the most trusted row, then with most evidence, the longest, the smallest."""
    some = rows.where(~is_blank("definition"))
    order = F.struct(-F.coalesce("confidence", F.lit(-1.0)), -F.size("evidence"), -F.length("definition"), F.col("definition"))
    return some.groupBy("source_id", "label_key").agg(collapse(F.min_by("definition", order)).alias("definition"))


def best_kinds(rows: DataFrame) -> DataFrame:
    """(source_id, label_key, kind): highest summed confidence, then count, then name."""
    per = rows.where("kind is not null").groupBy("source_id", "label_key", "kind").agg(F.sum(F.round(F.coalesce("confidence", F.lit(0.0)) * 1e6).cast("bigint")).alias("w"), F.count("*").alias("n"))
    return per.groupBy("source_id", "label_key").agg(F.min_by("kind", F.struct(-F.col("w"), -F.col("n"), F.col("kind"))).alias("kind"))


def _spellings(rows: DataFrame) -> DataFrame:
    """What every later choice needs, once for each (source_id, label_key, label, kind): far fewer rows than drafts."""
    order = F.struct((-F.coalesce("confidence", F.lit(-1.0))).alias("c"), (-F.size("evidence")).alias("e"), (-F.length("definition")).alias("l"), F.col("definition").alias("definition"))
    return rows.groupBy("source_id", "label_key", F.trim("label").alias("label"), "kind").agg(
        F.count("*").alias("n"),
        F.max("confidence").alias("confidence"),
        F.sum(F.round(F.coalesce("confidence", F.lit(0.0)) * 1e6).cast("bigint")).alias("w"),
        F.min(F.when(~is_blank("definition"), order)).alias("best"),
    )


def reduced_terms(terms: DataFrame, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["terms"], rows: DataFrame | None = None) -> DataFrame:
    """(source_id, label_key, label, kind, definition, confidence, n_evidence, rank): the salient terms of each source.

    rows: checkpointed drafts(terms), if the caller has them.
    """
    return _reduced(drafts(terms) if rows is None else rows, least, budget)


def _reduced(rows: DataFrame, least: float, budget: int) -> DataFrame:
    keys = ["source_id", "label_key"]
    spelt = cut(_spellings(rows))
    by_label = spelt.groupBy(*keys, "label").agg(F.sum("n").alias("n"), F.max(F.coalesce("confidence", F.lit(-1.0))).alias("c"))
    labels = by_label.groupBy(*keys).agg(F.min_by("label", F.struct(-F.col("n"), -F.col("c"), F.length("label"), fold_label("label"), F.col("label"))).alias("label"))
    by_kind = spelt.where("kind is not null").groupBy(*keys, "kind").agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
    kinds = by_kind.groupBy(*keys).agg(F.min_by("kind", F.struct(-F.col("w"), -F.col("n"), F.col("kind"))).alias("kind"))
    top = spelt.groupBy(*keys).agg(F.max("confidence").alias("confidence"), collapse(F.min("best")["definition"]).alias("definition"))
    joined = top.where(F.col("confidence") >= least).join(labels, keys).join(evidence_counts(rows, keys), keys)
    salience = W.partitionBy("source_id").orderBy(F.desc("confidence"), F.desc("n_evidence"), "label_key")
    kept = joined.withColumn("rank", F.row_number().over(salience)).where(F.col("rank") <= budget)
    return kept.join(kinds, keys, "left").select(*keys, "label", "kind", F.coalesce("definition", F.lit("")).alias("definition"), "confidence", "n_evidence", "rank")


def abstracts(reduced: DataFrame, size: int = ABSTRACT_SIZE) -> DataFrame:
    """(source_id, abstract): the ``size`` most salient terms with their definitions."""
    text = F.when(F.col("definition") != "", F.concat_ws(": ", "label", "definition")).otherwise(F.col("label"))
    top = reduced.where(F.col("rank") <= size).groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("rank", text.alias("text")))).alias("parts"))
    return top.select("source_id", F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n").alias("abstract"))


def term_links(terms: DataFrame, reduced: DataFrame) -> DataFrame:
    """(source_id, label_key, link, other_key): links between surviving terms with their inverses, no self-links."""
    rows = drafts(terms)
    sides = F.array(*[F.struct(F.lit(n).alias("link"), F.lit(i).alias("inverse"), F.coalesce(c, F.array().cast("array<string>")).alias("labels")) for n, i, c in (("broader", "narrower", "broader_labels"), ("narrower", "broader", "narrower_labels"), ("related", "related", "related_labels"))])
    each = rows.select("source_id", "label_key", F.explode(sides).alias("s")).select("source_id", "label_key", "s.link", "s.inverse", F.explode("s.labels").alias("o")).select("source_id", "label_key", "link", "inverse", fold_label("o").alias("other_key")).where("other_key <> '' and other_key <> label_key").distinct()
    alive = cut(reduced.select("source_id", "label_key"))  # both ends are looked up
    known = each.join(alive, ["source_id", "label_key"], "left_semi").join(alive.withColumnRenamed("label_key", "other_key"), ["source_id", "other_key"], "left_semi")
    return known.select("source_id", "label_key", "link", "other_key").unionByName(known.select("source_id", F.col("other_key").alias("label_key"), F.col("inverse").alias("link"), F.col("label_key").alias("other_key"))).distinct()


def clustered(terms: DataFrame, keyed: DataFrame) -> DataFrame:
    """Draft rows with the cluster_key of resolution.resolve(); rows without a position go by their label."""
    at = F.when(F.col("fragment_index").isNotNull() & F.col("term_index").isNotNull(), F.concat_ws(":", "fragment_index", "term_index"))
    rows = drafts(terms).withColumn("key", at).join(keyed, ["source_id", "key"], "left")
    return rows.withColumn("cluster_key", F.coalesce("cluster_key", F.concat(F.lit("label:"), "label_key")))


def resolved_terms(terms: DataFrame, keyed: DataFrame, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["terms"], rows: DataFrame | None = None) -> DataFrame:
    """(source_id, cluster_key, label_key, label, aliases, kind, definition, confidence, n_evidence, rank): the salient terms of each source, one for each cluster.

    rows: checkpointed clustered(terms, keyed), if the caller has them.
    """
    rows = cut(clustered(terms, keyed)) if rows is None else rows
    kept = _reduced(rows.withColumn("label_key", F.col("cluster_key")), least, budget).withColumnRenamed("label_key", "cluster_key").withColumn("label_key", fold_label("label"))
    names = rows.select("source_id", "cluster_key", F.explode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias")).select("source_id", "cluster_key", F.trim("alias").alias("alias")).distinct()
    other = names.join(kept.select("source_id", "cluster_key", "label_key"), ["source_id", "cluster_key"]).where((fold_label("alias") != "") & (fold_label("alias") != F.col("label_key")))
    aliases = other.groupBy("source_id", "cluster_key").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    return kept.join(aliases, ["source_id", "cluster_key"], "left").select("source_id", "cluster_key", "label_key", "label", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"), "kind", "definition", "confidence", "n_evidence", "rank")


def resolved_links(terms: DataFrame, keyed: DataFrame, reduced: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """(source_id, cluster_key, link, other_cluster): links between surviving clusters with their inverses, no self-links.

    A stated label means the one cluster that has it as a label or alias in the
    same fragment, else the one that has it in the source, else nothing.
    rows: checkpointed clustered(terms, keyed), if the caller has them.
    """
    rows = cut(clustered(terms, keyed)) if rows is None else rows
    none = F.array().cast("array<string>")
    names = rows.select("source_id", "fragment_index", "cluster_key", F.explode(F.concat(F.array("label"), F.coalesce("aliases", none))).alias("name")).select("source_id", "fragment_index", "cluster_key", fold_label("name").alias("name")).where("name <> ''").distinct()
    one = lambda keys, to: names.groupBy(*keys).agg(F.count_distinct("cluster_key").alias("n"), F.min("cluster_key").alias(to)).where("n = 1").drop("n")
    sides = F.array(*[F.struct(F.lit(n).alias("link"), F.lit(i).alias("inverse"), F.coalesce(c, none).alias("labels")) for n, i, c in (("broader", "narrower", "broader_labels"), ("narrower", "broader", "narrower_labels"), ("related", "related", "related_labels"))])
    each = rows.select("source_id", "fragment_index", "cluster_key", F.explode(sides).alias("s")).select("source_id", "fragment_index", "cluster_key", "s.link", "s.inverse", F.explode("s.labels").alias("o")).withColumn("name", fold_label("o")).where("name <> ''").drop("o").distinct()
    found = each.join(one(["source_id", "fragment_index", "name"], "local"), ["source_id", "fragment_index", "name"], "left").join(one(["source_id", "name"], "everywhere"), ["source_id", "name"], "left").withColumn("other_cluster", F.coalesce("local", "everywhere"))
    alive = cut(reduced.select("source_id", "cluster_key"))
    known = found.where("other_cluster <> cluster_key").join(alive, ["source_id", "cluster_key"], "left_semi").join(alive.withColumnRenamed("cluster_key", "other_cluster"), ["source_id", "other_cluster"], "left_semi")
    return known.select("source_id", "cluster_key", "link", "other_cluster").unionByName(known.select("source_id", F.col("other_cluster").alias("cluster_key"), F.col("inverse").alias("link"), F.col("cluster_key").alias("other_cluster"))).distinct()


def dangling_labels(terms: DataFrame) -> DataFrame:
    """(source_id, other_key, n): labels that are linked to but have no row in their source."""
    rows = drafts(terms)
    links = rows.select("source_id", F.explode(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("broader_labels", "narrower_labels", "related_labels")])).alias("o")).select("source_id", fold_label("o").alias("other_key")).where("other_key <> ''")
    return links.join(rows.select("source_id", F.col("label_key").alias("other_key")).distinct(), ["source_id", "other_key"], "left_anti").groupBy("source_id", "other_key").agg(F.count("*").alias("n"))
