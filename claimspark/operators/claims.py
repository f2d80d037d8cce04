"""Fragments of claims reduced to one ontology for each source.

A fragment is what was extracted from one chunk: terms, relations, axioms,
mental models and open questions, each with evidence.  Reduction quarantines
what isn't verified, binds every label to the cluster it means, merges equal
claims, applies least confidence and salience budgets and links the rest by
identifiers.  A merge of batches, batch by batch, is what a partial aggregation
does; ``merge_batch`` states it for one set of fragments and is associative, so
any tree of batches gives the same rows.

Identifiers are derived from content: kind, source, the claim's key and the
identity of its evidence.  Everything is an aggregation or an equi-join; lists
are collected only where a budget bounds them.

Defined results: null and blank labels, statements and names form no claim;
rows without verified evidence are quarantined; confidences outside 0..1 count
as absent; repeated rows count once; empty tables give no rows; columns that
aren't named here are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from claimspark.functions.columns import collapse, fold_label, is_blank
from claimspark.functions.text import datalog_rule_is_safe
from claimspark.operators.reduction import ABSTRACT_SIZE, BUDGETS, LEAST_CONFIDENCE, clustered, resolved_terms, trusted
from claimspark.runtime import cut

EVIDENCE = "array<struct<source_id:string,chunk_id:string,heading_path:array<string>,page_start:int,page_end:int,quote:string,quote_sha256:string,verified:boolean>>"
LISTS = ("applicable_when", "assumptions", "variables", "mechanism", "procedure", "predictions", "failure_modes")
SEPARATOR = "\u001f"


@dataclass
class Fragments:
    """Draft claims: every table has source_id, fragment_index, item_index (term_index of terms), confidence and evidence."""

    terms: DataFrame
    relations: DataFrame  # subject_label, predicate, object_label, qualifiers map<string,string>
    axioms: DataFrame  # statement, modality, epistemic_status, attribution, conditions, exceptions
    models: DataFrame  # name, purpose and the LISTS
    questions: DataFrame  # source_id, fragment_index, question


@dataclass
class Ontology:
    """Canonical claims of all sources, one row each; claim_id is unique over all kinds."""

    terms: DataFrame
    links: DataFrame
    relations: DataFrame
    axioms: DataFrame
    models: DataFrame
    conflicts: DataFrame
    evidence: DataFrame
    abstracts: DataFrame
    questions: DataFrame


def _verified() -> Column:
    return F.filter("evidence", lambda e: F.coalesce(e["verified"], F.lit(False)))


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with verified evidence only, rows without any)."""
    kept = rows.withColumn("evidence", F.coalesce(_verified(), F.array().cast(rows.schema["evidence"].dataType)))
    return kept.where(F.size("evidence") > 0), kept.where(F.size("evidence") == 0)


def ordered_unique(rows: DataFrame, keys: list[str], column: str, at: list[str]) -> DataFrame:
    """(keys, column): the distinct strings of an array column in order of first mention, spaces collapsed.

    Strings are equal if their folded forms are; the first spelling stays.  A
    string that folds to nothing is one more form, of which the first stays.
    """
    each = rows.select(*keys, *at, F.posexplode(column).alias("place", "value")).where("value is not null").withColumn("value", collapse("value")).where("value <> ''")
    first = each.groupBy(*keys, fold_label("value").alias("folded")).agg(F.min(F.struct(*at, "place", "value")).alias("f"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["value"]).alias(column))


def evidence_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys + (evidence_source, chunk_id, quote_sha256, page_start, page_end, quote): distinct verified evidence."""
    e = rows.select(*keys, F.explode(_verified()).alias("e"))
    return e.groupBy(*keys, F.col("e.source_id").alias("evidence_source"), F.col("e.chunk_id").alias("chunk_id"), F.col("e.quote_sha256").alias("quote_sha256"), F.coalesce("e.page_start", F.lit(0)).alias("page_start"), F.coalesce("e.page_end", F.lit(0)).alias("page_end")).agg(
        F.min("e.quote").alias("quote")
    )


def _identity(*parts: Column | str) -> Column:
    """A whole number that stands for one evidence row; the exclusive or of a claim's rows is its evidence's identity."""
    text = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def claim_id(kind: str, *parts: Column | str) -> Column:
    text = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts])
    return F.concat(F.lit(kind + ":"), F.substring(F.sha2(text, 256), 1, 16))


def _with_evidence(rows: DataFrame, grouped: DataFrame, keys: list[str], kind: str, parts: list[str]) -> tuple[DataFrame, DataFrame]:
    """(grouped with n_evidence and claim_id, their evidence by claim_id)."""
    proof = evidence_of(rows, keys)
    per = proof.groupBy(*keys).agg(F.count("*").alias("n_evidence"), F.bit_xor(_identity("evidence_source", "chunk_id", "quote_sha256", "page_start", "page_end")).alias("proof"))
    ided = cut(grouped.join(per, keys).withColumn("claim_id", claim_id(kind, "source_id", *parts, "proof")).drop("proof"))
    return ided, proof.join(ided.select(*keys, "claim_id"), keys).select("source_id", "claim_id", "evidence_source", "chunk_id", "quote_sha256", "page_start", "page_end", "quote")


def _salient(rows: DataFrame, text: str, budget: int) -> DataFrame:
    order = W.partitionBy("source_id").orderBy(F.desc("confidence"), F.desc("n_evidence"), fold_label(text), "claim_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= budget)


# --- one batch -----------------------------------------------------------------------------------------------------------


def _list_key(c: str) -> Column:
    return F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), fold_label), "\u001e")


def qualifier_key(c: Column | str = "qualifiers") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "\u001e"), F.lit(""))


_CLAIM_KEYS = {
    "terms": lambda: {"k1": fold_label("label"), "k2": F.col("kind"), "k3": fold_label("definition")},
    "relations": lambda: {"k1": fold_label("subject_label"), "k2": fold_label("predicate"), "k3": fold_label("object_label"), "k4": qualifier_key()},
    "axioms": lambda: {"k1": fold_label("statement"), "k2": F.col("modality"), "k3": F.col("epistemic_status"), "k4": fold_label("attribution"), "k5": _list_key("conditions"), "k6": _list_key("exceptions")},
    "models": lambda: {"k1": fold_label("name"), "k2": fold_label("purpose")} | {f"k{i}": _list_key(c) for i, c in enumerate(LISTS, 3)},
}
_SHOWN = {"terms": "label", "relations": "predicate", "axioms": "statement", "models": "name"}


@dataclass
class Batch:
    """Merged drafts of one kind: one row for each claim, and its evidence beside it."""

    kind: str
    claims: DataFrame  # source_id, claim keys, fields, confidence, weight (evidence of the winner), first (place of the first mention)
    evidence: DataFrame  # source_id, claim keys, evidence columns


_TERM_LISTS = ("aliases", "broader_labels", "narrower_labels", "related_labels")


def _won(rows: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    """One row for each claim: the fields of its best row, the highest confidence, of terms the union of the lists."""
    lists = [c for c in _TERM_LISTS if kind == "terms"]
    fields = [c for c in rows.columns if c not in (*keys, *lists, "confidence", "weight", "first")]
    shown = F.col(_SHOWN[kind])
    order = F.struct(-F.coalesce("confidence", F.lit(-1.0)), -F.col("weight"), shown, "first")
    best = F.min_by(F.struct(*fields, "weight"), order)
    out = rows.groupBy(*keys).agg(best.alias("w"), F.max("confidence").alias("confidence"), F.min("first").alias("first")).select(*keys, "w.*", "confidence", "first")
    for c in lists:
        out = out.join(ordered_unique(rows, keys, c, ["first"]), keys, "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return out


def merge_batch(rows: DataFrame, kind: str) -> Batch:
    """Draft rows of one kind with equal claims of a source as one.

    The row with the highest confidence (of terms also with the most evidence,
    then the smallest text) stands for the others; it gets the highest
    confidence and the union of the evidence, of terms also of the aliases and
    links.  No claim comes out that didn't go in.
    """
    made = {k: F.coalesce(c.cast("string"), F.lit("")) for k, c in _CLAIM_KEYS[kind]().items()}
    keys = ["source_id", *made]
    place = "term_index" if kind == "terms" else "item_index"
    keyed = rows.withColumns(made)
    if kind == "relations":  # maps can't be compared: qualifiers travel as sorted entries
        keyed = keyed.withColumn("qualifiers", F.array_sort(F.map_entries("qualifiers")))
    weight = F.coalesce(F.size(_verified()), F.lit(0)) if kind == "terms" else F.lit(0)
    flat = keyed.withColumn("weight", weight).withColumn("first", F.struct("fragment_index", F.col(place).alias("item")))
    return Batch(kind, _won(flat.drop("evidence", "fragment_index", place), kind, keys), evidence_of(keyed, keys))


def merge_batches(batches: list[Batch]) -> Batch:
    """Several merged batches as one; associative, so any tree of batches gives the same claims."""
    if not batches:
        raise ValueError("at least one batch is required")
    kind = batches[0].kind
    claims, proof = batches[0].claims, batches[0].evidence
    for x in batches[1:]:
        claims, proof = claims.unionByName(x.claims), proof.unionByName(x.evidence)
    keys = ["source_id", *_CLAIM_KEYS[kind]()]
    merged = proof.groupBy(*keys, "evidence_source", "chunk_id", "quote_sha256", "page_start", "page_end").agg(F.min("quote").alias("quote"))
    return Batch(kind, _won(claims, kind, keys), merged)


def merge_tree(rows: DataFrame, kind: str, batch_size: int = 8) -> Batch:
    """Batches of ``batch_size`` consecutive fragments of each source, merged each for itself and then together.

    One aggregation merges all batches of a level at once, as each batch is part of the key.
    """
    if batch_size < 2:
        raise ValueError("a batch needs at least two fragments")
    batch = F.floor(F.col("fragment_index") / batch_size).cast("string")
    level = merge_batch(rows.withColumn("source_id", F.concat_ws(SEPARATOR, "source_id", batch)), kind)
    whole = lambda df: df.withColumn("source_id", F.substring_index("source_id", SEPARATOR, 1))
    return merge_batches([Batch(kind, whole(level.claims), whole(level.evidence))])


def new_claims(before: DataFrame, after: Batch) -> DataFrame:
    """Keys of merged claims that no input has: empty for a sound merge."""
    keys = {k: F.coalesce(c.cast("string"), F.lit("")) for k, c in _CLAIM_KEYS[after.kind]().items()}
    had = before.select("source_id", *[c.alias(k) for k, c in keys.items()]).distinct()
    return after.claims.select("source_id", *keys).join(had, ["source_id", *keys], "left_anti")


# --- references ----------------------------------------------------------------------------------------------------------


def named_clusters(rows: DataFrame) -> DataFrame:
    """(source_id, fragment_index, name, cluster_key) of every label and alias of clustered draft terms."""
    none = F.array().cast("array<string>")
    names = rows.select("source_id", "fragment_index", "cluster_key", F.explode(F.concat(F.array("label"), F.coalesce("aliases", none))).alias("name"))
    return names.select("source_id", "fragment_index", fold_label("name").alias("name"), "cluster_key").where("name <> ''").distinct()


def referenced(rows: DataFrame, label: str, names: DataFrame, to: str) -> DataFrame:
    """rows with ``to``: the one cluster of the row's fragment that has the label, else the one of its source, else null."""
    one = lambda keys, c: names.groupBy(*keys).agg(F.count_distinct("cluster_key").alias("n"), F.min("cluster_key").alias(c)).where("n = 1").drop("n")
    keyed = rows.withColumn("name", fold_label(label))
    near = keyed.join(one(["source_id", "fragment_index", "name"], "local"), ["source_id", "fragment_index", "name"], "left")
    return near.join(one(["source_id", "name"], "everywhere"), ["source_id", "name"], "left").withColumn(to, F.coalesce("local", "everywhere")).drop("name", "local", "everywhere")


# --- reduction -----------------------------------------------------------------------------------------------------------


def terms_of(fragments: Fragments, keyed: DataFrame | None = None, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["terms"]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clustered draft rows, terms, their evidence)."""
    if keyed is None:
        keyed = fragments.terms.sparkSession.createDataFrame([], "source_id string, key string, cluster_key string")
    rows = cut(clustered(fragments.terms, keyed))
    kept = cut(resolved_terms(fragments.terms, keyed, least, budget))
    alive = rows.join(kept.select("source_id", "cluster_key"), ["source_id", "cluster_key"], "left_semi")
    return rows, *_with_evidence(alive, kept.drop("n_evidence"), ["source_id", "cluster_key"], "term", ["label_key", "kind", "definition"])


def _end(terms: DataFrame, c: str) -> DataFrame:
    return terms.select("source_id", F.col("cluster_key").alias(f"{c}_cluster"), F.col("claim_id").alias(f"{c}_id"))


def links_of(rows: DataFrame, terms: DataFrame, names: DataFrame) -> DataFrame:
    """(source_id, claim_id, link, other_id): stated links between terms with their inverses."""
    none = F.array().cast("array<string>")
    sides = F.array(*[F.struct(F.lit(n).alias("link"), F.lit(i).alias("inverse"), F.coalesce(c, none).alias("labels")) for n, i, c in (("broader", "narrower", "broader_labels"), ("narrower", "broader", "narrower_labels"), ("related", "related", "related_labels"))])
    stated = rows.select("source_id", "fragment_index", F.col("cluster_key").alias("from_cluster"), F.explode(sides).alias("s")).select("source_id", "fragment_index", "from_cluster", "s.link", "s.inverse", F.explode("s.labels").alias("other")).distinct()
    ends = referenced(stated, "other", names, "to_cluster").where("to_cluster is not null").join(_end(terms, "from"), ["source_id", "from_cluster"]).join(_end(terms, "to"), ["source_id", "to_cluster"]).where("from_id <> to_id")
    return cut(ends.select("source_id", F.col("from_id").alias("claim_id"), "link", F.col("to_id").alias("other_id")).unionByName(ends.select("source_id", F.col("to_id").alias("claim_id"), F.col("inverse").alias("link"), F.col("from_id").alias("other_id"))).distinct())


def relations_of(drafts: DataFrame, terms: DataFrame, names: DataFrame, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["relations"]) -> tuple[DataFrame, DataFrame]:
    """(relations between terms, their evidence); a relation with an end that means no term, or several, is left out."""
    r, _ = quarantine(drafts.where("source_id is not null").withColumn("confidence", trusted("confidence")))
    r = referenced(referenced(r, "subject_label", names, "subject_cluster"), "object_label", names, "object_cluster").where("subject_cluster is not null and object_cluster is not null")
    r = cut(r.join(_end(terms, "subject"), ["source_id", "subject_cluster"]).join(_end(terms, "object"), ["source_id", "object_cluster"]).withColumn("predicate_key", fold_label("predicate")).withColumn("qualifier_key", qualifier_key()).where("predicate_key <> ''"))
    keys = ["source_id", "subject_id", "predicate_key", "object_id", "qualifier_key"]
    text = F.trim("predicate")
    best = r.groupBy(*keys).agg(F.max("confidence").alias("confidence"), F.min_by(text, F.struct(F.length(text), F.lower(text), text)).alias("predicate")).where(F.col("confidence") >= least)
    found, proof = _with_evidence(r, best, keys, "relation", keys[1:])
    return cut(_salient(found, "predicate", budget)), proof


def axioms_of(drafts: DataFrame, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["axioms"]) -> tuple[DataFrame, DataFrame]:
    """(axioms, their evidence): equal statements under equal modality, status, attribution, conditions and exceptions as one."""
    a, _ = quarantine(drafts.where("source_id is not null").withColumn("confidence", trusted("confidence")))
    a = a.withColumns({"statement_key": fold_label("statement"), "attribution_key": F.coalesce(fold_label("attribution"), F.lit("")), "conditions_key": _list_key("conditions"), "exceptions_key": _list_key("exceptions")}).where("statement_key <> ''")
    keys = ["source_id", "statement_key", "modality", "epistemic_status", "attribution_key", "conditions_key", "exceptions_key"]
    a = cut(a.fillna("", ["modality", "epistemic_status"]))
    order = F.struct(-F.coalesce("confidence", F.lit(-1.0)), -F.size("evidence"), F.col("statement"), F.col("fragment_index"), F.col("item_index"))
    best = a.groupBy(*keys).agg(F.max("confidence").alias("confidence"), F.min_by(F.struct("statement", "attribution", "conditions", "exceptions"), order).alias("w")).where(F.col("confidence") >= least).select(*keys, "confidence", "w.*")
    found, proof = _with_evidence(a, best, keys, "axiom", keys[1:])
    return cut(_salient(found, "statement", budget)), proof


def models_of(drafts: DataFrame, least: float = LEAST_CONFIDENCE, budget: int = BUDGETS["mental_models"]) -> tuple[DataFrame, DataFrame]:
    """(mental models, their evidence): equal names as one, with the union of each list."""
    m, _ = quarantine(drafts.where("source_id is not null").withColumn("confidence", trusted("confidence")))
    m = cut(m.withColumn("name_key", fold_label("name")).where("name_key <> ''"))
    keys = ["source_id", "name_key"]
    conf = -F.coalesce("confidence", F.lit(-1.0))
    best = m.groupBy(*keys).agg(F.max("confidence").alias("confidence"), F.min_by(F.trim("name"), F.struct(conf, F.trim("name"))).alias("name"), F.min_by(F.trim("purpose"), F.struct(conf, -F.length(F.trim("purpose")), F.trim("purpose"))).alias("purpose")).where(F.col("confidence") >= least)
    for c in LISTS:
        best = best.join(ordered_unique(m, keys, c, ["fragment_index", "item_index"]), keys, "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    found, proof = _with_evidence(m, best, keys, "model", keys[1:] + ["purpose"])
    return cut(_salient(found, "name", budget)), proof


def build(fragments: Fragments, keyed: DataFrame | None = None, least: float = LEAST_CONFIDENCE, budgets: dict[str, int] = BUDGETS) -> Ontology:
    """The ontology of every source; ``keyed`` is the first result of resolution.resolve(), without it equal labels are one term."""
    rows, terms, proof_t = terms_of(fragments, keyed, least, budgets["terms"])
    names = cut(named_clusters(rows))
    relations, proof_r = relations_of(fragments.relations, terms, names, least, budgets["relations"])
    axioms, proof_a = axioms_of(fragments.axioms, least, budgets["axioms"])
    models, proof_m = models_of(fragments.models, least, budgets["mental_models"])
    final = terms.select("source_id", "claim_id").unionByName(relations.select("source_id", "claim_id")).unionByName(axioms.select("source_id", "claim_id")).unionByName(models.select("source_id", "claim_id"))
    evidence = cut(proof_t.unionByName(proof_r).unionByName(proof_a).unionByName(proof_m).join(final, ["source_id", "claim_id"], "left_semi"))
    asked = fragments.questions.where("source_id is not null").select("source_id", collapse("question").alias("question")).where("question <> ''").distinct()
    return Ontology(terms, links_of(rows, terms, names), relations, axioms, models, contradictions(axioms), evidence, abstracts(terms, axioms, models), grounded_questions(asked, evidence))


def signature(statement: Column) -> tuple[Column, Column]:
    """(the statement's words without negations and plural endings, whether it is negated)."""
    words = F.split(fold_label(statement), " ")
    base = F.filter(words, lambda w: ~w.isin("no", "not", "never", "cannot", "do", "does", "did"))
    stem = F.transform(base, lambda w: F.when((F.length(w) > 3) & w.endswith("s") & ~(w.endswith("ss") | w.endswith("is") | w.endswith("us")), F.left(w, F.length(w) - 1)).otherwise(w))
    return F.array_join(stem, " "), F.exists(words, lambda w: w.isin("no", "not", "never", "cannot"))


def contradictions(axioms: DataFrame) -> DataFrame:
    """(source_id, conflict_id, signature, claim_ids, kind): axioms of a source that differ by a negation only; bounded by the budget of axioms."""
    sign, negated = signature(F.col("statement"))
    grouped = axioms.select("source_id", sign.alias("signature"), negated.alias("negated"), "claim_id", "modality").groupBy("source_id", "signature")
    found = grouped.agg(F.max("negated").alias("some"), F.min("negated").alias("all"), F.array_sort(F.collect_set("claim_id")).alias("claim_ids"), F.max(F.col("modality") == "causal").alias("causal")).where("some and not all")
    return found.select("source_id", claim_id("conflict", "source_id", "signature", F.array_join("claim_ids", SEPARATOR)).alias("conflict_id"), "signature", "claim_ids", F.when(F.col("causal"), "causal").otherwise("empirical").alias("kind"))


def abstracts(terms: DataFrame, axioms: DataFrame, models: DataFrame, size: int = ABSTRACT_SIZE) -> DataFrame:
    """(source_id, abstract, support_ids): the most salient terms, axioms and models of each source as one text."""
    titled = lambda name, body: F.when(~is_blank(body), F.concat_ws(": ", name, F.trim(body))).otherwise(F.col(name))
    part = lambda df, text, by: df.select("source_id", "claim_id", "confidence", "n_evidence", fold_label(by).alias("by"), text.alias("text"))
    every = part(axioms, F.trim("statement"), "statement").unionByName(part(terms, titled("label", "definition"), "label")).unionByName(part(models, titled("name", "purpose"), "name")).where("text <> ''")
    rank = F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("confidence"), F.desc("n_evidence"), "by", "claim_id"))
    top = every.withColumn("rank", rank).where(F.col("rank") <= size).groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text", "claim_id"))).alias("parts"))
    return top.select("source_id", F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n").alias("abstract"), F.transform("parts", lambda p: p["claim_id"]).alias("support_ids"))


def grounded_questions(asked: DataFrame, evidence: DataFrame) -> DataFrame:
    """(source_id, question): open questions that stand in a verified quotation of their source.

    A question meets only quotations that hold its longest inner word; one
    without an inner word meets all of its source.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    inner = F.slice(words("question"), 2, F.greatest(F.size(words("question")) - 2, F.lit(0)))
    q = asked.withColumn("anchor", F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"])
    quotes = evidence.select("source_id", "quote").where("quote is not null").distinct()
    by_word = quotes.select("source_id", "quote", F.explode(F.array_distinct(words("quote"))).alias("anchor"))
    anchored = q.where("anchor is not null").join(by_word, ["source_id", "anchor"]).where(F.contains("quote", "question"))
    short = q.where("anchor is null").join(quotes, "source_id").where(F.contains("quote", "question"))
    return anchored.select("source_id", "question").unionByName(short.select("source_id", "question")).distinct()


@F.pandas_udf(T.BooleanType())
def _safe_rule(s: pd.Series) -> pd.Series:
    return s.map(datalog_rule_is_safe)


def formal_problems(axioms: DataFrame) -> DataFrame:
    """(claim_id, problem) of axioms (claim_id, formalism, formal_expression) whose expression doesn't fit their formalism.

    Without a formalism there is no expression; Datalog rules are well formed and
    range restricted; no other formalism has a checker, so none is accepted.
    """
    some = ~is_blank("formal_expression")
    rules = axioms.withColumn("safe", F.when((F.col("formalism") == "datalog") & some, _safe_rule("formal_expression")))
    problem = (
        F.when(F.coalesce(F.col("formalism"), F.lit("none")) == "none", F.when(F.col("formal_expression").isNotNull(), "expression_without_formalism"))
        .when(~some, "missing_expression")
        .when(F.col("formalism") != "datalog", "unsupported_formalism")
        .when(~F.col("safe"), "unsafe_rule")
    )
    return rules.select("claim_id", problem.alias("problem")).where("problem is not null")


def broken_references(o: Ontology) -> DataFrame:
    """(source_id, claim_id, problem): what a canonical ontology must not hold."""
    ids = o.terms.select("source_id", "claim_id").unionByName(o.relations.select("source_id", "claim_id")).unionByName(o.axioms.select("source_id", "claim_id")).unionByName(o.models.select("source_id", "claim_id"))
    twice = ids.groupBy("claim_id").agg(F.count("*").alias("n"), F.min("source_id").alias("source_id")).where("n > 1").select("source_id", "claim_id", F.lit("duplicate_id").alias("problem"))
    t = o.terms.select("source_id", "claim_id")
    gone = lambda df, at, problem: df.join(t.withColumnRenamed("claim_id", at), ["source_id", at], "left_anti").select("source_id", "claim_id", F.lit(problem).alias("problem"))
    selfish = o.links.where("claim_id = other_id").select("source_id", "claim_id", F.lit("self_reference").alias("problem"))
    bare = ids.join(o.evidence.select("source_id", "claim_id").distinct(), ["source_id", "claim_id"], "left_anti").select("source_id", "claim_id", F.lit("no_evidence").alias("problem"))
    conflict = o.conflicts.select("source_id", F.col("conflict_id").alias("owner"), F.explode("claim_ids").alias("claim_id")).join(ids, ["source_id", "claim_id"], "left_anti").select("source_id", F.col("owner").alias("claim_id"), F.lit("dangling_conflict").alias("problem"))
    support = o.abstracts.select("source_id", F.explode("support_ids").alias("claim_id")).join(ids, ["source_id", "claim_id"], "left_anti").select("source_id", "claim_id", F.lit("dangling_support").alias("problem"))
    foreign = o.evidence.where("evidence_source is null or evidence_source <> source_id").select("source_id", "claim_id", F.lit("foreign_evidence").alias("problem"))
    return twice.unionByName(gone(o.links, "other_id", "dangling_link")).unionByName(gone(o.relations, "subject_id", "dangling_subject")).unionByName(gone(o.relations, "object_id", "dangling_object")).unionByName(selfish).unionByName(bare).unionByName(conflict).unionByName(support).unionByName(foreign).distinct()
