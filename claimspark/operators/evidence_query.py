"""Read API over reduced claims: look up, trace, retrieve and ask.

Every answer is a DataFrame over whole tables; a limit stands only where the
answer is a top-k report.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.functions.columns import fold_label
from claimspark.operators.reduction import drafts, merged_evidence

ANSWER_SIZE, PHRASE_BONUS = 10, 0.25


def _query_words(query: str) -> list[str]:
    if not query or not query.strip():
        raise ValueError("the query is empty")
    return sorted(set(re.findall(r"[a-z0-9]+", query.casefold())))


def _quotations(terms: DataFrame) -> DataFrame:
    rows = drafts(terms)
    return rows.select("label_key", F.explode("evidence").alias("e")).where("e.quote is not null").select("label_key", F.col("e.source_id").alias("source_id"), "e.chunk_id", "e.quote_sha256", "e.quote")


def evidence_index(terms: DataFrame) -> DataFrame:
    """(source_id, chunk_id, quote_sha256, quote, n_claims): distinct verified quotations and how many labels each supports."""
    return _quotations(terms).groupBy("source_id", "chunk_id", "quote_sha256").agg(F.min("quote").alias("quote"), F.count_distinct("label_key").alias("n_claims"))


def evidence_claims(terms: DataFrame) -> DataFrame:
    """(source_id, chunk_id, quote_sha256, label_key): every label that a quotation supports, one row each."""
    return _quotations(terms).select("source_id", "chunk_id", "quote_sha256", "label_key").distinct()


def retrieve(index: DataFrame, query: str, source_ids: list[str] | None = None) -> DataFrame:
    """index rows that share a word with the query, with their score: shared part of the query's words plus a phrase bonus, at most 1."""
    words = _query_words(query)
    rows = index.where(F.col("source_id").isin(source_ids)) if source_ids else index
    own = F.array_distinct(F.regexp_extract_all(F.lower("quote"), F.lit("[a-z0-9]+"), F.lit(0)))
    shared = F.size(F.array_intersect(own, F.array(*map(F.lit, words))))
    bonus = F.when(F.contains(F.lower("quote"), F.lit(query.casefold())), PHRASE_BONUS).otherwise(0.0)
    score = F.round(F.least(F.lit(1.0), shared / max(1, len(words)) + bonus), 4)
    return rows.where(shared > 0).withColumn("score", score)


def lookup(reduced: DataFrame, label: str) -> DataFrame:
    """Terms with this label; ambiguous says whether several sources have it."""
    hits = reduced.where(F.col("label_key") == fold_label(F.lit(label)))
    several = F.count("*").over(W.partitionBy("label_key")) > 1
    return hits.select("source_id", "label_key", "label", "kind", "definition", "confidence", several.alias("ambiguous"))


def trace(terms: DataFrame, label: str) -> DataFrame:
    """(source_id, label_key, chunk_id, quote_sha256, quote): the verified evidence of a label in every source."""
    rows = drafts(terms).where(F.col("label_key") == fold_label(F.lit(label)))
    return merged_evidence(rows, ["source_id", "label_key"]).select("source_id", "label_key", "chunk_id", "quote_sha256", "quote")


def neighbourhood(links: DataFrame, label: str) -> DataFrame:
    """(source_id, label_key): the concept and all concepts one link away."""
    key = fold_label(F.lit(label))
    at = links.where((F.col("label_key") == key) | (F.col("other_key") == key))
    return at.select("source_id", F.explode(F.array("label_key", "other_key")).alias("label_key")).distinct()


def conflicts_of(contradictions: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """Contradictions of a source whose signature names the concept or a neighbour of it."""
    near = neighbourhood(links, label)
    return contradictions.join(near, "source_id").where(F.contains(F.concat(F.lit(" "), F.col("signature"), F.lit(" ")), F.concat(F.lit(" "), F.col("label_key"), F.lit(" ")))).select(*contradictions.columns).distinct()


def ask(index: DataFrame, query: str, size: int = ANSWER_SIZE) -> DataFrame:
    """The ``size`` best quotations for a question (a top-k report); see ask_claims() and ask_conflicts() for the rest of the answer."""
    return retrieve(index, query).orderBy(F.desc("score"), "source_id", "chunk_id", "quote_sha256").limit(size)


def ask_claims(index: DataFrame, claims: DataFrame, query: str, size: int = ANSWER_SIZE) -> DataFrame:
    """(source_id, chunk_id, quote_sha256, score, label_key): the citations of the displayed quotations, one row for each claim."""
    shown = ask(index, query, size).select("source_id", "chunk_id", "quote_sha256", "score")
    return shown.join(claims, ["source_id", "chunk_id", "quote_sha256"])


def ask_conflicts(index: DataFrame, claims: DataFrame, contradictions: DataFrame, links: DataFrame, query: str) -> DataFrame:
    """Contradictions of a source whose signature names a claim of any matched quotation, displayed or not, or a neighbour of it."""
    matched = retrieve(index, query).select("source_id", "chunk_id", "quote_sha256").join(claims, ["source_id", "chunk_id", "quote_sha256"]).select("source_id", "label_key").distinct()
    both = links.select("source_id", "label_key", "other_key").unionByName(links.select("source_id", F.col("other_key").alias("label_key"), F.col("label_key").alias("other_key")))
    around = both.join(matched, ["source_id", "label_key"]).select("source_id", F.col("other_key").alias("label_key"))
    near = matched.unionByName(around).distinct()
    return contradictions.join(near, "source_id").where(F.contains(F.concat(F.lit(" "), F.col("signature"), F.lit(" ")), F.concat(F.lit(" "), F.col("label_key"), F.lit(" ")))).select(*contradictions.columns).distinct()


def mental_model(models: DataFrame, name: str) -> DataFrame:
    """Reduced models with this name; ambiguous says whether several sources have it."""
    hits = models.where(F.col("name_key") == fold_label(F.lit(name)))
    return hits.withColumn("ambiguous", F.count("*").over(W.partitionBy("name_key")) > 1)
