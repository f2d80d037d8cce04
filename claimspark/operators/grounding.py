"""Grounding: a quotation counts only if it is an exact substring of its own chunk.

Chunks are joined on chunk_id first and searched second, so no text meets a
quotation of another chunk.  Null quotes and unknown chunks are never verified;
repeated rows count once; a chunk that stands in several versions verifies a
quote if any of them holds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions.columns import collapse, is_blank


def chunk_texts(chunks: DataFrame) -> DataFrame:
    return chunks.where("chunk_id is not null and text is not null").select("chunk_id", "text").distinct()


def verify(evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """(evidence_id, status): exact, whitespace, hash_mismatch, absent, unknown_chunk or empty."""
    rows = evidence.select("evidence_id", "chunk_id", "quote", "quote_sha256").distinct()
    hits = rows.join(chunk_texts(chunks), "chunk_id").groupBy("evidence_id").agg(
        F.max(F.contains("text", "quote")).alias("exact"), F.max(F.contains(collapse("text"), collapse("quote"))).alias("loose")
    )
    given = ~is_blank("quote_sha256")
    status = (
        F.when(is_blank("quote"), "empty")
        .when(given & (F.lower("quote_sha256") != F.sha2("quote", 256)), "hash_mismatch")
        .when(F.col("exact").isNull() & F.col("loose").isNull(), "unknown_chunk")
        .when(F.col("exact"), "exact")
        .when(F.col("loose"), "whitespace")
        .otherwise("absent")
    )
    return rows.join(hits, "evidence_id", "left").select("evidence_id", status.alias("status"))


def grounded_terms(terms: DataFrame, chunks: DataFrame) -> DataFrame:
    """(term_id, quote, chunk_id, source_id, quote_sha256): each distinct exact quote of a term, provenance taken from the chunk."""
    each = terms.select("term_id", F.explode("evidence").alias("e")).select("term_id", "e.chunk_id", "e.quote").where("quote is not null and quote <> ''").distinct()
    texts = chunks.where("chunk_id is not null and text is not null").select("chunk_id", "source_id", "text").distinct()
    return each.join(texts, "chunk_id").where(F.contains("text", "quote")).select("term_id", "chunk_id", "source_id", "quote", F.sha2("quote", 256).alias("quote_sha256")).distinct()


def evidence_violations(evidence: DataFrame) -> DataFrame:
    """(evidence_id, violation) of rows that break the evidence contract."""
    rows = evidence.distinct()
    checks = F.array_compact(
        F.array(
            F.when(is_blank("source_id"), "blank_source"),
            F.when(is_blank("chunk_id"), "blank_chunk"),
            F.when(F.col("page_end") < F.col("page_start"), "pages_reversed"),
            F.when(F.col("page_start") < 1, "page_before_first"),
            F.when(F.col("verified") & ~F.coalesce(F.col("quote_sha256") == F.sha2("quote", 256), F.lit(False)), "verified_hash_mismatch"),
        )
    )
    return rows.select("evidence_id", F.explode(checks).alias("violation"))


def fully_grounded(terms: DataFrame) -> DataFrame:
    """(term_id, grounded): all evidence verified and at least one."""
    some = F.size("evidence") > 0
    return terms.select("term_id", F.coalesce(some & F.forall("evidence", lambda e: F.coalesce(e["verified"], F.lit(False))), F.lit(False)).alias("grounded")).distinct()


class Ungrounded(ValueError):
    """Evidence that its chunk doesn't hold."""


def ground(evidence: DataFrame, chunks: DataFrame, strict: bool = False, loose: bool = False) -> DataFrame:
    """evidence rows that their chunk verifies, exactly or (loose) with white space set aside; strict: any other row is an error."""
    status = verify(evidence, chunks)
    good = ("exact", "whitespace") if loose else ("exact",)
    if strict:
        bad = status.where(~F.col("status").isin(*good))
        if not bad.isEmpty():
            worst = bad.first()
            raise Ungrounded(f"evidence {worst['evidence_id']}: {worst['status']}")
    return evidence.distinct().join(status.where(F.col("status").isin(*good)).select("evidence_id"), "evidence_id", "left_semi")
