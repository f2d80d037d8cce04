"""The engine's pipelines: files to chunks, chunks to ontologies, ontologies to a frame, and answers from what was published.

Every step has a key of its inputs and settings; a bundle of the same key that
is whole is used as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.config import Settings
from claimspark.operators import chunking, claims, evidence_query, extraction, frame, grounding, resolution
from claimspark.sources import bundles, readers
from claimspark.sources.writers import cache_key

CHUNK_TABLES = ("sources", "documents", "chunks", "rejected")
SUPPORTED = ", ".join(sorted(readers.ROUTES))


def _settings_key(s: Settings, *names: str) -> dict:
    return {n: getattr(s, n) for n in names}


def identity_of(gateway: object | None) -> str:
    """What a gateway calls itself; one without a name never shares an entry."""
    if gateway is None:
        return "offline"
    return str(getattr(gateway, "identity", "") or f"anonymous-{id(gateway)}")


def ingest(spark: SparkSession, path: str, target: str, settings: Settings = Settings(), converter: Callable = readers.convert, chunker: Callable | None = None) -> dict:
    """Files under a path as a bundle of sources, documents and chunks; files that no converter takes are rejected, not fatal."""
    files = readers.read_files(spark, path)
    key = cache_key(step="ingest", content=bundles.digest(files.select("path", "content_sha256")), converter=getattr(converter, "__qualname__", repr(converter)), chunker=repr(chunker), **_settings_key(settings, "max_tokens", "overlap_tokens"))
    if bundles.valid(spark, target, key, CHUNK_TABLES):
        return bundles.manifest_of(spark, target)
    converted = readers.convert_files(files, converter)
    docs = converted.where("error is null").select(F.col("source_id").alias("conversion_id"), "source_id", "title", "markdown", "backend")
    rejected = converted.where("error is not null").select("path", "extension", F.concat_ws("; ", "error", F.when(F.col("backend").isNull(), F.lit(f"supported: {SUPPORTED}"))).alias("error"))
    chunks = chunking.chunk_documents(docs, max_tokens=settings.max_tokens, overlap=settings.overlap_tokens, chunker=chunker)
    return bundles.publish_tables(spark, target, {"sources": converted.drop("markdown", "error"), "documents": docs, "chunks": chunks, "rejected": rejected}, key, kind="chunks")


def checked_chunks(spark: SparkSession, target: str) -> DataFrame:
    """The chunks of a bundle whose digests hold and whose sources are all known."""
    bad = bundles.damaged(spark, target, CHUNK_TABLES)
    if bad:
        raise ValueError(f"{target}: {bad}")
    chunks = bundles.table(spark, target, "chunks")
    foreign = chunking.foreign(chunks, bundles.table(spark, target, "sources"))
    if not foreign.isEmpty():
        raise ValueError(f"chunks of an unknown source: {foreign.first()['source_id']}")
    return chunks


def extract(spark: SparkSession, chunks: DataFrame, target: str, settings: Settings = Settings(), adjudicator: Callable | None = None, cap: int | None = extraction.SENTENCE_CAP) -> dict:
    """Chunks to a published ontology: extract, resolve, reduce, check, publish."""
    budgets = {"terms": settings.budget_terms, "relations": settings.budget_relations, "axioms": settings.budget_axioms, "mental_models": settings.budget_models}
    key = cache_key(
        step="extract", content=bundles.digest(chunks.select("chunk_id", "source_id", "ordinal", "text")), schema=bundles.schema_key(chunks), adjudicator=identity_of(adjudicator), cap=cap, budgets=budgets,
        **_settings_key(settings, "minimum_confidence", "lexical_threshold", "ambiguous_threshold"),
    )
    if bundles.valid(spark, target, key, bundles.ONTOLOGY_TABLES):
        return bundles.manifest_of(spark, target)
    found = extraction.fragments(chunks, cap)
    keyed, decisions = resolution.resolve(found.terms, settings.lexical_threshold, settings.ambiguous_threshold, adjudicator)
    o = claims.build(found, keyed, settings.minimum_confidence, budgets)
    manifest = bundles.publish_ontology(spark, target, o, key)
    bundles.publish_tables(spark, f"{target.rstrip('/')}/resolution", {"clusters": keyed, "decisions": decisions}, key, kind="resolution")
    return manifest


def integrate(ontologies: list[claims.Ontology]) -> claims.Ontology:
    """Several ontologies side by side; sources stay apart."""
    if not ontologies:
        raise ValueError("at least one ontology is required")
    union = lambda n: reduce(lambda a, b: a.unionByName(b), [getattr(o, n) for o in ontologies])
    return claims.Ontology(**{n: union(n) for n in bundles.ONTOLOGY_TABLES})


def synthesize(spark: SparkSession, sources: list[str], target: str, name: str, objective: str, settings: Settings = Settings(), critic: Callable | None = None) -> dict:
    """Published ontologies to a reviewed and published frame."""
    key = cache_key(step="synthesize", sources=[(bundles.manifest_of(spark, s) or {}).get("tables") for s in sources], name=name, objective=objective, critic=identity_of(critic), repairs=settings.critic_repairs)
    if bundles.valid(spark, target, key, bundles.FRAME_TABLES):
        return bundles.manifest_of(spark, target)
    o = integrate([bundles.load_ontology(spark, s) for s in sources])
    f, findings, approved = frame.review(frame.compose(o, name, objective), o, max_repairs=settings.critic_repairs, critic=critic)
    return bundles.publish_frame(spark, target, f, findings, approved, o.conflicts, key)


def validate(spark: SparkSession, target: str) -> dict:
    """{'damaged': names, 'problems': number of broken shapes and references} of a bundle."""
    bad = bundles.damaged(spark, target)
    kind = (bundles.manifest_of(spark, target) or {}).get("kind")
    problems = bundles.conformance(bundles.load_ontology(spark, target)).count() if kind == "ontology" and not bad else 0
    return {"kind": kind, "damaged": bad, "problems": problems}


def answer(spark: SparkSession, target: str, question: str) -> dict:
    """The best quotations for a question, their claims, and the conflicts of everything that matched."""
    o = bundles.load_ontology(spark, target)
    rows = o.evidence.where("quote is not null").select(F.col("evidence_source").alias("source_id"), "chunk_id", "quote_sha256", "quote", "claim_id")
    index = rows.groupBy("source_id", "chunk_id", "quote_sha256").agg(F.min("quote").alias("quote"), F.count_distinct("claim_id").alias("n_claims"))
    shown = evidence_query.ask(index, question)
    cited = shown.join(rows.select("source_id", "chunk_id", "quote_sha256", "claim_id").distinct(), ["source_id", "chunk_id", "quote_sha256"]).select("source_id", "chunk_id", "quote", "score", "claim_id").orderBy(F.desc("score"), "source_id", "chunk_id", "claim_id")
    matched = evidence_query.retrieve(index, question).join(rows.select("source_id", "chunk_id", "quote_sha256", "claim_id"), ["source_id", "chunk_id", "quote_sha256"]).select("source_id", "claim_id").distinct()
    sides = o.conflicts.select("source_id", "conflict_id", "signature", "kind", F.explode("claim_ids").alias("claim_id"))
    conflicts = sides.join(matched, ["source_id", "claim_id"], "left_semi").select("source_id", "conflict_id", "signature", "kind").distinct().orderBy("source_id", "conflict_id")
    as_dicts = lambda df: [r.asDict() for r in df.collect()]
    return {"question": question, "evidence": as_dicts(cited), "conflicts": as_dicts(conflicts)}


def grounded(terms: DataFrame) -> DataFrame:
    """(term_id) of rows that aren't fully grounded: empty where all are."""
    return grounding.fully_grounded(terms).where("not grounded").select("term_id")
