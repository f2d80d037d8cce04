"""Queries of the core operators over the whole tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators import alignment, chunking, claims, evidence_query, extraction, frame, graph, grounding, layout, reduction, resolution
from claimspark.plans import planted
from claimspark.runtime import cut, load
from claimspark.sources import readers

QUESTION = "Which audit qualifies the consensus?"
CONCEPT = "Vertical Relevance Model"
#: A concept of the planted rows that has a neighbour and a conflict.
CONTESTED = "Shared Trust"
MODEL_NAME = "Review Cycle Model"
OBJECTIVE = "Compare what the sources claim and keep their conflicts visible."


def source_routes(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "sources").distinct().select("source_id", readers.extension_of("stored_path").alias("extension"), readers.route("stored_path").alias("r")).select("source_id", "extension", "r.backend", "r.media_type")


def document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("content_sha256"), F.octet_length("text").alias("size_bytes"))


def duplicate_texts(spark: SparkSession, d: str) -> DataFrame:
    return document_fingerprints(spark, d).groupBy("content_sha256").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc_id")).where("n_docs > 1")


def chunk_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return chunking.checked_counts(load(spark, d, "chunks"))


def chunk_split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return chunking.split_sizes(load(spark, d, "chunks"))


def source_profiles(spark: SparkSession, d: str) -> DataFrame:
    return chunking.profiles(load(spark, d, "chunks"))


def heading_counts(spark: SparkSession, d: str) -> DataFrame:
    return chunking.heading_counts(load(spark, d, "chunks"))


def document_blocks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.document_blocks(load(spark, d, "converted_documents"))


def heading_groups(spark: SparkSession, d: str) -> DataFrame:
    return chunking.heading_groups(document_blocks(spark, d))


def layout_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.chunk_documents(load(spark, d, "converted_documents"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return extraction.sentences(load(spark, d, "chunks"), cap=None)


def chunk_sentences(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d).select("chunk_id", "sentence_no", "sentence")


def definition_statements(spark: SparkSession, d: str) -> DataFrame:
    return extraction.definitions(_sentences(spark, d)).select("chunk_id", "sentence_no", "label", "definition")


def relation_statements(spark: SparkSession, d: str) -> DataFrame:
    return extraction.relations(_sentences(spark, d)).select("chunk_id", "sentence_no", "subject", "predicate", "object")


def named_models(spark: SparkSession, d: str) -> DataFrame:
    return extraction.models(_sentences(spark, d)).select("chunk_id", "sentence_no", "name", "purpose")


def extracted_terms(spark: SparkSession, d: str) -> DataFrame:
    return extraction.terms(_sentences(spark, d)).select("chunk_id", "label", "definition", F.sha2("quote", 256).alias("quote_sha256"))


def _axioms(spark: SparkSession, d: str) -> DataFrame:
    return extraction.axioms(_sentences(spark, d))


def body_texts(spark: SparkSession, d: str) -> DataFrame:
    chunks = load(spark, d, "chunks").where("chunk_id is not null and text is not null").select("chunk_id", "heading_path", "text").distinct()
    return extraction.without_heading_prefix(chunks).select("chunk_id", F.sha2("text", 256).alias("text_sha256"))


def known_terms(spark: SparkSession, d: str) -> DataFrame:
    return extraction.known_terms(extraction.terms(_sentences(spark, d)))


def reduced_relations(spark: SparkSession, d: str) -> DataFrame:
    return extraction.reduced_relations(extraction.relations(_sentences(spark, d)), known_terms(spark, d))


def reduced_models(spark: SparkSession, d: str) -> DataFrame:
    return extraction.reduced_models(extraction.models(_sentences(spark, d)))


def reduced_axioms(spark: SparkSession, d: str) -> DataFrame:
    return extraction.reduced_axioms(_axioms(spark, d))


def _all_axioms(spark: SparkSession, d: str) -> DataFrame:
    return extraction.axioms(extraction.sentences(planted.with_chunks(spark, load(spark, d, "chunks")), cap=None))


def axiom_contradictions(spark: SparkSession, d: str) -> DataFrame:
    return extraction.contradictions(extraction.reduced_axioms(_all_axioms(spark, d)))


def opposed_statements(spark: SparkSession, d: str) -> DataFrame:
    return alignment.opposed_statements(_all_axioms(spark, d).select("statement", "modality"))


def quote_status(spark: SparkSession, d: str) -> DataFrame:
    return grounding.verify(load(spark, d, "evidence"), load(spark, d, "chunks"))


def evidence_violations(spark: SparkSession, d: str) -> DataFrame:
    return grounding.evidence_violations(load(spark, d, "evidence"))


def grounded_quotes(spark: SparkSession, d: str) -> DataFrame:
    return grounding.grounded_terms(load(spark, d, "draft_terms"), load(spark, d, "chunks"))


def term_grounding(spark: SparkSession, d: str) -> DataFrame:
    return grounding.fully_grounded(load(spark, d, "draft_terms"))


def _drafts(spark: SparkSession, d: str) -> DataFrame:
    return reduction.drafts(load(spark, d, "draft_terms"))


def evidence_counts(spark: SparkSession, d: str) -> DataFrame:
    return reduction.evidence_counts(_drafts(spark, d), ["source_id", "label_key"])


def canonical_labels(spark: SparkSession, d: str) -> DataFrame:
    return reduction.canonical_labels(_drafts(spark, d))


def best_definitions(spark: SparkSession, d: str) -> DataFrame:
    return reduction.best_definitions(_drafts(spark, d))


def best_kinds(spark: SparkSession, d: str) -> DataFrame:
    return reduction.best_kinds(_drafts(spark, d))


def salient_terms(spark: SparkSession, d: str) -> DataFrame:
    return reduction.reduced_terms(load(spark, d, "draft_terms"))


def source_abstracts(spark: SparkSession, d: str) -> DataFrame:
    return reduction.abstracts(salient_terms(spark, d))


def term_links(spark: SparkSession, d: str) -> DataFrame:
    return reduction.term_links(load(spark, d, "draft_terms"), salient_terms(spark, d))


def dangling_labels(spark: SparkSession, d: str) -> DataFrame:
    return reduction.dangling_labels(load(spark, d, "draft_terms"))


def similar_names(spark: SparkSession, d: str) -> DataFrame:
    occ = resolution.occurrences(load(spark, d, "draft_terms"))
    return resolution.similar_names(occ.select("source_id", F.explode("names").alias("name")).distinct())


def resolved_occurrences(spark: SparkSession, d: str) -> DataFrame:
    return resolution.resolved(load(spark, d, "draft_terms"))[0]


def resolution_audit(spark: SparkSession, d: str) -> DataFrame:
    return resolution.resolve(load(spark, d, "draft_terms"))[1]


def resolved_clusters(spark: SparkSession, d: str) -> DataFrame:
    terms = load(spark, d, "draft_terms")
    occ = cut(resolution.occurrences(terms))
    return resolution.clusters(terms, resolution.resolved(terms, occ=occ)[0], occ)


def resolved_terms(spark: SparkSession, d: str) -> DataFrame:
    terms = load(spark, d, "draft_terms")
    return reduction.resolved_terms(terms, resolution.resolved(terms)[0])


def resolved_links(spark: SparkSession, d: str) -> DataFrame:
    terms = load(spark, d, "draft_terms")
    keyed = resolution.resolved(terms)[0]
    rows = cut(reduction.clustered(terms, keyed))
    return reduction.resolved_links(terms, keyed, reduction.resolved_terms(terms, keyed, rows=rows), rows)


def concept_classes(spark: SparkSession, d: str) -> DataFrame:
    return alignment.classes(salient_terms(spark, d))


def class_membership(spark: SparkSession, d: str) -> DataFrame:
    return alignment.membership(salient_terms(spark, d))


def alignment_features(spark: SparkSession, d: str) -> DataFrame:
    return alignment.features(cut(concept_classes(spark, d))).drop("left_definition", "right_definition", "left_folded", "right_folded")


def concept_mappings(spark: SparkSession, d: str) -> DataFrame:
    rows = cut(_drafts(spark, d))
    reduced = cut(reduction.reduced_terms(load(spark, d, "draft_terms"), rows=rows))
    return alignment.mappings(alignment.classes(reduced), alignment.forms(reduced, rows))


def _quads(spark: SparkSession, d: str) -> DataFrame:
    terms = load(spark, d, "draft_terms")
    reduced = cut(reduction.reduced_terms(terms))  # read by every kind of triple
    return graph.term_quads(reduced, reduction.term_links(terms, reduced), reduction.drafts(terms))


def concept_quads(spark: SparkSession, d: str) -> DataFrame:
    return _quads(spark, d)


def quad_counts(spark: SparkSession, d: str) -> DataFrame:
    return _quads(spark, d).groupBy("predicate").agg(F.count("*").alias("n"))


def nquad_lines(spark: SparkSession, d: str) -> DataFrame:
    return graph.nquads(_quads(spark, d))


def turtle_statements(spark: SparkSession, d: str) -> DataFrame:
    return graph.turtle(_quads(spark, d))


def jsonld_nodes(spark: SparkSession, d: str) -> DataFrame:
    return graph.jsonld(_quads(spark, d))


def term_identifiers(spark: SparkSession, d: str) -> DataFrame:
    return graph.with_ids(salient_terms(spark, d)).select("source_id", "label_key", "term_id")


def mapping_quads(spark: SparkSession, d: str) -> DataFrame:
    return graph.mapping_quads(concept_mappings(spark, d))


def evidence_index(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.evidence_index(load(spark, d, "draft_terms"))


def evidence_claims(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.evidence_claims(load(spark, d, "draft_terms"))


def retrieve_evidence(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.retrieve(evidence_index(spark, d), QUESTION).drop("n_claims")


def ask_evidence(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.ask(evidence_index(spark, d), QUESTION).drop("n_claims")


def ask_claims(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.ask_claims(evidence_index(spark, d), evidence_claims(spark, d), QUESTION)


def ask_conflicts(spark: SparkSession, d: str) -> DataFrame:
    terms = planted.with_terms(spark, load(spark, d, "draft_terms"))
    links = reduction.term_links(terms, reduction.reduced_terms(terms))
    return evidence_query.ask_conflicts(evidence_query.evidence_index(terms), evidence_query.evidence_claims(terms), axiom_contradictions(spark, d), links, QUESTION)


def mental_model(spark: SparkSession, d: str) -> DataFrame:
    found = extraction.models(extraction.sentences(planted.with_chunks(spark, load(spark, d, "chunks")), cap=None))
    return evidence_query.mental_model(extraction.reduced_models(found), MODEL_NAME)


def lookup_concept(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.lookup(salient_terms(spark, d), CONCEPT)


def trace_claim(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.trace(load(spark, d, "draft_terms"), CONCEPT)


def concept_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    return evidence_query.neighbourhood(term_links(spark, d), CONCEPT)


def list_conflicts(spark: SparkSession, d: str) -> DataFrame:
    terms = planted.with_terms(spark, load(spark, d, "draft_terms"))
    return evidence_query.conflicts_of(axiom_contradictions(spark, d), reduction.term_links(terms, reduction.reduced_terms(terms)), CONTESTED)


# --- ontologies of all chunks --------------------------------------------------------------------------------------------


def _fragments(spark: SparkSession, d: str) -> claims.Fragments:
    found = extraction.fragments(planted.with_chunks(spark, load(spark, d, "chunks")), cap=None)
    return replace(found, axioms=found.axioms.unionByName(planted.norms(spark)))


def _ontology(spark: SparkSession, d: str) -> claims.Ontology:
    return claims.build(_fragments(spark, d))


def ontology_terms(spark: SparkSession, d: str) -> DataFrame:
    return claims.terms_of(_fragments(spark, d))[1].select("source_id", "claim_id", "label_key", "label", "kind", "definition", "confidence", "n_evidence", "rank")


def ontology_relations(spark: SparkSession, d: str) -> DataFrame:
    f = _fragments(spark, d)
    rows, terms, _ = claims.terms_of(f)
    return claims.relations_of(f.relations, terms, cut(claims.named_clusters(rows)))[0].select("source_id", "claim_id", "subject_id", "predicate", "object_id", "confidence", "n_evidence", "rank")


def ontology_axioms(spark: SparkSession, d: str) -> DataFrame:
    return claims.axioms_of(_fragments(spark, d).axioms)[0].select("source_id", "claim_id", "statement", "modality", "epistemic_status", "attribution", "confidence", "n_evidence", "rank")


def ontology_models(spark: SparkSession, d: str) -> DataFrame:
    return claims.models_of(_fragments(spark, d).models)[0].select("source_id", "claim_id", "name", "purpose", "confidence", "n_evidence", "rank")


def ontology_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return claims.contradictions(claims.axioms_of(_fragments(spark, d).axioms)[0]).select("source_id", "conflict_id", "signature", F.array_join("claim_ids", " ").alias("claim_ids"), "kind")


def ontology_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _ontology(spark, d).evidence.select("source_id", "claim_id", "chunk_id", "quote_sha256")


def ontology_abstracts(spark: SparkSession, d: str) -> DataFrame:
    return _ontology(spark, d).abstracts.select("source_id", "abstract", F.array_join("support_ids", " ").alias("support_ids"))


def ontology_questions(spark: SparkSession, d: str) -> DataFrame:
    return _ontology(spark, d).questions


def ontology_problems(spark: SparkSession, d: str) -> DataFrame:
    """The checks of a canonical ontology, with three broken rows planted."""
    o = _ontology(spark, d)
    link = spark.createDataFrame([(planted.A, "term:x", "broader", "term:none"), (planted.A, "term:x", "related", "term:x")], "source_id string, claim_id string, link string, other_id string")
    proof = spark.createDataFrame([(planted.A, "term:x", planted.B, "c", "h", 0, 0, "q")], "source_id string, claim_id string, evidence_source string, chunk_id string, quote_sha256 string, page_start int, page_end int, quote string")
    return claims.broken_references(replace(o, links=o.links.unionByName(link), evidence=o.evidence.unionByName(proof)))


def merged_terms(spark: SparkSession, d: str) -> DataFrame:
    """Draft terms merged in batches of eight fragments, then together."""
    rows, _ = claims.quarantine(_drafts(spark, d).where("fragment_index is not null and term_index is not null").select("source_id", "fragment_index", "term_index", "label", "aliases", "kind", "definition", "broader_labels", "narrower_labels", "related_labels", "confidence", "evidence"))
    merged = claims.merge_tree(rows, "terms", 8)
    keys = ["source_id", "k1", "k2", "k3"]
    return merged.claims.join(merged.evidence.groupBy(*keys).agg(F.count("*").alias("n_evidence")), keys).select(*keys, "confidence", "n_evidence", F.size("aliases").alias("n_aliases"))


def quarantined_terms(spark: SparkSession, d: str) -> DataFrame:
    return claims.quarantine(load(spark, d, "draft_terms").select("term_id", "evidence"))[1].select("term_id").distinct()


def ontology_quads(spark: SparkSession, d: str) -> DataFrame:
    return graph.ontology_quads(_ontology(spark, d))


def shape_violations(spark: SparkSession, d: str) -> DataFrame:
    """The shapes over all triples of all ontologies and some planted broken ones."""
    broken = spark.createDataFrame(list(BROKEN), "graph string, subject string, predicate string, object string, object_kind string")
    return graph.violations(graph.ontology_quads(_ontology(spark, d)).unionByName(broken), graph.ONTOLOGY_SHAPES)


_T, _G = graph.RDF + "type", "urn:planted"
#: Triples that break shapes.
BROKEN = (
    (_G, "urn:x:concept", _T, graph.SKOS + "Concept", "uri"),
    (_G, "urn:x:concept", graph.SKOS + "prefLabel", "", "literal"),
    (_G, "urn:x:concept", graph.DCTERMS + "identifier", "a", "literal"),
    (_G, "urn:x:concept", graph.DCTERMS + "identifier", "b", "literal"),
    (_G, "urn:x:concept", graph.BASE + "confidence", "1.5000", graph.XSD + "decimal"),
    (_G, "urn:x:concept", graph.SKOS + "definition", "d", "literal"),
    (_G, "urn:x:concept", graph.SKOS + "broader", "urn:x:proof", "uri"),
    (_G, "urn:x:concept", graph.PROV + "wasDerivedFrom", "urn:x:proof", "uri"),
    (_G, "urn:x:proof", _T, graph.BASE + "Evidence", "uri"),
    (_G, "urn:x:proof", graph.BASE + "sourceId", "s", "literal"),
    (_G, "urn:x:proof", graph.BASE + "chunkId", "c", "literal"),
    (_G, "urn:x:proof", graph.BASE + "quote", "q", "literal"),
    (_G, "urn:x:proof", graph.BASE + "quoteSha256", "short", "literal"),
    (_G, "urn:x:proof", graph.BASE + "verified", "false", graph.XSD + "boolean"),
    (_G, "urn:x:proof", graph.PROV + "wasDerivedFrom", "urn:x:chunk", "uri"),
    (_G, "urn:x:conflict", _T, graph.BASE + "Conflict", "uri"),
    (_G, "urn:x:conflict", graph.BASE + "conflictingClaim", "text", "literal"),
)


# --- frames --------------------------------------------------------------------------------------------------------------


def _frame(spark: SparkSession, d: str) -> tuple[claims.Ontology, frame.Frame]:
    o = _ontology(spark, d)
    return o, frame.compose(o, "Readers", OBJECTIVE)


def beliefs(spark: SparkSession, d: str) -> DataFrame:
    return _frame(spark, d)[1].beliefs


def stance_ledger(spark: SparkSession, d: str) -> DataFrame:
    return frame.ledger(_frame(spark, d)[1])


def intention_links(spark: SparkSession, d: str) -> DataFrame:
    return _frame(spark, d)[1].links


def frame_findings(spark: SparkSession, d: str) -> DataFrame:
    """The checks of a frame over all ontologies, to which unfit rows were added."""
    o, f = _frame(spark, d)
    b = spark.createDataFrame(
        [("bad-1", planted.A, "term", "term:none", "x", "accepted", "source", 0.5), ("bad-2", planted.A, "term", None, "x", "accepted", "source", 0.5), ("bad-3", planted.A, "term", None, "x", "synthesized", "derived", 0.5)],
        "belief_id string, source_id string, kind string, support string, proposition string, status string, origin string, confidence double",
    )
    g = spark.createDataFrame(
        [("bad-goal", "Be conscious of costs. Do not claim consciousness", "synthesized_subgoal", 3, None, None, None), ("bad-norm", "Teams may nap.", "source_norm", 2, None, planted.A, "axiom:none"), ("bad-parent", "Teams may sing.", "source_norm", 2, "objective", planted.A, "axiom:none")],
        "desire_id string, goal string, origin string, priority int, parent string, source_id string, claim_id string",
    )
    i = spark.createDataFrame([("bad-intent", "apply", planted.A, "model:none", " ")], "intention_id string, kind string, source_id string, subject string, stop string")
    links = spark.createDataFrame([("bad-intent", "belief", "bad-1")], "intention_id string, kind string, target string")
    models = spark.createDataFrame([(planted.A, "model:none")], "source_id string, model_id string")
    policy = f.policy.withColumn("frame_id", F.lit("frame")).withColumn("answer_contract", F.array(F.lit("Result first."))).withColumn("uncertainty_policy", F.lit("None."))
    unfit = frame.Frame(f.beliefs.unionByName(b), f.desires.unionByName(g), f.intentions.unionByName(i), f.links.unionByName(links), f.models.unionByName(models), policy)
    return frame.findings(unfit, o, canonical=f)


# --- planted samples of operators that the tables hold no case of ----------------------------------------------------------


def layout_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([("doc", planted.A, planted.LAYOUT)], "conversion_id string, source_id string, canonical string")
    return layout.layout_blocks(rows).select("block_no", "label", "level", "text", F.array_join("heading_path", " > ").alias("headings"), "page_start", "page_end")


def resolution_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = [(planted.A, i, 0, label, definition) for i, (label, definition) in enumerate(planted.NAMES)]
    terms = spark.createDataFrame(rows, "source_id string, fragment_index bigint, term_index int, label string, definition string")
    none = F.array().cast("array<string>")
    terms = terms.select("*", none.alias("aliases"), F.lit("concept").alias("kind"), F.lit(0.9).alias("confidence"), none.alias("broader_labels"), none.alias("narrower_labels"))
    return resolution.resolve(terms)[1].select("left", "right", "decision", "stage", F.round("score", 2).alias("score"))


def formal_sample(spark: SparkSession, d: str) -> DataFrame:
    return claims.formal_problems(spark.createDataFrame([r[:3] for r in planted.RULES], "claim_id string, formalism string, formal_expression string"))


def canonical_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Every conversion as a canonical document and back to blocks."""
    return layout.layout_blocks(layout.canonical_documents(load(spark, d, "converted_documents"))).select("conversion_id", "block_no", "label", "level", F.sha2("text", 256).alias("text_sha256"))


# --- gates and joins over the tables -------------------------------------------------------------------------------------


def fragment_gaps(spark: SparkSession, d: str) -> DataFrame:
    return extraction.unpaired(load(spark, d, "draft_terms"), load(spark, d, "chunks"))


def foreign_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.foreign(planted.with_chunks(spark, load(spark, d, "chunks")), load(spark, d, "sources"))


def source_metadata(spark: SparkSession, d: str) -> DataFrame:
    return chunking.merged_metadata(load(spark, d, "chunks")).select("source_id", "key", F.array_join("found", "\u001f").alias("found"))


def united_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Declared conflicts, opposed statements of different sources and conflicting concepts as one list."""
    f = _fragments(spark, d)
    axioms = claims.axioms_of(f.axioms)[0]
    reduced = claims.terms_of(f)[1].select("source_id", "label_key", "definition")
    mapped = alignment.conflicting(cut(alignment.classes(reduced)))
    return alignment.united_conflicts(claims.contradictions(axioms), alignment.opposed_claims(axioms), mapped)


def cross_source_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return alignment.opposed_claims(claims.axioms_of(_fragments(spark, d).axioms)[0])


_ALL = (
    source_routes, document_fingerprints, duplicate_texts, chunk_token_counts, chunk_split_sizes, source_profiles, heading_counts, document_blocks, heading_groups, layout_chunks, chunk_sentences, definition_statements, relation_statements,
    named_models, extracted_terms, body_texts, known_terms, reduced_relations, reduced_models, reduced_axioms, axiom_contradictions, opposed_statements, quote_status, evidence_violations, grounded_quotes, term_grounding, evidence_counts, canonical_labels, best_definitions, best_kinds, salient_terms,
    source_abstracts, term_links, dangling_labels, similar_names, resolved_occurrences, resolution_audit, resolved_clusters, resolved_terms, resolved_links, concept_classes, class_membership, alignment_features, concept_mappings, concept_quads, quad_counts, nquad_lines, turtle_statements, jsonld_nodes, term_identifiers, mapping_quads,
    shape_violations, ontology_terms, ontology_relations, ontology_axioms, ontology_models, ontology_conflicts, ontology_evidence, ontology_abstracts, ontology_questions, ontology_problems, ontology_quads, merged_terms, quarantined_terms, layout_sample, resolution_sample, formal_sample, canonical_blocks, fragment_gaps, foreign_chunks, source_metadata, cross_source_conflicts, united_conflicts, evidence_index, evidence_claims, retrieve_evidence, ask_evidence, ask_claims, ask_conflicts, mental_model, lookup_concept, trace_claim, concept_neighbourhood, list_conflicts, beliefs, stance_ledger, intention_links, frame_findings,
)


def queries():
    return {f.__name__: f for f in _ALL}
