"""Named-graph triples and declarative shape checks, as plain DataFrames.

A graph is a set of rows (graph, subject, predicate, object, object_kind); each
source is one named graph, so sources are never collapsed.  Shapes are rows of a
small constant table; all of them are checked in one pass over the triples.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions.text import stable_id
from claimspark.operators.claims import LISTS, SEPARATOR, Ontology
from claimspark.operators.reduction import merged_evidence
from claimspark.runtime import cut

BASE = "urn:claimspark:"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
PROV = "http://www.w3.org/ns/prov#"
XSD = "http://www.w3.org/2001/XMLSchema#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
DCTERMS = "http://purl.org/dc/terms/"
LINKS = {"broader": SKOS + "broader", "narrower": SKOS + "narrower", "related": SKOS + "related"}
MAPPINGS = {"exact_equivalent": SKOS + "exactMatch", "broader": SKOS + "narrowMatch", "narrower": SKOS + "broadMatch", "related_or_analogous": SKOS + "relatedMatch"}


def percent(c: Column) -> Column:
    """Percent-encoding of everything but letters, digits and "_.-~"."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def uri(kind: str, *parts: Column | str) -> Column:
    out = [F.lit(f"{BASE}{kind}")]
    for p in parts:
        out += [F.lit(":"), percent(F.col(p) if isinstance(p, str) else p)]
    return F.concat(*out)


def _rows(df: DataFrame, subject: Column, *pairs: tuple[str, Column, str]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(p).alias("predicate"), o.cast("string").alias("object"), F.lit(k).alias("object_kind")) for p, o, k in pairs])
    return df.select(uri("source", "source_id").alias("graph"), subject.alias("subject"), F.explode(each).alias("t")).select("graph", "subject", "t.*").where("object is not null")


def term_quads(reduced: DataFrame, links: DataFrame, rows: DataFrame) -> DataFrame:
    """Concepts, their links, and the evidence chain concept -> quotation -> chunk -> source."""
    concept = uri("concept", "source_id", "label_key")
    t = _rows(reduced, concept, (RDF + "type", F.lit(SKOS + "Concept"), "uri"), (SKOS + "prefLabel", F.col("label"), "literal"), (SKOS + "definition", F.when(F.col("definition") != "", F.col("definition")), "literal"), (BASE + "kind", F.col("kind"), "literal"), (BASE + "confidence", F.format_number("confidence", 4), XSD + "decimal"))
    step = F.coalesce(*[F.when(F.col("link") == k, F.lit(v)) for k, v in LINKS.items()])
    l = links.select(uri("source", "source_id").alias("graph"), concept.alias("subject"), step.alias("predicate"), uri("concept", "source_id", "other_key").alias("object"), F.lit("uri").alias("object_kind"))
    ev = merged_evidence(rows.join(reduced.select("source_id", "label_key"), ["source_id", "label_key"], "left_semi"), ["source_id", "label_key"]).where("chunk_id is not null and quote_sha256 is not null and quote is not null")
    quotation = uri("evidence", "evidence_source", "chunk_id", "quote_sha256")
    e = _rows(ev.where("evidence_source is not null"), quotation, (RDF + "type", F.lit(PROV + "Entity"), "uri"), (PROV + "value", F.col("quote"), "literal"), (BASE + "sha256", F.col("quote_sha256"), "literal"), (PROV + "wasQuotedFrom", uri("chunk", "chunk_id"), "uri"))
    d = ev.where("evidence_source is not null").select(uri("source", "source_id").alias("graph"), concept.alias("subject"), F.lit(PROV + "wasDerivedFrom").alias("predicate"), quotation.alias("object"), F.lit("uri").alias("object_kind"))
    c = ev.where("evidence_source is not null").select(uri("source", "source_id").alias("graph"), uri("chunk", "chunk_id").alias("subject"), F.lit(PROV + "hadPrimarySource").alias("predicate"), uri("source", "evidence_source").alias("object"), F.lit("uri").alias("object_kind"))
    return t.unionByName(l).unionByName(e).unionByName(d).unionByName(c).distinct()


# --- the whole ontology ----------------------------------------------------------------------------------------------

_LIST_NAMES = dict(zip(LISTS, ("applicableWhen", "assumption", "variable", "mechanismStep", "procedureStep", "prediction", "failureMode")))


def relation_uri(predicate: Column) -> Column:
    """Absolute predicates as they are, others under the relation namespace by their slug."""
    slugged = F.regexp_replace(F.regexp_replace(F.lower(predicate), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(F.regexp_like(predicate, F.lit("^(https?://|urn:)")), predicate).otherwise(F.concat(F.lit(BASE + "relation:"), F.when(slugged == "", "item").otherwise(F.left(slugged, F.lit(64)))))


def _claim(c: str = "claim_id") -> Column:
    return F.concat(F.lit(BASE + "claim:"), F.col(c))


def _each(df: DataFrame, subject: Column, predicate: str, values: str) -> DataFrame:
    """One triple for each string of an array column."""
    return df.select(uri("source", "source_id").alias("graph"), subject.alias("subject"), F.lit(predicate).alias("predicate"), F.explode(values).alias("object"), F.lit("literal").alias("object_kind"))


def ontology_quads(o: Ontology) -> DataFrame:
    """Every claim of an ontology: concepts, reified relations with their direct triples, axioms, models, conflicts, and the chain evidence -> chunk -> source."""
    text, node = "literal", "uri"
    decimal = F.format_number("confidence", 4)
    onto = uri("ontology", "source_id")
    kind = lambda df, type_, has, *more: _rows(
        df, _claim(), (RDF + "type", F.lit(type_), node), (DCTERMS + "identifier", F.col("claim_id"), text), (BASE + "confidence", decimal, XSD + "decimal"), *more
    ).unionByName(_rows(df, onto, (BASE + has, _claim(), node)))
    step = F.coalesce(*[F.when(F.col("link") == k, F.lit(v)) for k, v in LINKS.items()])
    terms = kind(o.terms, SKOS + "Concept", "hasTerm", (SKOS + "prefLabel", F.col("label"), text), (SKOS + "definition", F.col("definition"), text), (BASE + "kind", F.col("kind"), text)).unionByName(_each(o.terms, _claim(), SKOS + "altLabel", "aliases"))
    links = o.links.select(uri("source", "source_id").alias("graph"), _claim().alias("subject"), step.alias("predicate"), _claim("other_id").alias("object"), F.lit(node).alias("object_kind"))
    pred = relation_uri(F.col("predicate"))
    relations = kind(o.relations, BASE + "Relation", "hasRelation", (RDF + "type", F.lit(RDF + "Statement"), node), (RDF + "subject", _claim("subject_id"), node), (RDF + "predicate", pred, node), (RDF + "object", _claim("object_id"), node), (BASE + "predicateLabel", F.col("predicate"), text))
    direct = o.relations.select(uri("source", "source_id").alias("graph"), _claim("subject_id").alias("subject"), pred.alias("predicate"), _claim("object_id").alias("object"), F.lit(node).alias("object_kind"))
    names = _rows(o.relations, pred, (RDF + "type", F.lit(RDF + "Property"), node), (RDFS + "label", F.col("predicate"), text))
    pair = o.relations.where("qualifier_key <> ''").select("source_id", "claim_id", F.explode(F.split("qualifier_key", "\u001e")).alias("q"))
    pair = pair.withColumn("at", F.concat(_claim(), F.lit("/qualifier/"), F.left(F.sha2("q", 256), F.lit(16))))
    qualifiers = _rows(pair, _claim(), (BASE + "qualifier", F.col("at"), node)).unionByName(_rows(pair, F.col("at"), (BASE + "qualifierKey", F.substring_index("q", "=", 1), text), (BASE + "qualifierValue", F.regexp_replace("q", "^[^=]*=", ""), text)))
    axioms = kind(o.axioms, BASE + "Axiom", "hasAxiom", *[(BASE + n, F.col(c), text) for c, n in (("statement", "statement"), ("modality", "modality"), ("epistemic_status", "epistemicStatus"), ("attribution", "attribution"))])
    axioms = axioms.unionByName(_each(o.axioms, _claim(), BASE + "condition", "conditions")).unionByName(_each(o.axioms, _claim(), BASE + "exception", "exceptions"))
    models = kind(o.models, BASE + "MentalModel", "hasMentalModel", (RDFS + "label", F.col("name"), text), (BASE + "purpose", F.col("purpose"), text))
    for c, n in _LIST_NAMES.items():
        models = models.unionByName(_each(o.models, _claim(), BASE + n, c))
    c = o.conflicts.withColumnRenamed("conflict_id", "claim_id")
    conflicts = _rows(c, _claim(), (RDF + "type", F.lit(BASE + "Conflict"), node), (DCTERMS + "identifier", F.col("claim_id"), text), (BASE + "conflictKind", F.col("kind"), text), (BASE + "resolution", F.lit("unresolved"), text))
    sides = c.select(uri("source", "source_id").alias("graph"), _claim().alias("subject"), F.lit(BASE + "conflictingClaim").alias("predicate"), F.explode("claim_ids").alias("o")).select("graph", "subject", "predicate", F.concat(F.lit(BASE + "claim:"), "o").alias("object"), F.lit(node).alias("object_kind"))
    top = _rows(o.abstracts, onto, (RDF + "type", F.lit(OWL + "Ontology"), node), (DCTERMS + "identifier", F.col("source_id"), text), (DCTERMS + "title", F.col("source_id"), text), (DCTERMS + "abstract", F.col("abstract"), text), (PROV + "wasDerivedFrom", uri("source", "source_id"), node))
    support = o.abstracts.select(uri("source", "source_id").alias("graph"), onto.alias("subject"), F.lit(BASE + "abstractSupport").alias("predicate"), F.explode("support_ids").alias("o")).select("graph", "subject", "predicate", F.concat(F.lit(BASE + "claim:"), "o").alias("object"), F.lit(node).alias("object_kind"))
    asked = _rows(o.questions, onto, (BASE + "openQuestion", F.col("question"), text))
    e = o.evidence.where("evidence_source is not null and chunk_id is not null and quote_sha256 is not null and quote is not null")
    proof, chunk, source = uri("evidence", "evidence_source", "chunk_id", "quote_sha256"), uri("chunk", "evidence_source", "chunk_id"), uri("source", "evidence_source")
    positive = XSD + "positiveInteger"
    evidence = _rows(
        e, proof, (RDF + "type", F.lit(BASE + "Evidence"), node), (RDF + "type", F.lit(PROV + "Entity"), node), (BASE + "sourceId", F.col("evidence_source"), text), (BASE + "chunkId", F.col("chunk_id"), text), (BASE + "quote", F.col("quote"), text), (BASE + "quoteSha256", F.col("quote_sha256"), text),
        (BASE + "verified", F.lit("true"), XSD + "boolean"), (BASE + "pageStart", F.when(F.col("page_start") > 0, F.col("page_start")), positive), (BASE + "pageEnd", F.when(F.col("page_end") > 0, F.col("page_end")), positive), (PROV + "wasDerivedFrom", chunk, node),
    )
    chain = _rows(e, _claim(), (PROV + "wasDerivedFrom", proof, node)).unionByName(_rows(e, chunk, (RDF + "type", F.lit(PROV + "Entity"), node), (DCTERMS + "identifier", F.col("chunk_id"), text), (PROV + "wasDerivedFrom", source, node)))
    chain = chain.unionByName(_rows(e, source, (RDF + "type", F.lit(PROV + "Entity"), node), (DCTERMS + "identifier", F.col("evidence_source"), text)))
    every = terms
    for part in (links, relations, direct, names, qualifiers, axioms, models, conflicts, sides, top, support, asked, evidence, chain):
        every = every.unionByName(part)
    return every.distinct()


def mapping_quads(mapped: DataFrame) -> DataFrame:
    """The integration graph: one match statement for each related pair of classes."""
    step = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in MAPPINGS.items()])
    return mapped.select(F.lit(BASE + "integration").alias("graph"), uri("class", "left_id").alias("subject"), step.alias("predicate"), uri("class", "right_id").alias("object"), F.lit("uri").alias("object_kind")).where("predicate is not null").distinct()


@dataclass(frozen=True)
class Shape:
    """What the values of one path of a class must be; None asks for nothing."""

    target: str
    path: str
    least: int = 0
    most: int | None = None
    node_kind: str | None = None
    target_class: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    low: float | None = None
    high: float | None = None
    value: str | None = None


SHAPES = (
    Shape(SKOS + "Concept", SKOS + "prefLabel", 1, 1, "literal"),
    Shape(SKOS + "Concept", SKOS + "definition", 0, 1, "literal"),
    Shape(SKOS + "Concept", PROV + "wasDerivedFrom", 1, None, "uri", PROV + "Entity"),
    Shape(SKOS + "Concept", SKOS + "broader", 0, None, "uri", SKOS + "Concept"),
    Shape(PROV + "Entity", PROV + "value", 1, 1, "literal"),
    Shape(PROV + "Entity", PROV + "wasQuotedFrom", 1, 1, "uri"),
)
_GROUNDED = (SKOS + "Concept", BASE + "Relation", BASE + "Axiom", BASE + "MentalModel")
#: What every node of ontology_quads() must be.
ONTOLOGY_SHAPES = (
    Shape(OWL + "Ontology", DCTERMS + "identifier", 1, 1, "literal"),
    Shape(OWL + "Ontology", DCTERMS + "title", 1, 1, "literal"),
    Shape(OWL + "Ontology", PROV + "wasDerivedFrom", 1, None, "uri", PROV + "Entity"),
    *[Shape(t, DCTERMS + "identifier", 1, 1, "literal") for t in _GROUNDED],
    *[Shape(t, BASE + "confidence", 1, 1, low=0.0, high=1.0) for t in _GROUNDED],
    *[Shape(t, PROV + "wasDerivedFrom", 1, None, "uri", BASE + "Evidence") for t in _GROUNDED],
    Shape(SKOS + "Concept", SKOS + "prefLabel", 1, 1, min_length=1),
    Shape(SKOS + "Concept", SKOS + "definition", 1, 1),
    *[Shape(SKOS + "Concept", SKOS + n, target_class=SKOS + "Concept") for n in ("broader", "narrower", "related")],
    *[Shape(BASE + "Relation", RDF + n, 1, 1, "uri", SKOS + "Concept") for n in ("subject", "object")],
    Shape(BASE + "Relation", RDF + "predicate", 1, 1, "uri"),
    Shape(BASE + "Relation", RDF + "type", 2, None, "uri"),
    Shape(BASE + "Axiom", BASE + "statement", 1, 1, min_length=1),
    *[Shape(BASE + "Axiom", BASE + n, 1, 1) for n in ("modality", "epistemicStatus", "attribution")],
    Shape(BASE + "MentalModel", RDFS + "label", 1, 1),
    Shape(BASE + "MentalModel", BASE + "purpose", 1, 1),
    *[Shape(BASE + "Evidence", BASE + n, 1, 1, min_length=1) for n in ("sourceId", "chunkId", "quote")],
    Shape(BASE + "Evidence", BASE + "quoteSha256", 1, 1, min_length=64, max_length=64),
    Shape(BASE + "Evidence", BASE + "verified", 1, 1, XSD + "boolean", value="true"),
    Shape(BASE + "Evidence", PROV + "wasDerivedFrom", 1, None, "uri", PROV + "Entity"),
    Shape(BASE + "Conflict", BASE + "conflictingClaim", 2, None, "uri"),
    Shape(BASE + "Conflict", BASE + "resolution", 1, 1),
)
_SHAPE_ROW = "shape int, target string, path string, least int, most int, node_kind string, target_class string, min_length int, max_length int, low double, high double, value string"


def violations(quads: DataFrame, shapes: tuple[Shape, ...] = SHAPES) -> DataFrame:
    """(graph, subject, path, constraint) of every broken shape, all shapes in one pass.

    Nodes meet the shapes of their classes, then the values of the shapes' paths;
    a class constraint looks the value's classes up in the same graph.
    """
    from dataclasses import astuple

    spark = quads.sparkSession
    rules = F.broadcast(spark.createDataFrame([(i, *astuple(x)) for i, x in enumerate(shapes)], _SHAPE_ROW))  # a constant table
    known = cut(quads.where(F.col("predicate").isin(sorted({RDF + "type", *(x.path for x in shapes)}))))
    types = known.where(F.col("predicate") == RDF + "type").select("graph", "subject", F.col("object").alias("target")).distinct()
    focus = types.join(rules, "target")
    values = known.select("graph", "subject", F.col("predicate").alias("path"), "object", "object_kind")
    met = focus.join(values, ["graph", "subject", "path"], "left")
    classed = met.where("target_class is not null and object is not null").join(types.select("graph", F.col("subject").alias("object"), F.col("target").alias("target_class")), ["graph", "object", "target_class"], "left_anti").select("graph", "subject", "path", F.lit("class").alias("constraint"))
    size, number = F.length("object"), F.try_to_number("object", F.lit("999.9999"))
    some = lambda bad: F.max(F.coalesce(F.col("object").isNotNull() & bad, F.lit(False)))
    checked = met.groupBy("graph", "subject", "shape", "path", "least", "most").agg(
        F.count("object").alias("n"),
        some(F.col("node_kind").isNotNull() & (F.col("object_kind") != F.col("node_kind"))).alias("node_kind"),
        some(size < F.col("min_length")).alias("min_length"),
        some(size > F.col("max_length")).alias("max_length"),
        some((F.col("low").isNotNull() | F.col("high").isNotNull()) & (number.isNull() | (number < F.col("low")) | (number > F.col("high")))).alias("range"),
        some(F.col("value").isNotNull() & (F.col("object") != F.col("value"))).alias("value"),
    )
    broken = F.array_compact(F.array(F.when(F.col("n") < F.col("least"), "least"), F.when(F.col("n") > F.col("most"), "most"), *[F.when(F.col(c), c) for c in ("node_kind", "min_length", "max_length", "range", "value")]))
    return checked.select("graph", "subject", "path", F.explode(broken).alias("constraint")).unionByName(classed).distinct()


def nquads(quads: DataFrame) -> DataFrame:
    """(value): one N-Quads line for each row, ready for df.write.text."""
    literal = F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.replace(F.replace("object", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t")), F.lit('"'))
    plain = F.col("object_kind") == "literal"
    typed = F.concat(literal, F.lit("^^<"), F.col("object_kind"), F.lit(">"))
    obj = F.when(F.col("object_kind") == "uri", F.concat(F.lit("<"), F.col("object"), F.lit(">"))).when(plain, literal).otherwise(typed)
    ref = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    return quads.select(F.concat_ws(" ", ref("subject"), ref("predicate"), obj, ref("graph"), F.lit(".")).alias("value"))


_NQUAD = re.compile(r'^<([^>]*)> <([^>]*)> (?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>)?) <([^>]*)> \.$')


def parse_nquad(line: str) -> tuple[str, str, str, str, str]:
    """(graph, subject, predicate, object, object_kind) of a line that nquads wrote."""
    m = _NQUAD.match(line)
    if not m:
        raise ValueError(f"not an N-Quads line: {line[:80]}")
    if m.group(3) is not None:
        return m.group(6), m.group(1), m.group(2), m.group(3), "uri"
    value = re.sub(r"\\(.)", lambda x: {"n": "\n", "r": "\r", "t": "\t"}.get(x.group(1), x.group(1)), m.group(4))
    return m.group(6), m.group(1), m.group(2), value, m.group(5) or "literal"


def _blocks(quads: DataFrame, most: int, render) -> DataFrame:
    """(graph, value): the triples of each subject in blocks of at most ``most``, rendered one by one.

    The rows are sorted in ranges of subjects and streamed, so a subject of any
    size is written in bounded memory; one of more triples stands in several
    blocks, which both formats read as one node.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []
        for pdf in batches:
            out = []
            for g, s, p, o, k in pdf.itertuples(index=False, name=None):
                if (g, s) != key or len(held) >= most:
                    if held:
                        out.append((key[0], render(key[1], held)))
                    key, held = (g, s), []
                held.append((p, o, k))
            yield pd.DataFrame(out, columns=["graph", "value"])
        if held:
            yield pd.DataFrame([(key[0], render(key[1], held))], columns=["graph", "value"])

    columns = ["graph", "subject", "predicate", "object", "object_kind"]
    return quads.select(*columns).repartitionByRange("graph", "subject").sortWithinPartitions(*columns).mapInPandas(run, "graph string, value string")


def _turtle_block(subject: str, triples: list[tuple[str, str, str]]) -> str:
    def node(value: str, kind: str) -> str:
        if kind == "uri":
            return f"<{value}>"
        text = json.dumps(value, ensure_ascii=False)
        return text if kind == "literal" else f"{text}^^<{kind}>"

    return f"<{subject}> " + " ;\n    ".join(f"<{p}> {node(o, k)}" for p, o, k in triples) + " ."


def _json_block(subject: str, triples: list[tuple[str, str, str]]) -> str:
    out: dict = {"@id": subject}
    for p, o, k in triples:
        out.setdefault(p, []).append({"@id": o} if k == "uri" else {"@value": o} if k == "literal" else {"@value": o, "@type": k})
    return json.dumps(out, ensure_ascii=False)


def turtle(quads: DataFrame, most: int = 1_000) -> DataFrame:
    """(graph, value): Turtle statements, one for each subject of a graph (or block of it)."""
    return _blocks(quads, most, _turtle_block)


def trig(quads: DataFrame, most: int = 1_000) -> DataFrame:
    """(value): TriG statements, each in the braces of its graph."""
    return turtle(quads, most).select(F.concat(F.lit("GRAPH <"), "graph", F.lit("> { "), "value", F.lit(" }")).alias("value"))


def dataset_id(quads: DataFrame) -> str:
    """Identifier of the set of named graphs, whatever their order."""
    one = F.conv(F.substring(F.sha2("graph", 256), 1, 15), 16, 10).cast("bigint")
    got = quads.select("graph").distinct().agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(one), F.lit(0)).alias("x")).first()
    return f"dataset-{got['n']}-{got['x']:x}"


def named_graphs(quads: DataFrame, expected: DataFrame) -> DataFrame:
    """quads, if their graphs are exactly those of ``expected`` (graph); else an error."""
    have = quads.select("graph").distinct()
    apart = have.join(expected, "graph", "left_anti").unionByName(expected.select("graph").join(have, "graph", "left_anti"))
    if not apart.isEmpty():
        raise ValueError(f"graphs don't match, for example {apart.first()['graph']}")
    return quads


def derived_quads(beliefs: DataFrame, claims: DataFrame) -> DataFrame:
    """The integration graph's statements of derived beliefs; each must rest on a claim (source_id, claim_id) and have an identifier of its own."""
    made = beliefs.where("origin = 'derived' or status = 'synthesized'")
    known = claims.select("source_id", F.col("claim_id").alias("support"))
    bad = made.join(known, ["source_id", "support"], "left_anti").select("belief_id").unionByName(made.join(claims.select(F.col("claim_id").alias("belief_id")), "belief_id", "left_semi").select("belief_id"))
    if not bad.isEmpty():
        raise ValueError(f"derived belief without support or with a claim's identifier: {bad.first()['belief_id']}")
    each = F.array(F.struct(F.lit(RDF + "type").alias("predicate"), F.lit(BASE + "SynthesizedClaim").alias("object"), F.lit("uri").alias("object_kind")), F.struct(F.lit(BASE + "statement").alias("predicate"), F.col("proposition").alias("object"), F.lit("literal").alias("object_kind")), F.struct(F.lit(PROV + "wasDerivedFrom").alias("predicate"), _claim("support").alias("object"), F.lit("uri").alias("object_kind")))
    return made.select(F.lit(BASE + "integration").alias("graph"), F.concat(F.lit(BASE + "belief:"), "belief_id").alias("subject"), F.explode(each).alias("t")).select("graph", "subject", "t.*")


def conflict_quads(united: DataFrame) -> DataFrame:
    """The integration graph's conflicts of alignment.united_conflicts()."""
    each = united.withColumn("m", F.explode(F.split("members", " ")))
    node = F.concat(F.lit(BASE), F.col("conflict_id"))
    return each.select(F.lit(BASE + "integration").alias("graph"), node.alias("subject"), F.lit(BASE + "conflictingClaim").alias("predicate"), F.concat(F.lit(BASE + "claim:"), "m").alias("object"), F.lit("uri").alias("object_kind")).unionByName(
        united.select(F.lit(BASE + "integration").alias("graph"), node.alias("subject"), F.lit(BASE + "conflictKind").alias("predicate"), F.col("kind").alias("object"), F.lit("literal").alias("object_kind"))
    )


def jsonld(quads: DataFrame, most: int = 1_000) -> DataFrame:
    """(graph, value): JSON-LD node objects as JSON lines, one for each subject of a graph (or block of it)."""
    return _blocks(quads, most, _json_block)


def with_ids(reduced: DataFrame) -> DataFrame:
    """reduced terms with their content-derived identifier: equal content gives the same id wherever it is computed."""
    return reduced.withColumn("term_id", stable_ids(F.lit("term"), F.col("label"), F.struct("label_key", "kind", "definition")))


def stable_ids(prefix: Column, label: Column, payload: Column) -> Column:
    return _stable(prefix, label, F.to_json(payload, {"ignoreNullFields": "false"}))


@F.pandas_udf(T.StringType())
def _stable(prefix: pd.Series, label: pd.Series, payload: pd.Series) -> pd.Series:
    return pd.Series([stable_id(p, x or "", json.loads(j)) for p, x, j in zip(prefix, label, payload)])
