"""Deterministic extraction: definitions, relations and named models from sentences.

Everything stays in the JVM: sentences by split and posexplode, the surface
patterns by regexp_extract.  A chunk's first ``sentence_cap`` sentences are
scanned (a feature of the extractor, a parameter here).  The quote of a claim is
the sentence as it stands in the chunk.  Null and blank texts have no sentences.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.functions.columns import fold_label
from claimspark.operators.claims import LISTS, Fragments, signature

SENTENCE_CAP = 80
CONFIDENCE = {"term": 0.66, "definition": 0.64, "relation": 0.62, "statement": 0.61, "model": 0.58}
# The surface patterns of the offline extractor, with letters, digits and underscore spelt out.
_W = r"[\p{L}\p{N}_'’\-]"
DEFINITION = rf"^(?:[Tt]he\s+)?([A-Z]{_W}*(?:\s+[A-Z\p{{L}}\p{{N}}_]{_W}*){{0,5}})\s+(?:is|are|means|refers to|denotes)\s+(.+?)[.!?]?$"
QUOTED_DEFINITION = r"^[\"“]([^\"”]{2,80})[\"”]\s+(?:means|refers to)\s+(.+)$"
RELATION = rf"(?i)^([A-Z]{_W}*(?:\s+[A-Z\p{{L}}\p{{N}}_]{_W}*){{0,4}})\s+(causes|enables|requires|contains|influences|precedes|produces|prevents)\s+((?:the\s+)?[A-Za-z][^,.;:!?]{{1,80}})"
MODEL = rf"(?:^|[^\p{{L}}\p{{N}}_])(?:The\s+)?((?:[A-Z]{_W}*\s+){{0,5}}(?:Model|Framework|Method|Process))(?:$|[^\p{{L}}\p{{N}}_])"
CAUSAL = ("causes", "produces", "prevents")
EDGES = r"^[ .,:;\"'`()\[\]{}]+|[ .,:;\"'`()\[\]{}]+$"


#: What a sentence must hold for a definition or relation pattern to match: much faster to look for than the patterns.
COPULAS = (" is ", " are ", " means ", " refers to ", " denotes ")
VERBS = "(?iu) (?:causes|enables|requires|contains|influences|precedes|produces|prevents) "


def sentence_list(text: Column | str) -> Column:
    """Sentences of a text: heading lines removed, cut after . ! ? before blanks or line ends."""
    prose = F.regexp_replace(text, r"(?md)^#{1,6}\s+.*$", "")
    return F.filter(F.transform(F.split(prose, r"(?<=[.!?])(?:[ \t]+|\r?\n+)"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")


def sentences(chunks: DataFrame, key: str = "chunk_id", text: str = "text", cap: int | None = SENTENCE_CAP, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, source_id, carried columns, sentence_no, quote, sentence); sentence is the quote with single spaces."""
    rows = chunks.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), "source_id", *carry, F.col(text).alias("text")).distinct()
    found = rows.select("key", "source_id", *carry, F.posexplode(sentence_list("text") if cap is None else F.slice(sentence_list("text"), 1, cap)).alias("at", "quote"))
    return found.select(F.col("key").alias(key), "source_id", *carry, (F.col("at") + 1).alias("sentence_no"), "quote", F.trim(F.regexp_replace("quote", r"\s+", " ")).alias("sentence"))


def _label() -> Column:
    """What a definition pattern names, the copula pattern first; null where none matches."""
    plain, quoted = F.regexp_extract("sentence", DEFINITION, 1), F.regexp_extract("sentence", QUOTED_DEFINITION, 1)
    some = functools.reduce(Column.__or__, [F.contains("sentence", F.lit(c)) for c in COPULAS])
    return F.when(some, F.when(plain != "", plain).when(quoted != "", quoted))


def _verb() -> Column:
    """The predicate of a relation as it stands; null or empty where the pattern doesn't match."""
    # (?u): letters of any script have their case folded, as in the SQL twin and in Python
    return F.when(F.regexp_like("sentence", F.lit(VERBS)), F.regexp_extract("sentence", RELATION.replace("(?i)", "(?iu)"), 2))


def _predicate() -> Column:
    return F.replace(F.lower(_verb()), F.lit("ſ"), F.lit("s"))


def definitions(sents: DataFrame) -> DataFrame:
    """sents with label and definition where a definition pattern matches, the copula pattern first."""
    plain, quoted = F.regexp_extract("sentence", DEFINITION, 1), F.regexp_extract("sentence", QUOTED_DEFINITION, 1)
    label = F.when(plain != "", plain).when(quoted != "", quoted)
    body = F.when(plain != "", F.regexp_extract("sentence", DEFINITION, 2)).otherwise(F.regexp_extract("sentence", QUOTED_DEFINITION, 2))
    return sents.withColumn("label", F.regexp_replace(label, EDGES, "")).withColumn("definition", F.regexp_replace(F.trim(body), r"[.!?]+$", "")).where("label is not null and label <> ''")


def relations(sents: DataFrame) -> DataFrame:
    """sents with subject, predicate and object where the relation pattern matches."""
    # (?u): letters of any script have their case folded, as in the SQL twin and in Python
    part = lambda i: F.regexp_extract("sentence", RELATION.replace("(?i)", "(?iu)"), i)
    return sents.where(part(2) != "").select("*", F.trim(part(1)).alias("subject"), F.replace(F.lower(part(2)), F.lit("ſ"), F.lit("s")).alias("predicate"), F.trim(F.regexp_replace(part(3), r"(?i)^the\s+", "")).alias("object"))


def models(sents: DataFrame) -> DataFrame:
    """sents with name and purpose where a model, framework, method or process is named."""
    name = F.regexp_extract("sentence", MODEL, 1)
    return sents.where(name != "").select("*", name.alias("name"), F.regexp_replace("sentence", r"[.!?]+$", "").alias("purpose"))


def terms(sents: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(key, source_id, label, definition, quote, confidence): a chunk's first mention of each label.

    Definitions come before the subject and the object of a relation in one sentence.
    """
    d = definitions(sents).select(key, "source_id", "sentence_no", F.lit(0).alias("turn"), "label", "definition", "quote")
    r = relations(sents)
    stubs = [r.select(key, "source_id", "sentence_no", F.lit(i).alias("turn"), F.regexp_replace(c, EDGES, "").alias("label"), F.lit("").alias("definition"), "quote") for i, c in ((1, "subject"), (2, "object"))]
    every = d.unionByName(stubs[0]).unionByName(stubs[1]).where("label <> ''")
    first = W.partitionBy(key, F.lower("label")).orderBy("sentence_no", "turn")
    return every.withColumn("rank", F.row_number().over(first)).where("rank = 1").select(key, "source_id", "label", "definition", "quote", F.lit(CONFIDENCE["term"]).alias("confidence"))


def axioms(sents: DataFrame, key: str = "chunk_id") -> DataFrame:
    """(key, source_id, statement, modality, quote, confidence) of definitions and relations."""
    d = definitions(sents).select(key, "source_id", F.col("sentence").alias("statement"), F.lit("definitional").alias("modality"), "quote", F.lit(CONFIDENCE["definition"]).alias("confidence"))
    r = relations(sents).select(key, "source_id", F.col("sentence").alias("statement"), F.when(F.col("predicate").isin(*CAUSAL), "causal").otherwise("descriptive").alias("modality"), "quote", F.lit(CONFIDENCE["statement"]).alias("confidence"))
    return d.unionByName(r)


def _proof() -> Column:
    """Evidence of a sentence: it is a part of its chunk, so it is verified."""
    none = F.lit(None)
    one = F.struct("source_id", "chunk_id", none.cast("array<string>").alias("heading_path"), none.cast("int").alias("page_start"), none.cast("int").alias("page_end"), "quote", F.sha2("quote", 256).alias("quote_sha256"), F.lit(True).alias("verified"))
    return F.array(one).alias("evidence")


def fragments(chunks: DataFrame, cap: int | None = SENTENCE_CAP) -> Fragments:
    """The draft claims of every chunk; a chunk is a fragment of its source at its ordinal."""
    sents = sentences(chunks.where("source_id is not null and ordinal is not null"), cap=cap, carry=("ordinal",))
    place = [F.col("ordinal").cast("bigint").alias("fragment_index"), F.col("sentence_no").alias("item_index")]
    none = F.array().cast("array<string>")
    d, r, m = definitions(sents), relations(sents), models(sents)
    bare = lambda c: F.regexp_replace(c, EDGES, "")
    at = lambda turn: (F.col("sentence_no") * 4 + turn).alias("term_index")
    base = ["source_id", "chunk_id", F.col("ordinal").cast("bigint").alias("fragment_index")]
    mention = d.select(*base, at(0), "label", "definition", "quote").unionByName(r.select(*base, at(1), bare("subject").alias("label"), F.lit("").alias("definition"), "quote")).unionByName(r.select(*base, at(2), bare("object").alias("label"), F.lit("").alias("definition"), "quote")).where("label <> ''")
    first = W.partitionBy("source_id", "chunk_id", "fragment_index", F.lower("label")).orderBy("term_index")
    terms = mention.withColumn("turn", F.row_number().over(first)).where("turn = 1").select(
        F.lit(None).cast("bigint").alias("term_id"), "source_id", "fragment_index", "term_index", "label", none.alias("aliases"), F.lit("concept").alias("kind"), "definition", none.alias("broader_labels"), none.alias("narrower_labels"), none.alias("related_labels"), F.lit(CONFIDENCE["term"]).alias("confidence"), _proof()
    )
    rel = r.select("source_id", *place, bare("subject").alias("subject_label"), "predicate", bare("object").alias("object_label"), F.create_map().cast("map<string,string>").alias("qualifiers"), F.lit(CONFIDENCE["relation"]).alias("confidence"), _proof())
    # a sentence is read once for both of its claims
    claim = lambda made, modality, c: F.when(made, F.struct(modality.alias("modality"), F.lit(c).alias("confidence")))
    made = F.array(claim(F.regexp_replace(_label(), EDGES, "") != "", F.lit("definitional"), CONFIDENCE["definition"]), claim(_verb() != "", F.when(_predicate().isin(*CAUSAL), "causal").otherwise("descriptive"), CONFIDENCE["statement"]))
    said = sents.select("source_id", "chunk_id", *place, "sentence", "quote", F.explode(made).alias("m")).where("m is not null")
    axs = said.select("source_id", "fragment_index", "item_index", F.col("sentence").alias("statement"), "m.modality", F.lit("asserted").alias("epistemic_status"), F.lit("author").alias("attribution"), none.alias("conditions"), none.alias("exceptions"), "m.confidence", _proof())
    named = m.select("source_id", *place, "name", "purpose", *[none.alias(c) for c in LISTS], F.lit(CONFIDENCE["model"]).alias("confidence"), _proof())
    asked = sents.where(F.endswith("sentence", F.lit("?"))).select("source_id", F.col("ordinal").cast("bigint").alias("fragment_index"), F.col("quote").alias("question"))
    return Fragments(terms, rel, axs, named, asked)


def reduced_axioms(found: DataFrame) -> DataFrame:
    """(source_id, statement_key, modality, statement, confidence, n_evidence): equal statements of a source as one."""
    keyed = found.withColumn("statement_key", fold_label("statement"))
    return keyed.groupBy("source_id", "statement_key", "modality").agg(
        F.min_by("statement", F.struct(-F.col("confidence"), F.col("statement"))).alias("statement"), F.max("confidence").alias("confidence"), F.count_distinct("chunk_id", F.sha2("quote", 256)).alias("n_evidence")
    )


def contradictions(axs: DataFrame) -> DataFrame:
    """(source_id, signature, n_affirmed, n_negated, kind): statements of a source that differ by a negation only."""
    sign, negated = signature(F.col("statement"))
    rows = axs.select("source_id", sign.alias("signature"), negated.alias("negated"), "modality")
    return (
        rows.groupBy("source_id", "signature")
        .agg(F.sum((~F.col("negated")).cast("int")).alias("n_affirmed"), F.sum(F.col("negated").cast("int")).alias("n_negated"), F.when(F.max(F.col("modality") == "causal"), "causal").otherwise("empirical").alias("kind"))
        .where("n_affirmed > 0 and n_negated > 0")
    )


def without_heading_prefix(chunks: DataFrame) -> DataFrame:
    """chunks whose text has lost the leading lines that only repeat a heading of heading_path (or are blank)."""
    bare = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    expected = F.transform(F.coalesce("heading_path", F.array().cast("array<string>")), bare)
    line = lambda x: bare(F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), r"^#{1,6}\s+", ""))
    lines = F.split("text", "\n")
    # the number of leading lines that are blank or a heading
    lead = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda a, x: F.when(a["on"] & ((F.trim(x) == "") | F.array_contains(expected, line(x))), F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(F.struct(a["n"].alias("n"), F.lit(False).alias("on"))),
        lambda a: a["n"],
    )
    stripped = F.array_join(F.slice(lines, lead + 1, F.size(lines)), "\n")
    return chunks.withColumn("text", F.when(F.size(expected) > 0, stripped).otherwise(F.col("text")))


def known_terms(found: DataFrame, least: float = 0.55, budget: int = 250) -> DataFrame:
    """(source_id, label_key, label, definition, confidence, n_evidence, rank) of a source's extracted terms."""
    rows = found.withColumn("label_key", fold_label("label")).where("label_key <> '' and source_id is not null")
    merged = rows.groupBy("source_id", "label_key").agg(
        F.min_by("label", F.struct(F.length("label"), F.col("label"))).alias("label"),
        F.min_by("definition", F.struct(-F.length("definition"), F.col("definition"))).alias("definition"),
        F.max("confidence").alias("confidence"),
        F.count_distinct("chunk_id", F.sha2("quote", 256)).alias("n_evidence"),
    )
    rank = F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("confidence"), F.desc("n_evidence"), "label_key"))
    return merged.where(F.col("confidence") >= least).withColumn("rank", rank).where(F.col("rank") <= budget)


def reduced_relations(found: DataFrame, terms_kept: DataFrame, budget: int = 400) -> DataFrame:
    """(source_id, subject_key, predicate, object_key, n_evidence, rank): equal relations as one, both ends surviving terms."""
    keyed = found.where("source_id is not null").select("source_id", "chunk_id", fold_label(F.regexp_replace("subject", EDGES, "")).alias("subject_key"), "predicate", fold_label(F.regexp_replace("object", EDGES, "")).alias("object_key"), "quote")
    alive = terms_kept.select("source_id", "label_key")
    both = keyed.join(alive.withColumnRenamed("label_key", "subject_key"), ["source_id", "subject_key"], "left_semi").join(alive.withColumnRenamed("label_key", "object_key"), ["source_id", "object_key"], "left_semi")
    merged = both.groupBy("source_id", "subject_key", "predicate", "object_key").agg(F.count_distinct("chunk_id", F.sha2("quote", 256)).alias("n_evidence"))
    rank = F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("n_evidence"), "predicate", "subject_key", "object_key"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= budget)


def reduced_models(found: DataFrame, budget: int = 60) -> DataFrame:
    """(source_id, name_key, name, purpose, n_evidence, rank): a named model once for each source, with its longest purpose."""
    keyed = found.where("source_id is not null").withColumn("name_key", fold_label("name"))
    merged = keyed.groupBy("source_id", "name_key").agg(F.min("name").alias("name"), F.min_by("purpose", F.struct(-F.length("purpose"), F.col("purpose"))).alias("purpose"), F.count_distinct("chunk_id", F.sha2("quote", 256)).alias("n_evidence"))
    rank = F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("n_evidence"), "name_key"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= budget)


def unpaired(terms: DataFrame, chunks: DataFrame) -> DataFrame:
    """(source_id, chunk_id, missing): fragments without a chunk and chunks without a fragment; empty where both pair one to one."""
    f = terms.where("source_id is not null and chunk_id is not null").select("source_id", "chunk_id").distinct()
    c = chunks.where("source_id is not null and chunk_id is not null").select("source_id", "chunk_id").distinct()
    both = f.withColumn("f", F.lit(1)).join(c.withColumn("c", F.lit(1)), ["source_id", "chunk_id"], "full")
    return both.where("f is null or c is null").select("source_id", "chunk_id", F.when(F.col("f").isNull(), "fragment").otherwise("chunk").alias("missing"))
