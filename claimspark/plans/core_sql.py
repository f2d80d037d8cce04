"""SQL twins of the core queries."""

from __future__ import annotations

from claimspark.operators.alignment import EFFECT_DOWN, EFFECT_UP, NEGATIONS, OPPOSED, QUANTITY_DOWN, QUANTITY_UP, STATEMENT_NEGATIONS, STATEMENT_STOP
from claimspark.operators.extraction import DEFINITION, EDGES, MODEL, QUOTED_DEFINITION, RELATION
from claimspark.operators import graph
from claimspark.plans import planted
from claimspark.plans.core_queries import BROKEN, CONCEPT, CONTESTED, MODEL_NAME, OBJECTIVE, QUESTION
from claimspark.sources.readers import ROUTES

TOKENS = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s\x0B]'))"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# half- and full-width forms, counted from the code points, and letters that fold to others
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000ſς"
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " sσ"


def fold(x: str) -> str:
    plain = f"translate({x}, {quoted(_WIDE)}, {quoted(_PLAIN)})"
    for joined, letters in (("ß", "ss"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        plain = f"replace({plain}, '{joined}', '{letters}')"
    return rf"trim(regexp_replace(translate(lower({plain}), 'ς', 'σ'), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"


def blank(x: str) -> str:
    return rf"({x} is null or not regexp_matches({x}, '[^\s\x0B]'))"


def words(items) -> str:
    return "(" + ", ".join(f"'{w}'" for w in items) + ")"


_EXT = r"lower(regexp_extract(stored_path, '\.([^./\\]+)$', 1))"
_BY = lambda i: f"case {_EXT} " + " ".join(f"when '{e}' then '{r[i]}'" for e, r in ROUTES.items()) + " end"

SENTENCES = r"""
texts as (select distinct chunk_id, source_id, text from chunks where chunk_id is not null and text is not null),
parts as (
  select chunk_id, source_id, list_filter(list_transform(
      string_split(regexp_replace(regexp_replace(text, '(?m)^#{1,6}\s+.*$', '', 'g'), '([.!?])(?:[ \t]+|\r?\n+)', '\1' || chr(30), 'g'), chr(30)),
      lambda s: regexp_replace(s, '^[\s\x0B]+|[\s\x0B]+$', '', 'g')), lambda s: s <> '') q
  from texts
),
sentences as (
  select chunk_id, source_id, unnest(generate_series(1, len(q))) sentence_no, unnest(q) quote from parts
),
spoken as (select chunk_id, source_id, sentence_no::int sentence_no, quote, trim(regexp_replace(quote, '[\s\x0B]+', ' ', 'g')) sentence from sentences)
"""
_D, _Q, _R, _M = quoted(DEFINITION), quoted(QUOTED_DEFINITION), quoted(RELATION), quoted(MODEL)
_E = quoted(EDGES)
FOUND = f"""
defined as (
  select *, regexp_replace(case when regexp_extract(sentence, {_D}, 1) <> '' then regexp_extract(sentence, {_D}, 1) else regexp_extract(sentence, {_Q}, 1) end, {_E}, '', 'g') as label,
    regexp_replace(trim(case when regexp_extract(sentence, {_D}, 1) <> '' then regexp_extract(sentence, {_D}, 2) else regexp_extract(sentence, {_Q}, 2) end), '[.!?]+$', '') as definition
  from spoken where regexp_extract(sentence, {_D}, 1) <> '' or regexp_extract(sentence, {_Q}, 1) <> ''
),
definitions as (select * from defined where label <> ''),
relations as (
  select *, trim(regexp_extract(sentence, {_R}, 1)) as subject, replace(lower(regexp_extract(sentence, {_R}, 2)), 'ſ', 's') as predicate, trim(regexp_replace(regexp_extract(sentence, {_R}, 3), '(?i)^the\\s+', '')) as object
  from spoken where regexp_extract(sentence, {_R}, 2) <> ''
),
models as (
  select *, regexp_extract(sentence, {_M}, 1) as name, regexp_replace(sentence, '[.!?]+$', '') as purpose from spoken where regexp_extract(sentence, {_M}, 1) <> ''
)
"""
AXIOMS = f"""
axioms as (
  select chunk_id, source_id, sentence as statement, 'definitional' as modality, quote, 0.64 as confidence from definitions
  union all
  select chunk_id, source_id, sentence, case when predicate in ('causes', 'produces', 'prevents') then 'causal' else 'descriptive' end, quote, 0.61 from relations
),
reduced_ax as (
  select source_id, {fold("statement")} as statement_key, modality, arg_min(statement, (-confidence, statement)) as statement, max(confidence)::double as confidence,
    count(distinct (chunk_id, sha256(quote))) as n_evidence
  from axioms group by 1, 2, 3
)
"""
_EX = "with " + SENTENCES + "," + FOUND
_AX = _EX + "," + AXIOMS
# the same with the planted chunks
_EXP = "with " + planted.chunks_sql() + "," + SENTENCES.replace("from chunks where", "from all_chunks where") + "," + FOUND
_AXP = _EXP + "," + AXIOMS
CONTRADICTIONS = f"""
signed as (
  select source_id, modality, list_filter(string_split({fold("statement")}, ' '), lambda w: w in ('no', 'not', 'never', 'cannot')) neg,
    list_filter(string_split({fold("statement")}, ' '), lambda w: w not in ('no', 'not', 'never', 'cannot', 'do', 'does', 'did')) base from reduced_ax
),
contradicting as (
  select source_id, array_to_string(list_transform(base, lambda w: case when len(w) > 3 and w like '%s' and w not like '%ss' and w not like '%is' and w not like '%us' then left(w, len(w) - 1) else w end), ' ') signature,
    sum((len(neg) = 0)::int)::bigint n_affirmed, sum((len(neg) > 0)::int)::bigint n_negated, case when bool_or(modality = 'causal') then 'causal' else 'empirical' end kind
  from signed group by 1, 2 having sum((len(neg) = 0)::int) > 0 and sum((len(neg) > 0)::int) > 0
)
"""
_POLAR = (*EFFECT_UP, *EFFECT_DOWN, *QUANTITY_UP, *QUANTITY_DOWN)


def _direction(up, down) -> str:
    last = f"list_last(list_filter(tokens, lambda w: w in {words((*up, *down))}))"
    return f"coalesce(case when {last} in {words(up)} then 1 when {last} in {words(down)} then -1 end, 0) * case when negated then -1 else 1 end"


OPPOSED_ST = f"""
tokened as (select statement, list_sort(list_distinct(list(modality))) modalities, regexp_extract_all(replace(lower(statement), '''', ''), '[a-z0-9]+') tokens from axioms group by statement),
flagged as (select *, len(list_filter(tokens, lambda w: w in {words(STATEMENT_NEGATIONS)})) > 0 negated from tokened),
sig as (
  select statement, modalities, negated, {_direction(EFFECT_UP, EFFECT_DOWN)} effect, {_direction(QUANTITY_UP, QUANTITY_DOWN)} quantity,
    list_distinct(list_transform(list_filter(tokens, lambda w: w not in {words(STATEMENT_STOP)} and w not in {words(STATEMENT_NEGATIONS)} and w not in {words(_POLAR)}),
      lambda w: regexp_replace(w, '^(.{{4,}}?)(?:ization|ation|ments|ment|ing|ed|es|s)$', '\\1'))) content
  from flagged
),
opposed as (
  select l.statement left_statement, r.statement right_statement, list_concat(l.modalities, r.modalities) m
  from sig l join sig r on l.statement < r.statement
  where (l.negated or l.effect <> 0 or l.quantity <> 0 or r.negated or r.effect <> 0 or r.quantity <> 0)
    and (l.effect * r.effect = -1 or l.quantity * r.quantity = -1 or l.negated <> r.negated)
    and len(list_intersect(l.content, r.content)) >= 2
    and len(list_intersect(l.content, r.content)) / len(list_distinct(list_concat(l.content, r.content)))::double >= 0.40
),
opposing as (select left_statement, right_statement, case when list_contains(m, 'normative') then 'normative' when list_contains(m, 'methodological') or list_contains(m, 'heuristic') then 'methodological' when list_contains(m, 'causal') then 'causal' else 'empirical' end kind from opposed)
"""
DRAFTS = f"""
flat as (select distinct term_id, source_id, fragment_index, term_index, label, aliases, kind, definition, broader_labels, narrower_labels, related_labels, confidence, evidence from draft_terms),
drafts as (
  select * replace (case when confidence between 0 and 1 then confidence end as confidence, list_filter(coalesce(evidence, []), lambda e: coalesce(e.verified, false)) as evidence), {fold("label")} label_key
  from flat where source_id is not null and {fold("label")} <> ''
),
proofs as (
  select source_id, label_key, e.source_id evidence_source, e.chunk_id chunk_id, e.quote_sha256 quote_sha256, coalesce(e.page_start, 0) page_start, coalesce(e.page_end, 0) page_end, min(e.quote) quote
  from (select source_id, label_key, unnest(evidence) e from drafts) group by all
),
proof_counts as (select source_id, label_key, count(*) n_evidence from proofs group by all),
spelt as (select source_id, label_key, trim(label) label, count(*) n, max(coalesce(confidence, -1.0)) c from drafts group by all),
labels as (select source_id, label_key, arg_min(label, (-n, -c, len(label), label)) label, sum(n)::bigint n from spelt group by all),
definitions_best as (
  select source_id, label_key, trim(regexp_replace(arg_min(definition, (-coalesce(confidence, -1.0), -len(evidence), -len(definition), definition)), '[\\s\\x0B]+', ' ', 'g')) definition
  from drafts where not {blank("definition")} group by all
),
kinds_each as (select source_id, label_key, kind, sum(round(coalesce(confidence, 0.0) * 1e6)::bigint)::bigint w, count(*) n from drafts where kind is not null group by all),
kinds_best as (select source_id, label_key, arg_min(kind, (-w, -n, kind)) kind from kinds_each group by all),
salient as (
  select l.source_id, l.label_key, l.label, k.kind, coalesce(b.definition, '') definition, t.confidence, p.n_evidence,
    (row_number() over (partition by l.source_id order by t.confidence desc, p.n_evidence desc, l.label_key))::int rank
  from labels l join (select source_id, label_key, max(confidence) confidence from drafts group by all) t using (source_id, label_key)
    join proof_counts p using (source_id, label_key) left join definitions_best b using (source_id, label_key) left join kinds_best k using (source_id, label_key)
  where t.confidence >= 0.55 qualify rank <= 250
),
stated_links as (
  select source_id, label_key, 'broader' link, 'narrower' inverse, unnest(broader_labels) o from drafts union all
  select source_id, label_key, 'narrower', 'broader', unnest(narrower_labels) from drafts union all
  select source_id, label_key, 'related', 'related', unnest(related_labels) from drafts
),
keyed_links as (select distinct source_id, label_key, link, inverse, {fold("o")} other_key from stated_links where {fold("o")} <> '' and {fold("o")} <> label_key),
alive_links as (select k.* from keyed_links k semi join salient s using (source_id, label_key) where exists (select 1 from salient x where x.source_id = k.source_id and x.label_key = k.other_key)),
links as (select source_id, label_key, link, other_key from alive_links union select source_id, other_key, inverse, label_key from alive_links)
"""
_DR = "with " + DRAFTS
CLASSES = """
classes as (select sha256(label_key || chr(1) || definition) class_id, label_key, definition, count(distinct source_id) n_sources, min(source_id) first_source from salient group by all)
"""


def _wordset(x: str) -> str:
    return f"case when {fold(x)} = '' then []::varchar[] else list_distinct(string_split({fold(x)}, ' ')) end"


def _overlap(a: str, b: str) -> str:
    return f"case when len({a}) > 0 and len({b}) > 0 then len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::double else 0.0 end"


_NEG = "[" + ", ".join(f"'{w}'" for w in NEGATIONS) + "]"
_APART = " or ".join(f"(list_contains(ld, '{x}') and list_contains(rd, '{y}') and not list_contains(ld, '{y}') and not list_contains(rd, '{x}')) or (list_contains(ld, '{y}') and list_contains(rd, '{x}') and not list_contains(ld, '{x}') and not list_contains(rd, '{y}'))" for x, y in OPPOSED)
FEATURES = f"""
paired as (
  select l.class_id left_id, r.class_id right_id, l.label_key left_label, r.label_key right_label, string_split(l.label_key, ' ') la, string_split(r.label_key, ' ') ra,
    {_wordset("l.label_key")} lw, {_wordset("r.label_key")} rw, {_wordset("l.definition")} ld, {_wordset("r.definition")} rd
  from classes l join classes r on l.class_id < r.class_id
),
measured as (
  select *, left_label = right_label equal_label, len(la) > len(ra) and contains(' ' || left_label || ' ', ' ' || right_label || ' ') as "contains",
    len(la) < len(ra) and contains(' ' || right_label || ' ', ' ' || left_label || ' ') contained, {_overlap("lw", "rw")} lo from paired
),
features as (
  select left_id, right_id, left_label, right_label, equal_label, "contains", contained, round(lo, 6) label_overlap, round({_overlap("ld", "rd")}, 6) definition_overlap,
    ((len(list_intersect(ld, {_NEG})) > 0) <> (len(list_intersect(rd, {_NEG})) > 0) or {_APART})
      and {_overlap(f"list_filter(ld, lambda w: not list_contains({_NEG}, w))", f"list_filter(rd, lambda w: not list_contains({_NEG}, w))")} >= 0.5 opposed
  from measured where equal_label or "contains" or contained or lo >= 0.66
)
"""


def _uri(kind: str, *parts: str) -> str:
    return f"'urn:claimspark:{kind}'" + "".join(f" || ':' || url_encode({p})" for p in parts)


_RDF, _SKOS, _PROV, _BASE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/ns/prov#", "urn:claimspark:"
_S, _C, _EV = _uri("source", "source_id"), _uri("concept", "source_id", "label_key"), _uri("evidence", "evidence_source", "chunk_id", "quote_sha256")
QUADS = f"""
proofs_kept as (select * from proofs semi join salient using (source_id, label_key) where chunk_id is not null and quote_sha256 is not null and quote is not null and evidence_source is not null),
quads as (
  select {_S} graph, {_C} subject, '{_RDF}type' predicate, '{_SKOS}Concept' as object, 'uri' object_kind from salient
  union select {_S}, {_C}, '{_SKOS}prefLabel', label, 'literal' from salient
  union select {_S}, {_C}, '{_SKOS}definition', definition, 'literal' from salient where definition <> ''
  union select {_S}, {_C}, '{_BASE}kind', kind, 'literal' from salient where kind is not null
  union select {_S}, {_C}, '{_BASE}confidence', format('{{:.4f}}', confidence), 'http://www.w3.org/2001/XMLSchema#decimal' from salient
  union select {_S}, {_C}, '{_SKOS}' || link, {_uri("concept", "source_id", "other_key")}, 'uri' from links
  union select {_S}, {_EV}, '{_RDF}type', '{_PROV}Entity', 'uri' from proofs_kept
  union select {_S}, {_EV}, '{_PROV}value', quote, 'literal' from proofs_kept
  union select {_S}, {_EV}, '{_BASE}sha256', quote_sha256, 'literal' from proofs_kept
  union select {_S}, {_EV}, '{_PROV}wasQuotedFrom', {_uri("chunk", "chunk_id")}, 'uri' from proofs_kept
  union select {_S}, {_C}, '{_PROV}wasDerivedFrom', {_EV}, 'uri' from proofs_kept
  union select {_S}, {_uri("chunk", "chunk_id")}, '{_PROV}hadPrimarySource', {_uri("source", "evidence_source")}, 'uri' from proofs_kept
)
"""
INDEX = """
index_rows as (
  select e.source_id source_id, e.chunk_id chunk_id, e.quote_sha256 quote_sha256, min(e.quote) quote, count(distinct label_key) n_claims
  from (select label_key, unnest(evidence) e from drafts) where e.quote is not null group by 1, 2, 3
)
"""
_ASKED = sorted({w for w in "".join(c if c.isalnum() else " " for c in QUESTION.casefold()).split()})
_LIST = "[" + ", ".join(f"'{w}'" for w in _ASKED) + "]"
_SHARED = f"len(list_intersect(list_distinct(regexp_extract_all(lower(quote), '[a-z0-9]+')), {_LIST}))"
RETRIEVED = f"""
retrieved as (
  select source_id, chunk_id, quote_sha256, quote, round(least(1.0, {_SHARED} / {len(_ASKED)}.0::double + case when contains(lower(quote), {quoted(QUESTION.casefold())}) then 0.25 else 0.0 end), 4)::double score
  from index_rows where {_SHARED} > 0
)
"""
_KEY, _AGAINST = fold(quoted(CONCEPT)), fold(quoted(CONTESTED))
_MENTIONS = f"""
mentions as (
  select chunk_id, source_id, sentence_no, 0 turn, label, definition, quote from definitions union all
  select chunk_id, source_id, sentence_no, 1, regexp_replace(subject, {_E}, '', 'g'), '', quote from relations union all
  select chunk_id, source_id, sentence_no, 2, regexp_replace(object, {_E}, '', 'g'), '', quote from relations),
first_mentions as (select * from mentions where label <> '' qualify row_number() over (partition by chunk_id, lower(label) order by sentence_no, turn) = 1),
known as (
  select source_id, {fold("label")} label_key, arg_min(label, (len(label), label)) as label, arg_min(definition, (-len(definition), definition)) definition, 0.66::double confidence, count(distinct (chunk_id, sha256(quote))) n_evidence,
    (row_number() over (partition by source_id order by count(distinct (chunk_id, sha256(quote))) desc, {fold("label")}))::int rank
  from first_mentions where source_id is not null and {fold("label")} <> '' group by source_id, {fold("label")} qualify rank <= 250)
"""
_KNOWN = _EX + "," + _MENTIONS



def _hash(prefix: str, *parts: str) -> str:
    return f"'{prefix}' || left(sha256(concat_ws(chr(31), {', '.join(parts)})), 16)"


def _proof(source: str = "source_id") -> str:
    """The identity of a claim's evidence: page numbers are 0."""
    return f"bit_xor(('0x' || left(sha256(concat_ws(chr(31), {source}, chunk_id, sha, '0', '0')), 15))::bigint)"


_ONTO_ROWS = SENTENCES.replace("from chunks where", "from all_chunks where source_id is not null and ordinal is not null and")
_LESS = "row_number() over (partition by source_id order by confidence desc, n_evidence desc, {0}, claim_id)"
ONTOLOGY = (
    "with " + planted.chunks_sql() + "," + _ONTO_ROWS + "," + FOUND + "," + _MENTIONS.replace("known as (", "known_unused as (") + "," + AXIOMS.replace("union all\n  select chunk_id, source_id, sentence, case", f"union all {planted.norms_sql()} union all\n  select chunk_id, source_id, sentence, case")
    + f""",
tm as (select source_id, {fold("label")} label_key, trim(label) as label, definition, chunk_id, quote from first_mentions where {fold("label")} <> ''),
tm_n as (select source_id, label_key, label, count(*) n from tm group by all),
tm_label as (select source_id, label_key, arg_min(label, (-n, len(label), {fold("label")}, label)) as label from tm_n group by all),
tm_def as (select source_id, label_key, trim(regexp_replace(arg_min(definition, (-len(definition), definition)), '[\\s\\x0B]+', ' ', 'g')) definition from tm where not {blank("definition")} group by all),
tm_ev as (select source_id, label_key, chunk_id, sha256(quote) sha, min(quote) quote from tm group by source_id, label_key, chunk_id, sha256(quote)),
tm_sum as (select source_id, label_key, count(*) n_evidence, {_proof()} proof from tm_ev group by source_id, label_key),
terms as (
  select source_id, {_hash("term:", "source_id", "label_key", "'concept'", "coalesce(definition, '')", "proof::varchar")} claim_id, label_key, label, 'concept' kind, coalesce(definition, '') definition, 0.66::double confidence, n_evidence,
    (row_number() over (partition by source_id order by n_evidence desc, label_key))::int as rank
  from tm_label join tm_sum using (source_id, label_key) left join tm_def using (source_id, label_key) qualify rank <= 250
),
rl as (
  select r.source_id source_id, s.claim_id subject_id, o.claim_id object_id, {fold("predicate")} predicate_key, trim(predicate) predicate, chunk_id, quote, s.label subject_label, o.label object_label
  from relations r join terms s on s.source_id = r.source_id and s.label_key = {fold(f"regexp_replace(subject, {_E}, '', 'g')")} join terms o on o.source_id = r.source_id and o.label_key = {fold(f"regexp_replace(object, {_E}, '', 'g')")}
),
rl_ev as (select source_id, subject_id, predicate_key, object_id, chunk_id, sha256(quote) sha, min(quote) quote from rl group by source_id, subject_id, predicate_key, object_id, chunk_id, sha256(quote)),
rl_sum as (select source_id, subject_id, predicate_key, object_id, count(*) n_evidence, {_proof()} proof from rl_ev group by source_id, subject_id, predicate_key, object_id),
rl_best as (select source_id, subject_id, predicate_key, object_id, arg_min(predicate, (len(predicate), lower(predicate), predicate)) predicate, any_value(subject_label) subject_label, any_value(object_label) object_label from rl group by source_id, subject_id, predicate_key, object_id),
rel_ids as (select *, {_hash("relation:", "source_id", "subject_id", "predicate_key", "object_id", "''", "proof::varchar")} claim_id, 0.62::double confidence from rl_best join rl_sum using (source_id, subject_id, predicate_key, object_id)),
relation_claims as (select *, ({_LESS.format(fold("predicate"))})::int as rank from rel_ids qualify rank <= 400),
ax as (select source_id, {fold("statement")} statement_key, modality, statement, confidence, chunk_id, quote from axioms where source_id is not null and {fold("statement")} <> ''),
ax_ev as (select source_id, statement_key, modality, chunk_id, sha256(quote) sha, min(quote) quote from ax group by source_id, statement_key, modality, chunk_id, sha256(quote)),
ax_sum as (select source_id, statement_key, modality, count(*) n_evidence, {_proof()} proof from ax_ev group by source_id, statement_key, modality),
ax_best as (select source_id, statement_key, modality, arg_min(statement, (-confidence, statement)) as statement, max(confidence)::double confidence from ax group by source_id, statement_key, modality),
ax_ids as (select *, {_hash("axiom:", "source_id", "statement_key", "modality", "'asserted'", "'author'", "''", "''", "proof::varchar")} claim_id from ax_best join ax_sum using (source_id, statement_key, modality)),
axiom_claims as (select *, 'asserted' epistemic_status, 'author' attribution, ({_LESS.format(fold("statement"))})::int as rank from ax_ids qualify rank <= 200),
md as (select source_id, {fold("name")} name_key, trim(name) as name, trim(purpose) purpose, chunk_id, quote from models where {fold("name")} <> ''),
md_ev as (select source_id, name_key, chunk_id, sha256(quote) sha, min(quote) quote from md group by source_id, name_key, chunk_id, sha256(quote)),
md_sum as (select source_id, name_key, count(*) n_evidence, {_proof()} proof from md_ev group by source_id, name_key),
md_best as (select source_id, name_key, min(name) as name, arg_min(purpose, (-len(purpose), purpose)) purpose, 0.58::double confidence from md group by source_id, name_key),
md_ids as (select *, {_hash("model:", "source_id", "name_key", "purpose", "proof::varchar")} claim_id from md_best join md_sum using (source_id, name_key)),
model_claims as (select *, ({_LESS.format(fold("name"))})::int as rank from md_ids qualify rank <= 60),
proofs_of as (
  select source_id, claim_id, chunk_id, sha, quote from tm_ev join terms using (source_id, label_key)
  union all select source_id, claim_id, chunk_id, sha, quote from rl_ev join relation_claims using (source_id, subject_id, predicate_key, object_id)
  union all select source_id, claim_id, chunk_id, sha, quote from ax_ev join axiom_claims using (source_id, statement_key, modality)
  union all select source_id, claim_id, chunk_id, sha, quote from md_ev join model_claims using (source_id, name_key)
),
signs as (
  select source_id, claim_id, modality, list_filter(string_split({fold("statement")}, ' '), lambda w: w in ('no', 'not', 'never', 'cannot')) neg,
    list_filter(string_split({fold("statement")}, ' '), lambda w: w not in ('no', 'not', 'never', 'cannot', 'do', 'does', 'did')) base from axiom_claims
),
conflicts as (
  select source_id, array_to_string(list_transform(base, lambda w: case when len(w) > 3 and w like '%s' and w not like '%ss' and w not like '%is' and w not like '%us' then left(w, len(w) - 1) else w end), ' ') signature,
    list_sort(list_distinct(list(claim_id))) claim_ids, case when bool_or(modality = 'causal') then 'causal' else 'empirical' end kind
  from signs group by source_id, signature having bool_or(len(neg) > 0) and bool_or(len(neg) = 0)
),
conflict_claims as (select source_id, {_hash("conflict:", "source_id", "signature", "array_to_string(claim_ids, chr(31))")} conflict_id, signature, claim_ids, kind from conflicts),
parts_of as (
  select source_id, claim_id, confidence, n_evidence, {fold("statement")} by_, trim(statement) txt from axiom_claims
  union all select source_id, claim_id, confidence, n_evidence, {fold("label")}, case when {blank("definition")} then label else label || ': ' || trim(definition) end from terms
  union all select source_id, claim_id, confidence, n_evidence, {fold("name")}, case when {blank("purpose")} then name else name || ': ' || trim(purpose) end from model_claims
),
tops as (select *, row_number() over (partition by source_id order by confidence desc, n_evidence desc, by_, claim_id) rk from parts_of where txt <> '' qualify rk <= 8),
abstracts as (select source_id, string_agg(txt, chr(10) || chr(10) order by rk) abstract, list(claim_id order by rk) support_ids from tops group by 1),
questions as (
  select distinct q.source_id source_id, q.question question from (select distinct source_id, trim(regexp_replace(quote, '[\\s\\x0B]+', ' ', 'g')) question from spoken where sentence like '%?') q
  join proofs_of p on p.source_id = q.source_id and contains(p.quote, q.question)
)
"""
)
_CL, _ON = "'urn:claimspark:claim:' || claim_id", _uri("ontology", "source_id")
_DC, _OWL, _RDFS = graph.DCTERMS, graph.OWL, graph.RDFS
_DEC = "http://www.w3.org/2001/XMLSchema#decimal"
_EVI, _CHU = _uri("evidence", "source_id", "chunk_id", "sha"), _uri("chunk", "source_id", "chunk_id")
_PRED = "case when regexp_matches(predicate, '^(https?://|urn:)') then predicate else 'urn:claimspark:relation:' || coalesce(nullif(left(regexp_replace(regexp_replace(lower(predicate), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 64), ''), 'item') end"


def _kind_sql(table: str, type_: str, has: str, *more: tuple[str, str, str]) -> str:
    rows = [(_RDF + "type", f"'{type_}'", "uri"), (_DC + "identifier", "claim_id", "literal"), (_BASE + "confidence", "format('{:.4f}', confidence)", _DEC), *more]
    return " union all ".join([*[f"select {_S} graph, {_CL} subject, '{p}' predicate, {o} as object, '{k}' object_kind from {table}" for p, o, k in rows], f"select {_S}, {_ON}, '{_BASE}{has}', {_CL}, 'uri' from {table}"])


_TRIPLES = " union all ".join(
    [
        _kind_sql("terms", _SKOS + "Concept", "hasTerm", (_SKOS + "prefLabel", "label", "literal"), (_SKOS + "definition", "definition", "literal"), (_BASE + "kind", "kind", "literal")),
        _kind_sql("relation_claims", _BASE + "Relation", "hasRelation", (_RDF + "type", f"'{_RDF}Statement'", "uri"), (_RDF + "subject", "'urn:claimspark:claim:' || subject_id", "uri"), (_RDF + "predicate", _PRED, "uri"), (_RDF + "object", "'urn:claimspark:claim:' || object_id", "uri"), (_BASE + "predicateLabel", "predicate", "literal")),
        f"select {_S}, 'urn:claimspark:claim:' || subject_id, {_PRED}, 'urn:claimspark:claim:' || object_id, 'uri' from relation_claims",
        f"select {_S}, {_PRED}, '{_RDF}type', '{_RDF}Property', 'uri' from relation_claims union all select {_S}, {_PRED}, '{_RDFS}label', predicate, 'literal' from relation_claims",
        _kind_sql("axiom_claims", _BASE + "Axiom", "hasAxiom", *[(_BASE + n, c, "literal") for c, n in (("statement", "statement"), ("modality", "modality"), ("epistemic_status", "epistemicStatus"), ("attribution", "attribution"))]),
        _kind_sql("model_claims", _BASE + "MentalModel", "hasMentalModel", (_RDFS + "label", "name", "literal"), (_BASE + "purpose", "purpose", "literal")),
        *[f"select {_S}, 'urn:claimspark:claim:' || conflict_id, '{p}', {o}, '{k}' from conflict_claims" for p, o, k in ((_RDF + "type", f"'{_BASE}Conflict'", "uri"), (_DC + "identifier", "conflict_id", "literal"), (_BASE + "conflictKind", "kind", "literal"), (_BASE + "resolution", "'unresolved'", "literal"))],
        f"select {_S}, 'urn:claimspark:claim:' || conflict_id, '{_BASE}conflictingClaim', 'urn:claimspark:claim:' || c, 'uri' from (select source_id, conflict_id, unnest(claim_ids) c from conflict_claims)",
        *[f"select {_S}, {_ON}, '{p}', {o}, '{k}' from abstracts" for p, o, k in ((_RDF + "type", f"'{_OWL}Ontology'", "uri"), (_DC + "identifier", "source_id", "literal"), (_DC + "title", "source_id", "literal"), (_DC + "abstract", "abstract", "literal"), (_PROV + "wasDerivedFrom", _S, "uri"))],
        f"select {_S}, {_ON}, '{_BASE}abstractSupport', 'urn:claimspark:claim:' || c, 'uri' from (select source_id, unnest(support_ids) c from abstracts)",
        f"select {_S}, {_ON}, '{_BASE}openQuestion', question, 'literal' from questions",
        *[f"select {_S}, {_EVI}, '{p}', {o}, '{k}' from proofs_of" for p, o, k in ((_RDF + "type", f"'{_BASE}Evidence'", "uri"), (_RDF + "type", f"'{_PROV}Entity'", "uri"), (_BASE + "sourceId", "source_id", "literal"), (_BASE + "chunkId", "chunk_id", "literal"), (_BASE + "quote", "quote", "literal"), (_BASE + "quoteSha256", "sha", "literal"), (_BASE + "verified", "'true'", "http://www.w3.org/2001/XMLSchema#boolean"), (_PROV + "wasDerivedFrom", _CHU, "uri"))],
        f"select {_S}, {_CL}, '{_PROV}wasDerivedFrom', {_EVI}, 'uri' from proofs_of",
        *[f"select {_S}, {_CHU}, '{p}', {o}, '{k}' from proofs_of" for p, o, k in ((_RDF + "type", f"'{_PROV}Entity'", "uri"), (_DC + "identifier", "chunk_id", "literal"), (_PROV + "wasDerivedFrom", _S, "uri"))],
        *[f"select {_S}, {_S}, '{p}', {o}, '{k}' from proofs_of" for p, o, k in ((_RDF + "type", f"'{_PROV}Entity'", "uri"), (_DC + "identifier", "source_id", "literal"))],
    ]
)
ONTOLOGY_QUADS = f"quads as (select distinct * from ({_TRIPLES}))"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("null" if x is None else str(x) if isinstance(x, (int, float)) else quoted(x) for x in r) + ")" for r in rows)


_SHAPE_ROWS = _values([(i, x.target, x.path, x.least, x.most, x.node_kind, x.target_class, x.min_length, x.max_length, x.low, x.high, x.value) for i, x in enumerate(graph.ONTOLOGY_SHAPES)])
SHAPES_CHECKED = f"""
all_quads as (select * from quads union all select * from (values {_values(BROKEN)}) v(graph, subject, predicate, object, object_kind)),
shapes as (select * from (values {_SHAPE_ROWS}) v(shape, target, path, least, most, kind, cls, lo_len, hi_len, low, high, val)),
focus as (select distinct q.graph, q.subject, s.* from all_quads q join shapes s on q.predicate = '{_RDF}type' and q.object = s.target),
met as (select f.*, q.object, q.object_kind from focus f left join all_quads q on q.graph = f.graph and q.subject = f.subject and q.predicate = f.path),
checked as (
  select graph, subject, path, shape, list_filter([case when count(object) < any_value(least) then 'least' end, case when count(object) > any_value(most) then 'most' end, case when bool_or(object_kind <> kind) then 'node_kind' end,
    case when bool_or(len(object) < lo_len) then 'min_length' end, case when bool_or(len(object) > hi_len) then 'max_length' end, case when bool_or(object is not null and low is not null and not coalesce(try_cast(object as double) between low and high, false)) then 'range' end,
    case when bool_or(object <> val) then 'value' end], lambda x: x is not null) found
  from met group by graph, subject, path, shape
)
select distinct graph, subject, path, unnest(found) as "constraint" from checked
union select distinct graph, subject, path, 'class' from met m where cls is not null and object is not null and not exists (select 1 from all_quads t where t.graph = m.graph and t.subject = m.object and t.predicate = '{_RDF}type' and t.object = m.cls)
"""
FRAMES = f"""
contested as (select distinct source_id, unnest(claim_ids) support from conflict_claims),
believed as (
  select source_id, 'term' kind, claim_id support, label || ': ' || definition proposition, 'accepted' status, confidence from terms
  union all select source_id, 'axiom', claim_id, statement, 'accepted', confidence from axiom_claims
  union all select source_id, 'relation', claim_id, subject_label || ' ' || predicate || ' ' || object_label || '.', 'accepted', confidence from relation_claims
  union all select source_id, 'model', claim_id, source_id || ' proposes the model ' || name || ' for: ' || purpose, 'conditional', confidence from model_claims
),
beliefs as (
  select {_hash("belief-", "b.source_id", "b.support", "proposition")} belief_id, b.source_id source_id, kind, b.support support, proposition, case when c.support is not null then 'contested' else status end status, 'source' origin, confidence
  from believed b left join contested c on c.source_id = b.source_id and c.support = b.support
),
norms as (select {_hash("norm-", "source_id", "claim_id")} desire_id, claim_id from axiom_claims where modality = 'normative'),
intentions as (
  select {_hash("deliberate-", "''", "'objective'")} intention_id, 'deliberate' kind, null source_id, 'objective' subject
  union all select {_hash("apply-", "source_id", "claim_id")}, 'apply', source_id, claim_id from model_claims
  union all select {_hash("surface-", "source_id", "conflict_id")}, 'surface', source_id, conflict_id from conflict_claims
),
first_beliefs as (select belief_id from beliefs order by source_id, case kind when 'term' then 0 when 'axiom' then 1 when 'relation' then 2 else 3 end, belief_id limit 12),
links as (
  select intention_id, 'belief' kind, belief_id target from intentions, first_beliefs where kind = 'deliberate'
  union all select intention_id, 'belief', belief_id from intentions i join beliefs b on i.kind = 'apply' and b.source_id = i.source_id and b.support = i.subject
  union all select intention_id, 'belief', belief_id from intentions i join (select source_id, conflict_id, unnest(claim_ids) support from conflict_claims) c on i.kind = 'surface' and c.source_id = i.source_id and c.conflict_id = i.subject join beliefs b on b.source_id = c.source_id and b.support = c.support
  union all select intention_id, 'desire', unnest(case kind when 'deliberate' then ['objective', 'provenance', 'conflicts'] when 'surface' then ['conflicts', 'objective'] else ['objective'] end) from intentions
  union all select intention_id, 'model', subject from intentions where kind = 'apply'
)
"""
#: What the planted unfit rows of frame_findings must give, by hand.
_UNFIT = [
    ("unlinked_synthesized_subgoal", "bad-goal", 0), ("intrinsic_mental_status_assertion", "bad-goal", 0), ("source_norm_semantic_mismatch", "bad-norm", 1), ("source_norm_semantic_mismatch", "bad-parent", 1), ("invalid_desire_parentage", "bad-parent", 0),
    ("dangling_belief_support", "bad-1", 1), ("ungrounded_source_belief", "bad-2", 1), ("unsupported_synthesized_belief", "bad-3", 1), ("intention_uses_ungrounded_belief", "bad-intent", 1), ("intention_not_objective_directed", "bad-intent", 1),
    ("missing_stop_conditions", "bad-intent", 1), ("dangling_adopted_mental_model", "model:none", 1), ("missing_source_synthesis_separation", "frame", 1), ("missing_citation_contract", "frame", 1), ("missing_uncertainty_policy", "frame", 1),
    ("noncanonical_beliefs", "frame", 1), ("noncanonical_desires", "frame", 1), ("noncanonical_intentions", "frame", 1), ("noncanonical_adopted_mental_models", "frame", 1), ("noncanonical_frame_semantics", "frame", 1),
]
_O = ONTOLOGY

ORACLES = {
    "source_routes": f"select source_id, {_EXT} extension, {_BY(0)} backend, {_BY(1)} media_type from (select distinct * from sources)",
    "document_fingerprints": "select doc_id, sha256(text) content_sha256, strlen(text)::int size_bytes from documents where text is not null",
    "duplicate_texts": "select sha256(text) content_sha256, count(*) n_docs, min(doc_id) first_doc_id from documents where text is not null group by 1 having count(*) > 1",
    "chunk_token_counts": f"select chunk_id, token_count, {TOKENS.format('text')}::int tokens, token_count is distinct from {TOKENS.format('text')} stale_count, content_sha256 is distinct from sha256(text) stale_hash from (select distinct chunk_id, text, token_count, content_sha256 from chunks)",
    "chunk_split_sizes": f"select chunk_id, piece_no::int piece_no, least(1800, n - (piece_no - 1) * 1800)::int tokens from (select chunk_id, n, unnest(generate_series(1, greatest(ceil(n / 1800.0)::bigint, 1))) piece_no from (select chunk_id, {TOKENS.format('text')} n from (select distinct chunk_id, text from chunks where chunk_id is not null and text is not null)))",
    "source_profiles": "select source_id, count(*) n_chunks, sum(coalesce(len(heading_path), 0))::bigint n_headings, min(least(page_start, page_end)) first_page, max(greatest(page_start, page_end)) last_page from (select distinct source_id, chunk_id, heading_path, page_start, page_end from chunks where source_id is not null) group by 1",
    "heading_counts": "select source_id, h heading, count(*) n from (select source_id, unnest(heading_path) h from (select distinct source_id, chunk_id, heading_path from chunks where source_id is not null)) group by 1, 2",
    "chunk_sentences": "with " + SENTENCES + " select chunk_id, sentence_no, sentence from spoken",
    "definition_statements": _EX + " select chunk_id, sentence_no, label, definition from definitions",
    "relation_statements": _EX + " select chunk_id, sentence_no, subject, predicate, object from relations",
    "named_models": _EX + " select chunk_id, sentence_no, name, purpose from models",
    "extracted_terms": _EX + f""", mentions as (
  select chunk_id, sentence_no, 0 turn, label, definition, quote from definitions union all
  select chunk_id, sentence_no, 1, regexp_replace(subject, {_E}, '', 'g'), '', quote from relations union all
  select chunk_id, sentence_no, 2, regexp_replace(object, {_E}, '', 'g'), '', quote from relations)
select chunk_id, label, definition, sha256(quote) quote_sha256 from mentions where label <> '' qualify row_number() over (partition by chunk_id, lower(label) order by sentence_no, turn) = 1""",
    "known_terms": _KNOWN + " select * from known",
    "reduced_relations": _KNOWN + f""", ends as (select source_id, chunk_id, {fold(f"regexp_replace(subject, {_E}, '', 'g')")} subject_key, predicate, {fold(f"regexp_replace(object, {_E}, '', 'g')")} object_key, quote from relations where source_id is not null),
merged as (select source_id, subject_key, predicate, object_key, count(distinct (chunk_id, sha256(quote))) n_evidence from ends e where exists (select 1 from known k where k.source_id = e.source_id and k.label_key = e.subject_key) and exists (select 1 from known k where k.source_id = e.source_id and k.label_key = e.object_key) group by all)
select *, (row_number() over (partition by source_id order by n_evidence desc, predicate, subject_key, object_key))::int rank from merged qualify rank <= 400""",
    "reduced_models": _EX + f""", merged as (select source_id, {fold("name")} name_key, min(name) as name, arg_min(purpose, (-len(purpose), purpose)) purpose, count(distinct (chunk_id, sha256(quote))) n_evidence from models where source_id is not null group by 1, 2)
select *, (row_number() over (partition by source_id order by n_evidence desc, name_key))::int rank from merged qualify rank <= 60""",
    "reduced_axioms": _AX + " select * from reduced_ax",
    "axiom_contradictions": _AXP + "," + CONTRADICTIONS + " select * from contradicting",
    "opposed_statements": _AXP + "," + OPPOSED_ST + " select * from opposing",
    "quote_status": f"""with rows_ as (select distinct evidence_id, chunk_id, quote, quote_sha256 from evidence), texts as (select distinct chunk_id, text from chunks where chunk_id is not null and text is not null),
hits as (select evidence_id, max(contains(text, quote)) exact, max(contains(trim(regexp_replace(text, '[\\s\\x0B]+', ' ', 'g')), trim(regexp_replace(quote, '[\\s\\x0B]+', ' ', 'g')))) loose from rows_ join texts using (chunk_id) group by 1)
select evidence_id, case when {blank("quote")} then 'empty' when not {blank("quote_sha256")} and lower(quote_sha256) <> sha256(quote) then 'hash_mismatch' when exact is null and loose is null then 'unknown_chunk' when exact then 'exact' when loose then 'whitespace' else 'absent' end status
from rows_ left join hits using (evidence_id)""",
    "evidence_violations": f"""select evidence_id, unnest(list_filter([case when {blank("source_id")} then 'blank_source' end, case when {blank("chunk_id")} then 'blank_chunk' end, case when page_end < page_start then 'pages_reversed' end, case when page_start < 1 then 'page_before_first' end,
  case when verified and not coalesce(quote_sha256 = sha256(quote), false) then 'verified_hash_mismatch' end], lambda x: x is not null)) violation from (select distinct * from evidence)""",
    "grounded_quotes": """select distinct term_id, c.chunk_id, c.source_id, e.quote, sha256(e.quote) quote_sha256 from (select distinct term_id, e.chunk_id chunk_id, e.quote quote from (select term_id, unnest(evidence) e from draft_terms) where e.quote is not null and e.quote <> '') e
join (select distinct chunk_id, source_id, text from chunks where chunk_id is not null and text is not null) c using (chunk_id) where contains(c.text, e.quote)""",
    "term_grounding": "select distinct term_id, coalesce(len(evidence) > 0 and len(list_filter(evidence, lambda e: not coalesce(e.verified, false))) = 0, false) grounded from draft_terms",
    "evidence_counts": _DR + " select * from proof_counts",
    "canonical_labels": _DR + " select * from labels",
    "best_definitions": _DR + " select * from definitions_best",
    "best_kinds": _DR + " select * from kinds_best",
    "salient_terms": _DR + " select * from salient",
    "source_abstracts": _DR + " select source_id, string_agg(case when definition <> '' then label || ': ' || definition else label end, chr(10) || chr(10) order by rank) abstract from salient where rank <= 8 group by 1",
    "term_links": _DR + " select * from links",
    "dangling_labels": _DR + f", every_link as (select source_id, {fold('o')} other_key from stated_links where {fold('o')} <> '') select source_id, other_key, count(*) n from every_link e where not exists (select 1 from drafts x where x.source_id = e.source_id and x.label_key = e.other_key) group by 1, 2",
    "concept_classes": _DR + "," + CLASSES + " select * from classes",
    "class_membership": _DR + " select distinct sha256(label_key || chr(1) || definition) class_id, source_id from salient",
    "alignment_features": _DR + "," + CLASSES + "," + FEATURES + " select * from features",
    "concept_quads": _DR + "," + QUADS + " select * from quads",
    "quad_counts": _DR + "," + QUADS + " select predicate, count(*) n from quads group by 1",
    "evidence_index": _DR + "," + INDEX + " select * from index_rows",
    "evidence_claims": _DR + " select distinct e.source_id source_id, e.chunk_id chunk_id, e.quote_sha256 quote_sha256, label_key from (select label_key, unnest(evidence) e from drafts) where e.quote is not null",
    "retrieve_evidence": _DR + "," + INDEX + "," + RETRIEVED + " select * from retrieved",
    "ask_evidence": _DR + "," + INDEX + "," + RETRIEVED + " select * from retrieved order by score desc, source_id, chunk_id, quote_sha256 limit 10",
    "ask_claims": _DR + "," + INDEX + "," + RETRIEVED + ", shown as (select * from retrieved order by score desc, source_id, chunk_id, quote_sha256 limit 10), said as (select distinct e.source_id source_id, e.chunk_id chunk_id, e.quote_sha256 quote_sha256, label_key from (select label_key, unnest(evidence) e from drafts) where e.quote is not null) select source_id, chunk_id, quote_sha256, score, label_key from shown join said using (source_id, chunk_id, quote_sha256)",
    "ask_conflicts": _AXP + "," + CONTRADICTIONS + "," + planted.terms_sql() + "," + DRAFTS.replace("from draft_terms", "from all_terms") + "," + INDEX + "," + RETRIEVED + """, said as (select distinct e.source_id source_id, e.chunk_id chunk_id, e.quote_sha256 quote_sha256, label_key from (select label_key, unnest(evidence) e from drafts) where e.quote is not null),
matched as (select distinct source_id, label_key from retrieved join said using (source_id, chunk_id, quote_sha256)),
near as (select * from matched union select l.source_id, l.other_key from links l join matched m on m.source_id = l.source_id and m.label_key = l.label_key)
select distinct c.* from contradicting c join near using (source_id) where contains(' ' || signature || ' ', ' ' || label_key || ' ')""",
    "mental_model": _EXP + f""", merged as (select source_id, {fold("name")} name_key, min(name) as name, arg_min(purpose, (-len(purpose), purpose)) purpose, count(distinct (chunk_id, sha256(quote))) n_evidence from models where source_id is not null group by 1, 2),
ranked as (select *, (row_number() over (partition by source_id order by n_evidence desc, name_key))::int as rank from merged qualify rank <= 60)
select *, count(*) over (partition by name_key) > 1 ambiguous from ranked where name_key = {fold(quoted(MODEL_NAME))}""",
    "cross_source_conflicts": _O + "," + OPPOSED_ST.replace("from axioms group by statement", "from axiom_claims group by statement") + f""",
sides as (select statement, min((source_id, claim_id)) a, max((source_id, claim_id)) b from axiom_claims group by statement),
met as (
  select kind, case when l.a[1] <> r.a[1] then [l.a[2], r.a[2]] when l.b[1] <> r.a[1] then [l.b[2], r.a[2]] when l.a[1] <> r.b[1] then [l.a[2], r.b[2]] end p
  from opposing o join sides l on l.statement = o.left_statement join sides r on r.statement = o.right_statement
),
found as (select distinct kind, list_sort(p)[1] left_id, list_sort(p)[2] right_id from met where p is not null)
select {_hash("conflict:", "left_id", "right_id")} conflict_id, kind, left_id, right_id from found""",
    "lookup_concept": _DR + f" select source_id, label_key, label, kind, definition, confidence, count(*) over () > 1 ambiguous from salient where label_key = {_KEY}",
    "trace_claim": _DR + f" select source_id, label_key, chunk_id, quote_sha256, quote from proofs where label_key = {_KEY}",
    "concept_neighbourhood": _DR + f" select source_id, label_key from links where label_key = {_KEY} or other_key = {_KEY} union select source_id, other_key from links where label_key = {_KEY} or other_key = {_KEY}",
    "list_conflicts": _AXP + "," + CONTRADICTIONS + "," + planted.terms_sql() + "," + DRAFTS.replace("from draft_terms", "from all_terms") + f", near as (select source_id, label_key from links where label_key = {_AGAINST} or other_key = {_AGAINST} union select source_id, other_key from links where label_key = {_AGAINST} or other_key = {_AGAINST}) select distinct c.* from contradicting c join near using (source_id) where contains(' ' || signature || ' ', ' ' || label_key || ' ')",
    "ontology_terms": _O + "select source_id, claim_id, label_key, label, kind, definition, confidence, n_evidence, rank from terms",
    "ontology_relations": _O + "select source_id, claim_id, subject_id, predicate, object_id, confidence, n_evidence, rank from relation_claims",
    "ontology_axioms": _O + "select source_id, claim_id, statement, modality, epistemic_status, attribution, confidence, n_evidence, rank from axiom_claims",
    "ontology_models": _O + "select source_id, claim_id, name, purpose, confidence, n_evidence, rank from model_claims",
    "ontology_conflicts": _O + "select source_id, conflict_id, signature, array_to_string(claim_ids, ' ') claim_ids, kind from conflict_claims",
    "ontology_evidence": _O + "select source_id, claim_id, chunk_id, sha quote_sha256 from proofs_of",
    "ontology_abstracts": _O + "select source_id, abstract, array_to_string(support_ids, ' ') support_ids from abstracts",
    "ontology_questions": _O + "select * from questions",
    "ontology_problems": "select * from (values ('planted-a', 'term:x', 'dangling_link'), ('planted-a', 'term:x', 'self_reference'), ('planted-a', 'term:x', 'foreign_evidence')) v(source_id, claim_id, problem)",
    "ontology_quads": _O + "," + ONTOLOGY_QUADS + " select * from quads",
    "shape_violations": _O + "," + ONTOLOGY_QUADS + "," + SHAPES_CHECKED,
    "merged_terms": _DR + f""", keyed as (select source_id, label_key k1, coalesce(kind, '') k2, coalesce({fold("definition")}, '') k3, confidence, evidence, coalesce(aliases, []) aliases from drafts where fragment_index is not null and term_index is not null and len(evidence) > 0),
ev as (select source_id, k1, k2, k3, count(distinct (e.source_id, e.chunk_id, e.quote_sha256, coalesce(e.page_start, 0), coalesce(e.page_end, 0))) n_evidence from (select source_id, k1, k2, k3, unnest(evidence) e from keyed) group by all),
al as (select source_id, k1, k2, k3, count(distinct {fold("trim(regexp_replace(a, '[\\s\\x0B]+', ' ', 'g'))")})::int n_aliases from (select source_id, k1, k2, k3, unnest(aliases) a from keyed) where not {blank("a")} group by all)
select source_id, k1, k2, k3, max(confidence) confidence, any_value(n_evidence) n_evidence, coalesce(any_value(n_aliases), 0) n_aliases from keyed join ev using (source_id, k1, k2, k3) left join al using (source_id, k1, k2, k3) group by all""",
    "quarantined_terms": "select distinct term_id from (select distinct term_id, evidence from draft_terms) where len(list_filter(coalesce(evidence, []), lambda e: coalesce(e.verified, false))) = 0",
    "layout_sample": "select block_no::int block_no, label, level::int as level, text, headings, page_start::int page_start, page_end::int page_end from (values (1, 'title', 1, 'Report', 'Report', null, null), (2, 'section_header', 2, 'Scope', 'Report > Scope', 1, 1), (3, 'text', 0, 'First.', 'Report > Scope', 1, 1), (4, 'table', 0, '| a | b\\|c |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 |  |', 'Report > Scope', 2, 3), (5, 'picture', 0, 'Figure 1.', 'Report > Scope', 4, 4)) v(block_no, label, level, text, headings, page_start, page_end)",
    "resolution_sample": "select \"left\", \"right\", decision, stage, score::double score from (values ('0:0', '1:0', 'merge', 'exact', 100.0), ('0:0', '2:0', 'distinct', 'definition', 100.0), ('3:0', '4:0', 'merge', 'lexical', 96.55), ('5:0', '6:0', 'ambiguous', 'lexical', 87.18)) v(\"left\", \"right\", decision, stage, score)",
    "body_texts": """with t as (select distinct chunk_id, heading_path, text from chunks where chunk_id is not null and text is not null),
l as (select chunk_id, text, heading_path, string_split(text, chr(10)) ls, list_transform(coalesce(heading_path, []), lambda h: lower(trim(regexp_replace(h, '[\\s\\x0B]+', ' ', 'g')))) ex from t),
f as (select chunk_id, text, ls, ex, list_transform(ls, lambda x: trim(x) = '' or list_contains(ex, lower(trim(regexp_replace(regexp_replace(regexp_replace(x, '^[\\s\\x0B]+|[\\s\\x0B]+$', '', 'g'), '^#{1,6}[\\s\\x0B]+', ''), '[\\s\\x0B]+', ' ', 'g'))))) ok from l)
select chunk_id, sha256(case when len(ex) > 0 then array_to_string(ls[coalesce(list_position(ok, false), len(ls) + 1):], chr(10)) else text end) text_sha256 from f""",
    "nquad_lines": _DR + "," + QUADS + """ select '<' || subject || '> <' || predicate || '> ' || case when object_kind = 'uri' then '<' || object || '>' else '"' || replace(replace(replace(replace(replace(object, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't') || '"' || case when object_kind = 'literal' then '' else '^^<' || object_kind || '>' end end || ' <' || graph || '> .' as value from quads""",
    "turtle_statements": _DR + "," + QUADS + """, placed as (select *, (row_number() over (partition by graph, subject order by predicate, object, object_kind) - 1) // 1000 part from quads)
select graph, '<' || subject || '> ' || string_agg('<' || predicate || '> ' || case object_kind when 'uri' then '<' || object || '>' when 'literal' then to_json(object)::varchar else to_json(object)::varchar || '^^<' || object_kind || '>' end, ' ;' || chr(10) || '    ' order by predicate, object, object_kind) || ' .' as value from placed group by graph, subject, part""",
    "jsonld_nodes": _DR + "," + QUADS + """, placed as (select *, (row_number() over (partition by graph, subject order by predicate, object, object_kind) - 1) // 1000 part from quads),
lists as (select graph, subject, part, predicate, '[' || string_agg(case object_kind when 'uri' then '{"@id": ' || to_json(object)::varchar || '}' when 'literal' then '{"@value": ' || to_json(object)::varchar || '}' else '{"@value": ' || to_json(object)::varchar || ', "@type": ' || to_json(object_kind)::varchar || '}' end, ', ' order by object, object_kind) || ']' found from placed group by all)
select graph, '{"@id": ' || to_json(subject)::varchar || ', ' || string_agg(to_json(predicate)::varchar || ': ' || found, ', ' order by predicate) || '}' as value from lists group by graph, subject, part""",
    "term_identifiers": _DR + """ select source_id, label_key, 'term:' || coalesce(nullif(rtrim(left(trim(regexp_replace(lower(regexp_replace(strip_accents(label), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9]+', '-', 'g'), '-'), 64), '-'), ''), 'item') || '-' || left(sha256('{"label":' || to_json(label) || ',"payload":{"definition":' || to_json(definition) || ',"kind":' || coalesce(to_json(kind), 'null') || ',"label_key":' || to_json(label_key) || '}}'), 12) term_id from salient""",
    "formal_sample": f"select * from (values {_values([(r[0], r[3]) for r in planted.RULES if r[3]])}) v(claim_id, problem)",
    "fragment_gaps": "with f as (select distinct source_id, chunk_id from draft_terms where source_id is not null and chunk_id is not null), c as (select distinct source_id, chunk_id from chunks where source_id is not null and chunk_id is not null) select *, 'chunk' missing from (select * from f except select * from c) union all select *, 'fragment' from (select * from c except select * from f)",
    "foreign_chunks": "with " + planted.chunks_sql() + " select source_id, count(*) n_chunks from (select distinct source_id, chunk_id from all_chunks where source_id is not null) where source_id not in (select source_id from sources where source_id is not null) group by 1",
    "source_metadata": "with e as (select source_id, ordinal, chunk_id, unnest(map_entries(metadata)) m from chunks where source_id is not null and metadata is not null), v as (select source_id, m.key as key, m.value as value, min((ordinal, chunk_id)) first_at from e where m.value is not null group by all) select source_id, key, string_agg(value, chr(31) order by first_at, value) as found from v group by all",
    "beliefs": _O + "," + FRAMES + " select * from beliefs",
    "intention_links": _O + "," + FRAMES + " select distinct * from links",
    "stance_ledger": _O + "," + FRAMES + f"""
select belief_id object_id, 'belief' kind, origin, support from beliefs
union all select * from (values ('objective', 'desire', 'operator_objective', null), ('provenance', 'desire', 'synthesized_subgoal', 'objective'), ('conflicts', 'desire', 'synthesized_subgoal', 'objective'))
union all select desire_id, 'desire', 'source_norm', claim_id from norms
union all select intention_id, 'intention', 'instrumental_policy', subject from intentions
-- {OBJECTIVE}
""",
    "frame_findings": f"select code, 'error' severity, object_id, repairable = 1 repairable from (values {_values(_UNFIT)}) v(code, object_id, repairable)",
}


def oracle_sql():
    return ORACLES
