"""Rows that stand beside the tables where these hold no case of an operator, the same for Spark and SQL.

They form a source of their own (two for what compares sources), so they change no
result of the tables' sources.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from claimspark.operators.claims import EVIDENCE

A, B = "planted-a", "planted-b"
#: A canonical layout document: a title, a heading on page 0, a nested text, a table with a short row, a captioned picture, a repeated reference.
LAYOUT = """{"body": {"children": [{"$ref": "#/texts/0"}, {"$ref": "#/groups/0"}, {"$ref": "#/tables/0"}, {"$ref": "#/pictures/0"}, {"$ref": "#/texts/2"}]},
"groups": [{"label": "list", "children": [{"$ref": "#/texts/1"}, {"$ref": "#/texts/2"}]}],
"texts": [{"label": "title", "text": "Report"}, {"label": "section_header", "level": 2, "text": " Scope ", "prov": [{"page_no": 0}]}, {"label": "text", "orig": "First.", "text": "", "prov": [{"page_no": 1}, {"page_no": -3}]}, {"label": "caption", "text": "Figure 1."}],
"tables": [{"label": "table", "data": {"grid": [[{"text": "a"}, {"text": "b|c"}], [{"text": "1"}]]}, "prov": [{"page_no": 2}, {"page_no": 3}]}],
"pictures": [{"label": "picture", "captions": [{"$ref": "#/texts/3"}], "prov": [{"page_no": 4}]}]}"""
#: (claim_id, formalism, formal_expression, what is wrong with it)
RULES = (
    ("r1", "datalog", "trusted(X) :- audited(X, Y), team(Y).", None), ("r2", "datalog", "trusted(X) :- audited(Y, Y).", "unsafe_rule"), ("r3", "datalog", "open(X) :- team(X), not closed(X).", None), ("r4", "datalog", "open(X) :- not closed(X).", "unsafe_rule"),
    ("r5", "datalog", " ", "missing_expression"), ("r6", "none", None, None), ("r7", "none", "p(a).", "expression_without_formalism"), ("r8", "fol", "forall x", "unsupported_formalism"), ("r9", "datalog", "p(a).", None), ("r10", "datalog", "p(a)", "unsafe_rule"), ("r11", None, None, None),
)
#: (label, definition) of terms to be resolved, one fragment each.
NAMES = (("Bank", "land at the edge of a river"), ("bank", " "), ("BANK", "institution that lends money"), ("Shared Resource", None), ("Shared Resouce", None), ("cautious autonomy", None), ("cautious autonomy veto", None))
#: (chunk_id, source_id, ordinal, text)
CHUNKS = (
    ("planted-a:1", A, 1, "Shared Trust is a fair resource. Shared Trust is not a fair resource. Audit Load causes long delay. Audit Load is a burden?"),
    ("planted-a:2", A, 2, "Audit Load produces long delay. Long Delay is a cost of audits. The Review Cycle Model is a framework for shared trust."),
    ("planted-b:1", B, 1, "Shared Trust means a fair resource of all teams. Audit Load prevents long delay. Shared Trust enables audit load."),
)
#: (term_id, source_id, fragment_index, term_index, label, aliases, kind, definition, broader_labels, quote, confidence)
TERMS = (
    (-1, A, 1, 0, "Shared Trust", ("Mutual Trust",), "concept", "a fair resource", ("Audit Load",), "Shared Trust is a fair resource.", 0.9),
    (-2, A, 1, 1, "Audit Load", (), "process", "work that audits cause", (), "Audit Load causes long delay.", 0.8),
    (-3, B, 1, 0, "Shared Trust", (), "concept", "a fair resource of all teams", (), "Shared Trust means a fair resource of all teams.", 0.7),
)
#: (source_id, statement): norms, which no pattern of the extractor yields.
NORMS = ((A, "Teams should share every audit."), (B, "Offices must never be conscious of blame."))


def with_chunks(spark: SparkSession, chunks: DataFrame) -> DataFrame:
    rows = spark.createDataFrame(list(CHUNKS), "chunk_id string, source_id string, ordinal int, text string")
    return chunks.select("chunk_id", "source_id", "ordinal", "text").unionByName(rows)


def norms(spark: SparkSession) -> DataFrame:
    """Normative axioms in the shape of claims.Fragments.axioms."""
    rows = [(s, 9, k, x, "normative", "asserted", "author", [], [], 0.7, [(s, f"{s}:9", None, None, None, x, hashlib.sha256(x.encode()).hexdigest(), True)]) for k, (s, x) in enumerate(NORMS)]
    return spark.createDataFrame(rows, f"source_id string, fragment_index bigint, item_index int, statement string, modality string, epistemic_status string, attribution string, conditions array<string>, exceptions array<string>, confidence double, evidence {EVIDENCE}")


def norms_sql() -> str:
    """Rows of the norms as (chunk_id, source_id, statement, modality, quote, confidence)."""
    return " union all ".join(f"select {_lit(s + ':9')}, {_lit(s)}, {_lit(x)}, 'normative', {_lit(x)}, 0.7" for s, x in NORMS)


def with_terms(spark: SparkSession, terms: DataFrame) -> DataFrame:
    columns = "term_id bigint, source_id string, fragment_index bigint, term_index int, label string, aliases array<string>, kind string, definition string, broader_labels array<string>, narrower_labels array<string>, related_labels array<string>, confidence double, evidence " + EVIDENCE
    rows = [(i, s, f, t, label, list(al), k, d, list(br), [], [], c, [(s, f"{s}:1", None, 1, 1, q, hashlib.sha256(q.encode()).hexdigest(), True)]) for i, s, f, t, label, al, k, d, br, q, c in TERMS]
    return terms.select(*[c.split()[0] for c in columns.split(", ")]).unionByName(spark.createDataFrame(rows, columns))


def _lit(x) -> str:
    return "null" if x is None else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"


def chunks_sql() -> str:
    """A view ``all_chunks`` of the chunks and the planted ones."""
    rows = ", ".join("(" + ", ".join(map(_lit, r)) + ")" for r in CHUNKS)
    return f"all_chunks as (select chunk_id, source_id, ordinal, text from chunks union all select * from (values {rows}) v(chunk_id, source_id, ordinal, text))"


def terms_sql() -> str:
    """A view ``all_terms`` of the draft terms and the planted ones."""
    words = lambda xs: "[" + ", ".join(map(_lit, xs)) + "]::varchar[]"
    rows = ", ".join(
        f"({i}::bigint, {_lit(s)}, {f}::bigint, {t}::int, {_lit(label)}, {words(al)}, {_lit(k)}, {_lit(d)}, {words(br)}, []::varchar[], []::varchar[], {c}::double, "
        f"[{{'source_id': {_lit(s)}, 'chunk_id': {_lit(s + ':1')}, 'heading_path': null::varchar[], 'page_start': 1::int, 'page_end': 1::int, 'quote': {_lit(q)}, 'quote_sha256': sha256({_lit(q)}), 'verified': true}}])"
        for i, s, f, t, label, al, k, d, br, q, c in TERMS
    )
    columns = "term_id, source_id, fragment_index, term_index, label, aliases, kind, definition, broader_labels, narrower_labels, related_labels, confidence, evidence"
    return f"all_terms as (select {columns} from draft_terms union all select * from (values {rows}) v({columns}))"
