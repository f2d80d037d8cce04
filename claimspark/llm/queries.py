"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.llm import components, contamination, lookalike, markup, mixing, scan_repair, segment, sentences, survivors
from claimspark.runtime import load

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.surviving_rows(load(spark, d, "draft_terms"))


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.consistent_survivors(load(spark, d, "draft_terms"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return components.occurrence_groups(load(spark, d, "resolution_decisions"), load(spark, d, "entity_clusters"))


def p2_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("group_key").agg(F.count("*").alias("n_keys"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return segment.split_chunks(load(spark, d, "chunks")).where("n_pieces > 1 and chunk_id is not null").select("chunk_id").distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    return segment.split_chunks(load(spark, d, "chunks")).drop("metadata")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.noisy_lines(load(spark, d, "converted_documents"), load(spark, d, "chunks"))


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.repaired(load(spark, d, "converted_documents"), load(spark, d, "chunks")).select("record_id", "repaired")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.look_alike_quotes(load(spark, d, "chunks"), load(spark, d, "evidence"))


def p5_quotes(spark: SparkSession, d: str) -> DataFrame:
    _, quotes = lookalike.consistent_texts(load(spark, d, "chunks"), load(spark, d, "evidence"))
    return quotes.select("evidence_id", "chunk_id", F.col("canonical").alias("quote"), F.sha2("canonical", 256).alias("quote_sha256"))


def p5_chunks(spark: SparkSession, d: str) -> DataFrame:
    texts, _ = lookalike.consistent_texts(load(spark, d, "chunks"), load(spark, d, "evidence"))
    return texts.select("chunk_id", F.col("canonical").alias("text"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.elements(load(spark, d, "converted_documents"), load(spark, d, "chunks"))


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.cleaned(load(spark, d, "converted_documents"), load(spark, d, "chunks")).select("record_id", "clean", "removed")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaks(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leak_report(load(spark, d, "documents"), load(spark, d, "eval_items")).select("item_id", "suite", "n_documents")


def p8_clean(spark: SparkSession, d: str) -> DataFrame:
    return contamination.decontaminated(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(load(spark, d, "documents"), load(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.share_report(load(spark, d, "documents"), load(spark, d, "mix_targets"))


def p9_temperature(spark: SparkSession, d: str) -> DataFrame:
    return mixing.temperature_shares(load(spark, d, "documents"))


def p9_tempered(spark: SparkSession, d: str) -> DataFrame:
    return mixing.tempered_mixture(load(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(load(spark, d, "documents")).select("doc_id", "start_pos", "end_pos").distinct()


def p10_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(load(spark, d, "documents"))


def queries() -> dict[str, Query]:
    named = (p1_found, p1_survivors, p2_found, p2_group_sizes, p3_found, p3_pieces, p4_found, p4_repaired, p5_found, p5_quotes, p5_chunks, p6_found, p6_clean, p8_found, p8_report, p8_clean, p9_mixture, p9_shares, p9_temperature, p9_tempered, p10_found, p10_sentences)
    return {f.__name__: f for f in named}


_KEY = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_COMPONENTS = rf"""
with recursive raw as (
  select {_KEY.format("left_key")} a, {_KEY.format("right_key")} b from resolution_decisions
  where lower({_KEY.format("decision")}) = 'merge'
  union
  select min(k) over (partition by cluster_id), k
  from (select cluster_id, {_KEY.format("u.key")} k from entity_clusters, unnest(occurrence_keys) u(key)) where k is not null and k <> ''
), edges as (
  select a, b from raw where a <> b and a <> '' and b <> '' union select b, a from raw where a <> b and a <> '' and b <> ''
), reach as (
  select a node, a other from edges union select r.node, e.b from reach r join edges e on e.a = r.other
)
select node occurrence_key, min(other) group_key from reach group by node
"""


_FLAT = "lower(nfc_normalize({}))"
_GRAMS = rf"""
with docs as (select doc_id, regexp_extract_all({_FLAT.format("text")}, '[\p{{L}}\p{{N}}]+') w from documents where doc_id is not null and text is not null),
items as (select distinct item_id, lower(trim(coalesce(lang, '')))[1:2] in ('zh', 'ja') spaceless, regexp_extract_all({_FLAT.format("text")}, '[\p{{L}}\p{{N}}]+') w from eval_items where item_id is not null and text is not null),
item_streams as (select item_id, array_to_string(w, '') s from items where spaceless),
doc_streams as (select doc_id, array_to_string(w, '') s from docs),
item_grams as (
  select item_id, array_to_string(w[i:i + 14], '') g from (select item_id, w, unnest(generate_series(1, len(w) - 14)) i from items where not spaceless and len(w) >= 15)
),
doc_grams as (
  select doc_id, array_to_string(w[i:i + 14], '') g from (select doc_id, w, unnest(generate_series(1, len(w) - 14)) i from docs where len(w) >= 15)
),
item_chars as (select item_id, s[i:i + 29] g from (select item_id, s, unnest(generate_series(1, length(s) - 29)) i from item_streams where length(s) >= 30)),
doc_chars as (select doc_id, s[i:i + 29] g from (select doc_id, s, unnest(generate_series(1, length(s) - 29)) i from doc_streams where length(s) >= 30)),
found as (
  select distinct doc_id, item_id from doc_grams join item_grams using (g)
  union select distinct doc_id, item_id from doc_chars join item_chars using (g)
)
"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The twin's own tables: code points of letters of other scripts with the Latin letter each looks like, and widths and
# ligatures as Unicode's compatibility forms give them.
_LIKE = (
    "0430a 0435e 043eo 0440p 0441c 0443y 0445x 0456i 0458j 0455s 04bbh 0501d 051bq 051dw 0410A 0412B 0415E 041aK 041cM 041dH 041eO 0420P 0421C 0422T 0423Y 0425X 0406I 0408J 0405S 050cG 051aQ 051cW 04c0I "
    "03bfo 03bdv 03b1a 03b9i 03c1p 03c5u 0391A 0392B 0395E 0396Z 0397H 0399I 039aK 039cM 039dN 039fO 03a1P 03a4T 03a5Y 03a7X "
    "0555O 0585o 057du 053cL"
).split()
_WIDE = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFF01, 0xFF5F), *range(0xFF61, 0xFFA0))}
_JOINED = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFB00, 0xFB07)}


def _plain(c: str) -> str:
    out = rf"regexp_replace({c}, '[\x{{ad}}\x{{34f}}\x{{61c}}\x{{115f}}\x{{1160}}\x{{17b4}}\x{{17b5}}\x{{180b}}-\x{{180e}}\x{{200b}}-\x{{200f}}\x{{202a}}-\x{{202e}}\x{{2060}}-\x{{206f}}\x{{3164}}\x{{fe00}}-\x{{fe0f}}\x{{feff}}\x{{ffa0}}]', '', 'g')"
    out = f"translate({out}, {_quote(''.join(_WIDE) + chr(0x2010) + chr(0x2011))}, {_quote(''.join(_WIDE.values()) + '--')})"
    for joined, letters in _JOINED.items():
        out = f"replace({out}, '{joined}', '{letters}')"
    out = rf"trim(regexp_replace({out}, '[\s\p{{Z}}\x{{0b}}\x{{85}}\x{{1c}}-\x{{1f}}]+', ' ', 'g'))"
    return f"translate(nfc_normalize({out}), {_quote(''.join(chr(int(x[:4], 16)) for x in _LIKE))}, {_quote(''.join(x[4:] for x in _LIKE))})"


_LOOKS = f"""
with texts as (select distinct chunk_id, text, {_plain("text")} form from chunks where chunk_id is not null and text is not null),
quotes as (select distinct evidence_id, chunk_id, quote, {_plain("quote")} form from evidence where quote is not null)
select q.evidence_id from quotes q join texts t using (chunk_id) group by 1 having bool_or(contains(t.form, q.form) and q.form <> '') and not bool_or(contains(t.text, q.quote))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": _LOOKS,
        "p8_found": _GRAMS + "select * from found",
        "p8_report": _GRAMS + "select item_id, suite, count(doc_id) n_documents from (select distinct item_id, suite from eval_items) left join found using (item_id) group by all",
        "p2_found": _COMPONENTS,
        "p2_group_sizes": f"select group_key, count(*) n_keys from ({_COMPONENTS}) group by group_key",
        "p3_found": r"select distinct chunk_id from chunks where chunk_id is not null and len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]')) > 1800",
    }
