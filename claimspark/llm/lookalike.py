"""Visually identical text with different characters.

Method: values are mapped through the look-alike table, grouped in SQL under
Spark's accent-sensitive ``UNICODE`` collation (which equates composed and
decomposed accents and sees case, width and accents), the deterministic
canonical member of each class is chosen and joined back to every value.

A value is a word.  Widths, kinds of space, ligatures and invisible characters
have one form each and are set right in place by ``translate``; what remains
are words whose letters have look-alikes in other scripts or whose accents are
written apart.  The canonical member of a class is the one with no foreign
letters, then with no separate accents, then the most frequent, then the
smallest by code points; a word that mixes scripts counts as its look-alike
form.  The dictionary that is joined back holds only words that change.  Line
breaks stay in the consistent form; only when texts are compared they count as
spaces.

Defined results: null stays null; empty and blank texts become empty; repeated
rows count once; a quote that is blank is found nowhere; a row without a known
chunk isn't found; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.runtime import cut, spread

# Characters that have no shape of their own.
INVISIBLE = r"[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0]"
# Letters of other scripts that look like a Latin letter.
CYRILLIC, CYRILLIC_AS = "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅԌԚԜӀ", "aeopcyxijshdqwABEKMHOPCTYXIJSGQWI"
GREEK, GREEK_AS = "οναιρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovaipuABEZHIKMNOPTYX"
ARMENIAN, ARMENIAN_AS = "ՕօսԼ", "OouL"
LIGATURES = (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬅ", "st"), ("ﬆ", "st"))
# Half-width kana stand in the order of the code table from U+FF61; voiced marks become combining ones.
KANA = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン゙゚"

#: Keys over which the rows of one word are spread.
SALT = 16
WORD = r"[\p{L}\p{M}\p{N}]+"
_FOREIGN = f"[{CYRILLIC}{GREEK}{ARMENIAN}]"


def _widths() -> tuple[str, str]:
    full = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "".join(chr(c) for c in range(0xFF61, 0xFF61 + len(KANA)))
    return full, "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + KANA


def line_form(text: Column | str) -> Column:
    """Widths, spaces, ligatures, hyphens and invisible characters in their one form; line breaks stay, as "\\n"."""
    c = F.col(text) if isinstance(text, str) else text
    full, half = _widths()
    c = F.regexp_replace(c, INVISIBLE, "")
    c = F.translate(c, full + "\u2010\u2011", half + "--")  # hyphens that look like the plain one
    for lig, letters in LIGATURES:
        c = F.replace(c, F.lit(lig), F.lit(letters))
    c = F.regexp_replace(c, r"\r\n|[\r\u0085\u2028\u2029\u000b\u000c]", "\n")
    c = F.regexp_replace(c, r"[ \t\p{Zs}\u001c-\u001f]+", " ")
    return F.regexp_replace(F.regexp_replace(c, r" ?\n ?", "\n"), r"^[ \n]+|[ \n]+$", "")


def compared(form: Column | str) -> Column:
    """A line form as texts are compared: every run of white space is one space."""
    return F.trim(F.regexp_replace(form, r"\s+", " "))


def look_alike(word: Column | str) -> Column:
    c = F.col(word) if isinstance(word, str) else word
    return F.translate(c, CYRILLIC + GREEK + ARMENIAN, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS)


@F.pandas_udf(T.StringType())
def _composed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def _words(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def canonical_words(texts: DataFrame, text: str = "plain") -> DataFrame:
    """(word, canonical) for every word of the texts that isn't its class's canonical member."""
    counts = texts.select(F.explode(_words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # Composed once here: the collation equates composed and decomposed accents when it compares, but a shuffle may place
    # two spellings of one class in different partitions, so members of a class must have one spelling of their key.
    keyed = counts.withColumn("mapped", F.when(F.regexp_like("word", F.lit(r"[^\x00-\x7F]")), _composed(look_alike("word"))).otherwise(F.col("word")))
    mixed = F.regexp_like("word", F.lit(_FOREIGN)) & (F.regexp_like("word", F.lit("[A-Za-z]")) | F.regexp_like("word", F.lit(r"[À-ɏ]")))
    # the value a word stands for as a member of its class
    member = F.when(mixed, F.col("mapped")).otherwise(F.col("word"))
    ranked = keyed.withColumn("member", member).withColumn(
        "rank", F.struct(F.regexp_like("member", F.lit(_FOREIGN)).alias("foreign"), F.regexp_like("member", F.lit(r"\p{M}")).alias("apart"), (-F.col("n")).alias("n"), F.col("member"))
    )
    ranked = ranked.withColumn("class", F.expr("collate(mapped, 'UNICODE')"))
    best = ranked.groupBy("class").agg(F.min_by("member", "rank").alias("canonical"), F.count("*").alias("members"))
    # a class of one plain member changes nothing
    return (
        ranked.where(F.regexp_like("word", F.lit(r"[^\x00-\x7F]")))
        .select("word", "class")
        .join(best.select("class", "canonical"), "class")
        .where("word <> canonical")
        .groupBy("word")
        .agg(F.min("canonical").alias("canonical"))
    )


def consistent(rows: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """rows (key, plain) -> (key, canonical text): each word replaced by its class's canonical member.

    A common word stands in very many rows, so the dictionary, which holds only
    words that change, is laid out SALT times and a word's rows are spread over
    as many keys.
    """
    suspicious = F.array_distinct(F.filter(_words(text), lambda w: F.regexp_like(w, F.lit(r"[^\x00-\x7F]"))))
    salted = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    maps = (
        rows.where(F.regexp_like(text, F.lit(r"[^\x00-\x7F]")))
        .select(key, F.pmod(F.xxhash64(key), F.lit(SALT)).cast("int").alias("salt"), F.explode(suspicious).alias("word"))
        .join(salted, ["word", "salt"])
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "canonical"))).alias("changes"))  # bounded by the row's own words
    )
    pieces = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+"), F.lit(0))
    rewritten = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.element_at("changes", p), p)), "")
    return rows.join(maps, key, "left").withColumn("canonical", F.when(F.col("changes").isNull(), F.col(text)).otherwise(rewritten)).drop("changes")


def consistent_texts(chunks: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((text_id, chunk_id, text, canonical), (evidence_id, chunk_id, quote, canonical)) under one dictionary.

    text_id is the hash of a distinct (chunk_id, text): a chunk that stands in several versions keeps all of them.
    Both kinds are one table, written once, so that no text is normalised twice.
    """
    none = F.lit(None)
    texts = chunks.where("chunk_id is not null and text is not null").select("chunk_id", F.col("text").alias("raw")).distinct()
    texts = texts.select(F.sha2(F.concat_ws("\u0000", "chunk_id", "raw"), 256).alias("row_id"), none.cast("bigint").alias("evidence_id"), "chunk_id", "raw")
    quotes = evidence.where("quote is not null").select("evidence_id", "chunk_id", F.col("quote").alias("raw")).distinct()
    quotes = quotes.select(F.concat(F.lit("e"), F.sha2(F.concat_ws("\u0000", F.col("evidence_id").cast("string"), "chunk_id", "raw"), 256)).alias("row_id"), "evidence_id", "chunk_id", "raw")
    both = cut(spread(texts.unionByName(quotes)).withColumn("plain", line_form("raw")))
    fixed = cut(consistent(both, "row_id", "plain", canonical_words(both)))
    is_quote = F.startswith("row_id", F.lit("e")) & (F.length("row_id") == 65)
    return (
        fixed.where(~is_quote).select(F.col("row_id").alias("text_id"), "chunk_id", F.col("raw").alias("text"), "canonical"),
        fixed.where(is_quote).select("evidence_id", "chunk_id", F.col("raw").alias("quote"), "canonical"),
    )


def look_alike_quotes(chunks: DataFrame, evidence: DataFrame) -> DataFrame:
    """(evidence_id) of quotes that aren't in their chunk as written, but are once both have the consistent form."""
    texts, quotes = consistent_texts(chunks, evidence)
    pairs = quotes.withColumn("quote_form", compared("canonical")).drop("canonical").join(texts.withColumn("text_form", compared("canonical")).drop("canonical"), "chunk_id")
    verdict = pairs.groupBy("evidence_id").agg(F.max(F.contains("text", "quote")).alias("exact"), F.max(F.contains("text_form", "quote_form") & (F.col("quote_form") != "")).alias("same"))
    return verdict.where("same and not exact").select("evidence_id")
