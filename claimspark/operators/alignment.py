"""Alignment of concepts across sources and opposed statements.

Terms are compared as classes: one class for each distinct (label, definition),
with its sources as members, so copies in many sources aren't paired with each
other.  Candidates are found by equi-joins that lose nothing: equal labels;
a label that is a run of words of another (every run of a label's words is a
key); labels whose word sets overlap by LABEL_OVERLAP or more (they are equal
without the few words that may differ; of long labels the rarest words, one
more than may differ, have one in common).  Mappings also meet by
equal forms (label or alias) in different sources.

Defined results: blank labels form no class; equal classes don't pair with
themselves; an empty definition is similar to nothing and conflicts with
nothing.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from claimspark.functions.columns import fold_label
from claimspark.functions.text import text_ratios
from claimspark.runtime import cut

LABEL_OVERLAP, DEFINITION_OVERLAP, COMPATIBLE = 0.66, 0.30, 0.35
#: Labels of so many words may differ by no more than two words each.
SHORT = 8
# Words that negate, and pairs of words that oppose each other.
NEGATIONS = ("no", "not", "never", "without", "cannot")
OPPOSED = (("increase", "decrease"), ("increases", "decreases"), ("improve", "harm"), ("improves", "harms"), ("enable", "prevent"), ("enables", "prevents"), ("effective", "ineffective"), ("beneficial", "detrimental"))


def _words(c: Column | str) -> Column:
    return _split(fold_label(c))


def _split(folded: Column | str) -> Column:
    folded = F.col(folded) if isinstance(folded, str) else folded
    return F.when(folded == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(folded, " ")))


def _overlap(a: Column, b: Column) -> Column:
    """The share that two arrays of distinct words have in common."""
    common = F.size(F.array_intersect(a, b))
    return F.coalesce(common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1)), F.lit(0.0))


def classes(reduced: DataFrame) -> DataFrame:
    """(class_id, label_key, definition, words, sources) of distinct labels with their definitions."""
    keyed = reduced.where("label_key <> ''").select("source_id", "label_key", F.coalesce("definition", F.lit("")).alias("definition"))
    ided = keyed.withColumn("class_id", F.sha2(F.concat_ws("\u0001", "label_key", "definition"), 256))
    return ided.groupBy("class_id", "label_key", "definition").agg(F.count_distinct("source_id").alias("n_sources"), F.min("source_id").alias("first_source"))


def membership(reduced: DataFrame) -> DataFrame:
    """(class_id, source_id): the sources that hold each class."""
    return reduced.where("label_key <> ''").select(F.sha2(F.concat_ws("\u0001", "label_key", F.coalesce("definition", F.lit(""))), 256).alias("class_id"), "source_id").distinct()


def _near_short(sets: DataFrame) -> DataFrame:
    """(x, y), x < y, of labels whose words overlap by LABEL_OVERLAP or more: what two sets have in common is both without the words that may differ, so each set stands under itself and under all it leaves when so many are dropped."""
    less = "transform({}, v -> transform(sequence(0, size(v) - 1), k -> filter(v, (word, i) -> i <> k)))"
    fewer = f"flatten({less.format('array(words)')})"
    kept = F.concat(F.array("words"), *(F.when(F.col("n") - F.ceil(F.col("n") * LABEL_OVERLAP - 1e-9) >= k, F.expr(e)).otherwise(F.array().cast("array<array<string>>")) for k, e in ((1, fewer), (2, f"flatten({less.format(fewer)})"))))
    keys = sets.select("label", "n", F.explode(F.array_distinct(kept)).alias("part")).select("label", "n", F.size("part").alias("k"), F.array_join("part", " ").alias("part"))
    met = keys.alias("a").join(keys.alias("b"), ["part", "k"]).where("a.label < b.label").where(F.col("k") >= (F.col("a.n") + F.col("b.n") - F.col("k")) * (LABEL_OVERLAP - 1e-6))
    return met.select(F.col("a.label").alias("x"), F.col("b.label").alias("y"))


def _near_long(sets: DataFrame) -> DataFrame:
    """(x, y) of labels that may overlap so, one of more than SHORT words: their rarest words, one more than may differ, have one in common."""
    flat = sets.select("label", "n", F.explode("words").alias("word"))
    counts = flat.groupBy("word").agg(F.count("*").alias("df"))
    rank = F.row_number().over(W.partitionBy("label").orderBy("df", "word"))
    prefix = flat.join(counts, "word").withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * LABEL_OVERLAP - 1e-9) + 1).select("label", "n", "word")
    met = prefix.where(F.col("n") > SHORT).alias("a").join(prefix.alias("b"), "word").where("a.label <> b.label").where(F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * LABEL_OVERLAP - 1e-9)
    return met.select(F.col("a.label").alias("x"), F.col("b.label").alias("y"))


def candidate_pairs(cls: DataFrame) -> DataFrame:
    """(left_id, right_id), left_id < right_id, of every pair that some rule could relate."""
    # labels meet by numbers, which are shorter
    labels = cut(cls.select("label_key").distinct().withColumn("label", F.monotonically_increasing_id())).withColumn("w", F.split("label_key", " "))
    runs = labels.select(F.col("label").alias("outer"), F.col("label_key").alias("whole"), F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(F.sequence(i, F.size("w")), lambda j: F.array_join(F.slice("w", i, j - i + 1), " ")))))).alias("label_key")).where("whole <> label_key")
    inside = runs.join(labels.select("label_key", "label"), "label_key").select(F.col("outer").alias("x"), F.col("label").alias("y"))
    sets = labels.select("label", F.array_sort(F.array_distinct("w")).alias("words")).withColumn("n", F.size("words"))
    near = _near_short(sets.where(F.col("n") <= SHORT)).unionByName(_near_long(sets))
    equal = labels.select(F.col("label").alias("x"), F.col("label").alias("y"))
    pairs = inside.unionByName(near).unionByName(equal).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    ids = cut(cls.select("class_id", "label_key").join(labels.select("label_key", "label"), "label_key").select("class_id", "label"))
    joined = pairs.join(ids.select(F.col("label").alias("x"), F.col("class_id").alias("a")), "x").join(ids.select(F.col("label").alias("y"), F.col("class_id").alias("b")), "y").where("x <> y or a < b")
    return joined.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"))


def forms(reduced: DataFrame, rows: DataFrame) -> DataFrame:
    """(class_id, form, least, most): the labels and aliases of each class, with the smallest and largest source that has them."""
    ided = reduced.where("label_key <> ''").select("source_id", "label_key", F.sha2(F.concat_ws("\u0001", "label_key", F.coalesce("definition", F.lit(""))), 256).alias("class_id"))
    aliases = rows.select("source_id", "label_key", F.explode("aliases").alias("a")).select("source_id", "label_key", fold_label("a").alias("form")).where("form <> ''").distinct()
    every = ided.join(aliases, ["source_id", "label_key"]).select("class_id", "source_id", "form").unionByName(ided.select("class_id", "source_id", F.col("label_key").alias("form")))
    return every.groupBy("class_id", "form").agg(F.min("source_id").alias("least"), F.max("source_id").alias("most"))


def form_pairs(named: DataFrame) -> DataFrame:
    """(left_id, right_id), left_id < right_id: classes that have a form in common in two different sources."""
    left = named.select("form", F.col("class_id").alias("left_id"), "least", "most")
    right = named.select("form", F.col("class_id").alias("right_id"), F.col("least").alias("r_least"), F.col("most").alias("r_most"))
    return left.join(right, "form").where("left_id < right_id and (least <> r_most or most <> r_least)").select("left_id", "right_id").distinct()


def features(cls: DataFrame) -> DataFrame:
    """Candidate pairs that a rule on labels could relate, with equal_label, contains, contained, label_overlap, definition_overlap and opposed."""
    return _compared(cls, candidate_pairs(cls)).where(_BY_LABEL)


_BY_LABEL = f"equal_label or contains or contained or label_overlap >= {LABEL_OVERLAP}"


def _compared(cls: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs, with all their columns, and the features of their classes."""
    # what one class says is made before the join, once and not for each of its pairs
    negation = F.array(*map(F.lit, NEGATIONS))
    holds = lambda x, y: F.array_contains("words", x) & ~F.array_contains("words", y)
    bits = lambda ways: functools.reduce(Column.bitwiseOR, [F.when(holds(x, y), 1 << k).otherwise(0) for k, (x, y) in enumerate(ways)])
    own = cls.withColumn("folded", fold_label("definition")).withColumns({"words": _split("folded"), "label_words": _words("label_key"), "n": F.size(F.split("label_key", " "))})
    own = own.withColumns({"negated": F.arrays_overlap("words", negation), "first": bits(OPPOSED), "second": bits([(y, x) for x, y in OPPOSED])})
    side = lambda s: own.select(*[F.col(c).alias(f"{s}_{n}") for c, n in (("class_id", "id"), ("label_key", "label"), *((c, c) for c in ("definition", "folded", "words", "label_words", "n", "negated", "first", "second", *(["key"] if "key" in cls.columns else []))))])
    joined = pairs.join(side("left"), "left_id").join(side("right"), "right_id")
    pad = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    lw, rw = F.col("left_words"), F.col("right_words")
    opposed = (F.col("left_negated") != F.col("right_negated")) | (F.col("left_first").bitwiseAND(F.col("right_second")) != 0) | (F.col("left_second").bitwiseAND(F.col("right_first")) != 0)
    content = _overlap(F.array_except(lw, negation), F.array_except(rw, negation))
    return joined.select(
        *pairs.columns,
        *[f"{s}_{c}" for c in ("label", "definition", "folded", *(["key"] if "key" in cls.columns else [])) for s in ("left", "right")],
        (F.col("left_label") == F.col("right_label")).alias("equal_label"),
        (F.expr("left_n > right_n") & F.contains(pad("left_label"), pad("right_label"))).alias("contains"),
        (F.expr("left_n < right_n") & F.contains(pad("right_label"), pad("left_label"))).alias("contained"),
        F.round(_overlap(F.col("left_label_words"), F.col("right_label_words")), 6).alias("label_overlap"),
        F.round(_overlap(lw, rw), 6).alias("definition_overlap"),
        (opposed & (content >= 0.5)).alias("opposed"),
    )


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    ratio, given = pd.Series(float("nan"), a.index), a.notna() & b.notna()
    ratio[given] = text_ratios(a[given].tolist(), b[given].tolist())
    return ratio


def mappings(cls: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """(left_id, right_id, kind, confidence) of related classes; ``named`` are their forms()."""
    alike = F.col("equal_label")
    # numbers in the order of the identifiers stand for them until the end
    cls = cut(cls.orderBy("class_id").withColumn("key", F.col("class_id")).withColumn("class_id", F.monotonically_increasing_id()))
    if named is None:
        f = features(cls)
    else:
        numbered = named.join(cls.select(F.col("key").alias("class_id"), F.col("class_id").alias("number")), "class_id").drop("class_id").withColumnRenamed("number", "class_id")
        met = form_pairs(numbered).withColumn("shared_form", F.lit(True)).unionByName(candidate_pairs(cls).withColumn("shared_form", F.lit(False)))
        f = _compared(cls, met.groupBy("left_id", "right_id").agg(F.max("shared_form").alias("shared_form"))).where(f"{_BY_LABEL} or shared_form")
        alike = alike | F.col("shared_form")
    # the texts are compared only where a rule reads their similarity
    read = alike | ((F.col("contains") | F.col("contained")) & ~F.col("opposed") & (F.col("definition_overlap") < COMPATIBLE))
    f = f.withColumn("similar", _ratio(F.when(read, F.col("left_folded")), F.when(read, F.col("right_folded"))))
    s, lo, do = F.col("similar"), F.col("label_overlap"), F.col("definition_overlap")
    fits = ~F.col("opposed") & ((do >= COMPATIBLE) | (s >= 0.55))
    kind = (
        F.when(F.col("equal_label") & F.col("opposed"), "conflicting")
        .when(alike & (s >= 0.64), "exact_equivalent")
        .when(F.col("equal_label") & (s < 0.42), "superficially_similar_but_distinct")
        .when(alike, "related_or_analogous")
        .when(fits & F.col("contains"), "narrower")
        .when(fits & F.col("contained"), "broader")
        .when((lo >= LABEL_OVERLAP) & (do >= DEFINITION_OVERLAP), "related_or_analogous")
    )
    confidence = (
        F.when(F.col("kind") == "conflicting", 0.9)
        .when(F.col("kind") == "exact_equivalent", F.least(F.lit(0.99), 0.72 + 0.27 * s))
        .when(F.col("kind") == "superficially_similar_but_distinct", F.least(F.lit(0.95), 0.70 + 0.20 * (1 - s)))
        .when(F.col("kind").isin("narrower", "broader"), 0.82)
        .when(alike, 0.62)
        .otherwise(F.least(F.lit(0.88), 0.55 + 0.18 * lo + 0.15 * do))
    )
    return f.withColumn("kind", kind).where("kind is not null").withColumn("confidence", confidence).select(F.col("left_key").alias("left_id"), F.col("right_key").alias("right_id"), "left_label", "right_label", "kind", "confidence")


def conflicting(cls: DataFrame) -> DataFrame:
    """The rows of kind conflicting that mappings(cls) has; nothing else is compared.

    They have equal labels and opposed definitions, so definitions of a label meet
    only if one has a word that opposes what the other has or lacks.
    """
    words, negation = F.col("w"), F.array(*map(F.lit, NEGATIONS))
    holds = lambda x, y: F.array_contains(words, x) & ~F.array_contains(words, y)
    ways = lambda first, pairs: F.explode(F.filter(F.array(F.when(first, -1), *(F.when(holds(x, y), k) for k, (x, y) in enumerate(pairs))), lambda w: w.isNotNull())).alias("way")
    worded = cls.select("class_id", "label_key", _words("definition").alias("w"))
    negated = F.arrays_overlap(words, negation)
    up = worded.select("label_key", F.col("class_id").alias("a"), ways(negated, OPPOSED))
    down = worded.select("label_key", F.col("class_id").alias("b"), ways(~negated, [(y, x) for x, y in OPPOSED]))
    pairs = up.join(down, ["label_key", "way"]).select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")).distinct()
    return _compared(cls, pairs).where("equal_label and opposed").select("left_id", "right_id", "left_label", "right_label", F.lit("conflicting").alias("kind"), F.lit(0.9).alias("confidence"))


def complementarities(mapped: DataFrame) -> DataFrame:
    """(left_id, right_id, description): one for each related or analogous pair."""
    return mapped.where("kind = 'related_or_analogous'").select("left_id", "right_id", F.concat(F.col("left_label"), F.lit(" and "), F.col("right_label"), F.lit(" can be read together.")).alias("description"))


KINDS = ("exact_equivalent", "broader", "narrower", "related_or_analogous", "superficially_similar_but_distinct", "conflicting")


def mapping_problems(mapped: DataFrame, cls: DataFrame) -> DataFrame:
    """(left_id, right_id, problem) of mappings that name no class, pair a class with itself or two of one source only, or have no known kind."""
    ids = cls.select("class_id")
    gone = lambda side: mapped.join(ids.withColumnRenamed("class_id", side), side, "left_anti").select("left_id", "right_id", F.lit(f"dangling_{side[:-3]}").alias("problem"))
    one = cls.where("n_sources = 1").select("class_id", "first_source")
    side = lambda s: one.select(F.col("class_id").alias(f"{s}_id"), F.col("first_source").alias(f"{s}_source"))
    same = mapped.join(side("left"), "left_id").join(side("right"), "right_id").where("left_source = right_source").select("left_id", "right_id", F.lit("same_source").alias("problem"))
    itself = mapped.where("left_id = right_id").select("left_id", "right_id", F.lit("itself").alias("problem"))
    kind = mapped.where(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).select("left_id", "right_id", F.lit("unknown_kind").alias("problem"))
    return gone("left_id").unionByName(gone("right_id")).unionByName(same).unionByName(itself).unionByName(kind).distinct()


def given_mappings(answers: DataFrame, cls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound mappings, problems) of mappings that came from elsewhere, for example from a model: (left_id, right_id, kind, confidence)."""
    rows = answers.dropDuplicates(["left_id", "right_id"])
    problems = mapping_problems(rows, cls)
    return rows.join(problems.select("left_id", "right_id").distinct(), ["left_id", "right_id"], "left_anti"), problems


# --- opposed statements ---------------------------------------------------------------------------------------------

# Stop words, negations and the direction of effect words of statements.
STATEMENT_STOP = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "their", "this", "to", "when", "with")
STATEMENT_NEGATIONS = ("no", "not", "never", "without", "cannot", "shouldnt", "mustnt")
EFFECT_UP = ("improve", "improves", "improved", "enhance", "enhances", "support", "supports", "enable", "enables", "promote", "promotes", "effective", "beneficial")
EFFECT_DOWN = ("harm", "harms", "worsen", "worsens", "undermine", "undermines", "inhibit", "inhibits", "prevent", "prevents", "ineffective", "detrimental")
QUANTITY_UP, QUANTITY_DOWN = ("increase", "increases", "raise", "raises"), ("decrease", "decreases", "reduce", "reduces", "lower", "lowers")
SUFFIXES = r"^(.{4,}?)(?:ization|ation|ments|ment|ing|ed|es|s)$"
STATEMENT_OVERLAP, STATEMENT_SHARED = 0.40, 2


def signatures(statements: DataFrame) -> DataFrame:
    """statements with content (stems), negated, effect and quantity (-1, 0 or 1; the last word of a kind counts)."""
    words = F.regexp_extract_all(F.replace(F.lower("statement"), F.lit("'"), F.lit("")), F.lit("[a-z0-9]+"), F.lit(0))
    polar = (*EFFECT_UP, *EFFECT_DOWN, *QUANTITY_UP, *QUANTITY_DOWN)
    plain = F.filter("tokens", lambda w: ~w.isin(*STATEMENT_STOP) & ~w.isin(*STATEMENT_NEGATIONS) & ~w.isin(*polar))
    stems = F.array_sort(F.array_distinct(F.transform(plain, lambda w: F.regexp_replace(w, SUFFIXES, "$1"))))

    def direction(up: tuple, down: tuple) -> Column:
        last = F.try_element_at(F.filter("tokens", lambda w: w.isin(*up, *down)), F.lit(-1))
        sign = F.when(F.col("negated"), -1).otherwise(1)
        return F.coalesce(F.when(last.isin(*up), sign).when(last.isin(*down), -sign), F.lit(0))

    base = statements.withColumn("tokens", words).withColumn("negated", F.exists("tokens", lambda w: w.isin(*STATEMENT_NEGATIONS)))
    return base.withColumn("content", stems).withColumn("effect", direction(EFFECT_UP, EFFECT_DOWN)).withColumn("quantity", direction(QUANTITY_UP, QUANTITY_DOWN)).drop("tokens")


def _poles(sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sig once for each way to oppose another statement, by the side it takes: negated or not, effects or quantities up or down."""
    way = lambda n, e, q: F.explode(F.filter(F.array(F.when(n, "negation"), F.when(e, "effect"), F.when(q, "quantity")), lambda w: w.isNotNull())).alias("way")
    up, down = way(F.col("negated"), F.col("effect") == 1, F.col("quantity") == 1), way(~F.col("negated"), F.col("effect") == -1, F.col("quantity") == -1)
    return sig.select("*", up), sig.select("*", down)


def opposed_statements(statements: DataFrame) -> DataFrame:
    """(left_statement, right_statement, kind): distinct statements on one topic that oppose each other.

    Only statements at opposite poles are compared.  They meet by one of their
    rarest stems, so many that the overlap leaves no way to miss, at the first
    stem they have in common and only if enough stems come after it on both sides.
    """
    sig = signatures(statements.select("statement", "modality").where("statement is not null").groupBy("statement").agg(F.array_sort(F.collect_set("modality")).alias("modalities"))).where(F.size("content") >= STATEMENT_SHARED)
    sig = cut(sig.withColumn("id", F.monotonically_increasing_id()))
    flat = sig.select("id", F.explode("content").alias("stem"))
    # numbers that go up with the stems' frequency
    number = cut(flat.groupBy("stem").agg(F.count("*").alias("df")).orderBy("df", "stem").select("stem", F.monotonically_increasing_id().alias("number")))
    stems = flat.join(number, "stem").groupBy("id").agg(F.array_sort(F.collect_list("number")).alias("stems"))
    short = cut(sig.join(stems, "id").select("id", "negated", "effect", "quantity", "stems", F.size("stems").alias("n")))
    prefix = lambda poles: poles.select("*", F.posexplode(F.expr(f"slice(stems, 1, n - cast(ceil(n * {STATEMENT_OVERLAP} - 1e-9) as int) + 1)")).alias("place", "stem"))
    up, down = map(prefix, _poles(short))
    needed = (F.col("a.n") + F.col("b.n")) * (STATEMENT_OVERLAP / (1 + STATEMENT_OVERLAP)) - 1e-6
    met = up.alias("a").join(down.alias("b"), ["way", "stem"]).where(F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place")) >= F.greatest(needed, F.lit(STATEMENT_SHARED)))
    # a pair counts once: by the first way in which it is opposed, at its first common stem
    once = (F.col("way") == "negation") | ((F.col("a.negated") == F.col("b.negated")) & ((F.col("way") == "effect") | (F.col("a.effect") * F.col("b.effect") != -1)))
    both = met.where(once).select("stem", F.col("a.id").alias("a"), F.col("b.id").alias("b"), (F.col("a.n") + F.col("b.n")).alias("n"), F.array_intersect("a.stems", "b.stems").alias("common")).where(F.col("common")[0] == F.col("stem"))
    shared = F.size("common")
    pairs = both.where((shared >= STATEMENT_SHARED) & (shared / (F.col("n") - shared) >= STATEMENT_OVERLAP)).select("a", "b")
    one = lambda s: sig.select(F.col("id").alias(s), F.col("statement").alias(f"{s}_statement"), F.col("modalities").alias(f"{s}_modalities"))
    j = pairs.join(one("a"), "a").join(one("b"), "b")
    has = lambda m: F.array_contains(F.array_union("a_modalities", "b_modalities"), m)
    kind = F.when(has("normative"), "normative").when(has("methodological") | has("heuristic"), "methodological").when(has("causal"), "causal").otherwise("empirical")
    return j.select(F.least("a_statement", "b_statement").alias("left_statement"), F.greatest("a_statement", "b_statement").alias("right_statement"), kind.alias("kind"))


def opposed_claims(axioms: DataFrame) -> DataFrame:
    """(conflict_id, kind, left_id, right_id): axioms of different sources whose statements oppose each other; for each pair of statements the smallest claim of either side."""
    pairs = opposed_statements(axioms.select("statement", "modality"))
    side = lambda s: axioms.select(F.col("statement").alias(f"{s}_statement"), F.col("source_id").alias(f"{s}_source"), F.col("claim_id").alias(f"{s}_id"))
    # statements are classes: their claims meet through the first claim of each source pair, not all with all
    left = side("left").groupBy("left_statement").agg(F.min(F.struct("left_source", "left_id")).alias("l"), F.max(F.struct("left_source", "left_id")).alias("l2"))
    right = side("right").groupBy("right_statement").agg(F.min(F.struct("right_source", "right_id")).alias("r"), F.max(F.struct("right_source", "right_id")).alias("r2"))
    met = pairs.join(left, "left_statement").join(right, "right_statement")
    # where both first claims are of one source, another source's claim of either side stands in
    a = F.when(F.col("l.left_source") != F.col("r.right_source"), F.struct(F.col("l.left_id").alias("x"), F.col("r.right_id").alias("y"))).when(F.col("l2.left_source") != F.col("r.right_source"), F.struct(F.col("l2.left_id").alias("x"), F.col("r.right_id").alias("y"))).when(
        F.col("l.left_source") != F.col("r2.right_source"), F.struct(F.col("l.left_id").alias("x"), F.col("r2.right_id").alias("y"))
    )
    found = met.withColumn("p", a).where("p is not null").select("kind", F.least("p.x", "p.y").alias("left_id"), F.greatest("p.x", "p.y").alias("right_id")).distinct()
    return found.select(_conflict_id("left_id", "right_id"), "kind", "left_id", "right_id")


def _conflict_id(left: str, right: str) -> Column:
    return F.concat(F.lit("conflict:"), F.substring(F.sha2(F.concat_ws("\u001f", left, right), 256), 1, 16)).alias("conflict_id")


def united_conflicts(declared: DataFrame, opposed: DataFrame, mapped: DataFrame) -> DataFrame:
    """(conflict_id, origin, kind, members): declared, cross-source and mapping conflicts with unique identifiers.

    A declared conflict that repeats an identifier gets one of its own; another
    conflict with an identifier that is taken is the same one and is left out.
    """
    base = declared.select("conflict_id", F.lit("declared").alias("origin"), "kind", F.array_join("claim_ids", " ").alias("members"), F.lit(0).alias("turn"))
    cross = opposed.select("conflict_id", F.lit("cross_source").alias("origin"), "kind", F.concat_ws(" ", "left_id", "right_id").alias("members"), F.lit(1).alias("turn"))
    terms = mapped.where("kind = 'conflicting'").select(_conflict_id("left_id", "right_id"), F.lit("mapping").alias("origin"), F.lit("terminological").alias("kind"), F.concat_ws(" ", "left_id", "right_id").alias("members"), F.lit(2).alias("turn"))
    n = F.row_number().over(W.partitionBy("conflict_id").orderBy("turn", "members"))
    rows = base.unionByName(cross).unionByName(terms).withColumn("n", n).where("n = 1 or turn = 0")
    return rows.select(F.when(F.col("n") > 1, F.concat("conflict_id", F.lit("-"), F.col("n").cast("string"))).otherwise(F.col("conflict_id")).alias("conflict_id"), "origin", "kind", "members")
