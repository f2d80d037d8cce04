"""Best representative of each duplicate group.

Method: consistent bundles.  Dependent fields are grouped into bundles that
come from one row each (for example a chunk_id with its source_id); the
surviving record takes a whole bundle from some row of the group.  Which ones
is chosen by branch-and-bound that maximises the summed trust under functional
dependencies between bundles (the chosen left value must carry the right value
which the group most trusts for it).

No group is gathered.  Rows are first reduced to the best row for each distinct
bundle value (partial aggregation), then the ``width`` most trusted candidates
of each bundle are kept by a rank that Spark also applies before the shuffle.
Branch-and-bound over these gives a lower bound; any assignment that uses a
candidate outside has at most the trust of the next candidate plus the best of
the other bundles.  Groups for which that upper bound is not beaten are run
again with a doubled width, until every group's optimum is proven; most groups
are proven at once, for without a conflict the best of each bundle is optimal.

The trust of a candidate is its own number (a confidence, a count of quotes, a
time) divided by the best of its group and bundle, in steps of 1e-9.  The sum is
maximised in the order of the bundles' tiers: fields that the record is asked
for come first, fields that depend on them never cost one of those; among equal
sums the candidates of the rows extracted last win.

Labels.  An intact label is a term's full name.  Blank labels, placeholders,
mark-up, replacement characters, mis-decoded text, letters replaced by digits
or signs, and labels cut short aren't intact.  A label is cut short if another
row of the group, whatever its damage, goes on after it, or if its last word is
the beginning of a word that is far more common over all labels.

Defined results: rows without dup_group are no group; exact duplicate rows count
once; nulls never win; a bundle without a usable value gives no row; ties go to
the row extracted last, then loaded last, then to the largest term_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.runtime import cut

# Labels that stand for no label.
PLACEHOLDERS = ("n a", "na", "none", "null", "nil", "nan", "unknown", "tbd", "tba", "todo", "to do", "untitled", "unnamed", "placeholder", "missing", "undefined", "not available", "no label", "x", "xx", "xxx", "test", "dummy")
# Signs that stand for letters.
SIGNS, LETTERS = "013457@$!|+€", "oleastasiite"
#: How much more common the longer word must be for its beginning to count as cut off.
CUT_RATIO = 5
_PLACEHOLDER_NUMBER = r"^(term|label|concept|item|entity|node|name|field|value|id)[ _-]*\d+$"
_MISDECODED = r"[ÃÂ][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ¢¡]|â‚¬|â€|Ã|ï¿½"
_MARKUP = r"<[^<>]*>?|\[\[|\]\]|\{\{|\}\}|\*\*|__|&[a-zA-Z]+;|&#\d+;|\\[a-zA-Z]+\{|```|^#+ |'''?"
_ELLIPSIS = r"(\.{2,}|…)[\s\p{P}]*$"


@dataclass(frozen=True)
class Bundle:
    """Fields that survive together; usable and trust are SQL expressions over a row, the higher trust wins.

    A bundle of a lower tier is never given up for one of a higher tier.
    """

    name: str
    value: str
    usable: str
    trust: str
    tier: int = 0


@dataclass(frozen=True)
class Dependency:
    """The value of bundle ``left`` determines the value of bundle ``right``."""

    left: str
    right: str


#: Steps of a normalised trust; whole numbers, so that sums and bounds are exact.
STEPS = 1_000_000_000
#: The trust of a candidate by tiers, then its place among equals (0 the first, then negative).
Score = tuple[int, ...]
_Option = tuple[Score, object, str]


def _plus(a: Score, b: Score) -> Score:
    return tuple(x + y for x, y in zip(a, b))


def branch_and_bound(options: dict[str, list[_Option]], allowed: dict[tuple[str, str], dict[str, str]], size: int = 1) -> tuple[Score, dict[str, object]]:
    """Best assignment of at most one candidate to each bundle: the highest sum of scores in lexicographic order.

    options: bundle -> [(score, id, value)] from the highest score; allowed:
    (left, right) -> {left value: right value}.  A left value without an entry
    determines nothing.  A branch is left as soon as its sum with the best scores
    of the open bundles, which no assignment exceeds in any part, isn't higher
    than the best sum so far.
    """
    zero = (0,) * size
    names = sorted(options, key=lambda n: (len(options[n]), n))
    rest = [zero] * (len(names) + 1)
    for i in range(len(names) - 1, -1, -1):
        rest[i] = _plus(rest[i + 1], tuple(max([0, *(o[0][k] for o in options[names[i]])]) for k in range(size)))
    best: Score | None = None
    pick: dict[str, object] = {}

    def fits(chosen: dict[str, _Option], name: str, value: str) -> bool:
        for (left, right), must in allowed.items():
            if right == name and left in chosen and must.get(chosen[left][2], value) != value:
                return False
            if left == name and right in chosen and must.get(value, chosen[right][2]) != chosen[right][2]:
                return False
        return True

    def go(i: int, total: Score, chosen: dict[str, _Option]) -> None:
        nonlocal best, pick
        if best is not None and _plus(total, rest[i]) <= best:
            return
        if i == len(names):
            best, pick = total, {n: c[1] for n, c in chosen.items()}
            return
        for c in options[names[i]]:
            if fits(chosen, names[i], c[2]):
                chosen[names[i]] = c
                go(i + 1, _plus(total, c[0]), chosen)
                del chosen[names[i]]
        # a bundle may stay empty if no candidate fits
        go(i + 1, total, chosen)

    go(0, zero, {})
    return best or zero, pick


def _candidates(rows: DataFrame, group: str, row_id: str, bundles: list[Bundle], newest: list[str]) -> DataFrame:
    """(grp, bundle, value, id, sort): the best row for each distinct value of each bundle."""
    order = F.struct(*[F.col(c) for c in newest], F.col(row_id))
    each = F.array(
        *[
            F.when(
                F.expr(b.usable),
                F.struct(
                    F.lit(b.name).alias("bundle"),
                    F.expr(b.value).cast("string").alias("value"),
                    F.struct(F.expr(b.trust).cast("double").alias("trust"), order.alias("newest")).alias("sort"),
                ),
            )
            for b in bundles
        ]
    )
    flat = rows.where(F.col(group).isNotNull()).select(F.col(group).alias("grp"), F.col(row_id).alias("id"), F.explode(F.filter(each, lambda x: x.isNotNull())).alias("c")).select("grp", "id", "c.*")
    return flat.groupBy("grp", "bundle", "value").agg(F.max("sort").alias("sort"), F.max_by("id", "sort").alias("id"))


def survivors(rows: DataFrame, group: str, row_id: str, bundles: list[Bundle], dependencies: list[Dependency] = (), newest: list[str] = (), width: int = 8) -> DataFrame:
    """(grp, bundle, id, value): for every group the row that supplies each bundle of the surviving record."""
    candidates = cut(_candidates(rows, group, row_id, bundles, list(newest)))
    tiers = {b.name: b.tier for b in bundles}
    depth = max(tiers.values()) + 2
    pairs = rows.sparkSession.createDataFrame([], "grp string, left string, right string, lv string, rv string")
    values = {b.name: b for b in bundles}
    for d in dependencies:
        l, r = values[d.left], values[d.right]
        seen = rows.where(F.col(group).isNotNull()).where(F.expr(l.usable)).where(F.expr(r.usable))
        seen = seen.select(F.col(group).alias("grp"), F.expr(l.value).cast("string").alias("lv"), F.expr(r.value).cast("string").alias("rv"), F.expr(r.trust).cast("double").alias("t"))
        each = seen.groupBy("grp", "lv", "rv").agg(F.count("*").alias("n"), F.max("t").alias("t"))
        pairs = pairs.unionByName(each.groupBy("grp", "lv").agg(F.max_by("rv", F.struct("n", "t", "rv")).alias("rv")).select("grp", F.lit(d.left).alias("left"), F.lit(d.right).alias("right"), "lv", "rv"))
    pairs = cut(pairs) if dependencies else pairs
    open_, done, k = candidates, None, width
    schema = "grp string, bundle string, id bigint, value string, proven boolean"
    names = [b.name for b in bundles]
    while True:
        w = W.partitionBy("grp", "bundle").orderBy(F.col("sort").desc(), F.col("value"))
        # the rank limit is also applied before the shuffle, so a hot group sends k rows from each task
        top = open_.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1).select("grp", "bundle", "value", "id", "rank", "sort.trust")
        facts = top.select("grp", F.lit("c").alias("kind"), "bundle", F.lit(None).cast("string").alias("other"), "value", F.lit(None).cast("string").alias("must"), "id", "rank", "trust")
        if dependencies:
            shown = top.where(F.col("rank") <= k).select("grp", F.col("bundle").alias("left"), F.col("value").alias("lv"))
            facts = facts.unionByName(
                pairs.join(shown, ["grp", "left", "lv"]).select("grp", F.lit("d").alias("kind"), F.col("left").alias("bundle"), F.col("right").alias("other"), F.col("lv").alias("value"), F.col("rv").alias("must"), F.lit(None).cast("bigint").alias("id"), F.lit(0).alias("rank"), F.lit(None).cast("double").alias("trust"))
            )

        def choose(batches: Iterator[pd.DataFrame], k=k) -> Iterator[pd.DataFrame]:
            # rows come sorted by group within the partition; a group has at most (k + 1) * (bundles + dependencies) rows
            def solve(grp: str, block: list[tuple]) -> list[tuple]:
                options = {n: [] for n in names}
                allowed: dict[tuple[str, str], dict[str, str]] = {}
                more: dict[str, Score] = {}
                highest: dict[str, float] = {}
                for _, kind, bundle, _, _, _, _, rank, trust in block:
                    if kind == "c":
                        highest[bundle] = max(highest.get(bundle, 0.0), trust)
                for _, kind, bundle, other, value, must, id_, rank, trust in block:
                    if kind == "d":
                        allowed.setdefault((bundle, other), {})[value] = must
                        continue
                    # a candidate that is used counts for something, even with no trust of its own
                    part = 1 + (round(STEPS * trust / highest[bundle]) if highest[bundle] > 0 else STEPS)
                    score = tuple(part if t == tiers[bundle] else 0 for t in range(depth - 1)) + (1 - int(rank),)
                    if rank > k:
                        more[bundle] = score
                    else:
                        options[bundle].append((score, int(id_), value))
                for o in options.values():
                    o.sort(key=lambda c: c[0], reverse=True)
                best, pick = branch_and_bound(options, allowed, depth)
                zero = (0,) * depth
                ahead = {n: o[0][0] if o else zero for n, o in options.items()}

                def bound(n: str, instead: Score) -> Score:
                    total = instead
                    for m, first in ahead.items():
                        total = _plus(total, first) if m != n else total
                    return total

                proven = all(best >= bound(n, t) for n, t in more.items())
                shown = {n: {c[1]: c[2] for c in o} for n, o in options.items()}
                return [(grp, n, i, shown[n][i], proven) for n, i in pick.items()] or [(grp, None, None, None, proven)]

            columns = ["grp", "bundle", "id", "value", "proven"]
            grp, block = None, []
            for pdf in batches:
                out = []
                for r in pdf.itertuples(index=False, name=None):
                    if r[0] != grp and block:
                        out.extend(solve(grp, block))
                        block = []
                    grp = r[0]
                    block.append(r)
                yield pd.DataFrame(out, columns=columns).astype({"id": "Int64"})
            if block:
                yield pd.DataFrame(solve(grp, block), columns=columns).astype({"id": "Int64"})

        chosen = cut(facts.repartition("grp").sortWithinPartitions("grp").mapInPandas(choose, schema))
        proven = chosen.where("proven and bundle is not null").drop("proven")
        done = proven if done is None else done.unionByName(proven)
        pending = chosen.where("not proven").select("grp").distinct()
        if pending.isEmpty():
            return done
        open_, k = cut(candidates.join(pending, "grp", "left_semi")), k * 2


# --- labels ---------------------------------------------------------------------------------------------------------


def _key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}�]+", " "))


def labelled(terms: DataFrame) -> DataFrame:
    """terms with label_key (case, punctuation and spacing set aside) and intact (the label is a full name)."""
    label = F.col("label")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(label, _MARKUP, ""), _MISDECODED + r"|[\u0080-\u009f]", ""), _ELLIPSIS, "")
    # a sign inside a word that stands for a letter
    swapped = r"(?<=[\p{L}@$!|+€0-9])[@$!|+€0-9](?=[\p{L}@$!|+€0-9])|[@$!|+€0-9](?=[@$!|+€0-9]*\p{L})|(?<=\p{L})[@$|+€0-9]"
    mixed_word = F.size(F.regexp_extract_all(label, F.lit(r"\p{L}[@$!|+€0-9]+\p{L}"), F.lit(0)))
    key = _key(bare)
    decoded = F.when(F.regexp_like(bare, F.lit(swapped)), _key(F.translate(bare, SIGNS, LETTERS))).otherwise(key)
    blank = label.isNull() | ~F.regexp_like(label, F.lit(r"\p{L}"))
    sound = (
        ~blank
        & ~key.isin(*PLACEHOLDERS)
        & ~F.regexp_like(F.lower(F.trim(label)), F.lit(_PLACEHOLDER_NUMBER))
        & ~F.contains(label, F.lit("\ufffd"))
        & ~F.regexp_like(label, F.lit(_MISDECODED))
        & ~F.regexp_like(label, F.lit(r"[\u0000-\u0008\u000e-\u001f\u0080-\u009f]"))
        & ~F.regexp_like(label, F.lit(_MARKUP))
        & ~F.regexp_like(label, F.lit(_ELLIPSIS))
    )
    # The patterns are matched once for each distinct spelling of a source, which is far fewer rows than terms.
    stated = terms.where("label is not null").select("source_id", "label").distinct()
    spelt = cut(stated.select("source_id", "label", key.alias("label_key"), decoded.alias("label_decoded"), F.coalesce(sound, F.lit(False)).alias("sound"), F.coalesce(mixed_word, F.lit(0)).alias("mixed_words")))
    forms = spelt.drop("source_id").distinct()

    # how often each word stands in a sound label, over all labels
    words = cut(spelt.where("sound and mixed_words = 0").select("source_id", "label_key").distinct().select(F.explode(F.split("label_key", " ")).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n")))
    # for each beginning of a word, the count of the most common longer word
    longer = words.where(F.length("word") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), F.lit(1), i))).alias("last_word"), "n").groupBy("last_word").agg(F.max("n").alias("n_longer"))
    cut_words = words.select(F.col("word").alias("last_word"), "n").join(longer, "last_word").where(F.col("n_longer") >= CUT_RATIO * F.col("n")).select("last_word")
    known = words.where("n > 1").select(F.col("word").alias("decoded_word"))
    # in digits and signs for letters: one word decodes to a known word, or several words are so written
    swaps = forms.where("sound and mixed_words = 1").withColumn("decoded_word", F.element_at(F.split("label_decoded", " "), 1)).join(known, "decoded_word", "left_semi").select("label")
    broken = forms.where("not sound or mixed_words > 1").select("label")
    ends = forms.where("sound").withColumn("last_word", F.substring_index("label_key", " ", -1)).join(cut_words, "last_word", "left_semi").select("label")
    # one row for each spelling that isn't a full name
    damaged = swaps.unionByName(broken).unionByName(ends).distinct()

    # A word with one lost character is read as the most common word that fits.
    lost = forms.where("label_decoded like '%\ufffd%'").select("label_decoded").distinct()
    holed = lost.select("label_decoded", F.explode(F.split("label_decoded", " ")).alias("hole")).where("hole like '%\ufffd%'")
    fits = words.where("n > 1").select("word", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.overlay(F.col("word"), F.lit("\ufffd"), i, F.lit(1)))).alias("hole"))
    filled = holed.join(fits, "hole").groupBy("label_decoded", "hole").agg(F.max_by("word", F.struct("n", "word")).alias("word"))
    # a label whose every hole is filled; a label has few of them
    read = filled.groupBy("label_decoded").agg(F.collect_list(F.struct("hole", "word")).alias("h")).select("label_decoded", F.aggregate("h", F.col("label_decoded"), lambda t, x: F.replace(t, x["hole"], x["word"])).alias("filled"))

    # Another row of the group goes on: with all forms of a group's labels in order, an extension of a form follows it
    # directly.  The order is cut into ranges, so a hot group is spread over many tasks.
    grouped = terms.where("dup_group is not null and label is not null").select("dup_group", "source_id", "label").distinct()
    seen = grouped.join(spelt, ["source_id", "label"]).select("dup_group", "label_key", "label_decoded").distinct().where("label_decoded <> ''")
    whole = seen.where("label_decoded not like '%\ufffd%'").withColumn("filled", F.lit(None).cast("string")).unionByName(seen.where("label_decoded like '%\ufffd%'").join(read, "label_decoded", "left"))
    full = whole.select("dup_group", F.explode(F.array_distinct(F.array_compact(F.array(F.coalesce("filled", "label_decoded"), F.regexp_replace("label_decoded", "\ufffd.*$", ""), "label_key")))).alias("full")).where("full <> ''").distinct()
    ranges = cut(full.repartitionByRange(max(int(full.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), "dup_group", "full").withColumn("part", F.spark_partition_id()))
    heads = ranges.groupBy("part").agg(F.min(F.struct("dup_group", "full")).alias("head"))
    # one row for each range: its successor's first form closes its last one
    after = heads.select("part", F.lead("head").over(W.orderBy("part")).alias("after"))
    following = F.lead(F.struct("dup_group", "full")).over(W.partitionBy("part").orderBy("dup_group", "full"))
    chained = ranges.withColumn("next", following).join(F.broadcast(after), "part", "left").withColumn("next", F.coalesce("next", "after"))
    goes_on = chained.where((F.col("next.dup_group") == F.col("dup_group")) & F.startswith("next.full", F.col("full"))).select("dup_group", F.col("full").alias("label_key"), F.lit(True).alias("goes_on"))

    # rows without a label need neither table
    nameless = terms.where("label is null").withColumn("label_key", F.lit(None).cast("string")).withColumn("intact", F.lit(False))
    named = terms.where("label is not null").withColumn("label_key", key).join(damaged.withColumn("damaged", F.lit(True)), "label", "left").join(goes_on, ["dup_group", "label_key"], "left")
    return named.withColumn("intact", F.col("damaged").isNull() & F.col("goes_on").isNull()).drop("damaged", "goes_on").unionByName(nameless)


def checked(terms: DataFrame) -> DataFrame:
    """Distinct rows with label_key, intact, n_quotes and the usable confidence."""
    verified = F.filter("evidence", lambda e: e["verified"] & (e["quote_sha256"] == F.sha2(e["quote"], 256)))
    rows = terms.select("term_id", "source_id", "chunk_id", "dup_group", "label", "kind", "confidence", "extracted_at", "loaded_at", F.coalesce(F.size(F.array_distinct(F.transform(verified, lambda e: e["quote"]))), F.lit(0)).alias("n_quotes"), F.md5(F.to_json(F.struct("evidence"))).alias("evidence_id")).distinct()
    return labelled(cut(rows))


LABEL = Bundle("label", "label_key", "intact", "coalesce(unix_micros(extracted_at), 0)")
CONFIDENCE = Bundle("confidence", "confidence", "confidence between 0 and 1 and not isnan(confidence)", "confidence")
EVIDENCE = Bundle("evidence", "evidence_id", "n_quotes > 0", "n_quotes")
#: Fields that depend on those: a label has one kind, evidence one origin (a chunk with its source).
KIND = Bundle("kind", "kind", "kind is not null and trim(kind) <> ''", "coalesce(case when confidence between 0 and 1 then confidence end, 0)", 1)
ORIGIN = Bundle("origin", "chunk_id", "source_id is not null and chunk_id is not null", "n_quotes", 1)
DEPENDENCIES = (Dependency("label", "kind"), Dependency("evidence", "origin"))


def consistent_survivors(terms: DataFrame) -> DataFrame:
    """(dup_group, bundle, term_id, value): the row that supplies each bundle of every group's surviving term."""
    rows = survivors(cut(checked(terms).where("dup_group is not null")), "dup_group", "term_id", [LABEL, CONFIDENCE, EVIDENCE, KIND, ORIGIN], DEPENDENCIES, newest=["extracted_at", "loaded_at"])
    return rows.select(F.col("grp").alias("dup_group"), "bundle", F.col("id").alias("term_id"), "value")


def surviving_rows(terms: DataFrame) -> DataFrame:
    """(dup_group, field, term_id): the row that supplies the best label, confidence and evidence of each group."""
    asked = consistent_survivors(terms).where(F.col("bundle").isin("label", "confidence", "evidence"))
    return asked.select("dup_group", F.col("bundle").alias("field"), "term_id")
