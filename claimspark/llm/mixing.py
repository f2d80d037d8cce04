"""Mixing sources to target weights.

Method: temperature mixing.  Token shares are exponentiated and normalised, and
the exponent is bisected.

* Towards targets: w ~ p (t/p)^a, the natural shares p of the sources times the
  exponentiated ratio to the target shares t.  The exponent is the largest that
  the repetition limit allows for the budget and that the entropy needs: the
  relative entropy of the targets to the weights falls as a grows and is to
  reach ``divergence``.  Without a budget the largest one is bisected at which
  the exponent still meets the targets, so that the shares are those asked for
  (up to one document of a source) and as much as possible is used.
* Without targets: w ~ p^a with the exponent at which the weights have a target
  entropy; the budget is the largest that the repetition limit allows.

The weights are realised as budgeted block permutations: a source's documents
are passed as often as its quota holds all of them, and a last, partial pass
takes the documents in the order of a hash of (document, pass) until the quota
is used.  The order is cut by token sums of hash blocks, so only the one block
in which the quota ends is ordered row by row; no source is gathered.

Sizes are tokens of a public tokenizer (a file whose path is a parameter).

Defined results: null and blank texts have no tokens and aren't used; repeated
rows count once; sources compare in lower case with spaces and hyphens as
underscores; a target without documents can't be filled: its actual share is 0
and the other targets are scaled to sum to 1; a source without a target and a
target of 0 give nothing; a null max_repeats counts as 1.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.runtime import cut, once, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public split pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents of one source in a block of its permutation.
BLOCK_ROWS = 20_000
#: A table of targets is a setting; a larger one is an error.
MOST_TARGETS = 100_000


def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def source_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), r"[\s\p{Z}_-]+", "_")


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens) of the documents that have text."""
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = once(f"encoder:{tokenizer}", lambda: encoder(tokenizer))
        for s in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) for t in s], dtype="int64")

    docs = documents.where("doc_id is not null and source is not null").where(F.regexp_like("text", F.lit(r"[^\s\p{Z}]"))).select("doc_id", source_key(F.col("source")).alias("source"), "text").distinct()
    return spread(docs).select("doc_id", "source", count("text").alias("tokens"))


def tempered(shares: dict[str, float], exponent: float) -> dict[str, float]:
    w = {k: v**exponent if v > 0 else 0.0 for k, v in shares.items()}
    total = sum(w.values()) or 1.0
    return {k: v / total for k, v in w.items()}


def entropy(shares: dict[str, float]) -> float:
    return -sum(p * math.log(p) for p in shares.values() if p > 0)


def exponent_for_entropy(shares: dict[str, float], target: float, steps: int = 80) -> float:
    """The exponent at which the tempered shares have the entropy (0 at uniform; falls as the exponent grows)."""
    low, high = 0.0, 1.0
    while entropy(tempered(shares, high)) > target and high < 1e6:
        high *= 2
    for _ in range(steps):
        mid = (low + high) / 2
        if entropy(tempered(shares, mid)) > target:
            low = mid
        else:
            high = mid
    return (low + high) / 2


@dataclass
class Plan:
    exponent: float
    budget: int
    weights: dict[str, float]


def _normal(values: dict[str, float]) -> dict[str, float]:
    total = sum(values.values())
    return {k: v / total for k, v in values.items()}


def between(natural: dict[str, int], targets: dict[str, float], exponent: float) -> dict[str, float]:
    """The shares p (t/p)^exponent, normalised, of the sources that have documents and a target."""
    usable = [s for s, t in targets.items() if t > 0 and natural.get(s, 0) > 0]
    p, t = _normal({s: natural[s] for s in usable}), _normal({s: targets[s] for s in usable})
    return _normal({s: p[s] * (t[s] / p[s]) ** exponent for s in usable})


def relative_entropy(t: dict[str, float], w: dict[str, float]) -> float:
    return max(0.0, sum(x * math.log(x / w[s]) for s, x in t.items() if x > 0))


def plan(natural: dict[str, int], targets: dict[str, float], repeats: dict[str, int], budget: int | None = None, divergence: float = 1e-15, steps: int = 100) -> Plan:
    """Weights of the sources that have documents and a target."""
    usable = {s: t for s, t in targets.items() if t > 0 and natural.get(s, 0) > 0 and repeats[s] > 0}
    if not usable:
        return Plan(1.0, 0, {})
    most = {s: natural[s] * repeats[s] for s in usable}
    wanted = _normal(usable)
    met = lambda a: relative_entropy(wanted, between(natural, usable, a)) <= divergence
    fits = lambda a, size: all(w * size <= most[s] for s, w in between(natural, usable, a).items())
    # the least exponent that meets the targets
    low, high = 0.0, 1.0
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if met(mid) else (mid, high)
    needed = high
    if budget is None:
        # the largest budget at which that exponent keeps to the repetition limit
        low, high = 0, sum(most.values()) + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if fits(needed, mid) else (low, mid)
        return Plan(needed, low, between(natural, usable, needed))
    if fits(needed, budget):
        return Plan(needed, budget, between(natural, usable, needed))
    low, high = 0.0, needed
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if fits(mid, budget) else (low, mid)
    return Plan(low, budget, between(natural, usable, low))


def _prefix(rows: DataFrame, blocks: DataFrame, seed: int) -> DataFrame:
    """rows (doc_id, source, tokens, copy, rest): those whose running token sum by hash order is within rest."""
    h = F.xxhash64("doc_id", "copy", F.lit(seed))
    keyed = rows.join(blocks, "source").withColumn("h", h).withColumn("block", F.pmod(F.shiftrightunsigned("h", 1), F.col("blocks")))
    keyed = cut(keyed)
    sums = keyed.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("sum"))
    running = F.sum("sum").over(W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, 0))
    ends = sums.withColumn("end", running).withColumn("begin", F.col("end") - F.col("sum"))
    placed = keyed.join(ends.select("source", "block", "begin", "end"), ["source", "block"])
    inside = placed.where(F.col("end") <= F.col("rest"))
    last = placed.where((F.col("begin") < F.col("rest")) & (F.col("end") > F.col("rest")))
    within = F.sum("tokens").over(W.partitionBy("source", "block").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    return inside.select("doc_id", "source", "tokens", "copy").unionByName(last.withColumn("run", F.col("begin") + within).where(F.col("run") <= F.col("rest")).select("doc_id", "source", "tokens", "copy"))


def _setup(documents: DataFrame, targets: DataFrame, budget: int | None, tokenizer: str):
    sizes = cut(token_sizes(documents, tokenizer))
    goals = targets.where("source is not null").select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    n = goals.count()
    if n > MOST_TARGETS:
        raise ValueError(f"{n} target sources; at most {MOST_TARGETS} are a setting")
    per = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    rows = goals.join(per, "source", "left").collect()  # one row for each target, at most MOST_TARGETS
    natural = {r["source"]: int(r["tokens"] or 0) for r in rows}
    found = plan(natural, {r["source"]: float(r["target_share"] or 0) for r in rows}, {r["source"]: int(r["max_repeats"]) for r in rows}, budget)
    return sizes, rows, natural, found


def mixture(documents: DataFrame, targets: DataFrame, budget: int | None = None, tokenizer: str = TOKENIZER, seed: int = 0) -> DataFrame:
    """(doc_id, source, copy, tokens): the documents of the mixture, one row for each use."""
    return _mixture(*_setup(documents, targets, budget, tokenizer), seed)


def _mixture(sizes: DataFrame, rows: list, natural: dict[str, int], found: Plan, seed: int) -> DataFrame:
    spark = sizes.sparkSession
    quotas = []
    for r in rows:
        s = r["source"]
        if s in found.weights:
            quota = min(int(found.weights[s] * found.budget + 1e-6), natural[s] * int(r["max_repeats"]))
            passes = quota // natural[s]
            quotas.append((s, int(passes), int(quota - passes * natural[s]), max(1, -(-int(r["n"]) // BLOCK_ROWS))))
    quota = spark.createDataFrame(quotas, "source string, passes int, rest bigint, blocks bigint")
    joined = sizes.join(F.broadcast(quota), "source")  # at most MOST_TARGETS rows
    whole = joined.where("passes > 0").select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("copy"))
    part = joined.where("rest > 0").select("doc_id", "source", "tokens", (F.col("passes") + 1).alias("copy"), "rest")
    blocks = F.broadcast(quota.select("source", "blocks"))
    taken = cut(_prefix(part, blocks, seed))
    again = 0
    while True:
        # where the next document was too long for what is left of the quota, smaller ones fill it, until none fits
        again += 1
        left = part.join(taken.groupBy("source").agg(F.sum("tokens").alias("sum")), "source", "left").withColumn("rest", F.col("rest") - F.coalesce("sum", F.lit(0))).drop("sum")
        small = cut(left.where("tokens > 0 and tokens <= rest").join(taken.select("doc_id", "copy"), ["doc_id", "copy"], "left_anti"))
        if small.isEmpty():
            break
        taken = cut(taken.unionByName(_prefix(small, blocks, seed + again)))
    return whole.unionByName(taken).select("doc_id", "source", "copy", "tokens")


def share_report(documents: DataFrame, targets: DataFrame, budget: int | None = None, tokenizer: str = TOKENIZER, seed: int = 0) -> DataFrame:
    """For every target: its share, the weight it was given, the actual share, tokens, uses and the highest number of repeats."""
    sizes, rows, natural, found = _setup(documents, targets, budget, tokenizer)
    used = _mixture(sizes, rows, natural, found, seed)
    per = cut(used.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("uses"), F.max("copy").alias("most_repeats")))
    total = F.lit(per.agg(F.sum("tokens").alias("total")).first()["total"])
    plan_rows = sizes.sparkSession.createDataFrame([(r["source"], float(r["target_share"] or 0), float(found.weights.get(r["source"], 0.0)), natural[r["source"]], int(r["max_repeats"])) for r in rows], "source string, target_share double, weight double, available_tokens bigint, max_repeats int")
    zero = F.lit(0).cast("bigint")
    return (
        plan_rows.join(per, "source", "left")
        .select("source", "target_share", "weight", F.coalesce(F.col("tokens") / total, F.lit(0.0)).alias("actual_share"), F.coalesce("tokens", zero).alias("tokens"), "available_tokens", F.coalesce("uses", zero).alias("uses"), "max_repeats", F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.lit(found.exponent).alias("exponent"))
    )


def _tempered(sizes: DataFrame, flatness: float) -> tuple[list, dict[str, int], float, dict[str, float]]:
    per = cut(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).where("tokens > 0"))
    if per.count() > MOST_TARGETS:
        raise ValueError("more sources than a plan may hold")
    rows = per.collect()  # one row for each source, at most MOST_TARGETS
    natural = {r["source"]: int(r["tokens"]) for r in rows}
    shares = _normal(natural) if natural else {}
    h = entropy(shares)
    a = exponent_for_entropy(shares, h + flatness * (math.log(len(shares)) - h)) if len(shares) > 1 else 1.0
    return rows, natural, a, tempered(shares, a)


def temperature_shares(documents: DataFrame, flatness: float = 0.5, tokenizer: str = TOKENIZER) -> DataFrame:
    """(source, tokens, natural_share, tempered_share, exponent): natural shares tempered to an entropy.

    The target entropy lies ``flatness`` of the way from the natural entropy to that of equal shares.
    """
    _, natural, a, t = _tempered(token_sizes(documents, tokenizer), flatness)
    total = sum(natural.values()) or 1
    return documents.sparkSession.createDataFrame([(s, natural[s], natural[s] / total, t[s], a) for s in sorted(natural)], "source string, tokens bigint, natural_share double, tempered_share double, exponent double")


def tempered_mixture(documents: DataFrame, flatness: float = 0.5, most_repeats: int = 4, tokenizer: str = TOKENIZER, seed: int = 0) -> DataFrame:
    """(doc_id, source, copy, tokens): a mixture of all sources with the shares of temperature_shares().

    The budget is the largest at which no source is used more than ``most_repeats`` times.
    """
    sizes = cut(token_sizes(documents, tokenizer))
    rows, natural, a, weights = _tempered(sizes, flatness)
    budget = int(min((natural[s] * most_repeats / w for s, w in weights.items() if w > 0), default=0))
    return _mixture(sizes, [r.asDict() | {"max_repeats": most_repeats} for r in rows], natural, Plan(a, budget, weights), seed)
