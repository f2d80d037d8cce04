"""Evaluation texts leaking into training text.

Method: a broadcast hash set of normalised test n-grams; every document's
normalised stream is scanned window by window, hits are verified against the
whole n-gram, and the matched spans (or whole documents) can be removed.

Text is compared in a stream of its letters and digits only (NFKC, casefold),
so case, punctuation, spacing and line breaks don't matter.  An n-gram is
``words`` consecutive words of an item, which must begin and end where words of
the document do, or for languages without spaces ``chars`` consecutive
characters anywhere.  As every n-gram of an item is in the set, a document that
holds one of them anywhere is found: there is no sampling and no cap.

What is broadcast are 64-bit hashes of the n-grams and of their first letters,
sorted, in blocks of at most about GRAM_BLOCK (18 bytes each), so the broadcast is
bounded however large the test set is; one block is one scan.  A window whose
first letters' hash is in the set is compared by the hash of the whole n-gram;
what agrees meets the n-grams in an equi-join, which compares all letters.

Defined results: null, empty and blank texts carry nothing and are carried by
nothing; items shorter than one n-gram can't be found; an item that occurs
under two ids is reported under both; repeated document rows count once; an
empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.runtime import cut, once, spread

#: N-grams in a broadcast: 36 MB.
GRAM_BLOCK = 2_000_000
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_BASE = regex.compile(r"[\p{L}\p{N}]\p{M}*")
_SPACELESS = ("zh", "ja")
_MEMO: dict[str, str] = {}


def _fold(word: str) -> str:
    """Letters and digits of a word, compatibility form, casefolded."""
    if word.isascii():
        return word.lower()
    found = _MEMO.get(word)
    if found is None:
        found = "".join(_WORD.findall(unicodedata.normalize("NFKC", word).casefold()))
        if len(word) <= 16:  # scripts without spaces have no words that repeat
            if len(_MEMO) >= 50_000:
                _MEMO.clear()
            _MEMO[word] = found
    return found


def _spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the words; a mark that doesn't compose with its letter ends a word, composed or not."""
    if unicodedata.is_normalized("NFC", text):
        return [m.span() for m in _WORD.finditer(text)]
    out: list[tuple[int, int]] = []
    last, open_ = -1, False
    for m in _BASE.finditer(text):
        s, e = m.span()
        whole = unicodedata.normalize("NFC", m.group())
        if open_ and s == last:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
        last, open_ = e, not any(unicodedata.category(c)[0] == "M" for c in whole)
    return out


def _folded(text: str) -> list[tuple[str, int, int]]:
    """(normalised word, start, end) in code points of the text."""
    return [(w, s, e) for s, e in _spans(text) if (w := _fold(unicodedata.normalize("NFC", text[s:e])))]


def _words(text: str) -> list[str]:
    if unicodedata.is_normalized("NFC", text):
        return [w for x in _WORD.findall(text) if (w := _fold(x))]
    return [w for w, _, _ in _folded(text)]


_BASE_OF_HASH = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Stream:
    """A stream of letters with the hash of any part of it in constant time."""

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = len(codes)
        with np.errstate(over="ignore"):
            codes = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            codes ^= codes >> np.uint64(32)
            power = np.full(n, _BASE_OF_HASH)
            power[:1] = 1
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes * np.cumprod(power), out=self.sums[1:])
            back = np.full(n + 1, _INVERSE)
            back[:1] = 1
            self.back = np.cumprod(back)

    def hashes(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of the ``size`` letters from each place on."""
        with np.errstate(over="ignore"):
            h = (self.sums[at + size] - self.sums[at]) * self.back[at]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(32))


def gram_hash(text: str) -> int:
    return int(Stream(text).hashes(np.array([0]), len(text))[0].astype(np.int64))


def _grams(text: str, spaceless: bool, words: int, chars: int) -> list[str]:
    parts = _words(text)
    if spaceless:
        stream = "".join(parts)
        return [stream[i : i + chars] for i in range(len(stream) - chars + 1)]
    return ["".join(parts[i : i + words]) for i in range(len(parts) - words + 1)]


def item_grams(items: DataFrame, words: int, chars: int) -> DataFrame:
    """(item_id, gram, free, head, key): every n-gram of every item with the hashes of its first letters and of all; free ones may stand within a word."""
    size = min(words, chars)
    rows = items.where("item_id is not null and text is not null").select("item_id", "lang", "text").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, lang, text in zip(pdf["item_id"], pdf["lang"], pdf["text"]):
                free = str(lang or "").strip().lower()[:2] in _SPACELESS
                found = list(dict.fromkeys(_grams(text, free, words, chars)))
                if found:
                    yield pd.DataFrame({"item_id": i, "gram": found, "free": free, "head": [gram_hash(g[:size]) for g in found], "key": [gram_hash(g) for g in found]})

    return cut(spread(rows).mapInPandas(run, "item_id bigint, gram string, free boolean, head bigint, key bigint"))


class Grams:
    """The hashes of a block of n-grams in the order of their first letters' hashes."""

    def __init__(self, heads: np.ndarray, keys: np.ndarray, sizes: np.ndarray, free: np.ndarray) -> None:
        order = np.argsort(heads)
        self.heads, self.keys, self.sizes, self.free = heads[order], keys[order], sizes[order], free[order]

    def scan(self, text: str, size: int) -> list[tuple[int, str, int, int]]:
        """(hash, letters, start, end) of each window of the text that agrees with an n-gram."""
        parts = _words(text)
        letters = "".join(parts)
        if len(letters) < size:
            return []
        stream = Stream(letters)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        begins = ends - lengths
        anywhere = bool(self.free.any()) and not letters.isascii()
        at = np.arange(len(letters) - size + 1) if anywhere else begins[begins <= len(letters) - size]
        heads = stream.hashes(at, size)
        low = np.searchsorted(self.heads, heads)
        hit = self.heads[np.minimum(low, len(self.heads) - 1)] == heads
        at, low, heads = at[hit], low[hit], heads[hit]
        if not len(at):
            return []
        # every n-gram with these first letters
        many = np.searchsorted(self.heads, heads, "right") - low
        place, gram = np.repeat(at, many), np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        sizes = self.sizes[gram].astype(np.int64)
        fits = place + sizes <= len(letters)
        fits &= self.free[gram] | (np.isin(place, begins) & np.isin(place + sizes, ends))
        place, gram, sizes = place[fits], gram[fits], sizes[fits]
        same = stream.hashes(place, sizes) == self.keys[gram]
        if not same.any():
            return []
        where: list[int] = []
        for w, s, e in _folded(text):
            where.extend(range(s, s + len(w)) if len(w) == e - s else [s + (j * (e - s)) // len(w) for j in range(len(w))])
        return [(int(np.int64(k)), letters[p : p + n], where[p], where[p + n - 1] + 1) for p, n, k in zip(place[same].tolist(), sizes[same].tolist(), self.keys[gram[same]].astype(np.int64).tolist())]


def leaked_spans(documents: DataFrame, items: DataFrame, words: int = 15, chars: int = 30, gram_block: int = GRAM_BLOCK) -> DataFrame:
    """(doc_id, item_id, start_pos, end_pos): every verified n-gram of an item in a document."""
    spark = documents.sparkSession
    size = min(words, chars)
    grams = item_grams(items, words, chars)
    blocks = -(-grams.select("key").distinct().count() // gram_block)
    schema = "doc_id bigint, key bigint, gram string, start_pos int, end_pos int"
    docs = spread(documents.where("doc_id is not null and text is not null").select("doc_id", "text"))
    windows: DataFrame | None = None
    for b in range(blocks):
        mine = grams.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).groupBy("head", "key", F.length("gram").alias("size")).agg(F.max("free").alias("free")).toArrow()  # at most about gram_block rows
        column = lambda c, mine=mine: mine.column(c).to_numpy()
        shared = spark.sparkContext.broadcast((column("head").astype(np.int64).view(np.uint64), column("key").astype(np.int64).view(np.uint64), column("size").astype(np.uint16), column("free").astype(bool)))
        token = uuid.uuid4().hex

        def scan(batches: Iterator[pd.DataFrame], shared=shared, token=token) -> Iterator[pd.DataFrame]:
            block = once(token, lambda: Grams(*shared.value))
            for pdf in batches:
                rows = [(d, *c) for d, t in zip(pdf["doc_id"], pdf["text"]) for c in block.scan(t, size)]
                yield pd.DataFrame(rows, columns=["doc_id", "key", "gram", "start_pos", "end_pos"])

        if mine.num_rows:
            part = docs.mapInPandas(scan, schema)
            windows = part if windows is None else windows.unionByName(part)
    if windows is None:
        return spark.createDataFrame([], "doc_id bigint, item_id bigint, start_pos int, end_pos int")
    return windows.join(grams.select("item_id", "key", "gram"), ["key", "gram"]).select("doc_id", "item_id", "start_pos", "end_pos").distinct()


def leaks(documents: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id) of the documents that carry a passage of an item."""
    return leaked_spans(documents, items, **how).select("doc_id", "item_id").distinct()


def _union(spans: Column) -> Column:
    """Spans in order -> disjoint ones, joined where they meet; a document's spans are bounded by its own text."""
    return F.aggregate(
        spans,
        F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start_pos"] <= F.element_at(acc, -1)["e"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["end_pos"]).alias("e")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start_pos"].alias("s"), x["end_pos"].alias("e"))))),
    )


def leak_report(documents: DataFrame, items: DataFrame, **how) -> DataFrame:
    """For every test item: in how many documents it leaked and how many characters there."""
    each = leaked_spans(documents, items, **how).groupBy("item_id", "doc_id").agg(F.array_sort(F.collect_set(F.struct("start_pos", "end_pos"))).alias("spans"))
    chars = F.aggregate(_union(F.col("spans")), F.lit(0).cast("bigint"), lambda a, x: a + x["e"] - x["s"])
    per = each.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.sum(chars).alias("leaked_chars"))
    return items.select("item_id", "suite").distinct().join(per, "item_id", "left").select("item_id", "suite", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("leaked_chars", F.lit(0)).alias("leaked_chars"))


def decontaminated(documents: DataFrame, items: DataFrame, drop_share: float = 0.5, **how) -> DataFrame:
    """documents without the leaked spans: (doc_id, text, action, removed_chars).

    action is 'keep', 'cut' (spans removed) or 'drop' (text null) where at least
    drop_share of the text leaked.  Every document comes out once.
    """
    spans = leaked_spans(documents, items, **how).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start_pos", "end_pos"))).alias("spans"))
    joined = documents.select("doc_id", "text").distinct().join(spans, "doc_id", "left")

    kept = F.aggregate(
        "merged",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc["text"], F.substring("text", acc["at"] + 1, x["s"] - acc["at"])).alias("text"), x["e"].alias("at")),
        lambda acc: F.concat(acc["text"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    sized = joined.withColumn("merged", _union(F.col("spans"))).withColumn("removed_chars", F.coalesce(F.aggregate("merged", F.lit(0), lambda a, x: a + x["e"] - x["s"]), F.lit(0)))
    share = F.col("removed_chars") / F.length("text")
    action = F.when(F.col("removed_chars") == 0, "keep").when(share >= drop_share, "drop").otherwise("cut")
    return sized.withColumn("action", action).select("doc_id", F.when(F.col("action") == "keep", F.col("text")).when(F.col("action") == "cut", kept).alias("text"), "action", "removed_chars")
