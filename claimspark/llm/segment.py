"""Splitting oversized items at natural boundaries.

Method: lexical-cohesion segmentation.  At every natural boundary the
similarity of the word blocks before and after it is computed; valleys of this
curve mark changes of topic.  From the start of each piece the deepest valley
within its size window is cut, paragraph ends before sentence ends before line
ends before word gaps; then each later piece is extended to the left by the
overlap.

A piece is an exact substring of the text: the pieces without their overlaps
put together give the text again, from its first token to its last.  Cost is
linear in the text, whose length isn't limited: the blocks slide over it once for
each kind of boundary.

Defined results: a text of at most ``max_tokens`` tokens comes out whole as
piece 1 of 1 with the right token count; null and empty text too (0 tokens);
exact duplicate rows give one set of pieces; a run without any natural boundary
is cut between two tokens; null heading paths and metadata stay null.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.runtime import spread

MAX_TOKENS, OVERLAP = 1_800, 150
#: Tokens of the blocks compared on either side of a boundary.
BLOCK = 120
_TOKEN = re.compile(r"\w+|[^\w\s]")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*|\n(?=#{1,6} |=+ |\\(?:sub)*section)")
_SENTENCE = re.compile(r"[.!?।؟](?:[\"'”’»)\]]*)\s+|[。！？](?:[」』”）]*)\s*")
_LINE = re.compile(r"\n\s*")


def _boundaries(text: str, starts: list[int]) -> dict[int, int]:
    """Token index of the first token after a natural boundary -> its rank (0 paragraph, 1 sentence, 2 line)."""
    found: dict[int, int] = {}
    for rank, pattern in ((2, _LINE), (1, _SENTENCE), (0, _PARAGRAPH)):
        for m in pattern.finditer(text):
            i = bisect.bisect_left(starts, m.end())
            if 0 < i < len(starts):
                found[i] = rank
    return found


def _cohesion(words: list[str], cuts: list[int], block: int) -> list[float]:
    """Cosine of the word counts of the ``block`` tokens before and after each cut.

    The two blocks slide over the text once, whatever the number of cuts: a word
    that enters or leaves changes the product and the norms by its own counts.
    """
    left, right = Counter(), Counter(words[:block])
    dot, norm_l, norm_r = 0, 0, sum(n * n for n in right.values())
    out: list[float] = []
    at = 0
    for c in cuts:
        while at < c:
            w = words[at]
            # w goes from the right block to the left one
            dot -= left[w]
            norm_r -= 2 * right[w] - 1
            right[w] -= 1
            if at + block < len(words):
                new = words[at + block]
                dot += left[new]
                norm_r += 2 * right[new] + 1
                right[new] += 1
            dot += right[w]
            norm_l += 2 * left[w] + 1
            left[w] += 1
            if at >= block:
                old = words[at - block]
                dot -= right[old]
                norm_l -= 2 * left[old] - 1
                left[old] -= 1
                if not left[old]:
                    del left[old]
            if not right[w]:
                del right[w]
            at += 1
        norm = math.sqrt(norm_l * norm_r)
        out.append(dot / norm if norm else 0.0)
    return out


def _depths(words: list[str], cuts: list[int], block: int) -> list[float]:
    """Depth of each boundary's valley: how far the similarity rises to the peaks on both sides.

    A peak ends a stretch in which the similarity doesn't fall, so it is that of
    the neighbour where the neighbour is as high, else the boundary's own.
    """
    s = _cohesion(words, cuts, block)
    rise_l, rise_r = list(s), list(s)
    for i in range(1, len(s)):
        if s[i - 1] >= s[i]:
            rise_l[i] = rise_l[i - 1]
    for i in range(len(s) - 2, -1, -1):
        if s[i + 1] >= s[i]:
            rise_r[i] = rise_r[i + 1]
    return [a + b - 2 * x for a, b, x in zip(rise_l, rise_r, s)]


def split_text(text: str | None, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, block: int = BLOCK) -> list[tuple[int, int, int, int, str]]:
    """(start, end, tokens, overlapping tokens, boundary at the end) of each piece, in code points."""
    if text is None or text == "":
        return [(0, 0, 0, 0, "end")]
    spans = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    n = len(spans)
    if n <= max_tokens:
        return [(0, len(text), n, 0, "end")]
    starts = [s for s, _ in spans]
    words = [text[s:e].lower() for s, e in spans]
    ranks = _boundaries(text, starts)
    by_rank = {r: sorted(i for i, x in ranks.items() if x == r) for r in (0, 1, 2)}
    depth: dict[int, float] = {}
    for cuts in by_rank.values():
        depth.update(zip(cuts, _depths(words, cuts, block)))
    gaps = [i for i in range(1, n) if spans[i - 1][1] < spans[i][0]]
    out: list[tuple[int, int, int, int, str]] = []
    begin = 0  # first token of the piece's new content
    names = {0: "paragraph", 1: "sentence", 2: "line"}
    while True:
        over = min(overlap, begin) if begin else 0
        room = max_tokens - over
        first = spans[begin - over][0] if begin else 0
        if n - begin <= room:
            out.append((first, len(text), n - begin + over, over, "end"))
            return out
        low, high = begin + room // 2, begin + room
        cut, name = 0, ""
        for r in (0, 1, 2):
            cuts = by_rank[r]
            window = cuts[bisect.bisect_left(cuts, low) : bisect.bisect_right(cuts, high)]
            if window:
                # the deepest valley; among equals the one that leaves the fewest pieces
                cut, name = max(window, key=lambda i: (round(depth[i], 9), i)), names[r]
                break
        if not cut:
            k = bisect.bisect_right(gaps, high) - 1
            cut, name = (gaps[k], "word") if k >= 0 and gaps[k] > begin else (high, "token")
        out.append((first, spans[cut - 1][1], cut - begin + over, over, name))
        begin = cut


_COLUMNS = ("chunk_id", "source_id", "ordinal", "text", "heading_path", "page_start", "page_end", "metadata")
#: The tokens of TOKEN for the JVM: Python's white space is wider than that of Java's patterns.
_JVM_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
_PIECE = "piece_no int, n_pieces int, token_count int, overlap_tokens int, boundary string, start_pos int, end_pos int"


def split_chunks(chunks: DataFrame, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> DataFrame:
    """All chunks with text of at most max_tokens tokens, oversized ones as pieces with an overlap.

    Tokens are counted in the JVM; only oversized texts go to Python, once, and
    come back as their pieces.
    """
    if not 0 <= overlap < max_tokens:
        raise ValueError("overlap must be at least 0 and below max_tokens")
    # maps can't be compared, so repeated rows are found by the entries in key order
    rows = chunks.select(*_COLUMNS).withColumn("metadata", F.array_sort(F.map_entries("metadata")))
    tokens = F.coalesce(F.regexp_count("text", F.lit(_JVM_TOKEN)), F.lit(0))
    # a text of no more characters than tokens are allowed isn't counted to find the oversized ones
    oversized = F.coalesce(F.length("text") > max_tokens, F.lit(False)) & (tokens > max_tokens)
    kept = ["chunk_id", "source_id", "ordinal", "heading_path", "page_start", "page_end", "metadata"]
    large = spread(rows.where(oversized).distinct())
    schema = T.StructType([f for f in large.schema.fields if f.name in kept] + [T.StructField("text", T.StringType())] + T._parse_datatype_string(_PIECE).fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                found = split_text(r["text"], max_tokens, overlap)
                rows += [{k: r[k] for k in kept} | {"text": r["text"][s:e], "piece_no": i, "n_pieces": len(found), "token_count": n, "overlap_tokens": o, "boundary": b, "start_pos": s, "end_pos": e} for i, (s, e, n, o, b) in enumerate(found, 1)]
            out = pd.DataFrame(rows, columns=schema.names)
            yield out.astype({c: "Int32" for c in ("ordinal", "page_start", "page_end")})

    cut = large.mapInPandas(run, schema)
    one = F.lit(1)
    whole = rows.where(~oversized).distinct().select(*kept, "text", one.alias("piece_no"), one.alias("n_pieces"), tokens.alias("token_count"), F.lit(0).alias("overlap_tokens"), F.lit("end").alias("boundary"), F.lit(0).alias("start_pos"), F.coalesce(F.length("text"), F.lit(0)).alias("end_pos"))
    return (
        cut.unionByName(whole)
        .withColumn("metadata", F.map_from_entries("metadata"))
        .select("chunk_id", "source_id", "ordinal", "piece_no", "n_pieces", "text", "heading_path", "page_start", "page_end", "token_count", "overlap_tokens", "boundary", "start_pos", "end_pos", F.sha2("text", 256).alias("content_sha256"), "metadata")
    )
