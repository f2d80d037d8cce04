"""Blocks and chunks of documents.

A document is split and packed within its own row (one Python pass, no shuffle):
the packing is a fold over the document's blocks, which no window expresses.
Tables of any length stay whole; other blocks are cut at the token limit.
Null and blank texts have no blocks; repeated rows count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from claimspark.functions.columns import token_count
from claimspark.runtime import spread

MAX_TOKENS, OVERLAP = 1_800, 150
TABLES = frozenset({"table", "document_index"})
_TOKEN = re.compile(r"\w+|[^\w\s]")
_HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*#*\s*$")
_RULER = re.compile(r"^\s*\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)*\|?\s*$")
_ITEM = re.compile(r"(?:[-*+] |\d+[.)]\s)")


def blocks_of(text: str | None) -> list[tuple[str, int, str, tuple[str, ...]]]:
    """(label, level, text, heading path) of a Markdown text in order.

    The heading path is a stack by position: a heading of level n replaces
    everything from place n - 1 on, and is appended where the stack is shorter.
    """
    out: list[tuple[str, int, str, tuple[str, ...]]] = []
    path: list[str] = []
    held: list[str] = []
    fence = ""

    def close(label: str = "") -> None:
        body = "\n".join(held).strip("\n")
        held.clear()
        if body.strip():
            out.append((label or label_of(body), 0, body, tuple(path)))

    for line in (text or "").splitlines():
        opening = line.lstrip()[:3]
        if fence:
            held.append(line)
            if opening == fence:
                fence = ""
                close("code")
        elif opening in ("```", "~~~"):
            close()
            held.append(line)
            fence = opening
        elif m := _HEADING.match(line):
            close()
            level = len(m.group(1))
            del path[level - 1 :]
            path.append(m.group(2).strip())
            out.append(("section_header", level, path[-1], tuple(path)))
        elif line.strip():
            held.append(line)
        else:
            close()
    close("code" if fence else "")
    return out


def label_of(body: str) -> str:
    lines = body.splitlines()
    if len(lines) > 1 and _RULER.match(lines[1]):
        return "table"
    return "list_item" if _ITEM.match(lines[0].lstrip()) else "text"


def tokens_in(text: str) -> int:
    return sum(1 for _ in _TOKEN.finditer(text))


def cut_block(text: str, limit: int) -> list[str]:
    """A text in parts of at most limit tokens, cut before a token."""
    starts = [m.start() for m in _TOKEN.finditer(text)]
    if len(starts) <= limit:
        return [text]
    edges = [0, *starts[limit::limit], len(text)]
    return [part for a, b in zip(edges, edges[1:]) if (part := text[a:b].strip())]


def tail(parts: list[str], budget: int) -> str:
    """The last ``budget`` tokens of the parts."""
    joined = "\n\n".join(parts)
    starts = [m.start() for m in _TOKEN.finditer(joined)]
    if budget <= 0 or not starts:
        return ""
    return joined[starts[max(0, len(starts) - budget)] :].strip()


def pack(blocks: list[tuple], limit: int = MAX_TOKENS, overlap: int = OVERLAP, with_pages: bool = False) -> list[tuple]:
    """(text, heading path, labels), and with_pages the pages, of the chunks; chunks never cross a change of heading.

    A block is (label, level, text, heading path) and may end with its pages.
    """
    chunks: list[tuple] = []
    held: list[tuple[str, str, tuple[int, ...]]] = []
    size = 0
    where: tuple[str, ...] | None = None

    def emit(parts: list[tuple[str, str, tuple[int, ...]]]) -> None:
        made = ("\n\n".join(t for _, t, _ in parts).strip(), where or (), list(dict.fromkeys(label for label, _, _ in parts)))
        chunks.append((*made, tuple(sorted({n for _, _, p in parts for n in p}))) if with_pages else made)

    for label, _, text, path, *more in blocks:
        pages = more[0] if more else ()
        if path != where:
            if held:
                emit(held)
            held, size, where = [], 0, path
        whole = label in TABLES
        for part in [text] if whole else cut_block(text, limit):
            n = tokens_in(part)
            if held and size + n > limit:
                emit(held)
                rest = tail([t for _, t, _ in held], min(overlap, max(0, limit - n)))
                held = [("overlap", rest, held[-1][2])] if rest else []
                size = tokens_in(rest)
            if whole and n > limit:
                emit([(label, part, pages)])
                held, size = [], 0
                continue
            held.append((label, part, pages))
            size += n
    if held:
        emit(held)
    return chunks


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    return spread(df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), "source_id", F.col(text).alias("text")).distinct())


def document_blocks(df: DataFrame, key: str = "conversion_id", text: str = "markdown") -> DataFrame:
    """(key, source_id, block_no, label, level, text, heading_path)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, s, i + 1, *b[:3], list(b[3])) for k, s, t in zip(pdf["key"], pdf["source_id"], pdf["text"]) for i, b in enumerate(blocks_of(t))]
            yield pd.DataFrame(rows, columns=["key", "source_id", "block_no", "label", "level", "text", "heading_path"])

    return _texts(df, key, text).mapInPandas(run, "key string, source_id string, block_no int, label string, level int, text string, heading_path array<string>").withColumnRenamed("key", key)


def chunk_documents(df: DataFrame, key: str = "conversion_id", text: str = "markdown", max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP, chunker=None) -> DataFrame:
    """Chunks of every document; chunker(text) -> [(text, heading path, labels)] replaces the layout chunker."""
    if max_tokens < 1 or not 0 <= overlap < max_tokens:
        raise ValueError("max_tokens must be positive and overlap below it")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, s, t in zip(pdf["key"], pdf["source_id"], pdf["text"]):
                found = chunker(t) if chunker else pack(blocks_of(t), max_tokens, overlap)
                rows.extend((k, s, i + 1, body, list(path), list(labels)) for i, (body, path, labels) in enumerate(found))
            yield pd.DataFrame(rows, columns=["key", "source_id", "ordinal", "text", "heading_path", "labels"])

    made = _texts(df, key, text).mapInPandas(run, "key string, source_id string, ordinal int, text string, heading_path array<string>, labels array<string>")
    return made.select(
        F.format_string("%s:chunk:%06d", "key", "ordinal").alias("chunk_id"), F.col("key").alias(key), "source_id", "ordinal", "text", "heading_path", "labels", token_count("text").alias("token_count"), F.sha2("text", 256).alias("content_sha256")
    )


def heading_groups(blocks: DataFrame, key: str = "conversion_id") -> DataFrame:
    """Runs of blocks under one heading path (gaps and islands): (key, group_no, heading_path, n_blocks)."""
    w = W.partitionBy(key).orderBy("block_no")
    path = F.concat_ws("\u0001", "heading_path")
    changed = blocks.withColumn("new", F.when(F.lag(path).over(w).eqNullSafe(path), 0).otherwise(1))
    return changed.withColumn("group_no", F.sum("new").over(w)).groupBy(key, "group_no").agg(F.first("heading_path").alias("heading_path"), F.count("*").alias("n_blocks"))


def checked_counts(chunks: DataFrame) -> DataFrame:
    """(chunk_id, token_count, tokens, stale_count, stale_hash) of distinct chunk rows."""
    rows = chunks.select("chunk_id", "text", "token_count", "content_sha256").distinct()
    n = token_count("text")
    return rows.select("chunk_id", "token_count", n.alias("tokens"), (~F.col("token_count").eqNullSafe(n)).alias("stale_count"), (~F.col("content_sha256").eqNullSafe(F.sha2("text", 256))).alias("stale_hash"))


def split_sizes(chunks: DataFrame, limit: int = MAX_TOKENS) -> DataFrame:
    """(chunk_id, piece_no, tokens): how a text is cut into runs of ``limit`` tokens."""
    n = chunks.where("chunk_id is not null and text is not null").select("chunk_id", "text").distinct().select("chunk_id", token_count("text").alias("n"))
    pieces = F.greatest(F.ceil(F.col("n") / limit), F.lit(1))
    return n.select("chunk_id", "n", F.explode(F.sequence(F.lit(1).cast("bigint"), pieces.cast("bigint"))).alias("piece_no")).select("chunk_id", F.col("piece_no").cast("int").alias("piece_no"), F.least(F.lit(limit), F.col("n") - (F.col("piece_no") - 1) * limit).cast("int").alias("tokens"))


def profiles(chunks: DataFrame) -> DataFrame:
    """(source_id, n_chunks, n_headings, first_page, last_page) of every source."""
    rows = chunks.where("source_id is not null").select("source_id", "chunk_id", "heading_path", "page_start", "page_end").distinct()
    pages = F.array_compact(F.array("page_start", "page_end"))
    return rows.groupBy("source_id").agg(F.count("*").alias("n_chunks"), F.sum(F.coalesce(F.size("heading_path"), F.lit(0))).alias("n_headings"), F.min(F.array_min(pages)).alias("first_page"), F.max(F.array_max(pages)).alias("last_page"))


def heading_counts(chunks: DataFrame) -> DataFrame:
    """(source_id, heading, n) over the heading paths of distinct chunk rows."""
    rows = chunks.where("source_id is not null").select("source_id", "chunk_id", "heading_path").distinct()
    return rows.select("source_id", F.explode("heading_path").alias("heading")).groupBy("source_id", "heading").agg(F.count("*").alias("n"))


def foreign(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_id, n_chunks) of chunks whose source isn't known."""
    rows = chunks.where("source_id is not null").select("source_id", "chunk_id").distinct()
    return rows.join(sources.select("source_id").distinct(), "source_id", "left_anti").groupBy("source_id").agg(F.count("*").alias("n_chunks"))


def merged_metadata(chunks: DataFrame) -> DataFrame:
    """(source_id, key, found): the distinct values of each metadata key of a source in order of their first chunk."""
    each = chunks.where("source_id is not null and metadata is not null").select("source_id", "ordinal", "chunk_id", F.explode("metadata").alias("key", "value")).where("value is not null")
    first = each.groupBy("source_id", "key", "value").agg(F.min(F.struct("ordinal", "chunk_id")).alias("at"))
    return first.groupBy("source_id", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("found"))
