"""Canonical layout documents: JSON with texts, tables and pictures in body order.

A document is one row; its JSON is walked within the row (one Python pass, no
shuffle) and comes out as blocks with headings and pages, which the same packing
as for Markdown turns into chunks.

Defined results: null and blank JSON has no blocks; JSON that can't be read is
reported in ``error``; a reference is followed once; without a body the
collections are read in their order; page 0 is page 1, negative pages are none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions.columns import token_count
from claimspark.operators.chunking import MAX_TOKENS, OVERLAP, blocks_of, pack
from claimspark.runtime import spread

COLLECTIONS = ("texts", "tables", "pictures", "key_value_items", "form_items")
HEADINGS = ("section_header", "title")
DEEPEST = 6


def at_pointer(document: dict, pointer: str):
    """What a JSON pointer ("#/texts/0") names, or None."""
    here = document
    for step in pointer.lstrip("#").strip("/").split("/"):
        step = step.replace("~1", "/").replace("~0", "~")
        if isinstance(here, list) and step.isdigit() and int(step) < len(here):
            here = here[int(step)]
        elif isinstance(here, dict) and step in here:
            here = here[step]
        else:
            return None
    return here


def ordered_items(document: dict) -> list[tuple[dict, int]]:
    """(item, depth) in reading order."""
    out: list[tuple[dict, int]] = []
    seen: set[str] = set()
    todo = [(c, 0) for c in reversed((document.get("body") or {}).get("children") or [])]
    while todo:
        child, depth = todo.pop()
        ref = child.get("$ref") if isinstance(child, dict) else None
        if ref is None or ref in seen:
            continue
        seen.add(ref)
        item = at_pointer(document, ref)
        if isinstance(item, dict):
            if any(ref.startswith(f"#/{c}/") for c in COLLECTIONS):
                out.append((item, depth))
            todo.extend((c, depth + 1) for c in reversed(item.get("children") or []))
    return out or [(item, 0) for c in COLLECTIONS for item in document.get(c) or [] if isinstance(item, dict)]


def table_grid(item: dict) -> list[list[str]]:
    data = item.get("data") or {}
    shown = lambda cell: str(cell.get("text") or "") if isinstance(cell, dict) else str(cell or "")
    if data.get("grid"):
        return [[shown(c) for c in row] for row in data["grid"]]
    cells: dict[tuple[int, int], str] = {}
    for c in data.get("table_cells") or []:
        cells.setdefault((int(c.get("start_row_offset_idx") or 0), int(c.get("start_col_offset_idx") or 0)), shown(c))
    if not cells:
        return []
    wide = 1 + max(k for _, k in cells)
    return [[cells.get((r, k), "") for k in range(wide)] for r in range(1 + max(r for r, _ in cells))]


def pipe_table(grid: list[list[str]]) -> str:
    """A grid as a Markdown table: rows padded to one width, a ruler after the first."""
    wide = max((len(r) for r in grid), default=0)
    if not wide:
        return ""
    rows = ["| " + " | ".join(" ".join(c.split()).replace("|", "\\|") for c in [*r, *[""] * (wide - len(r))]) + " |" for r in grid]
    return "\n".join([rows[0], "|" + " --- |" * wide, *rows[1:]])


def item_text(document: dict, item: dict) -> str:
    body = next((str(item[k]).strip() for k in ("text", "orig", "content") if str(item.get(k) or "").strip()), "")
    if item.get("data") is not None and not body:
        body = pipe_table(table_grid(item))
    captions = [at_pointer(document, c["$ref"]) if isinstance(c, dict) and "$ref" in c else c for c in item.get("captions") or []]
    lines = [str(c.get("text") or "").strip() if isinstance(c, dict) else str(c or "").strip() for c in captions]
    return "\n\n".join([x for x in lines if x] + ([body] if body else []))


def item_pages(item: dict) -> tuple[int, ...]:
    pages = [p.get("page_no", p.get("page")) for p in item.get("prov") or [] if isinstance(p, dict)]
    return tuple(sorted({max(1, int(p)) for p in pages if isinstance(p, (int, float)) and not isinstance(p, bool) and p >= 0}))


def canonical_blocks(document: dict) -> list[tuple[str, int, str, tuple[str, ...], tuple[int, ...]]]:
    """(label, level, text, heading path, pages) of a canonical document; the heading path is a stack by position."""
    out, path = [], []
    for item, depth in ordered_items(document):
        text = item_text(document, item)
        if not text:
            continue
        label = str(item.get("label") or "text")
        level = 0
        if label in HEADINGS:
            given = item.get("level")
            level = min(DEEPEST, max(1, int(given) if isinstance(given, (int, float)) else depth + 1))
            del path[level - 1 :]
            path.append(text)
        out.append((label, level, text, tuple(path), item_pages(item)))
    return out


def canonical_document(markdown: str | None, name: str = "") -> dict:
    """Markdown as a canonical document with the same blocks in the same order."""
    document: dict = {"schema_name": "layout", "name": name, "body": {"children": []}, "texts": [], "tables": []}
    for label, level, text, _ in blocks_of(markdown):
        kind = "tables" if label == "table" else "texts"
        document["body"]["children"].append({"$ref": f"#/{kind}/{len(document[kind])}"})
        if kind == "tables":
            rows = [[c.replace("\x00", "|").strip() for c in r.strip().strip("|").replace("\\|", "\x00").split("|")] for k, r in enumerate(text.splitlines()) if k != 1]
            document[kind].append({"label": label, "data": {"grid": [[{"text": c} for c in r] for r in rows]}})
        else:
            document[kind].append({"label": label, "text": text} | ({"level": level} if level else {}))
    return document


def stamped(document: dict, **identity: str) -> dict:
    """The document with its identity; one that another program wrote stays as it is."""
    return document | {"identity": dict(sorted(identity.items()))} if document.get("schema_name") == "layout" else document


def canonical_documents(df: DataFrame, key: str = "conversion_id", text: str = "markdown") -> DataFrame:
    """(key, source_id, canonical): every Markdown text as canonical JSON."""
    rows = spread(df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), "source_id", F.col(text).alias("text")).distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [json.dumps(stamped(canonical_document(t, k), key=k, source_id=s or ""), ensure_ascii=False, sort_keys=True) for k, s, t in zip(pdf["key"], pdf["source_id"], pdf["text"])]
            yield pd.DataFrame({"key": pdf["key"], "source_id": pdf["source_id"], "canonical": made})

    return rows.mapInPandas(run, "key string, source_id string, canonical string").withColumnRenamed("key", key)


def _read(raw: str | None) -> tuple[dict | None, str | None]:
    if raw is None or not raw.strip():
        return None, None
    try:
        document = json.loads(raw)
    except ValueError as e:
        return None, f"not JSON: {e}"
    return (document, None) if isinstance(document, dict) else (None, "not an object")


def layout_blocks(documents: DataFrame, key: str = "conversion_id") -> DataFrame:
    """(key, source_id, block_no, label, level, text, heading_path, page_start, page_end, error) of canonical documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, s, raw in zip(pdf["key"], pdf["source_id"], pdf["canonical"]):
                document, error = _read(raw)
                if error:
                    rows.append((k, s, 0, None, None, None, None, None, None, error))
                for i, (label, level, text, path, pages) in enumerate(canonical_blocks(document or {}), 1):
                    rows.append((k, s, i, label, level, text, list(path), min(pages, default=None), max(pages, default=None), None))
            out = pd.DataFrame(rows, columns=["key", "source_id", "block_no", "label", "level", "text", "heading_path", "page_start", "page_end", "error"])
            yield out.astype({c: "Int32" for c in ("block_no", "level", "page_start", "page_end")})

    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), "source_id", "canonical").distinct()
    return spread(rows).mapInPandas(run, "key string, source_id string, block_no int, label string, level int, text string, heading_path array<string>, page_start int, page_end int, error string").withColumnRenamed("key", key)


def chunk_layout(documents: DataFrame, key: str = "conversion_id", max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of canonical documents with the pages of their blocks."""
    if max_tokens < 1 or not 0 <= overlap < max_tokens:
        raise ValueError("max_tokens must be positive and overlap below it")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, s, raw in zip(pdf["key"], pdf["source_id"], pdf["canonical"]):
                document, _ = _read(raw)
                for i, (text, path, labels, pages) in enumerate(pack(canonical_blocks(document or {}), max_tokens, overlap, with_pages=True), 1):
                    rows.append((k, s, i, text, list(path), labels, min(pages, default=None), max(pages, default=None)))
            out = pd.DataFrame(rows, columns=["key", "source_id", "ordinal", "text", "heading_path", "labels", "page_start", "page_end"])
            yield out.astype({c: "Int32" for c in ("ordinal", "page_start", "page_end")})

    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), "source_id", "canonical").distinct()
    made = spread(rows).mapInPandas(run, "key string, source_id string, ordinal int, text string, heading_path array<string>, labels array<string>, page_start int, page_end int")
    return made.select(F.format_string("%s:chunk:%06d", "key", "ordinal").alias("chunk_id"), F.col("key").alias(key), "source_id", "ordinal", "text", "heading_path", "labels", "page_start", "page_end", token_count("text").alias("token_count"), F.sha2("text", 256).alias("content_sha256"))
