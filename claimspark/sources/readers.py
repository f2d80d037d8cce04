"""Readers: files to sources, texts and chunks."""

from __future__ import annotations

import codecs
import hashlib
import io
import json
import mimetypes
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import unquote, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions.columns import token_count
from claimspark.functions.text import slug_udf

# Extension -> (backend, media type).
ROUTES = {
    "pdf": ("docling", "application/pdf"), "html": ("docling", "text/html"), "htm": ("docling", "text/html"), "docx": ("docling", "application/vnd.openxmlformats-officedocument.wordprocessingml.document"),
    "epub": ("ebooklib", "application/epub+zip"), "md": ("pass_through", "text/markdown"), "markdown": ("pass_through", "text/markdown"), "txt": ("pass_through", "text/plain"), "text": ("pass_through", "text/plain"),
}

CHUNK_SCHEMA = "chunk_id string, source_id string, ordinal int, text string, heading_path array<string>, page_start int, page_end int, token_count int, content_sha256 string, metadata map<string,string>, schema_version string"


def extension_of(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def route(path: Column | str) -> Column:
    """struct<backend, media_type> by extension; null where no converter takes it."""
    ext = extension_of(path)
    backend = F.coalesce(*[F.when(ext == e, F.struct(F.lit(b).alias("backend"), F.lit(m).alias("media_type"))) for e, (b, m) in ROUTES.items()])
    return backend


def media_type_of(path: Column | str) -> Column:
    """The routed media type, else that of the standard table of extensions, else application/octet-stream."""
    ext = F.concat(F.lit("."), extension_of(path))
    table = F.create_map(*[F.lit(x) for pair in sorted(mimetypes.types_map.items()) for x in pair])
    return F.coalesce(route(path)["media_type"], F.try_element_at(table, ext), F.lit("application/octet-stream"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, source_id, extension, backend, media_type, content_sha256, size_bytes, content) of the files under a path."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    title = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = raw.select("path", title.alias("title"), extension_of("path").alias("extension"), route("path").alias("r"), F.sha2("content", 256).alias("content_sha256"), F.col("length").alias("size_bytes"), "content")
    return rows.select("path", "title", F.concat_ws("-", slug_udf("title"), F.substring("content_sha256", 1, 12)).alias("source_id"), "extension", "r.backend", media_type_of("path").alias("media_type"), "content_sha256", "size_bytes", "content")


def decode(raw: bytes) -> str:
    """UTF-8 with or without a mark, then UTF-16, then UTF-8 with replacement characters; line ends untouched."""
    for name in ("utf-8-sig", "utf-16"):
        try:
            return codecs.decode(raw, name)
        except UnicodeError:
            continue
    return raw.decode("utf-8", errors="replace")


class _Markdown(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.lists: list[list] = []
        self.cells: list[str] | None = None
        self.rows = 0
        self.pre = False
        self.title = ""
        self.heading = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
            self.heading = tag
        elif tag in ("p", "div", "section", "article", "table"):
            self.out.append("\n\n")
            self.rows = 0
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n\n" if len(self.lists) == 1 else "")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "- "))
        elif tag == "br":
            self.out.append("\n")
        elif tag == "pre":
            self.out.append("\n\n```\n")
            self.pre = True
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append("")
        elif tag in ("b", "strong"):
            self._add("**")
        elif tag in ("i", "em"):
            self._add("*")
        elif tag == "img":
            a = dict(attrs)
            self._add(f"![{a.get('alt') or ''}]({a.get('src') or ''})")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif tag == "pre":
            self.out.append("\n```\n\n")
            self.pre = False
        elif tag == "tr" and self.cells is not None:
            self.out.append("\n| " + " | ".join(c.strip().replace("|", "\\|") for c in self.cells) + " |")
            if self.rows == 0:
                self.out.append("\n|" + "---|" * len(self.cells))
            self.rows += 1
            self.cells = None
        elif tag in ("b", "strong"):
            self._add("**")
        elif tag in ("i", "em"):
            self._add("*")
        elif re.fullmatch("h[1-6]|p|div", tag):
            self.out.append("\n\n")
            self.heading = ""

    def handle_data(self, data: str) -> None:
        if not self.skip:
            if self.heading in ("h1", "h2") and not self.title:
                self.title = data.strip()
            self._add(data if self.pre else re.sub(r"\s+", " ", data))

    def _add(self, text: str) -> None:
        if self.cells:
            self.cells[-1] += text
        else:
            self.out.append(text)


def html_to_markdown(raw: bytes | str) -> tuple[str, str]:
    """(Markdown with ATX headings, first heading) of an HTML page; scripts and styles are left out."""
    parser = _Markdown()
    parser.feed(decode(raw) if isinstance(raw, bytes) else raw)
    parser.close()
    return tidy("".join(parser.out)), parser.title


def tidy(markdown: str) -> str:
    """Lines without blanks at their ends, single empty lines between blocks, none around the text."""
    kept: list[str] = []
    for line in markdown.splitlines():
        bare = line.rstrip(" \t")
        if bare or (kept and kept[-1]):
            kept.append(bare)
    while kept and not kept[-1]:
        kept.pop()
    return "\n".join(kept).strip()


def member_path(*parts: str) -> str | None:
    """A path inside an archive, resolved part by part; None where it leaves the archive or names nothing."""
    kept: list[str] = []
    for step in "/".join(parts).replace("\\", "/").split("/"):
        if step == "..":
            if not kept:
                return None
            kept.pop()
        elif step not in ("", "."):
            kept.append(step)
    return "/".join(kept) or None


IMAGES = ("image/",)


def _book(z: zipfile.ZipFile) -> tuple[str, dict[str, tuple[str, str]], list[str]]:
    """(folder of the package, id -> (member, media type), ids in spine order, then the documents the spine leaves out)."""
    container = ElementTree.fromstring(z.read("META-INF/container.xml"))
    opf = container.find(".//{*}rootfile").get("full-path")
    package = ElementTree.fromstring(z.read(opf))
    base = posixpath.dirname(opf)
    items = {i.get("id"): (member_path(base, unquote(urlsplit(i.get("href")).path)) or "", i.get("media-type") or "") for i in package.iterfind(".//{*}manifest/{*}item")}
    order = [i.get("idref") for i in package.iterfind(".//{*}spine/{*}itemref")]
    order += [k for k, (_, kind) in items.items() if k not in order and "html" in kind]
    return base, items, list(dict.fromkeys(order))


def epub_assets(raw: bytes) -> list[tuple[str, str, bytes]]:
    """(member, asset name, content) of the images of a book; a name that is taken by other content gets a part of its hash."""
    found: list[tuple[str, str, bytes]] = []
    taken: dict[str, bytes] = {}
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        for member, kind in _book(z)[1].values():
            if not kind.startswith(IMAGES) or member not in names:
                continue
            content, name = z.read(member), posixpath.basename(member)
            if taken.get(name, content) != content:
                stem, dot, suffix = name.rpartition(".")
                name = f"{stem or suffix}-{hashlib.sha256(content).hexdigest()[:8]}{dot + suffix if stem else ''}"
            taken[name] = content
            found.append((member, name, content))
    return found


def epub_chapters(raw: bytes) -> list[tuple[str, str, str]]:
    """(href, chapter title, Markdown) in spine order, then the documents the spine leaves out; each once; images as assets/name."""
    images = {member: name for member, name, _ in epub_assets(raw)}
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        _, items, order = _book(z)
        out = []
        for k in order:
            href, kind = items.get(k, ("", ""))
            if "html" not in kind or href not in names:
                continue
            text, title = html_to_markdown(z.read(href))

            def asset(m: re.Match, href: str = href) -> str:
                at = urlsplit(m.group(2))
                member = None if at.scheme or not at.path else member_path(unquote(at.path)) if at.path.startswith("/") else member_path(posixpath.dirname(href), unquote(at.path))
                return f"![{m.group(1)}](assets/{images[member]})" if member in images else m.group()

            text = re.sub(r"!\[([^\]]*)\]\(([^()\s]*)\)", asset, text)
            if text:
                if title and not re.search(r"(?m)^#{1,6} ", text):
                    text = f"## {title}\n\n{text}"
                out.append((href, title, text))
    if not out:
        raise ValueError("the book has no text")
    return out


def epub_asset_rows(files: DataFrame) -> DataFrame:
    """(source_id, name, content, content_sha256) of the images of all books."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(s, name, content, hashlib.sha256(content).hexdigest()) for s, c in zip(pdf["source_id"], pdf["content"]) for _, name, content in epub_assets(c)]
            yield pd.DataFrame(rows, columns=["source_id", "name", "content", "content_sha256"])

    return files.where("backend = 'ebooklib'").select("source_id", "content").mapInPandas(run, "source_id string, name string, content binary, content_sha256 string").distinct()


def convert(raw: bytes, backend: str | None) -> tuple[str | None, str | None]:
    """(Markdown, error) of one file; PDF and DOCX need an injected converter."""
    try:
        if backend == "pass_through":
            return decode(raw), None
        if backend == "ebooklib":
            return "\n\n".join(t for _, _, t in epub_chapters(raw)), None
        if backend == "docling" and raw.lstrip()[:1] == b"<":
            return html_to_markdown(raw)[0], None
        return None, f"no converter for {backend}"
    except Exception as e:  # a damaged file is reported, not fatal for the others
        return None, f"{type(e).__name__}: {e}"


def convert_files(files: DataFrame, converter: Callable[[bytes, str | None], tuple[str | None, str | None]] = convert) -> DataFrame:
    """files with markdown and error in place of their content."""

    @F.pandas_udf("struct<markdown:string,error:string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for content, backend in batches:
            yield pd.DataFrame([converter(c, b) for c, b in zip(content, backend)], columns=["markdown", "error"])

    return files.withColumn("c", run("content", "backend")).select(*[c for c in files.columns if c != "content"], "c.markdown", "c.error")


def read_chunks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, rejected lines) of JSON Lines; missing hashes and token counts are computed, page 0 is page 1."""
    schema = T._parse_datatype_string(CHUNK_SCHEMA)
    schema.add("_bad", "string")
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_bad").json(path).cache()
    sound = F.col("_bad").isNull() & F.col("chunk_id").isNotNull() & F.col("source_id").isNotNull() & F.col("ordinal").isNotNull() & F.col("text").isNotNull()
    page = lambda c: F.when(F.col(c) == 0, 1).when(F.col(c) > 0, F.col(c))
    good = raw.where(sound).select(
        "chunk_id", "source_id", "ordinal", "text", F.coalesce("heading_path", F.array().cast("array<string>")).alias("heading_path"), page("page_start").alias("page_start"), F.coalesce(page("page_end"), page("page_start")).alias("page_end"),
        F.when(F.col("token_count") > 0, F.col("token_count")).otherwise(token_count("text")).alias("token_count"), F.when(F.col("content_sha256") != "", F.col("content_sha256")).otherwise(F.sha2("text", 256)).alias("content_sha256"), "metadata", "schema_version",
    )
    return good, raw.where(~F.coalesce(sound, F.lit(False)))


def coerced_chunks(rows: DataFrame, source_id: str | None = None) -> DataFrame:
    """Rows of any chunk-like table as chunks: text from text, markdown, content or body, an id from the text where there is none, the last page that of the first."""
    have = set(rows.columns)
    given = [F.col(c) for c in ("text", "markdown", "content", "body") if c in have]
    if not given:
        raise ValueError("chunks need a text, markdown, content or body")
    col = lambda c, kind: F.col(c).cast(kind) if c in have else F.lit(None).cast(kind)
    page = lambda c: F.when(col(c, "int") == 0, 1).when(col(c, "int") > 0, col(c, "int"))
    text = F.coalesce(*given)
    made = rows.select(
        F.coalesce(col("chunk_id", "string"), F.concat(F.lit("chunk-"), F.substring(F.sha2(text, 256), 1, 16))).alias("chunk_id"), F.coalesce(col("source_id", "string"), F.lit(source_id)).alias("source_id"), col("ordinal", "int").alias("ordinal"), text.alias("text"),
        F.coalesce(col("heading_path", "array<string>"), F.array().cast("array<string>")).alias("heading_path"), page("page_start").alias("page_start"), F.coalesce(page("page_end"), page("page_start")).alias("page_end"),
    )
    return made.where("text is not null").distinct()


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, problem) of the lines of JSON Lines files that aren't chunks; a file is read in order by one task."""
    wanted = ("chunk_id", "source_id", "ordinal", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["path"], pdf["content"]):
                for n, line in enumerate(content.decode("utf-8", "replace").splitlines(), 1):
                    if not line.strip():
                        continue
                    try:
                        found = json.loads(line)
                        missing = [w for w in wanted if found.get(w) in (None, "")] if isinstance(found, dict) else list(wanted)
                    except ValueError as e:
                        rows.append((file, n, f"not JSON: {e}"))
                        continue
                    if missing:
                        rows.append((file, n, "missing " + ", ".join(missing)))
            yield pd.DataFrame(rows, columns=["file", "line_no", "problem"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, line_no int, problem string")


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """(conversion_id, source_id, canonical): files as canonical documents; JSON that is one stays, everything else is converted and wrapped."""
    from claimspark.operators.layout import canonical_document

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for source, backend, ext, content in zip(pdf["source_id"], pdf["backend"], pdf["extension"], pdf["content"]):
                if ext == "json":
                    rows.append((source, source, decode(content)))
                    continue
                text, _ = convert(content, backend)
                if text is not None:
                    rows.append((source, source, json.dumps(canonical_document(text, source), ensure_ascii=False)))
            yield pd.DataFrame(rows, columns=["conversion_id", "source_id", "canonical"])

    return read_files(spark, path).select("source_id", "backend", "extension", "content").mapInPandas(run, "conversion_id string, source_id string, canonical string")
