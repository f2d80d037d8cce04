"""Markup residue in text documents.

Method: site style tree.  Every text is parsed into a small DOM: a page with
nested sections (by heading level), lists with their items, and leaves that carry
their markup (Markdown, HTML, wiki or LaTeX) and content.  The DOMs of one site
(all texts of a source, each distinct text counted once) are merged: the pages
are one root; the sequences of children with which a node occurs are its
styles; the children under one style at one place are again one node.  A node's
path (its parent's path, its parent's style, its place) is all that merging
needs, so the trees are merged by aggregation over (site, path), never by
gathering a site.

The importance of a node that m pages share:

* presentation (inner nodes): the entropy, to the base m, of its styles over
  the pages;
* content (leaves): 1 - the mean of H over its contents, where a content that
  stands on k of the pages has H = log k / log m;
* composite: (1 - g^l) of its own and g^l of its children's mean importance,
  over its l styles by their shares, from the leaves up (g = 0.9).

As few pages say little, an importance counts as 1 - c (1 - importance) with
c = log m / log (m + 1): a node of a single page is always important.  A branch
is noise if its composite importance and those of all nodes below it are under
the threshold.  Noise is removed; the rest is written as clean text in which
headings, list items, code blocks and formulas stay marked in one way ("# ",
"- ", "1. ", fences, "$").  Where the whole tree is noise the pages are copies of
each other, and nothing is removed.  The elements are those of the merged tree's
pages, with their lines and whether their branch stays; detection reports all.

Defined results: null, empty and blank texts have no nodes and come out empty;
unclosed code, comments and preformatted blocks run to the end of the text,
unclosed formulas are text; repeated rows count once; "\\r\\n" ends a line like
"\\n" without changing line numbers.
"""

from __future__ import annotations

import bisect
import hashlib
import html
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.lookalike import INVISIBLE
from claimspark.runtime import cut, spread

#: Below this importance a branch is boilerplate.
THRESHOLD = 0.2
#: What a node's own styles weigh against its children: 1 - DECAY ** styles.
DECAY = 0.9

_REGION = regex.compile(
    r"""(?msx)
    (?P<fence>^[ ]{0,3}(?P<f>`{3,}|~{3,})[^\n`]*$(?:\n.*?^[ ]{0,3}(?P=f)[`~]*[ \t\r]*$|.*\Z))
  | (?P<comment><!--.*?(?:-->|\Z) | ^[ \t]*%[^\n]*$)
  | (?P<pre>(?i:<pre\b[^<>]*>.*?(?:</pre\s*>|\Z)))
  | (?P<source>(?i:<(?P<s>syntaxhighlight|source)\b[^<>]*>.*?(?:</(?P=s)\s*>|\Z)))
  | (?P<verbatim>\\begin\{(?P<v>verbatim\*?|Verbatim|lstlisting|minted|alltt)\}.*?(?:\\end\{(?P=v)\}|\Z))
  | (?P<display>\\begin\{(?P<d>(?:equation|align|gather|multline|eqnarray|displaymath|math|flalign|alignat)\*?)\}.*?\\end\{(?P=d)\})
  | (?P<table>\\begin\{(?P<t>tabular[x*]?|array|longtable)\}.*?(?:\\end\{(?P=t)\}|\Z) | (?i:<table\b[^<>]*>.*?(?:</table\s*>|\Z)) | ^\{\|.*?(?:^\|\}|\Z) | ^[ ]{0,3}\|[^\n]*\|[ \t\r]*$)
  | (?P<mathtag>(?i:<math\b[^<>]*>.*?</math\s*>))
  | (?P<nowiki>(?i:<(?P<n>nowiki|script|style|code|tt|ref)\b[^<>]*(?:/>|>.*?</(?P=n)\s*>)))
  | (?P<template>\{\{(?:[^{}]++|\{(?!\{)|\}(?!\})|(?&template))*+\}\})
  | (?P<bracket>(?<!\\)\\\[(?:(?!\n[ \t\r]*\n).)*?\\\] | (?<!\\)\\\((?:(?!\n[ \t\r]*\n).)*?\\\))
  | (?P<escape>\\[^\w\s])
  | (?P<dollars>\$\$(?=[^$])(?:(?!\n[ \t\r]*\n).)*?(?<!\\)\$\$)
  | (?P<quotes>``(?=[^`\n]*''))
  | (?P<tick>(?P<b>`+)(?!`)(?:(?!\n[ \t\r]*\n).)+?(?<!`)(?P=b)(?!`))
  | (?P<dollar>\$(?=[^\s$])(?:(?!\n[ \t\r]*\n)[^$])*?(?<![\s\\])\$(?![\d$]))
    """
)
_CODE = {"fence", "pre", "source", "verbatim"}
_FORMULA = {"display", "mathtag", "bracket", "dollars", "dollar"}
_HIDDEN = _CODE | _FORMULA | {"comment", "table", "nowiki", "template", "tick"}

_ATX = regex.compile(r"^ {0,3}(#{1,6})[ \t]+(\S.*?)(?:[ \t]+#+)?[ \t\r]*$")
_WIKI = regex.compile(r"^(={1,6})(?!=)[ \t]*(\S.*?)[ \t]*(?<!=)\1[ \t\r]*$")
_TEX = regex.compile(r"(?<!\\)\\(part|chapter|section|subsection|subsubsection|paragraph|subparagraph)\*?(?:\[[^\]]*\])?\{((?:[^{}]|\{[^{}]*\})*)\}?")
_TAG = regex.compile(r"<h([1-6])(?:\s[^<>]*)?>(.*?)(?:</h\1\s*>|$)", regex.I)
_UNDER = regex.compile(r"^ {0,3}(={2,}|-{3,})[ \t\r]*$")
_RULE = regex.compile(r"^[ \t]*(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})\r?$")
_ITEM = regex.compile(r"^([ \t]*)([-*+]|\d{1,9}[.)])[ \t]+(\S.*)$")
_WIKI_ITEM = regex.compile(r"^([*#]{2,})[ \t]+(\S.*)$")
_TEX_ITEM = regex.compile(r"(?<!\\)\\item\b(?:\[[^\]]*\])?")
_LI = regex.compile(r"<li(?:\s[^<>]*)?>", regex.I)
_TEX_LEVEL = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
HIDE = "\x00"


def _regions(text: str) -> list[tuple[str, int, int]]:
    out = []
    for m in _REGION.finditer(text):
        kind = next(k for k in ("fence", "comment", "pre", "source", "verbatim", "display", "table", "mathtag", "nowiki", "template", "bracket", "escape", "dollars", "quotes", "tick", "dollar") if m.group(k) is not None)
        out.append((kind, m.start(), m.end()))
    return out


def _masked(text: str, regions: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, s, e in regions:
        out.append(text[at:s])
        part = text[s:e]
        if kind in _HIDDEN:
            out.append("\n".join(HIDE * len(x) for x in part.split("\n")))
        elif kind == "escape":
            out.append(HIDE * len(part))
        else:
            out.append(part)
        at = e
    out.append(text[at:])
    return "".join(out)


def _wiki_list(lines: list[str], i: int) -> bool:
    """Whether a '# ' line belongs to a wiki list: a neighbour is such a line too, in small letters."""
    near = [lines[j] for j in (i - 1, i + 1) if 0 <= j < len(lines)]
    here = _ATX.match(lines[i])
    return bool(here) and not here.group(2)[:1].isupper() and any(regex.match(r"^[#*]+[ \t]+\S", x) for x in near)


_SPACE = regex.compile(r"[^\S\n\r\t ]")


def parse(text: str) -> tuple[list[dict], list[tuple[int, str]]]:
    """(nodes in order, [(line number, element)]) of a text.

    Invisible characters are dropped and every kind of space counts as a plain
    one; neither changes a line's number.

    A node has line, kind ('heading', 'list_item', 'code', 'formula', 'table',
    'text', 'comment', 'template'), style (the markup it is written in), level
    and body.
    """
    if not text.isascii():
        text = _SPACE.sub(" ", regex.sub(INVISIBLE, "", text))
    regions = _regions(text)
    masked = _masked(text, regions)
    starts = [0]
    for i, ch in enumerate(text):
        if ch == "\n":
            starts.append(i + 1)
    line_of = lambda pos: bisect.bisect_right(starts, pos)
    found: set[tuple[int, str]] = set()
    whole: dict[int, tuple[int, str, str, str]] = {}  # first line -> (last line, kind, style, body)
    for kind, s, e in regions:
        a, b = line_of(s), line_of(max(s, e - 1))
        if kind in _CODE:
            found.add((a, "code"))
            whole[a] = (b, "code", kind, text[s:e])
        elif kind in _FORMULA:
            found.add((a, "formula"))
            alone = not text[starts[a - 1] : s].strip(" \t:") and not text[e : starts[b] if b < len(starts) else len(text)].strip()
            if alone and kind != "dollar":
                whole[a] = (b, "formula", kind, text[s:e])
        elif kind in ("table", "comment", "template"):
            alone = not text[starts[a - 1] : s].strip()
            if alone and a not in whole:
                whole[a] = (b, kind, kind, text[s:e])
    raw = text.split("\n")
    lines = masked.split("\n")
    nodes: list[dict] = []
    skip_to = 0
    previous = ""  # kind of the line before

    def node(line: int, kind: str, style: str, body: str, level: int = 0) -> None:
        nodes.append({"line": line, "kind": kind, "style": style, "level": level, "body": body})

    for i, line in enumerate(lines):
        n = i + 1
        if n <= skip_to:
            continue
        if n in whole:
            last, kind, style, body = whole[n]
            node(n, kind, style, body)
            skip_to, previous = last, kind
            continue
        bare = line.strip()
        if not bare:
            previous = ""
            continue
        if (m := _ATX.match(line)) and not _wiki_list(lines, i):
            found.add((n, "heading"))
            node(n, "heading", "markdown", _ATX.match(raw[i]).group(2) if _ATX.match(raw[i]) else raw[i], len(m.group(1)))
            previous = "heading"
        elif m := _WIKI.match(line):
            found.add((n, "heading"))
            node(n, "heading", "wiki", raw[i].strip().strip("=").strip(), len(m.group(1)))
            previous = "heading"
        elif (m := _UNDER.match(line)) and previous == "text":
            # the heading is the line above, whatever stands before it
            title = nodes.pop()
            found.add((title["line"], "heading"))
            node(title["line"], "heading", "underlined", title["body"], 1 if m.group(1)[0] == "=" else 2)
            previous = "heading"
        elif _RULE.match(line) or _UNDER.match(line):
            previous = "rule"
        else:
            tex, tags = list(_TEX.finditer(line)), list(_TAG.finditer(line))
            items, lis = list(_TEX_ITEM.finditer(line)), list(_LI.finditer(line))
            m = _ITEM.match(line) or _WIKI_ITEM.match(line)
            if m or _wiki_list(lines, i):
                found.add((n, "list_item"))
                mark = line.split(None, 1)[0]
                node(n, "list_item", "ordered" if mark[0].isdigit() or mark[0] == "#" else "bullet", raw[i].strip().split(None, 1)[-1], len(line) - len(line.lstrip()) + len(mark) - 1 if mark[0] in "*#" else len(line) - len(line.lstrip()))
                previous = "list_item"
            elif items or lis:
                found.add((n, "list_item"))
                if tags or tex:
                    found.add((n, "heading"))
                marks = [x.start() for x in (*items, *lis)] + [len(line)]
                marks.sort()
                for s, e in zip(marks, marks[1:]):
                    node(n, "list_item", "html" if lis else "latex", raw[i][s:e])
                previous = "list_item"
            elif tex or tags:
                found.add((n, "heading"))
                for x in tex:
                    node(n, "heading", "latex", raw[i][x.start(2) : x.end(2)], _TEX_LEVEL[x.group(1)])
                for x in tags:
                    node(n, "heading", "html", raw[i][x.start(2) : x.end(2)], int(x.group(1)))
                rest = raw[i][max(x.end() for x in (*tex, *tags)) :]
                if rest.strip():
                    node(n, "text", "html" if tags else "latex", rest)
                previous = "heading"
            elif regex.fullmatch(r"\s*(?:</?(?:ul|ol|div|p|section|article|body|html|tr|td|th|br|span)(?:\s[^<>]*)?/?>\s*)+", line, regex.I) or regex.fullmatch(r"\s*\\(?:begin|end)\{[^}]*\}(?:\[[^\]]*\])?\s*", line):
                previous = "tag"
            else:
                node(n, "text", "more" if previous == "text" else "p", raw[i])
                previous = "text"
    return nodes, sorted(found)


_INLINE = (
    (regex.compile(r"<!--.*?-->|\{\{[^{}]*\}\}|<ref\b[^<>]*>.*?</ref\s*>|<ref\b[^<>]*/>", regex.S), ""),
    (regex.compile(r"<math\b[^<>]*>(.*?)</math\s*>|\\\((.*?)\\\)|\\\[(.*?)\\\]", regex.S), lambda m: "$" + next(g for g in m.groups() if g is not None).strip() + "$"),
    (regex.compile(r"!?\[([^\[\]]*)\]\([^()\s]*(?:\s+\"[^\"]*\")?\)"), r"\1"),
    (regex.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]"), r"\1"),
    (regex.compile(r"<a\b[^<>]*>(.*?)</a\s*>", regex.S | regex.I), r"\1"),
    (regex.compile(r"<br\s*/?>", regex.I), " "),
    (regex.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>]*)?/?>"), ""),
    (regex.compile(r"~?\\(?:cite|ref|label|footnote|index)(?:\[[^\]]*\])?\{[^{}]*\}"), ""),
    (regex.compile(r"\\(?:emph|textbf|textit|texttt|underline|textsc|textrm|mbox)\{([^{}]*)\}"), r"\1"),
    (regex.compile(r"\\item\b(?:\[[^\]]*\])?\s*"), ""),
    (regex.compile(r"``(.*?)''", regex.S), r"“\1”"),
    (regex.compile(r"'{2,5}(.*?)'{2,5}"), r"\1"),
    (regex.compile(r"(?<![\w*])(\*{1,3})(?=\S)(.+?)(?<=\S)\1(?![\w*])"), r"\2"),
    (regex.compile(r"(?<![\w_])(_{1,3})(?=\S)(.+?)(?<=\S)\1(?![\w_])"), r"\2"),
    (regex.compile(r"(`+)(?!`)(.+?)(?<!`)\1(?!`)"), r"\2"),
    (regex.compile(r"\\([^\w\s])"), r"\1"),
)
_MATH = regex.compile(r"(?<![\\$])\$(?=[^\s$])[^$\n]*?(?<![\s\\])\$(?![\d$])")


def clean_inline(text: str) -> str:
    """A line without inline markup; formulas as $...$, entities as characters."""
    for pattern, new in _INLINE[:2]:
        text = pattern.sub(new, text)
    out, at = [], 0
    for m in _MATH.finditer(text):
        out.append((text[at : m.start()], False))
        out.append((m.group(), True))
        at = m.end()
    out.append((text[at:], False))
    parts = []
    for part, formula in out:
        if not formula:
            for pattern, new in _INLINE[2:]:
                part = pattern.sub(new, part)
            part = html.unescape(part)
        parts.append(part)
    return regex.sub(r"[ \t\u00a0\r]+", " ", "".join(parts)).strip()


def _code_body(body: str) -> str:
    lines = body.replace("\r", "").split("\n")
    inner = "\n".join(lines[1:-1]) if len(lines) > 2 else regex.sub(r"</?(?:pre|code|source|syntaxhighlight)\b[^<>]*>", "", body)
    return html.unescape(inner) if body.lstrip().lower().startswith("<pre") else inner


def _piece(n: dict) -> str:
    """A node as clean text."""
    kind = n["kind"]
    if kind == "heading":
        return "#" * max(1, n["level"]) + " " + clean_inline(n["body"])
    if kind == "list_item":
        return ("1. " if n["style"] == "ordered" else "- ") + clean_inline(n["body"])
    if kind == "code":
        return "```\n" + _code_body(n["body"]) + "\n```"
    if kind == "formula":
        inner = regex.sub(r"^\s*:?\s*(?:\$\$|\\\[|\\\(|<math\b[^<>]*>|\\begin\{[^}]*\})|(?:\$\$|\\\]|\\\)|</math\s*>|\\end\{[^}]*\})\s*$", "", n["body"]).strip()
        return "$$\n" + html.unescape(inner) + "\n$$"
    if kind == "table":
        rows = [clean_inline(regex.sub(r"\s*(?:\|\||\||&|!!|</t[dh]>\s*<t[dh][^<>]*>)\s*", " | ", r.strip().strip("|").replace("\\\\", ""))) for r in n["body"].split("\n") if not regex.fullmatch(r"[\s|:{}-]*|\{\|.*|<table.*|</table.*|\\(?:begin|end)\{.*", r)]
        return "\n".join(r.strip(" |") for r in rows if r.strip(" |"))
    return "" if kind in ("comment", "template") else clean_inline(n["body"])


def assemble(kinds: list[str], styles: list[str], pieces: list[str], removed: set[int]) -> str:
    """Clean text of the pieces whose index isn't removed."""
    out: list[str] = []
    open_ = ""
    for k, (kind, style, piece) in enumerate(zip(kinds, styles, pieces)):
        if k in removed or kind in ("comment", "template"):
            open_ = ""
            continue
        if not piece and kind in ("text", "table"):
            open_ = open_ if kind == "text" else kind
            continue
        if kind == open_ and kind in ("list_item", "table"):
            out[-1] += "\n" + piece
        elif kind == open_ == "text" and style == "more":
            out[-1] += " " + piece
        else:
            out.append(piece)
        open_ = kind
    return "\n\n".join(x for x in out if x.strip())


def render(nodes: list[dict], removed: set[int]) -> str:
    """Clean text of the nodes whose index isn't removed."""
    return assemble([n["kind"] for n in nodes], [n["style"] for n in nodes], [_piece(n) for n in nodes], removed)


def hash_text(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


ROOT = 0


def tree(nodes: list[dict]) -> list[dict]:
    """The style-tree facts of a page's DOM, one for each node of the tree.

    at is the index of a leaf in ``nodes`` (-1 for inner nodes), path the node's
    place in the merged tree, parent and under its parent's path and style, and
    value its own style (inner nodes) or content (leaves).
    """
    page: dict = {"tag": "page", "children": []}
    open_: list[tuple[int, dict]] = [(0, page)]
    for k, n in enumerate(nodes):
        leaf = {"tag": f"{n['kind']}:{n['style']}", "at": k}
        if n["kind"] == "heading":
            while open_[-1][0] >= max(1, n["level"]):
                open_.pop()
            section = {"tag": f"section{n['level']}", "children": [leaf]}
            open_[-1][1]["children"].append(section)
            open_.append((max(1, n["level"]), section))
            continue
        siblings = open_[-1][1]["children"]
        if n["kind"] != "list_item":
            siblings.append(leaf)
        elif siblings and siblings[-1]["tag"] == "list":
            siblings[-1]["children"].append(leaf)
        else:
            siblings.append({"tag": "list", "children": [leaf]})
    facts = []
    todo = [(page, ROOT, 0, 0, 0)]
    while todo:
        node, path, parent, under, depth = todo.pop()
        if "at" in node:
            body = regex.sub(r"\s+", " ", nodes[node["at"]]["body"]).strip().lower()
            facts.append({"at": node["at"], "depth": depth, "path": path, "parent": parent, "under": under, "value": hash_text(body)})
            continue
        style = hash_text("\n".join(c["tag"] for c in node["children"]))
        facts.append({"at": -1, "depth": depth, "path": path, "parent": parent, "under": under, "value": style})
        todo.extend((c, hash_text(f"{path} {style} {i}"), path, style, depth + 1) for i, c in enumerate(node["children"]))
    return facts


def pages(converted: DataFrame, chunks: DataFrame) -> DataFrame:
    """(record_id, site, page, text): distinct texts; page is the hash of the text as it stands."""
    a = converted.select(F.col("conversion_id").alias("record_id"), F.concat(F.lit("d:"), F.coalesce("source_id", F.lit(""))).alias("site"), F.col("markdown").alias("text"))
    b = chunks.select(F.col("chunk_id").alias("record_id"), F.concat(F.lit("c:"), F.coalesce("source_id", F.lit(""))).alias("site"), "text")
    both = a.unionByName(b).where("record_id is not null and text is not null").distinct()
    return both.withColumn("page", F.md5("text"))


_FACTS = "array<struct<at:int,depth:int,path:bigint,parent:bigint,under:bigint,value:bigint>>"
_ELEMENTS = "array<struct<line_no:int,element:string,at:int>>"


def parsed(converted: DataFrame, chunks: DataFrame, written: bool = True) -> DataFrame:
    """(record_id, site, page, text, elements, facts, kinds, styles, pieces, layout) of every text; pieces only where they are to be written; layout is the style of the root."""

    @F.pandas_udf(f"struct<elements:{_ELEMENTS},facts:{_FACTS},kinds:array<string>,styles:array<string>,pieces:array<string>>")
    def dom(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for t in s:
                nodes, found = parse(t)
                lines = [n["line"] for n in nodes]
                elements = [{"line_no": n, "element": e, "at": bisect.bisect_right(lines, n) - 1} for n, e in found]
                rows.append((elements, tree(nodes), *(([n["kind"] for n in nodes], [n["style"] for n in nodes], [_piece(n) for n in nodes]) if written else ([], [], []))))
            yield pd.DataFrame(rows, columns=["elements", "facts", "kinds", "styles", "pieces"])

    made = spread(pages(converted, chunks)).withColumn("dom", dom("text")).select("record_id", "site", "page", "text", "dom.*")
    return cut(made.withColumn("layout", F.element_at("facts", 1)["value"]))


def _shared(doms: DataFrame, roots: DataFrame) -> DataFrame:
    """The pages whose root has a style that another page of the site has: all others share no node but the root."""
    return doms.join(roots.where("n > 1").select("site", "layout"), ["site", "layout"], "left_semi")


def importance(doms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(site, path, depth, leaf, m, importance, noise): the nodes of the merged style trees that more than one page shares."""
    roots = doms.select("site", "page", "layout").distinct().groupBy("site", "layout").agg(F.count("*").alias("n"))
    fact = lambda n: F.first(f"f.{n}").alias(n)
    one = _shared(doms, roots).select("site", "page", "facts").dropDuplicates(["site", "page"]).select("site", F.explode("facts").alias("f")).where("f.depth > 0")
    deep = one.groupBy("site", "f.path", "f.value").agg(F.count("*").alias("n"), fact("depth"), fact("parent"), fact("under"), (F.first("f.at") >= 0).alias("leaf"))
    zero = F.lit(ROOT).cast("bigint")
    counted = deep.unionByName(roots.select("site", zero.alias("path"), F.col("layout").alias("value"), "n", F.lit(0).alias("depth"), zero.alias("parent"), zero.alias("under"), F.lit(False).alias("leaf")))
    counted = cut(counted)
    log_n = F.log("n")
    per = counted.groupBy("site", "path").agg(
        F.sum("n").alias("m"), F.count("*").alias("l"), F.sum(F.col("n") * log_n).alias("nlogn"), F.sum(log_n).alias("logs"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("under").alias("under"), F.first("leaf").alias("leaf"), F.min("n").alias("least")
    )
    base = F.log("m")
    # the entropy of counts n with sum m is log m - sum(n log n) / m
    own = F.when(F.col("leaf"), 1 - F.col("logs") / F.col("l") / base).otherwise((base - F.col("nlogn") / F.col("m")) / base)
    sure = base / F.log(F.col("m") + 1)
    nodes = cut(per.where("m > 1").withColumn("own", 1 - sure * (1 - own)).select("site", "path", "parent", "under", "depth", "leaf", "m", "l", "least", "own"))
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None:
        return nodes.select("site", "path", "depth", "leaf", "m", F.col("own").alias("importance"), F.lit(False).alias("noise"))
    styles = counted.where("not leaf").select("site", F.col("path").alias("parent"), F.col("value").alias("under"), "n")
    done = below = None
    # from the leaves up: sections nest by heading level, so there are few levels
    for depth in range(deepest, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        leaves = level.where("leaf").withColumn("importance", F.col("own")).withColumn("noise", F.col("own") < threshold)
        inner = level.where("not leaf")
        if below is None:
            inner = inner.withColumn("importance", F.col("own")).withColumn("noise", F.lit(False))
        else:
            # children of a style that one page has alone are important
            kids = below.groupBy("site", "parent", "under").agg(F.avg("importance").alias("mean"), F.min("noise").alias("noise"))
            shares = styles.where("n > 1").join(kids, ["site", "parent", "under"]).groupBy("site", F.col("parent").alias("path")).agg(F.sum(F.col("n") * (F.col("mean") - 1)).alias("less"), F.min("noise").alias("noise"))
            weight = F.pow(F.lit(DECAY), F.col("l"))
            inner = inner.join(shares, ["site", "path"], "left").withColumn("importance", (1 - weight) * F.col("own") + weight * (1 + F.coalesce("less", F.lit(0.0)) / F.col("m")))
            inner = inner.withColumn("noise", (F.col("importance") < threshold) & (F.col("least") > 1) & F.coalesce("noise", F.lit(False))).drop("less")
        below = leaves.unionByName(inner)
        done = below if done is None else done.unionByName(below)
    return cut(done.select("site", "path", "depth", "leaf", "m", "importance", "noise"))


def styled(converted: DataFrame, chunks: DataFrame, threshold: float = THRESHOLD, written: bool = True) -> DataFrame:
    """parsed() with ``removed``, the indexes of the nodes that the merged tree of the site calls noise."""
    doms = parsed(converted, chunks, written)
    nodes = importance(doms, threshold)
    copies = nodes.where("depth = 0 and noise").select("site")
    low = nodes.where("leaf and noise").select("site", "path").join(copies, "site", "left_anti")
    hits = (
        _shared(doms, doms.select("site", "page", "layout").distinct().groupBy("site", "layout").agg(F.count("*").alias("n")))
        .select("record_id", "site", "page", F.explode("facts").alias("f"))
        .where("f.at >= 0")
        .select("record_id", "page", "site", "f.at", "f.path")
        .join(low, ["site", "path"])
        .groupBy("record_id", "page")
        .agg(F.collect_set("at").alias("removed"))  # bounded by the record's own nodes
    )
    none = F.array().cast("array<int>")
    return cut(doms.drop("facts", "layout").join(hits, ["record_id", "page"], "left").withColumn("removed", F.coalesce("removed", none)))


def cleaned(converted: DataFrame, chunks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(record_id, text, elements, clean, removed) of every record."""

    @F.pandas_udf("string")
    def write(kinds: pd.Series, styles: pd.Series, pieces: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([assemble(list(k), list(s), list(p), set(r)) for k, s, p, r in zip(kinds, styles, pieces, removed)])

    return styled(converted, chunks, threshold).select("record_id", "text", "elements", write("kinds", "styles", "pieces", "removed").alias("clean"), F.size("removed").alias("removed"))


def tree_elements(converted: DataFrame, chunks: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(record_id, line_no, element, kept): the elements on the pages of the merged trees; kept says whether their branch stays."""
    each = styled(converted, chunks, threshold, written=False).select("record_id", "removed", F.explode("elements").alias("e"))
    rows = each.select("record_id", "e.line_no", "e.element", (~F.array_contains("removed", F.col("e.at"))).alias("kept"))
    return rows.groupBy("record_id", "line_no", "element").agg(F.max("kept").alias("kept"))


def elements(converted: DataFrame, chunks: DataFrame) -> DataFrame:
    """(record_id, line_no, element) of every structural element."""
    return tree_elements(converted, chunks).select("record_id", "line_no", "element")
