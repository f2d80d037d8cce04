"""Noise in text from scanned pages.

Method: the Levenshtein automaton of a word, whose edits are the confusions of
print (each costs one, whatever its letters), is intersected with a trie of the
vocabulary; it retrieves every vocabulary word that at most MOST confusions
explain.  The candidates are ranked by their confusions, then by their context
(neighbouring words); then page furniture is removed, broken words are joined
and lines reflowed into paragraphs.

The vocabulary is counted over all records: words that stand LEAST_COUNT times
or more and aren't themselves misreadings.  A word is a misreading if one
confusion explains it by a word that is more than MISREAD_RATIO times as common,
judged by a low estimate of its own count, which allows for chance where counts
are small.  Neither rule depends on the size of the corpus.

Nothing of the vocabulary is capped.  Words meet in blocks of one *skeleton*: a
confusion never changes a word's skeleton, so all words that confusions could
explain by each other are in one block, whose trie is built where the block is.
Records ask for the words that they hold, and the answers are joined back to
them.  Only as a shortcut are known words with a share of at least
FREQUENT_SHARE broadcast (by counting, no more than 1 / FREQUENT_SHARE of them):
records needn't ask for those.

Running headers are found over all records of a source: a short block of its
own that holds a page number, or a title that stands in such a block elsewhere
in the same source or repeats as a block of its own.

Defined results: null, empty and blank texts have no noise and come out as they
are; texts with markup aren't scans and come out unchanged; repeated rows count
once; line ends "\\r\\n" are read as "\\n" with the line numbers unchanged.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.llm.lookalike import ARMENIAN, ARMENIAN_AS, CYRILLIC, CYRILLIC_AS, GREEK, GREEK_AS, INVISIBLE
from claimspark.runtime import cut, once, spread

LEAST_COUNT = 3
MISREAD_RATIO = 50
#: Confusions in one word.
MOST = 2
FREQUENT_SHARE = 1e-5
#: Vocabulary words of one trie; larger blocks are searched in parts.
TRIE_WORDS = 200_000

# What print looks like when it is misread (as read, as meant).
CONFUSIONS = (
    ("c", "e"), ("e", "c"), ("€", "e"), ("l", "i"), ("i", "l"), ("1", "l"), ("1", "i"), ("l", "1"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("f", "t"), ("t", "f"), ("0", "o"), ("o", "0"), ("5", "s"), ("ſ", "s"),
    ("$", "s"), ("9", "g"), ("q", "g"), ("6", "b"), ("8", "b"), ("b", "h"), ("h", "b"), ("h", "li"), ("li", "h"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("u", "ii"), ("ii", "ü"), ("vv", "w"), ("w", "vv"), ("rn", "m"), ("m", "rn"), ("m", "in"), ("in", "m"),
    ("ni", "m"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("n", "ri"), ("ri", "n"), ("@", "a"), ("4", "a"), ("7", "t"), ("2", "z"), ("u", "n"), ("n", "u"), ("I", "l"), ("l", "I"), ("I", "i"), ("fi", "ﬁ"), ("nn", "m"), ("tl", "d"), ("iii", "m"), ("lll", "m"),
)
BREAKS = "-‐‑¬\u00ad"
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}€!|$@ſ]+(?:['’][\p{L}\p{M}]+)*")
_SQL_WORD = r"[\p{L}\p{M}]+(?:['’][\p{L}\p{M}]+)*"
_PAGE = regex.compile(r"^\W*(?:(?:page|seite|página|pagina|pág\.?|p\.|s\.|стр\.?)\s*)?(?:\d{1,5}(?:\s*(?:of|von|sur|de|di|из|/)\s*\d{1,5})?|[ivxlcdm]{1,9}|[IVXLCDM]{1,9})\W*$", regex.I)
_NUMBERED = regex.compile(r"^\s*(?:(\d{1,5}|[ivxlcdm]{1,9})\s{2,}(\S.*\S)|(\S.*?\S)\s{2,}(\d{1,5}|[ivxlcdm]{1,9}))\s*$")
_ROMAN = regex.compile(r"^\W*m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})[^\w.,;:!?]*$", regex.I)
_MARKUP = regex.compile(
    r"(?m)^[ \t]{0,3}#{1,6}[ \t]|^==+[^=\n].*==+\s*$|^[ \t]*```|^[ \t]*~~~|^[ \t]*\$\$|^[ \t]*[-*+][ \t]+\S|^[ \t]*\d+[.)][ \t]+\S|^\{\||^\|[-}|]|^\|.*\|[ \t\r]*$|</?[a-zA-Z][^<>\n]*>|\[\[[^\]\n]*\]\]|\]\([^)\n]*\)|\{\{|'''?[^'\n]+'''?|\\(?:section|subsection|subsubsection|begin|end|item|emph|textbf|cite|\[|\()|\*\*\S|`[^`\n]+`|(?<![\w\\])\$[^$\n]*[\\^_=<>][^$\n]*\$|&[a-z]+;|^(?:=+|-+)[ \t\r]*$|(?<!\w)_[^_\n]+_(?!\w)|``[^'\n]+''|^#\w"
)
_FOLD = str.maketrans(CYRILLIC + GREEK + ARMENIAN, CYRILLIC_AS + GREEK_AS + ARMENIAN_AS)
_UNSEEN = regex.compile(INVISIBLE)
_LATIN = regex.compile(r"[A-Za-zÀ-ɏ]")


# --- trie and automaton -----------------------------------------------------------------------------------------------

# The skeleton of a word: strokes that confusions add, drop or exchange are left out, the others stand for their class.
_STROKES = "ilIr1!|nuümhb68"
_CLASSES = (("cedtf7€", "c"), ("o0", "o"), ("s5ſ$", "s"), ("gq9", "g"), ("a@4", "a"), ("z2", "z"))
_SKELETON = str.maketrans({**{c: None for c in _STROKES}, **{c: to for group, to in _CLASSES for c in group}, "ﬁ": "c", "ﬂ": "c", "w": "vv"})


def skeleton(word: str) -> str:
    """Equal for all words that confusions turn into each other."""
    return word.translate(_SKELETON)


class Trie:
    """Vocabulary trie; each node is a dict of children, a word's end holds its count under ''."""

    def __init__(self, words: dict[str, int]) -> None:
        self.root: dict = {}
        for word, n in words.items():
            node = self.root
            for ch in word:
                node = node.setdefault(ch, {})
            node[""] = n

    def explained(self, read: str, most: int = MOST) -> list[tuple[int, int, str, int]]:
        """(confusions, place of the first in read, word, count) of every vocabulary word, at its fewest confusions.

        The states of the automaton are (letters read, confusions so far); a
        branch of the trie is left when no state is alive.
        """
        out: dict[str, tuple[int, int, int]] = {}
        size = len(read)
        at = [[(x, y) for x, y in CONFUSIONS if read.startswith(x, i)] for i in range(size + 1)]
        stack = [(self.root, "", 0, 0, -1)]
        while stack:
            node, prefix, i, cost, place = stack.pop()
            if i == size:
                if "" in node and cost and ((old := out.get(prefix)) is None or (cost, place) < old[:2]):
                    out[prefix] = (cost, place, node[""])
                continue
            if (child := node.get(read[i])) is not None:
                stack.append((child, prefix + read[i], i + 1, cost, place))
            if cost < most:
                for x, y in at[i]:
                    child = node
                    for ch in y:
                        child = child.get(ch)
                        if child is None:
                            break
                    else:
                        stack.append((child, prefix + y, i + len(x), cost + 1, i if place < 0 else place))
        return sorted((c, f, w, n) for w, (c, f, n) in out.items())


def is_misreading(n: int, by: int) -> bool:
    """Whether a word that stands n times is a misreading of one that stands ``by`` times and explains it."""
    return by >= MISREAD_RATIO * max(n - 1.5 * n**0.5, 0.2)


class Lexicon:
    """Words, compounds, beginnings of compounds and readings that a text asks for.

    readings: (read, before, after) -> (the word that was misread, place of the first misread character).
    """

    def __init__(self, words: dict[str, int], compounds: dict[str, int], heads: set[str], readings: dict[tuple[str, str, str], tuple[str, int]], more: dict[str, int] | None = None) -> None:
        self.words, self.compounds, self.heads, self.readings, self.more = words, compounds, heads, readings, more or {}

    def count(self, word: str) -> int:
        return self.words.get(word) or self.more.get(word, 0)

    def knows(self, word: str) -> bool:
        return word in self.words or word in self.more

    def meant(self, read: str, before: str, after: str) -> tuple[str, int] | None:
        return self.readings.get((read, before, after))


def folded(token: str) -> str:
    """Lower case, without invisible characters, widths and letters of other scripts in a Latin word."""
    if token.isascii():
        return token.lower()
    t = _UNSEEN.sub("", token)
    if not t.isascii():
        t = "".join(unicodedata.normalize("NFKC", c) if "！" <= c <= "ﾟ" else c for c in t)
        t = unicodedata.normalize("NFC", t)
        if _LATIN.search(t):
            t = t.translate(_FOLD)
    return t.lower()


# --- pages ------------------------------------------------------------------------------------------------------------

_ALIKE = str.maketrans("€c1!|i5ſ90f6h8", "eellllssgotbbb")


def title_key(line: str) -> str:
    """A title with its letters in visually confusable classes, so a misread title has the same key."""
    t = "".join(c for c in folded(line) if c.isalnum() or c in "€!|ſ")
    t = t.translate(_ALIKE)
    for a, b in (("rn", "m"), ("ll", "u"), ("vv", "w"), ("el", "d"), ("ln", "m")):
        t = t.replace(a, b)
    return t


_PAUSE = regex.compile(r"[.,;:!?]\s")
_COLUMNS = regex.compile(r"\S\s{2,}\d")
_TABLE = regex.compile(r"\s*(?:Table|Tabelle|Tableau|Tabla)\s+\d+\.")
_PIPES = regex.compile(r"(?m)^[ \t]*\|.*\|[ \t\r]*$")


def is_scan(text: str) -> bool:
    """Whether a text may come from a scanned page: no markup but ruled tables, and lines that are broken like print.

    Lines of any width that follow each other without a blank line are broken
    print.  A text of one-line blocks is a scan if one of them is page furniture
    or ends in a broken word.
    """
    if not text or not text.strip():
        return False
    prose = _PIPES.sub("", text)
    if _MARKUP.search(prose):
        return False
    lines = [x.strip() for x in prose.split("\n")]
    if any(a and b and not _is_table(a) and not _is_table(b) for a, b in zip(lines, lines[1:])):
        return True
    return any(x and (x[-1] in BREAKS or _line_kind(x)[0]) for x in lines)


def blocks(lines: list[str]) -> list[list[int]]:
    """Indexes of the lines of each block between blank lines."""
    out: list[list[int]] = []
    open_ = False
    for i, line in enumerate(lines):
        if not line.strip():
            open_ = False
        elif open_:
            out[-1].append(i)
        else:
            out.append([i])
            open_ = True
    return out


def _title_like(line: str) -> bool:
    words = line.split()
    # a title is no sentence: it neither ends nor pauses with a mark
    if not 1 <= len(words) <= 14 or words[-1][-1] in ".,;:!?-‐¬" or _PAUSE.search(line):
        return False
    letters = [w for w in words if any(c.isalpha() for c in w)]
    if not letters:
        return False
    upper = sum(1 for w in letters if next(c for c in w if c.isalpha()).isupper())
    # a title's words have capitals but for the short ones
    return upper == len(letters) or (letters[0][0].isupper() and all(next(c for c in w if c.isalpha()).isupper() or len(w) <= 4 for w in letters))


def _line_kind(line: str) -> tuple[str, str]:
    """('page' | 'roman' | 'both' | 'title' | '', title)."""
    line = line.strip()
    if _PAGE.match(line):
        return ("page", "") if any(c.isdigit() for c in line) else ("roman", "") if _ROMAN.match(line) else ("", "")
    if m := _NUMBERED.match(line):
        title = (m.group(2) or m.group(3)).strip()
        return ("both", title) if _title_like(title) else ("", "")
    return ("title", line) if _title_like(line) else ("", "")


def _sure_title(title: str) -> bool:
    """A title that ends as one: running text that has capitals goes on in small letters."""
    words = [w for w in title.split() if any(c.isalpha() for c in w)]
    capital = [next(c for c in w if c.isalpha()).isupper() for w in words]
    return len(words) > 1 and capital[-1] and sum(capital) > 1


def _candidates(lines: list[str]) -> list[tuple[int, str, str, bool]]:
    """(line, kind, title, numbered) of the lines that may be furniture.

    numbered: a short block of its own with a page number, or a numbered line;
    a title in running text next to a page number isn't yet one.
    """
    out = []
    for block in blocks(lines):
        kinds = [_line_kind(lines[i]) for i in block]
        alone = len(block) <= 2 and all(k for k, _ in kinds)
        number = any(k in ("page", "roman", "both") for k, _ in kinds)
        width = max(len(lines[i].strip()) for i in block)
        for j, (i, (kind, title)) in enumerate(zip(block, kinds)):
            if not kind:
                continue
            beside = any(kinds[n][0] in ("page", "roman") for n in (j - 1, j + 1) if 0 <= n < len(kinds))
            if alone:
                out.append((i, kind, title, number))
            elif kind == "title":
                # a wrapped line has no room for the next word; a line that has room was put in between
                room = j + 1 < len(block) and len(lines[i].strip()) + 1 + len(lines[block[j + 1]].split()[0]) < width
                out.append((i, kind, title, (beside or room) and _sure_title(title)))
            elif kind == "roman":
                near = [kinds[n] for n in (j - 1, j + 1) if 0 <= n < len(kinds)]
                out.append((i, kind, title, len(lines[i].strip()) > 1 or any(k == "title" and _sure_title(t) for k, t in near)))
            else:
                out.append((i, kind, title, kind == "page" or _sure_title(title)))
    return out


def title_lines(text: str) -> list[tuple[str, bool]]:
    """(title key, stands with a page number) of the lines of a scan that may be running headers."""
    lines = text.split("\n")
    short = {b[0] for b in blocks(lines) if len(b) == 1}
    return [(title_key(t), numbered) for i, kind, t, numbered in _candidates(lines) if t and (numbered or i in short)]


def furniture(lines: list[str], headers: set[str]) -> set[int]:
    """Indexes of running headers and page numbers; headers: keys of the source's known headers."""
    return {i for i, kind, title, numbered in _candidates(lines) if numbered or (kind == "title" and title_key(title) in headers)}


def _is_table(line: str) -> bool:
    return bool(_PIPES.match(line) or _COLUMNS.search(line) or _TABLE.match(line))


def _layout(text: str, headers: set[str]) -> tuple[list[str], set[int], list[int]]:
    """(lines, furniture, running lines)."""
    lines = [x.rstrip("\r") for x in text.split("\n")]
    extra = furniture(lines, headers)
    return lines, extra, [i for i, x in enumerate(lines) if x.strip() and i not in extra and not _is_table(x)]


def _words_of(line: str) -> list[tuple[int, int, str]]:
    return [m.span() + (m.group(),) for m in _WORD.finditer(line)]


def _broken(lines: list[str], running: list[int], k: int, words: list[tuple[int, int, str]]) -> tuple[int | None, object] | None:
    """(the next running line, its first word) where the line at k ends in a break after a word; None where it doesn't."""
    line = lines[running[k]].rstrip()
    if not (line and line[-1] in BREAKS and words and words[-1][1] >= len(line) - 1 and any(c.isalpha() for c in words[-1][2])):
        return None
    nxt = running[k + 1] if k + 1 < len(running) else None
    return nxt, _WORD.match(lines[nxt].lstrip()) if nxt is not None else None


def _asked(words: list[tuple[int, int, str]], folds: list[str], j: int) -> tuple[str, str, str, str] | None:
    """(the token without marks, its folded form, the folded words before and after it on the line)."""
    token, word = words[j][2], folds[j]
    if token[-1] in "!|":
        # an exclamation mark at the end is a mark
        token = token.rstrip("!|")
        word = folded(token)
    if (len(word) < 2 and word != "€") or not any(c.isalpha() or c in "€!|" for c in words[j][2]):
        return None
    return token, word, folds[j - 1] if j else "", folds[j + 1] if j + 1 < len(words) else ""


def _tail(word: str) -> tuple[str, str, str]:
    return word.rpartition("’" if "’" in word else "'")


def questions(text: str, headers: set[str], frequent: dict[str, int]) -> set[tuple[str, str, str]]:
    """(read, before, after) of everything that inspect() may ask about the text beyond the frequent words."""
    lines, _, running = _layout(text, headers)
    out: set[tuple[str, str, str]] = set()

    def ask(read: str, before: str = "", after: str = "") -> None:
        if read not in frequent:
            out.add((read, before, after))

    for k, i in enumerate(running):
        words = _words_of(lines[i])
        folds = [folded(t) for _, _, t in words]
        if cut_at := _broken(lines, running, k, words):
            lw = folds[-1]
            out.add((lw, "", ""))  # as the beginning of a compound, too
            if cut_at[1]:
                rw = folded(cut_at[1].group())
                ask(lw + rw)
                out.add((f"{lw}-{rw}", "", ""))
                ask(rw)
                ask(rw, lw)
        for j in range(len(words)):
            if not (found := _asked(words, folds, j)):
                continue
            bare, word, before, after = found
            ask(word, before, after)
            if "ﬁ" in bare or "ﬂ" in bare:
                out.add((word, before, after))
                ask(unicodedata.normalize("NFKC", word))
            if "'" in word or "’" in word:
                ask(_tail(word)[2], before, after)
    return out


def inspect(text: str, headers: set[str], lexicon: Lexicon) -> tuple[list[tuple[int, str]], str]:
    """([(line number, noise)], the repaired text) of a scan."""
    lines, extra, running = _layout(text, headers)
    noise: list[tuple[int, str]] = [(i + 1, "furniture") for i in sorted(extra)]
    fixes: dict[int, list[tuple[int, int, str]]] = {}
    joins: dict[int, tuple[int, str]] = {}  # line -> (where its part starts, 'word' or 'compound')
    glyph: set[int] = set()
    taken: dict[int, int] = {}  # line -> characters at its start that belong to the word of the line before

    def record(i: int, s: int, e: int, new: str) -> None:
        old = lines[i][s:e]
        if old[:1].isupper():
            new = new.upper() if len(old) > 1 and old.isupper() else new[:1].upper() + new[1:]
        fixes.setdefault(i, []).append((s, e, new))

    for k, i in enumerate(running):
        line = lines[i].rstrip()
        words = _words_of(lines[i])
        folds = [folded(t) for _, _, t in words]
        skip_last = False
        if cut_at := _broken(lines, running, k, words):
            nxt, m = cut_at
            s, e, left = words[-1]
            lw = folds[-1]
            if m and (m.group()[0].isalpha() or m.group()[0] in "€!|ſ1056"):
                lead = len(lines[nxt]) - len(lines[nxt].lstrip())
                rw = folded(m.group())
                joined, compound = lw + rw, f"{lw}-{rw}"
                n_join, n_comp = lexicon.count(joined), lexicon.compounds.get(compound, 0)
                fix = None if n_join or n_comp else lexicon.meant(joined, "", "")
                if n_join and n_join >= n_comp:
                    joins[i] = (nxt, "word")
                elif n_comp:
                    joins[i] = (nxt, "compound")
                elif fix and not (lexicon.knows(lw) and lexicon.knows(rw)):
                    joins[i] = (nxt, "word")
                    word, place = fix
                    at = i if place < len(lw) else nxt
                    glyph.add(at)
                    # the break stays where it was, counted from the end that is sound
                    split_at = len(lw) if at == nxt else len(word) - len(rw)
                    record(i, s, e, word[:split_at])
                    fixes.setdefault(nxt, []).append((lead, lead + m.end(), word[split_at:]))
                elif lexicon.knows(lw) and (lexicon.knows(rw) or lexicon.meant(rw, lw, "")) and line[-1] not in "¬\u00ad":
                    joins[i] = (nxt, "compound")
                else:
                    joins[i] = (nxt, "word")
                if joins[i][1] == "word":
                    noise.append((i + 1, "hyphen"))
                    skip_last = True
                    taken[nxt] = lead + m.end()
            elif m is None and nxt is None:
                # the text ends in the middle of a word
                if line[-1] in "¬\u00ad" or not (lw in lexicon.heads or lexicon.knows(lw)):
                    noise.append((i + 1, "hyphen"))
                    skip_last = True
        first = taken.get(i, 0)
        for j in range(len(words) - skip_last):
            s = words[j][0]
            if s < first or not (found := _asked(words, folds, j)):
                continue
            bare, word, before, after = found
            ligature = "ﬁ" in bare or "ﬂ" in bare
            if lexicon.knows(word) and not ligature:
                continue
            plain = unicodedata.normalize("NFKC", word)
            fix = (plain, 0) if ligature and lexicon.knows(plain) else lexicon.meant(word, before, after)
            if fix is None and ("'" in word or "’" in word):
                start, mark, tail = _tail(word)
                if lexicon.knows(tail):
                    continue
                part = lexicon.meant(tail, before, after)
                fix = (start + mark + part[0], len(start) + 1) if part else None
            if fix:
                glyph.add(i)
                record(i, s, s + len(bare), fix[0])
    noise.extend((i + 1, "glyph") for i in sorted(glyph))

    # continuous paragraphs
    def fixed(i: int) -> str:
        line = lines[i]
        for s, e, new in sorted(fixes.get(i, []), reverse=True):
            line = line[:s] + new + line[e:]
        return line.strip()

    out: list[str] = []
    paragraph, open_end, last = "", False, -1
    for i, line in enumerate(lines):
        if i in extra or not line.strip():
            continue
        if _is_table(line):
            if paragraph:
                out.append(paragraph)
                paragraph, open_end = "", False
            gap = last >= 0 and (last != i - 1 or not _is_table(lines[last]))
            if gap or not out:
                out.append(line.strip())
            else:
                out[-1] += "\n" + line.strip()
            last = i
            continue
        body = fixed(i)
        broken = last >= 0 and any(not lines[j].strip() for j in range(last + 1, i))
        page_break = broken and any(j in extra for j in range(last + 1, i))
        goes_on = open_end or (page_break and paragraph and paragraph[-1] not in ".!?。！？।؟:”»\"" and body[:1].islower())
        if paragraph and broken and not goes_on:
            out.append(paragraph)
            paragraph = ""
        if not paragraph:
            paragraph = body
        elif open_end:
            paragraph += body
        else:
            paragraph += " " + body
        open_end = False
        if i in joins:
            open_end = True
            if paragraph and paragraph[-1] in BREAKS:
                paragraph = paragraph[:-1] + ("-" if joins[i][1] == "compound" else "")
        last = i
    if paragraph:
        out.append(paragraph)
    return noise, "\n\n".join(out)


# --- Spark ------------------------------------------------------------------------------------------------------------


def records(converted: DataFrame, chunks: DataFrame) -> DataFrame:
    """(record_id, source_id, text): the distinct texts of both tables."""
    a = converted.select(F.col("conversion_id").alias("record_id"), "source_id", F.col("markdown").alias("text"))
    b = chunks.select(F.col("chunk_id").alias("record_id"), "source_id", "text")
    return a.unionByName(b).where("record_id is not null and text is not null").distinct()


def counted(texts: DataFrame) -> DataFrame:
    """(kind, value, n) over all texts: words (w), compounds (c) and pairs of neighbouring words (p)."""
    # the two parts of a word that is broken over lines are no words
    lower = F.regexp_replace(F.lower("text"), r"[\p{L}\p{M}]+[-‐‑¬\u00ad][ \t\r]*\n\s*[\p{L}\p{M}]+", " ")
    words = F.regexp_extract_all(lower, F.lit(_SQL_WORD), F.lit(0))
    compounds = F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{M}]+(?:-[\p{L}\p{M}]+)+"), F.lit(0))
    pairs = F.regexp_extract_all(lower, F.lit(r"(?=(?<![\p{L}\p{M}])([\p{L}\p{M}]+ [\p{L}\p{M}]+)(?![\p{L}\p{M}]))[\p{L}\p{M}]+"), F.lit(1))
    tagged = texts.select(F.explode(F.array(F.struct(F.lit("w").alias("kind"), words.alias("found")), F.struct(F.lit("c").alias("kind"), compounds.alias("found")), F.struct(F.lit("p").alias("kind"), pairs.alias("found")))).alias("t"))
    return cut(tagged.select("t.kind", F.explode("t.found").alias("value")).groupBy("kind", "value").agg(F.count("*").alias("n")))


@F.pandas_udf(T.StringType())
def _skeletons(s: pd.Series) -> pd.Series:
    return s.map(skeleton)


def explained_by(reads: DataFrame, words: DataFrame, trie_words: int | None = None) -> DataFrame:
    """(read, word, n, cost, place): the words (word, n) that confusions explain each read by, all of them.

    One task holds the trie of one skeleton's words; a skeleton of more than
    TRIE_WORDS is searched in parts, in each of which its reads are looked up.
    """
    limit = trie_words or TRIE_WORDS
    keyed = words.withColumn("skeleton", _skeletons("word"))
    asked = reads.select("read", _skeletons("read").alias("skeleton"))
    parts = keyed.groupBy("skeleton").agg(F.ceil(F.count("*") / limit).cast("int").alias("parts"))
    v = keyed.join(parts, "skeleton").select("skeleton", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), "word", "n")
    q = asked.join(parts, "skeleton").select("skeleton", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("read").alias("word"), F.lit(None).cast("bigint").alias("n"))
    columns = ["read", "word", "n", "cost", "place"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a block's words come before its reads
        at, held, trie = None, {}, None
        for pdf in batches:
            out = []
            for key, part, word, n in zip(pdf["skeleton"], pdf["part"], pdf["word"], pdf["n"]):
                if (key, part) != at:
                    at, held, trie = (key, part), {}, None
                if not pd.isna(n):
                    held[word] = int(n)
                    continue
                trie = trie or Trie(held)
                out.extend((word, w, k, c, f) for c, f, w, k in trie.explained(word) if w != word)
            yield pd.DataFrame(out, columns=columns)

    blocks = v.unionByName(q).repartition("skeleton", "part").sortWithinPartitions("skeleton", "part", F.col("n").isNull(), "word")
    return cut(blocks.mapInPandas(search, "read string, word string, n bigint, cost int, place int"))


def vocabulary(counts: DataFrame) -> DataFrame:
    """(word, n): the words that are no misreadings."""
    words = counts.where("kind = 'w'").select(F.col("value").alias("word"), "n").where(F.col("n") >= LEAST_COUNT)
    one = explained_by(words.select(F.col("word").alias("read")), words).where("cost = 1").groupBy("read").agg(F.max("n").alias("by"))
    low = F.greatest(F.col("n") - 1.5 * F.sqrt("n"), F.lit(0.2))
    return cut(words.join(one, words["word"] == one["read"], "left").where(F.col("by").isNull() | (F.col("by") < MISREAD_RATIO * low)).select("word", "n"))


def readings(asked: DataFrame, known: DataFrame, counts: DataFrame) -> DataFrame:
    """(read, before, after, word, place): what each asked read means in its context.

    Of the known words with the fewest confusions the one whose pairs with the
    neighbours are most frequent, then the most frequent, then the smallest.
    """
    reads = asked.select("read").distinct().join(known.select(F.col("word").alias("read")), "read", "left_anti")
    options = explained_by(reads, known)
    fewest = options.groupBy("read").agg(F.min("cost").alias("cost"))
    best = options.join(fewest, ["read", "cost"]).select("read", "word", "n", "place")
    each = cut(asked.select("read", "before", "after").distinct().join(best, "read"))
    keys = ["read", "before", "after"]
    several = each.join(each.groupBy(*keys).agg(F.count("*").alias("k")).where("k > 1").drop("k"), keys, "left_semi")
    pairs = several.select(*keys, "word", F.explode(F.array(F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "after"))).alias("value"))
    seen = pairs.join(counts.where("kind = 'p'").select("value", F.col("n").alias("times")), "value").groupBy(*keys, "word").agg(F.sum("times").alias("context"))
    ranked = each.join(seen, [*keys, "word"], "left")
    return ranked.groupBy(*keys).agg(F.min_by(F.struct("word", "place"), F.struct(-F.coalesce("context", F.lit(0)), -F.col("n"), F.col("word"))).alias("m")).select(*keys, "m.*")


def _headers(recs: DataFrame) -> DataFrame:
    """recs with scan (it may come from a scanned page) and headers, the keys of its own title lines that are running headers in its source."""

    @F.pandas_udf("struct<scan:boolean,t:array<struct<key:string,numbered:boolean>>>")
    def titles(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [(True, [{"key": k, "numbered": n} for k, n in title_lines(t)]) if is_scan(t) else (False, []) for t in s]
            yield pd.DataFrame(rows, columns=["scan", "t"])

    seen = cut(recs.withColumn("u", titles("text")).select("rid", "record_id", "source_id", "text", "u.scan", "u.t"))
    found = seen.where("scan").select("rid", "source_id", F.sha2("text", 256).alias("h"), F.explode("t").alias("t")).select("rid", "source_id", "h", "t.*")
    # exact copies of a text repeat a title without making it a header
    known = found.select("source_id", "h", "key", "numbered").distinct().groupBy("source_id", "key").agg(F.max("numbered").alias("numbered"), F.count("*").alias("n")).where("numbered or n > 1").select("source_id", "key")
    repeated = found.groupBy("rid", "key").agg(F.count("*").alias("n")).where("n > 1").select("rid", "key")
    own = found.join(known, ["source_id", "key"]).select("rid", "key").unionByName(repeated).groupBy("rid").agg(F.collect_set("key").alias("headers"))
    return cut(seen.drop("t", "source_id").join(own, "rid", "left").withColumn("headers", F.coalesce("headers", F.array().cast("array<string>"))))


_ANSWER = "read:string,before:string,after:string,n:bigint,compound:bigint,head:boolean,word:string,place:int"


def answers(scans: DataFrame, counts: DataFrame, known: DataFrame, frequent: Column | object, token: str) -> DataFrame:
    """(rid, answers): what each scan asks about its words, bounded by its own words."""

    @F.pandas_udf("array<struct<read:string,before:string,after:string>>")
    def ask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        common = once(token, lambda: dict(frequent.value))
        for texts, headers in batches:
            yield pd.Series([[{"read": r, "before": b, "after": a} for r, b, a in sorted(questions(t, set(h), common))] for t, h in zip(texts, headers)])

    asked = cut(scans.select("rid", F.explode(ask("text", "headers")).alias("q")).select("rid", "q.*"))
    compounds = counts.where("kind = 'c'").select(F.col("value").alias("read"), F.col("n").alias("compound"))
    heads = compounds.select(F.substring_index("read", "-", 1).alias("read")).distinct().withColumn("head", F.lit(True))
    facts = known.select(F.col("word").alias("read"), "n").join(compounds, "read", "full").join(heads, "read", "full")
    met = asked.join(facts, "read", "left").join(readings(asked, known, counts), ["read", "before", "after"], "left")
    useful = met.where("n is not null or compound is not null or head or word is not null")
    return useful.groupBy("rid").agg(F.collect_list(F.struct("read", "before", "after", "n", "compound", "head", "word", "place")).alias("answers"))


def repaired(converted: DataFrame, chunks: DataFrame) -> DataFrame:
    """(record_id, text, noise array<struct<line_no, noise>>, repaired) of every record; texts that aren't scans unchanged."""
    recs = spread(records(converted, chunks)).withColumn("rid", F.sha2(F.concat_ws("\u0001", "record_id", F.coalesce("source_id", F.lit("\u0002")), "text"), 256))
    spark = recs.sparkSession
    pages = _headers(recs)
    counts = counted(pages)
    known = vocabulary(counts)
    total = counts.where("kind = 'w'").agg(F.sum("n")).first()[0] or 0
    # at most 1 / FREQUENT_SHARE words
    frequent = spark.sparkContext.broadcast({r["word"]: r["n"] for r in known.where(F.col("n") >= F.lit(total * FREQUENT_SHARE)).toLocalIterator()})
    token = uuid.uuid4().hex
    scans = pages.where("scan")
    asked = scans.join(answers(scans, counts, known, frequent, token), "rid", "left").withColumn("answers", F.coalesce("answers", F.array().cast(f"array<struct<{_ANSWER}>>")))

    @F.pandas_udf("struct<noise:array<struct<line_no:int,noise:string>>,repaired:string>")
    def repair(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        common = once(token, lambda: dict(frequent.value))
        for texts, headers, found in batches:
            rows = []
            for t, h, rows_of in zip(texts, headers, found):
                words = {x["read"]: int(x["n"]) for x in rows_of if x["n"] is not None}
                compounds = {x["read"]: int(x["compound"]) for x in rows_of if x["compound"] is not None}
                means = {(x["read"], x["before"], x["after"]): (x["word"], int(x["place"])) for x in rows_of if x["word"] is not None}
                noise, new = inspect(t, set(h), Lexicon(words, compounds, {x["read"] for x in rows_of if x["head"]}, means, common))
                rows.append(([{"line_no": n, "noise": k} for n, k in noise], new))
            yield pd.DataFrame(rows, columns=["noise", "repaired"])

    done = asked.withColumn("r", repair("text", "headers", "answers")).select("record_id", "text", "r.noise", "r.repaired")
    rest = pages.where("not scan").select("record_id", "text", F.array().cast("array<struct<line_no:int,noise:string>>").alias("noise"), F.col("text").alias("repaired"))
    return done.unionByName(rest)


def noisy_lines(converted: DataFrame, chunks: DataFrame) -> DataFrame:
    """(record_id, line_no, noise)."""
    return repaired(converted, chunks).select("record_id", F.explode("noise").alias("n")).select("record_id", "n.line_no", "n.noise").distinct()
