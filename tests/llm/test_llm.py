"""Training-data operators: brute force, exact round trips and the defined results of edge cases."""

import datetime as dt
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from claimspark.llm import components, contamination, lookalike, markup, mixing, scan_repair, segment, sentences, survivors

EVIDENCE = "array<struct<source_id:string,chunk_id:string,heading_path:array<string>,page_start:int,page_end:int,quote:string,quote_sha256:string,verified:boolean>>"
TERM = f"term_id bigint, source_id string, chunk_id string, dup_group string, label string, kind string, definition string, confidence double, extracted_at timestamp, loaded_at timestamp, evidence {EVIDENCE}, value string, grp string"
CHUNK = "chunk_id string, source_id string, ordinal int, text string, heading_path array<string>, page_start int, page_end int, metadata map<string,string>, canonical string"
DOC = "doc_id bigint, text string, lang string, source string, item_id bigint"


def sha(q):
    return hashlib.sha256(q.encode()).hexdigest()


def row(i, label, conf=0.5, day=1, group="g", quotes=(), kind="concept"):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    return (i, "s", "c", group, label, kind, "d", conf, at, at, [("s", "c", None, 1, 1, q, sha(q), True) for q in quotes], "clash", "clash")


# --- 1 ---------------------------------------------------------------------------------------------------------------


def test_branch_and_bound_is_optimal():
    import itertools

    rng = random.Random(2)
    for _ in range(200):
        options = {b: sorted([((rng.randrange(4) if b != "c" else 0, rng.randrange(4) if b == "c" else 0, -k), f"{b}{k}", rng.choice("xyz")) for k in range(rng.randrange(5))], reverse=True) for b in "abc"}
        allowed = {("a", "b"): {v: rng.choice("xyz") for v in "xy"}, ("b", "c"): {v: rng.choice("xyz") for v in "yz"}}
        best = (0, 0, 0)
        for pick in itertools.product(*[[None, *options[b]] for b in "abc"]):
            if any(pick[i] and pick[i + 1] and allowed[k].get(pick[i][2], pick[i + 1][2]) != pick[i + 1][2] for i, k in enumerate(allowed)):
                continue
            best = max(best, tuple(sum(c[0][k] for c in pick if c) for k in range(3)))
        assert survivors.branch_and_bound(options, allowed, 3)[0] == best


def test_survivors_against_all_assignments(spark):
    """Two fields that are asked for and two that depend on them, against every assignment of each group."""
    import itertools

    rng = random.Random(8)
    rows = [(f"g{rng.randrange(12)}", i, rng.choice("abcd"), rng.choice("xyz"), rng.choice("pqr"), rng.choice([0.2, 0.5, 0.9]), rng.choice([1.0, 2.0, 3.0]), rng.random()) for i in range(110)]
    df = spark.createDataFrame(rows, "g string, id bigint, l string, k string, e string, lt double, et double, kt double")
    bundles = [survivors.Bundle("l", "l", "true", "lt"), survivors.Bundle("e", "e", "true", "et"), survivors.Bundle("k", "k", "true", "kt", 1)]
    depend = [survivors.Dependency("l", "k"), survivors.Dependency("e", "k")]
    got = {}
    for r in survivors.survivors(df, "g", "id", bundles, depend, width=2).collect():
        got.setdefault(r.grp, {})[r.bundle] = (r.id, r.value)
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]

        def ranked(c, t):
            best = {}
            for r in mine:
                best[r[c]] = max(best.get(r[c], (-1, -1)), (r[t], r[1]))
            order = sorted(best.items(), key=lambda x: x[1], reverse=True)
            return [(1 + round(10**9 * x[0] / order[0][1][0]), -i, x[1], v) for i, (v, x) in enumerate(order)]

        def must(c, v):
            n = {}
            for r in mine:
                if r[c] == v:
                    n[r[3]] = (n.get(r[3], (0, 0))[0] + 1, max(n.get(r[3], (0, 0))[1], r[7]))
            return max(n, key=lambda k: (*n[k], k))

        L, E, K = ranked(2, 5), ranked(4, 6), ranked(3, 7)
        options = []
        for a, b, c in itertools.product([*L, None], [*E, None], [*K, None]):
            if c and ((a and must(2, a[3]) != c[3]) or (b and must(4, b[3]) != c[3])):
                continue
            options.append((((a[0] if a else 0) + (b[0] if b else 0), c[0] if c else 0, sum(x[1] for x in (a, b, c) if x)), {n: (x[2], x[3]) for n, x in zip("lek", (a, b, c)) if x}))
        top = max(o[0] for o in options)
        assert got[g] in [o[1] for o in options if o[0] == top], g


def test_surviving_rows(spark):
    rows = [
        row(1, "Shared Resource Model", 0.9, 1, quotes=["a", "b"]), row(2, "shared-resource  model", 0.9, 5), row(3, "Shared Resource", 0.95, 9), row(4, "Sh@r3d R3s0urc3 M0d31", float("nan"), 10), row(5, "Shared Reso", 7.0, 11, quotes=["c"]),
        row(6, None, None, 12), row(7, "TBD", -1.0, 13), row(8, "<b>Shared Resource Model", 0.1, 14), row(9, "term_12", 0.2, 15), row(10, "Shared Resource Mod…", 0.3, 16), row(11, "Shared Resource Mo�el", 0.3, 17),
        row(12, "only", 0.4, 1, group=None), row(13, "n/a", None, 1, group="h"),
    ]
    df = spark.createDataFrame(rows + rows[:3], TERM)
    got = {(r.dup_group, r.field): r.term_id for r in survivors.surviving_rows(df).collect()}
    assert got == {("g", "label"): 2, ("g", "confidence"): 3, ("g", "evidence"): 1}
    assert survivors.surviving_rows(spark.createDataFrame([], TERM)).count() == 0


def test_ties_go_to_the_last(spark):
    df = spark.createDataFrame([row(1, "Audit Cycle", 0.5, 3), row(2, "audit cycle", 0.5, 3), row(3, "Audit Cycle", 0.5, 2)], TERM)
    assert {r.field: r.term_id for r in survivors.surviving_rows(df).collect()} == {"label": 2, "confidence": 2}


def test_dependencies_hold_and_widths_agree(spark):
    rng = random.Random(5)
    rows = [(f"g{rng.randrange(4)}", i, rng.choice("abcdef"), rng.choice("xyz"), rng.random(), rng.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, id bigint, l string, r string, lt double, rt double")
    bundles = [survivors.Bundle("l", "l", "true", "lt"), survivors.Bundle("r", "r", "true", "rt")]
    runs = []
    for width in (1, 100):
        got = {}
        for x in survivors.survivors(df, "g", "id", bundles, [survivors.Dependency("l", "r")], width=width).collect():
            got.setdefault(x.grp, {})[x.bundle] = (x.id, x.value)
        runs.append(got)
    assert runs[0] == runs[1] and len(runs[0]) == 4
    for g, pick in runs[0].items():
        pairs = [x for x in rows if x[0] == g and x[2] == pick["l"][1]]
        n = {r: (sum(x[3] == r for x in pairs), max(x[5] for x in pairs if x[3] == r)) for r in {x[3] for x in pairs}}
        assert pick["r"][1] == max(n, key=lambda r: (*n[r], r))


# --- 2 ---------------------------------------------------------------------------------------------------------------


def union_find(links):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {(k, find(k)) for k in list(up)}


@pytest.mark.parametrize("hub", [100_000, 5])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "LEAST_HUB", hub)
    monkeypatch.setattr(components, "HUB_SHARE", 4 if hub == 5 else 16_384)
    rng = random.Random(1)
    links = [(f"k{i}", f"k{i + 1}") for i in range(60)] + [("hub", f"h{i}") for i in range(80)] + [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(40)] + [("é", "z"), ("a", "a")]
    df = spark.createDataFrame(links + links[:9] + [(None, "q"), ("q", None)], "a string, b string")
    assert {tuple(r) for r in components.connected_components(df).collect()} == union_find(links)


def test_occurrence_groups(spark):
    decisions = spark.createDataFrame([(" 1:1", "1:2 ", "MERGE "), ("1:2", "1:3", "distinct"), (None, "1:4", "merge"), ("1:2", "1:1", "merge"), ("1:9", "1:9", "merge"), (" ", "1:8", "merge")], "left_key string, right_key string, decision string")
    clusters = spark.createDataFrame([(["1:5", "1:2", None, "1:5 "],), ([],), (None,), (["1:7"],)], "occurrence_keys array<string>")
    assert {tuple(r) for r in components.occurrence_groups(decisions, clusters).collect()} == {("1:1", "1:1"), ("1:2", "1:1"), ("1:5", "1:1")}
    assert components.occurrence_groups(decisions.limit(0), clusters.limit(0)).count() == 0


# --- 3 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["A b c. " * 700, "word " * 1000, "x\n\n" * 500, "字" * 50 + "。" * 400, "a" * 5000, "one two\nthree four\n" * 120, "!" * 333])
def test_split_round_trip(text):
    pieces = segment.split_text(text, 100, 10)
    spans = [(m.start(), m.end()) for m in re.finditer(r"\w+|[^\w\s]", text)]
    at = 0
    for k, (s, e, n, over, _) in enumerate(pieces):
        inside = [i for i, (a, b) in enumerate(spans) if a >= s and b <= e]
        assert len(inside) == n <= 100 and over == (min(10, at) if k else 0)
        assert inside[0] == at - over and inside == list(range(inside[0], inside[-1] + 1))
        at = inside[-1] + 1
    assert at == len(spans)


def test_split_prefers_valleys():
    a, b = " ".join(["alpha beta gamma delta."] * 14), " ".join(["sun moon star sky."] * 14)
    pieces = segment.split_text(f"{a}\n\n{b}\n\n{b}", 100, 0, block=30)
    assert pieces[0][4] == "paragraph" and f"{a}\n\n{b}"[: pieces[0][1]] == a


def test_split_chunks_edges(spark):
    long = "tok " * 3000
    rows = [("a", "s", 1, long, ["H"], 1, 2, {"k": "v"}, "x"), ("a", "s", 1, long, ["H"], 1, 2, {"k": "v"}, "x"), ("b", "s", 2, None, None, None, None, None, None), ("c", "s", 3, "", None, None, None, None, None), ("d", "s", 4, "x y!", None, None, None, {}, None), (None, None, None, long, None, None, None, None, None)]
    got = segment.split_chunks(spark.createDataFrame(rows, CHUNK)).collect()
    by = {}
    for r in got:
        by.setdefault(r.chunk_id, []).append(r)
    assert len(by["a"]) == 2 and all(r.heading_path == ["H"] and r.token_count <= 1800 and r.metadata == {"k": "v"} for r in by["a"])
    assert [r.token_count for r in by["b"] + by["c"] + by["d"]] == [0, 0, 3] and len(by[None]) == 2
    assert segment.split_chunks(spark.createDataFrame([], CHUNK)).count() == 0
    with pytest.raises(ValueError):
        segment.split_chunks(spark.createDataFrame([], CHUNK), 10, 10)


# --- 4 ---------------------------------------------------------------------------------------------------------------

WORDS = "the review of audits shapes every consensus because each committee protects a shared definition of trust between two offices".split()


def lexicon(text, headers=()):
    """The answers to a text's questions from a small vocabulary, without context."""
    words = {w: 100 for w in WORDS} | {"self": 50, "correcting": 60, "decision": 40, "making": 40}
    compounds = {"self-correcting": 30, "decision-making": 20}
    trie = scan_repair.Trie(words)
    means = {}
    for read, before, after in scan_repair.questions(text, set(headers), words):
        found = [] if read in words else trie.explained(read)
        if found:
            means[(read, before, after)] = (found[0][2], found[0][1])
    return scan_repair.Lexicon({}, compounds, {c.split("-")[0] for c in compounds}, means, words)


def explained(read, meant):
    """Fewest confusions that turn meant into read, by trying all."""
    best = {(0, 0): 0}
    for i in range(len(read) + 1):
        for j in range(len(meant) + 1):
            if (i, j) not in best:
                continue
            steps = [((1, 1), 0)] if i < len(read) and j < len(meant) and read[i] == meant[j] else []
            steps += [((len(x), len(y)), 1) for x, y in scan_repair.CONFUSIONS if read.startswith(x, i) and meant.startswith(y, j)]
            for (di, dj), c in steps:
                key = (i + di, j + dj)
                best[key] = min(best.get(key, 99), best[(i, j)] + c)
    return best.get((len(read), len(meant)), 99)


def misread(word, rng, times):
    for _ in range(times):
        at = [(i, x, y) for x, y in scan_repair.CONFUSIONS for i in range(len(word)) if word.startswith(y, i)]
        if at:
            i, x, y = rng.choice(at)
            word = word[:i] + x + word[i + len(y) :]
    return word


def test_confusions_keep_the_skeleton():
    assert all(scan_repair.skeleton(x) == scan_repair.skeleton(y) for x, y in scan_repair.CONFUSIONS)


def test_automaton_finds_all_confusions():
    rng = random.Random(4)
    words = {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *["".join(rng.choice("cemnrilut") for _ in range(rng.randrange(1, 7))) for _ in range(250)]]))}
    trie = scan_repair.Trie(words)
    reads = [misread(rng.choice(list(words)), rng, rng.randrange(1, 4)) for _ in range(120)] + ["iiiind", "cornrnon", "lll"]
    for read in reads:
        want = {(c, w) for w in words if 0 < (c := explained(read, w)) <= scan_repair.MOST}
        got = {(c, w) for c, _, w, _ in trie.explained(read) if w != read}
        assert got == {x for x in want if x[1] != read}, read
    assert scan_repair.Trie({"mind": 9, "common": 9}).explained("iiiind")[0][2] == "mind"
    assert scan_repair.Trie({"common": 9}).explained("cornrnon") == [(2, 2, "common", 9)]


def test_explained_by_in_parts(spark):
    rng = random.Random(6)
    words = list(dict.fromkeys("".join(rng.choice("cemnrilut") for _ in range(rng.randrange(2, 7))) for _ in range(200)))
    reads = list(dict.fromkeys(misread(rng.choice(words), rng, 2) for _ in range(60)))
    W_, R_ = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint"), spark.createDataFrame([(r,) for r in reads], "read string")
    want = {(r, w, explained(r, w)) for r in reads for w in words if w != r and explained(r, w) <= scan_repair.MOST}
    for size in (1_000, 3):
        assert {(r.read, r.word, r.cost) for r in scan_repair.explained_by(R_, W_, size).collect()} == want


def test_misreadings_and_rare_words(spark):
    body = "the common review of minds shapes every consensus\nbecause each committee minds the common trust"
    converted = spark.createDataFrame([(f"a{i}", "s", f"{body} {'x' * (i % 7 + 1)}") for i in range(60)] + [(f"b{i}", "s", body.replace("common", "cornmon")) for i in range(1)] + [("r", "s", "a zeugma here\nand zeugma there zeugma\nzeuqma too")], "conversion_id string, source_id string, markdown string")
    chunks = spark.createDataFrame([("k", "s", body.replace("minds", "iiiinds", 1))], "chunk_id string, source_id string, text string")
    got = {r.record_id: ([tuple(n) for n in r.noise], r.repaired) for r in scan_repair.repaired(converted, chunks).collect()}
    # a word of three occurrences is vocabulary at any size of the corpus, and is corrected to
    assert got["r"][0] == [(3, "glyph")] and got["r"][1].endswith("zeugma too")
    assert got["b0"][0] == [(1, "glyph"), (2, "glyph")] and "cornmon" not in got["b0"][1] and got["k"][0] == [(1, "glyph")]
    assert scan_repair.is_misreading(3, 40) and not scan_repair.is_misreading(30, 300) and not scan_repair.is_misreading(300, 3000)


def test_wide_scans():
    wide = " ".join(WORDS * 3)
    assert scan_repair.is_scan(f"{wide}\n{wide}") and not scan_repair.is_scan(f"{wide}\n\n{wide}") and scan_repair.is_scan("— 12 —")


def test_scan_noise_and_reflow():
    text = "\n".join(["the review of aud1ts shapes every con-", "sensus because each cornmittee protects a self-", "correcting defini-", "", "12    Shared Trust", "", "tion of trust between two", "Page 3 of 9", "offices.", "", "— 13 —", "SHARED TRUST", "", "Table 2. Trust by office", "audits      12    30"])
    noise, new = scan_repair.inspect(text, set(), lexicon(text))
    assert noise == [(5, "furniture"), (8, "furniture"), (11, "furniture"), (12, "furniture"), (1, "hyphen"), (3, "hyphen"), (1, "glyph"), (2, "glyph")]
    assert new == "the review of audits shapes every consensus because each committee protects a self-correcting definition of trust between two offices.\n\nTable 2. Trust by office\naudits      12    30"
    assert not scan_repair.is_scan("# Title\n\ntext") and not scan_repair.is_scan("") and not scan_repair.is_scan(None)


def test_repair_edges(spark):
    body = "\n".join([" ".join(WORDS[:9]), " ".join(WORDS[9:])] * 3)
    converted = spark.createDataFrame([("a", "s", body), ("a", "s", body), ("b", "s", None), ("c", None, ""), ("d", "s", "# H\n\nx-\ny"), (None, "s", "x")], "conversion_id string, source_id string, markdown string")
    chunks = spark.createDataFrame([("k", "s", body.replace("audits", "aud1ts", 1))], "chunk_id string, source_id string, text string")
    got = {r.record_id: r for r in scan_repair.repaired(converted, chunks).collect()}
    assert [tuple(n) for n in got["k"].noise] == [(1, "glyph")] and got["k"].repaired == got["a"].repaired and not got["a"].noise
    assert got["c"].repaired == "" and got["d"].repaired == "# H\n\nx-\ny" and set(got) == {"a", "c", "d", "k"}
    assert scan_repair.repaired(converted.limit(0), chunks.limit(0)).count() == 0


# --- 5 ---------------------------------------------------------------------------------------------------------------


def test_look_alikes(spark):
    text = "The  résumé of Ｃlaim [1]\nand Москва stays - fine"
    chunks = spark.createDataFrame([("c", text), ("c", text), ("d", None)], "chunk_id string, text string")
    quotes = [
        "résumé of", "of Сlaim", "Th\u200be résumé", "Ｃlaim\u00a0[1] and", "The résumé of Ｃlaim", "resume of", "the résumé", "Claim (1)", "", "Москва  stays", "stays – fine", "stays ‐ fine", "of\nClaim",
    ]
    rows = [(i, "c", q) for i, q in enumerate(quotes)] + [(50, "zz", "The"), (51, None, "The"), (52, "c", None), (0, "c", quotes[0])]
    ev = spark.createDataFrame(rows, "evidence_id bigint, chunk_id string, quote string")
    got = {r.evidence_id for r in lookalike.look_alike_quotes(chunks, ev).collect()}
    assert got == {0, 1, 2, 3, 4, 9, 11, 12}
    assert lookalike.look_alike_quotes(chunks.limit(0), ev.limit(0)).count() == 0


def test_line_form(spark):
    got = spark.createDataFrame([("ＡＢ\u3000ｶﾞ\u00adx ﬁ",), (None,), ("",), (" a \u00a0b\r\n\n  - c\u2028d \n",)], "t string").select(lookalike.line_form("t").alias("f")).select("f", lookalike.compared("f")).collect()
    assert got[0][0] == "AB \u30ab\u3099x fi" and got[1][0] is None and got[2][0] == ""
    assert tuple(got[3]) == ("a b\n\n- c\nd", "a b - c d")


def test_consistent_texts_keep_lines(spark):
    chunks = spark.createDataFrame([("c", "# Claіm\n\n- one\u00a0 two\n- Claim Claim")], "chunk_id string, text string")
    texts, _ = lookalike.consistent_texts(chunks, spark.createDataFrame([], "evidence_id bigint, chunk_id string, quote string"))
    assert [r.canonical for r in texts.collect()] == ["# Claim\n\n- one two\n- Claim Claim"]


# --- 6 ---------------------------------------------------------------------------------------------------------------

MIXED = r"""# Title
text $a_1$ and \(b\), costs $5 and $10, `$x$` ``quoted''
Under
-----
* item
  1) sub
\section*{S} \begin{itemize}
\item one \item two
$$
c
$$
```
# no
- no
```
<h2 id='a'>H</h2><ul><li>x</li></ul>
== W ==
** deep
<!-- # no -->
{{note|== no ==}}
% \section{no}
\# no
#tag no
* * *
| a | $b$ |
<pre>
# no
</pre>
<math>z</math>
\begin{align*}
x
\end{align*}
&lt;h2&gt; \$5 no"""


def test_elements():
    _, found = markup.parse(MIXED)
    assert found == sorted([(1, "heading"), (2, "formula"), (3, "heading"), (5, "list_item"), (6, "list_item"), (7, "heading"), (8, "list_item"), (9, "formula"), (12, "code"), (16, "heading"), (16, "list_item"), (17, "heading"), (18, "list_item"), (26, "code"), (29, "formula"), (30, "formula")])
    assert markup.parse("")[1] == [] and markup.parse("```\n# x")[1] == [(1, "code")] and markup.parse("a $$ b")[1] == []


def test_clean_text(spark):
    body = "<h1>Head</h1>\n<p>One <b>two</b>&amp;three<ref>n</ref> [[a|b]] $x_1$</p>\n\n1. it **em**\n\n```py\ncode  *x*\n```"
    nodes, _ = markup.parse(body)
    assert markup.render(nodes, set()) == "# Head\n\nOne two&three b $x_1$\n\n1. it em\n\n```\ncode  *x*\n```"
    pages = [(f"p{i}", "s", f"Home menu of the site\n\n# Page {i}\n\nbody {i}") for i in range(6)] + [("p0", "s", "Home menu of the site\n\n# Page 0\n\nbody 0"), ("n", "s", None), ("e", None, "")]
    converted = spark.createDataFrame(pages, "conversion_id string, source_id string, markdown string")
    chunks = spark.createDataFrame([("k", "s", "# X\n\ny")], "chunk_id string, source_id string, text string")
    got = {r.record_id: r for r in markup.cleaned(converted, chunks).collect()}
    assert got["p3"].clean == "# Page 3\n\nbody 3" and got["p3"].removed == 1 and got["k"].clean == "# X\n\ny" and got["e"].clean == "" and len(got) == 8
    assert markup.elements(converted.limit(0), chunks.limit(0)).count() == 0


def test_importance_of_presentation(spark):
    pages = [(f"p{i}", "s", "# Notes\n\n" + "\n\n".join(f"body {i} {k}" for k in range(i + 1))) for i in range(6)]
    chunks = spark.createDataFrame([], "chunk_id string, source_id string, text string")
    got = {r.record_id: r for r in markup.cleaned(spark.createDataFrame(pages, "conversion_id string, source_id string, markdown string"), chunks).collect()}
    assert all(r.removed == 0 and r.clean.startswith("# Notes") for r in got.values())


def site_importance(texts, decay=markup.DECAY):
    """The merged tree of one site by plain recursion: path -> (m, importance, noise)."""
    trees = [markup.tree(markup.parse(t)[0]) for t in dict.fromkeys(texts)]
    by = {}
    for t in trees:
        for f in t:
            by.setdefault(f["path"], []).append(f)

    def own(path):
        facts = by[path]
        m, n = len(facts), {}
        for f in facts:
            n[f["value"]] = n.get(f["value"], 0) + 1
        if m == 1:
            return m, n, 1.0
        raw = 1 - sum(math.log(k) / math.log(m) for k in n.values()) / len(n) if facts[0]["at"] >= 0 else -sum(k / m * math.log(k / m) for k in n.values()) / math.log(m)
        return m, n, 1 - math.log(m) / math.log(m + 1) * (1 - raw)

    out = {}

    def visit(path):
        m, n, imp = own(path)
        leaf = by[path][0]["at"] >= 0
        if leaf or m == 1:
            low = leaf and imp < markup.THRESHOLD
            for c in {f["path"] for p in by.values() for f in p if f["parent"] == path and f["depth"] > 0 and f["path"] != path}:
                visit(c)
            out[path] = (m, imp, low)
            return out[path]
        total, low = 0.0, True
        for style, k in n.items():
            kids = {f["path"] for p in by.values() for f in p if f["parent"] == path and f["under"] == style and f["depth"] > 0}
            got = [visit(c) for c in kids]
            total += k / m * sum(g[1] for g in got) / len(got)
            low &= all(g[2] for g in got)
        w = decay ** len(n)
        imp = (1 - w) * imp + w * total
        out[path] = (m, imp, low and imp < markup.THRESHOLD)
        return out[path]

    visit(markup.ROOT)
    return {p: x for p, x in out.items() if x[0] > 1}


def test_style_tree_against_recursion(spark):
    rng = random.Random(9)
    site = [f"Menu {i % 2}\n\n# T{i}\n\n" + "\n".join(f"- item {k}" for k in range(1 + i % 3)) + f"\n\n## Sub\n\nsame text\n\n" + ("```\nx\n```\n\n" if i % 4 else f"own {i}\n\n") + f"### Foot\n\nPage {i} of 9" for i in range(9)]
    rng.shuffle(site)
    rows = [(f"p{i}", "s", t) for i, t in enumerate([*site, site[0]])]
    doms = markup.parsed(spark.createDataFrame(rows, "conversion_id string, source_id string, markdown string"), spark.createDataFrame([], "chunk_id string, source_id string, text string"))
    got = {r.path: (r.m, pytest.approx(r.importance, abs=1e-9), r.noise) for r in markup.importance(doms).collect()}
    want = site_importance(site)
    assert got == want and any(x[2] for x in want.values()) and not all(x[2] for x in want.values())


def test_branches_are_removed_and_copies_stay(spark):
    foot = "\n\n# Contact\n\nWrite to the office\n\n- by post\n- by mail"
    rows = [(f"p{i}", "s", f"Own text {'abcdef'[i]} of the page" + foot) for i in range(6)] + [(f"c{i}", "t", "The same.\n\n# Head\n\n- one" + "\n" * i) for i in range(5)]
    # versions of one record that differ in line breaks lose their own lines only
    rows += [("p0", "s", "Own text a\nof the page" + foot)]
    converted = spark.createDataFrame(rows, "conversion_id string, source_id string, markdown string")
    chunks = spark.createDataFrame([], "chunk_id string, source_id string, text string")
    got = {(r.record_id, r.text): r for r in markup.cleaned(converted, chunks).collect()}
    assert all(r.clean == f"Own text {'abcdef'[int(i[1])]} of the page" and r.removed == 4 for (i, t), r in got.items() if i[0] == "p" and "a\nof" not in t), got
    assert got[("p0", rows[-1][2])].clean.startswith("Own text a of the page")
    assert all(r.removed == 0 for (i, _), r in got.items() if i[0] == "c")
    found = {(r.record_id, r.line_no, r.element): r.kept for r in markup.tree_elements(converted, chunks).collect()}
    assert found[("p1", 3, "heading")] is False and found[("p1", 7, "list_item")] is False and found[("c1", 3, "heading")] is True
    assert {k for k in found} == {tuple(r) for r in markup.elements(converted, chunks).collect()}


# --- 8 ---------------------------------------------------------------------------------------------------------------


def test_leaks(spark):
    words = [f"w{i}x" for i in range(40)]
    item, zh = " ".join(words), "".join(chr(0x4E00 + i * 7) for i in range(50))
    docs = [
        (1, "Before " + " ".join(words[3:18]).upper() + ", after", "en", "a", 1), (2, "x " + " ".join(words[3:17]) + " y", "en", "a", 1), (3, "-\n".join(words[:15]), None, None, None), (4, "好" + zh[5:35] + "。", "zh", "a", 1), (5, zh[5:34], "zh", "a", 1),
        (6, None, "en", "a", 1), (7, "", "en", "a", 1), (8, item * 3, "en", "a", 1), (1, "Before " + " ".join(words[3:18]).upper() + ", after", "en", "a", 1), (None, item, "en", "a", 1), (9, "q" + " ".join(words[:14]) + "z", "en", "a", 1),
    ]
    items = [(10, "t", "en", item), (11, "t", "en", item), (12, "t", "zh", zh), (13, "t", "en", None), (14, "t", None, " ".join(words[:5])), (10, "t", "en", item)]
    D, I = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id bigint, suite string, lang string, text string")
    want = {(d, i) for d in (1, 3, 8) for i in (10, 11)} | {(4, 12)}
    assert {tuple(r) for r in contamination.leaks(D, I).collect()} == want
    assert {tuple(r) for r in contamination.leaks(D, I, gram_block=7).collect()} == want
    clean = {r.doc_id: r for r in contamination.decontaminated(D.where("doc_id is not null"), I).collect()}
    assert clean[1].action == "drop" and clean[2].action == "keep" and clean[4].text is None and clean[6].text is None and len(clean) == 9
    cut = contamination.decontaminated(D.where("doc_id = 1"), I, drop_share=1.1).first()
    assert cut.text == "Before , after" and cut.action == "cut"
    assert contamination.leaks(D.limit(0), I).count() == 0 and contamination.leaks(D, I.limit(0)).count() == 0


# --- 9 ---------------------------------------------------------------------------------------------------------------


def test_temperature_and_plan():
    shares = {"a": 0.7, "b": 0.2, "c": 0.1}
    for target in (1.0, 0.5, math.log(3)):
        a = mixing.exponent_for_entropy(shares, target)
        assert mixing.entropy(mixing.tempered(shares, a)) == pytest.approx(target, abs=1e-6)
    natural, targets, caps = {"a": 1000, "b": 10}, {"a": 0.5, "b": 0.5, "none": 0.2}, {"a": 1, "b": 4, "none": 1}
    full = mixing.plan(natural, targets, caps)
    assert full.weights == pytest.approx({"a": 0.5, "b": 0.5}, abs=1e-6) and full.budget in (79, 80) and full.exponent == pytest.approx(1, abs=1e-5)
    tight = mixing.plan(natural, targets, caps, budget=400)
    assert 0 < tight.exponent < 1 and tight.weights["b"] * 400 <= 40 + 1e-6 and sum(tight.weights.values()) == pytest.approx(1)
    # the exponent is what a finer grid finds, too
    fits = [k / 20_000 for k in range(20_001) if mixing.between(natural, targets, k / 20_000)["b"] * 400 <= 40]
    assert tight.exponent == pytest.approx(max(fits), abs=1e-4)
    loose = mixing.plan(natural, targets, caps, budget=400, divergence=0.3)
    assert loose.exponent < tight.exponent or loose.exponent == pytest.approx(tight.exponent)
    assert mixing.relative_entropy({"a": 0.5, "b": 0.5}, mixing.between(natural, targets, mixing.plan(natural, targets, caps, budget=20, divergence=0.3).exponent)) == pytest.approx(0.3, abs=1e-6)


def test_tempered_mixture(spark):
    docs = [(i, "word " * (1 + i % 7), "en", "big" if i % 10 else "small", 1) for i in range(600)]
    D = spark.createDataFrame(docs, DOC)
    rows = mixing.tempered_mixture(D, most_repeats=3).collect()
    shares = {r.source: r for r in mixing.temperature_shares(D).collect()}
    used = {s: sum(r.tokens for r in rows if r.source == s) for s in shares}
    for s, n in used.items():
        assert abs(n / sum(used.values()) - shares[s].tempered_share) < 0.01 and shares[s].tempered_share != pytest.approx(shares[s].natural_share, abs=0.05)
    assert max(r.copy for r in rows) == 3 and mixing.tempered_mixture(D.limit(0)).count() == 0


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(i, "word " * rng.randrange(1, 60), "en", rng.choice(["big", "BIG ", "big"]) if i % 5 else "small-one", 1) for i in range(300)] + [(900, None, "en", "big", 1), (901, " ", "en", "big", 1), (902, "lost", "en", None, 1), (903, "x", "en", "untargeted", 1), (1, docs_text(), "en", "big", 1)]
    D = spark.createDataFrame(docs[:-1] + docs[:4], DOC)
    targets = spark.createDataFrame([("big", 0.5, 2), ("small_one", 0.4, 3), ("missing", 0.1, None)], "source string, target_share double, max_repeats int")
    rows = mixing.mixture(D, targets).collect()
    assert {r.source for r in rows} == {"big", "small_one"} and len({(r.doc_id, r.copy) for r in rows}) == len(rows)
    assert max(r.copy for r in rows if r.source == "big") <= 2 and max(r.copy for r in rows if r.source == "small_one") == 3
    report = {r.source: r for r in mixing.share_report(D, targets).collect()}
    assert report["missing"].actual_share == 0 and report["big"].weight == pytest.approx(5 / 9)
    assert abs(report["big"].actual_share - 5 / 9) < 0.01 and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    assert mixing.mixture(D.limit(0), targets).count() == 0 and mixing.mixture(D, targets.limit(0)).count() == 0


def docs_text():
    return "unused"


# --- 10 --------------------------------------------------------------------------------------------------------------

HELD_OUT = [
    ("Mr. Low and J. K. Roe met at 5 p.m. yesterday. See Fig. 3, p. 12 (Sec. 4.1). “Why now?” asked Dr. Roe. It rose by 3.5 percent! Notes, labels, etc. Fine.", ["Mr. Low and J. K. Roe met at 5 p.m. yesterday.", "See Fig. 3, p. 12 (Sec. 4.1).", "“Why now?” asked Dr. Roe.", "It rose by 3.5 percent!", "Notes, labels, etc.", "Fine."]),
    ("A Title Here\n\nOne line\nwraps here. Two?! (Three.) Four", ["A Title Here", "One line\nwraps here.", "Two?!", "(Three.)", "Four"]),
    ("Am 3. Mai kam z. B. Herr Roe. „Wer?“ fragte sie. Gut.", ["Am 3. Mai kam z. B. Herr Roe.", "„Wer?“ fragte sie.", "Gut."]),
    ("« Qui ? » demanda M. Roe. Oui !", ["« Qui ? » demanda M. Roe.", "Oui !"]),
    ("—¿Quién? —dijo la Sra. Roe. ¡No!", ["—¿Quién? —dijo la Sra. Roe.", "¡No!"]),
    ("В 1999 г. он ушёл. «Кто?» — спросил я. Списки и т. д. Всё.", ["В 1999 г. он ушёл.", "«Кто?» — спросил я.", "Списки и т. д.", "Всё."]),
    ("他写道：“好的。走吧。”，然后走了。增长2.5%！真的？", ["他写道：“好的。走吧。”，然后走了。", "增长2.5%！", "真的？"]),
    ("「誰か。」と言った。版は1.2（第3章。）。この本は良い。", ["「誰か。」と言った。", "版は1.2（第3章。）。", "この本は良い。"]),
    ("“कौन?” डॉ. रो ने पूछा। ठीक है।", ["“कौन?” डॉ. रो ने पूछा।", "ठीक है।"]),
    ("سأل د. رو: «من؟»، ثم غادر. نعم!", ["سأل د. رو: «من؟»، ثم غادر.", "نعم!"]),
    ("ทีมงานดี มี 13 กลุ่ม วิธีการชัดเจน ใคร? จบ", ["ทีมงานดี", "มี 13 กลุ่ม", "วิธีการชัดเจน", "ใคร?", "จบ"]),
]


def test_sentences_held_out(spark):
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, (t, _) in enumerate(HELD_OUT)] + [(90, None, None, None, 1), (91, "", None, None, 1), (92, " \n ", None, None, 1), (0, HELD_OUT[0][0], None, None, 1)], DOC)
    rows = sentences.sentences(docs).orderBy("doc_id", "sentence_no").collect()
    got = {}
    for r in rows:
        assert HELD_OUT[r.doc_id][0][r.start_pos : r.end_pos] == r.sentence
        got.setdefault(r.doc_id, []).append(r.sentence)
    wrong = [(want, got.get(i)) for i, (_, want) in enumerate(HELD_OUT) if got.get(i) != want]
    assert not wrong, wrong
    assert sentences.sentences(docs.limit(0)).count() == 0


def test_viterbi_is_exact():
    import itertools

    rng = random.Random(6)
    model = {k: rng.uniform(-1, 1) for k in ("a", "b", *[("step", x, y) for x in (0, 1) for y in (0, 1)])}
    for _ in range(30):
        rows = [tuple(rng.sample(["a", "b"], rng.randrange(1, 3))) for _ in range(rng.randrange(1, 7))]

        def score(tags):
            total, last = 0.0, 0
            for f, y in zip(rows, tags):
                total += y * sum(model[x] for x in f) + model[("step", last, y)]
                last = y
            return total

        best = max(score(t) for t in itertools.product((0, 1), repeat=len(rows)))
        assert score(sentences.viterbi(model, rows)) == pytest.approx(best)


def test_marks_are_stripped_for_unpunctuated_scripts():
    chains = sentences.labelled("ใครตรวจ? ทีมงานดี มี 13 กลุ่ม", frozenset())
    assert len(chains) == 2 and chains[0][1] == chains[1][1] and "mark=ask" in chains[1][0][0]
    # the features have lost the mark, the label hasn't
    assert "mark=gap" in chains[0][0][0] and chains[0][1][0] == 1 and not any("mark=ask" in f for f in chains[0][0])


def test_no_feature_tells_the_label():
    """Places that differ in their label differ in more than one known feature, and held-out text agrees."""
    texts = [("x", t, frozenset()) for t, _ in HELD_OUT]
    model = sentences.train([c for x in sentences.EXAMPLES for c in sentences.labelled(x, frozenset())])
    f1, n = sentences.agreement(texts, model)["x"]
    assert n > 15 and f1 > 0.9


def test_learned_abbreviations(spark):
    docs = spark.createDataFrame([(i, f"Das gilt bspw. für alle {i}. Es endet hier. Danach ging es so. Und es ist gut.", None, None, 1) for i in range(6)] + [(9, "no short words", None, None, 1)], DOC)
    assert [r.word for r in sentences.learned_abbreviations(docs).collect()] == ["bspw"]
    got = {r.doc_id: r.learned for r in sentences.with_abbreviations(docs.unionByName(docs)).collect()}
    assert got[9] == [] and got[3] == ["bspw"] and len(got) == 7


def test_long_text_is_whole():
    text = "One two three. " * 20_000
    model = sentences.train([c for x in sentences.EXAMPLES for c in sentences.labelled(x, frozenset())])
    assert len(sentences.split(text, model, frozenset())) == 20_000


# --- queries ---------------------------------------------------------------------------------------------------------


def test_queries_run(spark, sf):
    from claimspark.llm import queries

    found = queries.queries()
    assert {f"p{i}_found" for i in (1, 2, 3, 4, 5, 6, 8, 10)} <= set(found) and any(n.startswith("p9_") for n in found)
    for name, columns in {"p1_found": "dup_group field term_id", "p2_found": "occurrence_key group_key", "p3_found": "chunk_id", "p4_found": "record_id line_no noise", "p5_found": "evidence_id", "p6_found": "record_id line_no element", "p8_found": "doc_id item_id", "p10_found": "doc_id start_pos end_pos"}.items():
        df = found[name](spark, sf)
        assert df.columns == columns.split() and df.count() == df.distinct().count(), name


def test_classes_meet_in_any_layout(spark):
    """Spellings of one class come out alike however the words are partitioned."""
    rows = [(f"c{i}", w) for i, w in enumerate(["gr\u00f6\u00dfere", "gro\u0308\u00dfere", "gr\u00f6\u00df\u0435r\u0435", "gr\u00f6\u017fere", "cafe", "caf\u00e9", "cafe\u0301"] * 3)]
    texts = spark.createDataFrame(rows, "row_id string, plain string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for n in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            got = {r.word: r.canonical for r in lookalike.canonical_words(texts.repartition(n)).collect()}
            assert got == {"gro\u0308\u00dfere": "gr\u00f6\u00dfere", "gr\u00f6\u00df\u0435r\u0435": "gr\u00f6\u00dfere", "cafe\u0301": "caf\u00e9"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
