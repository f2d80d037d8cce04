"""Core operators against small fixtures and brute force."""

import difflib
import json
import random
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from claimspark import runtime
from claimspark.functions import text
from claimspark.operators import alignment, chunking, evidence_query, extraction, graph, grounding, reduction, resolution
from claimspark.sources import readers, writers

CHUNK = "chunk_id string, source_id string, text string"
EVIDENCE = "array<struct<source_id:string,chunk_id:string,heading_path:array<string>,page_start:int,page_end:int,quote:string,quote_sha256:string,verified:boolean>>"
TERM = f"term_id bigint, source_id string, fragment_index bigint, term_index int, label string, aliases array<string>, kind string, definition string, broader_labels array<string>, narrower_labels array<string>, related_labels array<string>, confidence double, evidence {EVIDENCE}"


def term(i, label, source="s", definition=None, confidence=0.9, broader=None, aliases=None, kind="concept", quote="q", verified=True):
    import hashlib

    ev = [(source, f"{source}:c{i}", None, 1, 1, quote, hashlib.sha256(quote.encode()).hexdigest(), verified)]
    return (i, source, i, 0, label, aliases, kind, definition, broader, None, None, confidence, ev)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_text_functions():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randrange(12))) for _ in "ab")
        assert text.common_subsequence(a, b) == lcs(a, b)
    assert text.slug("Über  den Wert!") == "uber-den-wert" and text.slug("???") == "item"
    assert text.stable_id("term", "A b", {"x": None}) == text.stable_id("term", "A b", {"x": None}) != text.stable_id("term", "A b", {"x": 1})
    assert text.fold("ＡＢ—Straße") == "ab strasse"
    assert not text.definitions_apart("", "x y") and text.definitions_apart("river edge land", "money house loans") and not text.definitions_apart("a river edge", "the edge of a river bank")
    import difflib

    for _ in range(200):
        a, b = (" ".join(rng.choice(["land", "edge", "river", "bank", "money", "loan", "of"]) for _ in range(rng.randrange(6))) for _ in "ab")
        x, y = (set(v.split()) - {"of"} for v in (a, b))
        like = max(len(x & y) / len(x | y), 0.5 * difflib.SequenceMatcher(None, a, b).ratio()) if x and y else 1.0
        assert text.definitions_apart(a, b) == (like < 0.25), (a, b)
    assert text.name_score("data model", "model data") == 100.0


@pytest.mark.parametrize("rule,ok", [("p(X) :- q(X).", True), ("p(X) :- not q(X).", False), ("p(a).", True), ("p(X).", False), ("p(X) :- q(X), not r(X).", True), ("p(X) :- q(Y).", False), ("p(X) :- q(X)", False), ("", False), (None, False)])
def test_datalog(rule, ok):
    assert text.datalog_rule_is_safe(rule) is ok


def test_blocks_and_heading_stack():
    md = "# A\n\ntext one\nmore\n\n### B\n\n### C\n\n- item\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n```py\n# no heading\n\nx\n```\n"
    got = chunking.blocks_of(md)
    assert [(b[0], b[3]) for b in got] == [("section_header", ("A",)), ("text", ("A",)), ("section_header", ("A", "B")), ("section_header", ("A", "B", "C")), ("list_item", ("A", "B", "C")), ("table", ("A", "B", "C")), ("code", ("A", "B", "C"))]
    assert chunking.blocks_of(None) == chunking.blocks_of("  \n") == []


def test_packing():
    words = " ".join(f"w{i}" for i in range(25))
    chunks = chunking.pack(chunking.blocks_of(f"# H\n\n{words}\n\nlast one"), limit=10, overlap=3)
    assert all(chunking.tokens_in(t) <= 10 for t, _, _ in chunks) and all(p == ("H",) for _, p, _ in chunks)
    assert chunks[0][0].startswith("H") and "last one" in chunks[-1][0]
    table = "| a |\n|---|\n" + "\n".join(f"| r{i} |" for i in range(20))
    made = chunking.pack(chunking.blocks_of(f"x\n\n{table}\n\ny"), limit=10, overlap=3)
    assert [label for _, _, label in made] == [["text"], ["table"], ["text"]]


def test_chunk_documents_edges(spark):
    df = spark.createDataFrame([("a", "s", "# T\n\nx"), ("a", "s", "# T\n\nx"), ("b", "s", None), (None, "s", "y"), ("c", "s", "")], "conversion_id string, source_id string, markdown string")
    rows = chunking.chunk_documents(df).collect()
    assert [(r.chunk_id, r.token_count) for r in rows] == [("a:chunk:000001", 2)]
    assert chunking.chunk_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chunking.chunk_documents(df, max_tokens=5, overlap=5)


def test_extraction(spark):
    body = "# Trust\n\nTrust is a belief in safe conduct. Trust means reliance! Shared Goals enable nothing. Load causes the delay of work. The Review Model is a framework for audits."
    sents = extraction.sentences(spark.createDataFrame([("c", "s", body), ("d", "s", None), ("e", "s", "")], CHUNK))
    assert sents.count() == 5
    labels = [r.label for r in extraction.terms(sents).orderBy("label").collect()]
    assert labels == ["Load", "Review Model", "Trust", "delay of work"]
    assert [(r.subject, r.predicate, r.object) for r in extraction.relations(sents).collect()] == [("Load", "causes", "delay of work")]
    assert [r.name for r in extraction.models(sents).collect()] == ["Review Model"]
    axioms = spark.createDataFrame([("s", "Load causes delay", "causal"), ("s", "Load does not cause delays", "causal")], "source_id string, statement string, modality string")
    assert extraction.contradictions(axioms.withColumn("statement", F.replace("statement", F.lit("causes"), F.lit("cause")))).select("kind", "n_affirmed", "n_negated").collect() == [("causal", 1, 1)]


def test_grounding(spark):
    import hashlib

    h = lambda q: hashlib.sha256(q.encode()).hexdigest()
    chunks = spark.createDataFrame([("c", "s", "one two\nthree"), ("c", "s", "one two\nthree"), (None, "s", "x")], CHUNK)
    rows = [(1, "s", "c", "two", h("two")), (2, "s", "c", "two three", ""), (3, "s", "c", "four", None), (4, "s", "zz", "two", None), (5, "s", "c", "two", h("x")), (6, "s", "c", "", None), (7, "s", None, None, None)]
    ev = spark.createDataFrame(rows, "evidence_id bigint, source_id string, chunk_id string, quote string, quote_sha256 string")
    assert {r.evidence_id: r.status for r in grounding.verify(ev, chunks).collect()} == {1: "exact", 2: "whitespace", 3: "absent", 4: "unknown_chunk", 5: "hash_mismatch", 6: "empty", 7: "empty"}


def test_similar_names_are_complete(spark):
    rng = random.Random(3)
    words = ["shared", "resource", "model", "trusted", "claim", "artifact", "layered", "audit", "cycle"]
    names = set()
    for _ in range(120):
        n = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))
        if rng.random() < 0.6:
            i = rng.randrange(len(n))
            n = n[:i] + rng.choice("xyz") + n[i + 1 :]
        names.add(" ".join(n.split()))
    df = spark.createDataFrame([("s", n) for n in names], "source_id string, name string")
    for threshold in (90.0, 78.0):
        brute = {(a, b) for a in names for b in names if a < b and text.name_score(a, b) >= threshold}
        assert {(r.left, r.right) for r in resolution.similar_names(df, threshold).collect()} == brute and brute


def test_similar_names_of_any_letters(spark):
    # low thresholds, more letters than codes, names longer than a word of the machine, one letter many times, several sources
    rng = random.Random(4)
    words = ["shared", "model", "a", "ab", "été", "模型", "a" * 14, "x" * 40, "y" * 30 + "z" * 40, *(chr(0x4E00 + k) for k in range(300))]
    rows = {(rng.choice("st"), " ".join(rng.choice(words[: rng.choice((5, 9, 309))]) for _ in range(rng.randrange(1, 4)))) for _ in range(160)}
    df = spark.createDataFrame(sorted(rows), "source_id string, name string")
    for threshold in (78.0, 60.0):
        brute = {(s, a, b): text.name_score(a, b) for s, a in rows for t, b in rows if s == t and a < b and text.name_score(a, b) >= threshold}
        got = resolution.similar_names(df, threshold).collect()
        assert {(r.source_id, r.left, r.right): r.score for r in got} == brute and len(got) == len(brute)
        half = sorted(rows)[::2], sorted(rows)[1::2]
        between = {(s, min(a, b), max(a, b)) for s, a in half[0] for t, b in half[1] if s == t and text.name_score(a, b) >= threshold}
        assert {x[:3] for x in text.close_names(*half, threshold)} == between and between


def test_resolution_guards(spark):
    rows = [
        term(0, "Bank", definition="land at the edge of a river"), term(1, "bank", definition=" "), term(2, "BANK", definition="institution that lends money"),
        term(3, "Shared Resource"), term(4, "Shared Resouce"), term(5, "Animal Kind"), term(6, "Animal Kinds", broader=["Animal Kind"]), term(7, None), term(8, "Shared Resource", source="t"),
    ]
    keyed, decisions = resolution.resolve(spark.createDataFrame(rows, TERM))
    got = {(r.source_id, r.key): r.cluster_key for r in keyed.collect()}
    assert got[("s", "0:0")] != got[("s", "2:0")] and got[("s", "3:0")] == got[("s", "4:0")] == "3:0"
    assert got[("s", "5:0")] != got[("s", "6:0")] and got[("t", "8:0")] == "8:0" and len(got) == 9
    assert {"merge", "distinct"} <= {r.decision for r in decisions.collect()}
    empty = resolution.resolve(spark.createDataFrame([], TERM))
    assert empty[0].count() == empty[1].count() == 0


def test_resolution_ambiguous(spark):
    rows = [term(0, "cautious autonomy"), term(1, "cautious autonomy veto"), term(2, "Cautious Autonomys"), term(3, "unlike")]
    df = spark.createDataFrame(rows, TERM)
    keyed, decisions = resolution.resolve(df)
    assert {(r.left, r.right, r.decision, r.stage) for r in decisions.collect()} == {("0:0", "1:0", "ambiguous", "lexical"), ("0:0", "2:0", "merge", "lexical"), ("1:0", "2:0", "ambiguous", "lexical")}
    assert {r.key: r.cluster_key for r in keyed.collect()} == {"0:0": "0:0", "1:0": "1:0", "2:0": "0:0", "3:0": "3:0"}
    names = resolution.occurrences(df).select("source_id", F.explode("names").alias("name"))
    assert resolution.similar_names(names).count() == 3
    keyed, decisions = resolution.resolve(df, adjudicator=lambda left, right, score: "veto" in right["names"][0])
    assert {r.key: r.cluster_key for r in keyed.collect()} == {"0:0": "0:0", "1:0": "0:0", "2:0": "0:0", "3:0": "3:0"}
    assert ("merge", "adjudicated") in {(r.decision, r.stage) for r in decisions.collect()}


def test_resolution_in_parts(spark):
    # clusters and decisions of the components without ambiguous pairs are those of one fold over all pairs
    rng = random.Random(8)
    words, said = ["shared", "resource", "model", "trust", "audit", "cycle", "ledger"], ["land at the edge of a river", "institution that lends money", "a bank of a river", "money of a river bank", None, "see", "it resembles a bank", "lends money to the edge"]
    rows = []
    for i in range(90):
        name = " ".join(rng.choice(words) for _ in range(rng.randrange(2, 4)))
        at = rng.randrange(len(name))
        name = name[:at] + rng.choice(["", "x", "xy", name[at]]) + name[at + 1 :]
        rows.append(term(i, name, aliases=[rows[rng.randrange(i)][5] if i and rng.random() < 0.2 else name.upper()], definition=rng.choice(said), broader=[r[5] for r in rng.sample(rows, min(i, 6))]))
    df = spark.createDataFrame(rows, TERM)
    keyed, decisions = resolution.resolve(df)
    occ = resolution.occurrences(df)
    reps = sorted(occ.groupBy("rep").agg(F.min("ord").alias("ord"), F.first("names").alias("names"), F.min("definition").alias("definition")).collect(), key=lambda r: r.ord)
    key = [f"{r.ord[0]}:{r.ord[1]}" for r in reps]
    at, close = {}, {}
    for i, r in enumerate(reps):
        for n in r.names:
            at.setdefault(n, []).append(i)
    for j in range(len(reps)):
        for i in range(j):
            score = max(text.name_score(x, y) for x in reps[i].names for y in reps[j].names)
            if score >= 78 and not set(reps[i].names) & set(reps[j].names):
                close.setdefault(i, {})[j] = score
    linked = {(r.x, r.y) for r in resolution.linked_names(df).collect()}
    roots, expected = resolution._resolve({"names": [r.names for r in reps], "definition": [r.definition for r in reps]}, close, at, linked, 90.0)
    got = [tuple(r)[1:] for r in decisions.collect()]
    assert sorted(got) == sorted((key[a], key[b], *rest) for a, b, *rest in expected) and {(r[2], r[3]) for r in got} >= {("ambiguous", "lexical"), ("distinct", "definition"), ("distinct", "analogy"), ("distinct", "hierarchy"), ("merge", "lexical")}
    of = {r.rep: key[roots[i]] for i, r in enumerate(reps)}
    assert {r.key: r.cluster_key for r in keyed.collect()} == {r.key: of[r.rep] for r in occ.collect()}
    # a guard between other members of the clusters stands in the way only once these have merged
    members = {"1:0": (["a"], None), "2:0": (["b"], None), "3:0": (["c"], None), "4:0": (["d"], None)}
    assert resolution._standing([("1:0", "2:0"), ("2:0", "3:0")], members, [("1:0", "4:0")], {("b", "d")}) == {("1:0", "2:0"): "", ("2:0", "3:0"): ""}
    assert resolution._standing([("1:0", "3:0"), ("3:0", "4:0")], members, [("1:0", "2:0")], {("b", "c")}) == {("1:0", "3:0"): "hierarchy", ("3:0", "4:0"): ""}


def test_reduction(spark):
    rows = [term(0, "A-b", confidence=0.9, definition="longer text"), term(1, "a b", confidence=0.8, definition="x", kind="role"), term(2, "a b", confidence=7.0), term(3, "weak", confidence=0.2), term(4, "unproven", verified=False), term(5, None), term(6, "other", broader=["A b", "other", "gone"])]
    df = spark.createDataFrame(rows, TERM)
    out = {r.label_key: r for r in reduction.reduced_terms(df).collect()}
    assert set(out) == {"a b", "other"} and out["a b"].label == "a b" and out["a b"].definition == "longer text" and out["a b"].n_evidence == 3
    links = {(r.label_key, r.link, r.other_key) for r in reduction.term_links(df, reduction.reduced_terms(df)).collect()}
    assert links == {("other", "broader", "a b"), ("a b", "narrower", "other")}
    assert [(r.other_key, r.n) for r in reduction.dangling_labels(df).collect()] == [("gone", 1)]
    assert reduction.reduced_terms(df, budget=1).count() == 1
    assert reduction.reduced_terms(spark.createDataFrame([], TERM)).count() == 0


def test_reduction_by_cluster(spark):
    rows = [term(0, "Data Model", aliases=["Schema"], confidence=0.8, definition="a plan of data"), term(1, "Schema", confidence=0.9), term(2, "Data Models", confidence=0.7), term(3, "other", broader=["schema", "gone"]), term(4, "alone", broader=["other"], confidence=0.2)]
    df = spark.createDataFrame(rows, TERM)
    keyed = resolution.resolve(df)[0]
    reduced = reduction.resolved_terms(df, keyed)
    out = {r.cluster_key: r for r in reduced.collect()}
    assert set(out) == {"0:0", "3:0"} and (out["0:0"].label, out["0:0"].aliases) == ("Schema", ["Data Model", "Data Models"])
    assert (out["0:0"].definition, out["0:0"].confidence, out["0:0"].n_evidence) == ("a plan of data", 0.9, 3)
    assert {(r.cluster_key, r.link, r.other_cluster) for r in reduction.resolved_links(df, keyed, reduced).collect()} == {("3:0", "broader", "0:0"), ("0:0", "narrower", "3:0")}


def test_alignment(spark):
    rows = [("s", "audit", "a check of records"), ("t", "audit", "a check of all records"), ("s", "formal audit", "a check of records"), ("t", "cycle", "never a check of records"), ("u", "audit", "a check of records")]
    cls = alignment.classes(spark.createDataFrame(rows, "source_id string, label_key string, definition string"))
    assert cls.count() == 4
    kinds = {frozenset((r.left_label, r.right_label)): r.kind for r in alignment.mappings(cls).collect()}
    assert kinds[frozenset({"audit"})] == "exact_equivalent" and kinds[frozenset({"audit", "formal audit"})] in ("broader", "narrower")


def test_alignment_candidates_are_complete(spark):
    rng = random.Random(6)
    labels = sorted({" ".join(rng.choice("abcdefghijklm"[: rng.choice((4, 13))]) for _ in range(rng.choice((1, 2, 3, 3, 4, 5, 6, 7, 8, 9, 11, 14)))) for _ in range(220)})
    cls = alignment.classes(spark.createDataFrame([("s", x, "d") for x in labels], "source_id string, label_key string, definition string"))
    of = {r.class_id: r.label_key for r in cls.collect()}
    got = [tuple(sorted((of[r.left_id], of[r.right_id]))) for r in alignment.candidate_pairs(cls).collect()]
    near = {(x, y) for x in labels for y in labels if x < y and len(set(x.split()) & set(y.split())) >= 0.66 * len(set(x.split()) | set(y.split()))}
    within = {(x, y) for x in labels for y in labels if x < y and (f" {x} " in f" {y} " or f" {y} " in f" {x} ")}
    assert len(set(got)) == len(got) and near | within <= set(got) and len(near) > 50
    # short labels give no pair that no rule could relate
    assert all(len(x.split()) > 8 or len(y.split()) > 8 for x, y in set(got) - near - within)


def test_texts_compared_only_where_read(spark, monkeypatch):
    seen = []
    real = alignment._ratio
    monkeypatch.setattr(alignment, "_ratio", lambda a, b: seen.append((a, b)) or real(a, b))
    rows = [("s", "audit of records", "a check of records"), ("t", "records of audit", "a tally of all records"), ("u", "audit", "one thing or another"), ("v", "audit", "one thing or two")]
    df = spark.createDataFrame(rows, "source_id string, label_key string, definition string")
    mapped = alignment.mappings(alignment.classes(df)).collect()
    assert {(frozenset((r.left_label, r.right_label)), r.kind) for r in mapped} >= {(frozenset(("audit of records", "records of audit")), "related_or_analogous"), (frozenset(("audit",)), "exact_equivalent")}
    f = alignment.features(alignment.classes(df)).withColumn("a", seen[0][0])
    assert {r.equal_label or r.contains or r.contained for r in f.where("a is not null").collect()} == {True} and f.where("a is null").count() == 1


def test_texts_are_compared_together():
    """The ratios of SequenceMatcher for all pairs at once, and in a small part of its time."""
    rng = random.Random(8)
    made = lambda letters, most: "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
    many = "".join(map(chr, range(32, 900)))
    pairs = [(made(letters, n), made(letters, m)) for letters in ("ab", "abc ", "adeilnorst ", "aé漢😀\x00 ", many) for n, m in ((3, 4), (40, 90), (199, 199), (260, 260), (20, 220), (220, 20)) for _ in range(30)]
    pairs += [("", ""), ("", "a"), ("a", ""), ("same text", "same text")] + [(x, y[:20] + x[20:60] + y[60:]) for x, y in pairs]
    rng.shuffle(pairs)
    assert text.text_ratios(*map(list, zip(*pairs))).tolist() == [difflib.SequenceMatcher(None, x, y).ratio() for x, y in pairs]
    words = ["ledger", "policy", "that", "links", "audits", "of", "the", "office", "shared", "partial"]
    pairs = [(" ".join(rng.choices(words, k=8)), " ".join(rng.choices(words, k=8))) for _ in range(4000)]
    began = time.process_time()
    got = text.text_ratios(*map(list, zip(*pairs)))
    middle = time.process_time()
    want = [difflib.SequenceMatcher(None, x, y).ratio() for x, y in pairs]
    assert got.tolist() == want and 2 * (middle - began) < time.process_time() - middle


def test_alignment_features_are_made_once_for_a_class(spark):
    """Numbers stand for identifiers whatever these are, and the pairs' own columns are kept."""
    rows = [("s", f"label {'x' * (i % 3)} {i % 5}".strip(), d) for i, d in enumerate(["never a check", "a check", "", "increase of work", "decrease of work", "work increases", "work decreases", "no increase of work"] * 4)]
    cls = alignment.classes(spark.createDataFrame(rows, "source_id string, label_key string, definition string"))
    pairs = alignment.candidate_pairs(cls).withColumn("mark", F.lit(7))
    got = alignment._compared(cls, pairs).collect()
    assert len(got) == pairs.count() == pairs.distinct().count() and {r.mark for r in got} == {7} and all(r.left_id < r.right_id for r in got)
    opposites = (("increase", "decrease"), ("increases", "decreases"))
    for r in got:
        x, y = set(r.left_definition.split()), set(r.right_definition.split())
        a, b = ({"no", "never"} & w for w in (x, y))
        apart = any((u in x and v in y and v not in x and u not in y) or (v in x and u in y and u not in x and v not in y) for u, v in opposites)
        p, q = x - {"no", "never"}, y - {"no", "never"}
        assert r.opposed == ((bool(a) != bool(b) or apart) and bool(p and q) and len(p & q) >= 0.5 * len(p | q))
        assert r.definition_overlap == round(len(x & y) / len(x | y), 6) if x | y else r.definition_overlap == 0
    ids = {r.class_id for r in cls.collect()}
    assert all(r.left_id in ids and r.right_id in ids and r.left_id < r.right_id for r in alignment.mappings(cls).collect())


def test_conflicting_alone_is_what_mappings_say(spark, monkeypatch):
    """The conflicting pairs without any comparison of texts or of other labels."""
    rng = random.Random(3)
    words = ["fair", "share", "of", "work", "never", "not", "increase", "decrease", "improves", "harms", "without", "team"]
    rows = [(f"s{i % 7}", f"label {rng.randint(0, 5)}" + " x" * rng.randint(0, 1), " ".join(rng.choice(words) for _ in range(rng.randint(0, 5)))) for i in range(300)]
    cls = alignment.classes(spark.createDataFrame([*rows, ("s", "", "never"), ("s", "label 1", None)], "source_id string, label_key string, definition string")).cache()
    want = {tuple(r) for r in alignment.mappings(cls).where("kind = 'conflicting'").collect()}
    monkeypatch.setattr(alignment, "_ratio", None)
    monkeypatch.setattr(alignment, "candidate_pairs", None)
    got = [tuple(r) for r in alignment.conflicting(cls).collect()]
    assert len(want) > 100 and len(got) == len(want) and set(got) == want


def test_alignment_by_alias(spark):
    rows = [
        term(0, "Ledger", source="s", aliases=["Account Book"], definition="a record of payments"), term(1, "account book", source="t", definition="a record of payments"),
        term(2, "Tally", source="u", aliases=["ledger"], definition="something else entirely"), term(3, "Roll", source="s", aliases=["Ledger"], definition="a list of names"),
    ]
    df = spark.createDataFrame(rows, TERM)
    reduced = reduction.reduced_terms(df)
    got = {(*sorted((r.left_label, r.right_label)), r.kind) for r in alignment.mappings(alignment.classes(reduced), alignment.forms(reduced, reduction.drafts(df))).collect()}
    assert got == {("account book", "ledger", "exact_equivalent"), ("ledger", "tally", "related_or_analogous"), ("roll", "tally", "related_or_analogous")}


def test_opposed_statements(spark):
    rows = [("Regular audits improve data quality", "causal"), ("Regular audits harm data quality", "causal"), ("Regular audits never improve data quality", "normative"), ("Cats sleep", "empirical"), (None, None)]
    got = {(r.left_statement, r.right_statement): r.kind for r in alignment.opposed_statements(spark.createDataFrame(rows, "statement string, modality string")).collect()}
    assert got[("Regular audits harm data quality", "Regular audits improve data quality")] == "causal" and len(got) == 3


def test_opposed_statements_all_found(spark):
    """Every pair that a comparison of all with all finds, whichever way it is opposed."""
    rng = random.Random(5)
    nouns = ["audit", "team", "office", "ledger", "norm", "margin", "zeal", "vote"]
    words = [*nouns, "never", "not", "improves", "harms", "increases", "reduces", "harms"]
    statements = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(2, 9))) for _ in range(400)})
    df = spark.createDataFrame([(s, rng.choice(["causal", "normative", "empirical"])) for s in statements], "statement string, modality string")
    sig = {r.statement: r for r in alignment.signatures(df).collect()}
    want = set()
    for i, a in enumerate(statements):
        for b in statements[i + 1 :]:
            x, y = sig[a], sig[b]
            shared = len(set(x.content) & set(y.content))
            if shared >= 2 and shared / len(set(x.content) | set(y.content)) >= 0.40 and (x.negated != y.negated or x.effect * y.effect == -1 or x.quantity * y.quantity == -1):
                want.add((a, b))
    got = [(r.left_statement, r.right_statement) for r in alignment.opposed_statements(df).collect()]
    assert len(want) > 1000 and len(got) == len(set(got)) and set(got) == want


def _one_pole(n: int) -> list[tuple[str, str]]:
    """n different statements of few words, all with an effect in one direction, but for a pair that is opposed."""
    nouns = [f"noun{i}x" for i in range(60)]
    rng = random.Random(7)
    rows = {" ".join([*rng.sample(nouns, 4), "improves", *rng.sample(nouns, 3)]) for _ in range(n)}
    return [(s, "causal") for s in sorted(rows)] + [("Late audits harm thin data", "causal"), ("Late audits improve thin data", "causal")]


def test_statements_of_one_pole_are_not_compared(spark):
    df = spark.createDataFrame(_one_pole(12_000), "statement string, modality string")
    began = time.monotonic()
    assert alignment.opposed_statements(df).count() == 1
    assert time.monotonic() - began < 40  # all with all are 70 million pairs


def test_graph_round_trip(spark):
    df = spark.createDataFrame([term(0, 'Say "x"\n\\', definition="d"), term(1, "b", broader=["say x"])], TERM)
    reduced = reduction.reduced_terms(df)
    quads = graph.term_quads(reduced, reduction.term_links(df, reduced), reduction.drafts(df))
    rows = {tuple(r) for r in quads.collect()}
    assert {graph.parse_nquad(r.value) for r in graph.nquads(quads).collect()} == rows
    assert graph.violations(quads).count() == 0
    broken = quads.where(F.col("predicate") != graph.SKOS + "prefLabel")
    assert {r.constraint for r in graph.violations(broken).collect()} == {"least"}


def test_evidence_query(spark):
    df = spark.createDataFrame([term(0, "a", quote="Trust needs audits"), term(1, "b", quote="Other text"), term(2, "c", quote="audits")], TERM)
    index = evidence_query.evidence_index(df)
    rows = evidence_query.ask(index, "trust needs audits").collect()
    assert [r.score for r in rows] == [1.0, 0.3333] and rows[0].n_claims == 1 and evidence_query.evidence_claims(df).count() == 3
    assert evidence_query.retrieve(index, "audits", []).count() == 2 and evidence_query.retrieve(index, "audits", ["zz"]).count() == 0
    with pytest.raises(ValueError):
        evidence_query.retrieve(index, "  ")


def test_ask_claims_and_conflicts(spark):
    rows = [term(i, f"label {i}", quote="trust needs audits " + "x" * i) for i in range(11)] + [term(20, "audit load", quote="zz trust", broader=["delay"]), term(21, "delay", quote="no match")]
    df = spark.createDataFrame(rows, TERM)
    index, claims = evidence_query.evidence_index(df), evidence_query.evidence_claims(df)
    got = evidence_query.ask_claims(index, claims, "trust needs audits").collect()
    assert len(got) == 10 and "audit load" not in {r.label_key for r in got}
    against = spark.createDataFrame([("s", "audit load cause harm"), ("s", "delay is bad"), ("s", "other thing"), ("t", "audit load cause harm")], "source_id string, signature string")
    links = reduction.term_links(df, reduction.reduced_terms(df))
    assert {(r.source_id, r.signature) for r in evidence_query.ask_conflicts(index, claims, against, links, "trust needs audits").collect()} == {("s", "audit load cause harm"), ("s", "delay is bad")}
    models = spark.createDataFrame([("s", "review model"), ("t", "review model"), ("s", "x")], "source_id string, name_key string")
    assert [r.ambiguous for r in evidence_query.mental_model(models, "Review-Model").collect()] == [True, True]


def test_files_to_chunks(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a note.md").write_bytes("# T\r\n\r\nBody é".encode())
    (src / "p.html").write_text("<html><script>x</script><h1>Head</h1><p>One <b>two</b></p><ul><li>i</li></ul><table><tr><td>a</td></tr></table></html>")
    (src / "x.bin").write_bytes(b"\0")
    with zipfile.ZipFile(src / "b.epub", "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="o/c.opf"/></rootfiles></container>')
        z.writestr("o/c.opf", '<package xmlns="urn:y"><manifest><item id="1" href="a.xhtml" media-type="application/xhtml+xml"/><item id="2" href="b.xhtml" media-type="application/xhtml+xml"/></manifest><spine><itemref idref="2"/></spine></package>')
        z.writestr("o/a.xhtml", "<p>second</p>")
        z.writestr("o/b.xhtml", "<h2>First</h2><p>one</p>")
    files = readers.read_files(spark, str(src))
    got = {r.title: r for r in readers.convert_files(files).collect()}
    assert got["a note"].markdown == "# T\r\n\r\nBody é" and got["a note"].source_id.startswith("a-note-") and got["x"].error
    assert "# Head" in got["p"].markdown and "**two**" in got["p"].markdown and "script" not in got["p"].markdown and "| a |" in got["p"].markdown
    assert got["b"].markdown.index("First") < got["b"].markdown.index("second")
    assert readers.decode("é".encode("utf-16")) == "é" and readers.decode(b"\xff\xfea") != ""
    line = tmp_path / "chunks.jsonl"
    line.write_text(json.dumps({"chunk_id": "c", "source_id": "s", "ordinal": 1, "text": "a b", "page_start": 0}) + "\n{bad\n" + json.dumps({"chunk_id": "d"}) + "\n")
    good, bad = readers.read_chunks(spark, str(line))
    assert [(r.token_count, r.page_start) for r in good.collect()] == [(2, 1)] and bad.count() == 2


def test_publish(tmp_path):
    target = writers.publish(tmp_path / "out", lambda d: (d / "a.txt").write_text("x"), title="t")
    assert writers.verify(target) == []
    (target / "a.txt").write_text("changed")
    assert writers.verify(target) == ["a.txt"]
    with pytest.raises(RuntimeError):
        writers.publish(target, lambda d: (_ for _ in ()).throw(RuntimeError("no")))
    assert (target / "a.txt").exists() and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_stream(spark, tmp_path):
    from claimspark.streaming.ingest import ingest_stream

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# A\n\none")
    (src / "copy.md").write_text("# A\n\none")
    ingest_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    (src / "b.txt").write_text("two")
    ingest_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_heading_prefix(spark):
    df = spark.createDataFrame([("a", ["Trust", "Audit"], "\n# Trust\n\n  audit \n\nBody\n# Trust"), ("b", None, "# Trust\nx"), ("c", ["Z"], "")], "chunk_id string, heading_path array<string>, text string")
    assert {r.chunk_id: r.text for r in extraction.without_heading_prefix(df).collect()} == {"a": "Body\n# Trust", "b": "# Trust\nx", "c": ""}


def test_serialisers_agree(spark):
    df = spark.createDataFrame([term(0, 'Say "x"\n', definition="d"), term(1, "b", broader=["say x"])], TERM)
    reduced = reduction.reduced_terms(df)
    quads = graph.term_quads(reduced, reduction.term_links(df, reduced), reduction.drafts(df))
    want = {tuple(r) for r in quads.collect()}
    got = set()
    for r in graph.jsonld(quads).collect():
        node = json.loads(r.value)
        got |= {(r.graph, node["@id"], p, v.get("@id") or v["@value"], "uri" if "@id" in v else v.get("@type", "literal")) for p, vs in node.items() if p != "@id" for v in vs}
    assert got == want
    assert sum(r.value.count(" ;\n    ") + 1 for r in graph.turtle(quads).collect()) == len(want)
    split = {tuple(sorted(json.loads(r.value))) for r in graph.jsonld(quads, 1).collect()}
    assert max(map(len, split)) == 2
    ids = [r.term_id for r in graph.with_ids(reduced).collect()]
    assert len(set(ids)) == 2 and all(i.startswith("term:") for i in ids)


def test_settings(tmp_path):
    from claimspark import config

    (tmp_path / "s.yaml").write_text("max_tokens: 900\nbudget_terms: 10\n# note: x\n")
    (tmp_path / ".env").write_text("CLAIMSPARK_MAX_TOKENS=800\nOTHER=1\n")
    got = config.load(tmp_path / "s.yaml", tmp_path / ".env", {"CLAIMSPARK_MAX_TOKENS": "700"})
    assert (got.max_tokens, got.budget_terms, got.overlap_tokens) == (700, 10, 150)
    (tmp_path / "bad.yaml").write_text("nonsense: 1\n")
    for bad in ((tmp_path / "bad.yaml", None, {}), (None, None, {"CLAIMSPARK_MAX_TOKENS": "100"})):
        with pytest.raises(ValueError):
            config.load(*bad)


def test_gateway(spark, tmp_path):
    from claimspark import gateway

    inner = gateway.Scripted({"terms": [["a"]]})
    cached = gateway.Cached(inner, tmp_path, "test")
    assert cached.structured("p", "terms") == ["a"] == cached.structured("p", "terms") and len(inner.calls) == 1
    with pytest.raises(LookupError):
        cached.structured("other", "terms")
    chunks = spark.createDataFrame([("c", "s", "Trust is good.")], CHUNK)
    rows = gateway.extract_with(chunks, lambda x: [{"label": "Trust", "quote": "Trust is good."}, {"label": "X", "quote": "invented"}]).collect()
    assert [r.label for r in rows] == ["Trust"]



def test_resolution_audit_components_in_one_pass(spark, monkeypatch):
    rng = random.Random(4)
    pairs = [(s, *sorted(rng.sample([f"{s}{i:03}" for i in range(300)], 2))) for s in "st" for _ in range(170 if s == "s" else 60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for _, a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {(s, x, find(x)) for s, a, b in pairs for x in (a, b)}
    df = spark.createDataFrame(pairs, "source_id string, a string, b string").distinct()
    # a source of many pairs is split; the other one is not
    assert sorted(map(tuple, resolution._components(df, edges=80).collect())) == sorted(want)
    monkeypatch.setattr(resolution, "forest", None)
    assert sorted(map(tuple, resolution._components(df).collect())) == sorted(want)
    assert resolution._components(df.limit(0)).count() == 0



def drafts_of_names(spark):
    rows = [term(i, label, definition="same words here") for i, label in enumerate(["shared trust model", "shared trust models", "shared trust mode", "central veto", "cental veto", "other thing"])]
    return spark.createDataFrame([*rows, term(9, "broad thing", broader=["Central Veto"], aliases=["other thing"])], TERM)



def test_resolved_clusters_looks_for_no_pair_that_cannot_merge(spark, monkeypatch):
    df, asked, similar = drafts_of_names(spark), [], resolution.similar_names
    monkeypatch.setattr(resolution, "similar_names", lambda names, threshold=resolution.AMBIGUOUS: asked.append(threshold) or similar(names, threshold))
    want = {tuple(r) for r in resolution.resolve(df)[0].collect()}
    occ = runtime.cut(resolution.occurrences(df))
    keyed, decisions = resolution.resolved(df, occ=occ)
    assert asked == [resolution.AMBIGUOUS, resolution.LEXICAL]
    assert {tuple(r) for r in keyed.collect()} == want and len({r[2] for r in want}) < 7
    assert {tuple(r) for r in decisions().collect()} == {tuple(r) for r in resolution.resolve(df)[1].collect()}
    found = {tuple(r) for r in resolution.clusters(df, keyed).collect()}
    monkeypatch.setattr(resolution, "occurrences", None)
    assert {tuple(r) for r in resolution.clusters(df, keyed, occ).collect()} == found



def test_folds_without_decisions_have_the_same_clusters(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(resolution, "definitions_apart", lambda x, y: {x, y} in ({"p", "q"}, {"q", "r"}))
    for _ in range(200):
        names = [rng.sample("abcdefg", rng.choice((1, 1, 2))) for _ in range(12)]
        at = {n: [i for i, x in enumerate(names) if n in x] for n in "abcdefg"}
        close = {i: {j: rng.choice((80.0, 95.0)) for j in range(i + 1, 12) if rng.random() < 0.1} for i in range(12)}
        members = {"names": names, "definition": [rng.choice("pqrst") for _ in names]}
        linked = {tuple(sorted(rng.sample("abcdefg", 2)))}
        roots, decisions = resolution._resolve(members, close, at, linked, 90.0)
        assert resolution._resolve(members, close, at, linked, 90.0, told=False) == (roots, []) and decisions



def test_resolved_terms_and_links_read_the_drafts_once(spark, monkeypatch):
    df = drafts_of_names(spark)
    keyed = runtime.cut(resolution.resolved(df)[0])
    terms, links = reduction.resolved_terms(df, keyed), reduction.resolved_links(df, keyed, reduction.resolved_terms(df, keyed))
    want = {tuple(map(str, r)) for r in terms.collect()}, {tuple(r) for r in links.collect()}
    rows = runtime.cut(reduction.clustered(df, keyed))
    monkeypatch.setattr(reduction, "clustered", None)
    again = reduction.resolved_terms(df, keyed, rows=rows)
    assert ({tuple(map(str, r)) for r in again.collect()}, {tuple(r) for r in reduction.resolved_links(df, keyed, again, rows).collect()}) == want and all(want)


def test_axioms_read_sentences_once(spark):
    text = "Audit is a check. Audit ENABLES trust. \"Fair share\" means equal work. Rules preventſ harm. Audits are checks that cause calm. Cats sleep."
    axioms = extraction.fragments(spark.createDataFrame([("c", "s", 1, text)], "chunk_id string, source_id string, ordinal int, text string")).axioms
    assert axioms._jdf.queryExecution().optimizedPlan().toString().count("posexplode") == 1
    got = sorted((r.item_index, r.modality, r.statement, r.evidence[0].quote == r.statement) for r in axioms.collect())
    assert [r[:2] for r in got] == [(1, "definitional"), (2, "descriptive"), (3, "definitional"), (4, "causal"), (5, "definitional")] and all(r[3] for r in got)
