"""Ontologies, frames, layouts and bundles on small fixtures."""

import functools
import json
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimspark import cli, pipelines
from claimspark.operators import alignment, claims, extraction, frame, graph, layout, reduction, resolution
from claimspark.plans import planted
from claimspark.sources import bundles, readers

TERM = f"term_id bigint, source_id string, fragment_index bigint, term_index int, label string, aliases array<string>, kind string, definition string, broader_labels array<string>, narrower_labels array<string>, related_labels array<string>, confidence double, evidence {claims.EVIDENCE}"
REL = f"source_id string, fragment_index bigint, item_index int, subject_label string, predicate string, object_label string, qualifiers map<string,string>, confidence double, evidence {claims.EVIDENCE}"
AX = f"source_id string, fragment_index bigint, item_index int, statement string, modality string, epistemic_status string, attribution string, conditions array<string>, exceptions array<string>, confidence double, evidence {claims.EVIDENCE}"
MODEL = "source_id string, fragment_index bigint, item_index int, name string, purpose string, " + ", ".join(f"{c} array<string>" for c in claims.LISTS) + f", confidence double, evidence {claims.EVIDENCE}"


def ev(quote="q", source="s", chunk="c", verified=True):
    import hashlib

    return [(source, f"{source}:{chunk}", None, None, None, quote, hashlib.sha256(quote.encode()).hexdigest(), verified)]


def term(f, t, label, confidence=0.9, definition="", aliases=(), broader=(), source="s", evidence=None, kind="concept"):
    return (None, source, f, t, label, list(aliases), kind, definition, list(broader), [], [], confidence, ev(f"{label} {f}") if evidence is None else evidence)


def fragments(spark, terms=(), relations=(), axioms=(), models=(), questions=()):
    make = spark.createDataFrame
    return claims.Fragments(make(list(terms), TERM), make(list(relations), REL), make(list(axioms), AX), make(list(models), MODEL), make(list(questions), "source_id string, fragment_index bigint, question string"))


def axiom(i, statement, modality="causal", confidence=0.8, conditions=(), status="asserted", evidence=None):
    return ("s", i, 0, statement, modality, status, "author", list(conditions), [], confidence, ev(statement or "n") if evidence is None else evidence)


def test_same_label_in_two_fragments_keeps_its_sense(spark):
    terms = [term(0, 0, "Bank", definition="land at the edge of a river"), term(0, 1, "River"), term(1, 0, "Bank", definition="institution that lends money"), term(1, 1, "Money"), term(2, 0, "Loan")]
    relations = [("s", 0, 0, "Bank", "borders", "River", {}, 0.9, ev("r0")), ("s", 1, 0, "bank", "lends", "Money", {"how": "often"}, 0.9, ev("r1")), ("s", 1, 1, "BANK", "Lends ", "money", {"how": "often"}, 0.7, ev("r2")), ("s", 2, 0, "Bank", "gives", "Loan", {}, 0.9, ev("r3")), ("s", 0, 1, "Bank", "has", "nothing", {}, 0.9, ev("r4")), ("s", 0, 2, "Bank", "has", "River", {}, 0.9, ev("r5", verified=False))]
    f = fragments(spark, terms, relations)
    o = claims.build(f, resolution.resolve(f.terms)[0])
    labels = {r.claim_id: r.definition or r.label for r in o.terms.collect()}
    got = {(labels[r.subject_id], r.predicate, labels[r.object_id]): (r.n_evidence, r.confidence, r.qualifier_key) for r in o.relations.collect()}
    # the reference in fragment 2 could mean either bank, so it means none
    assert got == {("land at the edge of a river", "borders", "River"): (1, 0.9, ""), ("institution that lends money", "Lends", "Money"): (2, 0.9, "how=often")} or got == {("land at the edge of a river", "borders", "River"): (1, 0.9, ""), ("institution that lends money", "lends", "Money"): (2, 0.9, "how=often")}
    assert claims.broken_references(o).count() == 0
    # without resolution equal labels are one term
    assert claims.build(f).terms.where("label_key = 'bank'").count() == 1


def test_axioms_models_and_conflicts(spark):
    models = [("s", 0, 0, "Review Model", "short", ["when asked"], [], [], ["a", "b"], [], [], [], 0.8, ev("m0")), ("s", 1, 0, "review-model", "a longer purpose", [" when  asked", "always"], [], [], ["B", "c"], [], [], [], 0.8, ev("m1")), ("s", 2, 0, "!!", "x", *[[]] * 7, 0.8, ev("m2"))]
    axioms = [axiom(0, "Load causes delays"), axiom(1, "Load never causes delay", "descriptive"), axiom(2, "load  causes delays.", confidence=0.9), axiom(3, "weak", confidence=0.2), axiom(4, "Load causes delays", conditions=["at night"]), axiom(5, "unproven", evidence=ev("u", verified=False)), axiom(6, None)]
    o = claims.build(fragments(spark, [term(0, 0, "Load")], axioms=axioms, models=models, questions=[("s", 0, "causes delay"), ("s", 0, "Who?"), ("s", 1, " causes   delay ")]))
    got = {(r.statement, tuple(r.conditions)): (r.n_evidence, r.confidence) for r in o.axioms.collect()}
    assert got == {("load  causes delays.", ()): (2, 0.9), ("Load never causes delay", ()): (1, 0.8), ("Load causes delays", ("at night",)): (1, 0.8)}
    m = o.models.collect()
    assert len(m) == 1 and m[0].purpose == "a longer purpose" and m[0].applicable_when == ["when asked", "always"] and m[0].mechanism == ["a", "b", "c"] and m[0].n_evidence == 2
    c = o.conflicts.collect()
    assert len(c) == 1 and c[0].kind == "causal" and len(c[0].claim_ids) == 3
    assert [r.question for r in o.questions.collect()] == ["causes delay"]
    a = o.abstracts.first()
    assert a.abstract.startswith("load  causes delays.\n\nLoad\n\nReview Model: a longer purpose") and len(a.support_ids) == 5
    assert claims.build(fragments(spark)).abstracts.count() == 0


def test_batches_merge_in_any_tree(spark):
    rows = [term(i, j, label, confidence=0.5 + (i * 7 + j) % 5 / 10, definition=definition, aliases=[f"x{i % 3}", "Y y", "y-Y"]) for i in range(9) for j, (label, definition) in enumerate((("A b", "d"), ("a-b", "D"), ("c", ""), ("c", "other")))]
    df = spark.createDataFrame(rows, TERM)
    keys = ["source_id", "k1", "k2", "k3"]

    def seen(b):
        proof = {tuple(r) for r in b.evidence.select(*keys, "chunk_id", "quote_sha256").collect()}
        return {(r.k1, r.k3, r.label, r.confidence, tuple(sorted(r.aliases))) for r in b.claims.collect()}, proof

    whole = seen(claims.merge_batch(df, "terms"))
    assert len(whole[0]) == 3 and seen(claims.merge_tree(df, "terms", 2)) == whole == seen(claims.merge_tree(df, "terms", 5))
    parts = [claims.merge_batch(df.where(f"fragment_index % 3 = {k}"), "terms") for k in range(3)]
    left, right = claims.merge_batches([claims.merge_batches(parts[:2]), parts[2]]), claims.merge_batches([parts[0], claims.merge_batches(parts[1:])])
    assert seen(left) == seen(right) == whole and claims.new_claims(df, left).count() == 0
    assert claims.new_claims(df.where("label <> 'c'"), left).count() == 2
    for bad in (lambda: claims.merge_tree(df, "terms", 1), lambda: claims.merge_batches([])):
        with pytest.raises(ValueError):
            bad()
    rel = spark.createDataFrame([("s", i, 0, "a", p, "b", {"k": "v", "j": "w"} if i % 2 else {"j": "w", "k": "v"}, 0.5 + i / 10, ev(str(i))) for i, p in enumerate(("Has", "has", "has!"))], REL)
    merged = claims.merge_tree(rel, "relations", 2)
    assert [(r.predicate, r.confidence) for r in merged.claims.collect()] == [("has!", 0.7)] and merged.evidence.count() == 3


def test_quads_and_shapes_of_all_claims(spark):
    models = [("s", 0, 0, "Review Model", "p", ["w"], [], [], ["m"], [], [], [], 0.8, ev("m0"))]
    relations = [("s", 0, 0, "Load", "causes long", "Delay", {"when": "a=b"}, 0.9, ev("r0")), ("s", 0, 1, "Load", "http://x/p", "Delay", {}, 0.9, ev("r1"))]
    o = claims.build(fragments(spark, [term(0, 0, "Load", aliases=["Burden"], broader=["Delay"]), term(0, 1, "Delay")], relations, [axiom(0, "Load causes delays", conditions=["x"]), axiom(1, "Load never causes delays")], models))
    q = graph.ontology_quads(o).collect()
    by = {(r.predicate.split("#")[-1].split(":")[-1].split("/")[-1], r.object) for r in q}
    ids = {r.label: r.claim_id for r in o.terms.collect()}
    load, delay = (graph.BASE + "claim:" + ids[x] for x in ("Load", "Delay"))
    triples = {(r.subject, r.predicate, r.object) for r in q}
    assert (load, graph.BASE + "relation:causes-long", delay) in triples and (load, "http://x/p", delay) in triples and (load, graph.SKOS + "broader", delay) in triples and (delay, graph.SKOS + "narrower", load) in triples
    assert {("qualifierKey", "when"), ("qualifierValue", "a=b"), ("altLabel", "Burden"), ("condition", "x"), ("mechanismStep", "m"), ("applicableWhen", "w"), ("resolution", "unresolved")} <= by
    df = spark.createDataFrame(q)
    assert graph.violations(df, graph.ONTOLOGY_SHAPES).count() == 0
    for path, broken, constraint in ((graph.BASE + "confidence", "7.0000", "range"), (graph.BASE + "verified", "false", "value"), (graph.BASE + "quoteSha256", "ab", "min_length"), (graph.BASE + "statement", "", "min_length")):
        bad = df.withColumn("object", F.when(F.col("predicate") == path, F.lit(broken)).otherwise(F.col("object")))
        assert constraint in {r.constraint for r in graph.violations(bad, graph.ONTOLOGY_SHAPES).collect()}, path
    gone = df.where(F.col("predicate") != graph.PROV + "wasDerivedFrom")
    assert {r.constraint for r in graph.violations(gone, graph.ONTOLOGY_SHAPES).collect()} == {"least"}


@functools.cache
def sample(spark):
    found = extraction.fragments(planted.with_chunks(spark, spark.createDataFrame([], "chunk_id string, source_id string, ordinal int, text string")))
    return claims.build(replace(found, axioms=found.axioms.unionByName(planted.norms(spark))))


def test_inner_states(spark):
    texts = [
        ("It does not claim consciousness", False), ("not only a tool but conscious", True), ("It is sentient; no person", True), ("no doubt it is self-aware", True), ("We study consciousness. It has none", False), ("must\tnot describe subjective experience", False),
        ("not\u00a0a claim of sentience", False), ("", False), (None, False), ("a plain text", False), ("without any personhood and then conscious", False), ("x" * 120 + " conscious", True), ("no " + "y" * 90 + " conscious", True), ("Personhood is given", True),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", frame.asserts_inner_state("t").alias("x")).collect()
    assert {r.i: r.x for r in rows} == {i: x for i, (_, x) in enumerate(texts)}


def test_frame_and_review(spark):
    o = sample(spark)
    f = frame.compose(o, "Readers", "Compare claims.")
    b = {r.proposition: r.status for r in f.beliefs.collect()}
    assert b["Shared Trust is a fair resource."] == b["Shared Trust is not a fair resource."] == "contested" and b["planted-a proposes the model Review Cycle Model for: The Review Cycle Model is a framework for shared trust"] == "conditional"
    assert "Shared Trust enables audit load." in b and f.desires.where("origin = 'source_norm'").count() == 2
    assert {r.kind for r in f.intentions.collect()} == {"deliberate", "apply", "surface"}
    assert f.links.where("kind = 'belief'").join(f.intentions.where("kind = 'deliberate'"), "intention_id").count() == 12
    same, found, approved = frame.review(f, o)
    assert approved and found.count() == 0 and same is f
    bad = replace(f, beliefs=f.beliefs.withColumn("status", F.lit("accepted")))
    fixed, found, approved = frame.review(bad, o)
    assert approved and {r.status for r in fixed.beliefs.collect()} == {"accepted", "contested", "conditional"} and fixed.policy.first().frame_id == f.policy.first().frame_id
    _, found, approved = frame.review(bad, o, max_repairs=0)
    assert not approved and {"suppressed_disagreement", "missing_contested_conflict_belief", "noncanonical_beliefs"} <= {r.code for r in found.collect()}
    _, found, approved = frame.review(f, o, critic=lambda x: (False, []))
    assert not approved and [r.code for r in found.collect()] == ["model_critic_rejected"]
    with pytest.raises(ValueError):
        frame.review(f, o, max_repairs=2)
    for bad in (lambda: frame.compose(o, " ", "x"), lambda: frame.compose(o, "x", " ")):
        with pytest.raises(ValueError):
            bad()
    text = frame.system_prompt(f)
    assert "Compare claims." in text and "[contested]" in text and len(frame.tool_manifest()) == 5
    assert {"missing_grounded_beliefs", "missing_conflict_belief"} <= {r.code for r in frame.findings(replace(f, beliefs=f.beliefs.limit(0)), o).collect()}


def test_cross_source_conflicts_of_many_sources(spark):
    """Thousands of statements of one direction over many sources; the pairs that are opposed lie across sources, within one, or both."""
    rng = random.Random(7)
    nouns = [f"noun{i}x" for i in range(60)]
    texts = sorted({" ".join([*rng.sample(nouns, 4), "improves", *rng.sample(nouns, 3)]) for _ in range(12_000)})
    rows = [(f"s{i % 300}", f"axiom:{i:05}", s, "causal") for i, s in enumerate(texts)]
    rows += [("s1", "axiom:a", "Late audits harm thin data", "causal"), ("s1", "axiom:b", "Late audits improve thin data", "causal"), ("s2", "axiom:c", "Late audits improve thin data", "causal"), ("s3", "axiom:d", "Dull votes never bind crews", "causal"), ("s3", "axiom:e", "Dull votes bind crews", "causal")]
    df = spark.createDataFrame(rows, "source_id string, claim_id string, statement string, modality string")
    began = time.monotonic()
    assert [(r.left_id, r.right_id) for r in alignment.opposed_claims(df).collect()] == [("axiom:a", "axiom:c")]
    assert time.monotonic() - began < 40  # all with all are 70 million pairs


def test_alignment_checks(spark):
    o = sample(spark)
    cls = alignment.classes(o.terms.select("source_id", "label_key", "definition"))
    mapped = alignment.mappings(cls)
    assert alignment.complementarities(mapped).count() == mapped.where("kind = 'related_or_analogous'").count()
    ids = [r.class_id for r in cls.orderBy("class_id").collect()]
    one = {r.first_source: r.class_id for r in cls.where("n_sources = 1").collect()}
    same = [r.class_id for r in cls.where(f"first_source = '{planted.A}' and n_sources = 1").limit(2).collect()]
    given = spark.createDataFrame([(ids[0], "none", "broader", 0.5), ("none", ids[0], "narrower", 0.5), (ids[1], ids[1], "broader", 0.5), (same[0], same[1], "broader", 0.5), (one[planted.A], one[planted.B], "sort of", 0.5), (one[planted.B], one[planted.A], "broader", 0.5)], "left_id string, right_id string, kind string, confidence double")
    sound, problems = alignment.given_mappings(given, cls)
    assert {r.problem for r in problems.collect()} == {"dangling_left", "dangling_right", "itself", "same_source", "unknown_kind"} and sound.count() == 1
    cross = alignment.opposed_claims(o.axioms)
    assert cross.count() >= 1
    twice = o.conflicts.unionByName(o.conflicts)
    united = alignment.united_conflicts(twice, cross, mapped).collect()
    assert len({r.conflict_id for r in united}) == len(united) and sum(r.origin == "declared" for r in united) == 2


def test_adjudicator_answers(spark):
    assert [resolution.verdict(x) for x in (True, "Merge ", "no", {"merge": True}, {"decision": "distinct"}, None, type("A", (), {"decision": "same"})())] == [True, True, False, True, False, False, True]
    asked = []

    def ask(left, right, score):
        asked.append((left["names"], right["names"]))
        return {"decision": "merge"}

    members = __import__("pandas").DataFrame({"names": [["cautious autonomy"], ["cautious autonomy veto"], ["cautious autonomy"], ["cautious autonomy veto"]], "definition": [None, None, "x y", "x y"]})
    at = {"cautious autonomy": [0, 2], "cautious autonomy veto": [1, 3]}
    roots, decisions = resolution._resolve(members, {0: {1: 87.0, 3: 87.0}, 1: {2: 87.0}, 2: {3: 87.0}}, at, set(), 90.0, ask)
    assert roots == [0, 0, 0, 0] and len(asked) == 1
    # k members of one name give at most two rows each
    rng = random.Random(5)
    many = __import__("pandas").DataFrame({"names": [["bank"]] * 40, "definition": [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(3)) for i in range(40)]})
    roots, decisions = resolution._resolve(many, {}, {"bank": list(range(40))}, set(), 90.0)
    assert len(set(roots)) > 20 and len(decisions) <= 78 and {d[1] for d in decisions} == set(range(1, 40))


def test_cluster_ids(spark):
    rows = [term(0, 0, "Audit", definition="d"), term(1, 0, "audit", definition="D"), term(0, 0, "Audit", source="t", definition="d"), term(1, 0, "Audits", source="t", definition="d")]
    df = spark.createDataFrame(rows, TERM)
    got = {r.source_id: r for r in resolution.clusters(df, resolution.resolve(df)[0]).collect()}
    assert (got["s"].canonical_label, got["s"].n_labels, got["s"].n_occurrences) == ("Audit", 2, 2) and got["s"].cluster_id != got["t"].cluster_id
    one = spark.createDataFrame([term(5, 3, "AUDIT", definition="d")], TERM)
    assert resolution.clusters(one, resolution.resolve(one)[0]).first().cluster_id == got["s"].cluster_id


def test_fold_label_widths(spark):
    from claimspark.functions.columns import fold_label
    from claimspark.functions.text import fold

    words = ["Ｓｈａｒｅｄ　Ｔｒｕｓｔ", "ﬁne Straße", "ΛΌΓΟΣ λόγος", "a_b-c", " ", None, "ſo"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(fold_label("w")).collect()
    assert [r[0] for r in got] == [None if w is None else fold(w) for w in words]


def test_canonical_documents(spark):
    md = "# T\n\none\n\n## S\n\n- item\n\n| a | b\\|c |\n|---|---|\n| 1 | 2 |\n\n```\nx\n\ny\n```"
    df = spark.createDataFrame([("d", "s", md), ("e", "s", None), ("f", "s", "")], "conversion_id string, source_id string, markdown string")
    made = layout.canonical_documents(df)
    blocks = layout.layout_blocks(made).orderBy("conversion_id", "block_no").collect()
    from claimspark.operators.chunking import blocks_of

    assert [(r.label, r.level, tuple(r.heading_path)) for r in blocks] == [(b[0], b[1], b[3]) for b in blocks_of(md)] and json.loads(made.where("conversion_id = 'd'").first().canonical)["identity"] == {"key": "d", "source_id": "s"}
    assert layout.stamped({"schema_name": "other"}, a="b") == {"schema_name": "other"}
    raw = spark.createDataFrame([("p", "s", planted.LAYOUT), ("q", "s", "{bad"), ("r", "s", None), ("t", "s", "[]"), ("u", "s", '{"texts": [{"text": "only"}], "tables": [{"data": {"table_cells": [{"start_row_offset_idx": 1, "start_col_offset_idx": 1, "text": "x"}]}}]}')], "conversion_id string, source_id string, canonical string")
    chunks = layout.chunk_layout(raw).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.page_start, r.page_end) for r in chunks if r.conversion_id == "p"] == [("p:chunk:000001", None, None), ("p:chunk:000002", 1, 4)]
    assert {r.conversion_id for r in layout.layout_blocks(raw).where("error is not null").collect()} == {"q", "t"}
    assert [r.text for r in chunks if r.conversion_id == "u"] == ["only\n\n|  |  |\n| --- | --- |\n|  | x |"]
    assert layout.chunk_layout(raw.limit(0)).count() == 0
    with pytest.raises(ValueError):
        layout.chunk_layout(raw, 5, 5)


def test_epub_assets():
    import io
    import zipfile

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:x"><rootfiles><rootfile full-path="o/c.opf"/></rootfiles></container>')
        items = "".join(f'<item id="i{k}" href="{h}" media-type="image/png"/>' for k, h in enumerate(("img/a.png", "more/a.png", "same/a.png")))
        z.writestr("o/c.opf", f'<package xmlns="urn:y"><manifest><item id="1" href="t/a.xhtml" media-type="application/xhtml+xml"/>{items}</manifest><spine><itemref idref="1"/></spine></package>')
        z.writestr("o/t/a.xhtml", '<h1>T</h1><p><img src="../img/a.png" alt="x"/><img src="../more/a.png"/><img src="../../../z.png"/><img src="http://h/i.png"/></p>')
        for name, body in (("img", b"1"), ("more", b"2"), ("same", b"1")):
            z.writestr(f"o/{name}/a.png", body)
    assets = readers.epub_assets(raw.getvalue())
    assert [n for _, n, _ in assets][0] == "a.png" and assets[1][1].startswith("a-") and len(assets) == 3
    text = readers.epub_chapters(raw.getvalue())[0][2]
    assert "![x](assets/a.png)" in text and f"(assets/{assets[1][1]})" in text and "(../../../z.png)" in text and "(http://h/i.png)" in text
    assert readers.member_path("a/b", "../c") == "a/c" and readers.member_path("a", "../../c") is None and readers.member_path("./") is None and readers.member_path("a\\..\\b") == "b"
    assert readers.tidy("a  \r\n\n\n\n b\t\n\n") == "a\n\n b"


def test_pipelines_and_bundles(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.md").write_text("# Notes\n\n" + planted.CHUNKS[0][3])
    (src / "b.txt").write_text(planted.CHUNKS[2][3])
    (src / "c.pdf").write_bytes(b"%PDF")
    out = str(tmp_path / "out")
    assert cli.main(["build", str(src), out, "Readers", "Compare claims."]) == 0
    shown = json.loads(capsys.readouterr().out)
    assert [b["kind"] for b in shown["bundles"]] == ["chunks", "ontology", "frame"] and shown["bundles"][0]["rows"]["rejected"] == 1
    # the same inputs and settings use what is there
    first = bundles.manifest_of(spark, f"{out}/ontology")["version"]
    assert pipelines.extract(spark, pipelines.checked_chunks(spark, f"{out}/chunks"), f"{out}/ontology")["version"] == first
    assert pipelines.extract(spark, pipelines.checked_chunks(spark, f"{out}/chunks"), f"{out}/ontology", cap=1)["version"] != first
    assert cli.main(["validate", f"{out}/ontology"]) == 0 and cli.main(["ask", f"{out}/ontology", "What is shared trust?"]) == 0
    answer = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert answer["evidence"] and answer["evidence"][0]["claim_id"]
    o = bundles.load_ontology(spark, f"{out}/ontology")
    assert bundles.load_frame(spark, f"{out}/frame").policy.count() == 1
    bundles.export_quads(spark, f"{out}/ontology", str(tmp_path / "nq"))
    assert {graph.parse_nquad(r.value) for r in spark.read.text(str(tmp_path / "nq")).collect()} == {tuple(r) for r in bundles.table(spark, f"{out}/ontology", "quads").collect()}
    with pytest.raises(bundles.NotConforming):
        bundles.publish_ontology(spark, f"{out}/bad", replace(o, links=spark.createDataFrame([("s", "term:x", "broader", "term:none")], o.links.schema)))
    assert bundles.manifest_of(spark, f"{out}/bad") is None
    with pytest.raises(bundles.Rejected):
        pipelines.synthesize(spark, [f"{out}/ontology"], f"{out}/no", "R", "x", critic=lambda f: (False, []))
    # a table that changed is found
    version = bundles.manifest_of(spark, f"{out}/chunks")["version"]
    spark.createDataFrame([("x", "unknown", 1, "t")], "chunk_id string, source_id string, ordinal int, text string").write.mode("overwrite").parquet(f"{out}/chunks/{version}/chunks")
    assert bundles.damaged(spark, f"{out}/chunks") == ["chunks"]
    with pytest.raises(ValueError):
        pipelines.checked_chunks(spark, f"{out}/chunks")
    assert bundles.damaged(spark, str(tmp_path / "nothing")) == ["current.json"] and pipelines.identity_of(object()) != pipelines.identity_of(object())
    with pytest.raises(SystemExit):
        cli.main(["pdf-to-markdown", "x", "y"])


def test_media_types(spark):
    paths = ["a.PDF", "b.md", "c.png", "d.unknown", None, "noext"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(readers.media_type_of("p")).collect()]
    assert got == ["application/pdf", "text/markdown", "image/png", "application/octet-stream", "application/octet-stream", "application/octet-stream"]


def test_question_anchors(spark):
    evidence = spark.createDataFrame([("s", "Who audits the auditors of trust?"), ("t", "Who audits the auditors of trust?"), ("s", None)], "source_id string, quote string")
    asked = spark.createDataFrame([("s", "audits the auditors of"), ("s", "its the audit"), ("s", "trust?"), ("t", "Why?"), ("s", "the auditors of trust??")], "source_id string, question string")
    assert {tuple(r) for r in claims.grounded_questions(asked, evidence).collect()} == {("s", "audits the auditors of"), ("s", "its the audit"), ("s", "trust?")}


def test_reduction_constants():
    assert set(reduction.BUDGETS) == {"terms", "relations", "axioms", "mental_models"}


def test_strict_grounding_and_coercion(spark, tmp_path):
    import hashlib

    from claimspark.operators import grounding

    h = lambda q: hashlib.sha256(q.encode()).hexdigest()
    chunks = spark.createDataFrame([("c", "s", "one two\nthree")], "chunk_id string, source_id string, text string")
    rows = spark.createDataFrame([(1, "c", "two", h("two")), (2, "c", "two three", None), (3, "zz", "two", None)], "evidence_id bigint, chunk_id string, quote string, quote_sha256 string")
    assert {r.evidence_id for r in grounding.ground(rows, chunks).collect()} == {1} and {r.evidence_id for r in grounding.ground(rows, chunks, loose=True).collect()} == {1, 2}
    assert grounding.ground(rows.where("evidence_id < 3"), chunks, strict=True, loose=True).count() == 2
    with pytest.raises(grounding.Ungrounded):
        grounding.ground(rows, chunks, strict=True)
    given = spark.createDataFrame([(None, "body text", 0, None), ("own", None, 3, None), (None, "body text", 0, None)], "chunk_id string, body string, page_start int, page_end int")
    got = readers.coerced_chunks(given, "src").collect()
    assert [(r.chunk_id, r.source_id, r.page_start, r.page_end, r.heading_path) for r in got] == [("chunk-" + h("body text")[:16], "src", 1, 1, [])]
    with pytest.raises(ValueError):
        readers.coerced_chunks(given.drop("body"))
    (tmp_path / "c.jsonl").write_text('{"chunk_id": "a", "source_id": "s", "ordinal": 1, "text": "x"}\n\n{bad\n{"chunk_id": "b"}\n[]\n')
    assert [(r.line_no, r.problem.split(":")[0]) for r in readers.bad_lines(spark, str(tmp_path / "c.jsonl")).orderBy("line_no").collect()] == [(3, "not JSON"), (4, "missing source_id, ordinal, text"), (5, "missing chunk_id, source_id, ordinal, text")]


def test_canonical_files_and_small_files(spark, tmp_path):
    from claimspark import gateway
    from claimspark.functions import text
    from claimspark.sources import writers

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text(planted.LAYOUT)
    (src / "b.md").write_text("# T\n\nx")
    (src / "c.pdf").write_bytes(b"%PDF")
    got = {r.source_id.rsplit("-", 1)[0]: r.label for r in layout.layout_blocks(readers.read_canonical(spark, str(src))).where("block_no = 1").collect()}
    assert got == {"a": "title", "b": "section_header"}
    for kind, value, want in (("json", {"b": 1}, '{\n  "b": 1\n}\n'), ("canonical", {"b": 1, "a": None}, '{"a":null,"b":1}'), ("jsonl", [{"a": 1}, 2], '{"a":1}\n2\n'), ("yaml", {"a": "x"}, 'a: "x"\n'), ("text", "t", "t"), ("bytes", b"z", "z")):
        path = writers.store(tmp_path / "d" / kind, value, kind)
        before = path.stat().st_mtime_ns
        assert path.read_text() == want and writers.store(path, value, kind).stat().st_mtime_ns == before
    (tmp_path / "link").symlink_to(tmp_path / "d" / "text")
    for bad in (tmp_path / "link", tmp_path / "d" / ".." / "x"):
        with pytest.raises(ValueError):
            writers.store(bad, "x", "text")
    g = gateway.Scripted({"k": [1]}, standing={"k": 2}, named={"Ann": 3})
    assert [g.structured("p", "k"), g.structured("p", "k"), g.structured("for Ann", "x")] == [1, 2, 3]
    assert text.ontology_id("A b", ["y", "x"]) == text.ontology_id("A b", ["x", "y", "x"]) and text.frame_id("n", "o", ["a"]) != text.frame_id("n", "p", ["a"])
    assert text.without_nulls({"a": None, "b": {"c": None, "d": [None]}}) == {"b": {"d": [None]}}


def test_integration_graph(spark, monkeypatch):
    o = sample(spark)
    q = spark.createDataFrame(graph.ontology_quads(o).collect())
    expected = q.select("graph").distinct()
    assert graph.named_graphs(q, expected) is q and graph.dataset_id(q) == graph.dataset_id(q.repartition(7))
    with pytest.raises(ValueError):
        graph.named_graphs(q, expected.limit(1))
    lines = [r.value for r in graph.trig(q).collect()]
    assert lines and all(x.startswith("GRAPH <urn:claimspark:source:planted-") and x.endswith(" . }") for x in lines)
    claim = o.axioms.first()
    made = spark.createDataFrame([("b1", claim.source_id, "axiom", claim.claim_id, "both", "synthesized", "derived", 0.5)], "belief_id string, source_id string, kind string, support string, proposition string, status string, origin string, confidence double")
    assert graph.derived_quads(made, o.axioms).count() == 3
    for bad in (made.withColumn("support", F.lit("none")), made.withColumn("belief_id", F.lit(claim.claim_id))):
        with pytest.raises(ValueError):
            graph.derived_quads(bad, o.axioms)
    united = alignment.united_conflicts(o.conflicts, alignment.opposed_claims(o.axioms), alignment.mappings(alignment.classes(o.terms.select("source_id", "label_key", "definition"))))
    assert graph.conflict_quads(united).where(F.col("predicate") == graph.BASE + "conflictKind").count() == united.count()
    f = frame.compose_with(o, "Readers", "Compare.", lambda p: {"role": "Another.", "frame_id": "x"})
    assert f.policy.first().role == "Another." and f.policy.first().frame_id != "x"
    monkeypatch.setattr(frame, "compose", lambda *a: f)
    for change in ({"objective": "Other."}, {"nonsense": 1}):
        with pytest.raises(ValueError):
            frame.compose_with(o, "Readers", "Compare.", lambda p, change=change: change)
