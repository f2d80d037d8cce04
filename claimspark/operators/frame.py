"""Belief, desire and intention rows over the claims of ontologies, their ledger and checks.

One objective comes from the operator; statements of sources become beliefs
with their support, never objectives.  Each kind of row is a projection, a check
is a DataFrame of findings, and a frame is a bundle of such DataFrames with one
row of policy.

Defined results: claims without confidence keep null; claims that stand in a
conflict are contested; an empty ontology gives a frame with the desires only,
which the checks report.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators.claims import SEPARATOR, Ontology
from claimspark.runtime import cut

# Words that claim an inner state, what separates clauses, and what before such a word denies or studies it.
STATUS = r"\b(?:conscious(?:ness)?|sentien(?:t|ce)|person(?:hood)?|self[- ]aware(?:ness)?|subjective experience|inner experience)\b"
CLAUSE_ENDS = r"[.;\n]+"
STRESSED = r"\bnot\s+only\b"
DENIALS = (
    r"\bno\b(?!\s+doubt\b).{0,60}$",
    r"\bwithout\b.{0,50}$",
    r"\b(?:do|does|must|should)\s+not\b.{0,80}\b(?:claim|assert|imply|present|describe)\b.{0,35}$",
    r"\bcannot\b.{0,60}\b(?:claim|assert|imply|present|describe)\b.{0,35}$",
    r"\bnot\s+(?:a\s+(?:claim|assertion|statement)\s+of\s+)?$",
    r"\b(?:analy[sz]e|study|discuss|research|evaluate|explain|compare|reason\s+about)\b.{0,60}$",
)
BEFORE = 100
FIRST_BELIEFS = 12
CONDITIONAL = ("conditional", "hypothetical", "reported")
PARTS = ("beliefs", "desires", "intentions", "models")


def asserts_inner_state(text: Column | str) -> Column:
    """Whether a text claims an inner state: some such word in a clause that nothing before it in the clause denies."""
    c = F.col(text) if isinstance(text, str) else text
    flags = "(?iU)"

    def claimed(clause: Column) -> Column:
        words = F.regexp_extract_all(clause, F.lit(flags + STATUS), F.lit(0))
        between = F.split(clause, flags + STATUS)

        def open_(k: Column) -> Column:
            # all of the clause before its k-th such word
            ahead = F.array_join(F.transform(F.sequence(F.lit(1), k), lambda j: F.concat(F.get(between, j - 1), F.when(j < k, F.get(words, j - 1)).otherwise(F.lit("")))), "")
            near = F.right(ahead, F.lit(BEFORE))
            denied = F.lit(False)
            for d in DENIALS:
                denied = denied | F.regexp_like(near, F.lit(flags + d))
            return F.regexp_like(near, F.lit(flags + STRESSED)) | ~denied

        return F.when(F.size(words) > 0, F.exists(F.sequence(F.lit(1), F.size(words)), open_)).otherwise(F.lit(False))

    return F.coalesce(F.exists(F.split(c, CLAUSE_ENDS), claimed), F.lit(False))


@dataclass
class Frame:
    """beliefs, desires, intentions, links (intention_id, kind, target), models (model_id) and one row of policy."""

    beliefs: DataFrame
    desires: DataFrame
    intentions: DataFrame
    links: DataFrame
    models: DataFrame
    policy: DataFrame


def _id(prefix: str, *parts: Column | str) -> Column:
    cols = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts]
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws(SEPARATOR, *cols), 256), 1, 16))


def beliefs(o: Ontology, contested: DataFrame) -> DataFrame:
    """(belief_id, source_id, kind, support, proposition, status, origin, confidence) of every claim.

    contested: (source_id, claim_id) of claims that stand in a conflict.
    """
    names = cut(o.terms.select("source_id", F.col("claim_id").alias("id"), "label"))
    end = lambda c: names.select("source_id", F.col("id").alias(f"{c}_id"), F.col("label").alias(f"{c}_label"))
    r = o.relations.join(end("subject"), ["source_id", "subject_id"], "left").join(end("object"), ["source_id", "object_id"], "left")
    part = lambda df, kind, text, status: df.select("source_id", F.lit(kind).alias("kind"), F.col("claim_id").alias("support"), text.alias("proposition"), status.alias("status"), "confidence")
    accepted = F.lit("accepted")
    rows = part(o.terms, "term", F.concat_ws(": ", "label", "definition"), accepted)
    rows = rows.unionByName(part(o.axioms, "axiom", F.col("statement"), F.when(F.col("epistemic_status") == "contested", "contested").when(F.col("epistemic_status").isin(*CONDITIONAL), "conditional").otherwise(accepted)))
    rows = rows.unionByName(part(r, "relation", F.concat(F.coalesce("subject_label", "subject_id"), F.lit(" "), "predicate", F.lit(" "), F.coalesce("object_label", "object_id"), F.lit(".")), accepted))
    rows = rows.unionByName(part(o.models, "model", F.concat("source_id", F.lit(" proposes the model "), "name", F.lit(" for: "), F.coalesce("purpose", F.lit(""))), F.lit("conditional")))
    hit = contested.select("source_id", F.col("claim_id").alias("support"), F.lit(True).alias("hit")).distinct()
    met = rows.join(hit, ["source_id", "support"], "left")
    return met.select(_id("belief", "source_id", "support", "proposition").alias("belief_id"), "source_id", "kind", "support", "proposition", F.when(F.col("hit"), "contested").otherwise(F.col("status")).alias("status"), F.lit("source").alias("origin"), "confidence").distinct()


OBJECTIVE_ID, PROVENANCE_ID, CONFLICTS_ID = "objective", "provenance", "conflicts"
_DESIRE = "desire_id string, goal string, origin string, priority int, parent string, source_id string, claim_id string"


def desires(spark: SparkSession, objective: str, norms: DataFrame | None = None) -> DataFrame:
    """(desire_id, goal, origin, priority, parent, source_id, claim_id): the objective, its procedural subgoals and one row for each norm of a source.

    norms: (source_id, claim_id, statement) of normative axioms; they are recorded, never adopted.
    """
    if not objective or not objective.strip():
        raise ValueError("an objective is required")
    rows = [
        (OBJECTIVE_ID, objective.strip(), "operator_objective", 5, None, None, None),
        (PROVENANCE_ID, "Ground every answer in verified evidence.", "synthesized_subgoal", 5, OBJECTIVE_ID, None, None),
        (CONFLICTS_ID, "Keep every position of a conflict visible.", "synthesized_subgoal", 4, OBJECTIVE_ID, None, None),
    ]
    base = spark.createDataFrame(rows, _DESIRE)
    if norms is None:
        return base
    each = norms.select(_id("norm", "source_id", "claim_id").alias("desire_id"), F.col("statement").alias("goal"), F.lit("source_norm").alias("origin"), F.lit(2).alias("priority"), F.lit(None).cast("string").alias("parent"), "source_id", "claim_id").distinct()
    return base.unionByName(each)


def intentions(o: Ontology, conflicts: DataFrame) -> DataFrame:
    """(intention_id, kind, source_id, subject, stop): deliberate, apply each model, surface each conflict.

    conflicts: (source_id, conflict_id, ...).
    """
    stop = F.lit("Stop where the evidence ends.").alias("stop")
    row = lambda df, kind, subject: df.select(_id(kind, "source_id", subject).alias("intention_id"), F.lit(kind).alias("kind"), "source_id", F.col(subject).alias("subject"), stop)
    spark = o.models.sparkSession
    first = spark.createDataFrame([(None, OBJECTIVE_ID)], "source_id string, subject string")
    return row(first, "deliberate", "subject").unionByName(row(o.models, "apply", "claim_id")).unionByName(row(conflicts, "surface", "conflict_id")).distinct()


def intention_links(rows: DataFrame, belief_rows: DataFrame, conflicts: DataFrame) -> DataFrame:
    """(intention_id, kind, target): the beliefs, desires and models that an intention rests on; deliberation starts from the first twelve beliefs."""
    order = F.when(F.col("kind") == "term", 0).when(F.col("kind") == "axiom", 1).when(F.col("kind") == "relation", 2).otherwise(3)
    first = belief_rows.orderBy("source_id", order, "belief_id").limit(FIRST_BELIEFS).select("belief_id")
    deliberate = first.select(_id("deliberate", F.lit(None).cast("string"), F.lit(OBJECTIVE_ID)).alias("intention_id"), F.lit("belief").alias("kind"), F.col("belief_id").alias("target")).join(rows.select("intention_id").distinct(), "intention_id", "left_semi")
    by = belief_rows.select("source_id", F.col("support").alias("claim_id"), "belief_id")
    models = rows.where("kind = 'apply'").select("intention_id", "source_id", F.col("subject").alias("claim_id"))
    sides = rows.where("kind = 'surface'").select("intention_id", "source_id", F.col("subject").alias("conflict_id")).join(conflicts.select("source_id", "conflict_id", F.explode("claim_ids").alias("claim_id")), ["source_id", "conflict_id"])
    about = models.unionByName(sides.select("intention_id", "source_id", "claim_id")).join(by, ["source_id", "claim_id"]).select("intention_id", F.lit("belief").alias("kind"), F.col("belief_id").alias("target"))
    goals = rows.select("intention_id", F.explode(F.when(F.col("kind") == "deliberate", F.array(F.lit(OBJECTIVE_ID), F.lit(PROVENANCE_ID), F.lit(CONFLICTS_ID))).when(F.col("kind") == "surface", F.array(F.lit(CONFLICTS_ID), F.lit(OBJECTIVE_ID))).otherwise(F.array(F.lit(OBJECTIVE_ID)))).alias("target")).select("intention_id", F.lit("desire").alias("kind"), "target")
    return deliberate.unionByName(about).unionByName(goals).unionByName(models.select("intention_id", F.lit("model").alias("kind"), F.col("claim_id").alias("target"))).distinct()


#: What every frame says of itself; texts of our own.
POLICY = {
    "role": "Answers from the ontologies of its sources, for the operator's objective.",
    "stance": "instrumental",
    "sentience_claim": False,
    "deliberation_cycle": ["Read the task against the objective.", "Retrieve claims and their verified evidence.", "List the conflicts that matter.", "Choose a model that applies, or none.", "Draft conclusions.", "Test conditions, exceptions and failure modes.", "Answer."],
    "model_selection_policy": "Use a model only where its conditions hold, and name them.",
    "evidence_policy": "Cite the quotation of each claim; add no knowledge that no source states.",
    "conflict_policy": "Give every position of a conflict with its source.",
    "uncertainty_policy": "State confidence and what evidence is missing.",
    "answer_contract": ["Result first.", "Source claims, synthesis and uncertainty in parts of their own.", "A citation for every source claim."],
    "capabilities": ["Look up concepts by source.", "Trace a claim to its quotations.", "Compare positions of sources."],
    "limitations": ["Knows its sources only.", "Cannot settle a conflict without new evidence."],
    "anti_goals": ["Never hide a disagreement.", "Never adopt a source's norm as the objective.", "Never invent a citation."],
}
_POLICY = "frame_id string, name string, objective string, role string, stance string, sentience_claim boolean, deliberation_cycle array<string>, model_selection_policy string, evidence_policy string, conflict_policy string, uncertainty_policy string, answer_contract array<string>, capabilities array<string>, limitations array<string>, anti_goals array<string>"


def contested_claims(conflicts: DataFrame) -> DataFrame:
    return conflicts.select("source_id", F.explode("claim_ids").alias("claim_id")).distinct()


def compose(o: Ontology, name: str, objective: str, conflicts: DataFrame | None = None) -> Frame:
    """The frame that the claims determine; conflicts default to those of the ontology."""
    if not name or not name.strip():
        raise ValueError("a name is required")
    spark = o.terms.sparkSession
    against = cut((o.conflicts if conflicts is None else conflicts).select("source_id", "conflict_id", "claim_ids"))
    b = cut(beliefs(o, contested_claims(against)))
    d = desires(spark, objective, o.axioms.where("modality = 'normative'").select("source_id", "claim_id", "statement"))
    i = cut(intentions(o, against))
    # the sources' identity without a list of them
    mark = o.abstracts.select("source_id").distinct().agg(F.coalesce(F.bit_xor(F.conv(F.substring(F.sha2("source_id", 256), 1, 15), 16, 10).cast("bigint")), F.lit(0))).first()[0]
    import hashlib

    ident = "frame-" + hashlib.sha256(SEPARATOR.join((name.strip(), objective.strip(), str(mark))).encode()).hexdigest()[:16]
    row = {"frame_id": ident, "name": name.strip(), "objective": objective.strip(), **POLICY}
    return Frame(b, d, i, intention_links(i, b, against), o.models.select("source_id", F.col("claim_id").alias("model_id")), spark.createDataFrame([tuple(row[c.split()[0]] for c in _POLICY.split(", "))], _POLICY))


def compose_with(o: Ontology, name: str, objective: str, proposed: Callable[[dict], dict], conflicts: DataFrame | None = None) -> Frame:
    """A frame whose policy someone else words: ``proposed`` gets the policy row and returns what it changes.

    Name, objective, stance and identifier stay those of the composition.
    """
    f = compose(o, name, objective, conflicts)
    row = f.policy.first().asDict()
    change = proposed(dict(row))
    kept = {"name", "objective", "stance", "sentience_claim"}
    if unknown := set(change) - set(row):
        raise ValueError(f"unknown parts of a policy: {sorted(unknown)}")
    if lost := [k for k in kept if k in change and change[k] != row[k]]:
        raise ValueError(f"must be preserved: {sorted(lost)}")
    row |= {k: v for k, v in change.items() if k != "frame_id"}
    return replace(f, policy=f.policy.sparkSession.createDataFrame([tuple(row[c.split()[0]] for c in _POLICY.split(", "))], _POLICY))


def ledger(f: Frame) -> DataFrame:
    """(object_id, kind, origin, support) of every ascription."""
    b = f.beliefs.select(F.col("belief_id").alias("object_id"), F.lit("belief").alias("kind"), "origin", "support")
    d = f.desires.select(F.col("desire_id").alias("object_id"), F.lit("desire").alias("kind"), "origin", F.coalesce("parent", "claim_id").alias("support"))
    i = f.intentions.select(F.col("intention_id").alias("object_id"), F.lit("intention").alias("kind"), F.lit("instrumental_policy").alias("origin"), F.col("subject").alias("support"))
    return b.unionByName(d).unionByName(i)


def texts(f: Frame) -> DataFrame:
    """(object_id, text) of everything that defines behaviour; beliefs and norms of sources don't."""
    p = f.policy
    lists = [c for c, t in p.dtypes if t == "array<string>"]
    plain = ["name", "role", "model_selection_policy", "evidence_policy", "conflict_policy", "uncertainty_policy"]
    own = p.select(F.col("frame_id").alias("object_id"), F.explode(F.concat(F.array(*plain), *[F.coalesce(c, F.array().cast("array<string>")) for c in lists])).alias("text"))
    goals = f.desires.where("origin <> 'source_norm'").select(F.col("desire_id").alias("object_id"), F.col("goal").alias("text"))
    return own.unionByName(goals).unionByName(f.intentions.select(F.col("intention_id").alias("object_id"), F.col("stop").alias("text")))


_FINDING = "code string, severity string, object_id string, repairable boolean"


def findings(f: Frame, o: Ontology, conflicts: DataFrame | None = None, canonical: Frame | None = None) -> DataFrame:
    """(code, severity, object_id, repairable) of everything that makes a frame unfit; a rule is a DataFrame each."""
    spark = f.policy.sparkSession
    against = o.conflicts if conflicts is None else conflicts
    claims = cut(o.terms.select("source_id", "claim_id").unionByName(o.relations.select("source_id", "claim_id")).unionByName(o.axioms.select("source_id", "claim_id")).unionByName(o.models.select("source_id", "claim_id")))
    b, d, i, links = cut(f.beliefs), cut(f.desires), cut(f.intentions), cut(f.links)
    policy = f.policy.first()
    frame_id = F.lit(policy["frame_id"]).alias("frame_id")
    out = spark.createDataFrame([], _FINDING)

    def add(rows: DataFrame, code: str, key: str, repairable: bool) -> None:
        nonlocal out
        out = out.unionByName(rows.select(F.lit(code).alias("code"), F.lit("error").alias("severity"), F.col(key).alias("object_id"), F.lit(repairable).alias("repairable")))

    def when_empty(rows: DataFrame, code: str, repairable: bool = False) -> None:
        add(rows.limit(1).agg(F.count("*").alias("n")).where("n = 0").select(frame_id), code, "frame_id", repairable)

    add(f.policy.where("objective is null or trim(objective) = ''"), "objective_missing", "frame_id", False)
    objective = d.where("origin = 'operator_objective'").agg(F.count("*").alias("n"), F.max("goal").alias("goal"))
    stated = F.trim(F.lit(policy["objective"] or ""))
    add(objective.where((F.col("n") != 1) | (F.trim("goal") != stated)).select(frame_id), "operator_objective_invalid", "frame_id", False)
    parents = d.where("origin = 'operator_objective'").select(F.col("desire_id").alias("p"))
    add(d.where("origin = 'synthesized_subgoal'").join(parents, F.col("parent") == F.col("p"), "left_anti"), "unlinked_synthesized_subgoal", "desire_id", False)
    add(d.where("origin <> 'synthesized_subgoal' and parent is not null"), "invalid_desire_parentage", "desire_id", False)
    add(f.policy.where("stance <> 'instrumental' or sentience_claim"), "stance_not_instrumental", "frame_id", False)
    add(texts(f).where(asserts_inner_state("text")).select("object_id").distinct(), "intrinsic_mental_status_assertion", "object_id", False)
    when_empty(b, "missing_grounded_beliefs")
    when_empty(i, "missing_intentions")
    norms = o.axioms.where("modality = 'normative'").select("source_id", "claim_id", F.col("statement").alias("goal"))
    add(d.where("origin = 'source_norm'").join(norms, ["source_id", "claim_id", "goal"], "left_anti"), "source_norm_semantic_mismatch", "desire_id", True)
    known = claims.select("source_id", F.col("claim_id").alias("support"))
    dangling = b.where("support is not null").join(known, ["source_id", "support"], "left_anti")
    add(dangling, "dangling_belief_support", "belief_id", True)
    bare = b.where("origin = 'source' and support is null")
    add(bare, "ungrounded_source_belief", "belief_id", True)
    made = b.where("status = 'synthesized' or origin = 'derived'")
    add(made.join(claims.select(F.col("claim_id").alias("belief_id")).distinct(), "belief_id", "left_semi"), "synthesized_claim_id_collision", "belief_id", False)
    add(made.where("support is null"), "unsupported_synthesized_belief", "belief_id", True)
    proven = o.evidence.select("source_id", F.col("claim_id").alias("support")).distinct()
    unproven = b.where("support is not null").join(known, ["source_id", "support"], "left_semi").join(proven, ["source_id", "support"], "left_anti")
    add(unproven, "unverified_belief_evidence", "belief_id", True)
    sides = against.select("source_id", "conflict_id", F.explode("claim_ids").alias("support"))
    held = sides.join(b.select("source_id", "support", "status"), ["source_id", "support"], "left").groupBy("source_id", "conflict_id", "support").agg(F.count("status").alias("n"), F.sum((F.col("status") == "contested").cast("int")).alias("k"))
    add(held.where("n = 0"), "missing_conflict_belief", "conflict_id", False)
    add(held.where("n > 0 and k < n"), "suppressed_disagreement", "conflict_id", True)
    add(held.where("n > 0 and k = 0"), "missing_contested_conflict_belief", "conflict_id", True)
    unfit = dangling.select("belief_id").unionByName(bare.select("belief_id")).unionByName(made.where("support is null").select("belief_id")).unionByName(unproven.select("belief_id")).distinct()
    add(links.where("kind = 'belief'").join(unfit.withColumnRenamed("belief_id", "target"), "target", "left_semi").select("intention_id").distinct(), "intention_uses_ungrounded_belief", "intention_id", True)
    own = d.where("origin <> 'source_norm'").select(F.col("desire_id").alias("target"))
    aimed = links.where("kind = 'desire'").join(own, "target", "left_semi").select("intention_id").distinct()
    add(i.join(aimed, "intention_id", "left_anti"), "intention_not_objective_directed", "intention_id", True)
    add(i.where("stop is null or trim(stop) = ''"), "missing_stop_conditions", "intention_id", True)
    add(f.models.join(o.models.select("source_id", F.col("claim_id").alias("model_id")), ["source_id", "model_id"], "left_anti"), "dangling_adopted_mental_model", "model_id", True)
    contract = F.lower(F.array_join("answer_contract", " "))
    add(f.policy.where(~(F.contains(contract, F.lit("source")) & F.contains(contract, F.lit("synthesis")))), "missing_source_synthesis_separation", "frame_id", True)
    add(f.policy.where(~(F.contains(contract, F.lit("citation")) | F.contains(contract, F.lit("cite")))), "missing_citation_contract", "frame_id", True)
    doubt = F.lower("uncertainty_policy")
    add(f.policy.where(~(F.contains(doubt, F.lit("uncertaint")) | F.contains(doubt, F.lit("confidence")))), "missing_uncertainty_policy", "frame_id", True)
    add(b.groupBy("belief_id").agg(F.count("*").alias("n")).where("n > 1"), "contract_support_validation_failed", "belief_id", False)
    if canonical is not None:
        every = None
        for part in PARTS:
            mine, theirs = getattr(f, part), getattr(canonical, part).select(*getattr(f, part).columns)
            apart = mine.exceptAll(theirs).select(F.lit(1).alias("x")).unionByName(theirs.exceptAll(mine).select(F.lit(1).alias("x"))).limit(1).select(frame_id)
            add(apart, f"noncanonical_{part}" if part != "models" else "noncanonical_adopted_mental_models", "frame_id", True)
            every = apart if every is None else every.unionByName(apart)
        add(every.select("frame_id").distinct(), "noncanonical_frame_semantics", "frame_id", True)
    return out.distinct()


def repair(f: Frame, canonical: Frame) -> Frame:
    """The canonical composition under the frame's own identifier."""
    return replace(canonical, policy=canonical.policy.withColumn("frame_id", F.lit(f.policy.first()["frame_id"])))


def review(f: Frame, o: Ontology, conflicts: DataFrame | None = None, max_repairs: int = 1, critic: Callable[[Frame], tuple[bool, list[tuple[str, str, str, bool]]]] | None = None) -> tuple[Frame, DataFrame, bool]:
    """(frame, findings, approved) after at most one repair.

    critic(frame) -> (approved, findings) may add findings of its own; a
    rejection without an error is reported as one.
    """
    if max_repairs not in (0, 1):
        raise ValueError("max_repairs is 0 or 1")
    spark = f.policy.sparkSession
    policy = f.policy.first()
    canonical = compose(o, policy["name"], policy["objective"] or "missing", conflicts)

    def found_in(frame: Frame) -> DataFrame:
        rows = findings(frame, o, conflicts, canonical)
        if critic is not None:
            fit, more = critic(frame)
            if not fit and not any(x[1] == "error" for x in more):
                more = [*more, ("model_critic_rejected", "error", policy["frame_id"], False)]
            rows = rows.unionByName(spark.createDataFrame(list(more), _FINDING))
        return cut(rows)

    rows = found_in(f)
    if max_repairs and not rows.where("severity = 'error' and repairable").isEmpty() and rows.where("severity = 'error' and not repairable").isEmpty():
        f = repair(f, canonical)
        rows = found_in(f)
    return f, rows, rows.where("severity = 'error'").isEmpty()


# --- texts and tools -----------------------------------------------------------------------------------------------------


def reasoning_policy(policy: dict) -> str:
    """The policy row as Markdown."""
    out = [f"# {policy['name']}", policy["role"], f"Objective: {policy['objective']}"]
    for c in ("deliberation_cycle", "answer_contract", "capabilities", "limitations", "anti_goals"):
        out.append(f"## {c.replace('_', ' ').capitalize()}\n\n" + "\n".join(f"{k}. {x}" for k, x in enumerate(policy[c], 1)))
    for c in ("model_selection_policy", "evidence_policy", "conflict_policy", "uncertainty_policy"):
        out.append(f"## {c.replace('_', ' ').capitalize()}\n\n{policy[c]}")
    return "\n\n".join(out) + "\n"


def system_prompt(f: Frame, shown: int = FIRST_BELIEFS) -> str:
    """The policy with the first beliefs (a bounded report) and the desires of the operator."""
    policy = f.policy.first().asDict()
    order = F.when(F.col("kind") == "term", 0).when(F.col("kind") == "axiom", 1).when(F.col("kind") == "relation", 2).otherwise(3)
    first = f.beliefs.orderBy("source_id", order, "belief_id").limit(shown).collect()
    goals = f.desires.where("origin <> 'source_norm'").orderBy(F.desc("priority"), "desire_id").collect()  # three rows
    lines = [f"- [{r['status']}] {r['proposition']} ({r['source_id']}, {r['support']})" for r in first]
    return reasoning_policy(policy) + "\n## Goals\n\n" + "\n".join(f"- {r['goal']}" for r in goals) + "\n\n## Beliefs\n\n" + "\n".join(lines) + "\n"


TOOLS = (
    ("lookup_concept", "Terms with a label, by source.", ("label",)),
    ("trace_claim", "The verified quotations of a claim.", ("label",)),
    ("retrieve_evidence", "Quotations that share words with a query.", ("query", "source_ids")),
    ("list_conflicts", "Conflicts of a concept and its neighbours.", ("label",)),
    ("get_mental_model", "A mental model by name.", ("name",)),
)


def tool_manifest() -> list[dict]:
    """The five tools of the read API with their parameters."""
    return [{"name": n, "description": d, "parameters": {"type": "object", "properties": {p: {"type": "array", "items": {"type": "string"}} if p == "source_ids" else {"type": "string"} for p in ps}, "required": [ps[0]]}} for n, d, ps in TOOLS]
