"""Bundles of tables on any file system that Spark reads.

A bundle is a folder of immutable versions and one small pointer file, which is
replaced last: readers see the old version or the new one, never a mixture, and
a run that dies leaves the pointer as it was.  Every table's rows are counted and
digested (independently of order and layout), so a changed bundle is found.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators import graph
from claimspark.operators.claims import Ontology, broken_references
from claimspark.operators.frame import Frame, ledger, reasoning_policy, system_prompt, tool_manifest
from claimspark.sources.writers import cache_key, write_nquads

POINTER, VERSION = "current.json", "1.0"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and renamed into it."""
    at, fs, jvm = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.hsync()
    out.close()
    hadoop = jvm.org.apache.hadoop.fs
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), fs.makeQualified(at), how)


def read_small(spark: SparkSession, path: str) -> str | None:
    at, fs, jvm = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def digest(df: DataFrame) -> dict:
    """Rows and their digest, whatever their order: the exclusive or of the rows' hashes and the count."""
    flat = [F.to_json(F.struct(c)) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string") for c, t in sorted(df.dtypes)]
    row = F.sha2(F.concat_ws("\u001f", *[F.coalesce(c, F.lit("\u0000")) for c in flat]), 256)
    part = lambda i: F.coalesce(F.bit_xor(F.conv(F.substring(row, i, 15), 16, 10).cast("bigint")), F.lit(0))
    got = df.agg(F.count("*").alias("n"), part(1).alias("a"), part(16).alias("b")).first()
    return {"rows": got["n"], "digest": f"{got['a'] & (2**60 - 1):015x}{got['b'] & (2**60 - 1):015x}"}


def schema_key(df: DataFrame) -> str:
    return cache_key(schema=df.schema.jsonValue())


def publish_tables(spark: SparkSession, target: str, tables: dict[str, DataFrame], key: str = "", texts: dict[str, str] | None = None, **facts) -> dict:
    """Write a version and point to it; the manifest holds every table's digest and schema."""
    version = uuid.uuid4().hex
    root = f"{target.rstrip('/')}/{version}"
    recorded = {}
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
        written = spark.read.parquet(f"{root}/{name}")
        recorded[name] = digest(written) | {"schema": schema_key(written)}
    for name, text in (texts or {}).items():
        write_small(spark, f"{root}/{name}", text)
    manifest = {"schema_version": VERSION, "version": version, "key": key, "tables": recorded, "texts": {n: cache_key(text=t) for n, t in (texts or {}).items()}, **facts}
    write_small(spark, f"{target.rstrip('/')}/{POINTER}", json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def manifest_of(spark: SparkSession, target: str) -> dict | None:
    """The manifest of the current version; None where there is none or it can't be read."""
    raw = read_small(spark, f"{target.rstrip('/')}/{POINTER}")
    try:
        found = json.loads(raw or "")
    except ValueError:
        return None
    return found if isinstance(found, dict) and {"version", "tables"} <= found.keys() and "/" not in found["version"] and ".." not in found["version"] else None


def table(spark: SparkSession, target: str, name: str) -> DataFrame:
    found = manifest_of(spark, target)
    if found is None or name not in found["tables"]:
        raise FileNotFoundError(f"{target} has no table {name}")
    return spark.read.parquet(f"{target.rstrip('/')}/{found['version']}/{name}")


def damaged(spark: SparkSession, target: str, required: tuple[str, ...] = ()) -> list[str]:
    """Names of what is missing or changed in a bundle; empty for a sound one."""
    found = manifest_of(spark, target)
    if found is None:
        return [POINTER]
    bad = [n for n in required if n not in found["tables"]]
    for name, was in found["tables"].items():
        try:
            now = table(spark, target, name)
            if digest(now) | {"schema": schema_key(now)} != was:
                bad.append(name)
        except Exception:  # a table that can't be read is a damaged one
            bad.append(name)
    for name, was in found.get("texts", {}).items():
        text = read_small(spark, f"{target.rstrip('/')}/{found['version']}/{name}")
        if not (text or "").strip() or cache_key(text=text) != was:
            bad.append(name)
    return bad


def valid(spark: SparkSession, target: str, key: str, required: tuple[str, ...] = ()) -> bool:
    """Whether the bundle was made from the same inputs and settings and is whole."""
    found = manifest_of(spark, target)
    return found is not None and found.get("key") == key and not damaged(spark, target, required)


# --- ontologies ----------------------------------------------------------------------------------------------------------

ONTOLOGY_TABLES = tuple(f.name for f in fields(Ontology))


class NotConforming(ValueError):
    """Claims that break a shape or a reference are not published."""


def conformance(o: Ontology) -> DataFrame:
    """(subject, problem) of everything that keeps an ontology from being published."""
    shapes = graph.violations(graph.ontology_quads(o), graph.ONTOLOGY_SHAPES)
    return shapes.select("subject", F.concat_ws(" ", "path", "constraint").alias("problem")).unionByName(broken_references(o).select(F.col("claim_id").alias("subject"), "problem"))


def publish_ontology(spark: SparkSession, target: str, o: Ontology, key: str = "") -> dict:
    """All tables of an ontology with its triples, Turtle and JSON-LD; only if it conforms."""
    problems = conformance(o)
    if not problems.isEmpty():
        raise NotConforming(f"{problems.count()} problems, for example {problems.first().asDict()}")
    quads = graph.ontology_quads(o)
    tables = {n: getattr(o, n) for n in ONTOLOGY_TABLES} | {"quads": quads, "turtle": graph.turtle(quads), "jsonld": graph.jsonld(quads)}
    return publish_tables(spark, target, tables, key, kind="ontology")


def load_ontology(spark: SparkSession, target: str) -> Ontology:
    """A published ontology, checked against its digests; claim ids must be unique."""
    bad = damaged(spark, target, ONTOLOGY_TABLES)
    if bad:
        raise ValueError(f"{target}: {bad}")
    o = Ontology(**{n: table(spark, target, n) for n in ONTOLOGY_TABLES})
    twice = broken_references(o).where("problem = 'duplicate_id'")
    if not twice.isEmpty():
        raise ValueError(f"claim ids are not unique: {twice.first()['claim_id']}")
    return o


def export_quads(spark: SparkSession, target: str, path: str) -> None:
    """The triples of a published ontology as N-Quads text."""
    write_nquads(table(spark, target, "quads"), path)


# --- frames --------------------------------------------------------------------------------------------------------------

FRAME_TABLES = tuple(f.name for f in fields(Frame)) + ("ledger", "conflicts", "findings")


class Rejected(ValueError):
    """A frame that its review didn't approve is not published."""


def publish_frame(spark: SparkSession, target: str, f: Frame, findings: DataFrame, approved: bool, conflicts: DataFrame, key: str = "") -> dict:
    if not approved:
        worst = [r["code"] for r in findings.where("severity = 'error'").select("code").distinct().collect()]  # at most one row for each rule
        raise Rejected(f"not approved: {sorted(worst)}")
    tables = {x.name: getattr(f, x.name) for x in fields(Frame)} | {"ledger": ledger(f), "conflicts": conflicts, "findings": findings}
    texts = {"reasoning_policy.md": reasoning_policy(f.policy.first().asDict()), "system_prompt.md": system_prompt(f), "tools.json": json.dumps(tool_manifest(), indent=2)}
    return publish_tables(spark, target, tables, key, texts, kind="frame")


def load_frame(spark: SparkSession, target: str) -> Frame:
    bad = damaged(spark, target, FRAME_TABLES)
    if bad:
        raise ValueError(f"{target}: {bad}")
    return Frame(**{x.name: table(spark, target, x.name) for x in fields(Frame)})
