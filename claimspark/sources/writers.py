"""Writers: chunk lines, N-Quads, manifests, and folders published in one step."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions.text import canonical_json
from claimspark.operators.graph import nquads


def write_chunks(chunks: DataFrame, path: str, files: int | None = None) -> None:
    """JSON Lines ordered by source and ordinal within each file; a source isn't split over files."""
    sized = chunks.repartition(files, "source_id") if files else chunks.repartition("source_id")
    sized.sortWithinPartitions("source_id", "ordinal").select(F.to_json(F.struct(*sorted(chunks.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_nquads(quads: DataFrame, path: str) -> None:
    nquads(quads).write.mode("overwrite").text(path)


def write_claims(df: DataFrame, path: str) -> None:
    """Parquet partitioned by source, so that a read of one source prunes the others."""
    df.write.mode("overwrite").partitionBy("source_id").parquet(path)


def manifest(folder: str | Path, **facts) -> dict:
    root = Path(folder)
    files = {str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(root.rglob("*")) if p.is_file() and p.name != "manifest.json"}
    return {"schema_version": "1.0", "artifacts": files, **facts}


def verify(folder: str | Path) -> list[str]:
    """Names of artifacts that are missing, changed, linked or outside the folder; empty for a sound folder."""
    root = Path(folder).resolve()
    try:
        recorded = json.loads((root / "manifest.json").read_text())["artifacts"]
    except (OSError, ValueError, KeyError):
        return ["manifest.json"]
    bad = []
    for name, digest in recorded.items():
        p = root / name
        if os.path.isabs(name) or ".." in Path(name).parts or p.is_symlink() or not p.is_file() or hashlib.sha256(p.read_bytes()).hexdigest() != digest:
            bad.append(name)
    return bad


def publish(target: str | Path, fill, **facts) -> Path:
    """fill(folder) writes the artifacts; the folder replaces the target in one rename, or nothing changes."""
    target = Path(target)
    if target.is_symlink():
        raise ValueError(f"{target} is a link")
    target.parent.mkdir(parents=True, exist_ok=True)
    staging = Path(tempfile.mkdtemp(prefix=f".{target.name}-", dir=target.parent))
    backup = target.with_name(f".{target.name}-old")
    try:
        fill(staging)
        (staging / "manifest.json").write_text(json.dumps(manifest(staging, **facts), indent=2, sort_keys=True))
        if target.exists():
            os.replace(target, backup)
        os.replace(staging, target)
    except BaseException:
        if backup.exists() and not target.exists():
            os.replace(backup, target)
        raise
    finally:
        shutil.rmtree(staging, ignore_errors=True)
        shutil.rmtree(backup, ignore_errors=True)
    return target


def store(path: str | Path, value, kind: str = "json") -> Path:
    """A small file that is whole or not there: written beside its place, flushed to the disk and renamed.

    kind: json (indented), canonical (one line, sorted), jsonl, yaml (flat), text or bytes.  A file with the same content is left alone.
    """
    render = {
        "json": lambda v: json.dumps(v, indent=2, sort_keys=True, ensure_ascii=False) + "\n",
        "canonical": canonical_json,
        "jsonl": lambda v: "".join(canonical_json(x) + "\n" for x in v),
        "yaml": lambda v: "".join(f"{k}: {json.dumps(x, ensure_ascii=False)}\n" for k, x in v.items()),
        "text": str,
    }
    raw = bytes(value) if kind == "bytes" else render[kind](value).encode()
    path = Path(path)
    if ".." in path.parts or path.is_symlink() or any(p.is_symlink() for p in path.parents if p.exists() and p != Path(p.anchor)):
        raise ValueError(f"{path} leaves its folder or is a link")
    if path.exists() and path.read_bytes() == raw:
        return path
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, beside = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}-")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(raw)
            f.flush()
            os.fsync(f.fileno())
        os.replace(beside, path)
    except BaseException:
        os.unlink(beside)
        raise
    return path


def cache_key(**parts) -> str:
    """Content address of a step: equal inputs and settings give the same key."""
    return hashlib.sha256(canonical_json(parts).encode()).hexdigest()
