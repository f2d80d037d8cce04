"""Seams where a model may be called: a protocol, a cache around it and a scripted double.

Nothing here reaches a network; an extractor built on a gateway runs inside
``mapInPandas`` (see ``extract_with``) and its results pass the same grounding.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from claimspark.sources.writers import cache_key


class Gateway(Protocol):
    def structured(self, prompt: str, kind: str, *, model: str = "", system: str = "") -> Any: ...


class Scripted:
    """Answers from queues by kind, then the standing answer of a kind, then that of a name in the prompt, then a responder; an unscripted call is an error."""

    def __init__(self, answers: dict[str, list] | None = None, responder: Callable[[str, str], Any] | None = None, standing: dict[str, Any] | None = None, named: dict[str, Any] | None = None) -> None:
        self.queues = defaultdict(deque, {k: deque(v) for k, v in (answers or {}).items()})
        self.standing, self.named, self.responder = standing or {}, named or {}, responder
        self.calls: list[tuple[str, str]] = []

    def structured(self, prompt: str, kind: str, *, model: str = "", system: str = "") -> Any:
        self.calls.append((kind, prompt))
        if self.queues[kind]:
            return self.queues[kind].popleft()
        if kind in self.standing:
            return self.standing[kind]
        for name, answer in self.named.items():
            if name in prompt:
                return answer
        if self.responder:
            return self.responder(prompt, kind)
        raise LookupError(f"no answer is scripted for {kind}")


class Cached:
    """Keeps answers by content in a folder; an unreadable entry is a miss."""

    def __init__(self, inner: Gateway, folder: str | Path, identity: str) -> None:
        self.inner, self.folder, self.identity = inner, Path(folder), identity

    def structured(self, prompt: str, kind: str, *, model: str = "", system: str = "") -> Any:
        path = self.folder / f"{cache_key(identity=self.identity, prompt=prompt, kind=kind, model=model, system=system)}.json"
        try:
            return json.loads(path.read_text())
        except (OSError, ValueError):
            answer = self.inner.structured(prompt, kind, model=model, system=system)
            self.folder.mkdir(parents=True, exist_ok=True)
            path.write_text(json.dumps(answer))
            return answer


def extract_with(chunks: DataFrame, extractor: Callable[[str], list[dict]], schema: str = "chunk_id string, source_id string, label string, definition string, quote string, confidence double") -> DataFrame:
    """Terms by an injected extractor(text) -> [{label, definition, quote, confidence}]; only exact quotes of the chunk stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(c, s, t.get("label"), t.get("definition", ""), t.get("quote"), float(t.get("confidence", 0))) for c, s, x in zip(pdf["chunk_id"], pdf["source_id"], pdf["text"]) for t in extractor(x) if t.get("quote") and t["quote"] in x]
            yield pd.DataFrame(rows, columns=["chunk_id", "source_id", "label", "definition", "quote", "confidence"])

    return chunks.where("chunk_id is not null and text is not null").select("chunk_id", "source_id", "text").distinct().mapInPandas(run, schema)
