"""python -m claimspark.cli pdf-to-markdown|ingest|extract|synthesize|build|validate|ask ..."""

from __future__ import annotations

import argparse
import json

from claimspark import config, pipelines, runtime


def _summary(manifest: dict) -> dict:
    return {"kind": manifest.get("kind"), "version": manifest["version"], "rows": {n: t["rows"] for n, t in manifest["tables"].items()}}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="claimspark")
    parser.add_argument("--config", help="YAML file of settings")
    sub = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *args: str, **more) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        for a in args:
            p.add_argument(a, **more.get(a, {}))
        return p

    command("pdf-to-markdown", "PDF files to documents; needs a converter, see pipelines.ingest", "path", "out")
    command("ingest", "files to a bundle of chunks", "path", "out")
    command("extract", "a bundle of chunks to an ontology", "chunks", "out")
    command("synthesize", "ontologies to a frame", "name", "objective", "out", "ontologies", ontologies={"nargs": "+"})
    command("build", "files to chunks, ontology and frame", "path", "out", "name", "objective")
    command("validate", "check a bundle", "bundle")
    command("ask", "evidence, claims and conflicts for a question", "ontology", "question")
    args = parser.parse_args(argv)
    if args.command == "pdf-to-markdown":
        parser.error("no PDF converter is part of this engine; call pipelines.ingest(converter=...)")
    settings = config.load(args.config, ".env")
    spark = runtime.get_spark()
    runtime.ship(spark)
    if args.command == "ingest":
        result = _summary(pipelines.ingest(spark, args.path, args.out, settings))
    elif args.command == "extract":
        result = _summary(pipelines.extract(spark, pipelines.checked_chunks(spark, args.chunks), args.out, settings))
    elif args.command == "synthesize":
        result = _summary(pipelines.synthesize(spark, args.ontologies, args.out, args.name, args.objective, settings))
    elif args.command == "build":
        out = args.out.rstrip("/")
        made = [pipelines.ingest(spark, args.path, f"{out}/chunks", settings)]
        made.append(pipelines.extract(spark, pipelines.checked_chunks(spark, f"{out}/chunks"), f"{out}/ontology", settings))
        made.append(pipelines.synthesize(spark, [f"{out}/ontology"], f"{out}/frame", args.name, args.objective, settings))
        result = {"bundles": [_summary(m) for m in made]}
    elif args.command == "validate":
        result = pipelines.validate(spark, args.bundle)
    else:
        result = pipelines.answer(spark, args.ontology, args.question)
    print(json.dumps(result, ensure_ascii=False))
    return 1 if result.get("damaged") or result.get("problems") else 0




if __name__ == "__main__":
    raise SystemExit(main())
