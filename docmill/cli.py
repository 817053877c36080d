"""Command line: crawl, parse, chunk, index, retrieve."""

from __future__ import annotations

import argparse
import datetime
import json
import os
import sys
import tomllib
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from docmill.operators import artifacts, chunking, embedding, retrieval, sections, vindex
from docmill.sources import crawl
from docmill.sources.config import read_sources
from docmill.sources.scan import scan_pages, scan_sources


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docmill", description=__doc__)
    parser.add_argument("--root", default=".", help="folder that source paths and data are relative to")
    commands = parser.add_subparsers(dest="command", required=True)
    fetch = commands.add_parser("crawl", help="choose and download the files of sources")
    fetch.add_argument("--source", action="append", help="name of a crawl entry, may be repeated; without it all are taken")
    fetch.add_argument("--crawl", default="crawl.toml", help="file of [[crawl]] tables: name, kind (index, tree, files) and what the kind needs")
    parse = commands.add_parser("parse", help="files to sections")
    parse.add_argument("--sources", default="sources.toml")
    chunk = commands.add_parser("chunk", help="sections to chunks")
    chunk.add_argument("--strategy", choices=sorted(chunking.STRATEGIES), default="structured")
    chunk.add_argument("--size", type=int, default=1200)
    chunk.add_argument("--overlap", type=int, default=150)
    chunk.add_argument("--min-size", type=int, default=300)
    chunk.add_argument("--unit", choices=["characters", "tokens"], default="characters")
    chunk.add_argument("--tokenizer", type=Path)
    index = commands.add_parser("index", help="chunks to a vector collection")
    index.add_argument("--input", required=True)
    index.add_argument("--collection", required=True)
    index.add_argument("--batch-size", type=int, default=16)
    index.add_argument("--part-rows", type=int, default=vindex.PART_ROWS, help="chunks after which progress is saved")
    search = commands.add_parser("retrieve", help="search a collection")
    search.add_argument("question")
    search.add_argument("--collection", required=True)
    search.add_argument("--top-k", type=int, default=5)
    for command in (index, search):
        command.add_argument("--server-url", default=os.getenv("EMBEDDING_URL"), help="model server; without it words are hashed")
        command.add_argument("--model", default=os.getenv("EMBEDDING_MODEL", ""))
    return parser


def _provider(args: argparse.Namespace) -> embedding.EmbeddingProvider:
    return embedding.ModelServerEmbedding(args.server_url, args.model) if args.server_url else embedding.HashingEmbedding()


def run(args: argparse.Namespace, spark: SparkSession, fetch: crawl.Fetcher = crawl.fetch_url) -> str:
    """Run one command; returns what it prints. Failures raise."""
    root = args.root.rstrip("/")
    if args.command == "crawl":
        with open(f"{root}/{args.crawl}", "rb") as stream:
            entries = {entry["name"]: entry for entry in tomllib.load(stream)["crawl"]}
        unknown = [name for name in args.source or [] if name not in entries]
        if unknown:
            raise ValueError(f"unknown source {unknown[0]!r}")
        done = []
        for name in args.source or entries:
            files = crawl.download(crawl.listed(spark, entries[name], fetch), fetch)
            crawl.save_files(files, f"{root}/data/raw/{name}")
            artifacts.write_text(spark, f"{root}/data/raw/{name}.SOURCE.txt", crawl.provenance(entries[name].get("about", f"{name}\n"), datetime.date.today().isoformat()))
            size = crawl.corpus_size(spark.read.parquet(f"{root}/data/raw/{name}")).first()
            done.append(f"{name}: {size.files} files, {size.megabytes:.1f} MB")
        return "\n".join(done)
    if args.command == "parse":
        sources = read_sources(Path(root, args.sources))
        flat, paged = [[s for s in sources if (s.format == "pdf") == kind] for kind in (False, True)]
        found: list[tuple] = []
        if flat:
            documents, left_out = scan_sources(spark, flat, root)
            parsed = sections.parse_documents(documents, flat)
            found.append((sections.sections_of(parsed), sections.audit_of(parsed).unionByName(left_out)))
        for source in paged:  # page texts made beforehand, see scan_pages
            pages, left_out = scan_pages(spark, source, f"{root}/data/pages/{source.name}")
            made = sections.parse_pages(pages, paged)
            found.append((made, sections.audit_of_pages(pages, made).unionByName(left_out)))
        rows, audit = (reduce(DataFrame.unionByName, tables) for tables in zip(*found))
        manifest = artifacts.write_parsed(rows, audit, sources, f"{root}/data/parsed")
        return "\n".join(f"{o['source']}: {o['docs']} docs, {o['sections']} sections, {o['chars'] / 1e6:.1f}M chars" for o in manifest["outputs"])
    if args.command == "chunk":
        measure, budget = None, "characters"
        if args.unit == "tokens":
            if args.tokenizer is None or not args.tokenizer.is_file():
                raise ValueError("--unit tokens needs an existing --tokenizer file")
            text = args.tokenizer.read_text(encoding="utf-8")
            measure, budget = chunking.token_measure(text), "tokens:" + chunking._module_hash(str(args.tokenizer))
        elif args.tokenizer:
            raise ValueError("--tokenizer needs --unit tokens")
        rows, parsed = artifacts.load_parsed(spark, f"{root}/data/parsed")
        options = {"overlap": args.overlap} if args.strategy == "recursive" else {"min_size": args.min_size}
        chunks = chunking.STRATEGIES[args.strategy](rows, args.size, measure=measure, budget=budget, **options)
        configuration = chunking.chunk_configuration(args.strategy, args.size, options.get("overlap", 0), options.get("min_size", 0), budget)
        run_id = artifacts.fingerprint({"corpus_id": parsed["corpus_id"], "configuration": configuration})[:16]
        folder = f"{root}/data/chunks/{args.strategy}-{args.size}-{args.unit}-{run_id}"
        artifacts.write_chunks(chunks, folder, parsed["corpus_id"], configuration)
        return folder
    if args.command == "index":
        chunks, manifest = artifacts.load_chunks(spark, args.input)  # before any service is contacted
        return json.dumps({"collection": args.collection, **vindex.index_chunks(chunks, manifest, args.collection, _provider(args), args.batch_size, args.part_rows)}, indent=2)
    found = retrieval.retrieve(spark, args.question, args.collection, _provider(args), args.top_k)
    return json.dumps([json.loads(r) for r in found.toJSON().collect()], indent=2, ensure_ascii=False)


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName("docmill").getOrCreate()
    try:
        print(run(args, spark))
    except Exception as error:  # noqa: BLE001
        print(f"{args.command} failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
