"""Command line over the tables of a corpus: ``python -m codexloom COMMAND ...``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import search, works
from .plans import pipeline
from .plans.pipeline import Corpus
from .sinks import exports
from .sinks.exports import publish
from .storage import clear_scratch

SUMMARY = ("manifest", "blocks", "works", "references", "datasets", "metrics")


def _open(spark: SparkSession, path: str, *names: str) -> Corpus:
    """The named tables of a corpus, those that were written."""
    return Corpus({n: spark.read.parquet(f"{path}/{n}") for n in names if os.path.exists(f"{path}/{n}")})


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="codexloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        out = commands.add_parser(name, help=text)
        for argument in arguments:
            out.add_argument(argument)
        return out

    for name, text in (("run", "ingest a folder and analyse it"), ("ingest", "ingest a folder: manifest, duplicates, blocks")):
        one = command(name, text, "input", "output")
        one.add_argument("--parsed", help="folder of the layout parser's outputs")
        if name == "run":
            one.add_argument("--terms", help="text file of dataset names, one a line")
            one.add_argument("--aliases", help="CSV file with the columns facet, label_id, alias")
        else:
            one.add_argument("--dry-run", action="store_true", help="show what would be taken")
    again = command("analyze", "analyse the blocks of an ingested corpus again", "output")
    again.add_argument("--terms")
    again.add_argument("--aliases")
    find = command("search", "search the blocks", "output", "text")
    find.add_argument("--mode", choices=search.MODES, default="hybrid")
    find.add_argument("--limit", type=int, default=10)
    command("export", "write the works", "output").add_argument("kind", choices=("bibtex", "csv", "jsonld"))
    commands.choices["export"].add_argument("path")
    command("report", "write a report", "output").add_argument("kind", choices=pipeline.REPORTS)
    commands.choices["report"].add_argument("path")
    command("graph", "write the knowledge graph as GraphML rows", "output", "path")
    command("citation-graph", "works by verified citations", "output")
    command("review", "pairs of works that may be one", "output")
    command("merge", "merge works with equal identifiers and titles", "output").add_argument("--threshold", type=float, default=0.95)
    command("status", "rows of the main tables", "output")
    return parser


def _inputs(spark: SparkSession, args: argparse.Namespace) -> tuple:
    terms = spark.read.text(args.terms).select(F.trim("value").alias("term")).where("term <> ''") if args.terms else None
    aliases = spark.read.option("header", True).csv(args.aliases).select("facet", "label_id", "alias") if args.aliases else None
    return terms, aliases


def _publish(corpus: Corpus, output: str) -> None:
    for name, df in corpus.tables.items():
        publish(df, f"{output}/{name}")


def _ingested(spark: SparkSession, args: argparse.Namespace) -> Corpus:
    return pipeline.ingest(spark, args.input, _open(spark, args.output, "manifest").tables.get("manifest"), args.parsed)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "ingest":
        corpus = _ingested(spark, args)
        if args.dry_run:
            corpus["manifest"].select("path", "work_id", "format", "selected", "reason").show(100, truncate=False)
        else:
            _publish(corpus, args.output)
        return
    if args.command in ("run", "analyze"):
        corpus = _ingested(spark, args) if args.command == "run" else _open(spark, args.output, "manifest", "duplicates", "blocks")
        done = pipeline.analyze(corpus, *_inputs(spark, args))
        valid = pipeline.check_evidence(done)
        new = {n: df for n, df in done.tables.items() if args.command == "run" or n not in corpus.tables}
        _publish(Corpus(new), args.output)
        print(f"{done['works'].count()} works, {done['sections'].count()} blocks, {valid} evidence locators")
    elif args.command == "search":
        corpus = _open(spark, args.output, "search_blocks", "search_vectors")
        search.search(corpus["search_blocks"], args.text, args.limit, args.mode, corpus["search_vectors"]).show(args.limit, truncate=False)
    elif args.command == "export":
        pipeline.export(_open(spark, args.output, "works"), args.kind, args.path)
    elif args.command == "report":
        pipeline.report(_open(spark, args.output, "works", "manifest", "datasets", "references", "statements"), args.kind, args.path)
    elif args.command == "graph":
        corpus = _open(spark, args.output, "kg_nodes", "kg_edges")
        exports.write_text(exports.graphml_rows(corpus["kg_nodes"], corpus["kg_edges"]).orderBy(F.desc("part"), "ord"), "xml", args.path)
    elif args.command == "citation-graph":
        corpus = _open(spark, args.output, "citations", "works")
        from .operators import graphs

        exports.citation_report(corpus["citations"], corpus["works"], graphs.citation_counts(corpus["citations"])).show(50, truncate=False)
    elif args.command == "review":
        rows = _open(spark, args.output, "manifest")["manifest"].select("document_id", "work_id", "title_key")
        works.match_candidates(rows).orderBy(F.desc("ratio"), "left_document_id").show(100, truncate=False)
    elif args.command == "merge":
        table = _open(spark, args.output, "works")["works"]
        log = works.auto_merges(table, args.threshold)
        publish(log, f"{args.output}/merge_log")
        publish(works.merge_works(table, spark.read.parquet(f"{args.output}/merge_log").select("primary", "merged")), f"{args.output}/merged_works")
        print(spark.read.parquet(f"{args.output}/merge_log").count(), "pairs merged into merged_works; works stays as it was")
    else:
        for name in SUMMARY:
            print(name, spark.read.parquet(f"{args.output}/{name}").agg(F.count("*")).first()[0])


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.command in ("run", "ingest") and os.path.abspath(args.output).startswith(os.path.abspath(args.input) + os.sep):
        parser.error("the output must not lie inside the input")
    spark = SparkSession.builder.appName("codexloom").getOrCreate()
    try:
        _run(spark, args)
    finally:
        clear_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
