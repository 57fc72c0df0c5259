"""The stages of the engine in their order, as one plan over tables.

Each stage is a function of tables; only blocks, sections and the records that several stages read are written, so that
they are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import graphs, mentions, records, search, sections, works
from ..sinks import exports, reports
from ..sources import files as sources
from ..storage import cut


@dataclass
class Corpus:
    """Tables of a corpus by name."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def put(self, name: str, df: DataFrame, keep: bool = False) -> None:
        self.tables[name] = cut(df, name) if keep else df


def ingest(spark: SparkSession, path: str, manifest: DataFrame | None = None, parsed: str | None = None) -> Corpus:
    """Files below ``path`` to a manifest with works, formats and selections, and their blocks.

    Files whose content the manifest already holds keep their work ids, and its rows whose file is gone stay. Blocks of
    PDF files are read from the layout parser's outputs below ``parsed``. A work's blocks come from its files of the
    best format that has any.
    """
    out = Corpus()
    content = cut(sources.pdf_preflight(sources.read_content(spark, path)), "contents")
    pages = content.where(tx.file_format("path") == "html").select("path", F.col("content").cast("string").alias("html"))
    docx = content.where(tx.file_format("path") == "docx")
    meta = sources.html_metadata(pages).select("path", "title", "authors", "year").unionByName(sources.docx_metadata(docx).select("path", tx.clean_title("title").alias("title"), "authors", F.lit(None).cast("int").alias("year")))
    files = works.exact_duplicates(content.drop("content"), "sha256", "path")
    out.put("duplicates", files.where("is_duplicate").select("path", "canonical", "sha256"))
    name = F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1)
    kept = files.where("not is_duplicate").join(meta, "path", "left")
    title = F.coalesce(F.when(tx.valid_title("title"), F.col("title")), F.when(tx.valid_title(F.regexp_replace(name, "[_-]+", " ")), tx.clean_title(F.regexp_replace(name, "[_-]+", " "))), name)
    rows = kept.select(tx.document_id("sha256").alias("document_id"), "path", "sha256", title.alias("title"), "authors", F.coalesce("year", tx.year_from_name(name)).alias("year"), tx.file_format("path").alias("format"), (F.col("preflight") != "failed").alias("extractable"), tx.find_doi(F.coalesce("title", name)).alias("doi"), tx.find_arxiv(F.coalesce("title", name)).alias("arxiv_id"))
    rows = rows.withColumn("title_key", tx.title_key("title")).withColumn("work_id", tx.work_id(F.col("doi"), F.col("arxiv_id"), F.col("title"))).withColumn("idx", F.col("path"))
    if manifest is not None:
        old = manifest.select("sha256", F.col("work_id").alias("_old")).where("sha256 is not null").dropDuplicates(["sha256"])
        rows = rows.join(old, "sha256", "left").withColumn("known", F.col("_old").isNotNull()).withColumn("work_id", F.coalesce("_old", "work_id")).drop("_old")
    else:
        rows = rows.withColumn("known", F.lit(False))
    grouped = cut(works.title_groups(rows).withColumn("work_id", F.col("group_work_id")).drop("group_work_id"), "grouped")
    clustered = grouped.join(works.cluster_works(grouped, works.fuzzy_edges(grouped)), "document_id").withColumn("work_id", F.col("cluster_work_id")).drop("cluster_work_id")
    if manifest is not None:
        gone = manifest.join(clustered.select("sha256"), "sha256", "left_anti")
        clustered = clustered.unionByName(gone.select(*[c for c in clustered.columns if c in gone.columns]), allowMissingColumns=True)
    out.put("manifest", works.format_policy(clustered), keep=True)
    blocks = sources.html_blocks(pages).unionByName(sources.docx_blocks(docx))
    if parsed is not None:
        stems = out["manifest"].where("format = 'pdf'").select("path", F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("stem"))
        blocks = blocks.unionByName(sources.parser_json_blocks(sources.read_parsed(spark, parsed).join(stems, "stem").select("path", "json")))
    blocks = cut(blocks, "read-blocks")
    readable = works.format_policy(out["manifest"].drop("selected", "reason").join(blocks.select("path").distinct(), "path", "left_semi"))
    ids = readable.select("path", "document_id").where(F.col("selected"))
    named = blocks.join(ids, "path").select("document_id", "idx", "type", "heading_level", "page_index", "text")
    out.put("blocks", named.withColumn("block_id", tx.block_id(F.col("document_id"), F.col("idx"), F.col("type"), F.col("text"))), keep=True)
    return out


def analyze(corpus: Corpus, terms: DataFrame | None = None, aliases: DataFrame | None = None) -> Corpus:
    """Blocks to sections, quality, statements, mentions, references, records, graphs and the search index."""
    out = Corpus(dict(corpus.tables))
    files = out["manifest"].where("selected")
    out.put("quality", sections.block_quality(out["blocks"]))
    out.put("sections", sections.section_fold(out["blocks"]), keep=True)
    body = out["sections"]
    out.put("statements", sections.select_statements(body), keep=True)
    out.put("datasets", mentions.dataset_mentions(body, terms), keep=True)
    out.put("metrics", mentions.metric_mentions(body), keep=True)
    out.put("results", mentions.result_sentences(body))
    out.put("references", mentions.references(body), keep=True)
    owner = out["manifest"].select("document_id", "work_id", "title")
    merged = files.groupBy("work_id").agg(F.max_by("title", "document_id").alias("title"), F.max_by("authors", "document_id").alias("authors"), F.max("year").alias("year"), F.max("doi").alias("doi"), F.max("arxiv_id").alias("arxiv_id"), F.array_sort(F.collect_set("document_id")).alias("document_ids"), F.lit("unreviewed").alias("merge_status"))
    out.put("works", merged, keep=True)
    named = owner
    owner = owner.drop("title")
    owned = out["datasets"].join(owner, "document_id")
    refs = out["references"].join(owner, "document_id")
    labels = mentions.taxonomy_labels(body.join(owner, "document_id"), aliases) if aliases is not None else None
    if labels is not None:
        out.put("labels", labels, keep=True)
    keyed = mentions.distinct_references(refs, "work_id")
    features = owned.groupBy("work_id").agg(F.collect_set("name").alias("datasets")).join(keyed.groupBy("work_id").agg(F.collect_set("key").alias("reference_keys")), "work_id", "full")
    facets = out["labels"].groupBy("work_id").agg(F.collect_set("label_id").alias("facets")) if labels is not None else features.select("work_id", F.array().cast("array<string>").alias("facets"))
    features = features.join(facets, "work_id", "full")
    table = graphs.feature_table(out["works"], out["statements"].join(owner, "document_id"), features)
    out.put("related", graphs.related_top(cut(graphs.related_pairs(cut(table, "features")), "related-pairs")), keep=True)
    out.put("citations", graphs.citation_edges(refs.select("work_id", F.col("ref_index"), "raw", "title", "doi", "arxiv_id"), out["works"]), keep=True)
    tagged = out["labels"] if labels is not None else out["works"].where("false").select("work_id", F.lit("").alias("facet"), F.lit("").alias("label_id"))
    nodes, edges = graphs.knowledge_graph(out["works"], owned.select("work_id", "name"), tagged, out["citations"], out["related"])
    out.put("kg_nodes", nodes)
    out.put("kg_edges", edges)
    indexed = body.join(named.select("document_id", "title"), "document_id").select("block_id", "title", F.col("section_role").alias("section"), "text")
    out.put("search_blocks", indexed, keep=True)
    out.put("search_vectors", search.tfidf_vectors(out["search_blocks"]), keep=True)
    evidence = out["statements"].select("document_id", "block_id", F.lit(None).cast("int").alias("page_index"), F.lit(None).cast("string").alias("section"))
    out.put("evidence", records.validate_evidence(evidence, body))
    return out


def check_evidence(corpus: Corpus) -> int:
    """Raise if any locator points nowhere; else the number of valid ones."""
    counts = {r.valid: r["count"] for r in corpus["evidence"].groupBy("valid").count().collect()}
    if counts.get(False):
        raise ValueError(f"{counts[False]} evidence locators point nowhere")
    return counts.get(True, 0)


REPORTS = ("all_works", "datasets", "references", "audit", "literature_review")


def report(corpus: Corpus, kind: str, path: str) -> None:
    """Write one of :data:`REPORTS` as Markdown."""
    named = corpus["datasets"].join(corpus["manifest"].select("document_id", "work_id"), "document_id").select("work_id", "name")
    if kind == "all_works":
        rows = reports.all_works_report(corpus["works"])
    elif kind == "datasets":
        index = reports.dataset_index(corpus["works"], named)
        rows = index.select(F.col("name").alias("ord"), F.concat(F.lit("- **"), "name", F.lit("** ("), F.col("n_works").cast("string"), F.lit("): "), "works").alias("markdown"))
    elif kind == "references":
        rows = reports.reference_report(corpus["works"], corpus["references"].join(corpus["manifest"].select("document_id", "work_id"), "document_id"))
    elif kind == "audit":
        mentioned = named.select("work_id", F.lit("dataset").alias("kind"), "name", F.lit(1).alias("n_evidence"))
        rows = reports.audit_report(records.corpus_audit(corpus["works"], mentioned), records.suspicious_names(named))
    elif kind == "literature_review":
        said = corpus["statements"].join(corpus["manifest"].select("document_id", "work_id"), "document_id").withColumn("locator", tx.locator(F.col("document_id"), F.col("block_id"), F.lit(None).cast("int")))
        rows = reports.statement_report(corpus["works"], said, ("research_problem", "methodology", "results", "limitations"))
    else:
        raise ValueError(f"unknown report {kind!r}: {', '.join(REPORTS)}")
    reports.write_report(rows, kind.replace("_", " ").capitalize(), path)


def export(corpus: Corpus, kind: str, path: str) -> None:
    """Write the works as bibtex, csv or jsonld."""
    if kind == "bibtex":
        exports.write_text(exports.bibtex_rows(corpus["works"]), "entry", path)
    elif kind == "csv":
        exports.write_csv(corpus["works"], path)
    elif kind == "jsonld":
        exports.write_text(exports.jsonld_rows(corpus["works"]), "json", path)
    else:
        raise ValueError(f"unknown export format {kind!r}: bibtex, csv or jsonld")
