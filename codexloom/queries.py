"""Queries of the core operators over the test tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import entities as en
from .functions import text as tx
from .operators import components, delta, graphs, mentions, records, search, sections, works
from .queries_sql import ORACLE
from .sinks import exports, reports
from .sources import files as sources
from .storage import cut, scratch_path, table
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}
SEARCH_TEXT = "sparse attention of the harmonic sensor"


def query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """Current manifest rows with clean formats, title keys and an order."""
    rows = records.manifest_defaults(delta.latest_rows(table(spark, sf, "manifest"))).withColumn("title_key", tx.title_key("title"))
    real = lambda c: F.when(F.lower(F.trim(c)).rlike("[0-9]"), F.trim(c))
    return rows.withColumn("doi", real("doi")).withColumn("arxiv_id", real("arxiv_id")).withColumn("idx", F.col("document_id")).withColumn("known", F.lit(False))


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sections").select("block_id", "document_id", F.col("source.source_index").alias("idx"), "type", "heading_level", "page_index", "section_path", "section_role", "text", "asset_path").dropDuplicates(["block_id"])


def _owner(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "works").select("work_id", F.explode("document_ids").alias("document_id"))


def _work_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).join(_owner(spark, sf), "document_id")


def _search_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return _blocks(spark, sf).select("block_id", F.get("section_path", F.lit(0)).alias("title"), F.col("section_role").alias("section"), "text")


def _aliases(spark: SparkSession, sf: str) -> DataFrame:
    """The facet labels of all works: a label is called by its words, and by those behind the first; and two with signs."""
    label = F.lower(F.trim("label"))
    labels = table(spark, sf, "work_features").select(F.explode("facets").alias("label")).select(label.alias("label_id")).where(F.col("label_id").rlike(r"^[a-z]+\.[a-z]+(_[a-z]+)+$")).distinct()
    words = F.replace(F.split_part("label_id", F.lit("."), F.lit(2)), F.lit("_"), F.lit(" "))
    named = labels.select(F.split_part("label_id", F.lit("."), F.lit(1)).alias("facet"), "label_id", F.explode(F.array(words, F.regexp_replace(words, "^[a-z]+ ", ""))).alias("alias"))
    return named.unionByName(spark.createDataFrame([("place", "place.selborne_ruun", "Selborne-Ruun"), ("sign", "sign.c_sharp", "C#")], "facet string, label_id string, alias string"))


# --- the next run's work (problem 2) ---


@query
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_delta(spark, sf).select("document_id", "stage")


def _next_run(spark: SparkSession, sf: str, at: datetime | None) -> DataFrame:
    """What is due, by a run that starts from the state that the run at the time ``at`` left."""
    manifest, ledger = table(spark, sf, "manifest"), table(spark, sf, "stage_ledger")
    state = None if at is None else delta.close_run(manifest, ledger, scratch_path(spark, "run-state"), at)
    return delta.incremental_delta(manifest, ledger, state)


@query
def p2_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The next run after the last one of the ledger."""
    return _next_run(spark, sf, delta.last_logged(table(spark, sf, "stage_ledger")))


@query
def p2_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the state of a run in the midst of the ledger, so that half of the rows come from the window."""
    return _next_run(spark, sf, table(spark, sf, "stage_ledger").select(F.percentile_approx("recorded_at", 0.5)).first()[0])


# --- files to works ---


@query
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return works.exact_duplicates(rows, "sha256", "doc_id").select("doc_id", "sha256", "canonical", "is_duplicate")


@query
def document_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").where("text is not null").select("doc_id", tx.document_id(F.sha2("text", 256)).alias("document_id"))


@query
def title_normalize(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "manifest").select("title").where("title is not null").distinct()
    return t.select("title", tx.clean_title("title").alias("clean"), tx.valid_title(tx.clean_title("title")).alias("valid"), tx.title_key("title").alias("key"), tx.slug("title").alias("slug"))


@query
def surname_sets(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select("document_id", F.array_join(tx.surnames("authors"), ",").alias("surnames"))


@query
def identifiers(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select("document_id", tx.normal_doi("doi").alias("doi"), tx.normal_arxiv("arxiv_id").alias("arxiv"), tx.is_preprint_doi("doi").alias("preprint"), tx.work_id(F.col("doi"), F.col("arxiv_id"), F.col("title")).alias("derived_work_id"))


@query
def title_groups(spark: SparkSession, sf: str) -> DataFrame:
    return works.title_groups(_files(spark, sf)).select("document_id", "group_work_id")


@query
def format_preference(spark: SparkSession, sf: str) -> DataFrame:
    return works.format_policy(_files(spark, sf)).select("document_id", "work_id", "format", "selected", "reason")


@query
def match_candidates_blocked(spark: SparkSession, sf: str) -> DataFrame:
    return works.trigram_candidates(table(spark, sf, "works").select(F.col("work_id").alias("document_id"), tx.title_key("title").alias("title_key")))


@query
def match_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return works.match_candidates(_files(spark, sf).select("document_id", "work_id", "title_key"))


@query
def fuzzy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return works.fuzzy_key_pairs(table(spark, sf, "works").select(tx.title_key("title").alias("title_key")))


@query
def fuzzy_work_clusters(spark: SparkSession, sf: str) -> DataFrame:
    f = _files(spark, sf).select("document_id", "work_id", "title_key", "doi", "arxiv_id", "authors", "idx", "known")
    f = cut(f, "files")
    return works.cluster_works(f, works.fuzzy_edges(f))


@query
def strong_identity(spark: SparkSession, sf: str) -> DataFrame:
    return works.strong_identities(table(spark, sf, "works"))


@query
def work_components(spark: SparkSession, sf: str) -> DataFrame:
    pairs = works.strong_identities(table(spark, sf, "works"))
    return components.connected_components(pairs, "left_work_id", "right_work_id").select(F.col("node").alias("work_id"), "component")


@query
def merged_works(spark: SparkSession, sf: str) -> DataFrame:
    w = table(spark, sf, "works")
    pairs = works.strong_identities(w).select(F.col("left_work_id").alias("primary"), F.col("right_work_id").alias("merged"))
    return works.merge_works(w, pairs).select("work_id", F.size("document_ids").cast("long").alias("n_documents"), "n_merged", "merge_status")


@query
def latest_titles(spark: SparkSession, sf: str) -> DataFrame:
    return works.latest_title(_files(spark, sf))


# --- blocks and sections ---


@query
def text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return sections.text_blocks(table(spark, sf, "documents"))


@query
def block_quality(spark: SparkSession, sf: str) -> DataFrame:
    return sections.block_quality(_blocks(spark, sf))


@query
def heading_roles(spark: SparkSession, sf: str) -> DataFrame:
    t = _blocks(spark, sf).where("type in ('title', 'heading') and text is not null").select("text").distinct()
    return t.select("text", tx.clean_heading("text").alias("heading"), tx.heading_role("text").alias("role"))


def _leveled(spark: SparkSession, sf: str) -> DataFrame:
    level = F.when(F.col("type").isin("title", "heading"), F.when(F.col("text").rlike(r"^[0-9]+\.[0-9]"), 3).otherwise(F.when(F.col("idx") == 0, 1).otherwise(2)))
    return _blocks(spark, sf).drop("section_role", "section_path", "heading_level").withColumn("heading_level", level)


@query
def section_roles(spark: SparkSession, sf: str) -> DataFrame:
    return sections.section_fold(_leveled(spark, sf)).select("block_id", "section_role")


@query
def section_paths(spark: SparkSession, sf: str) -> DataFrame:
    return sections.section_fold(_leveled(spark, sf)).select("block_id", tx.section_name("section_path").alias("section"))


@query
def select_first_n(spark: SparkSession, sf: str) -> DataFrame:
    return sections.select_statements(_blocks(spark, sf)).select("document_id", "field", "ord", "block_id")


@query
def prompt_budgets(spark: SparkSession, sf: str) -> DataFrame:
    return sections.prompt_budget(_blocks(spark, sf).where("text is not null"), ("abstract", "methodology", "results")).select("document_id", F.length("prompt").alias("n_chars"), F.sha2("prompt", 256).alias("prompt_sha256"))


@query
def markdown_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return exports.markdown_blocks(_blocks(spark, sf))


@query
def block_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks whose page and box were damaged on purpose: pages count from -1, titles lose a side of their box."""
    rows = table(spark, sf, "sections").dropDuplicates(["block_id"])
    damaged = rows.withColumn("page_index", F.col("page_index") - 1).withColumn("bbox", F.when(F.col("type") == "title", F.slice("bbox", 1, 3)).otherwise(F.col("bbox")))
    return records.violations(damaged, records.block_rules(), "block_id")


# --- mentions ---


@query
def entity_mentions(spark: SparkSession, sf: str) -> DataFrame:
    terms = table(spark, sf, "entity_vocabulary").select(F.col("name").alias("term"))
    hits = mentions.vocabulary_mentions(_blocks(spark, sf), terms)
    return hits.groupBy("term").agg(F.count("*").alias("n_blocks"), F.countDistinct("document_id").alias("n_documents"))


@query
def dataset_names(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "experiments").where("kind = 'dataset' and name is not null").select("name").distinct()
    return en.with_dataset(names, "name", "dataset")


@query
def dataset_mentions(spark: SparkSession, sf: str) -> DataFrame:
    terms = table(spark, sf, "entity_vocabulary").where("kind = 'dataset'").select(F.col("name").alias("term"))
    return mentions.dataset_mentions(_blocks(spark, sf).withColumn("heading_level", F.lit(None).cast("int")), terms).select("document_id", "key", "name", "block_id")


@query
def metric_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.metric_mentions(_blocks(spark, sf)).select("document_id", "key", "name", "block_id")


@query
def result_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.result_sentences(_blocks(spark, sf).where("text is not null"))


@query
def reference_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Bibliography lines made of the works themselves."""
    w = table(spark, sf, "works")
    lines = w.select("work_id", F.concat(F.lit("[7] "), F.array_join(F.coalesce("authors", F.array().cast("array<string>")), ", "), F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("n.d.")), F.lit("). "), F.coalesce(F.regexp_replace("title", "[.!?]", ","), F.lit("Untitled")), F.lit(". doi "), F.coalesce("doi", F.lit("none")), F.lit(".")).alias("raw"))
    f = lines.withColumn("f", en.reference_fields("raw"))
    return f.select("work_id", "raw", F.col("f.title").alias("title"), F.array_join("f.authors", "; ").alias("authors"), F.col("f.year").alias("year"), F.col("f.doi").alias("doi"))


@query
def taxonomy_facets(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.taxonomy_labels(_work_blocks(spark, sf), _aliases(spark, sf))


@query
def facet_collections(spark: SparkSession, sf: str) -> DataFrame:
    labels = mentions.taxonomy_labels(_work_blocks(spark, sf), _aliases(spark, sf))
    out = mentions.collections(labels, table(spark, sf, "works"))
    return out.select("facet", "label_id", "n_works", F.sha2("titles", 256).alias("titles_sha256"))


# --- records ---


def _statements(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "experiments").where("name is not null").dropDuplicates(["mention_id"])
    return rows.select("work_id", F.col("kind").alias("field"), F.col("mention_id").alias("pos"), F.col("name").alias("statement"), F.coalesce(F.size("evidence"), F.lit(0)).alias("n_evidence"))


@query
def statement_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return records.aggregate_statements(_statements(spark, sf))


@query
def evidence_validate(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "experiments").dropDuplicates(["mention_id"]).select("mention_id", F.posexplode("evidence").alias("pos", "e")).select("mention_id", "pos", "e.*")
    return records.validate_evidence(e, table(spark, sf, "sections")).groupBy("valid").agg(F.count("*").alias("n"))


@query
def corpus_audit(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "experiments").where("name is not null").dropDuplicates(["mention_id"]).select("work_id", "kind", "name", F.size("evidence").alias("n_evidence"))
    return records.corpus_audit(table(spark, sf, "works"), m)


@query
def suspicious_names(spark: SparkSession, sf: str) -> DataFrame:
    return records.suspicious_names(table(spark, sf, "experiments").where("kind = 'dataset'"))


@query
def metric_display_names(spark: SparkSession, sf: str) -> DataFrame:
    return records.display_metrics(table(spark, sf, "experiments").where("kind = 'metric'"))


@query
def gold_prf(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "experiments").where("name is not null and work_id is not null and kind is not null")
    gold = m.join(table(spark, sf, "entity_vocabulary").select("kind", tx.fold("name").alias("g")), ["kind"]).where(tx.fold(tx.strip("name")) == F.col("g"))
    predicted = m.where("support_status = 'supported'").select("work_id", "kind", F.col("name").alias("label"))
    return records.precision_recall(predicted, gold.select("work_id", "kind", F.col("name").alias("label")))


@query
def changed_works(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose content or title differs between their first and their current state."""
    m = table(spark, sf, "manifest").select(F.col("document_id").alias("work_id"), "title", "sha256", "updated_at").distinct()
    state = lambda pick: m.groupBy("work_id").agg(pick(F.struct("title", "sha256"), F.struct("updated_at", "sha256", "title")).alias("s")).select("work_id", "s.*")
    prints = lambda df: records.fingerprints(df, ("title", "sha256"))
    return records.changed_works(prints(state(F.min_by)), prints(state(F.max_by)))


@query
def stage_status(spark: SparkSession, sf: str) -> DataFrame:
    return records.stage_status(delta.latest_rows(table(spark, sf, "manifest")))


@query
def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "stage_ledger").select(F.col("document_id").alias("key"), delta.clean_status(F.col("stage")).alias("stage"), delta.clean_status(F.col("status")).alias("status"), F.col("recorded_at").alias("updated_at")).where("key is not null")
    return records.upsert_stages(log.where("false"), log)


# --- graphs ---


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.feature_table(table(spark, sf, "works"), None, table(spark, sf, "work_features"))


@query
def related_works(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.related_pairs(cut(_features(spark, sf), "features"))


@query
def related_topk(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.related_best(cut(_features(spark, sf), "features"))


def _references(spark: SparkSession, sf: str) -> DataFrame:
    """Two references of every work: to the first work of its year by title, and to the last one by its identifiers too."""
    w = table(spark, sf, "works")
    ends = w.groupBy("year").agg(F.min("work_id").alias("first"), F.max("work_id").alias("last"))
    cited = w.select(F.col("work_id").alias("target"), "title", "doi", "arxiv_id")
    flat = w.select("work_id", "year").join(ends, "year").select("work_id", F.posexplode(F.array("first", "last")).alias("ref_index", "target")).where("work_id <> target")
    none = F.lit(None).cast("string")
    by_id = lambda c: F.when(F.col("ref_index") == 1, F.col(c)).otherwise(none).alias(c)
    return flat.join(cited, "target").select("work_id", "ref_index", F.coalesce("title", F.lit("")).alias("raw"), "title", by_id("doi"), by_id("arxiv_id"))


@query
def citation_links(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.citation_edges(_references(spark, sf), table(spark, sf, "works"))


@query
def verified_citations(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.citation_counts(graphs.citation_edges(_references(spark, sf), table(spark, sf, "works")))


def _node_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Works, and the datasets and labels of works; labels are read twice, by nodes and edges."""
    data = table(spark, sf, "experiments").where("kind = 'dataset' and name is not null and work_id is not null").select("work_id", "name")
    labels = mentions.work_labels(table(spark, sf, "sections").select("document_id", "text"), _owner(spark, sf), _aliases(spark, sf))
    return table(spark, sf, "works"), data, cut(labels, "labels")


def _graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    w, data, labels = _node_sources(spark, sf)
    related = cut(graphs.related_best(cut(_features(spark, sf), "features")), "related")
    return graphs.knowledge_graph(w, data, labels, graphs.citation_edges(_references(spark, sf), w), related)


@query
def knowledge_graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graphs.graph_nodes(*_node_sources(spark, sf)).groupBy("type").agg(F.count("*").alias("n"))


@query
def graph_summary(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = _graph(spark, sf)
    return graphs.graph_summary(nodes, edges)


@query
def graphml_rows(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = _graph(spark, sf)
    return exports.graphml_rows(nodes, edges)


# --- search ---


@query
def token_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return search.document_frequency(_search_blocks(spark, sf))


@query
def tfidf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return search.tfidf_vectors(_search_blocks(spark, sf)).select("block_id", "dim", F.round("weight", 4).alias("weight"))


@query
def bm25_search(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25_scores(_search_blocks(spark, sf), SEARCH_TEXT).select("block_id", F.round("bm25", 4).alias("bm25"))


@query
def vector_search(spark: SparkSession, sf: str) -> DataFrame:
    index = cut(_search_blocks(spark, sf), "index")
    return search.search(index, SEARCH_TEXT, 25, "vector")


@query
def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    index = cut(_search_blocks(spark, sf), "index")
    return search.search(index, SEARCH_TEXT, 25)


@query
def token_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return search.token_overlap(_search_blocks(spark, sf), SEARCH_TEXT).select("block_id", F.round("share", 4).alias("share"))


@query
def nearest_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return search.nearest_vectors(e, e.where("vec_id % 50 = 0"))


# --- reports, exports, streams, sources ---


@query
def dataset_index(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "experiments").where("kind = 'dataset' and name is not null and work_id is not null").select("work_id", "name")
    out = reports.dataset_index(table(spark, sf, "works"), named)
    return out.select("name", "n_works", F.sha2("works", 256).alias("works_sha256"))


@query
def all_works_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.all_works_report(table(spark, sf, "works")).select("markdown")


@query
def bibtex_rows(spark: SparkSession, sf: str) -> DataFrame:
    return exports.bibtex_rows(table(spark, sf, "works"))


@query
def csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    return exports.csv_rows(table(spark, sf, "works"))


@query
def jsonld_rows(spark: SparkSession, sf: str) -> DataFrame:
    return exports.jsonld_rows(table(spark, sf, "works"))


@query
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingested_documents(spark, sf)


@query
def windowed_events(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.windowed_events(table(spark, sf, "events"))


@query
def html_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Section texts set as HTML pages and read back as blocks."""
    esc = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><head><title>"), F.col("block_id"), F.lit("</title><script>var p = '</p>';</script></head><body><nav><p>menu</p></nav><h2>Part</h2><p>"), esc, F.lit("<li>end</body></html>"))
    pages = _blocks(spark, sf).where("text is not null").select(F.col("block_id").alias("path"), page.alias("html"))
    return sources.html_blocks(pages)


def queries() -> dict[str, Query]:
    return dict(_ALL)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in _ALL}
