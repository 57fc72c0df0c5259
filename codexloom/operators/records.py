"""Work records: aggregation, evidence, audit, evaluation, fingerprints, manifest state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import entities as en
from ..functions import text as tx


def aggregate_statements(statements: DataFrame) -> DataFrame:
    """One row per work, field and folded statement: the one with most evidence, else the first; ``first_pos`` orders them.

    ``statements``: work_id, field, pos, statement, n_evidence.
    """
    keyed = statements.where(tx.strip("statement") != "").withColumn("key", tx.fold(tx.strip("statement")))
    best = keyed.groupBy("work_id", "field", "key").agg(F.max_by("statement", F.struct("n_evidence", -F.col("pos"))).alias("statement"), F.max("n_evidence").alias("n_evidence"), F.min("pos").alias("first_pos"))
    return best.select("work_id", "field", "first_pos", "statement", "n_evidence")


def validate_evidence(evidence: DataFrame, sections: DataFrame) -> DataFrame:
    """``evidence`` (document_id, block_id, page_index, section) with ``valid``: the block exists and, where given, so do
    its page and section."""
    known = sections.where("block_id is not null").select("document_id", "block_id", F.col("page_index").alias("_page"), tx.section_name("section_path").alias("_section")).dropDuplicates(["document_id", "block_id"]).withColumn("_there", F.lit(True))
    joined = evidence.join(known, ["document_id", "block_id"], "left")
    valid = F.coalesce("_there", F.lit(False)) & (F.col("page_index").isNull() | F.col("page_index").eqNullSafe(F.col("_page"))) & (F.col("section").isNull() | F.col("section").eqNullSafe(F.col("_section")))
    return joined.withColumn("valid", valid).drop("_page", "_section", "_there")


def cited_items(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """Model-made items all of whose cited blocks exist, marked as unverified; items without citations are dropped."""
    flat = items.select("item_id", F.explode("evidence_block_ids").alias("block_id")).distinct()
    known = flat.join(blocks.select("block_id").distinct().withColumn("there", F.lit(True)), "block_id", "left")
    good = known.groupBy("item_id").agg(F.min(F.coalesce("there", F.lit(False))).alias("all_there")).where("all_there").select("item_id")
    return items.join(good, "item_id", "left_semi").withColumn("support_status", F.lit("evidence_cited_unverified"))


#: The reasons reported for names that are hardly datasets, and their patterns.
SUSPICIONS = (
    ("suspiciously short (<= 2 chars)", r"^(?=.{1,2}$)[^0-9]*$"),
    ("contains sentence boundary", r"[.!?]\s+[A-Z]"),
    ("contains table/figure/section marker", r"(?i)\b(table|fig|figure|section|appendix)\b"),
    ("contains procedural/heading keyword", r"(?i)\b(comparison|evaluations?|results?|ablation|baseline|methods?|details|statistics|overview|following|unlike|since)\b"),
    ("contains prepositional phrase", r"(?i)\b(on|for|in|using|across)\s+the\b"),
    ("all-caps multi-word phrase (likely table heading)", r"^[^a-z]*[A-Z][^a-z\s]*(\s+[^a-z\s]+){2,}$"),
    ("question questionnaire marker", r"(?i)^Q[0-9]+\b"),
)


def suspicious_names(names: DataFrame, words: en.Words = en.Words()) -> DataFrame:
    """(name, reasons) of names with at least one reason to doubt them."""
    col = F.col("name")
    listed = [F.when(tx.fold(col).isin(*words.stopwords), "matches stopword"), F.when(tx.fold(col).isin(*words.not_datasets), "matches known false positive")]
    reasons = F.concat_ws("; ", *listed, *[F.when(col.rlike(p), reason) for reason, p in SUSPICIONS])
    return names.where("name is not null").select("name").distinct().withColumn("reasons", reasons).where("reasons <> ''")


#: A metric of a report has at most so many words, and none of these verbs, which make it a sentence.
METRIC_WORDS, METRIC_VERBS = 4, ("is", "was", "are", "were", "uses", "evaluated")


def display_metrics(names: DataFrame, words: en.Words = en.Words()) -> DataFrame:
    """(name) of distinct metric names fit to be shown: at most four words, no verb, and not blocked.

    Null and blank names are left out."""
    bare = names.where("name is not null").select(tx.strip("name").alias("name")).where("name <> ''").distinct()
    verb = F.col("name").rlike(r"(?i)\b(?:" + "|".join(METRIC_VERBS) + r")\b")
    return bare.where((F.size(F.split(tx.spaces("name"), " ")) <= METRIC_WORDS) & ~verb & ~F.upper("name").isin(*words.blocked_metrics))


def corpus_audit(works: DataFrame, mentions: DataFrame) -> DataFrame:
    """Key figures as rows (measure, value): works, documents, works of several files, datasets per work, metric coverage,
    evidence rate (100 without evidence). ``mentions``: work_id, kind, name, n_evidence."""
    w = works.agg(F.count("*").cast("double").alias("works"), F.coalesce(F.sum(F.size(F.coalesce("document_ids", F.array().cast("array<string>")))), F.lit(0)).cast("double").alias("documents"), F.count_if(F.size("document_ids") > 1).cast("double").alias("works_of_several_documents"))
    m = mentions.agg(
        F.countDistinct(F.when(F.col("kind") == "dataset", tx.fold(tx.strip("name")))).cast("double").alias("unique_datasets"),
        F.countDistinct(F.when(F.col("kind") == "metric", F.col("work_id"))).cast("double").alias("works_with_metrics"),
        F.count("*").cast("double").alias("_m"), F.count_if(F.col("n_evidence") > 0).cast("double").alias("_e"),
    )
    one = w.crossJoin(m)  # one row each
    one = one.withColumn("dataset_density", F.round(F.col("unique_datasets") / F.greatest(F.col("works"), F.lit(1.0)), 4)).withColumn("evidence_rate", F.round(F.when(F.col("_m") > 0, 100 * F.col("_e") / F.col("_m")).otherwise(100.0), 2)).withColumn("density_warning", (F.col("dataset_density") > 1.5).cast("double"))
    names = ("works", "documents", "works_of_several_documents", "unique_datasets", "works_with_metrics", "dataset_density", "evidence_rate", "density_warning")
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in names])))


def precision_recall(predicted: DataFrame, expected: DataFrame, keys: tuple[str, ...] = ("work_id", "kind")) -> DataFrame:
    """Per group: matched, predicted, expected, precision, recall, f1 (4 places). Labels are compared folded.

    Without predictions precision is 1 if nothing was expected, else 0; without expectations recall is 1.
    """
    side = lambda df, name: df.select(*keys, tx.fold(tx.strip("label")).alias("label")).where("label <> ''").distinct().withColumn(name, F.lit(1))
    both = side(predicted, "p").join(side(expected, "e"), [*keys, "label"], "full")
    n = both.groupBy(*keys).agg(F.coalesce(F.sum(F.col("p") * F.col("e")), F.lit(0)).alias("matched"), F.coalesce(F.sum("p"), F.lit(0)).alias("predicted"), F.coalesce(F.sum("e"), F.lit(0)).alias("expected"))
    p = F.when(F.col("predicted") > 0, F.col("matched") / F.col("predicted")).otherwise((F.col("expected") == 0).cast("double"))
    r = F.when(F.col("expected") > 0, F.col("matched") / F.col("expected")).otherwise(1.0)
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return n.select(*keys, "matched", "predicted", "expected", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f, 4).alias("f1"))


def fingerprints(works: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(work_id, fingerprint): hash over the named columns in order, nulls distinct from blanks."""
    parts = [F.concat(F.lit(f"{c}:"), F.sha2(F.coalesce(F.to_json(F.struct(c)), F.lit("")), 256)) for c in columns]
    return works.select("work_id", F.sha2(F.concat_ws("\n", *parts), 256).alias("fingerprint"))


def changed_works(before: DataFrame, now: DataFrame) -> DataFrame:
    """(work_id, change): added, changed or removed between two fingerprint tables."""
    both = before.select("work_id", F.col("fingerprint").alias("b")).join(now.select("work_id", F.col("fingerprint").alias("n")), "work_id", "full")
    change = F.when(F.col("b").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("b").eqNullSafe(F.col("n"))).select("work_id", change.alias("change"))


def stage_status(manifest: DataFrame, stages: tuple[str, ...] = ("ingestion", "extraction", "analysis")) -> DataFrame:
    """(stage, status, n): files by cleaned status of each stage."""
    flat = manifest.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.coalesce(F.lower(F.trim(F.col(f"stages.{s}.status"))), F.lit("missing")).alias("status")) for s in stages])).alias("s"))
    return flat.groupBy("s.stage", "s.status").agg(F.count("*").alias("n"))


def upsert_stages(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Stage table (key, stage, status, updated_at) after updates: the latest row of each key and stage wins, at equal
    times the update."""
    both = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return both.groupBy("key", "stage").agg(F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "_new", "status")).alias("r")).select("key", "stage", "r.*")


def manifest_defaults(manifest: DataFrame) -> DataFrame:
    """Old manifest rows with their defaults: format by suffix, extractable, title key, file name."""
    fmt = F.coalesce(tx.file_format(F.concat(F.lit("x."), F.lower(F.regexp_replace(F.trim("format"), r"^\.", "")))), tx.file_format("canonical_path"))
    return manifest.withColumn("format", fmt).withColumn("extractable", F.coalesce("extractable", F.lit(True))).withColumn("title_key", F.coalesce(F.nullif("title_key", F.lit("")), tx.title_key("title"))).withColumn("file_name", F.coalesce("file_name", F.regexp_extract("canonical_path", r"([^/]+)$", 1)))


def reconcile_outputs(manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """Files and parser outputs (stem, origin_sha256, finished): by stem, else by hash; complete, failed, pending, skipped."""
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    files = manifest.select("document_id", "sha256", stem.alias("stem"), "selected_for_extraction")
    by_stem = outputs.select("stem", F.col("finished").alias("f1")).groupBy("stem").agg(F.max("f1").alias("f1"))
    by_hash = outputs.where("origin_sha256 is not null").groupBy(F.col("origin_sha256").alias("sha256")).agg(F.max("finished").alias("f2"))
    joined = files.join(by_stem, "stem", "left").join(by_hash, "sha256", "left").withColumn("finished", F.coalesce("f1", "f2"))
    status = F.when(~F.coalesce("selected_for_extraction", F.lit(False)), "skipped").when(F.col("finished"), "complete").when(F.col("finished").isNull(), "pending").otherwise("failed")
    return joined.select("document_id", status.alias("status"))


def fill_missing(base: DataFrame, extra: DataFrame, columns: tuple[str, ...], key: str = "document_id") -> DataFrame:
    """``base`` with nulls filled from ``extra`` and, per row, the names of columns in which both differ."""
    other = extra.select(key, *[F.col(c).alias(f"_{c}") for c in columns]).dropDuplicates([key])
    joined = base.join(other, key, "left")
    conflicts = F.concat_ws(",", *[F.when(F.col(c).isNotNull() & F.col(f"_{c}").isNotNull() & (F.col(c) != F.col(f"_{c}")), c) for c in columns])
    return joined.withColumn("conflicts", conflicts).withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def combine_references(refs: DataFrame) -> DataFrame:
    """References of several parsers per work: the last of each key (DOI, arXiv, title, raw) wins. ``refs`` has pos."""
    key = F.coalesce(F.concat(F.lit("doi:"), tx.fold("doi")), F.concat(F.lit("arxiv:"), tx.fold("arxiv_id")), F.concat(F.lit("title:"), F.nullif(tx.title_key("title"), F.lit(""))), F.concat(F.lit("raw:"), tx.fold("raw")))
    rest = [c for c in refs.columns if c != "work_id"]
    return refs.withColumn("key", key).groupBy("work_id", "key").agg(F.max_by(F.struct(*rest), "pos").alias("r")).select("work_id", "key", "r.*")


def violations(rows: DataFrame, rules: dict[str, F.Column], key: str) -> DataFrame:
    """(key, errors): names of the rules a row breaks, sorted; a rule that is null is broken."""
    errors = F.concat_ws(",", *[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in sorted(rules.items())])
    return rows.select(key, errors.alias("errors")).where("errors <> ''")


def block_rules() -> dict[str, F.Column]:
    """Constraints of a block row."""
    return {"block_id": F.col("block_id").rlike("^blk_[0-9a-f]{20}$"), "document_id": F.col("document_id").rlike("^doc_[0-9a-f]{16}$"), "type": F.length("type") >= 1, "heading_level": F.col("heading_level").isNull() | (F.col("heading_level") >= 1), "page_index": F.col("page_index").isNull() | (F.col("page_index") >= 0), "bbox": F.col("bbox").isNull() | (F.size("bbox") == 4), "source_index": F.col("source.source_index") >= 0}
