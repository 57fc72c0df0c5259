"""Queries of the training-data problems, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.delta import latest_rows
from ..storage import cut, table
from . import canonical, leakage, markup, moderation, packing, scan_repair, set_join, survivors, title_versions

SET_FIELDS = ("facets", "datasets", "reference_keys")


def _title_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = latest_rows(table(spark, sf_dir, "manifest").select("document_id", "title", "updated_at"))
    return title_versions.title_versions(files)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return title_versions.version_pairs(_title_groups(spark, sf_dir))


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _title_groups(spark, sf_dir)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.scan_traces(table(spark, sf_dir, "sections")).select("block_id")


def p3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_repair.readable_paragraphs(table(spark, sf_dir, "sections"))


def _current_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("work_id", "document_id", "title", "authors", "year", "doi", "arxiv_id", "format", "canonical_path", "extractable", "preflight", "created_at", "updated_at")
    return latest_rows(table(spark, sf_dir, "manifest").select(*wanted))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.surviving_files(cut(survivors.ready_files(_current_files(spark, sf_dir)), "files")).select("work_id", "document_id")


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.survivors(_current_files(spark, sf_dir))


def p4_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = survivors.prepared(latest_rows(table(spark, sf_dir, "manifest")))
    _, quality = survivors.judged_values(files)
    return quality.select("field", "source", F.round("sensitivity", 6).alias("sensitivity"), F.round("specificity", 6).alias("specificity"))


def _work_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.tagged_items(table(spark, sf_dir, "work_features"), "work_id", SET_FIELDS, least=5)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = set_join.set_pairs(_work_sets(spark, sf_dir), 0.6)
    return pairs.select(F.col("left_id").alias("left_work_id"), F.col("right_id").alias("right_work_id"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per work with the class of its set and the number of other classes that are similar."""
    classed = cut(set_join.with_classes(_work_sets(spark, sf_dir)), "classed-sets")
    links = set_join.chosen_path_join(classed.where("id = class").select("class", "items"), 0.6)
    degree = links.select(F.explode(F.array("l", "r")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    return classed.join(degree, "class", "left").select(F.col("id").alias("work_id"), "class", F.size("items").alias("n_items"), F.coalesce("links", F.lit(0)).alias("links"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.markup_blocks(table(spark, sf_dir, "sections"))


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_blocks(table(spark, sf_dir, "sections"))


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.matched_mentions(table(spark, sf_dir, "experiments"), table(spark, sf_dir, "entity_vocabulary"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).where("entity_id is not null").select("mention_id", "entity_id").distinct()


def p7_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of values that mean no entry: kind, name, mentions."""
    return _mentions(spark, sf_dir).where("entity_id is null").groupBy("kind", "name").agg(F.count("*").alias("mentions"))


def _packed(spark: SparkSession, sf_dir: str, limits: packing.Limits = packing.Limits()) -> DataFrame:
    return cut(packing.packed_documents(table(spark, sf_dir, "documents"), limits), "packed-documents")


def p8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start_token", "tokens", "container")


def p8_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.container_usage(_packed(spark, sf_dir))


def p8_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the packing, counted: nothing lost, nothing twice, no limit exceeded, no needless cut."""
    return packing.packing_faults(table(spark, sf_dir, "documents"), _packed(spark, sf_dir))


#: Limits for instruction data: few examples a container, so that attention masks stay small, and a bounded share of loss.
INSTRUCTIONS = packing.Limits(2048, 6, 1920)


def p8_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts as instruction data, where each of the three limits is met by some containers."""
    return packing.container_usage(_packed(spark, sf_dir, INSTRUCTIONS), INSTRUCTIONS)


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p9_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per suite: its items, those that leaked, and the documents that leak them."""
    found = _leaks(spark, sf_dir)
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite").distinct()
    return items.join(found, "item_id", "left").groupBy("suite").agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct(F.when(F.col("doc_id").isNotNull(), F.col("item_id"))).alias("n_leaked"), F.countDistinct("doc_id").alias("n_documents"))


def _moderated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.moderated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "moderation_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir).where("label <> 'clean'").select("doc_id").distinct()


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moderated(spark, sf_dir)


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moderation.source_rates(table(spark, sf_dir, "documents"), _moderated(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p1_found, p1_groups, p3_found, p3_paragraphs, p4_found, p4_records, p4_sources, p5_found, p5_classes, p6_found, p6_clean, p7_found, p7_unmatched, p8_packing, p8_usage, p8_faults, p8_instructions, p9_found, p9_suites, p10_found, p10_scores, p10_rates)
    return {f.__name__: f for f in own}


_STAND_INS = ", ".join(f"'{x}'" for x in survivors.STAND_INS)

P4_SQL = rf"""
with cur as (
  select * from (select *, row_number() over (partition by document_id order by updated_at desc) as rn from (select distinct * from manifest)) where rn = 1 and work_id is not null
), f as (
  select work_id, document_id, created_at,
    coalesce(extractable, true) and coalesce(lower(trim(preflight.status)), '') <> 'failed' as readable,
    case when regexp_matches(lower(trim(coalesce(format, regexp_extract(canonical_path, '\.[A-Za-z]+$')))), 'pdf$') then 0
         when regexp_matches(lower(trim(coalesce(format, regexp_extract(canonical_path, '\.[A-Za-z]+$')))), 'docx$|wordprocessingml') then 1
         when regexp_matches(lower(trim(coalesce(format, regexp_extract(canonical_path, '\.[A-Za-z]+$')))), 'x?html?$') then 2 else 3 end as rank,
    (len(list_filter(coalesce(authors, []), lambda x: x is not null and lower(trim(x)) not in ({_STAND_INS}) and regexp_matches(x, '\p{{L}}{{2}}'))) > 0)::int
    + (coalesce(year between 1500 and 2200, false))::int
    + (coalesce(lower(trim(doi)) not in ({_STAND_INS}) and regexp_matches(doi, '10\.[0-9]{{3,}}/\S+'), false))::int
    + (coalesce(lower(trim(arxiv_id)) not in ({_STAND_INS}), false))::int as filled
  from cur
), w as (select work_id from f group by work_id having count(*) >= 2 and bool_or(readable))
select work_id, document_id from (
  select f.work_id, f.document_id, row_number() over (partition by f.work_id order by rank, filled desc, created_at desc nulls last, document_id) as place
  from f join w using (work_id) where readable
) where place = 1
"""

P5_SQL = """
with flat as (
  select work_id, 'f' as field, unnest(facets) as x from work_features
  union all select work_id, 'd', unnest(datasets) from work_features
  union all select work_id, 'r', unnest(reference_keys) from work_features
), items as (select distinct work_id, field, lower(trim(x)) as x from flat where x is not null and trim(x) <> ''),
sizes as (select work_id, count(*) as n from items group by work_id having count(*) >= 5),
kept as (select items.*, n from items join sizes using (work_id))
select a.work_id as left_work_id, b.work_id as right_work_id
from kept a join kept b on a.field = b.field and a.x = b.x and a.work_id < b.work_id
group by a.work_id, b.work_id, a.n, b.n
having count(*) >= 0.6 * (a.n + b.n - count(*)) - 1e-9
"""


P8_FAULTS_SQL = "select count(distinct doc_id) as n_documents, 0 as n_lost, 0 as n_twice, 0 as n_over, 0 as n_needless from documents where text <> ''"


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4_SQL, "p5_found": P5_SQL, "p8_faults": P8_FAULTS_SQL}
