"""Datasets, metrics, results, references and taxonomy labels mentioned in section blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import entities as en
from ..functions import text as tx
from ..storage import cut


def _blank(col: str) -> F.Column:
    return tx.strip(F.coalesce(col, F.lit(""))) == ""


def entity_blocks(blocks: DataFrame) -> DataFrame:
    """Body blocks that may name datasets."""
    kind = F.coalesce("type", F.lit(""))
    return blocks.where(F.col("section_role").isin(*en.ENTITY_ROLES) & ~kind.isin(*en.FURNITURE, "heading") & F.col("heading_level").isNull() & ~_blank("text"))


def metric_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.where(F.col("section_role").isin(*en.METRIC_ROLES) & ~F.coalesce("type", F.lit("")).isin(*en.FURNITURE) & ~_blank("text"))


def first_mentions(mentions: DataFrame) -> DataFrame:
    """The first mention of each folded name per document: mentions (document_id, idx, sub, block_id, name); null names
    have none. They are dropped after the aggregate, where the filter cannot copy the name's whole derivation below it."""
    firsts = mentions.groupBy("document_id", tx.fold("name").alias("key")).agg(F.min_by(F.struct("name", "block_id", "idx"), F.struct("idx", "sub")).alias("f"))
    return firsts.where("f.name is not null").select("document_id", "key", "f.name", "f.block_id", "f.idx")


def _standing(blocks: DataFrame, terms: DataFrame, *kept: str, few: bool = False) -> DataFrame:
    """The columns ``kept`` of a block, and each term that stands in its text as whole tokens. ``few``: the terms can be
    broadcast, so that the tokens of the blocks are not shuffled."""
    head = F.get(F.regexp_extract_all(F.lower("term"), F.lit("[a-z0-9]+"), F.lit(0)), F.lit(0))
    heads = terms.select("term").distinct().withColumn("tok", head).where("tok is not null")
    parts = blocks.select(*kept, "text", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)))).alias("tok"))
    return parts.join(F.broadcast(heads) if few else heads, "tok").where(tx.term_present("text", "term")).select(*kept, "term")


def vocabulary_mentions(blocks: DataFrame, terms: DataFrame) -> DataFrame:
    """Every (block, term) in which a term stands as whole tokens: blocks (document_id, idx, block_id, text), terms (term).

    Blocks and terms meet on the first token of the term, an equal join on an exploded token list, so that the pattern
    runs only where the term can stand; a term without letters or digits is compared with nothing.
    """
    return _standing(blocks, terms, "document_id", "idx", "block_id")


def dataset_mentions(blocks: DataFrame, configured: DataFrame | None = None, words: en.Words = en.Words()) -> DataFrame:
    """(document_id, key, name, block_id, idx): datasets named in entity blocks, configured ones before discovered ones."""
    body = entity_blocks(blocks).select("document_id", "idx", "block_id", "text")
    raw = body.where(F.lower("text").contains("dataset")).select("document_id", "idx", "block_id", F.posexplode(en.dataset_candidates("text")).alias("sub", "candidate"))
    found = en.with_dataset(raw, "candidate", "name", words).select("document_id", "idx", "sub", "block_id", "name")
    if configured is not None:
        known = vocabulary_mentions(body, configured).select("document_id", "idx", F.lit(-1).alias("sub"), "block_id", en.canonical_name("term", words).alias("name"))
        listed = first_mentions(known)
        fresh = first_mentions(found).join(listed.select("document_id", "key"), ["document_id", "key"], "left_anti")
        return listed.unionByName(fresh)
    return first_mentions(found)


def metric_mentions(blocks: DataFrame, words: en.Words = en.Words()) -> DataFrame:
    """(document_id, key, name, block_id, idx): metrics next to numbers."""
    raw = metric_blocks(blocks).select("document_id", "idx", "block_id", F.posexplode(en.metric_candidates("text", words)).alias("sub", "name"))
    return first_mentions(raw)


def result_sentences(blocks: DataFrame, most: int = 20) -> DataFrame:
    """First ``most`` sentences with a number and a capitalised name: (document_id, ord, block_id, sentence)."""
    rows = blocks.where(F.col("section_role").isin(*en.RESULT_ROLES)).select("document_id", "idx", "block_id", F.posexplode(en.sentences(F.coalesce("text", F.lit("")))).alias("sub", "sentence"))
    hits = rows.where(en.is_result(F.col("sentence"))).withColumn("sentence", tx.strip("sentence"))
    order = Window.partitionBy("document_id").orderBy("idx", "block_id", "sub")
    return hits.withColumn("ord", F.row_number().over(order)).where(F.col("ord") <= most).select("document_id", "ord", "block_id", "sentence")


def reference_blocks(blocks: DataFrame) -> DataFrame:
    inside = F.exists(F.coalesce("section_path", F.array().cast("array<string>")), lambda x: F.lower(x) == "references")
    return blocks.where((F.col("section_role") == "references") | inside)


def references(blocks: DataFrame) -> DataFrame:
    """Bibliography lines of at least 15 characters, numbered per document: raw, ref_index and the parsed fields."""
    body = reference_blocks(blocks).withColumn("text", tx.strip(F.coalesce("text", F.lit("")))).where(F.length("text") >= 10)
    lines = body.select("document_id", "block_id", "idx", F.posexplode(F.split("text", r"\r?\n")).alias("sub", "line")).withColumn("raw", tx.strip("line")).where(F.length("raw") >= 15)
    order = Window.partitionBy("document_id").orderBy("idx", "block_id", "sub")
    numbered = lines.withColumn("ref_index", F.row_number().over(order)).withColumn("f", en.reference_fields("raw"))
    return numbered.select("document_id", "block_id", "ref_index", "raw", F.col("f.title").alias("title"), F.col("f.authors").alias("authors"), F.col("f.year").alias("year"), F.col("f.doi").alias("doi"), F.col("f.arxiv_id").alias("arxiv_id"))


def reference_key(doi: F.Column, arxiv: F.Column, title: F.Column, raw: F.Column) -> F.Column:
    """Identity of a reference: DOI, else arXiv number, else title key."""
    return F.coalesce(F.concat(F.lit("doi:"), tx.fold(doi)), F.concat(F.lit("arxiv:"), tx.fold(arxiv)), F.concat(F.lit("title:"), tx.title_key(F.coalesce(title, raw))))


def distinct_references(refs: DataFrame, owner: str = "document_id") -> DataFrame:
    """The first reference of each key per owner; empty title keys are dropped."""
    keyed = refs.withColumn("key", reference_key(F.col("doi"), F.col("arxiv_id"), F.col("title"), F.col("raw"))).where("key <> 'title:'")
    rest = [c for c in keyed.columns if c not in (owner, "key")]
    return keyed.groupBy(owner, "key").agg(F.min_by(F.struct(*rest), "ref_index").alias("r")).select(owner, "key", "r.*")


def taxonomy_labels(blocks: DataFrame, aliases: DataFrame, evidence: int = 3) -> DataFrame:
    """Labels whose alias stands in a work's blocks: (work_id, facet, label_id, name, n_blocks, evidence).

    ``blocks``: work_id, document_id, idx, block_id, text; ``aliases``: facet, label_id, alias. ``evidence`` joins the
    first blocks in document and block order.
    """
    hits = vocabulary_mentions(blocks.select("document_id", "idx", "block_id", "text"), aliases.select(F.col("alias").alias("term")))
    labelled = hits.join(aliases.select("facet", "label_id", F.col("alias").alias("term")), "term").select("document_id", "idx", "block_id", "facet", "label_id").distinct()
    owned = labelled.join(blocks.select("work_id", "document_id", "idx", "block_id").distinct(), ["document_id", "idx", "block_id"])
    order = Window.partitionBy("work_id", "facet", "label_id").orderBy("document_id", "idx", "block_id")
    total = owned.groupBy("work_id", "facet", "label_id").agg(F.count("*").alias("n_blocks"))
    first = owned.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= evidence).groupBy("work_id", "facet", "label_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "block_id"))), lambda s: s["block_id"]), ",").alias("evidence"))
    return total.join(first, ["work_id", "facet", "label_id"]).select("work_id", "facet", "label_id", tx.display_name("label_id").alias("name"), "n_blocks", "evidence")


def work_labels(blocks: DataFrame, owner: DataFrame, aliases: DataFrame, limit: int = 100_000) -> DataFrame:
    """(work_id, facet, label_id) of :func:`taxonomy_labels` alone: no block is counted or named, so that repeated blocks need
    not be found. ``blocks``: document_id, text; ``owner``: work_id, document_id. Up to ``limit`` aliases (counted) are
    broadcast, so that no text is shuffled; more meet the blocks' tokens in a shuffle, with the same result.
    """
    aliases = cut(aliases.select("facet", "label_id", F.col("alias").alias("term")).distinct(), "aliases")
    few = aliases.count() <= limit
    hits = _standing(blocks, aliases, "document_id", few=few)
    labelled = hits.join(F.broadcast(aliases) if few else aliases, "term").select("document_id", "facet", "label_id").distinct()
    return labelled.join(owner, "document_id").select("work_id", "facet", "label_id").distinct()


def collections(labels: DataFrame, works: DataFrame) -> DataFrame:
    """(facet, label_id, n_works, titles): the works of each label, by title."""
    joined = labels.select("work_id", "facet", "label_id").distinct().join(works.select("work_id", "title"), "work_id")
    return joined.groupBy("facet", "label_id").agg(F.count("*").alias("n_works"), F.array_join(F.array_sort(F.collect_list(F.coalesce("title", F.lit("")))), "; ").alias("titles"))


def merged_vocabulary(layers: DataFrame) -> DataFrame:
    """(facet, label_id, alias) of the topmost layer of each label: ``layers`` has (layer, facet, label_id, alias)."""
    top = layers.groupBy("facet", "label_id").agg(F.max("layer").alias("layer"))
    return layers.join(top, ["facet", "label_id", "layer"]).select("facet", "label_id", "alias").distinct()
