"""Files to works: exact duplicates, title groups, fuzzy clusters, format policy, identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..storage import cut
from .components import connected_components


def exact_duplicates(files: DataFrame, key: str = "sha256", order: str = "path") -> DataFrame:
    """Per file its canonical copy, the least ``order`` with the same content: adds ``canonical`` and ``is_duplicate``.

    Files with a null hash are their own copy."""
    least = files.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("canonical"))
    joined = files.join(least, key, "left")
    return joined.withColumn("canonical", F.coalesce("canonical", order)).withColumn("is_duplicate", F.col("canonical") != F.col(order))


def already_known(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    """``files`` with ``action``: already_ingested if the manifest has the hash, else not_copied for repeats, else new."""
    known = manifest.select(key).where(F.col(key).isNotNull()).distinct().withColumn("known", F.lit(True))
    marked = exact_duplicates(files, key).join(known, key, "left")
    return marked.withColumn("action", F.when(F.col("known"), "already_ingested").when(F.col("is_duplicate"), "not_copied").otherwise("new")).drop("known")


def title_groups(files: DataFrame) -> DataFrame:
    """``files`` (document_id, idx, work_id, title_key, doi, arxiv_id, known) with ``group_work_id``.

    Files with an equal non-empty title key are one work if they have at most one published DOI and at most one arXiv
    number among them: the id of the first file known before, else of the first file.
    """
    published = F.when(~tx.is_preprint_doi("doi"), tx.normal_doi("doi"))
    groups = files.where("title_key <> ''").groupBy("title_key").agg(F.count("*").alias("n"), F.countDistinct(published).alias("dois"), F.countDistinct(tx.normal_arxiv("arxiv_id")).alias("arxivs"), F.min_by("work_id", F.struct(~F.coalesce("known", F.lit(False)), F.col("idx"))).alias("first_work_id"))
    merged = groups.where("n >= 2 and dois <= 1 and arxivs <= 1").select("title_key", "first_work_id")
    return files.join(merged, "title_key", "left").withColumn("group_work_id", F.coalesce("first_work_id", "work_id")).drop("first_work_id")


def alike_keys(left: DataFrame, right: DataFrame | None, threshold: float, rows_per_cell: int = 2_000) -> DataFrame:
    """Pairs (a, b), among them all with ratio >= threshold, of the keys ``a`` of ``left`` and ``b`` of ``right``; without
    ``right``, of those of ``left``, each pair once with a < b.

    The bounds lose no pair: blocks of ``rows_per_cell`` keys of like lengths meet, as a ratio bounds the factor of the
    lengths; the common bag of signs of all their pairs is a product of matrices, and the longest common subsequence
    bounds the matching blocks. At low thresholds nothing but these bounds tells keys apart, so that the work grows with
    the square of the keys, but only pairs that pass them leave a task.
    """
    x = cut(sim.blocks_of_keys(left, rows_per_cell), "left-keys")
    y = x if right is None else cut(sim.blocks_of_keys(right, rows_per_cell), "right-keys")
    bound = lambda n, m: F.col(n) * (2 - threshold) >= F.col(m) * threshold - 1e-9
    near = bound("high", "low_") & bound("high_", "low")
    return sim.meet_in_blocks(x, y, near & (F.col("block") <= F.col("block_")) if right is None else near, sim.alike_in_blocks(threshold, right is None), "a string, b string")


def fuzzy_key_pairs(files: DataFrame, threshold: float = 0.75) -> DataFrame:
    """All pairs of different title keys with ratio >= threshold: (left_key, right_key, ratio), left_key < right_key."""
    met = alike_keys(files.select("title_key").where("title_key <> ''").distinct(), None, threshold)
    return met.withColumn("ratio", sim.ratio_at_least(threshold)("a", "b")).where("ratio > 0").select(F.col("a").alias("left_key"), F.col("b").alias("right_key"), F.round("ratio", 4).alias("ratio"))


def match_candidates(files: DataFrame, threshold: float = 0.75, all_pairs: int = 60) -> DataFrame:
    """All pairs of files of different works with ratio >= threshold: (left_document_id, right_document_id, ratio).

    ``files``: document_id, work_id, title_key. The smaller id is the left one, and the ratio is that of its key to the
    other's. Up to ``all_pairs`` files (counted) every pair of keys is compared, beyond that those that pass the bounds of
    :func:`alike_keys`, which lose none: the result is the same.
    """
    rows = files.where("title_key <> '' and document_id is not null").select("document_id", "work_id", "title_key")
    keys = rows.select("title_key").distinct()
    if rows.limit(all_pairs + 1).count() <= all_pairs:
        met = keys.toDF("a").join(keys.toDF("b"), F.col("a") < F.col("b"))
    else:
        met = alike_keys(keys, None, threshold)
    repeated = rows.groupBy("title_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("title_key").alias("left_key"), F.col("title_key").alias("right_key"))
    both = met.select(F.explode(F.array(F.struct(F.col("a").alias("left_key"), F.col("b").alias("right_key")), F.struct(F.col("b").alias("left_key"), F.col("a").alias("right_key")))).alias("p")).select("p.*")
    pairs = cut(both.unionByName(repeated).withColumn("ratio", sim.ratio_at_least(threshold)("left_key", "right_key")).where("ratio > 0"), "alike-titles")
    side = lambda s: rows.select(F.col("document_id").alias(f"{s}_document_id"), F.col("work_id").alias(f"{s}_work"), F.col("title_key").alias(f"{s}_key"))
    met = pairs.join(side("left"), "left_key").join(side("right"), "right_key").where("left_document_id < right_document_id and not (left_work <=> right_work)")
    return met.select("left_document_id", "right_document_id", F.round("ratio", 4).alias("ratio"))


def trigram_candidates(files: DataFrame, rows_per_cell: int = 3_000) -> DataFrame:
    """Pairs of files that share at least half of the fewer trigrams of their title keys (at least one):
    (left_document_id, right_document_id, shared, least).

    Distinct keys meet in blocks (:func:`similarity.shared_grams`); postings or pairs of keys are never shuffled, as half
    of the trigrams of a title holds common ones, whose lists grow with the square of the keys."""
    distinct = files.select("title_key").where("title_key <> ''").distinct()
    blocks = cut(sim.blocks_of_keys(distinct, rows_per_cell), "title-keys")
    shared = sim.meet_in_blocks(blocks, blocks, F.col("block") <= F.col("block_"), sim.shared_grams, "a string, b string, shared long, least long")
    length = F.greatest(F.lit(1), F.length("title_key") - 2)
    own = F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), length), lambda p: F.substr(F.col("title_key"), p, F.lit(3))))).cast("long")
    same = files.where("title_key <> ''").groupBy("title_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("title_key").alias("a"), F.col("title_key").alias("b"), own.alias("shared"), own.alias("least"))
    pairs = shared.unionByName(same)
    left = files.select(F.col("title_key").alias("a"), F.col("document_id").alias("da"))
    right = files.select(F.col("title_key").alias("b"), F.col("document_id").alias("db"))
    out = pairs.join(left, "a").join(right, "b").where("da <> db and (a <> b or da < db)")
    return out.select(F.least("da", "db").alias("left_document_id"), F.greatest("da", "db").alias("right_document_id"), "shared", F.col("least").cast("long").alias("least"))


def fuzzy_edges(files: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Edges (src, dst) between files whose titles are alike and whose identities do not conflict.

    Conflict: different published DOIs, different arXiv numbers, or author lists without a common surname. Equal keys
    are linked to one file of the key, not to each other.
    """
    published = F.when(~tx.is_preprint_doi("doi"), tx.normal_doi("doi"))
    info = cut(files.select("document_id", "title_key", published.alias("pdoi"), tx.normal_arxiv("arxiv_id").alias("parxiv"), tx.surnames("authors").alias("names")).where("title_key <> ''"), "fuzzy-files")
    pairs = fuzzy_key_pairs(info, threshold).select("left_key", "right_key").unionByName(info.groupBy("title_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("title_key").alias("left_key"), F.col("title_key").alias("right_key")))
    side = lambda s: info.select(*[F.col(c).alias(f"{s}_{c}") for c in info.columns])
    met = pairs.join(side("l"), F.col("left_key") == F.col("l_title_key")).join(side("r"), F.col("right_key") == F.col("r_title_key")).where("l_document_id <> r_document_id and (left_key <> right_key or l_document_id < r_document_id)")
    clash = (F.col("l_pdoi") != F.col("r_pdoi")) | (F.col("l_parxiv") != F.col("r_parxiv"))
    strangers = (F.size("l_names") > 0) & (F.size("r_names") > 0) & ~F.arrays_overlap("l_names", "r_names")
    return met.where(~F.coalesce(clash, F.lit(False)) & ~strangers).select(F.col("l_document_id").alias("src"), F.col("r_document_id").alias("dst")).distinct()


def cluster_works(files: DataFrame, edges: DataFrame) -> DataFrame:
    """(document_id, cluster_work_id): the component's first file known before, else its first file, gives the id."""
    comp = connected_components(edges).withColumnRenamed("node", "document_id")
    inside = files.join(comp, "document_id")
    chosen = inside.groupBy("component").agg(F.min_by("work_id", F.struct(~F.coalesce("known", F.lit(False)), F.col("idx"))).alias("cluster_work_id"))
    named = inside.join(chosen, "component").select("document_id", "cluster_work_id")
    return files.join(named, "document_id", "left").select("document_id", F.coalesce("cluster_work_id", "work_id").alias("cluster_work_id"))


def format_policy(files: DataFrame, order: str = "document_id") -> DataFrame:
    """``files`` (work_id, format, extractable) with ``selected`` and ``reason``: of each work the extractable files of
    the best format; others are alternates of the first of these. Aggregates, so that a huge work is no sorted group."""
    rank = F.coalesce(*[F.when(F.col("format") == k, F.lit(v)) for k, v in tx.FORMATS.items()], F.lit(len(tx.FORMATS)))
    able = F.coalesce(F.col("extractable"), F.lit(True))
    ranked = files.withColumn("_rank", rank)
    best = ranked.groupBy("work_id").agg(F.count("*").alias("_n"), F.min(F.when(able, F.col("_rank"))).alias("_best"), F.min_by(order, F.when(able, F.struct("_rank", order))).alias("_first"))
    joined = ranked.join(best, "work_id", "left")
    chosen = F.coalesce(able & (F.col("_rank") == F.col("_best")), F.lit(False))
    reason = F.when(~able, "not_extractable").when(chosen & (F.col("_n") == 1), "only_representation").when(chosen, "preferred_format").otherwise(F.concat(F.lit("alternate_of:"), F.col("_first")))
    return joined.withColumn("selected", chosen).withColumn("reason", reason).drop("_rank", "_n", "_best", "_first")


def strong_identities(works: DataFrame) -> DataFrame:
    """Pairs of works with the same DOI, else the same arXiv number: (left_work_id, right_work_id, identity)."""
    keys = works.select("work_id", F.explode(F.array_compact(F.array(F.concat(F.lit("doi:"), tx.normal_doi("doi")), F.concat(F.lit("arxiv:"), tx.normal_arxiv("arxiv_id"))))).alias("identity"))
    met = keys.alias("l").join(keys.alias("r"), (F.col("l.identity") == F.col("r.identity")) & (F.col("l.work_id") < F.col("r.work_id")))
    return met.groupBy(F.col("l.work_id").alias("left_work_id"), F.col("r.work_id").alias("right_work_id")).agg(F.max(F.col("l.identity")).alias("identity"))


def auto_merges(works: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Merges that need no review: (primary, merged, identity, similarity), the smaller id being the primary.

    Works with an equal identifier whose titles reach the ratio ``threshold`` and whose other identifiers do not
    conflict. The table is the log of the merge; pairs that fail one of the tests stay for the review.
    """
    info = works.select("work_id", tx.title_key("title").alias("key"), tx.normal_doi("doi").alias("doi"), tx.normal_arxiv("arxiv_id").alias("arxiv"))
    side = lambda s: info.select(*[F.col(c).alias(f"{s}_{c}") for c in info.columns])
    met = strong_identities(works).join(side("l"), F.col("left_work_id") == F.col("l_work_id")).join(side("r"), F.col("right_work_id") == F.col("r_work_id"))
    clash = F.coalesce(F.col("l_doi") != F.col("r_doi"), F.lit(False)) | F.coalesce(F.col("l_arxiv") != F.col("r_arxiv"), F.lit(False))
    alike = met.where(~clash).withColumn("similarity", sim.ratio_at_least(threshold)("l_key", "r_key")).where("similarity > 0")
    return alike.select(F.col("left_work_id").alias("primary"), F.col("right_work_id").alias("merged"), "identity", F.round("similarity", 4).alias("similarity"))


def merge_works(works: DataFrame, merges: DataFrame) -> DataFrame:
    """Works after merging (primary, merged): document ids united, missing values filled, in a new snapshot.

    ``merges`` may chain; each component has the least primary id as its survivor. A work named nowhere stays as it is.
    """
    comp = connected_components(merges, "primary", "merged").withColumnRenamed("node", "work_id")
    joined = works.join(comp, "work_id", "left").withColumn("target", F.coalesce("component", "work_id"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(F.col("work_id") != F.col("target"), F.col("work_id")))).alias(c)
    documents = F.array_sort(F.array_distinct(F.flatten(F.collect_list("document_ids")))).alias("document_ids")
    out = joined.groupBy("target").agg(first("title"), first("authors"), first("year"), first("doi"), first("arxiv_id"), documents, F.count("*").alias("n_merged"))
    status = F.when(F.col("n_merged") > 1, "merged").otherwise("unreviewed")
    return out.withColumnRenamed("target", "work_id").withColumn("merge_status", status)


def review_queue(candidates: DataFrame, works_of: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """Match candidates (left_document_id, right_document_id, similarity) still open: of different works and undecided."""
    side = lambda s: works_of.select(F.col("document_id").alias(f"{s}_document_id"), F.col("work_id").alias(f"{s}_work_id"))
    rows = candidates.join(side("left"), "left_document_id").join(side("right"), "right_document_id").where("left_work_id <> right_work_id")
    if decisions is not None:
        rows = rows.join(decisions.select("left_document_id", "right_document_id"), ["left_document_id", "right_document_id"], "left_anti")
    return rows


def latest_title(documents: DataFrame) -> DataFrame:
    """(work_id, title) of the last document of each work, the one whose title a work takes."""
    return documents.groupBy("work_id").agg(F.max_by("title", "document_id").alias("title"))


def first_per_group(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark prunes each partition to n rows a group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")
