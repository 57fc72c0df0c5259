"""Ordered blocks to sections, quality and role-limited selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .works import first_per_group

#: Roles, limits and field of each role-limited statement list.
FIELDS = (("research_problem", ("abstract", "introduction"), 2), ("methodology", ("methodology",), 6), ("contributions", ("abstract", "conclusion"), 2), ("results", ("results",), 6), ("limitations", ("limitations",), 3), ("discussion", ("discussion",), 5), ("ablations", ("results",), 4))
ABSTRACT_FALLBACK = 2


def text_blocks(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Non-blank lines of texts as blocks: (document_id, idx, text)."""
    lines = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("document_id"), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("idx", "line"))
    return lines.select("document_id", "idx", tx.strip("line").alias("text")).where("text <> ''")


def section_fold(blocks: DataFrame) -> DataFrame:
    """Blocks (document_id, idx, heading_level, text) with ``section_role`` and ``section_path``.

    A heading (a level and a text) sets the role and its place in the path: the path before is cut to level - 1 entries,
    whatever their levels were. Other text that starts with "abstract" opens an abstract. Blocks before any heading are
    front matter of unknown role. Only the headings are folded, by windows: a block meets the heading whose number is the
    count of headings up to its place, so that a huge document takes time in proportion and its join is spread.
    """
    text = tx.strip(F.coalesce("text", F.lit("")))
    heading = (F.coalesce("heading_level", F.lit(0)) > 0) & (text != "")
    opening = ~heading & text.rlike(r"(?i)^abstract\b")
    rows = blocks.withColumn("_h", heading).withColumn("_o", opening)
    level = F.when(F.col("_h"), F.col("heading_level").cast("long")).otherwise(F.lit(1)).alias("level")
    name, role = F.when(F.col("_h"), text).otherwise("Abstract").alias("name"), F.when(F.col("_h"), tx.heading_role(text)).otherwise("abstract").alias("role")
    # The depth is the least of the level and the depth before plus one, hence a running minimum but for the event's number.
    order = Window.partitionBy("document_id").orderBy("idx", "level", "name", "role")
    events = rows.where("_h or _o").select("document_id", "idx", level, name, role).withColumn("_n", F.row_number().over(order).cast("long"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    events = events.withColumn("depth", F.col("_n") + F.least(F.lit(0), F.min(F.col("level") - F.col("_n")).over(upto)))
    # Each entry of a path is the last event of its depth, as what lies between goes deeper.
    places = events.select("document_id", "_n", "role", "depth", "name", F.explode(F.sequence(F.lit(1).cast("long"), "depth")).alias("place"))
    entry = F.last(F.when(F.col("place") == F.col("depth"), F.col("name")), ignorenulls=True).over(Window.partitionBy("document_id", "place").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0))
    paths = places.withColumn("entry", entry).groupBy("document_id", "_n", "role").agg(F.array_sort(F.collect_list(F.struct("place", "entry"))).alias("p")).select("document_id", "_n", "role", F.col("p.entry").alias("path"))
    so_far = F.coalesce(F.sum((F.col("_h") | F.col("_o")).cast("long")).over(Window.partitionBy("document_id").orderBy("idx")), F.lit(0))
    out = rows.withColumn("_n", so_far).join(paths.withColumnsRenamed({"role": "_role", "path": "_path"}), ["document_id", "_n"], "left")
    return out.select(*[F.col(c) for c in blocks.columns if c not in ("section_role", "section_path")], F.coalesce("_role", F.lit("unknown")).alias("section_role"), F.coalesce("_path", F.array(F.lit("Front matter"))).alias("section_path"))


def block_quality(blocks: DataFrame) -> DataFrame:
    """Per document: counts, characters, headings, share of empty blocks, pages, reasons and status."""
    bare = F.length(tx.strip(F.coalesce("text", F.lit(""))))
    per = blocks.groupBy("document_id").agg(F.count("*").alias("block_count"), F.sum(bare).alias("character_count"), F.count_if(F.coalesce("heading_level", F.lit(0)) > 0).alias("heading_count"), F.round(F.avg((bare == 0).cast("int")), 4).alias("empty_block_fraction"), (F.max("page_index") + 1).alias("page_count"))
    reasons = F.concat_ws(",", F.when(F.col("character_count") < 500, "very_low_text"), F.when(F.col("block_count") < 3, "very_few_blocks"), F.when(F.col("empty_block_fraction") > 0.5, "many_empty_blocks"))
    return per.withColumn("reasons", reasons).withColumn("status", F.when(F.col("reasons") == "", "accepted").otherwise("review_needed"))


def substantive(blocks: DataFrame) -> DataFrame:
    """Blocks with at least 80 characters that are no header, footer or footnote."""
    return blocks.where(~F.coalesce("type", F.lit("")).isin("header", "footer", "page_footnote") & (F.length(tx.strip("text")) >= 80))


def select_statements(blocks: DataFrame, fields: tuple = FIELDS) -> DataFrame:
    """First substantive blocks per document and field: (document_id, field, ord, block_id, statement).

    One shuffle for all fields. Without methodology the first two abstract blocks stand in; ablations are the first
    result blocks that mention ablation, taken before filtering.
    """
    body = substantive(blocks).select("document_id", "idx", "block_id", "section_role", tx.strip("text").alias("statement"))
    table = F.array(*[F.struct(F.lit(name).alias("field"), F.array(*[F.lit(r) for r in roles]).alias("roles"), F.lit(limit).alias("most")) for name, roles, limit in (*fields, ("_fallback", ("abstract",), ABSTRACT_FALLBACK))])
    wanted = body.select("*", F.explode(table).alias("f")).where(F.expr("array_contains(f.roles, section_role)")).select("document_id", "idx", "block_id", "statement", "f.field", "f.most")
    order = Window.partitionBy("document_id", "field").orderBy("idx", "block_id")
    top = max(limit for _, _, limit in fields)
    ranked = wanted.withColumn("ord", F.row_number().over(order)).where(F.col("ord") <= top).where("ord <= most").drop("most")
    has = ranked.groupBy("document_id").agg(F.max(F.col("field") == "methodology").alias("has"))
    ranked = ranked.join(has, "document_id").where("not (field = '_fallback' and has)").withColumn("field", F.when(F.col("field") == "_fallback", "methodology").otherwise(F.col("field"))).drop("has")
    return ranked.where((F.col("field") != "ablations") | F.lower("statement").contains("ablation")).select("document_id", "field", "ord", "block_id", "statement")


def prompt_budget(blocks: DataFrame, roles: tuple[str, ...], first: int = 80, per_block: int = 1800, total: int = 60_000) -> DataFrame:
    """Texts of at most ``total`` characters per document from its first blocks of the roles: (document_id, prompt)."""
    rows = first_per_group(blocks.where(F.col("section_role").isin(*roles)), ["document_id"], ["idx", "block_id"], first)
    line = F.concat(F.lit("["), F.col("block_id"), F.lit("] "), F.left("text", F.lit(per_block)))
    parts = rows.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("idx", "block_id", line.alias("line")))).alias("parts"))
    return parts.select("document_id", F.left(F.array_join("parts.line", "\n"), F.lit(total)).alias("prompt"))
