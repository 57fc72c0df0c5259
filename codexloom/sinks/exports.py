"""Works and graphs as text rows, and their writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut

CSV_COLUMNS = ("work_id", "title", "authors", "year", "doi", "arxiv_id", "document_ids", "merge_status")


def _list(col: str, sep: str) -> Column:
    return F.array_join(F.coalesce(F.col(col), F.array().cast("array<string>")), sep)


def bibtex_rows(works: DataFrame) -> DataFrame:
    """(work_id, entry): one BibTeX entry per work; absent fields are left out."""
    first = F.element_at(F.split(F.get("authors", F.lit(0)), r"\s+"), -1)
    stem = F.regexp_replace(F.coalesce(first, F.lit("Paper")), "[^A-Za-z]", "")
    key = F.concat(stem, F.coalesce(F.col("year").cast("string"), F.substring("work_id", -6, 6)))
    authors = F.coalesce(F.nullif(_list("authors", " and "), F.lit("")), F.lit("Unknown"))
    lines = F.concat_ws(
        "\n", F.concat(F.lit("@article{"), key, F.lit(",")), F.concat(F.lit("  title = {{"), F.coalesce("title", F.lit("Untitled")), F.lit("}},")), F.concat(F.lit("  author = {"), authors, F.lit("},")),
        F.concat(F.lit("  year = {"), F.col("year").cast("string"), F.lit("},")), F.concat(F.lit("  doi = {"), F.nullif("doi", F.lit("")), F.lit("},")),
        F.concat(F.lit("  eprint = {"), F.nullif("arxiv_id", F.lit("")), F.lit("},\n  archivePrefix = {arXiv},")), F.concat(F.lit("  note = {Work ID: "), F.col("work_id"), F.lit("}")), F.lit("}"),
    )
    return works.select("work_id", lines.alias("entry"))


def csv_rows(works: DataFrame) -> DataFrame:
    """Flat text columns of works; lists joined by ``; ``."""
    lists = {c for c, kind in works.dtypes if kind.startswith("array")}
    return works.select(*[(_list(c, "; ") if c in lists else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in CSV_COLUMNS])


def jsonld_rows(works: DataFrame) -> DataFrame:
    """(work_id, json): a ScholarlyArticle per work; absent keys are left out."""
    people = F.when(F.size("authors") > 0, F.transform("authors", lambda a: F.struct(F.lit("Person").alias("@type"), a.alias("name"))))
    body = F.struct(F.lit("ScholarlyArticle").alias("@type"), F.col("work_id").alias("@id"), F.col("title").alias("name"), people.alias("author"), F.col("year").cast("string").alias("datePublished"), F.concat(F.lit("https://doi.org/"), F.nullif("doi", F.lit(""))).alias("sameAs"))
    return works.select("work_id", F.to_json(body).alias("json"))


def _xml(col: Column | str) -> Column:
    out = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


GRAPHML_OPEN = """<?xml version="1.0" encoding="utf-8"?>
<graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="label" for="node" attr.name="label" attr.type="string"/><key id="type" for="all" attr.name="type" attr.type="string"/><key id="weight" for="edge" attr.name="weight" attr.type="double"/><graph edgedefault="directed">"""


def numbered_edges(edges: DataFrame, buckets: int = 1_024) -> DataFrame:
    """``edges`` with ``number``, from 0 on without gaps: they are counted and ordered by source, target and type within
    buckets of a hash of these and then shifted by the buckets before, so that no single task sorts all edges."""
    ends = ("source", "target", "type")
    rows = cut(edges.withColumn("_bucket", F.pmod(F.xxhash64(*ends), F.lit(buckets))), "edges")
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_m"))
    before = counts.select("_bucket", (F.sum("_m").over(Window.orderBy("_bucket")) - F.col("_m")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*ends))
    return rows.withColumn("_inside", inside).join(F.broadcast(before), "_bucket").withColumn("number", F.col("_before") + F.col("_inside") - 1).drop("_bucket", "_inside", "_before")


def graphml_rows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, ord, xml): the lines of a GraphML file, whose parts are in descending order (opening, node, edge, close).

    A node without a label is called by its id; related edges are undirected, weights default to 1. Edges are numbered
    from 0 on (:func:`numbered_edges`).
    """
    node = F.concat(F.lit('<node id="'), _xml("id"), F.lit('"><data key="label">'), _xml(F.coalesce("label", "id")), F.lit('</data><data key="type">'), _xml(F.coalesce("type", F.lit("unknown"))), F.lit("</data></node>"))
    edge_id, kind = F.concat(F.lit("e"), F.col("number").cast("string")), F.coalesce("type", F.lit("related"))
    edge = F.concat(F.lit('<edge id="'), edge_id, F.lit('" source="'), _xml("source"), F.lit('" target="'), _xml("target"), F.lit('"'), F.when(F.col("type") == "related", ' directed="false"').otherwise(""), F.lit('><data key="type">'), _xml(kind), F.lit('</data><data key="weight">'), F.coalesce("weight", F.lit(1.0)).cast("string"), F.lit("</data></edge>"))
    lines = nodes.select(F.lit("node").alias("part"), F.col("id").alias("ord"), node.alias("xml")).unionByName(numbered_edges(edges).select(F.lit("edge").alias("part"), edge_id.alias("ord"), edge.alias("xml")))
    frame = nodes.sparkSession.createDataFrame([("opening", "", GRAPHML_OPEN), ("close", "", "</graph></graphml>")], "part string, ord string, xml string")
    return lines.unionByName(frame)


def markdown_blocks(blocks: DataFrame) -> DataFrame:
    """(document_id, block_id, markdown): images as links, headings with their level, else the text."""
    image = F.concat(F.lit("![]("), F.col("asset_path"), F.lit(")"), F.when(F.trim(F.coalesce("text", F.lit(""))) != "", F.concat(F.lit("\n\n"), F.trim("text"))).otherwise(""))
    heading = F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), F.col("heading_level")))), F.lit(" "), F.trim("text"))
    md = F.when(F.col("asset_path").isNotNull(), image).when(F.coalesce("heading_level", F.lit(0)) > 0, heading).otherwise(F.trim(F.coalesce("text", F.lit(""))))
    return blocks.select("document_id", "block_id", md.alias("markdown"))


def markdown_documents(blocks: DataFrame) -> DataFrame:
    """(document_id, markdown): the blocks of each document in order."""
    parts = markdown_blocks(blocks).join(blocks.select("block_id", "idx").distinct(), "block_id").where("markdown <> ''")
    return parts.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "block_id", "markdown"))), lambda s: s["markdown"]), "\n\n").alias("markdown"))


def rewrite_assets(markdown: Column, assets: dict[str, str]) -> Column:
    """Markdown with asset paths replaced, the longest first; image links to other local paths are removed."""
    for old, new in sorted(assets.items(), key=lambda kv: -len(kv[0])):
        markdown = F.replace(markdown, F.lit(f"]({old})"), F.lit(f"]({new})"))
    kept = "|".join(rf"\Q{new}\E" for new in assets.values()) or "(?!)"
    return F.regexp_replace(markdown, rf"!\[[^\]]*\]\((?!(?:{kept})\)|https?://)[^)]*\)", "")


def citation_report(edges: DataFrame, works: DataFrame, cited: DataFrame) -> DataFrame:
    """(work_id, title, citations): works by verified citations, most first, then the greater id."""
    return works.select("work_id", "title").join(cited.withColumnRenamed("target_work_id", "work_id"), "work_id").orderBy(F.desc("citations"), F.desc("work_id"))


def write_text(rows: DataFrame, column: str, path: str) -> None:
    rows.select(column).write.mode("overwrite").text(path)


def write_csv(works: DataFrame, path: str) -> None:
    csv_rows(works).write.mode("overwrite").option("header", True).csv(path)


def write_collections(rows: DataFrame, path: str) -> None:
    """One folder per facet; a dot in a label becomes an underscore."""
    rows.withColumn("file", F.replace("label_id", F.lit("."), F.lit("_"))).write.mode("overwrite").partitionBy("facet").json(path)


def publish(df: DataFrame, path: str, order: str | None = None) -> None:
    """Write beside ``path`` and swap, so that a reader sees the old or the new table and nothing between."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh, old = fs_path(path), fs_path(path + ".new"), fs_path(path + ".old")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (df.sortWithinPartitions(order) if order else df).write.mode("overwrite").parquet(path + ".new")
    fs.delete(old, True)
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(fresh, target)
    fs.delete(old, True)


def ranked(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` greatest rows, numbered."""
    top = rows.orderBy(F.desc(by)).limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(by))))
