"""Markdown reports: ordered string aggregation per work, then one row per report section.

A report is a table (ord, markdown) whose rows in order are the file, so that writing it is a sorted write and no task
holds all works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def _bullets(rows: DataFrame, keys: list[str], order: list[str], line: Column, out: str) -> DataFrame:
    """Ordered bullet lines of each group, joined."""
    listed = F.array_sort(F.collect_list(F.struct(*order, line.alias("line"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda s: F.concat(F.lit("- "), s["line"])), "\n").alias(out))


def statement_report(works: DataFrame, statements: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(ord, markdown): per work, by title, its statements of some fields with their evidence.

    ``statements``: work_id, field, ord, statement, locator.
    """
    marked = statements.where(F.col("field").isin(*fields)).withColumn("line", F.concat_ws(" ", F.col("statement"), F.concat(F.lit("`["), F.col("locator"), F.lit("]`"))))
    per_field = _bullets(marked, ["work_id", "field"], ["ord", "statement"], F.col("line"), "lines")
    heading = F.concat(F.lit("### "), F.initcap(F.replace("field", F.lit("_"), F.lit(" "))), F.lit("\n\n"), F.col("lines"))
    place = F.coalesce(*[F.when(F.col("field") == f, F.lit(i)) for i, f in enumerate(fields)])
    body = per_field.groupBy("work_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), heading.alias("text")))), lambda s: s["text"]), "\n\n").alias("body"))
    joined = works.select("work_id", F.coalesce("title", F.lit("Untitled")).alias("title")).join(body, "work_id", "left")
    text = F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.coalesce("body", F.lit("No evidence found.")))
    return joined.select(F.concat_ws("\0", F.lower("title"), "work_id").alias("ord"), text.alias("markdown"))


def dataset_index(works: DataFrame, datasets: DataFrame, longest: int = 40) -> DataFrame:
    """(name, n_works, works): the works of each dataset name, first spelling shown, repeated works once."""
    named = datasets.where((F.length(tx.strip("name")) > 0) & (F.length("name") <= longest)).withColumn("key", tx.fold(tx.strip("name")))
    joined = named.join(works.select("work_id", F.coalesce("title", F.lit("Untitled")).alias("title")), "work_id")
    return joined.groupBy("key").agg(F.min_by(tx.strip("name"), F.struct("work_id", "name")).alias("name"), F.countDistinct("work_id").alias("n_works"), F.array_join(F.array_sort(F.collect_set("title")), "; ").alias("works")).drop("key")


def facet_index(works: DataFrame, labels: DataFrame) -> DataFrame:
    """(facet, name, n_works, works)."""
    joined = labels.select("work_id", "facet", "name").distinct().join(works.select("work_id", F.coalesce("title", F.lit("Untitled")).alias("title")), "work_id")
    return joined.groupBy("facet", "name").agg(F.count("*").alias("n_works"), F.array_join(F.array_sort(F.collect_list("title")), "; ").alias("works"))


def reference_report(works: DataFrame, references: DataFrame) -> DataFrame:
    """(ord, markdown): the distinct references of each work in order."""
    first = references.groupBy("work_id", "raw").agg(F.min("ref_index").alias("ref_index"))
    lists = _bullets(first, ["work_id"], ["ref_index"], F.col("raw"), "lines")
    joined = works.select("work_id", F.coalesce("title", F.lit("Untitled")).alias("title")).join(lists, "work_id")
    return joined.select(F.concat_ws("\0", F.lower("title"), "work_id").alias("ord"), F.concat(F.lit("## "), F.col("title"), F.lit("\n\n"), F.col("lines")).alias("markdown"))


def all_works_report(works: DataFrame) -> DataFrame:
    """(ord, markdown): one line per work with authors, year and identifiers."""
    line = F.concat_ws(" ", F.concat(F.lit("- **"), F.coalesce("title", F.lit("Untitled")), F.lit("**")), F.concat(F.lit("— "), F.nullif(F.array_join(F.coalesce("authors", F.array().cast("array<string>")), ", "), F.lit(""))), F.concat(F.lit("("), F.col("year").cast("string"), F.lit(")")), F.concat(F.lit("doi:"), F.nullif("doi", F.lit(""))), F.concat(F.lit("arXiv:"), F.nullif("arxiv_id", F.lit(""))))
    return works.select(F.concat_ws("\0", F.lower(F.coalesce("title", F.lit("Untitled"))), "work_id").alias("ord"), line.alias("markdown"))


def audit_report(audit: DataFrame, suspicious: DataFrame) -> DataFrame:
    """(ord, markdown): key figures, then doubtful names with their reasons."""
    figures = audit.select(F.concat(F.lit("0\0"), "measure").alias("ord"), F.concat(F.lit("- "), F.replace("measure", F.lit("_"), F.lit(" ")), F.lit(": "), F.col("value").cast("string")).alias("markdown"))
    doubts = suspicious.select(F.concat(F.lit("1\0"), "name").alias("ord"), F.concat(F.lit("- `"), "name", F.lit("`: "), "reasons").alias("markdown"))
    return figures.unionByName(doubts)


def write_report(rows: DataFrame, title: str, path: str) -> None:
    """Write a report's rows in order below its title."""
    spark = rows.sparkSession
    head = spark.createDataFrame([("", f"# {title}")], "ord string, markdown string")
    head.unionByName(rows).orderBy("ord").select(F.concat("markdown", F.lit("\n")).alias("markdown")).write.mode("overwrite").text(path)
