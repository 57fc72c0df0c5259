"""Files and documents as tables: discovery, HTML, DOCX, parser JSON, TEI, tolerant JSON, vocabularies."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import Any
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

SUPPORTED = ("pdf", "docx", "html", "htm")
BLOCKS = "path string, idx int, type string, heading_level int, page_index int, text string"
#: HTML tags that open a block, and those whose content is no text.
BLOCK_TAGS = {"title": "title", "p": "paragraph", "li": "list_item", "blockquote": "quote", "figcaption": "caption", **{f"h{n}": "heading" for n in range(1, 7)}}
SILENT_TAGS = frozenset(("script", "style", "nav"))


def _outside_corpora(files: DataFrame) -> DataFrame:
    """Files that lie in no folder that is itself a generated corpus (it holds ``manifests/last_pipeline.json``).

    Every file meets the roots by its folders, an equal join."""
    roots = files.where(F.col("path").endswith("/manifests/last_pipeline.json")).select(F.regexp_replace("path", "/manifests/last_pipeline.json$", "").alias("folder"))
    parts = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    nested = files.select("path", F.explode(folders).alias("folder")).join(roots, "folder", "left_semi").select("path").distinct()
    return files.join(nested, "path", "left_anti")


def discover(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, format, supported) of all files below a folder of any Hadoop file system.

    Files below a folder that is itself a generated corpus (it holds ``manifests/last_pipeline.json``) are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return _outside_corpora(files).withColumn("format", tx.file_format("path")).withColumn("supported", F.col("format").isNotNull()).orderBy("path")


def read_content(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, sha256) of the supported files that :func:`discover` finds."""
    wanted = discover(spark, path).where("supported").select("path")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(tx.file_format("path").isNotNull())
    return files.join(wanted, "path", "left_semi").select("path", "content", F.sha2("content", 256).alias("sha256"))


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """(stem, json, size) of the layout parser's outputs below a folder, the largest of each stem: ``<stem>.json``,
    ``<stem>_content_list.json`` or ``<stem>_middle.json``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)\.json$", 1), "_(?:content_list|middle)$", "")
    return files.groupBy(stem.alias("stem")).agg(F.max_by(F.struct(F.col("content").cast("string").alias("json"), F.col("length").alias("size")), F.struct("length", "path")).alias("r")).select("stem", "r.*")


def pdf_preflight(files: DataFrame) -> DataFrame:
    """Adds ``preflight``: accepted if the content starts as a PDF does, failed if not, not_applicable for other formats."""
    start = F.substring("content", 1, 5).cast("string")
    return files.withColumn("preflight", F.when(tx.file_format("path") != "pdf", "not_applicable").when(start == "%PDF-", "accepted").otherwise("failed"))


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, int | None, str]] = []
        self.kind: str | None = None
        self.level: int | None = None
        self.pieces: list[str] = []
        self.silent = 0
        self.meta: dict[str, list[str]] = {}

    def flush(self) -> None:
        text = " ".join(" ".join(self.pieces).split())
        if self.kind and text:
            self.rows.append((self.kind, self.level, text))
        self.kind, self.level, self.pieces = None, None, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SILENT_TAGS:
            self.silent += 1
        elif tag == "meta":
            named = dict(attrs)
            if named.get("name") and named.get("content"):
                self.meta.setdefault(named["name"].lower(), []).append(named["content"])
        elif tag in BLOCK_TAGS and not self.silent:
            self.flush()
            self.kind = BLOCK_TAGS[tag]
            self.level = 1 if tag == "title" else int(tag[1]) if self.kind == "heading" else None

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT_TAGS:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCK_TAGS:
            self.flush()

    def handle_data(self, data: str) -> None:
        if self.kind and not self.silent and data.strip():
            self.pieces.append(data)


def _parse_html(text: str) -> _Blocks:
    parser = _Blocks()
    parser.feed(text)
    parser.flush()
    return parser


def _frame(parsed: list[tuple[str, list[tuple]]]) -> pd.DataFrame:
    """One frame for all files of a batch."""
    return pd.DataFrame([(path, i, *row) for path, rows in parsed for i, row in enumerate(rows)], columns=["path", "idx", "type", "heading_level", "page_index", "text"]).astype({"heading_level": "Int32", "page_index": "Int32", "idx": "int32"})


def html_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of HTML pages (path, html): title, headings, paragraphs, list items, quotes, captions; a new block closes the
    one before; text of scripts, styles and navigation is left out. Null pages have no blocks."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _frame([(p, [(k, level, None, t) for k, level, t in _parse_html(h).rows]) for p, h in zip(pdf.path, pdf.html) if h])

    return pages.select("path", "html").mapInPandas(parse, BLOCKS)


def html_metadata(pages: DataFrame) -> DataFrame:
    """(path, title, authors, year): h1 before title; author metas in order; the first year in a date meta."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, text in zip(pdf.path, pdf.html):
                p = _parse_html(text or "")
                heads = [t for k, level, t in p.rows if k == "heading" and level == 1]
                titles = [t for k, _, t in p.rows if k == "title"]
                authors = [a for name in ("author", "citation_author", "dc.creator") for a in p.meta.get(name, [])]
                dates = [d for name in ("citation_publication_date", "citation_date", "dc.date", "date") for d in p.meta.get(name, [])]
                rows.append((path, (heads + titles + [None])[0], list(dict.fromkeys(authors)), (dates + [None])[0]))
            yield pd.DataFrame(rows, columns=["path", "title", "authors", "date"])

    raw = pages.select("path", "html").mapInPandas(parse, "path string, title string, authors array<string>, date string")
    year = F.try_to_number(F.nullif(F.regexp_extract("date", "((?:19|20)[0-9]{2})", 1), F.lit("")), F.lit("9999")).cast("int")
    return raw.select("path", tx.clean_title("title").alias("title"), F.filter(F.transform("authors", tx.clean_title), lambda a: F.length(a).between(2, 100)).alias("authors"), year.alias("year"))


_WORD_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx(content: bytes) -> tuple[list[tuple], dict[str, Any]]:
    rows: list[tuple] = []
    meta: dict[str, Any] = {"title": None, "authors": [], "error": None}
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = set(archive.namelist())
            if "docProps/core.xml" in names:
                for element in ElementTree.fromstring(archive.read("docProps/core.xml")).iter():
                    if element.tag.endswith("}title"):
                        meta["title"] = element.text
                    elif element.tag.endswith("}creator") and element.text:
                        meta["authors"].append(element.text)
            for paragraph in ElementTree.fromstring(archive.read("word/document.xml")).iter(f"{_WORD_NS}p"):
                text = " ".join("".join(t.text or "" for t in paragraph.iter(f"{_WORD_NS}t")).split())
                style = next((s.get(f"{_WORD_NS}val", "") for s in paragraph.iter(f"{_WORD_NS}pStyle")), "").lower()
                if text:
                    level = 1 if style == "title" else int(style[-1]) if style.startswith("heading") and style[-1:].isdigit() else None
                    rows.append(("heading" if level else "paragraph", level, None, text))
    except Exception as error:  # noqa: BLE001 - one broken file must not end the batch
        meta["error"] = f"{type(error).__name__}: {error}"[:200]
    return rows, meta


def docx_blocks(files: DataFrame) -> DataFrame:
    """Blocks of DOCX files (path, content); broken archives have none (see :func:`docx_metadata` for their error)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _frame([(p, _docx(c)[0]) for p, c in zip(pdf.path, pdf.content) if c is not None])

    return files.select("path", "content").mapInPandas(parse, BLOCKS)


def docx_metadata(files: DataFrame) -> DataFrame:
    """(path, title, authors, error)."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            metas = [_docx(c or b"")[1] for c in pdf.content]
            yield pd.DataFrame({"path": list(pdf.path), "title": [m["title"] for m in metas], "authors": [m["authors"] for m in metas], "error": [m["error"] for m in metas]})

    return files.select("path", "content").mapInPandas(parse, "path string, title string, authors array<string>, error string")


def _texts(node: Any) -> list[str]:
    if isinstance(node, str):
        return [node.strip()] if node.strip() else []
    if isinstance(node, list):
        return [t for x in node for t in _texts(x)]
    if isinstance(node, dict):
        return [t for key in ("text", "content") for t in _texts(node.get(key))]
    return []


def _flatten(node: Any, page: int | None) -> list[tuple]:
    """Blocks below a node, with the page index inherited from above."""
    if isinstance(node, list):
        return [row for x in node for row in _flatten(x, page)]
    if not isinstance(node, dict):
        return []
    found = node.get("page_idx", page)
    page = found if isinstance(found, int) and not isinstance(found, bool) else page
    inner = [node[k] for k in ("pages", "blocks", "pdf_info", "para_blocks", "children") if isinstance(node.get(k), list)]
    if inner:
        return [row for x in inner for row in _flatten(x, page)]
    lines = [t for key in ("text", "table_caption", "table_body", "table_footnote", "image_caption", "image_footnote") for t in _texts(node.get(key))]
    if not lines:
        lines = _texts(node.get("content"))
    if not (lines or node.get("img_path") or node.get("type")):
        return []
    level = node.get("text_level")
    return [(str(node.get("type") or "text"), level if isinstance(level, int) and level > 0 else None, page, "\n".join(dict.fromkeys(lines)))]


def parser_json_blocks(files: DataFrame) -> DataFrame:
    """Blocks of layout-parser output (path, json): flat lists, pages of blocks, or nested containers; texts, tables and
    captions become distinct lines. Malformed JSON has no blocks."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parsed = []
            for path, text in zip(pdf.path, pdf["json"]):
                try:
                    parsed.append((path, _flatten(json.loads(text or "null"), None)))
                except ValueError:
                    continue
            yield _frame(parsed)

    return files.select("path", "json").mapInPandas(parse, BLOCKS)


def tei_headers(files: DataFrame) -> DataFrame:
    """(path, title, authors, year, doi) of TEI documents (path, tei), by XPath in compiled code."""
    bare = F.regexp_replace("tei", r'\sxmlns(:\w+)?="[^"]*"', "")
    head = "//teiHeader"
    year = F.try_to_number(F.nullif(F.regexp_extract(F.xpath_string(bare, F.lit(f"{head}//date/@when")), "((?:19|20)[0-9]{2})", 1), F.lit("")), F.lit("9999")).cast("int")
    authors = F.zip_with(F.xpath(bare, F.lit(f"{head}//sourceDesc//author/persName/forename[1]/text()")), F.xpath(bare, F.lit(f"{head}//sourceDesc//author/persName/surname/text()")), lambda a, b: F.concat_ws(" ", a, b))
    return files.select("path", F.nullif(tx.clean_title(F.xpath_string(bare, F.lit(f"{head}//titleStmt/title"))), F.lit("")).alias("title"), authors.alias("authors"), year.alias("year"), F.nullif(F.xpath_string(bare, F.lit(f"{head}//idno[@type='DOI']")), F.lit("")).alias("doi"))


def tei_references(files: DataFrame) -> DataFrame:
    """(path, ref_index, title, doi) of the bibliography of TEI documents."""
    bare = F.regexp_replace("tei", r'\sxmlns(:\w+)?="[^"]*"', "")
    items = F.xpath_number(bare, F.lit("count(//listBibl/biblStruct)")).cast("int")
    numbered = files.withColumn("_n", items).where("_n > 0").select("path", bare.alias("_t"), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("ref_index"))
    return numbered.select("path", "ref_index", F.expr("nullif(get(xpath(_t, '//listBibl/biblStruct/*/title[1]/text()'), ref_index - 1), '')").alias("title"), F.expr("nullif(get(xpath(_t, '//listBibl/biblStruct/*/idno/text()'), ref_index - 1), '')").alias("doi"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def vocabulary(spark: SparkSession, layers: list[dict[str, dict[str, list[str]]]]) -> DataFrame:
    """Taxonomy layers {facet: {label: aliases}} as rows (layer, facet, label_id, alias); later layers override labels."""
    rows = [(n, facet, label, alias) for n, layer in enumerate(layers) for facet, labels in layer.items() for label, aliases in labels.items() for alias in aliases]
    return spark.createDataFrame(rows, "layer int, facet string, label_id string, alias string")
