import io
import json
import zipfile

from pyspark.sql import functions as F

from codexloom.plans import pipeline
from codexloom.sinks import exports
from codexloom.sources import files
from codexloom.streaming import ingest

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(paragraphs, title="A Study of River Flow"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("docProps/core.xml", f'<c:p xmlns:c="c" xmlns:dc="dc"><dc:title>{title}</dc:title><dc:creator>Ann Lee</dc:creator></c:p>')
        body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{style}"/></w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>' for style, text in paragraphs)
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_html(spark):
    page = '<title>T &amp; x</title><meta name="author" content="Ann Lee"><meta name="citation_date" content="2020/1/2"><nav><p>menu</p></nav><h1>The <b>Real</b> title</h1><p>one<br>two<p>three<script>var a="</p>"</script><ul><li>item</ul>'
    df = spark.createDataFrame([("a", page), ("b", None), ("c", "")], "path string, html string")
    got = [(r.idx, r.type, r.heading_level, r.text) for r in files.html_blocks(df).orderBy("idx").collect()]
    assert got == [(0, "title", 1, "T & x"), (1, "heading", 1, "The Real title"), (2, "paragraph", None, "one two"), (3, "paragraph", None, "three"), (4, "list_item", None, "item")]
    meta = {r.path: (r.title, r.authors, r.year) for r in files.html_metadata(df).collect()}
    assert meta["a"] == ("The Real title", ["Ann Lee"], 2020) and meta["b"] == (None, [], None)


def test_docx(spark):
    df = spark.createDataFrame([("a", docx([("Title", "Top"), ("Heading2", "Part"), ("Normal", "Body")])), ("b", b"broken"), ("c", None)], "path string, content binary")
    assert [(r.type, r.heading_level, r.text) for r in files.docx_blocks(df).orderBy("idx").collect()] == [("heading", 1, "Top"), ("heading", 2, "Part"), ("paragraph", None, "Body")]
    meta = {r.path: r for r in files.docx_metadata(df).collect()}
    assert meta["a"].authors == ["Ann Lee"] and meta["b"].error


def test_parser_json(spark):
    pages = [{"page_idx": 3, "blocks": [{"type": "title", "text": "T", "text_level": 1}, {"type": "image", "img_path": "x.png", "image_caption": ["cap", "cap"]}, {"content": {"text": "deep"}}]}]
    df = spark.createDataFrame([("a", json.dumps(pages)), ("b", "{broken"), ("c", None), ("d", json.dumps([{"type": "text", "text": "flat", "page_idx": 0}]))], "path string, json string")
    got = sorted((r.path, r.idx, r.type, r.page_index, r.text) for r in files.parser_json_blocks(df).collect())
    assert got == [("a", 0, "title", 3, "T"), ("a", 1, "image", 3, "cap"), ("a", 2, "text", 3, "deep"), ("d", 0, "text", 0, "flat")]


def test_tei(spark):
    tei = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><titleStmt><title>On flow.</title></titleStmt><sourceDesc><author><persName><forename>Ann</forename><surname>Lee</surname></persName></author><idno type="DOI">10.1/a</idno><date when="2019-01-01"/></sourceDesc></teiHeader><listBibl><biblStruct><analytic><title>R one</title></analytic></biblStruct></listBibl></TEI>'
    df = spark.createDataFrame([("a", tei)], "path string, tei string")
    r = files.tei_headers(df).first()
    assert (r.title, r.authors, r.year, r.doi) == ("On flow", ["Ann Lee"], 2019, "10.1/a")
    assert files.tei_references(df).first().title == "R one"


def test_exports(spark):
    ws = spark.createDataFrame([("work_123456", "T & <x>", ["Ann Lee"], 2020, "10.1/a", None, ["d1", "d2"], "merged"), ("work_abcdef", None, None, None, None, None, None, None)], "work_id string, title string, authors array<string>, year int, doi string, arxiv_id string, document_ids array<string>, merge_status string")
    bib = {r.work_id: r.entry for r in exports.bibtex_rows(ws).collect()}
    assert bib["work_123456"].startswith("@article{Lee2020,") and "year" not in bib["work_abcdef"] and bib["work_abcdef"].startswith("@article{Paperabcdef,")
    assert exports.csv_rows(ws).orderBy("work_id").first().document_ids == "d1; d2"
    assert "author" not in json.loads(exports.jsonld_rows(ws).where("work_id = 'work_abcdef'").first().json)
    nodes = spark.createDataFrame([("a", 'x<"', "paper", None)], "id string, label string, type string, facet string")
    edges = spark.createDataFrame([("a", "b", "related", None, None)], "source string, target string, type string, status string, weight double")
    xml = [r.xml for r in exports.graphml_rows(nodes, edges).collect()]
    assert "x&lt;&quot;" in xml[0] and 'directed="false"' in xml[1] and ">1.0<" in xml[1]
    md = spark.range(1).select(exports.rewrite_assets(F.lit("![a](img/a.png) ![b](img/b.png) ![c](https://x/c.png)"), {"img/a.png": "assets/1.png"})).first()[0]
    assert md == "![a](assets/1.png)  ![c](https://x/c.png)"


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    schema = "doc_id long, text string"
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], schema).write.parquet(source)
    ingest.incremental_ingest(spark, source, schema, target, check)
    ingest.incremental_ingest(spark, source, schema, target, check)
    spark.createDataFrame([(4, "b"), (5, "c"), (6, None)], schema).write.mode("append").parquet(source)
    ingest.incremental_ingest(spark, source, schema, target, check)
    assert sorted(r.doc_id for r in spark.read.parquet(target).collect()) == [1, 2, 5, 6]


def test_pipeline_end_to_end(spark, tmp_path):
    body = "<h2>Abstract</h2><p>" + "This work studies water in rivers with great care and patience. " * 4 + "</p><h2>Results</h2><p>The Alpha dataset gave DSC of 0.95 in all of the runs that we made here for this test.</p><h2>References</h2><p>[1] A. Lee (2019). Something long enough to parse. X.</p>"
    src = tmp_path / "src"
    src.mkdir()
    (src / "one.html").write_text(f"<title>Water in the great rivers</title>{body}")
    (src / "copy.html").write_text(f"<title>Water in the great rivers</title>{body}")
    (src / "two.docx").write_bytes(docx([("Title", "Water in the great rivers"), ("Normal", "text " * 40)], "Water in the great rivers"))
    (src / "bad.pdf").write_bytes(b"no pdf")
    corpus = pipeline.analyze(pipeline.ingest(spark, str(src)))
    manifest = {r.path.rsplit("/", 1)[1]: r for r in corpus["manifest"].collect()}
    assert set(manifest) == {"copy.html", "two.docx", "bad.pdf"} and manifest["copy.html"].work_id == manifest["two.docx"].work_id
    assert manifest["two.docx"].selected and not manifest["copy.html"].selected and not manifest["bad.pdf"].extractable
    assert pipeline.check_evidence(corpus) >= 0
    pipeline.export(corpus, "csv", str(tmp_path / "csv"))
    again = pipeline.ingest(spark, str(src), corpus["manifest"])
    assert {r.work_id for r in again["manifest"].collect()} == {r.work_id for r in corpus["manifest"].collect()}


def test_a_generated_corpus_inside_the_input_is_left_out(spark, tmp_path):
    src = tmp_path / "src"
    (src / "old" / "manifests").mkdir(parents=True)
    (src / "old" / "manifests" / "last_pipeline.json").write_text("{}")
    (src / "old" / "x.html").write_text("<p>x</p>")
    (src / "older.html").write_text("<p>y</p>")
    assert [r.path.rsplit("/", 1)[1] for r in files.discover(spark, str(src)).where("supported").collect()] == ["older.html"]
    assert [r.path.rsplit("/", 1)[1] for r in files.read_content(spark, str(src)).collect()] == ["older.html"]


def test_command_line_from_files_to_reports(spark, tmp_path, monkeypatch):
    """A work of a PDF with the parser's output, one whose PDF has none but whose page has, and a file that goes away."""
    from codexloom import __main__ as cli

    src, parsed, out = tmp_path / "src", tmp_path / "parsed", tmp_path / "out"
    src.mkdir(), parsed.mkdir()
    text = "This work studies the flow of water in rivers with great care and patience over years. " * 3
    page = "<title>{0}</title><h2>Abstract</h2><p>" + text + "</p><h2>Results</h2><p>The Alpha dataset gave DSC of 0.95 in all of the runs that we made for this test.</p>"
    (src / "rivers_of_the_north.pdf").write_bytes(b"%PDF-1.4 a")
    (parsed / "rivers_of_the_north_content_list.json").write_text(json.dumps([{"type": "text", "text": "Abstract", "text_level": 1, "page_idx": 0}, {"type": "text", "text": text, "page_idx": 1}]))
    (src / "glaciers_of_the_south.pdf").write_bytes(b"%PDF-1.4 b")
    (src / "glaciers_of_the_south.html").write_text(page.format("glaciers of the south"))
    (src / "gone_after_the_first_run.html").write_text(page.format("Gone after the first run"))
    assert cli.main(["run", str(src), str(out), "--parsed", str(parsed)]) == 0
    read = lambda name: spark.read.parquet(str(out / name))
    owner = {r.document_id: r for r in read("manifest").collect()}
    formats = {(owner[r.document_id].title, owner[r.document_id].format) for r in read("blocks").select("document_id").distinct().collect()}
    assert formats == {("rivers of the north", "pdf"), ("glaciers of the south", "html"), ("Gone after the first run", "html")}
    (src / "gone_after_the_first_run.html").unlink()
    assert cli.main(["ingest", str(src), str(out), "--parsed", str(parsed)]) == 0
    assert {r.title for r in read("manifest").collect()} == {"rivers of the north", "glaciers of the south", "Gone after the first run"}
    for kind in cli.pipeline.REPORTS:
        assert cli.main(["report", str(out), kind, str(tmp_path / kind)]) == 0
    assert "glaciers of the south" in "".join(r.value for r in spark.read.text(str(tmp_path / "literature_review")).collect())
    for command in (["graph", str(out), str(tmp_path / "graph")], ["citation-graph", str(out)], ["review", str(out)], ["merge", str(out)], ["status", str(out)], ["search", str(out), "water"], ["export", str(out), "csv", str(tmp_path / "csv")]):
        assert cli.main(command) == 0
    assert any("Alpha" in r.value for r in spark.read.text(str(tmp_path / "graph")).collect())


def test_automatic_merges_need_identity_likeness_and_no_conflict(spark):
    from codexloom.operators import works

    rows = [("w1", "Flow of water in rivers", "10.1/a", None), ("w2", "Flow of water in river", "https://doi.org/10.1/A", None), ("w3", "Something else altogether", "10.1/a", None), ("w4", "Snow on roofs", "10.1/b", "2001.1"), ("w5", "Snow on roofs", "10.1/c", "2001.1"), ("w6", None, None, None)]
    df = spark.createDataFrame(rows, "work_id string, title string, doi string, arxiv_id string")
    assert [(r.primary, r.merged) for r in works.auto_merges(df).collect()] == [("w1", "w2")]


def test_metrics_fit_to_be_shown(spark):
    from codexloom.operators import records

    df = spark.createDataFrame([("DSC",), ("mean error is low",), ("a score of five words",), ("GPU",), (None,), (" ",), ("peak  rate",)], "name string")
    assert sorted(r.name for r in records.display_metrics(df).collect()) == ["DSC", "peak  rate"]


def test_scratch_tables_are_deleted(spark):
    import os

    from codexloom import storage

    path = storage.cut(spark.range(3).toDF("x"), "probe").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and storage.clear_scratch(spark) >= 1
    assert not os.path.exists(path) and storage.clear_scratch(spark) == 0


def test_graphml_is_a_document_with_numbered_edges(spark):
    from xml.etree import ElementTree

    nodes = spark.createDataFrame([("a", 'x<"', "paper", None), ("b", None, None, None)], "id string, label string, type string, facet string")
    edges = spark.createDataFrame([("a", f"b{i}", "related", None, 0.5) for i in range(40)], "source string, target string, type string, status string, weight double")
    lines = exports.graphml_rows(nodes, edges).orderBy(F.desc("part"), "ord").collect()
    root = ElementTree.fromstring("\n".join(r.xml for r in lines).encode())
    space = "{http://graphml.graphdrawing.org/xmlns}"
    assert [k.get("id") for k in root.iter(f"{space}key")] == ["label", "type", "weight"]
    assert {n.get("id"): [d.text for d in n] for n in root.iter(f"{space}node")} == {"a": ['x<"', "paper"], "b": ["b", "unknown"]}
    assert sorted(int(e.get("id")[1:]) for e in root.iter(f"{space}edge")) == list(range(40))
