import json

from codexloom.operators import enrich
from codexloom.sinks import reports


def test_statement_report(spark):
    works = spark.createDataFrame([("w1", "B title"), ("w2", None)], "work_id string, title string")
    rows = spark.createDataFrame([("w1", "methodology", 2, "second", "d:b2:p1"), ("w1", "methodology", 1, "first", "d:b1:p1"), ("w1", "results", 1, "won", None)], "work_id string, field string, ord int, statement string, locator string")
    got = [r.markdown for r in reports.statement_report(works, rows, ("methodology", "results")).orderBy("ord").collect()]
    assert got[0] == "## B title\n\n### Methodology\n\n- first `[d:b1:p1]`\n- second `[d:b2:p1]`\n\n### Results\n\n- won" and "No evidence" in got[1]


def test_written_report(spark, tmp_path):
    works = spark.createDataFrame([("w1", "T", ["A. Lee"], 2020, "10.1/a", None)], "work_id string, title string, authors array<string>, year int, doi string, arxiv_id string")
    reports.write_report(reports.all_works_report(works), "All", str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect() if r.value] == ["# All", "- **T** — A. Lee (2020) doi:10.1/a"]


def test_enrichment_keeps_only_cited_items_and_falls_back(spark):
    def reply(prompt):
        if "broken" in prompt:
            raise RuntimeError("no answer")
        return "Sure! " + json.dumps({"results": [{"statement": "good", "evidence_block_ids": ["b1"]}, {"statement": "bad", "evidence_block_ids": ["nowhere"]}, {"statement": "uncited", "evidence_block_ids": []}]}) + " done"

    prompts = spark.createDataFrame([("d1", "ok"), ("d2", "broken")], "document_id string, prompt string")
    blocks = spark.createDataFrame([("b1",)], "block_id string")
    own = spark.createDataFrame([("d1", "results", "x"), ("d2", "results", "y")], "document_id string, field string, statement string")
    got = sorted(tuple(r) for r in enrich.enriched_statements(prompts, blocks, own, reply).collect())
    assert got == [("d1", "results", "good", "evidence_cited_unverified"), ("d2", "results", "y", "supported")]
    assert enrich.enriched_statements(prompts, blocks, own, None).count() == 2


def test_pending_and_prunable(spark):
    m = spark.createDataFrame([("a", "pdf", True, None), ("b", "pdf", True, True), ("c", "html", True, True), ("d", "pdf", False, True), ("e", "pdf", True, False)], "document_id string, format string, selected_for_extraction boolean, extractable boolean")
    done = spark.createDataFrame([("b",)], "document_id string")
    assert [r.document_id for r in enrich.pending_extraction(m, done).collect()] == ["a"]
    assert sorted(r.document_id for r in enrich.pending_extraction(m, done, force=True).collect()) == ["a", "b"]
    out = spark.createDataFrame([("b", "/raw/x"), ("b", "/raw/x/y"), ("b", "/other/x"), ("a", "/raw/z")], "document_id string, path string")
    assert [r.path for r in enrich.prunable(out, done, "/raw").collect()] == ["/raw/x"]
    a = spark.createDataFrame([("a", "img/p.png", b"1"), ("a", "t.csv", b"2")], "document_id string, path string, content binary")
    assert [r.name for r in enrich.renamed_assets(a).collect()] == ["p_6b86b273ff.png"] and enrich.renamed_assets(a, "none").count() == 0
