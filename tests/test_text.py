from pyspark.sql import functions as F

from codexloom.functions import entities as en
from codexloom.functions import text as tx


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def test_titles(spark):
    assert one(spark, tx.clean_title("x"), "  A\tgood\n title: - ") == "A good title"
    assert one(spark, tx.clean_title("x"), None) is None
    assert one(spark, tx.clean_title("x"), "x" * 400) == "x" * 300
    assert one(spark, tx.title_key("x"), "Flow Fields: A Survey (final)") == "flowfields"
    assert one(spark, tx.title_key("x"), "Größe 12") == "grsse12"
    assert one(spark, tx.slug("x"), "R&D: notes/2024") == "R_and_D_notes2024"
    assert one(spark, tx.slug("x"), "???") == "document"
    for title, good in (("A proper title", True), ("short", False), ("1234 5678 9012", False), ("Untitled document one", False), ("https://example.invalid/abcdefgh", False), (None, False)):
        assert one(spark, tx.valid_title("x"), title) is good


def test_names_and_identifiers(spark):
    assert one(spark, tx.surnames("x"), ["Ann Lee", "Bo de Vries; Cy Ono et al.", None, "3"], "array<string>") == ["lee", "ono", "vries"]
    assert one(spark, tx.surnames("x"), None, "array<string>") == []
    assert one(spark, tx.split_authors("x"), "Ann Lee, Bo Ono and Ann Lee") == ["Ann Lee", "Bo Ono"]
    assert one(spark, tx.normal_doi("x"), " https://doi.org/10.1/ABC ") == "10.1/abc"
    assert one(spark, tx.normal_arxiv("x"), "arXiv: 2401.00001") == "2401.00001"
    assert one(spark, tx.is_preprint_doi("x"), "10.48550/x") is True
    assert one(spark, tx.is_preprint_doi("x"), None) is False
    assert one(spark, tx.find_doi("x"), "see doi 10.1234/ab.c). ") == "10.1234/ab.c"
    assert one(spark, tx.year_from_name("x"), "paper_2019_(2021)") == 2021
    assert one(spark, tx.year_from_name("x"), "paper_20191") is None
    assert one(spark, tx.file_format("x"), "a/b.HTM") == "html"


def test_headings(spark):
    for heading, role in (("1. Introduction", "introduction"), ("IV. METHODS", "methodology"), ("Discussion and Limitations", "discussion"), ("Comparison with others", "results"), ("Appendix A", "appendix"), ("Bibliography", "references"), ("Thanks", "unknown"), (None, "unknown")):
        assert one(spark, tx.heading_role("x"), heading) == role, heading


def test_terms_are_whole_tokens(spark):
    for text, term, there in (("the C# client", "C#", True), ("flow-net works", "FLOW", True), ("workflow", "flow", False), ("a.b", "a.b", True), ("axb", "a.b", False), (None, "a", None)):
        assert spark.createDataFrame([(text, term)], "t string, w string").select(tx.term_present("t", "w")).first()[0] is there


def test_dataset_cleaner(spark):
    cases = {
        "the KITTI": "KITTI", "results on Sintel": "Sintel", "T R A N": "TRAN", "W O R": "WOR", "TRANS10 K": "TRANS10 K", "object detection": None, "Table A3": None, "Overview of CARE": None, "two": None, "C.1": None, "F1": None,
        "250 patients": None, "first. Then B": None, "Word One Two Three Four Five": None, "a new Alpha [12] (2019)": "Alpha", None: None, "": None,
    }
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "c string, want string")
    got = {r.c: r.got for r in en.with_dataset(rows, "c", "got").collect()}
    assert {k: got[k] for k in cases} == cases
    known = en.Words(canonical=(("f1 set", "F1-Set"),))
    assert en.with_dataset(spark.createDataFrame([("the F1 Set",)], "c string"), "c", "got", known).first().got == "F1-Set"


def test_candidates_metrics_results(spark):
    assert one(spark, en.dataset_candidates("x"), "We use the Alpha Beta dataset<sup>1</sup> and a dataset called Gamma here.") == ["Alpha Beta", "Gamma"]
    assert one(spark, en.metric_candidates("x"), "DSC of 0.95, 91.0% mIoU, 16 GB (HD95: 1.2)") == ["DSC", "HD95", "mIoU", "HD95"]
    f = one(spark, en.reference_fields("x"), "[3] A. Lee, B. Ono, 2020: Deep things here. J. X. doi 10.1234/ab.")
    assert (f.title, f.authors, f.year, f.doi, f.arxiv_id) == ("Deep things here", ["A. Lee", "B. Ono"], 2020, "10.1234/ab", None)
