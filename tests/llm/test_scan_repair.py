import pytest

from codexloom.llm import scan_repair as sr

SENTENCES = ("the harmonic sensor improves the calibrated archive", "every wave-like template follows the horizon of the river", "we measured seven kilometres of frozen water near the harbour")
BLOCK = "block_id string, document_id string, type string, page_index int, section_path array<string>, text string, source struct<source_index:int>, title string, idx string, line string"


@pytest.fixture(scope="module")
def reader():
    known = {}
    for s in SENTENCES:
        for w in [*s.split(), *s.replace("-", " ").split()]:
            known[w] = known.get(w, 0) + 200
    return sr.Reader(known)


@pytest.mark.parametrize("text,kinds,fixed", [
    ("the har-\nmonic sensor", ["hyphen"], "the harmonic sensor"), ("the har\u00admonic sensor", ["hyphen"], "the harmonic sensor"), ("a wave-\nlike template", [], "a wave-\nlike template"), ("the har- monic sensor", ["hyphen"], "the harmonic sensor"),
    ("the h a r b o u r", ["spacing"], "the harbour"), ("the harm0nic sens0r", ["glyph"], "the harmonic sensor"), ("Tlie calibrated archive", ["glyph"], "The calibrated archive"), ("the harmonie sensor", ["glyph"], "the harmonic sensor"),
    ("the harmonicsensor improves", ["spacing"], "the harmonic sensor improves"), ("near the har bour", ["spacing"], "near the harbour"), ("short- and long-range", [], "short- and long-range"), ("n < 4 and m > 5", [], "n < 4 and m > 5"), ("Zavolin-20 and GathuR2", [], "Zavolin-20 and GathuR2"),
    ("the river\nhorizon", [], "the river\nhorizon"), ("", [], ""), ("x" * 30_000, [], "x" * 30_000),
])
def test_words(reader, text, kinds, fixed):
    got, repaired, choices = reader.repair(text)
    for c in choices:
        best = max(c["options"], key=lambda o: (o["n"], o["shown"]))["shown"]
        got, repaired = sorted({*got, "spacing" if " " in best else "glyph"}), repaired.replace(sr.mark(c["k"]), best)
    assert got == kinds and (not kinds or repaired == fixed)


def blocks(spark, rows):
    return spark.createDataFrame([(b, d, t, p, ["A long title of the document that is cut in its header lines"], x, (i,) if i is not None else None, "clash", "clash", "clash") for b, d, t, p, x, i in rows], BLOCK)


def corpus(spark, extra):
    plain = [(f"f{k}", f"d{k % 3}", "text", k % 7, SENTENCES[k % 3] + ".", 100 + k) for k in range(120)]
    return blocks(spark, [*plain, *extra])


def test_page_lines_follow_the_page(spark):
    extra = []
    for p in range(5):
        extra += [(f"n{p}", "d0", "text", p, f"- {41 + p} -", p), (f"h{p}", "d0", "text", p, f"Quarterly Notes of the Harbour {41 + p}", 10 + p), (f"i{p}", "d0", "text", p, f"{SENTENCES[0]}\nQuarterly Notes of the Harbour\n{SENTENCES[1]}", 20 + p), (f"s{p}", "d0", "title", p, "2 Methods", 30 + p), (f"t{p}", "d0", "table", p, "12 14 9\n3 4 5", 40 + p)]
    extra += [("r", "d1", "text", 0, "iv", 1), ("c", "d1", "text", 2, "A LONG TITLE OF THE DOCUMENT THAT IS CUT IN", 2), ("e", "d2", "text", 1, "Lee et al.", 3), ("q", "d2", "equation", 1, "(3)", 4)]
    found = {r.block_id: r.kinds for r in sr.scan_traces(corpus(spark, extra)).collect()}
    assert {b for b, k in found.items() if "header" in k} == {f"{x}{p}" for x in "nhi" for p in range(5)} | {"r", "c", "e"}
    assert not any(b.startswith("f") for b in found)


def test_paragraphs_run_on_over_pages(spark):
    extra = [("a", "z", "text", 0, "The harmonic sensor im-\nproves the", 1), ("n", "z", "page_number", 0, "- 7 -", 2), ("b", "z", "text", 1, "calibrated archive.", 3), ("m", "z", "page_number", 1, "- 8 -", 4), ("c", "z", "text", 1, "Every template follows.", 5)]
    got = sr.readable_paragraphs(corpus(spark, extra)).where("document_id = 'z'").orderBy("paragraph").collect()
    assert [(r.first_block, r.n_blocks, r.text) for r in got] == [("a", 2, "The harmonic sensor improves the calibrated archive."), ("c", 1, "Every template follows.")]


def test_paragraphs_keep_prose_of_a_wrong_type(spark):
    kinds = ("header", "footer", "page_number", "title", "heading")
    extra = [("a", "z", "text", 0, "The harmonic sensor improves the", 1), ("b", "z", "header", 0, "frozen water near the har-\nbour of the river.", 2)]
    extra += [(f"k{i}", "z", k, i, f"We measured seven kilometres of {k} near the harbour.", 10 + i) for i, k in enumerate(kinds)]
    extra += [(f"l{i}", "z", k, i, "- 7 -" if k == "page_number" else "Omnibus of the Varnmoor Field Notebooks", 20 + i) for i, k in enumerate(kinds)]
    got = sr.readable_paragraphs(corpus(spark, extra)).where("document_id = 'z'").orderBy("paragraph").collect()
    assert [(r.first_block, r.n_blocks) for r in got] == [("a", 2), *((f"k{i}", 1) for i in range(5))]
    assert got[0].text == "The harmonic sensor improves the frozen water near the harbour of the river."


def test_defined_results_of_odd_rows(spark):
    rows = [(None, "d", "text", 0, "har-\nmonic", 0), ("x", None, None, None, "har-\nmonic", None), ("y", None, None, 0, None, None), ("z", "d", "text", 0, "har-\nmonic", 0), ("z", "d", "text", 0, "har-\nmonic", 0), ("w", None, "text", 0, " ", 0)]
    assert [r.block_id for r in sr.scan_traces(corpus(spark, rows)).collect()] == ["z"]
    empty = spark.createDataFrame([], BLOCK)
    assert sr.scan_traces(empty).count() == 0 and sr.readable_paragraphs(empty).count() == 0


def test_vocabulary_drops_misread_forms_by_ratios_alone(spark):
    for times in (1, 40):
        df = spark.createDataFrame([("harmonic",)] * 300 * times + [("harmomc",)] * 4 * times + [("horizon",)] * 4, "text string")
        assert {r.word: r.n for r in sr.frequent_words(sr.word_counts(df)).collect()} == {"harmonic": 300 * times, "horizon": 4}


def traced(spark, text, corpus, known, **options):
    words = spark.createDataFrame(list(known.items()), "word string, n long")
    found = sr.word_traces(spark.createDataFrame([("b", "text", text)], "block_id string, type string, text string"), spark.createDataFrame([(x,) for x in corpus], "text string"), words, **options).collect()
    return [(r.kinds, r.fixed) for r in found]


def test_neighbours_decide_between_explanations_and_reject_those_without_support(spark):
    known = {w: 200 for w in ("the", "boat", "boil", "sails", "water")} | {"boar": 900}
    corpus = ["the boat sails"] * 5 + ["boil water"] * 5
    assert traced(spark, "the boak sails", corpus, known) == [(["glyph"], "the boat sails")]
    assert traced(spark, "over boak beds", corpus, known) == []
    assert traced(spark, "tlie water", corpus, known) == [(["glyph"], "the water")]  # glyphs need no support


def test_any_vocabulary_size_and_partitioning_gives_one_result(spark):
    """The vocabulary broadcast or asked for by chunks, on 1 and 50 partitions, with whatever a worker has read before."""
    odd = ["we saw tlie har-\nmonic sen sor of the archive", "we saw tlie", "the har0our and the s1x rivcr wavelike", "h a r b o u r and cali- bra-\nted archives", "7 k1lometres of frozcn water, tlie horizonof the riuer", "The calibratedarchive", ""]
    rows = [(f"f{k}", f"d{k % 3}", "text", k % 7, SENTENCES[k % 3] + ".", 100 + k) for k in range(90)] + [(f"o{k}", "d9", "text", k, odd[k % len(odd)], k) for k in range(len(odd))]
    df = blocks(spark, rows)
    known = sr.frequent_words(sr.word_counts(df))
    key = lambda out: sorted((r.block_id, tuple(r.kinds), r.fixed) for r in out.collect())
    want = key(sr.word_traces(df.repartition(1), df, known))
    assert len(want) == 6
    assert key(sr.word_traces(df.repartition(50), df, known)) == want
    assert key(sr.word_traces(df.repartition(5), df, known, 0)) == want


def test_all_neighbours_or_those_wanted(spark):
    texts = spark.createDataFrame([("the boat sails the boat",), (None,), ("",)], "text string")
    wanted = spark.createDataFrame([("the", "boat"), ("boat", "boil")], "a string, b string")
    for limit in (0, 10):
        assert [(r.a, r.b, r.n) for r in sr.neighbour_counts(texts, wanted, limit).collect()] == [("the", "boat", 2)]
