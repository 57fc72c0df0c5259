import pytest

from codexloom.llm import markup as mk
from codexloom.llm.markup_labels import MARKUP, PLAIN

SCHEMA = "block_id string, document_id string, type string, text string, source struct<source_index:int>, words string, markup string, idx string"


def blocks(spark, rows):
    return spark.createDataFrame([(b, d, t, x, (i,) if i is not None else None, "clash", "clash", "clash") for b, d, t, x, i in rows], SCHEMA)


def test_labelled_texts_and_held_out_ones(spark):
    held_out = ["a <em>word</em> here", "half <sup>open", "A &hellip; B", "## Two words", "some **bold", "an [inline link](http://x.invalid)", "\\subsection{Name}", "with $y_{1}^{2} = 3$ there", "a '''loud word", "see {{also|this}}", "[[A|b]] and [[c"]
    clean = ["x < 3 and y > 4", "costs $7 or ~3", "AT&T and R&D", "vector [1, 2] only", "my_long_name = 3", "(p < 0.01) * and **", "C:\\temp\\file_3", "a -- b -- c", "Tom's and the boys' hats"]
    rows = [(f"m{i}", "d", "text", t, i) for i, t in enumerate([*MARKUP, *held_out])] + [(f"p{i}", "d", "text", t, 500 + i) for i, t in enumerate([*PLAIN, *clean])]
    found = {r.block_id for r in mk.markup_blocks(blocks(spark, rows)).collect()}
    assert found == {f"m{i}" for i in range(len(MARKUP) + len(held_out))}


def test_code_is_no_residue_and_odd_rows(spark):
    rows = [("c", "d", "code", "<b>x</b>", 1), ("e", "d", " Equation", "$x_1$", 2), ("n", None, None, None, None), ("t", "d", None, "<b>x</b>", None), ("t", "d", None, "<b>x</b>", None), (None, "d", "text", "<b>x</b>", 3), ("l", "d", "text", "word " * 20_000 + "<br>", 4)]
    assert {r.block_id for r in mk.markup_blocks(blocks(spark, rows)).collect()} == {"t", "l"}
    assert mk.clean_blocks(blocks(spark, rows)).count() == 5
    assert mk.markup_blocks(blocks(spark, [])).count() == 0 and mk.clean_blocks(blocks(spark, [])).count() == 0


def test_tree_as_expression_equals_the_tree(spark):
    from pyspark.sql import functions as F

    tree = mk.trained_tree()
    x, y = mk.labelled_features()

    def walk(node, row):
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.at else node.high
        return node.share

    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x[::7])], ["i", *mk.FEATURES])
    got = {r.i: r.s for r in df.select("i", mk.as_column(tree, {f: F.col(f) for f in mk.FEATURES}).alias("s")).collect()}
    assert got == {i: walk(tree, r) for i, r in enumerate(x[::7])} and all((walk(tree, r) >= 0.5) == bool(v) for r, v in zip(x, y))


def test_the_tree_weighs_words_and_its_error_on_texts_it_has_not_seen():
    """The neighbours' features are real ones; whether they help is for the tree to say."""
    x, y = mk.labelled_features()
    assert len({tuple(r[-4:]) for r in x}) > 100 and {bool(v) for r, v in zip(x, y) if r[-3] > 0} == {True, False}
    assert "star_words" in mk.used_features(mk.trained_tree())
    assert mk.held_out_error() < 0.12


def test_neighbours(spark):
    rows = [("a", "d", "text", "one two", 1), ("b", "d", "text", "[x y](http://z.invalid/q)", 2), ("c", "d", "text", "three", 3), ("x", "e", "text", "alone", 2)]
    got = {r.block_id: (r.words_before, r.density_before, r.words_after) for r in mk.block_features(blocks(spark, rows)).collect()}
    assert got == {"a": (0.0, 0.0, 2.0), "b": (2.0, 0.0, 1.0), "c": (2.0, 1.0, 0.0), "x": (0.0, 0.0, 0.0)}


@pytest.mark.parametrize("dirty,clean", [
    ("<h2>Results</h2><p>One &amp; two</p>", "# Results\n\nOne & two"), ("<ul><li>a</li><li>b</li></ul>", "- a\n\n- b"), ("<table><tr><td>1</td><td>2</td></tr></table>", "1\t2"), ("**Bold** and *soft*", "Bold and soft"), ("see [it](http://x.invalid/1) now", "see it now"),
    ("```sh\nls <b>\n```", "```\nls <b>\n```"), ("== Head ==\ntext", "# Head\ntext"), ("[[A|shown]] x", "shown x"), ("\\section{Name}\\label{s} Text", "# Name\nText"), ("a~\\cite{x} b", "a b"), ("\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", "- one\n\n- two"),
    ("Here \\(a \\leq b\\) holds", "Here $a \\leq b$ holds"), ("40\\% of R&D", "40% of R&D"), ("n < 4 and m > 5", "n < 4 and m > 5"), ("f(a | b) on {0, 1}", "f(a | b) on {0, 1}"), ("&amp;lt;i&amp;gt;x&amp;lt;/i&amp;gt;", "x"), (None, ""), ("", ""),
])
def test_conversion(dirty, clean):
    assert mk.clean_markup(dirty).replace("\n\n", "\n") == clean.replace("\n\n", "\n")


def test_structure(spark):
    rows = [("h", "d", "heading", "## Two", 1), ("l", "d", "text", "- [x] a\n- [ ] b", 2), ("t", "d", "text", "| a | b |\n|---|---|\n| 1 | 2 |", 3), ("c", "d", "text", "```\nx\n```", 4), ("f", "d", "equation", "x_1", 5), ("p", "d", "text", "plain", 6)]
    assert {r.block_id: r.structure for r in mk.clean_blocks(blocks(spark, rows)).collect()} == {"h": "heading", "l": "list", "t": "table", "c": "code", "f": "formula", "p": "text"}
