"""The small labelled table on which the markup classifier is trained: (text, carries markup), and documents of it.

Written for this operator: each row shows one construct of HTML, Markdown, wiki or LaTeX, whole or broken, or signs
that stand for themselves.
"""

MARKUP = (
    "<p>Plain words in a paragraph.</p>",
    "The last word is <b>bold",
    "Two lines<br>of one block<br/>",
    "<ul><li>first</li><li>second</li></ul>",
    '<a href="x.html">a link</a> in a line',
    "<table><tr><td>1</td><td>2</td></tr></table>",
    "<h2>Results</h2>",
    "<!-- note to self -->visible text",
    "Smith &amp; Sons make ovens",
    "ten&nbsp;grams of salt",
    "a dash &#8212; here",
    "twice escaped &amp;lt;i&amp;gt; text",
    "broken entity &ltsup&gt;4&lt;/sup&gt;",
    '<ref name="a1"/> after a claim.',
    "# Heading",
    "### Deep heading\n\nand its text",
    "Title\n=====\ntext below",
    "**Strong** opening of a line",
    "a word in *slanted* type",
    "a word in _slanted_ type",
    "very __strong__ words",
    "old ~~and removed~~ words",
    "***both at once*** in a line",
    "call `open()` before reading",
    "a `code span` here",
    "```sh\nls -l\n```",
    "see [the page](http://example.invalid/1)",
    "see [the page][3] for more",
    "<http://example.invalid>",
    "![picture](img/a.png)\nand text",
    "as noted[^3] before\n\n[^3]: the note",
    "- [x] done\n- [ ] open",
    "| a | b |\n|---|:--:|\n| 1 | 2 |",
    "> quoted line\n> and another",
    "== Section ==",
    "=== Lower section ===\ntext",
    "'''bold''' and ''slanted'' words",
    "it was ''not closed",
    "[[Target|shown words]] in a line",
    "a [[Link]] in a line",
    "a [[broken link in a line",
    "{{cite paper|title=x|year=1999}}",
    "{{main|topic}} The text",
    '{| class="a"\n|-\n! head !! other\n|-\n| 1 || 2\n|}',
    "[[File:x.png|thumb|caption]]",
    "__NOTOC__ text",
    "** [[A]] second level\n# [[B]] numbered",
    "\\section{Methods}\\label{sec:m} The text",
    "\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}",
    "as shown~\\cite{a2001} earlier",
    "See Fig.~\\ref{fig:a}.",
    "a claim\\footnote{see below} made",
    "{\\bf bold words} here",
    "\\textit{slanted} words, \\emph{too}",
    "about 40\\% of them",
    "where $x_i^2 = 0.3$ holds",
    "so \\(a \\leq b\\) holds",
    "\\begin{equation}\nE = \\frac{1}{2}\n\\end{equation}",
    "$$\\sum_i x_i$$",
    "1 & 2 & 3 \\\\ \\hline",
    "``quoted'' in the old way",
    "* first point of a list\n* second point of it",
    "* one more point",
)

PLAIN = (
    "Plain words in a sentence.",
    "Results",
    "",
    "1 Introduction",
    "n < 4 and m > 5 in all runs, with p < 0.05",
    "R&D costs rose & fell; item #12",
    "marked as * (p < 0.05) or ** (p < 0.01)",
    "the product 5 * 3 * 2 is even",
    "a density f(a | b) on the set {0, 1}",
    "item [389] only, and [12, 14] as well",
    "the C# client and the F# parser",
    "files lie under C:\\data\\runs_7 on the disk",
    "it costs $5 per piece and about ~9 grams",
    "we set max_step_size = 4 and min_count = 2",
    "short- and long-range ones -- and only those --",
    "- one thing\n- another thing",
    "12\t14\t9.5\n3  4  8",
    "potter's wheel and the potters' guild",
    "the l1 norm and the O(n) bound",
    "mail me at a@b.invalid, or use http://example.invalid/x",
    "a+b=c and x/y, 3^2 or 10_000",
    "- 12 -",
    "[214]",
    "the prof!le of the mode| in the text",
    "dou-\nbled words at a break",
    "he said \"no\" (twice); 'yes' later: 50%",
    "snake_case_name and another_name_here",
    "2 > 1; 1 < 2; a->b; x <- y",
    "50 % off | today only",
    "Annals, Vol. 3, No. 4 | 12",
    "* significant",
    "* see note",
    "Table 3: values by site\n* estimated",
)

#: Prose of several lengths between the labelled blocks of a document.
PROSE = (
    "A short line.",
    "The second series was weighed again in spring, after the scales had been repaired.",
    "None of the sites was visited twice. The keeper of the log wrote down the hour and the weather, and left the rest of the page empty for the readings of the day.",
    "In the first year the survey covered three valleys only. Later it was extended to the coast, where the boats of the harbour carried the instruments, and the old notes were copied by hand into one book. What is known of the earlier years comes from that book alone, as the papers themselves were lost in a flood.",
)


def documents() -> list[list[tuple[str, bool]]]:
    """Documents as lists of (text, carries markup) in reading order.

    Each labelled text stands once in a document full of markup, once between plain blocks, and once alone with prose,
    so that the neighbours' words and links are those of real neighbours, and length by itself tells nothing.
    """
    pages = []
    for n, size in ((0, 9), (1, 7), (2, 5)):
        plain = [(x, False) for x in (*PLAIN[n:], *PLAIN[:n])]
        for at in range(0, len(MARKUP), size):
            page = [(x, True) for x in MARKUP[at : at + size]]
            for k in range(0, size, n + 1):
                page.insert(2 * k, plain[(at + k) % len(plain)])
                page.insert(2 * k + 1, (PROSE[(at + k + n) % len(PROSE)], False))
            pages.append(page)
        pages.append([x for k, row in enumerate(plain) for x in (row, (PROSE[(k + n) % len(PROSE)], False))])
    ahead = [f"{p}\n" for p in PROSE]
    for n, lead in enumerate(ahead):
        pages.append([x for k, t in enumerate(MARKUP) for x in ((lead + t, True), (lead + PLAIN[(k + n) % len(PLAIN)], False))])
    return pages

