"""Problem 6: markup residue in text blocks, found by shallow text features and turned into clean text.

Every block is a flat text block (Kohlschuetter et al., "Boilerplate detection using shallow text features", 2010) with
its word count, its link density, counts of markup constructs, and the word count and link density of the blocks before
and after. A decision tree, grown on a small labelled table, says whether it carries markup; the tree becomes one
nested CASE expression, so that classifying runs in compiled code. Blocks with markup are then converted.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .markup_labels import PROSE, documents

#: The constructs that are counted, by family, in regular expressions that Java and Python read alike.
CONSTRUCTS = {
    "html_tag": r"</?[A-Za-z][A-Za-z0-9]{0,14}(?:\s[^<>]{0,200})?/?>|<!--|-->|<(?:https?|ftp|mailto):[^<>\s]+>",
    "html_entity": r"&(?:amp;)*(?:#[0-9]{1,6}|#x[0-9A-Fa-f]{1,6}|[A-Za-z]{2,8});|&(?:amp;)*(?:lt|gt|amp|nbsp|quot)(?=[A-Za-z])",
    "md_block": r"(?m)^[ \t]{0,3}#{1,6}[ \t]+\S|^[ \t]*(?:={3,}|~{3,}|`{3,})[ \t]*\w*[ \t]*$|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\||\|[ \t]*:?-{2,}:?[ \t]*\||^[ \t]*>[ \t]+\S|^[ \t]*[-*+][ \t]+\[[ xX]\][ \t]|^\[\^[^\]\s]+\]:",
    "md_link": r"\]\([^()\s]+\)|\]\[[0-9A-Za-z]{0,20}\]|!\[|\[\^[^\]\s]+\]",
    "md_mark": r"`[^`\n]+`|``|(?<![*\w\\])\*{1,3}(?=[^\s*()])[^*\n]*[^\s*(]\*{1,3}(?![*\w])|\*\*(?=[^\s*(])|(?<=[^\s*(])\*\*|(?<![\w_\\])_{1,3}(?=[^\s_])[^_\n]*[^\s_]_{1,3}(?![\w_])|(?<![\w_])__(?=[^\s_])|~~(?=\S)|(?<=\S)~~",
    "wiki": r"\[\[|\]\]|\{\{|\}\}|'{2,5}|\{\||(?m)^\|[-}]|(?m)^={2,6}[^=\n]+={2,6}[ \t]*$|\b__[A-Z]{4,}__\b|(?m)^![^!\n]+!!|(?m)^\[?https?://\S+\s[^\]]*\]",
    "latex_command": r"\\[A-Za-z]+\*?[ \t]*[{\[]|(?<![\w:\\])\\[A-Za-z]{2,}|~\\[A-Za-z]|\{\\|\\[%&#$_](?![A-Za-z0-9]*\\)|\\\\(?:[ \t]*(?:\\hline|\n|$))|``[^`'\n]+''",
    "latex_math": r"\\[()\[\]]|\$\$|\$[^$\n]*[\\^_={}][^$\n]*\$",
}
#: A sign without which no construct is possible: most blocks are settled by one look.
SIGNS = r"[<>&{}\[\]*_`#|=$~\\^]|''"
#: A line behind a star: a point of a list, or a note, which its number of words tells.
_STAR = r"(?m)^[ \t]*\*[ \t]+(\S[^\n]*)"
FEATURES = (*CONSTRUCTS, "star_words", "words", "link_density", "words_before", "density_before", "words_after", "density_after")
_LINK = r"<a\b[^>]*>[^<]*|\[[^\[\]\n]+\]\([^()\s]+\)|\[\[[^\[\]\n]+\]\]|<?https?://\S+"


@dataclass
class Node:
    """A split ``feature <= at`` with its two branches, or a leaf with the share of markup in it."""

    share: float
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 1) -> Node:
    """A decision tree by Gini impurity; ties go to the first feature and the lowest cut."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return Node(share)
    best = (share * (1 - share) - 1e-12, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n = int(low.sum())
            if n < least or len(y) - n < least:
                continue
            a, b = y[low].mean(), y[~low].mean()
            gini = (n * a * (1 - a) + (len(y) - n) * b * (1 - b)) / len(y)
            if gini < best[0]:
                best = (gini, f, float(cut))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def as_column(node: Node, columns: dict[str, Column]) -> Column:
    """The tree as a nested CASE expression giving the share of markup."""
    if node.feature < 0:
        return F.lit(node.share)
    return F.when(columns[FEATURES[node.feature]] <= node.at, as_column(node.low, columns)).otherwise(as_column(node.high, columns))


def _own_features(text: str) -> list[float]:
    words = len(text.split())
    linked = sum(len(m.split()) for m in re.findall(_LINK, text))
    starred = max((len(m.split()) for m in re.findall(_STAR, text)), default=0)
    return [*(float(len(re.findall(p if not p.count("(?m)") else "(?m)" + p.replace("(?m)", ""), text))) for p in CONSTRUCTS.values()), float(starred), float(words), min(1.0, linked / max(1, words))]


def labelled_features(pages: list[list[tuple[str, bool]]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Labelled documents (by default :func:`markup_labels.documents`) as features and labels, one row a block; the
    features of the neighbours are those of the blocks that stand before and after it."""
    rows, labels = [], []
    for page in documents() if pages is None else pages:
        own = [_own_features(text) for text, _ in page]
        sides = [(0.0, 0.0), *((x[-2], x[-1]) for x in own), (0.0, 0.0)]
        for k, (_, label) in enumerate(page):
            rows.append([*own[k], *sides[k], *sides[k + 2]])
            labels.append(float(label))
    return np.array(rows), np.array(labels)


def used_features(tree: Node) -> set[str]:
    """Names of the features that a tree splits on."""
    return set() if tree.feature < 0 else {FEATURES[tree.feature]} | used_features(tree.low) | used_features(tree.high)


def held_out_error(folds: int = 5) -> float:
    """Share of labelled texts that a tree grown without them misjudges: the texts, not their copies in several
    documents, are dealt out to the folds."""
    pages = documents()
    texts = sorted({t.split("\n", 1)[-1] if t.split("\n", 1)[0] in PROSE else t for page in pages for t, _ in page})
    fold = {t: k % folds for k, t in enumerate(texts)}
    of = lambda t: fold[t.split("\n", 1)[-1] if t.split("\n", 1)[0] in PROSE else t]
    x, y = labelled_features(pages)
    which = np.array([of(t) for page in pages for t, _ in page])
    wrong = 0
    for k in range(folds):
        tree = grow(x[which != k], y[which != k])
        wrong += sum((_judge(tree, row) >= 0.5) != bool(label) for row, label in zip(x[which == k], y[which == k]))
    return wrong / len(y)


def _judge(node: Node, row: np.ndarray) -> float:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.at else node.high
    return node.share


def trained_tree() -> Node:
    return grow(*labelled_features())


def block_features(sections: DataFrame) -> DataFrame:
    """One row per block: block_id, document_id, idx, type, text and :data:`FEATURES`.

    The neighbours come by an equal join on (document, position), not by a window, so that a document with very many
    blocks is spread like any other. Texts without any of :data:`SIGNS` skip the constructs.
    """
    rows = sections.where("block_id is not null").select("block_id", "document_id", F.col("source.source_index").alias("idx"), F.coalesce("type", F.lit("text")).alias("type"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["block_id"])
    signed = F.col("text").rlike(SIGNS)
    count = lambda p: F.when(signed, F.regexp_count("text", F.lit(p))).otherwise(0).cast("double")
    words = F.size(F.split(F.trim("text"), r"\s+")).cast("double")
    linked = F.when(signed, F.aggregate(F.transform(F.regexp_extract_all("text", F.lit(_LINK), F.lit(0)), lambda m: F.size(F.split(F.trim(m), r"\s+"))), F.lit(0), lambda a, b: a + b)).otherwise(0)
    starred = F.when(signed, F.coalesce(F.array_max(F.transform(F.regexp_extract_all("text", F.lit(_STAR), F.lit(1)), lambda m: F.size(F.split(F.trim(m), r"\s+")))), F.lit(0))).otherwise(0).cast("double")
    own = rows.select("*", starred.alias("star_words"), *[count(p if "(?m)" not in p else "(?m)" + p.replace("(?m)", "")).alias(k) for k, p in CONSTRUCTS.items()], F.when(F.trim("text") == "", 0.0).otherwise(words).alias("words"))
    own = own.withColumn("link_density", F.least(F.lit(1.0), linked / F.greatest(F.lit(1.0), F.col("words"))))
    slim = own.where("document_id is not null and idx is not null").groupBy("document_id", "idx").agg(F.max("words").alias("w"), F.max("link_density").alias("d"))
    sided = slim.select("document_id", F.explode(F.array(F.struct((F.col("idx") + 1).alias("idx"), F.lit(True).alias("before")), F.struct((F.col("idx") - 1).alias("idx"), F.lit(False).alias("before")))).alias("p"), "w", "d")
    sided = sided.groupBy("document_id", F.col("p.idx").alias("idx")).agg(*[F.max(F.when(F.col("p.before") == side, F.col(v))).alias(name) for v, side, name in (("w", True, "words_before"), ("d", True, "density_before"), ("w", False, "words_after"), ("d", False, "density_after"))])
    return own.join(sided, ["document_id", "idx"], "left").fillna(0.0, ["words_before", "density_before", "words_after", "density_after"])


def markup_share(features: DataFrame, tree: Node | None = None) -> DataFrame:
    """``features`` with ``markup``, the tree's share of markup."""
    return features.withColumn("markup", as_column(tree or trained_tree(), {f: F.col(f) for f in FEATURES}))


def markup_blocks(sections: DataFrame, tree: Node | None = None) -> DataFrame:
    """``block_id`` of every block, other than code and equations, whose text carries markup, whole or broken.

    Null texts count as empty, null types as text; rows with a null block id are left out, repeated rows count once, an
    empty table gives an empty one; further columns are ignored.
    """
    prose = ~F.lower(F.trim("type")).isin("code", "equation")
    return markup_share(block_features(sections), tree).where(prose & (F.col("markup") >= 0.5)).select("block_id").distinct()


_COMMANDS = r"textbf|textit|texttt|textsc|textrm|emph|underline|mbox|text|mathrm|bf|em|it|tt|sc|large|small"


def _fold_latex(text: str) -> str:
    text = re.sub(r"\\(?:sub)*section\*?\{([^{}]*)\}(?:\\label\{[^{}]*\})?", r"\n# \1\n", text)
    text = re.sub(r"\\(?:sub)?paragraph\*?\{([^{}]*)\}(?:\\label\{[^{}]*\})?", r"\n# \1\n", text)
    text = re.sub(r"\\begin\{(?:equation|align|displaymath)\*?\}\s*(.*?)\s*\\end\{(?:equation|align|displaymath)\*?\}", r"\n$$ \1 $$\n", text, flags=re.S)
    text = re.sub(r"\\begin\{(?:itemize|enumerate|tabular|table|quote)\*?\}(?:\{[^{}]*\}|\[[^\]]*\])*|\\end\{[^{}]*\}", "\n", text)
    text = re.sub(r"[ \t]*\\item(?:\[[^\]]*\])?\s*", "\n- ", text)
    text = re.sub(r"~?\\(?:cite[a-z]*|ref|eqref|label|footnote|index|vspace|hspace)\*?(?:\[[^\]]*\])?\{[^{}]*\}", "", text)
    for _ in range(4):
        once = re.sub(r"\\(?:" + _COMMANDS + r")\{([^{}]*)\}", r"\1", text)
        once = re.sub(r"\{\\(?:" + _COMMANDS + r")\s+([^{}]*)\}?", r"\1", once)
        if once == text:
            break
        text = once
    text = re.sub(r"\\\(\s*(.*?)\s*\\\)", r"$\1$", text, flags=re.S)
    text = re.sub(r"\\\[\s*(.*?)\s*\\\]", r"$$ \1 $$", text, flags=re.S)
    text = re.sub(r"\\([%&#_{}])", r"\1", text)
    text = re.sub(r"``([^`'\n]*)''", r'"\1"', text)
    if re.search(r"&.*\\\\", text):
        text = re.sub(r"[ \t]*\\\\[ \t]*(?:\\hline)?[ \t]*", "\n", re.sub(r"[ \t]*(?<!\\)&[ \t]*", "\t", text))
    return text.replace("\\hline", "")


def _table_row(line: str) -> str:
    return "\t".join(cell.strip() for cell in re.split(r"\|\||!!|\|", line.strip().strip("|!").strip()) if cell.strip() or "|" in line)


def clean_markup(text: str | None, kind: str | None = None) -> str:
    """Text without HTML, Markdown, wiki and LaTeX markup; '' for null.

    Kept is the structure: headings as ``# ...`` lines, list items as ``- ...``, tables as tab-separated rows, code
    between ``` fences, formulas as ``$...$`` or ``$$ ... $$``.
    """
    if not text:
        return ""
    codes: list[str] = []

    def keep(m: re.Match) -> str:
        codes.append(m.group(1).strip("\n"))
        return f"\n\x00{len(codes) - 1}\x00\n"

    text = re.sub(r"```[A-Za-z0-9]*\n(.*?)\n?```", keep, text, flags=re.S)
    text = re.sub(r"<(?:pre|code)\b[^>]*>(.*?)</(?:pre|code)>", keep, text, flags=re.S | re.I)
    text = text.replace("```", "\n")
    for _ in range(3):  # entities that were escaped again and again
        once = html.unescape(re.sub(r"&(amp;)*(lt|gt|nbsp|amp|quot)(?=[A-Za-z/])", lambda m: {"lt": "<", "gt": ">", "nbsp": " ", "amp": "&", "quot": '"'}[m.group(2)], text))
        if once == text:
            break
        text = once
    text = text.replace("\xa0", " ")
    text = re.sub(r"<!--.*?(?:-->|$)|-->", " ", text, flags=re.S)
    text = re.sub(r"<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref>", "", text, flags=re.S | re.I)
    text = re.sub(r"<h[1-6]\b[^>]*>", "\n# ", text, flags=re.I)
    text = re.sub(r"</h[1-6]>", "\n", text, flags=re.I)
    text = re.sub(r"<li\b[^>]*>", "\n- ", text, flags=re.I)
    text = re.sub(r"</t[dh]>\s*<t[dh]\b[^>]*>", "\t", text, flags=re.I)
    text = re.sub(r"<(?:br|/p|p|/tr|tr|/li|/?[uo]l|/?table|/?div|/?blockquote)\b[^>]*>", "\n", text, flags=re.I)
    text = re.sub(r"<((?:https?|ftp)://[^<>\s]+)>", r"\1", text)
    text = re.sub(r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>", "", text)
    text = re.sub(r"\{\{[^{}]*\}\}", "", text)
    text = re.sub(r"!\[([^\]]*)\]\([^()]*\)", r"\1", text)
    text = re.sub(r"\[\[(?:File|Image):[^\[\]]*?(?:\|([^\[\]|]*))?\]\]", r"\1", text)
    text = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", text)
    text = re.sub(r"\[([^\[\]\n]+)\]\([^()\s]+\)|\[([^\[\]\n]+)\]\[[0-9A-Za-z]*\]", lambda m: m.group(1) or m.group(2), text)
    text = re.sub(r"(?m)^\[\^[^\]\s]+\]:[ \t]*", "", text)
    text = re.sub(r"\[\^[^\]\s]+\]", "", text)
    text = _fold_latex(text)
    text = re.sub(r"__[A-Z]{4,}__", "", text)
    text = re.sub(r"(?m)^[ \t]*\S?={2,6}[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$", r"# \1", text)
    text = re.sub(r"(?m)^(.+)\n[ \t]*={3,}[ \t]*$", r"# \1", text)
    text = re.sub(r"(?m)^[ \t]{0,3}#{1,6}[ \t]+(?!#)", "# ", text)
    text = re.sub(r"(?m)^[ \t]*[*+:]{1,4}[ \t]+(?=\S)|^[ \t]*-[ \t]+\[[ xX]\][ \t]+", "- ", text)
    text = re.sub(r"(?m)^[ \t]*>[ \t]+", "", text)
    lines = []
    for line in text.split("\n"):
        if re.match(r"^\s*(\{\||\|\}|\|-|\|?[ \t:|-]*-{3,}[ \t:|-]*\|?\s*$)", line):
            continue
        lines.append(_table_row(line) if re.match(r"^\s*(\|.+\||\|\s.*\|\|.*|![^!].*!!.*|[|!] \S.*)$", line) else line)
    text = "\n".join(lines)
    text = re.sub(r"'{2,5}", "", text)
    text = re.sub(r"\*{1,3}(?=[^\s*()])([^*\n]*?[^\s*(])\*{1,3}|~~(?=\S)(.*?\S)~~|(?<![\w_])_{1,3}(?=[^\s_])([^_\n]*[^\s_])_{1,3}(?![\w_])", lambda m: next(x for x in m.groups() if x is not None), text)
    text = re.sub(r"`+([^`\n]*)`+|``", lambda m: m.group(1) or "", text)
    text = re.sub(r"\[\[|\]\]|\{\{|\}\}|(?<!\w)\*\*(?=[^\s(])|~~", "", text)
    text = re.sub(r"\x00([0-9]+)\x00", lambda m: f"```\n{codes[int(m.group(1))]}\n```", text)
    text = re.sub(r"[ \t]+(?=\n)|(?<=\n)[ ]+(?=[^\s-])", "", text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" {2,}", " ", text)).strip()


def clean_blocks(sections: DataFrame, tree: Node | None = None) -> DataFrame:
    """``(block_id, type, markup, clean_text, structure)`` of every block.

    ``structure`` is heading, list, table, code, formula or text, read from the cleaned text (from ``type`` where the
    block is code or an equation, which stay as they are). Blocks without markup keep their text; only the others are
    sent to Python.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [clean_markup(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([True] * len(clean), pa.bool_()), pa.array(clean, pa.string())], names=["block_id", "type", "markup", "clean_text"])

    scored = markup_share(block_features(sections), tree).select("block_id", "type", "text", (F.col("markup") >= 0.5).alias("markup"))
    prose = ~F.lower(F.trim("type")).isin("code", "equation")
    dirty = scored.where(prose & F.col("markup")).select("block_id", "type", "text").mapInArrow(convert, "block_id string, type string, markup boolean, clean_text string")
    whole = dirty.unionByName(scored.where(~(prose & F.col("markup"))).select("block_id", "type", F.lit(False).alias("markup"), F.col("text").alias("clean_text")))
    kind = F.lower(F.trim("type"))
    structure = (
        F.when(kind == "code", "code").when(kind == "equation", "formula").when(F.col("clean_text").rlike(r"(?s)^```.*```$"), "code")
        .when(kind.isin("title", "heading") | F.col("clean_text").rlike(r"^# [^\n]*$"), "heading").when((kind == "table") | F.col("clean_text").rlike(r"(?m)^[^\t\n]+\t"), "table")
        .when(kind.isin("list", "list_item") | F.col("clean_text").rlike(r"(?m)^- "), "list").when(F.col("clean_text").rlike(r"(?s)^\$\$.*\$\$$"), "formula").otherwise("text")
    )
    return whole.withColumn("structure", structure)
