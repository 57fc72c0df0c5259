"""Problem 3: traces of page scanning in text blocks, and their repair into readable paragraphs.

1. All words of the corpus are counted. Forms that the confusable glyphs of a scanner turn into one *skeleton* are one
   group; of each group the frequent forms are the words of the language, far rarer ones are misreadings.
2. Words outside that vocabulary are explained, if possible, by a skeleton, one misread glyph, a lost blank, a split
   word; of several explanations the one that its neighbours support is taken.
3. Running headers and page numbers are lines that are alike once digits are masked and whose number follows the page.
4. What remains is reflowed with window functions: lines into sentences, blocks into paragraphs across pages.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut, drop_made, scratch_mark

#: Glyph runs that scanners confuse, longest first, each with the sign that stands for its group.
CONFUSABLE = (("rn", "m"), ("nn", "m"), ("in", "m"), ("ni", "m"), ("li", "h"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("ll", "u"), ("0", "o"), ("1", "l"), ("i", "l"), ("!", "l"), ("|", "l"), ("5", "s"), ("$", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("q", "g"), ("e", "c"))
#: Signs read for letters inside a word.
DIGIT_FOR = {"0": "o", "1": "li", "!": "il", "|": "li", "5": "s", "6": "bg", "8": "b", "9": "g", "$": "s", "4": "a", "3": "e", "7": "t"}
SHORT_WORDS = frozenset("a an as at be by if in is it no of on or so to we and are but for its not our the was".split())
_TOKEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"([^\W\d_]+)([-¬­‐‑][ \t\r]*\n\s*|[¬­‐][ \t]*|- +)([^\W\d_]+)")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_] ){2,}[^\W_](?![^\W_])")
_SIGN = re.compile(r"(?<![\w\\])(?=[^\W_]*[0-9!|$])(?:[^\W\d_]|[0-9!|$](?=[^\W\d_])|(?<=[^\W\d_])[0-9!|$])+(?![\w])")


def skeleton(word: str) -> str:
    for glyphs, sign in CONFUSABLE:
        word = word.replace(glyphs, sign)
    return word


def word_counts(blocks: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of every word and hyphenated compound, in lower case, over all blocks.

    Each batch is counted before the shuffle, so that what moves is one row per word and batch.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in _TOKEN.findall(text.lower()):
                    total[word] += 1
                    if "-" in word:
                        total.update(word.split("-"))
            if len(total) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
                total = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = blocks.select(F.col(text_col).alias("text")).where("text is not null")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _skeleton(word: Column) -> Column:
    """:func:`skeleton` in compiled code."""
    for glyphs, sign in CONFUSABLE:
        word = F.replace(word, F.lit(glyphs), F.lit(sign))
    return word


def _wild_keys(word: Column) -> Column:
    """The word with one letter left out, once for each letter; none for short words and compounds."""
    gaps = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when((F.length(word) > 3) & ~word.contains("-"), gaps).otherwise(F.array().cast("array<string>"))


def frequent_words(counts: DataFrame, least: int = 3) -> DataFrame:
    """The vocabulary (word, n): words with n >= ``least`` that are no misread forms.

    A form is misread if another one of the same skeleton is 20 times as frequent, one that differs by a single letter
    (not by an inflection) 40 times, or 100 times where it has fewer than six letters, or if it falls into two words that are
    20 times as frequent. Only ratios decide, so that a rare word stays known however large the corpus is.
    """
    words = counts.where(F.col("n") >= least).withColumn("shape", _skeleton(F.col("word")))
    best = words.groupBy("shape").agg(F.max("n").alias("best"))
    keys = words.select("word", "n", F.posexplode(_wild_keys(F.col("word"))).alias("at", "key"))
    near = keys.where((F.col("at") < F.length("word") - 1) | ~F.col("word").rlike("[sdrny]$")).join(keys.groupBy("key").agg(F.max("n").alias("near")), "key").groupBy("word").agg(F.max("near").alias("near"))
    cuts = words.where((F.length("word") > 5) & ~F.col("word").contains("-")).select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at"))
    part = lambda c: (F.length(c) > 3) | c.isin(*SHORT_WORDS)
    cuts = cuts.select("word", "n", F.expr("left(word, at)").alias("a"), F.expr("substring(word, at + 1)").alias("b")).where(part(F.col("a")) & part(F.col("b")))
    often = words.where("n >= 20").select("word", "n")
    cuts = cuts.join(often.toDF("a", "n_a"), "a").join(often.toDF("b", "n_b"), "b").where("least(n_a, n_b) >= 20 * n").select("word").distinct()
    joined = words.join(best, "shape").join(near, "word", "left").join(cuts, "word", "left_anti")
    rare = F.when(F.length("word") < 6, 100).otherwise(40)
    return joined.where((F.col("n") * 20 > F.col("best")) & (F.col("near").isNull() | (F.col("n") * rare > F.col("near")))).select("word", "n")


def neighbour_counts(texts: DataFrame, wanted: DataFrame, limit: int = 500_000) -> DataFrame:
    """(a, b, n): how often the words ``a`` and ``b`` of ``wanted`` stand side by side in all texts.

    Up to ``limit`` wanted pairs (counted first) are broadcast, so that no other pair leaves its batch; more are joined.
    """
    held = None
    if wanted.count() <= limit:
        held = texts.sparkSession.sparkContext.broadcast({(r.a, r.b) for r in wanted.collect()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = held.value if held is not None else None
        for batch in batches:
            total: Counter[tuple[str, str]] = Counter()
            for text in batch.column(0).to_pylist():
                row = _WORD.findall(text.lower())
                total.update(p for p in zip(row, row[1:]) if pairs is None or p in pairs)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in total], pa.string()), pa.array([b for _, b in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["a", "b", "n"])

    rows = texts.select("text").where("text is not null").mapInArrow(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return rows if held is not None else rows.join(wanted, ["a", "b"], "left_semi")


_PLAIN_SIGN = str.maketrans("ig", "lb")


def sign_key(token: str) -> str:
    """What all readings of a token with signs have in common: the letters that one sign may mean are one letter."""
    return "".join(DIGIT_FOR.get(ch, ch)[0] for ch in token).translate(_PLAIN_SIGN)


class Reader:
    """Explains and repairs words of a scanned text by a vocabulary {word: occurrences}.

    What it says of a text follows from the text and the vocabulary; ``cache`` only spares time.
    """

    def __init__(self, known: dict[str, int]) -> None:
        self.known = known
        self.shape: dict[str, list[str]] = defaultdict(list)
        self.plain: dict[str, list[str]] = defaultdict(list)
        for word in known:
            if "-" not in word:
                self.shape[skeleton(word)].append(word)
                self.plain[word.translate(_PLAIN_SIGN)].append(word)
        self.letters = sorted({ch for word in known for ch in word} - {"-"})
        self.longest = max(map(len, known), default=0)
        self.cache: dict[str, tuple[bool, list[str]]] = {}

    def count(self, word: str) -> int:
        return self.known.get(word, 0)

    def of_shape(self, shape: str) -> list[str]:
        return self.shape.get(shape, [])

    def of_sign_key(self, key: str) -> list[str]:
        return self.plain.get(key, [])

    def one_letter_off(self, word: str) -> list[tuple[int, str]]:
        """(place, known word) for words that differ in the letter at this place."""
        known = self.known
        return [(i, w) for i, at in enumerate(word) for x in self.letters if x != at and (w := word[:i] + x + word[i + 1 :]) in known]

    def signed(self, token: str) -> str | None:
        """The word meant by a token with digits or signs among its letters."""
        low = token.lower()
        hits = [w for w in self.of_sign_key(sign_key(low)) if len(w) == len(low) and len(w) > 2 and all(x in DIGIT_FOR.get(ch, ch) for ch, x in zip(low, w))]
        if hits:
            return max(hits, key=lambda w: (self.count(w), w))
        inner = re.search(r"[a-z]{2}[01!|5689][a-z]{2}", token)
        return "".join(DIGIT_FOR.get(ch, ch)[0] for ch in low) if inner and len(re.findall(r"[0-9!|$]", token)) == 1 else None

    def explain(self, word: str) -> tuple[bool, list[str]]:
        """Known words (or two words) that a lower-case word outside the vocabulary may stand for; empty if none.

        The explanation is strong if confusable glyphs account for it."""
        held = self.cache.get(word)
        if held is not None:
            return held
        if len(word) > 2 * self.longest:  # a skeleton has at least half of its word's letters
            return False, []
        found = sorted(self.of_shape(skeleton(word)))
        strong = bool(found)
        if not found and 3 < len(word) <= self.longest:
            ends = "sdrny"
            found = sorted(x for i, x in self.one_letter_off(word) if self.count(x) >= 5 and not (i == len(word) - 1 and word[i] in ends and x[i] in ends))
        if not found and len(word) > 5:
            found = [f"{word[:i]} {word[i:]}" for i in range(1, len(word)) if self._part(word[:i]) and self._part(word[i:])]
        if len(self.cache) < 500_000:
            self.cache[word] = strong, found
        return strong, found

    def _part(self, word: str) -> bool:
        return (len(word) > 3 or word in SHORT_WORDS) and self.count(word) >= 20

    def repair(self, text: str) -> tuple[list[str], str, list[dict]]:
        """(kinds of traces, repaired text, choices); a text without traces comes back as it is.

        A *choice* is a word whose explanations its neighbours have to judge: its place in the text holds a mark
        (:func:`mark`), and it names the neighbours, the word as it stands, and the options.
        """
        kinds: set[str] = set()

        def joined(m: re.Match) -> str:
            a, sign, b = m.groups()
            whole, compound = (a + b).lower(), f"{a}-{b}".lower()
            if sign[0] in "¬­‐":
                kinds.add("hyphen")
                return a + b
            if self.count(whole) or ("\n" in sign and not self.count(compound) and b[0].islower() and not (self.count(a.lower()) and self.count(b.lower()))):
                kinds.add("hyphen")
                return a + b
            if "\n" in sign and self.count(compound):
                return f"{a}-{b}"
            return m.group(0)

        while True:  # a word may be split more than once
            once = _BREAK.sub(joined, text)
            if once == text:
                break
            text = once

        def closed(m: re.Match) -> str:
            if sum(ch.isalpha() for ch in m.group(0)) < 2:
                return m.group(0)
            kinds.add("spacing")
            return m.group(0).replace(" ", "")

        text = _SPACED.sub(closed, text)

        wiki = "{{" in text or "[[" in text or "{|" in text

        def read(m: re.Match) -> str:
            if wiki and "|" in m.group(0):
                return m.group(0)
            word = self.signed(m.group(0))
            if word is None:
                return m.group(0)
            kinds.add("glyph")
            return _case_like(word, m.group(0))

        if any(ch in text for ch in "0123456789!|$"):
            text = _SIGN.sub(read, text)
        tokens = [(m.start(), m.end(), m.group(0)) for m in _WORD.finditer(text)]
        swaps: list[tuple[int, int, str]] = []
        choices: list[dict] = []
        skip = -1
        for k, (start, end, word) in enumerate(tokens):
            low = word.lower()
            if k <= skip or len(word) < 3 or self.count(low):
                continue
            after = tokens[k + 1] if k + 1 < len(tokens) else None
            if after and text[end : after[0]] == " " and after[2].islower() and len(after[2]) > 1 and self.count(low + after[2].lower()) and not (after[2] in SHORT_WORDS and self.explain(low)[1]):
                kinds.add("spacing")
                swaps.append((start, after[1], _case_like(low + after[2].lower(), word)))
                skip = k + 1
                continue
            if word[0].isupper() and (word[1:] != word[1:].lower() and word != word.upper() or (k and len(word) < 6 and not _starts(text, start))):
                continue  # a name
            if word[0].isupper() and ("-" in text[max(0, start - 1) : start] or "-" in text[end : end + 1]):
                continue  # a part of a compound name
            strong, fits = self.explain(low)
            if fits and not (word[0].isupper() and not _starts(text, start) and (" " in fits[0] or skeleton(low) != skeleton(fits[0]) and len(low) < 8)):
                before, behind = tokens[k - 1][2].lower() if k else "", after[2].lower() if after else ""
                choices.append({"k": len(choices), "before": before, "behind": behind, "word": word, "strong": strong, "options": [{"first": x.split(" ")[0], "last": x.split(" ")[-1], "shown": _case_like(x, word), "n": self.count(x)} for x in fits]})
                swaps.append((start, end, mark(len(choices) - 1)))
        for start, end, word in reversed(swaps):
            text = text[:start] + word + text[end:]
        return sorted(kinds), text, choices


def mark(k: int) -> str:
    """What stands for the choice ``k`` in a text (noncharacters, which no text holds)."""
    return f"\ufdd0{k}\ufdd1"


def _starts(text: str, at: int) -> bool:
    """Whether a sentence starts at this place."""
    head = text[:at].rstrip()
    return not head or head[-1] in ".!?:"


def _case_like(word: str, model: str) -> str:
    letters = [ch for ch in model if ch.isalpha()]
    if len(letters) > 1 and all(ch.isupper() for ch in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if letters and letters[0].isupper() and model[0].isalpha() else word


def page_lines(blocks: DataFrame) -> DataFrame:
    """Running headers, footers and page numbers: ``(block_id, line_no, whole)`` of each such line.

    ``blocks``: block_id, document_id, type, page_index, title, text of scanned files, one row per block. Digits are
    masked: a line is a *page number* if nothing but its number, a roman numeral and the usual decoration stand in it,
    and a *running header* if its masked text carries a number that follows the page (page number minus page index is
    the document's most frequent such offset), or recurs without number where its masked text was seen as a header, in
    the document or in several, or is the cut title of its document.
    """
    lines = blocks.where("page_index is not null and text is not null and type not in ('code', 'equation') and (type <> 'table' or text rlike '[a-z]{3,} [a-z]{2,} [a-z]{2,}' and not text rlike '<t[dr]')").select("block_id", "document_id", "type", "page_index", "title", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", r"[\s\u00a0]+", " "))).where("line <> '' and length(line) <= 100")
    pure = r"^(?i)(?:(?:page|pg|p)\b\.?\s*)?[\-–—·\[|.\s]*((?=[lIOoS|]*[0-9])[0-9lIOoS|]{1,4}|[lIO|]{2,3})\s*(?:(?:of|/)\s*[0-9lIOoS|]{1,4})?[\-–—·\]|.\s]*$"
    roman = r"^[\-–—·\[\s]*(?=[ivxlc])(?:x{0,3}|xl|lx{0,3}|xc)(?:ix|iv|v?i{0,3})[\-–—·\]\s]*$"
    ends = r"^([0-9]{1,4})\b[\s|.·—–\-]*(?=\S*\p{L})|(?:^|[\s|.·…—–\-])([0-9]{1,4})$"
    bare = F.regexp_replace("line", r"^[0-9]{1,4}\b[\s|·—–\-]+|[\s|·…—–\-]+[0-9]{1,4}$", "")
    lines = lines.withColumn("pure", F.regexp_extract("line", pure, 1)).withColumn("roman", F.col("line").rlike(roman))
    lines = lines.withColumn("num", F.coalesce(F.expr("try_cast(nullif(translate(pure, 'lI|OoS', '111005'), '') as int)"), F.expr(f"try_cast(nullif(regexp_extract(line, r'{ends}', 1), '') as int)"), F.expr(f"try_cast(nullif(regexp_extract(line, r'{ends}', 2), '') as int)")))
    lines = lines.withColumn("key", F.when(F.col("pure") == "", F.trim(F.regexp_replace(F.regexp_replace(F.lower(bare), r"[0-9]+", "#"), r"[.…\s|]+$", ""))))
    lines = cut(lines.withColumn("off", F.col("num") - F.col("page_index")), "lines")
    # A heading has its number too, but only a page number keeps its distance to the page throughout the document.
    offsets = lines.where("off is not null and (pure <> '' or length(key) between 4 and 70)").groupBy("document_id", "off").agg(F.countDistinct("page_index").alias("n"))
    top = offsets.groupBy("document_id").agg(F.max_by("off", F.struct("n", "off")).alias("top"), F.max("n").alias("n")).where("n >= 2").select("document_id", "top")
    lines = lines.join(top, "document_id", "left").withColumn("follows", F.coalesce(F.col("off") == F.col("top"), F.lit(False)))
    # Markup, tables and formulas recur as well, but a header is made of words.
    lines = lines.withColumn("key", F.when(F.col("key").rlike(r"^[\p{L}0-9# ,.:;'’&()?!\-]+$") & F.col("key").rlike(r"\p{L}{2}"), F.col("key")))
    lines = lines.withColumn("opening", F.when(F.length("key") <= 62, F.regexp_extract("key", r"^(\p{L}+ \p{L}+)\b", 1)))
    textual = lines.where("key is not null and length(key) >= 4")
    # Numbered headings meet the offset by chance; a header's numbers follow the page as a rule.
    seen = textual.where("num is not null").groupBy("key").agg(F.countDistinct(F.when(F.col("follows"), F.struct("document_id", "page_index"))).alias("pages"), F.avg(F.col("follows").cast("int")).alias("rate"))
    heads = seen.where("pages >= 2 and rate >= 0.5").select("key", F.lit(True).alias("head"))
    repeats = textual.where(~F.col("type").isin("title", "heading") & (F.length("key") <= 70) & (~F.col("line").rlike(r"\p{Ll}\.$") | F.col("line").rlike(r"\bal\.$")) & F.col("line").rlike(r"^[A-Z0-9].*\s[A-Z]")).groupBy("document_id", "key").agg(F.countDistinct("page_index").alias("pages")).where("pages >= 2").select("document_id", "key", F.lit(True).alias("again"))
    # Rare or cut headers: short lines that open like headers of several documents.
    openings = textual.join(heads, "key", "left_semi").where("follows and opening <> ''").groupBy("opening").agg(F.countDistinct("document_id").alias("docs"), F.countDistinct("key").alias("keys")).where("docs >= 3").select("opening", F.lit(True).alias("opens"))
    flagged = lines.join(heads, "key", "left").join(repeats, ["document_id", "key"], "left").join(openings, "opening", "left")
    cut_title = (F.length("key") >= 25) & F.lower("title").startswith(F.col("key")) & (F.length("title") > F.length("key"))
    opened = F.col("opens") & F.col("line").rlike(r"^[A-Z0-9]") & ~F.col("line").rlike(r"[a-z][.,]$")
    names = F.col("line").rlike(r"^(?:[0-9]+ )?(?:[A-Z][a-z]+|[A-Z]{3,}) (?:et al\.?|ET AL\.?|and [A-Z][a-z]+|AND [A-Z]{3,})(?:[.… |]* ?[0-9]*)$")
    alone = F.col("line_no") == 0
    decorated = F.col("line").rlike(r"(?i)^[^0-9]*(page|p\.)|[\-–—·\[/]")
    number = (F.col("pure") != "") & (F.col("follows") | decorated | F.col("type").isin("page_number", "footer", "header", "text", "page_footnote")) & (F.col("follows") | alone | decorated)
    header = F.col("key").isNotNull() & ((F.col("follows") & (F.length("key") <= 70) & F.col("head")) | (F.col("head") & (F.col("num").isNull() | F.col("top").isNull())) | F.col("again") | cut_title | names | opened | (F.col("follows") & F.col("type").isin("header", "footer")))
    return flagged.where((number & (F.col("type") != "table")) | (F.col("roman") & alone) | F.coalesce(header, F.lit(False))).select("block_id", "line_no").distinct()


def scanned_rows(sections: DataFrame) -> DataFrame:
    """Rows of blocks of files with pages: (block_id, document_id, type, page_index, idx, title, text)."""
    wanted = sections.where("block_id is not null and page_index is not null and text is not null")
    return wanted.select("block_id", "document_id", F.coalesce("type", F.lit("text")).alias("type"), "page_index", F.col("source.source_index").alias("idx"), F.get("section_path", F.lit(0)).alias("title"), "text")


def scanned_blocks(sections: DataFrame) -> DataFrame:
    """One row per block of files with pages, the columns as in :func:`scanned_rows`."""
    return scanned_rows(sections).dropDuplicates(["block_id"])


_OPTION = "struct<first:string,last:string,shown:string,n:bigint>"
_FIXED = f"block_id string, kinds array<string>, fixed string, choices array<struct<k:int,before:string,behind:string,word:string,strong:boolean,options:array<{_OPTION}>>>"
_CHOICES = pa.list_(pa.struct([("k", pa.int32()), ("before", pa.string()), ("behind", pa.string()), ("word", pa.string()), ("strong", pa.bool_()), ("options", pa.list_(pa.struct([("first", pa.string()), ("last", pa.string()), ("shown", pa.string()), ("n", pa.int64())])))]))
#: Readers of this Python worker by the vocabulary they were made of.
_readers: dict[str, Reader] = {}


def _read_batch(reader: Reader, ids: list, texts: list[str]) -> pa.RecordBatch:
    out: tuple[list, ...] = ([], [], [], [])
    for block, text in zip(ids, texts):
        kinds, repaired, choices = reader.repair(text)
        if kinds or choices:
            for column, value in zip(out, (block, kinds, repaired, choices)):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.list_(pa.string()), pa.string(), _CHOICES))], names=["block_id", "kinds", "fixed", "choices"])


class _AskingReader(Reader):
    """A reader that knows the answers {key: [(word, n)]} of :func:`_keyed`, and notes the keys that it misses."""

    def __init__(self, answers: dict[str, list[tuple[str, int]]], longest: int) -> None:
        super().__init__({})
        self.longest = longest
        self.answers = answers
        self.known = {w: n for found in answers.values() for w, n in found}
        self.missed: set[str] = set()

    def _ask(self, key: str) -> list[str]:
        found = self.answers.get(key)
        if found is None:
            self.missed.add(key)
        return [w for w, _ in found or ()]

    def count(self, word: str) -> int:
        return self.known[word] if word in self.known else 0 * len(self._ask(f"={word}"))

    def of_shape(self, shape: str) -> list[str]:
        return self._ask(f"~{shape}")

    def of_sign_key(self, key: str) -> list[str]:
        return self._ask(f"#{key}")

    def one_letter_off(self, word: str) -> list[tuple[int, str]]:
        return [(i, w) for i in range(len(word)) for w in self._ask(f"{i + 1}:{word[:i]}{word[i + 1:]}") if w != word]


def _keyed(known: DataFrame) -> DataFrame:
    """(key, word, n): the vocabulary under every key by which a reader may look it up."""
    gaps = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word"))))
    single = F.array(F.concat(F.lit("~"), _skeleton(F.col("word"))), F.concat(F.lit("#"), F.translate("word", "ig", "lb")))
    keys = F.concat(F.array(F.concat(F.lit("="), "word")), F.when(F.col("word").contains("-"), F.array().cast("array<string>")).otherwise(F.concat(single, gaps)))
    return known.select(F.explode(keys).alias("key"), "word", "n")


def _asked_traces(prose: DataFrame, known: DataFrame, chunk_blocks: int) -> DataFrame:
    """Traces where the vocabulary is too large to be broadcast: chunks of blocks ask for the words that they consult.

    A chunk is read with the answers it has, and notes the keys it misses; these are joined with the vocabulary, and so
    on until no chunk misses any. Then every look-up was answered, and the result is that of the whole vocabulary.
    """
    spark = prose.sparkSession
    chunks = -(-max(1, prose.count()) // chunk_blocks)
    placed = cut(prose.withColumn("chunk", F.pmod(F.xxhash64("block_id"), F.lit(chunks))), "chunks")
    keyed = cut(_keyed(known), "keyed-words")
    longest = known.agg(F.max(F.length("word"))).first()[0]
    answers = spark.createDataFrame([], "chunk long, key string, word string, n long")

    def answered(pdf: pd.DataFrame) -> dict[str, list[tuple[str, int]]]:
        out: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for key, word, n in zip(pdf["key"], pdf["word"], pdf["n"]):
            found = out[key]
            if isinstance(word, str):
                found.append((word, int(n)))
        return dict(out)

    def miss(blocks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        reader = _AskingReader(answered(told), longest)
        for text in blocks["text"]:
            reader.repair(text)
        keys = sorted(reader.missed)
        return pd.DataFrame({"chunk": [int(blocks["chunk"].iloc[0])] * len(keys) if len(blocks) else [], "key": keys}).astype({"chunk": "int64", "key": "object"})

    def read(blocks: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        return _read_batch(_AskingReader(answered(told), longest), list(blocks["block_id"]), list(blocks["text"])).to_pandas()

    while True:
        both = placed.groupBy("chunk").cogroup(answers.groupBy("chunk"))
        missed = cut(both.applyInPandas(miss, "chunk long, key string"), "missed-keys")
        if missed.isEmpty():
            return both.applyInPandas(read, _FIXED)
        answers = cut(answers.unionByName(missed.join(keyed, "key", "left")), "answers")


def _candidate_traces(blocks: DataFrame, known: DataFrame, limit: int, chunk_blocks: int = 2000) -> DataFrame:
    """:data:`_FIXED` of the blocks in which a word is split, misread or wrongly spaced, or may be."""
    spark = blocks.sparkSession
    prose = blocks.where("type not in ('code', 'equation', 'table')").select("block_id", "text")
    if known.count() > limit:
        return _asked_traces(prose, known, chunk_blocks)
    held, key = spark.sparkContext.broadcast({r.word: r.n for r in known.collect()}), uuid.uuid4().hex

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _readers:
            _readers.clear()
            _readers[key] = Reader(held.value)
        for batch in batches:
            yield _read_batch(_readers[key], batch.column(0).to_pylist(), batch.column(1).to_pylist())

    return prose.mapInArrow(read, _FIXED)


def word_traces(blocks: DataFrame, texts: DataFrame, known: DataFrame, limit: int = 500_000) -> DataFrame:
    """(block_id, kinds, fixed) of blocks (block_id, type, text) in which a word was split, misread or wrongly spaced.

    ``known`` is the vocabulary of :func:`frequent_words` over ``texts`` (all of them). Of several explanations of a
    word the one that stands most often beside its neighbours in all texts is taken, then the most frequent; a weak
    explanation that never stands there is none, and the word stays. Two words stand beside each other.
    """
    found = cut(_candidate_traces(blocks, known, limit), "word-traces")
    asked = found.select("block_id", F.explode("choices").alias("c")).select("block_id", "c.*").select("block_id", "k", "before", "behind", "word", "strong", F.explode("options").alias("o"))
    sides = asked.select(F.explode(F.array(F.struct(F.col("before").alias("a"), F.col("o.first").alias("b")), F.struct(F.col("o.last").alias("a"), F.col("behind").alias("b")), F.struct(F.col("o.first").alias("a"), F.col("o.last").alias("b")))).alias("p")).select("p.*").where("a <> '' and b <> ''").distinct()
    pairs = neighbour_counts(texts, cut(sides, "asked-pairs"))
    inner = pairs.select(F.col("a").alias("first"), F.col("b").alias("last"), F.col("n").alias("n_inner"))
    left, right = pairs.select(F.col("a").alias("before"), F.col("b").alias("first"), F.col("n").alias("n_before")), pairs.select(F.col("a").alias("last"), F.col("b").alias("behind"), F.col("n").alias("n_behind"))
    judged = asked.withColumns({"first": F.col("o.first"), "last": F.col("o.last")}).join(left, ["before", "first"], "left").join(right, ["last", "behind"], "left")
    # Two words that lost their blank have each other for a neighbour.
    judged = judged.join(inner, ["first", "last"], "left").withColumn("support", F.when(F.col("first") != F.col("last"), F.coalesce("n_inner", F.lit(0))).otherwise(F.coalesce("n_before", F.lit(0)) + F.coalesce("n_behind", F.lit(0))))
    best = judged.groupBy("block_id", "k", "word", "strong", "before", "behind").agg(F.max(F.struct("support", F.col("o.n").alias("n"), F.col("o.shown").alias("shown"))).alias("b"))
    taken = F.col("strong") | (F.col("b.support") > 0) | ((F.col("before") == "") & (F.col("behind") == "") & ~F.col("b.shown").contains(" "))
    made = best.select("block_id", "k", F.when(taken, F.when(F.col("b.shown").contains(" "), "spacing").otherwise("glyph")).alias("kind"), F.when(taken, F.col("b.shown")).otherwise(F.col("word")).alias("shown"))
    made = made.groupBy("block_id").agg(F.collect_list(F.struct("k", "kind", "shown")).alias("made"))
    whole = found.select("block_id", "kinds", "fixed").dropDuplicates(["block_id"]).join(made, "block_id", "left")
    kinds = F.array_sort(F.array_distinct(F.concat("kinds", F.coalesce(F.filter(F.transform("made", lambda m: m["kind"]), lambda x: x.isNotNull()), F.array().cast("array<string>")))))
    fixed = F.when(F.col("made").isNull(), F.col("fixed")).otherwise(F.aggregate("made", F.col("fixed"), lambda text, m: F.replace(text, F.concat(F.lit("\ufdd0"), m["k"].cast("string"), F.lit("\ufdd1")), m["shown"])))
    return whole.select("block_id", kinds.alias("kinds"), fixed.alias("fixed")).where(F.size("kinds") > 0)


def scan_traces(sections: DataFrame, limit: int = 500_000) -> DataFrame:
    """``(block_id, kinds)`` of every block with a trace of scanning: hyphen, glyph, spacing, header.

    Blocks of files without pages have none. Null and blank texts have none, rows with a null block id are left out,
    repeated rows count once; an empty table gives an empty one; further columns are ignored.
    """
    known = cut(frequent_words(cut(word_counts(sections), "word-counts")), "vocabulary")
    blocks = scanned_rows(sections)
    words = word_traces(blocks, sections, known, limit).select("block_id", F.explode("kinds").alias("kind"))
    heads = page_lines(blocks).select("block_id", F.lit("header").alias("kind"))
    return words.unionByName(heads).groupBy("block_id").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))


def _ends_open(col: Column) -> Column:
    return ~col.rlike(r"[.!?:;][\"')\]]*\s*$")


def _prose(col: Column, kind: Column) -> Column:
    """Whether a block that is typed as no part of the running text holds prose: several lower-case words, and a full stop.

    Headers, footers and page numbers are never longer than a line of :func:`page_lines`, nor do they start in lower case.
    """
    words = F.size(F.regexp_extract_all(col, F.lit(r"(?<!\p{L})(\p{Ll}{2,})(?!\p{L})"), F.lit(1))) >= 4
    longer = kind.isin("header", "footer", "page_number") & ((F.length(col) > 100) | col.rlike(r"^\p{Ll}"))
    return words & (col.rlike(r"\.[\"')\]]*\s*$") | longer)


def readable_paragraphs(sections: DataFrame, limit: int = 500_000) -> DataFrame:
    """Continuous paragraphs of scanned files: ``(document_id, paragraph, first_block, n_blocks, text)``.

    Header and page-number lines are dropped, words repaired, lines joined; of blocks typed as title, heading, header,
    footer or page number those are kept whose remaining text is prose; a block that ends without a full stop goes on
    in the next text block of its document, if that starts in lower case, also over a page break. The window runs
    over *chunks* of 2,000 consecutive blocks, so that one long document never is one sorted group; a paragraph across
    two chunks is joined by the chunk's carried-over first piece.
    """
    spark, mark_before = sections.sparkSession, scratch_mark(sections.sparkSession)
    known = cut(frequent_words(cut(word_counts(sections), "word-counts")), "vocabulary")
    dropped = page_lines(scanned_rows(sections)).groupBy("block_id").agg(F.collect_set("line_no").alias("drop"))
    kept = scanned_blocks(sections).join(dropped, "block_id", "left").withColumn("lines", F.split("text", "\n"))
    kept = kept.withColumn("text", F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.expr("array_join(filter(lines, (x, i) -> not array_contains(drop, i)), '\n')"))).drop("lines", "drop")
    kept = cut(kept, "kept-lines")
    fixed = cut(word_traces(kept, sections, known, limit).select("block_id", "fixed"), "fixed-texts")
    drop_made(spark, mark_before, (kept, fixed))  # nothing reads the tables before these any more
    flow = kept.join(fixed, "block_id", "left").withColumn("text", F.coalesce("fixed", "text"))
    plain = ~F.col("type").isin("code", "equation", "table")
    flow = flow.withColumn("text", F.when(plain, F.trim(F.regexp_replace("text", r"\s+", " "))).otherwise(F.col("text"))).where("trim(text) <> ''")
    body = flow.where(plain & (~F.col("type").isin("title", "heading", "header", "footer", "page_number") | _prose(F.col("text"), F.col("type")))).select("document_id", "block_id", "idx", "text")
    # Where paragraphs start follows from two marks a block; the texts stay behind until they are grouped.
    marks = body.select("document_id", "block_id", "idx", F.floor(F.col("idx") / 2000).alias("chunk"), _ends_open(F.col("text")).alias("open"), F.col("text").rlike(r"^\p{Ll}").alias("low"))
    marks = cut(marks, "paragraph-marks")
    order = Window.partitionBy("document_id", "chunk").orderBy("idx", "block_id")
    last = marks.groupBy("document_id", "chunk").agg(F.max_by("open", F.struct("idx", "block_id")).alias("carried")).select("document_id", (F.col("chunk") + 1).alias("chunk"), "carried")
    opened = marks.join(last, ["document_id", "chunk"], "left").withColumn("before", F.coalesce(F.lag("open").over(order), F.when(F.row_number().over(order) == 1, F.col("carried"))))
    marked = opened.withColumn("start", F.when(F.col("before").isNull() | ~(F.col("before") & F.col("low")), F.struct("idx", "block_id")))
    sums = marked.groupBy("document_id", "chunk").agg(F.max("start").alias("latest"))
    earlier = sums.withColumn("carried_start", F.max("latest").over(Window.partitionBy("document_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))).select("document_id", "chunk", "carried_start")
    heads = marked.join(earlier, ["document_id", "chunk"]).withColumn("head", F.coalesce(F.last("start", ignorenulls=True).over(order), F.col("carried_start")))
    named = body.select("block_id", "idx", "text").join(heads.select("block_id", "document_id", "head"), "block_id")
    grouped = named.groupBy("document_id", "head").agg(F.array_sort(F.collect_list(F.struct("idx", "block_id", "text"))).alias("parts"))
    return grouped.select("document_id", F.col("head.idx").alias("paragraph"), F.col("head.block_id").alias("first_block"), F.size("parts").alias("n_blocks"), F.array_join("parts.text", " ").alias("text"))
