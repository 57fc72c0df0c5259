"""Column functions for titles, headings, identifiers and tokens. All run in compiled code.

Case folding is ``lower`` with sharp s written out, the one letter whose folding differs in European titles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants that decide results.
FORMATS = {"pdf": 0, "docx": 1, "html": 2}
BAD_TITLE_WORDS = ("microsoft word", "untitled", "download", "index")
EDITION_WORDS = ("preprint", "accepted manuscript", "author manuscript", "final", "revised")
PREPRINT_PREFIXES = ("10.21203/", "10.1101/", "10.48550/", "10.20944/", "10.31219/", "10.26434/", "10.36227/", "10.22541/", "10.2139/")
PREPRINT_MARKS = ("arxiv", "preprint", "/rs.")
#: Section roles and what their headings contain, in the order in which they are tried.
SECTION_ROLES = (
    ("abstract", r"\babstract\b"),
    ("introduction", r"\bintroduction\b|\bbackground\b"),
    ("related_work", r"related work|literature review|prior work"),
    ("methodology", r"\bmethod(ology|s)?\b|proposed (method|approach|framework)|model architecture|network architecture|our approach"),
    ("datasets", r"\bdatasets?\b|data collection|data description"),
    ("experiments", r"\bexperiments?\b|experimental setup|implementation details|evaluation setup|training details"),
    ("results", r"\bresults?\b|quantitative|qualitative|comparison|ablation"),
    ("discussion", r"\bdiscussion\b|analysis"),
    ("limitations", r"\blimitations?\b|failure cases?"),
    ("conclusion", r"\bconclusions?\b|summary and future|future work"),
    ("appendix", r"\bappendix\b|supplementary"),
    ("references", r"\breferences\b|bibliography"),
)
SEARCH_TOKEN = r"[A-Za-z0-9][A-Za-z0-9_.+-]{1,}"
RELATED_TOKEN = r"[A-Za-z][A-Za-z0-9_+-]{2,}"
RELATED_STOPWORDS = ("the", "and", "for", "with", "from", "that", "this", "using", "method", "paper", "based")


def text_or_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def fold(x: Column | str) -> Column:
    """Case folding."""
    return F.replace(F.lower(text_or_column(x)), F.lit("ß"), F.lit("ss"))


def spaces(x: Column | str) -> Column:
    """White space, no-break spaces included, as single blanks."""
    return F.regexp_replace(text_or_column(x), r"[\s\u00a0]+", " ")


def strip(x: Column | str) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(text_or_column(x), r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def clean_title(x: Column | str) -> Column:
    """Blanks squeezed, outer blanks and punctuation off, at most 300 characters."""
    return F.left(F.regexp_replace(spaces(x), r"^[ .,:;|_-]+|[ .,:;|_-]+$", ""), F.lit(300))


def valid_title(x: Column | str) -> Column:
    """Whether a candidate may be a title: 8 to 300 characters, 8 letters, no banned words, no address."""
    col = text_or_column(x)
    low = F.lower(col)
    banned = F.lit(False)
    for word in BAD_TITLE_WORDS:
        banned = banned | low.contains(word)
    return F.coalesce(F.length(col).between(8, 300) & (F.regexp_count(col, F.lit("[A-Za-z]")) >= 8) & ~banned & ~low.rlike("^https?://"), F.lit(False))


def slug(x: Column | str, most: int = 180) -> Column:
    """A name that any file system takes."""
    kept = F.regexp_replace(F.replace(text_or_column(x), F.lit("&"), F.lit(" and ")), "[^A-Za-z0-9._ -]+", "")
    joined = F.regexp_replace(F.regexp_replace(F.trim(kept), r"\s+", "_"), r"^[._-]+|[._-]+$", "")
    return F.coalesce(F.nullif(F.left(F.regexp_replace(joined, "_+", "_"), F.lit(most)), F.lit("")), F.lit("document"))


def title_key(x: Column | str) -> Column:
    """Key for equal titles: folded, without edition words and subtitle, letters and digits only."""
    low = F.regexp_replace(fold(x), r"\b(" + "|".join(EDITION_WORDS) + r")\b", " ")
    return F.regexp_replace(F.regexp_replace(low, r"(?s)\s*[:—–]\s+.*$", ""), "[^a-z0-9]+", "")


def surnames(authors: Column | str) -> Column:
    """Distinct folded surnames of an author list: the last word of letters in each name."""
    tails = F.transform(F.coalesce(text_or_column(authors), F.array().cast("array<string>")), lambda a: F.regexp_replace(a, r"(?i)\b(et\s+al\.?|and)\b.*$", ""))
    names = F.flatten(F.transform(F.filter(tails, lambda a: a.isNotNull()), lambda a: F.split(a, "[,;•\n\r\u2c00-\u2c5f\ufeff]+")))
    words = F.transform(names, lambda n: F.filter(F.split(F.trim(F.regexp_replace(n, "[\u4e00-\u9fff]+", " ")), r"\s+"), lambda w: (F.length(w) >= 2) & w.rlike(r"^\p{L}+$")))
    return F.array_sort(F.array_distinct(F.transform(F.filter(words, lambda w: F.size(w) > 0), lambda w: fold(F.element_at(w, -1)))))


def split_authors(x: Column | str) -> Column:
    """Names in one line, in order, without repeats; 2 to 100 characters."""
    parts = F.transform(F.split(text_or_column(x), r"[,;]|\band\b"), clean_title)
    return F.array_distinct(F.filter(parts, lambda p: F.length(p).between(2, 100)))


def is_preprint_doi(x: Column | str) -> Column:
    """Whether a DOI is one of a preprint server."""
    doi = F.trim(fold(x))
    hit = F.lit(False)
    for prefix in PREPRINT_PREFIXES:
        hit = hit | doi.startswith(prefix)
    for mark in PREPRINT_MARKS:
        hit = hit | doi.contains(mark)
    return F.coalesce(hit, F.lit(False))


def year_from_name(x: Column | str) -> Column:
    """The last delimited year 1950 to 2030 in a file name."""
    year = F.try_element_at(F.regexp_extract_all(text_or_column(x), F.lit(r"(?:^|[\s_\-(\[])((?:19|20)[0-9]{2})(?:[\s_\-)\]]|$)"), F.lit(1)), F.lit(-1))
    number = F.try_to_number(year, F.lit("9999")).cast("int")
    return F.when(number.between(1950, 2030), number)


def find_doi(x: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text_or_column(x), r"(?i)\b10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+", 0), r"[.,;)</]+$", ""), F.lit(""))


def find_arxiv(x: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text_or_column(x), r"(?i)\barXiv:\s*([A-Za-z0-9_.\-/]+)", 1), r"[.,;)</]+$", ""), F.lit(""))


def normal_doi(x: Column | str) -> Column:
    """DOI without its resolver or prefix, folded; null if blank."""
    return F.nullif(F.regexp_replace(F.trim(fold(x)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", ""), F.lit(""))


def normal_arxiv(x: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.trim(fold(x)), r"^(https?://arxiv\.org/(abs|pdf)/|arxiv:\s*)", ""), F.lit(""))


def file_format(x: Column | str) -> Column:
    """pdf, docx or html by suffix; null for anything else."""
    suffix = F.lower(F.regexp_extract(text_or_column(x), r"\.([A-Za-z]+)$", 1))
    return F.when(suffix == "htm", "html").when(suffix.isin(*FORMATS), suffix)


def document_id(sha256: Column | str) -> Column:
    return F.concat(F.lit("doc_"), F.left(text_or_column(sha256), F.lit(16)))


def work_id(doi: Column, arxiv: Column, title: Column) -> Column:
    """Identity by DOI, else arXiv number, else title key."""
    identity = F.coalesce(F.concat(F.lit("doi:"), normal_doi(doi)), F.concat(F.lit("arxiv:"), normal_arxiv(arxiv)), F.concat(F.lit("title:"), title_key(title)))
    return F.concat(F.lit("work_"), F.left(F.sha2(identity, 256), F.lit(16)))


def block_id(document: Column, position: Column, kind: Column, text: Column) -> Column:
    payload = F.concat_ws("\0", document, position.cast("string"), kind, text)
    return F.concat(F.lit("blk_"), F.left(F.sha2(payload, 256), F.lit(20)))


def clean_heading(x: Column | str) -> Column:
    """Heading without its leading number."""
    return strip(spaces(F.regexp_replace(text_or_column(x), r"(?i)^\s*([IVXLC]+|[0-9]+(\.[0-9]+)*)[.)\s:-]+", "")))


def heading_role(x: Column | str) -> Column:
    """Role of a heading: the first of :data:`SECTION_ROLES` that it contains, else ``unknown``."""
    heading = F.lower(clean_heading(x))
    role = None
    for name, pattern in SECTION_ROLES:
        role = F.when(heading.rlike(pattern), name) if role is None else role.when(heading.rlike(pattern), name)
    return role.otherwise("unknown")


def tokens(x: Column | str, pattern: str = SEARCH_TOKEN) -> Column:
    return F.regexp_extract_all(F.lower(text_or_column(x)), F.lit(pattern.replace("A-Z", "")), F.lit(0))


def related_tokens(x: Column | str) -> Column:
    return F.filter(tokens(x, RELATED_TOKEN), lambda t: ~t.isin(*RELATED_STOPWORDS))


def term_present(text: Column | str, term: Column | str) -> Column:
    """Whether a term stands in a text as whole tokens, whatever its letter case."""
    quoted = F.regexp_replace(text_or_column(term), r"([\\.\[\]{}()*+?^$|&~#-])", r"\\$1")
    return F.regexp_like(text_or_column(text), F.concat(F.lit("(?i)(?<![A-Za-z0-9])"), quoted, F.lit("(?![A-Za-z0-9])")))


def display_name(label: Column | str) -> Column:
    """Readable name of a dotted label."""
    return F.initcap(F.replace(F.element_at(F.split(text_or_column(label), r"\."), -1), F.lit("_"), F.lit(" ")))


def section_name(path: Column | str) -> Column:
    return F.array_join(text_or_column(path), " > ")


def locator(document: Column, block: Column, page: Column) -> Column:
    """``document:block:pN`` with pages from 1, ``?`` where unknown."""
    return F.concat_ws(":", document, block, F.concat(F.lit("p"), F.coalesce((page + 1).cast("string"), F.lit("?"))))


def hash_dimension(token: Column | str, dimensions: int = 512) -> Column:
    return F.pmod(F.conv(F.left(F.sha2(text_or_column(token), 256), F.lit(8)), 16, 10).cast("long"), F.lit(dimensions)).cast("int")
