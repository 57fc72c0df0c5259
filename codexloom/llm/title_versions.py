"""Problem 1: versions of one title, by a grouped prefix join.

1. Titles become ordered sets of word tokens, rarest first, and equal sets one *class*.
2. Classes with an identical prefix and size become one *group* (Bouros et al., "Spatio-textual similarity joins", 2012).
   For Jaccard >= t two sets of sizes a, b share at least ceil(t/(1+t)*(a+b)) tokens, hence at least two tokens of
   their prefixes of length a - ceil(t*a) + 2: groups meet on *pairs* of prefix tokens, which keeps the posting lists of
   common words short.
3. Group pairs are filtered by size, and expanded to their members, whose overlap is counted exactly.
4. Members are verified: small edits of words are undone, and a pair is linked only if both name the same system and
   the same part, phase, volume or year.
5. Linked classes form components; a title that lost its name or its number joins a component only if it fits no other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import bitmap, may_share
from ..operators.components import connected_components
from ..storage import cut

#: Endings and notes that editors and archives add to a title.
NOTES = ("final", "final version", "revised", "preprint", "accepted manuscript", "accepted version", "author version", "erratum included", "corrected", "draft", "camera ready", "a pilot study", "copy", "v1", "v2", "v3")
_NOTE = re.compile(r"(?:[\s:,;\-\[\(_*.]+(?:" + "|".join(re.escape(x).replace(r"\ ", r"[\s_]+") for x in sorted(NOTES, key=len, reverse=True)) + r")[\s\]\)*.]*|[\s*†.…]+)$")
_SUFFIX = re.compile(r"\.(?:pdf|docx|html?|xhtml)\s*$")
_MARK = re.compile(r"\b(part|phase|volume|vol|issue|chapter|series)[\s.\-]*([0-9]+|[ivxl]+)\b")
_YEAR = re.compile(r"\b((?:19|20)[0-9]{2})\b")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50}
#: Shorthand written for words.
SHORT = {"&": " and ", "w/": " with ", " 4 ": " for "}


def _roman(text: str) -> int:
    values = [_ROMAN[ch] for ch in text]
    return sum(-v if any(later > v for later in values[i + 1 :]) else v for i, v in enumerate(values))


def title_parts(title: str | None) -> tuple[list[str], str, bool]:
    """Word tokens of a title, its part/phase/volume/year mark ('' if none), and whether its end was cut off."""
    text = unicodedata.normalize("NFKD", title or "")
    text = "".join(ch for ch in text if not unicodedata.combining(ch)).lower().replace("_", " ")
    text = " ".join(text.split())
    cut_off = bool(re.search(r"(?:…|\.\.\.)", text))
    while True:
        shorter = _NOTE.sub("", _SUFFIX.sub("", text))
        if shorter == text or not shorter:
            break
        text = shorter
    for sign, word in SHORT.items():
        text = text.replace(sign, word)
    mark = ""
    for kind, number in _MARK.findall(re.sub(r"(?<=[ .\-])[il](?=\W|$)", lambda m: m.group(0) if m.group(0) == "i" else "1", text)):
        mark = f"{'volume' if kind == 'vol' else kind} {number if number.isdigit() else _roman(number)}"
    years = _YEAR.findall(text)
    if not mark and years:
        mark = f"year {years[-1]}"
    text = _MARK.sub(" ", text)
    text = _YEAR.sub(" ", text)
    text = re.sub(r"(?<=[a-z])0|0(?=[a-z])", "o", text)
    text = re.sub(r"(?<=[a-z])1|1(?=[a-z])", "l", text)
    text = re.sub(r"(?<=[a-z])5(?=[a-z])", "s", text)
    return re.findall(r"[a-z0-9]+", text.replace("'", "")), mark, cut_off


_PARTS = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("mark", T.StringType()), T.StructField("cut_off", T.BooleanType())])


@F.pandas_udf(_PARTS)
def _title_parts(titles: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([title_parts(x) for x in titles], columns=["tokens", "mark", "cut_off"])


def near(a: str, b: str) -> bool:
    """Whether two words are one word with small edits (at most 2 edits, 1 below six letters; a swap counts as one)."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 2:
        return False
    most = 1 if max(len(a), len(b)) < 6 else 2
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            now.append(cost)
        if min(now) > most:
            return False
        before, row = row, now
    return row[-1] <= most


def compare_titles(a: list[str], b: list[str], rare_a: list[str], rare_b: list[str], mark_a: str, mark_b: str) -> int:
    """2: versions of one title; 1: alike, but one lacks a name or a number that the other has; 0: other titles.

    ``rare_*`` are the tokens that few titles hold: names, and misspelled common words.
    """
    if mark_a and mark_b and mark_a != mark_b:
        return 0
    left, right = _rest(a, b), _rest(b, a)
    for x in list(left):
        hit = next((y for y in right if near(x, y)), None) or next((y for y in right if _glued(x, y)), None)
        if hit is not None:
            left.remove(x)
            right.remove(hit)
    for one, other in ((left, right), (right, left)):  # a word written as two, or two as one
        for x in list(one):
            parts = [y for y in other if len(y) > 1 and y in x]
            if parts and sum(map(len, parts)) >= len(x) - 2:
                one.remove(x)
                for y in parts:
                    other.remove(y)
    names_left, names_right = [x for x in left if x in rare_a and len(x) > 3], [x for x in right if x in rare_b and len(x) > 3]
    if names_left and names_right:
        return 0
    matched = min(len(a) - len(left), len(b) - len(right))
    if matched < 0.5 * max(len(a), len(b)) or len(left) > 0.34 * len(a) and len(right) > 0.34 * len(b) or (left and right and len(left) + len(right) > 5):
        return 0
    return 1 if names_left or names_right or mark_a != mark_b else 2


def _rest(a: list[str], b: list[str]) -> list[str]:
    """What of the bag ``a`` is not in the bag ``b``."""
    spare, out = list(b), []
    for x in a:
        if x in spare:
            spare.remove(x)
        else:
            out.append(x)
    return out


def _glued(x: str, y: str) -> bool:
    """A longer word whose ends are kept, as a cut or a misread one."""
    short, long = sorted((x, y), key=len)
    return len(short) >= 3 and len(short) * 2 >= len(long) and long.startswith(short)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        grade = [compare_titles(list(a), list(b), list(ra), list(rb), ma, mb) for a, b, ra, rb, ma, mb in zip(pdf.words_l, pdf.words_r, pdf.rare_l, pdf.rare_r, pdf.mark_l, pdf.mark_r)]
        yield pd.DataFrame({"l": pdf.l, "r": pdf.r, "grade": grade})[lambda x: x.grade > 0]


def grouped_prefix_join(sets: DataFrame, threshold: float, id_col: str = "id", tokens_col: str = "tokens") -> DataFrame:
    """All pairs ``(l, r, overlap)``, l < r, of rows whose token sets have Jaccard similarity >= threshold.

    ``sets`` holds one row per id. Tokens may repeat or be null (dropped); null and empty sets pair with nothing; two
    sets of one token each pair if equal. Rows with the same prefix and size are joined as one group and expanded only
    after the size filter. Exact: no token, however common, is left out.
    """
    t = float(threshold)
    flat = sets.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(tokens_col)).alias("tok")).where("tok is not null")
    frequency = flat.groupBy("tok").agg(F.count("*").alias("df"))
    ordered = (
        flat.join(frequency, "tok")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("df", F.xxhash64("tok").alias("h")))).alias("o"))
        .select("id", F.col("o.h").alias("toks"), F.size("o").alias("n"))
        .withColumn("prefix", F.expr(f"slice(toks, 1, least(n, n - cast(ceil({t} * n - 1e-9) as int) + 2))"))
    )
    ordered = cut(ordered.withColumn("gid", F.xxhash64("prefix", "n")), "prefix-groups")
    groups = ordered.groupBy("gid").agg(F.first("prefix").alias("prefix"), F.first("n").alias("n"))
    low, high = bitmap(F.col("prefix"))
    groups = groups.withColumns({"low": low, "high": high})
    # A pair must overlap in need(x, y) tokens. Groups meet on the two rarest tokens they share, which stand among the
    # first n - need + 2 of both; sets so small that one shared token may do meet on single tokens as well.
    single = f"if(n <= {1 / t}, transform(prefix, (a, i) -> struct(a as a, a as b, i + 1 as p)), array())"
    keys = F.expr(
        f"concat({single}, if(size(prefix) < 2, array(), flatten(transform(sequence(0, greatest(size(prefix) - 2, 0)), i -> "
        "transform(sequence(i + 1, greatest(size(prefix) - 1, i + 1)), j -> struct(prefix[i] as a, get(prefix, j) as b, j + 1 as p))))))"
    )
    posted = groups.select("gid", "n", "prefix", "low", "high", F.explode(keys).alias("k")).select("gid", "n", "prefix", "low", "high", "k.a", "k.b", "k.p")
    g = posted.alias("x").join(posted.alias("y"), (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b")) & (F.col("x.gid") < F.col("y.gid")))
    g = g.where((F.col("x.n") >= F.ceil(F.col("y.n") * t - 1e-9)) & (F.col("y.n") >= F.ceil(F.col("x.n") * t - 1e-9)))
    need = F.ceil((F.col("x.n") + F.col("y.n")) * (t / (1 + t)) - 1e-9)
    on_one = F.col("x.a") == F.col("x.b")
    g = g.where((F.col("x.p") <= F.col("x.n") - need + 2) & (F.col("y.p") <= F.col("y.n") - need + 2) & (on_one == (need == 1)))
    # Prefix and rest must be able to hold the overlap, by their bitmaps first.
    rest = F.greatest(F.col("x.n") - F.size("x.prefix"), F.col("y.n") - F.size("y.prefix"))
    g = g.where(may_share((F.col("x.low"), F.col("x.high")), F.size("x.prefix"), (F.col("y.low"), F.col("y.high")), F.size("y.prefix"), need - rest))
    shared = F.array_intersect("x.prefix", "y.prefix")  # rarest first, as both prefixes are
    # Each group pair once, at the rarest tokens it shares.
    first = (shared[0] == F.col("x.a")) & (on_one | (F.get(shared, F.lit(1)) == F.col("x.b")))
    g = g.where(first & (F.size(shared) + rest >= need))
    pairs = g.select(F.col("x.gid").alias("gl"), F.col("y.gid").alias("gr")).unionByName(groups.select(F.col("gid").alias("gl"), F.col("gid").alias("gr")))
    members = ordered.select("gid", "id", "n", "toks")
    met = (
        pairs.join(members.select(F.col("gid").alias("gl"), F.col("id").alias("il"), F.col("n").alias("nl"), F.col("toks").alias("tl")), "gl")
        .join(members.select(F.col("gid").alias("gr"), F.col("id").alias("ir"), F.col("n").alias("nr"), F.col("toks").alias("tr")), "gr")
        .where("gl <> gr or il < ir")
        .withColumn("overlap", F.size(F.array_intersect("tl", "tr")))
        .where(F.col("overlap") >= F.ceil((F.col("nl") + F.col("nr")) * (t / (1 + t)) - 1e-9))
    )
    return met.select(F.least("il", "ir").alias("l"), F.greatest("il", "ir").alias("r"), "overlap")


def title_versions(files: DataFrame, id_col: str = "document_id", title_col: str = "title", threshold: float = 0.5, rare: float = 0.002, rare_least: int = 12) -> DataFrame:
    """One row per file with the class of its title: ``(document_id, title_class, title_group, links)``.

    ``title_class`` unites titles with the same normalised words and mark, ``title_group`` all versions of one title
    (the least class id of the component), ``links`` counts the classes a class is linked to. A token that at most
    max(rare_least, rare * classes) classes hold counts as rare, i.e. as a name rather than a word of the language.
    Files with a null or blank title, or a null id, are left out; repeated rows count once; other columns are ignored.
    """
    rows = files.select(F.col(id_col).alias("document_id"), F.col(title_col).alias("title")).where("document_id is not null and title is not null").distinct()
    # Normalise each distinct spelling once: copies of a title are met before any Python runs.
    spelled = rows.select("title").distinct().withColumn("p", _title_parts("title")).select("title", F.col("p.tokens").alias("words"), F.col("p.mark").alias("mark")).where("size(words) > 0")
    spelled = spelled.withColumn("title_class", F.xxhash64(F.array_sort("words"), "mark"))
    labelled = cut(rows.join(spelled, "title").select("document_id", "title_class", "words", "mark"), "titles")
    classes = labelled.groupBy("title_class").agg(F.min("words").alias("words"), F.min("mark").alias("mark"))
    sets = classes.select(F.col("title_class").alias("id"), F.col("words").alias("tokens"))
    frequency = sets.select("id", F.explode(F.array_distinct("tokens")).alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))
    total = F.broadcast(sets.agg(F.count("*").alias("n_classes")))  # one row
    names = frequency.crossJoin(total).where(F.col("df") <= F.greatest(F.lit(rare_least), F.col("n_classes") * rare)).select("tok")
    rare_of = (
        sets.select("id", F.explode(F.array_distinct("tokens")).alias("tok")).join(names, "tok").groupBy("id").agg(F.collect_list("tok").alias("rare"))
    )
    full = cut(classes.withColumnRenamed("title_class", "id").join(rare_of, "id", "left").withColumn("rare", F.coalesce("rare", F.array().cast("array<string>"))), "title-classes")
    met = grouped_prefix_join(full.select("id", F.col("words").alias("tokens")), threshold)
    side = lambda s: full.select(F.col("id").alias(s), F.col("words").alias(f"words_{s}"), F.col("rare").alias(f"rare_{s}"), F.col("mark").alias(f"mark_{s}"))
    graded = cut(met.join(side("l"), "l").join(side("r"), "r").mapInPandas(_verify, "l long, r long, grade int"), "title-links")
    strong = connected_components(graded.where("grade = 2"), "l", "r")
    home = cut(full.select("id").join(strong.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("component")), "title-homes")
    # Weak links: a component that lacks a name or number joins the one other component that it fits, if just one.
    weak = graded.where("grade = 1").select("l", "r").join(home.select(F.col("id").alias("l"), F.col("component").alias("cl")), "l").join(home.select(F.col("id").alias("r"), F.col("component").alias("cr")), "r").where("cl <> cr")
    weak = weak.join(full.select(F.col("id").alias("l"), F.expr("size(rare) + if(mark = '', 0, 1)").alias("kl")), "l").join(full.select(F.col("id").alias("r"), F.expr("size(rare) + if(mark = '', 0, 1)").alias("kr")), "r")
    poor = weak.select(F.when(F.col("kl") <= F.col("kr"), F.col("cl")).otherwise(F.col("cr")).alias("node"), F.when(F.col("kl") <= F.col("kr"), F.col("cr")).otherwise(F.col("cl")).alias("into")).distinct()
    joined = poor.groupBy("node").agg(F.min("into").alias("into"), F.count("*").alias("k")).where("k = 1").select("node", "into")
    whole = connected_components(joined, "node", "into").withColumnRenamed("component", "merged").withColumnRenamed("node", "component")
    degree = graded.select(F.explode(F.array("l", "r")).alias("title_class")).groupBy("title_class").agg(F.count("*").alias("links"))
    grouped = home.join(whole, "component", "left").select(F.col("id").alias("title_class"), F.coalesce("merged", "component").alias("title_group"))
    return (
        labelled.select("document_id", "title_class").distinct().join(grouped, "title_class").join(degree, "title_class", "left")
        .select("document_id", "title_class", "title_group", F.coalesce("links", F.lit(0)).alias("links"))
    )


def version_pairs(groups: DataFrame) -> DataFrame:
    """``(left_document_id, right_document_id)``, smaller id first: all pairs of files whose titles are versions of one."""
    a = groups.select("title_group", F.col("document_id").alias("left_document_id"))
    b = groups.select("title_group", F.col("document_id").alias("right_document_id"))
    return a.join(b, "title_group").where("left_document_id < right_document_id").select("left_document_id", "right_document_id").distinct()

