"""Problem 4: one surviving record per group, by a latent two-sided quality model.

Each source (here: the kind of file that a record was read from) states values of fields. A value is true or false,
unseen; a source has a *sensitivity* (how often it states a true value) and a *specificity* (how often it does not
state a false one), inferred with the truths by expectation-maximisation (Zhao et al., "A Bayesian approach to
discovering truth from conflicting sources", 2012). Several values of one field may be true, so a multi-valued field
keeps every value judged true. The surviving *file* is found alike: that a file is the best of its work is the value,
and kind, completeness and date are the sources that state it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut

#: Words that stand in for a missing value.
STAND_INS = ("", "-", "--", "?", "n/a", "na", "n.a.", "nan", "nil", "no author", "no authors", "none", "not available", "null", "tba", "tbd", "unknown", "unknown author", "anonymous", "undefined", "various", "xxx", "[]")
FIELDS = ("authors", "year", "doi", "arxiv_id")
RANK = {"pdf": 0, "docx": 1, "html": 2}


def real_text(col: Column) -> Column:
    """Trimmed, null if blank or a stand-in."""
    bare = F.trim(F.regexp_replace(col, r"[\s\u00a0]+", " "))
    return F.when(~F.lower(bare).isin(*STAND_INS), bare)


def kind_of_file(fmt: Column, path: Column) -> Column:
    """pdf, docx or html from a freely spelled format, else from the suffix of the path; null if neither tells."""

    def read(x: Column) -> Column:
        x = F.lower(F.trim(x))
        return F.when(x.rlike(r"pdf$"), "pdf").when(x.rlike(r"docx$|wordprocessingml|msword"), "docx").when(x.rlike(r"x?html?$|html\+xml"), "html")

    return F.coalesce(read(fmt), read(F.regexp_extract(path, r"\.[A-Za-z]+\s*$", 0)))


def _name_key(name: Column) -> Column:
    """Surname and first initial of 'A. Name' or 'Name, A', in lower case."""
    bare = F.lower(F.trim(F.regexp_replace(name, r"[\s.]+", " ")))
    comma = F.concat_ws(" ", F.trim(F.substring_index(bare, ",", -1)), F.trim(F.substring_index(bare, ",", 1)))
    ordered = F.when(bare.contains(","), comma).otherwise(bare)
    return F.concat_ws(" ", F.regexp_extract(ordered, r"([^ ]+)$", 1), F.substring(ordered, 1, 1))


def prepared(files: DataFrame) -> DataFrame:
    """Per file the normalised fields: (work_id, document_id, kind, rank, readable, created_at, title, f.<field> arrays, filled)."""
    authors = F.filter(F.transform("authors", real_text), lambda x: x.isNotNull() & x.rlike(r"\p{L}{2}"))
    doi = F.regexp_extract(F.lower(real_text(F.col("doi"))), r"10\.[0-9]{3,}/\S+", 0)
    arxiv = F.regexp_replace(F.lower(real_text(F.col("arxiv_id"))), r"^arxiv:\s*|v[0-9]+$", "")
    year = F.when(F.col("year").between(1500, 2200), F.col("year").cast("string"))
    one = lambda c: F.when(c.isNotNull() & (c != ""), F.array(c)).otherwise(F.array().cast("array<string>"))
    kind = kind_of_file(F.col("format"), F.col("canonical_path"))
    out = files.select(
        "work_id", "document_id", kind.alias("kind"), "created_at", "title",
        (F.coalesce(F.col("extractable"), F.lit(True)) & ~(F.coalesce(F.lower(F.trim("preflight.status")), F.lit("")) == "failed")).alias("readable"),
        F.coalesce(authors, F.array().cast("array<string>")).alias("authors"), one(year).alias("year"), one(doi).alias("doi"), one(arxiv).alias("arxiv_id"),
    )
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in RANK.items()], F.lit(len(RANK)))
    return out.withColumn("rank", rank).withColumn("filled", sum(((F.size(f) > 0).cast("int") for f in FIELDS), F.lit(0)))


def _claims(files: DataFrame) -> DataFrame:
    """(work_id, field, key, value, source): what each file states."""
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("vals")) for f in FIELDS])
    flat = files.select("work_id", "document_id", F.concat_ws("/", F.coalesce("kind", F.lit("other")), F.when(F.col("readable"), "readable").otherwise("unreadable")).alias("source"), F.explode(parts).alias("p"))
    flat = flat.select("work_id", "document_id", "source", "p.field", F.explode("p.vals").alias("value"))
    return flat.withColumn("key", F.when(F.col("field") == "authors", _name_key(F.col("value"))).otherwise(F.col("value"))).where("key <> ''")


def judged_values(files: DataFrame, rounds: int = 12) -> tuple[DataFrame, DataFrame]:
    """Posterior truth of every stated value, and the quality of every source.

    ``files`` is the result of :func:`prepared`. Returns (work_id, field, key, value, truth) and (field, source,
    sensitivity, specificity). Of a field with one value (all but ``authors``) the values of a work exclude one another,
    those of a field with several are true or false each by itself. Values with the same evidence are one *pattern*,
    works with the same patterns one *case*: each round of the EM runs over the cases, whose number depends on how many
    files state a value and not on the number of works. A case is the sum of its patterns' hashes, so that no work is
    gathered in one row.
    """
    claims = cut(_claims(files), "claims")
    covers = claims.select("work_id", "field", "source", "document_id").distinct().groupBy("work_id", "field", "source").agg(F.count("*").alias("n"))
    said = claims.groupBy("work_id", "field", "key", "source").agg(F.countDistinct("document_id").alias("pos"))
    shown = claims.groupBy("work_id", "field", "key").agg(F.max("value").alias("value"))
    facts = shown.join(covers, ["work_id", "field"]).join(said, ["work_id", "field", "key", "source"], "left")
    facts = facts.groupBy("work_id", "field", "key", "value").agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("pos", F.lit(0)).alias("pos"), (F.col("n") - F.coalesce("pos", F.lit(0))).alias("neg")))).alias("evidence"))
    facts = cut(facts.withColumn("pattern", F.xxhash64("field", "evidence")), "facts")
    cases = facts.groupBy("work_id", "field").agg(F.sum(F.xxhash64("pattern", F.lit(1)).cast("decimal(38,0)")).alias("case"))
    facts = cut(facts.join(cases, ["work_id", "field"]), "cased-facts")
    single = F.col("field") != "authors"
    # Rows of a pattern in a case: how many values of one work, and of all.
    members = facts.groupBy("case", "field", "pattern", "work_id").agg(F.count("*").alias("m")).groupBy("case", "field", "pattern").agg(F.sum("m").alias("w"), F.max("m").alias("m"))
    members = cut(members, "cases")
    votes = cut(facts.groupBy("pattern", "field").agg(F.min("evidence").alias("evidence")).select("pattern", "field", F.inline("evidence")), "patterns")
    # Start: a value is as likely true as its share of the files that state the field.
    start = votes.groupBy("pattern").agg((F.sum("pos") / F.sum(F.col("pos") + F.col("neg"))).alias("p"))
    belief = members.join(start, "pattern").select("case", "field", "pattern", "w", "m", "p")
    quality = None
    for _ in range(rounds):
        # M: rates per source, with one pseudo-observation of 0.8 sensitivity and 0.9 specificity a source.
        mass = belief.groupBy("pattern").agg(F.sum(F.expr("w * p")).alias("yes"), F.sum(F.expr("w * (1 - p)")).alias("no"))
        quality = votes.join(mass, "pattern").groupBy("field", "source").agg(
            ((F.sum(F.expr("yes * pos")) + 8.0) / (F.sum(F.expr("yes * (pos + neg)")) + 10.0)).alias("sensitivity"),
            ((F.sum(F.expr("no * neg")) + 9.0) / (F.sum(F.expr("no * (pos + neg)")) + 10.0)).alias("specificity"),
        )
        prior = belief.groupBy("field").agg(((F.sum(F.expr("w * p")) + 1.0) / (F.sum("w") + 2.0)).alias("prior"))
        # E: posterior odds per pattern; where values exclude one another, shares of the case.
        odds = votes.join(quality, ["field", "source"]).groupBy("pattern").agg(F.sum(F.expr("pos * ln(sensitivity / (1 - specificity)) + neg * ln((1 - sensitivity) / specificity)")).alias("z"))
        scored = belief.drop("p").join(odds, "pattern").join(prior, "field").withColumn("o", F.exp(F.least(F.greatest(F.expr("ln(prior / (1 - prior)) + z"), F.lit(-30.0)), F.lit(30.0))))
        total = scored.groupBy("case", "field").agg(F.sum(F.expr("m * o")).alias("total"))
        belief = cut(scored.join(total, ["case", "field"]).select("case", "field", "pattern", "w", "m", F.when(single, F.col("o") / F.col("total")).otherwise(F.col("o") / (1 + F.col("o"))).alias("p")), "belief")
    truth = facts.join(belief, ["case", "field", "pattern"]).select("work_id", "field", "key", "value", F.round("p", 6).alias("truth"))
    return truth, quality


#: What speaks for a file as the survivor of its work; each is a source of the model.
CRITERIA = ("kind", "filled", "recent")


def _voted(files: DataFrame) -> DataFrame:
    """Readable files with a vote of each criterion: whether no file of the work is ahead of it in this."""
    made = F.coalesce(F.unix_micros(F.col("created_at").cast("timestamp")), F.lit(-(2**62)))
    rows = files.where("readable").withColumn("made", made)
    best = rows.groupBy("work_id").agg(F.min("rank").alias("b_rank"), F.max("filled").alias("b_filled"), F.max("made").alias("b_made"))
    return rows.join(best, "work_id").withColumns({"v_kind": F.col("rank") == F.col("b_rank"), "v_filled": F.col("filled") == F.col("b_filled"), "v_recent": F.col("made") == F.col("b_made")}).drop("b_rank", "b_filled", "b_made")


def criterion_quality(patterns: list[tuple[tuple[bool, ...], int]], rounds: int = 100) -> tuple[list[tuple[float, float]], float]:
    """([(sensitivity, specificity) of each criterion], prior) by EM over (votes, files) patterns, at most 2 ** criteria.

    A file is the survivor or not, unseen; a criterion votes for a survivor with its sensitivity, and for no other file
    with its specificity. It never speaks against a file: its sensitivity is at least its rate of false votes.
    """
    votes = np.array([v for v, _ in patterns], dtype=float).reshape(len(patterns), len(CRITERIA))
    weight = np.array([n for _, n in patterns], dtype=float)
    belief = votes.mean(axis=1) if len(votes) else np.zeros(0)
    sens, spec, prior = np.full(len(CRITERIA), 0.8), np.full(len(CRITERIA), 0.9), 0.5
    for _ in range(rounds if len(votes) else 0):
        yes, no = weight * belief, weight * (1 - belief)
        sens, spec = (yes @ votes + 8.0) / (yes.sum() + 10.0), (no @ (1 - votes) + 9.0) / (no.sum() + 10.0)
        sens, prior = np.maximum(sens, 1 - spec), (yes.sum() + 1.0) / (weight.sum() + 2.0)
        z = np.log(prior / (1 - prior)) + votes @ np.log(sens / (1 - spec)) + (1 - votes) @ np.log((1 - sens) / spec)
        after = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(after - belief).max() < 1e-9
        belief = after
        if done:
            break
    return list(zip(sens.tolist(), spec.tolist())), float(prior)


def surviving_files(files: DataFrame) -> DataFrame:
    """(work_id, document_id, n_files, belief, title): the best readable file of each work with two or more files.

    ``files`` is the result of :func:`prepared`, one row per file. The two-sided model believes most in the file for
    which the best criteria vote; a file that is nowhere behind another one has all votes and is never passed over.
    Equal beliefs are settled by kind (pdf, docx, html, other), number of filled fields, latest ``created_at``, least id.
    Only the counts of the vote patterns, at most eight, reach the driver.
    """
    sizes = files.groupBy("work_id").agg(F.count("*").alias("n_files"), F.max("readable").alias("any")).where("n_files >= 2 and any").select("work_id", "n_files")
    voted = _voted(files.join(sizes, "work_id"))
    names = [f"v_{c}" for c in CRITERIA]
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).count().collect())
    quality, prior = criterion_quality(patterns)
    z = F.lit(math.log(prior / (1 - prior)))
    for name, (sens, spec) in zip(names, quality):
        z = z + F.when(F.col(name), math.log(sens / (1 - spec))).otherwise(math.log((1 - sens) / spec))
    scored = voted.withColumn("belief", F.round(1 / (1 + F.exp(-z)), 9))
    order = F.struct(-F.col("belief"), "rank", -F.col("filled"), -F.col("made"), "document_id")
    best = scored.groupBy("work_id", "n_files").agg(F.min_by(F.struct("document_id", "belief", "title"), order).alias("b"))
    return best.select("work_id", "b.document_id", "n_files", "b.belief", "b.title")


def ready_files(files: DataFrame) -> DataFrame:
    """:func:`prepared` of current rows, one row per file; null works and documents left out."""
    return prepared(files.where("work_id is not null and document_id is not null")).dropDuplicates(["work_id", "document_id"])


def survivors(files: DataFrame, rounds: int = 12) -> DataFrame:
    """One surviving record per work with two or more files of which one is readable.

    ``files`` holds current rows of the manifest. The surviving *file* is that of :func:`surviving_files`, the surviving
    *record* takes each field from the values that all files of the work state, as :func:`judged_values` judges them:
    ``authors`` keeps every name judged true, the others the likeliest value, null if nobody states one.
    Columns: work_id, document_id, n_files, belief, title, authors, year, doi, arxiv_id, year_truth.
    Rows with a null work or document id are left out, repeated rows count once, an empty table gives an empty one,
    null arrays and stand-ins state nothing; other columns are ignored.
    """
    ready = cut(ready_files(files), "files")
    best = cut(surviving_files(ready), "surviving-files")
    truth, _ = judged_values(ready.join(best.select("work_id"), "work_id", "left_semi"), rounds)
    likeliest = lambda f: F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.struct("truth", "value"))).alias(f)
    built = truth.groupBy("work_id").agg(
        F.array_sort(F.collect_set(F.when((F.col("field") == "authors") & (F.col("truth") >= 0.5), F.col("value")))).alias("authors"),
        likeliest("year"), likeliest("doi"), likeliest("arxiv_id"), F.max(F.when(F.col("field") == "year", F.col("truth"))).alias("year_truth"),
    )
    return best.join(built, "work_id", "left").select("work_id", "document_id", "n_files", "belief", "title", "authors", F.col("year").cast("int").alias("year"), "doi", "arxiv_id", "year_truth")
