"""Search index and hybrid search over blocks: BM25, hashed TF-IDF, and their fusion."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

# Parameters of the ranking.
DIMENSIONS, K1, B, IDF_FLOOR = 512, 1.2, 0.75, 1e-6
LEXICAL_WEIGHT, VECTOR_WEIGHT = 0.45, 0.55
MODES = ("hybrid", "lexical", "vector")
#: Words of the full-text index: runs of letters and digits without diacritics.
_FULL_TEXT = "[a-z0-9]+"


def plain(x: F.Column) -> F.Column:
    """Lower case, Latin letters without their diacritics."""
    return F.translate(F.lower(x), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def full_text_tokens(x: F.Column) -> F.Column:
    return F.regexp_extract_all(plain(x), F.lit(_FULL_TEXT), F.lit(0))


def block_terms(blocks: DataFrame) -> DataFrame:
    """Postings (block_id, term, tf, length) of title, section and text together."""
    whole = F.concat_ws(" ", "title", "section", "text")
    rows = blocks.where(tx.strip("text") != "").select("block_id", full_text_tokens(whole).alias("toks")).withColumn("length", F.size("toks"))
    return rows.select("block_id", "length", F.explode("toks").alias("term")).groupBy("block_id", "term", "length").agg(F.count("*").alias("tf"))


def document_frequency(blocks: DataFrame) -> DataFrame:
    """(token, df): blocks that hold each search token."""
    return blocks.where(tx.strip("text") != "").select("block_id", F.explode(F.array_distinct(tx.tokens("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))


def tfidf_vectors(blocks: DataFrame) -> DataFrame:
    """Sparse unit vectors (block_id, dim, weight): tokens hashed to 512 dimensions, colliding weights added."""
    rows = blocks.where(tx.strip("text") != "").select("block_id", F.explode(tx.tokens("text")).alias("token")).groupBy("block_id", "token").agg(F.count("*").alias("tf"))
    n = blocks.where(tx.strip("text") != "").agg(F.count("*").alias("n_blocks"))
    df = rows.groupBy("token").agg(F.count("*").alias("df")).withColumn("dim", tx.hash_dimension("token", DIMENSIONS))  # hashed once a token
    weighted = rows.join(df, "token").crossJoin(F.broadcast(n))  # one row
    weight = (1 + F.log("tf")) * (F.log((F.col("n_blocks") + 1) / (F.col("df") + 1)) + 1)
    hashed = weighted.groupBy("block_id", "dim").agg(F.sum(weight).alias("w"))
    norm = hashed.groupBy("block_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return hashed.join(norm, "block_id").select("block_id", "dim", (F.col("w") / F.col("norm")).alias("weight"))


def bm25_scores(blocks: DataFrame, query: str) -> DataFrame:
    """(block_id, bm25) of blocks with any query word: k1 1.2, b 0.75, floored inverse frequency.

    The words of the query are known when the plan is built, so that only their occurrences are counted: no posting
    table is shuffled.
    """
    wanted = sorted(set(re.findall(_FULL_TEXT, query.lower())))
    whole = F.concat_ws(" ", "title", "section", "text")
    rows = blocks.where(tx.strip("text") != "").select("block_id", full_text_tokens(whole).alias("toks")).withColumn("length", F.size("toks"))
    counted = rows.select("block_id", "length", *[F.size(F.filter("toks", _equals(w))).alias(f"tf{i}") for i, w in enumerate(wanted)])
    totals = counted.agg(F.count("*").alias("n"), F.avg("length").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"n{i}") for i in range(len(wanted))])
    scored = counted.crossJoin(F.broadcast(totals))  # one row
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.greatest(F.log((F.col("n") - F.col(f"n{i}") + 0.5) / (F.col(f"n{i}") + 0.5)), F.lit(IDF_FLOOR))
        tf = F.col(f"tf{i}")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    hit = F.lit(False)
    for i in range(len(wanted)):
        hit = hit | (F.col(f"tf{i}") > 0)
    return scored.where(hit).select("block_id", score.alias("bm25"))


def _equals(word: str):  # noqa: ANN202
    return lambda t: t == word


def vector_scores(blocks: DataFrame, query: str, vectors: DataFrame | None = None) -> DataFrame:
    """(block_id, cosine) with the query's vector, built with the corpus's document frequencies."""
    spark = blocks.sparkSession
    words = re.findall(tx.SEARCH_TOKEN, query)
    counts: dict[str, int] = {}
    for w in words:
        counts[w.lower()] = counts.get(w.lower(), 0) + 1
    if not counts:
        return blocks.where("false").select("block_id", F.lit(0.0).alias("cosine"))
    q = spark.createDataFrame(sorted(counts.items()), "token string, tf long")
    n = blocks.where(tx.strip("text") != "").agg(F.count("*").alias("n_blocks"))
    # Only the query's words are counted, so that no other token leaves its block.
    asked = F.array(*[F.lit(w) for w in sorted(counts)])
    df = blocks.where(tx.strip("text") != "").select(F.explode(F.array_intersect(tx.tokens("text"), asked)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    weighted = q.join(df, "token", "left").crossJoin(F.broadcast(n))
    weight = (1 + F.log("tf")) * (F.log((F.col("n_blocks") + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)
    hashed = weighted.groupBy(tx.hash_dimension("token", DIMENSIONS).alias("dim")).agg(F.sum(weight).alias("qw"))
    norm = hashed.agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qn"))
    unit = hashed.crossJoin(F.broadcast(norm)).select("dim", (F.col("qw") / F.col("qn")).alias("qw"))
    # The query has at most as many dimensions as words: bounded, so the vectors are filtered by a broadcast.
    return (vectors if vectors is not None else tfidf_vectors(blocks)).join(F.broadcast(unit), "dim").groupBy("block_id").agg(F.sum(F.col("weight") * F.col("qw")).alias("cosine"))


def _rank_scores(blocks: DataFrame, query: str, keep: int) -> DataFrame:
    """(block_id, lexical): one over the BM25 rank of the best ``keep`` blocks."""
    top = bm25_scores(blocks, query).withColumn("bm25", F.round("bm25", 6)).orderBy(F.desc("bm25"), "block_id").limit(keep)
    return top.withColumn("rn", F.row_number().over(Window.orderBy(F.desc("bm25"), "block_id"))).select("block_id", (1.0 / F.col("rn")).alias("lexical"))


def search(blocks: DataFrame, query: str, limit: int = 10, mode: str = "hybrid", vectors: DataFrame | None = None) -> DataFrame:
    """The best ``limit`` blocks: (block_id, lexical, vector, score).

    ``lexical`` is one over the BM25 rank within the best max(20 * limit, 100); hybrid is .45 lexical + .55 vector.
    Scores are rounded to 6 places; ties go to the least block id.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    keep = max(20 * limit, 100)
    none = blocks.where("false")
    if mode == "vector":
        lexical = none.select("block_id", F.lit(0.0).alias("lexical"))
    else:
        lexical = _rank_scores(blocks, query, keep)
    vector = vector_scores(blocks, query, vectors).where("cosine > 0") if mode != "lexical" else none.select("block_id", F.lit(0.0).alias("cosine"))
    both = lexical.join(vector, "block_id", "full").select("block_id", F.coalesce("lexical", F.lit(0.0)).alias("lexical"), F.coalesce("cosine", F.lit(0.0)).alias("vector"))
    score = {"hybrid": LEXICAL_WEIGHT * F.col("lexical") + VECTOR_WEIGHT * F.col("vector"), "lexical": F.col("lexical"), "vector": F.col("vector")}[mode]
    ranked = both.select("block_id", F.round("lexical", 4).alias("lexical"), F.round("vector", 4).alias("vector"), F.round(score, 4).alias("score")).where("score > 0")
    return ranked.orderBy(F.desc("score"), "block_id").limit(limit)


def token_overlap(blocks: DataFrame, query: str) -> DataFrame:
    """(block_id, share) of the distinct query tokens that stand in title and text: the fallback without an index."""
    wanted = sorted({w.lower() for w in re.findall(tx.SEARCH_TOKEN, query)})
    found = F.size(F.array_intersect(F.array(*[F.lit(w) for w in wanted]), F.array_distinct(tx.tokens(F.concat_ws(" ", "title", "text")))))
    return blocks.select("block_id", (found / max(1, len(wanted))).alias("share")).where("share > 0")


def nearest_vectors(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Exact cosine top k of every query vector against all rows: (query_id, vec_id, cosine).

    The stated query set is small against the table; each partition keeps k rows a query before anything is shuffled.
    """
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    table = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), norm(F.col(vec_col)).alias("nv"))
    asked = queries.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("q"), norm(F.col(vec_col)).alias("nq"))
    dot = F.aggregate(F.zip_with("v", "q", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    met = table.join(asked, F.col("vec_id") != F.col("query_id")).withColumn("cosine", F.round(F.when((F.col("nv") > 0) & (F.col("nq") > 0), dot / (F.col("nv") * F.col("nq"))).otherwise(0.0), 4))
    order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    return met.select("query_id", "vec_id", "cosine").withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).drop("rn")
