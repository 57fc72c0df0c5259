"""Citation graph, related works and knowledge graph."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx
from ..storage import cut
from .works import alike_keys

# Weights and limits of the related-work score.
WEIGHTS = {"facet": 0.25, "dataset": 0.20, "text": 0.35, "reference": 0.20}
RELATED_THRESHOLD, RELATED_PER_WORK, TEXT_ALONE, COUPLING_ALONE = 0.16, 5, 0.55, 0.2
CITATION_RATIO, CONTAINED_LENGTH, SHORT_KEY = 0.85, 12, 8


def citation_edges(refs: DataFrame, works: DataFrame, ratio: float = CITATION_RATIO, rows_per_cell: int = 2_000) -> DataFrame:
    """Best work per reference: (source_work_id, ref_index, target_work_id, status, confidence).

    ``refs``: work_id, ref_index, raw, title, doi, arxiv_id; ``works``: work_id, title, doi, arxiv_id. An equal
    identifier is verified and beats everything; only references without one go through titles, which count if the
    ratio is at least ``ratio`` or the work's key (>= 12 characters) is part of the raw line's key; ties go to the least
    work id. Distinct titles of a similar length meet in cells and pass bounds before the ratio is computed
    (:func:`works.alike_keys`); contained titles meet on their first 12 characters, an equal join on the windows of the reference's key.
    """
    keyed = refs.select(F.col("work_id").alias("source_work_id"), "ref_index", tx.fold("doi").alias("doi"), tx.fold("arxiv_id").alias("arxiv"), tx.title_key(F.coalesce("title", "raw")).alias("key"), tx.title_key("raw").alias("raw_key"))
    keyed = cut(keyed.where((F.length("key") >= SHORT_KEY) | F.col("doi").isNotNull() | F.col("arxiv").isNotNull()), "reference-keys")
    target = works.select("work_id", tx.title_key("title").alias("tkey"), tx.fold("doi").alias("tdoi"), tx.fold("arxiv_id").alias("tarxiv"))
    by_doi = keyed.join(target.where("tdoi is not null"), F.col("doi") == F.col("tdoi"))
    by_arxiv = keyed.join(target.where("tarxiv is not null"), F.col("arxiv") == F.col("tarxiv"))
    cols = ("source_work_id", "ref_index", "work_id")
    verified = cut(by_doi.select(*cols).unionByName(by_arxiv.select(*cols)).where("source_work_id <> work_id").groupBy("source_work_id", "ref_index").agg(F.min("work_id").alias("work_id")).withColumn("score", F.lit(2.0)), "verified")
    rest = cut(keyed.join(verified, ["source_work_id", "ref_index"], "left_anti").where(F.length("key") >= SHORT_KEY).select("source_work_id", "ref_index", "key", "raw_key"), "references-left")
    titled = target.where("tkey <> ''").select("work_id", "tkey")
    # References to one title are one key, and titles of several works one; pairs of keys are compared once.
    met = alike_keys(rest.select(F.col("key").alias("a")).distinct(), titled.select(F.col("tkey").alias("b")).distinct(), ratio, rows_per_cell)
    scored = cut(met.withColumn("score", sim.ratio_at_least(ratio)("a", "b")).where("score > 0"), "alike-titles")
    alike = rest.join(scored.withColumnRenamed("a", "key"), "key").join(titled.withColumnRenamed("tkey", "b"), "b").where("source_work_id <> work_id").select(*cols, "score")
    long_titles = titled.where(F.length("tkey") >= CONTAINED_LENGTH).withColumn("head", F.left("tkey", F.lit(CONTAINED_LENGTH)))
    windows = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("raw_key") - CONTAINED_LENGTH + 1)), lambda p: F.substr(F.col("raw_key"), p, F.lit(CONTAINED_LENGTH))))
    # Lines of one key are one line here, too.
    lines = rest.select("key", "raw_key").distinct()
    inside = lines.select("key", "raw_key", F.explode(windows).alias("head")).join(long_titles.select("head", "tkey").distinct(), "head").where(F.col("raw_key").contains(F.col("tkey"))).select("key", "raw_key", "tkey").distinct()
    held = cut(inside.withColumn("score", sim.sequence_ratio("key", "tkey")), "contained-titles")
    contained = rest.join(held, ["key", "raw_key"]).join(titled, "tkey").where("source_work_id <> work_id").select(*cols, "score")
    every = verified.unionByName(alike).unionByName(contained)
    chosen = every.groupBy("source_work_id", "ref_index").agg(F.max("score").alias("score"), F.min_by("work_id", F.struct(-F.col("score"), F.col("work_id"))).alias("target_work_id"))
    status = F.when(F.col("score") >= 2.0, "verified").otherwise("candidate")
    return chosen.select("source_work_id", "ref_index", "target_work_id", status.alias("status"), F.round(F.when(F.col("score") >= 2.0, 1.0).otherwise(F.col("score")), 4).alias("confidence"))


def citation_counts(edges: DataFrame) -> DataFrame:
    """(target_work_id, citations): verified citations only."""
    return edges.where("status = 'verified'").groupBy("target_work_id").agg(F.count("*").alias("citations"))


def feature_table(works: DataFrame, statements: DataFrame | None, features: DataFrame) -> DataFrame:
    """Long table (work_id, kind, item, weight): text tokens with counts, distinct facets, datasets, references."""
    text = works.select("work_id", F.coalesce("title", F.lit("")).alias("t"))
    if statements is not None:
        method = statements.where("field = 'methodology'").groupBy("work_id").agg(F.concat_ws(" ", F.collect_list("statement")).alias("m"))
        text = text.join(method, "work_id", "left").select("work_id", F.concat_ws(" ", "t", "m").alias("t"))
    words = text.select("work_id", F.explode(tx.related_tokens("t")).alias("item")).groupBy("work_id", "item").agg(F.count("*").cast("double").alias("weight")).select("work_id", F.lit("text").alias("kind"), "item", "weight")
    parts = F.array(*[F.struct(F.lit(kind).alias("kind"), F.coalesce(F.col(col), F.array().cast("array<string>")).alias("vals")) for kind, col in (("facet", "facets"), ("dataset", "datasets"), ("reference", "reference_keys"))])
    flat = features.select("work_id", F.explode(parts).alias("p")).select("work_id", "p.kind", F.explode("p.vals").alias("item")).select("work_id", "kind", tx.fold(tx.strip("item")).alias("item")).where("item is not null and item <> ''")
    return words.unionByName(flat.distinct().withColumn("weight", F.lit(1.0)))


def _pack(kinds: dict[str, int], most: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Features (block, work_id, kind, id, weight) of a block of works as one row, in parts of at most ``most`` works. A part
    has its works, their sizes, and by kind its ids with their places in the works and weights behind them; ids that no other
    work has are null, and count for the sizes only."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        works, at = np.unique(rows["work_id"].to_numpy(dtype=object), return_inverse=True)
        kind, weight = rows["kind"].map(kinds).to_numpy(), rows["weight"].to_numpy(dtype=float)
        sizes = np.zeros((2, len(kinds), len(works)))
        np.add.at(sizes[0], (kind, at), weight)
        np.add.at(sizes[1], (kind, at), weight * weight)
        known = rows["id"].notna().to_numpy()
        ids = rows["id"].where(known, -1).to_numpy(dtype=np.int64)
        parts = []
        for start in range(0, len(works), most):
            lists = []
            for k in range(len(kinds)):
                here = np.flatnonzero(known & (kind == k) & (at >= start) & (at < start + most))
                here = here[np.argsort(ids[here], kind="stable")]
                found, first, n = np.unique(ids[here], return_index=True, return_counts=True)
                lists.append((found, first.astype(np.int32), n.astype(np.int32), (at[here] - start).astype(np.int32), weight[here].astype(np.float32) if (weight[here] == weight[here].astype(np.float32)).all() else weight[here]))
            parts.append((works[start : start + most], sizes[:, :, start : start + most], lists))
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "data": [pickle.dumps(parts)]})

    return pack


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each span of ``n``, one span behind the other."""
    before = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(first - before, n)


def _dots(left: tuple, right: tuple, shape: tuple[int, int], kind: type, dense: float = 0.004) -> tuple[np.ndarray, np.ndarray | None]:
    """Sums of products of the weights of common items, of every work of one part and every one of the other; and the places
    that may not be 0, if they are few.

    Items that meet in a share of the pairs above ``dense`` are columns of a product of matrices, for others the pairs that
    have them are listed."""
    _, x, y = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    nx, ny = left[2][x].astype(np.int64), right[2][y].astype(np.int64)
    often = nx * ny > dense * shape[0] * shape[1]
    often &= (nx * ny)[often].sum() * 8 > shape[0] * shape[1]  # a few such items are listed, too
    out = np.zeros(shape, dtype=kind)
    if often.any():
        sides = []
        for (_, first, _, at, weight), n, found, rows in ((left, nx, x, shape[0]), (right, ny, y, shape[1])):
            place = _spans(first[found[often]], n[often])
            side = np.zeros((rows, int(often.sum())), dtype=kind)
            np.add.at(side, (at[place], np.repeat(np.arange(side.shape[1]), n[often])), weight[place].astype(kind))
            sides.append(side)
        np.matmul(sides[0], sides[1].T, out=out)
    x, y, nx, ny = x[~often], y[~often], nx[~often], ny[~often]
    own = _spans(left[1][x], nx)
    n = np.repeat(ny, nx)
    other = _spans(np.repeat(right[1][y].astype(np.int64), nx), n)
    place = np.repeat(left[3][own].astype(np.int64) * shape[1], n) + right[3][other]
    np.add.at(out.reshape(-1), place, np.repeat(left[4][own].astype(kind), n) * right[4][other].astype(kind))
    return out, None if often.any() or len(place) * 5 > out.size else np.unique(place)


def _scored(left: tuple, right: tuple, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Pairs of works of two parts that pass the rule: places in either part, the similarities and the score. The dots are
    exact in float32 if weights are whole and sizes small; pairs near the limits are scored in float64, in the order of the
    SQL."""
    (_, sx, lx), (_, sy, ly) = left, right
    names = list(WEIGHTS)
    shape = (sx.shape[2], sy.shape[2])
    whole = all((part[4] == np.floor(part[4])).all() for part in (*lx, *ly)) and max(sx[1].max(), sy[1].max()) < 2**24
    text = names.index("text")
    found = [_dots(lx[k], ly[k], shape, np.float32 if whole else np.float64) for k in range(len(names))]
    dots = [dot for dot, _ in found]
    x, y = ((1 / np.sqrt(np.maximum(s[1][text], 1e-30))).astype(np.float32) for s in (sx, sy))
    rough = dots[text].astype(np.float32, copy=False) * (np.float32(WEIGHTS["text"]) * x)[:, None]
    rough *= y[None, :]
    for k, name in enumerate(names):
        dot, few = found[k]
        if k == text:
            continue
        if few is None:
            under = sx[0][k].astype(np.float32)[:, None] + sy[0][k].astype(np.float32)[None, :]
            under -= dot.astype(np.float32, copy=False)
            np.maximum(under, np.float32(1e-30), out=under)
            np.divide(dot.astype(np.float32, copy=False), under, out=under)
            under *= np.float32(WEIGHTS[name])
            rough += under
        elif len(few):
            i, j = np.divmod(few, shape[1])
            met = dot.reshape(-1)[few]
            rough.reshape(-1)[few] += (WEIGHTS[name] * met / np.maximum(sx[0][k][i] + sy[0][k][j] - met, 1e-30)).astype(np.float32)
    i, j = np.divmod(np.flatnonzero(rough >= np.float32(threshold - 1e-4)), shape[1])
    if same:
        i, j = i[i < j], j[i < j]
    v = []
    for k, name in enumerate(names):
        dot = dots[k][i, j].astype(float)
        under = np.sqrt(sx[1][k][i] * sy[1][k][j]) if name == "text" else sx[0][k][i] + sy[0][k][j] - dot
        v.append(np.divide(dot, under, out=np.zeros(dot.shape), where=dot != 0))
    score = sum((WEIGHTS[name] * v[k] for k, name in enumerate(names)), np.zeros(len(i)))
    active = sum(x > 0 for x in v)
    kept = (score >= threshold) & ((active >= 2) | (v[text] >= TEXT_ALONE) | (v[names.index("reference")] >= COUPLING_ALONE))
    return i[kept], j[kept], [x[kept] for x in v], score[kept]


def _related_in_blocks(threshold: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of works of two blocks that pass the rule."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right, same in zip(batch["left"], batch["right"], batch["same"]):
                mine, others = pickle.loads(left), pickle.loads(right)
                for m, x in enumerate(mine):
                    for n, y in enumerate(others):
                        if not same or m <= n:
                            i, j, v, score = _scored(x, y, same and m == n, threshold)
                            a, b = x[0][i], y[0][j]
                            yield pd.DataFrame({"a": np.where(a < b, a, b), "b": np.where(a < b, b, a)} | dict(zip(WEIGHTS, v)) | {"score": score})

    return run


def _may_be_best(own: np.ndarray, score: np.ndarray, per_work: int) -> np.ndarray:
    """Rows whose score can be among the best ``per_work`` of ``own`` when scores are rounded to 4 digits: none of these is
    lost, as what lies more than a unit below the last of them is less after rounding, too."""
    order = np.argsort(2.0 * own - score)  # by work, then by score, the best first
    own, score = own[order], score[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    n = np.diff(first, append=len(own))
    last = score[first + np.minimum(per_work, n) - 1]
    return order[score >= np.repeat(last - 1.001e-4, n)]


def _best_in_blocks(threshold: float, per_work: int, most: int = 1_000_000) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Ends (own, other, score) of the pairs of works of two blocks that pass the rule, those that are not among the best
    ``per_work`` of their own work in these blocks left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right, same in zip(batch["left"], batch["right"], batch["same"]):
                mine, others = pickle.loads(left), pickle.loads(right)
                works = np.concatenate([p[0] for p in mine] + ([] if same else [p[0] for p in others]))
                starts = [np.cumsum([0] + [len(p[0]) for p in side]) for side in (mine, others)]
                starts[1] = starts[1] + (0 if same else starts[0][-1])
                held, n_held, limit = [], 0, most
                for m, x in enumerate(mine):
                    for n, y in enumerate(others):
                        if same and m > n:
                            continue
                        i, j, _, score = _scored(x, y, same and m == n, threshold)
                        i, j = i + starts[0][m], j + starts[1][n]
                        held.append((np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([score, score])))
                        n_held += 2 * len(i)
                        if n_held > limit or (m, n) == (len(mine) - 1, len(others) - 1):
                            own, other, score = (np.concatenate(c) for c in zip(*held))
                            rows = _may_be_best(own, score, per_work)
                            held = [(own[rows], other[rows], score[rows])]
                            n_held = len(rows)
                            limit = max(most, 2 * n_held)
                own, other, score = held[0]
                yield pd.DataFrame({"own": works[own], "other": works[other], "score": score})

    return run


def _blocks_of_works(features: DataFrame, works_per_block: int, most_blocks: int, works_per_part: int) -> DataFrame:
    """Blocks of works as rows (block, data) of :func:`_pack`. Items get numbers if several works have them; the others count
    for the sizes only. Beyond ``most_blocks`` blocks get larger, so that what is shuffled grows with the works."""
    rows = features.where("work_id is not null and item is not null").where(F.col("kind").isin(*WEIGHTS))
    items = cut(rows.groupBy("kind", "item").agg(F.count("*").alias("n")).where("n > 1").select("kind", "item", F.monotonically_increasing_id().alias("id")), "items")
    n_works = rows.select(F.count_distinct("work_id")).first()[0]
    block = F.pmod(F.xxhash64("work_id"), F.lit(max(1, min(most_blocks, -(-n_works // works_per_block)))))
    numbered = rows.join(items, ["kind", "item"], "left").select(block.alias("block"), "work_id", "kind", "id", "weight")
    return cut(numbered.groupBy("block").applyInPandas(_pack({k: n for n, k in enumerate(WEIGHTS)}, works_per_part), "block long, data binary"), "blocks")


def related_pairs(features: DataFrame, threshold: float = RELATED_THRESHOLD, works_per_block: int = 6_000, most_blocks: int = 32, works_per_part: int = 500) -> DataFrame:
    """Pairs of works that pass the related-work rule: the four similarities and the score.

    Common items make most pairs of works share something, so all pairs are scored: blocks of works meet, part by part, and
    only pairs that pass leave a task. The work grows with the square of the works, what is shuffled with the works times
    the number of blocks.
    """
    packed = _blocks_of_works(features, works_per_block, most_blocks, works_per_part)
    schema = f"a string, b string, {', '.join(f'{k} double' for k in WEIGHTS)}, score double"
    kept = sim.meet_in_blocks(packed, packed, F.col("block") <= F.col("block_"), _related_in_blocks(threshold), schema)
    return kept.select(F.col("a").alias("left_work_id"), F.col("b").alias("right_work_id"), *[F.round(k, 4).alias(k) for k in WEIGHTS], F.round("score", 4).alias("score"))


def related_best(features: DataFrame, per_work: int = RELATED_PER_WORK, threshold: float = RELATED_THRESHOLD, works_per_block: int = 6_000, most_blocks: int = 32, works_per_part: int = 500) -> DataFrame:
    """:func:`related_top` of :func:`related_pairs`, whose pairs are scored as there, but never stored: of the blocks that
    meet, only what can be among the best of a work leaves the task."""
    packed = _blocks_of_works(features, works_per_block, most_blocks, works_per_part)
    ends = sim.meet_in_blocks(packed, packed, F.col("block") <= F.col("block_"), _best_in_blocks(threshold, per_work), "own string, other string, score double")
    order = Window.partitionBy("own").orderBy(F.col("score").desc(), F.col("other").desc())
    top = ends.withColumn("score", F.round("score", 4)).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_work)
    return top.groupBy(F.least("own", "other").alias("left_work_id"), F.greatest("own", "other").alias("right_work_id")).agg(F.max("score").alias("score"))


def related_top(pairs: DataFrame, per_work: int = RELATED_PER_WORK) -> DataFrame:
    """Pairs that are among the best ``per_work`` of either end; ties go to the greater other id."""
    both = pairs.select("left_work_id", "right_work_id", "score", F.explode(F.array(F.struct(F.col("left_work_id").alias("own"), F.col("right_work_id").alias("other")), F.struct(F.col("right_work_id").alias("own"), F.col("left_work_id").alias("other")))).alias("e"))
    order = Window.partitionBy("e.own").orderBy(F.col("score").desc(), F.col("e.other").desc())
    top = both.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_work)
    return top.groupBy("left_work_id", "right_work_id").agg(F.max("score").alias("score"))


def _named(datasets: DataFrame) -> DataFrame:
    return datasets.where(tx.strip("name") != "").select("work_id", tx.strip("name").alias("name"), F.concat(F.lit("dataset:"), tx.title_key("name")).alias("id"))


def _tagged(labels: DataFrame) -> DataFrame:
    return labels.where("label_id is not null").select("work_id", "facet", tx.display_name("label_id").alias("name"), F.concat(F.lit("facet:"), F.col("label_id")).alias("id"))


def graph_nodes(works: DataFrame, datasets: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label, type, facet) of papers, datasets and taxonomy labels; the first label wins."""
    papers = works.select(F.col("work_id").alias("id"), "title", F.lit("paper").alias("type"), F.lit(None).cast("string").alias("facet"), F.lit("").alias("ord"))
    ds_nodes = _named(datasets).select("id", F.col("name").alias("title"), F.lit("dataset").alias("type"), F.lit(None).cast("string").alias("facet"), F.concat_ws("\0", "work_id", "name").alias("ord"))
    tax_nodes = _tagged(labels).select("id", F.col("name").alias("title"), F.lit("taxonomy").alias("type"), "facet", F.concat_ws("\0", "work_id", "facet").alias("ord"))
    return papers.unionByName(ds_nodes).unionByName(tax_nodes).groupBy("id").agg(F.min_by(F.struct(F.col("title").alias("label"), "type", "facet"), "ord").alias("n")).select("id", "n.*")


def knowledge_graph(works: DataFrame, datasets: DataFrame, labels: DataFrame, citations: DataFrame, related: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of papers, datasets and taxonomy labels.

    nodes: :func:`graph_nodes`; edges: source, target, type, status, weight (the last wins).
    """
    nodes, named, tagged = graph_nodes(works, datasets, labels), _named(datasets), _tagged(labels)
    edge = lambda df, s, t, kind, status, weight: df.select(F.col(s).alias("source"), F.col(t).alias("target"), F.lit(kind).alias("type"), status.alias("status"), weight.alias("weight"))
    none, one = F.lit(None).cast("string"), F.lit(1.0)
    every = (
        edge(citations, "source_work_id", "target_work_id", "citation", F.col("status"), F.col("confidence").cast("double"))
        .unionByName(edge(related, "left_work_id", "right_work_id", "related", none, F.col("score").cast("double")))
        .unionByName(edge(named, "work_id", "id", "evaluated_on", none, one)).unionByName(edge(tagged, "work_id", "id", "classified_as", none, one))
    )
    edges = every.groupBy("source", "target", "type").agg(F.max_by(F.struct("status", "weight"), F.struct(F.coalesce("status", F.lit("")), "weight")).alias("e")).select("source", "target", "type", "e.*")
    return nodes, edges


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(measure, n): nodes and edges by type."""
    return nodes.groupBy(F.concat(F.lit("nodes:"), F.col("type")).alias("measure")).agg(F.count("*").alias("n")).unionByName(edges.groupBy(F.concat(F.lit("edges:"), F.col("type")).alias("measure")).agg(F.count("*").alias("n")))
