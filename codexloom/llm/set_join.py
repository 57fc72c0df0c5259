"""Problem 5: all similar pairs of set-valued records, by recursive chosen-path splitting.

Records walk down random trees (Christiani and Pagh, "Set similarity search beyond MinHash", 2017; Christiani, Pagh and
Sivertsen, "Scalable and robust set similarity join", 2018). At a node, a record x goes on to the child of each of its
tokens that a hash of (path, token) picks with probability 1 / (b * |x|); records that pick the same token meet there.
Nodes with few records are joined by brute force. Trees are repeated until the chance to miss a pair at the threshold is
below 1 - target recall; every pair found is verified.

Large nodes split without chance, as every further random split would leave a pair fewer shared tokens to meet on: the
other tokens of a record stand in one order, rare ones first, and a path takes them in that order. Sets of sizes a and b
that are similar share at least ceil(t / (1 + t) * (a + b)) tokens, hence the next shared one stands at a bounded place
of both. Once a path is as long as this overlap every pair of its node that has these sizes is similar, and is joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import bitmap, may_share
from ..storage import cut


def tagged_items(records: DataFrame, id_col: str, fields: tuple[str, ...], least: int = 1) -> DataFrame:
    """(id, items): the distinct items of several array columns, items of different columns being different.

    Letter case and outer blanks are disregarded; null and blank items, null arrays and null ids are dropped; sets with
    fewer than ``least`` items are left out. Repeated ids unite their items.
    """
    norm = lambda f: F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), lambda x: F.lower(F.regexp_replace(x, r"^[\s\u00a0]+|[\s\u00a0]+$", "")))
    tag = lambda f: F.transform(F.filter(norm(f), lambda x: x.isNotNull() & (x != "")), lambda x: F.concat(F.lit(f + "\x1f"), x))
    tagged = F.flatten(F.array(*[tag(f) for f in fields]))
    rows = records.select(F.col(id_col).alias("id"), tagged.alias("items")).where("id is not null")
    merged = rows.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.where(F.size("items") >= least)


def least_overlap(threshold: float, a: Column, b: Column) -> Column:
    """Tokens that sets of sizes a and b share at least if their Jaccard similarity is >= threshold."""
    return F.ceil((a + b) * threshold / (1 + threshold) - 1e-9)


def trees_needed(threshold: float, branch: float, target_recall: float, depth: int) -> int:
    """Trees so that a pair at the threshold is met with probability >= target_recall.

    Two similar records share at least threshold * |larger| tokens, so that Poisson(threshold / branch) of their
    children are common at each level; the survival over ``depth`` levels follows by recursion on the generating function.
    """
    mean, alive = threshold / branch, 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-mean * alive)
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - alive)))


def _picked(seed: Column, items: Column, n: Column, branch: float) -> Column:
    """Tokens that the hash of (tree, token) picks."""
    limit = (F.lit(2.0**53) / (F.lit(branch) * n)).cast("double")
    return F.filter(items, lambda i: F.shiftrightunsigned(F.xxhash64(seed, i), 11).cast("double") < limit)


def _rare_first(rows: DataFrame) -> DataFrame:
    """(key, side, tokens) with the tokens in order of their frequency."""
    tokens = rows.select("key", "side", F.explode("tokens").alias("tok"))
    counted = tokens.join(tokens.groupBy("tok").agg(F.count("*").alias("k")), "tok")
    return counted.groupBy("key", "side").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "tok"))), lambda x: x["tok"]).alias("tokens"))


def chosen_path_join(sets: DataFrame, threshold: float, other: DataFrame | None = None, target_recall: float = 0.99999, branch: float = 0.2, small: int = 64, depth: int = 6) -> DataFrame:
    """Pairs of different *classes* of equal sets with Jaccard similarity >= threshold: ``(l, r, overlap, similarity)``.

    ``sets`` and ``other`` have columns (class, items); a class is a row with distinct items. Without ``other`` pairs
    lie within ``sets``, l < r; with it, l is of ``sets`` and r of ``other``. Only the first token of a path is random;
    nodes larger than ``small`` lose no pair when they split, and those that are still larger after ``depth`` levels are
    joined whole, so no cap drops a pair. Null and empty sets pair with nothing. Pairs met are sifted by bitmaps of their
    tokens where they meet, and verified on the items themselves.
    """
    two = other is not None
    rows = sets.select(F.col("class"), "items", F.lit(0).alias("side"))
    if two:
        rows = rows.unionByName(other.select(F.col("class"), "items", F.lit(1).alias("side")))
    rows = rows.where(F.size("items") > 0).withColumn("key", F.xxhash64("class")).withColumn("tokens", F.transform("items", lambda i: F.xxhash64(i)))
    low, high = bitmap(F.col("tokens"))
    rows = cut(rows.select("class", "items", "key", "side", "tokens", F.size("items").alias("n"), low.alias("low"), high.alias("high")), "sets")
    count = trees_needed(threshold, branch, target_recall, 1)
    level = rows.select("key", "side", "n", "low", "high", F.explode(F.sequence(F.lit(1), F.lit(count))).alias("tree"), "tokens")
    level = level.select("key", "side", "n", "low", "high", "tree", F.explode(_picked(F.col("tree"), F.col("tokens"), F.col("n"), branch)).alias("tok"))
    level = level.select("key", "side", "n", "low", "high", F.xxhash64("tree", "tok").alias("node"), F.col("tok").alias("first"), F.lit(0).alias("at"))
    found: DataFrame | None = None
    ordered: DataFrame | None = None
    for step in range(1, depth + 1):
        level = cut(level, "nodes")
        sizes = level.groupBy("node").agg(F.count("*").alias("k"), F.countDistinct("side").alias("sides")).where("k > 1" + (" and sides = 2" if two else ""))
        last = step == depth
        leaf = level.join(sizes, "node").withColumn("whole", F.lit(last) | (F.col("k") <= small)).where(F.col("whole") | (least_overlap(threshold, F.col("n"), F.col("n") * threshold) <= step))
        left = leaf.select("node", "whole", F.col("key").alias("kl"), F.col("n").alias("nl"), F.col("side").alias("sl"), F.col("low").alias("ll"), F.col("high").alias("hl"))
        right = leaf.select("node", F.col("key").alias("kr"), F.col("n").alias("nr"), F.col("side").alias("sr"), F.col("low").alias("lr"), F.col("high").alias("hr"))
        need = least_overlap(threshold, F.col("nl"), F.col("nr"))
        met = left.join(right, "node").where("sl = 0 and sr = 1" if two else "kl < kr")
        met = met.where((F.col("nl") >= F.col("nr") * threshold - 1e-9) & (F.col("nr") >= F.col("nl") * threshold - 1e-9))
        met = met.where(may_share((F.col("ll"), F.col("hl")), F.col("nl"), (F.col("lr"), F.col("hr")), F.col("nr"), need))
        met = met.where(F.col("whole") | (need <= step)).select("kl", "kr").distinct()
        found = met if found is None else found.unionByName(met)
        if last:
            break
        large = cut(level.join(sizes.where(F.col("k") > small).select("node"), "node"), "large-nodes")
        if large.isEmpty():
            break
        if ordered is None:
            ordered = cut(_rare_first(rows), "ordered-sets")
        on = large.join(ordered, ["key", "side"]).withColumn("rest", F.array_remove("tokens", F.col("first")))
        furthest = F.least(F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + step, F.col("n") - 1)
        ahead = F.slice("rest", F.col("at") + 1, F.greatest(furthest - F.col("at"), F.lit(0)).cast("int"))
        on = on.select("key", "side", "n", "low", "high", "node", "first", "at", F.posexplode(ahead).alias("i", "tok"))
        level = on.select("key", "side", "n", "low", "high", F.xxhash64("node", "tok").alias("node"), "first", (F.col("at") + F.col("i") + 1).alias("at"))
    pairs = cut(found.distinct(), "met-pairs")
    side = lambda k, one: rows.where(F.col("side") == k).select(F.col("key").alias("k" + one), F.col("class").alias(one), F.col("items").alias("i" + one))
    exact = pairs.join(side(0, "l"), "kl").join(side(int(two), "r"), "kr").withColumn("overlap", F.size(F.array_intersect("il", "ir")))
    exact = exact.withColumn("similarity", F.col("overlap") / (F.size("il") + F.size("ir") - F.col("overlap"))).where(F.col("similarity") >= threshold - 1e-12)
    if two:
        return exact.select("l", "r", "overlap", "similarity")
    return exact.select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r"), "overlap", "similarity")


def with_classes(sets: DataFrame) -> DataFrame:
    """(id, items, class): equal sets share a class, the least of their ids, so that copies walk the trees once."""
    return sets.join(sets.groupBy("items").agg(F.min("id").alias("class")), "items").select("id", "items", "class")


def set_pairs(sets: DataFrame, threshold: float, **options: float) -> DataFrame:
    """All pairs of ids ``(left_id, right_id, similarity)``, smaller id first, of rows (id, items): class pairs, and copies."""
    classed = cut(with_classes(sets), "classed-sets")
    linked = chosen_path_join(classed.where("id = class").select("class", "items"), threshold, **options).select("l", "r", "similarity")
    linked = linked.unionByName(classed.groupBy("class").agg(F.count("*").alias("k")).where("k > 1").select(F.col("class").alias("l"), F.col("class").alias("r"), F.lit(1.0).alias("similarity")))
    a, b = classed.select(F.col("class").alias("l"), F.col("id").alias("a")), classed.select(F.col("class").alias("r"), F.col("id").alias("b"))
    out = linked.join(a, "l").join(b, "r").where("a <> b").where("l <> r or a < b")
    return out.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"), "similarity")
