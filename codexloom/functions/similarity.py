"""Similarities that need more than an expression: the matching-blocks ratio, its upper bounds, and joins of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789"
_CODES = {ch: k for k, ch in enumerate(_SIGNS)}
_OTHER, _PAD = len(_SIGNS), len(_SIGNS) + 1


_LUT = np.full(256, _OTHER, dtype=np.uint8)
for _ch, _k in _CODES.items():
    _LUT[ord(_ch)] = _k


def codes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of the keys, and their signs as numbers, a row a key; letters and digits count, other signs are one."""
    lengths = np.array([len(k) for k in keys], dtype=np.int64)
    out = np.full((len(keys), int(lengths.max(initial=0))), _PAD, dtype=np.uint8)
    flat = _LUT[np.frombuffer("".join(keys).encode("ascii", "replace"), dtype=np.uint8)]
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return lengths, out


def _masks(signs: np.ndarray, words: int) -> np.ndarray:
    """Where each sign stands in each key, 64 places a number: (word, key, sign)."""
    out = np.zeros((words, len(signs), _PAD + 1), dtype=np.uint64)
    rows = np.arange(len(signs))
    for at in range(min(signs.shape[1], 64 * words)):
        out[at // 64, rows, signs[:, at]] |= np.uint64(1 << at % 64)
    out[:, :, _PAD] = 0
    return out


def subsequence_lengths(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray, need: np.ndarray | None = None, most: int = 1 << 15) -> np.ndarray:
    """Lengths of the longest common subsequence of the keys ``i`` of ``left`` and ``j`` of ``right`` (:func:`codes`).

    Bit-parallel (Hyyro, 2004) over ``most`` pairs at once, with a carry from one number to the next in keys of more than
    64 signs. Pairs that can no longer reach ``need`` are left early and have 0."""
    out = np.zeros(len(i), dtype=np.int64)
    words, long = (left[0][i] + 63) // 64, right[0][j]
    order = np.lexsort((long, words))
    ends = np.searchsorted(words[order], words, "right") if len(i) else words
    full = np.uint64(2**64 - 1)
    at = 0
    while at < len(order):
        w = int(words[order[at]])
        rows = order[at : min(at + max(1, most // max(1, w)), int(ends[order[at]]))]
        at += len(rows)
        if w == 0:
            continue
        some, own = np.unique(i[rows], return_inverse=True)
        masks = _masks(left[1][some], w).reshape(w, -1)
        others, other = np.unique(j[rows], return_inverse=True)
        columns = np.ascontiguousarray(right[1][others].T)
        own, lengths = own * (_PAD + 1), left[0][i[rows]]
        inside = []
        for k in range(w):
            here = np.clip(lengths - 64 * k, 0, 64)
            inside.append(np.where(here == 64, full, (np.uint64(1) << np.minimum(here, 63).astype(np.uint64)) - np.uint64(1)))
        state = [np.full(len(rows), full) for _ in range(w)]
        steps = int(long[rows].max())
        for step in range(steps):
            place = own + columns[step].take(other)
            carry = None
            for k in range(w):
                met = masks[k].take(place)
                met &= state[k]
                total = state[k] + met
                if w > 1:
                    over = total < met
                    if carry is not None:
                        total += carry
                        over |= total < carry
                    carry = over.astype(np.uint64)
                state[k] ^= met
                state[k] |= total
            if need is not None and step % 8 == 7:
                so_far = sum(np.bitwise_count(~state[k] & inside[k]).astype(np.int64) for k in range(w))
                stay = so_far + np.maximum(long[rows] - step - 1, 0) >= need[rows]
                if stay.mean() < 0.9:
                    rows, own, other, state, inside = rows[stay], own[stay], other[stay], [x[stay] for x in state], [x[stay] for x in inside]
                    if not len(rows):
                        break
        for k in range(w):
            out[rows] += np.bitwise_count(~state[k] & inside[k])
    return out


def common_subsequence(left: list[str], right: list[str]) -> np.ndarray:
    """At least the length of the longest common subsequence of each pair: equal for keys of letters and digits, other
    signs count as one."""
    if not len(left):
        return np.zeros(0, dtype=np.int64)
    short = [a if len(a) <= len(b) else b for a, b in zip(left, right)]
    long = [b if len(a) <= len(b) else a for a, b in zip(left, right)]
    own, other = ({k: n for n, k in enumerate(dict.fromkeys(side))} for side in (short, long))
    return subsequence_lengths(codes(list(own)), codes(list(other)), np.array([own[k] for k in short]), np.array([other[k] for k in long]))


def common_bag(left: np.ndarray, right: np.ndarray, width: int = 512) -> np.ndarray:
    """Signs that the keys have in common, each as often as in both, of every key of ``left`` and every one of ``right``
    (:func:`codes`): products of 0 and 1, exact in float32."""
    counts = [np.stack([(side == k).sum(axis=1) for k in range(_PAD)], axis=1) for side in (left, right)]
    most = np.minimum(counts[0].max(axis=0, initial=0), counts[1].max(axis=0, initial=0))
    sign, nth = np.repeat(np.arange(_PAD), most), np.concatenate([np.arange(1, n + 1) for n in most])
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(sign), width):
        a, b = ((c[:, sign[at : at + width]] >= nth[at : at + width]).astype(np.float32) for c in counts)
        out += a @ b.T
    return out


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratio of matching blocks (Ratcliff and Obershelp), in argument order, which matters."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() if a is not None and b is not None else 0.0 for a, b in zip(left, right)])


def ratio_at_least(threshold: float) -> Callable[[Column | str, Column | str], Column]:
    """:func:`sequence_ratio` where it reaches ``threshold``, else 0. The matching blocks are a common subsequence, whose
    length settles nearly all pairs at once."""

    @F.pandas_udf(T.DoubleType())
    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left))
        rows = [i for i, (a, b) in enumerate(zip(left, right)) if a is not None and b is not None]
        a, b = [left.iloc[i] for i in rows], [right.iloc[i] for i in rows]
        bound = 2.0 * common_subsequence(a, b) >= threshold * np.array([len(x) + len(y) for x, y in zip(a, b)]) - 1e-9
        for k in np.flatnonzero(bound):
            value = SequenceMatcher(None, a[k], b[k]).ratio()
            out[rows[k]] = value if value >= threshold else 0.0
        return pd.Series(out)

    return ratio


def bitmap(hashes: Column) -> tuple[Column, Column]:
    """128 bits of hashed tokens, those of each half in one number."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 8).bitwiseAND(63).cast("int"))
    half = lambda odd: F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: F.when(h.bitwiseAND(1) == odd, acc.bitwiseOR(bit(h))).otherwise(acc))
    return half(0), half(1)


def may_share(left: tuple[Column, Column], n_left: Column, right: tuple[Column, Column], n_right: Column, need: Column) -> Column:
    """Whether sets of which the :func:`bitmap` and the size are known can have ``need`` tokens in common.

    Every bit that only one of them has stands for a token at least that the other one lacks, so no such pair is lost.
    """
    lacks = lambda x, y: F.bit_count(x[0].bitwiseAND(F.bitwise_not(y[0]))) + F.bit_count(x[1].bitwiseAND(F.bitwise_not(y[1])))
    return (n_left - lacks(left, right) >= need) & (n_right - lacks(right, left) >= need)


def blocks_of_keys(keys: DataFrame, rows_per_block: int) -> DataFrame:
    """The one column of distinct keys in blocks of about ``rows_per_block`` keys of like lengths: (block, low, high,
    data), the lengths lying between low and high. The lengths are counted first."""
    c = keys.columns[0]
    sized = keys.select(F.col(c).alias("k"), F.length(c).alias("n"))
    counts = sized.groupBy("n").agg(F.count("*").alias("m"))
    before = counts.withColumn("before", F.sum("m").over(Window.orderBy("n")) - F.col("m"))
    dealt = sized.join(F.broadcast(before), "n").withColumn("block", F.floor((F.col("before") + F.pmod(F.xxhash64("k"), F.col("m"))) / F.lit(rows_per_block)))
    return dealt.groupBy("block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.collect_list("k").alias("data"))


def meet_in_blocks(left: DataFrame, right: DataFrame, meets: Column, run: Callable, schema: str) -> DataFrame:
    """``run`` over every pair of blocks for which ``meets`` holds: an expression of the columns block, low, high of either
    side, those of the right one with an underscore behind them. ``run`` gets rows (left, right), the ``data`` of both.

    Tables of few rows: the pairs of blocks are counted, and dealt to at most 1,000 tasks, so that a task holds one pair of
    blocks at a time and pairs of rows are never shuffled."""
    names = [c for c in left.columns if c != "data"]
    cells = left.select(*names).crossJoin(right.select(*[F.col(c).alias(f"{c}_") for c in names])).where(meets).select("block", "block_")
    tasks = max(1, min(cells.count(), 1_000))
    a = left.select("block", F.col("data").alias("left")).join(cells, "block").repartition(tasks, "block", "block_")
    b = right.select(F.col("block").alias("block_"), F.col("data").alias("right")).join(cells, "block_").repartition(tasks, "block", "block_")
    return a.join(b, ["block", "block_"]).select("left", "right", (F.col("block") == F.col("block_")).alias("same")).mapInPandas(run, schema)


def alike_in_blocks(threshold: float, once: bool) -> Callable:
    """For :func:`meet_in_blocks` over blocks of keys: pairs (a, b) whose longest common subsequence lets the ratio reach
    ``threshold``; it is computed where the common bag of signs does. ``once``: each pair once, a < b, equal keys never."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right, same in zip(batch["left"], batch["right"], batch["same"]):
                a, b = codes(list(left)), codes(list(right))
                need = lambda i, j: np.ceil((a[0][i] + b[0][j]) * (threshold / 2) - 1e-9)  # noqa: B023, E731
                for at in range(0, len(left), 500):  # slices, so that no matrix is large
                    some = np.arange(at, min(at + 500, len(left)))
                    may = common_bag(a[1][some], b[1]) >= need(some[:, None], np.arange(len(right))[None, :])
                    i, j = np.nonzero(np.triu(may, at + 1) if once and same else may)
                    i = some[i]
                    least = need(i, j)
                    kept = subsequence_lengths(a, b, i, j, least) >= least
                    x, y = np.asarray(left, dtype=object)[i[kept]], np.asarray(right, dtype=object)[j[kept]]
                    if once:
                        x, y = np.where(x < y, x, y), np.where(x < y, y, x)
                    yield pd.DataFrame({"a": x, "b": y})

    return run


def grams(key: str) -> set[str]:
    return {key[at : at + 3] for at in range(max(1, len(key) - 2))}


def shared_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For :func:`meet_in_blocks` over blocks of keys: pairs (a, b), a < b, each once, that share at least half of the fewer
    trigrams, with the counts ``shared`` and ``least``.

    Trigrams are dealt to 512 bins. Those that two keys share lie in bins they share, but for the ones that fell on
    another of the same key; so a product of matrices bounds them, and few pairs are counted in full."""
    bins = 512

    def binned(keys: list[set[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.zeros((len(keys), bins), dtype=np.float32)
        for at, g in enumerate(keys):
            out[at, [crc32(x.encode("utf-8", "surrogatepass")) % bins for x in g]] = 1
        n = np.array([len(g) for g in keys], dtype=np.float32)
        return out, n, n - out.sum(axis=1)

    known: dict[str, tuple] = {}  # of the last blocks, by their first key
    for batch in batches:
        for left, right, same in zip(batch["left"], batch["right"], batch["same"]):
            known = {k: known[k] for k in (left[0], right[0]) if k in known}
            for keys in (left, right):
                if keys[0] not in known:
                    sets = [grams(k) for k in keys]
                    known[keys[0]] = (sets, *binned(sets))
            (gx, x, nx, ex), (gy, y, ny, ey) = known[left[0]], known[right[0]]
            for at in range(0, len(left), 500):  # slices, so that no matrix is large
                part = slice(at, min(at + 500, len(left)))
                bound = x[part] @ y.T
                bound += np.minimum(ex[part, None], ey[None, :])
                may = bound >= np.maximum(1, np.floor(np.minimum(nx[part, None], ny[None, :]) / 2))
                i, j = np.nonzero(np.triu(may, at + 1) if same else may)
                i = i + at
                shared = np.array([len(gx[p] & gy[q]) for p, q in zip(i.tolist(), j.tolist())], dtype=np.int64)
                least = np.minimum(nx[i], ny[j]).astype(np.int64)
                kept = shared >= np.maximum(1, least // 2)
                a, b = np.asarray(left, dtype=object)[i[kept]], np.asarray(right, dtype=object)[j[kept]]
                yield pd.DataFrame({"a": np.where(a < b, a, b), "b": np.where(a < b, b, a), "shared": shared[kept], "least": least[kept]})
