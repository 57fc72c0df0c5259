"""Problem 8: filling containers of fixed capacity, as vector bin packing with the dot-product heuristic.

Texts are sized in tokens of a public tokenizer. A container has limits on several dimensions at once: tokens, number of
segments, loss-bearing tokens. The open container takes, of all pieces that still fit, the one whose demand has the
greatest weighted dot product with what is left (Panigrahy et al., "Heuristics for vector bin packing", 2011).
Pieces are packed in groups of bounded size, one task each; badly filled containers are then opened again and their
items packed in new groups, which are fewer but not larger.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut

#: Where the vocabulary files of the public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Limits:
    """Capacity of a container."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


@lru_cache(maxsize=2)
def encoder(path: str):  # noqa: ANN201
    """A byte-level encoder from a file of ranks (base64 token and rank a line)."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, n_tokens, n_prompt) of every row with an id; null texts have none. Strings of special tokens are ordinary
    text. The *prompt* of a text is its first line, its response what follows; a text of one line has no prompt."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = [len(encode(t)) if t else 0 for t in texts]
            heads = [(t or "").partition("\n") for t in texts]
            prompts = [min(n, len(encode(h))) if rest.strip() else 0 for n, (h, _, rest) in zip(sizes, heads)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prompts, pa.int64())], names=["doc_id", "n_tokens", "n_prompt"])

    return documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, "doc_id long, n_tokens long, n_prompt long")


def pieces(sizes: DataFrame, capacity: int, *keep: str) -> DataFrame:
    """(doc_id, piece, start_token, tokens) and the columns ``keep``: a text that alone exceeds the capacity is cut into full pieces and a rest."""
    cuts = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity).cast("long")))
    rows = sizes.where("n_tokens > 0").select("doc_id", "n_tokens", *keep, cuts.alias("piece"))
    start = F.col("piece") * capacity
    return rows.select("doc_id", "piece", start.alias("start_token"), F.least(F.lit(capacity), F.col("n_tokens") - start).alias("tokens"), *keep)


def pack(demand: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Container number of each item (rows of ``demand``), by the dot-product heuristic.

    Equal items are one kind, so that a step costs the number of kinds. Weights are the demands' sums over the
    capacities; ties go to the greater first dimension. An item above a limit has a container of its own.
    """
    kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    order = np.lexsort(kinds.T[::-1])[::-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    kinds, kind_of = kinds[order], rank[kind_of]
    waiting = [list(x) for x in np.split(np.argsort(kind_of, kind="stable"), np.cumsum(np.bincount(kind_of, minlength=len(kinds)))[:-1])]
    left = np.array([len(w) for w in waiting])
    weight = demand.sum(axis=0) / capacity / np.maximum(1, demand.sum(axis=0).max())
    scaled = kinds / capacity * weight
    out = np.full(len(demand), -1, dtype=np.int64)
    box = 0
    while left.any():
        rest = capacity.astype(float).copy()
        filled = False
        while True:
            fits = (left > 0) & (kinds <= rest).all(axis=1)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, scaled @ (rest / capacity), -1.0)))
            out[waiting[k].pop()] = box
            left[k] -= 1
            rest -= kinds[k]
            filled = True
        if not filled:  # nothing left fits even an empty container
            k = int(np.flatnonzero(left)[0])
            out[waiting[k].pop()] = box
            left[k] -= 1
        box += 1
    return out


def _pack_groups(items: DataFrame, groups: int, limits: Limits, level: int) -> DataFrame:
    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        box = pack(pdf[["tokens", "segments", "loss"]].to_numpy(), np.array(astuple(limits)))
        return pdf.assign(container=[f"{level}-{g}-{b}" for g, b in zip(pdf["grp"], box)])

    schema = "doc_id long, piece long, start_token long, tokens long, segments long, loss long, grp long, container string"
    return items.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(groups))).groupBy("grp").applyInPandas(place, schema)


def fill_containers(items: DataFrame, limits: Limits = Limits(), group_items: int = 8_192, well_filled: float = 0.97, gain: float = 0.9) -> DataFrame:
    """``(doc_id, piece, start_token, tokens, segments, loss, container)`` of items (the columns but the last).

    Every item gets exactly one container; no limit is exceeded (an item above one is alone). Groups have about
    ``group_items`` items, whatever the table's size and at every level. The items of containers that are filled below
    ``well_filled`` of a limit are packed again in new groups, until one group holds them all or a level leaves more
    than ``gain`` of them, as where no two items fit together. An empty table gives an empty one.
    """
    n, level, rest, done = items.count(), 0, items, None
    while True:
        groups = max(1, -(-n // group_items))
        packed = cut(_pack_groups(rest, groups, limits, level), "packed")
        used = F.greatest(*[F.sum(d) / F.lit(float(most)) for d, most in (("tokens", limits.tokens), ("segments", limits.segments), ("loss", limits.loss))])
        full = packed.groupBy("container").agg((used >= well_filled).alias("full"))
        left = None if groups == 1 else cut(packed.join(full.where("not full").select("container"), "container", "left_semi"), "refill")
        last = left is None or (after := left.count()) > gain * n or after == 0
        final = packed if last else packed.join(full.where("full").select("container"), "container", "left_semi")
        shown = final.select("doc_id", "piece", "start_token", "tokens", "segments", "loss", "container")
        done = shown if done is None else done.unionByName(shown)
        if last:
            return done
        rest, n, level = left.drop("container", "grp"), after, level + 1


def packed_documents(documents: DataFrame, limits: Limits = Limits(), vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", **options: float) -> DataFrame:
    """Containers of whole documents: sized in tokens, cut only above the capacity, one segment a piece; the tokens of
    the response bear loss, those of the prompt (:func:`token_counts`) do not. Null and empty texts have no token and
    no container; of repeated ids the longest text counts."""
    sizes = token_counts(documents, vocabulary=vocabulary).groupBy("doc_id").agg(F.max(F.struct("n_tokens", "n_prompt")).alias("s")).select("doc_id", "s.n_tokens", "s.n_prompt")
    sizes = cut(sizes, "token-counts")
    prompt = F.when(F.col("piece") == 0, F.least("n_prompt", "tokens")).otherwise(F.lit(0).cast("long"))
    items = pieces(sizes, limits.tokens, "n_prompt").withColumn("segments", F.lit(1).cast("long")).withColumn("loss", F.col("tokens") - prompt).drop("n_prompt")
    return fill_containers(items, limits, **options)


def container_usage(packed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row: containers, items, tokens, share of the capacity used, containers with several items over a limit (none),
    and how many are full by each limit, i.e. could not take another average item."""
    per = packed.groupBy("container").agg(F.sum("tokens").alias("t"), F.count("*").alias("s"), F.sum("segments").alias("g"), F.sum("loss").alias("l"))
    mean = per.agg((F.sum("t") / F.sum("s")).alias("mt"), (F.sum("l") / F.sum("s")).alias("ml"))  # one row
    over = (F.col("s") > 1) & ((F.col("t") > limits.tokens) | (F.col("g") > limits.segments) | (F.col("l") > limits.loss))
    return per.crossJoin(F.broadcast(mean)).agg(
        F.count("*").alias("n_containers"), F.sum("s").alias("n_items"), F.sum("t").alias("n_tokens"), F.round(F.sum("t") / (F.count("*") * limits.tokens), 6).alias("used"), F.count_if(over).alias("n_over"),
        F.count_if(F.col("t") + F.col("mt") > limits.tokens).alias("full_tokens"), F.count_if(F.col("g") >= limits.segments).alias("full_segments"), F.count_if(F.col("l") + F.col("ml") > limits.loss).alias("full_loss"),
    )


def packing_faults(documents: DataFrame, packed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """What a packing must hold: (n_documents, n_lost, n_twice, n_over, n_needless) for documents with a text, those without
    container, pieces in two containers, containers over a limit, and documents cut below the capacity."""
    wanted = documents.where("doc_id is not null and text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    placed = packed.groupBy("doc_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("k"), F.countDistinct("piece").alias("p"))
    per = wanted.join(placed, "doc_id", "full").agg(F.count("*").alias("n_documents"), F.count_if(F.col("k").isNull()).alias("n_lost"), F.coalesce(F.sum(F.col("k") - F.col("p")), F.lit(0)).alias("n_twice"), F.count_if((F.col("p") > 1) & (F.col("t") <= limits.tokens)).alias("n_needless"))
    usage = container_usage(packed, limits).select("n_over")
    return per.crossJoin(F.broadcast(usage)).select("n_documents", "n_lost", "n_twice", "n_over", "n_needless")
